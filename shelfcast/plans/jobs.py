"""The two user-level jobs, stage by stage.

Weekly forecast: weekly aggregate -> features -> model -> store breakdown -> daily.
Daily replenishment: cleaned sales + stock + daily forecast -> need -> allocation.

Each stage output that feeds several consumers is written once as parquet into the
shared folder named by ``spark.checkpoint.dir`` and read back (``cut``), which also
cuts its lineage -- the same hand-off points where the original pipeline wrote parquet
between tasks.
That keeps the fact table to ONE scan per job, makes a lost executor cost one
stage instead of the whole chain, and lets each consumer start from a small
materialised table instead of re-running scans, joins and scalar subqueries.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import allocate, breakdown, features, forecast, need, prep, safety, universe, weights
from ..operators.clean import open_order_qty
from ..profiles import Profile, get_profile
from ..session import materialize, materialize_bucketed


def cut(df: DataFrame, name: str = "stage") -> DataFrame:
    """Stage hand-off: see ``shelfcast.session.materialize``."""
    return materialize(df, name)


@dataclass
class WeeklyOutputs:
    weekly: DataFrame
    features: DataFrame
    forecast: DataFrame
    breakdown: DataFrame
    daily: DataFrame


def weekly_forecast_job(sales: DataFrame, product: DataFrame, clusters: DataFrame, calendar: DataFrame,
                        as_of: Column, profile: "Profile | str | None" = None, forecaster=None) -> WeeklyOutputs:
    """E1.  ``forecaster(weekly, features) -> forecast`` replaces the GBT model when given."""
    pf = get_profile(profile)
    weekly = cut(prep.weekly_segment_sales(sales, product, clusters, calendar=calendar, profile=pf, as_of=as_of))
    feats = features.demand_features(weekly, calendar, profile=pf)
    if forecaster is None:
        fc = cut(forecast.forecast_12w(feats, pf))
    else:
        fc = cut(forecaster(weekly, feats))
    ratio = breakdown.store_ratio(sales, product, clusters, as_of=as_of, profile=pf)
    store = breakdown.breakdown_to_store(fc, ratio)
    daily = cut(breakdown.weekly_to_daily(store))
    return WeeklyOutputs(weekly, feats, fc, store, daily)


@dataclass
class DailyOutputs:
    """The need and the allocation are computed when they are first asked for: what only reads the base
    does not wait for them."""

    sales: DataFrame
    stock: DataFrame
    pairs: DataFrame
    safety: DataFrame
    weights: DataFrame
    prediction: DataFrame
    base: DataFrame
    warehouse_stock: DataFrame
    profile: Profile
    include_unserved: bool = False

    @cached_property
    def results(self) -> DataFrame:
        return cut(need.need_with_14day_coverage(self.base, self.profile))

    @cached_property
    def distribution(self) -> DataFrame:
        return allocate.distribute_warehouse_stock(self.results, self.warehouse_stock, include_unserved=self.include_unserved)


def daily_replenishment_job(sales: DataFrame, product: DataFrame, store_stock: DataFrame,
                            warehouse_stock: DataFrame, stock_movement: DataFrame, daily_pred: DataFrame,
                            as_of: Column, profile: "Profile | str | None" = None,
                            include_unserved: bool = False, buckets: int | None = None) -> DailyOutputs:
    """Need per store x product and the allocation of warehouse stock.

    Sales and stock are stage tables in ``buckets`` of (store, product): the day sums, the
    safety stock, the 7/14/28-day sums, the stock on hand and their joins to the universe read them
    in place.  Of the star's sides only the universe, the prediction and the orders are shuffled, each once."""
    pf = get_profile(profile)
    s = materialize_bucketed(universe.replenishment_sales(sales, product, as_of, pf), need.KEY, "repl-sales", buckets)
    # the last sales date, read once from the small materialised table and passed on as a
    # literal: five sub-plans filter on it, and a literal date can prune partitions at
    # planning time where a scalar subquery only filters at run time
    end = F.lit(s.agg(F.max("date")).first()[0]).cast("date")
    stock = materialize_bucketed(universe.stock_by_day(store_stock, as_of, pf.stock_month_floor_days),
                                 ["magaza", "product_id"], "stock", buckets)
    if pf.forecast_universe:
        # forecast-driven universe: forecast pairs join the stock pairs, 'today' is the later
        # of the two dates, and variant weights are only needed where a forecast exists
        skus = universe.store_sku_pairs(stock, daily_pred, anchor="max", lookahead_pred_days=None)
        pairs = universe.style_to_variants(skus, product)
        positive = (daily_pred.filter(F.col("prediction_store_daily") > 0)
                              .select("store_code", "stok_kodu").distinct())
        # the styles are chosen before they are expanded to their variants
        forecast_skus = skus.join(positive.withColumnRenamed("store_code", "magaza"), ["magaza", "stok_kodu"], "left_semi")
        weight_pairs = universe.style_to_variants(forecast_skus, product)
    else:
        pairs = universe.store_product_pairs(stock, product)
        weight_pairs = pairs
    ss = safety.seasonal_safety_stock(
        s, end, lead_time_days=pf.lead_time_days, service_level=pf.service_level,
        use_weighted_calculation=pf.weighted_safety, weight_strategy=pf.weight_strategy,
        weight_decay_factor=pf.weight_decay_factor, recent_days_weight=pf.recent_days_weight)
    wm = weights.variant_weight_map(s, stock, weight_pairs, end)
    p14 = weights.prediction_14d_by_product(daily_pred, wm, end, drop_negative=pf.drop_negative_predictions)
    orders = open_order_qty(stock_movement, null_safe=pf.null_safe_open_orders, depot=pf.open_order_depot)
    base = need.replenishment_base(pairs, ss, p14, universe.latest_stock(stock), need.sales_7_14_28(s, end), orders,
                                   integer_orders=pf.integer_open_orders)
    return DailyOutputs(s, stock, pairs, ss, wm, p14, base, warehouse_stock, pf, include_unserved)
