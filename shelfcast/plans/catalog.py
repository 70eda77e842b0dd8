"""Registered queries: one callable per operator key, ``(spark, sf_dir) -> DataFrame``.

Each callable builds the retail views from the driver tables and runs one
operator (or one composite job) on the whole tables.  Doubles are rounded to four
places at the very end (report precision), the same rounding the DuckDB oracle
applies.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import prep
from ..profiles import LOCAL, PROD
from ..sources.fixtures import Retail

# Registered weekly jobs run the prod rules over the WHOLE sales history: the
# 24-month window is a profile parameter (``prep_lookback_months``) and is
# exercised on its own by ``month_floor_lookback``.
PROD_ALL_HISTORY = PROD.with_(name="prod_all_history", prep_lookback_months=None)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def finish(df: DataFrame, scale: int = 4) -> DataFrame:
    """Round double/float columns (report precision shared with the oracle)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(f"`{f.name}`").cast(T.DecimalType(38, 10))
            cols.append(F.round(c, scale).cast("double").alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def as_of_lit(r: Retail):
    return F.lit(r.as_of)


def _memo(r: Retail, name: str, build):
    """Build a stage output once per query call (chained keys share it)."""
    store = r.__dict__.setdefault("_memo", {})
    if name not in store:
        store[name] = build()
    return store[name]


# ------------------------------------------------------------------ step 1: H1
def _weekly(r: Retail, profile=PROD_ALL_HISTORY) -> DataFrame:
    return prep.weekly_segment_sales(r.history_sales, r.dim_product, r.store_clustering,
                                     calendar=r.dim_calendar, profile=profile, as_of=as_of_lit(r))


@register("weekly_segment_sales")
def q_weekly_segment_sales(spark, sf_dir):
    return finish(_weekly(Retail(spark, sf_dir)))


# ------------------------------------------------------------- step 1: sources
import uuid  # noqa: E402

from ..operators import clean  # noqa: E402
from ..session import scratch_path  # noqa: E402
from ..sources import io  # noqa: E402
from ..functions.columns import clean_attribute_code, discount_fraction  # noqa: E402

HISTORY_SALES_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()), T.StructField("store_code", T.StringType()),
    T.StructField("product_id", T.StringType()), T.StructField("stok_kodu", T.StringType()),
    T.StructField("net_quantity", T.DoubleType()), T.StructField("discount_amount", T.DoubleType()),
    T.StructField("net_amount_wovat", T.DoubleType()), T.StructField("unit_price", T.DoubleType())])


def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@register("src_parquet_pruned")
def q_src_parquet_pruned(spark, sf_dir):
    df = io.read_parquet_pruned(spark, f"{sf_dir}/lineitem.parquet",
                                ["l_partkey", "l_suppkey", "l_quantity", "l_shipdate"])
    return finish(df.withColumn("l_shipdate", F.col("l_shipdate").cast("date")))


@register("src_csv")
def q_src_csv(spark, sf_dir):
    path = _scratch(spark, "history_sales_csv")
    io.write_csv(Retail(spark, sf_dir).history_sales, path)
    return finish(io.read_csv(spark, path, HISTORY_SALES_SCHEMA))


@register("src_csv_locale")
def q_src_csv_locale(spark, sf_dir):
    cols = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"]
    src = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*cols)
    path = _scratch(spark, "lineitem_locale_csv")
    io.write_csv_formatted(src, path, decimals=2, decimal_comma=True, sep=";", thousands=True)
    schema = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
                           T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
                           T.StructField("l_discount", T.DoubleType())])
    return finish(io.read_csv_locale(spark, path, schema))


@register("dim_store_cluster")
def q_dim_store_cluster(spark, sf_dir):
    r = Retail(spark, sf_dir)
    path = _scratch(spark, "store_cluster_csv")
    # the file carries a leading unnamed index column, as the cluster export does
    with_index = r.store_clustering.select(F.monotonically_increasing_id().cast("string").alias(""), "store_code", "store_cluster")
    io.write_csv(with_index.coalesce(1), path)
    return finish(io.read_store_cluster_file(spark, path))


@register("normalize_sales")
def q_normalize_sales(spark, sf_dir):
    return finish(prep.normalize_sales(Retail(spark, sf_dir).history_sales))


@register("clean_attribute_code")
def q_clean_attribute_code(spark, sf_dir):
    p = Retail(spark, sf_dir).dim_product
    return finish(p.select("product_id", "product_att_02",
                           clean_attribute_code("product_att_02").alias("product_att_02_clean")))


@register("exclude_sentinels")
def q_exclude_sentinels(spark, sf_dir):
    p = Retail(spark, sf_dir).dim_product
    p = p.select("product_id", "product_att_01", clean_attribute_code("product_att_02").alias("product_att_02"))
    return finish(clean.exclude_sentinels(p, values=(9, 999)))


@register("negative_qty_modes")
def q_negative_qty_modes(spark, sf_dir):
    return finish(clean.negative_quantity_sums(Retail(spark, sf_dir).history_sales, ["store_code", "product_id"]))


@register("discount_fraction")
def q_discount_fraction(spark, sf_dir):
    hs = Retail(spark, sf_dir).history_sales
    frac, denom = discount_fraction()
    return finish(hs.select("date", "store_code", "product_id", frac.alias("discount_frac"), denom.alias("rev_pre_disc")))


@register("daily_unit_price")
def q_daily_unit_price(spark, sf_dir):
    return finish(prep.daily_unit_price(Retail(spark, sf_dir).history_sales))


def _recent_sales(r: Retail, days: int) -> DataFrame:
    """Sales of the last ``days`` days; the bound is a literal on the raw column."""
    return r.sales_since(r.as_of - dt.timedelta(days=days - 1))


@register("month_floor_lookback")
def q_month_floor_lookback(spark, sf_dir):
    r = Retail(spark, sf_dir)
    hs = clean.month_floor_filter(r.history_sales, as_of_lit(r), months=24)
    return finish(hs.groupBy(F.trunc("date", "month").alias("month_start")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("net_quantity").alias("net_quantity")))


@register("lookback_filter")
def q_lookback_filter(spark, sf_dir):
    r = Retail(spark, sf_dir)
    hs = clean.lookback_filter(_recent_sales(r, 28), 28, as_of=as_of_lit(r))
    return finish(hs.groupBy("date", "store_code").agg(F.sum("net_quantity").alias("net_quantity")))


@register("enrich_sales")
def q_enrich_sales(spark, sf_dir):
    r = Retail(spark, sf_dir)
    e = prep.enrich_sales(r.history_sales, r.dim_product, r.store_clustering)
    return finish(e.select("date", "store_code", "product_id", "net_quantity", "product_att_01", "product_att_02",
                           "product_att_05", "store_cluster"))


@register("calendar_week_join")
def q_calendar_week_join(spark, sf_dir):
    r = Retail(spark, sf_dir)
    e = prep.calendar_week_join(r.history_sales, r.dim_calendar)
    return finish(e.select("date", "store_code", "product_id", "net_quantity", "week_start_date"))


def _prepared(r: Retail) -> DataFrame:
    return prep.prepared_sales(r.history_sales, r.dim_product, r.store_clustering, as_of=as_of_lit(r), months=None)


@register("weekly_quantity")
def q_weekly_quantity(spark, sf_dir):
    return finish(prep.weekly_quantity(_prepared(Retail(spark, sf_dir))))


@register("weekly_price_stats")
def q_weekly_price_stats(spark, sf_dir):
    return finish(prep.weekly_price_stats(_prepared(Retail(spark, sf_dir))))


@register("weighted_discount")
def q_weighted_discount(spark, sf_dir):
    return finish(prep.weighted_discount(_prepared(Retail(spark, sf_dir))))


@register("top_segments")
def q_top_segments(spark, sf_dir):
    return finish(prep.top_segments(_weekly(Retail(spark, sf_dir)), 20))


@register("segment_keys")
def q_segment_keys(spark, sf_dir):
    return finish(prep.segment_keys(_weekly(Retail(spark, sf_dir))))


@register("sales_profile")
def q_sales_profile(spark, sf_dir):
    return finish(clean.sales_profile(Retail(spark, sf_dir).history_sales))


# ------------------------------------------------------------- step 2: features
from ..operators import features as feat  # noqa: E402

_FEATURE_GROUPS = {
    "lag_features": feat.lag_columns,
    "lag_last_year": feat.last_year_column,
    "pct_change_features": feat.pct_change_columns,
    "rolling_features": lambda spec, w: feat.rolling_columns(spec, w, 2),
    "price_lag_features": lambda spec, w: feat.price_lag_columns(spec, w, 2),
    "segment_mean": feat.segment_mean_column,
}

_KEYS_OUT = prep.SEGMENT + prep.SEGMENT_DESCS + ["week_start_date", "total_quantity"]


def _feature_group(key):
    def q(spark, sf_dir):
        w = feat.zero_negative_target(_weekly(Retail(spark, sf_dir)))
        spec = feat.FeatureSpec()
        return finish(w.select(*_KEYS_OUT, *_FEATURE_GROUPS[key](spec, feat.segment_window())))
    q.__name__ = f"q_{key}"
    return q


for _k in _FEATURE_GROUPS:
    register(_k)(_feature_group(_k))


@register("calendar_weekly")
def q_calendar_weekly(spark, sf_dir):
    return finish(feat.calendar_weekly(Retail(spark, sf_dir).dim_calendar))


def _features(r: Retail) -> DataFrame:
    return feat.demand_features(_weekly(r), r.dim_calendar, profile=PROD_ALL_HISTORY)


@register("demand_features")
def q_demand_features(spark, sf_dir):
    return finish(_features(Retail(spark, sf_dir)))


# ------------------------------------------------ step 3: universe, weights, safety
from ..operators import breakdown as bd  # noqa: E402
from ..operators import safety, universe, weights  # noqa: E402
from ..sources.fixtures import naive_weekly_forecast  # noqa: E402


def _repl_sales(r: Retail) -> DataFrame:
    """Cleaned replenishment sales, materialised once per call: every replenishment key
    reads it from several branches (day sums, shares, the last sales date)."""
    from .jobs import cut
    return _memo(r, "repl_sales", lambda: cut(
        universe.replenishment_sales(r.history_sales, r.dim_product, as_of_lit(r), profile="prod"), "repl-sales"))


def _all_sales(r: Retail) -> DataFrame:
    """Cleaned replenishment sales over the whole history."""
    from .jobs import cut
    return _memo(r, "all_sales", lambda: cut(universe.replenishment_sales(
        r.history_sales, r.dim_product, as_of_lit(r), PROD.with_(sales_lookback_days=None)), "all-sales"))


def _stock_agg(r: Retail) -> DataFrame:
    from .jobs import cut
    return _memo(r, "stock_agg", lambda: cut(universe.stock_by_day(r.store_stock, as_of_lit(r)), "stock"))


def _product_pairs(r: Retail) -> DataFrame:
    return universe.store_product_pairs(_stock_agg(r), r.dim_product)


def _weekly_cut(r: Retail) -> DataFrame:
    """The weekly aggregate as a stage output (read by the forecast stand-in twice: rows
    and the last week)."""
    from .jobs import cut
    return _memo(r, "weekly", lambda: cut(_weekly(r), "weekly"))


def _weekly_forecast(r: Retail) -> DataFrame:
    return naive_weekly_forecast(_weekly_cut(r))


def _ratio(r: Retail) -> DataFrame:
    return bd.store_ratio(r.history_sales, r.dim_product, r.store_clustering, as_of=as_of_lit(r), profile="prod")


def _breakdown(r: Retail) -> DataFrame:
    return bd.breakdown_to_store(_weekly_forecast(r), _ratio(r))


def _daily_pred(r: Retail) -> DataFrame:
    """Daily store x style forecast from the deterministic weekly stand-in, materialised
    once (it is the daily job's input, read by several consumers)."""
    from .jobs import cut
    return _memo(r, "daily_pred", lambda: cut(bd.weekly_to_daily(_breakdown(r))))


def _weight_map(r: Retail) -> DataFrame:
    return weights.variant_weight_map(_repl_sales(r), _stock_agg(r), _product_pairs(r))


@register("stock_product_id")
def q_stock_product_id(spark, sf_dir):
    r = Retail(spark, sf_dir)
    attrs = r.dim_product.select("product_id", F.col("product_att_03").alias("color_code"),
                                 F.col("product_att_04").alias("size"))
    st = r.store_stock.drop("color_code", "size").join(attrs, "product_id", "left")
    out = clean.stock_product_id(st, out="sku_id")
    return finish(out.select("stok_tarihi", "magaza", "stok_kodu", "color_code", "size", "product_id", "sku_id",
                             "toplam_miktar"))


@register("active_products")
def q_active_products(spark, sf_dir):
    p = clean.active_products(Retail(spark, sf_dir).dim_product)
    return finish(p.select("product_id", "product_code", "is_blocked"))


@register("style_to_variants")
def q_style_to_variants(spark, sf_dir):
    """J4 with blocked variants too (``store_product_pairs`` has the active ones)."""
    r = Retail(spark, sf_dir)
    return finish(universe.style_to_variants(universe.store_sku_pairs(_stock_agg(r)), r.dim_product, only_active=False))


@register("store_product_pairs")
def q_store_product_pairs(spark, sf_dir):
    return finish(_product_pairs(Retail(spark, sf_dir)))


@register("store_sku_pairs")
def q_store_sku_pairs(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return finish(universe.store_sku_pairs(_stock_agg(r), _daily_pred(r)))


@register("stock_by_day")
def q_stock_by_day(spark, sf_dir):
    return finish(_stock_agg(Retail(spark, sf_dir)))


@register("open_order_qty")
def q_open_order_qty(spark, sf_dir):
    return finish(clean.open_order_qty(Retail(spark, sf_dir).stock_movement))


@register("extract_open_orders")
def q_extract_open_orders(spark, sf_dir):
    path = _scratch(spark, "open_order_parquet")
    io.write_parquet(clean.extract_open_orders(Retail(spark, sf_dir).stock_movement), path)
    return finish(spark.read.parquet(path))


@register("seasonal_months")
def q_seasonal_months(spark, sf_dir):
    s = _all_sales(Retail(spark, sf_dir))
    s = clean.seasonal_months(s, s.agg(F.max("date")).scalar(), window=1)
    return finish(s.groupBy(F.year("date").alias("year"), F.month("date").alias("month"))
                   .agg(F.count(F.lit(1)).alias("row_count"), F.sum("net_quantity").alias("net_quantity")))


@register("demand_stats")
def q_demand_stats(spark, sf_dir):
    return finish(safety.demand_stats(safety.daily_demand(_all_sales(Retail(spark, sf_dir)))))


@register("weighted_demand_stats_all_years")
def q_weighted_demand_stats_all_years(spark, sf_dir):
    return finish(safety.weighted_demand_stats(safety.daily_demand(_all_sales(Retail(spark, sf_dir)))))


@register("weighted_demand_stats")
def q_weighted_demand_stats(spark, sf_dir):
    return finish(safety.weighted_demand_stats(safety.daily_demand(_repl_sales(Retail(spark, sf_dir)))))


@register("safety_stock")
def q_safety_stock(spark, sf_dir):
    return finish(safety.seasonal_safety_stock(_all_sales(Retail(spark, sf_dir)), use_weighted_calculation=False))


def _safety_weighted(r: Retail) -> DataFrame:
    return safety.seasonal_safety_stock(_repl_sales(r), use_weighted_calculation=True,
                                        weight_strategy="exponential_decay", weight_decay_factor=0.95,
                                        recent_days_weight=0.6)


@register("safety_stock_weighted")
def q_safety_stock_weighted(spark, sf_dir):
    return finish(_safety_weighted(Retail(spark, sf_dir)))


@register("compare_weighting_strategies")
def q_compare_weighting_strategies(spark, sf_dir):
    return finish(safety.compare_weighting_strategies(_all_sales(Retail(spark, sf_dir))))


@register("pairs_semi_join")
def q_pairs_semi_join(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return finish(universe.pairs_semi_join(_repl_sales(r), _product_pairs(r)))


@register("variant_sales_share")
def q_variant_sales_share(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return finish(weights.variant_sales_share(_repl_sales(r), _product_pairs(r)))


@register("variant_weight_map")
def q_variant_weight_map(spark, sf_dir):
    return finish(_weight_map(Retail(spark, sf_dir)))


# ------------------------------------------------------ step 4: breakdown, daily
@register("store_ratio")
def q_store_ratio(spark, sf_dir):
    return finish(_ratio(Retail(spark, sf_dir)))


@register("breakdown_to_store")
def q_breakdown_to_store(spark, sf_dir):
    return finish(_breakdown(Retail(spark, sf_dir)))


@register("week_length")
def q_week_length(spark, sf_dir):
    return finish(bd.week_length(_breakdown(Retail(spark, sf_dir))))


@register("weekly_to_daily")
def q_weekly_to_daily(spark, sf_dir):
    return finish(_daily_pred(Retail(spark, sf_dir)))


@register("prediction_14d_by_product")
def q_prediction_14d_by_product(spark, sf_dir):
    r = Retail(spark, sf_dir)
    s = _repl_sales(r)
    return finish(weights.prediction_14d_by_product(_daily_pred(r), _weight_map(r), s.agg(F.max("date")).scalar()))


# --------------------------------------------------- step 5: need, allocation
from ..operators import allocate, need  # noqa: E402


def _orders(r: Retail) -> DataFrame:
    return clean.open_order_qty(r.stock_movement)


def _daily_job(r: Retail, profile: str = "prod"):
    from .jobs import daily_replenishment_job
    return _memo(r, f"daily_job_{profile}", lambda: daily_replenishment_job(
        r.history_sales, r.dim_product, r.store_stock, r.warehouse_stock, r.stock_movement, _daily_pred(r),
        as_of_lit(r), profile=profile))


def _base(r: Retail) -> DataFrame:
    return _daily_job(r).base


def _need_prod(r: Retail) -> DataFrame:
    return _daily_job(r).results


@register("sales_7_14_28")
def q_sales_7_14_28(spark, sf_dir):
    return finish(need.sales_7_14_28(_repl_sales(Retail(spark, sf_dir))))


@register("replenishment_base")
def q_replenishment_base(spark, sf_dir):
    return finish(_base(Retail(spark, sf_dir)))


@register("blend_weight")
def q_blend_weight(spark, sf_dir):
    b = _base(Retail(spark, sf_dir))
    return finish(b.select("store_code", "product_id", need.momentum_column().alias("momentum"),
                           need.blend_weight(b, "prod").alias("w_model")))


@register("replenishment_need_prod")
def q_replenishment_need_prod(spark, sf_dir):
    return finish(_need_prod(Retail(spark, sf_dir)))


@register("replenishment_need_local")
def q_replenishment_need_local(spark, sf_dir):
    return finish(_daily_job(Retail(spark, sf_dir), "local").results)


@register("replenishment_need_fused")
def q_replenishment_need_fused(spark, sf_dir):
    return finish(_daily_job(Retail(spark, sf_dir), "fused").results)


def _dense_distribution(r: Retail) -> DataFrame:
    return allocate.distribute_warehouse_stock(r.dense_need, r.dense_stock)


@register("warehouse_distribution")
def q_warehouse_distribution(spark, sf_dir):
    return finish(_dense_distribution(Retail(spark, sf_dir)))


@register("warehouse_stockouts")
def q_warehouse_stockouts(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return finish(allocate.warehouse_stockouts(r.dense_need, r.dense_stock))


@register("fulfilment_summary")
def q_fulfilment_summary(spark, sf_dir):
    return finish(allocate.fulfilment_summary(_dense_distribution(Retail(spark, sf_dir))))


@register("fulfilment_by_warehouse")
def q_fulfilment_by_warehouse(spark, sf_dir):
    return finish(allocate.fulfilment_by_warehouse(_dense_distribution(Retail(spark, sf_dir))))


@register("fulfilment_by_warehouse_sku")
def q_fulfilment_by_warehouse_sku(spark, sf_dir):
    return finish(allocate.fulfilment_by_warehouse(_sku_distribution(Retail(spark, sf_dir))))


@register("publish_replenishment")
def q_publish_replenishment(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return finish(need.publish_rows(_need_prod(r), as_of_lit(r)))


def _sku_distribution(r: Retail) -> DataFrame:
    return _daily_job(r).distribution


@register("publish_distribution")
def q_publish_distribution(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return finish(need.publish_rows(_sku_distribution(r), as_of_lit(r), only_positive=False))


from ..operators import audit  # noqa: E402


@register("audit_zero_need")
def q_audit_zero_need(spark, sf_dir):
    return finish(audit.zero_need(_need_prod(Retail(spark, sf_dir))))


@register("audit_14d_point")
def q_audit_14d_point(spark, sf_dir):
    """14-day quantity per (product, store): the point check for every pair at once."""
    return finish(audit.quantity_by(_recent_sales(Retail(spark, sf_dir), 14), ["product_id", "store_code"], "net_quantity"))


@register("audit_14d_daily")
def q_audit_14d_daily(spark, sf_dir):
    return finish(audit.quantity_by(_recent_sales(Retail(spark, sf_dir), 14), ["product_id", "store_code", "date"], "net_quantity_14"))


@register("audit_first_sale")
def q_audit_first_sale(spark, sf_dir):
    return finish(audit.first_sale(Retail(spark, sf_dir).history_sales))


@register("audit_daily_sample")
def q_audit_daily_sample(spark, sf_dir):
    r = Retail(spark, sf_dir)
    hs = clean.month_floor_filter(r.history_sales, as_of_lit(r), months=24)
    return finish(audit.daily_sample(prep.daily_unit_price(hs), 10))


@register("audit_distribution_product")
def q_audit_distribution_product(spark, sf_dir):
    return finish(audit.distribution_of(_dense_distribution(Retail(spark, sf_dir)), product="Brand#3", warehouse="900101"))


@register("audit_distribution_after")
def q_audit_distribution_after(spark, sf_dir):
    return finish(audit.distribution_after(_dense_distribution(Retail(spark, sf_dir)), product="Brand#3", not_warehouse="900101"))


# ------------------------------------------------------------- step 6: forecast
from ..operators import forecast as fc  # noqa: E402


def _frame(r: Retail) -> DataFrame:
    return fc.model_frame(_features(r))


@register("future_grid")
def q_future_grid(spark, sf_dir):
    return finish(fc.future_grid(_frame(Retail(spark, sf_dir)), 12))


@register("last_observed_features")
def q_last_observed_features(spark, sf_dir):
    f = _frame(Retail(spark, sf_dir))
    return finish(fc.last_observed_features(f, fc.frozen_columns(fc.model_feature_columns(f))))


@register("future_features")
def q_future_features(spark, sf_dir):
    return finish(fc.future_features(_frame(Retail(spark, sf_dir)), 12))


@register("forecast_12w")
def q_forecast_12w(spark, sf_dir):
    """Rows-only check: the learner is Spark ML's, its values differ from any other library's."""
    return finish(fc.forecast_12w(_features(Retail(spark, sf_dir)), PROD_ALL_HISTORY))


def _valid(df: DataFrame, value: str) -> DataFrame:
    """What is deterministic of a model's output: its rows, and that each value is a number >= 0."""
    ok = F.coalesce((F.col(value) >= 0) & ~F.isnan(value), F.lit(False))
    return df.withColumn("valid", ok).drop(value)


@register("forecast_12w_rows")
def q_forecast_12w_rows(spark, sf_dir):
    return finish(_valid(fc.forecast_12w(_features(Retail(spark, sf_dir)), PROD_ALL_HISTORY), "predicted_quantity"))


@register("weekly_forecast_job")
def q_weekly_forecast_job(spark, sf_dir):
    """E1 with the model, through the break-down to store, style and day."""
    from .jobs import weekly_forecast_job
    r = Retail(spark, sf_dir)
    job = weekly_forecast_job(r.history_sales, r.dim_product, r.store_clustering, r.dim_calendar, as_of_lit(r),
                              PROD_ALL_HISTORY)
    return finish(_valid(job.daily, "prediction_store_daily"))


@register("audit_forecast_conservation")
def q_audit_forecast_conservation(spark, sf_dir):
    """E1 with the model: its quantities arrive whole in stores and days; the quantities are the learner's."""
    from .jobs import weekly_forecast_job
    r = Retail(spark, sf_dir)
    job = weekly_forecast_job(r.history_sales, r.dim_product, r.store_clustering, r.dim_calendar, as_of_lit(r), PROD_ALL_HISTORY)
    return finish(audit.forecast_conservation(job.forecast, job.breakdown, job.daily).drop("predicted_quantity"))


@register("weekly_segment_sales_local")
def q_weekly_segment_sales_local(spark, sf_dir):
    return finish(_weekly(Retail(spark, sf_dir), LOCAL))


@register("segment_mean_expanding")
def q_segment_mean_expanding(spark, sf_dir):
    w = feat.zero_negative_target(_weekly(Retail(spark, sf_dir)))
    return finish(w.select(*_KEYS_OUT, *feat.segment_mean_column(feat.FeatureSpec(), feat.segment_window(), expanding=True)))


@register("dense_weeks")
def q_dense_weeks(spark, sf_dir):
    return finish(feat.dense_weeks(_weekly(Retail(spark, sf_dir))).select(*_KEYS_OUT))


# -------------------------------------------------- step 7: extracts and sinks
@register("extract_store_stock")
def q_extract_store_stock(spark, sf_dir):
    path = _scratch(spark, "store_stock_parquet")
    io.write_parquet(Retail(spark, sf_dir).store_stock, path)
    return finish(spark.read.parquet(path))


@register("extract_warehouse_stock")
def q_extract_warehouse_stock(spark, sf_dir):
    path = _scratch(spark, "warehouse_stock_parquet")
    io.write_parquet(Retail(spark, sf_dir).warehouse_stock, path)
    return finish(spark.read.parquet(path))


@register("edge_rename")
def q_edge_rename(spark, sf_dir):
    """The allocation under its English names, as written at the edge."""
    return finish(io.renamed(_dense_distribution(Retail(spark, sf_dir)), io.EDGE_NAMES))


@register("extract_sales_12m")
def q_extract_sales_12m(spark, sf_dir):
    """12 months of sales (month floor) written as parquet partitioned by month, read back."""
    r = Retail(spark, sf_dir)
    hs = clean.month_floor_filter(r.history_sales, as_of_lit(r), months=12)
    path = _scratch(spark, "sales_12m_parquet")
    io.write_parquet(hs.withColumn("month", F.date_format("date", "yyyy-MM")), path, partition_by=["month"])
    back = spark.read.parquet(path)
    return finish(back.select("date", "store_code", "product_id", "stok_kodu", "net_quantity", "discount_amount",
                              "net_amount_wovat", "unit_price", F.col("month").cast("string").alias("month")))


@register("sink_parquet_roundtrip")
def q_sink_parquet_roundtrip(spark, sf_dir):
    """The weekly aggregate written as snappy parquet and read back."""
    path = _scratch(spark, "weekly_parquet")
    io.write_parquet(_weekly(Retail(spark, sf_dir)), path)
    return finish(spark.read.parquet(path))


@register("sink_csv_formatted")
def q_sink_csv_formatted(spark, sf_dir):
    """Store x style forecast as ';'-separated text, 6 decimals, decimal comma; read back."""
    path = _scratch(spark, "breakdown_csv")
    src = _breakdown(Retail(spark, sf_dir)).select("week_start_date", "store_code", "stok_kodu",
                                                    "store_predicted_quantity", "store_ratio")
    io.write_csv_formatted(src, path, decimals=6, decimal_comma=True, sep=";")
    schema = T.StructType([T.StructField("week_start_date", T.DateType()), T.StructField("store_code", T.StringType()),
                           T.StructField("stok_kodu", T.StringType()),
                           T.StructField("store_predicted_quantity", T.StringType()),
                           T.StructField("store_ratio", T.StringType())])
    back = io.read_csv(spark, path, schema, sep=";")
    num = lambda c: F.translate(F.col(c), ",", ".").cast("double").alias(c)
    return finish(back.select("week_start_date", "store_code", "stok_kodu", num("store_predicted_quantity"), num("store_ratio")))


@register("land_raw_text")
def q_land_raw_text(spark, sf_dir):
    """A CSV export with awkward headers landed as an all-text table with clean names."""
    path = _scratch(spark, "raw_landing_csv")
    hs = Retail(spark, sf_dir).history_sales
    awkward = hs.select(F.col("date").alias("Satış Tarihi"), F.col("store_code").alias("Mağaza Kodu"),
                        F.col("product_id").alias("1 Ürün-ID"), F.col("net_quantity").alias("Net Adet (%)"),
                        F.col("stok_kodu").alias("net adet (%)tutar"))
    io.write_csv(awkward, path)
    return io.land_raw_text(spark, path)


# ------------------------------------------------------- step 8: landing, months
from ..operators import incremental, sketches  # noqa: E402
from ..sources import landing  # noqa: E402


@register("land_raw_files")
def q_land_raw_files(spark, sf_dir):
    """S9 for a folder: two column orders, two separators, and one layout without a column."""
    path = _scratch(spark, "raw_landing_files")
    hs = Retail(spark, sf_dir).history_sales
    names = {"date": "Satış Tarihi", "store_code": "Mağaza Kodu", "product_id": "1 Ürün-ID", "net_quantity": "Net Adet (%)"}
    layouts = [("a", ["date", "store_code", "product_id", "net_quantity"], ",", F.col("store_code") < "1500"),
               ("b", ["net_quantity", "product_id", "date", "store_code"], ";", F.col("store_code").between("1500", "2599")),
               ("c", ["product_id", "store_code", "date"], "\t", F.col("store_code") > "2599")]
    for folder, columns, sep, rows in layouts:
        some = hs.filter(rows).select(*[F.col(c).alias(names[c]) for c in columns])
        some.write.option("header", True).option("sep", sep).csv(f"{path}/{folder}")
    return landing.land_raw_files(spark, path)


@register("src_csv_rejects")
def q_src_csv_rejects(spark, sf_dir):
    """Line items as text with damaged records; accepted rows and rejects by reason add up."""
    key = F.col("l_orderkey")
    amount = F.when(key % 97 == 0, F.lit("n/a")).otherwise(F.translate(F.format_number("l_extendedprice", 2), ",.", ".,"))
    day = F.when(key % 89 == 1, F.lit("1994-13-31")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    line = F.concat_ws(";", key.cast("string"), F.col("l_linenumber").cast("string"), amount, day)
    line = F.when(key % 101 == 2, F.concat(line, F.lit(";x"))).when(key % 103 == 3, F.concat_ws(";", key.cast("string"), F.col("l_linenumber").cast("string"))).otherwise(line)
    src = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(line.alias("value"))
    path = _scratch(spark, "damaged_csv")
    src.write.text(path)
    schema = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
                           T.StructField("l_extendedprice", T.DoubleType()), T.StructField("l_shipdate", T.DateType())])
    checked = landing.land_checked_csv(spark, path, schema, _scratch(spark, "checked_csv"), header=False, sep=";", locale="tr-TR")
    amounts = checked.rows.agg(F.sum("l_extendedprice")).scalar()
    out = landing.reject_summary(checked)
    return finish(out.withColumn("amount", F.when(F.col("outcome") == "accepted", amounts)))


@register("extract_sales_incremental")
def q_extract_sales_incremental(spark, sf_dir):
    """S5 + P12: the 12-month extract brought up to date month by month (a year ago, a month ago, now)."""
    r = Retail(spark, sf_dir)
    sales = r.history_sales
    extract = landing.MonthlyExtract(spark, _scratch(spark, "sales_months"), sales.schema)
    for days in (370, 31, 0):
        extract.refresh(sales, r.as_of - dt.timedelta(days=days))
    return finish(extract.read())


@register("fulfilment_levels")
def q_fulfilment_levels(spark, sf_dir):
    return finish(allocate.fulfilment_levels(_dense_distribution(Retail(spark, sf_dir))))


@register("store_share")
def q_store_share(spark, sf_dir):
    return finish(feat.store_share(_weekly(Retail(spark, sf_dir))).select(*_KEYS_OUT, "store_product_share"))


@register("yoy_growth")
def q_yoy_growth(spark, sf_dir):
    w = feat.zero_negative_target(_weekly(Retail(spark, sf_dir)))
    return finish(feat.yoy_growth(w).select(*_KEYS_OUT, "quantity_back", "quantity_year_before", "yoy_growth"))


@register("sketch_ranges")
def q_sketch_ranges(spark, sf_dir):
    """G2/G9 from merged monthly sketches: exact figures of each three months and whether the
    estimates are within their bounds; the estimates themselves belong to the sketch library."""
    out = sketches.checked_ranges(Retail(spark, sf_dir).history_sales)
    return finish(out.drop("estimate", "estimate_store_code", "estimate_product_id"))


@register("demand_features_incremental")
def q_demand_features_incremental(spark, sf_dir):
    """H2 for the last week, from the state that the two weekly runs before it handed on."""
    r = Retail(spark, sf_dir)
    last = r.as_of - dt.timedelta(days=r.as_of.weekday())
    weeks = [last - dt.timedelta(weeks=k) for k in (2, 1, 0)]
    before = r.history_sales.filter(F.col("date") < F.lit(weeks[0]))
    aggregate = lambda sales: prep.weekly_segment_sales(sales, r.dim_product, r.store_clustering, calendar=r.dim_calendar,
                                                        profile=PROD_ALL_HISTORY, as_of=as_of_lit(r))
    state, out = incremental.initial_state(aggregate(before)), None
    for week in weeks:
        new = r.sales_since(week).filter(F.col("date") < F.lit(week + dt.timedelta(weeks=1)))
        out, state = incremental.next_weeks(state, aggregate(new), r.dim_calendar, PROD_ALL_HISTORY)
    return finish(out)
