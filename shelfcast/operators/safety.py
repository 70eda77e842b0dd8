"""Seasonal safety stock.

Daily demand is a partial+final aggregate on (store, product, date); the per-pair
statistics are a second aggregate on (store, product), whose exchange carries one row per
(store, product, day), a bounded set (days with sales in a +-1 month window); over a table bucketed by
(store, product) neither needs an exchange.

Weighted statistics are moments (count, weight, mean, sum of weighted squared deviations from that
mean).  Moments merge: the mean moves by the weighted difference of the two means, and the squared deviations grow
by that difference squared.  Nothing is ever subtracted from a large sum of squares, so a deviation of 1
around a mean of 1e9 survives, in one pass.  Several weightings of the same days are columns
of one aggregate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import bround_decimal, number, seasonal_month_filter, z_value

KEY = ["store_code", "product_id"]
STRATEGIES = ("exponential_decay", "linear_decay", "recent_heavy")


def daily_demand(sales: DataFrame, as_of: Column | None = None, month_window: int = 1,
                 date_col: str = "date", qty: str = "net_quantity") -> DataFrame:
    """P14 + G1: seasonal months (+-window around as_of's month, all years), summed per day.
    Days without sales are absent, as in the pipeline."""
    today = as_of if as_of is not None else sales.agg(F.max(date_col)).scalar()
    s = sales.filter(seasonal_month_filter(date_col, today, month_window))
    return (s.groupBy(*KEY, F.col(date_col).alias("date"))
             .agg(F.sum(F.coalesce(number(qty), F.lit(0.0))).alias("net_quantity"))
             .withColumn("days_from_today", F.datediff(today, F.col("date"))))


def demand_stats(daily: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of daily demand; one day -> std 0."""
    return daily.groupBy(*KEY).agg(F.avg("net_quantity").alias("daily_avg"),
                                   F.coalesce(F.stddev_samp("net_quantity"), F.lit(0.0)).alias("daily_std"))


def day_weight(daily: DataFrame, strategy: str = "exponential_decay", decay: float = 0.95,
               recent_days_weight: float = 0.7, recent_days: int = 7) -> Column:
    d = F.col("days_from_today")
    if strategy == "linear_decay":
        max_days = daily.agg(F.max("days_from_today")).scalar()
        return F.greatest(F.lit(1.0) - F.try_divide(d.cast("double"), max_days.cast("double")), F.lit(0.1))
    if strategy == "recent_heavy":
        return F.when(d <= recent_days, F.lit(recent_days_weight)).otherwise(F.lit(1.0 - recent_days_weight))
    return F.pow(F.lit(decay), d.cast("double"))


def merge_moments(a: Column, b: Column) -> Column:
    """The moments of two sets of days together."""
    w = a["w"] + b["w"]
    d = b["mean"] - a["mean"]
    share = F.coalesce(F.try_divide(b["w"], w), F.lit(0.0))
    return F.struct((a["n"] + b["n"]).alias("n"), w.alias("w"), (a["mean"] + d * share).alias("mean"),
                    (a["m2"] + b["m2"] + d * d * a["w"] * share).alias("m2"))


def no_moments() -> Column:
    return F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("w"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))


def demand_moments(daily: DataFrame, weights: dict[str, Column], keys: list[str] | None = None) -> DataFrame:
    """Per key and weighting the moments of daily demand, in one aggregate.

    A key's days are bounded by the calendar: one row a day of the seasonal months.  With more keys
    (say, the year) the parts can be kept and merged later (``merged_moments``)."""
    keys = keys or KEY
    days = daily.select(*keys, F.struct(F.col("net_quantity").cast("double").alias("x"), *[w.cast("double").alias(name) for name, w in weights.items()]).alias("d"))
    grouped = days.groupBy(*keys).agg(F.collect_list("d").alias("days"))

    def of(name: str) -> Column:
        def add(acc, day):
            one = F.struct(F.lit(1).cast("long").alias("n"), day[name].alias("w"), day["x"].alias("mean"), F.lit(0.0).alias("m2"))
            return merge_moments(acc, one)
        return F.aggregate("days", no_moments(), add)

    return grouped.select(*keys, *[of(name).alias(name) for name in weights])


def merged_moments(parts: DataFrame, names: list[str], keys: list[str] | None = None) -> DataFrame:
    """Moments of finer keys merged per key; a key's parts are bounded like its days."""
    keys = keys or KEY
    lists = parts.groupBy(*keys).agg(*[F.collect_list(c).alias(c) for c in names])
    return lists.select(*keys, *[F.aggregate(c, no_moments(), merge_moments).alias(c) for c in names])


def deviation(moments: Column, sample: bool = False) -> Column:
    """Population or sample deviation; a single day has none."""
    per = F.try_divide(moments["m2"], (moments["n"] - 1).cast("double") if sample else moments["w"])
    return F.when(moments["n"] > 1, F.sqrt(F.greatest(per, F.lit(0.0)))).otherwise(F.lit(0.0))


def weighted_demand_stats(daily: DataFrame, strategy: str = "exponential_decay", decay: float = 0.95,
                          recent_days_weight: float = 0.7) -> DataFrame:
    """Weighted mean and weighted population std per (store, product); one day -> 0.

    A global normalisation of the weights cancels inside every group and is skipped."""
    m = demand_moments(daily, {"m": day_weight(daily, strategy, decay, recent_days_weight)})
    return m.select(*KEY, F.col("m.mean").alias("daily_avg"), deviation(F.col("m")).alias("daily_std"))


def seasonal_safety_stock(sales: DataFrame, as_of: Column | None = None, lead_time_days: float = 2,
                          service_level: float = 0.9, month_window: int = 1, use_weighted_calculation: bool = True,
                          weight_strategy: str = "exponential_decay", weight_decay_factor: float = 0.95,
                          recent_days_weight: float = 0.7) -> DataFrame:
    """Safety stock = z(service level) * daily std * sqrt(lead time), half-even to 2 places."""
    daily = daily_demand(sales, as_of, month_window)
    if use_weighted_calculation:
        strategy = weight_strategy if weight_strategy in STRATEGIES else "exponential_decay"
        stats = weighted_demand_stats(daily, strategy, weight_decay_factor, recent_days_weight)
    else:
        stats = demand_stats(daily)
    return stats.select("*", _stock_of(F.col("daily_std"), lead_time_days, service_level))


def _stock_of(daily_std: Column, lead_time_days: float, service_level: float) -> Column:
    return bround_decimal(F.lit(z_value(service_level) * math.sqrt(lead_time_days)) * daily_std, 2).alias("safety_stock")


def compare_weighting_strategies(sales: DataFrame, as_of: Column | None = None, **kw) -> DataFrame:
    """The four strategies side by side, one ``strategy`` column; the day sums are aggregated
    once, with the strategies' weights as columns."""
    runs = {  # fixed values: the strategies' names and parameters
        "no_weight": dict(use_weighted_calculation=False),
        "exponential_decay": dict(use_weighted_calculation=True, weight_strategy="exponential_decay", weight_decay_factor=0.95),
        "linear_decay": dict(use_weighted_calculation=True, weight_strategy="linear_decay"),
        "recent_heavy": dict(use_weighted_calculation=True, weight_strategy="recent_heavy", recent_days_weight=0.6),
    }
    daily = daily_demand(sales, as_of, kw.get("month_window", 1))
    weights, sampled = {}, set()
    for name, params in runs.items():
        p = {**kw, **params}
        if p.get("use_weighted_calculation"):
            weights[name] = day_weight(daily, p["weight_strategy"], p.get("weight_decay_factor", 0.95), p.get("recent_days_weight", 0.7))
        else:
            weights[name] = F.lit(1.0)
            sampled.add(name)
    stats = demand_moments(daily, weights)
    rows = F.array(*[F.struct(F.lit(name).alias("strategy"), F.col(f"{name}.mean").alias("daily_avg"),
                              deviation(F.col(name), sample=name in sampled).alias("daily_std")) for name in weights])
    out = stats.select(*KEY, F.inline(rows))
    return out.select(*KEY, "daily_avg", "daily_std", _stock_of(F.col("daily_std"), kw.get("lead_time_days", 2), kw.get("service_level", 0.9)), "strategy")
