"""Cluster forecast -> store x style (H4) and week -> day (H5).

``store_ratio`` aggregates recent sales once per (cluster, attributes, store, style)
and divides by the segment total, itself a partial aggregate joined back on the
segment key (one row per segment), so no task ever holds a whole hot segment.
``weekly_to_daily`` expands rows with ``sequence`` + ``posexplode`` (a generator
inside the same stage) and sums per (store, style, day).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import as_date, clean_attribute_code, month_floor_lookback, not_sentinel, number, require_columns
from ..profiles import Profile, get_profile

# Column names of the break-down tables.
RATIO_KEYS = ["store_cluster", "product_att_01", "product_att_02", "product_att_05", "store_code", "stok_kodu"]
MERGE_KEYS = ["store_cluster", "product_att_01", "product_att_02", "product_att_05"]


def store_ratio(sales: DataFrame, product: DataFrame, clusters: DataFrame, as_of: Column | None = None,
                profile: "Profile | str | None" = None) -> DataFrame:
    """Share of each (store, style) in its (cluster, attributes) over the recent weeks."""
    pf = get_profile(profile)
    require_columns(sales, ["date", "store_code", "stok_kodu", "net_quantity"], "history_sales")
    s = sales.select(as_date("date").alias("date"), F.col("store_code").cast("string").alias("store_code"),
                     F.col("stok_kodu").cast("string").alias("stok_kodu"),
                     F.coalesce(number("net_quantity"), F.lit(0.0)).alias("net_quantity"))
    if pf.breakdown_month_floor:
        anchor = as_of if as_of is not None else F.current_date()
        s = s.filter((F.col("date") >= month_floor_lookback(anchor, weeks=pf.breakdown_weeks)) & (F.col("net_quantity") >= 0))
    else:
        last = s.agg(F.max("date")).scalar()
        s = s.filter(F.col("date") >= F.date_sub(last, 7 * pf.breakdown_weeks))
    if pf.breakdown_clip_negative:
        s = s.withColumn("net_quantity", F.greatest(F.col("net_quantity"), F.lit(0.0)))
    s = s.join(clusters.select("store_code", "store_cluster"), "store_code", "left")
    # one row per style (its attributes are a function of the style), so the join
    # does not multiply a sale by the style's variant count
    styles = product.select(F.col("product_code").cast("string").alias("product_code"),
                            "product_att_01", "product_att_02", "product_att_05").distinct()
    s = s.join(styles, s.stok_kodu == styles.product_code, "left").drop("product_code")
    s = s.withColumn("product_att_02", clean_attribute_code("product_att_02"))
    s = s.filter(not_sentinel("product_att_01", [9]) & not_sentinel("product_att_02", [9]))
    s = s.withColumn("product_att_01", F.col("product_att_01").try_cast("double")) \
         .withColumn("product_att_05", F.col("product_att_05").try_cast("double")) \
         .withColumn("store_cluster", F.col("store_cluster").try_cast("double"))
    g = s.dropna(subset=RATIO_KEYS).groupBy(*RATIO_KEYS).agg(F.sum("net_quantity").alias("net_quantity"))
    # segment totals by a partial aggregate joined back, not a window: a window would put
    # every store x style row of a hot segment into one task; the totals table has one row
    # per segment and is joined by key (broadcast by AQE when small)
    totals = g.groupBy(*MERGE_KEYS).agg(F.sum("net_quantity").alias("cluster_total"))
    g = g.join(totals, MERGE_KEYS, "inner")
    return g.withColumn("store_ratio", F.when(F.col("cluster_total") > 0, F.col("net_quantity") / F.col("cluster_total"))
                        .otherwise(F.lit(0.0)))


def breakdown_to_store(forecast: DataFrame, ratio: DataFrame) -> DataFrame:
    """H4: segment forecast x store share; segments without recent sales drop out."""
    require_columns(forecast, MERGE_KEYS + ["week_start_date", "predicted_quantity"], "forecast")
    f = forecast.select(*[F.col(k).try_cast("double").alias(k) for k in MERGE_KEYS],
                        as_date("week_start_date").alias("week_start_date"),
                        number("predicted_quantity").alias("predicted_quantity")).dropna(subset=MERGE_KEYS)
    r = ratio.select(*MERGE_KEYS, "store_code", "stok_kodu", "store_ratio").dropna(subset=MERGE_KEYS)
    out = f.join(r, MERGE_KEYS, "inner")
    return out.select("week_start_date", "store_cluster", "store_code", "product_att_01", "product_att_02",
                      "product_att_05", "stok_kodu",
                      (F.col("predicted_quantity") * F.col("store_ratio")).alias("store_predicted_quantity"),
                      "predicted_quantity", "store_ratio")


def week_length(weekly_pred: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """Days until the style's next forecast week (7 after the last; <= 0 -> 7)."""
    tie = tie_break if tie_break is not None else [c for c in MERGE_KEYS if c in weekly_pred.columns]
    w = weekly_pred.select(
        F.trim(F.col("store_code").cast("string")).alias("store_code"),
        F.trim(F.col("stok_kodu").cast("string")).alias("stok_kodu"),
        as_date("week_start_date").alias("week_start_date"),
        F.coalesce(number("store_predicted_quantity"), F.lit(0.0)).alias("store_predicted_quantity"),
        *[F.col(c) for c in tie])
    win = Window.partitionBy("store_code", "stok_kodu").orderBy("week_start_date", *tie)
    nxt = F.coalesce(F.lead("week_start_date").over(win), F.date_add("week_start_date", 7))
    w = w.withColumn("next_week_start", nxt)
    n = F.datediff("next_week_start", "week_start_date")
    return w.withColumn("n_days", F.when(n <= 0, F.lit(7)).otherwise(n))


def weekly_to_daily(weekly_pred: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """H5: each week's quantity spread evenly over its n_days, summed per (store, style, day)."""
    w = week_length(weekly_pred, tie_break)
    days = w.select("store_code", "stok_kodu", "week_start_date", "n_days", "store_predicted_quantity",
                    F.posexplode(F.sequence(F.lit(0), F.col("n_days") - 1)).alias("offset", "_v"))
    days = days.select("store_code", "stok_kodu", F.date_add("week_start_date", F.col("offset")).alias("date"),
                       (F.col("store_predicted_quantity") / F.col("n_days")).alias("q"))
    return days.groupBy("store_code", "stok_kodu", "date").agg(F.sum("q").alias("prediction_store_daily"))
