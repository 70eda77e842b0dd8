"""Replenishment need.

The base table is a chain of left joins that all use the same key
(store_code, product_id): Spark shuffles the universe once on that key and every
further sort-merge join reuses the partitioning (small sides are broadcast by
AQE when measured small).  Sides that come from tables bucketed by that key
(``plans.jobs``) are not shuffled at all.  The need formula is pure column arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clip, number
from ..profiles import Profile, get_profile

KEY = ["store_code", "product_id"]


def sales_7_14_28(sales: DataFrame, as_of: Column | None = None, clip_negative: bool = True) -> DataFrame:
    """7/14/28-day sales per (product, store) in one pass (one shuffle)."""
    end = as_of if as_of is not None else sales.agg(F.max("date")).scalar()
    s = sales.filter((F.col("date") >= F.date_sub(end, 27)) & (F.col("date") <= end))
    out = []
    for n in (7, 14, 28):
        v = F.coalesce(F.sum(F.when(F.col("date") >= F.date_sub(end, n - 1), F.col("net_quantity"))), F.lit(0.0))
        if clip_negative:
            v = F.greatest(v, F.lit(0.0))
        out.append(v.alias(f"net_quantity_{n}"))
    return s.groupBy(*KEY).agg(*out)


def replenishment_base(pairs: DataFrame, safety: DataFrame, pred14: DataFrame, on_hand: DataFrame,
                       sales_windows: DataFrame, orders: DataFrame, integer_orders: bool = True) -> DataFrame:
    """Universe x safety stock x 14-day prediction x on-hand x 7/14/28 sales x open orders."""
    b = pairs.select("store_code", "stok_kodu", "product_id")
    b = b.join(safety.select(*KEY, "safety_stock"), KEY, "left")
    b = b.join(pred14.select(*KEY, "prediction_df"), KEY, "left")
    b = b.join(on_hand.select(*KEY, "stok_miktar"), KEY, "left")
    b = b.join(sales_windows.select(*KEY, "net_quantity_7", "net_quantity_14", "net_quantity_28"), KEY, "left")
    b = b.join(orders.select(*KEY, "acik_siparis"), KEY, "left")
    q = {n: F.greatest(F.coalesce(F.col(f"net_quantity_{n}"), F.lit(0.0)), F.lit(0.0)).cast("long") for n in (7, 14, 28)}
    ma = ((q[7] / 7) * 0.5 + (q[14] / 14) * 0.3 + (q[28] / 28) * 0.2) * 14
    return b.select(
        "store_code", "stok_kodu", "product_id",
        F.coalesce(number("safety_stock"), F.lit(0.0)).alias("safety_stock"),
        F.coalesce(F.col("prediction_df"), F.lit(0.0)).cast("double").alias("prediction_df"),
        F.coalesce(F.col("stok_miktar"), F.lit(0)).cast("long").alias("stok_miktar"),
        q[7].alias("net_quantity_7"), q[14].alias("net_quantity_14"), q[28].alias("net_quantity_28"),
        ma.alias("prediction_ma"),
        F.coalesce(number("acik_siparis"), F.lit(0.0)).cast("long" if integer_orders else "double").alias("acik_siparis"))


def blend_weight(base: DataFrame, profile: "Profile | str | None" = None) -> Column:
    """Model weight: momentum (14-day vs half of 28-day sales, 1 without history,
    bounded 0..2) mapped linearly and clipped, then the override rules."""
    pf = get_profile(profile)
    q7, q28 = (F.col(f"net_quantity_{n}").cast("double") for n in (7, 28))
    df, ma = F.col("prediction_df"), F.col("prediction_ma")
    w = clip(F.lit(pf.w_base) + F.lit(pf.w_slope) * (momentum_column() - 1.0), pf.w_min, pf.w_max, keep_null=False)
    w = F.when((ma <= 0) & (df > 0), F.lit(1.0)).otherwise(w)
    w = F.when((df <= 0) & (ma > 0) & (q28 > 0), F.lit(0.0)).otherwise(w)
    if pf.low_week_sales_cutoff is not None:
        w = F.when(q7 < pf.low_week_sales_cutoff, F.lit(0.0)).otherwise(w)
    return w


def momentum_column() -> Column:
    q14, q28 = F.col("net_quantity_14").cast("double"), F.col("net_quantity_28").cast("double")
    return F.least(F.greatest(F.coalesce(F.try_divide(q14, F.nullif(q28 / 2.0, F.lit(0.0))), F.lit(1.0)), F.lit(0.0)), F.lit(2.0))


def need_with_14day_coverage(base: DataFrame, profile: "Profile | str | None" = None,
                             lead_time_days: float | None = None) -> DataFrame:
    """H8: order-up-to level (safety + blended 14-day demand) minus expected stock at
    arrival (on hand - lead-time demand + open orders), rounded to units."""
    pf = get_profile(profile)
    lt = pf.lead_time_days if lead_time_days is None else lead_time_days
    b = base.withColumn("w_model", blend_weight(base, pf))
    b = b.withColumn("pred_14_blended", F.col("w_model") * F.col("prediction_df")
                     + (F.lit(1.0) - F.col("w_model")) * F.col("prediction_ma"))
    b = b.withColumn("pred_LT", F.col("pred_14_blended") * (lt / 14.0))
    b = b.withColumn("OUL_14", F.col("safety_stock") + F.col("pred_14_blended"))
    expected = F.col("stok_miktar") - F.col("pred_LT") + F.col("acik_siparis")
    gap = F.greatest(F.lit(0.0), F.col("OUL_14") - expected)
    need = F.ceil(gap) if pf.need_rounding == "ceil" else F.bround(gap, 0)
    b = b.withColumn("ihtiyac_adet", need.cast("long"))
    if pf.zero_need_without_sales:
        b = b.withColumn("ihtiyac_adet", F.when(F.col("net_quantity_28") == 0, F.lit(0)).otherwise(F.col("ihtiyac_adet")).cast("long"))
    if pf.post_adjust:
        # reported figures are rewritten after the need was computed from the originals
        b = b.withColumn("prediction_df", F.when(F.col("prediction_df") > F.col("net_quantity_14"), F.lit(0.0))
                         .otherwise(F.col("prediction_df")))
        b = b.withColumn("safety_stock", F.when(F.col("safety_stock") > 1.15 * F.col("prediction_ma"),
                                                F.col("safety_stock") * 0.8).otherwise(F.col("safety_stock")))
    if not pf.keep_order_up_to:
        b = b.drop("OUL_14")
    return b.filter(F.col("ihtiyac_adet") > 0) if pf.only_positive_need else b


def publish_rows(results: DataFrame, model_date: Column, need_col: str = "ihtiyac_adet",
                 only_positive: bool = True) -> DataFrame:
    """S8 rows: a leading ``model_date`` column; replenishment keeps need > 0 only."""
    out = results.select(model_date.alias("model_date"), *results.columns)
    return out.filter(F.col(need_col) > 0) if only_positive else out
