"""Variant weights and the 14-day product prediction.

Shares are window sums over (store, style): a partition holds the variants of one
style in one store, a group bounded by the style's size, never by sales volume.  Rows of the universe are
dealt over a given number of partitions (``spread``), since their keys compress too well to be dealt by bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import as_date, number
from ..session import spread
from .universe import pairs_semi_join

PAIR = ["store_code", "stok_kodu", "product_id"]
GROUP = ["store_code", "stok_kodu"]


def _end(df: DataFrame, c: str) -> Column:
    return df.agg(F.max(c)).scalar()


def _recent_sales(sales: DataFrame, end: Column, lookback_days: int = 90) -> DataFrame:
    """Positive sales of the last 90 days per variant."""
    s = sales.filter((F.col("date") >= F.date_sub(end, lookback_days - 1)) & (F.col("date") <= end)
                     & (F.col("net_quantity") > 0))
    return s.groupBy(*PAIR).agg(F.greatest(F.sum("net_quantity"), F.lit(0.0)).alias("sales_90d"))


def _recent_stock(stock_agg: DataFrame, end: Column, lookback_days: int = 60) -> DataFrame:
    """Positive stock of the last 60 days per variant."""
    st = stock_agg.filter((F.col("stok_tarihi") >= F.date_sub(end, lookback_days - 1))
                          & (F.col("stok_tarihi") <= end) & (F.col("stok_miktar") > 0))
    # grouped under the table's own names, which a bucketed table serves in place
    st = st.groupBy("magaza", "stok_kodu", "product_id").agg(F.sum("stok_miktar").alias("onhand_30d"))
    return st.withColumnRenamed("magaza", "store_code")


def _share(qty: str) -> Column:
    """A variant's share of a quantity within (store, style)."""
    return F.try_divide(F.col(qty), F.sum(qty).over(Window.partitionBy(*GROUP)))


def variant_sales_share(sales: DataFrame, pairs: DataFrame, end_date: Column | None = None,
                        lookback_days: int = 90) -> DataFrame:
    """Positive sales of the last 90 days per variant and its share within (store, style)."""
    end = end_date if end_date is not None else _end(sales, "date")
    agg = spread(pairs_semi_join(_recent_sales(sales, end, lookback_days), pairs, PAIR), *GROUP)
    return agg.withColumn("weight_sales", _share("sales_90d"))


def variant_stock_share(stock_agg: DataFrame, pairs: DataFrame, end_date: Column,
                        lookback_days: int = 60) -> DataFrame:
    """Positive stock of the last 60 days per variant and its share (column name kept
    as the pipeline's ``onhand_30d``)."""
    agg = spread(pairs_semi_join(_recent_stock(stock_agg, end_date, lookback_days), pairs, PAIR), *GROUP)
    return agg.withColumn("weight_onhand", _share("onhand_30d"))


def variant_weight_map(sales: DataFrame, stock_agg: DataFrame, pairs: DataFrame,
                       end_date: Column | None = None) -> DataFrame:
    """H6: weight of each variant inside (store, style).

    Sales share first, stock share where a variant has no sales; a group with neither
    gets 1/n; a group whose weights sum to 0 gets 1/n; finally weights are
    renormalised to sum to 1 over the non-null ones.

    The shares are those of ``variant_sales_share`` and ``variant_stock_share``, taken on the universe's own rows:
    the left joins keep just its variants, and the windows that the weights need anyway add them up.  So the universe
    is expanded, dealt and sorted once, not again for each share's semi-join."""
    end = end_date if end_date is not None else _end(sales, "date")
    p = spread(pairs.select(*PAIR), *PAIR)
    w = p.join(_recent_sales(sales, end), PAIR, "left").join(_recent_stock(stock_agg, end), PAIR, "left")
    w = spread(w, *GROUP)
    g = Window.partitionBy(*GROUP)
    w = w.withColumn("weight_sales", _share("sales_90d")).withColumn("weight_onhand", _share("onhand_30d"))
    w = w.withColumn("weight", F.coalesce("weight_sales", "weight_onhand"))
    w = w.withColumn("n_option", F.count("product_id").over(g))
    inv_n = F.try_divide(F.lit(1.0), F.col("n_option").cast("double"))
    w = w.withColumn("weight", F.when(F.max(F.col("weight").isNotNull()).over(g), F.col("weight")).otherwise(inv_n))
    w = w.withColumn("weight", F.when(F.coalesce(F.sum("weight").over(g), F.lit(0.0)) == 0, inv_n).otherwise(F.col("weight")))
    w = w.withColumn("weight", F.try_divide(F.col("weight"), F.sum("weight").over(g)))
    return w.select(*PAIR, "weight")


def prediction_14d_by_product(daily_pred: DataFrame, weight_map: DataFrame, start_date: Column,
                              horizon_days: int = 14, drop_negative: bool = True) -> DataFrame:
    """H7: store x style daily forecast spread to variants by weight, summed over
    (start, start + 14 days].  Summing before weighting gives the same result and
    shuffles one row per (store, style) instead of one per day."""
    p = daily_pred.select(F.col("store_code").cast("string").alias("store_code"),
                          F.col("stok_kodu").cast("string").alias("stok_kodu"),
                          as_date("date").alias("sales_date"),
                          F.coalesce(number("prediction_store_daily"), F.lit(0.0)).alias("q"))
    if drop_negative:
        p = p.filter(F.col("q") >= 0)
    p = p.filter((F.col("sales_date") > start_date) & (F.col("sales_date") <= F.date_add(start_date, horizon_days)))
    per_style = p.groupBy(*GROUP).agg(F.sum("q").alias("q"))
    # variants without a product id are dropped, as a group-by on the id would
    wm = weight_map.select(*PAIR, "weight").filter(F.col("product_id").isNotNull())
    out = per_style.join(wm, GROUP, "inner")
    return out.select(*PAIR, F.coalesce(F.col("q") * F.col("weight"), F.lit(0.0)).alias("prediction_df"))
