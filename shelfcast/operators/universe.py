"""Replenishment inputs and the store x product universe (P13, J4, J6, G1 stock, H7b).

The universe is small per store (styles a store stocks or is forecast to sell), so
the joins here are keyed shuffles on (store, style) or broadcasts of the active
product map when the planner measures it small enough.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_date, clean_attribute_code, month_floor_lookback, not_sentinel, number
from ..profiles import Profile, get_profile
from ..session import spread
from .clean import active_products


def replenishment_sales(sales: DataFrame, product: DataFrame, as_of: Column,
                        profile: "Profile | str | None" = None) -> DataFrame:
    """Sales used by replenishment: the profile's month-floored lookback (none: all sales),
    attribute sentinels removed (NULL attributes kept), no returns.  Style code is taken from
    the product dimension when the sales table lacks it."""
    pf = get_profile(profile)
    s = sales.select(as_date("date").alias("date"), F.trim(F.col("store_code").cast("string")).alias("store_code"),
                     F.trim(F.col("product_id").cast("string")).alias("product_id"),
                     *([F.col("stok_kodu").cast("string").alias("stok_kodu")] if "stok_kodu" in sales.columns else []),
                     F.coalesce(number("net_quantity"), F.lit(0.0)).alias("net_quantity"))
    s = s.filter(F.col("net_quantity") >= 0)
    if pf.sales_lookback_days is not None:
        s = s.filter(F.col("date") >= month_floor_lookback(as_of, days=pf.sales_lookback_days))
    cols = ["product_id", "product_att_01", "product_att_02"]
    if "stok_kodu" not in s.columns:
        cols.append(F.col("product_code").alias("stok_kodu"))
    p = product.select(*cols)
    s = s.join(p, "product_id", "left").withColumn("product_att_02", clean_attribute_code("product_att_02"))
    keep = not_sentinel("product_att_01", pf.sentinels) & not_sentinel("product_att_02", pf.sentinels)
    return s.filter(keep).select("date", "store_code", "product_id", "stok_kodu", "net_quantity")


def stock_by_day(store_stock: DataFrame, as_of: Column | None = None, month_floor_days: int | None = 30) -> DataFrame:
    """G1: stock summed per (date, store, style, product); quantity truncated to an integer.

    With ``month_floor_days`` the read is limited to positive rows since the first of the month
    of as_of - that many days, the window the prod job reads; None keeps every row."""
    s = store_stock.select(as_date("stok_tarihi").alias("stok_tarihi"),
                           F.col("magaza").cast("string").alias("magaza"),
                           F.col("stok_kodu").cast("string").alias("stok_kodu"),
                           F.col("product_id").cast("string").alias("product_id"),
                           F.coalesce(number("toplam_miktar"), F.lit(0.0)).alias("toplam_miktar"))
    if month_floor_days is not None:
        s = s.filter((F.col("stok_tarihi") >= month_floor_lookback(as_of, days=month_floor_days))
                     & (F.col("toplam_miktar") > 0))
    return (s.groupBy("stok_tarihi", "magaza", "stok_kodu", "product_id")
             .agg(F.sum("toplam_miktar").cast("long").alias("stok_miktar")))


def latest_stock(stock_agg: DataFrame) -> DataFrame:
    """On-hand per (store, product) from the latest snapshot date of that pair."""
    return (stock_agg.groupBy(F.col("magaza").alias("store_code"), "product_id")
                     .agg(F.max_by("stok_miktar", "stok_tarihi").alias("stok_miktar")))


def store_sku_pairs(stock_agg: DataFrame, prediction: DataFrame | None = None,
                    lookback_stock_days: int = 30, lookahead_pred_days: int | None = 30, min_pred: float = 0.0,
                    anchor: str = "stock", pred_qty: str = "prediction_store_daily") -> DataFrame:
    """(store, style) pairs with stock in the last 30 days, union forecast pairs.

    ``anchor='stock'`` puts 'today' at the last stock date; ``'max'`` takes the later of
    the stock and forecast dates, as the forecast-driven variant does."""
    today = stock_agg.agg(F.max("stok_tarihi")).scalar()
    if prediction is not None and anchor == "max":
        today = F.greatest(today, prediction.agg(F.max(as_date("date"))).scalar())
    st = stock_agg.filter((F.col("stok_tarihi") >= F.date_sub(today, lookback_stock_days - 1))
                          & (F.col("stok_tarihi") <= today) & (F.col("stok_miktar") > 0))
    pairs = st.select(F.col("magaza").cast("string").alias("magaza"), F.col("stok_kodu").cast("string").alias("stok_kodu"))
    if prediction is not None:
        q = F.coalesce(number(pred_qty), F.lit(0.0))
        keep = q > min_pred
        if lookahead_pred_days is not None:
            keep = keep & (as_date("date") <= F.date_add(today, lookahead_pred_days - 1))
        pr = prediction.filter(keep)
        pairs = pairs.unionByName(pr.select(F.col("store_code").cast("string").alias("magaza"),
                                            F.col("stok_kodu").cast("string").alias("stok_kodu")))
    return pairs.distinct()


def style_to_variants(pairs: DataFrame, product: DataFrame, only_active: bool = True) -> DataFrame:
    """Every (store, style) pair expanded to the style's (active) variants; a style
    without variants keeps one row with a NULL product_id.

    Both sides are distinct before the join, so its rows are, and nothing holds the expansion.  The
    number of partitions is given: AQE would size them by the two small inputs, and one task would
    write all the variants of all stores."""
    p = active_products(product) if only_active else product
    p = p.select(F.col("product_code").cast("string").alias("product_code"), F.col("product_id").cast("string").alias("product_id"))
    pairs = spread(pairs.select("magaza", "stok_kodu").distinct(), "stok_kodu")
    p = spread(p, "product_code").distinct()
    out = pairs.join(p, pairs.stok_kodu == p.product_code, "left")
    return out.select(F.col("magaza").alias("store_code"), "stok_kodu", "product_id")


def store_product_pairs(stock_agg: DataFrame, product: DataFrame, prediction: DataFrame | None = None,
                        **kw) -> DataFrame:
    return style_to_variants(store_sku_pairs(stock_agg, prediction, **kw), product)


def pairs_semi_join(rows: DataFrame, pairs: DataFrame, keys=("store_code", "stok_kodu", "product_id")) -> DataFrame:
    """Keep rows whose key is in the pair set (pairs are distinct, so no fan-out).

    The pairs are dealt over a given number of partitions, and the rows with them (dealt the rows,
    the optimizer would move the join below)."""
    return rows.join(spread(pairs.select(*keys), *keys), list(keys), "left_semi")
