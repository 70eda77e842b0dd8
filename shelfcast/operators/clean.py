"""Cleaning, filters and small derivations (P4-P16) as DataFrame -> DataFrame steps."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clip, month_floor_lookback, not_sentinel, number, seasonal_month_filter


def exclude_sentinels(df: DataFrame, cols: Iterable[str] = ("product_att_01", "product_att_02"),
                      values: Iterable = (9, 999)) -> DataFrame:
    """P5: drop rows whose attribute equals a sentinel; rows with a NULL attribute stay."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & not_sentinel(c, values)
    return df.filter(cond)


def negative_quantity_sums(df: DataFrame, keys: Iterable[str], qty: str = "net_quantity") -> DataFrame:
    """Sums per key under the three treatments of returns: rows clipped at 0, rows below 0
    dropped, and the sum itself zeroed."""
    q = number(qty)
    return df.groupBy(*keys).agg(F.sum(clip(q, lo=0.0)).alias("qty_clipped"),
                                 F.sum(F.when(q >= 0, q)).alias("qty_filtered"),
                                 F.greatest(F.sum(q), F.lit(0.0)).alias("qty_zeroed_after_sum"))


def sales_profile(sales: DataFrame) -> DataFrame:
    """One row of counts, date range and totals."""
    return sales.agg(F.count(F.lit(1)).alias("row_count"), F.min("date").alias("min_date"), F.max("date").alias("max_date"),
                     F.countDistinct("store_code").alias("stores"), F.countDistinct("product_id").alias("products"),
                     F.sum("net_quantity").alias("net_quantity"))


def lookback_filter(df: DataFrame, days: int, date_col: str = "date", as_of: Column | None = None) -> DataFrame:
    """The last ``days`` days up to ``as_of`` (default max(date) of the input), inclusive."""
    end = as_of if as_of is not None else df.agg(F.max(date_col)).scalar()
    return df.filter((F.col(date_col) >= F.date_sub(end, days - 1)) & (F.col(date_col) <= end))


def month_floor_filter(df: DataFrame, as_of: Column, date_col: str = "date",
                       months: int = 0, days: int = 0, weeks: int = 0) -> DataFrame:
    """Date >= first of the month of (as_of - N)."""
    return df.filter(F.col(date_col) >= month_floor_lookback(as_of, months=months, days=days, weeks=weeks))


def active_products(product: DataFrame) -> DataFrame:
    """Products that are not blocked (NULL counts as not blocked)."""
    if "is_blocked" not in product.columns:
        return product
    return product.filter(F.coalesce(F.col("is_blocked").try_cast("int"), F.lit(0)) == 0)


def stock_product_id(stock: DataFrame, style: str = "stok_kodu", color: str = "color_code",
                     size: str = "size", out: str = "product_id") -> DataFrame:
    """SKU id = style || color || size."""
    return stock.withColumn(out, F.concat(F.col(style), F.col(color), F.col(size)))


def open_order_qty(movement: DataFrame, null_safe: bool = False, depot: str = "entry") -> DataFrame:
    """S5 + P10: open orders per (product, store); quantity = in transit + unpicked.

    ``depot='entry'`` keys by the first 4 characters of the entry depot (the
    receiving store); 'exit' keys by the exit depot."""
    transit, unpicked = number("toplam_yoldaki_miktar"), number("toplanmayan_urun")
    m = movement.filter((transit > 0) | (unpicked > 0))
    key = F.left(F.col("giris_depo_kodu"), F.lit(4)) if depot == "entry" else F.col("cikis_depo_kodu")
    # keyed in the order that the star joins by, which saves them an exchange
    g = m.groupBy(key.cast("string").alias("store_code"), F.col("urun_kodu").cast("string").alias("product_id")).agg(
        F.sum(transit).alias("toplam_yoldaki_miktar"),
        F.sum(unpicked).alias("toplanmayan_urun"))
    if null_safe:
        q = F.coalesce(F.col("toplam_yoldaki_miktar"), F.lit(0.0)) + F.coalesce(F.col("toplanmayan_urun"), F.lit(0.0))
    else:
        q = F.col("toplam_yoldaki_miktar") + F.col("toplanmayan_urun")
    return g.withColumn("acik_siparis", q)


def extract_open_orders(movement: DataFrame) -> DataFrame:
    """S5 loader: open orders summed per (product, exit depot), no row filter."""
    return (movement.groupBy(F.col("urun_kodu").alias("product_id"), F.col("cikis_depo_kodu").alias("depo_kodu"))
                    .agg(F.sum("toplam_yoldaki_miktar").alias("toplam_yoldaki_miktar"),
                         F.sum("toplanmayan_urun").alias("toplanmayan_urun")))


def seasonal_months(df: DataFrame, as_of: Column, window: int = 1, date_col: str = "date") -> DataFrame:
    """Rows whose month is within +-window of as_of's month, in any year."""
    return df.filter(seasonal_month_filter(date_col, as_of, window))
