"""Audits of the jobs' inputs and outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .breakdown import MERGE_KEYS

def quantity_by(sales: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Quantity per key of the sales given, for every key at once."""
    return sales.groupBy(*keys).agg(F.sum("net_quantity").alias(name))


def zero_need(results: DataFrame) -> DataFrame:
    """Pairs for which the job found no need."""
    return results.filter(F.col("ihtiyac_adet") <= 0).select("store_code", "stok_kodu", "product_id", "ihtiyac_adet",
                                                            "net_quantity_28", "stok_miktar")


def first_sale(sales: DataFrame) -> DataFrame:
    """First sales day of every product."""
    return sales.groupBy("product_id").agg(F.min("date").alias("first_date"))


def daily_sample(daily: DataFrame, n: int) -> DataFrame:
    """The first ``n`` day x store x product rows in order."""
    return daily.orderBy("date", "store_code", "product_id").limit(n)


def distribution_of(distribution: DataFrame, product: str, warehouse: str) -> DataFrame:
    """Shipments of one product from one warehouse."""
    return distribution.filter((F.col("urun") == product) & (F.col("gonderen_depo") == warehouse))


def distribution_after(distribution: DataFrame, product: str, not_warehouse: str) -> DataFrame:
    """Shipments of the products after ``product`` in text order, from the other warehouses."""
    return distribution.filter((F.col("urun") > product) & (F.col("gonderen_depo") != not_warehouse))


def forecast_conservation(forecast: DataFrame, stores: DataFrame, daily: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Whether a weekly forecast arrives whole in its break-downs, per segment.

    ``stores_ok``: in every week the stores' shares add up to the forecast, or to nothing where the segment had no
    recent sales.  ``days_ok``: the days of each of its store x style pairs add up to the pair's weeks.
    A segment that has no store has ``n_pairs`` 0 and both are true."""
    def near(a, b):
        return F.abs(a - b) <= tolerance * F.greatest(F.lit(1.0), F.abs(a), F.abs(b))

    f = forecast.select(*[F.col(k).try_cast("double").alias(k) for k in MERGE_KEYS], "week_start_date", "predicted_quantity")
    in_stores = stores.groupBy(*MERGE_KEYS, "week_start_date").agg(F.sum("store_predicted_quantity").alias("in_stores"), F.max("store_ratio").alias("share"))
    whole = F.when(F.coalesce("share", F.lit(0.0)) > 0, near(F.col("in_stores"), F.col("predicted_quantity"))).otherwise(F.coalesce("in_stores", F.lit(0.0)) == 0)
    weeks = f.join(in_stores, [*MERGE_KEYS, "week_start_date"], "left").groupBy(*MERGE_KEYS).agg(
        F.count(F.lit(1)).alias("n_weeks"), F.sum("predicted_quantity").alias("predicted_quantity"), F.every(whole).alias("stores_ok"))
    pair = ["store_code", "stok_kodu"]
    by_week = stores.groupBy(*MERGE_KEYS, *pair).agg(F.sum("store_predicted_quantity").alias("weeks"))
    by_day = daily.groupBy(*pair).agg(F.sum("prediction_store_daily").alias("days"))
    pairs = by_week.join(by_day, pair, "left").groupBy(*MERGE_KEYS).agg(
        F.count(F.lit(1)).alias("n_pairs"), F.every(near(F.col("weeks"), F.coalesce("days", F.lit(0.0)))).alias("days_ok"))
    out = weeks.join(pairs, MERGE_KEYS, "left")
    return out.select(*MERGE_KEYS, "n_weeks", "predicted_quantity", F.coalesce("n_pairs", F.lit(0)).alias("n_pairs"), "stores_ok", F.coalesce("days_ok", F.lit(True)).alias("days_ok"))
