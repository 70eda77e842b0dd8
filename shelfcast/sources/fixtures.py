"""Retail views derived from the driver's TPC-H-like parquet tables.

The mapping is documented in FIXTURES.md; the DuckDB twin of every view lives in
``shelfcast.plans.oracle`` so the two sides read the same rows.  Everything here
is lazy: a view is a DataFrame plan over the parquet scan, so Catalyst prunes the
columns and pushes the date filters into the reader.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture mapping (FIXTURES.md).
ATT01_BY_TYPE = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "SMALL": 4, "STANDARD": 5, "PROMO": 999}
WAREHOUSE_PREFIX = "90010"
STOCK_OUT_BRAND = "Brand#7"


def store_code_of(nationkey: str) -> F.Column:
    return (F.lit(1001) + F.lit(100) * F.col(nationkey)).cast("string")


def warehouse_of(suppkey: str) -> F.Column:
    return F.concat(F.lit(WAREHOUSE_PREFIX), (F.col(suppkey) % 3 + 1).cast("string"))


class Retail:
    """Lazy retail tables over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """One DataFrame per table and instance: the file listing and footer read happen
        once, and identical scans in different branches can share an exchange."""
        cache = self.__dict__.setdefault("_tables", {})
        if name not in cache:
            cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return cache[name]

    @cached_property
    def as_of(self) -> dt.date:
        """The day the jobs run: the last shipping day, from the file metadata or one column."""
        return self.table("lineitem").agg(F.max("l_shipdate").cast("date")).first()[0]

    # ---------------------------------------------------------------- dimensions
    @staticmethod
    def _att01():
        t = F.col("p_type")
        att01 = None
        for name, code in ATT01_BY_TYPE.items():
            att01 = (F.when(t == name, F.lit(code)) if att01 is None
                     else att01.when(t == name, F.lit(code)))
        return att01

    @staticmethod
    def _att02():
        m5 = F.col("p_size") % 5
        return F.when(m5 == 0, F.lit("D")).when(m5 == 1, F.lit("N")).otherwise(m5.cast("string"))

    @cached_property
    def part_codes(self) -> DataFrame:
        """(p_partkey, product_code): facts join on the numeric key, not the string id."""
        return self.table("part").select(
            "p_partkey", F.concat(self._att01().cast("string"), F.lit("-"), F.col("p_brand"), F.lit("-"),
                                  self._att02()).alias("product_code"))

    @cached_property
    def dim_product(self) -> DataFrame:
        p = self.table("part")
        att01 = self._att01()
        m5 = F.col("p_size") % 5
        att02 = self._att02()
        att05 = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int") % 4
        pk = F.col("p_partkey") % 20
        words = F.split("p_name", " ")
        return p.select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.concat(att01.cast("string"), F.lit("-"), F.col("p_brand"), F.lit("-"), att02).alias("product_code"),
            F.col("p_brand").alias("marka_aciklama"),
            att01.cast("int").alias("product_att_01"),
            att02.alias("product_att_02"),
            F.element_at(words, 1).alias("product_att_03"),
            F.element_at(words, -1).alias("product_att_04"),
            att05.cast("int").alias("product_att_05"),
            F.lit(None).cast("string").alias("product_att_06"),
            F.col("p_type").alias("product_att_01_desc"),
            F.when(m5 <= 1, F.lit("BAND-9")).otherwise(F.concat(F.lit("BAND-"), m5.cast("string"))).alias("product_att_02_desc"),
            F.lit(None).cast("string").alias("product_att_03_desc"),
            F.lit(None).cast("string").alias("product_att_04_desc"),
            F.concat(F.lit("BRANDGRP-"), att05.cast("string")).alias("product_att_05_desc"),
            F.lit(None).cast("string").alias("product_att_06_desc"),
            F.when(pk == 0, F.lit(1)).when(pk == 1, F.lit(None)).otherwise(F.lit(0)).cast("int").alias("is_blocked"),
        )

    @cached_property
    def store_clustering(self) -> DataFrame:
        n = self.table("nation")
        return n.filter(F.col("n_nationkey") != 24).select(
            store_code_of("n_nationkey").alias("store_code"),
            (F.col("n_nationkey") % 4).cast("int").alias("store_cluster"),
        )

    @cached_property
    def dim_calendar(self) -> DataFrame:
        """One row per day over the shipping range of ``lineitem``."""
        li = self.table("lineitem")
        rng = li.agg(F.min("l_shipdate").cast("date").alias("lo"), F.max("l_shipdate").cast("date").alias("hi"))
        d = F.col("date")
        day = F.dayofmonth(d)
        mon = F.month(d)
        kara = (mon == 11) & (F.weekday(d) == 4) & day.between(23, 29)
        ram = (mon == 3) & (day <= 3)
        kur = (mon == 6) & day.between(10, 13)
        return rng.select(F.explode(F.sequence("lo", "hi")).alias("date")).select(
            d,
            mon.cast("int").alias("month"),
            F.when(kara, F.lit("KARA_CUMA")).when(ram, F.lit("RAMAZAN")).when(kur, F.lit("KURBAN"))
             .when(day == 1, F.lit("YOK")).alias("special_day_tag"),
            ram.cast("int").alias("ramazan_bayrami"),
            kur.cast("int").alias("kurban_bayrami"),
            kara.cast("int").alias("kara_cuma"),
        )

    # --------------------------------------------------------------------- facts
    def _lines_with_store(self, cols: list[str]) -> DataFrame:
        li = self.table("lineitem").select(*cols)
        s = self.table("supplier").select("s_suppkey", "s_nationkey")
        return li.join(s, li.l_suppkey == s.s_suppkey, "inner")

    @cached_property
    def history_sales(self) -> DataFrame:
        return self.sales_since(None)

    def sales_since(self, first_day: dt.date | None) -> DataFrame:
        """Sales from ``first_day`` on; the bound is on the raw column, so it reaches the scan."""
        x = self._lines_with_store(["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                                    "l_returnflag", "l_linestatus", "l_shipdate"])
        if first_day is not None:
            # a string literal cast to timestamp_ntz does not depend on any time zone
            x = x.filter(F.col("l_shipdate") >= F.lit(f"{first_day.isoformat()} 00:00:00").cast("timestamp_ntz"))
        x = x.join(self.part_codes, x.l_partkey == self.part_codes.p_partkey, "inner")
        sign = F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), F.lit(-1.0)).otherwise(F.lit(1.0))
        x = x.select(
            F.col("l_shipdate").cast("date").alias("date"),
            F.col("product_code").alias("stok_kodu"),
            store_code_of("s_nationkey").alias("store_code"),
            F.col("l_partkey").cast("string").alias("product_id"),
            (sign * F.col("l_quantity")).alias("net_quantity"),
            (sign * F.col("l_extendedprice") * F.col("l_discount")).alias("discount_amount"),
            (sign * F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("net_amount_wovat"),
            F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"),
        )
        return x.select("date", "store_code", "product_id", "stok_kodu", "net_quantity",
                        "discount_amount", "net_amount_wovat", "unit_price")

    @cached_property
    def store_stock(self) -> DataFrame:
        x = self._lines_with_store(["l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"])
        x = x.filter((F.col("l_linestatus") == "O") & (F.col("l_returnflag") != "R"))
        x = x.join(self.part_codes, x.l_partkey == self.part_codes.p_partkey, "inner")
        x = x.select(
            F.col("l_shipdate").cast("date").alias("stok_tarihi"),
            store_code_of("s_nationkey").alias("magaza"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_quantity").alias("toplam_miktar"),
            "product_code")
        return x.select("stok_tarihi", "magaza", F.col("product_code").alias("stok_kodu"),
                        F.lit(None).cast("string").alias("color_code"), F.lit(None).cast("string").alias("size"),
                        "product_id", "toplam_miktar")

    @cached_property
    def warehouse_stock(self) -> DataFrame:
        li = self.table("lineitem").filter(F.col("l_linestatus") == "F")
        return (li.groupBy(warehouse_of("l_suppkey").alias("alt_yer"), F.col("l_partkey").cast("string").alias("product_id"))
                  .agg(F.sum(F.floor(F.col("l_quantity") / 10)).cast("long").alias("miktar")))

    @cached_property
    def stock_movement(self) -> DataFrame:
        x = self._lines_with_store(["l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linenumber"])
        x = x.filter(F.col("l_returnflag") == "N")
        even = (F.col("l_linenumber") % 2) == 0
        return (x.groupBy(F.col("l_partkey").cast("string").alias("urun_kodu"),
                          F.concat(store_code_of("s_nationkey"), F.lit("01")).alias("giris_depo_kodu"),
                          warehouse_of("l_suppkey").alias("cikis_depo_kodu"))
                 .agg(F.sum(F.when(even, F.col("l_quantity")).otherwise(F.lit(0.0))).alias("toplam_yoldaki_miktar"),
                      F.sum(F.when(~even, F.col("l_quantity")).otherwise(F.lit(0.0))).alias("toplanmayan_urun")))

    # ------------------------------------------------------ dense allocation pair
    @cached_property
    def dense_need(self) -> DataFrame:
        brand = self.dim_product.select("product_id", "marka_aciklama")
        return (self.history_sales.join(brand, "product_id", "inner")
                  .groupBy("store_code", F.col("marka_aciklama").alias("product_id"))
                  .agg(F.ceil(F.sum(F.greatest(F.col("net_quantity"), F.lit(0.0))) / 10).cast("long").alias("ihtiyac_adet")))

    @cached_property
    def dense_stock(self) -> DataFrame:
        li = self.table("lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_linestatus")
        li = li.filter(F.col("l_linestatus") == "F")
        p = self.table("part").select("p_partkey", "p_brand").filter(F.col("p_brand") != STOCK_OUT_BRAND)
        x = li.join(p, li.l_partkey == p.p_partkey, "inner")
        return (x.groupBy(warehouse_of("l_suppkey").alias("alt_yer"), F.col("p_brand").alias("product_id"))
                 .agg(F.sum(F.floor(F.col("l_quantity") / 12)).cast("long").alias("miktar")))


def naive_weekly_forecast(weekly: DataFrame, horizon_weeks: int = 12, last_n: int = 4) -> DataFrame:
    """Deterministic forecast stand-in (FIXTURES.md): per segment, the mean of
    max(total_quantity, 0) over its last ``last_n`` observed weeks, repeated for each
    of the ``horizon_weeks`` weeks after the last week in the data."""
    from pyspark.sql import Window
    seg = ["product_att_01", "product_att_02", "product_att_05", "store_cluster"]
    descs = ["product_att_01_desc", "product_att_02_desc", "product_att_05_desc"]
    last_week = weekly.agg(F.max("week_start_date")).scalar()
    rn = F.row_number().over(Window.partitionBy(*seg).orderBy(F.col("week_start_date").desc(), *descs))
    recent = weekly.select(*seg, F.greatest(F.col("total_quantity").cast("double"), F.lit(0.0)).alias("q"), rn.alias("rn"))
    level = recent.filter(F.col("rn") <= last_n).groupBy(*seg).agg(F.avg("q").alias("predicted_quantity"))
    return level.select(*seg, F.explode(F.sequence(F.lit(1), F.lit(horizon_weeks))).alias("h"), "predicted_quantity") \
                .select(*seg, F.date_add(last_week, F.col("h") * 7).alias("week_start_date"), "predicted_quantity")
