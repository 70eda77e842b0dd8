"""Sources and sinks.

Readers always take an explicit schema (no inference pass over the data); sinks
write through Spark's distributed writers, one file per task.  Where the
pipeline's outputs used a regional number format (';' separator, decimal comma,
6 decimals), the formatting is a column expression, not a driver-side step.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# ------------------------------------------------------------------------ readers
def read_csv(spark: SparkSession, path: str, schema: "T.StructType | str", header: bool = True,
             sep: str = ",", **options) -> DataFrame:
    """CSV with header and a declared schema (mode FAILFAST would stop on a bad row;
    PERMISSIVE with NULLs mirrors a coercing reader)."""
    r = spark.read.schema(schema).option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
    for k, v in options.items():
        r = r.option(k, v)
    return r.csv(path)


def read_csv_locale(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";",
                    locale: str = "tr-TR", **options) -> DataFrame:
    """S2: ';'-separated, decimal comma, '.' thousands.

    Numeric fields are declared as DecimalType so the locale applies while parsing;
    they are returned as doubles."""
    dec_schema = T.StructType([
        T.StructField(f.name, T.DecimalType(18, 4) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else f.dataType,
                      f.nullable) for f in schema.fields])
    df = read_csv(spark, path, dec_schema, header=True, sep=sep, locale=locale, **options)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_parquet_pruned(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """S3: parquet with a column list; the scan's ReadSchema holds only these columns."""
    return spark.read.parquet(path).select(*columns)


def read_jdbc(spark: SparkSession, url: str, query: str, properties: dict | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None) -> DataFrame:
    """table/query read over JDBC in ``num_partitions`` range reads of ``partition_column``.

    A read without a partition column goes through one task and must be asked for with
    ``num_partitions=1``.  Credentials come from ``properties``."""
    if num_partitions is None or (partition_column is None) != (num_partitions == 1):
        raise ValueError("give a partition column with num_partitions, or num_partitions=1 for a single task")
    r = spark.read.format("jdbc").option("url", url)
    if partition_column:
        if lower_bound is None or upper_bound is None:
            raise ValueError("a partition column needs lower_bound and upper_bound")
        r = (r.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
              .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
              .option("numPartitions", str(num_partitions)))
    else:
        r = r.option("query", query)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()


def read_store_cluster_file(spark: SparkSession, path: str) -> DataFrame:
    """The store-cluster file carries a leading unnamed index column."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    first = df.columns[0]
    if first in ("", "_c0") or first.startswith("Unnamed"):
        df = df.drop(first)
    return df.select(F.trim(F.col("store_code")).alias("store_code"),
                     F.col("store_cluster").try_cast("int").alias("store_cluster"))


#: Names of the feeds and their English names at the edge.
EDGE_NAMES = {
    "magaza": "store_code", "stok_kodu": "style_code", "product_code": "style_code", "stok_tarihi": "stock_date",
    "toplam_miktar": "stock_qty", "stok_miktar": "on_hand_qty", "alt_yer": "warehouse_code", "miktar": "warehouse_qty",
    "acik_siparis": "open_order_qty", "toplam_yoldaki_miktar": "in_transit_qty", "toplanmayan_urun": "unpicked_qty",
    "giris_depo_kodu": "entry_depot_code", "cikis_depo_kodu": "exit_depot_code", "urun_kodu": "product_id",
    "prediction_df": "model_14d_qty", "prediction_ma": "moving_avg_14d_qty", "OUL_14": "order_up_to_14d",
    "pred_LT": "lead_time_qty", "ihtiyac_adet": "need_qty", "gonderen_depo": "from_warehouse", "alan_magaza": "to_store",
    "urun": "product_id", "baslangic_depo_stok": "warehouse_opening_qty", "karsilanan_adet": "shipped_qty",
    "kalan_ihtiyac": "remaining_need_qty", "depo_sevk_toplam": "warehouse_shipped_qty",
    "depo_kalan_nihai": "warehouse_closing_qty", "marka_aciklama": "brand", "kara_cuma": "black_friday",
    "ramazan_bayrami": "feast_spring", "kurban_bayrami": "feast_summer",
}


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Columns under their names at the other side of an edge; other columns stay."""
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


# ------------------------------------------------------------------------- sinks
def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    """Snappy parquet."""
    w = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """S7 (plain)."""
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


def format_decimal(c: "str | F.Column", decimals: int = 6, decimal_comma: bool = False,
                   thousands: bool = False) -> F.Column:
    """Fixed-decimals text for a number; optionally '1.234,5' style."""
    x = F.col(c) if isinstance(c, str) else c
    if thousands:
        s = F.format_number(x, decimals)                   # 1,234.500000
    else:
        s = F.format_string(f"%.{decimals}f", x)           # 1234.500000
    if decimal_comma:
        s = F.translate(s, ",.", ".,")
    return F.when(x.isNotNull(), s)


def write_csv_formatted(df: DataFrame, path: str, decimals: int = 6, decimal_comma: bool = False,
                        sep: str = ";", thousands: bool = False, mode: str = "overwrite") -> None:
    """S7 (formatted): every floating column rendered with fixed decimals."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            out.append(format_decimal(F.col(f"`{f.name}`"), decimals, decimal_comma, thousands).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    write_csv(df.select(*out), path, sep=sep, mode=mode)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               truncate: bool = True) -> None:
    """Truncate-and-load; the table keeps its definition, rows are replaced."""
    w = df.write.format("jdbc").mode("overwrite").option("url", url).option("dbtable", table)
    if truncate:
        w = w.option("truncate", "true")
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


# ----------------------------------------------------------------- raw landing
_SPACE, _BAD = re.compile(r"\s+"), re.compile(r"[^\w$]")


def sanitize_column_names(names: list[str], max_len: int = 60) -> list[str]:
    """Column names that a database takes: letters of any alphabet, digits, _ and $ stay, runs of
    white space and other characters become _, a leading digit gets a _ before it; at most
    ``max_len`` long and unique."""
    out: list[str] = []
    for name in names:
        clean = _BAD.sub("_", _SPACE.sub("_", (name or "").strip().replace("\ufeff", "")))
        clean = ("_" + clean if clean[:1].isdigit() else clean)[:max_len] or "_col"
        free, k = clean, 0
        while free in out:
            k += 1
            free = clean[:max(1, max_len - len(f"_{k}"))] + f"_{k}"
        out.append(free)
    return out


def land_raw_text(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Every column as text, names sanitised and de-duplicated (only the header
    row's names are handled on the driver; the data stays distributed)."""
    reader = spark.read.option("inferSchema", False).option("sep", sep).option("encoding", encoding)
    # Spark de-duplicates header names on its own ('a3', 'a4'); take the raw header line
    header = reader.option("header", False).csv(path).limit(1).collect()[0]
    df = reader.option("header", True).csv(path)
    return df.toDF(*sanitize_column_names([str(v) if v is not None else "" for v in header]))
