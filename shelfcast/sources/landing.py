"""Landing of text feeds: folders of CSV files with differing headers, rows that do not fit a
schema, and extracts kept as monthly partitions.

``land_raw_files`` reconciles headers file by file; ``land_checked_csv`` splits rows from rejects in one
pass; ``MonthlyExtract`` reloads single months without touching the files of others.
"""

from __future__ import annotations

import csv
import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .io import sanitize_column_names

#: Separators that a header line is searched for.
SEPARATORS = (",", ";", "\t", "|")
#: Header lines read at a time.
OPEN_AT_ONCE = 16


# ----------------------------------------------------------- folders of raw files
def csv_files(spark: SparkSession, paths: "str | list[str]", pattern: str = "*.csv*") -> list[str]:
    """The files with bytes below ``paths``, in order; a listing, no content is read."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
              .option("pathGlobFilter", pattern).load(paths).filter("length > 0").select("path"))
    return sorted(r.path for r in listed.collect())


def first_line(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str:
    """The first line of a file, read through the file system that Spark reads it with.

    Compressed files are opened by their codec."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(conf).open(where)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
        content = stream if codec is None else codec.createInputStream(stream)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(content, encoding)).readLine() or ""
    finally:
        stream.close()


def separator_of(header: str) -> str:
    """The separator that occurs most often outside quotes; ';' if there is none."""
    outside = "".join(header.split('"')[::2])
    best = max(SEPARATORS, key=outside.count)
    return best if outside.count(best) else ";"


def land_raw_files(spark: SparkSession, paths: "str | list[str]", sep: str | None = None, encoding: str = "UTF-8",
                   file_column: str | None = None) -> DataFrame:
    """S9 for a folder: every column of every file as text, matched by its sanitised name.

    Files may order their columns differently, miss some or bring new ones, and (``sep=None``) use
    different separators.  Columns come in the order of their first appearance over the files by path; a
    column that a file does not have is NULL in its rows.  ``file_column`` names a column for the file a row came
    from.  Only header lines (one a file, like the listing) reach the driver.  Files of one layout are one scan, so
    a plan has as many scans as there are layouts; a needed column is pruned in each."""
    files = csv_files(spark, paths)
    if not files:
        raise ValueError(f"no CSV files below {paths}")
    with ThreadPoolExecutor(OPEN_AT_ONCE) as pool:
        lines = list(pool.map(lambda f: first_line(spark, f, encoding), files))
    layouts: dict[tuple, list[str]] = {}
    for path, line in zip(files, lines):
        by = sep or separator_of(line)
        names = next(csv.reader([line], delimiter=by), [])
        layouts.setdefault((by, tuple(sanitize_column_names(names))), []).append(path)
    order = list(dict.fromkeys(name for _, names in layouts for name in names))
    out = None
    for (by, names), some in layouts.items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        df = spark.read.schema(schema).option("header", True).option("sep", by).option("encoding", encoding).csv(some)
        if file_column:
            df = df.select("*", F.col("_metadata.file_path").alias(file_column))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out.select(*(F.col(f"`{c}`") for c in [*order, *([file_column] if file_column else [])]))


# ------------------------------------------------------------ rows and rejects
@dataclass
class CheckedCsv:
    """``rows`` fit the schema; ``rejects`` are (source_file, record, n_fields, bad_fields, reason)."""

    rows: DataFrame
    rejects: DataFrame


@contextmanager
def both_files_open(spark: SparkSession, partitions: int):
    """Writes of at most so many partitions keep a file of each open.

    Spark otherwise sorts a task's rows by the partition first, and one task holds its whole share of the input."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, max(int(before), partitions))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def land_checked_csv(spark: SparkSession, path: str, schema: T.StructType, out: str, header: bool = True,
                     sep: str = ",", locale: str | None = None, **options) -> CheckedCsv:
    """S1/S2 with a quarantine: rows that fit ``schema`` and the records that do not.

    The file is parsed once, into a table partitioned by whether the record was rejected; both results
    read only their own partition.  A record is rejected when its number of fields differs from the schema's or
    when a field does not parse; the reasons name the fields.  With ``locale`` numbers are
    read as that region writes them (as ``read_csv_locale`` does)."""
    def parsed_as(kind: T.DataType) -> T.DataType:
        return T.DecimalType(18, 4) if locale and isinstance(kind, (T.DoubleType, T.FloatType)) else kind

    options = {"sep": sep, **({"locale": locale} if locale else {}), **options}
    record = T.StructField("_record", T.StringType())
    fields = T.StructType([*(T.StructField(f.name, parsed_as(f.dataType), True) for f in schema.fields), record])
    df = spark.read.schema(fields).options(header=header, mode="PERMISSIVE", columnNameOfCorruptRecord="_record", **options).csv(path)
    typed = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]
    df = df.select(*typed, "_record", F.col("_metadata.file_path").alias("_file"), F.col("_record").isNotNull().alias("_rejected"))
    with both_files_open(spark, 2):
        df.write.partitionBy("_rejected").parquet(out)
    stored = spark.read.schema(df.schema).parquet(out)
    rejected = stored.filter("_rejected")
    return CheckedCsv(stored.filter("not _rejected").select(*(F.col(f"`{f.name}`") for f in schema.fields)),
                      _explained(rejected, schema, sep, options))


def _explained(rejected: DataFrame, schema: T.StructType, sep: str, options: dict) -> DataFrame:
    """Why each record was rejected: the text of every field against what became of it."""
    texts = ", ".join(f"f{i} string" for i in range(len(schema.fields)))
    split = F.from_csv("_record", F.lit(texts), {k: str(v) for k, v in options.items() if k in ("sep", "quote", "escape", "charToEscapeQuoteEscaping")})
    # separators outside quotes
    quoted = sep if sep.isalnum() else "\\" + sep
    n_fields = F.regexp_count("_record", F.lit(f'{quoted}(?=(?:[^"]*"[^"]*")*[^"]*$)')) + 1
    lost = [F.when(F.col(f"_t.f{i}").isNotNull() & F.col(f"`{f.name}`").isNull(), F.lit(f.name)) for i, f in enumerate(schema.fields)]
    df = rejected.withColumn("_t", split).select(
        F.col("_file").alias("source_file"), F.col("_record").alias("record"), n_fields.alias("n_fields"),
        F.array_compact(F.array(*lost)).alias("bad_fields"))
    expected = len(schema.fields)
    reason = F.concat_ws("; ", F.when(F.col("n_fields") != expected, F.concat(F.col("n_fields").cast("string"), F.lit(f" of {expected} fields"))),
                         F.when(F.size("bad_fields") > 0, F.concat(F.lit("not readable: "), F.array_join("bad_fields", ", "))))
    return df.withColumn("reason", reason)


def reject_summary(checked: CheckedCsv) -> DataFrame:
    """How many records were accepted, and how many rejected for each reason."""
    accepted = checked.rows.agg(F.lit("accepted").alias("outcome"), F.count(F.lit(1)).alias("records"))
    return accepted.unionByName(checked.rejects.groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("records")))


# ---------------------------------------------------------- monthly partitions
class MonthlyExtract:
    """S5 + P12 as a table of monthly partitions, kept up to date month by month.

    A full extract rewrites a year each day; this one rewrites only months that are missing or may
    still change.  A reload replaces the partitions of its months and leaves the files of all others as they
    are.  Reads are by month, so they list and open only the folders they need."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, date_col: str = "date"):
        self.spark, self.path, self.schema, self.date_col = spark, path.rstrip("/"), schema, date_col

    @staticmethod
    def window(as_of: dt.date, months: int) -> list[str]:
        """The month of ``as_of`` and the ``months`` before it."""
        last = as_of.year * 12 + as_of.month - 1
        return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(last - months, last + 1)]

    def _of(self, months: list[str]) -> Column:
        """Rows of the given months as ranges on the raw date column, so that a scan can prune by it."""
        runs: list[list[str]] = []
        for m in sorted(set(months)):
            if runs and self._after(runs[-1][1]) == m:
                runs[-1][1] = m
            else:
                runs.append([m, m])
        c = F.col(self.date_col)
        out = F.lit(False)
        for a, b in runs:
            out = out | (c >= F.lit(f"{a}-01").cast("date")) & (c < F.lit(f"{self._after(b)}-01").cast("date"))
        return out

    @staticmethod
    def _after(month: str) -> str:
        return MonthlyExtract.window(dt.date(int(month[:4]), int(month[5:]), 1) + dt.timedelta(days=32), 0)[0]

    def stored_months(self) -> list[str]:
        """The months on disk, from the folder names."""
        where, fs = self._at("")
        if not fs.exists(where):
            return []
        names = (s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory())
        return sorted(n.removeprefix("month=") for n in names if n.startswith("month="))

    def load(self, source: DataFrame, months: list[str]) -> None:
        """Replace the partitions of ``months`` by the rows that ``source`` has for them now; a month
        without rows has no partition afterwards."""
        rows = source.filter(self._of(months)).select(*(F.col(f"`{f.name}`") for f in self.schema.fields))
        rows = rows.withColumn("month", F.date_format(self.date_col, "yyyy-MM"))
        # months together, large ones split by size at run time; the write tells which months had rows
        seen = Observation()
        rows = rows.hint("rebalance", "month").observe(seen, F.collect_set("month").alias("months"))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .option("compression", "snappy").partitionBy("month").parquet(self.path))
        self.drop([m for m in months if m not in (seen.get["months"] or [])])

    def drop(self, months: list[str]) -> None:
        for m in months:
            where, fs = self._at(f"/month={m}")
            fs.delete(where, True)

    def refresh(self, source: DataFrame, as_of: dt.date, months: int = 12, open_months: int = 1) -> list[str]:
        """Bring the extract to the window of ``as_of``: load the months it lacks and the last
        ``open_months`` before the current one, which may still change; drop those before the window."""
        window, stored = self.window(as_of, months), self.stored_months()
        due = [m for m in window if m not in stored or m in window[-1 - open_months:]]
        self.load(source, due)
        self.drop([m for m in stored if m < window[0]])
        return due

    def read(self, months: list[str] | None = None) -> DataFrame:
        """All months, or some, with their ``month``."""
        fields = T.StructType([*self.schema.fields, T.StructField("month", T.StringType())])
        if not self.stored_months():
            return self.spark.createDataFrame([], fields)
        df = self.spark.read.schema(fields).parquet(self.path)
        return df if months is None else df.filter(F.col("month").isin(list(months)))

    def _at(self, below: str):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path + below)
        return where, where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
