"""Helpers shared by the operators of this subpackage: table reads, Arrow batches, written stages."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Text bytes that one task handles at a time; a longer text is a piece of its own.
PIECE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, deleted when the driver's JVM ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:16]}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, lineage cut, safe against
    lost executors."""
    path = stage_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stage(df: DataFrame) -> None:
    """Delete the written table behind ``df`` once nothing reads it any more."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        where = jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(conf).delete(where, True)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` for a function of one batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None:
                yield out
    return df.mapInArrow(run, schema)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; a null is an empty text."""
    column = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; every range has at least one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def protected(docs: DataFrame, *names: str) -> DataFrame:
    """``docs`` with all columns but ``names`` prefixed, so that none clashes with an operator's own."""
    return docs.select(*(F.col(f"`{c}`").alias(c if c in names else f"in_{c}") for c in docs.columns))


def restored(df: DataFrame, docs: DataFrame, *names: str) -> DataFrame:
    """The columns of ``docs`` under their own names, from a frame that came of ``protected``."""
    return df.select(*(F.col(f"`{c if c in names else 'in_' + c}`").alias(c) for c in docs.columns))


def running_sums(df: DataFrame, order: list[Column], columns: list[str], name: str) -> DataFrame:
    """``df`` with ``place`` (rows before, by ``order``, of which no two are equal) and for each column c
    ``before_c``, its sum over the rows before.

    Rows are dealt by ranges of the order and numbered inside their range; where a range begins is the running
    sum over the ranges, of which there is one row each."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = written(dealt.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), name)
    ones = dealt.withColumn("one", F.lit(1))
    sums = {"one": "place", **{c: f"before_{c}" for c in columns}}
    inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ones = ones.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(new) for c, new in sums.items()])
    ranges = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.withColumn("one", F.lit(1)).groupBy(F.col("part").alias("p")).agg(*[F.sum(c).alias(f"all_{c}") for c in sums])
    begin = totals.select("p", *[F.coalesce(F.sum(f"all_{c}").over(ranges), F.lit(0)).alias(f"begin_{c}") for c in sums])
    out = ones.join(begin, F.col("part") == F.col("p"))
    return out.select(*df.columns, *[(F.col(new) + F.col(f"begin_{c}")).alias(new) for c, new in sums.items()])


#: A key with more than one row in HOT, and at least OFTEN rows, is frequent; there are fewer than HOT of them,
#: whatever the table.
HOT, OFTEN = 10_000, 1000


def frequent(df: DataFrame, key: str, name: str, hot: int = HOT, often: int = OFTEN) -> DataFrame | None:
    """(hot): the keys of ``df`` that more than one row in ``hot`` has, written; None if there are none."""
    counts = written(df.groupBy(F.col(key).alias("hot")).agg(F.count("*").alias("n")), name)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    keys = counts.where((F.col("n") * hot > total) & (F.col("n") >= often)).select("hot")
    return None if keys.isEmpty() else keys


def dealt_join(left: DataFrame, right: DataFrame, key: str, to: str, hot: DataFrame | None, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` (unique by ``to``) on left.key = right.to, without a task that
    holds a frequent key: rows of the ``hot`` keys are joined where they are, with the few broadcast rows of
    ``right`` that they need, all others by shuffle."""
    on = F.col(key) == F.col(to)
    if hot is None:
        return left.join(right, on, how)
    hot = F.broadcast(hot)
    few = F.broadcast(right.join(hot, F.col(to) == F.col("hot"), "left_semi"))
    here = left.join(hot, F.col(key) == F.col("hot"), "left_semi").join(few, on, how)
    return here.unionByName(left.join(hot, F.col(key) == F.col("hot"), "left_anti").join(right, on, how))
