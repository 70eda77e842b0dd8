"""Spark session helpers.

The library never creates its own cluster settings on a real deployment: every
function takes the caller's ``SparkSession``.  ``build_session`` exists for tests,
the bench and the local command line, and only fills settings that are unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators are designed around.  AQE re-plans joins at runtime
# (broadcast only when the measured side is small), coalesces tiny shuffle
# partitions and splits skewed ones, so a hot segment or product does not end
# up in one task.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "shelfcast", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is.  Only
    when it is unset (tests, a laptop) a fresh scratch folder is created.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            # a folder on the driver's disk is invisible to executors and lost with the driver
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. an object-store or HDFS path)")
        path = tempfile.mkdtemp(prefix="shelfcast-ckpt-", dir=os.environ.get("SHELFCAST_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_root(spark: SparkSession) -> str:
    """This application's folder for written intermediate tables, below the shared checkpoint
    folder.  ``clear_scratch`` removes it; the driver's JVM does so when it ends."""
    sc = spark.sparkContext
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{sc.applicationId}-tables"
    if root not in _ROOTS:
        _ROOTS.add(root)
        where, fs = _hadoop(spark, root)
        fs.mkdirs(where)
        fs.deleteOnExit(where)
    return root


def clear_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application; frames that read them end with it."""
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS `{_TABLES.pop()}`")
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}-tables"
    _ROOTS.discard(root)
    where, fs = _hadoop(spark, root)
    fs.delete(where, True)


_ROOTS: set[str] = set()
#: Bucketed stage tables in the catalog; their files lie in the scratch folder.
_TABLES: set[str] = set()


def _hadoop(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A place for a written intermediate table."""
    return f"{scratch_root(spark)}/{name}"


def materialize(df, name: str = "stage"):
    """Write a stage output as snappy parquet into the shared checkpoint folder and
    continue from that table (one pass, columnar, prunable; cuts the lineage).

    ``DataFrame.checkpoint()`` would compute its input twice unless it is also cached,
    and it stores serialised rows.  The folder is the one named by
    ``spark.checkpoint.dir`` -- never a machine-local temporary folder on a cluster."""
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:16]}")
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return spark.read.parquet(path)


def spread(df, *keys):
    """Deal rows by ``keys`` over all of ``spark.sql.shuffle.partitions``.

    AQE merges the partitions of its own exchanges by their compressed bytes, and keys that repeat compress
    to a byte or two a row: one task would then sort all rows.  It leaves a given number as it is, also
    for the other side of a join with these rows."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def materialize_bucketed(df, keys: list[str], name: str = "stage", buckets: int | None = None):
    """Write a stage output bucketed and sorted by ``keys`` and continue from that table.

    Groupings and joins by the keys (or by more than them) read it without an exchange, and merge
    joins without a sort, so a table that several consumers group or join by the same keys is shuffled
    once, here.  ``buckets`` defaults to ``spark.sql.shuffle.partitions``, the number that the other side
    of a join is shuffled to.  A row of the catalog holds the bucketing; the files are in the shared
    scratch folder.  Where the catalog outlives the session, ``clear_scratch`` at the job's end drops both."""
    import uuid
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex[:16]}"
    # dealt by the buckets' own hash: a bucket is one file, whatever the number of tasks before
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
       .option("compression", "snappy").option("path", scratch_path(spark, table)).format("parquet").saveAsTable(table))
    _TABLES.add(table)
    return spark.table(table)
