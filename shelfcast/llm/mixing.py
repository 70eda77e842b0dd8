"""Mixing sources to target weights with hash-threshold histograms.

Each source gets a target number of words.  It is met by whole repeats of the source plus, for the
rest, the documents whose hash lies below the source's threshold.  The threshold is found without
a sort: words are summed by source and leading hash digits, the nested budget picks the boundary
bucket, and only that bucket is summed again by the next digits, until it holds one row.

Hashes come from md5 of doc_id and text, so reruns agree.  Rows that are equal in both are told apart by
their place in the written table, as further digits: first its partition, then the row in it.  Which of the equal
rows are taken may differ between runs, how many cannot, as they have one size.  A null text has size 0 and is equal to
an empty one; a missing doc_id is an empty one; sources are ordered by code point with null last, and a null
source is a source like any other.  An empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import protected, restored, running_sums, written

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
#: Most times that a document is taken.
MOST = 3
#: Hex digits of the hash, of a partition's number and of a row's in its partition.
HASH, PARTITION, ROW = 12, 8, 9
#: Digits known after each histogram: 4,096 buckets a source, one a partition, then the rows of one partition.
DEPTHS = (3, 6, 9, HASH, HASH + PARTITION, HASH + PARTITION + 6, HASH + PARTITION + ROW)
#: Sources up to which their thresholds (some 100 bytes each) are broadcast.
MOST_SOURCES = 100_000


def hashed(docs: DataFrame) -> DataFrame:
    """``docs`` with h: digits of the hash of doc_id and text, then of the row's place.  To be
    written before it is used more than once."""
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.col("text"), F.lit("")))
    place = F.monotonically_increasing_id()
    digits = lambda n, width: F.lpad(F.lower(F.hex(n)), width, "0")
    return docs.withColumn("h", F.concat(F.substring(F.md5(key), 1, HASH), digits(F.shiftright(place, 33), PARTITION), digits(place.bitwiseAND(F.lit((1 << 33) - 1)), ROW)))


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with size, the words of the text."""
    return docs.withColumn("size", F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, size): shares of all words by weight, no target
    above ``most`` times its source, the excess shared again by weight.

    The fixed point gives weight w the words min(most * size, w * level).  With the sources in the
    order of most * size / w the capped ones come first, so the level is found by running sums,
    over ranges of the sources."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = running_sums(per, [F.asc_nulls_last("source")], [], "mix-sources").withColumnRenamed("place", "number")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("number", F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("w", weight.cast("long")).withColumn("cap", most * F.col("source_size"))
    per = running_sums(per, [F.asc(F.col("cap") / F.col("w")), F.asc("number")], ["cap", "w"], "mix-order")
    whole = per.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n"), F.coalesce(F.sum("w"), F.lit(0)).alias("w")).first()
    left_n, left_w = F.lit(whole.n) - F.col("before_cap"), F.lit(whole.w) - F.col("before_w")
    per = per.withColumn("left_n", left_n).withColumn("left_w", left_w).withColumn("open", F.col("cap") * F.col("left_w") >= F.col("w") * F.col("left_n"))
    # where the first open source stands; there is one, as the last is open by itself or all words are 0
    level = per.where("open").agg(F.min_by(F.struct("left_n", "left_w"), "place").alias("x")).first().x
    target = F.col("cap").cast("double")
    if level is not None:
        target = F.when(F.col("open"), F.col("w") * F.lit(level.left_n) / F.lit(level.left_w)).otherwise(target)
    return per.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def few(edges: DataFrame, bound: int) -> DataFrame:
    """``edges`` broadcast while they are within the bound; beyond it Spark plans a shuffle and splits
    hot sources."""
    return F.broadcast(edges) if edges.count() <= bound else edges


def thresholds(narrow: DataFrame, targets: DataFrame, most: int = MOST, bound: int = MOST_SOURCES) -> DataFrame:
    """(source, repeats, below, source_size, target): the documents of a source are taken
    ``repeats`` times, and once more if their hash is less than ``below``.

    Each round sums the words of the current boundary bucket by its next digits; the rows that meet in a group are
    buckets: 4,096 a source, or as many as partitions.  Rounds end when every boundary bucket is one row."""
    at = targets.withColumn("repeats", F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(F.lit(0)).cast("long"))
    at = at.withColumn("budget", F.col("target") - F.col("repeats") * F.col("source_size")).withColumn("prefix", F.lit(""))
    for depth in DEPTHS:
        edge = at.select(F.col("source").alias("s"), F.col("prefix").alias("p"), "budget")
        some = narrow if depth == DEPTHS[0] else narrow.join(few(edge.drop("budget"), bound), F.col("source").eqNullSafe(F.col("s")) & F.col("h").startswith(F.col("p")))
        hist = some.groupBy("source", F.substring("h", 1, depth).alias("bucket")).agg(F.sum("size").alias("n"), F.count("*").alias("rows"))
        running = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
        hist = hist.join(edge, F.col("source").eqNullSafe(F.col("s"))).withColumn("before", F.sum("n").over(running) - F.col("n"))
        crossing = (hist.where(F.col("before") <= F.col("budget"))
                        .groupBy("source").agg(F.max_by(F.struct("bucket", "before", "n", "rows"), "bucket").alias("x")))
        at = (at.alias("a").join(crossing.withColumnRenamed("source", "c"), F.col("source").eqNullSafe(F.col("c")), "left")
                .select("source", "source_size", "target", "repeats", (F.col("budget") - F.coalesce(F.col("x.before"), F.lit(0))).alias("budget"),
                        F.coalesce("x.bucket", "prefix").alias("prefix"), F.coalesce("x.n", F.lit(0)).alias("n"), F.coalesce("x.rows", F.lit(0)).alias("rows")))
        at = written(at, "mix-edge")
        if (at.agg(F.max("rows")).first()[0] or 0) <= 1:
            break
    # the last bucket is one row: taken if that comes nearer to the budget
    below = F.when(F.col("budget") * 2 > F.col("n"), F.concat("prefix", F.lit("~"))).otherwise(F.col("prefix"))
    return at.select("source", "source_size", "target", "repeats", below.alias("below"))


def with_edges(rows: DataFrame, edges: DataFrame, most: int, bound: int = MOST_SOURCES) -> DataFrame:
    """``rows`` (source, h, ...) with source_size, target and copies."""
    rows = rows.join(few(edges.withColumnRenamed("source", "edge_source"), bound), F.col("source").eqNullSafe(F.col("edge_source")))
    extra = (F.col("repeats") < most) & (F.col("h") < F.col("below"))
    return rows.withColumn("copies", F.col("repeats") + extra.cast("long")).drop("h", "edge_source", "repeats", "below")


def edges_of(narrow: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, bound: int = MOST_SOURCES) -> DataFrame:
    """The thresholds of the written rows (source, h, size)."""
    narrow = narrow.select("source", "h", "size")
    return thresholds(narrow, written(source_targets(narrow, weights, most), "mix-targets"), most, bound)


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, bound: int = MOST_SOURCES) -> DataFrame:
    """doc_id, size, source_size, target and taken (words that the mix takes) of every row."""
    narrow = written(hashed(sized(docs.select("doc_id", "source", "text"))).select("doc_id", "source", "h", "size"), "mix-sizes")
    rows = with_edges(narrow, edges_of(narrow, weights, most, bound), most, bound)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mixture itself: every row of ``docs`` as often as the mix takes it."""
    names = ("doc_id", "source", "text")
    rows = written(hashed(sized(protected(docs, *names))), "mix-rows")
    rows = with_edges(rows, edges_of(rows, weights, most), most)
    again = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    return restored(rows.where("copies > 0").select("*", again), docs, *names)
