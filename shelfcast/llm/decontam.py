"""Benchmark decontamination by a prefix-filtered set join.

An item's windows of ``n`` consecutive words are sets of word shingles.  A document can contain a
window only if it has all its shingles, so for exact containment one necessary shingle is its prefix:
the first in the order of rarity over the whole corpus.

1. The windows of all items are distinct rows of a table, with their shingles.
2. One pass over the documents counts the shingles of windows.
3. Each window's rarest shingle becomes its prefix.
4. One pass over the documents finds the prefixes and sends each with the words around it.  They are joined with the
   windows on the prefix; length and position bound where the window can begin and end; the window is
   compared word by word.

Both passes look shingles up in a bit table of a fixed size first (a Bloom filter with one hash), so only shingles that
may matter leave a task; the join decides.  Neither the number of passes nor what is broadcast depends on the
number of windows: the prefixes themselves are broadcast up to a bound, and beyond it both sides are salted
and shuffled.  The items of a document are looked up once for each distinct set of windows found, not for each
document.  What one document holds (its hits) is grouped in one row, as its text is; so is the list of items that
share a window, which is as long as the benchmark at most.

Null and empty texts have no words: such documents are clean, such items have no window.  Items of
fewer than ``n`` words are one window.  Repeated rows get equal results; an item without an item_id
still marks words but is not counted or listed.  Empty tables give empty or all-clean results."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t

from . import text as T
from .common import pieces, protected, restored, text_bytes, written

WINDOW = 10
#: Words of a shingle.
SHINGLE = 3
#: Bits of the table of shingles: 16 MB, whatever the benchmark.
FILTER_BITS = 27
#: Windows (about 150 bytes each) up to which the prefixes are broadcast, and copies of a prefix beyond it.
MOST_WINDOWS, SALT = 200_000, 16
#: Contaminated rows (8 bytes each) up to which their numbers are broadcast.
MOST_ROWS = 1_000_000


def words_of(batch_column: pa.Array):
    """Pieces of a text column: (first row, last row, lower-cased bytes, starts, ends, word offsets)."""
    data, at = text_bytes(batch_column)
    for lo, hi in pieces(at):
        part = T.lower_ascii(data[at[lo]:at[hi]])
        yield lo, hi, part, *T.runs(part, at[lo:hi + 1] - at[lo], T.NOT_ALNUM)


def spelled(part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    return [part[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist())]


# -- the benchmark's side

def windows(items: DataFrame, n: int = WINDOW) -> DataFrame:
    """(item, window, length, shingles): all windows of all items, a window being its words joined by spaces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, part, starts, ends, word_at in words_of(batch.column(1)):
                item, words, hashes = batch.column(0).slice(lo, hi - lo).to_pylist(), spelled(part, starts, ends), T.span_hashes(part, starts, ends)
                out = []
                for row, (a, b) in enumerate(zip(word_at[:-1].tolist(), word_at[1:].tolist())):
                    size, length = min(b - a, SHINGLE), min(b - a, n)
                    key = T.ngram_hashes(hashes[a:b], size).view(np.int64).tolist() if b > a else []
                    out += [(item[row], " ".join(words[k:k + length]), length, key[k - a:k - a + length - size + 1]) for k in range(a, b - length + 1) if b > a]
                columns = list(zip(*out)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.string(), pa.string(), pa.int32(), pa.list_(pa.int64())))], ["item", "window", "length", "shingles"])
    return items.select(F.col("item_id").cast("string").alias("item"), "text").mapInArrow(run, "item string, window string, length int, shingles array<long>")


class Bits:
    """A table of FILTER_BITS bits, one hash: which shingles may be among those it was made from."""

    def __init__(self, packed: np.ndarray, sizes: tuple[int, ...]):
        self.packed, self.sizes = packed, sizes

    @classmethod
    def of(cls, shingles: DataFrame, sizes: tuple[int, ...]) -> Bits:
        """From a column ``shingle``; the driver gets the table's set pages, of 4 KB each."""
        place = F.shiftrightunsigned("shingle", 64 - FILTER_BITS) + 1
        pages = shingles.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
        packed = np.zeros(1 << FILTER_BITS >> 3, np.uint8)
        for r in pages.collect():
            packed[(r.page - 1) * 4096:r.page * 4096] = np.frombuffer(r.bits, np.uint8)
        return cls(packed, sizes)

    def found(self, words: np.ndarray, word_at: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, first words, shingles) of those in the table, within the rows."""
        for size in self.sizes:
            places = T.window_starts(word_at, size)
            keys = T.ngram_hashes(words, size)[places]
            bit = keys >> np.uint64(64 - FILTER_BITS)
            here = self.packed[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1 > 0
            yield size, places[here], keys[here]


# -- the documents' side

def shingle_counts(docs: DataFrame, bits: Bits) -> DataFrame:
    """(shingle, n) over all documents, for shingles in the table; summed in each batch before the shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, part, starts, ends, word_at in words_of(batch.column(0)):
                words = T.span_hashes(part, starts, ends)
                keys, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *(k for _, _, k in shared.value.found(words, word_at))]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["shingle", "n"])
    return docs.select("text").mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))


def prefixes(distinct: DataFrame, counts: DataFrame) -> DataFrame:
    """(window, length, shingle, offset): of each window the shingle that is rarest, the first of equals."""
    each = distinct.select("window", "length", F.posexplode("shingles").alias("offset", "shingle")).join(counts, "shingle", "left")
    rarest = F.min_by(F.struct("shingle", "offset"), F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset"))
    return each.groupBy("window", "length").agg(rarest.alias("p")).select("window", "length", "p.shingle", "p.offset")


def candidates(docs: DataFrame, bits: Bits, carry: tuple[str, ...], n: int) -> DataFrame:
    """The columns ``carry``, n_words, and ``found``: where a prefix may begin, with the words around it."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    some = docs.select(F.col("text").alias("decontam_text"), *(F.col(f"`{c}`") for c in carry))
    kind = pa.struct([("at", pa.int32()), ("shingle", pa.int64()), ("base", pa.int32()), ("words", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, part, starts, ends, word_at in words_of(batch.column(0)):
                hashes, found = T.span_hashes(part, starts, ends), [[] for _ in range(hi - lo)]
                for _, places, keys in shared.value.found(hashes, word_at):
                    rows = np.searchsorted(word_at, places, "right") - 1
                    for p, key, row in zip(places.tolist(), keys.view(np.int64).tolist(), rows.tolist()):
                        a, b = max(int(word_at[row]), p - n + 1), min(int(word_at[row + 1]), p + n)
                        first = int(word_at[row])
                        found[row].append((p - first, key, a - first, spelled(part, starts[a:b], ends[a:b])))
                cells = pa.array([[dict(zip(("at", "shingle", "base", "words"), f)) for f in own] for own in found], pa.list_(kind))
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns[1:], pa.array(np.diff(word_at).astype(np.int64)), cells], [*batch.schema.names[1:], "n_words", "found"])

    cell = t.StructType().add("at", t.IntegerType()).add("shingle", t.LongType()).add("base", t.IntegerType()).add("words", t.ArrayType(t.StringType()))
    return some.mapInArrow(run, t.StructType([*some.schema.fields[1:], t.StructField("n_words", t.LongType()), t.StructField("found", t.ArrayType(cell))]))


def verified(found: DataFrame, prefix: DataFrame, most: int = MOST_WINDOWS) -> DataFrame:
    """(row, start, length, window) of every occurrence: prefix joined, bounds applied, words compared."""
    each = found.select("row", "n_words", F.explode("found").alias("f")).select("row", "n_words", "f.*")
    if prefix.count() <= most:
        met = each.join(F.broadcast(prefix), "shingle")
    else:
        salted = prefix.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        met = each.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALT)).cast("int")).join(salted, ["shingle", "salt"])
    start = F.col("at") - F.col("offset")
    # the order matters: a slice needs a start within the words sent
    inside = (start >= 0) & (start + F.col("length") <= F.col("n_words")) & (start >= F.col("base"))
    same = F.when(inside, F.array_join(F.slice("words", F.greatest(start - F.col("base") + 1, F.lit(1)), F.col("length")), " ") == F.col("window")).otherwise(False)
    return met.where(same).select("row", start.alias("start"), "length", "window")


def covered(spans: F.Column) -> F.Column:
    """How many words lie in the union of (start, length) spans, given in order."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def add(acc, s):
        end = F.greatest(acc["end"], (s["start"] + s["length"]).cast("long"))
        return F.struct((acc["n"] + end - F.greatest(acc["end"], s["start"].cast("long"))).alias("n"), end.alias("end"))
    return F.aggregate(spans, zero, add, lambda acc: acc["n"])


def contamination(docs: DataFrame, items: DataFrame, carry: tuple[str, ...] = ("doc_id",), n: int = WINDOW, most: int = MOST_WINDOWS) -> DataFrame:
    """Every row of ``docs`` with the columns ``carry``, n_words, n_hit, n_items, items_sha256 and
    contaminated."""
    spark: SparkSession = docs.sparkSession
    own = written(windows(items, n), "decontam-windows")
    distinct = written(own.select("window", "length", "shingles").dropDuplicates(["window"]), "decontam-distinct")
    sizes = tuple(sorted({min(r.length, SHINGLE) for r in distinct.select("length").distinct().collect()}))
    all_bits = Bits.of(distinct.select(F.explode("shingles").alias("shingle")), sizes)
    prefix = written(prefixes(distinct, shingle_counts(docs, all_bits)), "decontam-prefixes")
    some = candidates(docs, Bits.of(prefix.select("shingle"), sizes), carry, n)
    rows = written(some.withColumn("row", F.monotonically_increasing_id()), "decontam-rows")
    hits = verified(rows.where(F.size("found") > 0), prefix, most)
    per_row = hits.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"), F.array_sort(F.collect_set("window")).alias("windows"))
    per_row = written(per_row.select("row", covered(F.col("spans")).alias("n_hit"), "windows", F.sha2(F.array_join("windows", "\n"), 256).alias("set")), "decontam-hits")
    # each distinct set of windows once
    sets = per_row.select("set", "windows").dropDuplicates(["set"]).select("set", F.explode("windows").alias("window"))
    owners = own.where("item IS NOT NULL").select("item", "window").distinct()
    listed = sets.join(owners, "window").groupBy("set").agg(F.array_sort(F.collect_set("item")).alias("ids"))
    listed = listed.select("set", F.size("ids").cast("long").alias("n_items"), F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"))
    result = per_row.select("row", "n_hit", "set").join(listed, "set", "left").drop("set")
    columns = [F.col(f"`{c}`") for c in carry]

    def out(df: DataFrame, n_hit, n_items, sha) -> DataFrame:
        return df.select(*columns, "n_words", n_hit.alias("n_hit"), n_items.alias("n_items"), sha.alias("items_sha256"), (n_hit > 0).alias("contaminated"))
    zero, none = F.lit(0).cast("long"), F.sha2(F.lit(""), 256)
    maybe = rows.where(F.size("found") > 0).drop("found").withColumnRenamed("row", "decontam_row").join(result, F.col("decontam_row") == F.col("row"), "left")
    return out(rows.where(F.size("found") == 0), zero, zero, none).unionByName(
        out(maybe, F.coalesce("n_hit", zero), F.coalesce("n_items", zero), F.coalesce("items_sha256", none)))


def clean(docs: DataFrame, items: DataFrame, few: int = MOST_ROWS) -> DataFrame:
    """The rows of ``docs`` that hold no window of an item.

    The rows are written with a number, and only that goes through the search; the numbers of contaminated
    rows come back, broadcast while there are at most ``few``."""
    names = ("doc_id", "text")
    rows = written(protected(docs, *names).withColumn("decontam_id", F.monotonically_increasing_id()), "decontam-docs")
    found = contamination(rows, items, ("decontam_id",), WINDOW).where("contaminated").select(F.col("decontam_id").alias("gone"))
    found = written(found, "decontam-found")
    gone = F.broadcast(found) if found.count() <= few else found
    return restored(rows.join(gone, F.col("decontam_id") == F.col("gone"), "left_anti"), docs, *names)
