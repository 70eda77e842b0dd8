"""Importance resampling: draw documents whose hashed n-grams look like a target's.

Features are all runs of one to ``longest`` consecutive words of a document (lower-cased A-Z, words of
digits, a-z and all beyond ASCII), joined by one space; a feature's bucket is the CRC-32 of its bytes modulo
``buckets``.  The corpus' and the target's bucket counts give every bucket a gain, a document weighs
the floored mean gain of its features, and Gumbel noise from its doc_id turns the weights into a draw
without replacement: the highest scores are taken.

A batch's texts are joined by a sentinel byte that no UTF-8 text holds; one pass of a regular
expression finds all words and sentinels.  The sentinels give the offsets of the documents among the
words, a search in them tells the document of each word, and n-grams that cross from one document into
the next are masked before they are counted.  The CRC of an n-gram follows from those of its parts
(CRC-32 is linear), so that no n-gram is ever spelled out.

Both passes read whole texts and shuffle bucket counts only.  Ranks come from a range-partitioned sort of
numbers (no texts): equal keys are split by a row number, and where a range begins in the whole is the
running sum over the ranges.

A null or wordless text has no features, weight 0 and is not drawn, like all texts under the least
number of words.  A missing doc_id counts as an empty one in the hash and comes last among ties; rows that
repeat a doc_id are ordered by n_features and weight and each have a rank.  An empty table gives no
rows; an empty target or corpus counts zero in every bucket."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as t

from .common import pieces, text_bytes, written
from .text import sums

#: A byte that UTF-8 never has; it is the sentinel, and any in a malformed text becomes another.
SENTINEL = b"\xff"
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else min(b, 0xFE) for b in range(256))
TOKEN = re.compile(rb"[0-9a-z\x80-\xfe]+|\xff")
#: Word bytes up to which a CRC is carried on by tables, and bytes of words that a worker remembers.
TABLED, REMEMBERED = 64, 64 << 20
#: The polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320


def shift_tables(longest: int) -> np.ndarray:
    """What ``n`` more bytes do to a CRC: tables[n][k] maps its k-th byte, the four results are XORed."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, step >> 1 ^ np.uint32(POLYNOMIAL), step >> 1)
    tables = np.empty((longest + 1, 4, 256), np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, longest + 1):
        tables[n] = step[tables[n - 1] & 0xFF] ^ (tables[n - 1] >> 8)
    return tables


class Words(dict):
    """Numbers of words, from 1; 0 is the sentinel.  Remembers CRCs for later batches."""

    def __init__(self):
        self.tables = shift_tables(TABLED + 1)
        self.reset()

    def reset(self) -> None:
        self.clear()
        self[SENTINEL] = 0
        self.words, self.bytes = [SENTINEL], 0
        self.crc = self.spaced = self.length = np.zeros(0, np.uint32)

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        self.bytes += len(word)
        return number

    def split(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The word numbers of folded texts, and the offsets of the texts among them."""
        if self.bytes > REMEMBERED:
            self.reset()
        found = TOKEN.findall(SENTINEL.join([*texts, b""]))
        numbers = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
        new = self.words[len(self.crc):]
        # with the space before it, as it continues an n-gram
        self.crc = np.append(self.crc, np.fromiter(map(zlib.crc32, new), np.uint32, len(new)))
        self.spaced = np.append(self.spaced, np.fromiter((zlib.crc32(b" " + w) for w in new), np.uint32, len(new)))
        self.length = np.append(self.length, np.fromiter(map(len, new), np.uint32, len(new)))
        ends = np.flatnonzero(numbers == 0)
        return numbers[numbers != 0], np.concatenate(([0], ends - np.arange(len(ends))))

    def carried(self, crc: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The CRCs of n-grams that are longer by a space and a word."""
        n = self.length[word]
        shift = np.minimum(n, TABLED) + 1
        out = self.spaced[word]
        for k in range(4):
            out = out ^ self.tables[shift, k, crc >> np.uint32(8 * k) & np.uint32(0xFF)]
        for i in np.flatnonzero(n > TABLED).tolist():
            out[i] = zlib.crc32(b" " + self.words[word[i]], int(crc[i]))
        return out


_WORDS: list[Words] = []


def features(batch: pa.Array, longest: int, buckets: int) -> Iterator[tuple[int, int, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """For each slice lo..hi of a batch of texts: its word offsets, and for each n-gram length the
    bucket of every n-gram and the n + 1 offsets of the texts among them."""
    if not _WORDS:
        _WORDS.append(Words())
    words = _WORDS[0]
    raw, at = text_bytes(batch)
    for lo, hi in pieces(at):
        folded, local = raw[at[lo]:at[hi]].tobytes().translate(FOLD), (at[lo:hi + 1] - at[lo]).tolist()
        numbers, offsets = words.split([folded[a:b] for a, b in zip(local[:-1], local[1:])])
        document = np.searchsorted(offsets, np.arange(len(numbers)), side="right")
        crc, found = words.crc[numbers], []
        for n in range(longest):
            if n:
                crc = words.carried(crc[:-1], numbers[n:])
            inside = document[:len(crc)] == document[n:]
            found.append(((crc[inside] % np.uint32(buckets)).astype(np.int64), np.concatenate(([0], np.cumsum(inside)))[np.minimum(offsets, len(crc))]))
        yield lo, hi, offsets, found


def bucket_counts(docs: DataFrame, longest: int = 2, buckets: int = 10_000) -> np.ndarray:
    """How many features of all texts fall into each bucket; tasks send one row a bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for *_, found in features(batch.column(0), longest, buckets):
                for bucket, _ in found:
                    counts += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of each bucket's smoothed shares in target and corpus, floored."""
    n = len(corpus)
    above = (target + 1).astype(float) * float(corpus.sum() + n)
    below = (corpus + 1).astype(float) * float(target.sum() + n)
    return np.floor(1000 * np.log(above / below)).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, longest: int = 2, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` (as c0, c1, ...), n_words, n_features and weight of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, offsets, found in features(batch.column(0), longest, len(gain)):
                n = sum(np.diff(at) for _, at in found)
                total = sum(sums(gain[bucket], at) for bucket, at in found)
                own = [np.diff(offsets), n, np.where(n > 0, total // np.maximum(n, 1), 0)]
                kept = batch.slice(lo, hi - lo).columns[1:]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x.astype(np.int64)) for x in own)], names)

    some = docs.select("text", *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)))
    numbers = ["n_words", "n_features", "weight"]
    names = [f"c{i}" for i in range(len(carry))] + numbers
    return some.mapInArrow(run, t.StructType([*some.schema.fields[1:], *(t.StructField(c, t.LongType()) for c in numbers)]))


def with_score(df: DataFrame, doc_id: str, seed: int) -> DataFrame:
    """``score``: the weight and 1000 times a standard Gumbel variate from the doc_id, floored."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return df.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))))


def ranked(rows: DataFrame, doc_id: str, percent: int, least_words: int) -> DataFrame:
    """``rank`` of the drawn among the written ``rows``; null for the others."""
    order = [F.desc("score"), F.asc_nulls_last(doc_id), F.asc("n_features"), F.asc("weight"), F.asc("row")]
    fit = F.col("n_words") >= least_words
    dealt = rows.where(fit).withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            place = pa.array(np.arange(before, before + batch.num_rows, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, place], [*batch.schema.names, "place"])
            before += batch.num_rows

    schema = t.StructType([*dealt.schema.fields, t.StructField("place", t.LongType())])
    placed = written(dealt.mapInArrow(number, schema).withColumn("part", F.spark_partition_id()), "importance-ranks")
    # one row for each range
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))
    begin = sizes.select(F.col("part").alias("p"), (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("begin"), F.sum("n").over(W.partitionBy()).alias("all"))
    rank = F.col("begin") + F.col("place") + 1
    drawn = placed.join(begin, F.col("part") == F.col("p")).withColumn("rank", F.when(rank <= F.floor(percent * F.col("all") / 100), rank))
    return drawn.select(*rows.columns, "rank").unionByName(rows.where(~fit).withColumn("rank", F.lit(None).cast("long")))


def importance(docs: DataFrame, target: DataFrame, longest: int = 2, buckets: int = 10_000, percent: int = 25, least_words: int = 20, seed: int = 7, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``carry``, of which the first is the document's id, with n_words, n_features,
    weight, score and rank of every document; undrawn ones have no rank."""
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    rows = written(with_score(weighted(docs, gain, longest, carry), "c0", seed), "importance")
    own = ["n_words", "n_features", "weight", "score", "rank"]
    return ranked(rows, "c0", percent, least_words).select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(carry)), *own)


def resampled(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The drawn rows of ``docs``, with all their columns."""
    carry = (doc_id, *(c for c in docs.columns if c != doc_id))
    renamed = docs.select(F.col("text"), *(F.col(f"`{c}`").alias(f"in_{c}") for c in carry))
    out = importance(renamed, target, carry=tuple(f"in_{c}" for c in carry), **options)
    return out.where("rank IS NOT NULL").select(*(F.col(f"`in_{c}`").alias(c) for c in docs.columns))
