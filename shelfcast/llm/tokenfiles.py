"""Token ids of documents in ORC files, in ascending doc_id order, and reads back from them.

Documents are dealt by ranges of doc_id; each task sorts its range, encodes whole texts and writes
ORC.  ORC stores the ids as integers in run-length encoding inside stripes; every stripe has a row
index (minimum and maximum of each ROW_INDEX rows) and a Bloom filter on doc_id, so a read of some
documents skips files, stripes and row groups by their metadata, and a read of all is parallel by
stripe.

Each file carries its number ``part``; where a file's documents begin in the whole is the running
sum over files, of which there is one row each.

Byte-level encoding treats the pre-tokens of a text independently.  A text is cut where the
tokenizer's own pattern always begins a new pre-token, so equal cuts are encoded once and looked up
afterwards; the ids are those of the whole text.

A null text is empty and has only the end id.  Rows without a doc_id come first.  Rows that repeat
a doc_id stay, ordered by the hash of their text; equal ones may lie in several files.  An empty table gives no rows."""

from __future__ import annotations

import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import text as T
from .common import map_batches, pieces, stage_path, text_bytes, written

END = 2
#: Rows of an ORC row index entry and false-positive rate of the Bloom filters.
ROW_INDEX, FALSE_POSITIVES = 1000, 0.01
STRIPE_BYTES = 16 << 20
#: Distinct pieces that a worker remembers; beyond that it starts anew.
REMEMBERED = 1_500_000
#: Bytes of text encoded at a time.
BATCH_BYTES = 4 << 20
#: White space beyond ASCII, which the cuts do not know: texts that have some are encoded whole.
WIDE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: First bytes of those characters.
WIDE_HEADS = np.zeros(256, bool)
WIDE_HEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True
#: Classes of the tokenizer's pattern by byte.  Two-byte characters from U+00C0 to U+024F are
#: letters but for two; what is odd (other characters, apostrophes) is left to the tokenizer.
WHITE, LETTER, DIGIT, OTHER, ODD = range(5)
CLASSES = np.full(256, ODD, np.uint8)
CLASSES[:0x80] = OTHER
CLASSES[T.SPACE] = WHITE
CLASSES[0x30:0x3A] = DIGIT
CLASSES[0x41:0x5B] = CLASSES[0x61:0x7B] = CLASSES[0xC3:0xCA] = LETTER
CLASSES[0x27] = ODD


def cuts(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the pieces, which cover all of ``raw``, and which of them are odd.

    First each word with one white-space character before it, the rest of a run of white space, and
    the run at the end of a text; then, unless a piece is odd, its pre-tokens: runs of one class,
    a space with the run after it."""
    starts, ends, word_at = T.runs(raw, offsets, T.SPACE)
    row = T.row_of(word_at)
    before = offsets[:-1][row]
    inner = np.flatnonzero(row[1:] == row[:-1]) + 1
    before[inner] = ends[inner - 1]
    gap = starts - before
    some = np.diff(word_at) > 0
    tails = ends[word_at[1:][some] - 1]
    tails = tails[tails < offsets[1:][some]]
    full = offsets[:-1][np.diff(offsets) > 0]
    mark = np.zeros(len(raw), bool)
    for begin in (full, starts - np.minimum(gap, 1), before[gap > 1], tails):
        mark[begin] = True
    words = np.flatnonzero(mark)
    if not len(words):
        return words, np.zeros(0, bool)
    kind = CLASSES[raw]
    second = np.flatnonzero((raw[:-1] >= 0xC3) & (raw[:-1] <= 0xC9)) + 1
    kind[second] = LETTER
    signs = second[(raw[second - 1] == 0xC3) & ((raw[second] == 0x97) | (raw[second] == 0xB7))]
    kind[signs] = ODD
    odd = np.logical_or.reduceat(kind == ODD, words)
    inside = np.zeros(len(raw), bool)
    inside[1:] = (kind[1:] != kind[:-1]) & (kind[1:] != WHITE) & (raw[:-1] != 0x20)
    inside[np.repeat(odd, np.diff(np.append(words, len(raw))))] = False
    pieces = np.flatnonzero(mark | inside)
    return pieces, odd[np.searchsorted(words, pieces, "right") - 1]


class Encoder:
    """Encodes texts with a tokenizers file.

    Pieces are told apart by 64-bit hashes and remembered with their ids; a new piece is encoded by
    the tokenizer's model or, if odd, by the whole tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model, self.alphabet = self.tokenizer.model, str.maketrans(byte_alphabet())
        self.clear()

    def clear(self) -> None:
        self.known, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.bounds, self.n, self.size = np.zeros(1 << 18, np.int32), np.zeros(1 << 16, np.int64), 0, 0

    def piece(self, raw: bytes, odd: bool) -> list[int]:
        if odd:
            return self.tokenizer.encode(raw.decode(), add_special_tokens=False).ids
        return [t.id for t in self.model.tokenize(raw.decode("latin-1").translate(self.alphabet))]

    def learn(self, hashes: np.ndarray, pieces: list[bytes], odd: list[bool]) -> None:
        """Remember the ids of new pieces; ``hashes`` ascend."""
        got = list(map(self.piece, pieces, odd))
        ends = self.size + np.cumsum(np.fromiter(map(len, got), np.int64, len(got)))
        while len(self.bounds) < self.n + len(got) + 1:
            self.bounds = np.concatenate((self.bounds, np.zeros_like(self.bounds)))
        while len(self.ids) < ends[-1]:
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[self.size:ends[-1]] = np.fromiter(chain.from_iterable(got), np.int32, int(ends[-1] - self.size))
        self.bounds[self.n + 1:self.n + len(got) + 1] = ends
        where = np.searchsorted(self.known, hashes)
        self.known, self.at = np.insert(self.known, where, hashes), np.insert(self.at, where, np.arange(self.n, self.n + len(got)))
        self.n, self.size = self.n + len(got), int(ends[-1])

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows of a piece of texts, an end id after each, and the n + 1 offsets."""
        if self.n > REMEMBERED:
            self.clear()
        starts, odd = cuts(raw, offsets)
        ends = np.append(starts[1:], len(raw))[:len(starts)]
        hashes, first, piece = np.unique(T.span_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.known, hashes), max(0, self.n - 1))
        new = np.flatnonzero(self.known[place] != hashes) if self.n else np.arange(len(hashes))
        if len(new):
            flat = raw.tobytes()
            self.learn(hashes[new], [flat[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())], odd[first[new]].tolist())
        at = self.at[np.searchsorted(self.known, hashes)][piece] if len(hashes) else np.zeros(0, np.int64)
        begin, lengths = self.bounds[at], self.bounds[at + 1] - self.bounds[at]
        piece_end = np.concatenate(([0], np.cumsum(lengths)))
        n_before = np.searchsorted(starts, offsets)
        n_rows = len(offsets) - 1
        row_end = piece_end[n_before[1:]] + np.arange(1, n_rows + 1)
        out = np.empty(int(piece_end[-1]) + n_rows, np.int32)
        out[row_end - 1] = END
        order = np.arange(int(piece_end[-1]))
        row = np.repeat(np.arange(n_rows), np.diff(n_before))
        out[order + np.repeat(row, lengths)] = self.ids[order - np.repeat(piece_end[:-1] - begin, lengths)]
        return self.whole(raw, offsets, out, np.concatenate(([0], row_end)))

    def whole(self, raw: np.ndarray, offsets: np.ndarray, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put the ids of the whole text where a row has white space that the cuts do not know."""
        heads = np.flatnonzero(WIDE_HEADS[raw])
        rows = np.unique(np.searchsorted(offsets, heads, "right") - 1)
        rows = [r for r in rows.tolist() if WIDE.search(raw[offsets[r]:offsets[r + 1]].tobytes().decode())]
        if not rows:
            return ids, at
        parts = {r: np.array(self.tokenizer.encode(raw[offsets[r]:offsets[r + 1]].tobytes().decode(), add_special_tokens=False).ids + [END], np.int32) for r in rows}
        each = [parts.get(r, ids[at[r]:at[r + 1]]) for r in range(len(at) - 1)]
        return np.concatenate(each), np.concatenate(([0], np.cumsum([len(x) for x in each])))


def byte_alphabet() -> dict[int, int]:
    """The printable character that a byte-level vocabulary has for each byte: printable bytes stand
    for themselves, the others for the code points from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in plain)
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(others)}


_ENCODERS: dict[str, Encoder] = {}


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids) of the rows of each partition, in order."""
    def run(batches):
        # a worker keeps what it has learned for its next task
        if tokenizer not in _ENCODERS:
            _ENCODERS[tokenizer] = Encoder(tokenizer)
        encoder = _ENCODERS[tokenizer]
        for batch in batches:
            data, at = text_bytes(batch.column(1))
            for lo, hi in pieces(at, BATCH_BYTES):
                flat, ends = encoder.encode(data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))], ["doc_id", "ids"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def write_tokens(docs: DataFrame, tokenizer: str, path: str) -> None:
    """Write the ids of all ``docs`` as ORC files below ``path``."""
    # the place splits rows that are equal in both into several ranges
    order = ["doc_id", F.xxhash64("text"), "place"]
    dealt = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("place")).repartitionByRange(*order).sortWithinPartitions(*order)
    (encoded(dealt, tokenizer).withColumn("part", F.spark_partition_id())
        .withColumn("row", F.monotonically_increasing_id()).write
        .option("compression", "zstd").option("orc.create.index", "true").option("orc.row.index.stride", ROW_INDEX)
        .option("orc.stripe.size", STRIPE_BYTES).option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", FALSE_POSITIVES).orc(path))


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, ids, part, row) from the files; some ``doc_ids`` are found by metadata."""
    rows = spark.read.schema("doc_id long, ids array<int>, part int, row long").orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(doc_ids))


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column(1)
        at, flat = ids.offsets.to_numpy(), ids.values.to_numpy().astype("<u4", copy=False)
        crc = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1], at[1:])]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64()), batch.column(2), batch.column(3)], ["doc_id", "n_tokens", "ids_crc32", "part", "row"])

    rows = written(map_batches(read_tokens(spark, path), one, "doc_id long, n_tokens long, ids_crc32 long, part int, row long"), "token-index")
    whole = rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumnRenamed("part", "p")
    begin = whole.withColumn("begin", F.sum("n").over(W.orderBy("p")) - F.col("n")).drop("n")
    within = F.sum("n_tokens").over(W.partitionBy("part").orderBy("row").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n_tokens")
    placed = rows.withColumn("within", within).join(begin, F.col("part") == F.col("p"))
    return placed.select("doc_id", (F.col("begin") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the token files of ``docs`` to the shared folder and index them."""
    spark = docs.sparkSession
    path = stage_path(spark, "tokens")
    write_tokens(docs, tokenizer, path)
    return token_index(spark, path)
