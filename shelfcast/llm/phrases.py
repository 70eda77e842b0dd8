"""Substring dedup with repeated-phrase automata.

A window of WINDOW words that occurs in several documents shares every phrase inside it, and so the
one phrase of PHRASE words that has the smallest hash.  Only those phrases (about one word in five)
are exchanged:

1. each group of documents sends its phrases to hash buckets, which confirm those that recur in
   other documents and send them back to the groups that hold them;
2. each group compiles its recurring phrases into an Aho-Corasick automaton, a shard of the whole,
   and streams its documents through it to locate every occurrence; windows around a located phrase
   go to hash buckets by 96-bit hash, which find the smallest doc_id of each;
3. each group removes the windows that begin in a document with a smaller doc_id.

The automaton finds what the group's own hashes found in step 1, and confirms it as text: a phrase is
compared byte by byte in the buckets and in the automaton, never by hash alone.

Documents are shuffled to groups once; Spark reuses that exchange in all three steps.  Which group a row is in
has no influence on the result; equal rows are dealt like others, by their place in the table, which is read from files
so that a task run again deals its rows alike.  Groups and
buckets have bounded sizes, and a group sends a phrase or window once however many of its documents
hold it, so a passage that a third of all documents share is one entry for each group.

Null and empty texts have no words.  A null doc_id counts as larger than all others.  Rows that
repeat a doc_id do not remove each other's words.  An empty table gives no rows."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import pieces, text_bytes

WINDOW, PHRASE = 13, 5
#: Bytes of text of a group of documents, and for each bucket of the exchanges.
GROUP_BYTES, BUCKET_BYTES = 12 << 20, 4 << 20
LEAST_BUCKETS = 64
NO_ID = np.iinfo(np.int64).max


# -- packed columns

def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes: sorted or small ones take few bytes."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T) if len(values) else b""
    return zstandard.ZstdCompressor(level=1).compress(bytes(planes))


def unpack(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel() if len(raw) else np.zeros(0, kind)


def pack_lines(lines: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"\n".join(lines))


def unpack_lines(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split(b"\n")


# -- one group of documents

class Words:
    """The words of some rows, joined by single spaces (also one before the first)."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        starts, ends, self.at = T.runs(raw, offsets, T.SPACE)
        self.hashes = T.span_hashes(raw, starts, ends)
        size = ends - starts + 1
        self.space = np.cumsum(size)  # place of the space after each word
        self.first = self.space - size + 1
        total = int(size.sum())
        source = np.arange(total) - np.repeat(self.first - 1, size) + np.repeat(starts, size)
        self.joined = np.full(total + 1, 0x20, np.uint8)
        if total:
            self.joined[1:] = raw[np.minimum(source, len(raw) - 1)]
            self.joined[self.space] = 0x20
        self.row = T.row_of(self.at)
        self.windows = T.window_starts(self.at, WINDOW)

    def phrase_of_window(self) -> np.ndarray:
        """For each window, the first word of its phrase: the leftmost of smallest hash."""
        h = T.ngram_hashes(self.hashes, PHRASE)
        best, place = h[self.windows], self.windows.copy()
        for j in range(1, WINDOW - PHRASE + 1):
            other = h[self.windows + j]
            less = other < best
            best[less], place[less] = other[less], self.windows[less] + j
        return place


def parts_of(table: pa.Table):
    """(first row, last row, Words) of the texts of a group, and its doc_ids."""
    column = table.column("text").combine_chunks() if table.num_rows else pa.array([], pa.string())
    raw, at = text_bytes(column if isinstance(column, pa.Array) else column.chunk(0))
    for lo, hi in pieces(at):
        yield lo, hi, Words(raw[at[lo]:at[hi]], at[lo:hi + 1] - at[lo])


def ids_of(table: pa.Table) -> np.ndarray:
    return table.column("doc_id").fill_null(NO_ID).to_numpy().astype(np.int64)


def group_phrases(table: pa.Table, buckets: int) -> pa.Table:
    """The group's distinct phrases by bucket, and which of them several of its documents hold."""
    hashes, rows, texts = [], [], []
    for lo, _, w in parts_of(table):
        place = np.unique(w.phrase_of_window())
        hashes.append(T.ngram_hashes(w.hashes, PHRASE)[place])
        rows.append(w.row[place] + lo)
        flat = w.joined.tobytes()
        texts += [flat[a:b] for a, b in zip(w.first[place].tolist(), w.space[place + PHRASE - 1].tolist())]
    if not texts:
        return pa.table({"bucket": pa.array([], pa.int32()), "grp": pa.array([], pa.int32()), "phrases": pa.array([], pa.binary()), "several": pa.array([], pa.binary())})
    h, row = np.concatenate(hashes), np.concatenate(rows)
    order = np.lexsort((row, h, h % np.uint64(buckets)))
    h, row = h[order], row[order]
    lead = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    several = np.maximum.reduceat(row, lead) > row[lead]
    bucket = (h[lead] % np.uint64(buckets)).astype(np.int32)
    cut = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket)]
    which = order[lead].tolist()
    return pa.table({
        "bucket": pa.array(bucket[cut[:-1]]), "grp": pa.array(np.full(len(cut) - 1, table.column("grp")[0].as_py(), np.int32)),
        "phrases": pa.array([pack_lines([texts[i] for i in which[a:b]]) for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
        "several": pa.array([np.packbits(several[a:b]).tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())})


def recurring(table: pa.Table) -> pa.Table:
    """Of the phrases of a bucket those that more than one document holds, back to their groups."""
    held, times = [], {}
    for phrases, several in zip(table.column("phrases").to_pylist(), table.column("several").to_pylist()):
        lines = unpack_lines(phrases)
        held.append(lines)
        for line, more in zip(lines, np.unpackbits(np.frombuffer(several, np.uint8)).tolist()):
            times[line] = times.get(line, 0) + 1 + more
    found = [[line for line in lines if times[line] > 1] for lines in held]
    some = [i for i, lines in enumerate(found) if lines]
    return pa.table({"grp": table.column("grp").take(pa.array(some, pa.int64())), "phrases": pa.array([pack_lines(found[i]) for i in some], pa.binary())})


def automaton(phrases: list[bytes]):
    """An Aho-Corasick automaton of whole-word phrases; bytes stand for characters."""
    import ahocorasick
    machine = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for p in phrases:
        machine.add_word(f" {p.decode('latin-1')} ")
    machine.make_automaton()
    return machine


def located(machine, w: Words) -> np.ndarray:
    """Which words begin an occurrence of one of the automaton's phrases."""
    found = np.zeros(len(w.hashes), bool)
    ends = np.fromiter((end for end, _ in machine.iter(w.joined.tobytes().decode("latin-1"))), np.int64)
    found[np.searchsorted(w.space, ends) - PHRASE + 1] = True
    return found


def second_hashes(words: np.ndarray) -> np.ndarray:
    return (T.ngram_hashes(T.mix(words ^ np.uint64(0xA5A5A5A55A5A5A5A)), WINDOW) >> np.uint64(32)).astype(np.uint32)


def group_windows(table: pa.Table, phrases: pa.Table, buckets: int) -> pa.Table:
    """The group's windows around recurring phrases by bucket, each with its smallest doc_id here."""
    empty = pa.table({"bucket": pa.array([], pa.int32()), "grp": pa.array([], pa.int32()), "h1": pa.array([], pa.binary()), "h2": pa.array([], pa.binary()), "doc": pa.array([], pa.binary())})
    lines = [line for data in phrases.column("phrases").to_pylist() for line in unpack_lines(data)]
    if not lines or not table.num_rows:
        return empty
    machine, ids = automaton(lines), ids_of(table)
    h1, h2, doc = [], [], []
    for lo, _, w in parts_of(table):
        if not len(w.windows):
            continue
        some = w.windows[located(machine, w)[w.phrase_of_window()]]
        h1.append(T.ngram_hashes(w.hashes, WINDOW)[some])
        h2.append(second_hashes(w.hashes)[some])
        doc.append(ids[lo + w.row[some]])
    if not sum(map(len, h1)):
        return empty
    h1, h2, doc = np.concatenate(h1), np.concatenate(h2), np.concatenate(doc)
    order = np.lexsort((doc, h2, h1, h1 % np.uint64(buckets)))
    h1, h2, doc = h1[order], h2[order], doc[order]
    lead = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
    h1, h2, doc = h1[lead], h2[lead], doc[lead]
    bucket = (h1 % np.uint64(buckets)).astype(np.int32)
    cut = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket)]
    spans = list(zip(cut[:-1].tolist(), cut[1:].tolist()))
    return pa.table({
        "bucket": pa.array(bucket[cut[:-1]]), "grp": pa.array(np.full(len(spans), table.column("grp")[0].as_py(), np.int32)),
        "h1": pa.array([pack(h1[a:b]) for a, b in spans], pa.binary()), "h2": pa.array([pack(h2[a:b]) for a, b in spans], pa.binary()),
        "doc": pa.array([pack(doc[a:b]) for a, b in spans], pa.binary())})


def earlier_elsewhere(table: pa.Table) -> pa.Table:
    """Of the windows of a bucket those that a smaller doc_id of another group holds, by group."""
    h1 = [unpack(x, np.uint64) for x in table.column("h1").to_pylist()]
    h2 = np.concatenate([unpack(x, np.uint32) for x in table.column("h2").to_pylist()])
    doc = np.concatenate([unpack(x, np.int64) for x in table.column("doc").to_pylist()])
    at, h1 = np.repeat(np.arange(len(h1)), list(map(len, h1))), np.concatenate(h1)
    order = np.lexsort((doc, h2, h1))
    a, b, d = h1[order], h2[order], doc[order]
    lead = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
    least = d[lead][np.cumsum(lead) - 1]
    gone = np.zeros(len(d), bool)
    gone[order] = d > least
    # the entries of a group lie together
    h1, cut = h1[gone], np.searchsorted(at[gone], np.arange(table.num_rows + 1)).tolist()
    sent = [(g, pack(h1[i:j])) for g, i, j in zip(table.column("grp").to_pylist(), cut[:-1], cut[1:]) if j > i]
    return pa.table({"grp": pa.array([g for g, _ in sent], pa.int32()), "h1": pa.array([x for _, x in sent], pa.binary())})


def group_result(table: pa.Table, gone: pa.Table) -> pa.Table:
    """doc_id, n_words, n_removed and kept_sha256 of the rows of a group."""
    elsewhere = np.sort(np.concatenate([np.zeros(0, np.uint64), *(unpack(x, np.uint64) for x in gone.column("h1").to_pylist())]))
    ids, n_words, n_removed, digests = ids_of(table), [], [], []
    every = [(lo, w) for lo, _, w in parts_of(table)]
    h = np.concatenate([np.zeros(0, np.uint64), *(T.ngram_hashes(w.hashes, WINDOW)[w.windows] for _, w in every)])
    doc = np.concatenate([np.zeros(0, np.int64), *(ids[lo + w.row[w.windows]] for lo, w in every)])
    order = np.lexsort((doc, h))
    lead = np.r_[True, h[order][1:] != h[order][:-1]] if len(h) else np.zeros(0, bool)
    removed = np.zeros(len(h), bool)
    if len(h):
        removed[order] = doc[order] > doc[order][lead][np.cumsum(lead) - 1]
    if len(elsewhere):
        removed |= elsewhere[np.minimum(np.searchsorted(elsewhere, h), len(elsewhere) - 1)] == h
    at = 0
    for _, w in every:
        drop = T.covered(w.windows[removed[at:at + len(w.windows)]], WINDOW, len(w.hashes))
        at += len(w.windows)
        n_words.append(np.diff(w.at))
        n_removed.append(T.sums(drop, w.at))
        size = w.space - w.first + 1
        kept = w.joined[1:][np.repeat(~drop, size)].tobytes()
        bound = np.concatenate(([0], np.cumsum(np.where(drop, 0, size))))[w.at].tolist()
        digests += [hashlib.sha256(kept[a:max(a, b - 1)]).hexdigest() for a, b in zip(bound[:-1], bound[1:])]
    if not table.num_rows:
        n_words = n_removed = [np.zeros(0, np.int64)]
    return pa.table({"doc_id": table.column("doc_id").combine_chunks(), "n_words": np.concatenate(n_words).astype(np.int64), "n_removed": np.concatenate(n_removed).astype(np.int64), "kept_sha256": pa.array(digests, pa.string())})


def without_repeats(docs: DataFrame, group_bytes: int = GROUP_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of ``docs``."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(3 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // group_bytes))
    buckets = max(LEAST_BUCKETS, -(-total // bucket_bytes))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("place"))
    # the place deals rows that are equal in both columns to different groups
    grouped = rows.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text", "place"), F.lit(groups)).cast("int").alias("grp")).repartition(max(1, groups // 3), "grp")
    by_group = grouped.groupBy("grp")
    phrases = (by_group.applyInArrow(lambda t: group_phrases(t, buckets), "bucket int, grp int, phrases binary, several binary")
               .groupBy("bucket").applyInArrow(recurring, "grp int, phrases binary"))
    windows = by_group.cogroup(phrases.groupBy("grp")).applyInArrow(lambda t, p: group_windows(t, p, buckets), "bucket int, grp int, h1 binary, h2 binary, doc binary")
    gone = windows.groupBy("bucket").applyInArrow(earlier_elsewhere, "grp int, h1 binary")
    return by_group.cogroup(gone.groupBy("grp")).applyInArrow(group_result, "doc_id long, n_words long, n_removed long, kept_sha256 string")
