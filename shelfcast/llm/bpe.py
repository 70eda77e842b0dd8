"""Byte-level BPE: texts to token ids and back, by merge ranks.

A text is split by a pattern; every match (pre-token) is encoded by itself.  One that is in the
vocabulary is one id.  Any other starts as single bytes; the adjacent pair of lowest rank, the leftmost
of equals, is merged until no pair is in the vocabulary.

The pair to merge comes from a segment tree over byte positions.  The leaf of a position holds the
rank of the pair that begins there (the token at the position and the next live one), an inner node
the lowest of its leaves, and the leftmost of equal ones.  A merge changes three leaves (the merged
token, the one it swallowed, its left neighbour), so a pre-token of n bytes costs n log n however
long it is.

Ids are kept as little-endian unsigned 32-bit integers in a binary column; ``unpacked`` gives them as
an array.  The vocabulary is read once on the driver and broadcast: it has a fixed size, whatever
the corpus.  A worker remembers the ids of short pre-tokens, up to a bound, so each is merged about
once a worker; the new ones of a batch are merged together, one tree each, in numpy.

A null text is empty: no ids.  Rows are independent, so repeated rows, rows without a doc_id and texts
of any length need no special treatment; an empty table gives no rows; other columns are left out."""

from __future__ import annotations

import base64
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, pieces, text_bytes

#: Characters of a pre-token up to which its ids are remembered, and how many a worker remembers.
SHORT, REMEMBERED = 32, 1_000_000
#: Leaves of the trees that are merged together.
TOGETHER = 1 << 19
#: A leaf whose pair is not in the vocabulary.
NO_PAIR = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: lines of a base64 token and its rank, which is its id."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Pairs:
    """The rank of two adjacent tokens by their ids: every cut of a token into two tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.width = 1 + max(ranks.values())
        cuts = ((ranks.get(t[:k]), ranks.get(t[k:]), rank) for t, rank in ranks.items() for k in range(1, len(t)))
        table = np.array(sorted((a * self.width + b, rank) for a, b, rank in cuts if a is not None and b is not None), np.int64).reshape(-1, 2)
        self.keys, self.ranks = np.append(table[:, 0], NO_PAIR), np.append(table[:, 1], NO_PAIR)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NO_PAIR)


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token of at least one byte."""
    n = len(piece)
    size = 1 << (n - 1).bit_length()
    tree = array("q", [NO_PAIR]) * (2 * size)
    # a node is rank * n + position: the least is the lowest rank, leftmost of equals
    for i in range(n - 1):
        rank = ranks.get(piece[i:i + 2])
        if rank is not None:
            tree[size + i] = rank * n + i
    for node in range(size - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    after, before = array("q", range(1, n + 1)), array("q", range(-1, n))

    def put(position: int, begin: int, end: int) -> None:
        """The leaf of ``position`` for the pair of bytes begin..end, and the nodes above it."""
        rank = ranks.get(piece[begin:end])
        value, node = NO_PAIR if rank is None else rank * n + position, size + position
        tree[node] = value
        while node > 1:
            least = min(tree[node], tree[node ^ 1])
            node >>= 1
            if tree[node] == least:
                return
            tree[node] = least

    while tree[1] != NO_PAIR:
        i = tree[1] % n
        gone = after[i]
        end = after[i] = after[gone]
        put(gone, 0, 0)
        if end < n:
            before[end] = i
            put(i, i, after[end])
        else:
            put(i, 0, 0)
        if i:
            put(before[i], before[i], end)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:after[i]]])
        i = after[i]
    return ids


def merged_together(some: list[bytes], byte_ids: np.ndarray, pairs: Pairs) -> list[bytes]:
    """The packed ids of many short pre-tokens: one tree a row, every step merges one pair in each row."""
    n = np.fromiter(map(len, some), np.int64, len(some))
    rows, size = len(some), 1 << (int(n.max()) - 1).bit_length()
    at = np.arange(size)
    alive = at < n[:, None]
    token = np.zeros((rows, size), np.int64)
    token[alive] = byte_ids[np.frombuffer(b"".join(some), np.uint8)]
    tree = np.full((rows, 2 * size), NO_PAIR)
    if size > 1:
        rank = pairs(token[:, :-1], token[:, 1:])
        tree[:, size:-1] = np.where(alive[:, 1:] & (rank < NO_PAIR), rank * size + at[:-1], NO_PAIR)
    half = size
    while half > 1:
        tree[:, half // 2:half] = np.minimum(tree[:, half:2 * half:2], tree[:, half + 1:2 * half:2])
        half //= 2
    after, before = np.tile(at + 1, (rows, 1)), np.tile(at - 1, (rows, 1))
    flat, tokens, after, before = tree.ravel(), token.ravel(), after.ravel(), before.ravel()
    row = np.arange(rows)
    while len(row := row[tree[row, 1] != NO_PAIR]):
        root, first, nodes = tree[row, 1], row * size, row * 2 * size
        i, made, last = root % size, root // size, n[row]
        gone = after[first + i]
        end = after[first + gone]
        tokens[first + i], after[first + i] = made, end
        alive[row, gone] = False
        right, left = end < last, before[first + i]
        before[(first + end)[right]] = i[right]
        with_right = np.full(len(row), NO_PAIR)
        with_right[right] = pairs(made[right], tokens[(first + end)[right]])
        has = left >= 0
        with_left = pairs(tokens[(first + left)[has]], made[has])
        positions = np.concatenate((gone, i, left[has]))
        ranks = np.concatenate((np.full(len(row), NO_PAIR), with_right, with_left))
        base = np.concatenate((nodes, nodes, nodes[has]))
        node = size + positions
        flat[base + node] = np.where(ranks < NO_PAIR, ranks, 0) * size + np.where(ranks < NO_PAIR, positions, NO_PAIR)
        while node[0] > 1:
            least = np.minimum(flat[base + node], flat[base + (node ^ 1)])
            node >>= 1
            flat[base + node] = least
    packed, ends = token[alive].astype("<u4").tobytes(), np.cumsum(4 * alive.sum(1)).tolist()
    return [packed[a:b] for a, b in zip([0, *ends], ends)]


class Codec(dict):
    """Ids of pre-tokens, as little-endian bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        super().__init__()
        self.ranks, self.split, self.pairs = ranks, regex.compile(pattern).findall, Pairs(ranks)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def learn(self, new: set[str]) -> None:
        """Remember the ids of short pre-tokens; those of like length are merged together."""
        groups: dict[int, list[str]] = {}
        for piece in new:
            raw = piece.encode()
            if raw in self.ranks:
                self[piece] = self.ranks[raw].to_bytes(4, "little")
            else:
                groups.setdefault((len(raw) - 1).bit_length(), []).append(piece)
        for bits, group in groups.items():
            step = max(1, TOGETHER >> bits)
            for k in range(0, len(group), step):
                some = group[k:k + step]
                self.update(zip(some, merged_together([p.encode() for p in some], self.byte_ids, self.pairs)))

    def __missing__(self, piece: str) -> bytes:
        """A long pre-token, which is not remembered."""
        raw = piece.encode()
        return np.array([self.ranks[raw]] if raw in self.ranks else merged(raw, self.ranks), "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text."""
        if len(self) > REMEMBERED:
            self.clear()
        split = list(map(self.split, texts))
        self.learn({p for p in set().union(*split).difference(self) if len(p) <= SHORT})
        return [b"".join(map(self.__getitem__, s)) for s in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[str, Codec] = {}


class ByteBPE:
    """Encoder and decoder of DataFrames by a vocabulary file and a pattern."""

    def __init__(self, spark, path: str, pattern: str):
        self.ranks, self.pattern, self.key = spark.sparkContext.broadcast(read_ranks(path)), pattern, uuid.uuid4().hex

    def _codec(self) -> Codec:
        """The worker's codec, kept for its next task."""
        if self.key not in _CODECS:
            _CODECS.clear()
            _CODECS[self.key] = Codec(self.ranks.value, self.pattern)
        return _CODECS[self.key]

    def encoded(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """(doc_id, ids) of every whole text."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codec = self._codec()
            for batch in batches:
                at = text_bytes(batch.column(1))[1]
                for lo, hi in pieces(at):
                    texts = batch.column(1).slice(lo, hi - lo).fill_null("").to_pylist()
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(codec.encode(texts), pa.binary())], ["doc_id", "ids"])
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, "doc_id long, ids binary")

    def decoded(self, ids: DataFrame) -> DataFrame:
        """(doc_id, ids, data) with the bytes that the ids stand for; null ids are none."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codec = self._codec()
            for batch in batches:
                at = np.concatenate(([0], np.cumsum([len(x or b"") for x in batch.column(1).to_pylist()])))
                for lo, hi in pieces(at):
                    some = batch.slice(lo, hi - lo).select([0, 1])
                    data = pa.array(map(codec.decode, some.column(1).fill_null(b"").to_pylist()), pa.binary())
                    yield pa.RecordBatch.from_arrays([*some.columns, data], ["doc_id", "ids", "data"])
        return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, data binary")


def n_tokens(ids: Column) -> Column:
    """How many ids a packed column holds."""
    return F.floor(F.octet_length(ids) / 4).cast("long")


def unpacked(ids: DataFrame) -> DataFrame:
    """(doc_id, ids) with the ids as an array of integers."""
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [np.frombuffer(x or b"", "<u4").astype(np.int32) for x in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int32()))], ["doc_id", "ids"])
    return map_batches(ids.select("doc_id", "ids"), one, "doc_id long, ids array<int>")
