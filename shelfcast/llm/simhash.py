"""SimHash near-duplicates: 64-bit fingerprints, linked within a Hamming radius by BK-trees.

Distinct fingerprints are sharded so that no pair within the radius is missed: the 64 bits are cut
into BLOCKS blocks, and two fingerprints that differ in at most RADIUS bits agree on at least
BLOCKS - RADIUS of them, so each fingerprint goes to one shard for every choice of AGREE blocks.
A shard is indexed by BK-trees, whose children are keyed by their integer distance to the parent;
a search follows only the edges within the radius of the distance that it measures.

A shard that more than SHARD fingerprints share is dealt into parts; each part's tree meets every
part's queries in a task of its own, so a group of copies never has to fit in one task.  Tasks
return a spanning forest of the links that they find instead of all pairs.  The forests are joined
to components by rounds of smallest-neighbour stars, each written to the shared folder.

Nulls and empty texts have fingerprint zero and link like any other.  Rows without a doc_id get the
smallest doc_id of their component (null if it has none).  Repeated rows get equal results."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import drop_stage, map_batches, pieces, protected, restored, text_bytes, written

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Blocks of the fingerprint, and how many of them a shard's members agree on (at most BLOCKS - RADIUS).
BLOCKS, AGREE = 6, 2
#: Fingerprints of one tree.
SHARD = 2048
#: Copies of a root's row, and rows of which a fingerprint must have more than one share to be broadcast.
SALT, HOT = 16, 10_000
#: Pairs of queries and nodes that a search looks at in one step.
STEP = 1 << 20


# -- fingerprints

def fingerprints_of(raw: np.ndarray, offsets: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """The SimHash of each row of a piece of texts."""
    low = T.lower_ascii(raw)
    starts, ends, word_at = T.runs(low, offsets, T.SPACE)
    # the words of all rows, joined by single spaces
    lengths = ends - starts + 1
    first = np.cumsum(lengths) - lengths
    total = int(lengths.sum())
    source = np.arange(total) - np.repeat(first, lengths) + np.repeat(starts, lengths)
    joined = low[np.minimum(source, len(low) - 1)] if total else low[:0]
    joined[first + lengths - 1] = 0x20
    flat, last = joined.tobytes(), first + lengths - 1
    n_words = np.diff(word_at)
    n_shingles = np.where(n_words >= n, n_words - n + 1, np.minimum(n_words, 1))
    row = np.repeat(np.arange(len(n_words)), n_shingles)
    at = np.arange(int(n_shingles.sum())) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles) + word_at[row]
    to = np.minimum(at + n, word_at[row + 1]) - 1
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(flat[a:b], SEED) for a, b in zip(first[at].tolist(), last[to].tolist())), np.uint64, len(at))
    out = np.zeros(len(n_words), np.uint64)
    some = np.flatnonzero(n_shingles)
    if len(some):
        begin = (np.cumsum(n_shingles) - n_shingles)[some]
        bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        set_ = np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
        packed = np.packbits(2 * set_ > n_shingles[some, None], axis=1)
        out[some] = packed.view(">u8").ravel()
    return out


def fingerprints(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` and fp, the fingerprint as a signed long, of every row."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, at = text_bytes(batch.column(len(carry)))
        found = [fingerprints_of(data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo]) for lo, hi in pieces(at, 1 << 20)]
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(carry))), pa.array(np.concatenate(found).view(np.int64))], [*carry, "fp"])
    return map_batches(docs.select(*carry, "text"), one, ", ".join([*(f"`{c}` {kinds[c]}" for c in carry), "fp long"]))


# -- BK-trees

class Forest:
    """BK-trees of many shards, one tree for each shard, built level by level.

    ``values`` are the fingerprints and ``tree`` their shards, ascending.  The children of a node
    lie together in ``child`` from ``begin`` to ``end``, sorted by ``edge``, the distance to it."""

    def __init__(self, tree: np.ndarray, values: np.ndarray):
        n = len(values)
        self.values, self.begin, self.end = values, np.zeros(n, np.int64), np.zeros(n, np.int64)
        child, edge, filled = np.zeros(n, np.int64), np.zeros(n, np.int64), 0
        first = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]) if n else np.zeros(0, np.int64)
        self.tree, self.roots = tree, first
        rest = np.setdiff1d(np.arange(n), first)
        owner = first[np.searchsorted(first, rest, "right") - 1]
        while len(rest):
            # distance to the node that owns each of them; the first at each distance becomes its child
            distance = np.bitwise_count(values[rest] ^ values[owner]).astype(np.int64)
            order = np.lexsort((rest, distance, owner))
            rest, owner, distance = rest[order], owner[order], distance[order]
            lead = np.r_[True, (owner[1:] != owner[:-1]) | (distance[1:] != distance[:-1])]
            heads = np.flatnonzero(lead)
            child[filled:filled + len(heads)], edge[filled:filled + len(heads)] = rest[heads], distance[heads]
            parents, start, many = np.unique(owner[heads], return_index=True, return_counts=True)
            self.begin[parents], self.end[parents] = filled + start, filled + start + many
            filled += len(heads)
            owner = rest[heads][np.cumsum(lead) - 1]
            rest, owner = rest[~lead], owner[~lead]
        self.child, self.edge = child[:filled], edge[:filled]

    def near(self, query: np.ndarray, tree: np.ndarray, radius: int):
        """Yields arrays (query index, node) of all nodes within ``radius`` of a query in its tree."""
        at = np.searchsorted(self.tree[self.roots], tree)
        found = at < len(self.roots)
        found[found] = self.tree[self.roots[at[found]]] == tree[found]
        work = [(np.flatnonzero(found), self.roots[at[found]])]
        while work:
            q, node = work.pop()
            if len(q) > STEP:
                half = len(q) // 2
                work += [(q[half:], node[half:]), (q[:half], node[:half])]
                continue
            distance = np.bitwise_count(query[q] ^ self.values[node]).astype(np.int64)
            hit = distance <= radius
            if hit.any():
                yield q[hit], node[hit]
            many = self.end[node] - self.begin[node]
            if not many.any():
                continue
            up = np.repeat(np.arange(len(q)), many)
            place = np.arange(len(up)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.begin[node], many)
            follow = np.abs(self.edge[place] - distance[up]) <= radius
            work.append((q[up[follow]], self.child[place[follow]]))


def merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a[i] and b[i]; ``parent`` maps to the smallest member once it is settled."""
    while True:
        ra, rb = parent[a], parent[b]
        open_ = ra != rb
        if not open_.any():
            return
        low, high = np.minimum(ra, rb)[open_], np.maximum(ra, rb)[open_]
        np.minimum.at(parent, high, low)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def forest_links(shard: np.ndarray, side: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fp, smaller fp of its set) that span all pairs of a shard within the radius.

    ``side``: 0 for nodes of the tree, 1 for queries only, 2 for both."""
    values = fp.view(np.uint64)
    order = np.argsort(shard, kind="stable")
    shard, side, values = shard[order], side[order], values[order]
    nodes, asks = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    forest, parent = Forest(shard[nodes], values[nodes]), np.arange(len(values))
    for q, node in forest.near(values[asks], shard[asks], radius):
        merge(parent, asks[q], nodes[node])
    linked = parent != np.arange(len(values))
    return values[linked].view(np.int64), values[parent[linked]].view(np.int64)


# -- shards

def block_masks(blocks: int = BLOCKS, agree: int = AGREE) -> list[int]:
    """The bit masks of all choices of ``agree`` blocks."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    each = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return [signed(sum(c)) for c in combinations(each, agree)]


def links(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, agree: int = AGREE, shard: int = SHARD) -> DataFrame:
    """(a, b): links among the distinct ``fps`` (fp) that connect all pairs within ``radius``."""
    if not 1 <= agree <= blocks - radius:
        raise ValueError("agree must be between 1 and blocks - radius")
    masks = F.array(*(F.lit(m).cast("long") for m in block_masks(blocks, agree)))
    sharded = fps.select("fp", F.posexplode(masks).alias("choice", "mask")).select("fp", "choice", F.col("fp").bitwiseAND(F.col("mask")).alias("common"))
    sizes = sharded.groupBy("choice", "common").agg(F.count("*").alias("n")).where("n > 1").withColumnsRenamed({"choice": "c", "common": "k"})
    members = sharded.join(sizes, (F.col("choice") == F.col("c")) & (F.col("common") == F.col("k"))).select("fp", "choice", "common", F.ceil(F.col("n") / shard).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    # a part's tree meets the queries of its own and of all later parts
    meets = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(
        F.least("part", j).alias("tree"), F.greatest("part", j).alias("query"),
        F.when(F.col("part") == j, 2).when(F.col("part") < j, 0).otherwise(1).alias("side")))
    dealt = members.withColumn("part", part).select("fp", F.explode(meets).alias("m"), "choice", "common")
    keyed = dealt.select("fp", F.col("m.side").alias("side"), F.xxhash64("choice", "common", "m.tree", "m.query").alias("shard"))
    spread = keyed.repartition("shard").sortWithinPartitions("shard")

    def run(batches):
        held = None
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            keys = held.column("shard").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1], "left"))  # the last shard may go on in the next batch
            if cut > 1 << 14:
                yield found(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield found(held)

    def found(rows: pa.Table) -> pa.RecordBatch:
        a, b = forest_links(rows.column("shard").to_numpy(), rows.column("side").to_numpy(), rows.column("fp").to_numpy().copy(), radius)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return spread.mapInArrow(run, "a long, b long")


# -- components

def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): its component's smallest node, if another.

    Rounds of two steps: every node links its larger neighbours to its smallest neighbour, then its
    smaller neighbours.  The edges of a node never meet in one task: only minima are grouped."""
    now, before = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"), None
    while True:
        for large in (True, False):
            both = now.select(F.col("a").alias("u"), F.col("b").alias("v"))
            if large:
                both = both.union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
            # written, so that both sides of the join are exchanges that Spark can split at a hub
            least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "w"), "least")
            met = both.join(least, F.col("u") == F.col("w"))
            if large:
                new = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
            else:
                new = met.where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.where("w != m").select("w", "m"))
            step = written(new.where("a != b").distinct(), "links")
            drop_stage(now)
            drop_stage(least)
            now = step
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def component_ids(distinct: DataFrame, roots: DataFrame) -> DataFrame:
    """(f, root, component_id) of every distinct fingerprint (fp, least), given the ``roots`` of the linked ones.

    Roots and fingerprints without a link are joined by themselves, one row a key; the members of a
    component meet their root's row in SALT copies, so a large component is dealt to as many tasks."""
    rooted = written(distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", "root"), "rooted")
    linked = rooted.where("root IS NOT NULL")
    below = linked.groupBy("root").agg(F.min("least").alias("m")).withColumnRenamed("root", "r")
    alone = rooted.where("root IS NULL").join(below, F.col("fp") == F.col("r"), "left")
    # least() skips nulls: a missing doc_id is larger than any
    alone = written(alone.select(F.col("fp").alias("f"), F.col("fp").alias("root"), F.least("least", "m").alias("component_id"), F.col("r").isNotNull().alias("shared")), "component-roots")
    copies = alone.where("shared").select(F.col("f").alias("r"), "component_id", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("s"))
    salted = linked.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALT)).cast("int"))
    members = salted.join(copies, (F.col("root") == F.col("r")) & (F.col("salt") == F.col("s")))
    return written(members.select(F.col("fp").alias("f"), "root", "component_id").unionByName(alone.drop("shared")), "components")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every row of ``docs`` with the columns ``carry``, fp and component_id.

    Fingerprints that more than one row in HOT has are at most HOT; their results are broadcast.  The others are
    joined by shuffle, where no key has more than that share."""
    rows = written(fingerprints(docs, carry), "simhash")
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "fingerprints")
    of_fp = component_ids(distinct.select("fp", "least"), components(links(distinct.select("fp"), radius)))
    all_rows = distinct.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = distinct.where(F.col("n") * HOT > F.lit(all_rows)).where("n > 1").select(F.col("fp").alias("hot"))
    hot = of_fp.join(F.broadcast(often), F.col("f") == F.col("hot"), "left_semi")
    kept = [*carry, "fp", "root", "component_id"]
    in_place = rows.join(F.broadcast(hot), F.col("fp") == F.col("f")).select(*kept)
    others = rows.join(F.broadcast(often), F.col("fp") == F.col("hot"), "left_anti")
    return in_place.unionByName(others.join(of_fp, F.col("fp") == F.col("f")).select(*kept))


def representatives(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` for each component: the one with the smallest doc_id (null last, then by
    hash of the text); of rows that repeat it one stays."""
    text_hash = F.xxhash64("text").alias("th")
    found = near_duplicates(docs.select("doc_id", "text", text_hash), radius, ("doc_id", "th"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "th")
    best = found.groupBy("root").agg(F.min(order).alias("x")).select(F.col("x.doc_id").alias("best_id"), F.col("x.th").alias("best_th"))
    rows = protected(docs, "doc_id", "text").select("*", text_hash)
    kept = rows.join(best, F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("th") == F.col("best_th")), "left_semi")
    return restored(kept.dropDuplicates(["doc_id", "th"]), docs, "doc_id", "text")
