"""URL filters: rules by host and path, and exact block lists as Bloom filter cascades.

A cascade answers membership exactly for every key of a known universe.  Its first level is a Bloom
filter of the listed keys; the unlisted keys that it passes wrongly make the second level, the
listed keys that the second passes wrongly the third, and so on until a level errs on no key.  A
key's answer is the parity of the level that first rejects it.

The universe is all distinct keys of the corpus, dealt into shards of bounded size by hash; each
shard's cascade is built in one task.  URLs are judged in place, without a join: the cascades of up to MOST_BYTES are
broadcast at a time, and while there are more, the URLs of the next shards are judged in a further
pass, whose broadcast replaces the one before.

The list is a table of keys, whatever it was made from; ``blocked_hosts`` makes one from the corpus: hosts of which the
rules block at least a share of the pages.

A null URL, or one without ://, has an empty host and path; the empty host is a key like any other.
Repeated rows are judged alike.  Without listed keys everything that no rule fits is allowed.  Listed keys that no
URL has are ignored, null ones too."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stage_path, written
from .text import mix

#: Keys of one shard, and bytes of all cascades up to which they are broadcast.
SHARD_KEYS, MOST_BYTES = 500_000, 64 << 20
#: Share of unlisted keys that the first level may pass; later levels pass half.
FIRST_LEVEL, LATER_LEVELS = 0.02, 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) and the path of a URL; both empty without ://."""
    host = F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def first_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls; rules are (verdict, host/path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, name in sorted(rules, key=lambda r: len(r[1])):
        domain, _, start = name.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + start)
        rule, verdict = F.when(fits, name).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


class Cascade:
    """The levels of one shard: (bits, number of hashes) of each Bloom filter."""

    def __init__(self, levels: list[tuple[np.ndarray, int]]):
        self.levels = levels

    @staticmethod
    def places(keys: np.ndarray, level: int, n_hashes: int, size: int) -> np.ndarray:
        """Bit positions of each key, one row for each hash; keys are pairs of 64-bit hashes."""
        a = mix(keys[0] + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64))
        b = mix(keys[1] ^ a) | np.uint64(1)
        return ((a + np.arange(n_hashes, dtype=np.uint64)[:, None] * b) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, listed: np.ndarray, others: np.ndarray) -> Cascade:
        """A cascade that holds all ``listed`` and none of ``others`` (2 x n arrays of hashes)."""
        levels, inside, outside = [], listed, others
        while inside.shape[1]:
            rate = FIRST_LEVEL if not levels else LATER_LEVELS
            n_hashes = max(1, round(-np.log2(rate)))
            size = max(64, int(np.ceil(inside.shape[1] * -np.log2(rate) * 1.4427 / 8)) * 8)
            bits = np.zeros(size, bool)
            bits[cls.places(inside, len(levels), n_hashes, size)] = True
            passed = bits[cls.places(outside, len(levels), n_hashes, size)].all(axis=0)
            levels.append((np.packbits(bits), n_hashes))
            inside, outside = outside[:, passed], inside
        return cls(levels)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key of the universe is listed."""
        answer, open_ = np.zeros(keys.shape[1], bool), np.arange(keys.shape[1])
        for level, (packed, n_hashes) in enumerate(self.levels):
            at = self.places(keys[:, open_], level, n_hashes, 8 * len(packed))
            passed = ((packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0).astype(bool)
            open_ = open_[passed]
            answer[open_] = level % 2 == 0
        return answer

    def pack(self) -> bytes:
        head = np.array([len(self.levels), *(x for bits, k in self.levels for x in (len(bits), k))], np.int64)
        return head.tobytes() + b"".join(bits.tobytes() for bits, _ in self.levels)

    @classmethod
    def unpack(cls, data: bytes) -> Cascade:
        n = int(np.frombuffer(data, np.int64, 1)[0])
        head = np.frombuffer(data, np.int64, 2 * n, 8).reshape(-1, 2)
        at, levels = 8 + 16 * n, []
        for size, k in head.tolist():
            levels.append((np.frombuffer(data, np.uint8, size, at), k))
            at += size
        return cls(levels)


def key_hashes(key: Column, shards: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(0), key), F.lit(shards)).cast("int").alias("shard"), F.xxhash64(F.lit(1), key).alias("h1"), F.xxhash64(F.lit(2), key).alias("h2")]


def cascades(keys: DataFrame, shards: int) -> DataFrame:
    """(shard, cascade) from all distinct keys (key, listed)."""
    def build(got: pd.DataFrame) -> pd.DataFrame:
        h = np.stack([got["h1"].to_numpy(np.int64).view(np.uint64), got["h2"].to_numpy(np.int64).view(np.uint64)])
        listed = got["listed"].to_numpy(bool)
        return pd.DataFrame({"shard": got["shard"].iloc[:1], "cascade": [Cascade.build(h[:, listed], h[:, ~listed]).pack()]})
    return keys.select(*key_hashes(F.col("key"), shards), "listed").groupBy("shard").applyInPandas(build, "shard int, cascade binary")


def judged(rows: DataFrame, listed: DataFrame, most_bytes: int = MOST_BYTES, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``rows`` (with a column host) with ``blocked``: whether the host is on the list (key), by the cascade."""
    spark = rows.sparkSession
    some = listed.select(F.col("key").alias("k")).where("k IS NOT NULL").distinct()
    keys = rows.select(F.col("host").alias("key")).distinct().join(some, F.col("key") == F.col("k"), "left")
    keys = written(keys.select("key", F.col("k").isNotNull().alias("listed")), "keys")
    shards = max(1, -(-keys.count() // shard_keys))
    built = written(cascades(keys, shards).withColumn("bytes", F.length("cascade")), "cascades")
    # groups of shards that are broadcast together: one row a shard
    groups, room = [[]], most_bytes
    for r in built.select("shard", "bytes").orderBy("shard").collect():
        if groups[-1] and r.bytes > room:
            groups.append([])
            room = most_bytes
        groups[-1].append(r["shard"])
        room -= r.bytes
    names = rows.columns
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    sent = [F.col(f"`{c}`").alias(f"in_{c}") for c in names]
    hashed = rows.select(*sent, *key_hashes(F.col("host"), shards))
    if len(groups) == 1:
        return _answered(hashed, _shared(built, groups[0]), names, kinds)
    hashed, out = written(hashed, "hosts"), stage_path(spark, "answers")
    for group in groups:
        shared = _shared(built, group)
        _answered(hashed.where(F.col("shard").isin(group)), shared, names, kinds).write.mode("append").parquet(out)
        shared.destroy()
    return spark.read.schema(", ".join([*(f"`{c}` {kinds[c]}" for c in names), "blocked boolean"])).parquet(out)


def _shared(built: DataFrame, shards: list[int]):
    """The cascades of some shards, broadcast."""
    rows = built.where(F.col("shard").isin(shards)).select("shard", "cascade").collect()
    return built.sparkSession.sparkContext.broadcast({r["shard"]: bytes(r["cascade"]) for r in rows})


def _answered(hashed: DataFrame, shared, names: list[str], kinds: dict[str, str]) -> DataFrame:
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        shard, h1, h2 = (batch.column(len(names) + i).to_numpy() for i in range(3))
        h = np.stack([h1.view(np.uint64), h2.view(np.uint64)])
        blocked = np.zeros(batch.num_rows, bool)
        for s in np.unique(shard).tolist():
            some = np.flatnonzero(shard == s)
            blocked[some] = Cascade.unpack(shared.value[s]).holds(h[:, some])
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), pa.array(blocked)], [*names, "blocked"])

    return map_batches(hashed, one, ", ".join([*(f"`{c}` {kinds[c]}" for c in names), "blocked boolean"]))


def has_term(key: Column, terms: tuple[str, ...]) -> Column:
    """Whether a part of a host name (between dots and hyphens) is one of ``terms``."""
    return F.arrays_overlap(F.split(key, "[.-]"), F.array(*map(F.lit, terms)))


def located(pages: DataFrame) -> DataFrame:
    """page_id, host and path of every page."""
    host, path = host_and_path(F.col("url"))
    return pages.select("page_id", host.alias("host"), path.alias("path"))


def blocked_hosts(pages: DataFrame, rules: list[tuple[str, str]], share: float) -> DataFrame:
    """(key): the hosts of which the rules block at least ``share`` of the pages."""
    verdict = first_rule(F.col("host"), F.col("path"), rules)[1]
    per = located(pages).groupBy(F.col("host").alias("key")).agg(F.avg(F.coalesce(verdict == "block", F.lit(False)).cast("double")).alias("share"))
    return per.where(F.col("share") >= share).select("key")


def url_filter(pages: DataFrame, rules: list[tuple[str, str]], listed: DataFrame, most_bytes: int = MOST_BYTES, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """page_id, host, path, rule and verdict of every page; ``listed`` (key) are the blocked hosts."""
    rule, verdict = first_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("blocked"), "block").otherwise("allow")
    return judged(located(pages), listed, most_bytes, shard_keys).select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"))
