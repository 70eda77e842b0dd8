import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from helpers import frame, random_texts

from shelfcast.llm import importance as K
from shelfcast.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "w" * 90 + " tail " + "é" * 70 + " " + "x9" * 3000
TEXTS = random_texts(80) + [LONG, LONG + " a", "İstanbul ß ÀB àb \x00 null\x00byte", "one", "a b " * 4000, "same words here " * 30]


def buckets(text, longest=2, n=10_000):
    words = WORD.findall((text or "").translate(FOLD))
    return len(words), [zlib.crc32(" ".join(words[i:i + k]).encode()) % n for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def brute(rows, target, percent=25, least=20, seed=7, longest=2):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(buckets(text, longest)[1])
    for text in target:
        t.update(buckets(text, longest)[1])
    S, T = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in range(10_000)]
    out = []
    for doc_id, text in rows:
        n, f = buckets(text, longest)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    rank = {id(r): i + 1 for i, r in enumerate(fit[:percent * len(fit) // 100])}
    return sorted(((*r[:1], *r[2:], rank.get(id(r))) for r in out), key=str)


def test_buckets_of_whole_batches():
    words = K.Words()
    K._WORDS[:] = [words]
    for longest in (1, 2, 3):
        for lo, hi, offsets, found in K.features(pa.array(TEXTS), longest, 10_000):
            for row, text in enumerate(TEXTS[lo:hi]):
                n, want = buckets(text, longest)
                assert offsets[row + 1] - offsets[row] == n
                assert [b for bucket, at in found for b in bucket[at[row]:at[row + 1]].tolist()] == want, text
    words.bytes = K.REMEMBERED + 1
    assert sum(len(b) for *_, f in K.features(pa.array(["x y", None]), 2, 7) for b, _ in f) == 3 and len(words) == 3


def test_query_against_brute_force(spark, tmp_path):
    bench = ["the é4 passage Zz92 ab1", None, "", "words here same"]
    docs = frame(spark, TEXTS).union(spark.createDataFrame([(None, "no id " * 30, "s")] * 2 + [(4, "the same row " * 20, "s")] * 60, "doc_id long, text string, source string"))
    docs = docs.selectExpr("*", "1 AS score", "'x' AS rank", "2 AS c0")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    frame(spark, bench).selectExpr("doc_id AS item_id", "text").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in QUERIES["op13_importance"](spark, str(tmp_path)).collect()), key=str)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got == brute(rows, bench)
    drawn = K.resampled(docs, frame(spark, bench))
    assert drawn.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in drawn.collect()).total() == sum(r[4] is not None for r in got)
    assert {r.doc_id for r in drawn.collect()} == {r[0] for r in got if r[4] is not None}


def test_other_parameters(spark):
    docs, target = frame(spark, TEXTS), frame(spark, TEXTS[:5])
    got = K.importance(docs, target, longest=3, percent=60, least_words=5, seed=11)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()), key=str) == brute(rows, TEXTS[:5], 60, 5, 11, 3)


def test_the_draw_leans_to_the_target(spark):
    rng = np.random.default_rng(5)
    topics = [[f"{t}{i}" for i in range(40)] for t in ("near", "far")]
    texts = [" ".join(rng.choice(topics[i % 10 > 2], 60)) for i in range(400)]
    target = [" ".join(rng.choice(topics[0], 60)) for _ in range(20)]
    drawn = [r.doc_id for r in K.importance(frame(spark, texts), frame(spark, target)).collect() if r["rank"]]
    assert len(drawn) == 100 and sum(d % 10 <= 2 for d in drawn) > 2 * 30


def test_empty_tables(spark):
    none, some = frame(spark, []), frame(spark, TEXTS[:6])
    assert K.importance(none, some).count() == 0
    rows = [(r.doc_id, r.text) for r in some.collect()]
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in K.importance(some, none).collect()), key=str) == brute(rows, [])
