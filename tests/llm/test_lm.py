import collections
import math
import random
import zlib

import numpy as np
from helpers import collected, frame, random_texts, words
from pyspark.sql import functions as F

from shelfcast.llm import lm as L

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = L.Network(L.Network.initial(rng.integers(1, 100, L.CLASSES * L.CLASS_WORDS).astype(float)).vector.astype(np.float64) * 3)
    x, mask, h = rng.integers(0, L.CLASSES * L.CLASS_WORDS, (5, 3)), rng.random((5, 3)) < 0.8, rng.normal(0, 0.3, (3, L.WIDTH))

    def loss(vector):
        n = L.Network(vector)
        states, _ = n.window(x, h)
        return -n.log_probs(states[mask].astype(np.float64), x[mask])[0].sum() / mask.sum()
    grads, _, _ = net.gradients(x, mask, h)
    for i in np.argsort(-abs(grads.vector))[:300:10]:
        v = net.vector.copy()
        v[i] += 1e-3
        up = loss(v)
        v[i] -= 2e-3
        assert abs((up - loss(v)) / 2e-3 - grads.vector[i]) < 2e-3 + 0.02 * abs(grads.vector[i])


def test_probabilities_sum_to_one_and_windows_carry_the_state():
    net = L.Network.initial(np.arange(float(L.CLASSES * L.CLASS_WORDS)))
    states = np.random.default_rng(1).normal(0, 1, (3, L.WIDTH)).astype(np.float32)
    total = sum(np.exp(net.log_probs(states, np.full(3, i))[0]) for i in range(L.CLASSES * L.CLASS_WORDS))
    assert np.allclose(total, 1, atol=1e-3)
    rows = [np.random.default_rng(i).integers(0, L.CLASSES * L.CLASS_WORDS, n) for i, n in enumerate((500, 1, 70, 33, 32, 0, 64))]
    ids, at = np.concatenate(rows), np.concatenate(([0], np.cumsum(list(map(len, rows)))))
    got = L.row_scores(net, ids, at)
    for k, r in enumerate(rows):
        s, _ = net.window(r[:, None], np.zeros((1, L.WIDTH), np.float32)) if len(r) else (np.zeros((0, 1, L.WIDTH)), None)
        assert abs(got[k] - (net.log_probs(s[:, 0], r)[0].sum() if len(r) else 0)) < 1e-2


def test_counts_and_base_score_match_brute_force(spark):
    texts = random_texts(60, seed=7, vocabulary=80)
    docs = frame(spark, texts)
    tokens = {i: [*words((t or "").translate(LOWER)), None] for i, t in enumerate(texts)}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    c = collections.Counter(t for i, w in tokens.items() if not held[i] for t in w)
    n, v = sum(c.values()), len(c)
    for known in (L.KNOWN, 20):
        L.KNOWN, old = known, L.KNOWN
        L.Statistics.__init__.__defaults__ = (known, *L.Statistics.__init__.__defaults__[1:])
        try:
            got = collected(L.scored(docs, L.held_out(F.col("doc_id"))))
        finally:
            L.KNOWN = old
            L.Statistics.__init__.__defaults__ = (old, *L.Statistics.__init__.__defaults__[1:])
        for i, w in tokens.items():
            r = got[i]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(w), sum(t in c for t in w), n)
            assert abs(r.base_score - sum(math.log10((c[t] + 1) / (n + v + 1)) for t in w)) < 1e-6


def test_learns_order_that_counts_cannot_see(spark):
    rng = random.Random(1)
    cycle = [f"w{i}" for i in range(12)]

    def text():
        k = rng.randrange(12)
        return " ".join(cycle[(k + j) % 12] for j in range(60))
    got = L.scored(frame(spark, [text() for _ in range(3000)]).coalesce(1), L.held_out(F.col("doc_id"))).where("held_out").agg(F.sum("base_score"), F.sum("score"), F.sum("n_tokens")).first()
    assert got[1] / got[2] > got[0] / got[2] + 0.3


def test_learns_order_from_few_texts(spark):
    rng = random.Random(1)
    cycle = [f"w{i}" for i in range(12)]

    def text():
        k = rng.randrange(12)
        return " ".join(cycle[(k + j) % 12] for j in range(60))
    got = L.scored(frame(spark, [text() for _ in range(300)]).coalesce(1), L.held_out(F.col("doc_id"))).where("held_out").agg(F.sum("base_score"), F.sum("score"), F.sum("n_tokens")).first()
    assert got[1] / got[2] > got[0] / got[2] + 0.3


def test_every_token_is_propagated_back_with_the_state_of_its_document(monkeypatch):
    rng = np.random.default_rng(2)
    rows = [rng.integers(0, L.CLASSES * L.CLASS_WORDS, n).astype(np.int32) for n in (1500, 7, 19, 600, *[11] * 200)]
    ids, at = np.concatenate(rows), np.concatenate(([0], np.cumsum(list(map(len, rows)))))
    seen, fresh = [], 0
    gradients = L.Network.gradients

    def watched(net, x, mask, h):
        nonlocal fresh
        seen.append(x[mask])
        fresh += int((~h.any(axis=1) & mask[0]).sum())
        return gradients(net, x, mask, h)
    monkeypatch.setattr(L.Network, "gradients", watched)
    assert L.trained(L.Network.initial(np.ones(L.CLASSES * L.CLASS_WORDS)), [(ids, at)]) == len(ids)
    assert sorted(np.concatenate(seen).tolist()) == sorted(ids.tolist())
    assert fresh == len(rows)  # a state is zero only where a document begins


def test_empty_table_and_no_training_rows(spark):
    assert L.scored(frame(spark, []), L.held_out(F.col("doc_id"))).count() == 0
    r = L.scored(frame(spark, ["a b"]), F.lit(True)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and r.base_score == 0


def test_partitions_do_not_matter(spark, monkeypatch):
    texts = random_texts(300, seed=11, vocabulary=60)
    docs = frame(spark, texts).union(spark.createDataFrame([(5, texts[8], "s")] * 3, "doc_id long, text string, source string"))
    # several replicas a round, of several documents each
    monkeypatch.setattr(L.dealt, "__defaults__", (L.ROUNDS, 500))
    monkeypatch.setattr(L.fit, "__defaults__", (L.ROUNDS, 500))
    runs = []
    for parts in (1, 7):
        rows = L.scored(docs.repartition(parts), L.held_out(F.col("doc_id"))).collect()
        runs.append(sorted((r.doc_id, r.n_tokens, r.score) for r in rows))
    assert [r[:2] for r in runs[0]] == [r[:2] for r in runs[1]]
    assert np.allclose([r[2] for r in runs[0]], [r[2] for r in runs[1]], rtol=1e-4, atol=1e-3)


def test_equal_frequent_rows_are_dealt_to_many_parts(spark):
    rows = spark.createDataFrame([(1, bytearray(b"ab"), i) for i in range(3000)] + [(i, bytearray(b"cd"), 10_000 + i) for i in range(300)], "doc_id long, ids binary, row long")
    parts, replicas = L.dealt(rows, 400_000, 4, 10_000)
    assert replicas == 10
    counts = {r.part: r["count"] for r in parts.where("row < 10000").groupBy("part").count().collect()}
    assert len(counts) == 40 and max(counts.values()) < 3 * 3000 / 40
    assert {r.part % 4 for r in parts.where("row >= 10000").collect()} == set(range(4))
    tiny, one = L.dealt(rows.where("row >= 10000"), 900, 4, 10_000)
    assert one == 1 and {r.part for r in tiny.collect()} == set(range(4))


def test_the_end_is_known_and_counted_once(spark):
    # all words equally often: fewer are known than there are of that count
    docs = frame(spark, [" ".join(f"w{i}" for i in range(k, k + 10)) for k in range(0, 300, 10)])
    for known in (1, 7, 5000):
        stats = L.Statistics(L.token_counts(docs), known)
        # of equally frequent ones whole ranges of hashes are known
        n_known = len(stats.h) - 1
        assert stats.id_counts[L.END] == 30 and min(known, 300) - 2 <= n_known <= min(known, 300)
        assert stats.tail(L.token_counts(docs)).count() == 300 - n_known
        assert stats.n_rest + stats.id_counts[1:].sum() == stats.n == 330 and stats.v == 301


def test_very_long_text(spark):
    long = " ".join(f"w{i % 50}" for i in range(120_000))
    got = collected(L.scored(frame(spark, [long, "w1 w2 w3", "new words"]), L.held_out(F.col("doc_id"))))
    assert got[0].n_tokens == 120_001 and got[2].n_tokens == 3
    assert all(np.isfinite(got[i].score) and got[i].score < 0 for i in range(3))


def test_every_replica_has_a_task_of_its_own(spark):
    for tasks in (1, 3, 17, 40):
        rows = spark.range(2000).withColumn("part", F.col("id") % tasks)
        got = L.own_partitions(rows, F.col("part"), tasks)
        per = got.groupBy(F.spark_partition_id().alias("at")).agg(F.countDistinct("part").alias("n")).collect()
        assert got.columns == rows.columns and len(per) == tasks and {r.n for r in per} == {1}
