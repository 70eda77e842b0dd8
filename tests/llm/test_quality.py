import collections
import math
import re

import numpy as np
import pyarrow as pa
import pytest
from helpers import WORD, collected, frame, random_texts, words

from shelfcast.llm import quality as Q
from shelfcast.llm import text as T
from shelfcast.llm.common import text_bytes


def base(text):
    w = words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    times = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    cover = {j for i in range(len(w) - 7) if times[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(cover)


def buckets_of(text, n):
    raw, at = text_bytes(pa.array([text or ""]))
    s, e, wa = T.runs(raw, at, T.SPACE)
    h = [int(x) for x in T.span_hashes(raw, s, e)]
    pairs = [int(T.ngram_hashes(np.array(h[i:i + 2], np.uint64), 2)[0]) for i in range(len(h) - 1)]
    return [x % n for x in h + pairs]


def test_base_columns_and_scores_match_brute_force(spark):
    texts = random_texts(24)
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(1, 1, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    got = collected(Q.quality_rules(docs, labels, buckets=256, threshold=-20_000))
    trusted = {i for i in range(12) if i % 2}  # a label says that 3 is toxic, another that it is not
    raw, target = collections.Counter(), collections.Counter()
    for i, t in enumerate(texts):
        b = buckets_of(t, 256)
        raw.update(b)
        if i in trusted:
            target.update(b)
    n_raw, n_target = sum(raw.values()), sum(target.values())
    p = [(raw[b] + 1) / (n_raw + 256) for b in range(256)]
    weight = [round(1e6 * math.log((target[b] + 256 * p[b]) / (n_target + 256) / p[b])) for b in range(256)]
    kept = set()
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(t), i
        b = buckets_of(t, 256)
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        total = sum(weight[x] for x in b)
        assert r.score is None if not b else abs(r.score - total / len(b) / 1e6) < 1e-9
        assert r.kept == (not r.base_failed and total >= -20_000 * len(b))
        kept.add(r.kept)
    assert kept == {True, False}


def test_long_text_and_pieces_agree(spark):
    long = "\n".join(f"word{i % 977} and |{i}" for i in range(300_000))
    got = collected(Q.judge(frame(spark, [long, "short text", long]), np.zeros(64, np.int64)))
    assert tuple(got[0][1:6]) == base(long) == tuple(got[2][1:6])


def test_empty_tables_and_clashing_columns(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Q.quality_rules(frame(spark, []), labels).count() == 0
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(40)), 5, "x"), (None, "few", 6, "y")], "doc_id long, text string, n_words int, kept string")
    out = Q.clean(docs, labels)
    assert out.columns == docs.columns and [tuple(r)[2:] for r in out.collect()] == [(5, "x")]


@pytest.mark.parametrize("sf", ("sf0.001", "sf0.01", "sf0.1"))
def test_verdicts_are_alike_at_every_size(spark, sf):
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.quality_rules(docs, labels, carry=("doc_id", "lang")).where("not base_failed").toPandas()
    known = labels.toPandas().groupby("doc_id").quality.min()
    quality = got.doc_id.map(known)
    clean = got[quality.isna() & (got.n_symbols == 0) & (got.n_dup_lines == 0) & (got.n_repeat_words == 0)]
    bad, good = got[quality == 0], got[quality == 1]
    assert len(bad) and bad.kept.mean() < 0.12 and good.kept.mean() > 0.99
    assert clean.groupby("lang").kept.mean().min() > 0.98


def test_threshold_counts_each_trusted_document_without_itself(spark):
    texts = [t for t in random_texts(24, longest=200) if len(words(t)) >= 20]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, len(texts), 2)], "doc_id long, quality int, toxic int")
    _, threshold = Q.fitted(docs, labels, 256)
    bags = [collections.Counter(buckets_of(t, 256)) for t in texts]
    raw = sum(bags, collections.Counter())
    target = sum(bags[::2], collections.Counter())
    n_raw, n = sum(raw.values()), sum(target.values())
    p = [(raw[b] + 1) / (n_raw + 256) for b in range(256)]
    scores = []
    for t, bag in zip(texts[::2], bags[::2]):
        words_n, *_, repeat = base(t)
        if 100 * repeat <= 30 * words_n:
            m = sum(bag.values())
            scores.append(sum(c * math.log((target[b] - c + n * p[b]) / (2 * n - m) / p[b]) for b, c in bag.items()) / m)
    assert len(scores) > 3 and threshold == 1000 * math.floor(1000 * sorted(scores)[len(scores) // 100]) - Q.MARGIN


def test_target_has_every_trusted_document(spark):
    """the target was fitted on the first 100,000 by hash."""
    n, others, buckets = 100_500, 50_000, 1 << 16
    docs = spark.range(n + others).selectExpr("id as doc_id", f"if(id < {n}, 'good words', 'other text') as text")
    labels = spark.range(n).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    weights, _ = Q.fitted(docs, labels, buckets, threshold=0)
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for text, times, trusted in (("good words", n, True), ("other text", others, False)):
        for b in buckets_of(text, buckets):
            raw[b] += times
            target[b] += times * trusted
    assert (weights == Q.bucket_weights(raw, target, Q.SMOOTHING * buckets)).all()
