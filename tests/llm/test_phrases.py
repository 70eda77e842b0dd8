import hashlib
import random

from helpers import frame, random_texts, words

from shelfcast.llm import phrases as R


def expected(rows):
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - 12):
            key = tuple(w[k:k + 13])
            first[key] = min(first.get(key, R.NO_ID), R.NO_ID if i is None else i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = {j for k in range(len(w) - 12) if first[tuple(w[k:k + 13])] < (R.NO_ID if i is None else i) for j in range(k, k + 13)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_matches_brute_force_with_small_groups(spark):
    rng = random.Random(2)
    texts = random_texts(40, seed=9, vocabulary=4, longest=50) + random_texts(30, seed=3, vocabulary=200, longest=80)
    for i in range(20):  # pieces of other texts, so that runs start and end anywhere
        a, b = words(rng.choice(texts)), words(rng.choice(texts))
        texts.append(" ".join(a[rng.randrange(5):rng.randrange(5, 60)] + b))
    docs = frame(spark, texts)
    more = spark.createDataFrame([(None, texts[0], "a"), (None, texts[4], "b"), (2, texts[8], "c"), (2, texts[8], "c")], docs.schema)
    docs = docs.union(more)
    want = expected([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(x[2] for x in want) > 500
    assert got(R.without_repeats(docs)) == want
    assert got(R.without_repeats(docs, group_bytes=400, bucket_bytes=400)) == want


def test_long_text_and_empty_table(spark):
    long = " ".join(f"w{i}" for i in range(100_000))
    docs = frame(spark, [long, "x " + long, "alone"])
    assert got(R.without_repeats(docs)) == expected([(r.doc_id, r.text) for r in docs.collect()])
    assert R.without_repeats(frame(spark, [])).count() == 0


def test_repeated_rows_are_dealt_to_many_groups(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(5, text)] * 300 + [(4, text + " end"), (6, "x " + text)], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    out = R.without_repeats(docs, group_bytes=2000, bucket_bytes=400)
    assert got(out) == expected([(r.doc_id, r.text) for r in docs.collect()])
    # after the run the texts were exchanged once and reused twice
    out = R.without_repeats(docs)
    out.collect()
    assert out._jdf.queryExecution().executedPlan().toString().count("ReusedExchange") >= 2
    # equal rows are in many groups
    dealt = docs.selectExpr("pmod(xxhash64(doc_id, text, monotonically_increasing_id()), 50) AS g", "doc_id").where("doc_id = 5")
    assert dealt.select("g").distinct().count() > 30


def test_a_bucket_is_split_by_group_in_one_go():
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(7)
    groups = [(g, np.sort(rng.choice(5000, 40, replace=False)).astype(np.uint64)) for g in range(60)]
    docs = [rng.integers(0, 1000, len(h)) for _, h in groups]
    table = pa.table({"grp": pa.array([g for g, _ in groups], pa.int32()), "h1": pa.array([R.pack(h) for _, h in groups], pa.binary()),
                      "h2": pa.array([R.pack(np.zeros(len(h), np.uint32)) for _, h in groups], pa.binary()), "doc": pa.array([R.pack(d) for d in docs], pa.binary())})
    least = {}
    for (_, h), d in zip(groups, docs):
        for x, y in zip(h.tolist(), d.tolist()):
            least[x] = min(least.get(x, y), y)
    want = {g: {x for x, y in zip(h.tolist(), d.tolist()) if y > least[x]} for (g, h), d in zip(groups, docs)}
    sent = R.earlier_elsewhere(table)
    assert {g: set(R.unpack(x, np.uint64).tolist()) for g, x in zip(sent["grp"].to_pylist(), sent["h1"].to_pylist())} == {g: w for g, w in want.items() if w}
