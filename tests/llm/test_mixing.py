from fractions import Fraction

from helpers import frame, random_texts, words

from shelfcast.llm import mixing as M


def targets(sizes):
    """Share by weight; cap; share the excess again, until none is above."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, open_, out = Fraction(sum(sizes.values())), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 3 * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = Fraction(3 * sizes[s])
            left -= out[s]
        open_ -= over
    return out


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = M.mixed(docs).collect()
    again = M.mixed(docs).collect()
    key = lambda r: str(tuple(r))
    assert sorted(got, key=key) == sorted(again, key=key) and len(got) == len(rows)
    sizes, biggest = {}, {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
        biggest[s] = max(biggest.get(s, 0), len(words(t)))
    want = targets(sizes)
    source = {i: s for i, _, s in rows}
    text = {i: t for i, t, _ in rows}
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = source[r.doc_id]
        assert r.size == len(words(text[r.doc_id])) and r.source_size == sizes[s]
        assert abs(r.target - float(want[s])) < 1e-6
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - float(want[s])) <= biggest[s], s


def test_targets_and_taken(spark):
    check(spark, [(i, t, ("b", "a", "é", None)[i % 4]) for i, t in enumerate(random_texts(150, vocabulary=50))])


def test_small_source_is_capped_and_excess_reshared(spark):
    rows = [(i, "w " * (5 + i % 9), "big") for i in range(300)] + [(1000 + i, "a b c", "tiny") for i in range(4)] + [(2000, "", "empty"), (2001, None, "none"), (2002, "x " * 400, "one")]
    check(spark, rows)


def test_mix_repeats_rows_and_keeps_columns(spark):
    docs = frame(spark, random_texts(40)).withColumnRenamed("source", "h").selectExpr("doc_id", "text", "h", "'s' as source", "1 as copies")
    out = M.mix(docs)
    assert out.columns == docs.columns and out.count() == docs.count()  # one source: all of it, once
    assert M.mix(docs.limit(0)).count() == 0 and M.mixed(docs.limit(0)).count() == 0


def totals(rows, key):
    out = {}
    for r in rows:
        out[key(r)] = out.get(key(r), 0) + r.taken
    return out


def test_rows_without_an_id_or_of_one_id_are_taken_one_by_one(spark):
    schema = "doc_id long, text string, source string, part string"
    own = [(None, "w " * 20, "a", None)] * 150 + [(7, "v " * 20, "b", str(i)) for i in range(150)] + [(8, f"x{i} " * 20, "c", None) for i in range(50)]
    for parts in (1, 5):
        docs = spark.createDataFrame(own, schema).repartition(parts)
        got = M.mixed(docs).collect()
        want = targets({"a": 3000, "b": 3000, "c": 1000})
        taken = totals(got, lambda r: {None: "a", 7: "b", 8: "c"}[r.doc_id])
        assert all(abs(taken[s] - float(want[s])) <= 10 + 1e-6 for s in want), (taken, want)
        assert all(r.taken <= 3 * r.size for r in got)
        if parts == 1:
            first = sorted((str(r.doc_id), r.size, r.taken) for r in got)
    assert sorted((str(r.doc_id), r.size, r.taken) for r in got) == first      # as many of the equal rows
    out = M.mix(docs)
    assert out.columns == docs.columns
    assert {r.source: 20 * r["count"] for r in out.groupBy("source").count().collect()} == taken


def test_more_sources_than_are_broadcast(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 5), f"s{i % 40}" if i % 41 else None) for i in range(400)], "doc_id long, text string, source string")
    few, many = M.mixed(docs), M.mixed(docs, bound=3)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))


def test_running_sums_over_ranges(spark):
    from pyspark.sql import functions as F
    from shelfcast.llm.common import running_sums
    df = spark.createDataFrame([(i * 37 % 101, i % 7) for i in range(101)], "k long, v long").repartition(5)
    got = sorted(map(tuple, running_sums(df, [F.asc("k")], ["v"], "sums").collect()))
    values = dict((i * 37 % 101, i % 7) for i in range(101))
    assert got == [(k, values[k], k, sum(values[j] for j in range(k))) for k in range(101)]
    assert running_sums(df.limit(0), [F.asc("k")], ["v"], "sums").count() == 0
