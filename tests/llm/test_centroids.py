import hashlib
import math

import numpy as np

from shelfcast.llm import centroids as K
from shelfcast.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k=16, rounds=3, seed=1, dims=64, scale=64):
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == dims and all(v is not None and math.isfinite(v) for v in x):
            kept.append((vec_id, x, [math.floor(v * scale) if math.isfinite(v * scale) else int(v) * scale for v in x]))
    points = [v for *_, v in sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, p)), j) for j, p in enumerate(points)) for *_, v in kept]
    for _ in range(rounds):
        best = assign()
        for j in range(len(points)):
            own = [v for (*_, v), (_, c) in zip(kept, best) if c == j]
            if own:
                points[j] = [sum(c) // len(own) for c in zip(*own)]
    best = assign()
    own = {j: sum(d for d, c in best if c == j) for j in range(len(points))}

    def long(n):
        return n if n < 1 << 63 else None

    def total(c):
        return None if any(d >= 1 << 63 for d, j in best if c in (None, j)) else long(sum(d for d, j in best if c in (None, j)))
    digest = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    assert sum(own.values()) == sum(d for d, _ in best)
    return sorted(((i, c, long(d), total(c), total(None), digest[c]) for (i, *_), (d, c) in zip(kept, best)), key=str)


def vectors(n, dims=64, seed=0, spread=0.4):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(10, dims))
    return [(i, (middle[i % 10] + spread * rng.normal(size=dims)).tolist()) for i in range(n)]


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA).repartition(3)
    out = K.with_inertia(*K.Clustering(**options).fit(df))
    return sorted(map(tuple, out.collect()), key=str)


def test_query_against_brute_force_with_odd_rows(spark, tmp_path):
    some = vectors(150)
    rows = some + [(1, some[1][1])] * 60 + [(None, some[2][1]), (None, some[3][1])] + [(900 + i, [0.0] * 64) for i in range(20)]
    rows += [(1000, None), (1001, []), (1002, [0.5] * 63), (1003, [0.5] * 65), (1004, [0.5] * 63 + [None]), (1005, [0.5] * 63 + [math.nan]), (1006, [-math.inf] + [0.5] * 63)]
    df = spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA).selectExpr("*", "1 AS cluster", "2 AS x", "3 AS distance").repartition(4)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(map(tuple, QUERIES["op12_centroids"](spark, str(tmp_path)).collect()), key=str)
    assert got == brute(rows)


def test_huge_components_and_distances(spark):
    rows = vectors(40) + [(500, [3e38] * 64), (501, [-3e38] * 64), (502, [1.7e308] + [0.0] * 63), (503, [1e7] * 64), (504, [2e9] * 32 + [-2e9] * 32), (505, [-1e-9] * 64)]
    for seed in (1, 5):  # huge ones among the first centroids or not
        assert found(spark, rows, seed=seed) == brute(rows, seed=seed)


def test_far_from_the_origin_and_other_parameters(spark):
    rows = [(i, [v + 1.5e6 for v in x]) for i, x in vectors(120, dims=9, seed=4, spread=0.05)]
    for options in ({"k": 7, "rounds": 2, "seed": 3, "dims": 9, "scale": 10, "lead": 3}, {"k": 200, "rounds": 1, "dims": 9, "lead": 20}):
        want = brute(rows, **{k: v for k, v in options.items() if k != "lead"})
        assert found(spark, rows, **options) == want


def test_ties_go_to_the_smaller_number(spark):
    rows = [(i, [float(i % 3)] * 64) for i in range(30)]
    assert found(spark, rows) == brute(rows)


def test_the_filter_saves_distances_and_loses_none(spark):
    df = spark.createDataFrame([(i, x, 0) for i, x in vectors(2000, spread=0.2)], SCHEMA)
    assigned, points = K.Clustering().fit(df)
    exact = assigned.agg({"measured": "sum"}).first()[0]
    assert len(points) == 16 and 2000 <= exact < 2000 * 16 / 2


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert K.with_inertia(*K.Clustering().fit(none)).count() == 0
    assert found(spark, [(1, None), (2, [1.0])]) == []
    assert found(spark, [(1, [0.5] * 64)]) == brute([(1, [0.5] * 64)])
