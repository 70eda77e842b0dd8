"""Mergeable weighted moments against numpy, and their plan."""
import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from shelfcast.operators import safety

SCHEMA = "store_code string, product_id string, date date, net_quantity double, days_from_today int"


def days(spark, values):
    start = dt.date(2024, 1, 1)
    rows = [(s, p, start + dt.timedelta(days=i), x, len(xs) - 1 - i) for (s, p), xs in values.items() for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def expected(xs, w):
    xs, w = np.array(xs, np.longdouble), np.array(w, np.longdouble)
    m = (w * xs).sum() / w.sum()
    return float(m), 0.0 if len(xs) == 1 else float(np.sqrt((w * (xs - m) ** 2).sum() / w.sum()))


def test_small_deviation_around_a_large_mean(spark):
    rng = random.Random(2)
    values = {("s", "far"): [1e9 + rng.choice((-1, 1)) for _ in range(200)], ("s", "near"): [float(rng.randrange(9)) for _ in range(50)], ("t", "one"): [5.0]}
    got = {(r.store_code, r.product_id): (r.daily_avg, r.daily_std) for r in safety.weighted_demand_stats(days(spark, values)).collect()}
    for key, xs in values.items():
        mean, std = expected(xs, [0.95 ** (len(xs) - 1 - i) for i in range(len(xs))])
        assert abs(got[key][0] - mean) <= 1e-12 * abs(mean) and abs(got[key][1] - std) < 1e-6, key
    assert 0.9 < got[("s", "far")][1] <= 1.001


def test_parts_merge_to_the_whole(spark):
    rng = random.Random(4)
    daily = days(spark, {("s", str(p)): [1e8 + 10 * rng.random() for _ in range(rng.randrange(1, 90))] for p in range(12)})
    weights = {"flat": F.lit(1.0), "decay": safety.day_weight(daily), "never": F.lit(0.0)}
    whole = {r.product_id: r for r in safety.demand_moments(daily, weights).collect()}
    parts = safety.demand_moments(daily.withColumn("month", F.month("date")), weights, [*safety.KEY, "month"])
    merged = {r.product_id: r for r in safety.merged_moments(parts, list(weights)).collect()}
    for p, r in whole.items():
        for name in ("flat", "decay"):
            a, b = r[name], merged[p][name]
            assert a.n == b.n and np.isclose(a.w, b.w) and np.isclose(a["mean"], b["mean"], rtol=1e-14) and np.isclose(a.m2, b.m2, rtol=1e-6, atol=1e-6)
        assert r.never.n == whole[p].flat.n and r.never.w == 0 and merged[p].never.m2 == 0


def test_strategies_are_columns_of_one_aggregate(spark):
    daily = days(spark, {("s", "a"): [1.0, 5.0, 2.0], ("s", "b"): [4.0]})
    m = safety.demand_moments(daily, {"flat": F.lit(1.0), "recent": safety.day_weight(daily, "recent_heavy")})
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan
    got = m.filter("product_id = 'a'").select(safety.deviation(F.col("flat"), sample=True), safety.deviation(F.col("flat"))).first()
    assert np.allclose(got, [np.std([1, 5, 2], ddof=1), np.std([1, 5, 2])])


def test_all_strategies_equal_their_single_runs(spark):
    rng = random.Random(9)
    sales = spark.createDataFrame([(dt.date(2024, 3, 1) - dt.timedelta(days=rng.randrange(400)), f"s{rng.randrange(3)}", f"p{rng.randrange(4)}", float(rng.randrange(1, 30))) for _ in range(300)],
                                  "date date, store_code string, product_id string, net_quantity double")
    both = {(r.strategy, r.store_code, r.product_id): (r.daily_avg, r.daily_std, r.safety_stock) for r in safety.compare_weighting_strategies(sales, service_level=0.95).collect()}
    assert {k[0] for k in both} == {"no_weight", *safety.STRATEGIES}
    for name in ("no_weight", "linear_decay"):
        one = safety.seasonal_safety_stock(sales, service_level=0.95, use_weighted_calculation=name != "no_weight", weight_strategy=name)
        for r in one.collect():
            assert np.allclose(both[(name, r.store_code, r.product_id)], (r.daily_avg, r.daily_std, r.safety_stock))
