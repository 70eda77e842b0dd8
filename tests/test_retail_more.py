"""Store share, year-on-year growth, fulfilment levels, sums with medians, sketches."""
import datetime as dt
import random
import statistics

import numpy as np
from pyspark.sql import functions as F

from shelfcast.operators import allocate, features, prep, sketches

SEG = "product_att_01 int, product_att_02 int, product_att_05 int, store_cluster int, product_att_01_desc string, product_att_02_desc string, product_att_05_desc string, week_start_date date, total_quantity long"
MONDAY = dt.date(2022, 1, 3)


def weekly(spark, rows):
    return spark.createDataFrame([(1, 2, 3, c, d, "b", "c", MONDAY + dt.timedelta(weeks=w), q) for c, d, w, q in rows], SEG)


def test_growth_meets_calendar_weeks_across_gaps(spark):
    # week 52 has no row, nor has most of the year: a lag over rows would take other weeks
    rows = [(0, "x", 0, 10), (0, "y", 0, 5), (0, "x", 1, 0), (0, "x", 2, 7), (0, "x", 52, 30), (0, "x", 53, 3), (0, "x", 54, 9), (1, "x", 53, 4)]
    got = {(r.store_cluster, r.product_att_01_desc, (r.week_start_date - MONDAY).days // 7): (r.quantity_back, r.quantity_year_before, r.yoy_growth)
           for r in features.yoy_growth(weekly(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert got[(0, "x", 53)] == (30.0, 15.0, 1.0)              # both descriptions of week 0 count
    assert got[(0, "x", 54)] == (3.0, 0.0, 3.0 / 1e-5)         # a base of zero
    assert got[(0, "x", 52)] == (None, None, None) and got[(0, "x", 1)] == (15.0, None, None)
    assert got[(1, "x", 53)] == (None, None, None)             # another segment
    plan = features.yoy_growth(weekly(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "RangeFrame" in plan and plan.count("Exchange hashpartitioning") <= 1


def test_store_share(spark):
    rows = [(0, "x", 0, 6), (0, "y", 0, 2), (1, "x", 0, 5), (2, "x", 0, 0)]
    got = {(r.store_cluster, r.product_att_01_desc): r.store_product_share for r in features.store_share(weekly(spark, rows)).collect()}
    assert got == {(0, "x"): 0.75, (0, "y"): 0.25, (1, "x"): 1.0, (2, "x"): None}


def test_levels_add_up(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["w1", "w2", None]), f"s{i}", rng.choice("ABC"), rng.randrange(1, 9)) for i in range(60)]
    d = spark.createDataFrame([(w, s, p, n, n // 2, n - n // 2) for w, s, p, n in rows], "gonderen_depo string, alan_magaza string, urun string, ihtiyac_adet long, karsilanan_adet long, kalan_ihtiyac long")
    out = allocate.fulfilment_levels(d)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 1
    got = out.collect()
    for level in ("all", "warehouse", "product", "both"):
        some = [r for r in got if r.level == level]
        assert sum(r.total_need for r in some) == sum(n for *_, n in rows) and sum(r["rows"] for r in some) == 60
        assert all(abs(r.fill_rate - r.total_shipped / r.total_need) < 1e-12 for r in some)
    # rows without a warehouse are a group of their own, not the total
    assert {r.gonderen_depo for r in got if r.level == "warehouse"} == {"w1", "w2", None}
    assert len([r for r in got if r.level == "all"]) == 1


def test_sums_and_median_against_python(spark):
    rng = random.Random(8)
    rows = [(g, rng.choice([None, -3.5, 0.0, 1e-12, 2.0, 2.001, 7.25, 1e6]) if g < 40 else None, rng.randrange(1, 5), rng.random()) for g in range(45) for _ in range(rng.randrange(1, 9))]
    counts = spark.createDataFrame(rows, "g int, v double, n long, q double").groupBy("g", "v").agg(F.sum("n").alias("n"), F.sum("q").alias("q"))
    got = {r.g: r for r in prep.sums_and_median(counts, ["g"], ["n", "q"], "v", "n", "m").collect()}
    old = {r.g: r.m for r in prep.median_of_counts(counts, ["g"], "v", "n", "m").collect()}
    for g in range(45):
        own = [r for r in rows if r[0] == g]
        values = [v for _, v, n, _ in own if v is not None for _ in range(n)]
        assert got[g].n == sum(r[2] for r in own) and abs(got[g].q - sum(r[3] for r in own)) < 1e-9
        assert got[g].m == (statistics.median(values) if values else None) == old.get(g)


def test_weekly_aggregate_reads_the_sales_once(spark):
    """The sums and the median come from one pass over the sales, whatever the optimizer prunes for either."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    days = [dt.date(2024, 1, 1) + dt.timedelta(days=d) for d in range(14)]
    rows = [(d, "s1", f"p{i % 3}", float(1 + i % 4), 0.5, float(10 + i)) for i, d in enumerate(days * 5)]
    schema = "date date, store_code string, product_id string, net_quantity double, discount_amount double, net_amount_wovat double"
    sales_rows = spark.createDataFrame(rows, schema)
    product = spark.createDataFrame([(f"p{i}", 1, "2", 3, "a", "b", "c") for i in range(3)], "product_id string, product_att_01 int, product_att_02 string, product_att_05 int, product_att_01_desc string, product_att_02_desc string, product_att_05_desc string")
    clusters = spark.createDataFrame([("s1", 1)], "store_code string, store_cluster int")
    profile = prep.get_profile("prod").with_(prep_lookback_months=None)
    got = prep.weekly_segment_sales(sales_rows.mapInArrow(counted, schema), product, clusters, profile=profile).orderBy("week_start_date").collect()
    assert [r.total_quantity for r in got] == [round(sum(x[3] for x in rows if x[0] in days[w:w + 7])) for w in (0, 7)]
    for r in got:
        daily = {}
        for d, _, p, q, _, a in rows:
            if r.week_start_date <= d < r.week_start_date + dt.timedelta(days=7):
                n, m = daily.get((d, p), (0.0, 0.0))
                daily[d, p] = n + q, m + a
        assert abs(r.unit_price_median - statistics.median(m / n for n, m in daily.values())) < 1e-9
    assert read.value == len(rows)


def sales(spark, n=4000, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=int(d)), f"s{s}", f"p{p}", None if p % 50 == 0 else float(v))
            for d, s, p, v in zip(rng.integers(0, 200, n), rng.integers(0, 30, n), rng.integers(0, 900, n), rng.gamma(2, 30, n))]
    return spark.createDataFrame(rows, "date date, store_code string, product_id string, unit_price double"), rows


def test_sketches_merge_over_any_range(spark):
    df, rows = sales(spark)
    kept = sketches.monthly_sketches(df)
    assert kept.count() == 7
    one = sketches.merged_range(kept, "2024-02", "2024-05").select("rows", sketches.quantile("q_unit_price", 0.9).alias("q"), sketches.distinct_count("d_product_id").alias("d")).first()
    own = [r for r in rows if dt.date(2024, 2, 1) <= r[0] < dt.date(2024, 6, 1)]
    prices = sorted(r[3] for r in own if r[3] is not None)
    rank = sum(v <= one.q for v in prices) / len(prices)
    assert one.rows == len(own) and abs(rank - 0.9) <= sketches.RANK_ERROR
    assert abs(one.d - len({r[2] for r in own})) <= sketches.DISTINCT_ERROR * len({r[2] for r in own})


def test_ranges_are_checked_against_exact_figures(spark):
    df, rows = sales(spark, seed=3)
    got = {r.range_end: r for r in sketches.checked_ranges(df).collect()}
    assert sorted(got) == [f"2024-0{m}" for m in range(1, 8)]
    for end, r in got.items():
        m = int(end[-1])
        own = [x for x in rows if m - 2 <= x[0].month <= m]
        assert r.n == sum(x[3] is not None for x in own) and r.store_code == len({x[1] for x in own}) and r.product_id == len({x[2] for x in own})
        assert r.quantile_ok and r.store_code_ok and r.product_id_ok
    # a wrong estimate is flagged: the bound is checked, not assumed
    off = df.withColumn("unit_price", F.lit(1.0) + F.monotonically_increasing_id())
    kept = sketches.monthly_sketches(off)
    q = sketches.merged_range(kept, "2024-01", "2024-07").select(sketches.quantile("q_unit_price", 0.9)).first()[0]
    assert off.filter(F.col("unit_price") <= q).count() / off.count() > 0.5 + sketches.RANK_ERROR
