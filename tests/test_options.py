import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from shelfcast.functions.columns import require_columns
from shelfcast.operators import prep
from shelfcast.operators.allocate import distribute_warehouse_stock
from shelfcast.sources.fixtures import Retail

SF = "/root/testdata/sf0.001"


def test_require_columns_lists_all_missing(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(KeyError) as e:
        require_columns(df, ["a", "b", "c"], "forecast")
    assert "['b', 'c']" in str(e.value)


def test_unserved_rows_option(spark):
    needs = spark.createDataFrame([("s1", "A", 3), ("s2", "A", 2), ("s3", "A", 1)],
                                  "store_code string, product_id string, ihtiyac_adet long")
    stock = spark.createDataFrame([("w1", "A", 2.0)], "alt_yer string, product_id string, miktar double")
    base = {r["alan_magaza"] for r in distribute_warehouse_stock(needs, stock).collect()}
    assert base == {"s1", "s2"}                             # s3 never reached: absent
    full = distribute_warehouse_stock(needs, stock, include_unserved=True)
    extra = [r for r in full.collect() if r["gonderen_depo"] is None]
    assert [(r["alan_magaza"], r["kalan_ihtiyac"]) for r in extra] == [("s3", 1)]


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_local_profile_weekly(spark):
    r = Retail(spark, SF)
    loc = prep.weekly_segment_sales(r.history_sales, r.dim_product, r.store_clustering, calendar=r.dim_calendar,
                                    profile="local", as_of=F.lit(r.as_of))
    prod = prep.weekly_segment_sales(r.history_sales, r.dim_product, r.store_clustering, calendar=r.dim_calendar,
                                     profile="prod", as_of=F.lit(r.as_of))
    # local: whole history, calendar weeks, truncated totals; prod: 24 months
    assert loc.count() > prod.count() > 0
    assert loc.agg(F.min("week_start_date")).collect()[0][0] < dt.date(1996, 1, 1)
    assert prod.agg(F.min("week_start_date")).collect()[0][0] >= dt.date(1999, 10, 25)


def test_median_of_counts_matches_median(spark):
    import random
    rnd = random.Random(3)
    value = lambda: rnd.choice([None, 0.0, float(rnd.randint(-9, 9)), rnd.uniform(-1e6, 1e6), rnd.random() * 1e-6, -0.5])
    rows = [(g if g else None, value()) for g in range(60) for _ in range(rnd.randint(1, 14))]
    rows += [(99, None), (99, None)]                      # all-NULL group: no median row
    df = spark.createDataFrame(rows, "g int, unit_price double")
    exact = {r[0]: r[1] for r in df.groupBy("g").agg(F.median("unit_price")).collect()}
    counts = df.groupBy("g", "unit_price").agg(F.count(F.lit(1)).alias("n"))
    got = {r[0]: r[1] for r in prep.median_of_counts(counts, ["g"], "unit_price", "n").collect()}
    assert {g: v for g, v in exact.items() if v is not None} == got


def test_weekly_plan_has_no_group_buffer(spark):
    r = Retail(spark, SF)
    weekly = prep.weekly_segment_sales(r.history_sales, r.dim_product, r.store_clustering, profile="prod", as_of=F.lit(r.as_of))
    plan = weekly._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and "median(" not in plan


def test_no_lookback_keeps_every_row(spark):
    from shelfcast.operators import universe
    r = Retail(spark, SF)
    every = universe.replenishment_sales(r.history_sales, r.dim_product, F.lit(r.as_of), "local")
    some = universe.replenishment_sales(r.history_sales, r.dim_product, F.lit(r.as_of), "prod")
    assert every.agg(F.min("date")).first()[0].year == 1995 and some.agg(F.min("date")).first()[0].year == 2001
    stock = r.store_stock
    assert universe.stock_by_day(stock, F.lit(r.as_of), None).agg(F.sum("stok_miktar")).first()[0] == stock.agg(F.sum("toplam_miktar")).first()[0]


def test_scratch_tables_are_removed(spark):
    import __spark_entry__ as E
    from shelfcast import session
    E.queries()["src_csv"](spark, SF).count()
    root = session.scratch_root(spark).removeprefix("file:")
    assert os.listdir(root)
    session.clear_scratch(spark)
    assert not os.path.exists(root)


def test_jdbc_parallelism_is_explicit(spark):
    from shelfcast.sources import io
    for kw in ({}, {"partition_column": "id"}, {"num_partitions": 4}, {"partition_column": "id", "num_partitions": 4}):
        with pytest.raises(ValueError):
            io.read_jdbc(spark, "jdbc:none", "select 1", **kw)
