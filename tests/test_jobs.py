"""Both jobs end to end on the smallest driver tables, checked by invariants."""
import os

import pytest
from pyspark.sql import functions as F

from shelfcast.plans.jobs import daily_replenishment_job, weekly_forecast_job
from shelfcast.sources.fixtures import Retail, naive_weekly_forecast

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def outputs(spark):
    r = Retail(spark, SF)
    wk = weekly_forecast_job(r.history_sales, r.dim_product, r.store_clustering, r.dim_calendar, F.lit(r.as_of),
                             profile="prod", forecaster=lambda weekly, feats: naive_weekly_forecast(weekly))
    dy = daily_replenishment_job(r.history_sales, r.dim_product, r.store_stock, r.warehouse_stock, r.stock_movement,
                                 wk.daily, F.lit(r.as_of), profile="prod")
    return wk, dy


def test_store_ratios_sum_to_one_or_zero(outputs):
    wk, _ = outputs
    sums = wk.breakdown.groupBy("week_start_date", "store_cluster", "product_att_01", "product_att_02", "product_att_05") \
        .agg(F.sum("store_ratio").alias("s")).collect()
    assert sums and all(abs(r["s"] - 1) < 1e-9 or r["s"] == 0 for r in sums)


def test_daily_preserves_weekly_total(outputs):
    wk, _ = outputs
    weekly = wk.breakdown.agg(F.sum("store_predicted_quantity")).collect()[0][0]
    daily = wk.daily.agg(F.sum("prediction_store_daily")).collect()[0][0]
    assert abs(weekly - daily) < 1e-6 * max(1.0, weekly)


def test_weights_sum_to_one(outputs):
    _, dy = outputs
    sums = dy.weights.groupBy("store_code", "stok_kodu").agg(F.sum("weight").alias("s")).collect()
    assert all(r["s"] is None or abs(r["s"] - 1) < 1e-9 for r in sums)


def test_need_and_allocation_bounds(outputs, spark):
    _, dy = outputs
    assert dy.results.filter(F.col("ihtiyac_adet") < 0).count() == 0
    d = dy.distribution
    assert d.filter(F.col("karsilanan_adet") > F.col("ihtiyac_adet")).count() == 0
    assert d.filter((F.col("gonderen_depo") != "STOK_YOK") & (F.col("depo_kalan_nihai") < -1e-9)).count() == 0
    shipped = d.groupBy("urun").agg(F.sum("karsilanan_adet").alias("s"))
    need = dy.results.groupBy(F.col("product_id").alias("urun")).agg(F.sum("ihtiyac_adet").alias("n"))
    assert shipped.join(need, "urun").filter(F.col("s") > F.col("n")).count() == 0


def test_base_does_not_run_need_and_allocation(spark, outputs, monkeypatch):
    """What reads the base alone writes no need table and no input of the allocation."""
    from shelfcast import session
    from shelfcast.operators import allocate
    from shelfcast.plans import jobs
    written = []
    for module in (jobs, allocate):
        monkeypatch.setattr(module, "materialize", lambda df, name="stage": written.append(name) or session.materialize(df, name))
    wk, dy = outputs
    r = Retail(spark, SF)
    job = daily_replenishment_job(r.history_sales, r.dim_product, r.store_stock, r.warehouse_stock, r.stock_movement,
                                  wk.daily, F.lit(r.as_of), profile="prod")
    assert job.base.count() == dy.base.count() and not written
    assert job.results.count() == dy.results.count() and written == ["stage"]
    assert job.distribution.count() == dy.distribution.count() and written == ["stage", "alloc-needs", "alloc-stock"]


def test_fused_profile_runs(spark, outputs):
    wk, _ = outputs
    r = Retail(spark, SF)
    dy = daily_replenishment_job(r.history_sales, r.dim_product, r.store_stock, r.warehouse_stock, r.stock_movement,
                                 wk.daily, F.lit(r.as_of), profile="fused")
    prod_pairs = daily_replenishment_job(r.history_sales, r.dim_product, r.store_stock, r.warehouse_stock,
                                         r.stock_movement, wk.daily, F.lit(r.as_of), profile="prod").pairs.count()
    assert dy.pairs.count() >= prod_pairs          # forecast pairs widen the universe
    assert dy.results.filter(F.col("ihtiyac_adet") < 0).count() == 0
    assert "OUL_14" in dy.results.columns           # kept by the local/fused rules


def test_star_shuffles_only_unbucketed_sides(spark, outputs):
    """Merge joins (no side broadcast): the universe and the prediction are each dealt once by (store, product), the
    orders by their own aggregate; the sides that come from the bucketed tables never are."""
    wk, dy = outputs
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        from shelfcast.operators import need, safety, universe
        end = F.lit(dy.sales.agg(F.max("date")).first()[0])
        alone = {"safety": safety.seasonal_safety_stock(dy.sales, end), "windows": need.sales_7_14_28(dy.sales, end),
                 "on_hand": universe.latest_stock(dy.stock)}
        for name, side in alone.items():
            plan = side._jdf.queryExecution().executedPlan().toString()
            assert "Exchange hashpartitioning" not in plan and "Bucketed: true" in plan, name
        r = Retail(spark, SF)
        base = daily_replenishment_job(r.history_sales, r.dim_product, r.store_stock, r.warehouse_stock, r.stock_movement,
                                       wk.daily, F.lit(r.as_of), profile="prod").base
        plan = base._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    joins = [line for line in plan.splitlines() if "SortMergeJoin [store_code#" in line and "product_id#" in line and "LeftOuter" in line and "stok_kodu" not in line]
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(store_code#" in line and ", product_id#" in line and "stok_kodu" not in line]
    assert len(joins) == 5 and len(dealt) == 2, plan
    assert sorted(map(tuple, base.collect()), key=str) == sorted(map(tuple, dy.base.collect()), key=str)


def test_a_forecast_arrives_whole_or_is_flagged(outputs):
    from shelfcast.operators.audit import forecast_conservation
    wk, _ = outputs
    rows = forecast_conservation(wk.forecast, wk.breakdown, wk.daily).collect()
    assert rows and all(r.stores_ok and r.days_ok and r.n_weeks == 12 for r in rows) and any(r.n_pairs for r in rows)
    assert abs(sum(r.predicted_quantity for r in rows) - wk.forecast.agg(F.sum("predicted_quantity")).first()[0]) < 1e-6
    # a lost store and a lost day are seen in their segments only
    pair = wk.breakdown.filter("store_ratio > 0.1 AND store_ratio < 0.9 AND store_predicted_quantity > 0").orderBy("store_code", "stok_kodu").first()
    here = (F.col("store_code") == pair.store_code) & (F.col("stok_kodu") == pair.stok_kodu)
    lost = forecast_conservation(wk.forecast, wk.breakdown.filter(~here), wk.daily).filter("NOT stores_ok").collect()
    assert len(lost) == 1 and lost[0].store_cluster == pair.store_cluster
    day = wk.daily.filter(here).filter("prediction_store_daily > 0").agg(F.min("date")).first()[0]
    short = forecast_conservation(wk.forecast, wk.breakdown, wk.daily.filter(~(here & (F.col("date") == F.lit(day))))).collect()
    assert [r.store_cluster for r in short if not r.days_ok] == [pair.store_cluster] and all(r.stores_ok for r in short)
