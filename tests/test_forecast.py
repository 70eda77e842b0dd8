"""Forecast shape checks: segments x 12 rows, non-negative, seeded determinism."""
import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import features as feat
from shelfcast.operators import forecast as fc
from shelfcast.operators import prep
from shelfcast.profiles import PROD
from shelfcast.sources.fixtures import Retail

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def test_forecast_shape_and_determinism(spark):
    r = Retail(spark, SF)
    pf = PROD.with_(prep_lookback_months=None)
    weekly = prep.weekly_segment_sales(r.history_sales, r.dim_product, r.store_clustering, calendar=r.dim_calendar,
                                       profile=pf, as_of=F.lit(r.as_of))
    feats = feat.demand_features(weekly, r.dim_calendar, pf)
    a = fc.forecast_12w(feats, pf, seed=7, max_iter=5)
    b = fc.forecast_12w(feats, pf, seed=7, max_iter=5)
    segments = weekly.select(*prep.SEGMENT).distinct().count()
    rows_a = sorted(tuple(x) for x in a.collect())
    assert len(rows_a) == segments * 12
    assert all(x[-1] >= 0 for x in rows_a)
    assert len({x[4] for x in rows_a}) == 12                      # twelve distinct future weeks
    assert rows_a == sorted(tuple(x) for x in b.collect())        # same seed, same predictions


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01"), reason="driver test data not present")
def test_model_beats_constant_mean_on_holdout(spark):
    r = Retail(spark, "/root/testdata/sf0.01")
    pf = PROD.with_(prep_lookback_months=None)
    weekly = prep.weekly_segment_sales(r.history_sales, r.dim_product, r.store_clustering, calendar=r.dim_calendar,
                                       profile=pf, as_of=F.lit(r.as_of))
    frame = fc.model_frame(feat.demand_features(weekly, r.dim_calendar, pf))
    cutoff = frame.agg(F.date_sub(F.max("week_start_date"), 7 * 12)).first()[0]
    train, test = frame.filter(F.col("week_start_date") <= cutoff), frame.filter(F.col("week_start_date") > cutoff)
    fitted = fc.fit_forecast_model(train, pf, seed=42, max_iter=20)
    mean = train.agg(F.avg("total_quantity")).first()[0]
    pred = fitted.predict(test)
    err = pred.agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("total_quantity"), 2))).alias("m"),
                   F.sqrt(F.avg(F.pow(F.lit(mean) - F.col("total_quantity"), 2))).alias("c")).first()
    assert err["m"] < err["c"]


def _frame(spark, rows):
    return spark.createDataFrame([(1, 2.0, 3, i % 2, dt.date(2024, 1, 1) + dt.timedelta(weeks=i), q, a, b, c, d) for i, (q, a, b, c, d) in enumerate(rows)],
                                 "product_att_01 int, product_att_02 double, product_att_05 int, store_cluster int, week_start_date date, total_quantity double, a double, b double, c double, d double")


def test_a_missing_value_is_a_signal_of_its_own(spark):
    rng = random.Random(6)
    # missing means 100; present values lie on both sides of what a missing number counts as
    rows = [(100.0 if (gone := rng.random() < 0.3) else 0.0, None if gone else rng.uniform(-2e6, 2e6), rng.random(), None, 1.0 if gone else None) for _ in range(400)]
    frame = _frame(spark, rows)
    fitted = fc.fit_forecast_model(frame, PROD, seed=1, max_iter=8)
    # b is never missing, c always
    assert fitted.indicators == ["a", "d"]
    pred = [(r.total_quantity, r.prediction) for r in fitted.predict(frame).collect()]
    assert all(abs(q - p) < 10 for q, p in pred)


def test_indicators_of_the_same_rows_are_one(spark):
    rows = [(1.0, None if i < 5 else 1.0, None if i < 5 else 2.0, float(i), None if i < 7 else 3.0) for i in range(20)]
    frame = _frame(spark, rows)
    assert fc.missing_indicators(frame, fc.model_feature_columns(frame)) == ["a", "d"]
    assert fc.missing_indicators(frame.limit(0), fc.model_feature_columns(frame)) == []


def test_registered_forecasts_train_the_profile_model(spark, monkeypatch):
    from shelfcast.plans import catalog
    seen = []
    real = fc.fit_forecast_model

    def fit(frame, profile=None, seed=42, max_iter=None, checkpoint=True):
        seen.append((profile.gbt_max_iter, max_iter))
        return real(frame, profile, seed, 1, checkpoint)
    monkeypatch.setattr(fc, "fit_forecast_model", fit)
    for key in ("forecast_12w", "forecast_12w_rows", "weekly_forecast_job"):
        catalog.QUERIES[key](spark, SF)
    assert seen == [(PROD.gbt_max_iter, None)] * 3 and PROD.gbt_max_iter == 100
