"""The weekly run from its state against the full run."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import features, incremental
from shelfcast.profiles import PROD

MONDAY = dt.date(2021, 1, 4)
SCHEMA = ("product_att_01 int, product_att_02 double, product_att_05 int, store_cluster int, product_att_01_desc string, "
          "product_att_02_desc string, product_att_05_desc string, week_start_date date, total_quantity long, unit_price_mean double, "
          "unit_price_median double, discount_frac_mean double, discount_frac_wavg double")


def history(weeks=75, seed=3):
    rng = random.Random(seed)
    rows = []
    for seg in range(5):
        for w in range(weeks):
            if seg == 3 and w < weeks - 2 or rng.random() < 0.1 * seg:      # a new segment; gaps
                continue
            for desc in ("x", "y") if seg == 1 and w % 3 == 0 else ("x",):   # two rows a week
                price = rng.choice([None, rng.uniform(1, 90)])
                rows.append((seg, 2.0, seg % 2, 0, desc, "b", "c", MONDAY + dt.timedelta(weeks=w), rng.randrange(-3, 40), price, price, rng.random(), None if rng.random() < 0.2 else rng.random()))
    return rows


@pytest.fixture(scope="module")
def calendar(spark):
    days = [(MONDAY + dt.timedelta(days=d), 1 + d % 12, "TAG" if d % 31 == 0 else None, d % 2, 0, 0) for d in range(76 * 7)]
    return spark.createDataFrame(days, "date date, month int, special_day_tag string, ramazan_bayrami int, kurban_bayrami int, kara_cuma int")


def same(a, b):
    return len(a) == len(b) and all(x == y or isinstance(x, float) and abs(x - y) <= 1e-9 * max(1, abs(x)) for r, s in zip(a, b) for x, y in zip(r, s))


def in_order(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_each_step_equals_the_full_run(spark, calendar):
    rows = history()
    frame = lambda some: spark.createDataFrame(some, SCHEMA)
    week = lambda r: (r[7] - MONDAY).days // 7
    state = incremental.initial_state(frame([r for r in rows if week(r) < 71]))
    for first, after in ((71, 72), (72, 74), (74, 75)):                       # one week, two at once, one
        out, state = incremental.next_weeks(state, frame([r for r in rows if first <= week(r) < after]), calendar, PROD)
        upto = features.demand_features(frame([r for r in rows if week(r) < after]), calendar, PROD)
        want = upto.filter(F.col("week_start_date") >= MONDAY + dt.timedelta(weeks=first))
        assert set(out.columns) == set(want.columns)
        assert same(in_order(out), in_order(want)) and out.count() > 0
    # the state stays as small as it was
    most = state.rows.groupBy("product_att_01").count().agg(F.max("count")).first()[0]
    assert most == incremental.rows_back(features.FeatureSpec()) == 53


def test_a_step_reads_only_state_and_new_weeks(spark, calendar):
    rows = history()
    state = incremental.initial_state(spark.createDataFrame(rows[:200], SCHEMA))
    out, after = incremental.next_weeks(state, spark.createDataFrame(rows[200:], SCHEMA), calendar, PROD)
    files = {f.rsplit("/", 2)[1].rsplit("-", 1)[0] for f in out.inputFiles()}
    assert files <= {"feature-rows", "feature-totals", "new-weeks"}


def test_the_first_state_reads_the_history_once(spark, tmp_path, monkeypatch):
    path, reads, write = str(tmp_path / "weekly"), [], incremental.materialize
    spark.createDataFrame(history(weeks=8), SCHEMA).write.parquet(path)
    monkeypatch.setattr(incremental, "materialize", lambda df, name="stage": reads.append(any(path in f for f in df.inputFiles())) or write(df, name))
    state = incremental.initial_state(spark.read.parquet(path))
    assert reads.count(True) == 1 and state.totals.count() == 5 and state.rows.count() == len(history(weeks=8))


def test_no_new_rows(spark, calendar):
    state = incremental.initial_state(spark.createDataFrame(history()[:50], SCHEMA))
    out, after = incremental.next_weeks(state, spark.createDataFrame([], SCHEMA), calendar, PROD)
    assert out.count() == 0 and after.rows.count() == state.rows.count()
