import datetime as dt

from pyspark.sql import functions as F

from shelfcast.functions.columns import (bround_decimal, clean_attribute_code, discount_fraction,
                                         as_date, not_sentinel, number, seasonal_month_filter)


def test_clean_attribute_code(spark):
    df = spark.createDataFrame([(v,) for v in ["3", "D", "N", "1D", None, "X", "9", "999"]], "a string")
    got = dict((r["a"], r["c"]) for r in df.select("a", clean_attribute_code("a").alias("c")).collect())
    assert got == {"3": 3.0, "D": 9.0, "N": 9.0, "1D": 19.0, None: None, "X": None, "9": 9.0, "999": 999.0}


def test_sentinel_filter_keeps_nulls(spark):
    df = spark.createDataFrame([(1,), (9,), (999,), (None,)], "a int")
    kept = sorted((r[0] is None, r[0]) for r in df.filter(not_sentinel("a", [9, 999])).collect())
    assert kept == [(False, 1), (True, None)]


def test_discount_fraction_cases(spark):
    df = spark.createDataFrame([(0.0, 0.0), (5.0, -10.0), (95.0, 5.0), (None, 10.0), (2.0, None), (1.0, 3.0)],
                               "discount_amount double, net_amount_wovat double")
    frac, denom = discount_fraction()
    got = [(r[0], r[1]) for r in df.select(frac, denom).collect()]
    assert got == [(0.0, 0.0), (0.0, -5.0), (0.9, 100.0), (0.0, 10.0), (0.9, 2.0), (0.25, 4.0)]


def test_seasonal_months_wrap(spark):
    days = spark.createDataFrame([(dt.date(2000, m, 15),) for m in range(1, 13)], "d date")
    for as_of, expect in [(dt.date(2001, 1, 5), {12, 1, 2}), (dt.date(2001, 12, 5), {11, 12, 1})]:
        got = {r[0].month for r in days.filter(seasonal_month_filter("d", F.lit(as_of), 1)).collect()}
        assert got == expect


def test_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,), (0.125,)], "x double")
    assert [r[0] for r in df.select(bround_decimal("x", 0)).collect()][:4] == [0.0, 2.0, 2.0, -0.0]
    assert df.select(bround_decimal("x", 2)).collect()[4][0] == 0.12


def test_bad_dates_and_nan_become_null(spark):
    df = spark.createDataFrame([("2019-12-31", "1.5"), ("31.12.2019", "NaN"), ("", "x"), (None, None)], "d string, x string")
    got = df.select(as_date("d"), number("x")).collect()
    assert [tuple(r) for r in got] == [(dt.date(2019, 12, 31), 1.5), (None, None), (None, None), (None, None)]


def test_month_floor_needs_an_offset():
    import pytest
    from shelfcast.functions.columns import month_floor_lookback
    with pytest.raises(ValueError):
        month_floor_lookback(F.current_date())
