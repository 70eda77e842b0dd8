import datetime as dt

from shelfcast.operators.breakdown import week_length, weekly_to_daily


def _pred(spark, weeks, q=14.0):
    base = dt.date(2001, 1, 1)
    data = [("1001", "S1", base + dt.timedelta(weeks=w), q, 1.0, 1.0, 2.0, 0.0) for w in weeks]
    return spark.createDataFrame(data, "store_code string, stok_kodu string, week_start_date date, "
                                       "store_predicted_quantity double, store_cluster double, product_att_01 double, "
                                       "product_att_02 double, product_att_05 double")


def test_gap_week_stretches(spark):
    wl = week_length(_pred(spark, [0, 1, 3]))
    assert [r["n_days"] for r in wl.orderBy("week_start_date").collect()] == [7, 14, 7]


def test_daily_sum_equals_weekly(spark):
    d = weekly_to_daily(_pred(spark, [0, 1, 3]))
    got = d.orderBy("date").collect()
    assert len(got) == 7 + 14 + 7
    assert abs(sum(r["prediction_store_daily"] for r in got) - 42.0) < 1e-9
    assert got[7]["prediction_store_daily"] == 1.0     # 14 spread over 14 days
