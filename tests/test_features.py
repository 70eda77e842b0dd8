import datetime as dt

from shelfcast.operators import features as feat
from shelfcast.operators.prep import SEGMENT

MONDAY = dt.date(2001, 1, 1)


def _weekly(spark, rows):
    data = [(a1, 1.0, 0, 0, "d1", "d2", "d5", MONDAY + dt.timedelta(weeks=w), q, 1.0, 1.0, 0.1, 0.1) for a1, w, q in rows]
    return spark.createDataFrame(data, "product_att_01 int, product_att_02 double, product_att_05 int, store_cluster int, "
                                       "product_att_01_desc string, product_att_02_desc string, product_att_05_desc string, "
                                       "week_start_date date, total_quantity long, unit_price_mean double, "
                                       "unit_price_median double, discount_frac_mean double, discount_frac_wavg double")


def test_rolling_is_per_segment(spark):
    # two segments x 10 weeks: 1..10 then 100..1000; the second segment's first rows must
    # not see the first segment's values (a frame over the unsorted table would leak them)
    rows = [(1, w, w + 1) for w in range(10)] + [(2, w, 100 * (w + 1)) for w in range(10)]
    w = _weekly(spark, rows)
    spec = feat.FeatureSpec()
    out = w.select(*SEGMENT, "week_start_date", *feat.rolling_columns(spec, feat.segment_window(), 2))
    seg2 = sorted((r["week_start_date"], r["mean_total_quantity_roll4_shift1"]) for r in
                  out.filter("product_att_01 = 2").collect())
    assert seg2[0][1] is None and seg2[1][1] is None       # fewer than 2 earlier rows
    assert seg2[2][1] == 150.0                              # mean(100, 200)
    assert seg2[5][1] == 350.0                              # mean(200..500)


def test_min_periods_equal_window(spark):
    rows = [(1, w, w + 1) for w in range(6)]
    out = _weekly(spark, rows).select("week_start_date", *feat.rolling_columns(feat.FeatureSpec(), feat.segment_window(), None))
    vals = [r["mean_total_quantity_roll4_shift1"] for r in out.orderBy("week_start_date").collect()]
    assert vals[:4] == [None] * 4 and vals[4] == 2.5


def test_lags_count_rows_not_weeks(spark):
    # week 2 missing: lag 1 of week 3 is week 1's value
    rows = [(1, 0, 5), (1, 1, 7), (1, 3, 11)]
    out = _weekly(spark, rows).select("week_start_date", *feat.lag_columns(feat.FeatureSpec(), feat.segment_window()))
    got = [r["total_quantity_shifted_1"] for r in out.orderBy("week_start_date").collect()]
    assert got == [None, 5, 7]


def test_pct_change_base_zero(spark):
    rows = [(1, 0, 0), (1, 1, 4), (1, 2, 6), (1, 3, 3)]
    out = _weekly(spark, rows).select("week_start_date", *feat.pct_change_columns(feat.FeatureSpec(), feat.segment_window()))
    got = [r["pct_change_1"] for r in out.orderBy("week_start_date").collect()]
    assert got == [None, None, None, 0.5]     # base 0 -> null; (6-4)/4


def test_calendar_weekly_first_tag(spark):
    cal = spark.createDataFrame([
        (dt.date(2001, 3, 1), 3, "RAMAZAN", 1, 0, 0), (dt.date(2001, 3, 2), 3, None, 1, 0, 0),
        (dt.date(2001, 3, 5), 3, None, 0, 0, 0), (dt.date(2001, 4, 1), 4, "YOK", 0, 0, 0)],
        "date date, month int, special_day_tag string, ramazan_bayrami int, kurban_bayrami int, kara_cuma int")
    got = {r["week_start_date"]: (r["month"], r["ramazan_bayrami"], r["is_special_day"])
           for r in feat.calendar_weekly(cal).collect()}
    assert got[dt.date(2001, 2, 26)] == (3, 1, 1)
    assert got[dt.date(2001, 3, 5)] == (3, 0, 0)      # no tag -> 'YOK'
    assert got[dt.date(2001, 3, 26)] == (4, 0, 0)     # 'YOK' is not special
