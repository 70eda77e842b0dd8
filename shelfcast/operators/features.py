"""Demand features (W1-W6, G7 calendar, H2).

Every lag and rolling frame is an expression over ONE window specification
(partition = segment, order = week + description tie-break), and all of them are
built in a single ``select``.  Catalyst then plans one Exchange (hash on the
segment), one Sort and one Window operator for ~60 columns, instead of one per
column.  Frames are per segment, so a rolling window never reaches into the
previous segment; ``min_periods`` is enforced with a count over the same frame.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import as_date, first_non_null, week_start
from ..profiles import Profile, get_profile
from .prep import SEGMENT, SEGMENT_DESCS

# Feature shape of the weekly model.
SHIFTS = [1, 2, 3, 4, 5, 6, 8, 12, 24, 48, 49, 50, 51, 52]
ROLLS = {1: [4, 8], 2: [4, 8], 3: [4, 8], 8: [4], 12: [4]}
PCT_DIFFS = [1, 2, 3, 4, 8, 12]
PRICE_COLS = ["discount_frac_wavg", "discount_frac_mean", "unit_price_mean", "unit_price_median"]
LAST_YEAR_LAG = 53
CALENDAR_FLAGS = ["ramazan_bayrami", "kurban_bayrami", "kara_cuma"]


@dataclass(frozen=True)
class FeatureSpec:
    target: str = "total_quantity"
    shifts: tuple = tuple(SHIFTS)
    rolls: dict = field(default_factory=lambda: dict(ROLLS))
    pct_diffs: tuple = tuple(PCT_DIFFS)
    price_cols: tuple = tuple(PRICE_COLS)
    last_year_lag: int = LAST_YEAR_LAG

    def lag_set(self) -> list[int]:
        """Lags that become columns: the shift list plus the d+1 lags the pct changes need."""
        ks = list(self.shifts)
        for d in self.pct_diffs:
            for k in (d, d + 1):
                if k not in ks:
                    ks.append(k)
        return ks


def segment_window(order_extra: list[str] | None = None):
    order = ["week_start_date"] + (order_extra if order_extra is not None else SEGMENT_DESCS)
    return Window.partitionBy(*SEGMENT).orderBy(*order)


def _guarded(agg, c: Column, w, lo: int, hi: int, min_periods: int) -> Column:
    frame = w.rowsBetween(lo, hi)
    return F.when(F.count(c).over(frame) >= min_periods, agg(c).over(frame))


def lag_columns(spec: FeatureSpec, w) -> list[Column]:
    t = F.col(spec.target)
    return [F.lag(t, k).over(w).alias(f"{spec.target}_shifted_{k}") for k in spec.lag_set()]


def last_year_column(spec: FeatureSpec, w) -> list[Column]:
    return [F.lag(F.col(spec.target), spec.last_year_lag).over(w).alias(f"{spec.target}_last_year")]


def pct_change_columns(spec: FeatureSpec, w) -> list[Column]:
    t = F.col(spec.target)
    out = []
    for d in spec.pct_diffs:
        a, b = F.lag(t, d).over(w), F.lag(t, d + 1).over(w)
        out.append(F.try_divide((a - b).cast("double"), F.nullif(b, F.lit(0)).cast("double")).alias(f"pct_change_{d}"))
    return out


def rolling_columns(spec: FeatureSpec, w, min_periods: int | None) -> list[Column]:
    t = F.col(spec.target)
    out = []
    for s, windows in spec.rolls.items():
        for n in windows:
            mp = n if min_periods is None else min_periods
            lo, hi = -(s + n - 1), -s
            for name, agg in (("min", F.min), ("mean", F.avg), ("max", F.max)):
                out.append(_guarded(agg, t, w, lo, hi, mp).alias(f"{name}_{spec.target}_roll{n}_shift{s}"))
    return out


def price_lag_columns(spec: FeatureSpec, w, min_periods: int = 2) -> list[Column]:
    out = []
    for c in spec.price_cols:
        x = F.col(c)
        out.append(F.lag(x, 1).over(w).alias(f"{c}_l1"))
        out.append(_guarded(F.avg, x, w, -4, -1, min_periods).alias(f"{c}_ma4_l1"))
    return out


def segment_mean_column(spec: FeatureSpec, w, expanding: bool = False) -> list[Column]:
    """The segment's mean over its whole history or, expanding, over the rows before each."""
    # same partition/order as the other frames, so it shares their Window operator
    frame = w.rowsBetween(Window.unboundedPreceding, -1 if expanding else Window.unboundedFollowing)
    return [F.avg(F.col(spec.target)).over(frame).alias("segment_mean")]


def store_share(weekly: DataFrame, target: str = "total_quantity") -> DataFrame:
    """A segment-week's share of its store cluster's quantity in that week; NULL where that is 0."""
    whole = F.sum(target).over(Window.partitionBy("store_cluster", "week_start_date"))
    return weekly.withColumn("store_product_share", F.try_divide(F.col(target).cast("double"), whole.cast("double")))


#: Fixed value: what a base of zero counts as in the growth.
ZERO_BASE = 1e-5


def yoy_growth(weekly: DataFrame, target: str = "total_quantity", back: int = 1, year: int = 52) -> DataFrame:
    """Growth of the segment's quantity ``back`` weeks ago over that of ``year`` weeks before it.

    The frames are ranges of the week number, so they meet exactly those calendar weeks whatever
    weeks a segment has no row for, and all rows of a week (its descriptions) count together; where either
    week is missing the growth is NULL.  Lags over rows would slip by one week for each gap."""
    week = F.datediff("week_start_date", F.lit("1970-01-05").cast("date")) / 7
    out = weekly.withColumn("_week", F.floor(week).cast("long"))
    by_week = Window.partitionBy(*SEGMENT).orderBy("_week")
    now = F.sum(target).over(by_week.rangeBetween(-back, -back)).cast("double")
    then = F.sum(target).over(by_week.rangeBetween(-back - year, -back - year)).cast("double")
    base = F.when(then == 0, F.lit(ZERO_BASE)).otherwise(then)
    return out.select(*weekly.columns, now.alias("quantity_back"), then.alias("quantity_year_before"), ((now - then) / base).alias("yoy_growth"))


def dense_weeks(weekly: DataFrame, target: str = "total_quantity") -> DataFrame:
    """Every week between a segment's first and last one: missing weeks have quantity 0."""
    keys = SEGMENT + SEGMENT_DESCS
    span = weekly.groupBy(*keys).agg(F.min("week_start_date").alias("lo"), F.max("week_start_date").alias("hi"))
    spine = span.select(*keys, F.explode(F.sequence("lo", "hi", F.expr("interval 7 days"))).alias("week_start_date"))
    return spine.join(weekly, [*keys, "week_start_date"], "left").withColumn(target, F.coalesce(target, F.lit(0)))


def zero_negative_target(weekly: DataFrame, target: str = "total_quantity") -> DataFrame:
    t = F.col(target)
    return weekly.withColumn(target, F.when(t < 0, F.lit(0)).otherwise(t))


def calendar_weekly(calendar: DataFrame) -> DataFrame:
    """Per week the first month, first non-null tag ('YOK' if none), max of flags."""
    cal = calendar.select(as_date("date").alias("date"), "month", "special_day_tag", *CALENDAR_FLAGS)
    tag = F.coalesce(first_non_null("special_day_tag", "date"), F.lit("YOK"))
    g = cal.groupBy(week_start("date").alias("week_start_date")).agg(
        first_non_null("month", "date").alias("month"),
        tag.alias("special_day_tag"),
        *[F.max(c).alias(c) for c in CALENDAR_FLAGS])
    return g.select("week_start_date", "month", *CALENDAR_FLAGS,
                    (F.col("special_day_tag") != "YOK").cast("int").alias("is_special_day"))


def demand_features(weekly: DataFrame, calendar: DataFrame, profile: "Profile | str | None" = None,
                    spec: FeatureSpec | None = None, densify: bool = False, expanding: bool = False) -> DataFrame:
    """H2: weekly segment sales + lag / rolling / pct-change / price features + weekly calendar.

    ``densify`` counts lags in calendar weeks instead of observed rows; ``expanding`` keeps the
    segment mean free of the present and the future."""
    pf = get_profile(profile)
    spec = spec or FeatureSpec()
    weekly = dense_weeks(weekly, spec.target) if densify else weekly
    df = zero_negative_target(weekly, spec.target).withColumn("week_of_year", F.weekofyear("week_start_date"))
    w = segment_window()
    feats = (price_lag_columns(spec, w, pf.price_min_periods) + last_year_column(spec, w)
             + lag_columns(spec, w) + pct_change_columns(spec, w)
             + rolling_columns(spec, w, pf.rolling_min_periods) + segment_mean_column(spec, w, expanding))
    out = df.select("*", *feats)
    return out.join(calendar_weekly(calendar), "week_start_date", "left")
