"""Weekly features week by week (H2): a state handed from run to run instead of the whole history.

The features of a week look back at most 53 rows of their segment and at the segment's mean.  So a
run needs, per segment, its last 53 rows and the count and sum of all its quantities: ``FeatureState``.
``next_week`` merges the state with the new weeks' aggregate, computes the features of the new rows
with the very expressions of the full run, and returns the state for the next run.  The result equals the full
run over all history up to the new weeks on every new row.

State and step are bounded by the segments, not by the history."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..profiles import Profile, get_profile
from ..session import materialize
from .features import (FeatureSpec, calendar_weekly, lag_columns, last_year_column, pct_change_columns, price_lag_columns,
                       rolling_columns, segment_window, zero_negative_target)
from .prep import SEGMENT, SEGMENT_DESCS


@dataclass
class FeatureState:
    """``rows``: each segment's last rows as the weekly aggregate has them; ``totals``: count and sum of its
    quantities (negative weeks as 0); both written tables."""

    rows: DataFrame
    totals: DataFrame


def rows_back(spec: FeatureSpec, min_back: int = 4) -> int:
    """How many earlier rows of a segment the features of a row reach."""
    rolled = max(s + n - 1 for s, windows in spec.rolls.items() for n in windows)
    return max([min_back, spec.last_year_lag, rolled, *spec.lag_set(), *(d + 1 for d in spec.pct_diffs)])


def _last_rows(rows: DataFrame, n: int) -> DataFrame:
    newest = Window.partitionBy(*SEGMENT).orderBy(F.col("week_start_date").desc(), *[F.col(c).desc() for c in SEGMENT_DESCS])
    return rows.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= n).drop("_rn")


def _totals(rows: DataFrame, spec: FeatureSpec) -> DataFrame:
    t = F.col(spec.target)
    return zero_negative_target(rows, spec.target).groupBy(*SEGMENT).agg(F.count(t).alias("n"), F.sum(t).alias("total"))


def initial_state(weekly: DataFrame, spec: FeatureSpec | None = None) -> FeatureState:
    """The state after a full history; the weekly aggregate is written once, not computed for each table."""
    spec = spec or FeatureSpec()
    weekly = materialize(weekly, "weekly-history")
    return FeatureState(materialize(_last_rows(weekly, rows_back(spec)), "feature-rows"), materialize(_totals(weekly, spec), "feature-totals"))


def next_weeks(state: FeatureState, new: DataFrame, calendar: DataFrame, profile: "Profile | str | None" = None,
               spec: FeatureSpec | None = None) -> tuple[DataFrame, FeatureState]:
    """The features of the new weeks' rows and the state after them.

    ``new`` is the weekly aggregate of weeks after all those in the state; it is written once."""
    pf, spec = get_profile(profile), spec or FeatureSpec()
    new = materialize(new, "new-weeks")
    added = _totals(new, spec)
    totals = materialize(state.totals.unionByName(added).groupBy(*SEGMENT).agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "feature-totals")
    both = state.rows.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
    # segments without a new row have no features to compute
    both = both.join(new.select(*SEGMENT).distinct(), SEGMENT, "left_semi")
    w = segment_window()
    df = zero_negative_target(both, spec.target).withColumn("week_of_year", F.weekofyear("week_start_date"))
    feats = (price_lag_columns(spec, w, pf.price_min_periods) + last_year_column(spec, w) + lag_columns(spec, w)
             + pct_change_columns(spec, w) + rolling_columns(spec, w, pf.rolling_min_periods))
    out = df.select("*", *feats).filter("_new").drop("_new")
    mean = totals.select(*SEGMENT, (F.col("total") / F.col("n")).alias("segment_mean"))
    out = out.join(mean, SEGMENT, "left").join(calendar_weekly(calendar), "week_start_date", "left")
    rows = materialize(_last_rows(state.rows.unionByName(new), rows_back(spec)), "feature-rows")
    return out, FeatureState(rows, totals)
