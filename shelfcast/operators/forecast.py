"""Twelve-week segment forecast.

One global gradient-boosted tree model over all segments (Spark ML
``GBTRegressor``, trained distributed over the segment-week frame).  The frame is
written once to the shared checkpoint folder before fitting: boosting makes one
pass per tree, and without a cut lineage every pass would re-run the window
features from the parquet scan.  Future rows freeze every non-calendar feature at
the segment's last observed value (no recursion).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import require_columns
from ..profiles import Profile, get_profile
from ..session import materialize
from .prep import SEGMENT, SEGMENT_DESCS

TARGET = "total_quantity"
DROP_COLS = ["week_start_date", TARGET] + SEGMENT_DESCS
CALENDAR_RECOMPUTED = ["month", "week_of_year"]
SPECIAL_FLAGS = ["ramazan_bayrami", "kurban_bayrami", "kara_cuma", "is_special_day"]
CATEGORICAL = ["store_cluster", "month"]
MISSING = -999999.0  # what a missing number counts as; its indicator tells it apart


def model_feature_columns(features: DataFrame) -> list[str]:
    return [c for c in features.columns if c not in DROP_COLS]


def frozen_columns(feature_cols: list[str]) -> list[str]:
    return [c for c in feature_cols if c not in SEGMENT and c not in CALENDAR_RECOMPUTED and c not in SPECIAL_FLAGS]


def model_frame(features: DataFrame) -> DataFrame:
    """(a) one row per segment-week: target summed, other features = last non-null
    (description columns order rows inside a week).

    Written as one ordered window over the segment-week with a full frame
    (``last(..., ignorenulls)`` per column) keeping the first row: a partition holds the
    rows of one segment-week, and ~70 window expressions share one Window operator,
    where ~70 ``max_by`` aggregates would generate one oversized aggregation method."""
    require_columns(features, SEGMENT + ["week_start_date", TARGET], "features")
    feats = [c for c in model_feature_columns(features) if c not in SEGMENT]
    descs = [c for c in SEGMENT_DESCS if c in features.columns] or ["week_start_date"]
    ordered = Window.partitionBy(*SEGMENT, "week_start_date").orderBy(*descs)
    full = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cols = [F.sum(TARGET).over(full).alias(TARGET)] + [F.last(c, ignorenulls=True).over(full).alias(c) for c in feats]
    out = features.select(*SEGMENT, "week_start_date", *cols, F.row_number().over(ordered).alias("_rn"))
    return out.filter(F.col("_rn") == 1).drop("_rn")


def future_grid(frame: DataFrame, horizon_weeks: int = 12) -> DataFrame:
    """Every segment x the ``horizon_weeks`` weeks after the last week of the frame."""
    last = frame.agg(F.max("week_start_date")).scalar()
    seg = frame.select(*SEGMENT).distinct()
    return seg.select(*SEGMENT, F.explode(F.sequence(F.lit(1), F.lit(horizon_weeks))).alias("h")) \
              .select(*SEGMENT, F.date_add(last, F.col("h") * 7).alias("week_start_date"))


def last_observed_features(frame: DataFrame, cols: list[str]) -> DataFrame:
    """Per segment, each feature's last non-null value in week order (one ordered
    window per segment -- its rows are the segment's weeks -- keeping one row)."""
    ordered = Window.partitionBy(*SEGMENT).orderBy("week_start_date")
    full = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = frame.select(*SEGMENT, *[F.last(c, ignorenulls=True).over(full).alias(c) for c in cols],
                       F.row_number().over(ordered).alias("_rn"))
    return out.filter(F.col("_rn") == 1).drop("_rn")


def future_features(frame: DataFrame, horizon_weeks: int = 12) -> DataFrame:
    """(c)+(d): the grid with recomputed month / ISO week, special flags 0 and every
    other feature frozen at the segment's last observed value."""
    feats = model_feature_columns(frame)
    frozen = frozen_columns(feats)
    grid = future_grid(frame, horizon_weeks)
    last = last_observed_features(frame, frozen)
    out = grid.join(last, SEGMENT, "left")
    adds = []
    if "month" in feats:
        adds.append(F.month("week_start_date").alias("month"))
    if "week_of_year" in feats:
        adds.append(F.weekofyear("week_start_date").alias("week_of_year"))
    adds += [F.lit(0).alias(c) for c in SPECIAL_FLAGS if c in feats]
    return out.select(*SEGMENT, "week_start_date", *frozen, *adds)


def fit_categories(frame: DataFrame, feature_cols: list[str]):
    """Index the categorical features; the index columns carry their categories to the trees."""
    from pyspark.ml.feature import StringIndexer
    cols = [c for c in CATEGORICAL if c in feature_cols]
    texts = frame.select(*[F.col(c).cast("string").alias(f"_s_{c}") for c in cols])
    return StringIndexer(inputCols=texts.columns, outputCols=[f"_x_{c}" for c in cols], handleInvalid="keep",
                         stringOrderType="alphabetAsc").fit(texts)


def missing_indicators(train: DataFrame, feature_cols: list[str]) -> list[str]:
    """The numeric features whose absence is a feature of its own.

    A feature that is never or always missing has no indicator, and of features that are missing in the
    very same rows only the first has one: one aggregate counts the missing values of each and sums a
    hash of their rows."""
    numeric = [c for c in feature_cols if c not in CATEGORICAL]
    row = F.xxhash64(*[F.col(c) for c in feature_cols])
    absent = [F.col(c).isNull().cast("long") for c in numeric]
    got = train.select(F.lit(1).alias("_one"), (F.pmod(row, F.lit(1 << 31)) + 1).alias("_h"), *[a.alias(f"a{i}") for i, a in enumerate(absent)]).agg(
        F.sum("_one").alias("n"), *[F.struct(F.sum(f"a{i}").alias("k"), F.sum(F.col(f"a{i}") * F.col("_h")).alias("h")).alias(f"a{i}") for i in range(len(numeric))]).first()
    kept: dict[tuple, str] = {}
    for i, c in enumerate(numeric):
        pattern = (got[f"a{i}"].k, got[f"a{i}"].h)
        if got.n and 0 < pattern[0] < got.n:
            kept.setdefault(pattern, c)
    return list(kept.values())


def _assembled(df: DataFrame, feature_cols: list[str], categories, indicators: list[str]) -> DataFrame:
    """Features as one vector: numbers, categories, and 0/1 indicators of missing numbers.  A missing or
    new category is a category of its own."""
    from pyspark.ml.feature import VectorAssembler
    numeric = [c for c in feature_cols if c not in CATEGORICAL]
    filled = df.select("*", *[F.coalesce(F.col(c).cast("double"), F.lit(MISSING)).alias(f"_x_{c}") for c in numeric],
                       *[F.col(c).cast("string").alias(f"_s_{c}") for c in feature_cols if c in CATEGORICAL],
                       *[F.col(c).isNull().cast("double").alias(f"_m_{c}") for c in indicators])
    inputs = [f"_x_{c}" for c in feature_cols] + [f"_m_{c}" for c in indicators]
    return VectorAssembler(inputCols=inputs, outputCol="features_vec", handleInvalid="keep").transform(categories.transform(filled))


@dataclass(frozen=True)
class ForecastModel:
    """A fitted learner and how its input vector is made."""

    model: object
    features: list[str]
    categories: object
    indicators: list[str]

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with a ``prediction`` column."""
        return self.model.transform(_assembled(df, self.features, self.categories, self.indicators))


def fit_forecast_model(frame: DataFrame, profile: "Profile | str | None" = None, seed: int = 42,
                       max_iter: int | None = None, checkpoint: bool = True) -> ForecastModel:
    """(b) one global GBT regressor over all segments and weeks (no hold-out)."""
    from pyspark.ml.regression import GBTRegressor
    pf = get_profile(profile)
    feats = model_feature_columns(frame)
    train = frame.select(*feats, F.col(TARGET).cast("double").alias("label"))
    if checkpoint:
        train = materialize(train, "gbt-train")
    categories, indicators = fit_categories(train, feats), missing_indicators(train, feats)
    most = max([64, *(len(labels) + 1 for labels in categories.labelsArray)])
    # boosting reads the assembled rows once per tree: keep them cached (spilling to disk
    # when large) for the fit only; the error RDD is checkpointed every 10 trees
    data = _assembled(train, feats, categories, indicators).select("features_vec", "label").persist(StorageLevel.MEMORY_AND_DISK)
    gbt = GBTRegressor(featuresCol="features_vec", labelCol="label", maxIter=max_iter or pf.gbt_max_iter,
                       maxDepth=pf.gbt_max_depth, stepSize=pf.gbt_step_size, seed=seed, maxBins=most,
                       checkpointInterval=10)
    try:
        model = gbt.fit(data)
    finally:
        data.unpersist()
    return ForecastModel(model, feats, categories, indicators)


def forecast_12w(features: DataFrame, profile: "Profile | str | None" = None, seed: int = 42,
                 max_iter: int | None = None) -> DataFrame:
    """H3: predicted weekly quantity per segment for the next weeks, clipped at 0."""
    pf = get_profile(profile)
    # the frame feeds the fit, the grid, the last week and the frozen values: materialise once
    frame = materialize(model_frame(features), "model-frame")
    fitted = fit_forecast_model(frame, pf, seed=seed, max_iter=max_iter, checkpoint=False)
    pred = fitted.predict(future_features(frame, pf.forecast_weeks))
    return pred.select(*SEGMENT, "week_start_date",
                       F.greatest(F.col("prediction"), F.lit(0.0)).alias("predicted_quantity"))
