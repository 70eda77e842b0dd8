"""Monthly sketches of sales (G2, G9 at scale): quantiles and distinct counts that merge.

A month's sketches are some kilobytes whatever its sales.  Kept beside the monthly extract, they
answer medians, other quantiles and distinct counts for any range of months by merging, without a scan of the
sales.  Quantiles are KLL sketches (error in rank), distinct counts HyperLogLog (relative error)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: KLL size, for which 99 % of answers are within 0.4 % of the asked rank: RANK_ERROR is some seven standard errors.
KLL_K, RANK_ERROR = 800, 0.01
#: HyperLogLog size: a standard error is 1.04 / sqrt(2^14), DISTINCT_ERROR is six.
HLL_BITS, DISTINCT_ERROR = 14, 0.05


def monthly_sketches(sales: DataFrame, value: str = "unit_price", distinct: tuple[str, ...] = ("store_code", "product_id"),
                     date_col: str = "date", keys: tuple[str, ...] = ()) -> DataFrame:
    """One row a month (and ``keys``) with ``rows``, the value's sketch ``q_<value>`` and ``d_<column>`` of each distinct
    column; rows meet in one task only as partial sketches.  NULLs count in ``rows`` alone."""
    month = F.date_format(date_col, "yyyy-MM").alias("month")
    return sales.groupBy(month, *keys).agg(
        F.count(F.lit(1)).alias("rows"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(KLL_K)).alias(f"q_{value}"),
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(HLL_BITS)).alias(f"d_{c}") for c in distinct])


def merged_range(sketches: DataFrame, first: str, last: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """The sketches of all months from ``first`` to ``last`` as one row (per ``keys``)."""
    some = sketches.filter(F.col("month").between(first, last))
    return some.groupBy(*keys).agg(F.sum("rows").alias("rows"), *_unions(sketches.columns))


def trailing_ranges(sketches: DataFrame, months: int = 3) -> DataFrame:
    """For every month the sketches of it and the ``months`` - 1 before: each month's row is sent to
    the ranges it belongs to, some kilobytes each."""
    start = F.to_date(F.concat("month", F.lit("-01")))
    ends = F.transform(F.sequence(F.lit(0), F.lit(months - 1)), lambda k: F.date_format(F.add_months(start, k), "yyyy-MM"))
    known = sketches.select(F.col("month").alias("range_end"))
    spread = sketches.withColumn("range_end", F.explode(ends)).join(known, "range_end", "left_semi")
    return spread.groupBy("range_end").agg(F.sum("rows").alias("rows"), *_unions(sketches.columns))


def _unions(columns: list[str]) -> list[Column]:
    return [(F.kll_merge_agg_double(c) if c.startswith("q_") else F.hll_union_agg(c)).alias(c) for c in columns if c.startswith(("q_", "d_"))]


def quantile(sketch: str, p: float) -> Column:
    return F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(p))


def distinct_count(sketch: str) -> Column:
    return F.hll_sketch_estimate(F.col(sketch))


def checked_ranges(sales: DataFrame, months: int = 3, value: str = "unit_price", distinct: tuple[str, ...] = ("store_code", "product_id"),
                   p: float = 0.5, date_col: str = "date") -> DataFrame:
    """The trailing ranges' estimates beside exact figures from the sales, and whether each error is
    within its bound: an audit of the sketches, which reads every sale ``months`` times."""
    estimates = trailing_ranges(monthly_sketches(sales, value, distinct, date_col), months).select(
        "range_end", quantile(f"q_{value}", p).alias("estimate"), *[distinct_count(f"d_{c}").alias(f"estimate_{c}") for c in distinct])
    start = F.trunc(date_col, "month")
    ends = F.transform(F.sequence(F.lit(0), F.lit(months - 1)), lambda k: F.date_format(F.add_months(start, k), "yyyy-MM"))
    rows = sales.select(F.explode(ends).alias("range_end"), F.col(value).cast("double").alias("v"), *distinct).join(estimates, "range_end")
    below, upto = F.sum((F.col("v") < F.col("estimate")).cast("long")), F.sum((F.col("v") <= F.col("estimate")).cast("long"))
    out = rows.groupBy("range_end", "estimate", *[f"estimate_{c}" for c in distinct]).agg(
        F.count("v").alias("n"), below.alias("below"), upto.alias("upto"), *[F.countDistinct(c).alias(c) for c in distinct])
    # the estimate holds the ranks below + 1 .. upto; the asked one is p * n
    n = F.col("n")
    near = (F.col("below") <= (p + RANK_ERROR) * n) & (F.col("upto") >= (p - RANK_ERROR) * n)
    flags = [F.abs(F.col(f"estimate_{c}") - F.col(c)) <= F.greatest(F.lit(1.0), DISTINCT_ERROR * F.col(c)) for c in distinct]
    return out.select("range_end", "n", "estimate", near.alias("quantile_ok"), *distinct,
                      *[F.col(f"estimate_{c}") for c in distinct], *[f.alias(f"{c}_ok") for c, f in zip(distinct, flags)])
