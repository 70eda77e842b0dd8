"""Column expressions shared by the operators.

All of these are built-in Catalyst expressions, so they stay inside whole-stage
codegen.  They encode the null / rounding rules the pipeline depends on:
pandas keeps NaN rows in ``x != v`` filters, skips NaN in means, rounds half to
even, and yields NaN (not an error) on division by zero.
"""

from __future__ import annotations

import statistics
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: "str | Column") -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_attribute_code(c: "str | Column") -> Column:
    """'D' and 'N' mean 'no value' and map to 9; the rest is parsed as a number.

    Anything that does not parse becomes NULL instead of failing the job.
    """
    return F.expr("try_cast(translate(cast({} as string), 'DN', '99') as double)".format(_sql(c)))


def _sql(c: "str | Column") -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("pass a column name")


def not_sentinel(c: "str | Column", values: Iterable) -> Column:
    """True unless the value equals one of ``values``; NULL rows are kept."""
    cond = F.lit(True)
    for v in values:
        cond = cond & ~col(c).eqNullSafe(F.lit(v))
    return cond


def number(c: "str | Column") -> Column:
    """A double, NULL where the value does not parse or is not a number (NaN)."""
    x = col(c).try_cast("double")
    return F.when(~F.isnan(x), x)


def as_date(c: "str | Column") -> Column:
    """A DATE, NULL where the value does not parse."""
    return col(c).try_cast("date")


def clip(c: "str | Column", lo=None, hi=None, keep_null: bool = True) -> Column:
    """Bound a value; NULL stays NULL (pandas ``clip`` semantics)."""
    x = col(c)
    out = x
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    if keep_null:
        out = F.when(x.isNotNull(), out)
    return out


def discount_fraction(discount: str = "discount_amount", net: str = "net_amount_wovat",
                      cap: float = 0.9) -> tuple[Column, Column]:
    """(discount_frac, rev_pre_disc): d / (d + n) when the denominator is positive, else 0,
    bounded to [0, cap]; missing parts count as 0."""
    d = F.coalesce(F.col(discount), F.lit(0.0))
    n = F.coalesce(F.col(net), F.lit(0.0))
    denom = d + n
    frac = F.when(denom > 0, d / denom).otherwise(F.lit(0.0))
    return F.least(F.greatest(frac, F.lit(0.0)), F.lit(cap)), denom


def week_start(c: "str | Column") -> Column:
    """Monday of the week, as a DATE."""
    return F.trunc(as_date(c), "week")


def month_floor_lookback(as_of: Column, months: int = 0, days: int = 0, weeks: int = 0) -> Column:
    """First day of the month of (as_of - N days/weeks/months)."""
    if not (months or days or weeks):
        raise ValueError("month_floor_lookback needs an offset; leave the filter out to keep all rows")
    d = as_of
    if days or weeks:
        d = F.date_sub(d, days + 7 * weeks)
    if months:
        d = F.add_months(d, -months)
    return F.trunc(d, "month")


def seasonal_month_filter(date_col: "str | Column", as_of: Column, window: int = 1) -> Column:
    """month(date) is within +-window months of month(as_of), any year (lazy form)."""
    m = F.month(col(date_col))
    cm = F.month(as_of)
    dist = F.pmod(m - cm, F.lit(12))
    return (dist <= window) | (dist >= 12 - window)


def z_value(service_level: float) -> float:
    """Inverse standard normal CDF (a driver-side constant)."""
    return statistics.NormalDist().inv_cdf(service_level)


def first_non_null(value: "str | Column", order: "str | Column") -> Column:
    v = col(value)
    return F.min_by(v, F.when(v.isNotNull(), col(order)))


def require_columns(df, cols: Iterable[str], what: str = "input") -> None:
    """Analysis-time key validation with a message listing every missing column."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"{what} is missing column(s): {missing}")


def bround_decimal(c: "str | Column", scale: int = 0) -> Column:
    """Half-even rounding of a double through DECIMAL(38,10).

    Rounding the decimal value (not the binary double) makes x.xx5 ties behave the
    same on every engine; the result is a double again."""
    from pyspark.sql import types as T
    return F.bround(col(c).cast(T.DecimalType(38, 10)), scale).cast("double")
