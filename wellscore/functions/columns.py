"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c: str | Column, digits: int) -> Column:
    """Round like numpy/pandas ``round``: scale, round half to even, unscale.

    Spark's ``round`` rounds half up on the decimal text and ``bround`` rounds
    the decimal value, so neither matches a float pipeline; ``rint`` does.
    """
    scale = float(10**digits)
    return F.rint(col(c) * F.lit(scale)) / F.lit(scale)


def clip(c: str | Column, lo, hi) -> Column:
    """Clip to [lo, hi]; null stays null (``least``/``greatest`` would drop nulls), NaN becomes null."""
    c = col(c)
    return F.when(F.isnan(c.cast("double")), F.lit(None)).when(c < F.lit(lo), F.lit(lo)).when(c > F.lit(hi), F.lit(hi)).otherwise(c)


def norm(c: str | Column, max_val: float, min_val: float = 0.0) -> Column:
    """Scale to [0, 1] by a known range and clip; NaN counts as missing."""
    span = float(max_val - min_val)
    return clip((F.nullif(col(c).cast("double"), F.lit(float("nan"))) - F.lit(min_val)) / F.lit(span), 0.0, 1.0)


def inv(c: Column) -> Column:
    return F.lit(1.0) - c


def weighted_sum(terms: Iterable[tuple[float, Column]]) -> Column:
    """Left-to-right ``w1*t1 + w2*t2 ...``; a negative weight is written as a subtraction."""
    out = None
    for w, t in terms:
        if out is None:
            out = F.lit(float(w)) * t if w >= 0 else F.lit(0.0) - F.lit(float(-w)) * t
        elif w >= 0:
            out = out + F.lit(float(w)) * t
        else:
            out = out - F.lit(float(-w)) * t
    return out


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields null instead of raising under ANSI mode."""
    return F.try_divide(num, den)


def is_missing(df: DataFrame, c: str) -> Column:
    """Null, or NaN for floating columns (pandas counts both as missing)."""
    dtype = dict(df.dtypes)[c]
    if dtype in ("double", "float"):
        return F.col(c).isNull() | F.isnan(F.col(c))
    return F.col(c).isNull()


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into null on float/double columns only."""
    fixes = {c: F.when(F.isnan(F.col(c)), F.lit(None)).otherwise(F.col(c)) for c, t in df.dtypes if t in ("double", "float")}
    return df.withColumns(fixes) if fixes else df


def grid_mean(c: str | Column, scale: float) -> Column:
    """Exact mean of values on a 1/scale grid (2-digit scores: scale=100).

    The sum is taken over integers, so it does not depend on summation order
    (partitioning); one final division gives the same double everywhere.
    """
    x = col(c)
    return F.sum(F.rint(x * F.lit(float(scale))).cast("bigint")).cast("double") / (F.count(x).cast("double") * F.lit(float(scale)))
