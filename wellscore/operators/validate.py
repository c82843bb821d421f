"""Validation and profiling operators (V1-V8).

Every per-column statistic is computed in ONE aggregate over all columns
(partial aggregation on the executors, a single small row at the end), never
a pass per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellscore.functions.columns import grid_mean, is_missing, round_half_even


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Required names absent from ``df`` (checked on raw names, no job)."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"Missing columns: {missing}")
    return df


def column_presence(df: DataFrame, required: list[str]) -> DataFrame:
    """(column_name, present, n_values) for each required column.

    Presence comes from the schema; the non-null count of every present column
    comes from one aggregate over the table (null for an absent column).
    """
    have = set(df.columns)
    present = [c for c in required if c in have]
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in present]) if present else df.limit(1).select(F.lit(1).alias("__x"))
    structs = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(c in have).alias("present"),
            (F.col(c).cast("bigint") if c in have else F.lit(None).cast("bigint")).alias("n_values"),
        )
        for c in required
    ]
    return counts.select(F.inline(F.array(*structs)))


def table_profile(df: DataFrame) -> DataFrame:
    """(n_rows, n_cols) - the table shape."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("bigint"))


def null_counts(df: DataFrame, total_name: str = "__total__") -> DataFrame:
    """Long (column_name, null_count) with one extra row for the total.

    Null and NaN count as missing. One aggregate for all columns, then unpivot.
    """
    aggs = [F.sum(is_missing(df, c).cast("long")).alias(c) for c in df.columns]
    wide = df.agg(*aggs)
    wide = wide.select([F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in df.columns])
    total = sum((F.col(c) for c in df.columns), F.lit(0).cast("bigint"))
    wide = wide.withColumn(total_name, total)
    return wide.unpivot([], wide.columns, "column_name", "null_count")


def duplicate_count(df: DataFrame) -> DataFrame:
    """(n_rows, n_distinct, n_duplicates): rows minus distinct rows.

    ``groupBy(all columns).count()`` collapses copies map-side before the
    shuffle, so a hot group of copies never lands whole in one task.
    """
    g = df.groupBy(*df.columns).count()
    return g.agg(
        F.sum("count").cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).cast("bigint").alias("n_distinct"),
        F.sum(F.col("count") - 1).cast("bigint").alias("n_duplicates"),
    )


def class_balance(df: DataFrame, label: str = "stress_level") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def describe(df: DataFrame, c: str, digits: int = 2, grid: float | None = None, approx: bool = False) -> DataFrame:
    """count, mean, std (sample), min, 25%, 50%, 75%, max - rounded like pandas."""
    x = F.col(c)
    if approx:
        q = F.percentile_approx(x.cast("double"), [0.25, 0.5, 0.75], 10000)
    else:
        q = F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    stats = df.agg(
        F.count(x).cast("double").alias("count"),
        (grid_mean(x, grid) if grid else F.avg(x)).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.min(x).cast("double").alias("min"),
        q.alias("q"),
        F.max(x).cast("double").alias("max"),
    )
    out = stats.select(
        "count",
        "mean",
        "std",
        "min",
        F.col("q")[0].alias("p25"),
        F.col("q")[1].alias("p50"),
        F.col("q")[2].alias("p75"),
        "max",
    )
    return out.select([round_half_even(F.col(k), digits).alias(k) for k in out.columns])


def index_range_check(df: DataFrame, cols: list[str], lo: float = 0.0, hi: float = 1.01) -> DataFrame:
    """(index_name, min_value, max_value, n_null, in_range) per column, one aggregate."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"), F.sum(F.col(c).isNull().cast("long")).alias(f"{c}__nulls")]
    wide = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("index_name"),
                F.col(f"{c}__min").cast("double").alias("min_value"),
                F.col(f"{c}__max").cast("double").alias("max_value"),
                F.coalesce(F.col(f"{c}__nulls"), F.lit(0)).cast("bigint").alias("n_null"),
            )
            for c in cols
        ]
    )
    long = wide.select(F.inline(rows))
    ok = (F.col("min_value") >= F.lit(lo)) & (F.col("max_value") <= F.lit(hi)) & (F.col("n_null") == 0)
    return long.withColumn("in_range", F.coalesce(ok, F.lit(False)))


def monotone_check(df: DataFrame, label: str = "stress_level", score: str = "burnout_score") -> DataFrame:
    """Mean score per label and whether it rises over the previous label.

    The window runs over the handful of rows left after the aggregation.
    """
    means = df.groupBy(label).agg(grid_mean(score, 100).alias("mean_score"))
    w = Window.orderBy(label)
    prev = F.lag("mean_score").over(w)
    return means.select(
        label,
        F.col("mean_score"),
        prev.alias("prev_mean"),
        F.coalesce(F.col("mean_score") > prev, F.lit(True)).alias("rises"),
    )
