"""Report aggregates (R1-R8): the numbers behind the five charts.

All of them are grouped or global aggregates with partial aggregation on the
executors. Box statistics come from the counts per (group, value), which are
joined to the quartiles of their group; correlations come from sums of
products that tasks add up in numpy.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellscore.functions.columns import grid_mean, nan_to_null, round_half_even
from wellscore.operators.gramian import means, products

# Columns of the correlation report, in display order (fixed values).
CORRELATION_COLUMNS = [
    "anxiety_level", "depression", "self_esteem", "mental_health_history",
    "headache", "blood_pressure", "sleep_quality", "breathing_problem",
    "study_load", "future_career_concerns", "academic_performance",
    "peer_pressure", "bullying", "social_support", "noise_level",
    "emotional_strain", "physical_stress", "academic_pressure",
    "social_stress", "recovery_index", "burnout_score",
]

LABEL_ORDER = ["Low (0)", "Moderate (1)", "High (2)"]


def histogram(df: DataFrame, c: str = "burnout_score", bins: int = 30) -> DataFrame:
    """Equal-width histogram between min and max; the max lands in the last bin.

    Bin edges are ``first + i * (last - first) / bins`` and a value sits in the
    bin whose edges bracket it (edge corrections as a float histogram does),
    so counts agree with a NumPy-style histogram. Empty bins are kept.
    The range is one small global aggregate read before the counting pass.
    """
    df = nan_to_null(df)
    x = F.col(c).cast("double")
    r = df.agg(F.min(x).alias("mn"), F.max(x).alias("mx")).first()
    if r["mn"] is None:
        lo, hi = 0.0, 1.0
    elif r["mx"] > r["mn"]:
        lo, hi = float(r["mn"]), float(r["mx"])
    else:
        lo, hi = float(r["mn"]) - 0.5, float(r["mx"]) + 0.5
    bounds = df.where(x.isNotNull()).select(x.alias("x"), F.lit(lo).alias("first"), F.lit(hi).alias("last"))
    first, last, xx = F.col("first"), F.col("last"), F.col("x")
    step = (last - first) / F.lit(float(bins))

    def edge(i: Column) -> Column:
        return i * step + first

    raw = F.floor((xx - first) / (last - first) * F.lit(float(bins)))
    t = bounds.withColumn("i0", F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1)))
    t = t.withColumn("i1", F.when(xx < edge(F.col("i0")), F.col("i0") - 1).otherwise(F.col("i0")))
    i1 = F.col("i1")
    t = t.withColumn("bin", F.when((xx >= edge(i1 + 1)) & (i1 != bins - 1), i1 + 1).otherwise(i1).cast("int"))
    # one global aggregate with a conditional count per bin: empty bins are 0,
    # no join, partial aggregation on every executor
    per_bin = [F.count(F.when(F.col("bin") == i, 1)).cast("bigint").alias(f"b{i}") for i in range(bins)]
    agg = t.agg(F.max("first").alias("first"), F.max("last").alias("last"), *per_bin)
    long = agg.select("first", "last", F.inline(F.array(*[F.struct(F.lit(i).alias("bin"), F.col(f"b{i}").alias("n")) for i in range(bins)])))
    b = F.col("bin")
    return long.select(
        b,
        F.round(edge(b.cast("double")), 6).alias("lo_edge"),
        F.round(F.when(b == bins - 1, last).otherwise(edge((b + 1).cast("double"))), 6).alias("hi_edge"),
        F.col("n"),
    )


def center(df: DataFrame, c: str = "burnout_score", approx: bool = False) -> DataFrame:
    """Exact mean (2-digit grid, order-independent) and exact median of a column.

    A score rounded to 2 digits in [0, 100] has at most 10,001 distinct
    values, so the exact median's value->count buffer stays small at any size.
    """
    med = F.percentile_approx(F.col(c).cast("double"), 0.5, 10000) if approx else F.median(c)
    return df.agg(grid_mean(c, 100).alias("mean_score"), med.alias("median_score"))


def risk_distribution(df: DataFrame, c: str = "burnout_score", low: float = 33.0, moderate: float = 66.0) -> DataFrame:
    """Count and share (percent, 1 decimal) per band, all three bands listed."""
    x = F.col(c)
    agg = df.agg(
        F.count(F.when(x <= low, 1)).alias("Low"),
        F.count(F.when((x > low) & (x <= moderate), 1)).alias("Moderate"),
        F.count(F.when(x > moderate, 1)).alias("High"),
    )
    total = (F.col("Low") + F.col("Moderate") + F.col("High")).cast("double")
    long = agg.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("band_order"),
                        F.lit(b).alias("risk_level"),
                        F.col(b).cast("bigint").alias("n"),
                        round_half_even(F.try_divide(F.col(b) * F.lit(100.0), total), 1).alias("share_pct"),
                    )
                    for i, b in enumerate(["Low", "Moderate", "High"])
                ]
            )
        )
    )
    return long


def correlation_pairs(df: DataFrame, cols: list[str] | None = None, digits: int = 2) -> DataFrame:
    """Pearson correlation, pairwise complete, lower triangle without diagonal: (row_col, col_col, corr).

    One pass for the means and one for the sums of products about them (``gramian.products``),
    with or without missing values; the k x k result is built on the driver. A pair below two
    complete rows or with a zero-variance column gives null, as a float correlation gives NaN.
    """
    cols = [c for c in (cols or CORRELATION_COLUMNS) if c in df.columns]
    sums = products(df, cols, shift=means(df, cols)).get(None)
    r = sums.correlation() if sums else np.full((len(cols), len(cols)), np.nan)
    scale = float(10**digits)
    rows = [(cols[j], cols[i], None if np.isnan(r[j, i]) else float(np.rint(r[j, i] * scale) / scale)) for i, j in itertools.combinations(range(len(cols)), 2)]
    return df.sparkSession.createDataFrame(rows, "row_col string, col_col string, corr double")


def label_names(c: Column, names: dict[int, str] | None = None) -> Column:
    names = names or {0: "Low (0)", 1: "Moderate (1)", 2: "High (2)"}
    m = F.create_map(*itertools.chain.from_iterable((F.lit(k), F.lit(v)) for k, v in names.items()))
    return m[c]


def box_stats(df: DataFrame, group: str, c: str = "burnout_score", whis: float = 1.5, digits: int = 6, approx: bool = False) -> DataFrame:
    """Per group: quartiles, whiskers at the furthest point inside whis*IQR,
    outlier count, notch (median +- 1.57*IQR/sqrt(n)).

    The data is reduced once to (group, value, count), summed on the map side, so a
    group with most of the rows is no hot key; quartiles, whiskers and outliers come
    from those counts (a 2-digit score has at most 10,001 values a group).
    """
    x = F.col("x")
    values = nan_to_null(df).groupBy(group, F.col(c).cast("double").alias("x")).agg(F.count(F.lit(1)).alias("k"))
    if approx:
        q = nan_to_null(df).groupBy(group).agg(F.percentile_approx(F.col(c).cast("double"), [0.25, 0.5, 0.75], 10000).alias("q"), F.count(c).alias("n"))
    else:
        quart = F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("k"))
        q = values.groupBy(group).agg(quart.alias("q"), F.coalesce(F.sum(F.when(x.isNotNull(), F.col("k"))), F.lit(0)).alias("n"))
    q = q.select(group, "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("med"), F.col("q")[2].alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    q = q.withColumns({"lo_lim": F.col("q1") - F.lit(whis) * iqr, "hi_lim": F.col("q3") + F.lit(whis) * iqr})
    joined = values.join(q.select(group, "lo_lim", "hi_lim"), group)
    inside = (x >= F.col("lo_lim")) & (x <= F.col("hi_lim"))
    w = joined.groupBy(group).agg(
        F.min(F.when(inside, x)).alias("whisker_lo"),
        F.max(F.when(inside, x)).alias("whisker_hi"),
        F.coalesce(F.sum(F.when(~inside, F.col("k"))), F.lit(0)).alias("n_outliers"),
    )
    out = q.join(w, group)
    notch = F.lit(1.57) * (F.col("q3") - F.col("q1")) / F.sqrt(F.col("n").cast("double"))
    r = lambda e: F.round(e, digits)
    return out.select(
        group,
        F.col("n").cast("bigint").alias("n"),
        r(F.col("q1")).alias("q1"),
        r(F.col("med")).alias("median"),
        r(F.col("q3")).alias("q3"),
        r(F.col("whisker_lo")).alias("whisker_lo"),
        r(F.col("whisker_hi")).alias("whisker_hi"),
        F.col("n_outliers").cast("bigint").alias("n_outliers"),
        r(F.col("med") - notch).alias("notch_lo"),
        r(F.col("med") + notch).alias("notch_hi"),
    )


def mean_by_label_ordered(df: DataFrame, label_col: str = "stress_label", c: str = "burnout_score", order: list[str] | None = None) -> DataFrame:
    """Mean per label in a fixed order; a missing label gives null."""
    order = order or LABEL_ORDER
    means = df.groupBy(label_col).agg(grid_mean(c, 100).alias("mean_score"))
    wanted = df.sparkSession.createDataFrame([(i, v) for i, v in enumerate(order)], f"label_order int, {label_col} string")
    # both sides hold one row per label after aggregation; AQE picks the join
    return wanted.join(means, label_col, "left").select("label_order", label_col, "mean_score")
