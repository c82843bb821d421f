"""Cleaning operators (P1-P9): names, imputation, dedupe, IQR clip, one-hot.

Statistics (medians, modes, quartiles) are computed for all columns in ONE
aggregate. The result is a single small row; where it decides the output
schema (which columns get imputed, which categories become columns) it is
read on the driver at plan time - one row, never the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellscore.functions.columns import is_missing, nan_to_null
from wellscore.operators.quantiles import mode, quantiles

NUMERIC = ("int", "bigint", "smallint", "tinyint", "double", "float")


def standard_name(c: str) -> str:
    return c.strip().lower().replace(" ", "_")


def standardize_names(df: DataFrame) -> DataFrame:
    """Trim, lower-case, spaces to underscores; refuse name collisions."""
    new = [standard_name(c) for c in df.columns]
    dupes = sorted({n for n in new if new.count(n) > 1})
    if dupes:
        raise ValueError(f"standardised names collide: {dupes}")
    return df.toDF(*new)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [c for c, t in df.dtypes if (t in NUMERIC or t.startswith("decimal")) and c not in exclude]


def other_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [c for c, t in df.dtypes if not (t in NUMERIC or t.startswith("decimal")) and c not in exclude]


def missing_stats(df: DataFrame, approx: bool = False, key_cols: tuple[str, ...] = ()) -> dict:
    """{column: (missing, fill)}: one aggregate counts what is missing; median or mode only where something is.

    Medians and modes come from distributed value counts (``approx``: medians from one bounded
    sketch). Key columns get no fill.
    """
    row = df.agg(*[F.sum(is_missing(df, c).cast("long")).alias(c) for c in df.columns]).first().asDict()
    num = set(numeric_columns(df))
    open_cols = [c for c in df.columns if row[c] and c not in key_cols]
    fills = {c: mode(df, c) for c in open_cols if c not in num}
    medians = [c for c in open_cols if c in num]
    if medians and approx:
        clean = [F.percentile_approx(F.when(~is_missing(df, c), F.col(c)), 0.5, 10000).cast("double").alias(c) for c in medians]
        fills |= df.agg(*clean).first().asDict()
    elif medians:
        fills |= {r["column_name"]: r["value"] for r in quantiles(df, medians, [0.5]).collect()}  # one row per column
    return {c: (row[c] or 0, fills.get(c)) for c in df.columns}


def impute(
    df: DataFrame, numeric: bool = True, other: bool = True, stats: dict | None = None, approx: bool = False, key_cols: tuple[str, ...] = ()
) -> DataFrame:
    """Median for numeric columns with missing values, mode for the others.

    A numeric column that gets imputed becomes double (the median may be
    fractional); an all-missing column stays missing.
    """
    stats = stats or missing_stats(df, approx, key_cols)
    num = set(numeric_columns(df))
    fixes = {}
    for c in df.columns:
        n_missing, fill = stats[c]
        if n_missing == 0:
            continue
        if c in num and numeric:
            x = F.col(c).cast("double")
            x = F.when(F.isnan(x), F.lit(None)).otherwise(x)
            fixes[c] = F.coalesce(x, F.lit(fill).cast("double")) if fill is not None else x
        elif c not in num and other and fill is not None:
            fixes[c] = F.coalesce(F.col(c), F.lit(fill))
    return df.withColumns(fixes) if fixes else df


def dedupe(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows (map-side partial dedupe before the shuffle)."""
    return df.dropDuplicates()


def iqr_bounds(df: DataFrame, cols: list[str], threshold: float = 1.5, approx: bool = False) -> DataFrame:
    """Long (column_name, q1, q3, lower, upper) with linear quartiles; nulls for a column without values."""
    names = F.array(*[F.lit(c) for c in cols])
    if approx:
        wide = df.agg(*[F.percentile_approx(F.col(c).cast("double"), [0.25, 0.75], 10000).alias(c) for c in cols])
        long = wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c)[0].alias("q1"), F.col(c)[1].alias("q3")) for c in cols])))
    else:
        q = quantiles(df, cols, [0.25, 0.75]).groupBy("column_name")
        q = q.agg(F.max(F.when(F.col("prob") < 0.5, F.col("value"))).alias("q1"), F.max(F.when(F.col("prob") > 0.5, F.col("value"))).alias("q3"))
        long = df.sparkSession.range(1).select(F.explode(names).alias("column_name")).join(q, "column_name", "left")
    t = F.lit(float(threshold))
    iqr = F.col("q3") - F.col("q1")
    return long.withColumns({"lower": F.col("q1") - t * iqr, "upper": F.col("q3") + t * iqr})


def _bounds_row(df: DataFrame, cols: list[str], threshold: float, approx: bool) -> dict:
    """{c: {lower, upper}} from ONE aggregate over all columns (a single small row)."""
    rows = iqr_bounds(df, cols, threshold, approx).collect()
    return {r["column_name"]: {"lower": F.lit(r["lower"]).cast("double"), "upper": F.lit(r["upper"]).cast("double")} for r in rows}


def iqr_clip(df: DataFrame, cols: list[str], threshold: float = 1.5, approx: bool = False) -> DataFrame:
    """Clip each column to its IQR bounds (as double); null stays null, NaN becomes null."""
    df = nan_to_null(df)
    b = _bounds_row(df, cols, threshold, approx)
    fixes = {}
    for c in cols:
        x = F.col(c).cast("double")
        lo, hi = b[c]["lower"], b[c]["upper"]
        fixes[c] = F.when(x < lo, lo).when(x > hi, hi).otherwise(x)
    return df.withColumns(fixes)


def outlier_counts(df: DataFrame, cols: list[str], threshold: float = 1.5, total_name: str = "__total__", approx: bool = False) -> DataFrame:
    """Long (column_name, n_clipped) of values outside the IQR bounds, plus a total row."""
    df = nan_to_null(df)
    b = _bounds_row(df, cols, threshold, approx)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs.append(F.coalesce(F.sum(((x < b[c]["lower"]) | (x > b[c]["upper"])).cast("long")), F.lit(0)).cast("bigint").alias(c))
    wide = df.agg(*aggs)
    wide = wide.withColumn(total_name, sum((F.col(c) for c in cols), F.lit(0).cast("bigint")))
    return wide.unpivot([], wide.columns, "column_name", "n_clipped")


def categories(df: DataFrame, cols: list[str], max_categories: int | None = None) -> dict[str, list[str]]:
    """Sorted distinct values per categorical column, for columns narrow enough to be named dummies.

    One distinct-aggregate job per column. With ``max_categories``, a wider column is an error, never a
    silent cut; ``categories.sparse_one_hot`` encodes columns of any width.
    """
    out = {}
    for c in cols:
        found = df.select(c).where(F.col(c).isNotNull()).distinct()
        vals = [r[0] for r in (found if max_categories is None else found.limit(max_categories + 1)).collect()]
        if max_categories is not None and len(vals) > max_categories:
            raise ValueError(f"{c} has more than {max_categories} categories; not a categorical column")
        out[c] = sorted(vals)
    return out


def one_hot(df: DataFrame, cols: list[str] | None = None, drop_first: bool = True, cats: dict[str, list[str]] | None = None) -> DataFrame:
    """Boolean dummies ``<col>_<value>`` for string columns; first category dropped."""
    cols = other_columns(df) if cols is None else cols
    if not cols:
        return df
    cats = cats or categories(df, cols)
    keep = [F.col(c) for c in df.columns if c not in cols]
    dummies = []
    for c in cols:
        values = cats[c][1:] if drop_first else cats[c]
        dummies += [F.coalesce(F.col(c) == F.lit(v), F.lit(False)).alias(f"{c}_{v}") for v in values]
    return df.select(*keep, *dummies)


def clean(
    df: DataFrame, method: str = "iqr", threshold: float = 1.5, key_cols: tuple[str, ...] = (), approx: bool = False, materialize=None
) -> DataFrame:
    """names -> impute -> dedupe -> (iqr clip) -> one-hot.

    Categories are the same before and after imputation, dedupe and clipping
    (they add none and remove none), so they are read from the written table
    when there is one, else from the raw columns. ``materialize(df) -> df`` may write the deduped
    table once (e.g. to the checkpoint folder) so the quartile pass and the
    final pass do not both repeat the dedupe shuffle.
    """
    named = standardize_names(df)
    out = dedupe(impute(named, approx=approx, key_cols=key_cols))
    if materialize is not None:
        out = materialize(out)
        cats = categories(out, other_columns(out, exclude=key_cols))  # one-column read of the written table
    else:
        cats = categories(named, other_columns(named, exclude=key_cols))
    if method == "iqr":
        out = iqr_clip(out, numeric_columns(out, exclude=key_cols), threshold, approx)
    return one_hot(out, list(cats), cats=cats)
