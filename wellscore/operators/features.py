"""Composite indices, interaction features, the 0-100 score and risk bands.

Two modes mirror the original pipeline:

* ``mode="train"`` - batch feature engineering: indices unrounded,
  interactions rounded to 3 digits, ``mental_load`` not clipped.
* ``mode="score"`` - rebuilding features for new records: indices rounded
  to 4 digits, interactions to 3, ``mental_load`` and ``isolation_index``
  built from clipped norms.

The min-max score needs the table-wide min/max of the raw score. It is one
global aggregate (partial on every executor, a single row at the end) - never
an unpartitioned window, which would pull every row into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellscore.functions.columns import clip, grid_mean, inv, norm, round_half_even, weighted_sum
from wellscore.spec import BAND_TEXTS, DEFAULT_SPEC, Spec


def norm_columns(spec: Spec = DEFAULT_SPEC, invert: bool = True) -> dict[str, Column]:
    """``<feature>_norm`` per indicator: scaled to [0,1], flipped when lower is worse."""
    out = {}
    inverted = set(spec.inverted)
    for name, lo, hi in spec.indicators:
        n = norm(name, hi, lo)
        out[f"{name}_norm"] = inv(n) if (invert and name in inverted) else n
    return out


def norm_scale(df: DataFrame, spec: Spec = DEFAULT_SPEC) -> DataFrame:
    return df.withColumns(norm_columns(spec))


def index_columns(spec: Spec = DEFAULT_SPEC, mode: str = "train") -> dict[str, Column]:
    spec.validate_scales()
    scale = spec.scale
    out = {}
    for index, terms in spec.index_terms.items():
        parts = []
        for feat, w, flip in terms:
            lo, hi = scale[feat]
            n = norm(feat, hi, lo)
            parts.append((w, inv(n) if flip else n))
        c = weighted_sum(parts)
        out[index] = round_half_even(c, 4) if mode == "score" else c
    return out


def add_indices(df: DataFrame, spec: Spec = DEFAULT_SPEC, mode: str = "train") -> DataFrame:
    return df.withColumns(index_columns(spec, mode))


def interaction_columns(mode: str = "train") -> dict[str, Column]:
    a, d = F.col("anxiety_level"), F.col("depression")
    sleep, support, peer = F.col("sleep_quality"), F.col("social_support"), F.col("peer_pressure")
    ratio = a / (sleep + F.lit(1e-6))
    burden = (F.col("study_load") + F.col("future_career_concerns")) / F.lit(10)
    if mode == "score":
        isolation = (F.lit(5) - norm(support, 3) * F.lit(5)) * (peer + F.lit(1)) / F.lit(6)
        mental = (norm(a, 21) + norm(d, 27)) / F.lit(2)
    else:
        isolation = (F.lit(5) - clip(support, 0, 3) / F.lit(3) * F.lit(5)) * (peer + F.lit(1)) / F.lit(6)
        mental = (a / F.lit(21) + d / F.lit(27)) / F.lit(2)
    env = (F.col("living_conditions") + F.col("safety") + F.col("basic_needs")) / F.lit(15)
    cols = {
        "stress_sleep_ratio": ratio,
        "academic_burden": burden,
        "isolation_index": isolation,
        "environment_quality": env,
        "mental_load": mental,
    }
    return {k: round_half_even(v, 3) for k, v in cols.items()}


def add_interactions(df: DataFrame, mode: str = "train") -> DataFrame:
    return df.withColumns(interaction_columns(mode))


def raw_score_column(spec: Spec = DEFAULT_SPEC) -> Column:
    return weighted_sum((w, F.col(idx)) for idx, w in spec.score_terms)


def add_raw_score(df: DataFrame, spec: Spec = DEFAULT_SPEC, out: str = "raw_score") -> DataFrame:
    return df.withColumn(out, raw_score_column(spec))


def score_range(df: DataFrame, raw: str = "raw_score") -> Column:
    """Struct scalar (mn, mx) of the raw score over the whole table."""
    return df.agg(F.struct(F.min(raw).alias("mn"), F.max(raw).alias("mx"))).scalar()


def minmax_column(raw: Column, mn: Column, mx: Column) -> Column:
    scaled = (raw - mn) / (mx - mn) * F.lit(100.0)
    return F.when(mx > mn, round_half_even(scaled, 2)).otherwise(F.lit(0.0))


def minmax_score(
    df: DataFrame, raw: str = "raw_score", out: str = "burnout_score", frozen: tuple[float, float] | None = None, lazy: bool = False
) -> DataFrame:
    """0-100 min-max score, 2 digits; 0 everywhere when max == min.

    The table-wide range is one global aggregate (partial on every executor,
    one row at the end). By default that row is read once and folded in as
    literals, which keeps every downstream plan flat; ``lazy=True`` keeps it
    as a scalar subquery instead. ``frozen=(mn, mx)`` scores new rows against
    a stored range (streams, answer sheets).
    """
    if frozen is None and lazy:
        rng = score_range(df, raw)
        mn, mx = rng["mn"], rng["mx"]
    else:
        if frozen is None:
            row = df.agg(F.min(raw).alias("mn"), F.max(raw).alias("mx")).first()
            frozen = (row["mn"], row["mx"])
        if frozen[0] is None:  # empty table: nothing to scale
            return df.withColumn(out, F.lit(None).cast("double"))
        mn, mx = F.lit(float(frozen[0])), F.lit(float(frozen[1]))
    return df.withColumn(out, minmax_column(F.col(raw), mn, mx))


def frozen_range(df: DataFrame, spec: Spec = DEFAULT_SPEC) -> DataFrame:
    """One-row table (mn, mx) of the raw score, to store next to a model."""
    scored = add_raw_score(add_indices(df, spec), spec)
    return scored.agg(F.min("raw_score").alias("mn"), F.max("raw_score").alias("mx"))


def engineer(df: DataFrame, spec: Spec = DEFAULT_SPEC, keep_raw: bool = False) -> DataFrame:
    """Input + 5 indices + 5 interactions + burnout_score."""
    out = add_raw_score(add_interactions(add_indices(df, spec)), spec)
    out = minmax_score(out)
    return out if keep_raw else out.drop("raw_score")


def score_by_label(df: DataFrame, label: str = "stress_level", labels=(0, 1, 2), score: str = "burnout_score") -> DataFrame:
    """Mean score per label; a label with no rows gets null (right join to the list)."""
    means = df.groupBy(label).agg(grid_mean(score, 100).alias("mean_score"))
    wanted = df.sparkSession.createDataFrame([(int(v),) for v in labels], f"{label} int")
    # both sides hold one row per label after aggregation; AQE picks the join
    return wanted.join(means, label, "left").select(label, "mean_score")


# --- scoring -----------------------------------------------------------------


def clip_score(c: Column) -> Column:
    """Clip a prediction to [0, 100] and round to 2 digits; null and NaN give null."""
    return round_half_even(clip(F.nullif(c.cast("double"), F.lit(float("nan"))), 0.0, 100.0), 2)


def risk_band(c: Column, low: float = 33.0, moderate: float = 66.0) -> Column:
    """Low, Moderate or High; a missing score has no band."""
    return F.when(c <= F.lit(low), F.lit("Low")).when(c <= F.lit(moderate), F.lit("Moderate")).when(c.isNotNull(), F.lit("High"))


def band_advice(band: Column, texts: dict[str, str] | None = None) -> Column:
    """The caller's text for the band (``BAND_TEXTS`` by default); null without a band or a text for it."""
    texts = BAND_TEXTS if texts is None else texts
    return F.element_at(F.create_map(*[F.lit(x) for kv in texts.items() for x in kv]), band)


def score_features(df: DataFrame, spec: Spec = DEFAULT_SPEC) -> DataFrame:
    """Rebuild model features for scoring (rounded indices, clipped mental load)."""
    missing = [f for f in spec.features if f not in df.columns]
    if missing:
        raise ValueError(f"missing indicator columns: {missing}")
    return add_interactions(add_indices(df, spec, mode="score"), mode="score")


def formula_score(df: DataFrame, spec: Spec = DEFAULT_SPEC, frozen: tuple[float, float] | None = None) -> DataFrame:
    """Score rows by the formula (indices from the scoring mode), clip, band."""
    feats = score_features(df, spec)
    raw = add_raw_score(feats, spec)
    scored = minmax_score(raw, frozen=frozen)
    return scored.withColumn("burnout_score", clip_score(F.col("burnout_score"))).withColumn(
        "risk_level", risk_band(F.col("burnout_score"), spec.band_low, spec.band_moderate)
    )


def scored_record(df: DataFrame, spec: Spec = DEFAULT_SPEC, score_col: str = "burnout_score", id_col: str = "respondent_id", keep: tuple[str, ...] = (), texts: dict[str, str] | None = None) -> DataFrame:
    """Nested scored record per row: score, band, advice, input struct, indices, and the columns to ``keep``."""
    band = risk_band(F.col(score_col), spec.band_low, spec.band_moderate)
    return df.select(
        F.col(id_col),
        F.col(score_col).alias("burnout_score"),
        band.alias("risk_level"),
        band_advice(band, texts).alias("advice"),
        F.struct(*[F.col(f) for f in spec.features]).alias("input_features"),
        *[F.col(i) for i in spec.indices],
        *[F.col(c) for c in keep],
    )
