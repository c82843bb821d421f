"""Stress drivers per respondent and the text columns built from them.

Contributions are an ``array<struct>`` per row; top-n is ``array_sort`` +
``slice`` on that array - a per-row operation with no shuffle, whatever the
number of respondents. Text is assembled with built-in string functions.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellscore.functions.columns import clip, grid_mean, round_half_even
from wellscore.operators.features import band_advice
from wellscore.spec import DEFAULT_DRIVER_MAX, DEFAULT_DRIVER_MIN, DEFAULT_SPEC, FEATURE_LABELS, Spec


def default_label(feature: Column) -> Column:
    """``snake_case`` -> ``Title Case``."""
    return F.initcap(F.regexp_replace(feature, "_", " "))


def feature_label(feature: Column, labels: dict[str, str] | None = None) -> Column:
    labels = FEATURE_LABELS if labels is None else labels
    m = F.create_map(*itertools.chain.from_iterable((F.lit(k), F.lit(v)) for k, v in labels.items()))
    return F.coalesce(m[feature], default_label(feature))


def contribution_structs(features: list[str], spec: Spec = DEFAULT_SPEC, labels: dict[str, str] | None = None) -> list[Column]:
    """One struct per feature: pos, name, label, raw_value, stress_contribution, direction.

    Unknown features use the default 0-10 scale; a zero-width scale is skipped.
    """
    labels = FEATURE_LABELS if labels is None else labels
    scale = spec.scale
    inverted = set(spec.inverted)
    out = []
    for pos, f in enumerate(features):
        lo, hi = scale.get(f, (DEFAULT_DRIVER_MIN, DEFAULT_DRIVER_MAX))
        if hi == lo:
            continue
        n = clip((F.col(f).cast("double") - F.lit(float(lo))) / F.lit(float(hi - lo)), 0.0, 1.0)
        contrib = (F.lit(1.0) - n) if f in inverted else n
        out.append(
            F.struct(
                F.lit(pos).alias("pos"),
                F.lit(f).alias("name"),
                F.lit(labels.get(f, f.replace("_", " ").title())).alias("label"),
                F.col(f).cast("double").alias("raw_value"),
                round_half_even(contrib, 3).alias("stress_contribution"),
                F.lit("low" if f in inverted else "high").alias("direction"),
            )
        )
    return out


def contributions(df: DataFrame, features: list[str] | None = None, spec: Spec = DEFAULT_SPEC) -> Column:
    return F.array(*contribution_structs(features or spec.features, spec))


def top_drivers(contrib: Column, n: int = 3) -> Column:
    """Top-n by contribution, descending; ties keep input order (stable on the rounded value). Missing contributions don't rank."""
    contrib = F.filter(contrib, lambda s: s["stress_contribution"].isNotNull())
    keyed = F.transform(contrib, lambda s: F.struct((-s["stress_contribution"]).alias("k"), s["pos"].alias("p"), s.alias("d")))
    ordered = F.array_sort(keyed)
    return F.transform(F.slice(ordered, 1, n), lambda s: s["d"])


def contributions_long(df: DataFrame, id_col: str = "respondent_id", spec: Spec = DEFAULT_SPEC) -> DataFrame:
    return df.select(F.col(id_col), F.inline(contributions(df, spec=spec)))


def top_drivers_long(df: DataFrame, id_col: str = "respondent_id", n: int = 3, spec: Spec = DEFAULT_SPEC) -> DataFrame:
    top = top_drivers(contributions(df, spec=spec), n)
    return df.select(F.col(id_col), F.posexplode(top).alias("rank0", "d")).select(
        id_col, (F.col("rank0") + 1).alias("rank"), "d.pos", "d.name", "d.label", "d.raw_value", "d.stress_contribution", "d.direction"
    )


def _value_text(c: Column, integral: bool = True) -> Column:
    """Raw value as text, as a Python ``str`` of an int (or float) would show it."""
    return F.when(c == F.floor(c), c.cast("bigint").cast("string")).otherwise(c.cast("string")) if integral else c.cast("string")


def driver_text(drivers: Column, integral_values: bool = True) -> Column:
    """Numbered lines ``  i. Label = v (too low|elevated, stress contribution: p%)``."""

    def line(d, i):
        direction = F.when(d["direction"] == "low", F.lit("too low")).otherwise(F.lit("elevated"))
        pct = F.rint(d["stress_contribution"] * F.lit(100.0)).cast("bigint").cast("string")
        return F.concat(
            F.lit("  "), (i + 1).cast("string"), F.lit(". "), d["label"], F.lit(" = "), _value_text(d["raw_value"], integral_values),
            F.lit(" ("), direction, F.lit(", stress contribution: "), pct, F.lit("%)"),
        )

    return F.array_join(F.transform(drivers, line), "\n")


def profile_text(features: list[str], labels: dict[str, str] | None = None) -> Column:
    """One line per feature: ``  - Label: value``."""
    labels = FEATURE_LABELS if labels is None else labels
    lines = [F.concat(F.lit(f"  - {labels.get(f, f.replace('_', ' ').title())}: "), F.col(f).cast("string")) for f in features]
    return F.concat_ws("\n", *lines)


def static_advice(score: Column, band: Column, drivers: Column, texts: dict[str, str] | None = None) -> Column:
    """Three lines: band and score, the drivers' labels (or none), the caller's text for the band (``BAND_TEXTS`` by default)."""
    names = F.when(F.size(drivers) > 0, F.array_join(F.transform(drivers, lambda d: d["label"]), ", ")).otherwise(F.lit("none"))
    return F.concat(F.lit("Band "), band, F.lit(", score "), score.cast("string"), F.lit(" of 100\nDrivers: "), names, F.lit("\n"), band_advice(band, texts))


def two_digits(c: Column) -> Column:
    """``{x:.2f}`` as Python prints it: round half-even on the double first."""
    return F.format_string("%.2f", round_half_even(c, 2))


def request_text(score: Column, band: Column, profile: Column, drivers_txt: Column, indices: dict[str, Column]) -> Column:
    """The advice request for one respondent (stops at the text; no call is made)."""
    parts = [
        F.lit("Assessment\n- Score: "), score.cast("string"), F.lit("/100\n- Risk: "), band,
        F.lit("\n\nProfile\n"), profile, F.lit("\n\nTop drivers\n"), drivers_txt, F.lit("\n\nIndices"),
    ]
    for name, c in indices.items():
        parts += [F.lit(f"\n- {name}: "), two_digits(F.coalesce(c, F.lit(0.5))), F.lit("/1.0")]
    return F.concat(*parts)


def followup_text(question: Column, score: Column, band: Column) -> Column:
    return F.concat(
        F.lit("Follow-up question:\n\n"), question, F.lit("\n\nContext: score "), score.cast("string"),
        F.lit("/100 ("), band, F.lit(" risk). Answer briefly and concretely."),
    )


def cohort_drivers(df: DataFrame, cohort: str = "cohort", n: int = 3, spec: Spec = DEFAULT_SPEC) -> DataFrame:
    """How often each feature is a top-n driver per cohort, with its mean contribution.

    ``groupBy`` aggregates partially on every executor, so a cohort holding a
    large share of the rows is pre-aggregated before the shuffle.
    """
    top = top_drivers(contributions(df, spec=spec), n)
    ex = df.select(F.col(cohort), F.explode(top).alias("d"))
    return ex.groupBy(cohort, F.col("d.name").alias("feature")).agg(
        F.count(F.lit(1)).alias("n_top"), grid_mean("d.stress_contribution", 1000).alias("mean_contribution")
    )
