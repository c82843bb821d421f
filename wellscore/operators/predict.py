"""Scoring of survey records with a saved model: features, prediction, band, advice and drivers in one record (Q2).

Every step is a narrow projection and the model a stateless transform, so the same function scores
a table or a stream.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellscore.operators import drivers as drv
from wellscore.operators import features as feat
from wellscore.sources import io
from wellscore.spec import DEFAULT_SPEC, Spec


def predict(records: DataFrame, model: PipelineModel, id_col: str = "respondent_id", top: int = 3, spec: Spec = DEFAULT_SPEC, keep: tuple[str, ...] = (), texts: dict[str, str] | None = None) -> DataFrame:
    """One record per row: id, burnout_score, risk_level, advice, input_features, the composite indices, stress_drivers.

    The model's columns that the records lack are 0. A record with a missing indicator has no score, band
    or advice, but the drivers of those that it has. ``keep``: further columns passed through;
    ``texts``: the advice per band.
    """
    rebuilt = feat.score_features(records.drop("prediction", "features", "raw_features"), spec)
    filled = io.with_missing_features(rebuilt, io.model_features(model))
    scored = model.transform(filled).withColumn("burnout_score", feat.clip_score(F.col("prediction")))
    scored = scored.withColumn("stress_drivers", drv.top_drivers(drv.contributions(records, spec=spec), top))
    return feat.scored_record(scored, spec, id_col=id_col, keep=("stress_drivers", *keep), texts=texts)
