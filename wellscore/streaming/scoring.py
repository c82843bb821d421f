"""Scoring a stream with a saved model into a table that a replayed batch doesn't change (ST1)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellscore.operators.predict import predict
from wellscore.session import scratch_path
from wellscore.sources import io
from wellscore.sources.fixtures import respondent_exprs
from wellscore.spec import DEFAULT_SPEC, Spec


def score_with_model(stream: DataFrame, model_path: str, spec: Spec = DEFAULT_SPEC) -> DataFrame:
    """Each arriving record scored with the model saved at ``model_path``."""
    records = stream.selectExpr(*respondent_exprs("spark", key="event_id", cohort="event_type"), "ts")
    return predict(records, io.load_model(model_path), spec=spec, keep=("ts",)).withColumnRenamed("respondent_id", "event_id")


def batch_table(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink: each batch is a partition of its own, overwritten if the batch is run again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
        tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)

    return write


def run_to_batches(stream: DataFrame, name: str) -> DataFrame:
    """Run a query to completion into such a table; the table with its batch_id."""
    spark = stream.sparkSession
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    q = stream.writeStream.foreachBatch(batch_table(out)).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out)
