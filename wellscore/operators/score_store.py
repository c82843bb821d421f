"""The min-max score over batches that keep coming.

A batch is read once: its raw scores are written while their range is observed. The ranges are a small table,
one row per batch, so writing a batch again replaces its range too. The score of a row depends on the range
over all batches; as long as a new batch lies within it only that batch is scaled, and only a widened range
scales the others again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wellscore.operators import features as feat
from wellscore.spec import DEFAULT_SPEC, Spec

RANGES = "mn double, mx double, batch_id long"


def _put(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def score_range(spark: SparkSession, path: str) -> tuple[float, float] | None:
    """The range over all batches; None before the first row."""
    fs = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/ranges")
    if not fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs):
        return None
    row = spark.read.schema(RANGES).parquet(f"{path}/ranges").agg(F.min("mn"), F.max("mx")).first()
    return None if row[0] is None else (row[0], row[1])


def add_batch(df: DataFrame, path: str, batch_id: int, spec: Spec = DEFAULT_SPEC, id_col: str = "respondent_id") -> bool:
    """Add (or replace) a batch of indicator rows; whether the other batches were scaled again.

    A row without a raw score has no score and doesn't count for the range."""
    spark = df.sparkSession
    before = score_range(spark, path)
    seen = Observation()
    raw = feat.add_raw_score(feat.add_indices(df, spec), spec).select(F.col(id_col), F.nullif("raw_score", F.lit(float("nan"))).alias("raw_score"))
    tagged = raw.withColumn("batch_id", F.lit(batch_id).cast("long"))
    _put(tagged.observe(seen, F.min("raw_score").alias("mn"), F.max("raw_score").alias("mx")), f"{path}/raw")
    here = seen.get
    row = spark.createDataFrame([(here.get("mn"), here.get("mx"), batch_id)], RANGES)
    _put(row, f"{path}/ranges")
    after = score_range(spark, path)
    moved = before is not None and before != after
    rows = spark.read.schema(tagged.schema).parquet(f"{path}/raw")
    rows = rows if moved else rows.where(F.col("batch_id") == batch_id)
    scaled = feat.minmax_score(rows, frozen=after or (None, None))
    _put(scaled.withColumn("burnout_score", F.when(F.col("raw_score").isNotNull(), F.col("burnout_score"))).select(id_col, "burnout_score", "batch_id"), f"{path}/scores")
    return moved


def scores(spark: SparkSession, path: str) -> DataFrame:
    """(id, burnout_score, batch_id) of all batches."""
    return spark.read.parquet(f"{path}/scores")
