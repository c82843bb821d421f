"""Exact quantiles and modes from value counts, without one task that sees every value.

The rows are counted per (column, value) with map-side partial sums, and the counts are dealt by
ranges of (column, value): a value is one row however often it occurs, so ranges are even under any
skew. Totals per range, one small row each, say which range holds a wanted rank; only there are
counts summed up, one window per range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellscore.session import scratch_path


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, value, n) of the numeric columns as doubles; null and NaN aren't counted."""
    x = [F.nullif(F.col(c).cast("double"), F.lit(float("nan"))).alias(c) for c in cols]
    long = df.select(*x).unpivot([], cols, "column_name", "value")
    return long.where("value IS NOT NULL").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """(column_name, prob, value), linear between neighbours; a column without values has no rows."""
    spark = df.sparkSession
    path = scratch_path(spark, "value-counts")
    dealt = value_counts(df, cols).repartitionByRange("column_name", "value")
    dealt.withColumn("part", F.spark_partition_id()).write.parquet(path)
    counts = spark.read.parquet(path)
    of_column = Window.partitionBy("column_name")
    parts = counts.groupBy("column_name", "part").agg(F.sum("n").alias("here"))
    parts = parts.select("*", (F.sum("here").over(of_column.orderBy("part")) - F.col("here")).alias("before"), F.sum("here").over(of_column).alias("total"))
    asked = parts.select("*", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
    asked = asked.withColumn("pos", F.col("prob") * (F.col("total") - 1))
    asked = asked.select("*", F.explode(F.array(F.floor("pos"), F.ceil("pos"))).alias("rank")).distinct()
    # at most two rows per column and probability
    asked = asked.where("rank >= before AND rank < before + here").select("column_name", "part", "prob", "pos", "rank", (F.col("rank") - F.col("before")).alias("at"))
    held = counts.join(F.broadcast(asked.select("column_name", "part").distinct()), ["column_name", "part"], "left_semi")
    held = held.withColumn("upto", F.sum("n").over(Window.partitionBy("column_name", "part").orderBy("value")))
    hit = held.join(F.broadcast(asked), ["column_name", "part"]).where("at < upto AND at >= upto - n")
    ends = hit.groupBy("column_name", "prob", "pos").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    between = (F.ceil("pos") - F.col("pos")) * F.col("lo") + (F.col("pos") - F.floor("pos")) * F.col("hi")
    return ends.select("column_name", "prob", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(between).alias("value"))


def mode(df: DataFrame, c: str):
    """The most frequent value that isn't null, the least on ties; None if there is none."""
    row = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("__n")).orderBy(F.col("__n").desc(), F.col(c).asc()).first()
    return row[0] if row else None
