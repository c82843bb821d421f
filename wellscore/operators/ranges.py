"""Global row numbers without one task that sees every row.

The rows are dealt by ranges of the sort order and written; the row count of each range, one small
number per range, gives the number that a range starts at; within a range the rows are numbered by a
window of their own.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellscore.session import scratch_path


def numbered(df: DataFrame, order: list[Column | str], name: str = "row_number") -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... (long) in the given order.

    Rows that are equal in ``order`` are numbered in any order; a run of them is dealt by a tie number
    too, so that no range has to hold it whole. An empty table gives no rows.
    """
    spark = df.sparkSession
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    tie, part = f"__tie_{name}", f"__part_{name}"
    tied = df.withColumn(tie, F.monotonically_increasing_id())
    path = scratch_path(spark, "numbered")
    tied.repartitionByRange(*order, tie).withColumn(part, F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.schema(f"`{part}` int").parquet(path)
    sizes = [(r[0], r[1]) for r in dealt.groupBy(part).count().orderBy(part).collect()]  # one row per range
    first = dict(zip([p for p, _ in sizes], accumulate([0, *[n for _, n in sizes]]), strict=False))
    back = spark.read.schema(T.StructType([*df.schema.fields, T.StructField(tie, T.LongType()), T.StructField(part, T.IntegerType())])).parquet(path)
    offsets = spark.createDataFrame(list(first.items()), f"`{part}` int, __first long")
    w = Window.partitionBy(part).orderBy(*order, tie)
    at = F.row_number().over(w).cast("long") - 1 + F.col("__first")
    return back.join(F.broadcast(offsets), part).withColumn(name, at).drop(tie, part, "__first")
