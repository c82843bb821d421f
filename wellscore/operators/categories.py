"""One-hot encoding of columns with too many values to be columns: a category table and sparse rows.

The distinct values of all columns become one table, numbered by ranges; a row keeps the numbers of its
values. Neither the values nor their number have to fit anywhere: nothing of that size reaches the driver,
and a value that most rows share is one row of the table, joined as a skewed key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellscore.operators.ranges import numbered
from wellscore.session import scratch_path


def _long(df: DataFrame, cols: list[str], key: str | None = None) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols])
    return df.select(*([F.col(f"`{key}`").alias("__key")] if key else []), F.inline(cells))


def category_table(df: DataFrame, cols: list[str], drop_first: bool = True) -> DataFrame:
    """(column_name, value, idx): every value that isn't null, numbered from 0 by column and value.

    drop_first: the least value of each column gets no number, as its dummies would add up to a constant."""
    found = _long(df, cols).where("value IS NOT NULL").distinct()
    if drop_first:
        path = scratch_path(df.sparkSession, "categories")
        found.write.parquet(path)
        found = df.sparkSession.read.parquet(path)
        first = found.groupBy("column_name").agg(F.min("value").alias("__first"))  # one row per column
        found = found.join(F.broadcast(first), "column_name").where("value <> __first").drop("__first")
    return numbered(found, ["column_name", "value"], "idx").select("column_name", "value", "idx")


def sparse_one_hot(df: DataFrame, key: str, cols: list[str], table: DataFrame | None = None, drop_first: bool = True) -> DataFrame:
    """(key, size, indices): per row the sorted numbers of its values, size being that of the table.

    ``key`` must tell rows apart. Null and unnumbered values have no index; with a ``table`` of other rows,
    a value that it doesn't hold has none either."""
    if table is None:
        path = scratch_path(df.sparkSession, "category-table")
        category_table(df, cols, drop_first).write.parquet(path)
        table = df.sparkSession.read.parquet(path)
    size = table.count()
    held = _long(df, cols, key).join(table, ["column_name", "value"], "left")
    rows = held.groupBy("__key").agg(F.sort_array(F.collect_list("idx")).alias("indices"))  # at most one index a column
    return rows.select(F.col("__key").alias(key), F.lit(size).cast("long").alias("size"), "indices")
