"""Global row numbers over ranges."""

from pyspark.sql import functions as F

from wellscore.operators.ranges import numbered


def test_numbers_follow_the_order(spark):
    df = spark.range(5000).select(F.pmod(F.col("id") * 7919, F.lit(5000)).alias("k"), (F.col("id") % 7).alias("v")).repartition(6)
    rows = numbered(df, [F.desc("v"), "k"]).collect()
    want = sorted(((r.v, r.k) for r in rows), key=lambda t: (-t[0], t[1]))
    assert [(r.v, r.k) for r in sorted(rows, key=lambda r: r.row_number)] == want
    assert sorted(r.row_number for r in rows) == list(range(5000))


def test_ties_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "x"), (1, "y"), (1, "y"), (1, "y"), (0, "z")], "k int, other string")
    rows = sorted(numbered(df, [F.asc_nulls_last("k")], "n").collect(), key=lambda r: r.n)
    assert [r.k for r in rows] == [0, 1, 1, 1, None] and [r.n for r in rows] == list(range(5))
    assert rows[0].other == "z"
    assert numbered(df.limit(0), ["k"]).count() == 0


def test_a_hot_value_is_dealt_over_ranges(spark):
    df = spark.range(40000).select(F.lit(1).alias("k"))
    got = numbered(df, ["k"])
    assert got.agg(F.count_distinct("row_number"), F.max("row_number")).first()[:] == (40000, 39999)
