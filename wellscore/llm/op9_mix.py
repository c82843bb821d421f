"""Mixing sources to target weights by Poisson replication.

A source with n rows and share w of the target gets the mean repetition rate
w * target / n. Each document draws its count by inverting the Poisson distribution at a
uniform number hashed from (seed, document), is exploded by that count, and all copies are
shuffled globally by a hash of (seed, document, copy). A mean above 32 is a sum of
independent parts of at most 32 each, so the inversion is exact at any rate; a part is a row
of its own before its copies are made, and `copy` numbers them part by part (with gaps).

Nothing depends on partitioning, so a lost executor recomputes the same copies.

Edge cases: a null source is a source of its own; a document without an id is drawn by its
text, without either by the empty text; repeated rows draw alike; an empty table gives no
rows; columns of any name pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellscore.llm.common import written

PART = 32.0
# copies of part p are numbered from PER_PART * (p - 1) + 1; a part's distribution ends below that
PER_PART = 128
# parts of one row that one task explodes
RUN = 1024


def _uniform(seed: int, part: Column, key: Column) -> Column:
    """In [0, 1): the first 52 bits of an md5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), part.cast("string"), key)), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def rates(documents: DataFrame, weights: dict[str, float] | None = None, target: int | None = None) -> DataFrame:
    """(source, parts, mean, cdf): mean of each part, and the Poisson distribution function up to where it is 1.

    weights: share by source (those not named get 0); none: the same share for all. target:
    documents wanted, by default as many as there are. One row per source."""
    n = written(documents.groupBy(F.col("source").alias("source")).agg(F.count("*").alias("n")), "sources")
    if weights is None:
        n = n.withColumn("w", F.lit(1.0))
    else:
        n = n.withColumn("w", F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]), F.coalesce("source", F.lit(""))), F.lit(0.0)))
    total = n.agg(F.sum("w").alias("w"), F.sum("n").alias("n")).first()
    goal = float(target if target is not None else total["n"] or 0)
    lam = F.col("w") / F.lit(float(total["w"] or 1.0)) * F.lit(goal) / F.col("n")
    n = n.withColumn("lam", lam).withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("lam") / PART)).cast("int")).withColumn("mean", F.col("lam") / F.col("parts"))
    last = F.ceil(F.col("mean") + 12 * F.sqrt("mean") + 20).cast("int")
    start = F.struct(F.exp(-F.col("mean")).alias("p"), F.array(F.exp(-F.col("mean"))).alias("c"))
    grow = F.aggregate(
        F.sequence(F.lit(1), last), start, lambda a, k: F.struct((a["p"] * F.col("mean") / k).alias("p"), F.concat(a["c"], F.array(F.element_at(a["c"], -1) + a["p"] * F.col("mean") / k)).alias("c"))
    )
    return n.select("source", "parts", "mean", grow["c"].alias("cdf"))


def replicate(documents: DataFrame, weights: dict[str, float] | None = None, target: int | None = None, seed: int = 9) -> DataFrame:
    """(row, copy, shuffle_key): each document as a struct, once per drawn copy, in global random order."""
    cols = set(documents.columns)
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.col("text")) if "text" in cols else F.lit(""), F.lit(""))
    r = written(rates(documents, weights, target), "rates").withColumnRenamed("source", "to")
    d = documents.select(F.struct("*").alias("row"), F.col("source").alias("s"), key.alias("k")).join(r, F.col("s").eqNullSafe(F.col("to")))
    # rows of many parts are dealt out in runs of RUN parts before anything is exploded, so no task makes more copies of a row than those of one run
    few = d.withColumn("first", F.lit(1))
    if not r.filter(F.col("parts") > RUN).isEmpty():
        many = d.filter(F.col("parts") > RUN).withColumn("first", F.explode(F.sequence(F.lit(1), F.col("parts"), F.lit(RUN))))
        few = few.filter(F.col("parts") <= RUN).unionByName(many.repartition("k", "first"))
    d = few.withColumn("part", F.explode(F.sequence(F.col("first"), F.least(F.col("first") + (RUN - 1), F.col("parts")))))
    # the last value of the table ends the count: beyond it u can't lie but for rounding
    draw = F.size(F.filter(F.col("cdf"), lambda c: c <= F.col("u")))
    d = d.withColumn("u", _uniform(seed, F.col("part"), F.col("k"))).select("row", "k", "part", draw.alias("count")).filter("count > 0")
    d = d.select("row", "k", "part", F.explode(F.sequence(F.lit(1), F.col("count"))).alias("i"))
    d = d.select("row", "k", (F.lit(PER_PART) * (F.col("part").cast("long") - 1) + F.col("i")).alias("copy"))
    d = d.select("row", "copy", F.md5(F.concat_ws(":", F.lit(f"{seed}:shuffle"), "k", F.col("copy").cast("string"))).alias("shuffle_key"))
    return d.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


SQL = r"""
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
r AS (SELECT source, greatest(1, CAST(ceil(lam / 32.0) AS BIGINT)) AS parts, lam FROM
      (SELECT source, 1.0 / (SELECT count(*) FROM n) * (SELECT sum(n) FROM n) / n AS lam FROM n)),
m AS (SELECT source, parts, lam / parts AS mean FROM r),
k AS (SELECT source, parts, mean, unnest(generate_series(0, CAST(ceil(mean + 12 * sqrt(mean) + 20) AS BIGINT))) AS k FROM m),
c AS (SELECT source, k, sum(exp(-mean + CASE WHEN k = 0 THEN 0 ELSE k * ln(mean) END - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS c FROM k),
u AS (SELECT d.rid, d.doc_id, d.source, j, CAST(CAST('0x' || substr(md5('9:' || j || ':' || coalesce(CAST(d.doc_id AS VARCHAR), md5(d.text), '')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u
      FROM (SELECT documents.*, unnest(generate_series(1, m.parts)) AS j FROM (SELECT *, row_number() OVER () AS rid FROM documents) documents JOIN m ON documents.source IS NOT DISTINCT FROM m.source) d),
q AS (SELECT rid, doc_id, u.source, j, count(c.k) AS n FROM u LEFT JOIN c ON u.source IS NOT DISTINCT FROM c.source AND c.c <= u.u GROUP BY rid, doc_id, u.source, j),
x AS (SELECT doc_id, source, 128 * (j - 1) + unnest(generate_series(1, n)) AS copy FROM q WHERE n > 0)
SELECT doc_id, source, copy, md5('9:shuffle:' || doc_id || ':' || copy) AS shuffle_key FROM x
"""
