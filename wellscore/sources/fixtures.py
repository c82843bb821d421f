"""Survey tables derived from the driver's `orders` / `events` tables.

The test tables carry no survey columns, so the survey fixtures are computed
from `orders.o_orderkey` with integer-only arithmetic. The same expression
text is rendered for Spark SQL (``div``) and DuckDB (``//``), so the oracle
sees exactly the rows Spark sees. Everything is a narrow, per-row projection
over two columns of `orders`, which are written once per session in several files;
the work grows with `orders`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellscore.plans.stored import stored
from wellscore.spec import INDICATORS, INVERTED, OPTION_BANKS

# Fixed values of the fixture definition: one prime per indicator (schema order).
PRIMES = [103, 107, 109, 113, 127, 131, 137, 139, 149, 151, 157, 163, 167, 173, 179, 181, 191, 193, 197, 199]

BANK_A_SIZES = {feat: len(vals) for feat, _, vals in OPTION_BANKS["A"]}


def _div(dialect: str) -> str:
    return "div" if dialect == "spark" else "//"


def respondent_exprs(dialect: str, key: str = "o_orderkey", cohort: str | None = "o_orderpriority") -> list[str]:
    """Select-list of the clean `respondents` table over `orders`."""
    d = _div(dialect)
    lat = f"((({key} * 37) % 101) * 10)"
    exprs = [f"{key} AS respondent_id"]
    for i, (feat, lo, hi) in enumerate(INDICATORS):
        p = PRIMES[i]
        a = 11 + 2 * i
        noise = f"(((({key} * {a} + {i}) % {p}) * 1000) {d} {p - 1})"
        lvl = f"(1000 - {lat})" if feat in INVERTED else lat
        exprs.append(f"CAST({lo} + (((6 * {lvl} + 4 * {noise}) * {hi - lo + 1}) {d} 10001) AS INT) AS {feat}")
    exprs.append(f"CAST(((({key} * 37) % 101) * 3) {d} 101 AS INT) AS stress_level")
    if cohort:
        exprs.append(f"{cohort} AS cohort")
    return exprs


def respondents_sql(dialect: str = "duckdb") -> str:
    return "SELECT " + ", ".join(respondent_exprs(dialect)) + " FROM orders"


def dirty_sql(source: str = "respondents") -> str:
    """`respondents_dirty` from a relation named ``source`` (same text in both engines)."""
    cols = []
    for feat, _, _ in INDICATORS:
        if feat == "anxiety_level":
            cols.append("CASE WHEN respondent_id % 17 = 0 THEN NULL ELSE anxiety_level END AS anxiety_level")
        elif feat == "depression":
            cols.append("CASE WHEN respondent_id % 97 = 0 THEN 200 ELSE depression END AS depression")
        else:
            cols.append(feat)
    cols.append("stress_level")
    cols.append("CASE WHEN respondent_id % 13 = 0 THEN NULL ELSE cohort END AS cohort")
    body = "SELECT respondent_id, " + ", ".join(cols) + f" FROM {source}"
    return f"SELECT * FROM ({body}) d UNION ALL SELECT * FROM ({body}) d2 WHERE respondent_id % 50 = 0"


def question_params() -> list[tuple[int, str, int, int, int]]:
    """(q, feature, a, p, n) per question of the answers fixture."""
    return [(i, feat, 11 + 2 * i, PRIMES[i], BANK_A_SIZES[feat]) for i, (feat, _, _) in enumerate(INDICATORS)]


def answers_sql() -> str:
    """DuckDB text of the `answers` fixture over a `respondents`-like relation `orders`."""
    vals = ", ".join(f"({q}, '{f}', {a}, {p}, {n})" for q, f, a, p, n in question_params())
    first = INDICATORS[0][0]
    return f"""
    SELECT o_orderkey AS respondent_id, qp.feature,
           CAST(CASE WHEN o_orderkey % 41 = qp.q THEN 9
                     ELSE 1 + ((o_orderkey * qp.a + qp.q) % qp.p) % qp.n END AS INTEGER) AS opt_idx,
           CAST(qp.q AS INTEGER) AS answer_seq
    FROM orders, (VALUES {vals}) qp(q, feature, a, p, n)
    WHERE o_orderkey % 43 <> qp.q
    UNION ALL
    SELECT o_orderkey, 'unknown_item', CAST(1 AS INTEGER), CAST(20 AS INTEGER) FROM orders WHERE o_orderkey % 29 = 0
    UNION ALL
    SELECT o_orderkey, '{first}', CAST(1 AS INTEGER), CAST(100 AS INTEGER) FROM orders WHERE o_orderkey % 31 = 0
    """


# ---------------------------------------------------------------------------
# Spark builders
# ---------------------------------------------------------------------------


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and priority of all orders, dealt once per session into one file per core by ranges of the key.

    A table of one row group is otherwise one task for every query that derives from it."""

    def dealt() -> DataFrame:
        raw = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderpriority")
        return raw.repartitionByRange(max(raw.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism), "o_orderkey")

    return stored(spark, "orders", sf_dir, dealt)


def respondents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean survey table: respondent_id, 20 indicators, stress_level, cohort."""
    return orders(spark, sf_dir).selectExpr(*respondent_exprs("spark"))


def respondents_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey table with nulls, an outlier column and exact duplicate rows.

    One scan: rows to be duplicated are emitted twice by a generator.
    """
    base = respondents(spark, sf_dir)
    rid = F.col("respondent_id")
    dirty = base.withColumns(
        {
            "anxiety_level": F.when(rid % 17 == 0, F.lit(None)).otherwise(F.col("anxiety_level")),
            "depression": F.when(rid % 97 == 0, F.lit(200)).otherwise(F.col("depression")),
            "cohort": F.when(rid % 13 == 0, F.lit(None)).otherwise(F.col("cohort")),
        }
    )
    copies = F.sequence(F.lit(1), F.when(rid % 50 == 0, F.lit(2)).otherwise(F.lit(1)))
    return dirty.withColumn("__copy", F.explode(copies)).drop("__copy")


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long answers table (respondent_id, feature, opt_idx, answer_seq).

    One scan: every respondent row expands through a generator (``inline``) to
    its 20 answer candidates plus the unknown-item and repeated-answer
    candidates, and a filter keeps the ones that exist. No join, no union of
    separate scans.
    """
    first = INDICATORS[0][0]
    cand = [
        F.struct(F.lit(q).alias("q"), F.lit(f).alias("feature"), F.lit(a).alias("a"), F.lit(p).alias("p"), F.lit(n).alias("n"), F.lit(0).alias("kind"))
        for q, f, a, p, n in question_params()
    ]
    cand.append(F.struct(F.lit(20).alias("q"), F.lit("unknown_item").alias("feature"), F.lit(1).alias("a"), F.lit(1).alias("p"), F.lit(1).alias("n"), F.lit(1).alias("kind")))
    cand.append(F.struct(F.lit(100).alias("q"), F.lit(first).alias("feature"), F.lit(1).alias("a"), F.lit(1).alias("p"), F.lit(1).alias("n"), F.lit(2).alias("kind")))
    base = orders(spark, sf_dir).select(F.col("o_orderkey").alias("respondent_id"), F.inline(F.array(*cand)))
    rid, q, kind = F.col("respondent_id"), F.col("q"), F.col("kind")
    keep = ((kind == 0) & (rid % 43 != q)) | ((kind == 1) & (rid % 29 == 0)) | ((kind == 2) & (rid % 31 == 0))
    opt = (
        F.when(kind != 0, F.lit(1))
        .when(rid % 41 == q, F.lit(9))
        .otherwise(1 + ((rid * F.col("a") + q) % F.col("p")) % F.col("n"))
    )
    return base.where(keep).select(rid, F.col("feature"), opt.cast("int").alias("opt_idx"), q.cast("int").alias("answer_seq"))
