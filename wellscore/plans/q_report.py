"""Queries for validation/profiling (V1-V8) and report aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from wellscore.operators import features as feat
from wellscore.operators import report as rep
from wellscore.operators import sketches
from wellscore.operators import validate as val
from wellscore.plans import ctes
from wellscore.plans import sqlspec as S
from wellscore.plans.registry import query
from wellscore.plans.stored import stored
from wellscore.session import scratch_path
from wellscore.sources import fixtures as fx
from wellscore.spec import DEFAULT_SPEC, INDEX_TERMS

SPEC = DEFAULT_SPEC
REQUIRED = SPEC.features + ["stress_level", "mental_fatigue"]
DIRTY_COLS = ["respondent_id", *SPEC.features, "stress_level", "cohort"]


def _engineered(spark, sf):
    """The engineered table, written once per session and re-read (as the report stage does).

    Its respondents are written first: the score's range and its rows both read them."""

    def build():
        return feat.engineer(stored(spark, "respondents", sf, lambda: fx.respondents(spark, sf)), SPEC)

    return stored(spark, "engineered", sf, build, SPEC)


# --- V ------------------------------------------------------------------------


def _missing_sql() -> str:
    dirty_cols = set(DIRTY_COLS)
    parts = [
        f"SELECT '{c}' AS column_name, true AS present, CAST(count({c}) AS BIGINT) AS n_values FROM dirty"
        if c in dirty_cols
        else f"SELECT '{c}' AS column_name, false AS present, CAST(NULL AS BIGINT) AS n_values"
        for c in REQUIRED
    ]
    return f"WITH {ctes.dirty()} " + " UNION ALL ".join(parts)


@query("missing_columns", "V1", _missing_sql)
def q_missing_columns(spark, sf):
    return val.column_presence(fx.respondents_dirty(spark, sf), REQUIRED)


@query(
    "table_profile",
    "V2",
    lambda: f"WITH {ctes.dirty()} SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST({len(DIRTY_COLS)} AS BIGINT) AS n_cols FROM dirty",
)
def q_table_profile(spark, sf):
    return val.table_profile(fx.respondents_dirty(spark, sf))


def _null_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS null_count FROM dirty" for c in DIRTY_COLS]
    total = " + ".join(f"(count(*) - count({c}))" for c in DIRTY_COLS)
    parts.append(f"SELECT '__total__', CAST({total} AS BIGINT) FROM dirty")
    return f"WITH {ctes.dirty()} " + " UNION ALL ".join(parts)


@query("null_counts", "V3", _null_sql)
def q_null_counts(spark, sf):
    return val.null_counts(fx.respondents_dirty(spark, sf))


@query(
    "duplicate_count",
    "V4",
    lambda: f"""WITH {ctes.dirty()}
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST((SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)) AS BIGINT) AS n_distinct,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)) AS BIGINT) AS n_duplicates
FROM dirty""",
)
def q_duplicate_count(spark, sf):
    return val.duplicate_count(fx.respondents_dirty(spark, sf))


@query(
    "class_balance",
    "V5",
    lambda: f"WITH {ctes.respondents()} SELECT stress_level, count(*) AS n FROM respondents GROUP BY stress_level",
)
def q_class_balance(spark, sf):
    return val.class_balance(fx.respondents(spark, sf))


def _describe_sql() -> str:
    x = "burnout_score"
    cols = {
        "count": f"CAST(count({x}) AS DOUBLE)",
        "mean": S.grid_mean(x, 100),
        "std": f"stddev_samp({x})",
        "min": f"min({x})",
        "p25": f"quantile_cont({x}, 0.25)",
        "p50": f"quantile_cont({x}, 0.5)",
        "p75": f"quantile_cont({x}, 0.75)",
        "max": f"max({x})",
    }
    return f"{ctes.with_engineered()} SELECT " + ", ".join(f"{S.rnd(v, 2)} AS {k}" for k, v in cols.items()) + " FROM engineered"


@query("score_describe", "V6", _describe_sql)
def q_score_describe(spark, sf):
    return val.describe(_engineered(spark, sf), "burnout_score", grid=100)


PRICES = ["l_extendedprice", "l_quantity"]


def _batches_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, true AS p25_ok, true AS p50_ok, true AS p75_ok FROM lineitem" for c in PRICES]
    return " UNION ALL ".join(parts)


@query("describe_batches", "V6", _batches_sql)
def q_describe_batches(spark, sf):
    """Summary of two unbounded columns from four batches' sketches; each quantile's rank is checked to 1 % against all rows."""
    items = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", *PRICES)
    path = scratch_path(spark, "sketches")
    for b in range(4):
        sketches.add_batch(items.where(F.col("l_orderkey") % 4 == b), PRICES, path, b)
    out = sketches.merged(sketches.read_parts(spark, path)).persist()  # one row per column
    probs, found = [0.25, 0.5, 0.75], {r["column_name"]: r["quantiles"] for r in out.collect()}
    ranks = [F.struct(F.lit(c).alias("column_name"), *[F.struct((F.avg((F.col(c) < q).cast("double"))).alias("lo"), (F.avg((F.col(c) <= q).cast("double"))).alias("hi")).alias(f"p{i}") for i, q in enumerate(found[c])]) for c in PRICES]
    exact = items.agg(*[s.alias(f"s{i}") for i, s in enumerate(ranks)]).select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(PRICES))])))
    ok = [((F.col(f"p{i}.lo") <= p + 0.01) & (F.col(f"p{i}.hi") >= p - 0.01)).alias(f"p{int(100 * p)}_ok") for i, p in enumerate(probs)]
    return out.join(exact, "column_name").select("column_name", "count", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min", "max", *ok)


def _range_sql() -> str:
    parts = [
        f"""SELECT '{c}' AS index_name, CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value,
        CAST(count(*) - count({c}) AS BIGINT) AS n_null,
        coalesce(min({c}) >= 0.0 AND max({c}) <= 1.01 AND count(*) = count({c}), false) AS in_range FROM engineered"""
        for c in INDEX_TERMS
    ]
    return f"{ctes.with_engineered()} " + " UNION ALL ".join(parts)


@query("index_range_check", "V7", _range_sql)
def q_index_range_check(spark, sf):
    return val.index_range_check(_engineered(spark, sf), list(INDEX_TERMS))


@query(
    "monotone_check",
    "V8",
    lambda: f"""{ctes.with_engineered()}, m AS (SELECT stress_level, {S.grid_mean('burnout_score', 100)} AS mean_score FROM engineered GROUP BY stress_level)
SELECT stress_level, mean_score, lag(mean_score) OVER (ORDER BY stress_level) AS prev_mean,
       coalesce(mean_score > lag(mean_score) OVER (ORDER BY stress_level), true) AS rises FROM m""",
)
def q_monotone_check(spark, sf):
    return val.monotone_check(_engineered(spark, sf))


# --- R ------------------------------------------------------------------------


def _hist_sql(bins: int = 30) -> str:
    B = S.D(bins)
    first = "(CASE WHEN mx > mn THEN mn ELSE mn - 0.5 END)"
    last = "(CASE WHEN mx > mn THEN mx ELSE mx + 0.5 END)"
    step = f"(({last} - {first}) / {B})"

    def edge(i: str) -> str:
        return f"(({i}) * {step} + {first})"

    return f"""{ctes.with_engineered()},
r AS (SELECT min(burnout_score) AS mn, max(burnout_score) AS mx FROM engineered),
a AS (SELECT burnout_score AS x, least(greatest(floor((burnout_score - {first}) / ({last} - {first}) * {B}), 0), {bins - 1}) AS i0, r.* FROM engineered, r),
b AS (SELECT x, mn, mx, CASE WHEN x < {edge('i0')} THEN i0 - 1 ELSE i0 END AS i1 FROM a),
c AS (SELECT CAST(CASE WHEN x >= {edge('i1 + 1')} AND i1 <> {bins - 1} THEN i1 + 1 ELSE i1 END AS INTEGER) AS bin FROM b),
counts AS (SELECT bin, count(*) AS n FROM c GROUP BY bin),
fl AS (SELECT {first} AS fst, {last} AS lst FROM r),
g AS (SELECT CAST(range AS INTEGER) AS bin, fst, lst FROM range({bins}), fl),
e AS (SELECT bin, round(CAST(bin AS DOUBLE) * ((lst - fst) / {B}) + fst, 6) AS lo_edge,
             round(CASE WHEN bin = {bins - 1} THEN lst ELSE CAST(bin + 1 AS DOUBLE) * ((lst - fst) / {B}) + fst END, 6) AS hi_edge FROM g)
SELECT e.bin, e.lo_edge, e.hi_edge, CAST(coalesce(counts.n, 0) AS BIGINT) AS n FROM e LEFT JOIN counts ON e.bin = counts.bin"""


@query("score_histogram", "R1", _hist_sql)
def q_score_histogram(spark, sf):
    return rep.histogram(_engineered(spark, sf))


@query(
    "score_center",
    "R2",
    lambda: f"{ctes.with_engineered()} SELECT {S.grid_mean('burnout_score', 100)} AS mean_score, quantile_cont(burnout_score, 0.5) AS median_score FROM engineered",
)
def q_score_center(spark, sf):
    return rep.center(_engineered(spark, sf))


def _risk_dist_sql() -> str:
    return f"""{ctes.with_engineered()},
c AS (SELECT count(*) FILTER (WHERE burnout_score <= 33.0) AS lo, count(*) FILTER (WHERE burnout_score > 33.0 AND burnout_score <= 66.0) AS mo,
             count(*) FILTER (WHERE burnout_score > 66.0) AS hi FROM engineered),
l AS (SELECT 0 AS band_order, 'Low' AS risk_level, lo AS n, lo + mo + hi AS t FROM c
      UNION ALL SELECT 1, 'Moderate', mo, lo + mo + hi FROM c UNION ALL SELECT 2, 'High', hi, lo + mo + hi FROM c)
SELECT CAST(band_order AS INTEGER) AS band_order, risk_level, CAST(n AS BIGINT) AS n,
       {S.rnd(f'CASE WHEN t = 0 THEN NULL ELSE (n * {S.D(100.0)}) / CAST(t AS DOUBLE) END', 1)} AS share_pct FROM l"""


@query("risk_distribution", "R3", _risk_dist_sql)
def q_risk_distribution(spark, sf):
    return rep.risk_distribution(_engineered(spark, sf))


def _corr_sql(source_ctes: str, table: str) -> str:
    cols = rep.CORRELATION_COLUMNS
    parts = []
    for i in range(len(cols)):
        for j in range(i + 1, len(cols)):
            a, b = f"CAST({cols[i]} AS DOUBLE)", f"CAST({cols[j]} AS DOUBLE)"
            both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
            den = f"(stddev_samp(CASE WHEN {both} THEN {a} END) * stddev_samp(CASE WHEN {both} THEN {b} END))"
            e = f"CASE WHEN {den} = 0 OR isnan({den}) THEN NULL ELSE covar_samp({a}, {b}) / {den} END"
            parts.append(f"SELECT '{cols[j]}' AS row_col, '{cols[i]}' AS col_col, {S.rnd(e, 2)} AS corr FROM {table}")
    return f"{source_ctes} " + " UNION ALL ".join(parts)


@query("correlation_pairs", "R4 R5", lambda: _corr_sql(ctes.with_engineered(), "engineered"))
def q_correlation_pairs(spark, sf):
    return rep.correlation_pairs(_engineered(spark, sf))


#: Column -> a value is missing in every so many rows.
MISSING = {"anxiety_level": 17, "depression": 19, "noise_level": 23}


def _corr_missing_sql() -> str:
    holes = ", ".join(f"CASE WHEN respondent_id % {k} = 0 THEN NULL ELSE {c} END AS {c}" for c, k in MISSING.items())
    return _corr_sql(f"{ctes.with_engineered()}, holed AS (SELECT * REPLACE ({holes}) FROM engineered)", "holed")


@query("correlation_missing", "R4 R5", _corr_missing_sql)
def q_correlation_missing(spark, sf):
    rid = F.col("respondent_id")
    holes = {c: F.when(rid % k != 0, F.col(c).cast("double")).when(rid % 2 == 0, F.lit(float("nan"))) for c, k in MISSING.items()}
    return rep.correlation_pairs(_engineered(spark, sf).withColumns(holes))


LABEL_CASE = "CASE stress_level WHEN 0 THEN 'Low (0)' WHEN 1 THEN 'Moderate (1)' WHEN 2 THEN 'High (2)' END"


@query(
    "label_names",
    "R6",
    lambda: f"WITH {ctes.respondents()} SELECT respondent_id, stress_level, {LABEL_CASE} AS stress_label FROM respondents",
)
def q_label_names(spark, sf):
    r = fx.respondents(spark, sf)
    return r.select("respondent_id", "stress_level", rep.label_names(F.col("stress_level")).alias("stress_label"))


def _box_sql() -> str:
    r6 = lambda e: f"round({e}, 6)"
    return f"""{ctes.with_engineered()},
e AS (SELECT {LABEL_CASE} AS stress_label, burnout_score AS x FROM engineered),
q AS (SELECT stress_label, count(x) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS med, quantile_cont(x, 0.75) AS q3 FROM e GROUP BY stress_label),
lim AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_lim, q3 + 1.5 * (q3 - q1) AS hi_lim FROM q),
w AS (SELECT e.stress_label, min(CASE WHEN x >= lo_lim AND x <= hi_lim THEN x END) AS wl, max(CASE WHEN x >= lo_lim AND x <= hi_lim THEN x END) AS wh,
             count(*) FILTER (WHERE NOT (x >= lo_lim AND x <= hi_lim)) AS n_out FROM e JOIN lim USING (stress_label) GROUP BY e.stress_label)
SELECT stress_label, CAST(n AS BIGINT) AS n, {r6('q1')} AS q1, {r6('med')} AS median, {r6('q3')} AS q3, {r6('wl')} AS whisker_lo, {r6('wh')} AS whisker_hi,
       CAST(n_out AS BIGINT) AS n_outliers, {r6('med - 1.57 * (q3 - q1) / sqrt(CAST(n AS DOUBLE))')} AS notch_lo,
       {r6('med + 1.57 * (q3 - q1) / sqrt(CAST(n AS DOUBLE))')} AS notch_hi
FROM lim JOIN w USING (stress_label)"""


@query("box_stats", "R7", _box_sql)
def q_box_stats(spark, sf):
    e = _engineered(spark, sf).withColumn("stress_label", rep.label_names(F.col("stress_level")))
    return rep.box_stats(e, "stress_label")


@query(
    "mean_by_label_ordered",
    "R8",
    lambda: f"""{ctes.with_engineered()},
m AS (SELECT {LABEL_CASE} AS stress_label, {S.grid_mean('burnout_score', 100)} AS mean_score FROM engineered GROUP BY 1)
SELECT CAST(o.label_order AS INTEGER) AS label_order, o.stress_label, m.mean_score
FROM (VALUES (0, 'Low (0)'), (1, 'Moderate (1)'), (2, 'High (2)')) o(label_order, stress_label) LEFT JOIN m USING (stress_label)""",
)
def q_mean_by_label_ordered(spark, sf):
    e = _engineered(spark, sf).withColumn("stress_label", rep.label_names(F.col("stress_level")))
    return rep.mean_by_label_ordered(e)
