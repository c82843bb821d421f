"""Queries for survey answers and option banks."""

from __future__ import annotations

from pyspark.sql import functions as F

from wellscore.operators import features as feat
from wellscore.operators import survey as sv
from wellscore.plans import ctes
from wellscore.plans import sqlspec as S
from wellscore.plans.registry import REGISTRY, query
from wellscore.session import scratch_path
from wellscore.sources import fixtures as fx
from wellscore.spec import DEFAULT_SPEC, OPTION_BANKS

SPEC = DEFAULT_SPEC


def _q(s) -> str:
    return "NULL" if s is None else "'" + str(s).replace("'", "''") + "'"


def bank_cte(bank: str | None = None) -> str:
    rows = [r for r in sv.bank_rows(SPEC) if bank is None or r[0] == bank]
    vals = ", ".join(f"({_q(b)}, {qp}, {_q(f)}, {_q(sec)}, {_q(qt)}, {oi}, {_q(lab)}, {v})" for b, qp, f, sec, qt, oi, lab, v in rows)
    name = f"bank{bank or ''}"
    return f"""{name} AS (SELECT bank, CAST(q_pos AS INTEGER) AS q_pos, feature, CAST(section AS VARCHAR) AS section, question,
CAST(opt_idx AS INTEGER) AS opt_idx, label, CAST(value AS INTEGER) AS value FROM (VALUES {vals}) t(bank, q_pos, feature, section, question, opt_idx, label, value))"""


def _bank(spark, name: str | None = "A"):
    return sv.option_bank(spark, name, SPEC)


@query(
    "option_bank",
    "A1",
    lambda: f"""WITH {ctes.answers()}, {bank_cte()},
c AS (SELECT substring('ABCDE', CAST(respondent_id % 5 AS INTEGER) + 1, 1) AS bank, feature, opt_idx, count(*) AS n_answers FROM answers GROUP BY 1, 2, 3)
SELECT b.*, CAST(coalesce(c.n_answers, 0) AS BIGINT) AS n_answers FROM bank b
LEFT JOIN c ON c.bank = b.bank AND c.feature = b.feature AND c.opt_idx = b.opt_idx""",
)
def q_option_bank(spark, sf):
    # sheets of all five banks: the fixture deals them by respondent
    sheet = F.substring(F.lit("ABCDE"), (F.col("respondent_id") % 5).cast("int") + 1, F.lit(1))
    return sv.option_usage(fx.answers(spark, sf).withColumn("bank", sheet), _bank(spark, None))


def _file_bank_sql() -> str:
    return f"SELECT * FROM ({REGISTRY['option_bank'].sql}) WHERE bank IN ('A', 'B', 'C')"


@query("option_bank_file", "A1 V9 V10 V11", _file_bank_sql)
def q_option_bank_file(spark, sf):
    """The use of every option of the complete banks, written to a file, read back and checked (D and E lack or add an indicator)."""
    path = scratch_path(spark, "bank-file")
    sv.write_bank(_bank(spark, None), path)
    sheet = F.substring(F.lit("ABCDE"), (F.col("respondent_id") % 5).cast("int") + 1, F.lit(1))
    return sv.option_usage(fx.answers(spark, sf).withColumn("bank", sheet), sv.load_bank(spark, path, SPEC, ["A", "B", "C"]))


@query(
    "answers_to_values",
    "A2",
    lambda: f"""WITH {ctes.answers()}, {bank_cte('A')}
SELECT a.feature, a.opt_idx, a.respondent_id, a.answer_seq, b.value FROM answers a JOIN bankA b USING (feature, opt_idx)""",
)
def q_answers_to_values(spark, sf):
    return sv.answers_to_values(fx.answers(spark, sf), _bank(spark))


@query(
    "rejected_answers",
    "A3",
    lambda: f"""WITH {ctes.answers()}, {bank_cte('A')}
SELECT a.*, 'unknown_feature' AS reason FROM answers a WHERE a.feature NOT IN (SELECT feature FROM bankA)
UNION ALL
SELECT a.*, 'invalid_option' FROM answers a WHERE a.feature IN (SELECT feature FROM bankA)
  AND NOT EXISTS (SELECT 1 FROM bankA b WHERE b.feature = a.feature AND b.opt_idx = a.opt_idx)""",
)
def q_rejected_answers(spark, sf):
    return sv.rejected_answers(fx.answers(spark, sf), _bank(spark))


def _wide_cte() -> str:
    cols = ", ".join(f"max_by(value, answer_seq) FILTER (WHERE feature = '{f}' AND value IS NOT NULL) AS {f}" for f in SPEC.features)
    return f"""WITH {ctes.answers()}, {bank_cte('A')},
vals AS (SELECT a.*, b.value FROM answers a LEFT JOIN bankA b USING (feature, opt_idx)),
wide AS (SELECT respondent_id, {cols} FROM vals GROUP BY respondent_id)"""


@query("answers_wide", "A4", lambda: f"{_wide_cte()} SELECT * FROM wide")
def q_answers_wide(spark, sf):
    return sv.answers_wide(sv.answers_to_values(fx.answers(spark, sf), _bank(spark), keep_invalid=True), SPEC.features)


def _filled_cte() -> str:
    mids = sv.midpoints("A")
    cols = ", ".join(f"CAST(coalesce({f}, {mids[f]}) AS INTEGER) AS {f}" for f in SPEC.features)
    return f"{_wide_cte()}, filled AS (SELECT respondent_id, {cols} FROM wide)"


@query("fill_midpoint", "A5", lambda: f"{_filled_cte()} SELECT * FROM filled")
def q_fill_midpoint(spark, sf):
    values = sv.answers_to_values(fx.answers(spark, sf), _bank(spark), keep_invalid=True)
    return sv.fill_midpoint(sv.answers_wide(values, SPEC.features), SPEC.features, "A")


def _review_sql() -> str:
    q, lab = "b.question", "coalesce(l.label, '—')"
    return f"""WITH {ctes.answers()}, {bank_cte('A')},
qs AS (SELECT DISTINCT feature, q_pos, question FROM bankA)
SELECT a.respondent_id, a.answer_seq, b.q_pos,
       CASE WHEN length({q}) > 45 THEN substring({q}, 1, 45) || '...' ELSE {q} END AS question_short,
       CASE WHEN length({lab}) > 60 THEN substring({lab}, 1, 57) || '...' ELSE {lab} END AS answer_label
FROM answers a JOIN qs b ON a.feature = b.feature LEFT JOIN bankA l ON l.feature = a.feature AND l.opt_idx = a.opt_idx"""


@query("response_review", "A10", _review_sql)
def q_response_review(spark, sf):
    return sv.response_review(fx.answers(spark, sf), _bank(spark))


def _e2e_sql() -> str:
    ind_train = S.raw_expr()
    ind = S.select_list(S.index_exprs(SPEC, "score"))
    inter = S.select_list(S.interaction_exprs("score"))
    tr = S.select_list(S.index_exprs(SPEC))
    clipped = S.rnd(f"least(greatest(({S.minmax_expr()}), {S.D(0.0)}), {S.D(100.0)})", 2)
    return f"""{_filled_cte()}, {ctes.respondents()},
tr AS (SELECT {tr} FROM respondents),
rng AS (SELECT min({ind_train}) AS mn, max({ind_train}) AS mx FROM tr),
sf AS (SELECT *, {ind}, {inter} FROM filled),
rawt AS (SELECT *, {S.raw_expr()} AS raw_score FROM sf),
scored AS (SELECT respondent_id, {clipped} AS burnout_score FROM rawt, rng)
SELECT respondent_id, burnout_score, {S.band_expr('burnout_score')} AS risk_level FROM scored"""


@query("answers_end_to_end", "A12 Q1 Q3 Q4", _e2e_sql)
def q_answers_end_to_end(spark, sf):
    row = feat.frozen_range(fx.respondents(spark, sf), SPEC).first()
    return sv.answers_end_to_end(fx.answers(spark, sf), _bank(spark), (row["mn"], row["mx"]), SPEC)


def _coverage_sql() -> str:
    miss = " UNION ALL ".join(
        f"SELECT '{b}' AS bank, e.feature, 'missing' AS issue FROM exp e WHERE e.feature NOT IN (SELECT feature FROM bank WHERE bank = '{b}')"
        for b in OPTION_BANKS
    )
    return f"""WITH {ctes.answers()}, {bank_cte()},
exp AS (SELECT DISTINCT feature FROM answers),
pb AS (SELECT DISTINCT bank, feature, q_pos FROM bank)
{miss}
UNION ALL SELECT bank, feature, 'extra' FROM pb WHERE feature NOT IN (SELECT feature FROM exp)
UNION ALL SELECT bank, feature, 'duplicate' FROM pb GROUP BY bank, feature HAVING count(*) > 1"""


@query("bank_coverage", "V9", _coverage_sql)
def q_bank_coverage(spark, sf):
    expected = fx.answers(spark, sf).select("feature").distinct()
    return sv.bank_coverage(_bank(spark, None), expected).select("bank", "feature", "issue")


def _sections_cte(bank: str) -> str:
    return f"""WITH {ctes.answers()}, {bank_cte(bank)},
qs AS (SELECT q_pos, feature, coalesce(last_value(section IGNORE NULLS) OVER (ORDER BY q_pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'General') AS section
       FROM (SELECT DISTINCT q_pos, feature, section FROM bank{bank})),
aq AS (SELECT a.respondent_id, qs.q_pos, qs.feature, qs.section FROM (SELECT DISTINCT respondent_id, feature FROM answers) a JOIN qs USING (feature)),
bysec AS (SELECT respondent_id, section, count(*) AS n_answered, min(q_pos) AS first_pos, string_agg(feature, ',' ORDER BY q_pos) AS features
          FROM aq GROUP BY respondent_id, section)"""


@query("answers_by_section", "A6 A9", lambda: f"{_sections_cte('D')} SELECT * FROM bysec")
def q_answers_by_section(spark, sf):
    return sv.answered_by_section(fx.answers(spark, sf), _bank(spark, "D"))


def _sections_ordered_sql() -> str:
    slots = ", ".join(f"({i}, '{s}')" for i, s in enumerate(sv.BANK_B_SECTION_ORDER))
    return f"""{_sections_cte('B')}
SELECT r.respondent_id, CAST(o.section_order AS INTEGER) AS section_order, o.section, CAST(coalesce(b.n_answered, 0) AS BIGINT) AS n_answered,
       coalesce(b.features, '') AS features
FROM (SELECT DISTINCT respondent_id FROM answers) r, (VALUES {slots}) o(section_order, section)
LEFT JOIN bysec b ON b.respondent_id = r.respondent_id AND b.section = o.section"""


@query("answers_by_section_ordered", "A7", _sections_ordered_sql)
def q_answers_by_section_ordered(spark, sf):
    return sv.answered_by_section_ordered(fx.answers(spark, sf), _bank(spark, "B"))
