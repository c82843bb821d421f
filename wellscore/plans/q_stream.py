"""Queries for the stream re-aims (ST1-ST4), each checked against a batch oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from wellscore.operators import features as feat
from wellscore.operators import survey as sv
from wellscore.plans import ctes
from wellscore.plans import sqlspec as S
from wellscore.plans.linear_sql import prediction
from wellscore.plans.q_models import _clipped, _linear_cte, _saved_linear, _scored_features
from wellscore.plans.q_survey import bank_cte
from wellscore.plans.registry import query
from wellscore.plans.stored import input_state
from wellscore.sources import fixtures as fx
from wellscore.spec import DEFAULT_SPEC, INDICATORS
from wellscore.streaming import stream as st
from wellscore.streaming.scoring import run_to_batches, score_with_model
from wellscore.streaming.sheets import complete_sheets, run_stateful

SPEC = DEFAULT_SPEC
TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DUCK_FMT = "'%Y-%m-%d %H:%M:%S.%f'"


_INPUT: dict[tuple, tuple[str, int]] = {}


def _stream(spark, sf, kind, repeat_every=0):
    """A stream over the events as answers or records; its files are written once per session."""
    key = (spark.sparkContext.applicationId, sf, input_state(spark, sf, "events"), kind, repeat_every)
    if key not in _INPUT:
        rows = {"answers": st.answer_events, "records": st.record_events}[kind](spark.read.parquet(f"{sf}/events.parquet"))
        _INPUT[key] = st.write_event_files(spark, rows, repeat_every=repeat_every)
    return st.read_events(spark, *_INPUT[key])


def _frozen(spark, sf):
    row = feat.frozen_range(fx.respondents(spark, sf), SPEC).first()
    return row["mn"], row["mx"]


def _answer_events_sql() -> str:
    sizes = ", ".join(str(fx.BANK_A_SIZES[f]) for f, _, _ in INDICATORS)
    sheet = f"event_id % {st.SHEET_EVERY} = 0"
    return f"""asked AS (SELECT *, unnest(CASE WHEN {sheet} THEN range(20) ELSE [event_id % 20] END) AS q,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
ev AS (SELECT event_id, user_id AS respondent_id, CAST(q AS INTEGER) AS question,
  CAST(1 + (k + CASE WHEN {sheet} THEN q ELSE 0 END) % ([{sizes}])[CAST(q AS INTEGER) + 1] AS INTEGER) AS opt_idx,
  event_type, CAST(ts AS TIMESTAMP) AS ts FROM asked)"""


def _scored_events_sql() -> str:
    rec = ", ".join(fx.respondent_exprs("duckdb", key="event_id", cohort="event_type"))
    ind = S.select_list(S.index_exprs(SPEC, "score"))
    inter = S.select_list(S.interaction_exprs("score"))
    tr = S.select_list(S.index_exprs(SPEC))
    clipped = S.rnd(f"least(greatest(({S.minmax_expr()}), {S.D(0.0)}), {S.D(100.0)})", 2)
    return f"""WITH {ctes.respondents()},
tr AS (SELECT {tr} FROM respondents),
rng AS (SELECT min({S.raw_expr()}) AS mn, max({S.raw_expr()}) AS mx FROM tr),
rec AS (SELECT {rec}, CAST(ts AS TIMESTAMP) AS ts FROM events),
sf AS (SELECT *, {ind}, {inter} FROM rec),
rawt AS (SELECT *, {S.raw_expr()} AS raw_score FROM sf),
scored AS (SELECT respondent_id AS event_id, ts, {clipped} AS burnout_score FROM rawt, rng),
banded AS (SELECT *, {S.band_expr('burnout_score')} AS risk_level FROM scored)"""


@query("stream_score", "ST1", lambda: f"{_scored_events_sql()} SELECT event_id, burnout_score, risk_level FROM banded")
def q_stream_score(spark, sf):
    out = st.run_to_table(spark, st.score_stream(_stream(spark, sf, "records"), _frozen(spark, sf), SPEC), "st1")
    return out.select("event_id", "burnout_score", "risk_level")


def _model_stream_sql() -> str:
    rec = ", ".join(fx.respondent_exprs("duckdb", key="event_id", cohort="event_type"))
    return f"""{_linear_cte()}, rec AS (SELECT {rec} FROM events), {_scored_features("rec")},
sc AS (SELECT respondent_id AS event_id, {_clipped(prediction())} AS burnout_score FROM sf, lc)
SELECT event_id, burnout_score, {S.band_expr("burnout_score")} AS risk_level FROM sc"""


@query("stream_score_model", "ST1 Q2", _model_stream_sql)
def q_stream_score_model(spark, sf):
    scored = score_with_model(_stream(spark, sf, "records"), _saved_linear(spark, sf), SPEC)
    return run_to_batches(scored, "st1m").select("event_id", "burnout_score", "risk_level")


def _sessions_sql(gap_h: int = 2, delay_h: int = 1) -> str:
    vals_f = ", ".join(f"max_by(value, ts) FILTER (WHERE feature = '{f}') AS {f}" for f in SPEC.features)
    answered = " + ".join(f"CAST({f} IS NOT NULL AS INTEGER)" for f in SPEC.features)
    qmap = ", ".join(f"({i}, '{f}')" for i, (f, _, _) in enumerate(INDICATORS))
    return f"""WITH {_answer_events_sql()}, {bank_cte('A')},
vals AS (SELECT ev.*, b.value, b.feature FROM ev JOIN (VALUES {qmap}) q(question, feature) USING (question)
         JOIN bankA b ON b.feature = q.feature AND b.opt_idx = ev.opt_idx),
s1 AS (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY respondent_id ORDER BY ts, event_id, question) IS NULL
                       OR ts - lag(ts) OVER (PARTITION BY respondent_id ORDER BY ts, event_id, question) >= INTERVAL {gap_h} HOUR THEN 1 ELSE 0 END AS new_s FROM vals),
s2 AS (SELECT *, sum(new_s) OVER (PARTITION BY respondent_id ORDER BY ts, event_id, question ROWS UNBOUNDED PRECEDING) AS sid FROM s1),
sess AS (SELECT respondent_id, min(ts) AS s_start, max(ts) + INTERVAL {gap_h} HOUR AS s_end, count(*) AS n_events, {vals_f}
         FROM s2 GROUP BY respondent_id, sid),
wm AS (SELECT max(ts) - INTERVAL {delay_h} HOUR AS wm FROM vals)
SELECT respondent_id, strftime(s_start, {DUCK_FMT}) AS session_start, strftime(s_end, {DUCK_FMT}) AS session_end, n_events,
       CAST({answered} AS INTEGER) AS n_answered, {', '.join(SPEC.features)}
FROM sess, wm WHERE s_end <= wm.wm AND {answered} = {len(SPEC.features)}"""


@query("stream_sessions", "ST2", _sessions_sql)
def q_stream_sessions(spark, sf):
    bank = sv.option_bank(spark, "A", SPEC)
    out = st.run_to_table(spark, st.assemble_answers(_stream(spark, sf, "answers"), bank, "2 hours", "1 hour", SPEC), "st2")
    return out.withColumns({"session_start": F.date_format("session_start", TS_FMT), "session_end": F.date_format("session_end", TS_FMT)})


TTL_HOURS = 48


def _sheets_sql() -> str:
    qmap = ", ".join(f"({i}, '{f}')" for i, (f, _, _) in enumerate(INDICATORS))
    names = [f for f, _, _ in INDICATORS]
    values = ", ".join(f"max(value) FILTER (WHERE question = {q})" for q in range(len(names)))
    fresh = f"started IS NULL OR len(list_filter(st.v, lambda x: x IS NOT NULL)) = {len(names)} OR step.us > started + {TTL_HOURS * 3_600_000_000}"
    return f"""WITH RECURSIVE {_answer_events_sql()}, {bank_cte('A')},
vals AS (SELECT ev.*, b.value FROM ev JOIN (VALUES {qmap}) q(question, feature) USING (question) JOIN bankA b ON b.feature = q.feature AND b.opt_idx = ev.opt_idx),
one AS (SELECT respondent_id, ts, question, max_by(value, event_id) AS value, count(*) AS n FROM vals GROUP BY respondent_id, ts, question),
step AS (SELECT respondent_id, epoch_us(ts) AS us, sum(n) AS n, [{values}] AS v, row_number() OVER (PARTITION BY respondent_id ORDER BY ts) AS i FROM one GROUP BY respondent_id, ts),
st(respondent_id, i, started, completed, n, v) AS (
  SELECT DISTINCT respondent_id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(0 AS HUGEINT), CAST(NULL AS INTEGER[]) FROM step UNION ALL
  SELECT st.respondent_id, step.i, CASE WHEN {fresh} THEN step.us ELSE started END, step.us, CASE WHEN {fresh} THEN step.n ELSE st.n + step.n END,
    CASE WHEN {fresh} THEN step.v ELSE list_transform(range({len(names)}), lambda k: coalesce(step.v[k + 1], st.v[k + 1])) END
  FROM st JOIN step ON step.respondent_id = st.respondent_id AND step.i = st.i + 1)
SELECT respondent_id, strftime(make_timestamp(started), {DUCK_FMT}) AS started_at, strftime(make_timestamp(completed), {DUCK_FMT}) AS completed_at, CAST(n AS BIGINT) AS n_answers,
       {', '.join(f'v[{names.index(f) + 1}] AS {f}' for f in SPEC.features)}
FROM st WHERE len(list_filter(v, lambda x: x IS NOT NULL)) = {len(names)}"""


@query("stream_answers", "ST2", _sheets_sql)
def q_stream_answers(spark, sf):
    bank = sv.option_bank(spark, "A", SPEC)
    out = run_stateful(complete_sheets(_stream(spark, sf, "answers"), bank, TTL_HOURS), "sheets")
    return out.withColumns({c: F.date_format(c, TS_FMT) for c in ("started_at", "completed_at")})


@query(
    "stream_dedupe",
    "ST3",
    lambda: f"WITH {_answer_events_sql()} SELECT DISTINCT event_id, respondent_id, question, opt_idx FROM ev",
)
def q_stream_dedupe(spark, sf):
    out = st.run_to_table(spark, st.dedupe_stream(_stream(spark, sf, "answers", repeat_every=2)), "st3")
    return out.select("event_id", "respondent_id", "question", "opt_idx")


@query(
    "stream_risk_window",
    "ST4",
    lambda: f"""{_scored_events_sql()},
wm AS (SELECT max(ts) - INTERVAL 1 HOUR AS wm FROM banded),
g AS (SELECT date_trunc('day', ts) AS ws, risk_level, count(*) AS n FROM banded GROUP BY 1, 2)
SELECT strftime(ws, {DUCK_FMT}) AS window_start, strftime(ws + INTERVAL 1 DAY, {DUCK_FMT}) AS window_end, risk_level, n
FROM g, wm WHERE ws + INTERVAL 1 DAY <= wm.wm""",
)
def q_stream_risk_window(spark, sf):
    scored = st.score_stream(_stream(spark, sf, "records"), _frozen(spark, sf), SPEC)
    tz = spark.conf.get("spark.sql.session.timeZone")  # events carry wall-clock times
    out = st.run_to_table(spark, st.band_windows(scored, "1 day", "1 hour", wall_clock_tz=tz), "st4")
    return out.withColumns({"window_start": F.date_format("window_start", TS_FMT), "window_end": F.date_format("window_end", TS_FMT)})
