"""Sheets emitted on completion, and a stream scored with a saved model into a table that replays don't change."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wellscore.operators import models as md
from wellscore.operators import survey as sv
from wellscore.operators.predict import predict
from wellscore.session import scratch_path
from wellscore.sources import io
from wellscore.sources.fixtures import respondent_exprs
from wellscore.spec import DEFAULT_SPEC, MODEL_FEATURES, TARGET_COL
from wellscore.streaming import stream as st
from wellscore.streaming.scoring import batch_table, run_to_batches, score_with_model
from wellscore.streaming.sheets import complete_sheets, run_stateful

START = dt.datetime(2024, 1, 1)


def answers(spark, slices):
    """A stream over (respondent, question, minute) rows, one file and micro-batch per slice."""
    path = scratch_path(spark, "answers")
    n = 0
    for rows in slices:
        data = [(n + i, r, q, 1, START + dt.timedelta(minutes=m)) for i, (r, q, m) in enumerate(rows)]
        n += len(rows)
        spark.createDataFrame(data, "event_id long, respondent_id long, question int, opt_idx int, ts timestamp").coalesce(1).write.mode("append").parquet(path)
    return st.read_events(spark, path)


def test_sheets_are_emitted_once_and_lapse(spark):
    day = 24 * 60
    slices = [
        [(1, q, q) for q in range(20)] + [(2, q, 30) for q in range(10)] + [(3, q, 40 - q) for q in range(12)],
        [(1, 19, 10), (3, 0, 1)] + [(3, q, 41 + q) for q in range(12, 20)],  # late answers: one for a closed sheet, one out of order
        [(1, q, 90) for q in range(19)] + [(9, 0, 3 * day)],
        [(2, q, 3 * day + 1) for q in range(10, 20)] + [(9, q, 3 * day + 2) for q in range(1, 20)],  # 2's first half has lapsed
        [(1, 19, 3 * day + 5)] + [(2, q, 4 * day) for q in range(10)] + [(1, q, 4 * day + q) for q in range(19)],
    ]
    got = run_stateful(complete_sheets(answers(spark, slices), sv.option_bank(spark, "A")), "t-sheets")
    rows = {(r["respondent_id"], (r["started_at"] - START).total_seconds() / 60, (r["completed_at"] - START).total_seconds() / 60, r["n_answers"]) for r in got.collect()}
    assert rows == {(1, 0, 19, 20), (3, 1, 60, 21), (9, 3 * day, 3 * day + 2, 20), (2, 3 * day + 1, 4 * day, 20), (1, 3 * day + 5, 4 * day + 18, 20)}
    assert all(r[f] is not None for r in got.collect() for f in DEFAULT_SPEC.features)


@pytest.fixture(scope="module")
def saved(spark):
    train = spark.range(300).selectExpr(*respondent_exprs("spark", key="id", cohort=None))
    cols = [f for f in MODEL_FEATURES if f in train.columns]
    train = train.withColumn(TARGET_COL, F.col("anxiety_level") * 2.0 + F.col("depression") + 5)
    return io.save_model(md.fit_linear(train, cols), scratch_path(spark, "t-model")), cols


def test_stream_equals_batch_and_replay_adds_nothing(spark, saved):
    events = spark.range(600).select(F.col("id").alias("event_id"), F.lit("x").alias("event_type"), F.timestamp_seconds(F.col("id") * 60).alias("ts"))
    path, files = st.write_event_files(spark, events)
    out = run_to_batches(score_with_model(st.read_events(spark, path, files), saved[0]), "t-st1")
    batch = predict(events.selectExpr(*respondent_exprs("spark", key="event_id", cohort="event_type")), io.load_model(saved[0]))
    pick = lambda df, key: sorted((r[0], r[1], r[2], [d["name"] for d in r[3]]) for r in df.select(key, "burnout_score", "risk_level", "stress_drivers").collect())
    assert pick(out, "event_id") == pick(batch, "respondent_id")
    ids = {r["batch_id"] for r in out.select("batch_id").distinct().collect()}
    assert len(ids) > 1
    again = scratch_path(spark, "t-replay")
    sink = batch_table(again)
    for batch_id in (0, 1, 0, 0):
        sink(batch.limit(10 + batch_id), batch_id)
    assert spark.read.parquet(again).groupBy("batch_id").count().orderBy("batch_id").collect() == [(0, 10), (1, 11)]


def test_predict_missing_values_and_clashing_columns(spark, saved):
    row = spark.range(3).selectExpr(*respondent_exprs("spark", key="id", cohort=None)).withColumns({"prediction": F.lit("x"), "noise_level": F.when(F.col("respondent_id") == 1, F.lit(float("nan"))).otherwise(F.col("noise_level"))})
    row = row.withColumn("anxiety_level", F.when(F.col("respondent_id") != 2, F.col("anxiety_level")))
    got = {r["respondent_id"]: r for r in predict(row, io.load_model(saved[0]), top=20).collect()}
    assert got[0]["burnout_score"] is not None and got[0]["advice"]
    assert got[2]["burnout_score"] is None and got[2]["risk_level"] is None and got[2]["advice"] is None
    assert "noise_level" not in [d["name"] for d in got[1]["stress_drivers"]] and len(got[1]["stress_drivers"]) == 19


def test_linear_model_is_exact_on_collinear_columns(spark):
    df = spark.range(200).selectExpr("id AS respondent_id", "id % 7 AS a", "(id % 7) * 2.0D AS b", "id % 11 AS c", "3.0D AS d", f"(id % 7) + (id % 11) * 4 + 1.0D AS {TARGET_COL}")
    model = md.fit_linear(df, ["a", "b", "c", "d"])
    worst = model.transform(df).agg(F.max(F.abs(F.col("prediction") - F.col(TARGET_COL)))).first()[0]
    assert worst < 1e-9 and io.model_features(model) == ["a", "b", "c", "d"]
    with pytest.raises(ValueError, match="no complete row"):
        md.fit_linear(df.limit(0), ["a"])


class CountedState:
    """A value state and its handle in memory, counting the calls that a task would send to the state store."""

    def __init__(self):
        self.value, self.calls, self.timers = None, 0, set()

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def clear(self):
        self.calls += 1
        self.value = None

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)


def test_a_batch_of_answers_costs_three_state_calls_and_state_is_freed():
    from types import SimpleNamespace

    from wellscore.streaming.sheets import SheetProcessor

    state, p, ttl = CountedState(), SheetProcessor(20, 1_000_000), 1_000_000
    p.init(state)
    rows = lambda qs, us: [{"us": us, "event_id": q, "question": q, "value": q + 1} for q in qs]
    assert list(p.handleInputRows((7,), iter(rows(range(15), 5_000)), None)) == [] and state.calls <= 3
    state.calls = 0
    done = list(p.handleInputRows((7,), iter(rows(range(15, 20), 6_000) + rows([3], 7_000)), None))
    assert state.calls <= 3 and [r["n_answers"] for r in done] == [20] and [done[0][f"q{q}"] for q in range(20)] == list(range(1, 21))
    while state.timers:  # an open sheet of one answer, then nothing: the timer is set again until the state is free
        at = state.timers.pop()
        assert at <= (7_000 + ttl) // 1000 + 1
        p.handleExpiredTimer((7,), None, SimpleNamespace(getExpiryTimeInMs=lambda at=at: at))
    assert state.value is None
