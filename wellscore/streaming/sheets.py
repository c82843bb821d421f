"""Answer sheets emitted as soon as they are complete (ST2), as keyed state with timers.

Each respondent's open sheet is state: the last value of every answered question, the time of its first
answer and the number of answers. The answer that fills the last open question emits the sheet and
closes it; answers up to that time that arrive later don't reopen it. A sheet that isn't complete
`ttl` after its first answer lapses: the next answer starts a new one, and an event-time timer frees
the state when the watermark gets there. State is bounded by the respondents active within `ttl`,
however long a respondent goes on answering.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wellscore.session import scratch_path
from wellscore.spec import DEFAULT_SPEC, INDICATORS, Spec
from wellscore.streaming.stream import spark_question_map

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


SHEET_STATE = "due long, started long, n long, closed long, question array<int>, value array<int>, us array<long>"


class SheetProcessor(StatefulProcessor):
    """State of one respondent, read and written as one value: the open sheet (started, n), `closed` and question -> (value, us). Times in microseconds."""

    def __init__(self, n_questions: int, ttl_us: int):
        self.n_questions, self.ttl_us = n_questions, ttl_us
        self.fields = ["respondent_id", "started_us", "completed_us", "n_answers", *[f"q{q}" for q in range(n_questions)]]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sheet = handle.getValueState("sheet", SHEET_STATE)

    def _read(self) -> tuple[int | None, int | None, int, int | None, dict]:
        """(due, started, n, closed, question -> (value, us)); due: the time in ms of the timer that is set"""
        kept = self.sheet.get()
        if kept is None:
            return None, None, 0, None, {}
        due, started, n, closed, questions, values, times = kept
        return due, started, n, closed, dict(zip(questions, zip(values, times, strict=True), strict=True))

    def _write(self, due: int | None, started: int | None, n: int, closed: int | None, held: dict) -> None:
        """Keep the state. One timer is set at a time, and it is set again only after it has fired: when the sheet lapses, or
        when answers up to `closed` are too late to come."""
        ends = [end for end in (None if started is None else started + self.ttl_us, closed) if end is not None]
        if due is None and ends:
            due = int(max(ends)) // 1000 + 1
            self.handle.registerTimer(due)
        if ends:
            self.sheet.update((due, started, n, closed, list(held), [v for v, _ in held.values()], [at for _, at in held.values()]))
        else:
            self.sheet.clear()

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = sorted((r["us"], r["event_id"], r["question"], r["value"]) for r in rows)
        due, started, n, closed, held = self._read()
        out = []
        for us, group in groupby(new, key=lambda t: t[0]):
            if closed is not None and us <= closed:
                continue
            if started is not None and us > started + self.ttl_us:
                held, started, n = {}, None, 0
            started = us if started is None else min(started, us)
            for _, _, question, value in group:
                n += 1
                if question not in held or held[question][1] <= us:
                    held[question] = (value, us)
            if len(held) == self.n_questions:
                closed = max(at for _, at in held.values())
                out.append(Row(**dict(zip(self.fields, (key[0], started, closed, n, *[held[q][0] for q in range(self.n_questions)]), strict=True))))
                held, started, n = {}, None, 0
        self._write(due, started, n, closed, held)
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs() * 1000
        _, started, n, closed, held = self._read()
        if started is not None and started + self.ttl_us < now:
            started, n, held = None, 0, {}
        if closed is not None and closed < now:
            closed = None
        self._write(None, started, n, closed, held)
        return iter(())

    def close(self) -> None:
        pass


def complete_sheets(stream: DataFrame, bank: DataFrame, ttl_hours: float = 48.0, delay: str = "1 hour", spec: Spec = DEFAULT_SPEC) -> DataFrame:
    """One row per completed sheet: respondent_id, started_at, completed_at, n_answers and every indicator's value.

    stream: answers (event_id, respondent_id, question, opt_idx, ts); answers at one time count as given together."""
    names = [f for f, _, _ in INDICATORS]
    questions = spark_question_map(bank.sparkSession, {f: i for i, f in enumerate(names)})  # as many rows as questions
    vals = stream.join(F.broadcast(questions), "question").join(F.broadcast(bank.select("feature", "opt_idx", "value")), ["feature", "opt_idx"])
    rows = vals.withWatermark("ts", delay).select("respondent_id", "ts", F.unix_micros("ts").alias("us"), "event_id", "question", F.col("value").cast("int").alias("value"))
    kind = stream.schema["respondent_id"].dataType.simpleString()
    fields = f"respondent_id {kind}, started_us long, completed_us long, n_answers long, " + ", ".join(f"q{q} int" for q in range(len(names)))
    done = rows.groupBy("respondent_id").transformWithState(SheetProcessor(len(names), int(ttl_hours * 3_600_000_000)), fields, "Append", "EventTime")
    times = [F.timestamp_micros(f"{c}_us").alias(f"{c}_at") for c in ("started", "completed")]
    return done.select("respondent_id", *times, "n_answers", *[F.col(f"q{names.index(f)}").alias(f) for f in spec.features])


def run_stateful(stream: DataFrame, name: str) -> DataFrame:
    """Run a query with keyed state to completion into a parquet sink; the sink as a table. Its state lives in RocksDB."""
    spark = stream.sparkSession
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        q = stream.writeStream.format("parquet").option("checkpointLocation", ckpt).trigger(availableNow=True).start(out)
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
