"""Structured Streaming re-aims of the per-record programs (ST1-ST4).

* ST1 ``score_stream``: stateless scoring of arriving records against a
  frozen score range (append mode).
* ST2 ``assemble_answers``: a respondent's answers gathered per session
  window under a watermark; a session is emitted once the watermark passes
  its end, so state is bounded (a plain ``groupBy(id)`` never releases it).
* ST3 ``dedupe_stream``: repeated submissions dropped with
  ``dropDuplicatesWithinWatermark``.
* ST4 ``band_windows``: risk-band counts per tumbling event-time window.

Sources are file sources (no socket, no port). Sinks are parquet folders with
a checkpoint location under the shared checkpoint folder, run with
``trigger(availableNow=True)`` so a job processes what is there and stops;
a restarted job resumes from its checkpoint after an executor or driver loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellscore.operators import features as feat
from wellscore.session import scratch_path
from wellscore.sources.fixtures import BANK_A_SIZES, respondent_exprs
from wellscore.spec import DEFAULT_SPEC, INDICATORS, Spec

#: Every event whose id is a multiple of this submits a whole answer sheet, the others one answer.
SHEET_EVERY = 9


def record_events(events: DataFrame) -> DataFrame:
    """Events as records to score, time as a TIMESTAMP (watermarks reject TIMESTAMP_NTZ)."""
    return events.select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))


def answer_events(events: DataFrame) -> DataFrame:
    """Events as survey answers: respondent = user, option from k in the JSON props. A sheet event
    answers every question, any other the question event_id % 20."""
    sizes = F.array(*[F.lit(BANK_A_SIZES[f]) for f, _, _ in INDICATORS])
    sheet = F.col("event_id") % SHEET_EVERY == 0
    asked = F.when(sheet, F.sequence(F.lit(0), F.lit(len(INDICATORS) - 1))).otherwise(F.array((F.col("event_id") % len(INDICATORS)).cast("int")))
    k = F.get_json_object("props", "$.k").try_cast("bigint")  # a malformed record must not fail the job
    rows = events.select("event_id", "user_id", "event_type", "ts", F.explode(asked).alias("question"), k.alias("k"), sheet.alias("sheet"))
    q = F.col("question")
    turn = F.col("k") + F.when(F.col("sheet"), q).otherwise(F.lit(0))
    return rows.select(
        "event_id",
        F.col("user_id").alias("respondent_id"),
        "question",
        (F.lit(1) + F.pmod(turn, F.element_at(sizes, q + 1).cast("bigint"))).cast("int").alias("opt_idx"),
        "event_type",
        F.col("ts").cast("timestamp").alias("ts"),
    )


def write_event_files(spark: SparkSession, rows: DataFrame, n_slices: int = 8, rows_per_file: int = 1_000_000, repeat_every: int = 0) -> tuple[str, int]:
    """Write the rows as slices of event time, one after the other, into a fresh folder; (folder, files per slice).

    Slices hold about equally many rows and are written by all executors: their number of files grows
    with the rows, and a micro-batch of that many files is one slice. ``repeat_every=k`` appends every
    k-th slice a second time right after it (repeated submissions for the dedupe stream).
    """
    path = scratch_path(spark, "stream-in")
    us = F.unix_micros("ts")
    cuts = rows.agg(F.percentile_approx(us, [i / n_slices for i in range(1, n_slices)], 10000).alias("c")).first()["c"]
    cuts = sorted(set(cuts or []))
    slice_of = sum(((us > c).cast("int") for c in cuts), F.lit(0))
    sliced = rows.withColumn("__slice", F.coalesce(slice_of, F.lit(0))).persist()
    try:
        sizes = {r[0]: r[1] for r in sliced.groupBy("__slice").count().collect()}  # one row per slice
        files = max(1, min(max(sizes.values()) // rows_per_file, min(sizes.values()) // 1000)) if sizes else 1
        for i in range(len(cuts) + 1):
            part = sliced.where(F.col("__slice") == i).drop("__slice")
            part = part.repartition(files) if files > 1 else part.coalesce(1)
            for _ in range(2 if repeat_every and i % repeat_every == 0 else 1):
                part.write.mode("append").parquet(path)
    finally:
        sliced.unpersist()
    return path, files


def read_events(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def run_to_table(spark: SparkSession, stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a streaming query to completion into a parquet sink; return the sink as a table."""
    out = scratch_path(spark, f"{name}-out")
    ckpt = scratch_path(spark, f"{name}-ckpt")
    q = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", ckpt).trigger(availableNow=True).start(out)
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def score_stream(stream: DataFrame, frozen: tuple[float, float], spec: Spec = DEFAULT_SPEC) -> DataFrame:
    """ST1: build each record's indicators, score against the frozen range, band it."""
    records = stream.selectExpr(*respondent_exprs("spark", key="event_id", cohort="event_type"), "ts")
    scored = feat.formula_score(records, spec, frozen=frozen)
    return scored.select(F.col("respondent_id").alias("event_id"), "ts", "burnout_score", "risk_level")


def assemble_answers(stream: DataFrame, bank: DataFrame, gap: str = "2 hours", delay: str = "1 hour", spec: Spec = DEFAULT_SPEC, complete: bool = True) -> DataFrame:
    """ST2: per respondent and session window, the last value per question; only complete sheets unless ``complete`` is off.

    The bank is a bounded static table (stream-static broadcast join).
    Streaming has no ``pivot``; one filtered ``max_by`` per question instead.
    """
    qidx = spark_question_map(bank.sparkSession, {f: i for i, (f, _, _) in enumerate(INDICATORS)})
    vals = stream.join(F.broadcast(qidx), "question").join(F.broadcast(bank.select("feature", "opt_idx", "value")), ["feature", "opt_idx"])
    w = vals.withWatermark("ts", delay).groupBy("respondent_id", F.session_window("ts", gap).alias("s"))
    aggs = [F.max_by(F.col("value"), F.when(F.col("feature") == f, F.col("ts"))).alias(f) for f in spec.features]
    out = w.agg(F.count(F.lit(1)).alias("n_events"), *aggs)
    answered = sum((F.col(f).isNotNull().cast("int") for f in spec.features), F.lit(0))
    if complete:
        out = out.where(answered == len(spec.features))
    return out.select(
        "respondent_id",
        F.col("s.start").alias("session_start"),
        F.col("s.end").alias("session_end"),
        "n_events",
        answered.alias("n_answered"),
        *spec.features,
    )


def spark_question_map(spark: SparkSession, pos: dict[str, int]) -> DataFrame:
    return spark.createDataFrame([(i, f) for f, i in pos.items()], "question int, feature string")


def dedupe_stream(stream: DataFrame, key: tuple[str, ...] = ("event_id", "question"), delay: str = "1 hour") -> DataFrame:
    """ST3: drop repeated submissions of the same answer within the watermark."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(key))


def band_windows(scored: DataFrame, size: str = "1 day", delay: str = "1 hour", slide: str | None = None, wall_clock_tz: str | None = None) -> DataFrame:
    """ST4: counts per (event-time window, risk band); tumbling, or sliding with ``slide``.

    Windows align to UTC epoch boundaries. For events recorded as wall-clock
    time (TIMESTAMP_NTZ cast in the session zone ``wall_clock_tz``) the event
    time is shifted to wall clock before windowing and the window bounds are
    shifted back, so a "1 day" window is a calendar day of the recorded times.
    """
    ts = F.from_utc_timestamp("ts", wall_clock_tz) if wall_clock_tz else F.col("ts")
    s = scored.withColumn("__t", ts)
    win = F.window("__t", size, slide) if slide else F.window("__t", size)
    g = s.withWatermark("__t", delay).groupBy(win.alias("w"), "risk_level").agg(F.count(F.lit(1)).alias("n"))
    start, end = F.col("w.start"), F.col("w.end")
    if wall_clock_tz:
        start, end = F.to_utc_timestamp(start, wall_clock_tz), F.to_utc_timestamp(end, wall_clock_tz)
    return g.select(start.alias("window_start"), end.alias("window_end"), "risk_level", "n")
