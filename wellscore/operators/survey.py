"""Survey answers: option banks, answer mapping, wide profiles.

The option banks are small literal tables (475 rows in all, fixed by the
spec), so every lookup against them is a broadcast hash join of a bounded
side; the answers stream past it without a shuffle. Only the long -> wide
step groups by respondent, with partial aggregation before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wellscore.operators import features as feat
from wellscore.spec import (
    BANK_B_SECTION_ORDER,
    DEFAULT_DRIVER_MAX,
    DEFAULT_DRIVER_MIN,
    DEFAULT_SECTION,
    DEFAULT_SPEC,
    OPTION_BANKS,
    Spec,
    option_label,
    question_text,
)

BANK_SCHEMA = "bank string, q_pos int, feature string, section string, question string, opt_idx int, label string, value int"


def bank_rows(spec: Spec = DEFAULT_SPEC) -> list[tuple]:
    scale = spec.scale
    rows = []
    for bank, questions in OPTION_BANKS.items():
        for q_pos, (feature, section, values) in enumerate(questions):
            lo, hi = scale.get(feature, (DEFAULT_DRIVER_MIN, DEFAULT_DRIVER_MAX))
            for i, v in enumerate(values, 1):
                rows.append((bank, q_pos, feature, section, question_text(feature), i, option_label(feature, i, v, lo, hi), v))
    return rows


def option_bank(spark: SparkSession, bank: str | None = None, spec: Spec = DEFAULT_SPEC) -> DataFrame:
    """Long option-bank table (bank, q_pos, feature, section, question, opt_idx, label, value)."""
    df = spark.createDataFrame(bank_rows(spec), BANK_SCHEMA)
    return df.where(F.col("bank") == bank) if bank else df


BANK_FILE = "bank string, questions array<struct<feature: string, section: string, question: string, options: array<struct<label: string, value: int>>>>"


def write_bank(bank: DataFrame, path: str) -> None:
    """A long option bank as one JSON list, an object per bank: its questions in order, each with its options. Banks are small."""
    options = F.transform(F.array_sort(F.collect_list(F.struct("opt_idx", "label", "value"))), lambda o: F.struct(o["label"].alias("label"), o["value"].alias("value")))
    asked = bank.groupBy("bank", "q_pos", "feature", "section", "question").agg(options.alias("options"))
    questions = F.transform(F.array_sort(F.collect_list(F.struct("q_pos", "feature", "section", "question", "options"))), lambda q: q.dropFields("q_pos"))
    banks = asked.groupBy("bank").agg(questions.alias("questions"))
    whole = banks.agg(F.to_json(F.sort_array(F.collect_list(F.struct("bank", "questions"))), {"pretty": "true"}).alias("value"))
    whole.write.mode("overwrite").text(path)


def read_bank(spark: SparkSession, path: str) -> DataFrame:
    """The long option bank from JSON files, each a bank or a list of banks over any number of lines: positions and option numbers follow the file."""
    whole = spark.read.schema(BANK_FILE).option("multiLine", True).json(path)
    asked = whole.select("bank", F.posexplode_outer("questions").alias("q_pos", "q"))
    chosen = asked.select("bank", "q_pos", "q.feature", "q.section", "q.question", F.posexplode_outer("q.options").alias("o", "option"))
    return chosen.select("bank", F.col("q_pos").cast("int"), "feature", "section", "question", (F.col("o") + 1).cast("int").alias("opt_idx"), "option.label", "option.value")


def bank_issues(bank: DataFrame, spec: Spec = DEFAULT_SPEC) -> DataFrame:
    """(bank, feature, issue) of all checks V9 to V11: missing, extra, duplicate, too_few_options, out_of_range, empty_label, not_low, not_high."""
    names = [r[0] for r in bank.select("bank").distinct().orderBy("bank").collect()]  # one row per bank
    expected = bank.sparkSession.createDataFrame([(f,) for f in spec.features], "feature string")
    rules = bank_rules(bank.where("feature IS NOT NULL"), spec)
    span = bank_span(bank, spec)
    checks = {"too_few_options": F.col("n_options") < 2, "out_of_range": F.col("n_out_of_range") > 0, "empty_label": F.col("n_empty_labels") > 0}
    listed = lambda df, of: df.select("bank", "feature", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in of.items()]))).alias("issue"))
    out = listed(rules, checks).unionByName(listed(span, {"not_low": ~F.col("reaches_low"), "not_high": ~F.col("reaches_high")}))
    return bank_coverage(bank, expected, names).unionByName(out) if names else out


def load_bank(spark: SparkSession, path: str, spec: Spec = DEFAULT_SPEC, banks: list[str] | None = None) -> DataFrame:
    """The banks of a file (those named, or all), checked before use; a bank with issues is an error that names the first of them."""
    bank = read_bank(spark, path)
    bank = bank.where(F.col("bank").isin(banks)).persist() if banks else bank.persist()
    found = bank_issues(bank, spec).orderBy("bank", "feature", "issue").limit(20).collect()
    if found or not bank.take(1):
        raise ValueError("option bank: " + ("; ".join(f"{r['bank']}/{r['feature']}: {r['issue']}" for r in found) or "no questions"))
    return bank


def option_usage(answers: DataFrame, bank: DataFrame) -> DataFrame:
    """How many answers picked each option (A1 over the data).

    ``answers`` name the bank of their sheet in ``bank``; an answer counts under that bank only.
    """
    counts = answers.withColumn("opt_idx", F.col("opt_idx").try_cast("int")).groupBy("bank", "feature", "opt_idx").agg(F.count(F.lit(1)).alias("n_answers"))
    # counts are pre-aggregated per (bank, feature, option); the bank is the preserved side
    return bank.join(counts, ["bank", "feature", "opt_idx"], "left").withColumn("n_answers", F.coalesce("n_answers", F.lit(0)).cast("bigint"))


def answers_to_values(answers: DataFrame, bank: DataFrame, keep_invalid: bool = False) -> DataFrame:
    """Map (feature, 1-based option) -> value; unknown features and options drop out.

    Digit strings are accepted as option numbers. The bank side is a bounded
    literal table: broadcast join, no shuffle of the answers. With ``keep_invalid``
    they stay with a null value, so that a respondent without a valid answer stays too.
    """
    a = answers.withColumn("opt_idx", F.col("opt_idx").try_cast("int"))
    b = bank.select("feature", "opt_idx", "value")
    return a.join(F.broadcast(b), ["feature", "opt_idx"], "left" if keep_invalid else "inner")


def rejected_answers(answers: DataFrame, bank: DataFrame) -> DataFrame:
    """Answers the mapping drops, with the reason (unknown_feature / invalid_option).

    One pass over the answers: two left lookups against bounded bank tables
    (broadcast), then the reason is a column expression.
    """
    a = answers.withColumn("opt_idx", F.col("opt_idx").try_cast("int"))
    feats = bank.select("feature").distinct().withColumn("__known", F.lit(True))
    opts = bank.select("feature", "opt_idx").distinct().withColumn("__valid", F.lit(True))
    j = a.join(F.broadcast(feats), "feature", "left").join(F.broadcast(opts), ["feature", "opt_idx"], "left")
    reason = F.when(F.col("__known").isNull(), F.lit("unknown_feature")).when(F.col("__valid").isNull(), F.lit("invalid_option"))
    return j.withColumn("reason", reason).where(F.col("reason").isNotNull()).select(*a.columns, "reason")


def answers_wide(values: DataFrame, features: list[str], id_col: str = "respondent_id", order_col: str = "answer_seq") -> DataFrame:
    """One row per respondent, one column per feature; the last answer wins.

    A pivot over the fixed feature list written as one filtered ``max_by`` per
    feature: a single shuffle (``pivot`` would plan two), and ``max_by`` is
    aggregated partially map-side, so a respondent with very many rows is
    reduced before the shuffle.
    """
    return values.groupBy(id_col).agg(
        *[F.max_by(F.col("value"), F.when((F.col("feature") == f) & F.col("value").isNotNull(), F.col(order_col))).alias(f) for f in features]
    )


def midpoints(bank: str = "A") -> dict[str, int]:
    """``values[len // 2]`` per feature of a bank."""
    return {f: vals[len(vals) // 2] for f, _, vals in OPTION_BANKS[bank]}


def fill_midpoint(wide: DataFrame, features: list[str], bank: str = "A", id_col: str = "respondent_id") -> DataFrame:
    """Fill a missing feature with its middle option; features outside the list are dropped."""
    mids = midpoints(bank)
    cols = [F.coalesce(F.col(f), F.lit(mids[f])).cast("int").alias(f) if f in wide.columns else F.lit(mids[f]).cast("int").alias(f) for f in features]
    return wide.select(F.col(id_col), *cols)


def bank_by_section(bank: DataFrame) -> DataFrame:
    """Questions grouped by section (default "General"), question order kept."""
    q = bank.select("bank", "q_pos", "feature", F.coalesce("section", F.lit(DEFAULT_SECTION)).alias("section")).distinct()
    return q.groupBy("bank", "section").agg(
        F.min("q_pos").alias("first_pos"),
        F.transform(F.array_sort(F.collect_list(F.struct("q_pos", "feature"))), lambda s: s["feature"]).alias("features"),
    )


def bank_by_section_ordered(bank: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Fixed section order with the question index; empty sections kept (empty list)."""
    order = order or BANK_B_SECTION_ORDER
    spark = bank.sparkSession
    sections = spark.createDataFrame([(i, s) for i, s in enumerate(order)], "section_order int, section string")
    q = bank.select("q_pos", "feature", "section").distinct()
    grouped = q.groupBy("section").agg(F.array_sort(F.collect_list(F.struct(F.col("q_pos").alias("index"), "feature"))).alias("questions"))
    return sections.join(grouped, "section", "left").select(
        "section_order", "section", F.coalesce("questions", F.array().cast("array<struct<index:int,feature:string>>")).alias("questions")
    )


def bank_schema(bank: DataFrame) -> DataFrame:
    """Public form schema: id, section, question and option labels only (values hidden)."""
    return bank.groupBy("bank", "q_pos", "feature", F.coalesce("section", F.lit(DEFAULT_SECTION)).alias("section"), "question").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("opt_idx", "label"))), lambda s: s["label"]).alias("options")
    )


def section_fill(bank: DataFrame) -> DataFrame:
    """Carry the last non-empty section forward in question order, per bank."""
    q = bank.select("bank", "q_pos", "feature", "section").distinct()
    w = Window.partitionBy("bank").orderBy("q_pos").rowsBetween(Window.unboundedPreceding, 0)
    return q.withColumn("section_filled", F.last("section", ignorenulls=True).over(w))


def response_review(answers: DataFrame, bank: DataFrame, q_limit=45, q_keep=45, l_limit=60, l_keep=57, missing="—") -> DataFrame:
    """Question and chosen label per answered question, shortened for display."""
    a = answers.withColumn("opt_idx", F.col("opt_idx").try_cast("int"))
    questions = bank.select("feature", "q_pos", "question").distinct()
    labels = bank.select("feature", "opt_idx", "label")
    j = a.join(F.broadcast(questions), "feature", "inner").join(F.broadcast(labels), ["feature", "opt_idx"], "left")
    q, lab = F.col("question"), F.coalesce(F.col("label"), F.lit(missing))
    return j.select(
        "respondent_id",
        "answer_seq",
        "q_pos",
        F.when(F.length(q) > q_limit, F.concat(F.substring(q, 1, q_keep), F.lit("..."))).otherwise(q).alias("question_short"),
        F.when(F.length(lab) > l_limit, F.concat(F.substring(lab, 1, l_keep), F.lit("..."))).otherwise(lab).alias("answer_label"),
    )


def position_profiles(bank: DataFrame) -> DataFrame:
    """First / middle / last option value per question, one row per (bank, position)."""
    per_q = bank.groupBy("bank", "feature").agg(F.array_sort(F.collect_list(F.struct("opt_idx", "value"))).alias("opts"))
    vals = F.transform("opts", lambda s: s["value"])
    per_q = per_q.select(
        "bank", "feature",
        F.element_at(vals, 1).alias("first"),
        F.element_at(vals, F.floor(F.size(vals) / 2).cast("int") + 1).alias("middle"),
        F.element_at(vals, -1).alias("last"),
    )
    return per_q.unpivot(["bank", "feature"], ["first", "middle", "last"], "position", "value")


# --- bank checks (V9-V11) ------------------------------------------------------------


def bank_coverage(bank: DataFrame, expected: DataFrame, banks: list[str] | None = None) -> DataFrame:
    """Per bank: expected features missing, features not expected, features listed twice.

    Expected features are paired with every bank by a generator (no join of
    two tables), then one anti join against the bank (a bounded broadcast).
    """
    banks = banks or list(OPTION_BANKS)
    per_bank = bank.select("bank", "feature", "q_pos").distinct()
    exp = expected.select("feature").distinct()
    pairs = exp.select("feature", F.explode(F.array(*[F.lit(b) for b in banks])).alias("bank"))
    miss = pairs.join(F.broadcast(per_bank.select("bank", "feature").distinct()), ["bank", "feature"], "left_anti").withColumn("issue", F.lit("missing"))
    extra = per_bank.select("bank", "feature").join(exp, "feature", "left_anti").withColumn("issue", F.lit("extra"))
    dup = per_bank.groupBy("bank", "feature").count().where(F.col("count") > 1).select("bank", "feature").withColumn("issue", F.lit("duplicate"))
    return miss.select("bank", "feature", "issue").unionByName(extra.select("bank", "feature", "issue")).unionByName(dup)


def bank_rules(bank: DataFrame, spec: Spec = DEFAULT_SPEC) -> DataFrame:
    """Per (bank, feature): option count, values outside the scale, empty labels, ok flag."""
    scale = bank.sparkSession.createDataFrame([(n, lo, hi) for n, lo, hi in spec.indicators], "feature string, lo int, hi int")
    j = bank.join(F.broadcast(scale), "feature", "left")
    out_of_range = F.when(F.col("lo").isNotNull() & ((F.col("value") < F.col("lo")) | (F.col("value") > F.col("hi"))), 1).otherwise(0)
    g = j.groupBy("bank", "feature").agg(
        F.count(F.lit(1)).alias("n_options"),
        F.sum(out_of_range).alias("n_out_of_range"),
        F.sum(F.when(F.length(F.trim(F.col("label"))) == 0, 1).otherwise(0)).alias("n_empty_labels"),
    )
    return g.withColumn("ok", (F.col("n_options") >= 2) & (F.col("n_out_of_range") == 0) & (F.col("n_empty_labels") == 0))


def bank_span(bank: DataFrame, spec: Spec = DEFAULT_SPEC, low_frac: float = 0.4, high_frac: float = 0.6) -> DataFrame:
    """Lowest option <= min + 0.4*span and highest >= min + 0.6*span, per (bank, feature)."""
    scale = bank.sparkSession.createDataFrame([(n, lo, hi) for n, lo, hi in spec.indicators], "feature string, lo int, hi int")
    g = bank.groupBy("bank", "feature").agg(F.min("value").alias("min_value"), F.max("value").alias("max_value"))
    j = g.join(F.broadcast(scale), "feature", "inner").where(F.col("hi") > F.col("lo"))
    span = (F.col("hi") - F.col("lo")).cast("double")
    return j.withColumns(
        {
            "reaches_low": F.col("min_value") <= F.col("lo") + F.lit(low_frac) * span,
            "reaches_high": F.col("max_value") >= F.col("lo") + F.lit(high_frac) * span,
        }
    )


# --- end to end ----------------------------------------------------------------------


def answers_end_to_end(answers: DataFrame, bank: DataFrame, frozen: tuple[float, float], spec: Spec = DEFAULT_SPEC, mid_bank: str = "A") -> DataFrame:
    """answers -> values -> wide -> midpoint fill -> scoring features -> score -> band."""
    values = answers_to_values(answers, bank, keep_invalid=True)
    wide = answers_wide(values, spec.features)
    filled = fill_midpoint(wide, spec.features, mid_bank)
    scored = feat.formula_score(filled, spec, frozen=frozen)
    return scored.select("respondent_id", "burnout_score", "risk_level")


# --- answered questions by section (A6, A7, A9 over the answers) ----------------------


#: Questions per long of a respondent's answered ones.
BITS = 63


def _questions(bank: DataFrame) -> list:
    """The bank's (q_pos, feature, section) in order, sections carried forward. Banks are small."""
    q = section_fill(bank).select("q_pos", "feature", F.coalesce("section_filled", F.lit(DEFAULT_SECTION)).alias("section"))
    return sorted(q.collect(), key=lambda r: (r["q_pos"] is not None, r["q_pos"], r["feature"] is not None, r["feature"]))


def _answered_questions(answers: DataFrame, questions: list) -> DataFrame:
    """Per respondent the answered questions, bit i % 63 of the long b<i // 63> being question i.

    A respondent's answers are reduced to these longs before the one shuffle, however many there are,
    and respondents whose answers match no question keep a row."""
    words = max(1, -(-len(questions) // BITS))
    masks: dict[str, list[int]] = {}
    for i, q in enumerate(questions):
        if q["feature"] is not None:
            masks.setdefault(q["feature"], [0] * words)[i // BITS] |= 1 << (i % BITS)
    names = [f"b{w}" for w in range(words)]
    of_feature = answers.sparkSession.createDataFrame([(f, *m) for f, m in masks.items()], "feature string, " + ", ".join(f"{b} bigint" for b in names))
    a = answers.select("respondent_id", "feature").join(F.broadcast(of_feature), "feature", "left")
    return a.groupBy("respondent_id").agg(*[F.coalesce(F.bit_or(b), F.lit(0).cast("bigint")).alias(b) for b in names])


def _section(section: str, questions: list) -> dict:
    """Of the section's questions in the bits: how many were answered, the first position, the features in order."""
    hits = [(q, F.col(f"b{i // BITS}").bitwiseAND(F.lit(1 << (i % BITS)).cast("bigint")) != 0) for i, q in enumerate(questions) if q["section"] == section]
    return {
        "n_answered": sum((F.when(hit, 1).otherwise(0) for _, hit in hits), F.lit(0)).cast("bigint"),
        "first_pos": F.array_min(F.array(*[F.when(hit, F.lit(q["q_pos"])).cast("int") for q, hit in hits])),
        "features": F.concat_ws(",", *[F.when(hit, F.lit(q["feature"])) for q, hit in hits]),
    }


def answered_by_section(answers: DataFrame, bank: DataFrame) -> DataFrame:
    """Per respondent and (carried-forward) section: answered questions in order."""
    questions = _questions(bank)
    slots = [F.struct(F.lit(s).alias("section"), *[c.alias(n) for n, c in _section(s, questions).items()]) for s in dict.fromkeys(q["section"] for q in questions)]
    kind = "array<struct<section:string,n_answered:bigint,first_pos:int,features:string>>"
    answered = F.filter(F.array(*slots).cast(kind), lambda s: s["n_answered"] > 0)
    return _answered_questions(answers, questions).select("respondent_id", F.inline(answered))


def answered_by_section_ordered(answers: DataFrame, bank: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Fixed section order per respondent, empty sections kept (0 answered, empty list).

    One row per section by a generator over the respondent's answered questions: no join of respondents
    with a section grid. Respondents whose answers match no question still appear.
    """
    questions = _questions(bank)
    slots = []
    for i, s in enumerate(order or BANK_B_SECTION_ORDER):
        of = _section(s, questions)
        slots.append(F.struct(F.lit(i).alias("section_order"), F.lit(s).alias("section"), of["n_answered"].alias("n_answered"), of["features"].alias("features")))
    return _answered_questions(answers, questions).select("respondent_id", F.inline(F.array(*slots)))
