"""Drivers, text columns, option banks and answer mapping (checked by brute force)."""

from pyspark.sql import functions as F

from wellscore.operators import drivers as drv
from wellscore.operators import survey as sv
from wellscore.spec import DEFAULT_SPEC, OPTION_BANKS

FEATS = DEFAULT_SPEC.features


def _brute_top(rec, n=3):
    scale, inv = DEFAULT_SPEC.scale, set(DEFAULT_SPEC.inverted)
    import numpy as np

    scored = []
    for pos, (f, v) in enumerate(rec.items()):
        lo, hi = scale.get(f, (0, 10))
        if hi == lo:
            continue
        nv = max(0.0, min(1.0, (float(v) - lo) / (hi - lo)))
        c = float(np.rint(((1.0 - nv) if f in inv else nv) * 1000.0) / 1000.0)
        scored.append((f, c, pos))
    scored.sort(key=lambda t: -t[1])  # stable: ties keep input order
    return [(f, c) for f, c, _ in scored[:n]]


def test_top_drivers_match_brute_force_with_ties(spark):
    recs = [
        dict(zip(FEATS, [21, 0, 1, 27, 5, 3, 0, 5, 5, 0, 0, 0, 0, 5, 0, 5, 0, 5, 0, 5])),  # many ties at 1.0
        dict(zip(FEATS, [10, 15, 0, 13, 2, 2, 3, 2, 2, 3, 3, 3, 3, 2, 3, 2, 2, 2, 3, 2])),
    ]
    df = spark.createDataFrame([tuple(r[f] for f in FEATS) for r in recs], ", ".join(f"{f} int" for f in FEATS))
    top = df.select(drv.top_drivers(drv.contributions(df), 3).alias("t")).collect()
    for rec, row in zip(recs, top):
        assert [(d["name"], d["stress_contribution"]) for d in row["t"]] == _brute_top(rec)


def test_unknown_feature_default_scale(spark):
    df = spark.createDataFrame([(7,)], "mental_fatigue int")
    d = df.select(F.inline(drv.contributions(df, ["mental_fatigue"]))).first()
    assert d["stress_contribution"] == 0.7 and d["label"] == "Mental Fatigue"


def test_driver_text_percent_half_even(spark):
    df = spark.createDataFrame([(0.625, "low", "Sleep Quality", 2.0)], "c double, d string, l string, v double")
    arr = F.array(F.struct(F.col("l").alias("label"), F.col("v").alias("raw_value"), F.col("c").alias("stress_contribution"), F.col("d").alias("direction")))
    txt = df.select(drv.driver_text(arr)).first()[0]
    assert txt == "  1. Sleep Quality = 2 (too low, stress contribution: " + format(0.625, ".0%") + ")"


def test_bank_structure_rules_and_span(spark):
    bank = sv.option_bank(spark)
    assert bank.count() == sum(len(v) for q in OPTION_BANKS.values() for _, _, v in q) == 475
    rules = sv.bank_rules(bank.where("bank = 'A'")).collect()
    assert len(rules) == 20 and all(r["ok"] for r in rules)
    span = sv.bank_span(bank.where("bank = 'A'")).collect()
    assert all(r["reaches_low"] and r["reaches_high"] for r in span)


def test_bank_grouping_schema_and_section_fill(spark):
    bank = sv.option_bank(spark)
    by_sec = {(r["bank"], r["section"]): r["features"] for r in sv.bank_by_section(bank.where("bank = 'A'")).collect()}
    assert by_sec[("A", "Rest")] == ["sleep_quality"]
    ordered = sv.bank_by_section_ordered(bank.where("bank = 'B'")).orderBy("section_order").collect()
    assert [r["section"] for r in ordered] == ["Mind", "Health", "Home", "School", "Friends"]
    assert [q["feature"] for q in ordered[0]["questions"]] == ["anxiety_level", "self_esteem", "mental_health_history", "depression"]
    schema = sv.bank_schema(bank.where("bank = 'A'")).where("feature = 'blood_pressure'").first()
    assert len(schema["options"]) == 3 and "value" not in schema.asDict()
    filled = {r["feature"]: r["section_filled"] for r in sv.section_fill(bank.where("bank = 'D'")).collect()}
    assert filled["depression"] == "Recent feelings" and filled["basic_needs"] == "Living space"


def test_position_profiles_in_range(spark):
    prof = sv.position_profiles(sv.option_bank(spark, "A")).collect()
    scale = DEFAULT_SPEC.scale
    assert len(prof) == 60
    for r in prof:
        lo, hi = scale[r["feature"]]
        assert lo <= r["value"] <= hi
    mids = sv.midpoints("A")
    got = {r["feature"]: r["value"] for r in prof if r["position"] == "middle"}
    assert got == mids


def test_answers_mapping_rejections_and_last_wins(spark):
    answers = spark.createDataFrame(
        [(1, "anxiety_level", "2", 0), (1, "anxiety_level", "5", 7), (1, "nope", "1", 1), (1, "safety", "9", 2), (2, "safety", "1", 0)],
        "respondent_id long, feature string, opt_idx string, answer_seq int",
    )
    bank = sv.option_bank(spark, "A")
    vals = sv.answers_to_values(answers, bank)
    assert vals.count() == 3
    rej = {(r["feature"], r["reason"]) for r in sv.rejected_answers(answers, bank).collect()}
    assert rej == {("nope", "unknown_feature"), ("safety", "invalid_option")}
    wide = {r["respondent_id"]: r for r in sv.answers_wide(vals, FEATS).collect()}
    assert wide[1]["anxiety_level"] == 21 and wide[1]["safety"] is None
    filled = {r["respondent_id"]: r for r in sv.fill_midpoint(sv.answers_wide(vals, FEATS), FEATS).collect()}
    assert filled[1]["safety"] == sv.midpoints("A")["safety"]


def test_malformed_option_is_rejected_not_fatal(spark):
    answers = spark.createDataFrame(
        [(1, "safety", "x"), (1, "safety", " 2"), (2, "safety", "3")], "respondent_id long, feature string, opt_idx string"
    ).withColumn("answer_seq", F.lit(0))
    bank = sv.option_bank(spark, "A")
    # " 2" is a digit string (whitespace trimmed, as int(" 2") does); "x" is not
    assert sorted(r["respondent_id"] for r in sv.answers_to_values(answers, bank).collect()) == [1, 2]
    rej = [(r["respondent_id"], r["reason"]) for r in sv.rejected_answers(answers, bank).collect()]
    assert (1, "invalid_option") in rej
