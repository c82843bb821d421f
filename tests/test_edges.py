"""Edge inputs: empty tables, a hot key holding a third of the rows."""

from pyspark.sql import functions as F

from wellscore.operators import clean as cl
from wellscore.operators import drivers as drv
from wellscore.operators import features as feat
from wellscore.operators import report as rep
from wellscore.operators import survey as sv
from wellscore.operators import validate as val
from wellscore.spec import DEFAULT_SPEC

FEATS = DEFAULT_SPEC.features
SCHEMA = "respondent_id long, " + ", ".join(f"{f} int" for f in FEATS) + ", stress_level int, cohort string"


def test_empty_table_through_the_operators(spark):
    empty = spark.createDataFrame([], SCHEMA)
    e = feat.engineer(empty)
    assert e.count() == 0 and "burnout_score" in e.columns
    assert [r["n"] for r in rep.histogram(e.withColumn("burnout_score", F.lit(1.0)).limit(0)).collect()] == [0] * 30
    assert all(r["corr"] is None for r in rep.correlation_pairs(e.withColumn("burnout_score", F.lit(1.0))).collect())
    assert {r["null_count"] for r in val.null_counts(empty).collect()} == {0}
    assert cl.dedupe(cl.impute(empty)).count() == 0
    assert drv.top_drivers_long(empty).count() == 0
    assert val.duplicate_count(empty).first()["n_rows"] in (None, 0)


def test_hot_respondent_answers_wide_matches_brute_force(spark):
    # respondent 7 holds a third of all rows, answering every question many times
    rows = []
    seq = 0
    for rep_i in range(40):
        for q, f in enumerate(FEATS):
            seq += 1
            rows.append((7, f, str(1 + (rep_i + q) % 3), seq))
    for rid in range(100, 180):
        for q, f in enumerate(FEATS):
            rows.append((rid, f, str(1 + (rid + q) % 2), q))
    answers = spark.createDataFrame(rows, "respondent_id long, feature string, opt_idx string, answer_seq int")
    bank = sv.option_bank(spark, "A")
    wide = {r["respondent_id"]: r.asDict() for r in sv.answers_wide(sv.answers_to_values(answers, bank), FEATS).collect()}
    values = {(f, i + 1): v for f, _, vals in __import__("wellscore.spec", fromlist=["OPTION_BANKS"]).OPTION_BANKS["A"] for i, v in enumerate(vals)}
    expect: dict = {}
    for rid, f, opt, s in rows:
        v = values.get((f, int(opt)))
        if v is None:
            continue
        cur = expect.setdefault(rid, {})
        if f not in cur or s > cur[f][0]:
            cur[f] = (s, v)
    for rid, cols in expect.items():
        assert {f: wide[rid][f] for f in cols} == {f: v for f, (_, v) in cols.items()}
