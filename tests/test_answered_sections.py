"""Answered questions by section: one shuffle of one row per respondent, whatever the number of answers and questions."""

from __future__ import annotations

import pytest

from wellscore.operators import survey as sv

SECTIONS = ["Mood", "Body"]


@pytest.fixture(scope="module")
def bank(spark):
    # 130 questions: more than two longs hold; the first has no section, every later section is carried forward
    rows = [("Z", i, f"f{i:03d}", None if i == 0 else SECTIONS[i // 40 % 2] if i % 40 in (0, 1) else None, "?", o, "x", o) for i in range(130) for o in (1, 2)]
    return spark.createDataFrame(rows, sv.BANK_SCHEMA)


@pytest.fixture(scope="module")
def answers(spark):
    rows = [(r, f"f{(r * k) % 140:03d}", 1 + k % 2, k) for r in range(1, 30) for k in range(1, 40)]
    rows += [(99, "nothing", 1, 0), (98, None, 1, 0), (None, "f000", 1, 0), (None, "f129", 1, 1), (1, "f001", 2, 99)]
    return spark.createDataFrame(rows, "respondent_id bigint, feature string, opt_idx int, answer_seq int").repartition(5)


def expected(answers, bank):
    section = {r["feature"]: (r["q_pos"], r["section_filled"] or "General") for r in sv.section_fill(bank).collect()}
    held: dict = {}
    for r in answers.collect():
        of = held.setdefault(r["respondent_id"], {})
        if r["feature"] in section:
            pos, name = section[r["feature"]]
            of.setdefault(name, set()).add((pos, r["feature"]))
    return held


def test_by_section_with_many_questions(answers, bank):
    want = {(r, s, len(q), min(q)[0], ",".join(f for _, f in sorted(q))) for r, of in expected(answers, bank).items() for s, q in of.items()}
    got = sv.answered_by_section(answers, bank).select("respondent_id", "section", "n_answered", "first_pos", "features").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_ordered_keeps_every_respondent(answers, bank):
    order = ["Body", "Empty", "General", "Mood"]
    want = {(r, i, s, len(of.get(s, ())), ",".join(f for _, f in sorted(of.get(s, ())))) for r, of in expected(answers, bank).items() for i, s in enumerate(order)}
    got = sv.answered_by_section_ordered(answers, bank, order).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_no_questions(answers, bank):
    none = bank.where("bank = 'none'")
    assert sv.answered_by_section(answers, none).count() == 0
    assert {r["n_answered"] for r in sv.answered_by_section_ordered(answers, none, ["Mood"]).collect()} == {0}


@pytest.mark.parametrize("operator", [sv.answered_by_section, sv.answered_by_section_ordered])
def test_answers_are_shuffled_once_by_respondent(answers, bank, operator):
    plan = operator(answers, bank)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [respondent_id") == 1 and plan.count("Aggregate") == 1
