"""op2, op3, op8, op9: against DuckDB or a brute-force version, and on edge cases."""

import math
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import EDGE, SF
from tests.oracle_compare import compare, duck
from wellscore.llm import op2_decontaminate, op3_chat, op8_quality, op9_mix
from wellscore.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    r = compare(spark, duck(SF), name, QUERIES[name], SQL[name], SF)
    assert r["status"] == "ok" and r["rows"] > 0, r


def base_rules(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(runs)
    hit = {i + k for i, r in enumerate(runs) if n[r] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_op8_base_rules_and_scores(spark, docs, edge):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in op8_quality.judged(docs, labels).collect():
        assert tuple(r[c] for c in cols) == base_rules(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.score >= op8_quality.THRESHOLD)
    rows = op8_quality.judged(edge, labels.limit(0)).collect()
    assert sorted(tuple(r[c] for c in cols) for r in rows) == sorted(base_rules(t) for _, t, *_ in EDGE)
    assert op8_quality.judged(edge.limit(0), labels).count() == 0


def test_op8_without_trusted_documents(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for none in (labels.limit(0), labels.filter("quality = 0"), labels.selectExpr("doc_id + 1000000000 AS doc_id", "quality")):
        rows = op8_quality.judged(docs, none).collect()
        assert {r.score for r in rows} == {0.0} and all(r.kept != r.base_failed for r in rows)


def brute_ratio(rows, good):
    """Mean log ratio of words and neighbouring pairs, add-one smoothed over the buckets; exact grams in place of hashes."""
    grams = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams[i] = [*w, *zip(w, w[1:])]
    raw, target = Counter(), Counter()
    for i, g in grams.items():
        raw.update(g)
        if i in good:
            target.update(g)
    b = op8_quality.BUCKETS
    nr, nt = b + raw.total(), b + target.total()
    return {i: sum(math.log((target[x] + 1) / nt * nr / (raw[x] + 1)) for x in g) / len(g) for i, g in grams.items()}


def test_op8_scores_match_brute_force(spark):
    rows = [
        (1, "the rain in the north falls on the plain and the plain is green after the rain has gone"),
        (2, "the green plain in the north is dry and no rain falls on the plain before the spring is here"),
        (3, "buy now buy now cheap cheap pills click here click here buy cheap pills now and win win win"),
        (4, "rain"),
        (5, "a text that shares nothing with any other one of them"),
    ]
    labels = spark.createDataFrame([(1, 1), (2, 1), (2, 0), (3, 0), (5, 1), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in op8_quality.judged(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect()}
    want = brute_ratio(rows, {1, 5})  # document 2 has a bad label too
    assert {i: r.score for i, r in got.items()} == pytest.approx(want, abs=1e-5)
    assert {i for i, r in got.items() if r.kept} == {i for i, s in want.items() if s >= op8_quality.THRESHOLD and i != 4}


def test_op2_finds_reparameterised_and_needs_consistent_slots(spark):
    bench = spark.createDataFrame([(1, "The farmer named Alice buys 12 apples at the market, then Alice sells 7 apples again for the same old price per kg"), (2, "short item"), (3, None), (None, "")], "item_id long, text string")
    swap = "Intro words come first here. The farmer named Robert buys 31 apples at the market, then Robert sells 9 apples again for the same old price per lb and so on"
    bad = swap.replace("then Robert", "then Walter")
    rows = [(1, swap), (2, bad), (3, "nothing to see"), (4, None), (5, "a short item here"), (None, swap), (1, swap)]
    got = op2_decontaminate.contaminated(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, k1 string"), bench).collect()
    assert sorted((r.doc_id or 0, r.contaminated, r.item_ids) for r in got) == sorted([(1, True, "1"), (1, True, "1"), (2, False, ""), (3, False, ""), (4, False, ""), (5, True, "2"), (0, True, "1")])


def test_op2_clash_in_one_alignment_leaves_the_others(spark):
    loaf = "To make the first loaf mix 3 cups of flour with 2 cups of sugar and to make the second loaf mix 5 cups of flour with 4 cups of sugar. How many cups are there?"
    shop = "The farmer named Alice buys 12 apples at the market, then Alice sells 7 apples again for the same old price per kg"
    other = "Far below: the farmer named Robert buys 12 apples at the market, then Walter sells 7 apples again for the same old price per kg"
    bench = spark.createDataFrame([(1, loaf), (2, shop), (3, shop), (3, other[11:])], "item_id long, text string")
    rows = [(1, loaf), (2, f"{shop}. {other}"), (3, other), (4, loaf.replace("3 cups", "9 cups")), (None, f"{other}. {shop}")]
    got = op2_decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert {r.doc_id or 0: r.item_ids for r in got} == {1: "1", 2: "2,3", 3: "3", 4: "1", 0: "2,3"}


def test_op2_names_at_sentence_starts_number_words_decimals_and_units(spark):
    sold = "Natalia sold 48 clips. Natalia sold 24 more. Ben sold 12 caps. How many things did Natalia and Ben sell altogether in those two weeks?"
    tank = "A tank holds 3.5 litres of water and a second tank holds 35 litres of water, so the pair of tanks holds far more water than 4kg of sand"
    bench = spark.createDataFrame([(1, sold), (2, tank)], "item_id long, text string")
    other = sold.replace("Natalia", "Robert").replace("Ben", "Olga").replace("48", "seventeen").replace("24", "5").replace("12", "1,000")
    rows = [
        (1, other),
        (2, other.replace("Robert sold 5", "Walter sold 5")),  # one name became two
        (3, other.replace("Olga", "Robert")),  # two names became one
        (4, tank.replace("3.5", "6").replace("35", "nine").replace("4kg", "2 lb")),
        (5, tank.replace("3.5", "6").replace("35", "6")),
        (6, tank.replace("3.5 litres", "35 litres")),
        (7, tank),
        (8, sold.replace("two weeks", "2 weeks")),
    ]
    got = op2_decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert {r.doc_id for r in got if r.item_ids == "1"} == {1, 8}
    assert {r.doc_id for r in got if r.item_ids == "2"} >= {4, 7}
    windows = {r.doc_id: r.most_windows for r in got}
    assert windows[5] < windows[4] and windows[6] < windows[7]
    con = duckdb.connect()
    for name, t in (("documents", rows), ("benchmark", [(1, sold), (2, tank)])):
        con.execute(f"CREATE TABLE {name} ({'doc_id' if name == 'documents' else 'item_id'} BIGINT, text VARCHAR)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", t)
    assert sorted(con.execute(op2_decontaminate.SQL).fetchall()) == sorted(tuple(r) for r in got)


def test_op9_deals_rows_of_many_parts(spark):
    t = spark.createDataFrame([(1, "a", "s0"), (2, "b", "s1"), (3, "c", "s1"), (3, "c", "s1")], "doc_id long, text string, source string")
    rows = op9_mix.replicate(t, target=80_000).select("row.doc_id", "copy", "shuffle_key")  # s0: 1,250 parts of one row
    n = {r.doc_id: (r["count"], r.distinct, r.keys) for r in rows.groupBy("doc_id").agg(F.count("*").alias("count"), F.countDistinct("copy").alias("distinct"), F.countDistinct("shuffle_key").alias("keys")).collect()}
    assert abs(n[1][0] - 40_000) < 1200 and n[1][0] == n[1][1] == n[1][2], n
    assert n[3][0] == 2 * n[3][1], n  # repeated rows draw alike


def test_op2_edges(spark, edge):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert op2_decontaminate.contaminated(edge, bench).count() == len(EDGE)
    assert op2_decontaminate.contaminated(edge, bench.limit(0)).filter("contaminated").count() == 0
    kept = op2_decontaminate.decontaminate(edge, bench)
    assert kept.columns == edge.columns and kept.count() == len(EDGE)
    assert op2_decontaminate.contaminated(edge.limit(0), bench).count() == 0


def test_op3_edges(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a"), (3, 0, "user", "a"), (3, 1, "assistant", "b"), (4, 0, "user", "ab"), (5, None, None, None), (None, 0, "user", "q"), (6, 0, "user", "a"), (6, 0, "user", "a"), (6, 1, "user", "c")]
    t = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, pos string")
    got = {r.conv_id: (r.n_turns, r.n_copies) for r in op3_chat.render(t).collect()}
    assert got == {1: (2, 2), 4: (1, 1), 5: (1, 1), 6: (2, 1)}
    assert op3_chat.render(t.limit(0)).count() == 0


def test_op9_edges_and_rates(spark, edge, docs):
    got = op9_mix.replicate(edge, target=110_00).collect()
    n = Counter(r.row.source for r in got)
    for s in ("s0", "s1", None, "s9"):
        assert abs(n[s] - 2750) < 300, n  # a quarter each; a standard deviation is about 52 for a source of one row
    assert {tuple(r.row.asDict()) for r in got} == {tuple(edge.columns)}
    assert op9_mix.replicate(edge.limit(0)).count() == 0
    only = op9_mix.replicate(docs, weights={"src0": 3.0, "src1": 1.0}).select("row.source").collect()
    assert {r.source for r in only} == {"src0", "src1"}
