"""op11, op12, op13: against brute-force versions (op12 and op13 also against DuckDB, in test_native) and on edge cases."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import EDGE, SF
from wellscore.llm import op11_resample, op12_lines, op13_repair

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# ---- op11 ----------------------------------------------------------------------------------


def features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def resampled(docs, target):
    read = [(i, *features(t)) for i, t in docs]
    wanted = Counter(b for t in target for b in features(t)[1])
    have = Counter(b for *_, f in read for b in f)
    s, t = sum(have.values()) + 10000, sum(wanted.values()) + 10000
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * s / ((have[b] + 1) * t))) for b in range(10000)]
    out = []
    for i, n_words, f in read:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words])
    fit = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    for n, r in enumerate(fit[: len(fit) * 5 // 100]):
        r[4] = n + 1
    return sorted((tuple(r) for r in out), key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_op11_all_documents(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = rows(op11_resample.resampled(docs, bench))
    assert got == resampled([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in bench.collect()])
    assert sum(r[4] is not None for r in got) == sum(r[5] >= 20 for r in got) * 5 // 100 > 0


def test_op11_edges(spark, edge):
    target = spark.createDataFrame([("Alpha beta\nGAMMA delta\n\nepsilon zeta", 1), (None, 2), ("", 3)], "text string, doc_id long")
    more = [(100 + i, "wörd Été\n" * 5 + "x" * 300 + f"\n{'y' * 70000} one-two\x00three {i}\n" * 4 + "z\ny\nx\n" * 3, "en", "s", i, "z", 1) for i in range(40)]
    both = edge.unionByName(spark.createDataFrame(more, edge.schema))
    assert rows(op11_resample.resampled(both, target)) == resampled([(r.doc_id, r.text) for r in both.collect()], [r.text for r in target.collect()])
    assert rows(op11_resample.resampled(edge, target.limit(0))) == resampled([(i, t) for i, t, *_ in EDGE], [])
    assert op11_resample.resampled(edge.limit(0), target).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("abC \n\n.é\U0001f600", max_size=60), max_size=6))
def test_op11_features_within_and_across_lines(texts):
    lines, text = op11_resample.split_lines(pa.array(texts, pa.large_string()))
    within, line, words = op11_resample.line_features(lines, 10000)
    across, row = op11_resample.cross_features(pa.array(texts, pa.large_string()), 10000)
    for i, t in enumerate(texts):
        n, want = features(t)
        assert Counter(want) == Counter(within[text[line] == i].tolist()) + Counter(across[row == i].tolist()) and n == words[text == i].sum()


def test_op11_crc_of_long_strings():
    a, b = np.random.default_rng(1).integers(0, 256, 9, dtype=np.uint8), np.random.default_rng(2).integers(0, 256, 70001, dtype=np.uint8)
    for n in (0, 1, 255, 256, 257, 70001):
        whole = zlib.crc32(a.tobytes() + b[:n].tobytes())
        got = op11_resample.shifted(np.array([zlib.crc32(a.tobytes())], np.uint32), np.array([n]))[0] ^ np.uint32(zlib.crc32(b[:n].tobytes()))
        assert int(got) == whole


# ---- op12 ----------------------------------------------------------------------------------


def key_of(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def line_dedup(docs):
    held = defaultdict(set)
    for i, t in docs:
        for x in (t or "").split("\n"):
            held[key_of(x)].add(-1 if i is None else i)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key_of(x)) < 20 or len(held[key_of(x)]) < 3 or max(held[key_of(x)]) == (-1 if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


LINES = ["A common line of more than twenty letters", "  a COMMON line of more than twenty letters\t\r", "short line", "été été été été été é", "été été été été été ét", "", "only here and nowhere else at all"]


@pytest.fixture(scope="module")
def lined(spark):
    texts = ["\n".join(p) for p in itertools.permutations(LINES, 2)] + ["\n".join([LINES[0]] * 50), "y" * 90000 + "\n" + LINES[1], None, "", "\n\n"]
    data = [(i % 30 if i % 7 else None, t, "z", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(data + data[:5], "doc_id long, text string, lost string, keep long").repartition(5)


@pytest.mark.parametrize("max_bits", [1 << 28, 1 << 13, 64])
def test_op12_any_filter_size(spark, lined, max_bits):
    got = rows(op12_lines.digest(op12_lines.deduplicated(lined, max_bits=max_bits)))
    assert got == line_dedup([(r.doc_id, r.text) for r in lined.collect()])
    assert any(r[2] for r in got)


def test_op12_edges(spark, edge):
    assert rows(op12_lines.digest(op12_lines.deduplicated(edge))) == line_dedup([(i, t) for i, t, *_ in EDGE])
    assert op12_lines.deduplicated(edge.limit(0)).count() == 0
    nulls = edge.selectExpr("CAST(NULL AS long) AS doc_id", "CAST(NULL AS string) AS text")
    assert {tuple(r) for r in op12_lines.deduplicated(nulls).collect()} == {(None, 1, 0, "")}


def test_op12_suspects_are_few_and_hold_all_repeats(spark, docs):
    bits = op12_lines.filter_bits(docs, 12, 1 << 28)
    found = op12_lines.suspects(docs, op12_lines.seen_twice(docs, bits))
    held = defaultdict(set)
    for r in docs.collect():
        for x in (r.text or "").split("\n"):
            held[key_of(x)].add(r.doc_id)
    keys = {r.key for r in found.select("key").distinct().collect()}
    twice = {k for k, d in held.items() if len(d) > 1 and len(k) >= 20}
    once = {k for k, d in held.items() if len(d) == 1 and len(k) >= 20}
    assert twice <= keys and len(keys & once) < 0.1 * len(once)


# ---- op13 ----------------------------------------------------------------------------------


def all_edits(turns, most):
    """Every sequence of edits that makes the turns sound, by trying all."""
    good = []

    def go(i, roles, cost, edits, added):
        if cost > most:
            return
        if i == len(turns) and re.fullmatch("(s?(ua)+)?", roles):
            good.append((cost, edits))
        if added < 3:
            for x in "ua":
                go(i, roles + x, cost + 5, edits + "I", added + 1)
        if i < len(turns):
            initial, fault = turns[i]
            go(i + 1, roles, cost + 2, edits + "D", 0)
            if fault < 2:
                go(i + 1, roles + (initial or "?"), cost + 5 * fault, edits + "K", 0)
                for x in "ua":
                    go(i + 1, roles + x, cost + 5 * fault + 1, edits + "R", 0)

    go(0, "", 0, "", 0)
    return min(good)


TURN = st.tuples(st.sampled_from(["s", "u", "a", "u", "a", "t", ""]), st.sampled_from([0, 0, 0, 1, 2]))


@settings(max_examples=60, deadline=None)
@given(st.lists(TURN, max_size=5))
def test_op13_search_finds_the_least_of_all_edits(turns):
    got = op13_repair.repair(turns)
    assert got == all_edits(turns, got[0])


@settings(max_examples=60, deadline=None)
@given(st.lists(TURN, max_size=24), st.integers(1, 7))
def test_op13_chunks_give_the_same_edits(turns, size):
    parts = [turns[i : i + size] for i in range(0, len(turns), size)] or [[]]
    costs, ranks, edits = zip(*map(op13_repair.all_repairs, parts), strict=True)
    cost, way = op13_repair.choose(costs, ranks)
    audit = "".join(e[4 * q + r] for e, (q, r) in zip(edits, way, strict=True)) + op13_repair.CLOSING[way[-1][1]]
    assert (cost, audit) == op13_repair.repair(turns)


def conversations_audited(table):
    """The contract in plain Python, over op13's search (which the tests above cover)."""
    held, ids = defaultdict(list), set()
    for conv, turn, role, text in table:
        ids.add(conv)
        name = [" " if x is None else x for x in (conv, turn, role, text)]
        h = zlib.crc32(f"{name[0]}:{name[1]}".encode()) % 20
        if h:
            text = "" if h == 1 else re.sub("[.!?]", "", name[3]) if h == 2 else name[3]
            held[conv] += [(turn, "user" if h == 4 else name[2], text)] * (2 if h == 3 else 1)
    out = []
    for conv in ids:
        chat = sorted(held[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, faults = set(), []
        for _, role, text in chat:
            solid = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        known, initials = [r[0] for r in chat if r[0] is not None], [r[1][:1] for r in chat]
        cost, audit = op13_repair.repair([(s, {"": 0, "truncated": 1}.get(f, 2)) for s, f in zip(initials, faults, strict=True)])
        whole = "\n".join(op13_repair.applied([(r[1], r[2]) for r in chat], audit))
        n = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        out.append((conv, max(known) - min(known) + 1 - len(set(known)) if known else 0, *n, illegal, cost, audit, hashlib.sha256(whole.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def chats(spark):
    roles = ["user", "assistant", "system", "tool", None, ""]
    long = [(1, i, roles[i % 2] if i % 11 else roles[i % 6], f"turn {i % 37}{'.' if i % 5 else ''} \n") for i in range(300)]
    ties = [(2, i // 6, roles[i % 3], f"t{i % 4}!") for i in range(40)] + [(3, 5, "user", "same.")] * 60
    odd = [(None, i if i % 3 else None, roles[i % 6], "x." if i % 2 else None) for i in range(12)] + [(4, None, None, None), (5, -3, "assistant", "y" * 100_000 + "?"), (5, 9, "user", " \t")]
    whole = [(c, t, roles[t % 2], f"{c}.{t}!") for c in range(10, 60) for t in range(c % 4)]
    return spark.createDataFrame([(*r, "x", 1) for r in long + ties + odd + whole], "conv_id long, turn long, role string, text string, part string, seq int").repartition(7)


@pytest.mark.parametrize("chunk", [64, 5, 1])
def test_op13_all_columns(spark, chats, chunk):
    want = conversations_audited([tuple(r)[:4] for r in chats.collect()])
    assert rows(op13_repair.audited(chats, chunk).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) == want


def test_op13_edges(spark, chats):
    assert op13_repair.audited(chats.limit(0)).count() == 0
    lost = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    gone = spark.createDataFrame([(7, lost, "user", "a.")], "conv_id long, turn long, role string, text string")
    assert rows(op13_repair.audited(gone)) == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
