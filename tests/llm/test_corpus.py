"""op5 and op10 against brute force, and on edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

from tests.llm.conftest import EDGE
from wellscore.llm import op5_suffix, op10_lm


def brute_lm(rows, strength):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    toks = [[*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)), 0] for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    uni, two, ctx = Counter(), Counter(), Counter()
    for w, h in zip(toks, held, strict=True):
        if not h:
            uni.update(w)
            two.update(zip([1, *w], w))
            ctx.update([1, *w[:-1]])
    n, v = sum(uni.values()), len(uni)
    out = []
    for (i, _), w, h in zip(rows, toks, held, strict=True):
        p = [(uni[x] + 1) / (n + v + 1) for x in w]
        q = [(two[c, x] + strength * y) / (ctx[c] + strength) for c, x, y in zip([1, *w], w, p)]
        out.append((i, h, len(w), sum(uni[x] > 0 for x in w), n, round(sum(map(math.log10, p)), 6), round(sum(map(math.log10, q)), 6)))
    return sorted(out, key=str)


def test_op10_matches_brute_force(spark, docs, edge):
    for table in (docs, edge, edge.limit(0)):
        rows = [(r.doc_id, r.text) for r in table.collect()]
        got = [(*tuple(r)[:5], round(r.base_score, 6), round(r.score, 6)) for r in op10_lm.scored(table).collect()]
        assert sorted(got, key=str) == brute_lm(rows, op10_lm.STRENGTH)


def brute_removed(texts, k=200):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + k] for d in data for i in range(len(d) - k + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - k + 1):
            if seen[d[i : i + k]] > 1:
                gone[i : i + k] = b"\1" * k
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(d), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(d, gone) if not g)).hexdigest()))
    return out


def test_op5_matches_brute_force(spark, docs, edge):
    some = [r.text for r in docs.collect()]
    long = max(some, key=len)
    # passages that overlap, that end within others, that repeat with a period, at the start and the end of texts
    some += [long[100:350], "head " + long[100:300], long[120:500] + " tail", "ab" * 300, "xyab" * 200, long[:199], long[5:205], long[6:206] + "é"]
    made = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    for table in (made, edge.withColumn("text", edge.text.substr(1, 3000))):
        rows = table.collect()
        want = [(r.doc_id or -1, *x) for r, x in zip(rows, brute_removed([r.text for r in rows]), strict=True)]
        got = [(r.doc_id or -1, *tuple(r)[1:5]) for r in op5_suffix.removed(table).collect()]
        assert sorted(got) == sorted(want)
    assert op5_suffix.removed(edge).count() == len(EDGE)
    assert op5_suffix.removed(edge.limit(0)).count() == 0
