"""Near duplicates by ProbMinHash.

A text is the multiset of its runs of five words (fewer words: the whole text is one run),
each run weighted by 1 + log(count). Every run is a Poisson process whose arrivals come at
its weight's rate and pick a register at random; a register keeps the run that arrived first.
Two texts agree in a register with the probability of their probability Jaccard similarity.
Arrivals are drawn only up to a bound by which all registers of the text are very likely
taken; where one is not, the bound doubles and the draw goes on, so the sketch is the exact
ProbMinHash sketch and long texts cost about as many draws as short ones.

Registers are banded; documents of one bucket are candidates, verified by the exact Jaccard
similarity of their sets of runs. As that counts each run once, a text is also banded with equal
weights, where registers agree with the probability of the set Jaccard similarity; the two
sketches are the same where no run repeats, so only texts with repeated runs have both:
  1. copies collapse to one node (digest of the text, map-side grouping);
  2. in rounds, each bucket's nodes are compared with one node of it, drawn by hash, that is in
     another class: a bucket of any size costs a pair per node. Verified pairs join classes;
     a group of copies shares many buckets, so it has many such centres even in one round;
  3. when a round finds few links, or few pairs are left, the nodes of buckets that still hold
     several classes are joined by prefix filtering, which gives every pair of different
     classes that can be similar enough. So no link of the candidates is lost, while
     pairs within a class, which cannot change it, are never made.
Links stay in tables; nothing of document size reaches the driver.

Edge cases: null texts are empty; a text without a word is a class of its own row's node
(all empty texts are copies of each other); repeated rows are copies; ties go to the least
doc_id (null ids last); an empty table gives no rows; extra columns are ignored (classes) or
passed through (deduplicated).
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellscore.llm.common import binary, components, mix, slices, table_rows, text_bytes, window_hashes, word_hashes, word_spans, written

WORDS, BANDS, ROWS, SIMILARITY = 5, 20, 5, 0.8


def shingles(buf: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of k words; a text of 1 to k - 1 words is one run."""
    start, end, row = word_spans(buf, offs)
    h = word_hashes(buf, start, end)
    w, at = window_hashes(h, row, k)
    n = np.bincount(row, minlength=len(offs) - 1)
    first = np.concatenate([[0], np.cumsum(n)])
    short = np.flatnonzero((n > 0) & (n < k))
    rest = np.zeros(len(short), np.uint64)
    for j in range(k - 1):
        here = n[short] > j
        rest[here] = mix(rest[here] * np.uint64(0x9E3779B97F4A7C15) + h[first[short[here]] + j])
    r = np.concatenate([row[at], short])
    order = np.argsort(r, kind="stable")
    return np.concatenate([w, rest])[order], r[order]


def distinct(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, hash) in order, with counts."""
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])]) if len(h) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return h[at], row[at], np.diff(np.concatenate([at, [len(h)]]))


def _unit(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def prob_minhash(h: np.ndarray, row: np.ndarray, weight: np.ndarray, rows: int, m: int) -> np.ndarray:
    """Registers [rows, m]: the element of least arrival time in each (0 where the row has no element)."""
    best, who = np.full(rows * m, np.inf), np.zeros(rows * m, np.uint64)
    total = np.bincount(row, weight, rows)
    bound = np.where(total > 0, m / np.maximum(total, 1e-300) * (math.log(m) + 3.0), 0.0)
    todo = total > 0
    while todo.any():
        at = np.flatnonzero(todo[row])
        key, r, w = h[at], row[at], weight[at]
        limit, t = bound[r], np.zeros(len(at))
        step = 0
        while len(key):
            x = mix(key + np.uint64((0x9E3779B97F4A7C15 * (2 * step + 1)) % (1 << 64)))
            t = t - np.log(_unit(x)) / w
            live = t <= limit  # early termination: later arrivals of this element come later still
            key, r, w, limit, t, x = key[live], r[live], w[live], limit[live], t[live], x[live]
            slot = r * m + (mix(x ^ np.uint64(0xD1B54A32D192ED03)) % np.uint64(m)).astype(np.int64)
            order = np.lexsort((key, t, slot))
            s = slot[order]
            lead = order[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else order
            s, tt, kk = slot[lead], t[lead], key[lead]
            win = (tt < best[s]) | ((tt == best[s]) & (kk < who[s]))
            best[s[win]], who[s[win]] = tt[win], kk[win]
            step += 1
        full = np.isfinite(best).reshape(rows, m).all(1)
        todo &= ~full
        bound[todo] *= 2
    return who.reshape(rows, m)


def band_keys(registers: np.ndarray, bands: int, size: int) -> np.ndarray:
    out = np.zeros((len(registers), bands), np.uint64)
    for b in range(bands):
        x = np.full(len(registers), b + 1, np.uint64)
        for j in range(size):
            x = mix(x * np.uint64(0x9E3779B97F4A7C15) + registers[:, b * size + j])
        out[:, b] = x
    return out


def sketches(documents: DataFrame, words: int = WORDS, bands: int = BANDS, size: int = ROWS) -> DataFrame:
    """(doc_id, node, n, keys): digest of the text, number of distinct runs, distinct band keys of equal and of probability weights (none without a run)."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def sketch(batches):
        for b in batches:
            buf, offs = text_bytes(b.column(1))
            node, count, used, keys = [], [], [], []
            for lo, hi in slices(offs):
                part, own = buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
                node += [hashlib.md5(part[own[i] : own[i + 1]].tobytes()).hexdigest() for i in range(hi - lo)]
                h, row, n = distinct(*shingles(part, own, words))
                count.append(np.bincount(row, minlength=hi - lo))
                equal = band_keys(prob_minhash(h, row, np.ones(len(h)), hi - lo, bands * size), bands, size)
                again = np.bincount(row, n > 1, hi - lo) > 0
                at, which = again[row], np.cumsum(again) - 1
                weighted = equal.copy()
                weighted[again] = band_keys(prob_minhash(h[at], which[row[at]], 1.0 + np.log(n[at]), int(again.sum()), bands * size), bands, size)
                both = np.concatenate([equal, weighted], 1)
                use = np.concatenate([np.ones(equal.shape, bool), weighted != equal], 1) & (count[-1] > 0)[:, None]
                used.append(use.sum(1))
                keys.append(both[use])
            n = np.concatenate(count) if count else np.zeros(0, np.int64)
            k = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            ends = np.concatenate([[0], *used]).cumsum().astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(k.view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(node, pa.string()), pa.array(n, pa.int64()), lists], ["doc_id", "node", "n", "keys"])

    return table_rows(documents, doc_id="doc_id", text="text").mapInArrow(sketch, f"doc_id {kind}, node string, n long, keys array<long>")


def run_sets(want: DataFrame, nodes: DataFrame, documents: DataFrame, words: int) -> DataFrame:
    """(node, runs): the sorted distinct runs of the wanted nodes, as little-endian numbers."""
    need = want.distinct().join(nodes.select("node", "doc_id"), "node").withColumnsRenamed({"node": "want", "doc_id": "id"})
    text = table_rows(documents, doc_id="doc_id", text="text").withColumn("text", F.coalesce("text", F.lit("")))
    # one row of each node: other copies have other ids and don't meet here
    text = text.join(need, F.col("doc_id").eqNullSafe(F.col("id")) & (F.md5("text") == F.col("want"))).select(F.col("want").alias("node"), "text")

    def sets(batches):
        for b in batches:
            buf, offs = text_bytes(b.column(1))
            out = []
            for lo, hi in slices(offs):
                h, row, _ = distinct(*shingles(buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], words))
                cut = np.searchsorted(row, np.arange(hi - lo + 1))
                out += [h[cut[i] : cut[i + 1]].tobytes() for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays([b.column(0), binary(out)], ["node", "runs"])

    return written(text.mapInArrow(sets, "node string, runs binary").dropDuplicates(["node"]), "runs", small=True)


def verified(pairs: DataFrame, runs: DataFrame, similarity: float) -> DataFrame:
    """Those pairs (a, b) of nodes whose sets of runs have the Jaccard similarity or more."""

    def compare(batches):
        for b in batches:
            ra, rb = b.column(2), b.column(3)
            ok = []
            for i in range(b.num_rows):
                x, y = np.frombuffer(ra[i].as_buffer(), np.uint64), np.frombuffer(rb[i].as_buffer(), np.uint64)
                if min(len(x), len(y)) < similarity * max(len(x), len(y)):
                    ok.append(False)
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(both >= similarity * (len(x) + len(y) - both) and both > 0)
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["a", "b"])

    joined = pairs.join(runs.select(F.col("node").alias("b"), F.col("runs").alias("rb")), "b").join(runs.select(F.col("node").alias("a"), F.col("runs").alias("ra")), "a")
    return written(joined.select("a", "b", "ra", "rb").mapInArrow(compare, "a string, b string"), "links", small=True)


def ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))


def prefix_pairs(runs: DataFrame, own: DataFrame, similarity: float, counters: int = 1 << 20) -> DataFrame:
    """All pairs (a, b) of nodes of different classes that can have the similarity, by prefix filtering.

    In one order of all runs, two sets that similar share a run among the first
    n - ceil(similarity * n) + 1 of each, whatever the order. Rare runs come first (frequencies in
    a table of fixed size, counted by hash), and a shared run must come early enough in both, so
    nodes of a large group meet only where they share nearly all that others don't."""

    def count(batches):
        total = np.zeros(counters, np.int64)
        for b in batches:
            for x in b.column(1):
                np.add.at(total, (np.frombuffer(x.as_buffer(), np.uint64) % np.uint64(counters)).astype(np.int64), 1)
        at = np.flatnonzero(total)
        for lo in range(0, len(at), 1 << 16):
            part = at[lo : lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(total[part], pa.int64())], ["k", "n"])

    def pack(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([binary([np.asarray(c).astype(np.uint32).tobytes()]) for c in b.columns], ["k", "n"])

    seen = runs.mapInArrow(count, "k long, n long").groupBy("k").agg(F.least(F.sum("n"), F.lit(2**32 - 1)).alias("n")).filter("n > 1")
    often = np.ones(counters, np.uint32)
    for r in seen.mapInArrow(pack, "k binary, n binary").toLocalIterator():  # 8 bytes for each of at most `counters` rows
        often[np.frombuffer(r["k"], np.uint32)] = np.frombuffer(r["n"], np.uint32)

    def first(batches):
        for b in batches:
            run, node, size, place = [], [], [], []
            for name, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                n = len(x) - math.ceil(similarity * len(x) - 1e-9) + 1 if len(x) else 0
                run.append(x[np.lexsort((x, often[x % np.uint64(counters)]))[:n]].view(np.int64))
                node += [name] * n
                size += [len(x)] * n
                place.append(np.arange(n))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(run) if run else [], pa.int64()), pa.array(node, pa.string()), pa.array(size, pa.int64()), pa.array(np.concatenate(place) if place else [], pa.int64())], ["run", "node", "n", "i"])

    t = written(runs.mapInArrow(first, "run long, node string, n long, i long").join(own, "node"), "prefixes", small=True)
    some = t.groupBy("run").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select("run")
    t = t.join(some, "run")
    x = t.toDF("run", *(f"x{c}" for c in t.columns[1:]))
    y = t.toDF("yrun", *(f"y{c}" for c in t.columns[1:]))
    # after the first shared run, no more can be shared than what follows it in either set
    rest = F.least(F.col("xn") - F.col("xi"), F.col("yn") - F.col("yi")) >= F.lit(similarity / (1 + similarity)) * (F.col("xn") + F.col("yn")) - 1e-6
    fits = rest & (F.col("xnode") < F.col("ynode")) & (F.col("xc") != F.col("yc")) & (F.least("xn", "yn") >= similarity * F.greatest("xn", "yn"))
    return x.join(y, (F.col("run") == F.col("yrun")) & fits).select(F.col("xnode").alias("a"), F.col("ynode").alias("b")).distinct()


def merged(own: DataFrame, links: DataFrame) -> DataFrame:
    """Classes (node, c) after the links (a, b) between nodes of different classes."""
    a, b = own.toDF("a", "ca"), own.toDF("b", "cb")
    between = links.join(a, "a").join(b, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    to = components(between).toDF("c", "new")
    return written(own.join(to, "c", "left").select("node", F.coalesce("new", "c").alias("c")), "classes")


def classes(documents: DataFrame, words: int = WORDS, bands: int = BANDS, size: int = ROWS, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document row: doc_id, node, class_id (least doc_id of its near duplicates), n_copies of its exact text."""
    sketch = written(sketches(documents, words, bands, size), "sketches", small=True)
    nodes = written(sketch.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies"), F.max("n").alias("n"), F.max("keys").alias("keys")), "nodes")
    member = nodes.select("node", "n", F.explode("keys").alias("bucket"))
    shared = member.groupBy("bucket").count().filter("count > 1").select("bucket")
    member = written(member.join(shared, "bucket"), "buckets")
    own = member.select("node", F.col("node").alias("c")).distinct()
    alike = lambda x, y: F.least(x, y) >= similarity * F.greatest(x, y)
    step, before, left = 0, float("inf"), member.withColumn("c", F.col("node"))
    while True:
        lead = left.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("node", "bucket", F.lit(step)).alias("h"), "node", "n", "c")).alias("lead"))
        pairs = left.join(lead, "bucket").filter((F.col("c") != F.col("lead.c")) & alike(F.col("n"), F.col("lead.n")))
        pairs = written(pairs.select(F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b")).distinct(), "pairs")
        links = verified(pairs, run_sets(ends(pairs), nodes, documents, words), similarity)
        own = merged(own, links)
        left = member.join(own, "node")
        size = left.groupBy("bucket", "c").count().groupBy("bucket").agg(F.sum("count").alias("all"), F.sum(F.col("count") * F.col("count")).alias("same"))
        left = written(left.join(size.filter("all * all > same"), "bucket").select("bucket", "node", "n", "c", "all", "same"), "mixed")
        todo = left.agg(F.sum((F.col("all") - F.col("same") / F.col("all")) / 2).alias("pairs"), F.count("*").alias("rows")).first()
        now = todo["pairs"] or 0.0
        if not links.take(1) or now <= 2 * todo["rows"] or now > 0.7 * before:
            break
        step, before = step + 1, now
    runs = run_sets(left.select("node"), nodes, documents, words)
    more = written(prefix_pairs(runs, own, similarity), "pairs")
    comp = written(merged(own, verified(more, runs, similarity)).withColumnsRenamed({"node": "cn"}), "classes")
    labelled = nodes.join(comp, F.col("node") == F.col("cn"), "left").select("node", "doc_id", "n_copies", F.coalesce("c", "node").alias("c"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "node")).alias("first")
    least = labelled.groupBy("c").agg(first).select("c", F.col("first.doc_id").alias("class_id"), F.col("first.node").alias("kept_node"))
    labelled = written(labelled.join(least, "c").select("node", "class_id", "kept_node", "n_copies"), "labelled")
    return sketch.select("doc_id", "node").join(labelled, "node").select("doc_id", "node", "class_id", "kept_node", "n_copies")


def deduplicated(documents: DataFrame, **how) -> DataFrame:
    """One document of each class, all columns: the one with class_id (of repeated rows with that id and text, one)."""
    kept = classes(documents, **how).filter("node = kept_node").groupBy(F.col("node").alias("want")).agg(F.min("class_id").alias("class_id"), F.min("n_copies").alias("copies"))
    kept = written(kept, "kept")
    d = documents.select(F.struct("*").alias("row"), F.md5(F.coalesce("text", F.lit(""))).alias("h"))
    d = d.join(kept, F.col("row.doc_id").eqNullSafe(F.col("class_id")) & (F.col("h") == F.col("want")))
    # only texts with copies can have repeated rows
    once = d.filter("copies = 1").select("row.*")
    return once.unionByName(d.filter("copies > 1").dropDuplicates(["h"]).select("row.*"))
