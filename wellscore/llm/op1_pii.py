"""Personal data: base patterns and a linear-chain conditional random field over word shapes.

The base patterns (base_spans) give email, ip, card and phone spans. The field labels words
that hold a digit, @ or + with one of the four kinds or none; any other word is none by
definition, so the chain falls apart into runs of such words, each decoded exactly by
Viterbi in numpy batches of equally long runs. Its features are shapes of the word and of
its neighbours, its training table is at most `max_runs` runs (`max_words` words of each) from `max_docs` documents (those
with the least hashes of doc_id) labelled by the base patterns. Words that it labels and no
base span touches become additional spans; base spans always stay.

All per-text work is linear in the text (possessive patterns, no retries). Only model weights
go to the executors; nothing is shuffled but the small training table.

Edge cases: a null text is empty; empty texts have no spans; texts of any length are read
whole; repeated rows get the same spans; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellscore.llm.common import slices, table_rows, text_bytes, word_spans

KINDS = ("email", "ip", "card", "phone")
MAX_DOCS, MAX_RUNS, MAX_WORDS = 4000, 6000, 30

_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_PLAIN = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    d = [int(c) for c in reversed(digits)]
    return (sum(d[::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind, then start."""
    out, last = [], 0
    for m in _AT.finditer(text):
        i = m.start()
        while i > last and text[i - 1] in _LOCAL:
            i -= 1
        if i < m.start():
            out.append((0, i, m.end()))
            last = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 16 <= len(d := _PLAIN.sub("", m[0])) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_PLAIN.sub("", m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


# ---- words and features --------------------------------------------------------------------

SPECIAL = np.zeros(256, bool)
SPECIAL[[43, 64, *range(48, 58)]] = True


def runs(buf: np.ndarray, offs: np.ndarray) -> list[tuple[int, list[str], list[tuple[int, int]]]]:
    """Maximal runs of neighbouring words with a digit, @ or +: row, words, (start, end) in code points of the row."""
    at = np.flatnonzero(SPECIAL[buf])
    if not len(at):
        return []
    start, end, row = word_spans(buf, offs)
    w = np.unique(np.searchsorted(start, at, "right") - 1)
    lead = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    cut = np.flatnonzero(np.concatenate([[True], (np.diff(w) != 1) | (row[w[1:]] != row[w[:-1]])]))
    out = []
    for a, b in zip(cut, [*cut[1:], len(w)], strict=True):
        k = w[a:b]
        r = int(row[k[0]])
        words = [buf[start[i] : end[i]].tobytes().decode("utf-8", "replace") for i in k]
        head = lead[offs[r]]
        out.append((r, words, [(int(lead[start[i]] - head), int(lead[end[i]] - head)) for i in k]))
    return out


def shape(word: str) -> str:
    """Digits by number up to 4 and runs of letters by class, of the whole word."""
    s = re.sub(r"[0-9]+", lambda m: "9" * min(len(m[0]), 4), word)
    s = re.sub(r"[A-Z]+", "A", s)
    return re.sub(r"[a-z]+|[^\x00-\x7f]+", "a", s)


def named(core: str) -> str:
    """A shape's name in features: itself up to 40 characters, else its hash, so that a feature's size is bounded."""
    return core if len(core) <= 40 else hashlib.md5(core.encode()).hexdigest()


def features(words: list[str]) -> list[list[str]]:
    bare = [shape(w).strip("!\"#$%&'*,./:;<=>?[]^_`{|}~") for w in words]
    core = [named(x) for x in bare]
    out = []
    for i, w in enumerate(words):
        digits = sum(map(str.isdigit, w))
        out.append([
            "bias", f"core={core[i]}", f"digits={min(digits, 20)}", f"at={'@' in w}", f"dots={min(w.count('.'), 4)}", f"head={bare[i][:1]}",
            f"before={core[i - 1] if i else ''}", f"after={core[i + 1] if i + 1 < len(words) else ''}", f"run={min(len(words), 5)}.{min(i, 4)}",
        ])
    return out


class Field:
    """Weights of the conditional random field: emissions by feature, transitions, start and end."""

    def __init__(self, labels: int):
        self.ids: dict[str, int] = {}
        self.labels = labels
        self.w = np.zeros((0, labels))
        self.move = np.zeros((labels + 1, labels + 1))  # the last row is the start, the last column the end

    def emissions(self, feats: list[list[str]]) -> np.ndarray:
        return np.array([sum((self.w[self.ids[f]] for f in x if f in self.ids), np.zeros(self.labels)) for x in feats])

    def fit(self, data: list[tuple[list[list[str]], list[int]]], epochs: int = 80, rate: float = 0.4, decay: float = 1e-4) -> Field:
        for x, _ in data:
            for f in (f for t in x for f in t):
                self.ids.setdefault(f, len(self.ids))
        n, k = len(self.ids), self.labels
        self.w = np.zeros((n, k))
        groups: dict[int, list] = {}
        for x, y in data:
            groups.setdefault(len(x), []).append(([[self.ids[f] for f in t] for t in x], y))
        batches = [(np.array([x for x, _ in g]), np.array([y for _, y in g])) for g in groups.values()]
        sw, sm = np.full_like(self.w, 1e-8), np.full_like(self.move, 1e-8)
        for _ in range(epochs):
            gw, gm = -decay * len(data) * self.w, -decay * len(data) * self.move
            for x, y in batches:
                e = self.w[x].sum(2)
                b, t, _ = e.shape
                inner = self.move[:k, :k]
                a = np.empty((b, t, k))
                z = np.empty((b, t, k))
                a[:, 0] = e[:, 0] + self.move[k, :k]
                for i in range(1, t):
                    a[:, i] = e[:, i] + _lse(a[:, i - 1][:, :, None] + inner, 1)
                z[:, -1] = self.move[:k, k]
                for i in range(t - 2, -1, -1):
                    z[:, i] = _lse(inner[None] + (e[:, i + 1] + z[:, i + 1])[:, None, :], 2)
                total = _lse(a[:, -1] + z[:, -1], 1)
                p = np.exp(a + z - total[:, None, None])
                d = np.eye(k)[y] - p
                np.add.at(gw, x.ravel(), np.repeat(d.reshape(-1, k), x.shape[2], 0))
                gm[k, :k] += d[:, 0].sum(0)
                gm[:k, k] += d[:, -1].sum(0)
                for i in range(1, t):
                    pair = np.exp(a[:, i - 1][:, :, None] + inner + (e[:, i] + z[:, i])[:, None, :] - total[:, None, None])
                    gm[:k, :k] += np.einsum("bi,bj->ij", np.eye(k)[y[:, i - 1]], np.eye(k)[y[:, i]]) - pair.sum(0)
            sw += gw**2
            sm += gm**2
            self.w += rate * gw / np.sqrt(sw)
            self.move += rate * gm / np.sqrt(sm)
        return self

    def decode(self, items: list[list[list[str]]]) -> list[np.ndarray]:
        """The best label sequence of each item, in batches of equal length."""
        out: list = [None] * len(items)
        groups: dict[int, list[int]] = {}
        for i, x in enumerate(items):
            groups.setdefault(len(x), []).append(i)
        k = self.labels
        for t, own in groups.items():
            e = np.array([self.emissions(items[i]) for i in own])
            best, back = e[:, 0] + self.move[k, :k], np.zeros((len(own), t, k), np.int64)
            for i in range(1, t):
                step = best[:, :, None] + self.move[:k, :k]
                back[:, i] = step.argmax(1)
                best = step.max(1) + e[:, i]
            y = np.zeros((len(own), t), np.int64)
            y[:, -1] = (best + self.move[:k, k]).argmax(1)
            for i in range(t - 1, 0, -1):
                y[:, i - 1] = back[np.arange(len(own)), i, y[:, i]]
            for j, i in enumerate(own):
                out[i] = y[j]
        return out


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


def labelled_runs(documents: DataFrame, max_docs: int = MAX_DOCS, max_runs: int = MAX_RUNS, max_words: int = MAX_WORDS) -> DataFrame:
    """The training table: words and labels (0: none, else 1 + kind) of at most max_runs runs, max_words of each."""
    d = table_rows(documents, doc_id="doc_id", text="text").filter("text IS NOT NULL")
    ids = d.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs).select(F.col("doc_id").alias("k")).distinct()
    d = d.join(F.broadcast(ids), F.col("doc_id").eqNullSafe(F.col("k"))).select("text")

    def label(batches):
        for b in batches:
            buf, offs = text_bytes(b.column(0))
            found, said = [], []
            for lo, hi in slices(offs):
                part = buf[offs[lo] : offs[hi]]
                own = offs[lo : hi + 1] - offs[lo]
                spans: dict[int, list] = {}
                for r, words, at in runs(part, own):
                    if r not in spans:
                        spans[r] = base_spans(part[own[r] : own[r + 1]].tobytes().decode())
                    found.append(words[:max_words])
                    said.append([next((1 + k for k, s, e in spans[r] if s < q and p < e), 0) for p, q in at[:max_words]])
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())), pa.array(said, pa.list_(pa.int32()))], ["words", "labels"])

    t = d.mapInArrow(label, "words array<string>, labels array<int>")
    return t.orderBy(F.xxhash64("words"), "words", "labels").limit(max_runs)


def fit(documents: DataFrame, **how) -> Field:
    def name(batches):
        for b in batches:
            x = pa.array([features(w) for w in b.column(0).to_pylist()], pa.list_(pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays([x, b.column(1)], ["features", "labels"])

    # at most max_runs rows of max_words words, whose features are short however long the words are
    rows = labelled_runs(documents, **how).mapInArrow(name, "features array<array<string>>, labels array<int>").collect()
    return Field(1 + len(KINDS)).fit([(r["features"], r["labels"]) for r in rows])


def find(documents: DataFrame, field: Field) -> DataFrame:
    """One row per document: doc_id, base and all (arrays of kind, start, end)."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def spans(batches):
        for b in batches:
            buf, offs = text_bytes(b.column(1))
            n = len(offs) - 1
            base: list[list] = [[] for _ in range(n)]
            more: list[list] = [[] for _ in range(n)]
            for lo, hi in slices(offs):
                part, own = buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
                found = runs(part, own)
                for r in {r for r, _, _ in found}:
                    base[lo + r] = base_spans(part[own[r] : own[r + 1]].tobytes().decode())
                for (r, words, at), y in zip(found, field.decode([features(w) for _, w, _ in found]), strict=True):
                    i = 0
                    while i < len(y):
                        j = i + 1
                        while j < len(y) and y[j] == y[i]:
                            j += 1
                        if y[i]:
                            head = len(words[i]) - len(words[i].lstrip("\"'<([{,;:#*$%&|"))
                            tail = len(words[j - 1]) - len(words[j - 1].rstrip("\"'>)]},;:.!?#*$%&|"))
                            p, q = at[i][0] + head, at[j - 1][1] - tail
                            if p < q and not any(s < q and p < e for _, s, e in base[lo + r]):
                                more[lo + r].append((int(y[i]) - 1, p, q))
                        i = j
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([[{"kind": KINDS[k], "start": s, "end": e} for k, s, e in x] for x in side], list_) for side in (base, [sorted(x + y) for x, y in zip(base, more, strict=True)]))], ["doc_id", "base", "spans"])

    list_ = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    span = "array<struct<kind:string,start:bigint,end:bigint>>"
    return table_rows(documents, doc_id="doc_id", text="text").mapInArrow(spans, f"doc_id {kind}, base {span}, spans {span}")


def digest(found: DataFrame) -> DataFrame:
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    count = [of(k) for k in KINDS]
    return found.select("doc_id", *count, F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))
