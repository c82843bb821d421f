"""Language-model scoring by a weighted backoff automaton.

Model: n-grams up to `order`, counted in the training documents, Dirichlet-smoothed:
    p(w | c) = (count(c w) + strength * p(w | shorter c)) / (count(c) + strength),
ending in the add-one unigram. An automaton of this model has a state for every context seen in
training, an arc for every n-gram seen, and from every state a failure arc to the shorter
context that costs log(strength / (count + strength)). That automaton isn't built here: the
sums that its traversal would give are computed elementwise from looked-up counts, on numpy
arrays over all texts of a block at once (README names this as a departure from the method).

Counting and lookup follow blocks.py: a block asks once for each of its distinct n-grams, with
its own training counts; ranges of keys sum the counts over blocks and answer those that
occur in training. Everything gathered grows with the corpus and is dealt by key; one task
holds one block or one range of keys.

Edge cases: null and empty texts are just the end token; a null doc_id counts as the text
'' for the split; repeated rows are counted and scored each; without training documents all
counts are 0 and N = V = 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellscore.llm.blocks import answers, ask, by_block, text_size, write_blocks
from wellscore.llm.common import BASE, BYTE_ID_LOWER, mix, slices, text_bytes, word_hashes, word_spans

ORDER, STRENGTH = 2, 4.0
END, START = np.uint64(0x1B873593CC9E2D51), np.uint64(0x85EBCA6B27D4EB4F)


def held_out(ids: list) -> np.ndarray:
    return np.array([zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i in ids], bool)


def tokens(col) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (words lower-cased in ASCII, then the end of each text), and the number of each text's tokens."""
    buf, offs = text_bytes(col)
    out, count = [], []
    for lo, hi in slices(offs):
        part, own = buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        start, end, row = word_spans(part, own)
        n = np.bincount(row, minlength=hi - lo)
        out.append(np.insert(word_hashes(part, start, end, BYTE_ID_LOWER), np.cumsum(n), END))
        count.append(n + 1)
    return (np.concatenate(out), np.concatenate(count)) if out else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def contexts(tok: np.ndarray, n: np.ndarray, order: int) -> list[np.ndarray]:
    """Keys of the n-grams that end at each token, for n from 1 to order; before a text stand start marks."""
    place = np.arange(len(tok)) - np.repeat(np.cumsum(n) - n, n)
    out = [mix(tok + np.uint64(BASE))]
    back = tok
    for k in range(2, order + 1):
        back = np.concatenate([[START], back[:-1]]) if len(back) else back
        back = np.where(place >= k - 1, back, START)
        out.append(mix(out[-1] * np.uint64(BASE) + back + np.uint64(k)))
    return out


def asked(table: pa.Table, order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct n-gram keys of a block; the counts in its training texts and whether it is one token."""
    tok, n = tokens(table.column(1))
    train = ~held_out(table.column(0).to_pylist())
    keep = np.repeat(train, n)
    keys, counts, single = [], [], []
    for k, g in enumerate(contexts(tok, n, order)):
        u, inv = np.unique(g, return_inverse=True)
        keys.append(u)
        counts.append(np.bincount(inv, keep, len(u)).astype(np.uint32))
        single.append(np.full(len(u), k == 0, np.uint8))
    keys = np.concatenate(keys)
    by = np.argsort(keys)
    return keys[by], [np.concatenate(counts)[by], np.concatenate(single)[by]]


def total_counts(keys: np.ndarray, cols: list[np.ndarray]) -> tuple[np.ndarray, list[int]]:
    """Training count of every key over all blocks; sums: training tokens and distinct ones."""
    u, inv = np.unique(keys, return_inverse=True)
    total = np.bincount(inv, cols[0], len(u)).astype(np.int64)
    single = np.zeros(len(u), bool)
    single[inv[cols[1] > 0]] = True
    return total[inv], [int(total[single].sum()), int((single & (total > 0)).sum())]


class Automaton:
    """Training counts of the n-grams of one block, and the scores they give; no states or arcs are built."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, total: int, types: int, texts: int, strength: float):
        self.keys, self.counts = keys, counts
        self.total, self.types, self.texts, self.strength = total, types, texts, strength

    def count(self, keys: np.ndarray) -> np.ndarray:
        """Of keys that are all in the block."""
        u, inv = np.unique(keys, return_inverse=True)
        return self.counts[np.searchsorted(self.keys, u)][inv].astype(np.int64)

    def walk(self, tok: np.ndarray, n: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log10 probability by the model and by the unigrams, and training count, of every token."""
        grams = contexts(tok, n, order)
        seen = [self.count(g) for g in grams]
        base = (seen[0] + 1.0) / (self.total + self.types + 1.0)
        p = base
        first = np.zeros(len(tok), bool)
        if len(n):
            first[np.cumsum(n) - n] = True
        for k in range(1, order):
            # times the context was seen in training: the k-gram that ends one token earlier
            state = np.concatenate([[0], seen[k - 1][:-1]]) if len(tok) else seen[k - 1]
            state = np.where(first, self.texts, state)
            p = (seen[k] + self.strength * p) / (state + self.strength)
        return np.log10(p), np.log10(base), seen[0]


def scored(documents: DataFrame, order: int = ORDER, strength: float = STRENGTH) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    texts = write_blocks(documents)
    folder, sums = ask(texts, lambda _, t: asked(t, order), total_counts, ["u4", "u1"], order * text_size(texts) // 7, "ngrams")
    total, types = sums or (0, 0)
    id_ = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    n_texts = texts.filter(F.crc32(id_.cast("binary")) % 7 != 2).count()
    kind = documents.schema["doc_id"].dataType.simpleString()

    def score(batches):
        for block, t in by_block(batches):
            auto = Automaton(asked(t, order)[0], answers(folder, block), total, types, n_texts, strength)
            tok, n = tokens(t.column(1))
            lm, base, c = auto.walk(tok, n, order)
            row = np.repeat(np.arange(len(n)), n)
            sums = [np.bincount(row, x, len(n)) for x in (base, lm)]
            known = np.bincount(row, c > 0, len(n)).astype(np.int64)
            ids = t.column(0).combine_chunks()
            cols = [ids, pa.array(held_out(ids.to_pylist())), pa.array(n), pa.array(known), pa.array(np.full(len(n), total)), pa.array(sums[0]), pa.array(sums[1])]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return texts.mapInArrow(score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
