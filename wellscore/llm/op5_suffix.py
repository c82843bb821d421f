"""Repeated passages by bucket-pointer refinement.

Every byte offset has the identifier of its initial bucket, the 64 bytes that start there; the
bucket of a longer string follows from the bucket identifiers at later offsets, so the
identifier of a 200-byte string refines those at 0, 64, 128 and 136. Identifiers are 64-bit
hashes, which are the same in every task, where a suffix array on one machine has ranks.

Refining all offsets would move every byte of the corpus. It is enough to sort sampled
offsets: of every 200-byte string, the offset of its least bucket identifier. Equal strings
have that offset at the same place, so they meet in its bucket. The strings with one sampled
offset are a zone; buckets are refined in steps, each reusing what the last one found:
  1. bucket of the sampled offset, and refined bucket of its whole zone. A zone that occurs
     twice repeats as a whole. A zone alone in its bucket has no repeated string.
  2. In buckets that split (zones that agree in part: the edges of repeated passages), the
     strings of each refined bucket, once per bucket, are sorted by their own identifier.
  3. Strings that occur twice cover the bytes that are removed.
Each step asks once per block and key (blocks.py): keys spread evenly, a passage that a third
of all texts share is one request per block in step 1, and step 2 grows with the edges of
passages, not with pairs of them.

Edge cases: a null text is empty; texts under 200 bytes keep all bytes; repeated rows are
removed wholly if they have 200 bytes; texts are read whole, by windows of bounded size; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wellscore.llm.blocks import answers, ask, by_block, text_size, write_blocks
from wellscore.llm.common import BASE, mix, powers, prefix_ids, slices, text_bytes

LENGTH, GRAM = 200, 64
SEGMENT = 1 << 20


def buckets(buf: np.ndarray) -> np.ndarray:
    """Identifier of the GRAM bytes at each offset."""
    if len(buf) < GRAM:
        return np.zeros(0, np.uint64)
    p = prefix_ids(buf)
    _, down = powers(len(buf))
    return mix((p[GRAM:] - p[:-GRAM]) * down[: len(buf) - GRAM + 1])


def refined(h: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Identifier of the strings at some offsets, from the bucket identifiers at later offsets."""
    out = h[at]
    for k in [*range(GRAM, length - GRAM, GRAM), length - GRAM]:
        out = mix(out * np.uint64(BASE) + h[at + k])
    return out


def zones(buf: np.ndarray, offs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket identifiers; first and last start of the strings of every zone, bucket of the zone's sampled offset, refined bucket."""
    h = buckets(buf)
    none = np.zeros(0, np.int64)
    if len(buf) < length:
        return h, none, none, none.astype(np.uint64), none.astype(np.uint64)
    w = length - GRAM + 1
    total = len(buf) - length + 1
    edge = np.zeros(len(buf) + 1, np.int32)
    big = np.flatnonzero(np.diff(offs) >= length)
    np.add.at(edge, offs[big], 1)
    np.add.at(edge, offs[big + 1] - length + 1, -1)
    valid = np.cumsum(edge)[:total] > 0
    first, last, anchor = [], [], []
    low = np.uint64(0xFFFFFF)
    for base in range(0, total, SEGMENT):
        n = min(SEGMENT, total - base)
        key = (h[base : base + n + w - 1] & ~low) | np.arange(n + w - 1, dtype=np.uint64)
        pad = np.full(-len(key) % w, ~np.uint64(0), np.uint64)
        key = np.concatenate([key, pad]).reshape(-1, w)
        up = np.minimum.accumulate(key, 1).ravel()
        down = np.minimum.accumulate(key[:, ::-1], 1)[:, ::-1].ravel()
        a = (np.minimum(down[:n], up[w - 1 : w - 1 + n]) & low).astype(np.int64) + base
        ok = valid[base : base + n]
        new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (ok[1:] != ok[:-1])]))
        end = np.concatenate([new[1:], [n]]) - 1
        keep = ok[new]
        first.append(new[keep] + base)
        last.append(end[keep] + base)
        anchor.append(a[new[keep]])
    lo, hi, p = (np.concatenate(x) for x in (first, last, anchor))
    shape = (hi - lo).astype(np.uint64) * np.uint64(1 << 20) + (p - lo).astype(np.uint64)
    z = mix(mix(refined(h, lo, length) * np.uint64(BASE) + refined(h, hi, length)) + shape)
    return h, lo, hi, h[p], z


def pieces(t: pa.Table, length: int):
    """(first row, bytes, offsets, zones) of the slices of a block."""
    buf, offs = text_bytes(t.column(1))
    for lo, hi in slices(offs):
        part, own = buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        yield lo, part, own, zones(part, own, length)


ONE = np.uint64(1)


def _keys(q: np.ndarray, z: np.ndarray):
    """Sorted distinct keys: buckets (even) and refined buckets (odd), with their place for every zone and their content."""
    zk = mix(q * np.uint64(BASE) + z) | ONE
    qk = q & ~ONE
    uz, first, inv_z, n = np.unique(zk, return_index=True, return_inverse=True, return_counts=True)
    uq, inv_q = np.unique(qk, return_inverse=True)
    lo, hi = np.full(len(uq), ~np.uint64(0), np.uint64), np.zeros(len(uq), np.uint64)
    np.minimum.at(lo, inv_q, zk)
    np.maximum.at(hi, inv_q, zk)
    keys = np.concatenate([uq, uz])
    value = np.concatenate([np.where(lo == hi, lo, np.uint64(0)), n.astype(np.uint64)])
    order = np.argsort(keys)
    place = np.empty(len(keys), np.int64)
    place[order] = np.arange(len(keys))
    return keys[order], value[order], place[inv_q], place[len(uq) + inv_z], first


def all_zones(t: pa.Table, length: int):
    parts = [z[3:] for *_, z in pieces(t, length)]
    return np.concatenate([q for q, _ in parts]), np.concatenate([z for _, z in parts])


def refine(keys: np.ndarray, cols: list[np.ndarray]) -> tuple[np.ndarray, list[int]]:
    """Buckets: 1 if they split. Refined buckets: 0 if they occur once, else 1, and 2 for the one block that shows them in step 2."""
    order = np.argsort(keys, kind="stable")
    k, v = keys[order], cols[0][order]
    at = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    size = np.diff(np.concatenate([at, [len(k)]]))
    split = (np.minimum.reduceat(v, at) != np.maximum.reduceat(v, at)) | (np.minimum.reduceat(v, at) == 0)
    often = np.add.reduceat(v, at) > 1
    odd = (k[at] & ONE) == 1
    code = np.where(odd, often, split).astype(np.int64)
    out = np.repeat(code, size)
    out[at] += (odd & often).astype(np.int64)
    back = np.empty(len(out), np.int64)
    back[order] = out
    return back, []


def twice(keys: np.ndarray, cols: list[np.ndarray]) -> tuple[np.ndarray, list[int]]:
    u, inv = np.unique(keys, return_inverse=True)
    return (np.bincount(inv, cols[0], len(u)) > 1)[inv].astype(np.int64), []


def _starts(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    n = hi - lo + 1
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _shown(t: pa.Table, length: int, code: np.ndarray):
    """Per zone of a block: whether it repeats, whether its strings are sorted in step 2."""
    q, z = all_zones(t, length)
    _, _, iq, iz, first = _keys(q, z)
    often, split = code[iz], code[iq] == 1
    once = np.zeros(len(q), bool)
    once[first] = True
    return often > 0, split & once & (often != 1)


def _strings(t: pa.Table, length: int, show: np.ndarray):
    """Identifiers of the strings of the shown zones, in order."""
    out, k = [np.zeros(0, np.uint64)], 0
    for _, _, _, (h, lo, hi, _, _) in pieces(t, length):
        own = show[k : k + len(lo)]
        k += len(lo)
        out.append(refined(h, _starts(lo[own], hi[own]), length))
    return np.concatenate(out)


def removed(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, end in bytes)."""
    texts = write_blocks(documents, 1 << 23)
    size = text_size(texts)

    def step1(_, t):
        keys, value, *_ = _keys(*all_zones(t, length))
        return keys, [value]

    one, _ = ask(texts, step1, refine, ["u8"], size // 30, "zones")

    def step2(block, t):
        u, n = np.unique(_strings(t, length, _shown(t, length, answers(one, block))[1]), return_counts=True)
        return u, [n.astype(np.uint32)]

    two, _ = ask(texts, step2, twice, ["u4"], size // 20, "strings")
    kind = documents.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for block, t in by_block(batches):
            whole, show = _shown(t, length, answers(one, block))
            ids = _strings(t, length, show)
            u, inv = np.unique(ids, return_inverse=True)
            hit = answers(two, block)[inv] > 0 if len(u) else np.zeros(0, bool)
            k = s = 0
            rows = []
            for _, part, own, (_, lo, hi, _, _) in pieces(t, length):
                w, v = whole[k : k + len(lo)], show[k : k + len(lo)]
                k += len(lo)
                at = _starts(lo[v], hi[v])
                edge = np.zeros(len(part) + 1, np.int64)
                np.add.at(edge, lo[w], 1)
                np.add.at(edge, hi[w] + length, -1)
                some = at[hit[s : s + len(at)]]
                s += len(at)
                np.add.at(edge, some, 1)
                np.add.at(edge, some + length, -1)
                gone = np.cumsum(edge)[:-1] > 0
                for a, b in zip(own[:-1], own[1:], strict=True):
                    g = gone[a:b]
                    turn = np.flatnonzero(np.diff(np.concatenate([[False], g, [False]])))
                    rows.append((b - a, int(g.sum()), len(turn) // 2, hashlib.sha256(part[a:b][~g].tobytes()).hexdigest(), [{"start": int(x), "end": int(y)} for x, y in zip(turn[::2], turn[1::2], strict=True)]))
            n_bytes, gone_, spans, sha, where = (list(x) for x in zip(*rows, strict=True))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([t.column(0).combine_chunks(), pa.array(n_bytes, pa.int64()), pa.array(gone_, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha), pa.array(where, span)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return texts.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>")
