"""Line dedup with two Bloom filters: one of hashes seen once, one of hashes seen twice.

A line's key is the line without white space at both ends, A-Z in lower case. Keys of at least
`min_chars` code points found in at least `min_docs` documents lose all their lines but those in
the document of the largest doc_id that holds them.

* Every task puts the keys of its texts into a filter of its own, and those that it meets in a
  second text into another one. Filters are cut into segments, and a segment's filters of all tasks
  are merged one after the other: a bit is seen twice if it is in two tasks' filters of once-seen
  hashes, or in one of twice-seen ones. A key of two documents has all its bits in the merged
  filter of twice-seen hashes.
* Only keys that this filter holds are suspected. They alone are shuffled, as text, to be counted
  exactly per document and to find the largest doc_id; keys of a single document that the filter
  let through go there.
* What a document loses is sent back to it as a list of its own keys (at most its text).

The filter has about `bits_per_line` bits for every line, up to `max_bits` (32 MB): that is the bound
of what is broadcast. Beyond it the filter lets through more, at worst every line, and the exact
count sorts them out: results don't depend on its size.

Edge cases: null and empty texts are one empty line; documents are told apart by doc_id, so rows of
one id are one document, and all rows without an id are one that comes before any other; repeated
rows get equal results; lines of any length are kept whole; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellscore.llm.common import mix, powers, prefix_ids, slices, table_rows, text_bytes, written

MIN_CHARS, MIN_DOCS = 20, 3
BITS_PER_LINE, MAX_BITS, SEGMENT_BITS = 12, 1 << 28, 1 << 20
WHITE = " \t\n\x0b\x0c\r"


def pieces(b: pa.RecordBatch, column: int, limit: int = 1 << 22):
    """A batch in pieces of about limit bytes of text."""
    _, offs = text_bytes(b.column(column))
    for lo, hi in slices(offs, limit):
        yield b.slice(lo, hi - lo)


def long_keys(texts: pa.Array, min_chars: int) -> tuple[pa.Array, np.ndarray]:
    """The keys of at least min_chars code points in all lines, and the row of each."""
    parts = pc.split_pattern(texts.cast(pa.large_string()).fill_null(""), "\n")
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    keys = pc.ascii_lower(pc.ascii_trim(parts.flatten(), characters=WHITE))
    some = pc.greater_equal(pc.utf8_length(keys), min_chars)
    return keys.filter(some), row[some.to_numpy(zero_copy_only=False)]


def key_hashes(keys: pa.Array) -> np.ndarray:
    """A 64-bit hash of every key."""
    buf, offs = text_bytes(keys)
    p = prefix_ids(buf)
    _, down = powers(len(buf) + 1)
    return mix((p[offs[1:]] - p[offs[:-1]]) * down[offs[:-1]] + np.diff(offs).astype(np.uint64))


def places(h: np.ndarray, bits: int) -> np.ndarray:
    """The two bits of every hash."""
    return np.concatenate([h & np.uint64(bits - 1), mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)) & np.uint64(bits - 1)]).astype(np.int64)


def put(bitmap: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(bitmap, at >> 3, (1 << (at & 7)).astype(np.uint8))


def has(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether both bits of every hash are set; at: places of all hashes, first bits first."""
    on = (bitmap[at >> 3] >> (at & 7)) & 1 == 1
    return on[: len(on) // 2] & on[len(on) // 2 :]


def filter_bits(documents: DataFrame, bits_per_line: int, max_bits: int) -> int:
    """A power of 2, from the number of lines."""
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n")))
    n = documents.agg(F.sum(breaks + 1)).first()[0] or 0
    return min(max_bits, 1 << max(13, math.ceil(math.log2(max(1, n * bits_per_line)))))


def seen_twice(documents: DataFrame, bits: int, min_chars: int = MIN_CHARS) -> bytes:
    """The merged Bloom filter of hashes seen in two texts or more (bits / 8 bytes)."""
    step = min(bits, SEGMENT_BITS) // 8

    def collect(batches):
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for b in pieces(batch, 0):
                keys, row = long_keys(b.column(0), min_chars)
                if not len(keys):
                    continue
                h = key_hashes(keys)
                h = np.unique(np.stack([h, row.astype(np.uint64)]), axis=1)[0]  # one of each key and text
                h, n = np.unique(h, return_counts=True)
                at = places(h, bits)
                again = has(once, at) | (n > 1)
                put(twice, at[np.concatenate([again, again])])
                put(once, at)
        for s in range(0, len(once), step):
            if once[s : s + step].any():
                blobs = [pa.array([zlib.compress(x[s : s + step].tobytes(), 1)], pa.binary()) for x in (once, twice)]
                yield pa.RecordBatch.from_arrays([pa.array([s // step]), *blobs], ["segment", "once", "twice"])

    def merge(batches):
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for segment, parts in groupby(rows, key=lambda r: r[0]):
            once, twice = np.zeros(step, np.uint8), np.zeros(step, np.uint8)
            for _, o, t in parts:
                o, t = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (o, t))
                once, twice = once | o, twice | t | (once & o)
            yield pa.RecordBatch.from_arrays([pa.array([segment]), pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary())], ["segment", "twice"])

    texts = table_rows(documents, text="text").filter("text <> ''")
    parts = texts.mapInArrow(collect, "segment long, once binary, twice binary").repartition("segment").sortWithinPartitions("segment")
    out = np.zeros(bits // 8, np.uint8)
    for r in parts.mapInArrow(merge, "segment long, twice binary").collect():  # bits / 8 bytes at most
        out[r["segment"] * step :][:step] = np.frombuffer(zlib.decompress(r["twice"]), np.uint8)
    return out.tobytes()


def suspects(documents: DataFrame, twice: bytes, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, doc_id, text_hash): the keys that the filter holds, once per row of documents."""
    held = documents.sparkSession.sparkContext.broadcast(twice)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def probe(batches):
        bitmap = np.frombuffer(held.value, np.uint8)
        for batch in batches:
            for b in pieces(batch, 1):
                keys, row = long_keys(b.column(1), min_chars)
                if not len(keys):
                    continue
                hit = np.flatnonzero(has(bitmap, places(key_hashes(keys), 8 * len(bitmap))))
                t = pa.table({"row": row[hit], "key": keys.take(pa.array(hit))}).group_by(["row", "key"]).aggregate([])
                ids = b.column(0).take(t.column("row").combine_chunks())
                mine = b.column(2).take(t.column("row").combine_chunks())
                for x in pa.table([t.column("key").cast(pa.string()), ids, mine], ["key", "doc_id", "text_hash"]).to_batches():
                    yield x

    return _with_hash(documents).mapInArrow(probe, f"key string, doc_id {kind}, text_hash long")


def _with_hash(documents: DataFrame) -> DataFrame:
    return table_rows(documents, doc_id="doc_id", text="text").withColumn("text_hash", F.xxhash64("text"))


def repeated(found: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(key, n_docs, keep): the suspected keys that are in min_docs documents, and the largest doc_id of each."""
    once = found.groupBy("key", "doc_id").agg(F.lit(1).alias("one"))
    return once.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keep")).filter(F.col("n_docs") >= min_docs)


def deduplicated(documents: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, bits_per_line: int = BITS_PER_LINE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept (the remaining text) of every row of documents."""
    bits = filter_bits(documents, bits_per_line, max_bits)
    found = written(suspects(documents, seen_twice(documents, bits, min_chars), min_chars), "suspects")
    lost = found.join(written(repeated(found, min_docs), "repeated"), "key").filter("NOT doc_id <=> keep")
    # rows of one id and text share a list, so a list is no longer than a text
    lists = lost.groupBy("doc_id", "text_hash").agg(F.collect_set("key").alias("lost"))
    lists = written(lists, "lost").select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), "lost")
    kind = documents.schema["doc_id"].dataType.simpleString()

    def drop(batches):
        for batch in batches:
            for b in pieces(batch, 1):
                out = []
                for text, lost in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                    lines = (text or "").split("\n")
                    if lost:
                        lost = set(lost)
                        keys = pc.ascii_lower(pc.ascii_trim(pa.array(lines, pa.large_string()), characters=WHITE)).to_pylist()
                        kept = [x for x, k in zip(lines, keys, strict=True) if k not in lost]
                        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
                    else:
                        out.append((len(lines), 0, text or ""))
                n, d, kept = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(d), pa.array(kept, pa.string())], ["doc_id", "n_lines", "n_dropped", "kept"])

    d = _with_hash(documents)
    d = d.join(lists, d.doc_id.eqNullSafe(F.col("of_id")) & (d.text_hash == F.col("of_hash")), "left").select("doc_id", "text", "lost")
    return d.mapInArrow(drop, f"doc_id {kind}, n_lines long, n_dropped long, kept string")


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, r.key IS NOT NULL AND doc_id <> keep AS dropped FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
