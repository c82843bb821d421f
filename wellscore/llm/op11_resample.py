"""Target-distribution importance resampling with line segments counted once.

A feature is a run of 1 to 3 neighbouring words; its bucket is the crc32 of its bytes modulo
`buckets`. Newlines separate words, so a text is a sequence of lines and every feature lies either
within one line or across line ends. Corpus counts follow that split: the distinct lines are
grouped with their occurrences (partial sums on the map side, so a line that is everywhere is one
row per task), the features of a distinct line are counted once and multiplied by its
occurrences, and the features across line ends are counted apart, text by text. Only `buckets`
numbers reach the driver.

A document's weight is the sum of its features' gains: again the gains within a distinct line of a
batch are summed once and added for each of its occurrences, then those across line ends. Gumbel
noise hashed from the document makes the draw of the highest scores a sample without replacement;
ranks come from ranges of the score (no task sees all rows).

Bucket hashes are computed in numpy: the crc32 of every word byte by byte over all words at once,
that of a run from those of its words, since crc32 is linear.

Edge cases: a null or empty text has no features and weight 0; a null doc_id is hashed as an empty
id and comes last among equal scores; repeated rows are drawn on their own; texts of any length
are read whole; without benchmark texts every target count is 0; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellscore.llm.common import slices, table_rows, text_bytes, word_spans, written
from wellscore.operators.ranges import numbered

BUCKETS, PERCENT, MIN_WORDS, SEED = 10_000, 5, 20, 42

#: Bytes of words as they are, A-Z in lower case; every other byte is a space.
LETTER = np.full(256, 32, np.uint8)
for _lo, _hi in ((48, 58), (97, 123), (128, 256)):
    LETTER[_lo:_hi] = np.arange(_lo, _hi)
LETTER[65:91] = np.arange(97, 123)


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


STEP = _byte_table()


def _apply(op: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by its values on each byte [..., 4, 256], at every x."""
    return op[..., 0, :][x & 255] ^ op[..., 1, :][(x >> 8) & 255] ^ op[..., 2, :][(x >> 16) & 255] ^ op[..., 3, :][x >> 24]


def _zeros() -> tuple[np.ndarray, np.ndarray]:
    """The maps that append n zero bytes for n < 256, and 2**k zero bytes for k from 8 to 31."""
    few = np.empty((256, 4, 256), np.uint32)
    few[0] = [np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)]
    for n in range(1, 256):
        few[n] = STEP[few[n - 1] & 255] ^ (few[n - 1] >> 8)
    many = [_apply(few[128], few[128])]
    for _ in range(9, 32):
        many.append(_apply(many[-1], many[-1]))
    return few, np.array(many)


FEW, MANY = _zeros()
CRC_SPACE = np.uint32(zlib.crc32(b" "))


def shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What the crc32 of a string adds to that of the string and n more bytes."""
    low = n & 255
    out = FEW[low, 0, crc & 255] ^ FEW[low, 1, (crc >> 8) & 255] ^ FEW[low, 2, (crc >> 16) & 255] ^ FEW[low, 3, crc >> 24]
    long = np.flatnonzero(n > 255)
    for k in range(8, int(n.max()).bit_length() if len(long) else 8):
        at = long[(n[long] >> k) & 1 == 1]
        out[at] = _apply(MANY[k - 8], out[at])
    return out


def word_crcs(buf: np.ndarray, start: np.ndarray, end: np.ndarray, most: int = 48) -> np.ndarray:
    """crc32 of every word; the few longer than `most` bytes go through zlib."""
    n = end - start
    crc = np.full(len(start), 0xFFFFFFFF, np.uint32)
    live = np.flatnonzero(n <= most)
    for i in range(most):
        live = live[n[live] > i]
        if not len(live):
            break
        crc[live] = STEP[(crc[live] ^ buf[start[live] + i]) & 255] ^ (crc[live] >> 8)
    crc = ~crc
    for w in np.flatnonzero(n > most):
        crc[w] = zlib.crc32(buf[start[w] : end[w]])
    return crc


def runs(crc: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """crc32 of the runs of 2 and 3 words that start at every word, joined by one space."""
    spaced = shifted(np.full(len(crc), CRC_SPACE, np.uint32), size) ^ crc
    two = shifted(crc[:-1], size[1:] + 1) ^ spaced[1:]
    return two, shifted(two[:-1], size[2:] + 1) ^ spaced[2:]


def line_features(lines: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and line of every feature within lines, and the number of words of every line."""
    buf, offs = text_bytes(lines)
    buf = LETTER[buf]
    start, end, row = word_spans(buf, offs)
    words = np.bincount(row, minlength=len(lines))
    if not len(start):
        return np.zeros(0, np.int64), row, words
    crc, size = word_crcs(buf, start, end), end - start
    two, three = runs(crc, size)
    in2, in3 = np.flatnonzero(row[:-1] == row[1:]), np.flatnonzero(row[:-2] == row[2:])
    hashes = np.concatenate([crc, two[in2], three[in3]]).astype(np.int64)
    return hashes % buckets, np.concatenate([row, row[in2], row[in3]]), words


def cross_features(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every feature across line ends."""
    buf, offs = text_bytes(texts)
    ends = np.flatnonzero(buf == 10)
    buf = LETTER[buf]
    start, end, row = word_spans(buf, offs)
    line = np.searchsorted(ends, start)
    two = np.flatnonzero((row[:-1] == row[1:]) & (line[:-1] != line[1:]))
    three = np.flatnonzero((row[:-2] == row[2:]) & (line[:-2] != line[2:]))
    if not len(two):
        return np.zeros(0, np.int64), two
    near = np.zeros(len(start), bool)
    for at, k in ((two, 2), (three, 3)):
        for j in range(k):
            near[at + j] = True
    kept = np.flatnonzero(near)
    crc, size = word_crcs(buf, start[kept], end[kept]), (end - start)[kept]
    # neighbours of a run across a line end are all kept, so they are neighbours here too
    h2, h3 = runs(crc, size)
    place = np.cumsum(near) - 1
    return np.concatenate([h2[place[two]], h3[place[three]]]).astype(np.int64) % buckets, np.concatenate([row[two], row[three]])


def split_lines(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All lines of all texts, and the text of each."""
    parts = pc.split_pattern(texts.cast(pa.large_string()).fill_null(""), "\n")
    return parts.flatten(), np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))


def pieces(col: pa.Array, limit: int = 1 << 22):
    """A text column in pieces of about limit bytes."""
    _, offs = text_bytes(col)
    for lo, hi in slices(offs, limit):
        yield lo, col.slice(lo, hi - lo)


def distinct_lines(documents: DataFrame) -> DataFrame:
    """(line, n): every distinct line of all texts and its occurrences; lines without a word are left out."""

    def cut(batches):
        for b in batches:
            for _, texts in pieces(b.column(0)):
                lines, _ = split_lines(texts)
                n = lines.value_counts()
                line = n.field("values").cast(pa.string())
                some = pc.match_substring_regex(line, r"[0-9A-Za-z]|[^\x00-\x7F]")
                yield pa.RecordBatch.from_arrays([line, n.field("counts")], ["line", "n"]).filter(some)

    texts = table_rows(documents, text="text").filter("text <> ''")
    return texts.mapInArrow(cut, "line string, n long").groupBy("line").agg(F.sum("n").alias("n"))


def bucket_counts(documents: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all documents in every bucket: those of distinct lines times their occurrences, and those across."""

    def out(total):
        at = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    def within(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            n = b.column(1).to_numpy()
            for lo, lines in pieces(b.column(0)):
                bucket, row, _ = line_features(lines, buckets)
                np.add.at(total, bucket, n[lo + row])
        yield out(total)

    def across(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, texts in pieces(b.column(0)):
                total += np.bincount(cross_features(texts, buckets)[0], minlength=buckets)
        yield out(total)

    fields = "bucket long, n long"
    texts = table_rows(documents, text="text").filter("text IS NOT NULL")
    both = distinct_lines(documents).mapInArrow(within, fields).unionByName(texts.mapInArrow(across, fields))
    total = np.zeros(buckets, np.int64)
    for r in both.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most `buckets` rows
        total[r["bucket"]] = r["n"]
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed ratio target / source) of every bucket."""
    k = len(source)
    s, t = float(source.sum() + k), float(target.sum() + k)
    return np.array([math.floor(1000 * math.log(((b + 1) * s) / ((a + 1) * t))) for a, b in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weighted(documents: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document."""
    buckets = len(gain)

    def weigh(batches):
        for b in batches:
            for lo, texts in pieces(b.column(1)):
                lines, text = split_lines(texts)
                coded = lines.dictionary_encode()
                once, each = coded.dictionary, coded.indices.to_numpy()
                bucket, row, words = line_features(once, buckets)
                total = np.zeros((3, len(texts)), np.int64)
                per_line = [words, np.bincount(row, minlength=len(once)), np.bincount(row, weights=gain[bucket], minlength=len(once))]
                for i, x in enumerate(per_line):
                    total[i] = np.bincount(text, weights=x[each], minlength=len(texts))
                bucket, row = cross_features(texts, buckets)
                total[1] += np.bincount(row, minlength=len(texts))
                total[2] += np.bincount(row, weights=gain[bucket], minlength=len(texts)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, len(texts)), *map(pa.array, total)], ["doc_id", "n_words", "n_features", "weight"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return table_rows(documents, doc_id="doc_id", text="text").mapInArrow(weigh, f"doc_id {kind}, n_words long, n_features long, weight long")


def resampled(documents: DataFrame, target: DataFrame, buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank is null where it wasn't drawn.

    floor(percent * N / 100) of the N documents of at least min_words words are drawn, the highest
    scores first, equal ones by doc_id. target: texts of the wanted distribution."""
    gain = gains(bucket_counts(documents, buckets), bucket_counts(target, buckets))
    u = (F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    score = F.col("weight") + F.floor(-1000 * F.ln(-F.ln(u))).cast("long")
    all_ = written(weighted(documents, gain).withColumn("score", score), "weights")
    fit = F.col("n_words") >= min_words
    drawn = all_.filter(fit).count() * percent // 100
    ranked = numbered(all_.filter(fit), [F.desc("score"), F.asc_nulls_last("doc_id")], "rank").withColumn("rank", F.when(F.col("rank") < drawn, F.col("rank") + 1))
    rest = all_.filter(~fit).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank", "n_words")
