"""Quality rules: hashed n-gram log-likelihood ratio (DataFrame operations only).

Words and pairs of neighbouring words are hashed to `buckets`. Two multinomials, add-one
smoothed, are counted: the raw corpus (all documents) and the trusted target (documents
labelled good). A document's score is the mean of log(target / raw) over its n-grams; it is
kept at `threshold` or more, and if the base rules pass. Every document gets a verdict.

The trusted target comes from at most `max_trusted` labelled documents (those with the least
hashes of doc_id); the raw counts cover all texts. Only bucket counts (2 x buckets numbers)
and the trusted ids reach the driver.

Base rules: see base_columns. All of it is computed within each row: no shuffle but that of
the bucket counts, so hot sources and groups of copies cost nothing extra.

Edge cases: null and empty texts have no words, score 0 and fail the base rules; a null
doc_id is never labelled; of several labels for one id all must be good; repeated rows get
the same verdict; without a trusted n-gram all scores are 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellscore.llm.common import SPACE, table_rows

BUCKETS, MAX_TRUSTED, THRESHOLD = 1 << 16, 20_000, -0.2
RUN = 5


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def grams(wh: Column) -> Column:
    """Bucket-ready hashes of words and of neighbouring pairs, from the words' hashes."""
    return F.concat(wh, F.zip_with(F.slice(wh, 1, F.greatest(F.size(wh) - 1, F.lit(0))), F.slice(wh, 2, F.greatest(F.size(wh) - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b)))


def _hashed(documents: DataFrame) -> DataFrame:
    d = table_rows(documents, doc_id="doc_id", text="text").withColumn("text", F.coalesce("text", F.lit("")))
    d = d.withColumn("w", words(F.col("text")))
    return d.withColumn("wh", F.transform("w", lambda x: F.xxhash64(x)))


def base_columns(hashed: DataFrame) -> DataFrame:
    """doc_id, wh and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    lines = F.filter(F.split(F.col("text"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = hashed.select(
        "doc_id",
        "wh",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
    )
    at = lambda i, k: F.get(F.col("wh"), i + k)
    d = d.withColumn("win", F.transform(F.slice("wh", 1, F.greatest(F.size("wh") - (RUN - 1), F.lit(0))), lambda h, i: F.xxhash64(h, *[at(i, k) for k in range(1, RUN)])))
    # only texts with a repeated window are sorted
    again = F.size(F.array_distinct("win")) < F.size("win")
    d = d.withColumn("s", F.when(again, F.array_sort(F.transform("win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twin = lambda x, i, k: F.get(F.col("s"), i + k)["h"].eqNullSafe(x["h"])
    d = d.withColumn("p", F.array_sort(F.filter(F.transform("s", lambda x, i: F.when(twin(x, i, -1) | twin(x, i, 1), x["i"])), lambda i: i.isNotNull())))
    step = F.zip_with("p", F.slice("p", 2, F.greatest(F.size("p"), F.lit(1))), lambda a, b: F.coalesce(F.least(b - a, F.lit(RUN)), F.lit(RUN)))
    n = F.coalesce(F.aggregate(step, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")
    return d.select("doc_id", "wh", "n_words", "word_chars", "n_symbols", "n_dup_lines", n.alias("n_repeat_words"))


def trusted(labels: DataFrame, at_most: int) -> DataFrame:
    good = table_rows(labels, doc_id="doc_id", quality="quality").filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.coalesce("quality", F.lit(0))).alias("q")).filter("q = 1")
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(at_most).select(F.col("doc_id").alias("good_id"))


def weights(documents: DataFrame, labels: DataFrame, buckets: int, max_trusted: int) -> list[float]:
    """log(target / raw) of every bucket, rounded to 6 places; 0 if no trusted n-gram was counted."""
    h = _hashed(documents).select("doc_id", grams(F.col("wh")).alias("g"))
    h = h.join(F.broadcast(trusted(labels, max_trusted)), F.col("doc_id") == F.col("good_id"), "left")
    n = h.select(F.col("good_id").isNotNull().alias("good"), F.explode_outer("g").alias("g")).filter("g IS NOT NULL").groupBy(F.pmod("g", F.lit(buckets)).alias("b"), "good").count()
    raw, target = [1] * buckets, [1] * buckets
    for r in n.collect():  # at most 2 x buckets rows
        raw[r["b"]] += r["count"]
        if r["good"]:
            target[r["b"]] += r["count"]
    if sum(target) == buckets:
        return [0.0] * buckets
    nr, nt = math.log(sum(raw)), math.log(sum(target))
    return [round(math.log(t) - nt - math.log(r) + nr, 6) for t, r in zip(target, raw, strict=True)]


def judged(documents: DataFrame, labels: DataFrame, buckets: int = BUCKETS, max_trusted: int = MAX_TRUSTED, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, the base columns, base_failed, kept, score."""
    w = weights(documents, labels, buckets, max_trusted)
    model = F.split(F.lit(",".join(map(str, w))), ",").cast("array<double>")  # folded to a literal of fixed size
    d = base_columns(_hashed(documents)).withColumn("g", grams(F.col("wh")))
    total = F.aggregate("g", F.lit(0.0), lambda a, h: a + F.get(model, F.pmod(h, F.lit(buckets)).cast("int")))
    d = d.withColumn("score", F.when(F.size("g") > 0, total / F.size("g")).otherwise(F.lit(0.0)))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return d.select(*cols, failed.alias("base_failed"), (~failed & (F.col("score") >= threshold)).alias("kept"), "score")
