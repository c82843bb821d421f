"""Language identification by Bayesian evidence fusion.

Posterior over languages = host prior x P(declared language | language) x text likelihood.
  text      hashed byte-trigram multinomials, fitted on at most `max_train` / languages
            labelled documents of each language, one at least; a text counts as at most
            `cap` independent trigrams.
  declared  the markup's language attribute (or the lang column), read whole and matched with the
            labels by tag (declared_label); how reliable it is comes
            from a grouped count of declared against text-only decisions over all rows.
  host      counts of text-only decisions, smoothed from all rows to address suffix to
            registered domain to host. These are grouped aggregations with map-side sums, so
            a host with a third of the rows is one row per task before the shuffle.

Two passes over the text: one for the counts, one for the decision; no text is shuffled for
the counts. The host table is joined by Spark's own size-checked choice of broadcast.

Edge cases: null or letterless texts have no evidence and are rejected (language null if
nothing is known); null host, suffix or declared language add no evidence of their own (null
hosts share one prior); repeated rows get the same decision; ties go to the first language
by name; an empty table gives no rows; extra columns pass through in the row struct.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellscore.llm.common import slices, table_rows, text_bytes, written

BUCKETS, MAX_TRAIN, CAP, SMOOTH, MIN_PROB = 1 << 14, 4000, 40, 5.0, 0.5

LETTER = np.full(256, 32, np.uint32)
LETTER[97:123] = np.arange(97, 123)
LETTER[65:91] = np.arange(97, 123)
LETTER[128:] = np.arange(128, 256)


def trigrams(buf: np.ndarray, offs: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of each byte trigram that has a letter; other ASCII counts as space."""
    n = LETTER[buf]
    if len(n) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (n[:-2] << np.uint32(16)) | (n[1:-1] << np.uint32(8)) | n[2:]
    ok = code != np.uint32(0x202020)
    for cut in offs[1:-1]:
        ok[max(0, cut - 2) : cut] = False
    at = np.flatnonzero(ok)
    h = (code[at] * np.uint32(2654435761)) >> np.uint32(32 - int(math.log2(buckets)))
    return h.astype(np.int64), np.searchsorted(offs, at, "right") - 1


def train(documents: DataFrame, buckets: int = BUCKETS, max_train: int = MAX_TRAIN) -> tuple[list[str], np.ndarray]:
    """All labelled languages (by name) and their log trigram probabilities [language, bucket].

    Each language gives its max_train / languages rows (at least one) of least hash. A language
    without a trigram in them is never the text's choice, only that of markup and host."""
    d = table_rows(documents, doc_id="doc_id", text="text", lang="lang").filter("lang IS NOT NULL AND text IS NOT NULL")
    d = d.select("lang", "text", F.xxhash64("doc_id", "lang", "text").alias("h"))
    # one small row per language
    seen = written(d.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"), F.min("h").alias("least")), "languages")
    langs = sorted(r["lang"] for r in seen.select("lang").collect())
    if not langs:
        return [], np.full((0, buckets), 0.5)
    quota = max(1, max_train // len(langs))
    # a bound of the hash below which a language has more than its quota, by far; the exact rank then has few rows to sort
    share = F.least(F.lit(1.0), F.lit(2.0 * quota + 32) / F.col("n"))
    bound = F.greatest(F.col("least"), F.when(share >= 1, F.lit(2**63 - 1)).otherwise((share * 2.0**64 - 2.0**63).cast("long")))
    d = d.join(F.broadcast(seen.select(F.col("lang").alias("k"), bound.alias("bound"))), (F.col("lang") == F.col("k")) & (F.col("h") <= F.col("bound")))
    d = d.groupBy("lang", "h").agg(F.min("text").alias("text"))  # repeated rows are one
    d = d.withColumn("i", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("i") <= quota).select("lang", "text")

    def count(batches):
        for b in batches:
            buf, offs = text_bytes(b.column(1))
            lang = b.column(0).to_pylist()
            for lo, hi in slices(offs):
                h, row = trigrams(buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], buckets)
                for name in set(lang[lo:hi]):
                    own = np.array([x == name for x in lang[lo:hi]])
                    k, n = np.unique(h[own[row]], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(k), pa.string()), pa.array(k, pa.int64()), pa.array(n, pa.int64())], ["lang", "b", "n"])

    counts = d.mapInArrow(count, "lang string, b long, n long").groupBy("lang", "b").agg(F.sum("n").alias("n"))
    counts = written(counts, "trigrams")
    table = np.zeros((len(langs), buckets))
    at = {x: i for i, x in enumerate(langs)}
    for r in counts.toLocalIterator():  # at most languages x buckets rows
        table[at[r["lang"]], r["b"]] = r["n"]
    none = table.sum(1) == 0
    table += 0.5
    model = np.log(table / table.sum(1, keepdims=True)).astype(np.float32)
    if none.any() and not none.all():
        model[none] = model[~none].min(0) - 1
    return langs, model


def with_text_evidence(rows: DataFrame, model: np.ndarray, cap: int) -> DataFrame:
    """rows (any columns, then text as _t) with _n trigrams and _ll, the log likelihoods at the capped length."""
    buckets = model.shape[1]
    keep = [c for c in rows.columns if c != "_t"]

    def score(batches):
        for b in batches:
            buf, offs = text_bytes(b.column(b.schema.get_field_index("_t")))
            n, ll = np.zeros(len(offs) - 1, np.int64), np.zeros((len(offs) - 1, len(model)))
            for lo, hi in slices(offs):
                h, row = trigrams(buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], buckets)
                n[lo:hi] = np.bincount(row, minlength=hi - lo)
                ends = np.cumsum(n[lo:hi])
                for k in range(len(model)):
                    c = np.concatenate([[0.0], np.cumsum(model[k][h], dtype=np.float64)])
                    ll[lo:hi, k] = c[ends] - c[ends - n[lo:hi]]
            ll *= (np.minimum(n, cap) / np.maximum(n, 1))[:, None]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * len(model), pa.int32()), pa.array(np.round(ll, 9).ravel()))
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in keep] + [pa.array(n), lists], [*keep, "_n", "_ll"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    return rows.mapInArrow(score, f"{fields}, _n long, _ll array<double>")


def host_parts(host: Column) -> tuple[Column, Column]:
    """Registered domain (last two labels) and suffix (last label) of a host; a name without a dot is its own domain, without suffix."""
    return F.substring_index(host, ".", -2), F.when(host.contains("."), F.substring_index(host, ".", -1)).otherwise("")


def declared_label(declared: Column, langs: list[str]) -> Column:
    """The label that a declared tag names, null if none: the tag itself, else the longest label that it starts with up to a hyphen (en of en-GB), any case, _ as -."""
    norm = lambda c: F.replace(F.lower(c), F.lit("_"), F.lit("-"))
    labels = F.array(*[F.struct(F.concat(norm(F.lit(x)), F.lit("-")).alias("start"), F.lit(x).alias("name")) for x in sorted(langs, key=lambda x: (-len(x), x))])
    tag = F.concat(norm(F.trim(declared)), F.lit("-"))
    return F.coalesce(F.when(declared.isin(langs), declared), F.get(F.filter(labels, lambda x: F.startswith(tag, x["start"])), F.lit(0))["name"])


def identify(rows: DataFrame, langs: list[str], model: np.ndarray, text: Column, declared: Column, host: Column, cap: int = CAP, smooth: float = SMOOTH, min_prob: float = MIN_PROB) -> DataFrame:
    """One row per input row: row (all its columns), text_lang, lang, prob, accepted."""
    if not langs:
        return rows.select(F.struct("*").alias("row"), F.lit(None).cast("string").alias("text_lang"), F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("prob"), F.lit(False).alias("accepted"))
    width = len(langs)
    names = F.array(*[F.lit(x) for x in langs])
    known = declared_label(declared, langs)
    host = F.coalesce(F.lower(host), F.lit(""))
    best = F.when(F.col("_n") > 0, F.array_position("_ll", F.array_max("_ll")) - 1)
    votes = with_text_evidence(rows.select(known.alias("declared"), host.alias("host"), F.coalesce(text, F.lit("")).alias("_t")), model, cap)
    votes = written(votes.groupBy("host", "declared", best.cast("int").alias("best")).agg(F.count("*").alias("n")).filter("best IS NOT NULL"), "votes", small=True)
    # declared against text-only: at most (languages + 1) x languages rows
    seen = np.ones((width, width))
    for r in votes.filter("declared IS NOT NULL").groupBy("declared", "best").agg(F.sum("n").alias("n")).collect():
        seen[r["best"], langs.index(r["declared"])] += r["n"]
    says = np.log(seen / seen.sum(1, keepdims=True))
    total = np.ones(width)
    for r in votes.groupBy("best").agg(F.sum("n").alias("n")).collect():
        total[r["best"]] += r["n"]
    prior = F.array(*[F.lit(float(x)) for x in total / total.sum()])
    each = lambda: F.array(*[F.sum(F.when(F.col("best") == k, F.col("n")).otherwise(0)).cast("double") for k in range(width)])
    blend = lambda counts, above: F.zip_with(counts, above, lambda c, p: (c + smooth * p) / (F.aggregate(counts, F.lit(0.0), lambda a, x: a + x) + smooth))
    domain, suffix = host_parts(F.col("host"))
    votes = votes.withColumns({"domain": domain, "suffix": suffix})
    by_suffix = votes.groupBy("suffix").agg(each().alias("c")).select("suffix", blend(F.col("c"), prior).alias("p1"))
    by_domain = votes.groupBy("domain", "suffix").agg(each().alias("c")).join(by_suffix, "suffix").select("domain", blend(F.col("c"), F.col("p1")).alias("p2"))
    by_host = votes.groupBy("host", "domain").agg(each().alias("c")).join(by_domain, "domain").select(F.col("host").alias("h"), blend(F.col("c"), F.col("p2")).alias("prior"))
    by_host = written(by_host, "hosts")
    scored = with_text_evidence(rows.select(F.struct("*").alias("row"), known.alias("declared"), host.alias("host"), F.coalesce(text, F.lit("")).alias("_t")), model, cap)
    scored = scored.join(by_host, F.col("host") == F.col("h"), "left").withColumn("prior", F.coalesce("prior", prior))
    heard = F.array(*[F.array(*[F.lit(float(x)) for x in r]) for r in says])
    zero = F.array_repeat(F.lit(0.0), width)
    said = F.when(F.col("declared").isNull(), zero).otherwise(F.transform(heard, lambda r: F.get(r, (F.array_position(names, F.col("declared")) - 1).cast("int"))))
    scored = scored.withColumn("post", F.zip_with(F.zip_with("_ll", F.transform("prior", lambda p: F.log(p)), lambda a, b: a + b), said, lambda a, b: a + b))
    scored = scored.withColumn("top", F.array_max("post"))
    prob = F.lit(1.0) / F.aggregate("post", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    any_ = (F.col("_n") > 0) | F.col("declared").isNotNull() | (F.col("host") != "")
    out = scored.select("row", F.get(names, best.cast("int")).alias("text_lang"), F.when(any_, F.get(names, (F.array_position("post", F.col("top")) - 1).cast("int"))).alias("lang"), prob.alias("prob"), "_n")
    return out.select("row", "text_lang", "lang", "prob", ((F.col("_n") > 0) & (F.col("prob") >= min_prob)).alias("accepted"))


def page_text(html: Column) -> Column:
    t = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1>", " ")
    return F.regexp_replace(F.regexp_replace(t, r"(?s)<!--.*?-->|<[^>]*>", " "), r"&#?[A-Za-z0-9]+;", " ")


def identify_pages(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """(page_id, host, declared, text_lang, lang, prob, accepted) of every page; the text model is fitted on documents."""
    langs, model = train(documents)
    p = table_rows(pages, page_id="page_id", url="url", html="html")
    declared = F.nullif(F.regexp_extract("html", r"""(?i)<html\b[^>]*\blang\s*=\s*["']?([A-Za-z0-9]+(?:[-_][A-Za-z0-9]+)*)""", 1), F.lit(""))
    host = F.nullif(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))
    out = identify(p, langs, model, page_text(F.col("html")), declared, host)
    return out.select("row.page_id", F.nullif(F.lower(F.regexp_extract("row.url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit("")).alias("host"), "text_lang", "lang", F.round("prob", 9).alias("prob"), "accepted")


def identified_documents(documents: DataFrame) -> DataFrame:
    """The documents that are accepted, all columns; lang is evidence (declared) and source the host."""
    langs, model = train(documents)
    out = identify(documents, langs, model, F.col("text"), F.col("lang"), F.col("source"))
    return out.filter("accepted").select("row.*")
