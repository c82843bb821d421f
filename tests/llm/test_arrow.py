"""op1, op4, op6, op7: against brute force, round trips and held-out accuracy; edge cases."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.conftest import EDGE, SF
from wellscore.llm import op1_pii, op4_minhash, op6_tokens, op7_language
from wellscore.llm.queries import vocabulary


def slow_base(t):
    """The contract's patterns as they stand."""
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) < 256 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub(r"\D", "", m[0])
        if 16 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub(r"\D", "", m[0])) <= 15]
    return out


def test_op1_base_and_added(spark, docs, edge):
    field = op1_pii.fit(docs)
    for table in (docs, edge.filter("length(text) < 9000 OR text IS NULL")):
        want = defaultdict(list)
        for r in table.collect():
            want[(r.doc_id, hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in slow_base(r.text or "")).encode()).hexdigest())].append(r)
        got = op1_pii.digest(op1_pii.find(table, field)).collect()
        assert sorted((r.doc_id or -1, r.base_sha256) for r in got) == sorted((k[0] or -1, k[1]) for k, v in want.items() for _ in v)
    r = next(r for r in op1_pii.find(edge, field).collect() if r.doc_id == 1)
    assert {s.kind for s in r.base} == {"email", "card", "phone"} and all(s in r.spans for s in r.base)
    assert op1_pii.find(edge, field).count() == len(EDGE)
    assert op1_pii.find(edge.limit(0), op1_pii.fit(edge.limit(0))).count() == 0


def test_op1_field_learns_the_shapes(spark):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["words"], r["labels"]) for r in op1_pii.labelled_runs(big).collect()]
    train, held = rows[::2], rows[1::2]
    f = op1_pii.Field(5).fit([(op1_pii.features(w), y) for w, y in train])
    got = f.decode([op1_pii.features(w) for w, _ in held])
    right = sum(int(a == b) for y, (_, z) in zip(got, held, strict=True) for a, b in zip(y, z, strict=True))
    assert right >= 0.95 * sum(len(y) for _, y in held)


def near(texts, k=5):
    """Classes by exact Jaccard similarity of all pairs."""
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            a, b = sets[i], sets[j]
            same = (texts[i] or "") == (texts[j] or "")
            if same or a and b and min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {i: find(i) for i in ids}


def test_op4_classes(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    words = next(t for t in texts.values() if 60 < len(t.split()) < 120).split()
    for j in range(40):  # a group of near copies: some differ from others by more than from the first
        w = list(words)
        w[(j * 7) % len(w)] = f"new{j}"
        texts[10_000 + j] = " ".join(w)
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in op4_minhash.classes(table).collect()}
    assert got == near(texts)
    assert sorted(r.doc_id for r in op4_minhash.deduplicated(table).collect()) == sorted(set(got.values()))


def test_op4_copies_that_repeat_lines_differently(spark):
    texts = {}
    for g in range(16):  # the same set of runs, or nearly: 14 words once more, or a thousand times
        base = [f"g{g}w{i}" for i in range(54)]
        texts[2 * g] = " ".join(base + base[:14] * 2)
        texts[2 * g + 1] = " ".join(base + base[:14] * 1000 + ["end"] * (g % 2))
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in op4_minhash.classes(table).collect()}
    assert got == near(texts) and len(set(got.values())) == 16


def test_op4_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(3)
    h = rng.integers(1, 2**62, 300).astype(np.uint64)
    wa, wb = rng.integers(1, 5, 300).astype(float), rng.integers(1, 5, 300).astype(float)
    wa[:60], wb[-60:] = 0, 0
    both = (wa > 0) & (wb > 0)
    exact = sum(1 / np.maximum(wa / wa[i], wb / wb[i]).sum() for i in np.flatnonzero(both))
    a, b = wa > 0, wb > 0
    row = np.repeat([0, 1], [a.sum(), b.sum()])
    s = op4_minhash.prob_minhash(np.concatenate([h[a], h[b]]), row, np.concatenate([wa[a], wb[b]]), 2, 4096)
    assert abs((s[0] == s[1]).mean() - exact) < 0.03


def test_op4_edges(spark, edge):
    got = op4_minhash.classes(edge).collect()
    assert len(got) == len(EDGE)
    c = {r.doc_id: r.class_id for r in got if r.doc_id is not None}
    assert c[7] == c[1] == 1 and c[2] == c[3] == 2 and c[4] == 4
    kept = op4_minhash.deduplicated(edge)
    assert kept.columns == edge.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 4, 5, 6, 6]
    assert op4_minhash.classes(edge.limit(0)).count() == 0


def test_op6_round_trip(spark, docs, edge):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocabulary())
    tok.encode_special_tokens = True
    odd = [(1, " a  b  c d  "), (2, "<|endoftext|> x"), (3, "it's  'll éß 中文 \U0001f600 x y\n z\r\n"), (4, "a ́b ſs"), (5, " "), (6, "tail ")]
    for table in (docs, edge, spark.createDataFrame(odd, "doc_id long, text string")):
        want, at = [], 0
        for r in sorted(table.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, (r.text or "").encode())):
            ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 0]
            want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            at += len(ids)
        got = sorted(op6_tokens.encoded(table, vocabulary()).collect(), key=lambda r: r.start)
        assert [tuple(r) for r in got] == want
    assert op6_tokens.encoded(edge.limit(0), vocabulary()).count() == 0


def test_op6_query_encodes_as_the_unchanged_tokenizer(spark, tmp_path):
    import corpus_pipeline
    from tokenizers import Tokenizer

    from wellscore.llm.queries import QUERIES

    tok, e = Tokenizer.from_file(vocabulary()), "<|endoftext|>"
    texts = [f"x {e} y", e, e * 3, f"a{e}b\n{e}\nc", f" {e}  {e} it's{e}'s", "<|endoftext", f"|>{e[:-1]} >", f"é{e}中 {e[2:]}", "plain words only", f"<|endof{e}text|> {e}"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    want, at = [], 0
    for i, t in enumerate(texts):
        ids = [*tok.encode(t, add_special_tokens=False).ids, 0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    d = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for got in (QUERIES["op6_seekable_tokens"](spark, str(tmp_path)), corpus_pipeline.tokens(spark, d, str(tmp_path))):
        assert sorted(tuple(r) for r in got.collect()) == want


def test_op6_reads_single_documents_and_notices_damage(tmp_path):
    p = tmp_path / "f.zst"
    rng = np.random.default_rng(1)
    data = rng.integers(0, 255, 100_000).astype(np.uint8).tobytes()
    with open(p, "wb") as f:
        w = op6_tokens.Writer(f, 4096)
        w.write(data)
        w.close()
    import zstandard

    assert zstandard.ZstdDecompressor().stream_reader(p.read_bytes(), read_across_frames=True).read() == data
    r = op6_tokens.Reader(open(p, "rb"), p.stat().st_size)
    assert r.read(5000, 13_000) == data[5000:13_000] and r.read(99_999, 100_000) == data[-1:]
    b = bytearray(p.read_bytes())
    b[20] ^= 1
    p.write_bytes(bytes(b))
    with pytest.raises(Exception):  # noqa: B017
        op6_tokens.Reader(open(p, "rb"), len(b)).read(0, 10)


def test_op7_held_out_and_edges(spark, edge):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    langs, model = op7_language.train(d, max_train=300)
    from pyspark.sql import functions as F

    none = F.lit(None).cast("string")
    got = op7_language.identify(d, langs, model, F.col("text"), none, none).select("row.lang", F.col("lang").alias("said")).collect()
    assert sum(r.lang == r.said for r in got) >= 0.97 * len(got)
    out = op7_language.identify(edge, langs, model, F.col("text"), F.col("lang"), F.col("source")).collect()
    assert len(out) == len(EDGE)
    assert not any(r.accepted for r in out if not re.search("[A-Za-z]", r.row.text or ""))
    assert op7_language.identified_documents(edge).columns == edge.columns
    assert op7_language.identified_documents(edge.limit(0)).count() == 0


def test_op7_rare_and_many_languages_are_kept(spark):
    from pyspark.sql import functions as F

    word = lambda k, i: "".join(chr(97 + c % 26) for c in hashlib.md5(f"{k} {i}".encode()).digest()[:6])
    name = lambda k: chr(97 + k // 26) + chr(97 + k % 26)
    rows = [(i, " ".join(word(0, i + j) for j in range(12)), name(0)) for i in range(400)]
    rows += [(1000 + k, " ".join(word(k, j) for j in range(12)), name(k)) for k in range(1, 80)]  # one row each
    rows.append((2000, "12 34", "zz"))  # no trigram with a letter
    t = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, model = op7_language.train(t, max_train=100)
    assert langs == sorted({r[2] for r in rows}) and model.shape == (81, op7_language.BUCKETS) and np.isfinite(model).all()
    few = t.filter("doc_id BETWEEN 1071 AND 1079")
    got = op7_language.identify(few, langs, model, F.col("text"), F.col("lang"), F.lit(None).cast("string")).collect()
    assert [r.lang for r in got] == [r.row.lang for r in got] and len(got) == 9


def test_op7_host_prior_and_markup_decide_short_texts(spark):
    from pyspark.sql import functions as F

    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    langs, model = op7_language.train(d)
    rows = [(i, t.text, None, "www.a.fr") for i, t in enumerate(d.filter("lang = 'fr'").limit(60).collect())]
    rows += [(1000, "on", None, "x.a.fr"), (1001, "on", None, "z.example"), (1002, "on", "de", "z.example")]
    t = spark.createDataFrame(rows, "id long, text string, said string, host string")
    p = {r.row.id: (r.lang, r.prob) for r in op7_language.identify(t, langs, model, F.col("text"), F.col("said"), F.col("host")).collect()}
    assert p[1000][0] == "fr"


def test_op7_declared_tags_are_read_whole(spark):
    from pyspark.sql import functions as F

    said = [("eng", "eng"), ("SPA", "spa"), ("zh-cn", "zh-cn"), ("zh_TW", "zh-tw"), ("zh-Hant-HK", "zh"), ("eng-GB", "eng"), ("en", None), ("english", None), ("", None), (None, None), (" spa ", "spa")]
    t = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(said)], "id long, said string, want string")
    got = t.select("said", "want", op7_language.declared_label(F.col("said"), ["eng", "spa", "zh", "zh-cn", "zh-tw"]).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]
    both = t.limit(1).select(op7_language.declared_label(F.lit("en"), ["EN", "en"]), op7_language.declared_label(F.lit("En"), ["EN", "en"])).first()
    assert tuple(both) == ("en", "EN")  # a label itself, else the first by name


def test_op7_three_letter_labels_are_evidence(spark):
    from pyspark.sql import functions as F

    d = spark.createDataFrame([(i, f"the house {i} of the river", "eng") for i in range(30)] + [(100 + i, f"la casa {i} del rio", "spa") for i in range(30)], "doc_id long, text string, lang string")
    langs, model = op7_language.train(d)
    t = d.union(spark.createDataFrame([(200, "", "eng"), (201, "", "spa-MX")], d.schema))
    got = {r.row.doc_id: (r.lang, r.prob) for r in op7_language.identify(t, langs, model, F.col("text"), F.col("lang"), F.lit(None).cast("string")).collect()}
    assert got[200][0] == "eng" and got[201][0] == "spa" and min(got[200][1], got[201][1]) > 0.9


def test_op1_words_are_judged_whole():
    """Words that are alike for 300 characters differ by what follows; features stay short."""
    same = "ab1-" * 100
    one, two = (op1_pii.features([same + tail])[0] for tail in ("", "x@9"))
    assert one != two and "at=True" in two and "at=False" in one
    assert op1_pii.features(["1" * 15 + "a" * 400 + "2" * 3])[0][2] == "digits=18"
    assert max(len(f) for w in ("ab1-" * 50_000, "9" * 100_000) for f in op1_pii.features([w])[0]) < 60


def test_small_batches_bound_what_a_worker_gets_and_change_no_result(spark, docs, edge, monkeypatch):
    import pyarrow as pa

    from wellscore.llm import common

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    before = spark.conf.get(common.BATCH_LIMIT)
    long = spark.range(0, 400, 1, 1).selectExpr("repeat('x', 50000) AS text")
    got = [r.n for r in common.written(long.mapInArrow(sizes, "n long"), "sizes", small=True).collect()]
    assert sum(got) > 400 * 50_000 and max(got) < common.BATCH_BYTES + 200_000
    assert spark.conf.get(common.BATCH_LIMIT) == before

    some = docs.limit(200).localCheckpoint().select("doc_id", "text")
    tables = some.unionByName(edge.select("doc_id", "text")).coalesce(2)
    results = []
    for limit in (common.BATCH_BYTES, 20_000):
        monkeypatch.setattr(common, "BATCH_BYTES", limit)
        monkeypatch.setattr(op6_tokens, "SLICE_BYTES", min(limit, op6_tokens.SLICE_BYTES))
        linked = op4_minhash.classes(tables).select("doc_id", "class_id", "n_copies").collect()
        coded = op6_tokens.encoded(tables, vocabulary()).collect()
        results.append((sorted(map(str, linked)), sorted(map(str, coded))))
    assert results[0] == results[1]


def test_op6_worker_memory_does_not_hold_many_times_its_batch():
    """Encoding 8 MB of text in slices of SLICE_BYTES takes far less than slices of 4 MB did (157 MB)."""
    import tracemalloc

    from wellscore.llm import common

    text = b"alpha beta gamma delta " * 350_000
    offs = np.arange(0, len(text) + 1, 2300)
    buf = np.frombuffer(text, np.uint8)[: offs[-1]]
    common._POW.clear()  # powers kept by earlier tests
    enc = op6_tokens.Encoder(vocabulary(), False)
    tracemalloc.start()
    for lo, hi in common.slices(offs, op6_tokens.SLICE_BYTES):
        enc.encode(buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6, peak
