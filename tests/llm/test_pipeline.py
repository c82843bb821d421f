"""The corpus pipeline: whole runs on edge cases, and the order of its last stage."""

import zlib

import pytest

import corpus_pipeline
from tests.llm.conftest import SF
from wellscore.llm import op6_tokens
from wellscore.llm.queries import vocabulary


@pytest.fixture()
def folder(spark, tmp_path, edge):
    """A folder of tables whose documents are the edge cases, or none of them, or nulls only."""

    def build(kind):
        docs = edge.limit(0) if kind == "empty" else edge
        if kind == "nulls":
            docs = docs.selectExpr(*[f"CAST(NULL AS {t}) AS {c}" for c, t in docs.dtypes])
        docs.write.parquet(f"{tmp_path}/{kind}/documents.parquet")
        spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/{kind}/benchmark.parquet")
        return f"{tmp_path}/{kind}"

    return build


@pytest.mark.parametrize("kind", ["edge", "empty", "nulls"])
def test_run_on_edge_cases(spark, folder, edge, kind):
    out = corpus_pipeline.run(spark, folder(kind))
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    ids = {r.doc_id for r in out.collect()}
    assert ids <= {r.doc_id for r in edge.collect()} and (kind == "edge" or not ids - {None})


def test_token_files_keep_the_order_of_the_mix(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = f"{tmp_path}/mixed"
    corpus_pipeline.mix(spark, docs, SF).write.parquet(path)
    mixed = spark.read.parquet(path)
    got = corpus_pipeline.tokens(spark, mixed, SF).orderBy("start").collect()
    stored = mixed.collect()
    assert [r.doc_id for r in got] == [r.doc_id for r in stored] and [r.doc_id for r in got] != sorted(r.doc_id for r in stored)
    from tokenizers import Tokenizer

    tok, at = Tokenizer.from_file(vocabulary()), 0
    for r, row in zip(got, stored, strict=True):
        ids = [*tok.encode(row.text or "", add_special_tokens=False).ids, 0]
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(raw))
        at += len(ids)


def test_stored_order_and_id_order_hold_the_same_documents(spark, edge):
    by_id, stored = (op6_tokens.encoded(edge, vocabulary(), stored_order=o).collect() for o in (False, True))
    key = lambda r: (r.doc_id is None, r.doc_id, r.n_tokens, r.ids_crc32)
    assert sorted(map(key, by_id), key=str) == sorted(map(key, stored), key=str)
    assert [r.doc_id for r in sorted(stored, key=lambda r: r.start)] == [r.doc_id for r in edge.collect()]
