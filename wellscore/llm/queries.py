"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wellscore.llm import op1_pii, op10_lm, op11_resample, op12_lines, op13_repair, op2_decontaminate, op3_chat, op4_minhash, op5_suffix, op6_tokens, op7_language, op8_quality, op9_mix
from wellscore.llm.common import table


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_word_shape_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return op1_pii.digest(op1_pii.find(documents, op1_pii.fit(documents)))


def op2_decontaminate_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_collapse_and_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_chat.render(table(spark, sf_dir, "conversations"))


def op4_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_minhash.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_copies")


def op5_bucket_pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_suffix.removed(table(spark, sf_dir, "documents")).drop("spans")


def op6_seekable_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_tokens.encoded(table(spark, sf_dir, "documents"), vocabulary(), literal=False)


def op7_evidence_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_language.identify_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op8_ngram_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_mix.replicate(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select("row.doc_id", "row.source", "copy", "shuffle_key")


def op10_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_lm.scored(table(spark, sf_dir, "documents"))


def op11_segment_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_resample.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")


def op12_two_bloom_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_lines.digest(op12_lines.deduplicated(table(spark, sf_dir, "documents")))


def op13_deepening_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_repair.audited(table(spark, sf_dir, "conversations"))


_BUILT = (
    op1_word_shape_field,
    op2_decontaminate_templates,
    op3_collapse_and_render,
    op4_prob_minhash,
    op5_bucket_pointers,
    op6_seekable_tokens,
    op7_evidence_fusion,
    op8_ngram_ratio,
    op9_poisson_mix,
    op10_backoff_automaton,
    op11_segment_resampling,
    op12_two_bloom_filters,
    op13_deepening_repair,
)
QUERIES = {f.__name__: f for f in _BUILT}
SQL = {
    "op2_decontaminate_templates": op2_decontaminate.SQL,
    "op3_collapse_and_render": op3_chat.SQL,
    "op9_poisson_mix": op9_mix.SQL,
    "op12_two_bloom_filters": op12_lines.SQL,
    "op13_deepening_repair": op13_repair.SQL,
}
