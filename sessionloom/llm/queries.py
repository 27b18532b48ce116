"""The operators as queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.config import stage
from sessionloom.llm import (
    best_fit,
    bit_scatter,
    chosen_path,
    chunk_table,
    decision_list,
    kneser_ney,
    multi_index,
    packed_ids,
    page_diff,
    phrase_automata,
    prefix_rollup,
    raking,
    segment_counts,
)
from sessionloom.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = decision_list.fit_rules(docs, table(spark, sf_dir, "labels"))
    return decision_list.judge(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rule", "kept"
    )


def op3_segment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents before and after two edits of each, made from its own columns."""
    docs = table(spark, sf_dir, "documents")
    path, pattern = byte_tokenizer()
    edits = F.expr(
        "array(struct(length(text) div 3 as at, 7L as removed, concat(' ', source, ' ') as inserted), "
        "struct(2 * length(text) div 3 as at, 0L as removed, lang as inserted))"
    )
    trees = segment_counts.build_trees(docs.select("doc_id", "text", edits.alias("edits")), path, pattern)
    before = trees.withColumn("n_tokens", segment_counts.n_tokens())
    after = segment_counts.apply_edits(before, path, pattern)
    return after.select(
        "doc_id",
        "n_tokens",
        segment_counts.n_tokens().alias("n_tokens_edited"),
        F.get("chars", F.lit(1)).alias("n_chars_edited"),
        "n_encoded",
    )


def op4_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raking.mix_probabilities(table(spark, sf_dir, "documents"), share=raking.KEPT_SHARE).select(
        "doc_id",
        F.col("_source").alias("source"),
        F.col("_lang").alias("lang"),
        F.col("_topic").alias("topic"),
        F.col("_tokens").alias("n_tokens"),
        F.round("_probability", 9).alias("probability"),
        (F.col("_drawn") < F.col("_probability")).alias("kept"),
    )


def op5_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_automata.digest(table(spark, sf_dir, "documents"))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_tokenizer() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 4
    model = kneser_ney.fit(docs.where(remainder != 2))
    held_out = F.coalesce(remainder == 2, F.lit(False)).alias("held_out")
    predicted = kneser_ney.with_rejection(stage(kneser_ney.predict(docs, model)))
    return predicted.select("doc_id", held_out, "lang_pred", "score", "entropy", "rejected")


def op8_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_page_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_diff.extract(table(spark, sf_dir, "pages"))


def op10_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = byte_tokenizer()
    return packed_ids.packed_ids(table(spark, sf_dir, "documents"), path, pattern)


def op11_bit_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_scatter.whitened(table(spark, sf_dir, "embeddings"))


def op12_prefix_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_rollup.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_chunk_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_table.digests(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_chosen_path,
        op2_quality_rules,
        op3_segment_counts,
        op4_raking,
        op5_phrase_automata,
        op6_best_fit_packing,
        op7_kneser_ney,
        op8_multi_index,
        op9_page_diff,
        op10_packed_ids,
        op11_bit_scatter,
        op12_prefix_rollup,
        op13_chunk_table,
    )
}
