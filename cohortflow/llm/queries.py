"""The registered queries: each applies its operator to the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortflow.llm import bpe, cotrain, debruijn, divergence, embed, html_crf, lines, lm, packing, rules, simhash, suffix, whiten
from cohortflow.llm.common import read_table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extract_pages(read_table(spark, sf_dir, "pages"))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.span_report(read_table(spark, sf_dir, "documents"))


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.round_trip(read_table(spark, sf_dir, "documents"), tokenizer_path)


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.span_report(read_table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(read_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return rules.score_documents(docs, rules.learn_from(docs, read_table(spark, sf_dir, "labels")))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_held_out(read_table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(read_table(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_extraction,
        op2_simhash_dedup,
        op3_best_fit_packing,
        op4_quality_classifier,
        op5_suffix_array_dedup,
        op6_bpe_round_trip,
        op7_embedding_dedup,
        op8_substring_dedup,
        op9_line_dedup,
        op10_quality_rules,
        op11_lm_scoring,
        op12_embedding_whitening,
        op13_source_divergence,
    )
}

ORACLE = {"op9_line_dedup": lines.LINE_REPORT_SQL}
