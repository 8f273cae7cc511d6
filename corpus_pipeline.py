"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, substring
dedup, best-fit packing, each over everything its predecessor kept.

Every stage takes (spark, docs, sf_dir); what it returns is written as Parquet
to the shared folder and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortflow.llm import debruijn, lines, packing, rules, simhash
from cohortflow.llm.common import materialize, read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base check nor a learned rule rejects."""
    return rules.keep_good(docs, rules.learn_from(docs, read_table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its source's boilerplate lines taken out."""
    return lines.dedup_lines(docs, "source", "text", n_chars_col="n_chars")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id."""
    return simhash.drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the long spans that an earlier one also has."""
    return debruijn.drop_repeated_spans(docs, n_chars_col="n_chars")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every word of every document in one bin: (doc_id, segment, start, bin...)."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", simhash_dedup),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs)
    return docs


#: The learned rules and the packing depend on fits and greedy state: no SQL.
ORACLE_SQL = None
