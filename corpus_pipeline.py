"""The corpus pipeline: five stages over ``documents``, each written as
Parquet and read again as the next one's input.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  The stages use models, so the rows
are not expressible in SQL: ``ORACLE_SQL`` is None and the tests hold every
stage against a brute-force version.

Defined results: an empty table passes every stage and gives no pieces; null
and empty texts go at the first stage (no language); extra columns pass
through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from funnelkit.llm import decontaminate, language, lines, near, packing
from funnelkit.llm.storage import written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified."""
    return language.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of lines that an earlier one holds;
    n_chars follows the text."""
    return lines.with_length(lines.drop_passages(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return near.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens, placed in sequences, with their ids."""
    return packing.pack(docs.select("doc_id", "text"), with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", benchmark_decontamination),
    ("packing", sequence_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
