"""A training corpus from ``documents``: five stages, each written as Parquet and read again as the next one's input.

All stages but the last return the columns of ``documents``. The corpus operators do the work; nothing is swallowed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomwork.llm import common, lines, mixing, near, packing, toxicity


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose nearest labelled examples call them toxic go."""
    return toxicity.reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go; every document stays, if only with an empty text."""
    return lines.dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest doc_id: by SimHash, confirmed by Jaccard (five
    words, 0.8), and exactly by Jaccard where fingerprints are too far apart."""
    return near.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight takes them."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token pieces and their places in sequences."""
    return packing.pack_documents(docs)


#: In this order.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("mixing", mix),
    ("best_fit_packing", pack),
]

#: SQL has neither the nearest examples nor the tokenizer; tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = common.materialise(docs, f"stage-{name}")
    return docs
