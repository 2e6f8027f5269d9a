"""The queries of the corpus operators, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.llm import cws, embeddings, html_text, lines, mixing, packing, simhash, substrings, token_files, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op1(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(table(spark, sf_dir, "documents"))


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cws.neighbours(table(spark, sf_dir, "documents"))


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(table(spark, sf_dir, "documents"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write(table(spark, sf_dir, "documents")).documents()


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_mix, op2_simhash, op3_embeddings, op4_substrings, op5_fingerprint, op6_lines, op7_html, op8_token_files, op9_toxicity, op10_pack)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mix": mixing.OP1_SQL,
        "op3_embeddings": embeddings.OP3_SQL,
        "op4_substrings": substrings.OP4_SQL,
        "op6_lines": lines.OP6_SQL,
    }
