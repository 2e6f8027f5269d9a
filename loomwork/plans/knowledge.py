"""Knowledge base and graph, built as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.functions import lexicons, parsing
from loomwork.operators import chunking, graph
from loomwork.operators.durable import materialise, numbered
from loomwork.operators.retrieval import SparseIndex
from loomwork.plans.models import Chat, Embed, answered, embedded

EXTRACT = "Name the entities ({entities}) and relations ({relations}) in these passages of one article, as JSON with the lists entities and relations.\n\n"


def passages_of(articles: DataFrame, least: int = 100, most: int = 400) -> DataFrame:
    """Passages of (title, content, sections, url): ids run over all articles, so the graph and the index agree on them."""
    whole = F.array(F.struct(F.lit("Main").alias("title"), F.col("content").alias("text")))
    sections = F.when(F.size(F.coalesce("sections", F.array().cast("array<struct<title: string, text: string>>"))) > 0, F.col("sections")).otherwise(whole)
    rows = chunking.chunk(articles, "title", sections, least, most).withColumnRenamed("title", "article_title")
    urls = articles.select(F.col("title").alias("article_title"), "url")
    return rows.join(urls, "article_title").select("id", "text", "article_title", "section_title", "passage_index", F.coalesce("url", F.lit("")).alias("url"))


def extract_graph(
    passages: DataFrame, model: Chat, entity_types: Sequence[str] = lexicons.ENTITY_TYPES, relation_types: Sequence[str] = lexicons.RELATION_TYPES, checkpoint: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Raw entities and relations of every article, from one call each over what fits the budget of its passages.

    Passages come in the order of their numbers. With ``checkpoint``, answers are appended to a table there, and articles
    that it holds are not asked again; failed calls, whose answers are empty, are.
    """
    long_enough = passages.where(F.char_length("text") >= 100).withColumn("number", F.regexp_extract("id", r"(\d+)$", 1).cast("long"))
    texts = chunking.budgeted_text(long_enough, "article_title", "number", F.col("section_title"), F.col("text"))
    ids = long_enough.groupBy("article_title").agg(F.transform(F.array_sort(F.collect_list(F.struct("number", "id"))), lambda p: p["id"]).alias("passage_ids"))
    head = EXTRACT.format(entities=", ".join(entity_types), relations=", ".join(relation_types))
    asked = texts.join(ids, "article_title").withColumn("prompt", F.concat(F.lit(head), F.col("text")))
    if checkpoint:
        said = _resumed(asked, model, checkpoint)
    else:
        said = materialise(answered(asked, "prompt", "answer", model), "extraction")
    said = said.withColumn("found", parsing.extraction(F.col("answer")))
    entities = said.select(F.col("article_title").alias("source_article"), "passage_ids", F.posexplode("found.entities").alias("place", "entity"))
    entities = entities.select("source_article", "passage_ids", "place", "entity.*")
    relations = said.select(F.col("passage_ids").alias("evidence_passage_ids"), F.inline("found.relations"))
    return entities, relations


def _resumed(asked: DataFrame, model: Chat, checkpoint: str) -> DataFrame:
    """The answers for all of ``asked``: those that the checkpoint lacks are asked for and appended first."""
    spark = asked.sparkSession
    schema = "article_title string, answer string"
    answered(asked.limit(0), "prompt", "answer", model).select("article_title", "answer").write.mode("append").parquet(checkpoint)
    done = spark.read.schema(schema).parquet(checkpoint).where("answer <> ''").select("article_title").distinct()
    left = asked.join(done, "article_title", "left_anti")
    answered(left, "prompt", "answer", model).select("article_title", "answer").write.mode("append").parquet(checkpoint)
    held = spark.read.schema(schema).parquet(checkpoint).groupBy("article_title").agg(F.max("answer").alias("answer"))
    return asked.join(held, "article_title")


def build(articles: DataFrame, embed: Embed, chat: Chat | None = None, checkpoint: str | None = None) -> dict[str, DataFrame]:
    """The index tables: passages, vectors, weights and, with a chat model, entities, relations and surfaces."""
    passages = materialise(passages_of(articles), "passages")
    tables = {
        "passages": passages,
        "vectors": embedded(passages.select(F.col("id").alias("vec_id"), "text"), "text", "embedding", embed).drop("text"),
        "weights": SparseIndex.build(passages, "id", "text").weights,
    }
    if chat:
        raw, relations = extract_graph(passages, chat, checkpoint=checkpoint)
        # the first type and the first of equally long descriptions: by article, then by place in its answer
        entities = graph.merge_entities(numbered(raw, ["source_article", "place"], "ord"), "ord")
        tables |= {
            "entities": entities,
            "relations": graph.merge_relations(relations),
            "surfaces": embedded(graph.surfaces(entities).withColumn("surface_id", F.xxhash64("name", "surface")), "surface", "vector", embed),
        }
    return tables
