"""The knowledge graph as two tables, entities and relations, and how queries walk it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomwork.operators.durable import numbered
from loomwork.operators.retrieval import dense_search

HOP_WEIGHT = 0.5


def merge_entities(raw: DataFrame, order: str) -> DataFrame:
    """One row per name: unions of aliases and passages, the longest description (the earliest of equals), the first type.

    Ids entity_0, entity_1, ... run over the sorted names.
    """
    size = F.char_length(F.coalesce("description", F.lit("")))
    scalar = raw.groupBy("name").agg(
        F.min_by("type", order).alias("type"),
        F.max_by("description", F.struct(size, -F.col(order))).alias("description"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("aliases")))).alias("aliases"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("passage_ids")))).alias("passage_ids"),
    )
    rows = numbered(scalar, ["name"], "number")
    return rows.withColumn("id", F.concat(F.lit("entity_"), F.col("number").cast("string"))).drop("number")


def merge_relations(raw: DataFrame) -> DataFrame:
    """One row per (source, target, relation): greatest confidence, union of evidence."""
    return raw.groupBy("source", "target", "relation").agg(
        F.max("confidence").alias("confidence"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("evidence_passage_ids")))).alias("evidence_passage_ids"),
    )


def adjacency(relations: DataFrame) -> DataFrame:
    """(name, relation, neighbour, confidence, passage_ids): every relation from both of its ends."""
    forth = relations.select(F.col("source").alias("name"), "relation", F.col("target").alias("neighbour"), "confidence", F.col("evidence_passage_ids").alias("passage_ids"))
    back = relations.select(F.col("target").alias("name"), F.concat("relation", F.lit("_rev")).alias("relation"), F.col("source").alias("neighbour"), "confidence", F.col("evidence_passage_ids").alias("passage_ids"))
    return forth.unionByName(back)


def relations_of(edges: DataFrame, names: DataFrame) -> DataFrame:
    return edges.join(names.select("name"), "name").select("name", "relation", F.col("neighbour").alias("target"), "confidence")


def neighbours(edges: DataFrame, names: DataFrame, entities: DataFrame) -> DataFrame:
    """Neighbours one hop away; an end that is no entity's name has a null type."""
    found = edges.join(names.select("name"), "name")
    known = entities.select(F.col("name").alias("neighbour"), F.col("type").alias("neighbour_type"))
    return found.join(known, "neighbour", "left")


def surfaces(entities: DataFrame) -> DataFrame:
    """(surface, name): an entity's name and its other aliases."""
    every = F.array_distinct(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>"))))
    return entities.select("name", F.explode(every).alias("surface"))


def lookup(entities: DataFrame, order: str) -> DataFrame:
    """(surface, name): whom a lower-cased name or alias stands for; later entities win."""
    rows = entities.select(order, "name", F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("surface"))
    return rows.groupBy(F.lower("surface").alias("surface")).agg(F.max_by("name", order).alias("name"))


def match_entities(queries: DataFrame, surface_vectors: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, name, match_score) from (surface_id, name, vector): the k nearest surfaces, best one per entity."""
    hits = dense_search(surface_vectors, queries, k, "surface_id", "vector")
    named = hits.join(surface_vectors.select(F.col("surface_id").alias("doc_id"), "name"), "doc_id")
    return named.groupBy("query_id", "name").agg(F.max("score").alias("match_score"))


def passage_scores(matches: DataFrame, entities: DataFrame, edges: DataFrame, hop: float = HOP_WEIGHT) -> DataFrame:
    """(query_id, passage_id, score, reason): an entity's own passages count in full, its edges' by confidence and ``hop``."""
    own = matches.join(entities.select("name", "passage_ids"), "name").select(
        "query_id", F.explode("passage_ids").alias("passage_id"), F.col("match_score").alias("score"), F.concat(F.lit("entity:"), F.col("name")).alias("reason")
    )
    walk = F.concat(F.col("name"), F.lit("--"), F.col("relation"), F.lit("-->"), F.col("neighbour"))
    near = matches.join(edges, "name").select(
        "query_id", F.explode("passage_ids").alias("passage_id"), (F.col("match_score") * F.col("confidence") * hop).alias("score"), walk.alias("reason")
    )
    rows = own.unionByName(near).groupBy("query_id", "passage_id", "reason").agg(F.sum("score").alias("score"))
    return rows.groupBy("query_id", "passage_id").agg(F.sum("score").alias("score"), F.array_join(F.array_sort(F.collect_set("reason")), "; ").alias("reason"))


def expand(matches: DataFrame, entities: DataFrame, edges: DataFrame, passages: DataFrame, k: int = 5, most: int = 10, hop: float = HOP_WEIGHT) -> DataFrame:
    """(query_id, passage_id, content, score, reason, position): the best ``most`` by score, known ones, then the first k."""
    scores = passage_scores(matches, entities, edges, hop)
    best = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), "passage_id")
    scores = scores.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= most)
    known = scores.join(passages.select("passage_id", "content"), "passage_id")
    place = Window.partitionBy("query_id").orderBy("nth")
    return known.withColumn("position", F.row_number().over(place)).where(F.col("position") <= k).drop("nth")
