"""Dense and sparse retrieval over ordinary tables, and how their results are joined."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwork.functions.text import tokens
from loomwork.operators.durable import materialise

K1, B, FLOOR = 1.5, 0.75, 0.25
RRF_K = 60
#: Queries whose vectors are broadcast at once.
QUERY_BLOCK = 4096


@dataclass
class SparseIndex:
    """``postings``: (doc_id, dl, term, tf), one row for each document and term; ``terms``: (term, idf, avg_dl, k1, b).

    A query is two joins and a sum. Both tables are written once when the index is built.
    """

    postings: DataFrame
    terms: DataFrame

    @classmethod
    def build(cls, docs: DataFrame, key: str, text: str, k1: float = K1, b: float = B, floor: float = FLOOR) -> SparseIndex:
        """Okapi BM25. A term in more than half of the documents has a negative idf, which becomes ``floor`` times the mean."""
        rows = docs.select(F.col(key).alias("doc_id"), tokens(F.coalesce(F.col(text), F.lit(""))).alias("words"))
        # the null word stands for the document itself, so that texts are cut once and empty ones count
        words = F.concat("words", F.array(F.lit(None).cast("string")))
        rows = rows.select("doc_id", F.size("words").alias("dl"), F.explode(words).alias("term"))
        postings = materialise(rows.groupBy("doc_id", "dl", "term").agg(F.count("*").alias("tf")), "postings")
        stats = postings.where("term is null").agg(F.sum("tf").alias("n_docs"), (F.sum(F.col("dl") * F.col("tf")) / F.sum("tf")).alias("avg_dl"))
        postings = postings.where("term is not null")
        terms = postings.groupBy("term").agg(F.count("*").alias("df")).crossJoin(F.broadcast(stats))
        terms = terms.withColumn("raw", F.ln(F.col("n_docs") - F.col("df") + 0.5) - F.ln(F.col("df") + 0.5))
        terms = materialise(terms.select("term", "raw", "avg_dl"), "terms")
        mean = terms.agg(F.avg("raw").alias("mean_raw"))
        idf = F.when(F.col("raw") < 0, F.col("mean_raw") * floor).otherwise(F.col("raw"))
        terms = terms.crossJoin(F.broadcast(mean)).select("term", idf.alias("idf"), "avg_dl", F.lit(k1).alias("k1"), F.lit(b).alias("b"))
        return cls(postings, terms)

    @staticmethod
    def _weight() -> Column:
        length = 1 - F.col("b") + F.col("b") * F.col("dl") / F.col("avg_dl")
        return F.col("idf") * F.col("tf") * (F.col("k1") + 1) / (F.col("tf") + F.col("k1") * length)

    @property
    def weights(self) -> DataFrame:
        """(doc_id, term, weight) of the whole index."""
        return self.postings.join(self.terms, "term").select("doc_id", "term", self._weight().alias("weight"))

    def search(self, queries: DataFrame, key: str, text: str, k: int) -> DataFrame:
        """(query_id, doc_id, score, rank): the k best of score above 0; a word said twice counts twice.

        What the queries do not ask for is left out before anything is weighted.
        """
        asked = queries.select(F.col(key).alias("query_id"), F.explode(tokens(F.col(text))).alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("times"))
        asked = materialise(asked, "asked")
        known = self.terms.join(asked.select("term").distinct(), "term", "left_semi")
        wanted = self.postings.join(known, "term").select("doc_id", "term", self._weight().alias("weight"))
        scores = wanted.join(asked, "term").groupBy("query_id", "doc_id").agg(F.sum(F.col("weight") * F.col("times")).alias("score"))
        return top_k(scores.where("score > 0"), k)


def top_k(scores: DataFrame, k: int, by: tuple[str, ...] = ("query_id",), score: str = "score", tie: str = "doc_id") -> DataFrame:
    """The k best of each group; equal scores, to nine decimals, in the order of ``tie``."""
    w = Window.partitionBy(*by).orderBy(F.round(score, 9).desc(), F.col(tie))
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def inner_product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def dense_search(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, doc_id, score, rank): exact largest inner products of (query_id, query_vector) with all vectors.

    A stated set of queries against all rows: a nested-loop join that streams the vectors past the queries, QUERY_BLOCK
    of them, about, at a time, so that what is broadcast is bounded; the k best are cut per task before anything is
    shuffled.
    """
    asked = queries.select("query_id", "query_vector")
    n = asked.count()
    blocks = max(1, -(-n // QUERY_BLOCK))

    def one(block: DataFrame) -> DataFrame:
        pairs = vectors.select(F.col(key).alias("doc_id"), F.col(vector).alias("v")).crossJoin(F.broadcast(block))
        return top_k(pairs.select("query_id", "doc_id", inner_product(F.col("v"), F.col("query_vector")).alias("score")), k)

    if blocks == 1:
        return one(asked)
    asked = materialise(asked, "asked-vectors")
    out = one(asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == 0))
    for i in range(1, blocks):
        out = out.unionByName(one(asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == i)))
    return out


def fuse(dense: DataFrame, sparse: DataFrame, k: int = RRF_K) -> DataFrame:
    """Reciprocal rank fusion: (query_id, doc_id, score, dense_rank, sparse_rank)."""
    both = dense.select("query_id", "doc_id", F.col("rank").alias("dense_rank"), F.lit(None).cast("int").alias("sparse_rank")).unionByName(
        sparse.select("query_id", "doc_id", F.lit(None).cast("int").alias("dense_rank"), F.col("rank").alias("sparse_rank"))
    )
    fused = both.groupBy("query_id", "doc_id").agg(F.min("dense_rank").alias("dense_rank"), F.min("sparse_rank").alias("sparse_rank"))
    part = lambda r: F.coalesce(1.0 / (k + F.col(r)), F.lit(0.0))
    return fused.withColumn("score", F.round(part("dense_rank") + part("sparse_rank"), 4))


def ranked(fused: DataFrame, k: int | None = None, threshold: float = 0.0) -> DataFrame:
    """Fused hits in order: by score, then by dense rank, then by sparse rank."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("dense_rank"), F.asc_nulls_last("sparse_rank"), "doc_id")
    out = fused.where(F.round("score", 4) >= threshold).withColumn("position", F.row_number().over(w))
    return out.where(F.col("position") <= k) if k else out


def rerank(hits: DataFrame, k: int, scorer: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The k best of hits with a position, by an injected scorer that adds ``rerank_score``; 1 / position without one.

    Queries with k hits or fewer keep their order and score.
    """
    n = F.count("*").over(Window.partitionBy("query_id"))
    scored = scorer(hits) if scorer else hits.withColumn("rerank_score", F.lit(None).cast("double"))
    # what a scorer leaves without a score, as it does where it fails, has 1 / position
    scored = scored.withColumn("rerank_score", F.coalesce("rerank_score", 1.0 / F.col("position")))
    scored = scored.withColumn("hits", n).withColumn("final_score", F.when(F.col("hits") > k, F.col("rerank_score")).otherwise(F.col("score")))
    best = F.when(F.col("hits") > k, F.col("rerank_score"))
    w = Window.partitionBy("query_id").orderBy(best.desc_nulls_last(), "position")
    return scored.withColumn("position", F.row_number().over(w)).where(F.col("position") <= k).drop("hits", "rerank_score")


def retrieve(queries: DataFrame, vectors: DataFrame, index: SparseIndex, k: int = 5, threshold: float = 0.0, reranker: Callable[[DataFrame], DataFrame] | None = None, most: int = 25) -> DataFrame:
    """Hybrid retrieval of (query_id, text, query_vector): both legs, fusion, threshold, reranking."""
    candidates = min(4 * k, most) if reranker else 2 * k
    fused = fuse(dense_search(vectors, queries, candidates), index.search(queries, "query_id", "text", candidates))
    hits = ranked(fused, None if reranker else k, threshold)
    return rerank(hits, k, reranker) if reranker else hits


def merge(base: DataFrame, graph: DataFrame, k: int, boost: float = 1.2, prefix: int = 100) -> DataFrame:
    """Graph hits (boosted) and base hits of (query_id, content, score, position), one for each beginning of content.

    Graph hits come first among equals; the k best by score stay, equal scores in that order.
    """
    rows = graph.select("query_id", "content", (F.col("score") * boost).alias("score"), F.lit(0).alias("leg"), "position").unionByName(
        base.select("query_id", "content", "score", F.lit(1).alias("leg"), "position")
    )
    start = F.substring("content", 1, prefix)
    first = Window.partitionBy("query_id", start).orderBy("leg", "position")
    rows = rows.withColumn("nth", F.row_number().over(first)).where("nth = 1").drop("nth")
    best = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), "leg", "position")
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def unified(
    queries: DataFrame, vectors: DataFrame, index: SparseIndex, passages: DataFrame, expanded: DataFrame | None = None, k: int = 5, threshold: float = 0.0,
    reranker: Callable[[DataFrame], DataFrame] | None = None, needles: tuple[str | None, ...] = (),
) -> DataFrame:
    """(query_id, content, score, rank) for all of (query_id, text, query_vector) at once: hybrid hits, merged with the
    graph's where ``expanded`` (query_id, content, score, position) has any for the query, then only what holds every
    needle, say a crop and a region.

    ``passages``: (doc_id, content). Queries without graph hits keep their hybrid hits as they are.
    """
    hits = retrieve(queries, vectors, index, k, threshold, reranker)
    score = F.col("final_score") if reranker else F.col("score")
    base = hits.withColumn("s", score).join(passages.select("doc_id", "content"), "doc_id").select("query_id", "content", F.col("s").alias("score"), "position")
    if expanded is None:
        out = base.withColumnRenamed("position", "rank")
    else:
        met = expanded.select("query_id").distinct()
        merged = merge(base.join(met, "query_id", "left_semi"), expanded, k).select("query_id", "content", "score", "rank")
        alone = base.join(met, "query_id", "left_anti").select("query_id", "content", "score", F.col("position").alias("rank"))
        out = merged.unionByName(alone)
    return holding(out, "content", *needles)


def holding(hits: DataFrame, content: str = "content", *needles: str | None) -> DataFrame:
    """Hits whose content holds every given text, whatever the case."""
    for needle in needles:
        if needle:
            hits = hits.where(F.contains(F.lower(content), F.lit(needle.lower())))
    return hits
