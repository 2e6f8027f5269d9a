"""The registered queries over whole tables, each with its DuckDB equivalent where SQL can express it.

Stand-ins: documents are articles and passages, embeddings vectors, conversations chains (a turn is a step), suppliers
and parts entities, line items relations, events stage outcomes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions import chains, lexicons, markup, parsing, schemas, text
from loomwork.operators import chain_ops, chunking, comparison, graph, retrieval

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
#: Test prose is invented, so word gates use its own words.
WORDS = ("the", "ing", "ation", "ment", "heat", "tea", "eau", "keit")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


# ---------------------------------------------------------------- retrieval

BM25 = """
docs AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\\s+'), lambda w: w <> '') AS words FROM documents),
sized AS (SELECT doc_id, words, len(words) AS dl FROM docs),
stats AS (SELECT count(*) AS n_docs, avg(dl) AS avg_dl FROM sized),
postings AS (SELECT doc_id, dl, term, count(*) AS tf FROM (SELECT doc_id, dl, unnest(words) AS term FROM sized) GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM postings GROUP BY term),
raws AS (SELECT term, ln(n_docs - df + 0.5) - ln(df + 0.5) AS raw FROM dfs, stats),
idfs AS (SELECT term, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM raws) ELSE raw END AS idf FROM raws),
asked AS (SELECT item_id AS query_id, term, count(*) AS times FROM (
  SELECT item_id, unnest(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\\s+'), lambda w: w <> '')) AS term FROM benchmark) GROUP BY ALL),
sparse_scores AS (
  SELECT query_id, doc_id, sum(times * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avg_dl))) AS score
  FROM postings JOIN idfs USING (term) JOIN asked USING (term), stats GROUP BY query_id, doc_id
)"""


def _benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _vector_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A benchmark item asks with its text and with the vector of its number."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    return _benchmark_queries(spark, sf_dir).join(vectors, "query_id")


@query(f"""WITH {BM25}
SELECT query_id, doc_id, round(score, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM sparse_scores WHERE score > 0
) WHERE rank <= 5""")
def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = retrieval.SparseIndex.build(table(spark, sf_dir, "documents"), "doc_id", "text")
    hits = index.search(_benchmark_queries(spark, sf_dir), "query_id", "text", 5)
    return hits.select("query_id", "doc_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query("""SELECT query_id, doc_id, round(score, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM (
    SELECT q.vec_id AS query_id, v.vec_id AS doc_id, list_inner_product(v.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS score
    FROM embeddings q, embeddings v WHERE q.vec_id % 50 = 0)
) WHERE rank <= 5""")
def dense_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    asked = vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    hits = retrieval.dense_search(vectors, asked, 5)
    return hits.select("query_id", "doc_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


HYBRID = f"""{BM25},
queries AS (SELECT b.item_id AS query_id, e.embedding::DOUBLE[] AS q FROM benchmark b JOIN embeddings e ON b.item_id = e.vec_id),
dense AS (SELECT * FROM (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS dense_rank FROM (
  SELECT query_id, vec_id AS doc_id, list_inner_product(embedding::DOUBLE[], q) AS score FROM embeddings, queries)) WHERE dense_rank <= 10),
sparse AS (SELECT * FROM (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS sparse_rank
  FROM sparse_scores WHERE score > 0 AND query_id IN (SELECT query_id FROM queries)) WHERE sparse_rank <= 10),
fused AS (SELECT coalesce(d.query_id, s.query_id) AS query_id, coalesce(d.doc_id, s.doc_id) AS doc_id, dense_rank, sparse_rank,
    round(coalesce(1.0::DOUBLE / (60 + dense_rank), 0) + coalesce(1.0::DOUBLE / (60 + sparse_rank), 0), 4) AS score
  FROM dense d FULL JOIN sparse s ON d.query_id = s.query_id AND d.doc_id = s.doc_id),
hybrid AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, dense_rank NULLS LAST, sparse_rank NULLS LAST, doc_id) AS position FROM fused)
  WHERE position <= 5)"""


def _hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = retrieval.SparseIndex.build(table(spark, sf_dir, "documents"), "doc_id", "text")
    return retrieval.retrieve(_vector_queries(spark, sf_dir), table(spark, sf_dir, "embeddings"), index, 5)


@query(f"WITH {HYBRID} SELECT query_id, doc_id, score, position FROM hybrid")
def rrf_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hybrid(spark, sf_dir).select("query_id", "doc_id", "score", F.col("position").cast("long").alias("position"))


@query(f"""WITH {HYBRID}, candidates AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, dense_rank NULLS LAST, sparse_rank NULLS LAST, doc_id) AS place,
    count(*) OVER (PARTITION BY query_id) AS n FROM fused))
SELECT query_id, doc_id, CASE WHEN n > 5 THEN round(1.0::DOUBLE / place, 6) ELSE score END AS final_score, place AS position FROM candidates WHERE place <= 5""")
def rerank_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = retrieval.SparseIndex.build(table(spark, sf_dir, "documents"), "doc_id", "text")
    asked, vectors = _vector_queries(spark, sf_dir), table(spark, sf_dir, "embeddings")
    fused = retrieval.fuse(retrieval.dense_search(vectors, asked, 10), index.search(asked, "query_id", "text", 10))
    hits = retrieval.rerank(retrieval.ranked(fused), 5)
    return hits.select("query_id", "doc_id", F.round("final_score", 6).alias("final_score"), F.col("position").cast("long").alias("position"))


GRAPH = """
suppliers AS (SELECT s_suppkey, s_name AS name, 'src' || (s_suppkey % 20) AS own FROM supplier),
surface AS (SELECT s_suppkey AS surface_id, name, embedding::DOUBLE[] AS v FROM suppliers JOIN embeddings ON s_suppkey = vec_id),
asked_v AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id % 50 = 0),
matched AS (SELECT query_id, name, max(score) AS match_score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, surface_id) AS r FROM (
    SELECT query_id, surface_id, name, list_inner_product(v, q) AS score FROM surface, asked_v)) WHERE r <= 5 GROUP BY query_id, name),
relations AS (SELECT s_name AS source, p_name AS target, CASE l_returnflag WHEN 'A' THEN 'affects' WHEN 'N' THEN 'requires' ELSE 'found_in' END AS relation,
    max(1 - l_discount) AS confidence, list_sort(list_distinct(list('order_' || l_orderkey))) AS evidence
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY ALL),
edges AS (SELECT source AS name, relation, target AS neighbour, confidence, evidence FROM relations
  UNION ALL SELECT target, relation || '_rev', source, confidence, evidence FROM relations)"""


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as entities: number, name, type, aliases, description, and a source as passage."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        "s_suppkey",
        F.col("s_name").alias("name"),
        F.lit("practice").alias("type"),
        F.array(F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))).alias("aliases"),
        F.concat(F.lit("balance "), F.round("s_acctbal").cast("long").cast("string")).alias("description"),
        F.array(F.concat(F.lit("src"), (F.col("s_suppkey") % 20).cast("string"))).alias("passage_ids"),
    )


def _relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("source"))
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("target"))
    kind = F.when(F.col("l_returnflag") == "A", "affects").when(F.col("l_returnflag") == "N", "requires").otherwise("found_in")
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", kind.alias("relation"), (1 - F.col("l_discount")).alias("confidence"), F.array(F.concat(F.lit("order_"), F.col("l_orderkey").cast("string"))).alias("evidence_passage_ids"))
    return items.join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(p, F.col("l_partkey") == F.col("p_partkey")).select("source", "target", "relation", "confidence", "evidence_passage_ids")


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    known = _suppliers(spark, sf_dir).join(vectors, F.col("s_suppkey") == F.col("vec_id"))
    known = known.select(F.col("s_suppkey").alias("surface_id"), "name", F.col("embedding").alias("vector"))
    asked = vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    return graph.match_entities(asked, known, 5)


PASSAGES = """passages AS (
  SELECT 'order_' || o_orderkey AS passage_id, 'order of customer ' || o_custkey AS content FROM orders
  UNION ALL SELECT source, min(text) FROM documents WHERE source IS NOT NULL GROUP BY source)"""
EXPANDED = f"""{GRAPH}, {PASSAGES}, reasons AS (
  SELECT query_id, passage_id, reason, sum(score) AS score FROM (
    SELECT query_id, own AS passage_id, match_score AS score, 'entity:' || name AS reason FROM matched JOIN suppliers USING (name)
    UNION ALL
    SELECT query_id, unnest(evidence), match_score * confidence * 0.5, name || '--' || relation || '-->' || neighbour FROM matched JOIN edges USING (name)
  ) GROUP BY ALL
), scored AS (SELECT query_id, passage_id, sum(score) AS score, array_to_string(list_sort(list(reason)), '; ') AS reason FROM reasons GROUP BY query_id, passage_id),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, passage_id) AS nth FROM scored) WHERE nth <= 10),
expanded AS (SELECT * FROM (SELECT b.query_id, b.passage_id, p.content, b.score, b.reason, row_number() OVER (PARTITION BY query_id ORDER BY nth) AS position
  FROM best b JOIN passages p USING (passage_id)) WHERE position <= 5)"""


def _expanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.concat(F.lit("order_"), F.col("o_orderkey").cast("string")).alias("passage_id"), F.concat(F.lit("order of customer "), F.col("o_custkey").cast("string")).alias("content"))
    sources = table(spark, sf_dir, "documents").where("source is not null").groupBy(F.col("source").alias("passage_id")).agg(F.min("text").alias("content"))
    edges = graph.adjacency(graph.merge_relations(_relations(spark, sf_dir)))
    return graph.expand(_matches(spark, sf_dir), _suppliers(spark, sf_dir), edges, orders.unionByName(sources))


@query(f"WITH {EXPANDED} SELECT query_id, passage_id, md5(content) AS content_md5, round(score, 6) AS score, reason, position FROM expanded")
def graph_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _expanded(spark, sf_dir)
    return rows.select("query_id", "passage_id", F.md5(F.col("content").cast("binary")).alias("content_md5"), F.round("score", 6).alias("score"), "reason", F.col("position").cast("long").alias("position"))


@query(f"WITH {GRAPH} SELECT query_id, name, round(match_score, 6) AS match_score FROM matched")
def entity_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matches(spark, sf_dir).select("query_id", "name", F.round("match_score", 6).alias("match_score"))


@query(f"""WITH {EXPANDED}, base AS (
  SELECT query_id, content, score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS position FROM (
    SELECT a.query_id, d.doc_id, d.text AS content, list_inner_product(e.embedding::DOUBLE[], a.q) AS score
    FROM asked_v a, embeddings e JOIN documents d ON e.vec_id = d.doc_id)
), both_legs AS (
  SELECT query_id, content, score * 1.2 AS score, 0 AS leg, position FROM expanded
  UNION ALL SELECT query_id, content, score, 1, position FROM base WHERE position <= 5
), firsts AS (SELECT *, row_number() OVER (PARTITION BY query_id, substr(content, 1, 100) ORDER BY leg, position) AS nth FROM both_legs)
SELECT query_id, md5(content) AS content_md5, round(score, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, leg, position) AS rank FROM firsts WHERE nth = 1) WHERE rank <= 5""")
def merge_boost_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    asked = vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    hits = retrieval.dense_search(vectors.join(docs.select(F.col("doc_id").alias("vec_id")), "vec_id", "left_semi"), asked, 5)
    base = hits.join(docs, "doc_id").select("query_id", "content", "score", F.col("rank").alias("position"))
    rows = retrieval.merge(base, _expanded(spark, sf_dir), 5)
    return rows.select("query_id", F.md5(F.col("content").cast("binary")).alias("content_md5"), F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


# ---------------------------------------------------------------- graph building


@query("""WITH raw AS (
  SELECT p_brand AS name, p_type AS type, [p_name] AS aliases, p_type || ' of size ' || p_size AS description, ['part_' || p_partkey] AS passage_ids, p_partkey AS ord FROM part)
SELECT name, arg_min(type, ord) AS type, list_sort(list_distinct(flatten(list(aliases)))) AS aliases,
  arg_max(description, (len(description), -ord)) AS description, list_sort(list_distinct(flatten(list(passage_ids)))) AS passage_ids,
  'entity_' || (row_number() OVER (ORDER BY name) - 1) AS id FROM raw GROUP BY name""")
def entity_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    raw = p.select(
        F.col("p_brand").alias("name"),
        F.col("p_type").alias("type"),
        F.array("p_name").alias("aliases"),
        F.concat(F.col("p_type"), F.lit(" of size "), F.col("p_size").cast("string")).alias("description"),
        F.array(F.concat(F.lit("part_"), F.col("p_partkey").cast("string"))).alias("passage_ids"),
        F.col("p_partkey").alias("ord"),
    )
    return graph.merge_entities(raw, "ord")


@query(f"WITH {GRAPH} SELECT source, target, relation, round(confidence, 6) AS confidence, evidence AS evidence_passage_ids FROM relations")
def relation_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.merge_relations(_relations(spark, sf_dir)).withColumn("confidence", F.round("confidence", 6))


@query(f"""WITH {GRAPH} SELECT e.name, e.relation, e.neighbour, round(e.confidence, 6) AS confidence, len(e.evidence) AS n_passages, CASE WHEN s.name IS NULL THEN NULL ELSE 'practice' END AS neighbour_type
FROM edges e LEFT JOIN suppliers s ON e.neighbour = s.name""")
def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = graph.adjacency(graph.merge_relations(_relations(spark, sf_dir)))
    rows = graph.neighbours(edges, edges.select("name").distinct(), _suppliers(spark, sf_dir))
    return rows.select("name", "relation", "neighbour", F.round("confidence", 6).alias("confidence"), F.size("passage_ids").cast("long").alias("n_passages"), "neighbour_type")


@query("""SELECT surface, arg_max(name, ord) AS name FROM (
  SELECT lower(unnest([s_name, 's' || s_suppkey])) AS surface, s_name AS name, s_suppkey AS ord FROM supplier) GROUP BY surface""")
def entity_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.lookup(_suppliers(spark, sf_dir), "s_suppkey")


# ---------------------------------------------------------------- text metrics

#: The same patterns for DuckDB, whose \\b knows ASCII only: a boundary is what no letter, digit or underscore touches.
BOUND = "[\\p{L}\\p{N}\\p{M}_]"


def _count(pattern: str, flags: str = "i", column: str = "text") -> str:
    return f"len(regexp_extract_all({column}, '{pattern}', 0, '{flags}'))"


def _bare(pattern: str) -> str:
    """The alternatives of a \\b(?:...)\\b pattern."""
    return pattern.replace("(?i)", "").removeprefix(r"\b(?:").removesuffix(r")\b").replace("'", "''")


def _words(pattern: str, column: str = "text") -> str:
    """Occurrences of whole words: neighbours are doubled apart first, as RE2 has no look-around."""
    spaced = f"regexp_replace({column}, '([^\\p{{L}}\\p{{N}}\\p{{M}}_])', '\\1\\1', 'g')"
    return f"len(regexp_extract_all(' ' || {spaced} || ' ', '[^\\p{{L}}\\p{{N}}\\p{{M}}_](?:{_bare(pattern)})[^\\p{{L}}\\p{{N}}\\p{{M}}_]', 0, 'i'))"


METRICS_SQL = f"""
  len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) AS word_count,
  greatest(1, len(regexp_extract_all(text, '[.!?]+(?:\\s|$)'))) AS sentence_count,
  round(least(1.0, ({" + ".join(_count(p.replace("(?i)", "")) for p in lexicons.EVIDENCE)}) / 5.0), 3) AS evidence"""


@query(f"""SELECT doc_id, word_count::INTEGER AS word_count, sentence_count::INTEGER AS sentence_count, round(word_count::DOUBLE / sentence_count, 1) AS avg_sent_len, evidence::DOUBLE AS evidence
FROM (SELECT doc_id, {METRICS_SQL} FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents))""")
def text_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = text.score_text(F.col("text"))
    names = ("word_count", "sentence_count", "avg_sent_len", "evidence")
    return table(spark, sf_dir, "documents").select("doc_id", *[scores[m].alias(m) for m in names])


@query(f"""SELECT doc_id, round(least(1.0, {_words(lexicons.IMPERATIVES)} / 15.0), 3)::DOUBLE AS actionability, round(least(1.0, {_words(lexicons.CONNECTIVES)} / 8.0), 3)::DOUBLE AS coherence,
round(least(1.0, (3 * {_count("^#{1,3}[ \\t\\n\\f\\r\\v]", "m")} + {_count("^\\s*[0-9]+[\\.\\)]\\s", "m")} + {_count("^\\s*[-*•]\\s", "m")} + {_count("\\*\\*[^*]+\\*\\*", "c")}) / 15.0), 3)::DOUBLE AS structure
FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)""")
def text_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = text.score_text(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", *[scores[m].alias(m) for m in ("actionability", "coherence", "structure")])


#: Latin letters beyond ASCII become underscores, so that RE2's ASCII \\b falls where Unicode's does.
LATIN = "regexp_replace({0}, '[À-ɏ]', '_', 'g')"


def _found(column: str, pattern: str, flags: str = "c", group: int = 0) -> str:
    plain = pattern.replace("(?i)", "").replace("'", "''")
    return f"regexp_extract_all({LATIN.format(column)}, '{plain}', {group}, '{flags}')"


def _specificity_sql(c: str) -> str:
    numbers = f"len({_found(c, lexicons.UNIT_NUMBERS, 'i')}) + len({_found(c, lexicons.BARE_NUMBERS)})"
    tokens = f"string_split(replace({LATIN.format(c)}, chr(10), chr(10)), ' ')"
    caps = (
        f"len(list_filter(list_zip({tokens}[2:], {tokens}[:-2]), lambda p: regexp_matches(p[1], '^[A-Z][a-z]+([^A-Za-z0-9_]|$)') "
        f"AND regexp_matches(p[2], '[a-z.]$')))"
    )
    return f"round(least(1.0, (2 * ({numbers}) + {caps} + 3 * len({_found(c, lexicons.TECHNICAL)})) / 20.0), 3)::DOUBLE"


def _coverage_sql(c: str, q: str) -> str:
    found = f"list_concat({_found(q, lexicons.LOCATIONS, 'c', 1)}, list_concat({_found(f'lower({q})', lexicons.PRACTICES)}, list_concat({_found(f'lower({q})', lexicons.CROPS)}, list_concat({_found(f'lower({q})', lexicons.CONDITIONS)}, {_found(q, chr(92) + 'b' + chr(92) + 'd+' + chr(92) + 'b')}))))"
    return f"CASE WHEN len({found}) = 0 THEN 0.5 ELSE len(list_filter({found}, lambda x: contains(lower({c}), lower(x))))::DOUBLE / len({found}) END"


def _metrics_sql(c: str, q: str) -> str:
    """All metrics of a text, as columns."""
    words = f"len(list_filter(regexp_split_to_array({c}, '\\s+'), lambda w: w <> ''))"
    sentences = f"greatest(1, len(regexp_extract_all({c}, '[.!?]+(?:\\s|$)')))"
    proof = " + ".join(_count(p.replace("(?i)", ""), "i", c) for p in lexicons.EVIDENCE)
    lines = f"3 * {_count('^#{1,3}[ ' + chr(92) + 't' + chr(92) + 'n' + chr(92) + 'f' + chr(92) + 'r' + chr(92) + 'v]', 'm', c)} + {_count('^' + chr(92) + 's*[0-9]+[' + chr(92) + '.' + chr(92) + ')]' + chr(92) + 's', 'm', c)} + {_count('^' + chr(92) + 's*[-*•]' + chr(92) + 's', 'm', c)} + {_count(lexicons.BOLD, 'c', c)}"
    return f"""{words} AS word_count, {sentences} AS sentence_count, round({words}::DOUBLE / {sentences}, 1) AS avg_sent_len,
  {_specificity_sql(c)} AS specificity, round(least(1.0, ({proof}) / 5.0), 3)::DOUBLE AS evidence,
  round(least(1.0, {_words(lexicons.IMPERATIVES, c)} / 15.0), 3)::DOUBLE AS actionability, round(least(1.0, {_words(lexicons.CONNECTIVES, c)} / 8.0), 3)::DOUBLE AS coherence,
  round(least(1.0, ({lines}) / 15.0), 3)::DOUBLE AS structure, CASE WHEN {q} = '' THEN 0 ELSE round({_coverage_sql(c, q)}, 3) END::DOUBLE AS constraint_coverage"""


@query(f"SELECT doc_id, {_specificity_sql('text')} AS specificity FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)")
def specificity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.round(text.specificity(F.col("text")), 3).alias("specificity"))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation's first text asks, its last answers, all of them together are the enhanced answer."""
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.min_by("text", "turn").alias("question"), F.max_by("text", "turn").alias("answer"), F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("all")
    )
    whole = F.array_join(F.transform("all", lambda t: F.coalesce(t["text"], F.lit(""))), " ")
    turns = turns.withColumn("whole", whole)
    original = turns.select("question", F.col("answer").alias("text"), F.col("conv_id").alias("ord"))
    return comparison.pair(turns.select("question", F.col("whole").alias("text")), original, "ord")


PAIRS = """turns AS (
  SELECT conv_id, arg_min(text, turn) AS question, arg_max(text, turn) AS answer, array_to_string(list(coalesce(text, '') ORDER BY turn), ' ') AS whole FROM conversations GROUP BY conv_id),
originals AS (SELECT trim(question, ' ') AS key, arg_max(answer, conv_id) AS original_text FROM turns GROUP BY 1),
pairs AS (SELECT t.question, t.whole AS enhanced_text, o.original_text FROM turns t JOIN originals o ON trim(t.question, ' ') = o.key)"""


@query(f"""WITH {PAIRS} SELECT md5(question) AS question_md5, md5(enhanced_text) AS enhanced_md5, md5(original_text) AS original_md5,
  len(list_filter(regexp_split_to_array(enhanced_text, '\\s+'), lambda w: w <> ''))::INTEGER AS enhanced_words,
  len(list_filter(regexp_split_to_array(original_text, '\\s+'), lambda w: w <> ''))::INTEGER AS original_words FROM pairs""")
def paired_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    md5 = lambda c: F.md5(F.col(c).cast("binary"))
    return _pairs(spark, sf_dir).select(
        md5("question").alias("question_md5"),
        md5("enhanced_text").alias("enhanced_md5"),
        md5("original_text").alias("original_md5"),
        text.word_count(F.col("enhanced_text")).alias("enhanced_words"),
        text.word_count(F.col("original_text")).alias("original_words"),
    )


WEIGHTED = "round(" + " + ".join(f"{w} * {m}" for m, w in lexicons.COMPARISON_WEIGHTS.items()) + ", 3)"
SCORED = f"""{PAIRS}, after_scores AS (SELECT row_number() OVER () AS id, {_metrics_sql('enhanced_text', 'question')}, original_text, question FROM pairs),
before_scores AS (SELECT id AS before_id, {_metrics_sql('original_text', 'question')} FROM after_scores),
after_all AS (SELECT *, {WEIGHTED} AS overall FROM after_scores), before_all AS (SELECT *, {WEIGHTED} AS overall FROM before_scores)"""


@query(f"WITH {SCORED} " + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, round(avg(b.{m}), 6)::DOUBLE AS original_mean, round(avg(a.{m}), 6)::DOUBLE AS enhanced_mean, round(round(avg(a.{m}), 6) - round(avg(b.{m}), 6), 6)::DOUBLE AS delta FROM after_all a JOIN before_all b ON a.id = b.before_id"
    for m in (*comparison.METRICS, "overall")
))
def paired_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparison.means(comparison.scored(_pairs(spark, sf_dir)))


@query(f"""WITH {SCORED} SELECT count(*) FILTER (a.overall > b.overall) AS wins, count(*) FILTER (b.overall > a.overall) AS losses, count(*) FILTER (a.overall = b.overall) AS ties
FROM after_all a JOIN before_all b ON a.id = b.before_id""")
def win_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparison.win_counts(comparison.scored(_pairs(spark, sf_dir)))


@query(f"WITH {PAIRS} SELECT md5(question) AS question_md5, round({_coverage_sql('enhanced_text', 'question')}, 6)::DOUBLE AS coverage FROM pairs")
def constraint_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _pairs(spark, sf_dir)
    return rows.select(F.md5(F.col("question").cast("binary")).alias("question_md5"), F.round(text.constraint_coverage(F.col("enhanced_text"), F.col("question")), 6).alias("coverage"))


# ---------------------------------------------------------------- gates and lexicons


@query(f"""SELECT doc_id, len(list_filter({_list(WORDS)}, lambda k: contains(lower(coalesce(text, '')), k)))::INTEGER AS hits,
  len(list_filter({_list(WORDS)}, lambda k: contains(lower(coalesce(text, '')), k))) >= 3 AS relevant,
  len(list_filter({_list(sorted({k.lower() for k in lexicons.CONTENT_KEYWORDS}))}, lambda k: contains(lower(coalesce(text, '')), k)))::INTEGER AS topic_hits FROM documents""")
def keyword_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.col("text")
    lowered = sorted({k.lower() for k in lexicons.CONTENT_KEYWORDS})
    return table(spark, sf_dir, "documents").select("doc_id", text.keyword_hits(body, WORDS).alias("hits"), text.is_relevant(body, WORDS).alias("relevant"), text.keyword_hits(body, lowered).alias("topic_hits"))


@query(f"""SELECT p_partkey, len(list_filter({_list(lexicons.TITLE_KEYWORDS)}, lambda k: contains(lower(p_name), k))) > 0 AS title_ok,
  len(list_filter({_list(lexicons.CATEGORY_EXCLUDE)}, lambda k: contains(lower(p_type), k))) = 0 AND len(list_filter({_list(lexicons.CATEGORY_INCLUDE)}, lambda k: contains(lower(p_type), k))) > 0 AS category_ok FROM part""")
def title_category_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", text.is_topic_title(F.col("p_name")).alias("title_ok"), text.is_topic_category(F.col("p_type")).alias("category_ok"))


@query(f"SELECT doc_id, list_filter({_list(sorted(set(lexicons.ENTITY_LEXICON)))}, lambda t: contains(lower(coalesce(text, '')), t)) AS entities FROM documents")
def lexicon_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.extract_entities(F.col("text")).alias("entities"))


_REWRITE = "q"
for _p in lexicons.QUESTION_PREFIXES:
    _REWRITE = f"regexp_replace({_REWRITE}, '^{_p}', '', 'i')"


@query(f"""SELECT item_id, intent, md5(CASE WHEN intent = 'fact_check' THEN trim({_REWRITE}, ' ') ELSE q END) AS rewritten_md5
FROM (SELECT item_id, ['How ', 'what is ', 'Can ', ''][1 + item_id % 4] || text AS q, unnest(['background', 'fact_check', 'gap_fill']) AS intent FROM benchmark)""")
def query_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = F.array(*[F.lit(s) for s in ("How ", "what is ", "Can ", "")])
    rows = table(spark, sf_dir, "benchmark").select("item_id", F.concat(F.get(starts, (F.col("item_id") % 4).cast("int")), F.col("text")).alias("q"), F.explode(F.array(*map(F.lit, ("background", "fact_check", "gap_fill")))).alias("intent"))
    return rows.select("item_id", "intent", F.md5(text.rewrite_query(F.col("q"), F.col("intent")).cast("binary")).alias("rewritten_md5"))


# ---------------------------------------------------------------- markup and chunks


@query("""SELECT page_id, CASE WHEN len(t) >= 200 THEN md5(t) END AS text_md5, CASE WHEN len(t) >= 200 THEN len(t)::INTEGER END AS n FROM (
  SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'), ' ') AS t FROM pages)""")
def html_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", markup.strip_html(F.col("html")).alias("t"))
    return rows.select("page_id", F.md5(F.col("t").cast("binary")).alias("text_md5"), F.char_length("t").alias("n"))


@query("""SELECT page_id, 0 AS section, 'Main' AS title, md5(t) AS text_md5 FROM (
  SELECT page_id, html, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'), ' ') AS t FROM pages)
WHERE len(html) >= 500 AND len(t) >= 200 AND NOT regexp_matches(html, '<h[23]')""")
def html_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", F.posexplode(markup.html_sections(F.col("html"))).alias("n", "s"))
    return rows.select("page_id", F.col("n").alias("section"), "s.title", F.md5(F.col("s.text").cast("binary")).alias("text_md5"))


@query("""SELECT page_id, list_slice(list_transform(list_filter(list_zip(found, range(1, len(found) + 1)), lambda x: list_position(found, x[1]) = x[2]), lambda x: x[1]), 1, 50) AS links FROM (
  SELECT page_id, list_transform(list_filter(regexp_extract_all(html, 'href=["''](?:/)([^"'']+)', 1), lambda x: NOT starts_with(x, '#')), lambda x: replace(url_decode(replace(x, '+', '%2B')), '_', ' ')) AS found FROM pages)""")
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", markup.links(F.col("html"), prefix="/").alias("links"))


WIKI = r"""{{Infobox {{nested|x}} }}<!-- c -->'''Bold''' [[Category:X]] [[a b|shown]] [[plain]] [https://e.org site] <ref name="r">gone</ref>{| t |} &amp; &nbsp;"""


def _rules_sql(column: str, rules: list[tuple[str, str]]) -> str:
    for pattern, with_ in rules:
        column = f"regexp_replace({column}, '{pattern.replace(chr(39), chr(39) * 2)}', '{with_.replace('$', chr(92))}', 'g')"
    return f"regexp_replace({column}, '^\\s+|\\s+$', '', 'g')"


@query(f"""SELECT doc_id, md5({_rules_sql('m', markup.wikitext_rules())}) AS text_md5, md5({_rules_sql('m', markup.SIMPLE_RULES)}) AS simple_md5
FROM (SELECT doc_id, '{WIKI.replace(chr(39), chr(39) * 2)}' || chr(10) || '== ' || source || ' ==' || chr(10) || text AS m FROM documents)""")
def wikitext_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = F.concat(F.lit(WIKI), F.lit("\n== "), F.col("source"), F.lit(" ==\n"), F.col("text"))
    rows = table(spark, sf_dir, "documents").select("doc_id", markup.clean_wikitext(marked).alias("t"), markup.clean_wikitext_simple(marked).alias("s"))
    return rows.select("doc_id", F.md5(F.col("t").cast("binary")).alias("text_md5"), F.md5(F.col("s").cast("binary")).alias("simple_md5"))


@query("""SELECT doc_id, title, md5(body) AS text_md5 FROM (
  SELECT doc_id, 'Introduction' AS title, regexp_replace(t[1], '^\\s+|\\s+$', '', 'g') AS body FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS t FROM documents)
  UNION ALL SELECT doc_id, coalesce(source, ''), regexp_replace(array_to_string(t[2:], chr(10)), '^\\s+|\\s+$', '', 'g') FROM (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS t FROM documents)
) WHERE len(body) > 50""")
def section_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with a heading of its source put after its first line."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    marked = F.concat_ws("\n", F.slice(lines, 1, 1), F.array(F.concat(F.lit("== "), F.coalesce("source", F.lit("")), F.lit(" =="))), F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))))
    rows = chunking.split_sections(table(spark, sf_dir, "documents").select("doc_id", marked.alias("t")), "doc_id", "t")
    return rows.select("doc_id", "title", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query("""WITH parts AS (
  SELECT doc_id, string_split(replace(t, '. ', '.' || chr(10)), chr(10)) AS sentences, t, len(list_filter(regexp_split_to_array(t, '\\s+'), lambda w: w <> '')) AS n
  FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g') AS t FROM documents) WHERE t <> ''
), folded AS (
  SELECT doc_id, CASE WHEN n <= 60 THEN [t] ELSE list_append(f.done, f.open) END AS chunks FROM (
    SELECT doc_id, t, n, list_reduce(list_transform(sentences, lambda s: {'done': []::VARCHAR[], 'open': s, 'n': len(list_filter(regexp_split_to_array(s, '\\s+'), lambda w: w <> ''))}),
      lambda a, x: CASE WHEN a.open <> '' AND a.n + x.n > 60 THEN {'done': list_append(a.done, a.open), 'open': x.open, 'n': x.n}
        ELSE {'done': a.done, 'open': CASE WHEN a.open = '' THEN x.open ELSE a.open || ' ' || x.open END, 'n': a.n + x.n} END) AS f FROM parts)
), numbered AS (SELECT doc_id, chunks[i] AS chunk, i - 1 AS passage_index FROM (SELECT doc_id, chunks, unnest(range(1, len(chunks) + 1)) AS i FROM folded))
SELECT doc_id, passage_index::INTEGER AS passage_index, md5(chunk) AS text_md5, 'passage_' || (row_number() OVER (ORDER BY doc_id, passage_index) - 1) AS id
FROM numbered WHERE len(list_filter(regexp_split_to_array(chunk, '\\s+'), lambda w: w <> '')) >= 20""")
def chunk_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    section = F.array(F.struct(F.lit("Main").alias("title"), F.col("text").alias("text")))
    rows = chunking.chunk(table(spark, sf_dir, "documents"), "doc_id", section, least=20, most=60)
    return rows.select("doc_id", "passage_index", F.md5(F.col("text").cast("binary")).alias("text_md5"), "id")


@query("""WITH entries AS (SELECT source, doc_id, '[' || coalesce(lang, 'Main') || '] ' || substr(coalesce(text, ''), 1, 500) AS entry FROM documents),
running AS (SELECT *, sum(len(entry)) OVER (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM entries)
SELECT source, md5(array_to_string(list(entry ORDER BY doc_id), chr(10) || chr(10))) AS text_md5, count(*)::INTEGER AS n FROM running WHERE upto <= 6000 GROUP BY source""")
def budgeted_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chunking.budgeted_text(table(spark, sf_dir, "documents"), "source", "doc_id", F.col("lang"), F.col("text"))
    return rows.select("source", F.md5(F.col("text").cast("binary")).alias("text_md5"), "n")


@query("SELECT count(*) AS n, sum(len(text))::BIGINT AS chars, round(sum(len(text)) / 1048576.0, 6)::DOUBLE AS mb FROM documents")
def corpus_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    chars = F.sum(F.char_length("text"))
    return table(spark, sf_dir, "documents").agg(F.count("*").alias("n"), chars.alias("chars"), F.round(chars / 1048576.0, 6).alias("mb"))


# ---------------------------------------------------------------- chains

KINDS = ("context_setup", "knowledge_application", "causal_reasoning", "evidence_integration", "conclusion")
STEPS_SQL = f"""steps AS (SELECT conv_id, turn, coalesce(text, '') AS content,
  {_list(KINDS)}[1 + (turn + conv_id) % 5] AS type,
  CASE WHEN turn % 2 = 1 THEN substr(text, 1, 40) END AS evidence, ['high', 'medium', 'low'][1 + (conv_id + turn) % 3] AS confidence FROM conversations),
chains AS (SELECT conv_id, list(type ORDER BY turn) AS types, list(content ORDER BY turn) AS contents, list(coalesce(evidence, '') ORDER BY turn) AS evidences, list(confidence ORDER BY turn) AS confidences, count(*) AS n FROM steps GROUP BY conv_id)"""


def _chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, steps): a conversation's turns as typed steps."""
    kinds, sure = F.array(*map(F.lit, KINDS)), F.array(*map(F.lit, ("high", "medium", "low")))
    turns = table(spark, sf_dir, "conversations")
    step = F.struct(
        F.col("turn").cast("int").alias("step"),
        F.get(kinds, ((F.col("turn") + F.col("conv_id")) % 5).cast("int")).alias("type"),
        F.coalesce("text", F.lit("")).alias("content"),
        F.when(F.col("turn") % 2 == 1, F.substring("text", 1, 40)).alias("evidence"),
        F.get(sure, ((F.col("conv_id") + F.col("turn")) % 3).cast("int")).alias("confidence"),
    )
    return turns.select("conv_id", step.alias("s")).groupBy("conv_id").agg(F.sort_array(F.collect_list("s")).alias("steps"))


@query(f"""WITH {STEPS_SQL}, metrics AS (SELECT conv_id, n, types, evidences, confidences,
  0.2 * (list_contains(types, 'context_setup')::INT + list_contains(types, 'conclusion')::INT + (n BETWEEN 3 AND 7)::INT
    + (len(list_filter(contents, lambda c: len(regexp_replace(c, '^\\s+|\\s+$', '', 'g')) <= 20)) = 0)::INT + (types[-1] = 'conclusion')::INT) AS structure,
  len(list_filter(evidences, lambda e: e <> '')) / n::DOUBLE AS traceability,
  list_position(types, 'context_setup') AS ctx, list_position(types, 'conclusion') AS con,
  len(list_filter([list_position(types, 'knowledge_application'), list_position(types, 'causal_reasoning'), list_position(types, 'evidence_integration')], lambda p: p > 0 AND p < list_position(types, 'context_setup'))) = 0 AS ctx_first
  FROM chains)
SELECT conv_id, round(structure, 3)::DOUBLE AS structure, round(traceability, 3)::DOUBLE AS traceability,
  round(CASE WHEN n < 2 THEN 0 WHEN coalesce(ctx, 0) = 0 AND coalesce(con, 0) = 0 THEN 1
    ELSE ((coalesce(ctx, 0) > 0 AND ctx_first)::INT + (coalesce(con, 0) > 0 AND types[-1] = 'conclusion')::INT + (coalesce(con, 0) > 2)::INT)::DOUBLE / ((coalesce(ctx, 0) > 0)::INT + 2 * (coalesce(con, 0) > 0)::INT) END, 3)::DOUBLE AS step_order
FROM metrics""")
def chain_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = chains.auto_metrics(F.col("steps"))
    return _chains(spark, sf_dir).select("conv_id", *[scores[m].alias(m) for m in ("structure", "traceability", "step_order")])


@query(f"""WITH bare AS (SELECT doc_id, list_transform(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\\s+'), lambda w: w <> ''), lambda w: trim(w, '.,;:!?"''()[]{{}}')) AS words FROM documents)
SELECT doc_id, CASE WHEN len(words) = 0 THEN 0 ELSE round(len(list_filter(words, lambda w: NOT list_contains({_list(lexicons.FILLER_WORDS)}, w)))::DOUBLE / len(words), 3) END::DOUBLE AS density FROM bare""")
def info_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.round(chains.density(F.col("text")), 3).alias("density"))


@query(f"""WITH {STEPS_SQL}, scores AS (SELECT conv_id, n, conv_id % 20 AS item_id,
  round(0.3 * CASE WHEN n BETWEEN 3 AND 7 THEN 1.0 WHEN n < 3 THEN n / 3.0 ELSE greatest(0.5, 1.0 - (n - 7) * 0.1) END
  + 0.35 * len(list_filter(evidences, lambda e: e <> ''))::DOUBLE / n + 0.2 * len(list_distinct(types)) / 5.0 + 0.15 * len(list_filter(confidences, lambda c: c = 'high'))::DOUBLE / n, 9) AS score FROM chains)
SELECT item_id, conv_id AS candidate, round(score, 6)::DOUBLE AS candidate_score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, conv_id) AS nth FROM scores) WHERE nth = 1""")
def candidate_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _chains(spark, sf_dir).select((F.col("conv_id") % 20).alias("item_id"), F.col("conv_id").alias("candidate"), "steps")
    best = chain_ops.select_candidates(rows)
    return best.select("item_id", "candidate", F.round("candidate_score", 6).alias("candidate_score"))


@query(f"""WITH {STEPS_SQL}, judged AS (
  SELECT c.conv_id, ['easy', 'medium', 'hard'][1 + c.conv_id % 3] AS difficulty, coalesce(l.quality, 0) * 2.5 + 1 AS faithfulness,
    len(list_filter(evidences, lambda e: e <> ''))::DOUBLE / n AS trace FROM chains c LEFT JOIN labels l ON c.conv_id = l.doc_id)
SELECT conv_id, difficulty, round(faithfulness / 5 * 0.25 + trace * 0.15, 6)::DOUBLE AS overall,
  (difficulty = 'hard' AND faithfulness / 5 * 0.25 + trace * 0.15 < 3.0) OR (difficulty = 'medium' AND faithfulness < 3.0) AS retry,
  CASE WHEN difficulty = 'hard' THEN 3 ELSE 1 END AS samples FROM judged""")
def overall_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.get(F.array(*map(F.lit, ("easy", "medium", "hard"))), (F.col("conv_id") % 3).cast("int"))
    judged = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("conv_id"), "quality")
    rows = _chains(spark, sf_dir).join(judged, "conv_id", "left").withColumn("difficulty", level)
    rows = rows.withColumn("faithfulness", F.coalesce("quality", F.lit(0)) * 2.5 + 1)
    value = chains.overall({"faithfulness": F.col("faithfulness"), "traceability": chains.traceability(F.col("steps"))}, {"faithfulness": 0.25, "traceability": 0.15})
    return rows.select("conv_id", "difficulty", F.round(value, 6).alias("overall"), chains.needs_retry(F.col("difficulty"), value, F.col("faithfulness")).alias("retry"), chains.samples_for(F.col("difficulty")).alias("samples"))


def _actions() -> F.Column:
    """One of each action, aimed by the conversation's number."""
    target = (F.col("conv_id") % 4 + 1).cast("int")
    given = [
        ("adjust_confidence", {"new_confidence": "low"}),
        ("add_evidence", {"evidence": "seen"}),
        ("insert_step", {"new_step": {"content": "added", "type": "comparison"}}),
        ("revise_step", {"revised_content": "rewritten"}),
        ("remove_step", {}),
    ]
    import json

    made = [F.struct(F.lit(a).alias("action"), (target + i % 2).alias("target_step"), F.lit("P1").alias("priority"), F.from_json(F.lit(json.dumps(p)), schemas.PARAMS).alias("params"), F.lit("").alias("reason")) for i, (a, p) in enumerate(given)]
    return F.struct(F.array(*made).alias("priority_actions"), F.from_json(F.lit("[]"), schemas.ACTIONS).alias("optional_improvements"), F.array(F.lit("none")).alias("conflicts_resolved"))


@query(f"""WITH {STEPS_SQL}, aimed AS (SELECT *, conv_id % 4 + 1 AS t FROM steps),
kept AS (SELECT conv_id, turn, t, type, coalesce(evidence, '') AS evidence, confidence,
    CASE WHEN turn = t + 1 THEN 'rewritten' ELSE content END AS content,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place, count(*) OVER (PARTITION BY conv_id) AS n FROM aimed WHERE turn <> t),
sizes AS (SELECT a.conv_id, any_value(a.t) AS t, count(k.turn) AS n FROM aimed a LEFT JOIN kept k ON a.conv_id = k.conv_id AND a.turn = k.turn GROUP BY a.conv_id),
made AS (SELECT conv_id, 2 * place AS spot, type, content, CASE WHEN turn = t + 1 THEN 'seen' ELSE evidence END AS evidence, confidence FROM kept
  UNION ALL SELECT conv_id, 2 * least(t - 1, n) + 1, 'comparison', 'added', '', 'low' FROM sizes)
SELECT conv_id, count(*)::INTEGER AS n, md5(string_agg(type || '|' || content || '|' || evidence || '|' || confidence, chr(10) ORDER BY spot)) AS steps_md5 FROM made GROUP BY conv_id""")
def apply_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _chains(spark, sf_dir).withColumn("unified", _actions())
    rows = rows.select("conv_id", chain_ops.apply_actions(F.col("steps"), F.col("unified")).alias("steps"))
    line = lambda s: F.concat_ws("|", s["type"], s["content"], F.coalesce(s["evidence"], F.lit("")), s["confidence"])
    return rows.select("conv_id", F.size("steps").alias("n"), F.md5(F.array_join(F.transform("steps", line), "\n").cast("binary")).alias("steps_md5"))


@query("""SELECT conv_id, turn, CASE WHEN h > 0 AND h >= m AND h >= e THEN 'hard' WHEN m > 0 AND m >= e THEN 'medium' ELSE 'easy' END AS difficulty FROM (
  SELECT conv_id, turn, strpos(a, 'easy') AS e, strpos(a, 'medium') AS m, strpos(a, 'hard') AS h FROM (
    SELECT conv_id, turn, ['not hard, it is easy', 'medium', 'easy at first, hard', 'no idea', 'Hard or medium'][1 + (conv_id + turn) % 5].lower() AS a FROM conversations))""")
def difficulty_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = F.array(*map(F.lit, ("not hard, it is easy", "medium", "easy at first, hard", "no idea", "Hard or medium")))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.get(answers, ((F.col("conv_id") + F.col("turn")) % 5).cast("int")).alias("a"))
    return rows.select("conv_id", "turn", parsing.difficulty(F.col("a")).alias("difficulty"))


@query("""SELECT conv_id, turn, CASE (conv_id + turn) % 6 WHEN 0 THEN least(5.0, greatest(1.0, conv_id % 9)) WHEN 1 THEN 3.0 WHEN 2 THEN 4.0 WHEN 3 THEN 3.0 WHEN 4 THEN 5.0 ELSE 2.0 END::DOUBLE AS score FROM conversations""")
def judge_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    json_score = F.concat(F.lit('Scored: {"score": '), (F.col("conv_id") % 9).cast("string"), F.lit(', "notes": []}'))
    answers = F.array(json_score, F.lit('{"notes": []}'), F.lit("I give 4 of 5"), F.lit("none"), F.lit('```json\n{"score": 9}\n```'), F.lit('{"score": 2.0, "notes": [{"step": 1}]}'))
    rows = rows.select("conv_id", "turn", F.get(answers, ((F.col("conv_id") + F.col("turn")) % 6).cast("int")).alias("a"))
    return rows.select("conv_id", "turn", parsing.judge_score(F.col("a")).alias("score"))


@query(f"""WITH {STEPS_SQL} SELECT conv_id, 'done' AS thought, 'FINISH' AS action, count(*)::INTEGER AS n, md5(string_agg(
  'Step ' || turn || ' [' || type || ']: ' || content || ' (confidence: ' || confidence || ')' || CASE WHEN coalesce(evidence, '') <> '' THEN chr(10) || '  Evidence: ' || evidence ELSE '' END, chr(10) ORDER BY turn)) AS text_md5
FROM steps GROUP BY conv_id""")
def response_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains written as answers and read back."""
    rows = _chains(spark, sf_dir)
    fenced = F.concat(F.lit("Thought 1: done\nAction 1: FINISH\n```json\n"), F.to_json(F.struct("steps")), F.lit("\n```"))
    rows = rows.withColumn("answer", fenced)
    thought, action = parsing.thought_and_action(F.col("answer"))
    back = parsing.chain_steps(F.col("answer"))
    return rows.select("conv_id", thought.alias("thought"), action.alias("action"), F.size(back).alias("n"), F.md5(chains.chain_text(back).cast("binary")).alias("text_md5"))


# ---------------------------------------------------------------- sampling, resume, reports


@query("""WITH drawn AS (SELECT doc_id, coalesce(lang, 'Unknown') AS lang, md5('42:' || doc_id) AS draw FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY draw, doc_id) AS nth FROM drawn),
few AS (SELECT greatest(1, 100 // count(DISTINCT lang)) AS most FROM drawn)
SELECT doc_id, lang FROM placed, few WHERE nth <= most ORDER BY nth, draw, doc_id LIMIT 100""")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chain_ops.stratified_sample(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "doc_id", 100)
    return rows.select("doc_id", F.coalesce("lang", F.lit("Unknown")).alias("lang"))


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def resume_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain_ops.unfinished(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), table(spark, sf_dir, "labels"), "doc_id")


@query("""WITH marked AS (SELECT user_id, ts, event_id, (event_type = 'error')::INT AS failed FROM events),
islands AS (SELECT *, sum(1 - failed) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM marked),
runs AS (SELECT user_id, island, sum(failed) AS n FROM islands GROUP BY user_id, island)
SELECT user_id, max(n)::BIGINT AS longest_streak, arg_max(n, island)::BIGINT AS last_streak FROM runs GROUP BY user_id""")
def failure_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain_ops.failure_streaks(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error")


@query("""SELECT difficulty, count(*) AS n, round(avg(overall), 6) AS mean_overall FROM (
  SELECT ['easy', 'medium', 'hard'][1 + d.doc_id % 3] AS difficulty, l.quality::DOUBLE AS overall FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) GROUP BY difficulty""")
def difficulty_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.get(F.array(*map(F.lit, ("easy", "medium", "hard"))), (F.col("doc_id") % 3).cast("int"))
    quality = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("overall"))
    rows = table(spark, sf_dir, "documents").join(quality, "doc_id", "left").select(level.alias("difficulty"), "overall")
    return chain_ops.difficulty_summary(rows)


def entry(spark: SparkSession, sf_dir: str = "/root/testdata/sf0.001") -> DataFrame:
    return bm25_topk(spark, sf_dir)
