"""Further registered queries: sections with headings, unified retrieval, parsed answers, texts of chains and tables.

Answers are built from the tables' numbers, so SQL can say what parsing them must give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions import chains, markup, parsing, prompts, text
from loomwork.operators import chunking, graph, retrieval
from loomwork.queries import EXPANDED, GRAPH, HYBRID, STEPS_SQL, _chains, _expanded, _relations, _suppliers, _vector_queries, query, table

# ---------------------------------------------------------------- markup and passages

#: What is put after a page's number and url.
HEAD, MIDDLE = "<h2> Growth </h2><p>At <b>", '</b></p><table><tr><td>no</table><h3 class="x">Overview</h3><p>Caf&eacute; &amp;lt; &#8364;&#x41; &nosuch; '


@query(f"""SELECT page_id, section, title, body FROM (
  SELECT page_id, h, 0 AS section, 'Introduction' AS title, 'Café &lt; €A &nosuch; ' || page_id AS body FROM (SELECT page_id, html || '{HEAD}' || url || '{MIDDLE}' || page_id || '</p>' AS h FROM pages)
  UNION ALL SELECT page_id, h, 1, 'Growth', 'At ' || url FROM (SELECT page_id, url, html || '{HEAD}' || url || '{MIDDLE}' || page_id || '</p>' AS h FROM pages)) WHERE len(h) >= 500""")
def html_headed_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of pages with headings put at their ends."""
    rows = table(spark, sf_dir, "pages").select("page_id", F.concat("html", F.lit(HEAD), "url", F.lit(MIDDLE), F.col("page_id").cast("string"), F.lit("</p>")).alias("h"))
    rows = rows.select("page_id", F.posexplode(markup.html_sections(F.col("h"))).alias("section", "s"))
    return rows.select("page_id", "section", F.col("s.title").alias("title"), F.col("s.text").alias("body"))


DEEP = "{{a" * 12 + " x " + "}}" * 12 + "{| q {| r |} |}"


@query("SELECT doc_id, 'kept ' || doc_id AS body FROM documents")
def wikitext_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templates twelve levels deep, and a table in a table, before a document's number."""
    marked = F.concat(F.lit(f"kept {DEEP} "), F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", markup.clean_wikitext(marked).alias("body"))


@query("SELECT source, count(*) AS n, sum(doc_id)::BIGINT AS ids FROM documents GROUP BY source")
def passages_by_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chunking.by_article(table(spark, sf_dir, "documents").select("source", "doc_id"), "source")
    return rows.select("source", F.size("passages").cast("long").alias("n"), F.aggregate("passages", F.lit(0).cast("long"), lambda a, p: a + p["doc_id"]).alias("ids"))


@query("SELECT doc_id, 'Wikipedia: ' || coalesce(source, '') || ', ' || coalesce(lang, '') AS label FROM documents")
def source_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.source_label(F.col("source"), F.col("lang")).alias("label"))


# ---------------------------------------------------------------- retrieval

NEEDLE = "the"


@query(f"""WITH {HYBRID}, {EXPANDED},
base AS (SELECT h.query_id, d.text AS content, h.score, h.position FROM hybrid h JOIN documents d USING (doc_id)),
met AS (SELECT DISTINCT query_id FROM expanded WHERE query_id IN (SELECT query_id FROM queries)),
legs AS (
  SELECT query_id, content, score * 1.2 AS score, 0 AS leg, position FROM expanded WHERE query_id IN (SELECT query_id FROM met)
  UNION ALL SELECT query_id, content, score, 1, position FROM base WHERE query_id IN (SELECT query_id FROM met)),
firsts AS (SELECT *, row_number() OVER (PARTITION BY query_id, substr(content, 1, 100) ORDER BY leg, position) AS nth FROM legs),
merged AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, leg, position) AS rank FROM firsts WHERE nth = 1)
SELECT query_id, md5(content) AS content_md5, round(score, 6) AS score, rank FROM (
  SELECT query_id, content, score, rank FROM merged WHERE rank <= 5
  UNION ALL SELECT query_id, content, score, position FROM base WHERE query_id NOT IN (SELECT query_id FROM met)
) WHERE contains(lower(content), '{NEEDLE}')""")
def unified_retrieve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hybrid and graph hits of every query, merged, then only what holds a word."""
    docs, asked = table(spark, sf_dir, "documents"), _vector_queries(spark, sf_dir)
    index = retrieval.SparseIndex.build(docs, "doc_id", "text")
    found = _expanded(spark, sf_dir).join(asked.select("query_id"), "query_id", "left_semi")
    contents = docs.select("doc_id", F.col("text").alias("content"))
    rows = retrieval.unified(asked, table(spark, sf_dir, "embeddings"), index, contents, found, 5, needles=(NEEDLE, None))
    return rows.select("query_id", F.md5(F.col("content").cast("binary")).alias("content_md5"), F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query(f"WITH {HYBRID} SELECT query_id, doc_id, score FROM hybrid WHERE score >= 0.0164")
def similarity_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = retrieval.SparseIndex.build(table(spark, sf_dir, "documents"), "doc_id", "text")
    hits = retrieval.retrieve(_vector_queries(spark, sf_dir), table(spark, sf_dir, "embeddings"), index, 5, threshold=0.0164)
    return hits.select("query_id", "doc_id", "score")


@query(f"WITH {GRAPH} SELECT name, relation, neighbour AS target, round(confidence, 6) AS confidence FROM edges WHERE name IN (SELECT name FROM suppliers)")
def relations_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = graph.adjacency(graph.merge_relations(_relations(spark, sf_dir)))
    return graph.relations_of(edges, _suppliers(spark, sf_dir)).withColumn("confidence", F.round("confidence", 6))


# ---------------------------------------------------------------- texts of chains


@query(f"""WITH {STEPS_SQL} SELECT conv_id, md5(string_agg(content || CASE WHEN evidence IS NOT NULL THEN ' ' || evidence ELSE '' END, ' ' ORDER BY turn)) AS enhanced_md5,
  md5(coalesce(arg_min(content, turn) FILTER (type = 'conclusion'), arg_max(content, turn))) AS conclusion_md5,
  count(*) FILTER (type IN ('knowledge_application', 'causal_reasoning', 'evidence_integration'))::INTEGER AS n_factual FROM steps GROUP BY conv_id""")
def chain_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = F.col("steps")
    return _chains(spark, sf_dir).select(
        "conv_id",
        F.md5(chains.enhanced_text(steps).cast("binary")).alias("enhanced_md5"),
        F.md5(chains.conclusion_text(steps).cast("binary")).alias("conclusion_md5"),
        F.size(chains.factual_steps(steps)).alias("n_factual"),
    )


@query("SELECT vec_id, round(exp(-list_sum(list_transform(embedding, lambda x: -abs(x)::DOUBLE)) / len(embedding)), 6) AS ppl FROM embeddings")
def perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of vectors read as log-probabilities."""
    probs = F.transform("embedding", lambda x: -F.abs(x).cast("double"))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(chains.perplexity(probs), 6).alias("ppl"))


@query("SELECT doc_id, doc_id % 3 = 0 AS cjk FROM documents")
def cjk_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document's text replaced by one that is mostly Chinese."""
    chosen = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("土壤酸性需要石灰来改良"), F.col("doc_id").cast("string"))).otherwise("soil and lime")
    return table(spark, sf_dir, "documents").select("doc_id", chains.is_cjk(chosen).alias("cjk"))


# ---------------------------------------------------------------- answers of models


def _turns(spark: SparkSession, sf_dir: str, *parts: str) -> DataFrame:
    """(conv_id, turn, a): answers put together from texts and, marked with $, the turn's numbers."""
    columns = [F.col(p[1:]).cast("string") if p.startswith("$") else F.lit(p) for p in parts]
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat(*columns).alias("a"))


@query("SELECT conv_id, turn, 'look at ' || turn AS thought, 'retrieve: soil ' || conv_id AS action, 'soil ' || conv_id AS wanted FROM conversations")
def react_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _turns(spark, sf_dir, "Thought 2: look at ", "$turn", "\nAction 2: retrieve: soil ", "$conv_id", "\n")
    thought, action = parsing.thought_and_action(F.col("a"))
    return rows.select("conv_id", "turn", thought.alias("thought"), action.alias("action"), parsing.retrieve_request(F.col("a")).alias("wanted"))


@query("SELECT conv_id, turn, 2 AS n, turn::INTEGER AS target, 'merge_steps' AS second, 'revise_step' AS optional, 'P2' AS priority, 'none ' || conv_id AS conflict FROM conversations")
def review_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions = '}, {"action": "dance"}, {"action": "merge_steps", "priority": "P0", "params": {"step_a": 1, "step_b": 2}}], "optional_improvements": [{"target_step": 2, "priority": "P0"}], "conflicts_resolved": ["none '
    rows = _turns(spark, sf_dir, 'So: {"priority_actions": [{"action": "remove_step", "target_step": ', "$turn", actions, "$conv_id", '"]} done')
    u = parsing.unified_actions(F.col("a"))
    first, second, extra = u["priority_actions"][0], u["priority_actions"][1], u["optional_improvements"][0]
    found = {"n": F.size(u["priority_actions"]), "target": first["target_step"], "second": second["action"], "optional": extra["action"], "priority": extra["priority"], "conflict": u["conflicts_resolved"][0]}
    return rows.select("conv_id", "turn", *[c.alias(name) for name, c in found.items()])


@query("SELECT conv_id, turn, 1 AS n, 'why ' || conv_id || '?' AS question, turn::INTEGER AS step FROM conversations")
def challenge_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _turns(spark, sf_dir, 'I ask [{"step": ', "$turn", ', "question": "why ', "$conv_id", '?"}, {"type": "gap"}]')
    found = parsing.challenges(F.col("a"))
    return rows.select("conv_id", "turn", F.size(found).alias("n"), found[0]["question"].alias("question"), found[0]["step"].alias("step"))


@query("""SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN '[{"issue":"gap ' || conv_id || '"}]' ELSE 'No issues found.' END AS critique FROM conversations""")
def issue_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _turns(spark, sf_dir, 'Found [{"issue": "gap ', "$conv_id", '"}] here')
    said = F.when(F.col("turn") % 2 == 0, F.col("a")).otherwise("nothing [to say")
    return rows.select("conv_id", "turn", prompts.critique_text(parsing.issues(said)).alias("critique"))


@query("SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN '[[0,0],[1],[2],[3]]' WHEN 1 THEN '[[0,1],[2],[3]]' WHEN 2 THEN '[[0,2],[1],[3]]' ELSE '[[0,3],[1],[2]]' END AS clusters FROM conversations")
def cluster_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    said = F.concat(F.lit('{"clusters": [{"indices": [0, '), (F.col("turn") % 4).cast("string"), F.lit(']}, {"indices": [7, -1]}]}'))
    return rows.select("conv_id", "turn", F.to_json(parsing.clusters(said, F.lit(4))).alias("clusters"))


@query("SELECT conv_id, turn, 1 AS n_entities, 'lime ' || conv_id AS name, 'ca' AS alias, 1 AS n_relations, 1.0::DOUBLE AS confidence FROM conversations")
def extraction_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    entities = '", "type": "Chemical", "aliases": ["CA", ""]}, {"name": "x", "type": "song"}], "relations": '
    relations = '[{"source": "Lime", "target": "Soil", "relation": "affects", "confidence": 7}, {"source": "", "target": "a", "relation": "affects"}]}\n```'
    found = parsing.extraction(F.col("a"))
    e, r = found["entities"], found["relations"]
    columns = {"n_entities": F.size(e), "name": e[0]["name"], "alias": F.array_join(e[0]["aliases"], ","), "n_relations": F.size(r), "confidence": r[0]["confidence"]}
    rows = _turns(spark, sf_dir, '```json\n{"entities": [{"name": " Lime ', "$conv_id", entities, relations)
    return rows.select("conv_id", "turn", *[c.alias(name) for name, c in columns.items()])


@query("SELECT conv_id, turn, 1 AS n, turn::INTEGER AS step, 'weak ' || conv_id AS issue FROM conversations")
def judge_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _turns(spark, sf_dir, 'Scored: {"score": 4, "notes": [{"step": ', "$turn", ', "issue": "weak ', "$conv_id", '"}]}')
    found = parsing.judge_notes(F.col("a"))
    return rows.select("conv_id", "turn", F.size(found).alias("n"), found[0]["step"].alias("step"), found[0]["issue"].alias("issue"))


@query("""SELECT conv_id, turn, chr(10) || 'Evaluator Feedback (from quality gate — focus on these issues):' || chr(10) || '  Scores: faithfulness=' || turn || '/5, logical_completeness=?/5, overall=?'
  || chr(10) || '  Faithfulness issues:' || chr(10) || '    Step ?: gap' AS feedback FROM conversations""")
def feedback_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("double")
    scores = F.struct(F.col("turn").alias("faithfulness"), none.alias("logical_completeness"), none.alias("overall"))
    note = F.from_json(F.lit('[{"assessment": "gap"}]'), parsing.NOTES)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", prompts.feedback_text(scores, note, F.lit(None).cast(parsing.NOTES)).alias("feedback"))
