from __future__ import annotations

import math
import re

from pyspark.sql import functions as F

from loomwork.functions import lexicons, markup, parsing, schemas, text


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


def test_counts_and_scores(spark):
    sample = "Apply 5 kg lime. According to the USDA guide, pH 6.5 is best!  However, test first"
    assert one(spark, text.word_count(F.col("t")), t=sample) == len(sample.split())
    assert one(spark, text.sentence_count(F.col("t")), t=sample) == max(1, len(re.findall(r"[.!?]+(?:\s|$)", sample)))
    assert one(spark, text.sentence_count(F.col("t")), t="") == 1
    # apply, lime is none, test: two of fifteen
    assert math.isclose(one(spark, text.actionability(F.col("t")), t=sample), 2 / 15)
    assert math.isclose(one(spark, text.coherence(F.col("t")), t=sample), 2 / 8)
    # usda, guide, according to
    assert math.isclose(one(spark, text.evidence(F.col("t")), t=sample), 3 / 5)
    assert one(spark, text.structure(F.col("t")), t="# A\n1. b\n- c\n**d**") == 6 / 15


def test_specificity_counts_units_twice(spark):
    # 5 kg is a unit number and a bare one, 6.5 a bare one; pH is technical; Iowa is a proper noun after a space
    sample = "in Iowa 5 kg at pH 6.5"
    assert math.isclose(one(spark, text.specificity(F.col("t")), t=sample), (3 * 2 + 1 + 3) / 20)


def test_coverage(spark):
    column = text.constraint_coverage(F.col("t"), F.col("q"))
    assert one(spark, column, t="nothing", q="why") == 0.5
    assert one(spark, column, t="Corn in Iowa", q="Does corn near Iowa survive drought in 2020?") == 0.5


def test_gates(spark):
    assert one(spark, text.is_relevant(F.col("t")), t="Crop and soil and seed") is True
    assert one(spark, text.is_relevant(F.col("t")), t="Crop and soil") is False
    # a mixed-case keyword counts only when keywords are lower-cased
    assert one(spark, text.keyword_hits(F.col("t"), ("soil pH",)), t="soil ph") == 0
    assert one(spark, text.is_relevant(F.col("t"), ("soil pH",), 1), t="soil PH") is True
    assert one(spark, text.is_topic_category(F.col("t")), t="Crop films") is False
    assert one(spark, text.extract_entities(F.col("t")), t="The phone rusted in the heat") == ["heat", "ph", "rust"]


def test_rewrite_strips_in_list_order(spark):
    def rewritten(q, intent):
        return one(spark, text.rewrite_query(F.col("q"), F.col("i")), q=q, i=intent)

    assert rewritten("How do you", "fact_check") == "you"
    # "is" comes after "what" in the list, "how" before it
    assert rewritten("what is how x", "fact_check") == "how x"
    assert rewritten("How do you", "background") == "How do you"


def test_wikitext(spark):
    raw = "{{a {{b}} }}<!-- x\ny -->'''Bold''' [[Category:C]][[p q|shown]] [[plain]] [https://e.org site]<ref name=a>z</ref> &amp; {| t |}\n== H ==\n\n\n\nend"
    assert one(spark, markup.clean_wikitext(F.col("t")), t=raw) == "Bold shown plain site & \nH\n\nend"


def test_html_sections(spark):
    page = "<p>lost</p><h2>One</h2><p>first <sup>no</sup> text</p><script>var x</script><h3>Overview</h3>over" + " " * 500
    found = one(spark, markup.html_sections(F.col("t")), t=page)
    assert [(s.title, s.text) for s in found] == [("Introduction", "over"), ("One", "first text")]
    assert one(spark, markup.html_sections(F.col("t")), t="<h2>a</h2>b") is None
    plain = one(spark, markup.html_sections(F.col("t")), t="<p>" + "word " * 120 + "</p>")
    assert [s.title for s in plain] == ["Main"]


def test_links(spark):
    page = '<a href="./A_b">x</a><a href="/wiki/C%2Bd">y</a><a href="./A_b">x</a><a href="./File:z">z</a><a href="./Me">m</a><a href="./e+f">g</a>'
    assert one(spark, markup.links(F.col("t"), F.lit("Me")), t=page) == ["A b", "C+d", "e+f"]


def test_difficulty(spark):
    for answer, label in (("not hard, it is easy", "easy"), ("easy, then hard, easy", "hard"), ("none", "easy"), ("HARD", "hard"), ("uneasy medium", "medium")):
        assert one(spark, parsing.difficulty(F.col("t")), t=answer) == label


def test_judge(spark):
    for answer, score in (('x {"score": 9}', 5.0), ('{"notes": []}', 3.0), ("about 4 points", 4.0), ("nothing", 3.0), ('```json\n{"score": 2}\n```', 2.0), ('{"score": "bad"} 2', 2.0)):
        assert one(spark, parsing.judge_score(F.col("t")), t=answer) == score


def test_react_lines(spark):
    thought, action = parsing.thought_and_action(F.col("t"))
    said = "Thought 1: look it up\nAction 1: retrieve: lime"
    assert (one(spark, thought, t=said), one(spark, action, t=said)) == ("look it up", "retrieve: lime")
    assert one(spark, action, t="Thought: ok\nFINISH") == "FINISH"
    assert one(spark, parsing.retrieve_request(F.col("t")), t="please Retrieve: soil ph\nmore") == "soil ph"
    assert one(spark, parsing.retrieve_request(F.col("t")), t="no") is None


def test_chain_json(spark):
    good = '```json\n{"steps": [{"type": "conclusion", "content": "c"}, {"type": "odd", "content": "d"}]}\n```'
    steps = one(spark, parsing.chain_steps(F.col("t")), t=good)
    assert [(s.step, s.type, s.confidence) for s in steps] == [(1, "conclusion", "medium")]
    bare = 'so {"steps": [{"step": 4, "type": "comparison", "content": "c", "confidence": "high"}]}'
    assert one(spark, parsing.chain_steps(F.col("t")), t=bare)[0].step == 4
    assert one(spark, parsing.chain_steps(F.col("t")), t="none") is None


def test_actions_json(spark):
    raw = '{"priority_actions": [{"action": "remove_step", "target_step": 2}, {"action": "fly"}, {}], "optional_improvements": [{"action": "add_evidence", "priority": "P0"}]}'
    got = one(spark, parsing.unified_actions(F.col("t")), t=raw)
    assert [(a.action, a.priority) for a in got.priority_actions] == [("remove_step", "P1"), ("revise_step", "P1")]
    assert [(a.action, a.priority) for a in got.optional_improvements] == [("add_evidence", "P2")]
    assert one(spark, parsing.unified_actions(F.col("t")), t="no").priority_actions == []


def test_extraction_json(spark):
    raw = 'x {"entities": [{"name": " Wilt ", "type": "Disease", "aliases": ["W", null]}, {"name": "q", "type": "odd"}], "relations": [{"source": "A", "target": "b", "relation": "CAUSES", "confidence": 3}, {"source": "", "target": "b", "relation": "causes"}]}'
    got = one(spark, parsing.extraction(F.col("t")), t=raw)
    assert [(e.name, e.type, e.aliases) for e in got.entities] == [("wilt", "disease", ["w"])]
    assert [(r.source, r.relation, r.confidence) for r in got.relations] == [("a", "causes", 1.0)]


def test_clusters_json(spark):
    raw = '{"clusters": [{"indices": [0, 7]}, {"indices": [2]}]}'
    assert one(spark, parsing.clusters(F.col("t"), F.lit(4)), t=raw) == [[0], [2], [1], [3]]
    assert one(spark, parsing.clusters(F.col("t"), F.lit(4)), t="no") is None


def test_lists_have_no_repeats():
    for name in ("CONTENT_KEYWORDS", "TITLE_KEYWORDS", "ENTITY_LEXICON", "FILLER_WORDS"):
        values = getattr(lexicons, name)
        assert len(values) == len(set(values)), name
    assert schemas.STEP.startswith("struct<")
