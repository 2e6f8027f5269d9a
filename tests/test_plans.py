from __future__ import annotations

import bz2
import json

from pyspark.sql import functions as F

from loomwork import jobs
from loomwork.plans import enrichment, knowledge, models
from loomwork.sources import readers, writers
from loomwork.streaming.ingest import ingest

CHAIN = '```json\n{"steps": [{"type": "context_setup", "content": "The soil is acid and needs lime."}, {"type": "causal_reasoning", "content": "Lime raises the pH of the soil."}, {"type": "conclusion", "content": "So apply lime to the whole field."}]}\n```'


def thinker(prompts):
    out = []
    for p in prompts:
        if p.startswith("Group"):
            out.append('{"clusters": [{"indices": [0, 1]}]}')
        elif "Observation 1" in p or "easy one" in p:
            out.append("Thought 2: known\nAction: FINISH\n" + CHAIN)
        else:
            out.append("Thought 1: look\nAction 1: retrieve: lime")
    return out


def evaluator(prompts):
    return ['{"score": 4}' if "faithfulness" in p else "I say 3" for p in prompts]


def reviewer(prompts):
    return ['{"priority_actions": [{"action": "add_evidence", "target_step": 2, "params": {"evidence": "seen"}}]}' if p.startswith("Join") else "[]" for p in prompts]


def classifier(prompts):
    return ["hard" if "hard one" in p else "easy" for p in prompts]


def lookup(queries):
    return queries.select("query_id", F.concat(F.lit("found "), F.coalesce("text", F.lit(""))).alias("evidence"))


def test_enrichment_and_resume(spark):
    items = spark.createDataFrame([(1, "an easy one", "lime"), (2, "a hard one", "lime")], "item_id int, question string, answer string")
    made = enrichment.run(items, enrichment.Models(classifier, thinker, reviewer, evaluator, lookup))
    rows = {r.item_id: r for r in made.collect()}
    assert (rows[1].difficulty, rows[2].difficulty) == ("easy", "hard")
    # easy items keep their draft and are never sent back; hard ones always are at the default bound
    assert [s.evidence for s in rows[1].revised] == [None, None, None] and not rows[1].retried
    assert rows[2].revised[1].evidence == "seen" and rows[2].retried
    assert rows[2].scores.faithfulness == 4.0 and rows[2].scores.logical_completeness == 3.0
    left = enrichment.run(items, enrichment.Models(classifier, thinker, reviewer, evaluator, lookup), done=made.where("item_id = 2"))
    assert [r.item_id for r in left.select("item_id").collect()] == [1]


def test_texts_that_models_write_notes_and_evidence_by_step(spark):
    """One hard item through both reviews, against what a plain reading of the stages gives."""
    actions = [
        {"action": "insert_step", "target_step": 2, "reason": "gap"},
        {"action": "revise_step", "target_step": 2, "reason": "vague"},
        {"action": "merge_steps", "target_step": 1, "params": {"step_a": 1, "step_b": 3}},
        {"action": "revise_step", "target_step": 9, "reason": "no such step"},
    ]

    def reviser(prompts):
        out = []
        for p in prompts:
            if p.startswith("Merge"):
                assert "Step 1: The soil is acid" in p and "Step 3: So apply lime" in p
                out.append('{"content": "merged", "type": "context_setup"}')
            elif p.startswith("Rewrite"):
                assert "vague" in p and "Lime raises" in p
                out.append("rewritten")
            else:
                # the merge and the revision have come before
                assert "merged" in p and "rewritten" in p and "gap" in p
                out.append('Here: {"content": "inserted", "type": "knowledge_application", "confidence": "low"}')
        return out

    def reviewer(prompts):
        out = []
        for p in prompts:
            if p.startswith("Join"):
                assert "unclear" in p
                second = "Evaluator Feedback" in p
                assert not second or ("Step 2: weak" in p and "faithfulness=4.0" in p)
                out.append(json.dumps({"priority_actions": [] if second else actions}))
            elif p.startswith("Check"):
                assert "For gaps:\n[wiki] found a hard one" in p
                assert "rewritten" in p or "Step 2: [wiki] found Lime raises" in p
                out.append('[{"issue": "unclear"}]')
            else:
                out.append("none")
        return out

    def evaluator(prompts):
        return ['{"score": 4, "notes": [{"step": 2, "issue": "weak"}]}' if "faithfulness" in p else "3" for p in prompts]

    def thinker(prompts):
        out = []
        for p in prompts:
            if p.startswith("Challenge"):
                out.append('[{"step": 1, "question": "why lime?"}]')
            elif p.startswith("Revise the chain"):
                assert "why lime?" in p
                out.append(CHAIN.replace("needs lime", "needs it"))
            elif p.startswith("Group"):
                out.append("")
            else:
                out.append("Thought 1: known\nAction: FINISH\n" + CHAIN)
        return out

    def hits(queries):
        return queries.select("query_id", F.array(F.struct(F.lit("wiki").alias("source"), F.concat(F.lit("found "), F.col("text")).alias("content"))).alias("hits"))

    items = spark.createDataFrame([(1, "a hard one", "lime", None)], "item_id int, question string, answer string, question_type string")
    scripted = enrichment.Models(classifier, thinker, reviewer, evaluator, hits, reviser, lambda texts: [[-1.0, -3.0] for _ in texts])
    row = enrichment.run(items, scripted).first()
    assert row.question_type == "Unknown" and row.metadata.n_samples == 3 and row.metadata.classification_raw == "hard"
    # the Socratic pass has rewritten the draft
    assert [s.content for s in row.draft] == ["The soil is acid and needs it.", "Lime raises the pH of the soil.", "So apply lime to the whole field."]
    assert [(s.step, s.content) for s in row.revised] == [(1, "merged"), (2, "inserted"), (3, "rewritten")]
    assert [(c.phase, c.issues) for c in row.critiques] == [("A_internal", "[]"), ("B_external", '[{"issue":"unclear"}]')] * 2
    assert row.retried and len(row.unified.priority_actions) == 4 and abs(row.scores.ppl - 7.38905609893065) < 1e-9
    assert [(n.step, n.issue) for n in row.faithfulness_notes] == [(2, "weak")]


def test_fallback_chain(spark):
    items = spark.createDataFrame([(1, 0, "q", "a")], "item_id int, candidate int, question string, answer string")
    silent = enrichment.Models(classifier, lambda ps: ["Thought 1: hm\nAction 1: retrieve: x"] * len(ps), reviewer, evaluator, lookup)
    row = enrichment.react(items, silent, rounds=2).first()
    assert [s.type for s in row.steps] == ["context_setup", "evidence_integration", "conclusion"] and row.react_rounds == 2


def test_socratic(spark):
    items = spark.createDataFrame([(1, "q", [(1, "conclusion", "old", None, "low")])], "item_id int, question string, steps array<struct<step: int, type: string, content: string, evidence: string, confidence: string>>")
    ask = lambda ps: ['[{"question": "why?"}]' if p.startswith("Challenge") else (CHAIN if "found" in p else "retrieve: lime") for p in ps]
    row = enrichment.socratic(items, enrichment.Models(classifier, ask, reviewer, evaluator, lookup)).first()
    assert len(row.steps) == 3


def test_failed_calls_answer_empty(spark):
    def broken(prompts):
        raise RuntimeError("down")

    rows = spark.createDataFrame([("p",)], "p string")
    assert models.answered(rows, "p", "a", broken, wait=0.0).first().a == ""


def test_knowledge_base(spark, tmp_path):
    words = "lime raises the soil ph and " * 30
    rows = spark.createDataFrame([("Lime", words, None, "u", 1), ("Soil", words, [("S", words)], "v", 2)], "title string, content string, sections array<struct<title: string, text: string>>, url string, page_id long")
    said = '{"entities": [{"name": "Lime", "type": "chemical", "description": "d"}], "relations": [{"source": "lime", "target": "soil", "relation": "affects", "confidence": 0.9}]}'
    tables = knowledge.build(rows, lambda ts: [[float(len(t)), 1.0] for t in ts], lambda ps: [said] * len(ps))
    writers.write_index(tables, str(tmp_path / "index"))
    read = readers.index_tables(spark, str(tmp_path / "index"))
    assert set(read) == set(tables)
    assert read["entities"].first().passage_ids == ["passage_0", "passage_1"]
    assert read["relations"].count() == 1 and read["vectors"].count() == read["passages"].count() == 2
    assert readers.index_tables(spark, str(tmp_path / "none")) == {}


def test_dump(spark, tmp_path):
    def page(title, ns, body):
        return f"<page><title>{title}</title><ns>{ns}</ns><id>{len(title)}</id><revision><id>1</id><text xml:space='preserve'>{body}</text></revision></page>"

    prose = "crop " * 80
    pages = [page("Crop", 0, prose), page("Crop talk", 1, prose), page("Plant", 0, "#REDIRECT [[Crop]]"), page("Seed", 0, "{{Disambig}} " + prose), page("Farm", 0, "short"), page("Bird", 0, "nothing here " * 30), page("Soil x", 0, "nothing here " * 30)]
    # two streams in one file
    data = bz2.compress(("<mediawiki>" + "".join(pages[:3])).encode()) + bz2.compress(("".join(pages[3:]) + "</mediawiki>").encode())
    (tmp_path / "dump.xml.bz2").write_bytes(data)
    got = readers.dump_articles(readers.dump_pages(spark, str(tmp_path / "dump.xml.bz2"))).collect()
    assert sorted(r.title for r in got) == ["Crop", "Soil x"]


def test_json_and_crawl(spark, tmp_path):
    (tmp_path / "qa.json").write_text(json.dumps([{"Question": "q", "Answer": "a", "Reasoning Traces": "r"}, {"Question": "q", "Answer": "a", "Reasoning Traces": ""}]))
    rows = readers.qa_records(spark, str(tmp_path / "qa.json")).collect()
    assert [r["Question Type"] for r in rows] == ["Unknown"]
    members = spark.createDataFrame([("Crops", "Wheat", "page"), ("Crops", "Soil fans", "subcat"), ("Crops", "Crop films", "subcat"), ("Soil fans", "Loam", "page"), ("Crop films", "Film", "page")], "category string, member string, kind string")
    assert {r.title for r in readers.category_titles(members, spark.createDataFrame([("Crops",)], "category string")).collect()} == {"Wheat", "Loam"}
    edges = spark.createDataFrame([("A", "Crop"), ("Crop", "Soil"), ("A", "Film"), ("Crop", "A")], "title string, link string")
    got = readers.follow_links(edges, spark.createDataFrame([("A",)], "title string"), depth=2).collect()
    assert [(r.title, r.hop) for r in got] == [("A", 0), ("Crop", 1), ("Soil", 2)]


def test_ingest_once(spark, tmp_path):
    landing, target = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    for n, ids in enumerate(([1, 2], [2, 3])):
        (landing / f"{n}.json").write_text("\n".join(json.dumps({"id": i, "t": str(n)}) for i in ids))
        ingest(spark, str(landing), "id int, t string", target, str(tmp_path / "check"), "id").awaitTermination()
    assert sorted((r.id, r.t) for r in spark.read.parquet(target).collect()) == [(1, "0"), (2, "0"), (3, "1")]
    writers.append_checkpoint(spark.createDataFrame([(9, "x")], "id int, t string"), target)
    assert spark.read.parquet(target).count() == 4


def test_jobs(spark, tmp_path):
    words = "lime raises the soil ph and " * 30
    (tmp_path / "articles.json").write_text(json.dumps([{"title": t, "content": f"{t} {words}", "url": "u"} for t in ("Lime", "Soil")]))
    said = '{"entities": [{"name": "Lime", "type": "chemical", "description": "d"}], "relations": []}'
    log = str(tmp_path / "asked")

    def chat(prompts):
        with open(log, "a") as out:
            out.writelines("asked\n" for _ in prompts)
        return [said if "] Lime " in p else "" for p in prompts]

    checkpoint = str(tmp_path / "extraction")
    for _ in range(2):
        tables = jobs.build_index(spark, str(tmp_path / "articles.json"), str(tmp_path / "index"), lambda ts: [[float(len(t)), 1.0] for t in ts], chat, checkpoint)
    # the second run asks again for the article whose answer was empty, and for no other
    assert len(open(log).readlines()) == 3 and tables["entities"].first().passage_ids == ["passage_0"]
    (tmp_path / "qa.json").write_text(json.dumps([{"Question": f"an easy one {i}", "Answer": "a", "Reasoning Traces": "r"} for i in range(3)]))
    scripted = enrichment.Models(classifier, thinker, reviewer, evaluator)
    first = jobs.enrich(spark, str(tmp_path / "qa.json"), str(tmp_path / "out"), scripted, n=2)
    assert first.count() == 2
    assert jobs.enrich(spark, str(tmp_path / "qa.json"), str(tmp_path / "out"), scripted, n=2).count() == 2


def test_passages_come_in_the_order_of_their_numbers(spark):
    rows = spark.createDataFrame([(f"passage_{i}", f"text {i} " + "w " * 60, "A", "S") for i in range(8, 13)], "id string, text string, article_title string, section_title string")
    said = '{"entities": [{"name": "x", "type": "crop"}, {"name": "x", "type": "soil"}], "relations": []}'

    def chat(prompts):
        assert all(p.index("text 8 ") < p.index("text 9 ") < p.index("text 10 ") < p.index("text 12 ") for p in prompts)
        return [said] * len(prompts)

    entities, _ = knowledge.extract_graph(rows, chat)
    got = entities.orderBy("place").collect()
    assert got[0].passage_ids == [f"passage_{i}" for i in range(8, 13)] and [r.place for r in got] == list(range(len(got)))
