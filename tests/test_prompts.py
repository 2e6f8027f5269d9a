from __future__ import annotations

from pyspark.sql import functions as F

from loomwork.functions import prompts

NOTES = "array<struct<step: int, issue: string, assessment: string>>"


def test_round_prompt(spark):
    df = spark.createDataFrame([("q", "a", ["t1", "t2"], [[("s", "x" * 400)]])], "q string, a string, t array<string>, o array<array<struct<source: string, content: string>>>")
    got = df.select(prompts.round_prompt(F.col("q"), F.col("a"), F.col("t"), F.col("o")).alias("x")).first().x
    assert got == "Question: q\nAnswer: a\n\nThought 1: t1\nObservation 1:\n  - [s] " + "x" * 300 + "\n\nThought 2: t2\n\nWhat is your next Thought and Action?"


def test_feedback(spark):
    df = spark.createDataFrame([((3.0, 4.0, 0.7), [(1, "weak", None), (None, None, "so")], [], 1), (None, None, [], 2)], f"s struct<faithfulness: double, logical_completeness: double, overall: double>, f {NOTES}, l {NOTES}, k int")
    got = [r.x for r in df.orderBy("k").select(prompts.feedback_text(F.col("s"), F.col("f"), F.col("l")).alias("x")).collect()]
    assert got[0].split("\n")[2:] == ["  Scores: faithfulness=3.0/5, logical_completeness=4.0/5, overall=0.7", "  Faithfulness issues:", "    Step 1: weak", "    Step ?: so"]
    assert got[1] == ""


def test_critique_and_record(spark):
    df = spark.createDataFrame([('[{"a": 1}]', "x", None), ("[]", "y", "z"), ("bad", None, None)], "j string, a string, b string")
    rows = df.select(prompts.critique_text(F.try_parse_json("j")).alias("c"), prompts.record_json(F.struct("a", "b")).alias("r")).collect()
    assert [r.c for r in rows] == ['[{"a":1}]', "No issues found.", "No issues found."]
    assert [r.r for r in rows] == ['{"a":"x"}', '{"a":"y","b":"z"}', "{}"]
