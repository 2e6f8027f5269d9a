"""Texts put before models: rounds of reasoning, critiques, feedback; and records as JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_prompt(question: Column, answer: Column, thoughts: Column, observations: Column, each: int = 300) -> Column:
    """Question, answer, then every thought with what was seen after it.

    ``observations`` is array<array<struct<source, content>>>; contents are cut to ``each`` characters.
    """

    def seen(hit: Column) -> Column:
        return F.concat(F.lit("  - ["), hit["source"], F.lit("] "), F.substring(hit["content"], 1, each))

    def turn(thought: Column, i: Column) -> Column:
        number = (i + 1).cast("string")
        hits = F.get(observations, i)
        head = F.concat(F.lit("Thought "), number, F.lit(": "), thought)
        body = F.when(hits.isNotNull(), F.concat(F.array(F.concat(F.lit("Observation "), number, F.lit(":"))), F.transform(hits, seen)))
        return F.array_join(F.concat(F.array(head), F.coalesce(body, F.array().cast("array<string>")), F.array(F.lit(""))), "\n")

    start = F.concat(F.lit("Question: "), question, F.lit("\nAnswer: "), answer, F.lit("\n"))
    return F.array_join(F.concat(F.array(start), F.transform(thoughts, turn), F.array(F.lit("What is your next Thought and Action?"))), "\n")


def critique_text(issues: Column) -> Column:
    """Issues (a variant list) as JSON; a sentence where there are none."""
    text = F.to_json(issues)
    return F.when(text.isNull() | text.isin("[]", "null"), F.lit("No issues found.")).otherwise(text)


def feedback_text(scores: Column, faithfulness_notes: Column, logic_notes: Column) -> Column:
    """What the evaluator found, for the next review; empty where it said nothing.

    Notes are array<struct<step: int, issue: string, assessment: string>>.
    """

    def lines(notes: Column, title: str) -> Column:
        def line(n: Column) -> Column:
            step = F.coalesce(n["step"].cast("string"), F.lit("?"))
            return F.concat(F.lit("    Step "), step, F.lit(": "), F.coalesce(n["issue"], n["assessment"], F.lit("")))

        none = F.array().cast("array<string>")
        return F.when(F.size(F.coalesce(notes, F.array().cast(_NOTES))) > 0, F.concat(F.array(F.lit(f"  {title} issues:")), F.transform(notes, line))).otherwise(none)

    told = lambda name: F.coalesce(scores[name].cast("string"), F.lit("?"))
    summary = F.concat(
        F.lit("  Scores: faithfulness="), told("faithfulness"), F.lit("/5, logical_completeness="), told("logical_completeness"), F.lit("/5, overall="), told("overall")
    )
    head = F.when(scores.isNotNull(), F.array(summary)).otherwise(F.array().cast("array<string>"))
    body = F.concat(head, lines(faithfulness_notes, "Faithfulness"), lines(logic_notes, "Logical completeness"))
    title = "\nEvaluator Feedback (from quality gate — focus on these issues):"
    return F.when(F.size(body) == 0, "").otherwise(F.array_join(F.concat(F.array(F.lit(title)), body), "\n"))


_NOTES = "array<struct<step: int, issue: string, assessment: string>>"


def record_json(record: Column) -> Column:
    """A record as JSON without its empty fields."""
    return F.to_json(record, {"ignoreNullFields": "true"})
