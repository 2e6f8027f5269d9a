"""What model answers say, by expressions: find it in the prose, parse it, else fall back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomwork.functions import lexicons as lex
from loomwork.functions import schemas
from loomwork.functions.chains import valid_steps
from loomwork.functions.markup import strip

FENCED = r"(?s)```(?:json)?\s*(\{.*?\})\s*```"
FENCED_LIST = r"(?s)```(?:json)?\s*(\[.*?\])\s*```"


NOTES = "array<struct<step: int, issue: string, assessment: string>>"


def _found(text: Column, pattern: str, group: int = 0) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), pattern, group), F.lit(""))


def _parsed(text: Column, schema: str) -> Column:
    """The record, or null unless the text is JSON; parsing bad text alone would give a record of nulls."""
    return F.when(F.try_parse_json(text).isNotNull(), F.from_json(text, schema))


def difficulty(answer: Column) -> Column:
    """The label whose first mention comes last; easy without any."""
    lowered = F.lower(strip(F.coalesce(answer, F.lit(""))))
    at = {label: F.regexp_instr(lowered, F.lit(rf"(?U)\b{label}\b")) for label in ("easy", "medium", "hard")}
    last = F.greatest(*at.values())
    return F.when((at["hard"] > 0) & (at["hard"] == last), "hard").when((at["medium"] > 0) & (at["medium"] == last), "medium").otherwise("easy")


def thought_and_action(response: Column) -> tuple[Column, Column]:
    """A reasoning round's thought, and its action: FINISH or what to do."""
    response = F.coalesce(response, F.lit(""))
    thought = strip(F.regexp_extract(response, r"(?is)Thought\s*\d*:\s*(.+?)(?=Action|\z)", 1))
    said = strip(F.regexp_extract(response, r"(?im)Action\s*\d*:\s*(.+?)$", 1))
    asks = F.lower(said).startswith("retrieve:")
    action = F.when(said == "", "FINISH").when(asks, said).when(F.lower(said).contains("finish"), "FINISH").otherwise(said)
    done = response.contains("FINISH") & ~F.lower(response).contains("retrieve")
    return thought, F.when(done, "FINISH").otherwise(action)


def retrieve_request(response: Column) -> Column:
    """What a revision asks to look up; null if nothing."""
    return F.nullif(strip(F.regexp_extract(F.coalesce(response, F.lit("")), r"(?i)retrieve:\s*(.+?)(?:\n|\z)", 1)), F.lit(""))


def chain_steps(response: Column) -> Column:
    """Valid steps of the chain in an answer: a fenced block, else a bare object; null without one."""
    schema = f"steps {schemas.STEPS}"
    fenced = _parsed(_found(response, r"(?s)```json\s*(\{.*?\})\s*```", 1), schema)["steps"]
    bare = _parsed(_found(response, r'(?s)\{[^{}]*"steps"\s*:\s*\[.*?\]\s*\}'), schema)["steps"]
    return valid_steps(F.coalesce(fenced, bare))


def challenges(response: Column) -> Column:
    """Challenges that have a question."""
    rows = _parsed(_found(response, r"(?s)\[.*\]"), "array<struct<step: int, question: string, type: string>>")
    return F.coalesce(F.filter(rows, lambda c: c["question"].isNotNull()), F.from_json(F.lit("[]"), "array<struct<step: int, question: string, type: string>>"))


def issues(response: Column) -> Column:
    """A list of issues as variant: the widest brackets, else a fenced list; null if neither is JSON."""
    return F.coalesce(F.try_parse_json(_found(response, r"(?s)\[.*\]")), F.try_parse_json(_found(response, FENCED_LIST, 1)))


def unified_actions(response: Column) -> Column:
    """Review actions; unknown ones are dropped, optional ones have priority P2, missing names are defaults."""
    data = F.coalesce(_parsed(_found(response, r"(?s)\{.*\}"), schemas.UNIFIED), _parsed(_found(response, FENCED, 1), schemas.UNIFIED))
    none = F.from_json(F.lit("[]"), schemas.ACTIONS)

    def valid(actions: Column, priority: str | None) -> Column:
        whole = F.transform(
            F.coalesce(actions, none),
            lambda a: a.withField("action", F.coalesce(a["action"], F.lit("revise_step")))
            .withField("target_step", F.coalesce(a["target_step"], F.lit(0)))
            .withField("priority", F.lit(priority) if priority else F.coalesce(a["priority"], F.lit("P1")))
            .withField("reason", F.coalesce(a["reason"], F.lit(""))),
        )
        return F.filter(whole, lambda a: a["action"].isin(*lex.ACTIONS) & a["priority"].isin(*lex.PRIORITIES))

    return F.struct(
        valid(data["priority_actions"], None).alias("priority_actions"),
        valid(data["optional_improvements"], "P2").alias("optional_improvements"),
        F.coalesce(data["conflicts_resolved"], F.from_json(F.lit("[]"), "array<string>")).alias("conflicts_resolved"),
    )


def judge_score(answer: Column) -> Column:
    """1 to 5: the score in JSON (3 if it has none), else in a fenced block, else the first digit 1 to 5, else 3."""
    answer = F.coalesce(answer, F.lit(""))
    out = F.lit(None).cast("double")
    for pattern, group in ((r"(?s)\{.*\}", 0), (FENCED, 1)):
        found = _found(answer, pattern, group)
        held = F.get_json_object(found, "$.score")
        score = F.coalesce(held.try_cast("double"), F.when(held.isNull(), 3.0))
        out = F.coalesce(out, F.when(F.try_parse_json(found).isNotNull() & score.isNotNull(), F.least(F.lit(5.0), F.greatest(F.lit(1.0), score))))
    digit = F.regexp_extract(answer, "[1-5]", 0)
    return F.coalesce(out, F.when(digit != "", digit.cast("double")), F.lit(3.0))


def judge_notes(answer: Column) -> Column:
    """What a judge found, array<struct<step, issue, assessment>>: the notes beside the score; none where it gives no JSON."""
    answer = F.coalesce(answer, F.lit(""))
    out = F.lit(None).cast(NOTES)
    for pattern, group in ((r"(?s)\{.*\}", 0), (FENCED, 1)):
        found = _found(answer, pattern, group)
        held = F.get_json_object(found, "$.score")
        usable = F.try_parse_json(found).isNotNull() & (held.isNull() | held.try_cast("double").isNotNull())
        out = F.coalesce(out, F.when(usable, F.coalesce(F.from_json(found, f"notes {NOTES}")["notes"], F.from_json(F.lit("[]"), NOTES))))
    return F.coalesce(out, F.from_json(F.lit("[]"), NOTES))


def written_step(answer: Column) -> Column:
    """The step that a model wrote as JSON; null without one."""
    return _parsed(_found(answer, r"(?s)\{.*\}"), "type string, content string, evidence string, confidence string")


def extraction(answer: Column) -> Column:
    """Entities and relations of known kinds, names lower-cased; relation ends need not be declared."""
    schema = (
        "entities array<struct<name: string, type: string, aliases: array<string>, description: string>>, "
        "relations array<struct<source: string, target: string, relation: string, confidence: double>>"
    )
    inner = F.coalesce(_found(answer, FENCED, 1), answer)
    data = _parsed(F.coalesce(_found(inner, r'(?s)\{[^{}]*"entities"\s*:\s*\[.*?\]\s*,\s*"relations"\s*:\s*\[.*?\]\s*\}'), _found(inner, r"(?s)\{.*\}")), schema)
    low = lambda c: F.lower(strip(F.coalesce(c, F.lit(""))))
    entities = F.transform(
        F.filter(data["entities"], lambda e: e["name"].isNotNull() & F.lower(e["type"]).isin(*lex.ENTITY_TYPES)),
        lambda e: F.struct(
            low(e["name"]).alias("name"),
            F.lower(e["type"]).alias("type"),
            F.transform(F.filter(F.coalesce(e["aliases"], F.array().cast("array<string>")), lambda a: F.coalesce(a, F.lit("")) != ""), low).alias("aliases"),
            strip(F.coalesce(e["description"], F.lit(""))).alias("description"),
        ),
    )
    relations = F.filter(
        F.transform(
            data["relations"],
            lambda r: F.struct(
                low(r["source"]).alias("source"),
                low(r["target"]).alias("target"),
                low(r["relation"]).alias("relation"),
                F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(r["confidence"], F.lit(0.5)))).alias("confidence"),
            ),
        ),
        lambda r: (r["source"] != "") & (r["target"] != "") & r["relation"].isin(*lex.RELATION_TYPES),
    )
    return F.struct(entities.alias("entities"), relations.alias("relations"))


def clusters(answer: Column, candidates: Column) -> Column:
    """Groups of candidate numbers; missing ones are groups of their own, numbers out of range are dropped; null without JSON."""
    data = _parsed(_found(answer, r"(?s)\{.*\}"), "clusters array<struct<indices: array<int>>>")
    every = F.when(candidates > 0, F.sequence(F.lit(0), candidates - 1)).otherwise(F.array().cast("array<int>"))
    given = F.transform(data["clusters"], lambda c: F.filter(F.coalesce(c["indices"], F.array().cast("array<int>")), lambda i: (i >= 0) & (i < candidates)))
    given = F.filter(given, lambda c: F.size(c) > 0)
    missing = F.transform(F.array_except(every, F.flatten(given)), lambda i: F.array(i))
    return F.when(F.size(data["clusters"]) > 0, F.concat(given, missing))

