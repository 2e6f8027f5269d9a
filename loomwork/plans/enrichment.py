"""Question-answer enrichment: difficulty, drafts, review, revision, scores and a gated retry, as staged tables.

Every stage is a table keyed by item; model answers are written before they are used, so no call is repeated when a
later stage is planned again or an executor is lost.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.functions import chains, parsing, prompts, schemas
from loomwork.operators import chain_ops
from loomwork.operators.durable import materialise
from loomwork.plans.models import Chat, answered, log_probabilities

#: Looks up (query_id, text) and returns (query_id, evidence), one text per query, or (query_id, hits) with hits an
#: array<struct<source: string, content: string>>.
Lookup = Callable[[DataFrame], DataFrame]
#: Characters of a hit that a reviewer is shown.
HIT_CHARS = 200


@dataclass
class Models:
    classifier: Chat
    thinker: Chat
    reviewer: Chat
    evaluator: Chat
    lookup: Lookup | None = None
    #: writes the texts that actions lack; without it such actions change nothing
    reviser: Chat | None = None
    #: log-probabilities of the tokens of texts, for the perplexity
    log_probs: Callable | None = None


def _empty_steps() -> Column:
    return F.from_json(F.lit("[]"), schemas.STEPS)


def classify(items: DataFrame, model: Chat) -> DataFrame:
    asked = items.withColumn("p", F.concat(F.lit("Is this easy, medium or hard?\n"), F.col("question"), F.lit("\n"), F.col("answer")))
    said = answered(asked, "p", "classification_raw", model).drop("p")
    return said.withColumn("difficulty", parsing.difficulty(F.col("classification_raw")))


def looked_up(queries: DataFrame, lookup: Lookup) -> DataFrame:
    """(query_id, evidence): hits as ``[source] content``, each cut to HIT_CHARS."""
    got = lookup(queries)
    if "hits" in got.columns:
        shown = F.transform("hits", lambda h: F.concat(F.lit("["), h["source"], F.lit("] "), F.substring(h["content"], 1, HIT_CHARS)))
        got = got.withColumn("evidence", F.nullif(F.array_join(shown, "; "), F.lit("")))
    return got.select("query_id", "evidence")


def react(rows: DataFrame, models: Models, rounds: int = 5) -> DataFrame:
    """(…, steps, react_rounds) for rows with item_id, candidate, question, answer.

    Each round asks about the rows not finished yet, all at once: a finished row's answer is parsed, one that asks for
    evidence gets it and stays. Rows that never finish with a chain get one from their thoughts and evidence.
    """
    rows = rows.withColumn("transcript", F.concat(F.lit("Question: "), F.col("question"), F.lit("\nAnswer: "), F.col("answer")))
    active = rows.withColumns({"thoughts": F.array().cast("array<string>"), "seen": F.array().cast("array<string>"), "response": F.lit("")})
    finished = None
    for number in range(1, rounds + 1):
        prompt = F.concat("transcript", F.lit("\nWhat is your next Thought and Action?"))
        said = materialise(answered(active.drop("response").withColumn("p", prompt), "p", "response", models.thinker).drop("p"), "react")
        thought, action = parsing.thought_and_action(F.col("response"))
        said = said.withColumns({"thought": thought, "action": action})
        said = said.withColumn("thoughts", F.array_append("thoughts", F.col("thought"))).withColumn("react_rounds", F.lit(number))
        over = said.where((F.col("action") == "FINISH") | F.lit(number == rounds))
        finished = over if finished is None else finished.unionByName(over, allowMissingColumns=True)
        going = said.where((F.col("action") != "FINISH") & F.lit(number < rounds))
        wanted = F.trim(F.regexp_extract("action", r"^retrieve:(.*)$", 1))
        if models.lookup:
            key = F.concat_ws("/", "item_id", "candidate")
            got = looked_up(going.select(key.alias("query_id"), wanted.alias("text")).where("text <> ''"), models.lookup)
            going = going.withColumn("query_id", key).join(got.select("query_id", "evidence"), "query_id", "left").drop("query_id")
        else:
            going = going.withColumn("evidence", F.lit(None).cast("string"))
        seen = F.coalesce("evidence", F.lit(""))
        more = F.concat("transcript", F.lit(f"\nThought {number}: "), F.col("thought"), F.lit(f"\nObservation {number}:\n"), seen)
        active = materialise(going.withColumn("transcript", more).withColumn("seen", F.array_append("seen", seen)).drop("evidence", "thought", "action", "react_rounds"), "react-active")
    parsed = parsing.chain_steps(F.col("response"))
    steps = F.when(F.size(F.coalesce(parsed, _empty_steps())) > 0, parsed).otherwise(from_thoughts(F.col("answer"), F.col("thoughts"), F.col("seen")))
    return finished.withColumn("steps", steps).drop("response", "transcript", "thought", "action", "thoughts", "seen")


def from_thoughts(answer: Column, thoughts: Column, seen: Column) -> Column:
    """A chain of the first thought, each piece of evidence with the thought after it, and the answer."""

    def step(kind: str, content: Column, proof: Column, sure: str) -> Column:
        return F.struct(F.lit(0).alias("step"), F.lit(kind).alias("type"), content.alias("content"), proof.alias("evidence"), F.lit(sure).alias("confidence")).cast(schemas.STEP)

    none = F.lit(None).cast("string")
    first = F.when(F.size(thoughts) > 0, F.array(step("context_setup", F.get(thoughts, F.lit(0)), none, "medium"))).otherwise(_empty_steps())
    facts = F.transform(seen, lambda e, i: step("evidence_integration", F.coalesce(F.nullif(F.get(thoughts, i + 1), F.lit("")), e), e, "medium"))
    facts = F.filter(facts, lambda s: F.coalesce(s["evidence"], F.lit("")) != "")
    last = step("conclusion", F.concat(F.lit("Therefore, the answer is: "), F.substring(answer, 1, 200)), none, "high")
    return chains.reindexed(F.concat(first, facts, F.array(last)))


def draft(items: DataFrame, models: Models) -> DataFrame:
    """One chain per item: hard items get three candidates, the model groups their conclusions, the best one stays."""
    tries = items.select("item_id", "question", "answer", F.explode(F.sequence(F.lit(0), chains.samples_for(F.col("difficulty")) - 1)).alias("candidate"))
    made = materialise(react(tries, models), "candidates")
    said = made.groupBy("item_id").agg(F.count("*").cast("int").alias("n"), F.sort_array(F.collect_list(F.struct("candidate", chains.conclusion_text(F.col("steps")).alias("c")))).alias("all"))
    listed = F.array_join(F.transform("all", lambda x: F.concat(F.lit("["), x["candidate"].cast("string"), F.lit("] "), x["c"])), "\n")
    many = said.where("n > 1").withColumn("p", F.concat(F.lit("Group the conclusions that agree, as JSON with clusters of indices.\n"), listed))
    grouped = answered(many, "p", "said", models.thinker).select("item_id", parsing.clusters(F.col("said"), F.col("n")).alias("clusters"))
    grouped = materialise(grouped.where("clusters is not null"), "clusters")
    best = chain_ops.select_candidates(made.select("item_id", "candidate", "steps", "react_rounds"), grouped)
    chosen = items.join(best.select("item_id", "steps", "react_rounds", F.col("candidate").alias("self_consistency_selected")), "item_id")
    return socratic(chosen, models)


def review(items: DataFrame, models: Models, feedback: Column | None = None) -> DataFrame:
    """Adds ``unified``, the review's actions: logic for all, facts for all but easy ones, then both joined; and appends
    both critiques to ``critiques``, array<struct<phase, issues>>, with issues as JSON.

    Each factual step is shown with what was found for it, in the order of the steps, and the question with what was
    found to fill gaps.
    """
    if "critiques" not in items.columns:
        items = items.withColumn("critiques", F.array().cast(CRITIQUES))
    text = chains.chain_text(F.col("steps"))
    rows = items.withColumn("p", F.concat(F.lit("List the logical issues as a JSON array.\n"), text))
    rows = answered(rows, "p", "logic", models.reviewer).drop("p")
    if models.lookup:
        about = F.transform(chains.factual_steps(F.col("steps")), lambda s: F.struct(F.concat(F.lit("Step "), s["step"].cast("string"), F.lit(": ")).alias("label"), s["content"].alias("text")))
        gap = F.struct(F.lit(None).cast("string").alias("label"), F.col("question").alias("text"))
        asked = rows.where("difficulty <> 'easy'").select("item_id", F.posexplode(F.concat(about, F.array(gap))).alias("at", "q"))
        asked = materialise(asked.select(F.concat_ws("/", "item_id", "at").alias("query_id"), "item_id", "at", "q.label", "q.text"), "fact-queries")
        got = looked_up(asked.select("query_id", "text"), models.lookup).where("evidence is not null and evidence <> ''")
        got = asked.select("query_id", "item_id", "at", "label").join(got, "query_id")
        facts = F.transform(F.array_sort(F.collect_list(F.when(F.col("label").isNotNull(), F.struct("at", F.concat("label", "evidence").alias("line"))))), lambda x: x["line"])
        got = got.groupBy(F.col("item_id").alias("f_item")).agg(F.nullif(F.array_join(facts, "\n"), F.lit("")).alias("facts"), F.max(F.when(F.col("label").isNull(), F.col("evidence"))).alias("gaps"))
        rows = rows.join(got, rows["item_id"] == got["f_item"], "left").drop("f_item")
    else:
        rows = rows.withColumns({"facts": F.lit(None).cast("string"), "gaps": F.lit(None).cast("string")})
    shown = [F.coalesce("facts", F.lit("No fact-check evidence retrieved.")), F.lit("\nFor gaps:\n"), F.coalesce("gaps", F.lit("No gap-fill evidence retrieved."))]
    ask = F.concat(F.lit("Check against the evidence, list issues as a JSON array.\n"), text, F.lit("\n"), *shown)
    easy = F.col("difficulty") == "easy"
    checked = answered(rows.where(~easy).withColumn("p", ask), "p", "external", models.reviewer).drop("p", "facts", "gaps")
    rows = materialise(checked.unionByName(rows.where(easy).drop("facts", "gaps").withColumn("external", F.lit(None).cast("string"))), "critiques")
    logic, external = prompts.critique_text(parsing.issues(F.col("logic"))), prompts.critique_text(parsing.issues(F.col("external")))
    made = F.array(*[F.struct(F.lit(phase).alias("phase"), F.coalesce(F.to_json(parsing.issues(F.col(c))), F.lit("[]")).alias("issues")) for phase, c in (("A_internal", "logic"), ("B_external", "external"))])
    rows = rows.withColumn("critiques", F.concat("critiques", F.when(easy, F.slice(made, 1, 1)).otherwise(made)))
    rows = rows.withColumn("p", F.concat(F.lit("Join the critiques into actions, as JSON.\n"), logic, F.lit("\n"), external, feedback if feedback is not None else F.lit("")))
    return answered(rows, "p", "said", models.reviewer).withColumn("unified", parsing.unified_actions(F.col("said"))).drop("p", "said", "logic", "external")


def revise(items: DataFrame, models: Models | None = None) -> DataFrame:
    """Adds ``revised``: easy items keep their draft, the others' actions are applied in order.

    With a reviser, actions that lack a text get it from the model, one action of every item at a time: what a model is
    shown is what the actions before have left. Items whose actions lack nothing are revised at once.
    """
    reviser = models.reviser if models else None
    at_once = F.when(F.col("difficulty") == "easy", F.col("steps")).otherwise(chain_ops.apply_actions(F.col("steps"), F.col("unified")))
    if reviser is None:
        return items.withColumn("revised", at_once)
    queue = F.when(F.col("difficulty") == "easy", F.array().cast(schemas.ACTIONS)).otherwise(chain_ops.action_queue(F.col("unified")))
    rows = materialise(items.withColumns({"queue": queue, "state": F.col("steps").cast(schemas.STEPS)}), "revision")
    longest = rows.agg(F.max(F.size("queue"))).first()[0] or 0
    for i in range(longest):
        rows = rows.withColumn("p", chain_ops.text_wanted(F.col("state"), F.get("queue", F.lit(i))))
        asked = answered(rows.where("p is not null"), "p", "written", reviser)
        rows = asked.unionByName(rows.where("p is null").withColumn("written", F.lit(None).cast("string")))
        action = F.get("queue", F.lit(i))
        done = chain_ops.apply_action(F.col("state"), chain_ops.with_text(action, F.col("written")), written=True)
        rows = materialise(rows.withColumn("state", F.when(action.isNull(), F.col("state")).otherwise(done)).drop("p", "written"), "revision")
    final = F.when(F.col("difficulty") == "easy", F.col("steps")).otherwise(chains.reindexed(F.col("state")))
    return rows.withColumn("revised", final).drop("queue", "state")


def socratic(items: DataFrame, models: Models, rounds: int = 3) -> DataFrame:
    """Challenge and revise ``steps``: the model asks, then rewrites; after ``rounds`` without a chain the draft stays."""
    text = chains.chain_text(F.col("steps"))
    rows = answered(items.withColumn("p", F.concat(F.lit("Challenge this reasoning, as a JSON array of questions.\n"), text)), "p", "asked", models.thinker).drop("p")
    questions = F.array_join(F.transform(parsing.challenges(F.col("asked")), lambda c: c["question"]), "\n")
    active = materialise(rows.withColumn("notes", questions).withColumn("better", F.lit(None).cast(schemas.STEPS)).drop("asked"), "challenges")
    for _ in range(rounds):
        open_rows, done = active.where("better is null and notes <> ''"), active.where("better is not null or notes = ''")
        said = materialise(answered(open_rows.withColumn("p", F.concat(F.lit("Revise the chain as JSON, or retrieve: <query>.\n"), text, F.lit("\n"), F.col("notes"))), "p", "said", models.thinker).drop("p"), "socratic")
        wanted, found = parsing.retrieve_request(F.col("said")), parsing.chain_steps(F.col("said"))
        if models.lookup:
            got = looked_up(said.select(F.col("item_id").cast("string").alias("query_id"), wanted.alias("text")).where("text is not null"), models.lookup)
            said = said.join(got.select(F.col("query_id").alias("q"), "evidence"), F.col("item_id").cast("string") == F.col("q"), "left").drop("q")
            said = said.withColumn("better", F.when(wanted.isNull() & (F.size(found) > 0), found))
            said = said.withColumn("notes", F.concat("notes", F.lit("\n"), F.coalesce("evidence", F.lit("")))).drop("evidence")
        else:
            said = said.withColumn("better", F.when(F.size(found) > 0, found))
        active = materialise(said.drop("said").unionByName(done), "socratic-round")
    return active.withColumn("steps", F.coalesce("better", "steps")).drop("better", "notes")


CRITIQUES = "array<struct<phase: string, issues: string>>"


def evaluate(items: DataFrame, models: Models, steps: str = "revised") -> DataFrame:
    """Adds ``scores``: rule-based metrics, two judged ones, their weighted sum and, with a model for it, the perplexity;
    and the judges' notes, ``faithfulness_notes`` and ``logic_notes``."""
    text, rows = chains.chain_text(F.col(steps)), items
    for name in ("faithfulness", "logical_completeness"):
        rows = answered(rows.withColumn("p", F.concat(F.lit(f"Score the {name} of this reasoning from 1 to 5, as JSON.\n"), text)), "p", f"{name}_said", models.evaluator).drop("p")
    if models.log_probs:
        rows = log_probabilities(rows.withColumn("p", text), "p", "log_probs", models.log_probs).drop("p")
    else:
        rows = rows.withColumn("log_probs", F.lit(None).cast("array<double>"))
    rows = materialise(rows, "judged")
    found = chains.auto_metrics(F.col(steps)) | {n: parsing.judge_score(F.col(f"{n}_said")) for n in ("faithfulness", "logical_completeness")}
    names = ("faithfulness", "structure", "information_density", "logical_completeness", "traceability", "step_order")
    scores = F.struct(*[found[n].alias(n) for n in names], F.round(chains.overall(found), 3).alias("overall"), chains.perplexity(F.col("log_probs")).alias("ppl"))
    notes = {"faithfulness_notes": parsing.judge_notes(F.col("faithfulness_said")), "logic_notes": parsing.judge_notes(F.col("logical_completeness_said"))}
    return rows.withColumns({"scores": scores} | notes).drop("faithfulness_said", "logical_completeness_said", "log_probs")


def run(items: DataFrame, models: Models, done: DataFrame | None = None, hard_below: float = 3.0, medium_below: float = 3.0) -> DataFrame:
    """Whole items for those not in ``done``: (item_id, question, answer, question_type, difficulty, steps, unified, revised,
    scores, critiques, metadata, ...).

    ``steps`` is the draft that the last review saw, ``draft`` the first; ``unified`` are the first review's actions.
    Critiques of both rounds are kept. A null or missing question type is Unknown.
    """
    if done is not None:
        items = chain_ops.unfinished(items, done, "item_id")
    kind = F.col("question_type") if "question_type" in items.columns else F.lit(None).cast("string")
    items = items.withColumn("question_type", F.coalesce(kind, F.lit("Unknown")))
    rows = materialise(draft(materialise(classify(items, models.classifier), "classified"), models), "drafts")
    rows = rows.withColumn("draft", F.col("steps"))
    first = materialise(evaluate(revise(materialise(review(rows, models), "reviewed"), models), models), "evaluated")
    again = chains.needs_retry(F.col("difficulty"), F.col("scores.overall"), F.col("scores.faithfulness"), hard_below, medium_below)
    kept, retry = first.where(~again), first.where(again)
    note = prompts.feedback_text(F.col("scores"), F.col("faithfulness_notes"), F.col("logic_notes"))
    retry = retry.withColumns({"steps": F.col("revised"), "first_actions": F.col("unified")})
    second = review(retry.drop("unified", "revised"), models, note).drop("scores", "faithfulness_notes", "logic_notes")
    second = evaluate(revise(materialise(second, "reviewed-again"), models), models)
    second = second.withColumn("unified", F.col("first_actions")).drop("first_actions")
    out = kept.withColumn("retried", F.lit(False)).unionByName(second.withColumn("retried", F.lit(True)))
    metadata = F.struct("classification_raw", chains.samples_for(F.col("difficulty")).alias("n_samples"))
    return out.withColumn("metadata", metadata).drop("classification_raw")
