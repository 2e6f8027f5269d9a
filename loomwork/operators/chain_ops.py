"""Reasoning chains as rows: choosing among candidates, editing by actions, routing and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwork.functions import chains, lexicons, parsing, schemas


def select_candidates(candidates: DataFrame, clusters: DataFrame | None = None) -> DataFrame:
    """One candidate of each item from (item_id, candidate, steps).

    With ``clusters`` (item_id, clusters array<array<int>>): the largest cluster, by total score among equals, and its
    best candidate; items without clusters, and all items without ``clusters``, take their best. Equal scores go to the
    first candidate; candidates without steps are chosen only where no other has any.
    """
    rows = candidates.withColumn("candidate_score", chains.candidate_score(F.col("steps"))).withColumn("has_steps", F.size("steps") > 0)
    if clusters is not None:
        parts = clusters.select("item_id", F.posexplode("clusters").alias("cluster", "members"))
        parts = parts.select("item_id", "cluster", F.size("members").alias("cluster_size"), F.explode("members").alias("candidate"))
        rows = rows.join(parts, ["item_id", "candidate"], "left")
        total = F.sum(F.when(F.col("has_steps"), F.col("candidate_score")).otherwise(0.0)).over(Window.partitionBy("item_id", "cluster"))
        rows = rows.withColumn("cluster_total", F.round(total, 9))
        order = [F.desc_nulls_last("cluster_size"), F.desc_nulls_last("cluster_total"), F.asc_nulls_last("cluster")]
    else:
        order = []
    w = Window.partitionBy("item_id").orderBy(F.desc("has_steps"), *order, F.round("candidate_score", 9).desc(), "candidate")
    out = rows.withColumn("nth", F.row_number().over(w)).where("nth = 1")
    return out.drop("nth", "has_steps", "cluster", "cluster_size", "cluster_total")


def ordered_actions(actions: Column) -> Column:
    """Stable: removals, merges, revisions, insertions, evidence, confidence."""
    names = F.array(*[F.lit(a) for a in lexicons.ACTIONS])
    keyed = F.transform(actions, lambda a, i: F.struct(F.array_position(names, a["action"]).alias("rank"), i.alias("at"), a.alias("action")))
    by_key = F.array_sort(F.transform(keyed, lambda k: F.struct(k["rank"], k["at"])))
    return F.transform(by_key, lambda k: F.get(actions, k["at"]))


def _insert(steps: Column, index: Column, step: Column) -> Column:
    """At a place counted from 0: past the end appends, negative ones count from the end."""
    n = F.size(steps)
    place = F.when(index >= 0, F.least(index, n)).otherwise(F.greatest(n + index, F.lit(0)))
    return F.concat(F.slice(steps, F.lit(1), place), F.array(step), F.slice(steps, place + 1, n))


def action_queue(unified: Column) -> Column:
    """A review's actions in the order of their execution."""
    return ordered_actions(F.concat(unified["priority_actions"], unified["optional_improvements"]))


def apply_actions(steps: Column, unified: Column) -> Column:
    """Priority actions, then optional ones, applied in order; steps are numbered anew at the end.

    Numbers stay as they are until then, so several steps may share one: changes go to the first, removals to all.
    Texts that a model must write come in the parameters (revised_content, new_step, merged); an action without its
    text, or with a type or confidence that does not exist, changes nothing.
    """
    return chains.reindexed(F.aggregate(action_queue(unified), steps.cast(schemas.STEPS), lambda state, a: apply_action(state, a)))


def text_wanted(state: Column, a: Column) -> Column:
    """The prompt for the text that an action lacks; null where it lacks none or its steps do not exist."""
    p, target = a["params"], a["target_step"]
    first = lambda number: F.get(F.filter(state, lambda s: s["step"] == number), 0)
    said = lambda s: F.concat(F.lit("Step "), s["step"].cast("string"), F.lit(": "), s["content"])
    reason = F.coalesce(a["reason"], F.lit(""))
    before = F.filter(state, lambda s: s["step"] <= target)
    around = F.array_join(F.transform(F.slice(before, F.greatest(F.size(before) - 1, F.lit(1)), F.lit(2)), said), "\n")
    form = F.lit('Answer as JSON: {"type": "...", "content": "...", "confidence": "..."}')
    old, one, two = first(target), first(p["step_a"]), first(p["step_b"])
    empty = lambda c: F.coalesce(c, F.lit("")) == ""
    return (
        F.when((a["action"] == "revise_step") & empty(p["revised_content"]), F.concat(F.lit("Rewrite this step, and say nothing else. Why: "), reason, F.lit("\n"), old["content"]))
        .when((a["action"] == "insert_step") & empty(p["new_step"]["content"]), F.concat(F.lit("Write the step that is missing at place "), target.cast("string"), F.lit(". Why: "), reason, F.lit("\n"), around, F.lit("\n"), form))
        .when((a["action"] == "merge_steps") & p["merged"].isNull(), F.concat(F.lit("Merge these two steps into one.\n"), said(one), F.lit("\n"), said(two), F.lit("\n"), form))
    )


def with_text(a: Column, said: Column) -> Column:
    """An action with the text that a model has written for it; as it is where the model said nothing that can be used."""
    p, name = a["params"], a["action"]
    step = parsing.written_step(said)
    new, merged = F.when((name == "insert_step") & (F.coalesce(p["new_step"]["content"], F.lit("")) == ""), step), F.when(name == "merge_steps", step)
    params = F.struct(
        p["evidence"].alias("evidence"),
        p["new_confidence"].alias("new_confidence"),
        F.coalesce(F.nullif(p["revised_content"], F.lit("")), F.when((name == "revise_step") & (said != ""), said)).alias("revised_content"),
        p["step_a"].alias("step_a"),
        p["step_b"].alias("step_b"),
        F.when(new.isNotNull(), F.struct(new["type"], F.coalesce(new["content"], F.lit("")).alias("content"), new["evidence"], new["confidence"])).otherwise(p["new_step"]).alias("new_step"),
        F.when(p["merged"].isNull() & merged.isNotNull(), F.struct(merged["type"], merged["content"], merged["confidence"])).otherwise(p["merged"]).alias("merged"),
    ).cast(schemas.PARAMS)
    return F.when(said.isNull(), a).otherwise(a.withField("params", params))


def apply_action(state: Column, action: Column, written: bool = False) -> Column:
    """One action on the steps. A step to insert needs a text; ``written`` by a model, it may be empty."""
    number = lambda s: F.transform(s, lambda x: x["step"])

    def on_first(state: Column, target: Column, change) -> Column:
        at = F.array_position(number(state), target)
        return F.transform(state, lambda s, i: F.when(i + 1 == at, change(s)).otherwise(s))

    def first_with(state: Column, target: Column) -> Column:
        return F.get(F.filter(state, lambda s: s["step"] == target), 0)

    def known(kind: Column, confidence: Column) -> Column:
        return kind.isin(*lexicons.STEP_TYPES) & confidence.isin(*lexicons.CONFIDENCES)

    def one(state: Column, a: Column) -> Column:
        p, target = a["params"], a["target_step"]
        new = p["new_step"]
        kind, sure = F.coalesce(new["type"], F.lit("knowledge_application")), F.coalesce(new["confidence"], F.lit("medium"))
        step = F.struct(target.alias("step"), kind.alias("type"), new["content"].alias("content"), new["evidence"].alias("evidence"), sure.alias("confidence")).cast(schemas.STEP)
        first, second = first_with(state, p["step_a"]), first_with(state, p["step_b"])
        got = p["merged"]
        merged = F.struct(
            p["step_a"].alias("step"),
            F.coalesce(got["type"], first["type"]).alias("type"),
            F.coalesce(got["content"], F.concat(first["content"], F.lit(" "), second["content"])).alias("content"),
            F.coalesce(F.nullif(first["evidence"], F.lit("")), second["evidence"]).alias("evidence"),
            F.coalesce(got["confidence"], first["confidence"]).alias("confidence"),
        ).cast(schemas.STEP)
        rest = F.filter(state, lambda s: ~s["step"].isin(p["step_a"], p["step_b"]))
        sure_new = F.coalesce(p["new_confidence"], F.lit("medium"))
        name = a["action"]
        has_text = new["content"].isNotNull() if written else F.coalesce(new["content"], F.lit("")) != ""
        return (
            F.when(name == "remove_step", F.filter(state, lambda s: s["step"] != target))
            .when((name == "merge_steps") & got.isNotNull() & first.isNotNull() & second.isNotNull() & known(merged["type"], merged["confidence"]), _insert(rest, p["step_a"] - 1, merged))
            .when((name == "revise_step") & (F.coalesce(p["revised_content"], F.lit("")) != ""), on_first(state, target, lambda s: s.withField("content", p["revised_content"])))
            .when((name == "insert_step") & has_text & known(kind, sure), _insert(state, target - 1, step))
            .when(name == "add_evidence", on_first(state, target, lambda s: s.withField("evidence", F.coalesce(p["evidence"], F.lit("")))))
            .when((name == "adjust_confidence") & sure_new.isin(*lexicons.CONFIDENCES), on_first(state, target, lambda s: s.withField("confidence", sure_new)))
            .otherwise(state)
        )

    return one(state, action)


def stratified_sample(rows: DataFrame, stratum: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """min(max(1, n // strata), its size) rows of each stratum, chosen by an MD5 of seed and key; trimmed to n. A null
    stratum is Unknown."""
    rows = rows.withColumn("__stratum", F.coalesce(F.col(stratum).cast("string"), F.lit("Unknown")))
    strata = rows.select("__stratum").distinct().count()
    each = max(1, n // max(1, strata))
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))
    w = Window.partitionBy("__stratum").orderBy(draw, key)
    out = rows.withColumn("__nth", F.row_number().over(w)).where(F.col("__nth") <= each)
    out = out.withColumn("__draw", draw).orderBy("__nth", "__draw", key).limit(n)
    return out.drop("__stratum", "__nth", "__draw")


def unfinished(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Resume: what the checkpoint does not hold, failed items included."""
    return items.join(done.select(key).distinct(), key, "left_anti")


def failure_streaks(outcomes: DataFrame, key: str, order: list[str], failed: Column) -> DataFrame:
    """(key, longest_streak, last_streak) of failures in a row; a success ends one."""
    rows = outcomes.select(key, *order, failed.cast("int").alias("failed"))
    w = Window.partitionBy(key).orderBy(*order)
    rows = rows.withColumn("island", F.sum(1 - F.col("failed")).over(w))
    runs = rows.groupBy(key, "island").agg(F.sum("failed").alias("n"))
    return runs.groupBy(key).agg(F.max("n").alias("longest_streak"), F.max_by("n", "island").alias("last_streak"))


def difficulty_summary(items: DataFrame) -> DataFrame:
    """(difficulty, n, mean_overall): items without scores count, but not in the mean."""
    return items.groupBy("difficulty").agg(F.count("*").alias("n"), F.round(F.avg("overall"), 6).alias("mean_overall"))
