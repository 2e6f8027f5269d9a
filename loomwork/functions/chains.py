"""Columns over reasoning chains (arrays of steps): metrics, scores and texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomwork.functions import lexicons as lex
from loomwork.functions.text import words


def _has(value: Column) -> Column:
    return F.coalesce(value, F.lit("")) != ""


def _share(steps: Column, keep) -> Column:
    n = F.size(steps)
    return F.when(n > 0, F.size(F.filter(steps, keep)) / n).otherwise(0.0)


def types_of(steps: Column) -> Column:
    return F.transform(steps, lambda s: s["type"])


def structure(steps: Column) -> Column:
    """A fifth each: a context, a conclusion, 3 to 7 steps, contents over 20 characters, the conclusion last."""
    types, n = types_of(steps), F.size(steps)
    concludes = F.array_contains(types, "conclusion")
    long_enough = F.forall(steps, lambda s: F.char_length(F.regexp_replace(F.coalesce(s["content"], F.lit("")), r"(?U)^\s+|\s+\z", "")) > 20)
    checks = (F.array_contains(types, "context_setup"), concludes, n.between(3, 7), long_enough, concludes & (F.get(types, n - 1) == "conclusion"))
    score = F.lit(0.0)
    for check in checks:
        score = score + F.when(check, 0.2).otherwise(0.0)
    return F.when(n > 0, score).otherwise(0.0)


def is_cjk(text: Column) -> Column:
    return _cjk_count(text) > F.char_length(text) * 0.3


def _cjk_count(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text, "[^一-鿿㐀-䶿]", ""))


def density(text: Column, filler: Sequence[str] = lex.FILLER_WORDS, stopchars: str = lex.CJK_STOPCHARS) -> Column:
    """Share of words that are not filler; for mostly Chinese text, of characters that are not stop characters."""
    text = F.coalesce(text, F.lit(""))
    own = words(F.lower(text))
    plain = F.size(F.filter(own, lambda w: ~F.btrim(w, F.lit(".,;:!?\"'()[]{}")).isin(*filler)))
    total = _cjk_count(text)
    stops = F.char_length(F.regexp_replace(text, f"[^{stopchars}]", ""))
    latin = F.when(F.size(own) > 0, plain / F.size(own)).otherwise(0.0)
    return F.when(is_cjk(text), F.when(total > 0, F.greatest(F.lit(0.0), (total - stops) / total)).otherwise(0.0)).otherwise(latin)


def content_text(steps: Column) -> Column:
    return F.array_join(F.transform(steps, lambda s: F.coalesce(s["content"], F.lit(""))), " ")


def information_density(steps: Column) -> Column:
    return density(content_text(steps))


def traceability(steps: Column) -> Column:
    return _share(steps, lambda s: _has(s["evidence"]))


def step_order(steps: Column) -> Column:
    """Mean of the checks that apply: context before the first factual step, conclusion last, and not before step 3."""
    types, n = types_of(steps), F.size(steps)
    context, conclusion = F.array_position(types, "context_setup"), F.array_position(types, "conclusion")
    factual = [F.array_position(types, t) for t in lex.FACTUAL_TYPES]
    first = F.least(*[F.when(p > 0, p).otherwise(n + 1) for p in factual])
    checks = F.when(context > 0, 1).otherwise(0) + F.when(conclusion > 0, 2).otherwise(0)
    score = (
        F.when((context > 0) & (context < first), 1.0).otherwise(0.0)
        + F.when((conclusion > 0) & (F.get(types, n - 1) == "conclusion"), 1.0).otherwise(0.0)
        + F.when(conclusion > 2, 1.0).otherwise(0.0)
    )
    return F.when(n < 2, 0.0).when(checks == 0, 1.0).otherwise(score / checks)


def auto_metrics(steps: Column) -> dict[str, Column]:
    found = {"structure": structure(steps), "information_density": information_density(steps), "traceability": traceability(steps), "step_order": step_order(steps)}
    return {name: F.round(value, 3) for name, value in found.items()}


def overall(scores: Mapping[str, Column], weights: Mapping[str, float] = lex.QUALITY_WEIGHTS) -> Column:
    """Judged scores run to 5 and count as fifths."""
    total = F.lit(0.0)
    for name, weight in weights.items():
        value = scores[name] / 5 if name in ("faithfulness", "logical_completeness") else scores[name]
        total = total + value * weight
    return total


def needs_retry(difficulty: Column, overall_score: Column, faithfulness: Column, hard_below: float = 3.0, medium_below: float = 3.0) -> Column:
    """The quality gate. ``overall_score`` runs to 1, so the default bound sends back every hard item."""
    return ((difficulty == "hard") & (overall_score < hard_below)) | ((difficulty == "medium") & (faithfulness < medium_below))


def samples_for(difficulty: Column) -> Column:
    return F.when(difficulty == "hard", 3).otherwise(1)


def candidate_score(steps: Column) -> Column:
    """Step count .30, evidence .35, kinds of steps (of five) .20, high confidence .15."""
    n = F.size(steps)
    count = F.when(n.between(3, 7), 1.0).when(n < 3, n / 3).otherwise(F.greatest(F.lit(0.5), 1.0 - (n - 7) * 0.1))
    kinds = F.size(F.array_distinct(types_of(steps))) / 5
    sure = _share(steps, lambda s: s["confidence"] == "high")
    return F.when(n > 0, count * 0.3 + traceability(steps) * 0.35 + kinds * 0.2 + sure * 0.15).otherwise(0.0)


def conclusion_text(steps: Column) -> Column:
    first = F.get(F.filter(steps, lambda s: s["type"] == "conclusion"), 0)["content"]
    last = F.get(steps, F.size(steps) - 1)["content"]
    return F.coalesce(first, last, F.lit(""))


def factual_steps(steps: Column) -> Column:
    return F.filter(steps, lambda s: s["type"].isin(*lex.FACTUAL_TYPES))


def valid_steps(steps: Column) -> Column:
    """Without steps of unknown type or confidence; a missing number is the place, missing type and confidence defaults."""
    whole = F.transform(
        steps,
        lambda s, i: F.struct(
            F.coalesce(s["step"], (i + 1).cast("int")).alias("step"),
            F.coalesce(s["type"], F.lit("knowledge_application")).alias("type"),
            F.coalesce(s["content"], F.lit("")).alias("content"),
            s["evidence"].alias("evidence"),
            F.coalesce(s["confidence"], F.lit("medium")).alias("confidence"),
        ),
    )
    return F.filter(whole, lambda s: s["type"].isin(*lex.STEP_TYPES) & s["confidence"].isin(*lex.CONFIDENCES))


def chain_text(steps: Column) -> Column:
    """A line per step, its evidence on a line below it."""

    def line(s: Column) -> Column:
        proof = F.when(_has(s["evidence"]), F.concat(F.lit("\n  Evidence: "), s["evidence"])).otherwise("")
        return F.concat(F.lit("Step "), s["step"].cast("string"), F.lit(" ["), s["type"], F.lit("]: "), s["content"], F.lit(" (confidence: "), s["confidence"], F.lit(")"), proof)

    return F.array_join(F.transform(steps, line), "\n")


def enhanced_text(steps: Column) -> Column:
    """Contents and non-empty evidence, in order."""
    parts = F.flatten(F.transform(steps, lambda s: F.array(F.coalesce(s["content"], F.lit("")), s["evidence"])))
    return F.array_join(F.filter(parts, lambda p: p.isNotNull()), " ")


def perplexity(log_probs: Column) -> Column:
    """exp of the mean negative log-probability; null without any."""
    n = F.size(log_probs)
    return F.when(n > 0, F.exp(-F.aggregate(log_probs, F.lit(0.0), lambda a, x: a + x) / n))


def reindexed(steps: Column) -> Column:
    return F.transform(steps, lambda s, i: s.withField("step", (i + 1).cast("int")))
