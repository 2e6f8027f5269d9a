"""Columns over plain text: counts, rule-based scores, gates and query rewriting. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomwork.functions import lexicons as lex

#: \b and \w by Unicode, as in patterns over str.
UNICODE = "(?U)"


def tokens(text: Column) -> Column:
    """Lower-cased words between white space."""
    return words(F.lower(text))


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(UNICODE + pattern))


def sentence_count(text: Column) -> Column:
    return F.greatest(F.lit(1), matches(text, r"[.!?]+(?:\s|\z)"))


def average_sentence_length(text: Column) -> Column:
    return word_count(text) / sentence_count(text)


def _share(raw: Column, full: float) -> Column:
    return F.least(F.lit(1.0), raw / F.lit(float(full)))


def specificity(text: Column) -> Column:
    numbers = matches(text, lex.UNIT_NUMBERS) + matches(text, lex.BARE_NUMBERS)
    return _share(numbers * 2 + matches(text, lex.PROPER_NOUNS) + matches(text, lex.TECHNICAL) * 3, 20)


def evidence(text: Column) -> Column:
    first, *rest = lex.EVIDENCE
    count = matches(text, first)
    for pattern in rest:
        count = count + matches(text, pattern)
    return _share(count, 5)


def actionability(text: Column) -> Column:
    return _share(matches(text, lex.IMPERATIVES), 15)


def coherence(text: Column) -> Column:
    return _share(matches(text, lex.CONNECTIVES), 8)


def structure(text: Column) -> Column:
    raw = matches(text, lex.HEADERS) * 3 + matches(text, lex.NUMBERED) + matches(text, lex.BULLETS) + matches(text, lex.BOLD)
    return _share(raw, 15)


def constraint_coverage(text: Column, question: Column) -> Column:
    """Share of the question's places, practices, crops, conditions and numbers that the text holds; repeats count."""
    question, lowered = F.coalesce(question, F.lit("")), F.lower(F.coalesce(text, F.lit("")))
    small = F.lower(question)
    found = F.concat(
        F.regexp_extract_all(question, F.lit(UNICODE + lex.LOCATIONS), 1),
        *[F.regexp_extract_all(small, F.lit(UNICODE + p), 0) for p in (lex.PRACTICES, lex.CROPS, lex.CONDITIONS)],
        F.regexp_extract_all(question, F.lit(UNICODE + r"\b\d+\b"), 0),
    )
    covered = F.size(F.filter(found, lambda c: F.contains(lowered, F.lower(c))))
    return F.when(F.size(found) == 0, F.lit(0.5)).otherwise(covered / F.size(found))


def score_text(text: Column, question: Column | None = None) -> dict[str, Column]:
    """All nine metrics, rounded; coverage is 0 without a question."""
    coverage = F.lit(0.0)
    if question is not None:
        coverage = F.when(F.coalesce(question, F.lit("")) == "", 0.0).otherwise(F.round(constraint_coverage(text, question), 3))
    return {
        "word_count": word_count(text),
        "sentence_count": sentence_count(text),
        "avg_sent_len": F.round(average_sentence_length(text), 1),
        "specificity": F.round(specificity(text), 3),
        "evidence": F.round(evidence(text), 3),
        "actionability": F.round(actionability(text), 3),
        "coherence": F.round(coherence(text), 3),
        "structure": F.round(structure(text), 3),
        "constraint_coverage": coverage,
    }


def weighted(scores: dict[str, Column], weights: dict[str, float]) -> Column:
    total = F.lit(0.0)
    for name, weight in weights.items():
        total = total + scores[name] * weight
    return F.round(total, 3)


def contains_any(text: Column, keywords: Sequence[str]) -> Column:
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return F.exists(_array(keywords), lambda k: F.contains(lowered, k))


def keyword_hits(text: Column, keywords: Sequence[str] = lex.CONTENT_KEYWORDS) -> Column:
    """How many different keywords a text holds."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return F.size(F.filter(_array(keywords), lambda k: F.contains(lowered, k)))


def is_relevant(text: Column, keywords: Sequence[str] = lex.CONTENT_KEYWORDS, at_least: int = 3, lower: bool = True) -> Column:
    """``lower`` also lower-cases the keywords, without which mixed-case ones never match."""
    own = list(dict.fromkeys(k.lower() for k in keywords)) if lower else keywords
    return keyword_hits(text, own) >= at_least


def is_topic_title(title: Column, keywords: Sequence[str] = lex.TITLE_KEYWORDS) -> Column:
    return contains_any(title, keywords)


def is_topic_category(name: Column, exclude: Sequence[str] = lex.CATEGORY_EXCLUDE, include: Sequence[str] = lex.CATEGORY_INCLUDE) -> Column:
    return ~contains_any(name, exclude) & contains_any(name, include)


def rewrite_query(query: Column, intent: Column) -> Column:
    """For fact checks, question words go from the front, one after another in the order of the list."""
    stripped = query
    for prefix in lex.QUESTION_PREFIXES:
        stripped = F.regexp_replace(stripped, f"(?i)^{prefix}", "")
    return F.when(intent == "fact_check", F.trim(stripped)).otherwise(query)


def extract_entities(query: Column, lexicon: Sequence[str] = lex.ENTITY_LEXICON) -> Column:
    """Terms that the query holds as substrings, sorted."""
    lowered = F.lower(F.coalesce(query, F.lit("")))
    return F.filter(_array(sorted(set(lexicon))), lambda t: F.contains(lowered, t))


def source_label(article: Column, section: Column, prefix: str = "Wikipedia") -> Column:
    return F.concat(F.lit(f"{prefix}: "), F.coalesce(article, F.lit("")), F.lit(", "), F.coalesce(section, F.lit("")))


def _array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])
