"""Original and enhanced texts side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomwork.functions import lexicons, text

METRICS = ("word_count", "sentence_count", "avg_sent_len", *lexicons.COMPARISON_WEIGHTS)


def pair(enhanced: DataFrame, original: DataFrame, order: str) -> DataFrame:
    """(question, enhanced_text, original_text): by trimmed question; of repeated originals the last one counts."""
    last = Window.partitionBy(F.trim("question")).orderBy(F.desc(order))
    known = original.withColumn("nth", F.row_number().over(last)).where("nth = 1")
    known = known.select(F.trim("question").alias("key"), F.col("text").alias("original_text"))
    rows = enhanced.select("question", F.trim("question").alias("key"), F.col("text").alias("enhanced_text"))
    return rows.join(known, "key").drop("key")


def unmatched(enhanced: DataFrame, original: DataFrame) -> DataFrame:
    return enhanced.join(original.select(F.trim("question").alias("key")).distinct(), F.trim("question") == F.col("key"), "left_anti")


def scored(pairs: DataFrame) -> DataFrame:
    """Every metric of both texts, their weighted overall, delta and winner."""
    columns = {}
    for side in ("original", "enhanced"):
        scores = text.score_text(F.col(f"{side}_text"), F.col("question"))
        columns |= {f"{side}_{m}": scores[m] for m in METRICS}
        columns[f"{side}_overall"] = text.weighted(scores, lexicons.COMPARISON_WEIGHTS)
    rows = pairs.withColumns(columns)
    before, after = F.col("original_overall"), F.col("enhanced_overall")
    winner = F.when(after > before, "enhanced").when(before > after, "original").otherwise("tie")
    return rows.withColumns({"delta": F.round(after - before, 3), "winner": winner})


def means(rows: DataFrame) -> DataFrame:
    """(metric, original_mean, enhanced_mean, delta); means are null for no rows."""
    names = [*METRICS, "overall"]
    averages = rows.agg(*[F.avg(f"{side}_{m}").alias(f"{side}_{m}") for m in names for side in ("original", "enhanced")])
    each = F.array(*[F.struct(F.lit(m).alias("metric"), F.round(f"original_{m}", 6).alias("original_mean"), F.round(f"enhanced_{m}", 6).alias("enhanced_mean")) for m in names])
    out = averages.select(F.inline(each))
    return out.withColumn("delta", F.round(F.col("enhanced_mean") - F.col("original_mean"), 6))


def win_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(*[F.count_if(F.col("winner") == w).alias(n) for w, n in (("enhanced", "wins"), ("original", "losses"), ("tie", "ties"))])
