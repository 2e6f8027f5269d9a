"""Sections, passages and texts that fit a budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwork.functions.markup import strip
from loomwork.functions.text import word_count
from loomwork.operators.durable import materialise, numbered


def split_sections(articles: DataFrame, key: str, text: str, least: int = 50) -> DataFrame:
    """(key, section_index, title, text): sections under ``== headings ==`` of balanced signs.

    What precedes the first heading is the Introduction; bodies of ``least`` characters or fewer are dropped.
    """
    lines = articles.select(key, F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("line_no", "line"))
    pattern = r"^(={2,6})\s*(.*?)\s*\1\s*$"
    lines = lines.withColumn("is_heading", F.rlike("line", F.lit(pattern)))
    so_far = Window.partitionBy(key).orderBy("line_no")
    lines = lines.withColumn("section_index", F.sum(F.col("is_heading").cast("int")).over(so_far))
    parts = lines.groupBy(key, "section_index").agg(
        F.max(F.when(F.col("is_heading"), F.trim(F.regexp_extract("line", pattern, 2)))).alias("heading"),
        F.sort_array(F.collect_list(F.when(~F.col("is_heading"), F.struct("line_no", "line")))).alias("body"),
    )
    body = strip(F.array_join(F.transform("body", lambda b: b["line"]), "\n"))
    parts = parts.select(key, "section_index", F.coalesce("heading", F.lit("Introduction")).alias("title"), body.alias("text"))
    return parts.where(F.char_length("text") > least)


def pack(parts: Column, most: int) -> Column:
    """Greedy packing of texts, joined by spaces, into texts of ``most`` words; a longer one stays whole."""
    counted = F.transform(parts, lambda p: F.struct(p.alias("text"), word_count(p).alias("n")))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"), F.lit(0).alias("n"))

    def add(state: Column, counted_part: Column) -> Column:
        part, n = counted_part["text"], counted_part["n"]
        full = (state["open"] != "") & (state["n"] + n > most)
        return F.struct(
            F.when(full, F.array_append(state["done"], state["open"])).otherwise(state["done"]).alias("done"),
            F.when(full | (state["open"] == ""), part).otherwise(F.concat(state["open"], F.lit(" "), part)).alias("open"),
            F.when(full, n).otherwise(state["n"] + n).alias("n"),
        )

    return F.aggregate(counted, start, add, lambda s: F.when(s["open"] != "", F.array_append(s["done"], s["open"])).otherwise(s["done"]))


def passages_of(text: Column, most: int = 400) -> Column:
    """A section's passages: paragraphs packed, packs that are too long split at sentences and packed again."""
    paragraphs = F.filter(F.transform(F.split(strip(text), "\n\n"), strip), lambda p: p != "")
    sentences = lambda p: F.split(F.replace(p, F.lit(". "), F.lit(".\n")), "\n")
    return F.flatten(F.transform(pack(paragraphs, most), lambda p: F.when(word_count(p) <= most, F.array(p)).otherwise(pack(sentences(p), most))))


def chunk(articles: DataFrame, key: str, sections: Column, least: int = 100, most: int = 400, ids: bool = True) -> DataFrame:
    """(key, section_index, section_title, passage_index, text[, id]) from ``sections``, an array of (title, text).

    Passages under ``least`` words are dropped after they were counted. With ``ids``, passage_0, passage_1, ... run over
    all articles in the order of key, section and passage.
    """
    rows = articles.select(key, F.posexplode(sections).alias("section_index", "section"))
    rows = rows.where(F.coalesce(strip(F.col("section.text")), F.lit("")) != "")
    rows = rows.select(key, "section_index", F.col("section.title").alias("section_title"), F.posexplode(passages_of(F.col("section.text"), most)).alias("passage_index", "text"))
    rows = rows.where(word_count(F.col("text")) >= least)
    if not ids:
        return rows
    # written before it is dealt by ranges, which reads it twice
    rows = numbered(materialise(rows, "chunks"), [key, "section_index", "passage_index"], "number")
    return rows.withColumn("id", F.concat(F.lit("passage_"), F.col("number").cast("string"))).drop("number")


def budgeted_text(passages: DataFrame, key: str, order: str, section: Column, text: Column, budget: int = 6000, each: int = 500) -> DataFrame:
    """(key, text, n): a group's passages, cut to ``each`` characters and labelled, up to the first that overflows."""
    entry = F.concat(F.lit("["), F.coalesce(section, F.lit("Main")), F.lit("] "), F.substring(F.coalesce(text, F.lit("")), 1, each))
    rows = passages.select(key, order, entry.alias("entry"))
    running = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("upto", F.sum(F.char_length("entry")).over(running)).where(F.col("upto") <= budget)
    grouped = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, "entry"))).alias("kept"))
    return grouped.select(key, F.array_join(F.transform("kept", lambda k: k["entry"]), "\n\n").alias("text"), F.size("kept").alias("n"))


def by_article(passages: DataFrame, article: str = "article_title") -> DataFrame:
    return passages.groupBy(article).agg(F.collect_list(F.struct(*[c for c in passages.columns if c != article])).alias("passages"))
