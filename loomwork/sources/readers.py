"""What the engine reads: JSON arrays, page dumps, index tables, crawl tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomwork.functions import lexicons, markup, schemas, text


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that holds one array of records."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def qa_records(spark: SparkSession, path: str) -> DataFrame:
    """Questions with reasoning traces, the empty ones dropped; a missing type is Unknown."""
    rows = json_array(spark, path, schemas.QA)
    rows = rows.where(F.coalesce(F.col("Reasoning Traces"), F.lit("")) != "")
    return rows.withColumn("Question Type", F.coalesce("Question Type", F.lit("Unknown")))


def articles(spark: SparkSession, path: str) -> DataFrame:
    return json_array(spark, path, schemas.ARTICLE)


def dump_pages(spark: SparkSession, path: str) -> DataFrame:
    """(title, ns, page_id, raw) from a page dump, compressed or not, read by Spark's XML source."""
    schema = "title string, ns long, id long, revision struct<text: struct<_VALUE: string>>"
    rows = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)
    return rows.select(F.trim("title").alias("title"), "ns", F.coalesce("id", F.lit(0)).alias("page_id"), F.col("revision.text._VALUE").alias("raw"))


def dump_articles(
    pages: DataFrame,
    titles: Sequence[str] = lexicons.TITLE_KEYWORDS,
    content: Sequence[str] = lexicons.CONTENT_KEYWORDS,
    common: Sequence[str] = lexicons.COMMON_TITLE_WORDS,
    least: int = 200,
) -> DataFrame:
    """(title, content, raw, url, page_id): articles of the main namespace that pass the gates, one row per title.

    Cheap gates come before the cleaning: namespace, title, redirects, disambiguation. Then stubs go, and pages whose
    content has no keyword unless the title has a common one. ``titles`` is the caller's word list.
    """
    rows = pages.where((F.coalesce("ns", F.lit(0)) == 0) & text.is_topic_title(F.col("title"), titles))
    low = F.lower("raw")
    rows = rows.where(
        ~F.startswith("raw", F.lit("#REDIRECT"))
        & ~F.startswith("raw", F.lit("#redirect"))
        & ~F.contains(F.substring(low, 1, 500), F.lit("{{disambig"))
        & ~F.contains(F.substring(low, 1, 200), F.lit("{{redirect"))
    )
    rows = rows.withColumn("content", markup.clean_wikitext(F.col("raw"))).where(F.char_length("content") >= least)
    lowered = list(dict.fromkeys(k.lower() for k in content))
    rows = rows.where(text.contains_any(F.col("content"), lowered) | text.contains_any(F.col("title"), common))
    first = Window.partitionBy("title").orderBy("page_id")
    rows = rows.withColumn("nth", F.row_number().over(first)).where("nth = 1").drop("nth")
    url = F.concat(F.lit("https://en.wikipedia.org/wiki/"), F.replace("title", F.lit(" "), F.lit("_")))
    return rows.select("title", "content", "raw", url.alias("url"), "page_id")


def category_titles(members: DataFrame, roots: DataFrame, most: int = 500, subcategories: bool = True) -> DataFrame:
    """Distinct titles of (category, member, kind) rows under ``roots`` (category), one level of topical subcategories deep.

    At most ``most`` members count per category; a category is visited once.
    """
    wanted = roots.select("category").distinct()
    if subcategories:
        below = members.where("kind = 'subcat'").join(wanted, "category").select(F.col("member").alias("category"))
        wanted = wanted.union(below.where(text.is_topic_category(F.col("category")))).distinct()
    w = Window.partitionBy("category").orderBy("member")
    pages = members.where("kind = 'page'").join(wanted, "category").withColumn("nth", F.row_number().over(w))
    return pages.where(F.col("nth") <= most).select(F.col("member").alias("title")).distinct()


def follow_links(edges: DataFrame, seeds: DataFrame, depth: int = 1, most: int = 3000, titles: Sequence[str] = lexicons.TITLE_KEYWORDS) -> DataFrame:
    """(title, hop): titles reached from ``seeds`` over (title, link) within ``depth`` hops, by hop and title, ``most`` of them.

    Links must pass the title gate; what was seen, taken or rejected, is not looked at again.
    """
    seen = seeds.select("title").distinct().withColumn("hop", F.lit(0))
    front = seen
    for hop in range(1, depth + 1):
        found = front.select("title").join(edges, "title").select(F.col("link").alias("title")).distinct()
        found = found.join(seen.select("title"), "title", "left_anti").where(text.is_topic_title(F.col("title"), titles))
        front = found.withColumn("hop", F.lit(hop))
        seen = seen.unionByName(front)
    return seen.orderBy("hop", "title").limit(most)


def index_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables that ``writers.write_index`` wrote, by name; what is absent is left out, so a graph is optional."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in store.listStatus(root) if s.isDirectory()] if store.exists(root) else []
    return {n: spark.read.parquet(f"{folder}/{n}") for n in sorted(names)}
