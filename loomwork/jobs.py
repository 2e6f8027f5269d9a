"""Jobs that join sources, plans and sinks: dump to articles, articles to index, questions to enriched items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions import lexicons
from loomwork.operators import chain_ops
from loomwork.plans import enrichment, knowledge
from loomwork.plans.models import Chat, Embed
from loomwork.sources import readers, writers

#: Items of one run of the enrichment before they are appended to the checkpoint.
ROUND = 10_000


def dump_to_articles(spark: SparkSession, dump: str, target: str, titles: Sequence[str] = lexicons.TITLE_KEYWORDS) -> DataFrame:
    """Articles of a page dump, written as JSON lines."""
    rows = readers.dump_articles(readers.dump_pages(spark, dump), titles)
    writers.json_lines(rows.drop("raw"), target)
    return spark.read.schema(rows.drop("raw").schema).json(target)


def build_index(spark: SparkSession, articles: str, folder: str, embed: Embed, chat: Chat | None = None, checkpoint: str | None = None) -> dict[str, DataFrame]:
    """The index tables of a file of articles, written below ``folder`` and read again.

    With ``checkpoint``, a run that was stopped takes up graph extraction where it ended.
    """
    writers.write_index(knowledge.build(readers.articles(spark, articles), embed, chat, checkpoint), folder)
    return readers.index_tables(spark, folder)


def enrich(spark: SparkSession, source: str, target: str, models: enrichment.Models, n: int = 1000, seed: int = 42, each: int = ROUND) -> DataFrame:
    """A stratified sample of a file of questions, enriched and appended to ``target`` in rounds of ``each`` items.

    An item's id is a hash of its question and answer, so the same sample is drawn again and what ``target`` holds is not
    asked for a second time.
    """
    rows = readers.qa_records(spark, source).select(
        F.xxhash64("Question", "Answer").alias("item_id"), F.col("Question").alias("question"), F.col("Answer").alias("answer"), F.col("Question Type").alias("question_type")
    )
    sample = chain_ops.stratified_sample(rows.dropDuplicates(["item_id"]), "question_type", "item_id", n, seed)
    store = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    begun = store.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(store)
    done = spark.read.parquet(target).select("item_id") if begun else sample.select("item_id").limit(0)
    left = chain_ops.unfinished(sample, done, "item_id")
    rounds = -(-left.count() // each)
    for i in range(rounds):
        # which round an item is in follows from its id, so a round that was stopped is repeated as it was
        own = left.where(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == i)
        writers.append_checkpoint(enrichment.run(own, models), target)
    return spark.read.parquet(target) if begun or rounds else done
