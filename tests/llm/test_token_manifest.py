"""How many files and tasks the manifest of token files takes."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwork.llm import token_files


def test_small_ranges_share_one_manifest_file_and_the_tasks_that_read_them(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"some words of text {i} " * (i % 7)) for i in range(400)], "doc_id long, text string")
    files = token_files.write(docs)
    parts = files.manifest.count()
    assert parts == 4 and len(files.manifest.inputFiles()) == 1
    few = files.documents().withColumn("task", F.spark_partition_id()).collect()
    assert {r.task for r in few} == {0}
    monkeypatch.setattr(token_files, "READ_IDS", 1)
    many = files.documents().withColumn("task", F.spark_partition_id()).collect()
    assert len({r.task for r in many}) == parts
    strip = lambda rows: sorted(tuple(r)[:4] for r in rows)
    assert strip(few) == strip(many) and [r[0] for r in strip(few)] == list(range(400))
    upto = 0
    for _, start, n, _ in strip(few):
        assert start == upto
        upto += n
