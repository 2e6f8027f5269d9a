from __future__ import annotations

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from loomwork.operators import durable


def test_numbers_run_on_over_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(7)
    rows = durable.numbered(df, ["k"], "n").collect()
    assert {r.k: r.n for r in rows} == {k: k for k in range(1000)}
    assert durable.numbered(df.limit(0), ["k"], "n").collect() == []


def test_clear(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(durable, "folder", lambda s: f"file://{tmp_path}/own")
    made = durable.materialise(spark.range(3), "x")
    assert made.count() == 3 and os.listdir(tmp_path / "own")
    durable.clear(spark)
    assert not os.path.exists(tmp_path / "own")


def test_drop_deletes_what_was_materialised_and_nothing_else(spark, tmp_path):
    made, other = durable.materialise(spark.range(3), "x"), durable.materialise(spark.range(4), "y")
    spark.range(5).write.parquet(f"{tmp_path}/input")
    files = made.inputFiles()
    durable.drop(made, spark.read.parquet(f"{tmp_path}/input"))
    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)
    assert other.count() == 4 and spark.read.parquet(f"{tmp_path}/input").count() == 5


def test_a_cluster_needs_a_shared_folder(spark):
    assert durable.folder(spark).startswith("file:///")
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda key, other: other), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        durable.folder(cluster)


def test_stores(tmp_path):
    store, path = durable.arrow_store(f"file://{tmp_path}/x")
    assert path == f"{tmp_path}/x"
    for bad in (str(tmp_path), "relative/path", "ftp://host/x"):
        with pytest.raises(ValueError):
            durable.arrow_store(bad)
