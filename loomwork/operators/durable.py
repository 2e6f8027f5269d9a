"""Tables written to the shared folder, which end lineage and outlive executors."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Schemes of Hadoop's that Arrow knows by another name.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "abfs", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs", "file": "file"}


def is_local(spark: SparkSession) -> bool:
    """Whether executors are threads of this process, so that its folders are theirs."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def folder(spark: SparkSession) -> str:
    """This application's part of the shared folder that spark.checkpoint.dir names, as a full URI.

    Where the setting is missing, a local session gets a temporary folder; on a cluster each executor would write to a
    disk of its own and rows would be missing, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + os.path.join(tempfile.gettempdir(), "loomwork-scratch")
    return f"{qualified(spark, root).rstrip('/')}/loomwork/{spark.sparkContext.applicationId}"


def qualified(spark: SparkSession, path: str) -> str:
    """A path as Spark reads it, with scheme and authority: what is written beside Spark lands in the same place."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = str(system.makeQualified(hadoop).toString())
    return "file://" + uri[len("file:") :] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def arrow_store(uri: str):
    """Arrow's file system for a full URI, and the path in it. A path without a scheme, or with one that Arrow cannot
    read, is refused: it would name another place than Spark's."""
    import pyarrow.fs

    scheme, sign, rest = uri.partition("://")
    known = ARROW_SCHEMES.get(scheme.lower())
    if not sign or known is None:
        raise ValueError(f"not a shared store that Arrow and Spark both read: {uri}")
    return pyarrow.fs.FileSystem.from_uri(f"{known}://{rest}")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path there."""
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Deletes what the application has written there; tables that still read it can no longer be read."""
    delete(spark, folder(spark))


def delete(spark: SparkSession, path: str) -> None:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(found, True)


def drop(*tables: DataFrame) -> None:
    """Deletes materialised tables that nothing reads any more."""
    for df in tables:
        own = folder(df.sparkSession)
        for parent in {os.path.dirname(f) for f in df.inputFiles()}:
            full = qualified(df.sparkSession, parent)
            if full.startswith(f"{own}/"):
                delete(df.sparkSession, full)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written as Parquet to the shared folder and read again: lineage ends here."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list, column: str) -> DataFrame:
    """Adds 0, 1, 2, ... in the order of ``order``, without a global window.

    Rows are dealt by ranges of the order and written once; what is counted per range is one row each.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    local = F.monotonically_increasing_id()
    rows = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    rows = materialise(rows.withColumn("__range", F.shiftright(local, 33)).withColumn("__local", local.bitwiseAND((1 << 33) - 1)), "numbered")
    counts = sorted((r["__range"], r["n"]) for r in rows.groupBy("__range").agg(F.count("*").alias("n")).collect())
    before, pairs = 0, []
    for part, count in counts:
        pairs += [F.lit(part), F.lit(before).cast("long")]
        before += count
    base = F.create_map(*pairs)[F.col("__range")] if pairs else F.lit(0).cast("long")
    return rows.withColumn(column, base + F.col("__local")).drop("__range", "__local")
