"""Resumable ingestion: files that land in a folder are read once each, their rows kept once per key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def ingest(spark: SparkSession, landing: str, schema: str, target: str, checkpoint: str, key: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Processes what has landed since the last run and stops; rows whose key the target holds already are left out.

    Each micro-batch joins its keys against the target before it is appended, and the checkpoint remembers the files, so
    a run that was cut off is taken up where it stopped.
    """

    def append(batch: DataFrame, number: int) -> None:
        rows = (transform(batch) if transform else batch).dropDuplicates([key])
        root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
        if root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root):
            rows = rows.join(spark.read.parquet(target).select(key), key, "left_anti")
        rows.write.mode("append").parquet(target)

    stream = spark.readStream.schema(schema).json(landing)
    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
