"""What the engine writes: checkpoints keyed by id, JSON lines, index tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append_checkpoint(rows: DataFrame, path: str) -> None:
    """Finished items are appended; a resumed run reads them and takes up what they do not hold."""
    rows.write.mode("append").parquet(path)


def json_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_index(tables: dict[str, DataFrame], folder: str) -> None:
    """One Parquet table each: passages, vectors, sparse weights, entities, relations, surfaces."""
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{folder}/{name}")
