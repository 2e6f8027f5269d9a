"""Remote models as injected batch functions.

A model is a function from a list of prompts to a list of answers (chat), or of texts to vectors (embedding). It runs
on the executors, once per Arrow batch; a prompt whose call fails three times has an empty answer.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

Chat = Callable[[Sequence[str]], Sequence[str | None]]
Embed = Callable[[Sequence[str]], Sequence[Sequence[float]]]
ATTEMPTS, WAIT = 3, 10.0


def answered(rows: DataFrame, prompt: str, answer: str, model: Chat, attempts: int = ATTEMPTS, wait: float = WAIT) -> DataFrame:
    """Adds the model's answer to the text in ``prompt``; the number of partitions bounds how many calls run at once."""
    schema = T.StructType([*rows.schema.fields, T.StructField(answer, T.StringType())])

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            said: list[str | None] = [None] * len(batch)
            for attempt in range(attempts):
                try:
                    said = list(model(batch[prompt].tolist()))
                    break
                except Exception:
                    if attempt + 1 < attempts:
                        time.sleep(wait * (attempt + 1))
            yield batch.assign(**{answer: [s or "" for s in said]})

    return rows.mapInPandas(call, schema)


def log_probabilities(rows: DataFrame, text: str, out: str, model: Callable[[Sequence[str]], Sequence[Sequence[float] | None]]) -> DataFrame:
    """Adds the tokens' log-probabilities of the text in ``text``; null where the model has none or fails."""
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))])

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            try:
                found = [None if x is None else [float(v) for v in x] for x in model(batch[text].tolist())]
            except Exception:
                found = [None] * len(batch)
            yield batch.assign(**{out: pd.Series(found, dtype=object, index=batch.index)})

    return rows.mapInPandas(call, schema)


def embedded(rows: DataFrame, text: str, vector: str, model: Embed, batch: int = 16) -> DataFrame:
    """Adds unit vectors of the text in ``text``, asked for ``batch`` at a time."""
    schema = T.StructType([*rows.schema.fields, T.StructField(vector, T.ArrayType(T.FloatType()))])

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in batches:
            texts, out = some[text].fillna("").tolist(), []
            for at in range(0, len(texts), batch):
                for v in model(texts[at : at + batch]):
                    norm = sum(x * x for x in v) ** 0.5 or 1.0
                    out.append([float(x / norm) for x in v])
            yield some.assign(**{vector: out})

    return rows.mapInPandas(call, schema)
