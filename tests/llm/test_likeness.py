"""op5: what the fingerprints say against the true generalised Jaccard likeness."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from loomwork.llm import cws

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def true_likeness(a: str, b: str) -> float:
    x, y = Counter(WORD.findall(a)), Counter(WORD.findall(b))
    total = sum((x | y).values())
    return sum((x & y).values()) / total if total else 1.0


def texts(n: int) -> list[str]:
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdef", k=rng.randint(1, 6))) for _ in range(300)]
    out = []
    for i in range(n):
        words = rng.choices(vocabulary, weights=[1 / (k + 1) for k in range(300)], k=rng.randint(1, 400))
        if i % 3 == 1:
            words = out[-1].split()[:-3] + words[:20]
        out.append(" ".join(words))
    return [*out, "", " \t", "one", "a\x0bb a", "x" * 5000]


def test_near_edited_and_near_next_follow_the_true_likeness(spark):
    rows = sorted(enumerate(texts(200)))
    got = {r.doc_id: r for r in cws.neighbours(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    edited, following = [], []
    for i, (k, text) in enumerate(rows):
        after, half = rows[i - 1][1], len(text) // 2
        edited.append(got[k].near_edited - true_likeness(text, text[: len(text) - half] + after[:half]))
        following.append(got[k].near_next - true_likeness(text, after))
    for error in map(np.array, (edited, following)):
        # a standard error of 0.5 / sqrt(positions) at most
        assert abs(error.mean()) < 0.02 and np.sqrt((error**2).mean()) < 0.5 / np.sqrt(cws.SAMPLES) and abs(error).max() < 0.35
    assert {len(r.fingerprint) for r in got.values()} == {8 * cws.SAMPLES}
    assert got[201].fingerprint == got[200].fingerprint == "0" * 8 * cws.SAMPLES and got[201].near_next == 1.0


def test_the_bound_leaves_the_same_samples(spark):
    rng = random.Random(2)
    rows = [(d, rng.randint(1, 10**12), rng.choice([1, 1, 1, 2, 3, 9, 50])) for d in range(20) for _ in range(rng.choice([1, 5, 300]))]
    df = spark.createDataFrame(rows, "d long, term long, weight long")
    total = df.groupBy("d").agg(F.sum("weight").alias("n")).withColumnRenamed("d", "e")
    free = {(r.d, r.part): r.m for r in cws.drawn(df, ["d"]).collect()}
    with_n = df.join(total, F.col("d") == F.col("e")).drop("e")
    bound = {(r.d, r.part): r.m for r in cws.drawn(with_n, ["d"], words=F.col("n")).collect()}
    assert len(bound) == 20 * cws.SAMPLES // cws.PART and bound == free and all(x is not None for m in bound.values() for x in m)


def test_ranges_split_a_repeated_doc_id(spark):
    rng = random.Random(5)
    rows = [(7 if i % 3 else i, f"{rng.random()} text {i}") for i in range(300)] + [(None, f"{i} none") for i in range(100)] + [(7, "same"), (7, "same")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    ends, n = cws._ranges(df)
    ends = ends.first()["ends"]
    assert n == len(ends) and sum(e["k"] == 7 for e in ends) > 4 and sum(e["k"] == cws.LEAST for e in ends) > 2
    got = cws.neighbours(df).collect()
    assert sorted((r.doc_id or -1) for r in got) == sorted((r[0] or -1) for r in rows)
    order = sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1]))
    want = Counter((r[0], len(r[1]), round(true_likeness(r[1], order[i - 1][1]))) for i, r in enumerate(order))
    assert Counter((r.doc_id, r.n_chars, round(r.near_next)) for r in got) == want
