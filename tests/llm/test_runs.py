"""op6 against maximal repeated runs found by force, and its ranks against the order of suffixes."""

from __future__ import annotations

import hashlib
import random

import pytest

from loomwork.llm import lines

SCHEMA = "doc_id long, text string"


def maximal_runs(texts: list[str], least: int = 5) -> list[set[int]]:
    """For each document, the lines of later copies of maximal repeated runs: every pair of places, grown both ways."""
    docs = [t.split("\n") for t in texts]
    gone: list[set[int]] = [set() for _ in docs]
    places = [(d, i) for d, doc in enumerate(docs) for i in range(len(doc))]
    for n, (d, i) in enumerate(places):
        for e, j in places[n + 1 :]:
            if docs[d][i] != docs[e][j] or (i and j and docs[d][i - 1] == docs[e][j - 1]):
                continue  # not alike, or not the run's first line
            size = 0
            while i + size < len(docs[d]) and j + size < len(docs[e]) and docs[d][i + size] == docs[e][j + size]:
                size += 1
            if sum(len(x.split()) for x in docs[e][j : j + size]) >= least:
                gone[e].update(range(j, j + size))
    return gone


def texts(seed: int) -> list[str]:
    rng = random.Random(seed)
    pool = ["", "a", "b b", "c c c", "one two three four five", "x y", "", " "]
    out = ["\n".join(rng.choices(pool, k=rng.randint(1, 14))) for _ in range(14)]
    out += [out[0], out[1] + "\n" + out[2], "\n".join(["a"] * 12), "", "\n\n"]
    return [f"{t}\nend of {i}" if i % 3 else t for i, t in enumerate(out)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_deleted_lines_are_those_of_maximal_repeated_runs(spark, seed):
    made = texts(seed)
    gone = maximal_runs(made)
    got = {r.doc_id: r for r in lines.digest(spark.createDataFrame(list(enumerate(made)), SCHEMA)).collect()}
    assert sum(map(len, gone)) > 20
    for i, t in enumerate(made):
        kept = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i])
        assert (got[i].n_removed, got[i].kept_sha256) == (len(gone[i]), hashlib.sha256(kept.encode()).hexdigest())


def test_ranks_follow_the_order_of_runs(spark):
    rng = random.Random(3)
    sequence = [rng.randrange(3) for _ in range(120)]
    ranks = lines.rank(spark.createDataFrame(list(enumerate(sequence)), "pos long, id long"), ["id"], "t1")
    width = 1
    while width < 4:
        ranks = lines.double(ranks, width, f"t{2 * width}")
        width *= 2
    runs = {p: tuple(sequence[p : p + width]) for p in range(len(sequence) - width + 1)}
    often = {r for r in runs.values() if list(runs.values()).count(r) > 1}
    got = {r.pos: r for r in ranks.collect()}
    assert set(got) == {p for p, r in runs.items() if r in often}
    for p, r in got.items():
        assert r.first == min(q for q, x in runs.items() if x == runs[p])
        assert r.rank == sum(x in often and x < runs[p] for x in runs.values())
