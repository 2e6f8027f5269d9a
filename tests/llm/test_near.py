"""Near copies against brute-force Jaccard over five-word shingles."""

from __future__ import annotations

import random

import corpus_pipeline
from loomwork.llm import near
from tests.llm.test_operators import DOCS, components


def simple_set(text):
    parts = (text or "").encode().lower().split()
    return frozenset(tuple(parts[i : i + 5]) for i in range(max(1, len(parts) - 4))) if parts else frozenset()


def alike(a, b):
    return not a and not b or len(a & b) >= 0.8 * len(a | b)


def edited():
    """Texts with some words replaced, up to both sides of the likeness; a passage in many; copies, blanks, nulls."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefg", k=rng.randint(2, 6))) for _ in range(500)]
    prose = lambda n: rng.choices(vocabulary, k=n)
    passage, texts = prose(30), []
    for _ in range(25):
        base = prose(rng.randint(20, 150))
        for _ in range(8):
            other = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 22))):
                other[rng.randrange(len(other))] = rng.choice(vocabulary)
            texts.append(" ".join(other + prose(rng.randint(0, 3))))
    texts += [" ".join(prose(rng.randint(1, 20)) + passage + prose(rng.randint(1, 10))) for _ in range(40)]
    texts += ["", None, "  ", "one", "One", "one two", "a b c d e", "a b c d e f", texts[0].upper(), texts[0]]
    return [(i, t, "en", "s", 0) for i, t in enumerate(texts)]


def test_near_dedup_keeps_one_of_each_group_by_jaccard(spark):
    rows = edited()
    sets = [simple_set(r[1]) for r in rows]
    root = components(sets, alike)
    least = {x: min(r[0] for r, y in zip(rows, root) if y == x) for x in set(root)}
    docs = spark.createDataFrame(rows, DOCS)
    assert 40 < len(least) < len(rows) - 50
    assert {(r.doc_id, r.component_id) for r in near.components(docs).collect()} == {(r[0], least[x]) for r, x in zip(rows, root)}
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(least.values())


def test_near_dedup_of_nothing_and_of_rows_without_id(spark):
    assert near.keep_one(spark.createDataFrame([], DOCS)).collect() == []
    text = "a b c d e f g h"
    rows = [(None, text, "en", "s", 0), (7, text, "en", "s", 0), (7, text, "en", "s", 0), (8, text + " i", "en", "s", 0), (None, "x", "en", "s", 0)]
    got = near.keep_one(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, text), (0, "x"), (7, text)]


def nothing(names):
    import pyarrow as pa

    def run(batches):
        for _ in batches:
            pass
        yield pa.RecordBatch.from_arrays([pa.array([], pa.int32() if n in ("n", "pos") else pa.int64()) for n in names], names=names)

    return run


def test_simhash_alone_links_what_its_fingerprints_show(spark, monkeypatch):
    """Without the prefix filter: near fingerprints are linked if their sets are alike, and only then."""
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefg", k=rng.randint(2, 6))) for _ in range(500)]
    texts = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=3000)
        texts += [" ".join(base), " ".join([*base, "end"]), " ".join(["start", *base]), " ".join(base[: rng.randint(5, 40)])]
    texts += ["", None, texts[0].upper()]
    monkeypatch.setattr(near, "_shared", nothing(["key", "sig", "n", "pos", "pick", "before"]))
    monkeypatch.setattr(near, "_across", nothing(["a", "b", "na", "nb", "shared"]))
    sets = [simple_set(t) for t in texts]
    prints = [near.simhash.majority(near.shingles(t)) for t in texts]
    root = components(list(range(len(texts))), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2 and alike(sets[i], sets[j]))
    want = {i: min(j for j, x in enumerate(root) if x == root[i]) for i in range(len(texts))}
    assert len(set(want.values())) < len(texts) - 15
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.component_id for r in near.components(docs).collect()} == want


def test_near_fingerprints_of_unlike_texts_are_no_link(spark, monkeypatch):
    texts = ["a b c d e f", "g h i j k l", "a b c d e f", "x"]
    monkeypatch.setattr(near, "_prints", lambda words: forged)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near.components(docs).collect()} == {0: 0, 1: 1, 2: 0, 3: 3}


def forged(batches):
    """Every text under the same fingerprint."""
    import pyarrow as pa

    for batch in batches:
        sigs = [near.signature(near.shingles(t.as_py())) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigs, pa.int64()), batch.column(2), pa.array([5] * batch.num_rows, pa.int64())], names=["doc_id", "sig", "key", "fp"])
