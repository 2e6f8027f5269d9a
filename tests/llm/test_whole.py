"""Indexes that outlive a call, mixes near their targets, scores end to end, and rows that must not be lost."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomwork.llm import common, embeddings, lines, mixing, near, simhash, substrings, toxicity
from tests.llm.test_operators import DOCS, clashing, corpus, shares, sizes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- op4: batches that come later


def removed(batches: list[list[tuple[int, str]]]) -> dict[int, tuple[int, str]]:
    """By force: words under a window of an earlier batch, or of a smaller id of the same batch."""
    seen, out = set(), {}
    for batch in batches:
        rows = sorted((k, WORD.findall(t or "")) for k, t in batch)
        own = [(k, [tuple(w[i : i + 13]) for i in range(len(w) - 12)], w) for k, w in rows]
        first = {}
        for k, windows, _ in own:
            for x in windows:
                first.setdefault(x, k)
        for k, windows, w in own:
            gone = {j for i, x in enumerate(windows) if x in seen or first[x] < k for j in range(i, i + 13)}
            out[k] = (len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
        seen.update(first)
    return out


def batches_of_passages() -> list[list[tuple[int, str]]]:
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefg", k=3)) for _ in range(200)]
    passages = [" ".join(rng.choices(words, k=30)) for _ in range(6)]
    make = lambda: " ".join([*rng.choices(words, k=15), rng.choice(passages), *rng.choices(words, k=10)])
    # ids of later batches are not always larger
    return [[(1000 - 10 * b + i, make()) for i in range(12)] for b in range(6)]


@pytest.mark.parametrize("bits", [None, 9])
def test_batches_are_added_to_a_saved_index(spark, tmp_path, bits):
    batches = batches_of_passages()
    want, got = removed(batches), {}
    folder = f"file://{tmp_path}/index"
    for n, batch in enumerate(batches):
        index = substrings.Index.create(spark, 10_000, folder, bits) if n == 0 else substrings.Index.open(spark, folder)
        assert index.batches == n
        rows = index.add(spark.createDataFrame(batch, "doc_id long, text string").repartition(3), text=True).collect()
        got |= {r.doc_id: (r.n_removed, r.kept_sha256) for r in rows}
        index.save()
    assert got == want
    # runs were merged on the way
    assert any(level for level in index.levels[1:]) and all(len(level) < substrings.FANOUT for level in index.levels)


def test_dedup_merges_runs_and_keeps_the_largest_id(spark, monkeypatch):
    merged = []
    append = substrings.Index._append
    monkeypatch.setattr(substrings.Index, "_append", lambda self, run, level: (merged.append(level), append(self, run, level)))
    rows = [(i, " ".join(f"w{(i * 7 + j) % 40}" for j in range(30))) for i in range(40)]
    rows += [((1 << 63) - 1, rows[0][1]), (None, rows[1][1]), (None, "alone")]
    got = substrings.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows) and 1 in merged
    assert {r.n_removed for r in got if r.doc_id in (None, (1 << 63) - 1)} == {0, 30}


# --- op1


def test_every_source_comes_near_its_target(spark):
    rng = random.Random(6)
    rows = [(i, "w " * min(5000, int(rng.paretovariate(0.8) * 5)), "en", f"s{rng.choice([0, 0, 0, 1, 2, 3])}", 0) for i in range(1500)]
    got = mixing.op1(spark.createDataFrame(rows, DOCS)).collect()
    _, target = shares(rows)
    source = {r[0]: r[3] for r in rows}
    taken = Counter()
    for r in got:
        assert r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - t) <= 0.02 * t for s, t in target.items())
    assert len(sizes(rows)) == len(got)


# --- op9, end to end


def test_scores_against_brute_force_cosine(spark):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 9))) for _ in range(300)]
    bad = ["vilest", "vilely", "rotten", "scummy"]
    rows, marks = [], []
    for i in range(240):
        toxic = i % 4 == 0
        rows.append((i, " ".join(rng.choices(words, k=rng.randint(5, 60)) + (rng.choices(bad, k=3) if toxic else []))))
        if i % 3:
            marks.append((i, int(toxic)))
    rows += [(500, None), (501, ""), (502, "Vilest vilest")]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}

    import zlib

    text = dict(rows)
    train = [(i, t) for i, t in marks if zlib.crc32(str(i).encode()) % 5]
    found = {i: toxicity.features(text[i]) for i, _ in train}
    n, bad_n = len(train), sum(t for _, t in train)
    df, of_bad = Counter(w for i, _ in train for w in found[i]), Counter(w for i, t in train if t for w in found[i])

    def chi2(w):
        a, b = of_bad[w], df[w] - of_bad[w]
        c, d = bad_n - a, n - bad_n - b
        return n * (a * d - b * c) ** 2 / ((a + b) * (c + d) * bad_n * (n - bad_n)) if df[w] < n else 0.0

    terms = {w for w in df if df[w] >= toxicity.MIN_EXAMPLES and chi2(w) >= 2 * math.log(len(df))}
    idf = {w: math.log((1 + n) / (1 + df[w])) + 1 for w in terms}

    def vector(t):
        v = {w: (1 + math.log(k)) * idf[w] for w, k in toxicity.features(t).items() if w in terms}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()}

    groups: dict[tuple, list[int]] = {}
    for i, t in train:
        key = tuple(sorted((w, k) for w, k in found[i].items() if w in terms))
        own = groups.setdefault(key, [0, 0])
        own[0] += 1
        own[1] += t
    prior = bad_n / n
    empty = groups.pop((), [0, 0])
    for doc, r in got.items():
        v = vector(text[doc])
        if not v:
            assert abs(r.score - (empty[1] + prior) / (empty[0] + 1)) < 1e-9
            continue
        cosines = sorted(((sum(v.get(w, 0.0) * x for w, x in vector_of(key, idf).items()), key) for key in groups), reverse=True)
        cosines = [(c, k) for c, k in cosines if c > 0]
        edge = cosines[: toxicity.NEAREST]
        if len(cosines) > len(edge) and abs(cosines[len(edge)][0] - edge[-1][0]) < 1e-9:
            continue  # a tie at the edge: any of them may be taken
        votes = [(min(c, 1.0) ** toxicity.POWER, groups[k]) for c, k in edge]
        want = (sum(w * g[1] for w, g in votes) + prior) / (sum(w * g[0] for w, g in votes) + 1)
        assert abs(r.score - want) < 1e-9 and r.predicted == int(r.score >= 0.5)
    held = [(r.score >= 0.5, i % 4 == 0) for i, r in got.items() if i < 240 and r.held_out]
    assert np.mean([a == b for a, b in held]) > 0.9


def vector_of(key, idf):
    v = {w: (1 + math.log(k)) * idf[w] for w, k in key}
    size = math.sqrt(sum(x * x for x in v.values()))
    return {w: x / size for w, x in v.items()}


def test_the_sample_bounds_rows(spark):
    docs = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"))
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    assert toxicity.sample_of(docs, labels, 100).count() <= 1


# --- rows that must not be lost


@pytest.mark.parametrize("keep_one", [near.keep_one, simhash.keep_one])
def test_unlike_texts_of_one_id_stay(spark, keep_one):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a, "en", "s", 1), (1, b, "en", "s", 2), (1, b, "en", "s", 2), (2, a, "en", "s", 3), (3, b + " ", "en", "s", 4)]
    got = keep_one(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, a), (1, b)]


def test_stages_keep_rows_and_columns_whatever_their_names(spark):
    rows = corpus()
    docs = clashing(spark.createDataFrame(rows, DOCS))
    labels = spark.createDataFrame([(i, 0) for i in range(30)], "doc_id long, toxic int")
    for stage in (lambda d: toxicity.reject_toxic(d, labels), lines.dedup_lines):
        got = stage(docs)
        assert got.columns == docs.columns and got.count() == len(rows)
    for stage in (near.keep_one, simhash.keep_one, mixing.mix):
        got = stage(docs)
        assert got.columns == docs.columns and 0 < got.count()
    for stage in (near.keep_one, lines.dedup_lines, mixing.mix):
        with pytest.raises(ValueError):
            stage(docs.withColumn("__lw_gone", F.lit(1)))


def test_forests_connect_what_edges_connect():
    rng = np.random.default_rng(3)
    for n in (1, 5, 300):
        u, v = rng.integers(0, 200, n) * 7, rng.integers(0, 200, n) * 7 + 1
        one, two = common.Forest(), common.Forest()
        for a, b in zip(u.tolist(), v.tolist()):
            one.join(a, b)
        fu, fv = embeddings.spanning_edges(u, v)
        for a, b in zip(fu.tolist(), fv.tolist()):
            assert two.find(a) != two.find(b)
            two.join(a, b)
        assert all(one.find(x) == two.find(x) for x in np.r_[u, v].tolist())
