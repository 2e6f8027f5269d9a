"""The pipeline's stages against plain versions of what they promise, each on its own input."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest

from tests.llm.test_operators import WORD, components, ids_of, kept_lines, shares, simple_hash

import corpus_pipeline
from loomwork.llm import common


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(300)]
    bad = ["vile", "foul", "nasty"]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    shared = prose(20)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 8 == 0
        words = prose(rng.randint(5, 60))
        if toxic:
            words += " " + " ".join(rng.choices(bad, k=2))
        if i % 10 == 3:
            words += "\n" + shared
        rows.append((i, words, "en", f"s{i % 4}" if i % 9 else None, len(words)))
        labels.append((i, 1, int(toxic)))
    rows += [(1000 + i, rows[i][1], "en", "s1", rows[i][4]) for i in range(1, 30, 2)]
    rows += [(2000, None, None, None, None), (2001, "", "en", "s2", 0), (2002, prose(5000), "en", "s3", 1)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    made = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        docs = common.materialise(stage(spark, docs, folder), "test-stage")
        after = [tuple(r) for r in docs.collect()]
        made[name] = after
        if name != "best_fit_packing":
            assert docs.columns == columns
        if name == "toxicity":
            away = {r[0] for r in before} - {r[0] for r in after}
            assert away == {i for i in range(400) if i % 8 == 0}
        if name == "line_dedup":
            assert Counter(r[0] for r in after) == Counter(r[0] for r in before)
            import hashlib

            want = {r[0]: r[3] for r in kept_lines(before)}
            assert all(hashlib.sha256((r[1] or "").encode()).hexdigest() == want[r[0]] for r in after)
            assert all(r[4] == len(r[1]) for r in after if r[1] != dict((b[0], b[1]) for b in before)[r[0]])
        if name == "simhash_near_dedup":
            prints = [simple_hash(r[1]) for r in before]
            root = components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
            want = {min(r[0] for r, y in zip(before, root) if y == x) for x in set(root)}
            assert sorted(r[0] for r in after) == sorted(want)
        if name == "mixing":
            total, target = shares(before)
            taken = Counter()
            for r in after:
                taken[r[3]] += len(WORD.findall(r[1] or ""))
            largest = max(len(WORD.findall(r[1] or "")) for r in before)
            assert set(after) <= set(before) and max(Counter(r[0] for r in after).values()) <= 3
            assert all(abs(taken[s] - t) <= largest for s, t in target.items())
        if name == "best_fit_packing":
            want = Counter()
            for r in before:
                ids = ids_of(r[1], 0)
                want.update((r[0], k, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for k, a in enumerate(range(0, len(ids), 2048)))
            assert Counter((r[0], r[1], r[3], r[4]) for r in after) == want
            bins = defaultdict(list)
            for r in after:
                bins[r[5]].append((r[6], r[3]))
            for b in bins.values():
                at = 0
                for offset, length in sorted(b):
                    assert offset == at
                    at += length
                assert at <= 2048


def test_run_is_its_stages(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert got.count() > 100 and corpus_pipeline.ORACLE_SQL is None
