"""What a worker keeps of scored texts."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np

from loomwork.llm import toxicity


def test_kept_scores_do_not_hold_the_vectors():
    rng = random.Random(4)
    terms = sorted({"".join(rng.choices("abcdefghij", k=3)) for _ in range(700)})
    index = toxicity.build([(i, ((i, 1), (i + 1, 1)), i % 2) for i in range(100)], terms, np.ones(len(terms)))
    texts = [" ".join(rng.sample(terms, 400)) for _ in range(200)]
    first = [index.score(t) for t in texts]
    index.known.clear()
    tracemalloc.start()
    for t in texts:
        index.score(t)
    size, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(index.known) == len(texts) and size < 3_000 * len(texts)
    assert [index.score(t) for t in texts] == first
