from __future__ import annotations

import random

from loomwork.llm import substrings


def kept(rows: list[tuple[int, str]]) -> dict[int, int]:
    """Words removed of each document, by force; rows in ascending order of ids."""
    first, out, n = {}, {}, substrings.WINDOW
    for doc, text in rows:
        words = text.split()
        gone = [False] * len(words)
        for i in range(len(words) - n + 1):
            if first.setdefault(tuple(words[i : i + n]), doc) < doc:
                gone[i : i + n] = [True] * n
        out[doc] = sum(gone)
    return out


def counted(monkeypatch) -> dict[str, list]:
    """What is materialised from now on, by name."""
    seen: dict[str, list] = {}
    plain = substrings.materialise

    def materialise(df, name):
        out = plain(df, name)
        seen.setdefault(name, []).append([tuple(r) for r in out.collect()])
        return out

    monkeypatch.setattr(substrings, "materialise", materialise)
    return seen


def test_chunks_are_read_again_only_for_more_than_an_even_part_of_the_requests(spark, monkeypatch):
    rng = random.Random(3)
    passages = [" ".join(f"p{rng.randrange(10**6)}" for _ in range(15)) for _ in range(6000)]
    rows = [(0, " ".join(passages))] + [(i + 1, f"a{i} {p} b{i}") for i, p in enumerate(passages)]
    seen = counted(monkeypatch)
    got = substrings.dedup(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), batches=2).collect()
    assert {r.doc_id: r.n_removed for r in got} == kept(rows)
    requests, shares = seen["substring-requests"][0], seen["substring-shares"][0]
    assert len(requests) == 6000
    # two chunks hold the documents, so two tasks answer
    assert sum(s for _, s in shares) <= 4


def test_windows_of_spans_that_run_on_are_asked_once(spark, monkeypatch):
    line = [f"w{i}" for i in range(7)]
    rows = [(0, " ".join(line * 4))] + [(i, " ".join([f"a{i}", *line * (20 + i), f"b{i}"])) for i in range(1, 30)]
    asked = []
    differing = substrings._differing
    monkeypatch.setattr(substrings, "_differing", lambda places, spans, *a: (asked.append(spans.count()), differing(places, spans, *a))[1])
    got = substrings.dedup(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), batches=1).collect()
    assert {r.doc_id: r.n_removed for r in got} == kept(rows)
    # seven windows, however long the line runs on in however many documents
    assert asked[1] == 7
