"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Fitting reads a sample of labelled rows, ``SAMPLE`` at most. Terms are words, beginnings of words, and beginnings that a
text repeats. Plain TF-IDF over all of them finds texts on the same subject, not of the same label, so the cosine is
taken over the terms that tell the labels apart: those whose chi-square over the sample no term would reach by chance,
however many terms there are. idf comes from the sample. Examples with the same vector are one entry with its counts of
both labels, so ties at any distance vote together. Entries lie in blocks; an inverted index holds, for each term, its
postings and its largest weight in each block. A document's blocks are visited by descending upper bound, a few and then
twice as many at a time, until no block can beat the entries found: the nearest are exact. Their votes, weighted by
cosine, give the score; the share of toxic examples is the prior that calibrates it, and the share among examples
without any of the terms is the score of documents without one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.common import give_back, materialise

#: Labelled documents that are read for fitting, at most; chosen by a hash of their ids.
SAMPLE = 20_000
#: Terms at most, and examples that must have a term.
MAX_TERMS, MIN_EXAMPLES = 8192, 4
#: Characters of a word's beginnings, which stand for its inflections and compounds.
BEGINNINGS = (3, 4, 5, 6)
#: How often a text has a beginning, at least, for one more term.
REPEATS = (2, 3, 4, 6)
NEAREST = 16
BLOCK = 64
#: Votes weigh cosine to this power; the prior weighs as one example at cosine 1.
POWER = 4.0
PRIOR_WEIGHT = 1.0

_word = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> dict[str, int]:
    """How often a text has each lower-cased word, each beginning of longer words, marked with ``*``, and beginnings that
    come so often, marked with ``*`` and the number."""
    found = Counter(_word.findall((text or "").lower()))
    starts: dict[str, int] = {}
    for w, n in found.items():
        for size in BEGINNINGS:
            if len(w) > size:
                start = w[:size] + "*"
                starts[start] = starts.get(start, 0) + n
    repeated = {f"{start}{k}": n for start, n in starts.items() if n >= REPEATS[0] for k in REPEATS if n >= k}
    return {**found, **starts, **repeated}


@dataclass
class Index:
    terms: dict[str, int]
    idf: np.ndarray
    #: entries: how many examples, how many of them toxic, and the id of one
    counts: np.ndarray
    toxic: np.ndarray
    example: np.ndarray
    #: postings by term and entry: entry and weight, and where those of each term and block begin
    entry: np.ndarray
    weight: np.ndarray
    block_start: np.ndarray
    block_max: np.ndarray
    prior: float
    empty_share: float
    known: dict = field(default_factory=dict)

    def vector(self, text: str | None) -> tuple[tuple[int, int], ...]:
        """(term, count) pairs of a text, by term."""
        terms = self.terms
        return tuple(sorted((terms[w], n) for w, n in features(text).items() if w in terms))

    def weights(self, vector: tuple[tuple[int, int], ...]) -> np.ndarray:
        term, n = np.array(vector).T
        w = (1 + np.log(n)) * self.idf[term]
        return w / math.sqrt(float(w @ w))

    def nearest(self, vector: tuple[tuple[int, int], ...], k: int = NEAREST) -> tuple[np.ndarray, np.ndarray]:
        """The k entries of largest cosine above 0, and their cosines; entry order breaks ties."""
        query = self.weights(vector)
        terms = np.array([t for t, _ in vector])
        bound = query @ self.block_max[terms]
        order = np.argsort(-bound, kind="stable")
        best_entry, best = np.empty(0, np.int64), np.empty(0)
        at, size = 0, 4
        while at < len(order):
            blocks = order[at : at + size]
            least = max(1e-15, best[k - 1] - 1e-12) if len(best) >= k else 1e-15
            blocks = blocks[bound[blocks] >= least]
            if not len(blocks):
                break
            begin, end = self.block_start[terms][:, blocks], self.block_start[terms][:, blocks + 1]
            counts = (end - begin).ravel()
            upto = np.cumsum(counts)
            place = np.arange(upto[-1]) + np.repeat(begin.ravel() - (upto - counts), counts)
            slot = np.repeat(np.tile(np.arange(len(blocks)), len(terms)), counts) * BLOCK + self.entry[place] % BLOCK
            weight = self.weight[place] * np.repeat(np.repeat(query, len(blocks)), counts)
            scores = np.bincount(slot, weight, len(blocks) * BLOCK)
            some = np.flatnonzero(scores > 0)
            best_entry = np.r_[best_entry, blocks[some // BLOCK] * BLOCK + some % BLOCK]
            best = np.r_[best, scores[some]]
            first = np.lexsort((best_entry, -best))[:k]
            best_entry, best = best_entry[first], best[first]
            at, size = at + size, size * 2
        return best_entry, best

    def score(self, text: str | None) -> tuple[float, list[tuple[int, float, float]]]:
        """Score, and as evidence the three nearest entries: an example's id, cosine, share of toxic labels."""
        vector = self.vector(text)
        if not vector:
            return self.empty_share, []
        # by digest: the vectors themselves would take most of a worker's memory
        key = xxhash.xxh3_128_digest(np.array(vector, np.int64).tobytes())
        if key not in self.known:
            if len(self.known) > 20_000:
                self.known.clear()
            entry, cosine = self.nearest(vector)
            vote = np.minimum(cosine, 1.0) ** POWER
            n, toxic = vote @ self.counts[entry], vote @ self.toxic[entry]
            score = (toxic + PRIOR_WEIGHT * self.prior) / (n + PRIOR_WEIGHT)
            shares = self.toxic[entry] / self.counts[entry]
            evidence = list(zip(self.example[entry][:3].tolist(), cosine[:3].tolist(), shares[:3].tolist()))
            self.known[key] = float(min(max(score, 0.0), 1.0)), evidence
        return self.known[key]


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample_of(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(doc_id, text, toxic) of ``sample`` training documents at most.

    A doc_id with several labels counts as toxic if one says so; of a doc_id with several texts the least is read, so
    that rows are bounded, not ids alone. Null labels and null ids are left out.
    """
    train = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
    train = train.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    train = train.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = train.select(F.col("doc_id").alias("label_id"), "toxic")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return materialise(rows.select("doc_id", "text", "toxic"), "toxic-sample")


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, bad = Counter(), Counter()
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            own = features(text).keys()
            total.update(own)
            if toxic:
                bad.update(own)
        terms = list(total)
        columns = [pa.array(terms, pa.string()), pa.array([total[t] for t in terms], pa.int64()), pa.array([bad[t] for t in terms], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["term", "n", "bad"])


def build(examples: list[tuple[int, tuple[tuple[int, int], ...], int]], terms: list[str], idf: np.ndarray) -> Index:
    """The index of examples (id, vector, toxic)."""
    n, bad = len(examples), sum(x[2] for x in examples)
    empty = [x for x in examples if not x[1]]
    prior = bad / n if n else 0.0
    empty_share = (sum(x[2] for x in empty) + prior) / (len(empty) + 1)
    groups: dict[tuple, list[int]] = {}
    for doc, vector, toxic in sorted(examples):
        if vector:
            own = groups.setdefault(vector, [0, 0, doc])
            own[0] += 1
            own[1] += toxic
    vectors = sorted(groups)  # entries that share words lie together, so block bounds are tight
    index = Index({t: i for i, t in enumerate(terms)}, idf, *(np.array([groups[v][i] for v in vectors], np.int64) for i in range(3)), *[np.empty(0)] * 4, prior, empty_share)
    rows = [(t, e, w) for e, v in enumerate(vectors) for (t, _), w in zip(v, index.weights(v))]
    rows.sort()
    term = np.array([r[0] for r in rows], np.int64)
    index.entry = np.array([r[1] for r in rows], np.int64)
    index.weight = np.array([r[2] for r in rows], np.float64)
    blocks = -(-len(vectors) // BLOCK)
    index.block_max = np.zeros((len(terms), blocks))
    # in the order of (term, entry), postings of a term and block are a range
    where = term * (blocks + 1) + index.entry // BLOCK
    index.block_start = np.searchsorted(where, np.arange(len(terms) * (blocks + 1))).astype(np.int32).reshape(len(terms), blocks + 1)
    np.maximum.at(index.block_max, (term, index.entry // BLOCK), index.weight)
    return index


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, max_terms: int = MAX_TERMS) -> Index:
    """The index. What reaches the driver are ``sample`` vectors of ``max_terms`` terms at most, and sums."""
    rows = sample_of(docs, labels, sample)
    total = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    n, bad = int(total[0]), int(total[1])
    counts = rows.mapInArrow(_term_counts, "term string, n long, bad long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    counts = materialise(counts, "toxic-terms")
    a, b = F.col("bad").cast("double"), (F.col("n") - F.col("bad")).cast("double")
    c, d = bad - a, (n - bad) - b
    chi2 = n * (a * d - b * c) * (a * d - b * c) / ((a + b) * (c + d) * (a + c) * (b + d))
    chosen = counts.where(F.col("n").between(MIN_EXAMPLES, n - 1) if 0 < bad < n else F.lit(False)).withColumn("chi2", chi2)
    # the largest of so many chi-squares stays below this where words and labels have nothing to do with each other
    least = 2 * math.log(max(2, counts.count()))
    chosen = chosen.where(F.col("chi2") >= least).orderBy(F.desc("chi2"), "term").limit(max_terms).collect()
    chosen = sorted((r["term"], r["n"]) for r in chosen)
    terms = [t for t, _ in chosen]
    idf = np.array([math.log((1 + n) / (1 + df)) + 1 for _, df in chosen])
    places = {t: i for i, t in enumerate(terms)}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted((places[w], m) for w, m in features(t).items() if w in places) for t in batch.column("text").to_pylist()]
            own = [pa.array([[v[i] for v in f] for f in found], pa.list_(pa.int32())) for i in range(2)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *own, batch.column("toxic")], names=["doc_id", "terms", "counts", "toxic"])

    got = rows.mapInArrow(vectors, "doc_id long, terms array<int>, counts array<int>, toxic int").collect()
    return build([(r["doc_id"], tuple(zip(r["terms"], r["counts"])), r["toxic"]) for r in got], terms, idf)


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) for every row of ``docs`` (doc_id, text).

    A score depends on the text alone. Null and empty texts score the share of toxic examples without any word of the
    vocabulary. Without usable labels the vocabulary is empty and every score 0. Rows that repeat a doc_id are scored
    each; a null doc_id is not held out. An empty table gives an empty table.
    """
    index = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        kind = pa.list_(pa.struct([("example_id", pa.int64()), ("cosine", pa.float64()), ("toxic_share", pa.float64())]))
        for batch in batches:
            found = [own.score(t.as_py()) for t in batch.column(2)]
            scores = np.array([s for s, _ in found], np.float64)
            evidence = pa.array([[dict(zip(("example_id", "cosine", "toxic_share"), e)) for e in ev] for _, ev in found], kind)
            columns = [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)), evidence]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted", "evidence"])
        give_back()

    schema = "doc_id long, held_out boolean, score double, predicted int, evidence array<struct<example_id: long, cosine: double, toxic_share: double>>"
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(run, schema)


def reject_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Rows of ``docs`` whose text is not predicted toxic, all columns kept, whatever their names.

    Null and empty texts are judged like texts without any term; repeated rows stay or go together. Without usable
    labels every row stays. An empty table gives an empty table.
    """
    index = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            yield batch.filter(pa.array([own.score(t.as_py())[0] < 0.5 for t in batch.column(place)], pa.bool_()))
        give_back()

    return docs.mapInArrow(run, docs.schema)
