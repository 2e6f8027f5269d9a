"""Line dedup by a suffix array over the line-ID sequences of all documents, built by distributed prefix doubling.

The documents' lines form one sequence in the order of (doc_id, text). A line's ID is its place in the order of all
lines' hashes. Doubling takes ranks of runs of 2**k lines to ranks of runs of 2**(k + 1): the pair of ranks at a position
and 2**k further on names the longer run, and its rank is how many positions have a smaller name. So ranks follow the
order of suffixes as far as runs of that length tell them apart, and positions of one rank are an interval of the suffix
array whose longest common prefix is 2**k lines at least. Each interval carries its first position: all others start a
later copy. What is unique sorts apart for good, so only intervals of two or more stay in the next round, and rounds
shrink quickly. The interval of a run of any other length is named by two overlapping runs of a power of two.

Deleted are later copies of maximal repeated runs with MIN_WORDS words or more. A line lies in one exactly if it lies
in a repeated run that is shortest with MIN_WORDS words from its first line on, or from its last line back; so the order
is refined to the longest of these, and deeper order cannot change what is deleted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.common import materialise, reserved, running_sums

#: Words that a repeated run must have to be deleted.
MIN_WORDS = 5


def _key(text) -> F.Column:
    """What tells texts of one doc_id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _lines(min_words: int):
    """One row per line: its 128-bit hash; ``ahead``: lines of the shortest run from it on with enough words (0: none);
    ``back``: lines of the shortest such run that ends with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            size = 0
            for doc, key, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                lines = [x.encode("utf-8", "surrogatepass") for x in (text or "").split("\n")]
                words = np.array([len(x.split()) for x in lines], np.int64)
                upto = np.cumsum(words)
                before = upto - words
                n = np.arange(len(lines))
                end = np.searchsorted(upto, before + min_words, side="left")
                ahead = np.where(end < len(lines), end - n + 1, 0)
                start = np.searchsorted(before, upto - min_words, side="right") - 1
                back = np.where(upto >= min_words, n - start + 1, 0)
                hashes = np.frombuffer(b"".join([xxhash.xxh3_128_digest(x) for x in lines]), np.int64).reshape(-1, 2)
                for column, values in zip(out, ([doc] * len(lines), [key] * len(lines), n, hashes[:, 0], hashes[:, 1], ahead, back)):
                    column.extend(values if isinstance(values, list) else values.tolist())
                size += len(lines)
                if size >= 50_000:
                    yield _batch(out)
                    out, size = [[] for _ in range(7)], 0
            yield _batch(out)

    return run


_LINE_ROWS = "doc_id long, doc_key long, line int, h1 long, h2 long, ahead int, back int"


def _batch(columns: list[list]) -> pa.RecordBatch:
    names = [x.split()[0] for x in _LINE_ROWS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def intervals(rows: DataFrame, name: list[str], label: str) -> DataFrame:
    """(name..., rank, first, n) of names that occur at two positions or more, from rows (pos, name...): an interval of
    the suffix array each, with its rank in the order of names, its first position, and how many positions it holds."""
    repeated = rows.groupBy(*name).agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.count("*").alias("n")).where("first < last")
    ranked = running_sums(repeated.select(*name, "first", "n"), name, [], "n", f"{label}-order")
    return materialise(ranked.withColumnRenamed("before", "rank"), f"{label}-intervals")


def rank(rows: DataFrame, name: list[str], label: str) -> DataFrame:
    """(pos, rank, first) of the rows (pos, name...) whose name occurs at two positions or more."""
    found = intervals(rows, name, label)
    found = found.select(*[F.col(c).alias(f"r_{c}") for c in name], "rank", "first")
    on = [F.col(c) == F.col(f"r_{c}") for c in name]
    return materialise(rows.join(found, on).select("pos", "rank", "first").distinct(), label)


def double(ranks: DataFrame, lines: int, label: str) -> DataFrame:
    """Ranks of runs of 2 * ``lines`` lines from those of ``lines`` lines."""
    ahead = ranks.select((F.col("pos") - lines).alias("at"), F.col("rank").alias("right"))
    pairs = ranks.join(ahead, F.col("pos") == F.col("at")).select("pos", F.col("rank").alias("left"), "right")
    return rank(materialise(pairs, f"{label}-pairs"), ["left", "right"], label)


def removed_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, doc_key, gone): for documents with lines to delete, their numbers."""
    rows = docs.select("doc_id", _key(F.col("text")).alias("doc_key"), "text")
    n = F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long")
    sizes = rows.select("doc_id", "doc_key", n.alias("n_lines")).distinct()
    bases = running_sums(sizes, ["doc_id", "doc_key"], [], "n_lines", "line-bases")
    bases = bases.select(F.col("doc_id").alias("b_id"), F.col("doc_key").alias("b_key"), F.col("before").alias("base"))
    lines = rows.mapInArrow(_lines(min_words), _LINE_ROWS)
    placed = lines.join(bases, F.col("doc_id").eqNullSafe(F.col("b_id")) & (F.col("doc_key") == F.col("b_key")))
    placed = placed.withColumn("pos", F.col("base") + F.col("line"))
    placed = materialise(placed.select("doc_id", "doc_key", "line", "pos", "h1", "h2", "ahead", "back"), "lines")
    ranks = rank(placed.select("pos", "h1", "h2"), ["h1", "h2"], "lines-1")
    starts = placed.where("ahead > 0").select("doc_id", "doc_key", "line", "pos", F.col("ahead").alias("m"))
    ends = placed.where("back > 0").select(
        "doc_id", "doc_key", (F.col("line") - F.col("back") + 1).alias("line"), (F.col("pos") - F.col("back") + 1).alias("pos"), F.col("back").alias("m")
    )
    # runs of one line need no name but their line's; longer ones only where their first line occurs twice
    alone = starts.where("m = 1").join(ranks.where("first < pos"), "pos").select("doc_id", "doc_key", "line", "m")
    runs = starts.where("m > 1").union(ends.where("m > 1")).distinct().join(ranks.select("pos"), "pos")
    runs = materialise(runs, "line-runs")
    longest = runs.agg(F.max("m")).first()[0] or 1
    found, width = alone, 1
    while 2 * width <= longest:
        width *= 2
        ranks = double(ranks, width // 2, f"lines-{width}")
        own = runs.where(F.col("m").between(width, 2 * width - 1))
        left = ranks.select(F.col("pos").alias("p1"), F.col("rank").alias("left"))
        right = ranks.select(F.col("pos").alias("p2"), F.col("rank").alias("right"))
        own = own.join(left, F.col("pos") == F.col("p1")).join(right, F.col("pos") + F.col("m") - width == F.col("p2"))
        own = materialise(own.select("doc_id", "doc_key", "line", "pos", "m", "left", "right"), f"line-runs-{width}")
        least = own.groupBy("m", "left", "right").agg(F.min("pos").alias("least"), F.max("pos").alias("last")).where("least < last")
        least = materialise(least.select(F.col("m").alias("l_m"), F.col("left").alias("l_1"), F.col("right").alias("l_2"), "least"), f"line-copies-{width}")
        same = (F.col("m") == F.col("l_m")) & (F.col("left") == F.col("l_1")) & (F.col("right") == F.col("l_2"))
        copies = own.join(least, same).where("least < pos").select("doc_id", "doc_key", "line", "m")
        found = found.union(copies)
    gone = found.select("doc_id", "doc_key", F.explode(F.sequence("line", F.col("line") + F.col("m") - 1)).alias("line"))
    return gone.groupBy("doc_id", "doc_key").agg(F.collect_set("line").alias("gone"))


def _with_gone(docs: DataFrame, min_words: int) -> DataFrame:
    gone = removed_lines(docs, min_words)
    gone = materialise(gone.select(*[F.col(c).alias(f"__lw_{c}") for c in gone.columns]), "lines-gone")
    same = F.col("doc_id").eqNullSafe(F.col("__lw_doc_id")) & (_key(F.col("text")) == F.col("__lw_doc_key"))
    return docs.join(gone, same, "left").drop("__lw_doc_id", "__lw_doc_key")


def _kept(text: str | None, gone: list[int] | None) -> str | None:
    if not gone:
        return text
    away = set(gone)
    return "\n".join([line for i, line in enumerate((text or "").split("\n")) if i not in away])


def digest(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_sha256) for every row of ``docs`` (doc_id, text).

    Lines end at \\n and are equal if all their characters are. Null and empty texts are one empty line. A null doc_id
    comes before all others. Rows alike in doc_id and text are one document listed twice: both get the same result, and
    neither counts as a copy of the other. An empty table gives an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_lines", "n_removed", "kept_sha256"]
        for batch in batches:
            out = []
            for doc, text, gone in zip(*(batch.column(i).to_pylist() for i in range(3))):
                kept = (_kept(text, gone) or "").encode("utf-8", "surrogatepass")
                out.append((doc, (text or "").count("\n") + 1, len(gone or ()), hashlib.sha256(kept).hexdigest()))
            kinds = pa.int64(), pa.int64(), pa.int64(), pa.string()
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

    rows = _with_gone(docs.select("doc_id", "text"), min_words)
    return rows.select("doc_id", "text", "__lw_gone").mapInArrow(run, "doc_id long, n_lines long, n_removed long, kept_sha256 string")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All rows and columns of ``docs``, texts without the deleted lines; n_chars follows the text where it changes.

    Nulls, empty texts, ties and repeated rows as in ``digest``. Names that begin with ``__lw_`` are refused, others may
    be anything. An empty table gives an empty table.
    """
    reserved(docs)
    columns = docs.columns
    schema = docs.schema
    text_at, gone_at = columns.index("text"), len(columns)
    chars_at = columns.index("n_chars") if "n_chars" in columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = list(batch.columns)
            gone = arrays.pop(gone_at).to_pylist()
            changed = [i for i, g in enumerate(gone) if g]
            if changed:
                texts = arrays[text_at].to_pylist()
                for i in changed:
                    texts[i] = _kept(texts[i], gone[i])
                arrays[text_at] = pa.array(texts, arrays[text_at].type)
                if chars_at is not None:
                    chars = arrays[chars_at].to_pylist()
                    for i in changed:
                        chars[i] = len(texts[i])
                    arrays[chars_at] = pa.array(chars, arrays[chars_at].type)
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return _with_gone(docs, min_words).mapInArrow(run, schema)


OP6_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, i, parts[i] AS line, len(regexp_extract_all(parts[i], '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM docs)
), sums AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY i) AS upto,
         sum(words) OVER (PARTITION BY doc_id ORDER BY i) - words AS before
  FROM lines
), ends AS (SELECT doc_id, upto, min(i) AS i FROM sums GROUP BY doc_id, upto
), starts AS (SELECT doc_id, before, max(i) AS i FROM sums GROUP BY doc_id, before
), runs AS (
  SELECT s.doc_id, s.i AS a, e.i AS b FROM (SELECT doc_id, i, before + 5 AS need FROM sums) s
    ASOF JOIN ends e ON s.doc_id = e.doc_id AND s.need <= e.upto
  UNION
  SELECT s.doc_id, e.i, s.i FROM (SELECT doc_id, i, upto - 5 AS most FROM sums WHERE upto >= 5) s
    ASOF JOIN starts e ON s.doc_id = e.doc_id AND s.most >= e.before
), named AS (
  SELECT r.doc_id, r.a, r.b, array_to_string(list_slice(d.parts, r.a, r.b), chr(10)) AS body
  FROM runs r JOIN docs d USING (doc_id)
), firsts AS (
  SELECT doc_id, a, b, min((doc_id, a)) OVER (PARTITION BY body) < (doc_id, a) AS copy FROM named
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM firsts WHERE copy
), kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
         coalesce(string_agg(CASE WHEN g.i IS NULL THEN l.line END, chr(10) ORDER BY l.i), '') AS body
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id
)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed AS BIGINT) AS n_removed, sha256(body) AS kept_sha256 FROM kept
"""
