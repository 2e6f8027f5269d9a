"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected some number of times in the mix. Expected copies are prefix-summed within the
source; one random offset is added, and a document is emitted once for each integer boundary that its step of the sum
crosses. The LARGEST documents of a source come first, by descending size, and each expects what is then left of the
target as a share of what is left of the source: what a large document takes too much or too little is made up for by
those after it. All others, by ascending size, share what is left of the target evenly. So a source's taken words miss its
target by about one of its smallest documents, or by the largest of the others, which holds less than a part in LARGEST of
the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomwork.llm.common import count_words, materialise, reserved, running_sums

#: Weights of the sources by code point of their names, null last; they repeat.
WEIGHTS = (1, 2, 3)
#: No source is taken more than this many times over.
MOST = 3
SEED = 20
#: Documents of a source, the largest, that are settled one after the other.
LARGEST = 512


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size): shares by weight, stopped at ``most`` times the size.

    What a stopped source leaves is shared again by weight until none is above: target = min(most * size, level *
    weight) with one level for all. Sorted by most * size / weight, the stopped sources come first; the level is set
    by what they leave. One row per source; the windows run over sources, not documents.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    nth = (F.row_number().over(by_name) - 1) % len(weights)
    rows = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth + 1).cast("int")))
    rows = rows.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / F.sum("weight").over(after),
    )
    # a source is stopped if its cap lies under the level that it and those after it would share
    stopped = F.col("level") * F.col("weight") >= F.col("cap")
    # the first source that is not stopped sets the level; those after it would count it as stopped and get a lower one
    final = F.max(F.when(~stopped, F.col("level"))).over(everything)
    target = F.when(stopped, F.col("cap")).otherwise(F.least(F.col("cap"), final * F.col("weight")))
    return rows.select("source", "source_size", target.alias("target"))


def offset(source, seed: int) -> F.Column:
    """A source's random offset in [0, 1): the first 20 bits of an MD5, so a sum with whole numbers is exact."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("\u0000null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 5), 16, 10).cast("double") / float(1 << 20)


def settle(large, source_size, target, start, most: float) -> F.Column:
    """From a source's largest documents, an array of (size, doc_id, row) by descending size: what they take, as a struct of
    copies (map row -> copies), their words, and the words taken."""
    begin = F.struct(
        F.lit(0).cast("long").alias("seen"), F.lit(0).cast("long").alias("taken"), F.lit(0.0).alias("sum"), F.array().cast("array<long>").alias("copies")
    )

    def step(state, doc):
        left = source_size - state["seen"]
        rate = F.when(left > 0, (target - state["taken"]) / left).otherwise(0.0)
        upto = state["sum"] + F.least(F.greatest(rate, F.lit(0.0)), F.lit(float(most)))
        n = F.floor(upto + start) - F.floor(state["sum"] + start)
        return F.struct(
            (state["seen"] + doc["size"]).alias("seen"),
            (state["taken"] + n * doc["size"]).alias("taken"),
            upto.alias("sum"),
            F.concat(state["copies"], F.array(n)).alias("copies"),
        )

    return F.aggregate(large, begin, step)


def copies(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source, source_size, target, copies) for every row of ``docs`` (doc_id, text, source).

    Null and empty texts have size 0; the null source is a source like any other. Rows that repeat a doc_id are
    documents of their own. Sources without words have target 0 and are not taken. Reruns agree: order and offset
    depend on rows and seed alone. An empty table gives an empty table.
    """
    sized = docs.select("doc_id", "source", count_words(F.col("text")).alias("size"))
    sized = sized.withColumn("one", F.lit(1).cast("long"))
    ranked = running_sums(sized, ["source", "size", "doc_id"], ["source"], "one", "mix-ranks")
    ranked = materialise(ranked.drop("one"), "mix")
    totals = materialise(ranked.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")), "mix-sources")
    shares = targets(totals.drop("n_docs"), weights, most)
    shares = shares.join(totals.select(F.col("source").alias("t"), "n_docs"), F.col("source").eqNullSafe(F.col("t"))).drop("t").withColumnRenamed("source", "s")
    shares = materialise(shares, "mix-targets")
    rows = ranked.join(shares, ranked["source"].eqNullSafe(shares["s"])).drop("s")
    # the order is ascending, so the largest have the last places: LARGEST rows for each source at most
    first = F.greatest(F.col("n_docs") - LARGEST, F.lit(0))
    large = rows.where(F.col("before") >= first).groupBy("source", "source_size", "target", "n_docs")
    large = large.agg(F.sort_array(F.collect_list(F.struct("before", "size")), asc=False).alias("docs"))
    settled = settle(F.col("docs"), F.col("source_size"), F.col("target"), offset(F.col("source"), seed), most)
    settled = materialise(large.select("source", settled.alias("x")).select(F.col("source").alias("z"), "x.*"), "mix-largest")
    rows = rows.join(settled.withColumnRenamed("copies", "settled"), rows["source"].eqNullSafe(settled["z"])).drop("z")
    left = F.col("source_size") - F.col("seen")
    rate = F.when(left > 0, (F.col("target") - F.col("taken")) / left).otherwise(0.0)
    rate = F.least(F.greatest(rate, F.lit(0.0)), F.lit(float(most)))
    start = offset(F.col("source"), seed)
    evenly = F.floor((F.col("before") + 1) * rate + start) - F.floor(F.col("before") * rate + start)
    one = F.get("settled", (F.col("n_docs") - 1 - F.col("before")).cast("int"))
    found = F.when(F.col("before") >= first, one).otherwise(F.least(evenly, F.ceil(F.lit(float(most)))))
    return rows.select("doc_id", "size", "source", "source_size", "target", found.cast("long").alias("copies"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = SEED) -> DataFrame:
    """The mix itself: rows of ``docs`` with all their columns, as often as they are taken.

    Rows alike in doc_id, source and text size are alike to the sampling, and share their copies in any order. Names
    that begin with ``__lw_`` are refused, others may be anything. Nulls, ties and empty tables as in ``copies``.
    """
    reserved(docs)
    key = ["__lw_id", "__lw_source", "__lw_size", "__lw_same"]
    same = Window.partitionBy(*key[:3])
    sized = docs.withColumns(
        {"__lw_id": F.col("doc_id"), "__lw_source": F.col("source"), "__lw_size": count_words(F.col("text"))}
    )
    sized = sized.withColumn("__lw_same", F.row_number().over(same.orderBy("text")))
    taken = copies(docs, weights, most, seed).where("copies > 0")
    taken = taken.select(
        F.col("doc_id").alias("t_id"), F.col("source").alias("t_source"), F.col("size").alias("t_size"), "copies"
    )
    w = Window.partitionBy("t_id", "t_source", "t_size").orderBy("copies")
    taken = taken.withColumn("t_same", F.row_number().over(w))
    taken = taken.select(*[F.col(c).alias(f"__lw_{c}") for c in taken.columns])
    on = F.col("__lw_id").eqNullSafe(F.col("__lw_t_id")) & F.col("__lw_source").eqNullSafe(F.col("__lw_t_source"))
    on = on & (F.col("__lw_size") == F.col("__lw_t_size")) & (F.col("__lw_same") == F.col("__lw_t_same"))
    out = sized.join(taken, on)
    out = out.withColumn("__lw_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__lw_copies"))))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


OP1_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [1.0, 2.0, 3.0][1 + CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS INTEGER)]::DOUBLE AS weight
  FROM sized GROUP BY source
), level AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap,
         ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(3.0::DOUBLE * source_size) OVER before, 0))
           / (sum(weight) OVER after) AS level
  FROM sources
  WINDOW before AS (ORDER BY 3.0::DOUBLE * source_size / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (ORDER BY 3.0::DOUBLE * source_size / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), shares AS (
  SELECT source, source_size,
         CASE WHEN level * weight >= cap THEN cap
              ELSE least(cap, max(CASE WHEN level * weight < cap THEN level END) OVER () * weight) END AS target
  FROM level
), ordered AS (
  SELECT d.doc_id, d.size, d.source, s.source_size, s.target,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS n, count(*) OVER (PARTITION BY d.source) AS n_docs,
         CAST('0x' || substr(md5('20:' || coalesce(d.source, chr(0) || 'null')), 1, 5) AS BIGINT) / 1048576.0::DOUBLE AS u
  FROM sized d JOIN shares s ON d.source IS NOT DISTINCT FROM s.source
), large AS (
  SELECT *, n_docs - n + 1 AS k FROM ordered WHERE n > n_docs - 512
), settled AS (
  SELECT source, 0::BIGINT AS k, 0::BIGINT AS seen, 0::BIGINT AS taken, 0.0::DOUBLE AS total, 0::BIGINT AS copies FROM shares
  UNION ALL
  SELECT source, k, seen + size, taken + size * CAST(floor(upto + u) - floor(total + u) AS BIGINT), upto, CAST(floor(upto + u) - floor(total + u) AS BIGINT)
  FROM (
    SELECT p.source, l.k, l.size, l.u, p.seen, p.taken, p.total,
           p.total + least(greatest(CASE WHEN l.source_size > p.seen THEN (l.target - p.taken) / (l.source_size - p.seen) ELSE 0 END, 0.0), 3.0) AS upto
    FROM settled p JOIN large l ON p.source IS NOT DISTINCT FROM l.source AND l.k = p.k + 1
  )
), ends AS (
  SELECT source, arg_max(seen, k) AS seen, arg_max(taken, k) AS taken FROM settled GROUP BY source
), rates AS (
  SELECT o.*, e.seen, e.taken,
         least(greatest(CASE WHEN o.source_size > e.seen THEN (o.target - e.taken) / (o.source_size - e.seen) ELSE 0 END, 0.0), 3.0)::DOUBLE AS rate
  FROM ordered o JOIN ends e ON o.source IS NOT DISTINCT FROM e.source
)
SELECT r.doc_id, r.size, r.source_size, round(r.target, 6) AS target,
       r.size * coalesce(x.copies, CAST(least(floor(r.n * r.rate + r.u) - floor((r.n - 1) * r.rate + r.u), 3) AS BIGINT)) AS taken
FROM rates r LEFT JOIN settled x ON x.k > 0 AND x.source IS NOT DISTINCT FROM r.source AND x.k = r.n_docs - r.n + 1 AND r.n > r.n_docs - 512
"""


def op1(docs: DataFrame) -> DataFrame:
    rows = copies(docs)
    return rows.select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), (F.col("size") * F.col("copies")).alias("taken")
    )
