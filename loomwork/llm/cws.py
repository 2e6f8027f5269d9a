"""Document fingerprints by consistent weighted sampling, in DataFrame functions alone.

A text's terms are its words, weighted by how often they occur. For each term k of weight S and each of SAMPLES
positions, uniforms u1..u4 come from hashes of k and the position; r = -ln(u1 u2) and c = -ln(u3 u4) are Gamma(2, 1), and
b = ln u1 / ln(u1 u2) is uniform and independent of r. t = floor(ln S / r + b), ln y = r (t - b), a = c / (y exp r). The
position's sample is the least a over the terms, which stands for the term and the t it came from. Two texts agree in a
position with a probability equal to their generalised Jaccard similarity, sum of min / sum of max of the weights;
their likeness is the share of positions in which they agree.

With this b, t is 0 exactly if S u2 < 1, and then a = c u2; otherwise a = c (u1 u2)**(t + 1) / u1. So a >= (1 - u3 u4) u2
or, for a larger t, (1 - u3 u4) u1 u2 / S, which needs no logarithm. The least a of a text of n words is an exponential of
rate n: beyond BOUND / n it lies with probability exp(-BOUND). Terms whose lower limit is beyond are not drawn further.

The query compares a text with its edited text and with its neighbour in the order of doc_id. Documents are dealt to
ranges of that order, each with the last document of the range before, and every later step (windows, words, weights,
minima) works within a range: texts are shuffled once, and no range has to hold a hot key. The words that a text and
its edited text share are cut and counted once, and a term that weighs the same in both is drawn once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomwork.llm.common import materialise, partitions

SAMPLES = 48
#: Positions that one row draws for: more in one aggregate are more code than the JVM compiles.
PART = 16
#: exp(-40) is 4e-18: the chance that a position of a text comes out empty.
BOUND = 40.0
#: Least doc_id; what stands for null in the order.
LEAST = -(1 << 63)
#: Ranges, and tasks that hold their terms: so many for each shuffle partition. Terms take several times the room of
#: their texts, and ranges outnumber tasks so that their hashes fill them evenly.
RANGES_EACH, TASKS_EACH = 32, 4
#: Characters of a text that, after the doc_id, tell ranges apart.
TIE_CHARS = 32
#: White space between words.
SPACE = r"[\x20\x09-\x0D]"


def sample(position: int) -> F.Column:
    """a of the term cws_term at a position; null where it is beyond cws_bound for certain.

    As SQL text: a draw has some forty nodes, and each would be a call to the JVM.
    """
    h1, h2 = f"xxhash64(cws_term, {2 * position})", f"xxhash64(cws_term, {2 * position + 1})"
    high, low = "((shiftrightunsigned({0}, 32) + 0.5D) * {1!r}D)", "((({0} & 4294967295L) + 0.5D) * {1!r}D)"
    u1, u2, u3, u4 = (u.format(h, 2.0**-32) for u, h in ((high, h1), (low, h1), (high, h2), (low, h2)))
    least, c = f"((1D - {u3} * {u4}) * {u2})", f"(-ln({u3} * {u4}))"
    beyond = f"(pow({u1} * {u2}, cast(floor((ln({u1}) - cws_ln) / ln({u1} * {u2})) as double) + 1D) / {u1})"
    at_once = f"case when {least} <= cws_bound then {c} * {u2} end"
    return F.expr(f"case when cws_weight * {u2} < 1D then {at_once} when {least} * {u1} <= cws_bound * cws_weight then {c} * {beyond} end")


def drawn(terms: DataFrame, key: list[str], samples: int = SAMPLES, words=None) -> DataFrame:
    """(key..., part, m, ...) from rows (key..., term long, weight, ...): per key and part, the samples of PART positions as
    an array, and the largest of every other column. A null term counts for nothing.

    ``words``: how many words the row's text has; without it, no term is left out early.
    """
    bound = F.lit(BOUND) / words.cast("double") if words is not None else F.lit(float("inf"))
    extra = [c for c in terms.columns if c not in (*key, "term", "weight")]
    # a null weight leaves every branch of a draw untaken
    weight = F.when(F.col("term").isNotNull(), F.col("weight").cast("double"))
    rows = terms.select(*key, *extra, F.coalesce("term", F.lit(0)).alias("cws_term"), weight.alias("cws_weight"), bound.alias("cws_bound"))
    parts = F.array(*[F.lit(i) for i in range(-(-samples // PART))])
    rows = rows.select("*", F.ln("cws_weight").alias("cws_ln"), F.explode(parts).alias("part"))
    rows = rows.withColumn("cws_term", F.xxhash64("cws_term", "part"))
    n = min(samples, PART)
    least = rows.groupBy(*key, "part").agg(*[F.min(sample(j)).alias(f"m{j}") for j in range(n)], *[F.max(c).alias(c) for c in extra])
    return least.select(*key, "part", F.array(*[f"m{j}" for j in range(n)]).alias("m"), *extra)


def signatures(terms: DataFrame, key: list[str], samples: int = SAMPLES) -> DataFrame:
    """One row per key with m0, m1, ...: from rows (key..., term long, weight)."""
    parts = drawn(terms.select(*key, "term", "weight"), key, samples).groupBy(*key)
    rows = parts.agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", "m"))), lambda p: p["m"])).alias("m"))
    return rows.select(*key, *[F.get("m", F.lit(j)).alias(f"m{j}") for j in range(samples)])


def _signature(samples: int) -> F.Column:
    return F.array(*[F.col(f"m{j}") for j in range(samples)])


def words(text) -> F.Column:
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")


def fingerprint(signature, samples: int = SAMPLES) -> F.Column:
    """32 bits of each position, in hex; all zeros for a text without words."""
    part = lambda m: F.lpad(F.lower(F.hex(F.xxhash64(m).bitwiseAND(F.lit((1 << 32) - 1)))), 8, "0")
    return F.when(F.get(signature, F.lit(0)).isNull(), F.lit("0" * 8 * samples)).otherwise(F.array_join(F.transform(signature, part), ""))


def likeness(left, right, samples: int = SAMPLES) -> F.Column:
    """Share of positions in which two signatures agree; two texts without words agree in all."""
    return F.size(F.filter(F.zip_with(left, right, lambda a, b: a.eqNullSafe(b)), lambda same: same)) / F.lit(float(samples))


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """(doc_id, fingerprint) for every row of ``docs`` (doc_id, text); null and empty texts have all zeros."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("row", F.monotonically_increasing_id())
    found = F.concat(words(F.col("text")), F.array(F.lit(None).cast("string")))
    rows = rows.select("row", "doc_id", F.explode(found).alias("word"))
    terms = rows.groupBy("row", "doc_id", F.when(F.col("word").isNotNull(), F.xxhash64("word")).alias("term")).agg(F.count("*").alias("weight"))
    return signatures(terms, ["row", "doc_id"], samples).select("doc_id", fingerprint(_signature(samples), samples).alias("fingerprint"))


def _order_key(docs: DataFrame) -> F.Column:
    """Where a document comes in the order of doc_id and text: null ids first."""
    return F.struct(F.coalesce("doc_id", F.lit(LEAST)).alias("k"), F.left(F.coalesce("text", F.lit("")), F.lit(TIE_CHARS)).alias("tie"))


def _ranges(docs: DataFrame) -> tuple[DataFrame, int]:
    """The last key of each range, ascending, as one row with an array; the number of ranges.

    Equal keys are in one range, so a repeated doc_id spreads over ranges by the beginnings of its texts.
    """
    keys = materialise(docs.select(_order_key(docs).alias("key")).select("key.*"), "cws-keys")
    dealt = keys.repartitionByRange(RANGES_EACH * partitions(docs.sparkSession), "k", "tie")
    last = materialise(dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.max(F.struct("k", "tie")).alias("last")), "cws-ranges")
    return last.agg(F.sort_array(F.collect_list("last")).alias("ends")), last.count()


def _range_of(key, ends, n: int) -> F.Column:
    """How many of ``n`` ascending ends are below the key, by binary search."""
    steps = F.array(*[F.lit(1 << i) for i in range(n.bit_length() - 1, -1, -1)])

    def step(at, width):
        to = at + width
        return F.when((to <= n) & (F.get(ends, to - 1) < key), to).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


#: What a document's facts travel as: terms of their own that count for nothing.
_FACTS = ("n_chars", "s0", "s1", "s2", "s3", "id", "guest")


def neighbours(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they are.

    Edited: the last half of the code points (rounded down) replaced by the first as many of the next document's, or
    all it has; next is by descending doc_id, after the last the first. Null texts count as empty; texts without words
    agree with each other. Null doc_ids come last, rows that repeat a doc_id follow each other by descending text; a
    single document is its own next one. An empty table gives an empty table.
    """
    found, n = _ranges(docs)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), _order_key(docs).alias("key"), found.scalar().alias("ends"))
    rows = rows.withColumn("own", _range_of(F.col("key"), F.col("ends"), n))
    here = F.struct(F.col("own").alias("range"), F.lit(0).alias("guest"))
    there = F.struct(F.pmod(F.col("own") + 1, F.lit(max(1, n))).alias("range"), F.lit(1).alias("guest"))
    edge = F.get("ends", "own") == F.col("key")
    rows = rows.select("doc_id", "text", F.col("key.k").alias("k"), F.inline(F.when(edge, F.array(here, there)).otherwise(F.array(here))))
    rows = rows.repartition(TASKS_EACH * partitions(docs.sparkSession), "range")
    w = Window.partitionBy("range").orderBy(F.desc("guest"), "k", "text")
    rows = rows.withColumns({"nth": F.row_number().over(w), "next_text": F.lag("text", 1, "").over(w)})
    n_chars = F.char_length("text")
    rows = rows.select("range", "nth", "guest", "doc_id", "text", "next_text", n_chars.alias("n_chars"), (n_chars - F.expr("char_length(text) div 2").cast("int")).alias("head"))
    rows = rows.withColumns({"kept": F.left("text", F.col("head")), "cut": F.expr("substring(text, head + 1)"), "put": F.expr("left(next_text, n_chars - head)")})
    # both texts begin with the same words, up to the last white space before the cut
    rows = rows.withColumn("shared", F.regexp_extract("kept", rf"(?s)\A.*{SPACE}", 0))
    rows = rows.withColumn("rest", F.expr("substring(kept, char_length(shared) + 1)"))
    guest = F.col("guest") == 1
    rows = rows.withColumns({"w_both": F.when(guest, words(F.col("text"))).otherwise(words(F.col("shared"))), "w_own": words(F.concat("rest", "cut")), "w_edited": words(F.concat("rest", "put"))})
    rows = rows.withColumns({"n_own": F.size("w_both") + F.when(guest, 0).otherwise(F.size("w_own")), "n_edited": F.size("w_both") + F.when(guest, 0).otherwise(F.size("w_edited"))})
    sha = F.sha2(F.concat("kept", "put").cast("binary"), 256)
    facts = [F.col("n_chars").cast("long"), *[F.conv(F.substring(sha, 1 + 16 * i, 16), 16, -10).cast("long") for i in range(4)], F.col("doc_id").cast("long"), F.col("guest").cast("long")]

    def part(what, own, edited, found):
        kinds = (("fact", "int"), ("own", "long"), ("edited", "long"), ("words", "array<string>"))
        return F.struct(*[x.cast(kind).alias(name) for x, (name, kind) in zip((F.lit(what), own, edited, found), kinds)])

    one, none, nothing = F.lit(1), F.lit(0), F.array(F.lit(None))
    told = [part(i + 1, fact, none, nothing) for i, fact in enumerate(facts)]
    # a guest's edited text is asked of the range it comes from
    visitor = F.array(part(0, one, none, F.col("w_both")), part(-1, none, none, nothing), told[-1])
    own = F.array(part(0, one, one, F.col("w_both")), part(0, one, none, F.col("w_own")), part(0, none, one, F.col("w_edited")), part(-1, none, none, nothing), *told)
    doc = ["range", "nth", "n_own", "n_edited"]
    rows = rows.select(*doc, F.inline(F.when(guest, visitor).otherwise(own))).select(*doc, "fact", "own", "edited", F.explode("words").alias("word"))
    rows = rows.select(*doc, "fact", F.when(F.col("word").isNotNull(), F.xxhash64("word")).alias("term"), "own", "edited")
    terms = rows.groupBy(*doc, "fact", "term").agg(F.sum("own").alias("own"), F.sum("edited").alias("edited"))

    def counted(kind, weight):
        return F.struct(F.lit(kind).alias("kind"), weight.cast("long").alias("weight"))

    # kind 0: facts; terms of 1: the text, 2: the edited text, 3: both with one weight. Every document has rows of all four
    each = (
        F.when(F.col("fact") > 0, F.array(counted(0, F.col("own"))))
        .when(F.col("fact") < 0, F.array(*[counted(i, none) for i in (1, 2, 3)]))
        .when(F.col("own") == F.col("edited"), F.array(counted(3, F.col("own"))))
        .when(F.col("edited") == 0, F.array(counted(1, F.col("own"))))
        .when(F.col("own") == 0, F.array(counted(2, F.col("edited"))))
        .otherwise(F.array(counted(1, F.col("own")), counted(2, F.col("edited"))))
    )
    n_words = F.when(F.col("kind") == 1, F.col("n_own")).when(F.col("kind") == 2, F.col("n_edited")).otherwise(F.least("n_own", "n_edited"))
    terms = terms.select(*doc, "fact", "term", F.inline(each))
    terms = terms.select("range", "nth", "kind", "term", "weight", F.greatest(n_words, F.lit(1)).alias("n_words"), *[F.when(F.col("fact") == i + 1, F.col("weight")).alias(c) for i, c in enumerate(_FACTS)])
    signed = drawn(terms, ["range", "nth", "kind"], samples, F.col("n_words"))
    # a document's rows follow each other by kind and part, and those of the next document come just before
    parts = -(-samples // PART)
    one = Window.partitionBy("range").orderBy("nth", "kind", "part")

    def before(kind: int, documents: int = 0) -> F.Column:
        back = [4 * parts * documents + parts * (3 - kind) + i for i in range(parts - 1, -1, -1)]
        return F.concat(*[F.lag("m", n).over(one) if n else F.col("m") for n in back])

    least = lambda a, b: F.zip_with(a, b, lambda x, y: F.least(x, y))
    found = {"text": (before(1), before(3)), "edited": (before(2), before(3)), "next": (before(1, 1), before(3, 1))}
    signed = signed.withColumns({f"{name}_{i}": c for name, pair in found.items() for i, c in enumerate(pair)} | {f"f_{c}": F.lag(c, 3 * parts).over(one) for c in _FACTS})
    signed = signed.where(f"kind = 3 and part = {parts - 1} and f_guest = 0")
    signed = signed.select(*[f"f_{c}" for c in _FACTS], *[least(f"{name}_0", f"{name}_1").alias(name) for name in found])
    return signed.select(
        F.col("f_id").alias("doc_id"),
        F.col("f_n_chars").alias("n_chars"),
        F.lower(F.concat(*[F.lpad(F.hex(f"f_s{i}"), 16, "0") for i in range(4)])).alias("edited_sha256"),
        fingerprint(F.col("text"), samples).alias("fingerprint"),
        fingerprint(F.col("edited"), samples).alias("edited_fingerprint"),
        likeness("text", "edited", samples).alias("near_edited"),
        likeness("text", "next", samples).alias("near_next"),
    )
