"""Mixing sources to target weights with hash-threshold histograms.

Every row gets a 60-bit hash of its id, its text and its number among equal
rows. Words are summed by source and by the
top bits of the hash; the running sums of that histogram show in which bucket
a source's budget ends. Everything below the bucket is taken, everything
above is not, and only the boundary bucket is split further, by the next bits
of the hash, until it holds one hash value. The result is one threshold per
source: rows are filtered by comparing their hash with it, and never sorted.
Thresholds are nested: a larger budget keeps all that a smaller one took, so
a budget of one to two epochs takes every row once and the rows below the
threshold twice. DataFrame functions only.

A null text has size 0. Sources weigh ``weights`` in turn by code point, the
null source last. Rows that share a doc_id but not their text have hashes of
their own; rows that are equal in id, source and text are numbered, so they
aren't taken together either. A source without words has target 0 and takes nothing. Empty
tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from punktwerk.llm.common import WORD, prepare, staged

BITS = 12          # hash bits per level: at most 4,096 buckets a source
LEVELS = 5
WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
SALTS = 64


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


#: Equal rows are told apart in blocks of this many.
EQUAL_ROWS = 4096


def row_key() -> Column:
    """64 bits for (id, source, text); rows with one key are equal rows."""
    return F.xxhash64("doc_id", "source", "text")


def row_hash(key: str = "key", nth: str = "nth") -> Column:
    """60 bits, so that five levels of 12 bits use them up."""
    return F.shiftrightunsigned(F.xxhash64(F.col(key), F.col(nth), F.lit("mix")), 64 - BITS * LEVELS)


def sized_rows(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, key, nth, hash. Equal rows are counted
    map-side and numbered by unfolding their count, so the numbers don't depend on
    where a row is stored."""
    counted = docs.select("doc_id", "source", words().alias("size"), row_key().alias("key")).groupBy(
        "doc_id", "source", "size", "key").agg(F.count("*").alias("m"))
    blocks = counted.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(m - 1) div {EQUAL_ROWS}"))))
    first = F.col("block") * EQUAL_ROWS
    return (blocks.withColumn("nth", F.explode(F.sequence(first, F.least(first + EQUAL_ROWS, F.col("m")) - 1)))
            .select("doc_id", "source", "size", "key", "nth", "m").withColumn("hash", row_hash()))


def weighted_sources(sized: DataFrame, weights=WEIGHTS) -> DataFrame:
    """(source, source_size, weight). The weight follows the position in code
    point order, found by a distributed sort: the position within a sorted
    partition plus the rows of the partitions before it."""
    src = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    at = staged(src.orderBy(F.col("source").asc_nulls_last()).withColumn("_m", F.monotonically_increasing_id()), "sources")
    part = at.select("*", F.shiftright("_m", 33).alias("_p"), F.expr("_m & 8589934591L").alias("_i"))
    before = part.groupBy("_p").agg(F.count("*").alias("_n")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    pos = part.join(before, "_p").withColumn("_at", F.col("_i") + F.col("_before"))
    k = F.array(*[F.lit(float(w)) for w in weights])
    return pos.select("source", "source_size", F.get(k, (F.col("_at") % len(weights)).cast("int")).alias("weight"))


def water_fill(sources: DataFrame, share: float = SHARE, repeats: float = REPEATS) -> DataFrame:
    """Adds ``target``: weight shares of ``share`` times all words, no target
    above ``repeats`` times its source. The excess is shared again by weight
    until none is above; each round is one aggregate to a single row."""
    cap = F.col("source_size") * float(repeats)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        over = cap <= F.col("weight") * F.lit(level)
        row = sources.agg(F.count(F.when(over, 1)).alias("n"), F.sum(F.when(over, cap)).alias("full"),
                          F.sum(F.when(~over, F.col("weight"))).alias("open")).first()
        if row.n == capped or not row.open:
            break
        capped, level = row.n, (share * total - (row.full or 0.0)) / row.open
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)) if level else cap)


def _below(sources: DataFrame, sized: DataFrame, level: int) -> DataFrame:
    """One refinement: the histogram of the boundary bucket's next bits."""
    shift = BITS * (LEVELS - 1 - level)
    s = sources.select(F.col("source").alias("_src"), "prefix", "budget")
    inside = sized.filter("size > 0").join(s, F.col("source").eqNullSafe(F.col("_src")))
    if level:
        inside = inside.filter(F.shiftright("hash", BITS * (LEVELS - level)) == F.col("prefix"))
    hist = inside.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(
        F.sum("size").alias("n"), F.first("budget").alias("budget"),
        F.min("hash").alias("lo"), F.max("hash").alias("hi"))
    run = hist.withColumn("upto", F.sum("n").over(W.partitionBy("source").orderBy("bucket")))
    # the first bucket that passes the budget; buckets before it are taken whole
    edge = run.filter("upto > budget").groupBy("source").agg(
        F.min(F.struct("bucket", "upto", "n", "budget", "lo", "hi")).alias("e"))
    return edge.select("source", F.col("e.bucket").alias("prefix"),
                       (F.col("e.budget") - (F.col("e.upto") - F.col("e.n"))).alias("budget"),
                       F.col("e.n").alias("n"), F.col("e.lo").alias("lo"), F.col("e.hi").alias("hi"))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, copies, threshold): rows are taken ``copies`` times, and once
    more where their hash is below the threshold."""
    base = targets.select("source", "source_size", "target",
                          F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).alias("copies"))
    base = base.withColumn("budget", F.col("target") - F.col("copies") * F.col("source_size"))
    todo = base.filter("source_size > 0").select("source", F.lit(0).cast("long").alias("prefix"), "budget")
    done = None
    for level in range(LEVELS):
        edge = staged(_below(todo, sized, level), f"edge{level}")
        last = level == LEVELS - 1
        ends = edge if last else edge.filter("lo = hi")
        # a single hash is left: the nearer of taking and leaving it
        ends = ends.select("source", (F.col("lo") + F.when(F.col("budget") * 2 >= F.col("n"), 1).otherwise(0)).alias("threshold"))
        done = ends if done is None else done.unionByName(ends)
        todo = edge.filter("lo < hi").select("source", "prefix", "budget")
        if todo.isEmpty():
            break
    d = done.withColumnRenamed("source", "_src")
    return base.join(d, F.col("source").eqNullSafe(F.col("_src")), "left").select(
        "source", "source_size", "target", "copies", F.coalesce("threshold", F.lit(0)).cast("long").alias("threshold"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: float = REPEATS) -> DataFrame:
    """doc_id, size, source, source_size, target, times, taken -- one row per
    document; ``times`` is how often the mix takes it."""
    prepare(docs.sparkSession)
    sized = staged(sized_rows(docs), "sized")
    plan = thresholds(sized, staged(water_fill(weighted_sources(sized, weights), share, repeats), "targets"))
    plan = staged(plan.coalesce(1), "mix_plan").withColumnRenamed("source", "_src")
    j = sized.join(plan, F.col("source").eqNullSafe(F.col("_src")))
    times = (F.col("copies") + F.when(F.col("hash") < F.col("threshold"), 1).otherwise(0)).cast("int")
    return j.withColumn("times", times).select(
        "doc_id", "source", "size", "source_size", F.col("target").cast("double").alias("target"), "times",
        (F.col("size") * F.col("times")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: float = REPEATS) -> DataFrame:
    """The mixed corpus: the documents' own columns, a row per time taken. The
    threshold is joined by source, so no text is shuffled or sorted."""
    prepare(docs.sparkSession)
    sized = staged(sized_rows(docs), "sized")
    plan = thresholds(sized, staged(water_fill(weighted_sources(sized, weights), share, repeats), "targets"))
    plan = staged(plan.coalesce(1), "mix_plan").select(F.col("source").alias("_src"), "copies", "threshold")
    more = F.when(F.col("hash") < F.col("threshold"), 1).otherwise(0)
    # of m equal rows some are taken once more: as many as their numbers say
    equal = staged(sized.filter("m > 1").join(plan, F.col("source").eqNullSafe(F.col("_src"))).groupBy("key").agg(F.sum(more).alias("extra")), "equal_rows")
    d = docs.select(F.struct("*").alias("_doc"), F.col("source").alias("_source"), row_key().alias("key"))
    d = d.withColumn("nth", F.lit(0).cast("long")).withColumn("hash", row_hash())
    j = d.join(plan, F.col("_source").eqNullSafe(F.col("_src"))).withColumn("more", more)
    if not equal.isEmpty():
        j = j.join(equal, "key", "left")
        parts = staged(j.filter("extra is not null").withColumn("_salt", F.expr(f"monotonically_increasing_id() % {SALTS}")), "equal_documents")
        at = F.row_number().over(W.partitionBy("key", "_salt").orderBy("_salt"))
        # the first rows of each salt; what a salt holds is summed before it
        held = parts.groupBy("key", "_salt").agg(F.count("*").alias("_n")).withColumn(
            "_before", F.coalesce(F.sum("_n").over(W.partitionBy("key").orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        ranked = parts.withColumn("_at", at).join(held.select("key", "_salt", "_before"), ["key", "_salt"])
        ranked = ranked.withColumn("more", F.when(F.col("_at") + F.col("_before") <= F.col("extra"), 1).otherwise(0))
        j = j.filter("extra is null").select("_doc", "copies", "more").unionByName(ranked.select("_doc", "copies", "more"))
    times = (F.col("copies") + F.col("more")).cast("int")
    return j.select("_doc", F.explode(F.array_repeat(F.lit(1), times)).alias("_n")).select("_doc.*")
