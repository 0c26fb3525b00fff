"""Grouping of spelling variants with asymmetric q-chunks.

Two words are near when one inserted, deleted or replaced code point turns
one into the other. Of two near words the shorter one (of equal length: both)
is cut into two disjoint chunks; the other one contributes its grams. One
edit spoils at most one chunk, so the other is a gram of the other word, at
the same place or one further: rows join on (chunk, place), and the pairs
are verified with the edit distance. Only grams that can meet a chunk are
made: those as long as the chunks of a word of this length or one less, at
the places of the first or the second chunk or one further.

Chunks that many words share (a common first half) would give many pairs. So
pairs are counted first, from the two counts per key, and a key with more
than ``pair_limit`` pairs is not joined: its words go on with the half in
which the edit must lie, cut into two chunks again, next to all that is known
to be equal. The words of one key get fewer with every round, and after
log2(length) rounds the edit is pinned to one code point. No pair is lost and
none is capped.

Words, counts and the slips that are planted (one code point deleted where
the CRC-32 of ``<doc_id>:<word>`` is divisible by 199) follow the digest
query's contract. A null text has no words; a null doc_id counts as empty
text in ``<doc_id>:``; rows that repeat a doc_id count each. Extra columns are
ignored; an empty table has no words."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punktwerk.llm.common import prepare, staged, tidied

#: Fixed by the contract of the digest query.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
SLIP = 199
LEAST_LENGTH, LEAST_COUNT, FORM_RATIO = 6, 5, 5
_LOWER = bytes(c + 32 if ord("A") <= c <= ord("Z") else c for c in range(256))

#: Words that a task holds before it hands its counts on.
HELD_WORDS = 200_000
#: Pairs that one key may give before its words are told apart further.
PAIR_LIMIT = 4096


def slipped(doc: str, run: str) -> str:
    """The run, or the run without one code point in one of 199 cases."""
    h = zlib.crc32(f"{doc}:{run}".encode())
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


@tidied
def _count(batches):
    held: Counter = Counter()

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return out

    for b in batches:
        for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for run, n in Counter(RUN.findall(text.encode().translate(_LOWER).decode())).items():
                held[slipped(doc, run)] += n
            if len(held) >= HELD_WORDS:
                yield flush()
    if held:
        yield flush()


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n: every word with its occurrences in all texts."""
    rows = docs.filter("text is not null").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), "text")
    return rows.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    return word_counts(docs).filter((F.char_length("word") >= least_length) & (F.col("n") >= least_count))


def _known(word: Column, head: Column, tail: Column) -> Column:
    """All of a word but a gap: its first ``head`` code points and those from
    ``tail`` on, as one 128-bit key."""
    return F.md5(F.concat(head.cast("string"), F.lit(":"), word.substr(F.lit(1), head), word.substr(tail + 1, F.char_length(word))).cast("binary"))


def near_pairs(words: DataFrame, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """a, b: every pair of near words of column ``word`` (distinct, not empty)
    once, ``a`` the shorter or smaller one."""
    L = F.char_length("word").cast("int")
    # chunk owners: the edit lies in [lo, hi) of a word of len code points
    owners = words.select("word", L.alias("len"), F.lit(0).alias("lo"), L.alias("hi"))
    # gram owners stand in for a shorter or equal word of ``len`` code points
    grams = words.select("word", F.explode(F.array(L, L - 1)).alias("len")).filter("len > 0").withColumn("lo", F.lit(0)).withColumn("hi", F.col("len"))
    found = None
    while True:
        def halves(df):
            cut = df.withColumn("mid", F.expr("cast((lo + hi) div 2 as int)"))
            return cut.select("word", "len", F.inline(F.array(F.struct(F.col("lo").alias("lo"), F.col("mid").alias("hi")),
                                                              F.struct(F.col("mid").alias("lo"), F.col("hi").alias("hi")))))
        # a gap [lo, hi) in the chunk owner is one wider in a longer gram owner
        key = _known(F.col("word"), F.col("lo"), F.col("hi") + F.char_length("word") - F.col("len"))
        chunk, gram = (staged(halves(df).withColumn("key", key), n) for df, n in ((owners, "chunks"), (grams, "grams")))
        keys = ["len", "lo", "hi", "key"]
        sizes = chunk.groupBy(*keys).agg(F.count("*").alias("c")).join(gram.groupBy(*keys).agg(F.count("*").alias("g")), keys)
        # a gap of one code point can't be told apart further
        full = staged(sizes.filter(F.col("c") * F.col("g") > pair_limit).filter("hi - lo > 1").select(*keys), "full_keys")
        meet = chunk.withColumnRenamed("word", "a").join(full, keys, "left_anti").join(gram.withColumnRenamed("word", "b"), keys)
        pairs = meet.filter((F.char_length("b") > F.col("len")) | (F.col("a") < F.col("b"))).filter(F.levenshtein("a", "b", 1) == 1).select("a", "b")
        pairs = staged(pairs, "near_pairs")
        found = pairs if found is None else found.unionByName(pairs)
        if full.isEmpty():
            return found.distinct()
        owners, grams = (df.join(full, keys, "left_semi").select("word", "len", "lo", "hi") for df in (chunk, gram))


def forms(words: DataFrame, pairs: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word of (word, n)."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = (both.join(words.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b").groupBy("a")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("best"))).alias("m")))
    each = words.join(near.withColumnRenamed("a", "word"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("m.less") >= ratio * F.col("n"), F.col("m")).alias("m")).select(
        "word", F.col("m.best").alias("form"), "n", "n_near", (-F.col("m.less")).alias("form_n"))
    each = staged(each, "forms")
    # a form occurs ``ratio`` times as often as its word: chains are short and
    # end; each round doubles the steps that are known
    up = each.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        up = staged(up, "roots")
        step = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = up.join(step, "root", "left")
        if further.filter("next is not null").isEmpty():
            break
        up = further.select("word", F.coalesce("next", "root").alias("root"))
    return each.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_forms(docs: DataFrame, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """The words of ``docs`` with the form that each may be a variant of."""
    prepare(docs.sparkSession)
    words = staged(vocabulary(docs), "vocabulary")
    return forms(words, staged(near_pairs(words.select("word"), pair_limit), "pairs"))
