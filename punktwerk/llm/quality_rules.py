"""Quality rules with adaptive thresholds.

Every document gets a few counts of its words, symbols, lines and repeats.
The rules don't compare them with fixed cutoffs: per language and source a
quantile sketch of each ratio is kept -- a log-linear histogram of the ratio
in parts per 10,000, over the documents that pass the base rule -- and a
document is rejected when a ratio lies beyond the fence
``median + reach * spread`` of its own group. The spread is a high quantile
(95 to 98 %) of the sketch less the median, so it is as wide as the group's own
tail. A group full of junk can't widen it at will, nor a spotless one narrow
it to nothing: the spread of a group counts for ``1 / BOUND`` to ``BOUND`` times
that of the whole corpus, and any spread for at most ``BOUND`` times a prior
that says what a signal's scale is (the corpus's for half of it at least). Median and spread of a source are blended with those
of its language, and these with the corpus's, by numbers of documents
(``n / (n + blend_docs)``), so small groups follow their parents and nothing
switches at a size. ``LEAST_PART`` occurrences or fewer never reject.

The sketches are plain rows (group, signal, bin, count): they are combined
map-side and merge by adding counts. The thresholds (one row per language and
source) are then joined to the documents' counts.

Nulls: a null text has no words (and fails the base rule); null languages
and sources are groups of their own. Empty tables give empty results;
repeated rows are judged row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from punktwerk.llm.common import prepare, staged

_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))
_SPACES = b" \t\n\x0b\x0c\r"
_NGRAM = 8

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_stutter"]


def _ranks(pairs: np.ndarray) -> tuple[np.ndarray, int]:
    u, inv = np.unique(pairs, return_inverse=True)
    return inv.astype(np.int64), len(u)


def repeated_window_words(word_lists: list[list[bytes]], width: int = _NGRAM) -> np.ndarray:
    """Per document, the words that lie in a ``width``-word window (a power of
    two) found at least twice in that document. Windows are compared exactly:
    equal words get equal ranks, then ranks of width 1, 2, 4, ... are paired."""
    sizes = np.array([len(w) for w in word_lists], dtype=np.int64)
    total = int(sizes.sum())
    if not total:
        return np.zeros(len(sizes), dtype=np.int64)
    codes: dict[bytes, int] = {}
    rank = np.fromiter((codes.setdefault(w, len(codes)) for ws in word_lists for w in ws), np.int64, total)
    doc = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    rank, n = _ranks(doc * len(codes) + rank)    # the same word of another document differs
    step = 1
    while step < width:
        # ranks near a document's end pair with the next document's; no other
        # window equals those, and they are cut off below
        nxt = np.concatenate([rank[step:], np.zeros(step, dtype=np.int64)])
        rank, n = _ranks(rank * n + nxt)
        step *= 2
    left = np.concatenate([np.arange(s, 0, -1) for s in sizes if s]) if total else sizes
    whole = left >= width
    many = np.zeros(total, dtype=bool)
    many[whole] = np.bincount(rank[whole], minlength=n)[rank[whole]] > 1
    edge = np.zeros(total + 1, dtype=np.int64)
    at = np.flatnonzero(many)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(doc[covered], minlength=len(sizes)).astype(np.int64)


def count_texts(texts) -> pd.DataFrame:
    """The counts of whole texts (None: no words)."""
    rows, words = [], []
    for t in texts:
        t = t or ""
        b = t.encode("utf-8", "surrogatepass")
        ws = b.split()              # ASCII white space only, as the word rule asks
        lines = [x for x in t.split("\n") if x.strip(" \t\x0b\x0c\r")]
        n = len(b)
        rows.append((len(ws), len(t) - (n - len(b.translate(None, _SPACES))), n - len(b.translate(None, _SYMBOLS)),
                     len(lines) - len(set(lines)), 0, len(lines), n - len(b.translate(None, _UPPER)),
                     n - len(b.translate(None, _LETTERS)), sum(map(bytes.__eq__, ws[1:], ws))))
        words.append(ws)
    out = pd.DataFrame(rows, columns=COUNTS, dtype="int64")
    out["n_repeat_words"] = repeated_window_words(words)
    return out


@F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def _text_counts(text: pd.Series) -> pd.DataFrame:
    return count_texts(text)


# Declared non-deterministic, so that filters on the counts are not pushed below
# them, which would count every text twice.
text_counts = _text_counts.asNondeterministic()


@dataclass(frozen=True)
class Signal:
    """A ratio in parts per 10,000; the quantile (percent) whose distance from
    the median is the spread; how many tenths of the spread a document may lie
    beyond the median; the prior of the spread."""
    name: str
    part: str
    whole: str
    high: int
    reach: int
    prior: int


SIGNALS = (
    Signal("symbols", "n_symbols", "word_chars", 95, 4, 1000),
    Signal("upper", "n_upper", "n_letters", 97, 50, 150),
    Signal("dup_lines", "n_dup_lines", "n_lines", 98, 30, 1000),
    Signal("repeats", "n_repeat_words", "n_words", 98, 45, 300),
    Signal("stutter", "n_stutter", "n_words", 97, 50, 150),
)
BLEND_DOCS = 200
BOUND = 2
LEAST_PART = 2


def base_failed() -> Column:
    """Fixed by the data contract: too short, or mostly repeats."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _ratio(s: Signal) -> Column:
    return F.expr(f"cast(10000 * {s.part} div greatest({s.whole}, 1) as long)")


def _bin(r: str) -> Column:
    """Log-linear bin of an integer: exact below 64, then 32 bins per
    doubling. Integer arithmetic, so every engine gets the same bin."""
    e = f"(length(bin({r})) - 6)"
    return F.expr(f"case when {r} < 64 then {r} else {e} * 32 + shiftright({r}, cast({e} as int)) end")


def _value(b: str) -> Column:
    """The smallest integer of a bin."""
    e = f"cast(({b} div 32) - 1 as int)"
    return F.expr(f"case when {b} < 64 then {b} else shiftleft({b} - {e} * 32, {e}) end")


def sketch(counts: DataFrame, signals=SIGNALS) -> DataFrame:
    """(lang, source, signal, bin, n): the quantile sketches of every group,
    of the documents that pass the base rule. Rows are combined before the shuffle; two sketches merge by adding n."""
    pairs = F.explode(F.array(*[F.struct(F.lit(s.name).alias("signal"), _ratio(s).alias("r")) for s in signals]))
    return (counts.filter(~base_failed()).select("lang", "source", pairs.alias("p"))
            .select("lang", "source", "p.signal", _bin("p.r").cast("int").alias("bin"))
            .groupBy("lang", "source", "signal", "bin").agg(F.count("*").alias("n")))


def _quantiles(sk: DataFrame, keys: list[str], signals) -> DataFrame:
    """Documents, median and spread of each (merged) sketch: at most a few
    hundred bins a group, whatever its number of documents."""
    k = [*keys, "signal"]
    merged = sk.groupBy(*k, "bin").agg(F.sum("n").alias("n"))
    run = merged.withColumn("run", F.sum("n").over(W.partitionBy(*k).orderBy("bin"))) \
                .withColumn("total", F.sum("n").over(W.partitionBy(*k)))
    v = run.withColumn("v", _value("bin").cast("long")).withColumn(
        "high", F.element_at(F.create_map(*[F.lit(x) for s in signals for x in (s.name, s.high)]), F.col("signal")))
    return v.groupBy(*k).agg(F.max("total").alias("docs"), F.min(F.expr("case when 2 * run >= total then v end")).alias("mid"),
                             F.min(F.expr("case when 100 * run >= high * total then v end")).alias("top")) \
            .select(*k, "docs", "mid", (F.col("top") - F.col("mid")).alias("spread"))


def thresholds(sk: DataFrame, signals=SIGNALS, blend_docs: int = BLEND_DOCS) -> DataFrame:
    """One row per (lang, source) with ``max_<signal>`` fences."""
    def level(keys, tag):
        return _quantiles(sk, keys, signals).select(*keys, "signal", *[F.col(c).alias(f"{c}_{tag}") for c in ("docs", "mid", "spread")])

    own, lang, everything = level(["lang", "source"], "s"), level(["lang"], "l"), level([], "a")
    l2 = lang.withColumnRenamed("lang", "_l").withColumnRenamed("signal", "_g")
    a2 = everything.withColumnRenamed("signal", "_h")
    t = own.join(l2, own["lang"].eqNullSafe(l2["_l"]) & (own["signal"] == l2["_g"])).join(a2, F.col("signal") == F.col("_h"))
    t = t.withColumn("prior", F.element_at(F.create_map(*[F.lit(x) for s in signals for x in (s.name, s.prior)]), F.col("signal")))
    t = t.withColumn("spread_a", F.expr(f"greatest(least(spread_a, {BOUND} * prior), prior div {BOUND})"))
    for tag, up in (("l", "a"), ("s", "l")):
        t = t.withColumn(f"spread_{tag}", F.expr(
            f"greatest(least(spread_{tag}, {BOUND} * least(spread_a, prior)), spread_a div {BOUND})"))
        for c in ("mid", "spread"):
            t = t.withColumn(f"{c}_{tag}", F.expr(f"(docs_{tag} * {c}_{tag} + {blend_docs} * {c}_{up}) div (docs_{tag} + {blend_docs})"))
    return t.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("signal") == s.name, F.expr(f"mid_s + {s.reach} * spread_s div 10"))).alias(f"max_{s.name}")
        for s in signals])


def _passes(s: Signal) -> Column:
    return F.coalesce((_ratio(s) <= F.col(f"max_{s.name}")) | (F.col(s.part) <= LEAST_PART), F.lit(True))


def _verdict(signals) -> Column:
    ok = ~base_failed()
    for s in signals:
        ok = ok & _passes(s)
    return ok


def _with_thresholds(df: DataFrame, limits: DataFrame, lang: str, source: str) -> DataFrame:
    r = limits.withColumnRenamed("lang", "_tl").withColumnRenamed("source", "_ts")
    return df.join(r, F.col(lang).eqNullSafe(F.col("_tl")) & F.col(source).eqNullSafe(F.col("_ts")), "left").drop("_tl", "_ts")


def judge(docs: DataFrame, signals=SIGNALS, blend_docs: int = BLEND_DOCS) -> DataFrame:
    """doc_id, lang, source, the counts, the group's fences, base_failed and
    kept -- one row per document."""
    prepare(docs.sparkSession)
    counts = staged(docs.select("doc_id", "lang", "source", text_counts("text").alias("c"))
                    .select("doc_id", "lang", "source", "c.*"), "counts")
    limits = staged(thresholds(sketch(counts, signals), signals, blend_docs).coalesce(1), "limits")
    return (_with_thresholds(counts, limits, "lang", "source")
            .withColumn("base_failed", base_failed()).withColumn("kept", _verdict(signals)))


def keep_good(docs: DataFrame, signals=SIGNALS, blend_docs: int = BLEND_DOCS) -> DataFrame:
    """The documents that pass, with their own columns (extra ones included).
    The counts are computed once for the sketches and once beside the text, so
    no text is shuffled."""
    prepare(docs.sparkSession)
    counts = docs.select("lang", "source", text_counts("text").alias("c")).select("lang", "source", "c.*")
    limits = staged(thresholds(sketch(counts, signals), signals, blend_docs).coalesce(1), "limits")
    flat = docs.select(F.struct("*").alias("_doc"), F.col("lang").alias("_lang"), F.col("source").alias("_source"),
                       text_counts("text").alias("_c")).select("_doc", "_lang", "_source", "_c.*")
    return _with_thresholds(flat, limits, "_lang", "_source").filter(_verdict(signals)).select("_doc.*")
