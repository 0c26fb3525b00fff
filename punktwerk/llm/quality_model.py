"""Quality classifier: a generalised additive model with pairwise terms.

Text features are binned by quantiles. Training is cyclic boosting: round
after round, one shallow tree per feature is fitted to the current residuals
and added to that feature's lookup table with a small learning rate; then
the strongest pairs of features are boosted the same way on a coarse grid.
A tree on one binned feature is a step function over its bins, so a trained
term is a table, and a score is a sum of table entries -- one vectorised
lookup per term.

The model is fitted on the driver with at most ``sample_rows`` labelled rows
(those with the smallest hashes); features are taken on the cluster and only
the sample's numbers are collected. Everything else runs over all rows.

Null and empty texts get the features of an empty text and a score. Rows
without a label, or with a null label, teach nothing; of several labels for
one doc_id the largest counts. Without any labels, or with one class only,
every score is the smoothed share of label 1. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punktwerk.llm.common import bounded_sample, prepare, text_crc
from punktwerk.llm.quality_rules import count_texts

SAMPLE_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 150
PAIR_ROUNDS = 60
RATE = 0.15
LEAVES = 3

FEATURES = ["log_words", "word_length", "symbol_share", "upper_share", "dup_line_share", "repeat_share", "words_per_line",
            "distinct_share", "stutter_share", "digit_share", "punct_share", "long_word_share", "top_word_share", "bang_share",
            "short_lines"]

_DIGITS = b"0123456789"
_PUNCT = b".,;:"
_BANG = b"!?"


def features(texts) -> np.ndarray:
    """One row of numbers per whole text."""
    texts = [t or "" for t in texts]
    c = count_texts(texts)
    out = np.zeros((len(texts), len(FEATURES)))
    for k, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass")
        ws = b.split()
        n, size = len(ws), max(1, len(b))
        seen: dict[bytes, int] = {}
        for w in ws:
            seen[w] = seen.get(w, 0) + 1
        m = max(1, n)
        out[k, 6] = n / max(1, t.count("\n") + 1)
        out[k, 7] = len(seen) / m
        out[k, 9] = (len(b) - len(b.translate(None, _DIGITS))) / size
        out[k, 10] = (len(b) - len(b.translate(None, _PUNCT))) / m
        out[k, 11] = sum(len(w) > 12 for w in seen) / max(1, len(seen))
        out[k, 12] = max(seen.values(), default=0) / m
        out[k, 13] = (len(b) - len(b.translate(None, _BANG))) / m
        out[k, 14] = sum(len(x) < 20 for x in t.split("\n")) / (t.count("\n") + 1)
    v = {x: c[x].to_numpy(dtype=np.float64) for x in c.columns}
    n = np.maximum(1, v["n_words"])
    out[:, 0] = np.log1p(v["n_words"])
    out[:, 1] = v["word_chars"] / n
    out[:, 2] = v["n_symbols"] / np.maximum(1, v["word_chars"])
    out[:, 3] = v["n_upper"] / np.maximum(1, v["n_letters"])
    out[:, 4] = v["n_dup_lines"] / np.maximum(1, v["n_lines"])
    out[:, 5] = v["n_repeat_words"] / n
    out[:, 8] = v["n_stutter"] / n
    return out


def _step(bins: np.ndarray, n_bins: int, grad: np.ndarray, hess: np.ndarray, leaves: int) -> np.ndarray:
    """The best tree of ``leaves`` leaves over ordered bins, by Newton gain:
    a step function with one value per bin."""
    g = np.bincount(bins, grad, n_bins)
    h = np.bincount(bins, hess, n_bins)
    cuts = [(0, n_bins)]

    def gain(lo, hi):
        return g[lo:hi].sum() ** 2 / (h[lo:hi].sum() + 1.0)

    for _ in range(leaves - 1):
        best = None
        for lo, hi in cuts:
            cg, ch = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
            if hi - lo < 2:
                continue
            left = cg[:-1] ** 2 / (ch[:-1] + 1.0) + (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + 1.0)
            left[(ch[:-1] < 1.0) | (ch[-1] - ch[:-1] < 1.0)] = -np.inf
            at = int(left.argmax())
            won = left[at] - gain(lo, hi)
            if np.isfinite(won) and won > 1e-9 and (best is None or won > best[0]):
                best = (won, lo, hi, lo + at + 1)
        if best is None:
            break
        _, lo, hi, mid = best
        cuts.remove((lo, hi))
        cuts += [(lo, mid), (mid, hi)]
    out = np.zeros(n_bins)
    for lo, hi in cuts:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + 1.0)
    return out


@dataclass
class AdditiveModel:
    base: float = 0.0
    edges: list = field(default_factory=list)          # per feature: bin edges
    tables: list = field(default_factory=list)         # per feature: score per bin
    coarse: list = field(default_factory=list)
    pairs: list = field(default_factory=list)          # (i, j, table)

    @staticmethod
    def _bin(edges, x):
        return [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(edges)]

    def scores(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.base)
        if self.tables:
            for t, b in zip(self.tables, self._bin(self.edges, x)):
                f += t[b]
            wide = self._bin(self.coarse, x)
            for i, j, t in self.pairs:
                f += t[wide[i], wide[j]]
        return 1.0 / (1.0 + np.exp(-f))


def _quantile_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.arange(1, bins) / bins, method="higher")) for c in x.T]


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting of main terms, then of the strongest pairs."""
    p = (y.sum() + 1.0) / (len(y) + 2.0) if len(y) else 0.5
    model = AdditiveModel(base=float(np.log(p / (1 - p))))
    if not len(y) or y.min() == y.max():
        return model
    model.edges, model.coarse = _quantile_edges(x, BINS), _quantile_edges(x, PAIR_BINS)
    bins = model._bin(model.edges, x)
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    f = np.full(len(y), model.base)

    def residuals():
        q = 1.0 / (1.0 + np.exp(-f))
        return y - q, q * (1 - q)

    for _ in range(ROUNDS):
        for k, b in enumerate(bins):
            s = RATE * _step(b, len(model.tables[k]), *residuals(), LEAVES)
            model.tables[k] += s
            f += s[b]
    wide = model._bin(model.coarse, x)
    size = [len(e) + 1 for e in model.coarse]
    grad, hess = residuals()
    ranked = []
    for i in range(x.shape[1]):
        for j in range(i):
            cell = wide[i] * size[j] + wide[j]
            g, h = np.bincount(cell, grad), np.bincount(cell, hess)
            ranked.append((float((g ** 2 / (h + 5.0)).sum()), i, j))
    chosen = [(i, j, np.zeros((size[i], size[j]))) for _, i, j in sorted(ranked, reverse=True)[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in chosen:
            grad, hess = residuals()
            # a shallow tree on two features: the best cut of one, then of the other on each side
            step = np.zeros_like(table)
            cut = np.flatnonzero(np.diff(_step(wide[i], size[i], grad, hess, 2)))
            mid = int(cut[0]) + 1 if len(cut) else size[i]
            for side, rows in ((slice(0, mid), wide[i] < mid), (slice(mid, size[i]), wide[i] >= mid)):
                step[side] = _step(wide[j][rows], size[j], grad[rows], hess[rows], 2)
            table += RATE * step
            f += RATE * step[wide[i], wide[j]]
    model.pairs = chosen
    return model


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def text_features(text: pd.Series) -> pd.Series:
    return pd.Series(list(features(text)))


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, rows: int):
    """Features and labels of at most ``rows`` training rows. The bound is set
    on the narrow labels first; only those texts are looked at."""
    train = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ((text_crc("doc_id") % folds) != held))
             .groupBy("doc_id").agg(F.max(label).cast("double").alias("_y")))
    train = bounded_sample(train, "fit", rows)
    # a bounded table: ``rows`` ids with a label
    got = (docs.select("doc_id", "text").join(F.broadcast(train), "doc_id")
           .select("doc_id", "_y", text_features("text").alias("f")).toPandas().drop_duplicates("doc_id").sort_values("doc_id"))
    if not len(got):
        return np.zeros((0, len(FEATURES))), np.zeros(0)
    return np.stack(got["f"].to_numpy()), got["_y"].to_numpy()


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 3, held: int = 1,
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row. Labels of rows whose
    crc32(doc_id) leaves ``held`` modulo ``folds`` are never learned."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(fit(*sample(docs, labels, label, folds, held, sample_rows)))

    @F.pandas_udf(T.DoubleType())
    def run(text: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(features(text)))

    return docs.select("doc_id", ((text_crc("doc_id") % folds) == held).alias("held_out"), run("text").alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
