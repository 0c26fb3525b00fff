"""Language identification by compression.

Each language gets a raw-content zstandard dictionary of sample text. A text
is cut into chunks, every chunk is compressed once with each dictionary, and
the language whose compressed sizes sum to the least wins. The margin to the
runner-up, per byte of text, gives a score; below ``least_margin`` the
prediction is rejected (``reliable`` false).

The dictionaries are built from a bounded sample: per language, one slice of
text from the row with the smallest hash in each of ``slots`` hash slots,
``slice_chars`` characters each. The sample comes from one combined
aggregation, so a language with most of the rows is no hot group. Before
compression letters are lower-cased and every run of other characters
becomes one space.

A null text, or one without letters, is ``und`` with score 0. Rows with a
null language teach nothing. Without any labelled row every text is ``und``.
Extra columns are ignored; repeated rows are predicted row by row.
"""

from __future__ import annotations

import re
import sys
import unicodedata

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punktwerk.llm.common import prepare, text_crc

SLOTS = 160
SLICE_CHARS = 400
CHUNK_BYTES = 2048
LEVEL = 9
LEAST_MARGIN = 0.01
#: Margin (compressed bytes saved per byte of text) at which the score is 0.73.
MARGIN_SCALE = 0.02
UND = "und"

# Letters and the marks that combine with them (Unicode categories L and M)
# make words; signs such as superscript digits or circled numbers don't.
_SIGNS, _MARKS = ("".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) in kinds) for kinds in (("No", "Nl"), ("Mn", "Mc", "Me")))
# Python looks characters of the first plane up in a table, others one by one.
_SPECIAL = re.compile("[" + "".join(c for c in _SIGNS + _MARKS if c < "\U00010000") + "]")
_ASTRAL = re.compile("[\U00010000-\U0010ffff]")
_NOT_LETTERS = re.compile(r"[\W\d_]+")                       # right for texts without special signs
_NOT_LETTERS_OR_MARKS = re.compile(f"(?:[\\d_{_SIGNS}]|(?![{_MARKS}])\\W)+")


def letters(text: str | None) -> str:
    """The words of a text, lower-cased; empty if it has no letter."""
    t = (text or "").lower()
    plain = t.isascii() or not (_SPECIAL.search(t) or _ASTRAL.search(t))
    t = (_NOT_LETTERS if plain else _NOT_LETTERS_OR_MARKS).sub(" ", t).strip()
    return t if any(map(str.isalpha, t)) else ""


def dictionaries(train: DataFrame, slots: int = SLOTS, slice_chars: int = SLICE_CHARS) -> dict[str, bytes]:
    """lang -> dictionary content, from (doc_id, text, lang) rows. At most
    ``slots * slice_chars`` characters a language reach the driver."""
    h = F.xxhash64("doc_id", F.lit("lang"))
    # the middle of the text: openings are shared by many documents
    middle = F.expr(f"substring(text, cast(greatest(1, (length(text) - {slice_chars}) / 2) as int), {slice_chars})")
    got = (train.filter("lang is not null and text is not null")
           .select("lang", F.pmod(h, F.lit(slots)).alias("slot"), F.struct(h.alias("h"), middle.alias("t")).alias("s"))
           .groupBy("lang", "slot").agg(F.min("s").alias("s")).collect())
    by: dict[str, list] = {}
    for r in got:
        by.setdefault(r["lang"], []).append((r["slot"], letters(r["s"]["t"])))
    return {lang: " ".join(t for _, t in sorted(rows) if t).encode() for lang, rows in sorted(by.items())}


class Compressors:
    """One compressor per language."""

    def __init__(self, content: dict[str, bytes]):
        self.langs = [k for k, v in content.items() if len(v) >= 8]
        self._each = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self._each.append(zstandard.ZstdCompressor(dict_data=d, level=LEVEL, write_checksum=False, write_content_size=False,
                                                       write_dict_id=False))

    def sizes(self, text: str) -> np.ndarray:
        """Compressed bytes of the whole text under each language."""
        b = text.encode("utf-8", "surrogatepass")
        chunks = [b[i:i + CHUNK_BYTES] for i in range(0, len(b), CHUNK_BYTES)]
        return np.array([sum(len(c.compress(x)) for x in chunks) for c in self._each], dtype=np.float64)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        t = letters(text)
        if not t or not self.langs:
            return UND, 0.0, False
        s = self.sizes(t)
        best = int(s.argmin())
        margins = (s - s[best]) / len(t.encode("utf-8", "surrogatepass"))
        score = 1.0 / np.exp(-margins / MARGIN_SCALE).sum()
        rest = np.delete(margins, best)
        return self.langs[best], float(score), bool(len(rest) == 0 or rest.min() >= LEAST_MARGIN)


def classify(content: dict[str, bytes], spark) -> "Column":
    """Column function text -> struct(lang_pred, score, reliable). The
    dictionaries are broadcast: a fixed number of bytes a language."""
    shared = spark.sparkContext.broadcast(content)
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                         T.StructField("reliable", T.BooleanType())])

    ready: list[Compressors] = []       # made once per task

    @F.pandas_udf(kind)
    def run(text: pd.Series) -> pd.DataFrame:
        if not ready:
            ready.append(Compressors(shared.value))
        c = ready[0]
        return pd.DataFrame([c.predict(t) for t in text], columns=["lang_pred", "score", "reliable"])

    return run


def identify(docs: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, lang_pred, score, reliable of every row. Rows whose
    crc32(doc_id) leaves ``held`` modulo ``folds`` are never learned from."""
    spark = prepare(docs.sparkSession)
    out = (text_crc("doc_id") % folds) == held
    model = dictionaries(docs.select("doc_id", "text", "lang").filter(~out))
    return docs.select("doc_id", out.alias("held_out"), classify(model, spark)("text").alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score", "p.reliable")
