"""Licence scan: a trained paragraph classifier, confirmed by templates.

Paragraphs (the lines up to one without words, joined, so that a hard-wrapped
notice is seen whole, and each line by itself, so that a one-line notice is not
lost among others; long ones in overlapping windows) are classified by
multinomial logistic regression over sparse word n-grams (one to three
words). It is trained on the notice templates below, on shortened and
word-dropped variants of them, and on ordinary paragraphs of the corpus. The
scores are calibrated on variants and paragraphs held out from training: a
temperature is fitted, and the ``unknown`` class is what stays below the
probability that the calibration paragraphs reach. A prediction is confirmed
when the paragraph covers enough of one of the family's templates.

Ordinary paragraphs come from a bounded sample (``sample_docs`` rows with the
smallest hashes, ``lines_per_doc`` lines each); paragraphs that match a
template are left out of it. A paragraph without any word that is typical of
the templates (a template word that ordinary paragraphs don't use) is no
licence by definition of the model. Null and empty texts have no paragraphs:
family ``none``. Ties between families go to the first by name. Extra columns
are ignored; empty tables give no rows and train on templates alone.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punktwerk.llm.common import bounded_sample, prepare

# Short public licence notices by family.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0"],
    "bsd": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause"],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0"],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Dedicated to the public domain under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0"],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later"],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only"],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT"],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0"],
    "proprietary": [
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher.",
        "This document is confidential and proprietary."],
}
NONE, UNKNOWN = "none", "unknown"
CLASSES = [NONE, *sorted(TEMPLATES)]
WINDOW, STRIDE = 48, 24
SAMPLE_DOCS, LINES_PER_DOC = 2000, 10
VARIANTS = 40
CONFIRM = 0.6
#: Share of ordinary calibration paragraphs that may pass as a licence.
FALSE_SHARE = 0.001

_TOKEN = re.compile(r"[a-z0-9]+")


def tokens(paragraph: str) -> list[str]:
    return _TOKEN.findall(paragraph.lower())


def ngrams(ws: list[str]) -> set:
    return {tuple(ws[i:i + n]) for n in (1, 2, 3) for i in range(len(ws) - n + 1)}


def paragraphs(lines):
    """Lists of (line number, words): the lines up to a blank line, or one of
    signs only. Comment signs are no words; leading comment words go."""
    block = []
    for k, line in enumerate(lines):
        ws = tokens(line)
        if ws and ws[0] in ("dnl", "rem"):
            ws = ws[1:]
        if ws:
            block.append((k, ws))
        elif block:
            yield block
            block = []
    if block:
        yield block


def windows(ws: list[str]):
    """A paragraph's words, long ones in overlapping windows; whole texts are
    covered."""
    if len(ws) <= WINDOW:
        yield ws
    else:
        for i in range(0, len(ws) - STRIDE, STRIDE):
            yield ws[i:i + WINDOW]


def coverage(ws: list[str], template: list[str]) -> float:
    """Share of a template's word pairs found in the paragraph (single words
    for one-word templates)."""
    def pairs(x):
        return set(zip(x, x[1:])) if len(x) > 1 else set(x)
    t = pairs(template)
    return len(t & pairs(ws)) / max(1, len(t))


@dataclass
class Classifier:
    vocabulary: dict          # n-gram -> column
    weights: np.ndarray       # columns x classes
    bias: np.ndarray
    typical: frozenset        # words that make a paragraph worth scoring
    known: frozenset          # words of the templates
    temperature: float = 1.0
    least: float = 0.5

    def logits(self, ws: list[str]) -> np.ndarray:
        cols = [c for c in map(self.vocabulary.get, ngrams(ws)) if c is not None]
        z = self.bias + self.weights[cols].sum(axis=0)
        return z + self.weights[-1] * (sum(w not in self.known for w in ws) / max(1, len(ws)))

    def probabilities(self, ws: list[str]) -> np.ndarray:
        z = self.logits(ws) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()

    def classify(self, ws: list[str]) -> tuple[str, float]:
        """(family, probability): ``none`` when ordinary text is likelier,
        ``unknown`` when no family reaches the calibrated probability."""
        if self.typical.isdisjoint(ws):
            return NONE, 1.0
        p = self.probabilities(ws)
        best = int(p.argmax())
        if best == 0:
            return NONE, float(p[0])
        return (CLASSES[best] if p[best] >= self.least else UNKNOWN), float(p[best])


def _variants(rng: random.Random, ws: list[str], others: list[list[str]]):
    """A notice as it is met in the wild: some words lost, some ordinary words
    around it."""
    out = [w for w in ws if rng.random() > 0.08] or ws
    if others and rng.random() < 0.5:
        extra = rng.choice(others)[:rng.randint(1, 8)]
        out = extra + out if rng.random() < 0.5 else out + extra
    return out


def train(ordinary: list[list[str]], seed: int = 7, variants: int = VARIANTS) -> Classifier:
    """Fits and calibrates the classifier on the driver, with bounded input."""
    rng = random.Random(seed)
    notices = [(CLASSES.index(f), tokens(t)) for f in sorted(TEMPLATES) for t in TEMPLATES[f]]
    ordinary = [ws for ws in ordinary if ws and max(coverage(ws, t) for _, t in notices) < CONFIRM]
    rng.shuffle(ordinary)
    cut = len(ordinary) // 4
    held_plain, plain = ordinary[:cut], ordinary[cut:]
    fitted = [(k, _variants(rng, t, plain) if v else t) for k, t in notices for v in range(variants)]
    held = [(k, _variants(rng, t, held_plain)) for k, t in notices for _ in range(variants // 4)]
    known = frozenset(w for _, t in notices for w in t)
    common = {w for ws in plain for w in ws}
    grams = sorted({g for _, t in notices for g in ngrams(t)})
    vocabulary = {g: i for i, g in enumerate(grams)}
    rows = fitted + [(0, ws) for ws in plain]
    x = np.zeros((len(rows), len(grams) + 1), np.float32)
    for i, (_, ws) in enumerate(rows):
        for g in ngrams(ws):
            if g in vocabulary:
                x[i, vocabulary[g]] = 1
        x[i, -1] = sum(w not in known for w in ws) / max(1, len(ws))
    y = np.eye(len(CLASSES), dtype=np.float32)[[k for k, _ in rows]]
    w, b = np.zeros((x.shape[1], len(CLASSES)), np.float32), np.zeros(len(CLASSES), np.float32)
    rate, speed_w, speed_b = 2.0, np.zeros_like(w), np.zeros_like(b)
    for _ in range(300):            # gradient descent with momentum, l2-regularised
        z = x @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = (p - y) / len(rows)
        speed_w = 0.9 * speed_w - rate * (x.T @ g + 1e-4 * w)
        speed_b = 0.9 * speed_b - rate * g.sum(axis=0)
        w, b = w + speed_w, b + speed_b
    typical = (known - common) | {"license", "licensed", "licence", "copyright", "reserved", "permission", "spdx"}
    model = Classifier(vocabulary, w, b, frozenset(typical), known)
    check = held + [(0, ws) for ws in held_plain]

    def loss(t):
        model.temperature = t
        return -np.mean([np.log(max(1e-12, model.probabilities(ws)[k])) for k, ws in check])

    model.temperature = min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0), key=loss)
    loss(model.temperature)
    # the unknown class: the probability that ordinary held-out paragraphs stay below
    false = sorted(1 - model.probabilities(ws)[0] for ws in held_plain if not model.typical.isdisjoint(ws))
    allowed = int(FALSE_SHARE * len(held_plain))
    model.least = max(0.5, float(false[-1 - allowed])) if len(false) > allowed else 0.5
    model.least = min(model.least, 0.95)
    return model


def ordinary_paragraphs(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, lines_per_doc: int = LINES_PER_DOC) -> list[list[str]]:
    """Paragraphs of a bounded sample of documents."""
    lines = F.slice(F.split("text", "\n"), 1, lines_per_doc)
    got = bounded_sample(docs.select("doc_id", "text"), "licence", sample_docs).filter("text is not null").select(
        "doc_id", lines.alias("l")).orderBy("doc_id").collect()
    notices = [tokens(t) for ts in TEMPLATES.values() for t in ts]
    out = []
    for r in got:
        for block in paragraphs(line[:2000] for line in r["l"]):
            joined = list(windows([w for _, ws in block for w in ws]))
            # the lines of a wrapped notice are no ordinary text
            if len(block) > 1 and all(max(coverage(win, t) for t in notices) < CONFIRM for win in joined):
                out += joined
            if len(block) == 1 or all(max(coverage(win, t) for t in notices if len(t) > WINDOW // 4) < CONFIRM for win in joined):
                out += [win for _, ws in block for win in windows(ws)]
    return out


_FOUND = T.ArrayType(T.StructType([T.StructField("paragraph", T.IntegerType()), T.StructField("family", T.StringType()),
                                   T.StructField("score", T.DoubleType()), T.StructField("confirmed", T.BooleanType())]))


def scan_text(text: str | None, model: Classifier, templates) -> list[dict]:
    """The licence paragraphs of a whole text, by their first line. Of a
    joined paragraph each confirmed family counts once; its lines that aren't
    confirmed themselves are part of it."""
    def surest(found, k, win):
        family, p = model.classify(win)
        if family == NONE:
            return
        sure = family != UNKNOWN and max(coverage(win, t) for t in templates[family]) >= CONFIRM
        if k not in found or (sure, p) > (found[k]["confirmed"], found[k]["score"]):
            found[k] = {"paragraph": k, "family": family, "score": p, "confirmed": sure}

    out = []
    for block in paragraphs((text or "").split("\n")):
        if all(model.typical.isdisjoint(ws) for _, ws in block):
            continue
        found: dict = {}
        for k, ws in block:
            for win in windows(ws):
                surest(found, k, win)
        if len(block) > 1:
            at = [k for k, ws in block for _ in ws]
            for i, win in enumerate(windows([w for _, ws in block for w in ws])):
                whole: dict = {}
                first, last = at[i * STRIDE], at[i * STRIDE + len(win) - 1]
                surest(whole, first, win)
                got = whole.get(first)
                if got and got["confirmed"]:
                    if all(f["family"] != got["family"] or not f["confirmed"] for f in found.values()):
                        # its lines, and those beside it that are no other family's
                        near = at[max(0, i * STRIDE - WINDOW)], at[min(len(at) - 1, i * STRIDE + 2 * WINDOW)]
                        found = {k: f for k, f in found.items() if f["confirmed"] or not (
                            first <= k <= last or near[0] <= k <= near[1] and f["family"] in (UNKNOWN, got["family"]))}
                        k = first
                        while k in found:       # a line with a notice of its own
                            k += 1
                        found[k] = got | {"paragraph": k}
        out += [found[k] for k in sorted(found)]
    return out


def scan(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, family, score, confirmed (of the surest paragraph), n_found and
    the list of licence paragraphs."""
    spark = prepare(docs.sparkSession)
    model = train(ordinary_paragraphs(docs, sample_docs))
    shared = spark.sparkContext.broadcast((model, {f: [tokens(t) for t in ts] for f, ts in TEMPLATES.items()}))

    @F.pandas_udf(_FOUND)
    def run(text: pd.Series) -> pd.Series:
        return pd.Series([scan_text(t, *shared.value) for t in text], dtype=object)

    d = docs.select("doc_id", run("text").alias("found"))
    best = F.array_max(F.transform("found", lambda p: F.struct(p["confirmed"], p["score"], p["family"])))
    return d.withColumn("_b", best).select(
        "doc_id", F.coalesce(F.col("_b.family"), F.lit(NONE)).alias("family"), F.coalesce(F.col("_b.score"), F.lit(0.0)).alias("score"),
        F.coalesce(F.col("_b.confirmed"), F.lit(False)).alias("confirmed"), F.size("found").alias("n_found"), "found")
