"""Operators 4, 5 and 9: held-out accuracy and edge cases."""
import zlib

import numpy as np
import pytest

from punktwerk.llm import language_id, licenses, quality_model
from punktwerk.llm.queries import QUERIES
from tests.llm.conftest import SF, edge_rows

SF01 = "/root/testdata/sf0.01"


def fold(i, n):
    return zlib.crc32(str(i if i is not None else "").encode()) % n


@pytest.fixture(scope="module")
def docs01():
    import duckdb
    return duckdb.sql(f"select * from '{SF01}/documents.parquet'").df().set_index("doc_id")


def test_language_held_out(spark, docs01):
    rows = QUERIES["op5_language_id"](spark, SF01).collect()
    assert len(rows) == len(docs01) and all(r.held_out == (fold(r.doc_id, 5) == 0) for r in rows)
    held = [r.lang_pred == docs01.lang[r.doc_id] for r in rows if r.held_out and len(docs01.text[r.doc_id]) >= 60]
    assert np.mean(held) > 0.97 and all(0 <= r.score <= 1 for r in rows)


def test_language_edge_cases(spark, edge, empty):
    rows = language_id.identify(edge).collect()
    assert len(rows) == len(edge_rows())
    by = {r[0]: r[1] for r in edge_rows()}
    for r in rows:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in by[r.doc_id] or ""))
    assert language_id.identify(empty).count() == 0
    unlabelled = edge.withColumn("lang", language_id.F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_language_never_learns_held_out_rows(spark):
    """Labels of the held-out fold can be anything."""
    rows = [(i, "der die das und " * 20 if i % 2 else "the and of to " * 20, "de" if i % 2 else "en") for i in range(60)]
    lies = [(i, t, lang if fold(i, 5) else "xx") for i, t, lang in rows]
    schema = "doc_id long, text string, lang string"
    a, b = (sorted(map(tuple, language_id.identify(spark.createDataFrame(x, schema)).collect())) for x in (rows, lies))
    assert a == b and all(r[2] == ("de" if r[0] % 2 else "en") for r in a)


def test_quality_held_out(spark, docs01):
    import duckdb
    lab = dict(duckdb.sql(f"select doc_id, quality from '{SF01}/labels.parquet'").fetchall())
    rows = QUERIES["op9_quality_model"](spark, SF01).collect()
    assert len(rows) == len(docs01) and all(r.held_out == (fold(r.doc_id, 3) == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r.predicted == lab[r.doc_id] for r in rows if r.held_out and r.doc_id in lab]
    assert np.mean(held) > 0.95


def test_quality_edge_cases(spark, edge, empty):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(30)] + [(3, None, 0), (None, 1, 1), (4, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    a = quality_model.score(edge, labels).collect()
    assert len(a) == len(edge_rows()) and all(r.score is not None for r in a)
    assert quality_model.score(empty, labels).count() == 0
    none = quality_model.score(edge, labels.filter("false")).collect()
    assert {r.score for r in none} == {0.5}


def test_quality_never_learns_held_out_labels(spark, edge):
    rows = [(i, i % 2) for i in range(50)]
    lies = [(i, 1 - y if fold(i, 3) == 1 else y) for i, y in rows]
    a, b = (sorted(map(repr, quality_model.score(edge, spark.createDataFrame(x, "doc_id long, quality int")).collect())) for x in (rows, lies))
    assert a == b


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (4000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)       # invisible to main terms
    m = quality_model.fit(x[:3000], y[:3000])
    assert np.mean((m.scores(x[3000:]) >= 0.5) == y[3000:]) > 0.9
    assert m.scores(x).shape == (4000,)


def test_additive_model_is_a_sum_of_tables():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 2))
    m = quality_model.fit(x, (x[:, 0] > 0.3).astype(float))
    bins = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(m.edges)]
    wide = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(m.coarse)]
    f = m.base + sum(t[b] for t, b in zip(m.tables, bins)) + sum(t[wide[i], wide[j]] for i, j, t in m.pairs)
    assert np.allclose(m.scores(x), 1 / (1 + np.exp(-f)))


LINES = {"Licensed under the Apache License, Version 2.0.": "apache-2.0", "Released under the MIT License.": "mit", "All rights reserved.": "proprietary",
         "This work is licensed under the GNU General Public License, version 3.": "gpl", "Licensed under CC BY-NC 4.0.": "cc-by-nc"}


def test_licenses_held_out(spark, docs01):
    """Documents with a notice line of a known family, against those without."""
    rows = QUERIES["op4_license_scan"](spark, SF01).collect()
    assert len(rows) == len(docs01)
    wrong = 0
    for r in rows:
        want = {f for line, f in LINES.items() if line.lower() in docs01.text[r.doc_id].lower()}
        wrong += (r.family not in want) if want else (r.family != "none")
    assert wrong <= 2


def test_licenses_edge_cases(spark, edge, empty):
    assert {r.family for r in licenses.scan(edge).collect()} == {"none"}
    assert licenses.scan(empty).count() == 0
    rows = [(1, "prose here\n\nRELEASED UNDER THE MIT LICENSE!!\nmore"), (2, None), (3, "licensed to drive a car"),
            (4, "word " * 3000 + "Licensed under the Apache License, Version 2.0. " + "word " * 3000)]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].family == "mit" and got[1].confirmed and [f.paragraph for f in got[1].found] == [2]
    assert got[2].family == "none" and not got[3].confirmed and got[4].family == "apache-2.0"


def test_licenses_shortened_notices():
    """Notices that lost some words are still assigned to their family."""
    import random
    model = licenses.train([["the", "of", "and", "a", "word", str(i)] for i in range(200)])
    rng = random.Random(99)
    right = []
    for family, ts in licenses.TEMPLATES.items():
        for t in ts:
            ws = licenses.tokens(t)
            for _ in range(5):
                cut = [w for w in ws if rng.random() > 0.1] or ws
                right.append(model.classify(cut)[0] == family)
    assert np.mean(right) > 0.85


WRAPPED = {
    "bsd": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:""",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:""",
    "gpl": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""}


@pytest.mark.parametrize("family", sorted(WRAPPED))
@pytest.mark.parametrize("leader", ["", "# ", " * ", "// ", "dnl "])
def test_licenses_wrapped_notices(family, leader):
    """A hard-wrapped notice, also in a comment, is one confirmed paragraph."""
    model = licenses.train([["the", "of", "and", "a", "word", str(i)] for i in range(200)])
    templates = {f: [licenses.tokens(t) for t in ts] for f, ts in licenses.TEMPLATES.items()}
    lines = ["some words", "", *WRAPPED[family].split("\n"), "", "more words"]
    found = licenses.scan_text("\n".join(leader + x for x in lines), model, templates)
    assert [(f["family"], f["confirmed"]) for f in found] == [(family, True)] and found[0]["paragraph"] == 2


def test_licenses_two_notices_in_a_paragraph():
    model = licenses.train([["the", "of", "and", "a", "word", str(i)] for i in range(200)])
    templates = {f: [licenses.tokens(t) for t in ts] for f, ts in licenses.TEMPLATES.items()}
    found = licenses.scan_text("Released under the MIT License.\nLicensed under CC BY-NC 4.0.\n" + "plain text here " * 30, model, templates)
    assert {(f["family"], f["confirmed"], f["paragraph"]) for f in found} >= {("mit", True, 0), ("cc-by-nc", True, 1)}


def test_letters_by_category():
    """Number signs are no letters, combining marks belong to their letters."""
    import unicodedata
    for t in ("²³", "½", "①", "Ⅷ", "٣", "_ _", "\u0301", "", None, "12 ! ?"):
        assert language_id.letters(t) == ""
    assert language_id.letters("हिन्दी² Ünï_x") == "हिन्दी ünï x"
    every = "".join(map(chr, range(0x20, 0x3000)))
    kept = set(language_id.letters(every).replace(" ", ""))
    assert all(unicodedata.category(c)[0] in "LM" for c in kept)
    assert {c for c in every.lower() if unicodedata.category(c)[0] == "L"} <= kept


def test_language_scores_against_plain_compression(spark, sf_docs):
    """The whole table by a plain version: the sizes of all chunks under each
    dictionary, the smallest sum, its softmax."""
    import zlib

    import numpy as np
    import zstandard
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    train = docs.select("doc_id", "text", "lang").filter("crc32(cast(cast(doc_id as string) as binary)) % 5 != 0")
    content = language_id.dictionaries(train)
    each = {k: zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(v, dict_type=zstandard.DICT_TYPE_RAWCONTENT), level=language_id.LEVEL,
                                        write_checksum=False, write_content_size=False, write_dict_id=False) for k, v in content.items() if len(v) >= 8}
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    for i, text in sf_docs[["doc_id", "text"]].itertuples(index=False):
        t = language_id.letters(text).encode()
        r = got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        if not t:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        sizes = {k: sum(len(c.compress(t[j:j + 2048])) for j in range(0, len(t), 2048)) for k, c in each.items()}
        best = min(sizes.values())
        assert sizes[r.lang_pred] == best
        assert abs(r.score - 1 / sum(np.exp(-(v - best) / len(t) / 0.02) for v in sizes.values())) < 1e-9
