import hashlib
from collections import defaultdict

import numpy as np

from punktwerk.llm import exact_dedup
from tests.llm.conftest import edge_rows


def norm(t):
    return (t or "").encode().lower()       # bytes: A-Z only


def test_edge_cases(edge):
    groups = defaultdict(list)
    for r in edge_rows():
        groups[norm(r[1])].append(r[0])
    want = []
    for r in edge_rows():
        g = groups[norm(r[1])]
        ids = [i for i in g if i is not None]
        keep = max(ids) if ids else None
        want.append((r[0], keep, len(g), r[0] == keep, hashlib.sha256(norm(r[1])).hexdigest()))
    got = [tuple(r) for r in exact_dedup.exact_groups(edge).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_drop_copies_keeps_columns(edge):
    out = exact_dedup.drop_copies(edge)
    assert out.columns == edge.columns
    kept = out.collect()
    assert sorted(norm(r.text) for r in kept) == sorted({norm(r[1]) for r in edge_rows()})
    best = {}
    for r in edge_rows():
        best[norm(r[1])] = max(best.get(norm(r[1]), -1), -1 if r[0] is None else r[0])
    assert all(best[norm(r.text)] == (-1 if r.doc_id is None else r.doc_id) for r in kept)


def test_rows_that_share_an_id(spark):
    """Repeated and null ids: rows go, not ids."""
    rows = [(1, "text A", "x"), (1, "text B", "x"), (2, "TEXT B", "x"), (None, "c", "x"), (None, "C", "x"), (None, "d", "x"), (5, "e", "x"), (5, "e", "x"),
            (5, "e", "y"), (None, None, "x"), (7, "", "x")]
    out = [tuple(r) for r in exact_dedup.drop_copies(spark.createDataFrame(rows, "doc_id long, text string, _t string").repartition(3)).collect()]
    assert sorted((norm(t), i is None, i) for i, t, _ in out) == sorted(
        [(b"text a", False, 1), (b"text b", False, 2), (b"c", True, None), (b"d", True, None), (b"e", False, 5), (b"", False, 7)])


def test_empty(empty):
    assert exact_dedup.exact_groups(empty).count() == 0


def test_filters_merge_without_loss():
    rng = np.random.default_rng(3)
    fp = rng.integers(-2**62, 2**62, 500)
    parts = [rng.choice(fp, 400) for _ in range(4)]
    merged = defaultdict(list)
    for p in parts:
        for block, rem, cnt in exact_dedup.filter_of(p, 6):
            assert (np.diff(rem.astype(np.float64)) > 0).all()
            merged[block].append((rem, cnt))
    got = {}
    for block, ps in merged.items():
        r, n = exact_dedup.merge_blocks(ps)
        full = ((np.uint64(block) << np.uint64(58)) | r).view(np.int64)
        got |= dict(zip(full.tolist(), n.tolist()))
    u, n = np.unique(np.concatenate(parts), return_counts=True)
    assert got == dict(zip(u.tolist(), n.tolist()))


def test_equal_fingerprints_of_different_texts_stay_apart(spark, monkeypatch, edge):
    """With a fingerprint that always collides, the bytes still decide."""
    from pyspark.sql import functions as F
    real = F.xxhash64
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.lit(7).cast("long") + real(*c) * 0)
    got = sorted((r.doc_id or -1, r.group_size) for r in exact_dedup.exact_groups(edge).collect())
    monkeypatch.undo()
    assert got == sorted((r.doc_id or -1, r.group_size) for r in exact_dedup.exact_groups(edge).collect())
