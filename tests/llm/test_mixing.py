import re
from collections import defaultdict

import pytest

from punktwerk.llm import mixing
from punktwerk.llm.queries import QUERIES
from tests.llm.conftest import SF, edge_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(rows, share=1.5, weights=(3, 1, 2)):
    """Shares by weight; excess over twice a source goes round again."""
    size = defaultdict(int)
    for _, text, source in rows:
        size[source] += len(WORD.findall(text or ""))
    order = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    left, open_, out = share * sum(size.values()), set(order), {}
    while open_:
        unit = left / sum(w[s] for s in open_)
        over = [s for s in open_ if w[s] * unit > 2 * size[s]]
        if not over:
            out |= {s: w[s] * unit for s in open_}
            break
        for s in over:
            out[s] = 2.0 * size[s]
            left -= out[s]
            open_.remove(s)
    return size, out


def check(rows, got):
    size, want = targets(rows)
    taken = defaultdict(int)
    largest = defaultdict(int)
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source], abs=1e-6)
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in want:
        assert abs(taken[s] - want[s]) <= 2 * largest[s]     # repeated rows are taken together
    return taken


def test_edge_cases(edge):
    got = mixing.mix(edge).collect()
    rows = [(r[0], r[1], r[3]) for r in edge_rows()]
    assert len(got) == len(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted(
        (i is None, i or 0, len(WORD.findall(t or ""))) for i, t, _ in rows)
    check(rows, got)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(edge.repartition(7)).collect()))


def test_whole_table(spark, sf_docs):
    check(list(sf_docs[["doc_id", "text", "source"]].itertuples(index=False)), QUERIES["op1_mixing"](spark, SF).collect())


def test_empty_and_wordless(spark, empty, edge):
    assert mixing.mix(empty).count() == 0
    assert {r.taken for r in mixing.mix(edge.filter("text is null or text = ''")).collect()} == {0}


def test_mixed_documents_repeat_rows(edge):
    times = sum(r.times for r in mixing.mix(edge).collect())
    out = mixing.mixed_documents(edge)
    assert out.columns == edge.columns and out.count() == times


def test_thresholds_nest(edge):
    """A larger budget keeps every document a smaller one took."""
    small = {r.doc_id for r in mixing.mix(edge, share=0.4).collect() if r.times}
    large = {r.doc_id for r in mixing.mix(edge, share=0.6).collect() if r.times}
    assert small <= large


def test_rows_that_share_an_id(spark):
    """One id for all rows, with equal and with different texts: the taken
    words still come near the target, and the documents follow the plan."""
    rows = [(1, f"a b c {i % 7}" if i % 2 else f"own {i}", "s") for i in range(300)] + [(None, "x y z", "t")] * 100 + [(None, None, None)] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    taken = check(rows, got)
    _, want = targets(rows)
    assert all(abs(taken[s] - want[s]) <= 4 for s in want)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df.coalesce(1)).collect()))
    out = mixing.mixed_documents(df).collect()
    words = lambda rs, s: sum(len(WORD.findall(r.text or "")) for r in rs if r.source == s)
    assert {s: words(out, s) for s in want} == {s: taken[s] for s in want}


def test_plan_is_native(edge):
    plan = mixing.mix(edge)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
