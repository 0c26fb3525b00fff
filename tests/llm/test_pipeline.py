"""The pipeline's stages, each against its brute-force version on the rows
that its predecessor kept."""
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402

from tests.llm import test_exact_dedup, test_mixing, test_near_join, test_packing, test_quality_rules  # noqa: E402
from tests.llm.conftest import SF  # noqa: E402
from tests.llm.test_tokens import BYTE_BPE, library  # noqa: E402


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The documents before and after every stage, written and read again."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("pipe") / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_join", "mixing", "packing"]


def test_columns(steps):
    assert all(d.columns == steps[0].columns for d in steps[:-1])


def test_rules(steps):
    want = test_quality_rules.verdicts(rows(steps[0], "doc_id", "text", "lang", "source"), corpus_pipeline.quality_rules.BLEND_DOCS)
    kept = {eval(w)[0] for w in want if eval(w)[-1]}
    assert {r.doc_id for r in steps[1].collect()} == kept


def test_exact(steps):
    best = {}
    for i, t in rows(steps[1], "doc_id", "text"):
        best[test_exact_dedup.norm(t)] = max(i, best.get(test_exact_dedup.norm(t), i))
    assert sorted(r.doc_id for r in steps[2].collect()) == sorted(best.values())


def test_near(steps):
    want = {c for _, _, c in test_near_join.brute(rows(steps[2], "doc_id", "text"))}
    assert sorted(r.doc_id for r in steps[3].collect()) == sorted(want)


def test_mixed(steps):
    before = rows(steps[3], "doc_id", "text", "source")
    times = Counter(r.doc_id for r in steps[4].collect())
    size, want = test_mixing.targets(before)
    taken, largest = Counter(), Counter()
    for i, t, s in before:
        n = len(test_mixing.WORD.findall(t or ""))
        assert times[i] <= 2
        taken[s] += n * times[i]
        largest[s] = max(largest[s], n)
    assert set(times) <= {i for i, _, _ in before}
    assert all(abs(taken[s] - want[s]) <= 2 * largest[s] for s in want)


def test_packed(steps):
    enc = library(BYTE_BPE)
    before = rows(steps[4], "doc_id", "text")
    texts = {i: enc(t) + [1] for i, t in before}
    got = steps[5].collect()
    assert sum(p.length for p in got) == sum(len(texts[i]) for i, _ in before)
    test_packing.check(got, texts)
    assert np.all([p.length <= 2048 for p in got])


def test_run_gives_the_last_stage(spark, steps):
    assert corpus_pipeline.run(spark, SF).count() == steps[5].count()
