import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from punktwerk.llm import packing
from punktwerk.llm.queries import QUERIES, tokenizer
from tests.llm.conftest import SF, edge_rows
from tests.llm.test_tokens import BYTE_BPE, library


def check(pieces, texts, max_len=2048):
    """texts: doc_id -> ids; every id lies in one piece, sequences are gapless."""
    covered = defaultdict(list)
    placed = defaultdict(list)
    for p in pieces:
        ids = texts[p.doc_id][p.start:p.start + p.length]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == p.ids_crc32 and p.doc_tokens == len(texts[p.doc_id])
        covered[p.doc_id].append((p.start, p.start + p.length))
        placed[p.sequence_id].append((p.offset, p.length))
    for doc, spans in covered.items():
        spans = sorted(set(spans))
        assert spans[0][0] == 0 and spans[-1][1] == len(texts[doc]) and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    for spans in placed.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= max_len
    assert sorted(placed) == list(range(len(placed)))


def test_whole_table(spark, sf_docs):
    enc = library(BYTE_BPE)
    texts = {i: enc(t) + [1] for i, t in sf_docs[["doc_id", "text"]].itertuples(index=False)}
    got = QUERIES["op7_packing"](spark, SF).collect()
    assert {p.doc_id for p in got} == set(texts) and sum(p.length for p in got) == sum(map(len, texts.values()))
    check(got, texts)


def test_edge_cases(edge, empty):
    enc = library(BYTE_BPE)
    rows = [(r[0], r[1]) for r in edge_rows()]
    got = packing.packing_digest(edge, tokenizer(BYTE_BPE), 1, 256).collect()
    texts = {i: enc(t) + [1] for i, t in rows}
    check(got, texts, 256)
    assert sum(p.length for p in got) == sum(len(enc(t)) + 1 for _, t in rows)
    assert packing.packing_digest(empty, tokenizer(BYTE_BPE), 1).count() == 0


def test_sequences_hold_the_pieces(edge):
    seqs = packing.sequences(edge, tokenizer(BYTE_BPE), 1, 256).collect()
    for s in seqs:
        n = sum(len(np.frombuffer(x, "<u2")) for x in s["ids"])
        assert n == s.used <= s.padded_to and (s.padded_to == 256 or s.padded_to == s.used)


@pytest.mark.parametrize("seed", range(5))
def test_patterns_hold_the_histogram(seed):
    rng = random.Random(seed)
    most = 10 ** rng.randint(2, 9)
    hist = {rng.randint(1, 512): rng.randint(most // 10, most) for _ in range(300)}
    patterns = packing.pack_histogram(hist, 512)
    back = Counter()
    for lengths, count in patterns:
        assert sum(lengths) <= 512 and count > 0
        for n in lengths:
            back[n] += count
    assert back == hist
    assert len(patterns) < 3000             # bounded by the lengths, not by the counts
    used = sum(n * c for n, c in hist.items())
    assert used / (512 * sum(c for _, c in patterns)) > 0.9
    for n, spans in packing.places(patterns).items():
        assert spans[0][0] == 0 and spans[-1][1] == hist[n] and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def check_plan(hist, max_len):
    """Each rank of each length once, its fragments in order and whole; no
    place of a sequence twice, no gap; little padding."""
    planned = packing.plan(hist, max_len)
    assert set(planned) == set(hist)
    spans = []
    for n, entries in planned.items():
        entries = sorted(entries)
        assert entries[0][0] == 0 and entries[-1][1] == hist[n] and all(a[1] == b[0] for a, b in zip(entries, entries[1:]))
        for lo, hi, fragments in entries:
            at = 0
            for sequence, offset, first, k in fragments:
                assert first == at and k > 0
                at += k
                spans.append((sequence, sequence + hi - lo, offset, k))
            assert at == n
    used = sum(n * c for n, c in hist.items())
    assert sum((hi - lo) * k for lo, hi, _, k in spans) == used
    sequences = max(hi for _, hi, _, _ in spans)
    if sequences < 5000:
        rows = [[] for _ in range(sequences)]
        for lo, hi, offset, k in spans:
            for s in range(lo, hi):
                rows[s].append((offset, k))
        for r in rows:
            at = 0
            for offset, k in sorted(r):
                assert offset == at
                at += k
            assert 0 < at <= max_len
    # a power of two isn't padded, and the last sequences may be short
    assert 1 - used / (max_len * sequences) < 0.02 or sequences <= used // max_len + 3
    return planned


@pytest.mark.parametrize("hist", [{1100: 1000}, {1100: 1000, 700: 100}, {1025: 7}, {2048: 5, 1: 1}, {1500: 10 ** 9, 1400: 10 ** 8}, {700: 10 ** 6, 690: 3},
                                  {1030: 500, 1031: 500, 5: 10}, {2047: 1000}, {1366: 300}, {1: 1}, {1200 + i: i + 1 for i in range(400)}])
def test_narrow_histograms_are_cut(hist):
    check_plan(hist, 2048)


@pytest.mark.parametrize("seed", range(8))
def test_any_histogram(seed):
    rng = random.Random(seed)
    lo = rng.randint(1, 500)
    check_plan({rng.randint(lo, 512): rng.randint(1, 10 ** rng.randint(1, 3)) for _ in range(rng.randint(1, 200))}, 512)


def test_cut_documents(spark):
    """Documents just above half a sequence: cut, each id in one piece."""
    enc = library(BYTE_BPE)
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.randint(65, 75)))) for i in range(300)]
    texts = {i: enc(t) + [1] for i, t in rows}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    longest = max(map(len, texts.values()))
    got = packing.packing_digest(df, tokenizer(BYTE_BPE), 1, 2 * longest - 40).collect()
    check(got, texts, 2 * longest - 40)
    assert any(p.length < p.doc_tokens for p in got)
    ids = sum(map(len, texts.values()))
    assert 1 - ids / ((2 * longest - 40) * (max(p.sequence_id for p in got) + 1)) < 0.02
    seqs = packing.sequences(df, tokenizer(BYTE_BPE), 1, 2 * longest - 40).collect()
    assert sum(s.used for s in seqs) == ids
