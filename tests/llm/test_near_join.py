import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from punktwerk.llm import near_join
from punktwerk.llm.queries import QUERIES
from tests.llm.conftest import SF, edge_rows


def sets_of(rows):
    out = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        out.append((i, {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())))
    return out


def brute(rows, percent=75):
    s = sets_of(rows)
    parent = list(range(len(s)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    holders = defaultdict(list)
    for i, (_, x) in enumerate(s):
        for g in x:
            holders[g].append(i)
    for i, (_, x) in enumerate(s):
        for j, n in Counter(j for g in x for j in holders[g] if j < i).items():
            if 100 * n >= percent * (len(x) + len(s[j][1]) - n):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, x) in enumerate(s):
        if d is not None:
            r = find(i)
            least[r] = min(d, least.get(r, d))
    return Counter((d, len(x), least.get(find(i)) if x else d) for i, (d, x) in enumerate(s))


def found(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_edge_cases(edge):
    assert found(near_join.near_groups(edge)) == brute([(r[0], r[1]) for r in edge_rows()])


def test_whole_table(spark, sf_docs):
    assert found(QUERIES["op8_near_join"](spark, SF)) == brute(list(sf_docs[["doc_id", "text"]].itertuples(index=False)))


def family(seed, copies, words=80, changes=(0, 6)):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(words)]
    rows = []
    for i in range(copies):
        w = list(base)
        for _ in range(rng.randint(*changes)):
            w[rng.randrange(words)] = f"x{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_around_the_threshold(spark, seed):
    """Many similar texts, so that a good share of the pairs is close to 0.75."""
    rows = family(seed, 150) + [(1000 + i, t) for i, t in family(seed + 50, 20, 12, (0, 2))]
    assert found(near_join.near_groups(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_blocks_of_large_groups(spark, monkeypatch):
    rows = family(9, 200)
    monkeypatch.setattr(near_join, "BLOCK_BYTES", 20_000)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(near_join.near_groups(df)) == brute(rows)


def test_empty(spark, empty):
    assert near_join.near_groups(empty).count() == 0
    alone = spark.createDataFrame([(1, None), (2, ""), (3, "a b c d e f g")], "doc_id long, text string")
    assert found(near_join.near_groups(alone)) == Counter([(1, 0, 1), (2, 0, 2), (3, 3, 3)])


def test_hot_shingles_travel_as_rows(spark, monkeypatch):
    """With a low limit, nearly all shingles count as hot; the groups stay.
    The limit is read where the sets are, so it is set before they are made."""
    rows = family(9, 120) + [(1000 + i, f"own words of number {i} and some more of {i * i} here") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = near_join.shingle_sets(df)
    classes, _ = near_join.frequency_classes(sets)
    hot = near_join.staged(sets, "sets")

    def pairs(members):
        by = {}
        for r in members.collect():
            by.setdefault(r.list_id, set()).add(r.node)
        return {frozenset(v) for v in by.values()}

    want = pairs(near_join.candidate_lists(hot))
    import pyarrow as pa

    def packed(batches):
        for b in batches:
            for node, tok in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if node is not None:
                    t = near_join.prefix(near_join.unpack48(tok), classes)
                    yield pa.RecordBatch.from_arrays([pa.array([t.astype("<u8").tobytes()], pa.binary()),
                                                      pa.array([np.full(len(t), node, "<i8").tobytes()], pa.binary())], ["t", "v"])

    postings = hot.select("node", "tokens").mapInArrow(packed, "t binary, v binary")
    assert pairs(near_join.hot_lists(postings)) == want and len(want) > 3


def test_drop_near_copies(edge):
    out = near_join.drop_near_copies(edge)
    assert out.columns == edge.columns
    want = {c for d, n, c in brute([(r[0], r[1]) for r in edge_rows()])}
    assert {r.doc_id for r in out.collect()} == want


def test_rows_that_share_an_id(spark):
    """Repeated and null ids: rows go, not ids."""
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    near = base + " more"
    rows = [(1, "alone here is a text of its own words"), (1, base), (2, near), (None, base.upper()), (None, "quite another text with no copy"),
            (None, "quite another text with no copy"), (5, "some five words and more"), (5, "some five words and more"), (5, None), (5, None), (None, "")]
    out = [tuple(r) for r in near_join.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()]
    want = [(1, rows[0][1]), (1, base), (None, rows[4][1]), (5, rows[6][1]), (5, None), (5, None), (None, "")]
    assert sorted(map(repr, out)) == sorted(map(repr, want))


def test_bound_never_excludes_a_link():
    """Whatever the tree skips has too small an intersection."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**48, 300).astype(np.uint64)
    sets = []
    for _ in range(160):
        keep = rng.random(300) < rng.uniform(0.6, 1.0)
        sets.append(np.unique(np.concatenate([base[keep], rng.integers(0, 2**48, rng.integers(0, 60)).astype(np.uint64)])))
    seen = set()
    tree = near_join.CountRTree(np.array([len(s) for s in sets]), [near_join.count_vector(s) for s in sets])
    tree.join(near_join.Links(len(sets)), lambda i, j: seen.add((min(i, j), max(i, j))) and False)
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 175 * both >= 75 * (len(sets[i]) + len(sets[j])):
                assert (j, i) in seen


def test_pack48_round_trip():
    h = np.unique(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64))
    assert (near_join.unpack48(near_join.pack48(h)) == np.unique(h >> np.uint64(16))).all()
