import hashlib
import random
import zlib

import pytest

from punktwerk.llm import conversation_trie as ct
from punktwerk.llm import sorted_runs

SCHEMA = "conv_id long, turn long, role string, text string, depth string, arc long, Conv long"


def md5(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def ordered(rows):
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", md5(role or "", text or ""), text or ""))
    return {c: [(r, x) for _, _, r, _, x in sorted(ts)] for c, ts in convs.items()}


def rebuild(convs):
    out = {}
    for c, ts in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - int(abs(c) % 5 * (1 if c >= 0 else -1)), [])[:h] + ts[h:]
    return out


def brute(convs):
    members = {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    kids, rows = {}, []
    for n in members:
        if n:
            kids.setdefault(n[:-1], []).append(n)
    leaves, saved = {}, {}
    for n in sorted(members, key=len, reverse=True):
        own = (len(members[n]) - 1) * len(n[-1][1].encode()) if n else 0
        leaves[n] = sum(leaves[k] for k in kids.get(n, [])) or 1
        saved[n] = own + sum(saved[k] for k in kids.get(n, []))
    for n, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(convs[c]) == len(n)))
        rows.append((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids.get(n, [])), leaves[n], saved[n],
                     hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                                               "ends_sha256").collect()), key=repr)


def random_rows(seed, convs=60, hot=True):
    rng = random.Random(seed)
    rows = []
    for c in range(-4, convs):
        for t in range(rng.randint(0, 6)):
            rows.append((c, t, rng.choice(["user", None]), rng.choice(["hi", "hé", None, ""])))
    if hot:
        rows += [(7, t, "user", f"turn {t % 3}") for t in range(300)]               # a third of all rows
        rows += [(c, 0, "user", "one first turn") for c in range(1000, 1150)]     # and one node with many members
        rows += [(c, 1, "user", f"{c}") for c in range(1000, 1150)]                 # ... and many children
    rows += [(None, 0, "user", "nobody"), (3, None, "user", "first"), (3, None, "user", "first"), (3, 2, "a", "x"), (3, 2, "a", "x"), (3, 2, "b", "w")]
    rng.shuffle(rows)
    return [(*r, "d", 1, 2) for r in rows]


@pytest.mark.parametrize("per_task", [1 << 16, 16])
def test_against_brute_force(spark, monkeypatch, per_task):
    monkeypatch.setattr(sorted_runs.sorted_parts, "__kwdefaults__", {"per_task": 50})
    rows = random_rows(1)
    convs = ordered(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(ct.rebuilt_trie(df, per_task)) == brute(rebuild(convs))


def test_conversations_as_they_are(spark):
    rows = random_rows(2, hot=False)
    assert result(ct.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute(ordered(rows))


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert result(ct.rebuilt_trie(df)) == brute(rebuild(ordered([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])))


def test_empty(spark):
    assert ct.rebuilt_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert ct.rebuilt_trie(spark.createDataFrame([(None, 1, "user", "x", None, None, None)], SCHEMA)).count() == 0


def test_pieces_of_long_member_lists(spark, monkeypatch):
    monkeypatch.setattr(sorted_runs.sorted_parts, "__kwdefaults__", {"per_task": 40})
    monkeypatch.setattr(ct, "IDS_PER_PIECE", 7)
    rows = [(c, 0, "user", "same" if c % 3 else f"own {c % 7}", None, None, None) for c in range(400)]
    assert result(ct.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute(ordered(rows))


def test_list_ranking_of_a_random_list(spark):
    """No locality at all: links jump over all ranges of arcs."""
    ids = list(range(0, 6000, 3))
    random.Random(3).shuffle(ids)
    arcs = spark.createDataFrame([(a, b, 1) for a, b in zip(ids, [*ids[1:], -1])], "arc long, succ long, hops long")
    found = {r["arc"]: r["pos"] for r in ct.positions(arcs, 400).collect()}
    assert found == {a: i for i, a in enumerate(ids)}
