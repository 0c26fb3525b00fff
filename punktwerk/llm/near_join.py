"""Jaccard join on word shingles with a count-vector R-tree.

A document's set is its distinct five-word shingles (hashed). Sets that share
a rare shingle meet: of a set of n shingles, the ``n - ceil(t n) + 1`` that
come first in one global order (rare ones first) are enough, since two sets
with Jaccard similarity t or more have one of them in common. The sets that
meet at a shingle form a list; equal lists are kept once.

Within a list nothing is paired off blindly. Shingles are hashed into groups,
and a set's counts per group are a point; the points of a list are packed
into an R-tree (by size, then by the coordinate that varies most), whose
nodes keep the largest count per coordinate. Two sets, or two nodes, can
share at most the sum of their coordinate minima; where that is less than
``t / (1 + t)`` times the summed sizes, nothing below can link. What survives
is not written as pairs: sets connected by surviving pairs form a family, one
narrow edge per set. Each family then gets every member's set once, and the
same R-tree join verifies surviving pairs by their exact intersection, as
long as their two sets are not connected already. The result is the
components of all links, exactly, with work that doesn't expand groups of
near copies into all their pairs.

Families and lists above a bounded size are joined block by block. A null or
wordless text has an empty set and no links; fewer than five words make one
shingle. Equal sets (copies) are one node. Rows that repeat a doc_id with the
same text are one node; with another text, another. Extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punktwerk.llm.common import bitmap, in_bitmap, prepare, staged, tidied, without
from punktwerk.operators.graph import connected_components

WIDTH = 5
PERCENT = 75
TOKEN_BYTES = 6                  # sets keep 48 bits of each shingle's hash
CELLS_LOG2 = 20                  # cells of the document-frequency counts: 4 MB at any input size
POSTINGS_PER_BUCKET = 1_500_000
BLOCK_BYTES = 32_000_000         # bytes of the packed rows of one side of a block, about
LIST_ROW_BYTES = 600             # a list's row, with its vector, in a task
LEAF, FANOUT = 64, 8
FAN_IN = 32                      # partial counts that one task adds up
HOT_LOG2 = 17                    # shingles in more documents (by their cell) travel as rows, not packed


# ---- sets ------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _fold(words: list[np.ndarray]) -> np.ndarray:
    s = _mix(words[0] + np.uint64(len(words)))
    for w in words[1:]:
        s = _mix(s + w)
    return s


def shingles(texts, width: int = WIDTH) -> list[np.ndarray]:
    """The distinct shingle hashes (64 bits, sorted) of each text."""
    words = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    flat = np.fromiter((h for ws in words for h in map(xxhash.xxh3_64_intdigest, ws)), np.uint64, sum(map(len, words)))
    whole = _fold([flat[i:len(flat) - width + 1 + i] for i in range(width)]) if len(flat) >= width else flat[:0]
    out, at = [], 0
    for ws in words:
        n = len(ws)
        if n >= width:
            out.append(np.unique(whole[at:at + n - width + 1]))
        elif n:
            out.append(_fold([flat[at + i:at + i + 1] for i in range(n)]))
        else:
            out.append(flat[:0])
        at += n
    return out


def pack_tokens(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES].tobytes()


def pack48(hashes: np.ndarray) -> bytes:
    return pack_tokens(np.unique(hashes >> np.uint64(16)))


def unpack48(b) -> np.ndarray:
    raw = np.frombuffer(b, np.uint8).reshape(-1, TOKEN_BYTES)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :TOKEN_BYTES] = raw
    return out.view("<u8").reshape(-1)


def group_bits(n: int) -> int:
    """log2 of the groups: about one shingle a group, 16 to 8,192 groups."""
    return min(13, max(4, (int(n) - 1).bit_length()))


MOST = 3      # counts are cut at this


def count_vector(tokens: np.ndarray) -> np.ndarray:
    """Counts per group, cut at three; the set's size tells how much was cut
    off in all. The group is the top bits of the hash, so a vector folds to
    fewer groups by adding neighbours (and cutting again)."""
    bits = group_bits(len(tokens))
    c = np.bincount((tokens >> np.uint64(48 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(c, MOST).astype(np.uint8)


def pack_vector(v: np.ndarray) -> bytes:
    """Two bits per count."""
    return (v[0::4] | (v[1::4] << 2) | (v[2::4] << 4) | (v[3::4] << 6)).tobytes()


def unpack_vector(b) -> np.ndarray:
    raw = np.frombuffer(b, np.uint8)
    return np.stack([(raw >> k) & 3 for k in (0, 2, 4, 6)], axis=1).reshape(-1)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n, node (hash of the whole set; null if empty),
    tokens. Two different sets get one node with probability 2^-64 a pair."""
    @tidied
    def run(batches):
        for b in batches:
            sets = shingles(b.column(1).to_pylist())
            packed = [pack48(s) for s in sets]
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(2), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64)) if len(s) else None
                          for s in sets], pa.int64()),
                pa.array(packed, pa.binary())], ["doc_id", "text_hash", "n", "node", "tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        run, "doc_id long, text_hash long, n long, node long, tokens binary")


def selected(sets: DataFrame, keys: DataFrame, payload) -> DataFrame:
    """(node, n, payload) of the sets whose node may be among ``keys``, once
    per node. A bitmap of fixed size filters before the shuffle, so sets that
    meet nobody stay where they are; an exact join has to follow."""
    shared = sets.sparkSession.sparkContext.broadcast(bitmap(keys, "node"))

    @tidied
    def run(batches):
        seen = set()
        for b in batches:
            node = b.column(0).to_numpy(zero_copy_only=False)
            rows = []
            for i in np.flatnonzero(in_bitmap(node, shared.value)):
                if int(node[i]) not in seen:
                    seen.add(int(node[i]))
                    rows.append(i)
            tokens = [unpack48(b.column(1)[int(i)].as_py()) for i in rows]
            yield pa.RecordBatch.from_arrays([
                pa.array(node[rows], pa.int64()), pa.array([len(t) for t in tokens], pa.int64()),
                pa.array([payload(t) for t in tokens], pa.binary())], ["node", "n", "payload"])

    return sets.filter("node is not null").select("node", "tokens").mapInArrow(
        run, "node long, n long, payload binary").dropDuplicates(["node"])


# ---- global order, postings, lists -----------------------------------------

def frequency_classes(sets: DataFrame) -> tuple[np.ndarray, int]:
    """log2 of the document frequency per hash cell, over all sets, and the
    number of shingles. A core of the cluster makes a few partial counts,
    however many partitions there are, and they are added up in rounds of
    ``FAN_IN``; the driver gets a table of fixed size."""
    sc = sets.sparkSession.sparkContext
    sets = sets.coalesce(4 * sc.defaultParallelism)
    cells, block = 1 << CELLS_LOG2, 1 << (CELLS_LOG2 - 6)

    @tidied
    def count(batches):
        c = np.zeros(cells, np.int64)
        for b in batches:
            rows = [unpack48(x) for x in b.column(0).to_pylist() if x]
            if rows:
                c += np.bincount((np.concatenate(rows) >> np.uint64(48 - CELLS_LOG2)).astype(np.int64), minlength=cells)
        yield pa.RecordBatch.from_arrays([pa.array(range(64), pa.int32()), pa.array([TaskContext.get().partitionId()] * 64, pa.int32()), pa.array(
            [c[i * block:(i + 1) * block].astype("<i8").tobytes() for i in range(64)], pa.binary())], ["block", "part", "counts"])

    def some(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, "<i8") for x in pdf["counts"])
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "part": pdf["part"].iloc[:1] // FAN_IN, "counts": [total.astype("<i8").tobytes()]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, "<i8") for x in pdf["counts"])
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "total": [int(total.sum())],
                             "classes": [np.ceil(np.log2(total + 1)).astype(np.uint8).tobytes()]})

    partial, parts = sets.select("tokens").mapInArrow(count, "block int, part int, counts binary"), 4 * sc.defaultParallelism
    while parts > FAN_IN:
        partial = partial.groupBy("block", F.expr(f"part div {FAN_IN}")).applyInPandas(some, "block int, part int, counts binary")
        parts = -(-parts // FAN_IN)
    got = partial.groupBy("block").applyInPandas(add, "block int, total long, classes binary").collect()
    classes = np.zeros(cells, np.uint8)
    for r in got:
        classes[r["block"] * block:(r["block"] + 1) * block] = np.frombuffer(r["classes"], np.uint8)
    return classes, sum(r["total"] for r in got)


EARLY = np.uint64(1 << 63)
_TOKEN = np.uint64((1 << 48) - 1)


def prefix(tokens: np.ndarray, classes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The shingles of a set that come first in the global order. Of two
    linked sets, the smaller one has the shared shingle among its first
    ``n - ceil(2t / (1 + t) n) + 1``; those are marked EARLY."""
    n = len(tokens)
    p, early = n + (-percent * n // 100) + 1, n + (-2 * percent * n // (100 + percent)) + 1
    key = (classes[(tokens >> np.uint64(48 - CELLS_LOG2)).astype(np.int64)].astype(np.uint64) << np.uint64(48)) | tokens
    first = np.partition(key, [early - 1, p - 1])[:p] & _TOKEN
    first[:early] |= EARLY
    return first


def lists_of(tokens: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(list_id, node) rows of the distinct lists of two or more nodes that
    share a token, one of them early. A list's id is a hash of its members."""
    marked = np.unique(tokens[tokens >= EARLY] & _TOKEN)
    tokens = tokens & _TOKEN
    keep = np.isin(tokens, marked)
    tokens, nodes = tokens[keep], nodes[keep]
    order = np.lexsort((nodes, tokens))
    t, v = tokens[order], nodes[order]
    fresh = np.ones(len(t), bool)
    fresh[1:] = (t[1:] != t[:-1]) | (v[1:] != v[:-1])
    t, v = t[fresh], v[fresh]
    start = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]])) if len(t) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(t)))
    ids = np.add.reduceat(_mix(v.view(np.uint64)), start) if len(t) else np.zeros(0, np.uint64)
    ids = _mix(ids + size.astype(np.uint64))
    many = np.flatnonzero(size > 1)
    _, first = np.unique(ids[many], return_index=True)
    keep = many[first]
    rows = np.repeat(start[keep] - np.concatenate([[0], np.cumsum(size[keep])[:-1]]), size[keep]) + np.arange(size[keep].sum()) \
        if len(keep) else np.zeros(0, np.int64)
    return np.repeat(ids[keep], size[keep]).view(np.int64), v[rows]


def candidate_lists(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(list_id, node): the distinct lists of sets that share a prefix
    shingle. Postings travel packed, a few rows per task and bucket; those of
    shingles that very many sets may share travel as rows, so that no task has
    to hold the sets of one shingle."""
    classes, total = frequency_classes(sets)
    shared = sets.sparkSession.sparkContext.broadcast(classes)      # 1 MB at any input size
    buckets = max(64, -(-total * (100 - percent) // 100 // POSTINGS_PER_BUCKET))

    @tidied
    def post(batches):
        seen, held, waiting = set(), [], 0

        def flush():
            t = np.concatenate([x for x, _ in held])
            v = np.repeat(np.array([n for _, n in held], np.int64), [len(x) for x, _ in held])
            b = ((t & _TOKEN) % np.uint64(buckets)).astype(np.int64)
            b[shared.value[((t & _TOKEN) >> np.uint64(48 - CELLS_LOG2)).astype(np.int64)] > HOT_LOG2] = -1
            order = np.argsort(b, kind="stable")
            t, v, b = t[order], v[order], b[order]
            at = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
            return pa.RecordBatch.from_arrays([
                pa.array(b[at]), pa.array([x.astype("<u8").tobytes() for x in np.split(t, at[1:])], pa.binary()),
                pa.array([x.astype("<i8").tobytes() for x in np.split(v, at[1:])], pa.binary())], ["bucket", "t", "v"])

        for b in batches:
            for node, tok in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if node is None or node in seen:
                    continue
                seen.add(node)
                held.append((prefix(unpack48(tok), shared.value, percent), node))
                waiting += len(held[-1][0])
            if waiting >= 400_000:
                yield flush()
                held, waiting = [], 0
        if held:
            yield flush()

    def collect(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, v = lists_of(np.concatenate([np.frombuffer(x, "<u8") for x in pdf["t"]]),
                          np.concatenate([np.frombuffer(x, "<i8") for x in pdf["v"]]))
        return pd.DataFrame({"list_id": ids, "node": v})

    postings = sets.select("node", "tokens").mapInArrow(post, "bucket long, t binary, v binary")
    if not (classes > HOT_LOG2).any():
        return postings.groupBy("bucket").applyInPandas(collect, "list_id long, node long").dropDuplicates()
    postings = staged(postings, "postings")
    packed = postings.filter("bucket >= 0").groupBy("bucket").applyInPandas(collect, "list_id long, node long").dropDuplicates()
    return packed.unionByName(hot_lists(postings.filter("bucket < 0")))


def hot_lists(postings: DataFrame) -> DataFrame:
    """The lists of ``lists_of`` from packed postings, found by aggregates
    over rows (shingle, node): a list's id comes from the XOR of its nodes'
    hashes, and of the shingles with one list the smallest gives its members."""
    @tidied
    def rows(batches):
        for b in batches:
            for t, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                t = np.frombuffer(t, "<u8")
                yield pa.RecordBatch.from_arrays([pa.array((t & _TOKEN).astype(np.int64)), pa.array(t >= EARLY), pa.array(np.frombuffer(v, "<i8"))],
                                                 ["token", "early", "node"])

    each = staged(postings.select("t", "v").mapInArrow(rows, "token long, early boolean, node long").groupBy("token", "node")
                  .agg(F.max("early").alias("early")), "hot_postings")
    heads = each.groupBy("token").agg(F.expr("bit_xor(xxhash64(node))").alias("x"), F.count("*").alias("n"), F.max("early").alias("early"))
    chosen = staged(heads.filter("n > 1 and early").groupBy(F.xxhash64("x", "n").alias("list_id")).agg(F.min("token").alias("token")), "hot_lists")
    return each.join(chosen, "token").select("list_id", "node")


# ---- the R-tree ------------------------------------------------------------

class Links:
    """Union-find over the rows of one group; remembers the unions made."""

    def __init__(self, n: int):
        self.parent = list(range(n))
        self.made: list[tuple[int, int]] = []

    def find(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def union(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.made.append((i, j))


def required(a, b, percent: int):
    """Least intersection of linked sets of sizes a and b."""
    return -(-percent * (a + b) // (100 + percent))


class CountRTree:
    """Points (count vectors) of one group, packed bottom-up. What was cut off
    the counts joins the bound as a whole: two sets share at most the sum of
    coordinate minima and the smaller of their excesses."""

    def __init__(self, sizes: np.ndarray, vectors: list[np.ndarray], percent: int = PERCENT):
        self.sizes, self.vectors, self.percent = sizes.astype(np.int64), vectors, percent
        self._cache: dict = {}
        order = np.argsort(self.sizes, kind="stable")
        leaves, at = [], 0
        while at < len(order):      # slabs of sizes that can link, then by the coordinate that varies most
            most = 100 * self.sizes[order[at]] // percent
            end = min(at + LEAF * FANOUT, int(np.searchsorted(self.sizes[order], most, side="right")))
            slab = order[at:end]
            if len(slab) > LEAF:
                m = self._cut(slab, min(6, self._bits(slab)))[0]
                slab = slab[np.argsort(m[:, m.astype(np.float32).var(axis=0).argmax()], kind="stable")]
            leaves += [slab[j:j + LEAF] for j in range(0, len(slab), LEAF)]
            at = end
        level = [(s, None) for s in leaves]
        while len(level) > 1:
            level = [(np.concatenate([r for r, _ in level[i:i + FANOUT]]), level[i:i + FANOUT])
                     for i in range(0, len(level), FANOUT)]
        self.root = level[0] if level else None

    def _bits(self, rows) -> int:
        return group_bits(int(self.sizes[rows].min()))

    def _cut(self, rows, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Vectors folded to ``bits`` and cut, and the excess of each row."""
        m = np.stack([np.minimum(self.vectors[r].reshape(1 << bits, -1).sum(axis=1, dtype=np.uint16), MOST) for r in rows]).astype(np.uint8)
        return m, self.sizes[rows] - m.sum(axis=1, dtype=np.int64)

    def _leaf(self, node, bits: int) -> tuple[np.ndarray, np.ndarray]:
        key = (id(node[0]), bits)
        if key not in self._cache:
            if len(self._cache) > 64:
                self._cache.clear()
            self._cache[key] = self._cut(node[0], bits)
        return self._cache[key]

    def _most(self, node, bits: int) -> tuple[np.ndarray, int]:
        """The largest count per coordinate, and the largest excess, below a node."""
        key = ("max", id(node[0]), bits)
        if key not in self._cache:
            if node[1] is None:
                m, e = self._leaf(node, bits)
                self._cache[key] = m.max(axis=0), int(e.max())
            else:
                below = [self._most(c, bits) for c in node[1]]
                self._cache[key] = np.max([m for m, _ in below], axis=0), max(e for _, e in below)
        return self._cache[key]

    def join(self, links: Links, check) -> None:
        """Calls ``check(i, j)`` for the pairs that the bound can't exclude and
        ``links`` doesn't connect yet, and unites those it accepts."""
        if self.root is not None:
            self._visit(self.root, self.root, links, check)

    def _visit(self, a, b, links, check) -> None:
        sa, sb = self.sizes[a[0]], self.sizes[b[0]]
        if 100 * sa.max() < self.percent * sb.min() or 100 * sb.max() < self.percent * sa.min():
            return
        if a is not b or a[1] is None:
            roots = {links.find(i) for i in a[0]}
            if len(roots) == 1 and {links.find(i) for i in b[0]} == roots:
                return
        bits = min(self._bits(a[0]), self._bits(b[0]))
        if a is not b:
            (ma, ea), (mb, eb) = self._most(a, bits), self._most(b, bits)
            if int(np.minimum(ma, mb).sum(dtype=np.int64)) + min(ea, eb) < required(int(sa.min()), int(sb.min()), self.percent):
                return
        if a[1] is None and b[1] is None:
            self._pairs(a, b, bits, links, check)
        elif a is b:
            for i, x in enumerate(a[1]):
                for y in a[1][:i + 1]:
                    self._visit(x, y, links, check)
        elif b[1] is None or (a[1] is not None and len(a[0]) >= len(b[0])):
            for x in a[1]:
                self._visit(x, b, links, check)
        else:
            for y in b[1]:
                self._visit(a, y, links, check)

    def _pairs(self, a, b, bits, links, check) -> None:
        ra, rb = a[0], b[0]
        (ma, ea), (mb, eb) = self._leaf(a, bits), self._leaf(b, bits)
        bound = np.stack([np.minimum(v, mb).sum(axis=1, dtype=np.int64) for v in ma]) + np.minimum(ea[:, None], eb[None, :])
        total = self.sizes[ra][:, None] + self.sizes[rb][None, :]
        ok = bound >= required(total, 0, self.percent)
        if a is b:
            ok = np.triu(ok, 1)
        hits = np.argwhere(ok)
        if len(hits) > 1:       # likeliest first: fewer verifications before all are connected
            hits = hits[np.argsort(-(bound[ok] / total[ok]), kind="stable")]
        for i, j in hits:
            x, y = int(ra[i]), int(rb[j])
            if links.find(x) != links.find(y) and check(x, y):
                links.union(x, y)


# ---- groups of bounded size -------------------------------------------------

def blocks(rows: DataFrame) -> DataFrame:
    """Adds ``_bi``/``_bj``: a group of ``_nb`` > 1 blocks is cut by node, and
    its rows are repeated once for each pair of blocks."""
    own = F.pmod(F.xxhash64("node"), F.col("_nb")).cast("int")
    return (rows.withColumn("_own", own).withColumn("_o", F.explode(F.expr("sequence(0, _nb - 1)")))
            .withColumn("_bi", F.least("_own", "_o")).withColumn("_bj", F.greatest("_own", "_o")).drop("_nb", "_own", "_o"))


def with_blocks(members: DataFrame, key: str, weight) -> DataFrame:
    """(key, node, _nb): how many blocks each group needs. Groups of several
    blocks are few; their table is written first, so its size is known and
    the members are shuffled only where it is too large to broadcast."""
    total = members.groupBy(F.col(key).alias("_k")).agg(F.ceil(F.sum(weight) / BLOCK_BYTES).cast("int").alias("_nb"))
    big = staged(total.filter("_nb > 1").repartition(1), "big_groups")
    if big.isEmpty():
        return members.select(key, "node", F.lit(1).alias("_nb"))
    return members.join(big, F.col(key) == F.col("_k"), "left").select(key, "node", F.coalesce("_nb", F.lit(1)).alias("_nb"))


def _groups(batches, keys: int):
    """The rows of each run of equal keys (the first columns), from sorted batches."""
    held, last = [], None
    for b in batches:
        cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        n = b.num_rows
        if not n:
            continue
        change = np.zeros(n - 1, bool)
        for c in cols:
            change |= c[1:] != c[:-1]
        at = [0, *(np.flatnonzero(change) + 1).tolist(), n]
        for lo, hi in zip(at[:-1], at[1:]):
            k = tuple(int(c[lo]) for c in cols)
            if last is not None and k != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(lo, hi - lo))
            last = k
    if held:
        yield pa.Table.from_batches(held)


def _joined(rows: DataFrame, key: str, solve) -> DataFrame:
    """(src, dst) edges that ``solve(sizes, payloads) -> Links`` makes in each
    group (and block pair) of ``rows`` (key, node, _nb, n, payload)."""
    @tidied
    def run(batches):
        for g in _groups(batches, 3):
            if g.num_rows < 2:
                continue
            node = g.column("node").to_numpy()
            made = solve(g.column("n").to_numpy(), g.column("payload").to_pylist()).made
            if made:
                e = np.array(made, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(node[e[:, 0]]), pa.array(node[e[:, 1]])], ["src", "dst"])

    keyed = blocks(rows).select(key, "_bi", "_bj", "node", "n", "payload")
    edges = keyed.repartition(key, "_bi", "_bj").sortWithinPartitions(key, "_bi", "_bj").mapInArrow(run, "src long, dst long")
    return edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()


def candidate_edges(members: DataFrame, points: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Edges that connect, in each list, all sets whose bounds let them link."""
    def solve(sizes, vecs):
        links = Links(len(sizes))
        CountRTree(sizes, [unpack_vector(v) for v in vecs], percent).join(links, lambda i, j: True)
        return links

    return _joined(members.join(points, "node"), "list_id", solve)


def link_edges(families: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Edges that connect, in each family, all sets that are linked by
    verified pairs."""
    def solve(sizes, packed):
        tokens = [unpack48(p) for p in packed]
        links = Links(len(tokens))

        def linked(i, j):
            both = len(np.intersect1d(tokens[i], tokens[j], assume_unique=True))
            return (100 + percent) * both >= percent * (len(tokens[i]) + len(tokens[j]))

        CountRTree(sizes, [count_vector(t) for t in tokens], percent).join(links, linked)
        return links

    return _joined(families.join(sets, "node"), "family", solve)


SALTS = 16


def components(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """The sets, and (_node, least): for each node the smallest row of its
    component, a struct (doc_id is null, doc_id, text_hash)."""
    prepare(docs.sparkSession)
    sets = staged(shingle_sets(docs), "shingle_sets")
    members = staged(candidate_lists(sets, percent), "candidate_lists")
    points = selected(sets, members, lambda t: pack_vector(count_vector(t)))
    edges = staged(candidate_edges(with_blocks(members, "list_id", F.lit(LIST_ROW_BYTES)), points, percent), "candidate_edges")
    families = staged(connected_components(edges).select("node", F.col("component").alias("family")), "families")
    sizes = sets.filter("node is not null").select("node", (F.length("tokens") + 100).alias("_w")).dropDuplicates(["node"])
    cut = staged(with_blocks(families.join(sizes, "node"), "family", "_w"), "family_blocks")
    links = staged(link_edges(cut, selected(sets, families, pack_tokens), percent), "link_edges")
    roots = staged(connected_components(links).select("node", F.col("component").alias("root")), "link_roots")
    least = staged(sets.filter("node is not null").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("least")), "least_rows")
    # a large component's nodes are dealt over the salts of its one row
    linked = least.join(roots, "node")
    top = linked.groupBy("root").agg(F.min("least").alias("top")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = linked.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(top, ["root", "salt"])
    alone = least.join(roots, "node", "left_anti")
    return sets, staged(joined.select(F.col("node").alias("_node"), F.col("top").alias("least")).unionByName(
        alone.select(F.col("node").alias("_node"), "least")), "near_components")


def near_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    sets, of_node = components(docs, percent)
    return sets.select("doc_id", F.col("n").alias("n_shingles"), "node").join(of_node, F.col("node") == F.col("_node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("least.doc_id", "doc_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each component stays, with its own columns: the one with
    the smallest doc_id (null ids last), of several texts with that id the one
    with the smallest hash, of equal rows any. Rows that share an id but not
    their text are told apart; a text without words stays."""
    sets, of_node = components(docs, percent)
    rows = sets.join(of_node, F.col("node") == F.col("_node"))
    kept = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))
    keys = {"doc_id": F.col("doc_id").cast("long"), "text_hash": F.xxhash64("text")}
    left = without(docs, rows.filter(~kept).select("doc_id", "text_hash").distinct(), keys)
    repeated = staged(rows.filter(kept).groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).filter("n > 1")
                      .select("doc_id", "text_hash"), "equal_rows")
    if repeated.isEmpty():
        return left
    # equal rows: all of them go, then one of each comes back
    held = docs.select(F.struct("*").alias("_doc"), F.struct(*[c.alias(k) for k, c in keys.items()]).alias("_row"))
    once = held.join(repeated.select(F.struct("doc_id", "text_hash").alias("_kept")), F.col("_row").eqNullSafe(F.col("_kept")), "left_semi")
    return without(left, repeated, keys).unionByName(once.dropDuplicates(["_row"]).select("_doc.*").select(*left.columns))
