"""Prefix trie of conversations, measured along an Euler tour.

Conversations that begin with the same turns share the nodes of those turns.
The trie is never walked: its Euler tour has an enter and an exit arc per
node, each with a link to the next arc, and the position of every arc is
found by ranking that list on the cluster. A node's subtree is the stretch
between its two arcs, so leaves and savings of subtrees are differences of
prefix sums over the positions.

1. Turns are numbered by a sort over range partitions (no group by
   conversation, so one conversation may hold any share of the rows).
2. A prefix of d turns is named by the XOR of one 128-bit hash for each
   (position, role, text), a running value of a second sorted scan. Two
   different prefixes get one name with probability 2^-128 a pair.
3. Nodes are groups of equal names, combined before the shuffle.
4. Parents followed by their children in the order of the smallest member:
   one more sorted scan gives first children, next siblings and parents, also
   where the children of one parent fill many partitions.
5. List ranking: each task contracts the links inside its range of arcs;
   while more than one range is left, random mates across ranges are
   contracted too (an arc with heads takes over a successor with tails).
   Then the levels are undone in reverse, each arc adding its offset to the
   position of the arc that took it over.

Defined cases: a row without conv_id belongs to no conversation; null role or
text is empty text; a null turn comes first; equal turns of a conversation
are ordered by role, then by the MD5 of role and text, so repeated rows are
turns of their own. A table without conversations has no nodes. Extra
columns are ignored."""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from punktwerk.llm.common import prepare, staged, text_crc
from punktwerk.llm.sorted_runs import carried, column, over_parts, run_starts, sorted_parts

#: Arcs that one task contracts at a time.
ARCS_PER_TASK = 1 << 16
#: Positions per block of the prefix sums.
BLOCK = 4096
#: Ids that are joined to one piece of text for the digest of a node's members.
IDS_PER_PIECE = 1 << 15

TURN = "part int, conv long, at long, hi long, lo long, bytes long"
PREFIX = "part int, conv long, depth long, at long, total long, bytes long, hi long, lo long, own_hi long, own_lo long"
TREE = ("part int, edge boolean, depth long, hi long, lo long, child boolean, nid long, conv long, value long, "
        "parent long, parent_conv long, next long")


def _batch(schema: str, values: list) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[k], from_pandas=False) for v, (_, k) in zip(values, fields)],
                                      [n for n, _ in fields])


# --- turns ---------------------------------------------------------------

def _number_turns(batches, part):
    last, held = None, 0
    for b in batches:
        conv = column(b, "conv")
        at = np.arange(len(conv)) - run_starts(conv)
        if conv[0] == last:
            at[conv == last] += held
        last, held = conv[-1], int(at[-1]) + 1
        digest = np.frombuffer(bytes.fromhex("".join(b.column(b.schema.get_field_index("digest")).to_pylist())), ">u8").reshape(-1, 2)
        yield _batch(TURN, [np.full(len(conv), part, np.int32), conv, at, digest[:, 0].astype(np.uint64).view(np.int64),
                            digest[:, 1].astype(np.uint64).view(np.int64), column(b, "bytes")])


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv, pos (from 0), hi, lo (digest of role and text), bytes of every
    turn of a conversation, as a stored table."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"), role.alias("role"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"))
    n = conversations.select("conv_id").count()
    turns = staged(sorted_parts(rows, n, "conv", "turn", "role", "digest").select("conv", "digest", "bytes")
                   .mapInArrow(over_parts(_number_turns), TURN), "turns")
    before = carried(turns, "conv", ["at"], lambda a, b: (a[0] + b[0] + 1,))
    return (turns.join(F.broadcast(before), (F.col("part") == F.col("_part")) & (F.col("conv") == F.col("_key")), "left")
            .select("conv", (F.col("at") + F.coalesce(F.col("_at") + 1, F.lit(0))).alias("pos"), "hi", "lo", "bytes"))


def lengths_of(turns: DataFrame) -> DataFrame:
    """conv, total: the turns of each conversation."""
    return turns.groupBy("conv").agg((F.max("pos") + 1).alias("total"))


def rebuilt(turns: DataFrame, family: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """The conversations that the digest query asks for: conversation c takes
    its first h turns from c - c % family, h = crc32(c) % heads. Returns
    (conv, total) and (conv, depth, total, hi, lo, bytes)."""
    lengths = lengths_of(turns)
    base = lengths.filter(f"conv % {family} = 0").select(F.col("conv").alias("base"), F.col("total").alias("base_total"))
    convs = staged(lengths.withColumn("base", F.expr(f"conv - conv % {family}")).withColumn("h", text_crc("conv") % heads)
                   .join(base, "base", "left").withColumn("head", F.least("h", F.coalesce("base_total", F.lit(0))))
                   .select("conv", "base", "h", "head", (F.col("head") + F.greatest(F.col("total") - F.col("h"), F.lit(0))).alias("total")),
                   "conversations")
    own = (turns.join(convs, "conv").filter("pos >= h")
           .select("conv", (F.col("head") + F.col("pos") - F.col("h") + 1).alias("depth"), "total", "hi", "lo", "bytes"))
    first = turns.filter(f"conv % {family} = 0 and pos < {heads - 1}").withColumnRenamed("conv", "base")
    taken = (first.join(convs, "base").filter("pos < head")
             .select("conv", (F.col("pos") + 1).alias("depth"), "total", "hi", "lo", "bytes"))
    return convs.select("conv", "total"), own.unionByName(taken)


# --- names of prefixes and nodes -----------------------------------------

_GOLD, _M1, _M2 = (np.uint64(v) for v in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def turn_hash(depth: np.ndarray, hi: np.ndarray, lo: np.ndarray):
    """Two 64-bit hashes of (position, digest of the turn)."""
    d, a, b = depth.astype(np.uint64) * _GOLD, hi.view(np.uint64), lo.view(np.uint64)
    x = _mix(a + d)
    y = _mix(b ^ _mix(x + d))
    return _mix(x ^ (y * _GOLD)).view(np.int64), y.view(np.int64)


def _name_prefixes(batches, part):
    last, before = None, (0, 0)
    for b in batches:
        conv, depth = column(b, "conv"), column(b, "depth")
        start = run_starts(conv)
        own = turn_hash(depth, column(b, "hi").copy(), column(b, "lo").copy())
        names = []
        for g, had in zip(own, before):
            run = np.bitwise_xor.accumulate(g)
            name = run ^ np.where(start > 0, run[start - 1], 0)
            if conv[0] == last:
                name[conv == last] ^= had
            names.append(name)
        last, before = conv[-1], (names[0][-1], names[1][-1])
        yield _batch(PREFIX, [np.full(len(conv), part, np.int32), conv, depth, depth, column(b, "total"), column(b, "bytes"), *names, *own])


def prefixes(turns: DataFrame) -> DataFrame:
    """Each prefix of each conversation: conv, depth, total, bytes, its name
    (hi, lo) and the name of the prefix before it (up_hi, up_lo)."""
    turns = staged(turns, "rebuilt")
    rows = staged(sorted_parts(turns, turns.count(), "conv", "depth").mapInArrow(over_parts(_name_prefixes), PREFIX), "prefixes")
    before = carried(rows, "conv", ["hi", "lo"], lambda a, b: (a[0] ^ b[0], a[1] ^ b[1]))
    rows = rows.join(F.broadcast(before), (F.col("part") == F.col("_part")) & (F.col("conv") == F.col("_key")), "left")
    for c in ("hi", "lo"):
        rows = rows.withColumn(c, F.col(c).bitwiseXOR(F.coalesce(f"_{c}", F.lit(0))))
    return rows.select("conv", "depth", "total", "bytes", "hi", "lo", F.col("hi").bitwiseXOR(F.col("own_hi")).alias("up_hi"),
                       F.col("lo").bitwiseXOR(F.col("own_lo")).alias("up_lo"))


def nodes(convs: DataFrame, prefix: DataFrame) -> DataFrame:
    """One row per node, numbered along (smallest member, depth): nid, conv,
    depth, hi, lo, up_hi, up_lo, n_convs, saved (of the node itself)."""
    inner = prefix.groupBy("depth", "hi", "lo").agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"),
        F.max("up_hi").alias("up_hi"), F.max("up_lo").alias("up_lo"))
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(c) for c in ("hi", "lo", "bytes", "up_hi", "up_lo")], "conv", "n_convs")
    every = staged(inner.unionByName(root), "named_nodes")
    return staged(sorted_parts(every, every.count(), "conv", "depth").select(
        F.monotonically_increasing_id().alias("nid"), "conv", "depth", "hi", "lo", "up_hi", "up_lo", "n_convs",
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")), "nodes")


# --- the tree and its tour -------------------------------------------------

def _link(batches, part):
    """Rows sorted by (depth, name, child, conv): a parent, then its children.
    The last row of a batch waits for the first one of the next."""
    waiting, parent = None, (None, None, None)          # (key, nid, conv) of the last parent seen
    first = True
    for b in _with_end(batches):
        cols = None if b is None else [column(b, c) for c in ("depth", "hi", "lo", "child", "nid", "conv", "value")]
        if waiting is not None:
            cols = waiting if cols is None else [np.concatenate([a, c]) for a, c in zip(waiting, cols)]
        if cols is None:
            return
        depth, hi, lo, child, nid, conv, value = cols
        same = (depth[1:] == depth[:-1]) & (hi[1:] == hi[:-1]) & (lo[1:] == lo[:-1]) & child[1:]
        n = len(nid) if b is None else len(nid) - 1
        following = np.full(len(nid), -1, np.int64)
        following[:-1][same] = nid[1:][same]
        at = np.maximum.accumulate(np.where(~child, np.arange(len(nid)), -1))    # the last parent row so far
        known = at >= 0
        own = child & known
        up, up_conv = np.full(len(nid), -1, np.int64), np.zeros(len(nid), np.int64)
        up[own], up_conv[own] = nid[at[own]], conv[at[own]]
        early = child & ~known
        if parent[0] is not None and early.any():       # children of a parent in an earlier batch
            up[early], up_conv[early] = parent[1], parent[2]
        if n:
            edge = np.zeros(n, bool)
            edge[0] |= first
            edge[-1] |= b is None
            first = False
            yield _batch(TREE, [np.full(n, part, np.int32), edge, depth[:n], hi[:n], lo[:n], child[:n], nid[:n], conv[:n], value[:n],
                                pa.array(up[:n], mask=up[:n] < 0), pa.array(up_conv[:n], mask=up[:n] < 0),
                                pa.array(following[:n], mask=following[:n] < 0)])
        seen = at[n - 1] if n else -1
        if seen >= 0:
            parent = (True, nid[seen], conv[seen])
        waiting = [c[n:] for c in cols]


def _with_end(batches):
    yield from batches
    yield None


def linked(node: DataFrame) -> DataFrame:
    """Two rows per node (the root: one), as parent of its children and as a
    child: a parent row has ``next`` = its first child, a child row its
    parent and ``next`` = its next sibling."""
    spark = node.sparkSession
    as_parent = node.select("depth", "hi", "lo", F.lit(False).alias("child"), "nid", "conv", F.col("saved").alias("value"))
    as_child = node.filter("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo"),
                                               F.lit(True).alias("child"), "nid", "conv", F.lit(0).cast("long").alias("value"))
    rows = staged(sorted_parts(as_parent.unionByName(as_child), 2 * node.count(), "depth", "hi", "lo", "child", "conv")
                  .mapInArrow(over_parts(_link), TREE), "tree")
    parts: dict[int, list] = {}
    for r in rows.filter("edge").orderBy("part", "depth", "hi", "lo", "child", "conv").collect():
        parts.setdefault(r["part"], []).append(r)
    ups, follows, before = [], [], None      # before: (last row of the partition before, its parent)
    for p in sorted(parts):
        head, tail = parts[p][0], parts[p][-1]
        name = (head["depth"], head["hi"], head["lo"])
        goes_on = before is not None and head["child"] and name == before[0]
        if goes_on:
            ups.append((p, *before[2]))
            follows.append((before[1], before[3], head["nid"]))
        own = (tail["nid"], tail["conv"]) if not tail["child"] else (tail["parent"], tail["parent_conv"])
        if own[0] is None:
            own = before[2]
        before = ((tail["depth"], tail["hi"], tail["lo"]), tail["nid"], own, tail["child"])
    up = spark.createDataFrame(ups, "_p int, _up long, _up_conv long")
    follow = spark.createDataFrame(follows, "_nid long, _child boolean, _next long")
    return (rows.join(F.broadcast(up), (F.col("part") == F.col("_p")) & F.col("child") & F.col("parent").isNull(), "left")
            .join(F.broadcast(follow), (F.col("nid") == F.col("_nid")) & (F.col("child") == F.col("_child")), "left")
            .select("depth", "child", "nid", "conv", "value", F.coalesce("parent", "_up").alias("parent"),
                    F.coalesce("parent_conv", "_up_conv").alias("parent_conv"), F.coalesce("next", "_next").alias("next")))


def tour(tree: DataFrame) -> DataFrame:
    """arc, succ, hops: enter arc 2 * nid, exit arc 2 * nid + 1; the exit of
    the root has no successor (-1)."""
    nid, nxt = F.col("nid") * 2, F.col("next") * 2
    enter = tree.filter("not child").select(nid.alias("arc"), F.coalesce(nxt, nid + 1).alias("succ"))
    leave = tree.filter("child").select((nid + 1).alias("arc"), F.coalesce(nxt, F.col("parent") * 2 + 1).alias("succ"))
    root = tree.filter("not child and depth = 0").select((nid + 1).alias("arc"), F.lit(-1).cast("long").alias("succ"))
    return enter.unionByName(leave).unionByName(root).withColumn("hops", F.lit(1).cast("long"))


# --- list ranking ----------------------------------------------------------

_CONTRACTED = "arc long, succ long, hops long, owner long"


def contract(arc: np.ndarray, succ: np.ndarray, hops: np.ndarray):
    """The lists inside one set of arcs: for each arc the head of its list
    and the hops from there, and for each arc whether it is a head, the
    successor of its list and the length of the list."""
    order = np.argsort(arc, kind="stable")
    arc, succ, hops = arc[order], succ[order], hops[order]
    n = len(arc)
    at = np.minimum(np.searchsorted(arc, succ), n - 1)
    inside = arc[at] == succ
    jump, off = np.arange(n), np.zeros(n, np.int64)
    jump[at[inside]] = np.flatnonzero(inside)           # predecessor, heads: themselves
    off[at[inside]] = hops[inside]
    while True:
        further = jump[jump]
        if (further == jump).all():
            break
        off, jump = off + off[jump], further
    tails = np.flatnonzero(~inside)
    end, length = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    end[jump[tails]], length[jump[tails]] = succ[tails], off[tails] + hops[tails]
    return arc, arc[jump], off, jump == np.arange(n), end, length


def _contract_part(batches, part):
    held = [[column(b, c) for c in ("arc", "succ", "hops")] for b in batches]
    if not held:
        return
    arc, owner, off, head, end, length = contract(*(np.concatenate(c) for c in zip(*held)))
    yield _batch(_CONTRACTED, [arc, np.where(head, end, -1), np.where(head, length, off), pa.array(owner, mask=head)])


def positions(arcs: DataFrame, per_task: int | None = None) -> DataFrame:
    """arc, pos: the place of every arc in the list, from 0."""
    per_task = per_task or ARCS_PER_TASK
    levels, round_, rest = [], 0, staged(arcs, "arcs")
    n = rest.count()
    while True:
        parts = max(1, -(-n // per_task))
        dealt = rest.repartitionByRange(parts, "arc") if parts > 1 else rest.coalesce(1)
        level = staged(dealt.mapInArrow(over_parts(_contract_part), _CONTRACTED), "contracted")
        levels.append(level.filter("owner is not null").select("arc", "owner", F.col("hops").alias("off")))
        rest = level.filter("owner is null").select("arc", "succ", "hops")
        if parts == 1:
            break
        # random mates: heads take over a successor with tails
        coin = lambda c: F.xxhash64(F.lit(round_), c) % 2 == 0
        takes = rest.filter(coin(F.col("arc")) & (F.col("succ") >= 0) & ~coin(F.col("succ"))).select(
            F.col("succ").alias("arc"), F.col("arc").alias("owner"), F.col("hops").alias("off"))
        mates = staged(rest.join(takes, "arc"), "mates")
        levels.append(mates.select("arc", "owner", "off"))
        gained = mates.select(F.col("owner").alias("arc"), F.col("succ").alias("_succ"), F.col("hops").alias("_hops"))
        rest = staged(rest.join(mates.select("arc"), "arc", "left_anti").join(gained, "arc", "left").select(
            "arc", F.coalesce("_succ", "succ").alias("succ"), (F.col("hops") + F.coalesce("_hops", F.lit(0))).alias("hops")), "arcs")
        n, round_ = rest.count(), round_ + 1
    found = rest.select("arc", F.lit(0).cast("long").alias("pos"))
    for i, level in enumerate(reversed(levels)):
        placed = level.join(found.select(F.col("arc").alias("owner"), "pos"), "owner").select("arc", (F.col("pos") + F.col("off")).alias("pos"))
        found = staged(found.unionByName(placed), "positions") if i % 4 == 3 else found.unionByName(placed)
    return staged(found, "positions")


def subtree_sums(tree: DataFrame, pos: DataFrame, block: int = BLOCK) -> DataFrame:
    """nid, n_leaves, saved_tokens from prefix sums at the positions of the
    arcs: inside blocks of positions, then over the blocks."""
    values = tree.filter("not child").select("nid", F.col("next").isNull().cast("long").alias("leaf"), "value")
    runs = (pos.select(F.expr("arc div 2").alias("nid"), (F.col("arc") % 2 == 1).alias("leaves"), "pos", F.expr(f"pos div {block}").alias("block"))
            .join(values, "nid"))
    amount = {c: F.when(F.col("leaves"), F.lit(0)).otherwise(F.col(c)) for c in ("leaf", "value")}
    w = W.partitionBy("block").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    runs = staged(runs.select("nid", "leaves", "block", "leaf", "value", *[F.sum(a).over(w).alias(f"run_{c}") for c, a in amount.items()],
                              *[a.alias(f"in_{c}") for c, a in amount.items()]), "runs")
    wb = W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before = runs.groupBy("block").agg(F.sum("in_leaf").alias("l"), F.sum("in_value").alias("v")).select(
        "block", *[F.coalesce(F.sum(c).over(wb), F.lit(0)).alias(f"before_{c}") for c in "lv"])
    whole = runs.join(before, "block")
    at = lambda run, before, leaves: F.max(F.when(F.col("leaves") == leaves, F.col(run) + F.col(before)))
    return whole.groupBy("nid").agg(
        (at("run_leaf", "before_l", True) - at("run_leaf", "before_l", False) + F.max("leaf")).alias("n_leaves"),
        (at("run_value", "before_v", True) - at("run_value", "before_v", False) + F.max("value")).alias("saved_tokens"))


# --- digests of the members that end at a node -----------------------------

_ENDS = "depth long, hi long, lo long, first long, ids string, digest string"


def _join_ids(batches, part, per_piece):
    """Rows sorted by (node, conv): a node inside the partition gets its
    digest; pieces of the first and the last node, and of long ones, go on as
    text."""
    open_key, ids, inside = None, [], False

    def pieces(key):
        return [(*key, int(ids[i]), ",".join(map(str, ids[i:i + per_piece])), None) for i in range(0, len(ids), per_piece)]

    for b in batches:
        cols = [column(b, c) for c in ("depth", "hi", "lo")]
        conv = column(b, "conv")
        starts = np.unique(run_starts(*cols))
        out = []
        for lo, hi in zip(starts, [*starts[1:], len(conv)]):
            key = tuple(int(c[lo]) for c in cols)
            if key != open_key:
                if open_key is not None:
                    out += [(*open_key, int(ids[0]), None, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())] if inside else pieces(open_key)
                    inside = True
                open_key, ids = key, []
            ids.extend(conv[lo:hi].tolist())
            if len(ids) >= per_piece:
                out, ids, inside = out + pieces(open_key), [], False
        if out:
            yield _batch(_ENDS, list(zip(*out)))
    if open_key is not None and ids:
        yield _batch(_ENDS, list(zip(*pieces(open_key))))


def _finish_digests(batches, part):
    key, sha, first = None, None, 0
    done = []
    for b in batches:
        for *k, start, ids in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("depth", "hi", "lo", "first", "ids"))):
            if k != key:
                if key is not None:
                    done.append((*key, first, None, sha.hexdigest()))
                key, sha, first = k, hashlib.sha256(ids.encode()), start
            else:
                sha.update(b"," + ids.encode())
    if key is not None:
        done.append((*key, first, None, sha.hexdigest()))
        yield _batch(_ENDS, list(zip(*done)))


def end_digests(convs: DataFrame, prefix: DataFrame, per_piece: int | None = None) -> DataFrame:
    """depth, hi, lo, ends_sha256 of the nodes where conversations end."""
    ends = prefix.filter("depth = total").select("depth", "hi", "lo", "conv").unionByName(
        convs.filter("total = 0").select(*[F.lit(0).cast("long").alias(c) for c in ("depth", "hi", "lo")], "conv"))
    rows = staged(sorted_parts(ends, convs.count(), "depth", "hi", "lo", "conv")
                  .mapInArrow(over_parts(functools.partial(_join_ids, per_piece=per_piece or IDS_PER_PIECE)), _ENDS), "ends")
    rest = (rows.filter("digest is null").repartition("depth", "hi", "lo").sortWithinPartitions("depth", "hi", "lo", "first")
            .mapInArrow(over_parts(_finish_digests), _ENDS))
    return rows.filter("digest is not null").unionByName(rest).select("depth", "hi", "lo", F.col("digest").alias("ends_sha256"))


NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def trie(convs: DataFrame, turns: DataFrame, per_task: int | None = None) -> DataFrame:
    """The trie of conversations (conv, total) with their turns (conv, depth
    from 1, total, hi, lo, bytes), one row per node."""
    prefix = staged(prefixes(turns), "names")
    node = nodes(convs, prefix)
    tree = staged(linked(node), "links")
    sums = subtree_sums(tree, positions(tour(tree), per_task))
    up = tree.filter("child").select("nid", "parent_conv")
    kids = tree.filter("child").groupBy(F.col("parent").alias("nid")).agg(F.count("*").alias("n_children"))
    ends = end_digests(convs, prefix)
    return (node.join(sums, "nid").join(up, "nid", "left").join(kids, "nid", "left").join(ends, ["depth", "hi", "lo"], "left")
            .select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs",
                    F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias("ends_sha256")))


def conversation_trie(conversations: DataFrame, per_task: int | None = None) -> DataFrame:
    """The trie of the conversations as they are."""
    prepare(conversations.sparkSession, rows=10_000)
    turns = staged(numbered_turns(conversations), "numbered")
    convs = staged(lengths_of(turns), "conversations")
    return trie(convs, turns.join(convs, "conv").select("conv", (F.col("pos") + 1).alias("depth"), "total", "hi", "lo", "bytes"), per_task)


def rebuilt_trie(conversations: DataFrame, per_task: int | None = None) -> DataFrame:
    """The trie of the conversations rebuilt from shared heads."""
    prepare(conversations.sparkSession, rows=10_000)
    return trie(*rebuilt(staged(numbered_turns(conversations), "numbered")), per_task)
