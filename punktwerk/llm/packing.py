"""Packing token sequences: shortest-pack-first over the length histogram
(Krell et al., "Efficient Sequence Packing without Cross-contamination").

Documents are tokenised and cut into pieces of at most ``max_len`` ids; only
a document's last piece is shorter. What is packed is the histogram of piece
lengths, at most ``max_len`` numbers however many pieces there are: lengths
are placed from the longest down, always into the open pattern that is
filled least, and a pattern is a list of lengths with a count. The patterns
come back to the pieces by rank: the k-th piece of a length takes the k-th
place that the patterns hold for that length. Ranks need no sort: a piece
knows its rank within its own task, and the counts of the tasks before it
are added as a prefix sum.

Where no length fits the rooms that are left (a corpus of pieces just above
half a sequence), more than ``PADDING`` of the sequences would be padding.
Then the least filled sequences are given up and their pieces are cut at the
open rooms of the others: cuts are counted on the histogram like patterns,
and dealt by rank like them. Rooms under ``max_len / 64`` stay open.

Null texts count as empty; a document always has its end id, so it has at
least one piece. Rows that repeat a doc_id are packed separately. Extra
columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from punktwerk.llm.common import prepare, staged, tidied
from punktwerk.llm.tokens import MEMO_UNITS, encoder

MAX_LEN = 2048
PIECES = "doc_id long, start long, length int, doc_tokens long, part int, nth long, ids binary"


def _cut(path: str, end_id: int, max_len: int, width: int, memo_units: int, special_as_text: bool):
    tail = np.array([end_id], dtype=f"<u{width}").tobytes()

    @tidied
    def run(batches):
        tok, part = encoder(path, width, memo_units, special_as_text), TaskContext.get().partitionId()
        seen = [0] * (max_len + 1)        # pieces of each length so far in this task
        step = max_len * width
        for b in batches:
            cols = [[] for _ in range(7)]
            for doc, x in zip(b.column(0).to_pylist(), tok.encode([t or "" for t in b.column(1).to_pylist()])):
                x += tail
                for at in range(0, len(x), step):
                    ids = x[at:at + step]
                    n = len(ids) // width
                    for col, v in zip(cols, (doc, at // width, n, len(x) // width, part, seen[n], ids)):
                        col.append(v)
                    seen[n] += 1
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             ["doc_id", "start", "length", "doc_tokens", "part", "nth", "ids"])

    return run


def pieces(docs: DataFrame, tokenizer: str, end_id: int, max_len: int = MAX_LEN, width: int = 2,
           memo_units: int = MEMO_UNITS, special_as_text: bool = False) -> DataFrame:
    """The cut and tokenised documents, written to the shared scratch folder:
    ``ids`` holds ``width`` bytes little-endian per id."""
    prepare(docs.sparkSession)
    return staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                  .mapInArrow(_cut(tokenizer, end_id, max_len, width, memo_units, special_as_text), PIECES), "pieces")


def pack_histogram(histogram: dict[int, int], max_len: int = MAX_LEN) -> list[tuple[list[int], int]]:
    """[(lengths, count)]: the patterns that hold every length as often as the
    histogram says. Work and result depend on the number of distinct lengths,
    not on the counts."""
    open_: list[tuple[int, int]] = []           # (-room, index) of unfinished patterns
    patterns: list[list] = []

    def add(lengths, count):
        patterns.append([lengths, count])
        room = max_len - sum(lengths)
        if room:
            heapq.heappush(open_, (-room, len(patterns) - 1))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not open_ or -open_[0][0] < length:
                each = max_len // length        # equal lengths share a pattern
                whole, rest = divmod(left, each)
                if whole:
                    add([length] * each, whole)
                if rest:
                    add([length] * rest, 1)
                break
            _, at = heapq.heappop(open_)        # the shortest pack
            lengths, count = patterns[at]
            placed = min(count, left)
            patterns[at][1] -= placed
            if patterns[at][1]:
                heapq.heappush(open_, (-(max_len - sum(lengths)), at))
            add([*lengths, length], placed)
            left -= placed
    return [(lengths, count) for lengths, count in patterns if count]


def places(patterns: list[tuple[list[int], int]]) -> dict[int, list[tuple[int, int, int, int]]]:
    """length -> [(first rank, end rank, first sequence, offset)]: which ranks
    of a length go where."""
    out: dict[int, list] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for lengths, count in patterns:
        offset = 0
        for n in lengths:
            lo = taken.get(n, 0)
            out.setdefault(n, []).append((lo, lo + count, sequence, offset))
            taken[n] = lo + count
            offset += n
        sequence += count
    return out


#: Share of padding above which pieces are cut.
PADDING = 0.01


def _given_up(patterns: list[tuple[list[int], int]], max_len: int, least: int) -> dict[int, int]:
    """pattern -> how many of its sequences are given up: the least filled
    ones, as long as the rooms of the others can take their ids and there is
    more padding than ``PADDING``."""
    room = [max_len - sum(lengths) for lengths, _ in patterns]
    ids = sum((max_len - r) * n for r, (_, n) in zip(room, patterns))
    many = sum(n for _, n in patterns) - -(-ids // int(max_len * (1 - PADDING)))
    free = sum(r * n for r, (_, n) in zip(room, patterns) if r >= least)
    out: dict[int, int] = {}
    for i in sorted(range(len(patterns)), key=lambda i: -room[i]):
        if many <= 0 or room[i] < least:
            break
        # n sequences less: their room goes, their ids come
        n = min(many, patterns[i][1], free // max_len)
        if n <= 0:
            break
        out[i] = n
        many, free = many - n, free - n * max_len
    return out


def plan(histogram: dict[int, int], max_len: int = MAX_LEN) -> dict[int, list[tuple[int, int, list[tuple[int, int, int, int]]]]]:
    """length -> [(first rank, end rank, fragments)]: where the pieces of a
    length go. A fragment is (sequence of the first rank, offset there, first
    id of the piece, ids); the next rank takes the next sequence."""
    patterns, least = pack_histogram(histogram, max_len), max(1, max_len // 64)
    gone = _given_up(patterns, max_len, least)
    kept = [(lengths, count - gone.get(i, 0)) for i, (lengths, count) in enumerate(patterns)]
    kept = [(lengths, count) for lengths, count in kept if count]
    out = {n: [(lo, hi, [(sequence, offset, 0, n)]) for lo, hi, sequence, offset in spans] for n, spans in places(kept).items()}
    rooms, sequence = [], 0             # (-room, first sequence, sequences, offset)
    for lengths, count in kept:
        used = sum(lengths)
        if max_len - used >= least:
            rooms.append((used - max_len, sequence, count, used))
        sequence += count
    heapq.heapify(rooms)
    loose: dict[int, int] = {}
    for i, count in gone.items():
        for n in patterns[i][0]:
            loose[n] = loose.get(n, 0) + count
    # (-ids left, length, first rank, pieces, first id left, fragments)
    todo = [(-n, n, out[n][-1][1] if n in out else 0, count, 0, []) for n, count in loose.items()]
    heapq.heapify(todo)
    while todo:
        left, n, rank, count, first, done = heapq.heappop(todo)
        left = -left
        if not rooms:
            each = max(1, max_len // left)
            heapq.heappush(rooms, (-max_len, sequence, -(-count // each), 0))
            sequence += rooms[0][2]
        room, at, many, offset = heapq.heappop(rooms)
        room, both = -room, min(count, many)
        taken = min(left, room)
        placed = [*done, (at, offset, first, taken)]
        if taken == left:
            out.setdefault(n, []).append((rank, rank + both, placed))
        else:
            heapq.heappush(todo, (taken - left, n, rank, both, first + taken, placed))
        if count > both:
            heapq.heappush(todo, (-left, n, rank + both, count - both, first, [(a + both, *rest) for a, *rest in done]))
        if many > both:
            heapq.heappush(rooms, (-room, at + both, many - both, offset))
        if room - taken >= least:
            heapq.heappush(rooms, (taken - room, at, both, offset + taken))
    return out


_FRAGMENT = T.StructType([T.StructField(c, T.LongType()) for c in ("sequence", "offset", "first", "n")])
_PLACES = T.StructType([T.StructField("_len", T.IntegerType()), T.StructField("_places", T.ArrayType(T.StructType([
    T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType()), T.StructField("fragments", T.ArrayType(_FRAGMENT))])))])


def place(cut: DataFrame, max_len: int = MAX_LEN) -> tuple[DataFrame, bool]:
    """Pieces (columns part, length, nth, start) by fragment: adds sequence_id,
    offset, first (id within the piece) and n; and whether any is cut. The
    counts of the tasks before are joined by task and length, so neither side
    is gathered in one place."""
    spark = cut.sparkSession
    counts = staged(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "piece_counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    planned = plan(histogram, max_len)
    table = staged(spark.createDataFrame(sorted(planned.items()), _PLACES).coalesce(1), "places")
    before = staged(counts.select(F.col("part").alias("_part"), F.col("length").alias("_length"), F.coalesce(
        F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before")), "ranks_before")
    ranked = (cut.join(before.hint("merge"), (F.col("part") == F.col("_part")) & (F.col("length") == F.col("_length")))
              .withColumn("_rank", F.col("nth") + F.col("_before")))
    hit = F.get(F.expr("filter(_places, p -> _rank >= p.lo and _rank < p.hi)"), 0)
    placed = (ranked.join(F.broadcast(table), F.col("length") == F.col("_len")).withColumn("_hit", hit)
              .withColumn("_f", F.explode("_hit.fragments"))
              .withColumn("sequence_id", F.col("_f.sequence") + F.col("_rank") - F.col("_hit.lo"))
              .select("*", F.col("_f.offset").alias("offset"), F.col("_f.first").alias("first"), F.col("_f.n").alias("n"))
              .drop("_part", "_length", "_before", "_rank", "_len", "_places", "_hit", "_f"))
    return placed, any(len(f) > 1 for spans in planned.values() for _, _, f in spans)


def ids_crc32(width: int):
    """Column function: crc32 of a piece's ids as unsigned 32-bit integers."""
    @F.pandas_udf(T.LongType())
    def crc(ids: pd.Series) -> pd.Series:
        return pd.Series([zlib.crc32(np.frombuffer(x, f"<u{width}").astype("<u4").tobytes()) for x in ids], dtype="int64")
    return crc


def _slice(ids: str, width: int):
    return F.substring(ids, (F.col("first") * width + 1).cast("int"), (F.col("n") * width).cast("int"))


def pack(docs: DataFrame, tokenizer: str, end_id: int, max_len: int = MAX_LEN, width: int = 2) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids, sequence_id, offset."""
    placed, _ = place(pieces(docs, tokenizer, end_id, max_len, width), max_len)
    return placed.select("doc_id", (F.col("start") + F.col("first")).alias("start"), F.col("n").cast("int").alias("length"), "doc_tokens",
                         _slice("ids", width).alias("ids"), "sequence_id", "offset")


def packing_digest(docs: DataFrame, tokenizer: str, end_id: int, max_len: int = MAX_LEN, width: int = 2,
                   memo_units: int = MEMO_UNITS, special_as_text: bool = False) -> DataFrame:
    """The placement of every piece with the crc32 of its stored ids. The
    digest is taken where the ids are read, so only narrow rows are joined;
    the ids of pieces that are cut go with their fragments."""
    cut = pieces(docs, tokenizer, end_id, max_len, width, memo_units, special_as_text)
    crc = ids_crc32(width)
    narrow = staged(cut.select("doc_id", "start", F.col("length").cast("long").alias("length"), crc("ids").alias("ids_crc32"),
                               "doc_tokens", "part", "nth"), "piece_digests")
    placed, any_cut = place(narrow, max_len)
    if any_cut:
        placed = staged(placed, "fragments")
        own = cut.select(F.col("part").alias("_p"), F.col("length").alias("_l"), F.col("nth").alias("_n"), "ids")
        parts = placed.filter("n < length").join(own, (F.col("part") == F.col("_p")) & (F.col("length") == F.col("_l")) & (F.col("nth") == F.col("_n")))
        parts = parts.withColumn("ids_crc32", crc(_slice("ids", width))).select(*placed.columns)
        placed = placed.filter("n = length").unionByName(parts)
    return placed.select("doc_id", (F.col("start") + F.col("first")).alias("start"), F.col("n").alias("length"), "ids_crc32", "doc_tokens",
                         "sequence_id", "offset")


def sequences(docs: DataFrame, tokenizer: str, end_id: int, max_len: int = MAX_LEN, width: int = 2) -> DataFrame:
    """(sequence_id, used, padded_to, ids): the packed sequences themselves.
    A sequence is padded to ``max_len`` unless it fills a power of two."""
    p = pack(docs, tokenizer, end_id, max_len, width)
    s = p.groupBy("sequence_id").agg(F.sum("length").cast("int").alias("used"),
                                     F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts"))
    power = F.expr("(used & (used - 1)) = 0")
    return s.withColumn("padded_to", F.when(power, F.col("used")).otherwise(max_len)).select(
        "sequence_id", "used", "padded_to", F.expr("transform(parts, p -> p.ids)").alias("ids"))
