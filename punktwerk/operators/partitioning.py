"""Spatial partitions that follow the density of the data.

A quadtree over the extent of one or more point tables is found from
histograms: a first one counts the cells some levels down, and only cells that
hold too many rows are counted further down, until every leaf holds at most
``rows_per_part`` rows. A leaf is an interval of Z-order codes, so the tree is
a sorted list of numbers, and rows of any table find their leaf by bisection.

Each leaf becomes one partition. Its rows carry a key whose hash falls into
that partition, so two tables dealt by the same tree meet leaf by leaf: a join
on the key needs no further exchange. Rows that lie in one spot can't be told
apart by place: such a leaf takes several partitions; the left table's rows
are dealt over them and the right table's rows repeated in each."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punktwerk.functions.curve import z_order
from punktwerk.session import scratch_path, ship_package

LEVELS = 28             # of the quadtree: 2^28 lattice lines a side
STEP = 5                # levels that one histogram goes down
#: A partition takes some memory of the driver whoever plans it; the tree
#: takes 24 bytes more.
MAX_PARTS = 1 << 20


@dataclass
class SplitTree:
    """Leaves in Z order: first code, rows, partitions and first key of each."""
    low: tuple[float, float]
    step: float
    starts: np.ndarray
    rows: np.ndarray
    parts: np.ndarray
    first: np.ndarray
    keys: np.ndarray

    @property
    def num_parts(self) -> int:
        return len(self.keys)

    def code(self, x: str = "x", y: str = "y") -> Column:
        return z_order(x, y, self.low, self.step)


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _keys(spark: SparkSession, n: int) -> np.ndarray:
    """For each of n partitions an integer that Spark's hash puts there."""
    tries = int(n * (math.log(n + 1) + 8))
    while True:
        found = (spark.range(tries).select(F.col("id").cast("int").alias("k")).groupBy(F.pmod(F.hash("k"), F.lit(n)).alias("slot"))
                 .agg(F.min("k").alias("k")).toPandas())
        if len(found) == n:
            return found.sort_values("slot")["k"].to_numpy()
        tries *= 2


def split_tree(tables: list[DataFrame], rows_per_part: int = 1_000_000, x: str = "x", y: str = "y") -> SplitTree:
    """The tree of all rows of ``tables`` together. Rows without a place
    count for the first cell."""
    spark = tables[0].sparkSession
    places = tables[0].select(F.col(x).alias("x"), F.col(y).alias("y"))
    for t in tables[1:]:
        places = places.unionByName(t.select(F.col(x).alias("x"), F.col(y).alias("y")))
    ok = ~F.isnan("x") & ~F.isnan("y")
    e = places.filter(ok).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).first()
    low = (e.x0 or 0.0, e.y0 or 0.0)
    step = max((e.x1 or 0.0) - low[0], (e.y1 or 0.0) - low[1], 1e-9) / ((1 << LEVELS) - 1)
    codes = places.select(z_order("x", "y", low, step).alias("code"))
    leaves, depth, dense = [], 0, None
    while True:
        down = min(depth + STEP, LEVELS)
        cell = lambda level: F.shiftright("code", 2 * (LEVELS - level))
        inside = codes.select(cell(depth).alias("top"), cell(down).alias("cell"))
        if dense is not None:
            inside = inside.join(dense, "top", "left_semi")
        counts = _staged(inside.groupBy("cell").agg(F.count("*").alias("n")), "cells")
        # from the top down: a cell that is small enough is a leaf, whatever is below it
        open_ = None
        for level in range(depth if depth == 0 else depth + 1, down + 1):
            at = counts.groupBy(F.shiftright("cell", 2 * (down - level)).alias("c")).agg(F.sum("n").alias("n"))
            if open_ is not None:
                at = at.join(open_, F.shiftright("c", 2) == F.col("up"), "left_semi")
            at = _staged(at, "level")
            small = at if level == LEVELS else at.filter(F.col("n") <= rows_per_part)
            leaves += [(r["c"] << 2 * (LEVELS - level), r["n"]) for r in small.collect()]
            if len(leaves) > MAX_PARTS:
                raise ValueError(f"more than {MAX_PARTS} partitions; raise rows_per_part")
            open_ = at.filter(F.col("n") > rows_per_part).select(F.col("c").alias("up"))
            if level == LEVELS or open_.isEmpty():
                open_ = None
                break
        if open_ is None:
            break
        dense, depth = open_.withColumnRenamed("up", "top"), down
    leaves = sorted(leaves) or [(0, 0)]
    starts, rows = (np.array(v, np.int64) for v in zip(*leaves))
    starts[0] = 0               # empty cells fall to the leaf before them
    parts = np.maximum(1, -(-rows // rows_per_part))
    first = np.concatenate([[0], np.cumsum(parts)[:-1]])
    return SplitTree(low, step, starts, rows, parts, first, _keys(spark, int(parts.sum())))


def _key_of(tree: SplitTree, spark: SparkSession, repeat: bool):
    """Column function from codes to part keys: bisection, and in a full spot
    the rows of a task by turns. 24 bytes a leaf are sent, MAX_PARTS at most."""
    shared = spark.sparkContext.broadcast((tree.starts, tree.first, tree.parts, tree.keys))

    def every(codes: Iterator[pd.Series]) -> Iterator[pd.Series]:
        starts, first, parts, keys = shared.value
        for code in codes:
            leaf = np.searchsorted(starts, code.to_numpy(np.int64), side="right") - 1
            yield pd.Series([keys[first[i]:first[i] + parts[i]].tolist() for i in leaf], dtype=object)

    def dealt(codes: Iterator[pd.Series]) -> Iterator[pd.Series]:
        starts, first, parts, keys = shared.value
        turn = np.full(len(starts), TaskContext.get().partitionId(), np.int64)
        for code in codes:
            leaf = np.searchsorted(starts, code.to_numpy(np.int64), side="right") - 1
            part = first[leaf]
            for i in np.unique(leaf[parts[leaf] > 1]):
                rows = np.flatnonzero(leaf == i)
                part[rows] += (turn[i] + np.arange(len(rows))) % parts[i]
                turn[i] += len(rows)
            yield pd.Series(keys[part], dtype="int32")

    if repeat:
        return F.pandas_udf(every, T.ArrayType(T.IntegerType())).asNondeterministic()
    return F.pandas_udf(dealt, T.IntegerType()).asNondeterministic()


def deal(df: DataFrame, tree: SplitTree, x: str = "x", y: str = "y", repeat: bool = False, name: str = "part_key") -> DataFrame:
    """``df`` with one partition per leaf (several for a full spot) and the
    key column ``name``. With ``repeat`` the rows of a spot go to all of its
    partitions, otherwise they are dealt: a partition then holds at most
    ``rows_per_part`` rows and one more for each task that dealt them."""
    spark = df.sparkSession
    ship_package(spark)
    key = _key_of(tree, spark, repeat)(tree.code(x, y))
    return df.withColumn(name, F.explode(key) if repeat else key).repartition(tree.num_parts, name)


def co_partition(a: DataFrame, b: DataFrame, rows_per_part: int = 1_000_000, x: str = "x", y: str = "y",
                 name: str = "part_key") -> tuple[DataFrame, DataFrame, SplitTree]:
    """Both tables dealt by one tree: rows of one place meet in one partition
    under one key."""
    tree = split_tree([a, b], rows_per_part, x, y)
    return deal(a, tree, x, y, name=name), deal(b, tree, x, y, repeat=True, name=name), tree
