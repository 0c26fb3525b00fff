"""Nearest neighbours with a bound on the distance.

Before any exact distance is computed, counts per cell (or the zone map of a
tile table) give a radius that surely holds ``k`` rows: the distance to the far
corner of enough cells. Only rows in the window of that radius are looked at,
and the window is a plain range predicate that reaches the scan."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from punktwerk.functions import geom as G
from punktwerk.session import scratch_path
from punktwerk.sources import tile_log as TL


def _far(px: float, py: float) -> Column:
    dx = F.greatest(F.abs(F.col("minx") - px), F.abs(F.col("maxx") - px))
    dy = F.greatest(F.abs(F.col("miny") - py), F.abs(F.col("maxy") - py))
    return F.sqrt(dx * dx + dy * dy)


def _placed(x: str, y: str) -> Column:
    return F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(x) & ~F.isnan(y)


def radius(boxes: DataFrame, k: int, px: float, py: float) -> float | None:
    """A distance within which the boxes (minx, maxx, miny, maxy, n) surely
    hold k rows; None if they don't hold so many. At most k boxes come to the
    driver, as each holds a row."""
    held = 0
    for r in boxes.filter("n > 0").select(_far(px, py).alias("far"), "n").orderBy("far").limit(k).collect():
        held += r["n"]
        if held >= k:
            return r["far"] * (1 + 1e-12)
    return None


def cell_boxes(df: DataFrame, cell: float, x: str = "x", y: str = "y") -> DataFrame:
    """The extent and count of the rows of each cell."""
    return df.filter(_placed(x, y)).groupBy(F.floor(F.col(x) / cell).alias("cx"), F.floor(F.col(y) / cell).alias("cy")).agg(
        F.min(x).alias("minx"), F.max(x).alias("maxx"), F.min(y).alias("miny"), F.max(y).alias("maxy"), F.count("*").alias("n"))


def knn_bounded(df: DataFrame, k: int, px: float, py: float, order_key: str, boxes: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """The k rows nearest to a point (ties by ``order_key``) as by
    ``joins.knn_point``, from the window that ``boxes`` allow. Rows without a
    place have no distance and are not found."""
    r = radius(boxes, k, px, py)
    near = df.filter(_placed(x, y)) if r is None else df.filter(
        (F.col(x) >= px - r) & (F.col(x) <= px + r) & (F.col(y) >= py - r) & (F.col(y) <= py + r))
    return near.withColumn("dist", G.dist_xy(x, y, F.lit(float(px)), F.lit(float(py)))).orderBy("dist", order_key).limit(k)


def knn_tiles(spark: SparkSession, table: str, k: int, px: float, py: float, *order: str) -> DataFrame:
    """The k points of a tile table nearest to a place: the zone map gives the
    radius, so no point is read for it, and only tiles that the window meets
    are read at all."""
    zones = TL.zone_map(spark, table).withColumn("n", F.col("n_points") - F.col("strays"))
    r = radius(zones, k, px, py)
    points = TL.read_points(spark, table).filter(_placed("x", "y")) if r is None else TL.window_points(
        spark, table, (px - r, py - r, px + r, py + r))
    return points.withColumn("dist", G.dist_xy("x", "y", F.lit(float(px)), F.lit(float(py)))).orderBy("dist", *order).limit(k)


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Levels of cells between two looks at the counts.
LEVEL_STEP = 2


def knn_join(queries: DataFrame, points: DataFrame, k: int, query_key: str, point_key: str, x: str = "x", y: str = "y") -> DataFrame:
    """(query_key, point_key, dist, rank): for every row of ``queries`` the k
    nearest rows of ``points``, ties by ``point_key``; fewer where there are
    fewer points. Keys are unique.

    Cells start small and double. A query is settled at the first size at
    which the 3 x 3 cells around it hold k points: its k nearest lie within
    the diagonal of those cells, so they are in the cells which that circle
    meets. Sparse places thus use large cells and dense places small ones,
    and each query meets a number of points near k, not a share of all; only
    queries far outside the points' extent meet cells of its size."""
    good = _placed(x, y)
    p = points.filter(good).select(F.col(x).alias("_x"), F.col(y).alias("_y"), F.col(point_key).alias("_p"))
    todo = queries.filter(good).select(F.col(query_key).alias("_q"), F.col(x).alias("_qx"), F.col(y).alias("_qy"))
    e = p.agg(F.count("*").alias("n"), F.min("_x").alias("x0"), F.max("_x").alias("x1"), F.min("_y").alias("y0"), F.max("_y").alias("y1")).first()
    if not e.n:
        return todo.join(p, todo["_qx"] == p["_x"]).select(F.col("_q").alias(query_key), F.col("_p").alias(point_key), F.lit(0.0).alias("dist"), F.lit(1).alias("rank"))
    k = min(k, e.n)
    side = max(e.x1 - e.x0, e.y1 - e.y0, 1e-9)
    size = max(math.sqrt(side * side * k / e.n) / 64, side / (1 << 26))
    far = float(1 << 40)            # beyond any cell that holds points

    def at(v, low, level):
        return F.floor(F.greatest(F.least((F.col(v) - F.lit(low)) / F.lit(size * 2.0 ** level), F.lit(far)), F.lit(-far))).cast("long")

    counts = _staged(p.groupBy(at("_x", e.x0, 0).alias("cx"), at("_y", e.y0, 0).alias("cy")).agg(F.count("*").alias("n")), "knn-cells")
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    found, level, todo = [], 0, _staged(todo, "knn-queries")
    while True:
        here = counts.groupBy(F.expr(f"shiftright(cx, {min(level, 62)})").alias("cx"), F.expr(f"shiftright(cy, {min(level, 62)})").alias("cy")).agg(F.sum("n").alias("n"))
        around = todo.withColumn("_s", steps).select("_q", (at("_qx", e.x0, level) + F.col("_s.i")).alias("cx"), (at("_qy", e.y0, level) + F.col("_s.j")).alias("cy"))
        settled = around.join(here, ["cx", "cy"]).groupBy("_q").agg(F.sum("n").alias("n")).filter(F.col("n") >= k).select("_q")
        settled = _staged(settled, "knn-settled")
        found.append((level, todo.join(settled, "_q")))
        todo = _staged(todo.join(settled, "_q", "left_anti"), "knn-queries")
        level += LEVEL_STEP
        if todo.isEmpty():
            break
        if size * 2.0 ** level > 4 * side:
            # outside of the extent: go to cells that reach it
            off = todo.agg(F.max(F.greatest(*[F.abs(F.col(v) - F.lit(c)) for v, c in (("_qx", e.x0), ("_qx", e.x1), ("_qy", e.y0), ("_qy", e.y1))]))).first()[0]
            level = max(level, math.ceil(math.log2(off / size)) + 1)
    out = None
    for level, qs in found:
        c = size * 2.0 ** level
        reach = F.explode(F.sequence(F.lit(-3), F.lit(3)))
        cells = qs.withColumn("_i", reach).withColumn("_j", reach).withColumn("cx", at("_qx", e.x0, level) + F.col("_i")).withColumn(
            "cy", at("_qy", e.y0, level) + F.col("_j"))
        cand = cells.join(p.withColumn("cx", at("_x", e.x0, level)).withColumn("cy", at("_y", e.y0, level)), ["cx", "cy"])
        d = G.dist_xy("_x", "_y", F.col("_qx"), F.col("_qy"))
        cand = cand.withColumn("dist", d).filter(F.col("dist") <= F.lit(2 * math.sqrt(2) * c * (1 + 1e-12))).select("_q", "_p", "dist")
        out = cand if out is None else out.unionByName(cand)
    ranked = out.withColumn("rank", F.row_number().over(W.partitionBy("_q").orderBy("dist", "_p"))).filter(F.col("rank") <= k)
    return ranked.select(F.col("_q").alias(query_key), F.col("_p").alias(point_key), "dist", "rank")
