"""Convex hull per group (st_aggr_convexhull) and cluster footprints.

Two phases, exact because hull(A u B) = hull(hull(A) u hull(B)):
(1) ``mapInPandas`` keeps, of each batch and group, the outer points only, so
    the points themselves are neither counted nor shuffled, whatever the size
    of a group; (2) ``groupBy(group).applyInPandas`` takes the hull of what is
    left (a small fraction of the points). The hull itself is Andrew's
    monotone chain in NumPy. Rows without valid coordinates are left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punktwerk.session import ensure_checkpoint_dir


def monotone_chain(xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """Convex hull vertices (n x 2 array), counter-clockwise, collinear
    points dropped, starting at the lowest-x (then lowest-y) point."""
    pts = np.unique(np.stack([xs, ys], axis=1), axis=0)  # sorted by x then y
    if len(pts) <= 2:
        return pts

    def cross(o, a, b):
        return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])
    lower, upper = [], []
    for p in pts:
        while len(lower) >= 2 and cross(lower[-2], lower[-1], p) <= 0:
            lower.pop()
        lower.append(p)
    for p in pts[::-1]:
        while len(upper) >= 2 and cross(upper[-2], upper[-1], p) <= 0:
            upper.pop()
        upper.append(p)
    hull = np.array(lower[:-1] + upper[:-1])
    return hull


def outer_points(xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """A superset of the hull's vertices: drops only points that lie inside by
    more than rounding, so that the last phase decides about the rest."""
    pts = np.unique(np.stack([xs, ys], axis=1), axis=0)
    if len(pts) <= 3:
        return pts
    tol = 1e-9 * max(np.ptp(pts[:, 0]), np.ptp(pts[:, 1]), 1e-300) ** 2

    def chain(points):
        out = []
        for p in points:
            while len(out) >= 2:
                (ox, oy), (ax, ay) = out[-2], out[-1]
                if (ax - ox) * (p[1] - oy) - (ay - oy) * (p[0] - ox) >= -tol:
                    break
                out.pop()
            out.append((p[0], p[1]))
        return out

    return np.unique(np.array(chain(pts) + chain(pts[::-1])), axis=0)


def _reduce(key_cols):
    """Map-side phase: of each batch and group, only the outer points."""
    def run(batches):
        for pdf in batches:
            parts = []
            for _, g in pdf.groupby(key_cols, dropna=False, sort=False):
                if len(g) > 3:
                    h = outer_points(g["x"].to_numpy(), g["y"].to_numpy())
                    g = g.iloc[:len(h)].assign(x=h[:, 0], y=h[:, 1])
                parts.append(g)
            yield pd.concat(parts) if parts else pdf
    return run


def _final(key_cols):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        h = monotone_chain(pdf["lx"].to_numpy(), pdf["ly"].to_numpy())
        x0, y0 = float(pdf["_x0"].iloc[0]), float(pdf["_y0"].iloc[0])
        if len(h) >= 3:
            hx, hy = h[:, 0], h[:, 1]
            area = 0.5 * float(np.sum(hx * np.roll(hy, -1) - np.roll(hx, -1) * hy))
            gtype = "POLYGON"
            ring = np.vstack([h, h[:1]])
        else:
            area, ring = 0.0, h
            gtype = "LINESTRING" if len(h) == 2 else "POINT"
        row = {k: pdf[k].iloc[0] for k in key_cols}
        row.update(gtype=gtype, n_vertices=int(len(h)), area=area,
                   hull=[{"x": float(a) + x0, "y": float(b) + y0} for a, b in ring])
        return pd.DataFrame([row])
    return fn


def convex_hull(df: DataFrame, by: str | list[str], x: str = "x", y: str = "y",
                rows_per_task: int = 200_000) -> DataFrame:
    """One row per group: gtype (POLYGON, or LINESTRING/POINT when the
    points are collinear/coincident), n_vertices, area, hull ring.

    Coordinates are shifted to the group's (min x, min y) before the hull
    and area are computed, which keeps the shoelace sum free of the
    cancellation large projected coordinates cause."""
    from punktwerk.session import ship_package
    ship_package(df.sparkSession)
    ensure_checkpoint_dir(df.sparkSession)
    keys = [by] if isinstance(by, str) else list(by)
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    valid = px.isNotNull() & py.isNotNull() & ~F.isnan(px) & ~F.isnan(py)
    pts = df.filter(valid).select(*keys, px.alias("x"), py.alias("y"))
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pts.schema.fields if f.name in keys)
    reduce_ = _reduce(keys)
    partial = pts.mapInPandas(reduce_, f"{key_schema}, x double, y double").checkpoint()
    # while a group's outer points exceed one task's share, deal that group
    # anew (row by row, so that equal points are dealt too) and reduce again;
    # what no longer shrinks is in convex position
    before: dict | None = None
    while True:
        sizes = partial.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"))
        row = sizes.filter(F.col("_m") > rows_per_task).agg(F.count("*").alias("groups"), F.sum("_m").alias("rows")).first()
        if not row.groups or (before is not None and row.groups == before["groups"] and row.rows > 0.9 * before["rows"]):
            break
        before = row.asDict()
        n = max(2, -(-row.rows // rows_per_task))
        dealt = partial.withColumn("_at", F.monotonically_increasing_id()).repartition(n, *keys, F.pmod("_at", F.lit(n))).drop("_at")
        partial = dealt.sortWithinPartitions(*keys).mapInPandas(reduce_, f"{key_schema}, x double, y double").checkpoint()
    low = partial.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min("x").alias("_x0"), F.min("y").alias("_y0"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    partial = partial.join(low, same).select(
        *keys, (F.col("x") - F.col("_x0")).alias("lx"), (F.col("y") - F.col("_y0")).alias("ly"), "_x0", "_y0")
    return partial.groupBy(*keys).applyInPandas(
        _final(keys), f"{key_schema}, gtype string, n_vertices int, area double, "
                      "hull array<struct<x:double,y:double>>")


def footprints(labels: DataFrame, cluster: str = "cluster", x: str = "x", y: str = "y",
               min_members: int = 3) -> DataFrame:
    """Hull footprint per cluster; noise (-1) and clusters with fewer than
    ``min_members`` points are skipped."""
    members = labels.filter(F.col(cluster) != -1)
    sizes = members.groupBy(cluster).agg(F.count(F.lit(1)).alias("n_points")) \
        .filter(F.col("n_points") >= min_members)
    hulls = convex_hull(members.join(sizes.select(cluster), cluster), cluster, x, y)
    return hulls.join(sizes, cluster)


def footprint_heights(fp: DataFrame, factor: float = 0.05, kind: str = "building") -> DataFrame:
    """Extrusion height: area * factor for buildings, 0 for streets."""
    h = F.col("area") * F.lit(factor) if kind == "building" else F.lit(0.0)
    return fp.withColumn("height", h)
