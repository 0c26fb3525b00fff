"""Clustering on Spark: exact DBSCAN on a grid, k-means, cluster footprints.

DBSCAN (eps, min_points; a point counts itself; neighbour = distance <=
eps; noise = -1; cluster id = smallest id among the component's core
points; a border point takes the smallest adjacent cluster id):

1. Half-cells of side h = eps / (2*sqrt(2)) and cells of side 2h. Any two
   points of one cell are closer than eps, so every point of a cell holding
   >= min_points points is core and needs no distance test at all.
2. Only points of sparse cells count neighbours, by a candidate equi-join
   against the 25 cells within reach (hot cells are salted).
3. Cells with core points are graph nodes. Two cells are linked for certain
   when they own core points in adjacent half-cells (their distance is then
   below eps) -- no point pairs needed. Components of these links come
   from the Large-Star/Small-Star iteration (``graph.py``).
4. Neighbouring core cells still in different components are compared on
   quarter-cells (at most 16 x 16 pairs per cell pair): a pair of core
   quarter-cells whose boxes are within eps everywhere links them for
   certain; only quarter pairs that may or may not hold a witness, in cell
   pairs without a certain link, are checked point by point.
5. Border points: non-core points (sparse cells only) against core points
   of the 25 cells around them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punktwerk.functions.geom import dist_xy
from punktwerk.operators.graph import blocked_components, connected_components
from punktwerk.operators.joins import BLOCK_ROWS, key_join, salted_equi_join
from punktwerk.session import ensure_checkpoint_dir

# all 25 cells: with cells a little smaller than eps / sqrt(2), points of
# corner cells can be just within eps (the exact test decides)
_OFFS25 = [(i, j) for i in range(-2, 3) for j in range(-2, 3)]
_OFFS8 = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) != (0, 0)]


def _offsets(offs) -> F.Column:
    return F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in offs])


def _node(cx: str, cy: str) -> F.Column:
    # cell -> one bigint node id; an index beyond 31 bits is an error, never
    # a silent collision of two cells
    lim = 1 << 31
    fits = F.col(cx).between(-lim, lim - 1) & F.col(cy).between(-lim, lim - 1)
    node = F.shiftleft(F.col(cx), 32) + F.col(cy).bitwiseAND(F.lit(0xFFFFFFFF))
    return F.when(fits, node).otherwise(F.raise_error(F.lit("dbscan: coordinate / eps exceeds 31 bits")).cast("bigint"))


BLOCK_CELLS = 64   # components are first solved inside blocks of 64 x 64 cells (<= 4096 nodes)


def _block(cx, cy) -> F.Column:
    return F.struct(F.floor(cx / BLOCK_CELLS).alias("bx"), F.floor(cy / BLOCK_CELLS).alias("by"))


def _replicate(df: DataFrame, offs, cx="_cx", cy="_cy") -> DataFrame:
    """One row per neighbouring cell, with the target cell in (_tx, _ty)."""
    return df.withColumn("_o", F.explode(_offsets(offs))) \
        .withColumn("_tx", F.col(cx) + F.col("_o.i")).withColumn("_ty", F.col(cy) + F.col("_o.j")).drop("_o")


def dbscan(df: DataFrame, eps: float, min_points: int, id_col: str = "pid", x: str = "x",
           y: str = "y", block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """(id, x, y, cluster, is_core) for every input row; see module doc."""
    ensure_checkpoint_dir(df.sparkSession)
    # quarter-cells of side q nest in half-cells (2q) and cells (4q); the
    # margin keeps the distance bounds strict under rounding of x / q
    q = eps / (4 * math.sqrt(2)) * (1 - 1e-6)
    raw = df.select(F.col(id_col).alias("_id"), F.col(x).cast("double").alias("_x"),
                    F.col(y).cast("double").alias("_y"))
    ok = F.col("_x").isNotNull() & F.col("_y").isNotNull() & ~F.isnan("_x") & ~F.isnan("_y")
    invalid = raw.filter(~ok)          # no coordinates: reported as noise, never dropped
    pts = raw.filter(ok)
    pts = pts.withColumn("_qx", F.floor(F.col("_x") / q).cast("bigint")) \
             .withColumn("_qy", F.floor(F.col("_y") / q).cast("bigint"))
    pts = pts.withColumn("_sx", F.shiftright("_qx", 1)).withColumn("_sy", F.shiftright("_qy", 1))
    pts = pts.withColumn("_cx", F.shiftright("_qx", 2)).withColumn("_cy", F.shiftright("_qy", 2))
    cell_n = pts.groupBy("_cx", "_cy").agg(F.count(F.lit(1)).alias("_n"))
    # materialised once: four branches below read it
    pts = key_join(pts, cell_n, ["_cx", "_cy"]).checkpoint()

    # 2. neighbour counts of points in sparse cells
    sparse = pts.filter(F.col("_n") < min_points).select("_id", "_x", "_y", "_cx", "_cy")
    probe = _replicate(sparse, _OFFS25).select(
        "_id", "_x", "_y", F.col("_tx").alias("_cx"), F.col("_ty").alias("_cy"))
    other = pts.select(F.col("_x").alias("_ox"), F.col("_y").alias("_oy"), "_cx", "_cy", F.col("_id").alias("_oid"))
    pairs = salted_equi_join(other, probe, ["_cx", "_cy"], block_rows)
    counts = pairs.filter(dist_xy("_x", "_y", "_ox", "_oy") <= eps).groupBy("_id").agg(
        F.count(F.lit(1)).alias("_k"))
    sparse_core = counts.filter(F.col("_k") >= min_points).select("_id", F.lit(True).alias("_sc"))
    pts = pts.join(sparse_core, "_id", "left").withColumn(
        "_core", (F.col("_n") >= min_points) | F.coalesce(F.col("_sc"), F.lit(False))).drop("_sc")
    pts = pts.withColumn("_node", _node("_cx", "_cy")).checkpoint()
    core = pts.filter("_core")

    # 3. certain links between cells through adjacent half-cells
    subs = core.select("_sx", "_sy", "_node").distinct()
    rep = _replicate(subs, _OFFS8, "_sx", "_sy").select(
        F.col("_tx").alias("_sx"), F.col("_ty").alias("_sy"), F.col("_node").alias("_src"),
        _block(F.shiftright("_sx", 1), F.shiftright("_sy", 1)).alias("_sb"))
    links = key_join(rep, subs, ["_sx", "_sy"]).filter(F.col("_src") != F.col("_node")) \
        .select(F.col("_src").alias("src"), F.col("_node").alias("dst"), "_sb",
                _block(F.shiftright("_sx", 1), F.shiftright("_sy", 1)).alias("_db")).distinct()
    cells = core.select("_node", "_cx", "_cy").distinct()
    comp1 = blocked_components(links, "_sb", "_db")
    cells = cells.join(comp1.select(F.col("node").alias("_node"), F.col("component").alias("_c1")),
                       "_node", "left").withColumn("_c1", F.coalesce("_c1", "_node")).checkpoint()

    # 4. witness pairs between neighbouring cells of different components
    cand = _replicate(cells, _OFFS25).select(
        F.col("_cx").alias("_acx"), F.col("_cy").alias("_acy"), F.col("_c1").alias("_ca"),
        F.col("_tx").alias("_cx"), F.col("_ty").alias("_cy"))
    cell_pairs = key_join(cand, cells.select("_cx", "_cy", F.col("_c1").alias("_cb")), ["_cx", "_cy"]) \
        .filter(F.col("_ca") < F.col("_cb")) \
        .select("_acx", "_acy", F.col("_cx").alias("_bcx"), F.col("_cy").alias("_bcy"), "_ca", "_cb")
    # quarter-cell pairs of each candidate cell pair (at most 16 x 16):
    # certain when their boxes are within eps at every point, possible when
    # the boxes come within eps at all
    cq = core.select("_qx", "_qy", "_cx", "_cy").distinct()
    combos = key_join(cell_pairs, cq.select(F.col("_qx").alias("_qax"), F.col("_qy").alias("_qay"),
                                            F.col("_cx").alias("_acx"), F.col("_cy").alias("_acy")),
                      ["_acx", "_acy"])
    combos = key_join(combos, cq.select(F.col("_qx").alias("_qbx"), F.col("_qy").alias("_qby"),
                                        F.col("_cx").alias("_bcx"), F.col("_cy").alias("_bcy")),
                      ["_bcx", "_bcy"])
    dqx = F.abs(F.col("_qax") - F.col("_qbx"))
    dqy = F.abs(F.col("_qay") - F.col("_qby"))
    combos = combos.withColumn("_certain", (dqx + 1) * (dqx + 1) + (dqy + 1) * (dqy + 1) <= 32) \
        .withColumn("_possible", F.greatest(dqx - 1, F.lit(0)) * F.greatest(dqx - 1, F.lit(0))
                    + F.greatest(dqy - 1, F.lit(0)) * F.greatest(dqy - 1, F.lit(0)) <= 32).checkpoint()
    pair_keys = ["_acx", "_acy", "_bcx", "_bcy"]
    certain = combos.filter("_certain").select(*pair_keys, "_ca", "_cb").distinct()
    amb = combos.filter(F.col("_possible") & ~F.col("_certain")).join(certain.select(*pair_keys), pair_keys, "left_anti")
    a_pts = key_join(core.select("_x", "_y", F.col("_qx").alias("_qax"), F.col("_qy").alias("_qay")),
                     amb.select("_qax", "_qay", "_qbx", "_qby", "_ca", "_cb"), ["_qax", "_qay"])
    b_pts = core.select(F.col("_x").alias("_bx"), F.col("_y").alias("_by"),
                        F.col("_qx").alias("_qbx"), F.col("_qy").alias("_qby"))
    witness = key_join(a_pts, b_pts, ["_qbx", "_qby"]).filter(dist_xy("_x", "_y", "_bx", "_by") <= eps) \
        .select(F.col("_ca").alias("src"), F.col("_cb").alias("dst")) \
        .unionByName(certain.select(F.col("_ca").alias("src"), F.col("_cb").alias("dst"))).distinct()
    comp2 = connected_components(witness)
    cells = cells.join(comp2.select(F.col("node").alias("_c1"), F.col("component").alias("_c2")), "_c1", "left") \
        .withColumn("_comp", F.coalesce("_c2", "_c1")).select("_node", "_comp")

    # cluster id = smallest core id of the component
    # found per cell first, so components are joined on cells, not on points;
    # the one join back to the points is by cell, salted where a cell is hot
    least = core.groupBy("_node").agg(F.min("_id").alias("_least"))
    named = cells.join(least, "_node")
    cid = named.groupBy("_comp").agg(F.min("_least").alias("_cluster"))
    of_cell = named.join(cid, "_comp").select("_node", "_cluster")
    core_lab = salted_equi_join(core.select("_id", "_x", "_y", "_cx", "_cy", "_node"), of_cell, ["_node"], block_rows) \
        .select("_id", "_x", "_y", "_cx", "_cy", "_cluster").checkpoint()

    # 5. border points: smallest cluster among core points within eps
    noncore = pts.filter(~F.col("_core")).select("_id", "_x", "_y", "_cx", "_cy")
    probe = _replicate(noncore, _OFFS25).select(
        "_id", "_x", "_y", F.col("_tx").alias("_cx"), F.col("_ty").alias("_cy"))
    cores = core_lab.select(F.col("_x").alias("_ox"), F.col("_y").alias("_oy"), "_cx", "_cy", "_cluster",
                            F.col("_id").alias("_oid"))
    border = salted_equi_join(cores, probe, ["_cx", "_cy"], block_rows) \
        .filter(dist_xy("_x", "_y", "_ox", "_oy") <= eps) \
        .groupBy("_id").agg(F.min("_cluster").alias("_bcluster"))
    out = noncore.join(border, "_id", "left").select(
        "_id", "_x", "_y", F.coalesce("_bcluster", F.lit(-1).cast("bigint")).alias("cluster"),
        F.lit(False).alias("is_core"))
    out = out.unionByName(core_lab.select("_id", "_x", "_y", F.col("_cluster").cast("bigint").alias("cluster"),
                                          F.lit(True).alias("is_core")))
    out = out.unionByName(invalid.select("_id", "_x", "_y", F.lit(-1).cast("bigint").alias("cluster"),
                                         F.lit(False).alias("is_core")))
    return out.select(F.col("_id").alias(id_col), F.col("_x").alias(x), F.col("_y").alias(y),
                      "cluster", "is_core")


# --------------------------------------------------------------------------
# k-means
# --------------------------------------------------------------------------

def kmeans_fit(df: DataFrame, k: int = 2, seed: int = 0, sample_rows: int | None = None,
               x: str = "x", y: str = "y", id_col: str | None = None):
    """Fit k-means (pyspark.ml, k-means||) on float32 coordinates: on all
    rows, or on a seeded sample if ``sample_rows`` asks for one. Returns
    (model, the fitted rows with 'label')."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    from punktwerk.operators.aggs import sample_points
    data = df if sample_rows is None else sample_points(df, sample_rows, seed=seed, key=id_col)
    data = data.withColumn("_fx", F.col(x).cast("float")).withColumn("_fy", F.col(y).cast("float"))
    feats = VectorAssembler(inputCols=["_fx", "_fy"], outputCol="_features").transform(data)
    model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="label").fit(feats)
    labelled = model.transform(feats).drop("_features", "_fx", "_fy")
    return model, labelled


def kmeans_assign(df: DataFrame, centres: list[tuple[float, float]], x: str = "x", y: str = "y",
                  out: str = "label") -> DataFrame:
    """Nearest centre (ties -> lower index) as a Column expression; the
    centres are a driver-side list of k pairs."""
    best = F.lit(0)
    best_d = (F.col(x) - centres[0][0]) ** 2 + (F.col(y) - centres[0][1]) ** 2
    for i, (cx, cy) in enumerate(centres[1:], start=1):
        d_i = (F.col(x) - cx) ** 2 + (F.col(y) - cy) ** 2
        best = F.when(d_i < best_d, F.lit(i)).otherwise(best)
        best_d = F.least(best_d, d_i)
    return df.withColumn(out, best)


def label_join_back(all_rows: DataFrame, labelled: DataFrame, key: str, label: str = "label") -> DataFrame:
    """Attach labels computed on a subset back to every row (null elsewhere)."""
    return all_rows.join(labelled.select(key, label), key, "left")
