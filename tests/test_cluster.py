import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from punktwerk.operators import cluster as CL
from punktwerk.operators import graph
from punktwerk.operators import hull as HU


def brute_dbscan(pts, eps, minp):
    ids = np.array([p[0] for p in pts])
    xy = np.array([[p[1], p[2]] for p in pts])
    d = np.sqrt(((xy[:, None, :] - xy[None, :, :]) ** 2).sum(-1))
    nb = d <= eps
    core = nb.sum(1) >= minp
    lab = {}
    for i in np.argsort(ids):
        if not core[i] or ids[i] in lab:
            continue
        comp, stack = [i], [i]
        seen = {i}
        while stack:
            j = stack.pop()
            for k in np.nonzero(nb[j] & core)[0]:
                if k not in seen:
                    seen.add(k)
                    stack.append(k)
                    comp.append(k)
        cid = min(ids[c] for c in comp)
        for c in comp:
            lab[ids[c]] = cid
    out = {}
    for i in range(len(ids)):
        if core[i]:
            out[ids[i]] = (lab[ids[i]], True)
        else:
            cs = [lab[ids[k]] for k in np.nonzero(nb[i] & core)[0]]
            out[ids[i]] = (min(cs) if cs else -1, False)
    return out


@pytest.mark.parametrize("seed,eps,minp", [(0, 5.0, 4), (1, 3.0, 6), (2, 8.0, 10)])
def test_dbscan_equals_brute_force(spark, seed, eps, minp):
    rnd = random.Random(seed)
    pts = []
    for c in range(6):
        cx, cy = rnd.uniform(0, 200), rnd.uniform(0, 200)
        for _ in range(rnd.randint(5, 60)):
            pts.append((cx + rnd.gauss(0, 4), cy + rnd.gauss(0, 4)))
    pts += [(rnd.uniform(0, 200), rnd.uniform(0, 200)) for _ in range(150)]
    pts += [(100.0 + 0.01 * i, 100.0) for i in range(40)]   # a dense cell
    rows = [(i * 7 + 3, x, y) for i, (x, y) in enumerate(pts)]
    df = spark.createDataFrame(rows, "pid long, x double, y double")
    got = {r.pid: (r.cluster, r.is_core) for r in CL.dbscan(df, eps, minp, block_rows=3).collect()}
    assert got == brute_dbscan(rows, eps, minp)


def test_connected_components_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101), (102, 101)], "src long, dst long")
    comp = {r.node: r.component for r in graph.connected_components(edges).collect()}
    assert all(comp[i] == 1 for i in range(1, 61)) and comp[102] == 100 and comp[101] == 100


def test_convex_hull_and_degenerate(spark):
    rnd = random.Random(5)
    pts = [(1, rnd.uniform(0, 10), rnd.uniform(0, 10)) for _ in range(3000)]
    pts += [(1, 0.0, 0.0), (1, 10.0, 0.0), (1, 10.0, 10.0), (1, 0.0, 10.0)]
    pts += [(2, float(i), 2.0 * i) for i in range(5)]     # collinear
    pts += [(3, 1.0, 1.0), (3, 1.0, 1.0)]                 # coincident
    df = spark.createDataFrame(pts, "g long, x double, y double")
    out = {r.g: r for r in HU.convex_hull(df, "g", rows_per_task=500).collect()}
    assert out[1].gtype == "POLYGON" and out[1].n_vertices == 4 and out[1].area == pytest.approx(100.0)
    assert out[2].gtype == "LINESTRING" and out[2].area == 0.0
    assert out[3].gtype == "POINT" and out[3].n_vertices == 1


def test_kmeans_assign_and_fit(spark):
    df = spark.createDataFrame([(i, float(i % 2) * 100 + i * 1e-3, 0.0) for i in range(200)], "pid long, x double, y double")
    lab = {r.pid: r.label for r in CL.kmeans_assign(df, [(0.0, 0.0), (100.0, 0.0)]).collect()}
    assert all(lab[i] == i % 2 for i in range(200))
    model, sample = CL.kmeans_fit(df, k=2, seed=0, sample_rows=100, id_col="pid")
    assert sample.count() == 100 and len(model.clusterCenters()) == 2


def test_sample_threshold_path_equals_ordered_limit(spark):
    from pyspark.sql import functions as F

    from punktwerk.operators import aggs as A
    df = spark.range(60000).withColumnRenamed("id", "pid")
    got = sorted(r.pid for r in A.sample_points(df, 20000, seed=3, key="pid").collect())
    h = F.md5(F.concat_ws("|", F.col("pid").cast("string"), F.lit("3")))
    exp = sorted(r.pid for r in df.orderBy(h).limit(20000).collect())
    assert got == exp


def test_describe_quartiles_exact(spark):
    import random

    from punktwerk.operators import aggs as A
    rnd = random.Random(9)
    vals = [rnd.uniform(0, 100) for _ in range(5001)] + [None] * 7
    df = spark.createDataFrame([(v,) for v in vals], "z double").repartition(7)
    out = {r.stat: r.value for r in A.describe_points(df, ("z",)).collect()}
    arr = np.array([v for v in vals if v is not None])
    for stat, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        assert out[stat] == pytest.approx(round(float(np.quantile(arr, q)), 6), abs=1e-6)
    assert out["count"] == 5001.0


def test_dbscan_hot_cell_third_of_rows(spark):
    """A third of all points in one cell: the dense cell is all core with no
    distance tests, so the run stays fast and the cell is one cluster."""
    import time
    rnd = random.Random(11)
    n = 30000
    hot = [(i, 500.0 + rnd.random(), 500.0 + rnd.random()) for i in range(n // 3)]
    rest = [(n + i, rnd.uniform(0, 2000), rnd.uniform(0, 2000)) for i in range(2 * n // 3)]
    df = spark.createDataFrame(hot + rest, "pid long, x double, y double").repartition(8)
    t = time.time()
    out = CL.dbscan(df, 5.0, 10, block_rows=500)
    labels = {r.pid: r.cluster for r in out.filter(F.col("pid") < n // 3).select("pid", "cluster").collect()}
    assert time.time() - t < 120
    assert set(labels.values()) == {0} and len(labels) == n // 3


def test_dbscan_dense_blobs_across_a_gap(spark):
    """Two dense blobs two cells apart, closer than eps, nothing between:
    linked through quarter-cells (and points) exactly like brute force."""
    rnd = random.Random(12)
    eps, minp = 10.0, 5
    cell = eps / (2 ** 0.5)
    rows, pid = [], 0
    for cx0 in (0.0, 2 * cell):
        for _ in range(60):
            rows.append((pid, cx0 + cell * (0.05 + 0.9 * rnd.random()), 3.0 + rnd.random()))
            pid += 1
    rows += [(1000 + i, 300.0 + 2.0 * i, 300.0) for i in range(8)]
    df = spark.createDataFrame(rows, "pid long, x double, y double")
    got = {r.pid: (r.cluster, r.is_core) for r in CL.dbscan(df, eps, minp).collect()}
    assert got == brute_dbscan(rows, eps, minp)


def test_dbscan_invalid_coordinates_are_noise(spark):
    rows = [(i, float(i % 3) * 0.1, 0.0) for i in range(12)] + [(100, None, 1.0), (101, float("nan"), 2.0)]
    df = spark.createDataFrame(rows, "pid long, x double, y double")
    got = {r.pid: r.cluster for r in CL.dbscan(df, 1.0, 5).collect()}
    assert got[100] == -1 and got[101] == -1 and len(got) == 14
    assert {got[i] for i in range(12)} == {0}


def test_approx_counts_and_describe_approx(spark):
    from punktwerk.operators import aggs as A
    df = spark.range(20000).selectExpr("cast(id % 5000 as double) as x", "cast(id % 7 as double) as y")
    r = A.approx_counts(df).first()
    assert r.n_rows == 20000 and abs(r.approx_distinct - 20000) / 20000 < 0.05   # (x, y) pairs are all distinct
    out = {(row.col_name, row.stat): row.value for row in A.describe_points_approx(df, ("x",)).collect()}
    assert out[("x", "count")] == 20000.0 and abs(out[("x", "p50")] - 2500) <= 5


def test_buckets_of_values_with_outliers(spark):
    """Far values don't gather the others in one bucket; buckets grow with
    the values, so the quartiles stay exact."""
    from punktwerk.operators import aggs as A
    v = [i / 7 for i in range(3000)] + [1e9, 1e12, -1e15, 2e9] + [5.0] * 500
    df = spark.createDataFrame([(x,) for x in v], "z double")
    values = df.groupBy("z").agg(F.count("*").alias("m")).select(F.lit("z").alias("col_name"), F.col("z").alias("v"), "m")
    dev = values.groupBy("col_name").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    rows = sorted((r.v, r.b) for r in A.value_buckets(values, dev).collect())
    assert [b for _, b in rows] == sorted(b for _, b in rows) and len(rows) == 3004
    assert max(np.bincount([b for _, b in rows])) <= 2 * 3004 / 256
    out = {r.stat: r.value for r in A.describe_points(df, ("z",)).collect()}
    assert [out[k] for k in ("min", "p25", "p50", "p75", "max")] == [round(float(q), 6) for q in np.quantile(v, [0, 0.25, 0.5, 0.75, 1])]
    some = spark.createDataFrame([(float("inf"),), (1.0,), (2.0,), (float("-inf"),)], "z double")
    assert A.describe_points(some, ("z",)).count() == 8
