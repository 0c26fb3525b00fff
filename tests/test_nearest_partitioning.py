import math
import random

import pytest
from pyspark.sql import functions as F

from punktwerk.operators import nearest as N
from punktwerk.operators import partitioning as P
from punktwerk.plans import fixtures as X
from punktwerk.sources import tile_log as TL
from tests.conftest import SF_SMALL

nan = float("nan")


def cloud(seed, n, crowd=0):
    rng = random.Random(seed)
    pts = [(rng.uniform(0, 1000), rng.uniform(0, 300)) for _ in range(n)]
    pts += [(500 + rng.random(), 100 + rng.random()) for _ in range(crowd)] + [(7.0, 7.0)] * (crowd // 2)
    return [(i, x, y) for i, (x, y) in enumerate(pts)] + [(-1, None, 1.0), (-2, nan, 1.0), (-3, 1.0, nan)]


def frame(spark, rows, key="id"):
    return spark.createDataFrame(rows, f"{key} long, x double, y double").repartition(4)


def test_partitions_are_bounded_and_co_located(spark):
    rows = cloud(1, 1500, 1000)
    a, b = frame(spark, rows), frame(spark, rows[::3], "other")
    tree = P.split_tree([a], 100)
    dealt = P.deal(a, tree)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 100 + 4 and len(sizes) < 8 * len(rows) / 100
    assert sorted(r.id for r in dealt.collect()) == sorted(r[0] for r in rows)
    left, right, _ = P.co_partition(a, b, 100)
    joined = left.join(right, ["part_key", "x", "y"])
    want = a.join(b, ["x", "y"])
    assert sorted(map(tuple, joined.select("id", "other").collect())) == sorted(map(tuple, want.select("id", "other").collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = left.join(right, "part_key")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(part_key") == 2 and plan.count("Exchange hashpartitioning") == 2


def test_one_spot_and_no_rows(spark):
    spot = frame(spark, [(i, 5.0, 5.0) for i in range(90)])
    tree = P.split_tree([spot], 20)
    sizes = [r["count"] for r in P.deal(spot, tree).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 90 and tree.num_parts == 5 and max(sizes) <= 20 + 4
    none = spot.filter("id < 0")
    assert P.deal(none, P.split_tree([none], 20)).count() == 0


def brute(queries, points, k):
    out = []
    for q, x, y in queries:
        if x is None or math.isnan(x) or math.isnan(y):
            continue
        near = sorted((math.hypot(px - x, py - y), p) for p, px, py in points if px is not None and not math.isnan(px) and not math.isnan(py))
        out += [(q, p, i + 1) for i, (_, p) in enumerate(near[:k])]
    return sorted(out)


@pytest.mark.parametrize("k", [1, 40, 5000])
def test_knn_join_against_brute_force(spark, k):
    points = cloud(2, 600, 300)
    queries = cloud(3, 40) + [(900, 500.5, 100.5), (901, 7.0, 7.0), (902, -4000.0, 90.0), (903, 1e9, 1e9), (904, 500.2, 5000.0)]
    got = N.knn_join(frame(spark, queries, "q"), frame(spark, points, "p"), k, "q", "p")
    assert sorted((r.q, r.p, r["rank"]) for r in got.collect()) == brute(queries, points, k)


def test_knn_join_without_points(spark):
    some, none = frame(spark, cloud(1, 5), "q"), frame(spark, cloud(1, 5), "p").filter("p > 100")
    assert N.knn_join(some, none, 3, "q", "p").count() == 0
    assert N.knn_join(some.filter("q > 100"), frame(spark, cloud(1, 5), "p"), 3, "q", "p").count() == 0


def test_bounded_search(spark, tmpdir_path):
    points = cloud(5, 800, 200)
    df = frame(spark, points)
    df.write.parquet(f"{tmpdir_path}/p")
    stored = spark.read.parquet(f"{tmpdir_path}/p")
    boxes = N.cell_boxes(stored, 20.0)
    for k, x, y in ((10, 500.0, 100.0), (3, -500.0, 50.0), (5000, 1.0, 1.0)):
        out = N.knn_bounded(stored, k, x, y, "id", boxes)
        assert [r.id for r in out.collect()] == [p for _, p, _ in sorted(brute([(0, x, y)], points, k), key=lambda t: t[2])]
    plan = spark._jvm.PythonSQLUtils.explainString(N.knn_bounded(stored, 10, 500.0, 100.0, "id", boxes)._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(x," in plan and "LessThanOrEqual(y," in plan


def test_tiles_far_away_are_not_read(spark, tmpdir_path):
    table = f"{tmpdir_path}/t"
    p = X.pts(spark, SF_SMALL, with_source=True)
    TL.commit_points(p, table)
    zones = TL.zone_map(spark, table).withColumn("n", F.col("n_points"))
    r = N.radius(zones, 20, 281500.0, 5653500.0)
    window = TL.window_points(spark, table, (281500 - r, 5653500 - r, 281500 + r, 5653500 + r))
    assert len(window.inputFiles()) < zones.count() / 2
    got = N.knn_tiles(spark, table, 20, 281500.0, 5653500.0, "z", "intensity").select("x", "y", "z").collect()
    d = F.sqrt((F.col("x") - 281500.0) * (F.col("x") - 281500.0) + (F.col("y") - 5653500.0) * (F.col("y") - 5653500.0))
    assert got == p.orderBy(d, "z", "intensity").limit(20).select("x", "y", "z").collect()
    assert N.knn_tiles(spark, table, 10 ** 6, 0.0, 0.0).count() == p.count()
