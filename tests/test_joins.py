import random

from pyspark.sql import functions as F

from punktwerk.functions import geom as G
from punktwerk.operators import aggs as A
from punktwerk.operators import joins as J


def _testpoints(spark):
    # 1,000 points on a diagonal (i + 0.1, i + 100.1)
    return spark.createDataFrame([(i, i + 0.1, i + 100.1) for i in range(1, 1001)], "id long, x double, y double")


def test_testpoint_distance_join_and_extent(spark):
    p = _testpoints(spark)
    assert J.distance_join(p, p, 2.0).count() == 2998
    e = A.extent(p).first()
    assert (e.minx, e.miny, e.maxx, e.maxy, e.n) == (1.1, 101.1, 1000.1, 1100.1, 1000)


def distance_join_theta(left, right, d, x="x", y="y", inclusive=False, suffixes=("_a", "_b")):
    """Brute force: every pair, tested."""
    sa, sb = suffixes
    dist = G.dist_xy(x + sa, y + sa, x + sb, y + sb)
    cond = dist <= d if inclusive else dist < d
    return J._suffixed(left, sa).crossJoin(J._suffixed(right, sb)).filter(cond)


def _pairs(df, a="id_a", b="id_b"):
    return sorted((r[a], r[b]) for r in df.select(a, b).collect())


def test_grid_distance_join_equals_theta(spark):
    rnd = random.Random(1)
    pts = [(i, rnd.uniform(0, 300), rnd.uniform(0, 300)) for i in range(600)]
    pts += [(1000 + i, 150.0 + i * 1e-3, 150.0) for i in range(50)]   # one dense spot
    df = spark.createDataFrame(pts, "id long, x double, y double")
    for d, inc in ((7.5, False), (7.5, True), (20.0, False)):
        grid = J.distance_join(df, df, d, inclusive=inc, block_rows=3)   # salting active
        theta = distance_join_theta(df, df, d, inclusive=inc)
        assert _pairs(grid) == _pairs(theta)


def test_distance_join_plan_has_no_nested_loop(spark):
    df = _testpoints(spark)
    plan = J.distance_join(df, df, 2.0)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_spatial_join_multilevel_equals_brute_force(spark):
    rnd = random.Random(2)
    pts = spark.createDataFrame([(i, rnd.uniform(0, 1000), rnd.uniform(0, 1000)) for i in range(2000)],
                                "pid long, x double, y double")
    rects = [(1, 10.0, 10.0, 60.0, 40.0), (2, 0.0, 0.0, 1000.0, 1000.0), (3, 500.0, 500.0, 500.5, 900.0),
             (4, 100.0, 100.0, 700.0, 130.0)]
    shapes = spark.createDataFrame(rects, "rect_id long, minx double, miny double, maxx double, maxy double")
    for pred in ("covers", "contains"):
        got = sorted((r.rect_id, r.pid) for r in J.spatial_join(shapes, pts, pred, cell=20.0, max_cells=16,
                                                                block_rows=5).collect())
        exp = []
        for rid, x0, y0, x1, y1 in rects:
            for r in pts.collect():
                inside = (x0 <= r.x <= x1 and y0 <= r.y <= y1) if pred == "covers" else (x0 < r.x < x1 and y0 < r.y < y1)
                if inside:
                    exp.append((rid, r.pid))
        assert got == sorted(exp)


def test_spatial_join_polygon_shapes(spark):
    rnd = random.Random(4)
    pts = spark.createDataFrame([(i, rnd.uniform(0, 10), rnd.uniform(0, 10)) for i in range(500)],
                                "pid long, x double, y double")
    tri = "POLYGON ((1 1, 9 1, 5 8, 1 1))"
    shapes = spark.createDataFrame([(1, tri)], "sid long, wkt string").withColumn("geom", G.st_geomfromtext("wkt"))
    shapes = G.with_bbox(shapes, "geom")
    got = sorted(r.pid for r in J.spatial_join(shapes, pts, "contains", cell=2.0, geom="geom").collect())
    exp = sorted(r.pid for r in pts.filter(G.contains_literal(tri)).collect())
    assert got == exp and len(got) > 50


def test_shape_join_touches_equals_brute_force(spark):
    rects = [(1, 0.0, 0.0, 10.0, 10.0), (2, 10.0, 0.0, 20.0, 5.0), (3, 5.0, 5.0, 15.0, 15.0),
             (4, 20.0, 5.0, 30.0, 6.0), (5, 40.0, 40.0, 41.0, 41.0), (6, 10.0, 10.0, 12.0, 12.0)]
    df = spark.createDataFrame(rects, "rid long, minx double, miny double, maxx double, maxy double")
    got = _pairs(J.shape_join(df, df, cell=4.0, predicate="touches").filter("rid_a < rid_b"), "rid_a", "rid_b")
    exp = []
    for a in rects:
        for b in rects:
            if a[0] < b[0]:
                ix0, iy0, ix1, iy1 = max(a[1], b[1]), max(a[2], b[2]), min(a[3], b[3]), min(a[4], b[4])
                if ix0 <= ix1 and iy0 <= iy1 and (ix0 == ix1 or iy0 == iy1):
                    exp.append((a[0], b[0]))
    assert got == sorted(exp)


def test_range_query_pushes_bbox_to_parquet(spark, tmpdir_path):
    _testpoints(spark).write.parquet(f"{tmpdir_path}/p")
    df = J.range_query(spark.read.parquet(f"{tmpdir_path}/p"), (10, 100, 20, 200))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(x), IsNotNull(y), GreaterThanOrEqual(x,10.0)" in plan
    assert df.count() == 10


def test_knn_ties_by_id(spark):
    df = spark.createDataFrame([(3, 1.0, 0.0), (1, 0.0, 1.0), (2, 5.0, 5.0), (4, -1.0, 0.0)], "id long, x double, y double")
    assert [r.id for r in J.knn_point(df, 3, 0.0, 0.0, "id").collect()] == [1, 3, 4]


def test_shape_join_multilevel_equals_brute_force(spark):
    rnd = random.Random(8)
    rects = []
    for i in range(150):
        w = rnd.choice([1.0, 3.0, 10.0, 80.0, 300.0])
        x0, y0 = rnd.uniform(0, 500), rnd.uniform(0, 500)
        rects.append((i, x0, y0, x0 + w * rnd.random() + 0.5, y0 + w * rnd.random() + 0.5))
    rects.append((999, 0.0, 0.0, 1000.0, 1000.0))
    df = spark.createDataFrame(rects, "rid long, minx double, miny double, maxx double, maxy double")
    got = _pairs(J.shape_join(df, df, cell=2.0, max_cells=16), "rid_a", "rid_b")
    exp = sorted((a[0], b[0]) for a in rects for b in rects
                 if max(a[1], b[1]) <= min(a[3], b[3]) and max(a[2], b[2]) <= min(a[4], b[4]))
    assert got == exp


def test_distance_join_invalid_coordinates_match_nothing(spark):
    rows = [(1, 0.0, 0.0), (2, 0.5, 0.0)] + [(10 + i, None, None) for i in range(200)] \
        + [(500 + i, float("nan"), 1.0) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    j = J.distance_join(df, df, 1.0, block_rows=50)
    assert _pairs(j) == [(1, 1), (1, 2), (2, 1), (2, 2)]


def test_grid_partition_spreads_hot_cell(spark):
    rnd = random.Random(13)
    rows = [(i, 500.0 + rnd.random(), 500.0 + rnd.random()) for i in range(10000)]
    rows += [(20000 + i, rnd.uniform(0, 1000), rnd.uniform(0, 1000)) for i in range(20000)]
    df = spark.createDataFrame(rows, "pid long, x double, y double")
    g, cell = J.grid_partition(df, rows_per_cell=500, num_partitions=16, max_cell_rows=1000)
    from pyspark.sql import functions as F
    hot = g.filter(F.col("pid") < 10000).select(F.spark_partition_id().alias("p")).distinct().count()
    assert hot >= 8 and g.count() == 30000


def test_point_table_ddl(spark, tmpdir_path):
    import uuid

    from punktwerk.sources import sinks as SK
    name = f"t_{uuid.uuid4().hex[:8]}"
    SK.create_point_table(spark, name, location=f"{tmpdir_path}/t")
    cols = [r.col_name for r in SK.describe_table(spark, name).collect()]
    assert "source_file" in cols and "classification" in cols
    SK.drop_point_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_coincident_points_spread_over_tasks(spark):
    """A third of the rows at one place: hot by the product of both sides,
    dealt row by row, so several tasks carry the cell."""
    rows = [(i, 5.0, 5.0) for i in range(400)] + [(1000 + i, 20.0 * i, 0.0) for i in range(800)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    j = J.distance_join(df, df, 1.0, block_rows=40)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = j.filter("id_a < 1000 and id_b < 1000").withColumn("p", F.spark_partition_id())
        assert hot.count() == 400 * 400 and hot.select("p").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert _pairs(j) == _pairs(distance_join_theta(df, df, 1.0))


def test_shape_join_tests_the_shapes(spark):
    """Lines whose boxes meet although they never do."""
    lines = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 10.0), (2, 4.0, 1.0, 9.0, 2.0), (3, 0.0, 5.0, 10.0, 5.0)],
                                  "id long, x1 double, y1 double, x2 double, y2 double")
    s = G.with_bbox(lines.withColumn("geom", G.st_linestring("x1", "y1", "x2", "y2")), "geom")
    boxes = J.shape_join(s, s, cell=5.0)
    exact = J.shape_join(s, s, cell=5.0, geom="geom")
    assert (1, 2) in _pairs(boxes) and (1, 2) not in _pairs(exact)
    assert (1, 3) in _pairs(exact) and (3, 1) in _pairs(exact)


def test_join_is_spread_by_its_pairs(spark, monkeypatch):
    """one split and few bytes, yet many pairs: many tasks."""
    monkeypatch.setattr(J, "PAIRS_PER_TASK", 500)
    rows = [(i, (i % 4) * 10.0, 0.0, (i % 4) * 10.0 + 10.0, 8.0) for i in range(120)] + [(120, None, 0.0, 1.0, 1.0)]
    r = spark.createDataFrame(rows, "id long, minx double, miny double, maxx double, maxy double").coalesce(1)
    for block in (5, 5000):
        j = J.shape_join(r, r, cell=10.0, predicate="touches", block_rows=block)
        assert j.rdd.getNumPartitions() > 20
        want = sorted((a[0], b[0]) for a in rows[:-1] for b in rows[:-1] if abs(a[1] - b[1]) == 10.0)
        assert _pairs(j) == want


def test_wide_distance_join_with_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(J, "PAIRS_PER_TASK", 50)
    nan = float("nan")
    rows = [(i, i % 7 + 0.25, i % 5 - 2.5) for i in range(60)] + [(60, None, 1.0), (61, nan, 1.0), (62, 1.0, None), (60, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    j = J.distance_join(df, df, 2.0)
    assert "REPARTITION_BY_NUM" in j._jdf.queryExecution().executedPlan().toString()
    assert _pairs(j) == _pairs(distance_join_theta(df.filter("x is not null and y is not null and not isnan(x)"),
                                                   df.filter("x is not null and y is not null and not isnan(x)"), 2.0))


def test_cheap_tests_of_a_shape_join_come_first(spark):
    """the cell and the caller's condition are tested before the shapes."""
    rows = [(i, float(i % 9), float(i % 7), float(i * 5 % 11), float(i * 3 % 8)) for i in range(60)]
    raw = spark.createDataFrame(rows, "id long, x1 double, y1 double, x2 double, y2 double")
    g = G.with_bbox(raw.withColumn("geom", G.st_linestring("x1", "y1", "x2", "y2")), "geom").select("id", "geom", "minx", "miny", "maxx", "maxy")
    every = J.shape_join(g, g, cell=2.0, geom="geom")
    half = J.shape_join(g, g, cell=2.0, geom="geom", only=F.col("id_a") < F.col("id_b"))
    assert _pairs(half) == [p for p in _pairs(every) if p[0] < p[1]]
    cond = half._jdf.queryExecution().analyzed().toString()
    assert 0 <= cond.index("id_a#") and cond.index("_cx") < cond.index("exists(")


def test_rows_are_shipped_once_a_tile(spark, monkeypatch):
    """copies for the cells are made behind the exchange; full cells are
    dealt in blocks, beside the others."""
    monkeypatch.setattr(J, "PAIRS_PER_TASK", 100)
    nan = float("nan")
    rows = [(i, i * 0.37 % 9 - 4, i * 0.73 % 7 - 3) for i in range(150)] + [(500 + i, 2.5, 2.5) for i in range(70)]
    odd = [(3, 2.5, 2.5), (None, 2.5, 2.5), (900, None, 1.0), (901, nan, 1.0), (902, 1.0, None)]
    df = spark.createDataFrame(rows + odd, "id long, x double, y double")
    placed = df.filter("x is not null and y is not null and not isnan(x)")
    want = placed.count()
    for block, split in ((5000, False), (3, True)):
        j = J.distance_join(df, placed.withColumnRenamed("id", "no"), 1.0, block_rows=block)
        assert j.columns == ["id_a", "x_a", "y_a", "no_b", "x_b", "y_b"]
        text = j._jdf.queryExecution().optimizedPlan().toString()
        assert text.index("collect_list") < text.index("RepartitionByExpression") < text.index("Union", text.index("collect_list"))
        assert ("LeftAnti" in text) == split
        theta = distance_join_theta(placed, placed.withColumnRenamed("id", "no"), 1.0)
        key = lambda t: sorted(map(str, t.select("id_a", "no_b").collect()))
        assert key(j) == key(theta) and j.count() > want


def test_pairs_of_a_cell_are_walked_in_shares(spark, monkeypatch):
    """what waits between two operators is a share's pairs, not a cell's."""
    monkeypatch.setattr(J, "PAIRS_PER_TASK", 100)
    rows = [(i, i * 0.37 % 9 - 4, i * 0.73 % 7 - 3) for i in range(150)] + [(None, 2.5, 2.5)] * 3
    df = spark.createDataFrame(rows, "id long, x double, y double").withColumn("x2", F.col("x") * 2)
    key = lambda t: sorted(map(str, t.select("id_a", "x2_a", "id_b", "x2_b").collect()))
    want = key(distance_join_theta(df, df, 1.0))
    plans = set()
    for waiting, shares in ((1, 1024), (1, 2), (40, 1024), (100_000, 1024)):
        monkeypatch.setattr(J, "PAIRS_WAITING", waiting)
        monkeypatch.setattr(J, "MAX_SHARES", shares)
        j = J.distance_join(df, df, 1.0)
        assert key(j) == want
        plans.add("slice(_ls" in j._jdf.queryExecution().optimizedPlan().toString())
    assert plans == {True}


def test_grouped_join_ships_no_pairs(spark, monkeypatch):
    """rows are grouped per cell of points, not per pair; keys that
    repeat share a list, blocks of shapes lose nothing."""
    rows = [(i * 0.37 % 9 - 4, i * 0.73 % 7 - 3) for i in range(300)] + [(2.5, 2.5)] * 3 + [(None, 1.0), (float("nan"), 1.0)]
    pts = spark.createDataFrame(rows, "x double, y double")
    rects = [(i, i % 5 - 4.0, i % 3 - 3.0, i % 5 - 4 + 1.0 + i % 4, i % 3 - 1.5 + i % 2) for i in range(40)]
    rects += [(7, -4.0, -3.0, 5.0, 4.0), (7, 2.5, 2.5, 2.5, 2.5), (None, 0.0, 0.0, 3.0, 3.0), (99, 50.0, 50.0, 60.0, 60.0), (98, 3.0, 3.0, 1.0, 1.0)]
    shapes = spark.createDataFrame(rects, "rect_id long, minx double, miny double, maxx double, maxy double")
    for tests, predicate in ((J.TESTS_PER_TASK, "covers"), (40, "covers"), (40, "contains")):
        monkeypatch.setattr(J, "TESTS_PER_TASK", tests)
        got = J.spatial_join_grouped(shapes, pts, "rect_id", chunk_cell=2.5, predicate=predicate, cell=2.0)
        pairs = J.with_grid(J.spatial_join(shapes, pts, predicate, cell=2.0), 2.5, names=("chunk_x", "chunk_y"))
        want = pairs.groupBy("rect_id", "chunk_x", "chunk_y").agg(
            F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.struct("x", "y"))).alias("points"))
        assert got.schema.simpleString() == want.schema.simpleString()
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 60
        text = got._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate [_kx" in text and "Aggregate [rect_id" not in text


def test_grouped_join_holds_one_shape_beside_the_list(spark):
    """a chunk's list isn't repeated for its shapes within one operator;
    strips lose nothing, whatever the points show and the shapes are."""
    rows = [(i, i * 0.37 % 9 - 4, i * 0.73 % 7 - 3) for i in range(200)] + [(200, 2.5, 2.5)] * 3 + [(None, 1.0, 1.0), (201, None, 1.0)]
    pts = spark.createDataFrame(rows, "id long, x double, y double")
    rects = [(i % 30, i % 5 - 4.0, i % 3 - 3.0, i % 5 - 4 + 1.0 + i % 4, i % 3 - 1.5 + i % 2) for i in range(35)] + [(98, 3.0, 3.0, 1.0, 1.0)]
    s = spark.createDataFrame(rects, "rect_id long, minx double, miny double, maxx double, maxy double")
    s = s.withColumn("geom", G.st_geomfromtext(F.format_string(
        "POLYGON ((%1$s %2$s, %3$s %2$s, %1$s %4$s, %1$s %2$s))", "minx", "miny", "maxx", "maxy")))
    pts = pts.withColumn("u", F.col("x"))
    for cols, geom, predicate in ((("u", "y", "x"), None, "covers"), (("u", "y", "id"), "geom", "contains"), (("x", "y"), "geom", "covers")):
        got = J.spatial_join_grouped(s, pts, "rect_id", cols, 2.5, predicate, 2.0, geom=geom)
        pairs = J.with_grid(J.spatial_join(s, pts, predicate, cell=2.0, geom=geom), 2.5, names=("chunk_x", "chunk_y"))
        want = pairs.groupBy("rect_id", "chunk_x", "chunk_y").agg(
            F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.struct(*cols))).alias("points"))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(_qs" not in plan and "shuffle_hash" in plan


def test_wide_shape_join_walks_lists_of_shapes(spark, monkeypatch):
    monkeypatch.setattr(J, "PAIRS_PER_TASK", 50)
    rnd = random.Random(8)
    pts = [(i, float(rnd.randint(0, 40)), float(rnd.randint(0, 40))) for i in range(200)]
    pts += pts[:5] + [(300, None, 3.0), (301, 3.0, None), (302, float("nan"), 3.0)] + [(400 + i, 90.0, 90.0) for i in range(30)]  # a full cell beside all shapes
    rects = [(i, x, y, x + 4.0 * (1 + i % 3), y + 6.0) for i in range(40) for x, y in [(float(rnd.randint(0, 35)), float(rnd.randint(0, 35)))]]
    rects += [rects[0], rects[0], (77, 0.0, 0.0, 40.0, 40.0), (78, -50.0, -50.0, -49.0, -49.0), (None, 1.0, 1.0, 9.0, 9.0)]
    p = spark.createDataFrame(pts, "id long, x double, y double")
    s = spark.createDataFrame(rects, "rid long, minx double, miny double, maxx double, maxy double")
    g = s.withColumn("geom", G.st_geomfromtext(F.format_string(
        "POLYGON ((%1$s %2$s, %3$s %2$s, %3$s %4$s, %1$s %4$s, %1$s %2$s))", "minx", "miny", "maxx", "maxy")))
    for predicate, bad in (("covers", 0), ("contains", 1)):
        def hit(r, q):
            inside = r[1] <= q[1] <= r[3] and r[2] <= q[2] <= r[4]
            return inside and not (bad and (q[1] in (r[1], r[3]) or q[2] in (r[2], r[4])))
        exp = sorted((-1 if r[0] is None else r[0], q[0]) for r in rects for q in pts if None not in q and hit(r, q))
        for block_rows in (3, 5_000):   # 3: blocks on both sides
            j = J.spatial_join(s, p, predicate, cell=20.0, max_cells=8, block_rows=block_rows)
            assert j.columns == [*p.columns, *s.columns]
            assert sorted((-1 if r.rid is None else r.rid, r.id) for r in j.collect()) == exp
            plan = j._jdf.queryExecution().executedPlan().toString()
            # no row is made of a pair before its test
            assert "inline(" in plan and "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan.split("inline(")[0]
        j = J.spatial_join(g, p, predicate, cell=20.0, max_cells=8, geom="geom").select("rid", "id")
        assert sorted((-1 if r.rid is None else r.rid, r.id) for r in j.collect()) == exp


def test_wide_shape_join_keeps_equal_names_apart(spark, monkeypatch):
    monkeypatch.setattr(J, "PAIRS_PER_TASK", 1)
    p = spark.createDataFrame([(i, i + 0.5, i + 0.5) for i in range(20)], "id long, x double, y double")
    s = spark.createDataFrame([(100, 0.0, 0.0, 9.0, 9.0)], "id long, minx double, miny double, maxx double, maxy double")
    rows = [tuple(r)[::3] for r in J.spatial_join(s, p, cell=4.0).collect()]
    assert sorted(r[:2] for r in rows) == [(i, 100) for i in range(9)]
