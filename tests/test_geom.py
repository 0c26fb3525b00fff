import math

import pytest
from pyspark.sql import functions as F

from punktwerk.functions import geom as G
from punktwerk.functions import geojson as GJ
from punktwerk.functions import wkb as WKB
from punktwerk.operators import aggs as A
from punktwerk.plans import fixtures as X

# The five sample points printed with the reference's point table.
README_POINTS = [(280000.00, 5652013.19, 59.88, 2), (280000.00, 5652013.48, 59.93, 2),
                 (280000.32, 5652013.23, 59.89, 2), (280000.59, 5652013.26, 59.88, 2),
                 (280000.32, 5652013.52, 60.06, 20)]


def test_region_stats_boundary_points_are_outside(spark):
    df = spark.createDataFrame(README_POINTS, "x double, y double, z double, classification int")
    r = A.region_stats(df, X.REGION_WKT).first()
    assert r.total_points == 3 and r.ground_points == 2
    assert r.min_z == 59.88 and r.max_z == 60.06
    assert abs(r.avg_z - 59.943333) < 1e-6


def test_region_stats_closed_counts_boundary(spark):
    df = spark.createDataFrame(README_POINTS, "x double, y double, z double, classification int")
    assert A.region_stats(df, X.REGION_WKT, boundary=True).first().total_points == 5


def test_wkt_parse_polygon_with_hole_and_area(spark):
    df = spark.createDataFrame([(X.POLY1_WKT,), (X.POLY2_WKT,)], "wkt string")
    rows = df.select(G.st_geomfromtext("wkt").alias("g")).select(
        F.col("g.gtype"), F.size(F.get("g.parts", 0)).alias("rings"), G.st_area("g").alias("a")).collect()
    assert [(r.gtype, r.rings) for r in rows] == [("POLYGON", 2), ("POLYGON", 1)]
    assert [r.a for r in rows] == [5500000.0, 4800000.0]


@pytest.mark.parametrize("wkt", [
    "POINT (1 2)", "LINESTRING (0 0, 1 1, 2 0)", "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 2, 2 2, 1 1))",
    "MULTIPOINT ((1 2), (3 4))", "MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))",
    "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5), (5.2 5.1, 5.8 5.1, 5.8 5.7, 5.2 5.1)))",
    "POLYGON EMPTY"])
def test_wkt_text_roundtrip(spark, wkt):
    out = spark.createDataFrame([(wkt,)], "w string").select(
        G.st_astext(G.st_geomfromtext("w")).alias("t")).first().t
    assert out == G.parse_wkt_literal(wkt).wkt()
    assert G.parse_wkt_literal(out) == G.parse_wkt_literal(wkt)


@pytest.mark.parametrize("bad", ["POLYGON ((0 0, 1 x, 1 1, 0 0))", "CIRCLE (1 2)", "POLYGON ((0 0, 1 1)", "nonsense"])
def test_wkt_invalid_is_null(spark, bad):
    assert spark.createDataFrame([(bad,)], "w string").select(G.st_geomfromtext("w").alias("g")).first().g is None


def test_contains_column_form_equals_literal_form(spark):
    import random
    rnd = random.Random(7)
    pts = [(280900 + rnd.random() * 7300, 5652100 + rnd.random() * 3600) for _ in range(3000)]
    # exact vertices and edge points of polygon 1 as boundary cases
    pts += [(281000.0, 5653000.0), (282500.0, 5654000.0), (281500.0, 5653500.0), (283000.0, 5652500.0)]
    df = spark.createDataFrame(pts, "x double, y double").withColumn("g", G.shape_literal(X.POLY1_WKT))
    rows = df.select(G.st_contains_xy("g", "x", "y").alias("a"), G.contains_literal(X.POLY1_WKT).alias("b"),
                     G.st_covers_xy("g", "x", "y").alias("c"),
                     G.contains_literal(X.POLY1_WKT, boundary=True).alias("d")).collect()
    assert all(r.a == r.b and r.c == r.d for r in rows)
    # the four boundary points are covered but not contained
    assert [(r.a, r.c) for r in rows[-4:]] == [(False, True)] * 4


def test_distance_point_polygon_and_segments(spark):
    df = spark.createDataFrame([(0.0, 0.0), (2.0, 2.0), (6.0, 2.0), (2.0, -3.0)], "x double, y double")
    sq = G.shape_literal("POLYGON ((1 1, 4 1, 4 4, 1 4, 1 1))")
    d = [r.d for r in df.select(G.st_distance_xy(sq, "x", "y").alias("d")).collect()]
    assert d[0] == pytest.approx(math.sqrt(2)) and d[1] == 0.0 and d[2] == 2.0 and d[3] == 4.0


def test_intersects_and_envelope(spark):
    df = spark.createDataFrame([("LINESTRING (0 0, 10 10)", "POLYGON ((4 0, 6 0, 6 2, 4 2, 4 0))"),
                                ("LINESTRING (0 5, 3 5)", "POLYGON ((4 0, 6 0, 6 2, 4 2, 4 0))"),
                                ("LINESTRING (4 2, 3 5)", "POLYGON ((4 0, 6 0, 6 2, 4 2, 4 0))")], "a string, b string")
    out = df.select(G.st_intersects(G.st_geomfromtext("a"), G.st_geomfromtext("b")).alias("i"),
                    G.st_envelope(G.st_geomfromtext("a")).alias("e")).collect()
    assert [r.i for r in out] == [False, False, True]
    assert tuple(out[0].e) == (0.0, 0.0, 10.0, 10.0)


def test_geojson_and_wkb_roundtrip(spark):
    wkts = ["POINT (1 2)", "LINESTRING (0 0, 1 1)", "POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))",
            "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))", "MULTIPOINT ((1 2), (3 4))"]
    df = spark.createDataFrame([(w,) for w in wkts], "w string").select(G.st_geomfromtext("w").alias("g"))
    back = df.select(G.st_astext(GJ.st_geomfromgeojson(GJ.st_asgeojson("g"))).alias("j"),
                     G.st_astext(WKB.st_geomfromwkb(WKB.st_asbinary("g"))).alias("b"),
                     G.st_astext("g").alias("t")).collect()
    assert all(r.j == r.t and r.b == r.t for r in back)


def test_geojson_feature_sample_with_trailing_comma(spark, tmpdir_path):
    from punktwerk.sources.shapes import read_geojson
    ring = [[-87.0 + i * 0.01, 31.0 + (i % 3) * 0.01] for i in range(28)] + [[-87.0, 31.0]]
    line = ('{"type":"Feature","properties":{"STATEFP":"01","COUNTYFP":"077","NAME":"Lauderdale","A":"1","B":"2",'
            '"C":"3","D":"4","E":"5","F":"6","G":"7"},"geometry":{"type":"Polygon","coordinates":[' + str(ring) + ']}},')
    with open(f"{tmpdir_path}/f.json", "w") as f:
        f.write(line + "\n")
    df = read_geojson(spark, tmpdir_path)
    r = df.select(F.size("properties").alias("np"), G.st_numpoints("geom").alias("nv")).first()
    assert r.np == 10 and r.nv == 29


def test_region_stats_pushes_bbox_to_parquet(spark, tmpdir_path):
    spark.createDataFrame(README_POINTS, "x double, y double, z double, classification int") \
        .write.parquet(f"{tmpdir_path}/pts")
    df = A.region_stats(spark.read.parquet(f"{tmpdir_path}/pts"), X.POLY2_WKT)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "LessThan(x,288000.0)" in plan


def test_wkt_is_matched_as_a_whole(spark):
    good = ["POINT (1 2)", "point(1 2)", "POINT Z(1 2 3)", "POINT Z (1 2 3)", "LINESTRING (0 0, 1e1 -2.5)", "POLYGON ((0 0, 1 0, 1 1, 0 0))",
            "POLYGON((0 0,4 0,4 4,0 0),(1 1,2 1,2 2,1 1))", "MULTIPOINT ((1 2), (3 4))", "MULTIPOINT (1 2, 3 4)",
            "MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))", "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))", "POLYGON EMPTY"]
    bad = ["POINT )1 2(", "POINT (1 2) garbage", "POLYGON ((0 0, 1 0, 1 1))", "POLYGON ((0 0, 1 0, 1 1, 0 1))", "LINESTRING (1 2)",
           "POINT (1 2, 3 4)", "POINT (1)", "POINT (a b)", "CIRCLE (1 2)", "POLYGON (0 0, 1 0, 1 1, 0 0)", "", "POINT ((1 2))", "x POINT (1 2)"]
    from punktwerk.functions.sql import register_sql_functions
    register_sql_functions(spark)
    df = spark.createDataFrame([(t, True) for t in good] + [(t, False) for t in bad], "t string, ok boolean")
    for r in df.select("t", "ok", G.st_geomfromtext("t").alias("g"), F.expr("st_geomfromtext(t)").alias("s")).collect():
        assert (r.g is not None) == r.ok, r.t
        assert r.g == r.s, r.t


def test_sql_functions_like_the_columns(spark):
    from punktwerk.functions.sql import register_sql_functions
    register_sql_functions(spark)
    texts = ["POINT (5 5)", "POINT (12 5)", "LINESTRING (-5 5, 20 6)", "LINESTRING (20 20, 30 20)", "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))",
             "POLYGON ((20 0, 30 0, 30 10, 20 10, 20 0))", "POLYGON ((2 2, 3 2, 3 3, 2 3, 2 2))", "MULTIPOINT ((1 1), (40 40))",
             "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))"]
    g = spark.createDataFrame([(t,) for t in texts], "t string").select("t", G.st_geomfromtext("t").alias("g"))
    j = g.selectExpr("t as ta", "g as a").crossJoin(g.selectExpr("t as tb", "g as b"))
    got = j.select("ta", "tb", F.expr("st_distance(a, b)").alias("ds"), G.st_distance("a", "b").alias("dc"),
                   F.expr("st_intersects(a, b)").alias("i"), G.st_intersects("a", "b").alias("ic"), F.expr("st_astext(a)").alias("w")).collect()
    for r in got:
        assert abs(r.ds - r.dc) < 1e-9 and r.i == r.ic and r.w == r.ta, (r.ta, r.tb, r.ds, r.dc)
    row = spark.sql("select st_distance(st_geomfromtext('POINT (5 12)'), st_geomfromtext('POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))')) as beside, "
                    "st_distance(st_geomfromtext('POINT (5 5)'), st_geomfromtext('POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))')) as inside, "
                    "st_astext(st_geomfromgeojson('{\"type\":\"Point\",\"coordinates\":[1.5,2]}')) as j, "
                    "st_astext(st_shapefromwkb('0101000000000000000000F03F0000000000000040')) as b, "
                    "st_transform(st_point(280000d, 5652000d), 'epsg:25832', 'epsg:4326') as t").first()
    assert row.beside == 2.0 and row.inside == 0.0 and row.j == "POINT (1.5 2)" and row.b == "POINT (1 2)"
    from punktwerk.functions.crs import st_transform
    want = spark.range(1).select(st_transform(F.lit(280000.0), F.lit(5652000.0), 25832, 4326).alias("p")).first().p
    assert abs(row.t.parts[0][0][0].x - want.x) < 1e-12 and abs(row.t.parts[0][0][0].y - want.y) < 1e-12


def test_two_segments_meet_as_shapes_do(spark):
    """the short test of two segments agrees with the general one."""
    pts = [(0.0, 0.0), (2.0, 2.0), (1.0, 1.0), (0.0, 2.0), (2.0, 0.0), (3.0, 3.0)]
    rows = [(*p, *q, *r, *s) for p in pts for q in pts for r in pts[:4] for s in pts[2:]]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double, g double, h double")
    one, two = G.st_linestring("a", "b", "c", "d"), G.st_linestring("e", "f", "g", "h")
    df = df.select(one.alias("one"), two.alias("two"))
    assert df.filter(~G.st_intersects("one", "two").eqNullSafe(G._shapes_intersect(F.col("one"), F.col("two")))).count() == 0
    assert df.filter(G.st_intersects("one", "two")).count() not in (0, len(rows))


def test_rounded_equals_round(spark):
    """to the last bit, ties and odd values too."""
    import random
    rnd = random.Random(3)
    vals = [rnd.uniform(-60, 60) for _ in range(4000)] + [(k + 0.5) / 1e6 for k in range(-500, 500)] + [k / 1e7 for k in range(300)]
    vals += [rnd.uniform(-1, 1) * 10 ** rnd.randint(-12, 18) for _ in range(2000)]
    vals += [0.0, -0.0, 2.5, -2.5, 1e300, -1e300, 5e-324, 0.4999995, 49.9999995, float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    for digits in (0, 3, 6):
        got = df.select("v", G.rounded("v", digits).alias("a"), F.round("v", digits).alias("b"))
        assert got.filter(~F.col("a").cast("string").eqNullSafe(F.col("b").cast("string"))).collect() == [] and got.filter("a is null").count() == 1
