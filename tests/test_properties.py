"""Property tests (hypothesis); each example is batched into one Spark job."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from punktwerk.functions import crs as CRS
from punktwerk.functions import geom as G
from punktwerk.functions import wkb as WKB
from punktwerk.operators import hull as HU

coord = st.integers(min_value=-10_000_000, max_value=10_000_000).map(lambda v: v / 100)
ring = st.lists(st.tuples(coord, coord), min_size=3, max_size=12).map(lambda r: tuple(r) + (r[0],))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(ring, min_size=1, max_size=3), min_size=1, max_size=3))
def test_wkt_wkb_roundtrip(spark, polys):
    shape = G.Shape("MULTIPOLYGON", tuple(tuple(p) for p in polys))
    wkt = shape.wkt()
    r = spark.createDataFrame([(wkt,)], "w string").select(G.st_geomfromtext("w").alias("g")).select(
        G.st_astext("g").alias("t"), G.st_astext(WKB.st_geomfromwkb(WKB.st_asbinary("g"))).alias("b")).first()
    assert G.parse_wkt_literal(r.t) == shape and r.b == r.t


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.floats(3.0, 15.0), st.floats(47.0, 55.0)), min_size=1, max_size=50))
def test_transform_roundtrip(spark, pts):
    df = spark.createDataFrame(pts, "lon double, lat double")
    u = df.select("lon", "lat", CRS.st_transform("lon", "lat", 4326, 25832).alias("u"))
    back = u.select("lon", "lat", CRS.st_transform("u.x", "u.y", 25832, 4326).alias("b")).collect()
    assert all(abs(r.b.x - r.lon) < 1e-9 and abs(r.b.y - r.lat) < 1e-9 for r in back)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 50)), min_size=1, max_size=60))
def test_hull_covers_its_points(spark, pts):
    df = spark.createDataFrame([(1, float(x), float(y)) for x, y in pts], "g long, x double, y double")
    h = HU.convex_hull(df, "g", rows_per_task=7).first()
    if h.gtype != "POLYGON":
        return
    shape = G.Shape("POLYGON", ((tuple((v.x, v.y) for v in h.hull),),))
    assert df.filter(~G.contains_literal(shape, "x", "y", boundary=True)).count() == 0
    assert df.filter(F.col("x").isNull()).count() == 0
