import pytest
from pyspark.sql import functions as F

from punktwerk.functions import crs as CRS
from punktwerk.functions import geohash as GH


def test_tm_known_point_and_roundtrip(spark):
    df = spark.createDataFrame([(280000.0, 5652013.19)], "x double, y double")
    ll = df.select(CRS.st_transform("x", "y", 25832, 4326).alias("p")).first().p
    assert ll.x == pytest.approx(5.865923361, abs=1e-8) and ll.y == pytest.approx(50.977623005, abs=1e-8)
    back = df.select(CRS.st_transform("x", "y", 25832, 4326).alias("p")) \
        .select(CRS.st_transform("p.x", "p.y", 4326, 25832).alias("q")).first().q
    assert back.x == pytest.approx(280000.0, abs=1e-6) and back.y == pytest.approx(5652013.19, abs=1e-6)


def test_tm_2180(spark):
    df = spark.createDataFrame([(21.0122, 52.2297)], "x double, y double")
    p = df.select(CRS.st_transform("x", "y", 4326, 2180).alias("p")).first().p
    assert p.x == pytest.approx(637382.2044, abs=1e-3) and p.y == pytest.approx(486757.2095, abs=1e-3)


def test_quarter_meridian():
    import math
    assert CRS.RECT_RADIUS * math.pi / 2 == pytest.approx(10001965.7292, abs=1e-4)


@pytest.mark.parametrize("lon,lat,p,expect", [
    (10.40744, 57.64911, 6, "u4pruy"), (10.40744, 57.64911, 7, "u4pruyd"),
    (-5.6, 42.6, 5, "ezs42"), (0.0, 0.0, 6, "7zzzzz")])
def test_geohash_vectors(spark, lon, lat, p, expect):
    df = spark.createDataFrame([(lon, lat)], "lon double, lat double")
    assert df.select(GH.geohash("lon", "lat", p).alias("g")).first().g == expect


def test_geohash_projected_and_invalid(spark):
    df = spark.createDataFrame([(280000.0, 5652013.19)], "x double, y double")
    assert df.select(GH.projected_geohash("x", "y", 25832, 7).alias("g")).first().g == "u1h4j2p"
    bad = spark.createDataFrame([(None, 1.0), (200.0, 1.0), (float("nan"), 1.0)], "lon double, lat double")
    assert [r.g for r in bad.select(GH.geohash("lon", "lat", 6).alias("g")).collect()] == [None] * 3


def test_geohash_matches_bisection(spark):
    import random
    from punktwerk.functions.geohash import BASE32

    def bisect(lon, lat, p):
        lo = [-180.0, 180.0]
        la = [-90.0, 90.0]
        bits = []
        for i in range(5 * p):
            rng, v = (lo, lon) if i % 2 == 0 else (la, lat)
            mid = (rng[0] + rng[1]) / 2
            if v > mid:
                bits.append(1)
                rng[0] = mid
            else:
                bits.append(0)
                rng[1] = mid
        return "".join(BASE32[int("".join(map(str, bits[i:i + 5])), 2)] for i in range(0, 5 * p, 5))
    rnd = random.Random(3)
    pts = [(rnd.uniform(-180, 180), rnd.uniform(-90, 90)) for _ in range(500)]
    df = spark.createDataFrame(pts, "lon double, lat double")
    got = [r.g for r in df.select(GH.geohash("lon", "lat", 8).alias("g")).collect()]
    assert got == [bisect(a, b, 8) for a, b in pts]


def test_srid_metadata(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    df = CRS.with_srid(df, "x", 25832)
    assert CRS.srid_of(df, "x") == 25832 and CRS.srid_of(df, "y") is None
