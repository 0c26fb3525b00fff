import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from punktwerk.sources import las as L
from punktwerk.sources import metadata as MD
from punktwerk.sources import points as SP


@pytest.mark.parametrize("fmt", [1, 6])
def test_las_roundtrip_in_splits(spark, tmpdir_path, fmt):
    n = 2500
    rng = np.random.default_rng(fmt)
    x = np.round(280000 + rng.uniform(0, 1000, n), 2)
    y = np.round(5652000 + rng.uniform(0, 1000, n), 2)
    z = np.round(rng.uniform(40, 90, n), 2)
    inten = rng.integers(0, 65535, n)
    ret = rng.integers(1, 5, n)
    cls = rng.choice([1, 2, 14, 17, 18, 20, 24, 26], n)
    L.write_las(f"{tmpdir_path}/3dm_32_280_5652_1_nw.las", x, y, z, inten, ret, cls, point_format=fmt,
                offset=(280000.0, 5652000.0, 0.0))
    L.write_las(f"{tmpdir_path}/empty.las", [], [], [], [], [], [], point_format=fmt)
    with open(f"{tmpdir_path}/junk.las", "wb") as f:
        f.write(b"not a las file at all" * 20)
    pts, bad = L.read_las(spark, tmpdir_path, points_per_split=700)
    got = pts.orderBy("x", "y").toPandas()
    order = np.lexsort((y, x))
    assert len(got) == n
    assert np.allclose(got["x"], x[order]) and np.allclose(got["z"], z[order])
    assert (got["classification"].to_numpy() == cls[order]).all()
    assert (got["return_num"].to_numpy() == ret[order]).all()
    assert set(got["source_file"]) == {"3dm_32_280_5652_1_nw.las"}
    errs = {r.name: r.error for r in bad.collect()}
    assert errs["empty.las"] == "no points" and "not a LAS file" in errs["junk.las"]


def test_tile_metadata_preamble_per_file(spark, tmpdir_path):
    for k in range(2):
        with open(f"{tmpdir_path}/meta{k}.csv", "w") as f:
            f.write("".join(f"preamble {i}\n" for i in range(7)))
            f.write(f"3dm_32_28{k}_5652_1_nw;2020-01-01;1;2021;0;4.5;25832;7837;GCG2016\n")
    df = MD.read_tile_metadata(spark, tmpdir_path)
    rows = sorted(df.collect())
    assert len(rows) == 2 and len(df.columns) == 9
    assert rows[0].Kachelname == "3dm_32_280_5652_1_nw" and rows[0].Aufloesung == 4.5
    cur = MD.curate_tile_metadata(df, as_of="2024-05-01")
    assert len(cur.columns) == 14 and cur.first().Kachelname.endswith(".laz")


def test_file_manifest_glob(spark, tmpdir_path):
    for name in ("3dm_32_283_5652_1_nw.laz", "3dm_32_284_5652_1_nw.laz", "other.txt"):
        with open(os.path.join(tmpdir_path, name), "wb") as f:
            f.write(b"x")
    m = SP.file_manifest(spark, tmpdir_path, "*3dm_32_283*.laz")
    assert [r.name for r in m.collect()] == ["3dm_32_283_5652_1_nw.laz"]
    assert SP.first_match(spark, tmpdir_path, "*.laz").endswith("3dm_32_283_5652_1_nw.laz")
    with pytest.raises(FileNotFoundError):
        SP.file_manifest(spark, tmpdir_path, "*.las")


def test_points_csv_roundtrip_with_lineage(spark, tmpdir_path):
    with open(f"{tmpdir_path}/tileA.csv", "w") as f:
        f.write("x,y,z,intensity,return_num,classification\n280000.0,5652013.19,59.88,41571,1,2\n")
    df = SP.with_source_file(SP.read_points_csv(spark, tmpdir_path))
    r = df.first()
    assert r.source_file == "tileA.csv" and r.classification == 2 and r.y == 5652013.19


def test_typed_points_with_offset(spark, tmpdir_path):
    with open(f"{tmpdir_path}/p.csv", "w") as f:
        f.write("testattribute0,-88.331492,32.324142,testattribute1,testattribute2\n")
        f.write("testattribute0,-88.175933,32.360763,testattribute1,testattribute2\n")
    df = SP.read_typed_points(spark, tmpdir_path, offset=1, sep=",")
    assert df.columns == ["x", "y", "attr1", "attr2", "attr3"]
    assert df.filter(F.col("x") == -88.331492).count() == 1


def test_typed_rectangles_and_shapes(spark, tmpdir_path):
    with open(f"{tmpdir_path}/r.csv", "w") as f:
        f.write("-88.3,-88.1,32.2,32.4\n")
    r = SP.read_typed_rectangles(spark, f"{tmpdir_path}/r.csv").first()
    assert (r.minx, r.miny, r.maxx, r.maxy) == (-88.3, 32.2, -88.1, 32.4)
    with open(f"{tmpdir_path}/p.csv", "w") as f:
        f.write("a,0,0,4,0,4,4,0,4\n")
    from punktwerk.functions import geom as G
    g = SP.read_typed_shapes(spark, f"{tmpdir_path}/p.csv", "polygon", offset=1)
    row = g.select(G.st_area("geom").alias("a"), G.st_numpoints("geom").alias("n")).first()
    assert row.a == 16.0 and row.n == 5


def test_write_geojson_and_read_back(spark, tmpdir_path):
    from punktwerk.functions import geom as G
    from punktwerk.sources.shapes import read_geojson
    from punktwerk.sources.sinks import write_geojson
    df = spark.createDataFrame([(7, "POLYGON ((0 0, 2 0, 2 1, 0 0))")], "fid long, w string") \
        .select("fid", G.st_geomfromtext("w").alias("geom"))
    write_geojson(df, f"{tmpdir_path}/gj")
    back = read_geojson(spark, f"{tmpdir_path}/gj", properties_schema="fid long").first()
    assert back.fid == 7 and back.maxx == 2.0


def test_touches(spark):
    from punktwerk.functions import geom as G
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (4.0, 2.0)], "x double, y double")
    sq = G.shape_literal("POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))")
    assert [r.t for r in df.select(G.st_touches_xy(sq, "x", "y").alias("t")).collect()] == [True, False, True]


def test_ingest_las_tiles_idempotent(spark, tmpdir_path):
    from punktwerk.sources.ingest import ingest_las
    rng = np.random.default_rng(0)
    for k in range(2):
        n = 300 + k
        L.write_las(f"{tmpdir_path}/3dm_32_28{k}_5652_1_nw.las", 280000 + k * 1000 + rng.uniform(0, 999, n),
                    5652000 + rng.uniform(0, 999, n), rng.uniform(40, 90, n), rng.integers(0, 999, n),
                    rng.integers(1, 4, n), rng.choice([2, 20], n), point_format=6)
    table = f"{tmpdir_path}/table"
    for _ in range(2):
        failures = ingest_las(spark, tmpdir_path, table, points_per_split=128)
        assert failures.count() == 0
    back = spark.read.parquet(table)
    counts = {r.source_file: r["count"] for r in back.groupBy("source_file").count().collect()}
    assert counts == {"3dm_32_280_5652_1_nw.las": 300, "3dm_32_281_5652_1_nw.las": 301}
    assert back.filter(F.length("geohash") != 6).count() == 0


def test_to_pandas_bounded(spark):
    from punktwerk.functions import geom as G
    from punktwerk.sources.sinks import to_pandas
    df = spark.createDataFrame([(1, 2.0, 3.0), (2, 4.0, 5.0)], "id long, x double, y double") \
        .withColumn("g", G.st_point("x", "y"))
    pdf = to_pandas(df, "g")
    assert list(pdf["g"]) == ["POINT (2 3)", "POINT (4 5)"]
    with pytest.raises(ValueError):
        to_pandas(df, "g", max_rows=1)


def test_las_truncated_or_compressed_files_are_failures(spark, tmpdir_path):
    from punktwerk.sources import las as L
    z = [1.0, 2.0, 3.0, 4.0]
    L.write_las(f"{tmpdir_path}/whole.las", z, z, z, [1] * 4, [1] * 4, [2] * 4)
    raw = open(f"{tmpdir_path}/whole.las", "rb").read()
    with open(f"{tmpdir_path}/cut.las", "wb") as f:
        f.write(raw[:-2 * 28])          # two whole records are missing
    packed = bytearray(raw)
    packed[104] |= 0x80
    with open(f"{tmpdir_path}/packed.las", "wb") as f:
        f.write(bytes(packed))
    pts, bad = L.read_las(spark, tmpdir_path)
    errs = {r.name: r.error for r in bad.collect()}
    assert set(errs) == {"cut.las", "packed.las"} and "truncated" in errs["cut.las"] and "compressed" in errs["packed.las"]
    assert pts.count() == 4


def test_append_keeps_the_other_tiles_of_a_table(spark, tmpdir_path):
    import uuid

    from pyspark.sql import functions as F

    from punktwerk.sources import sinks as SK
    name = f"t_{uuid.uuid4().hex[:8]}"
    SK.create_point_table(spark, name, location=f"{tmpdir_path}/t")
    cols = "x double, y double, z double, intensity int, return_num int, classification int, source_file string"
    try:
        for tile, n in (("a", 3), ("b", 2), ("a", 4)):
            SK.append_points(spark.createDataFrame([(1.0, 2.0, float(i), 1, 1, 2, tile) for i in range(n)], cols), table=name)
        got = {r.source_file: r["count"] for r in spark.table(name).groupBy("source_file").count().collect()}
        assert got == {"a": 4, "b": 2}
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
        assert spark.table(name).agg(F.sum("z")).first()[0] == 6 + 1
    finally:
        SK.drop_point_table(spark, name)


def test_wkb_with_more_ordinates(spark):
    import struct

    from punktwerk.functions.wkb import decode_wkb
    want = [[[{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 1.0}]]]
    for code, extra, head in ((1002, 1, b""), (2002, 1, b""), (3002, 2, b""), (0x80000002, 1, b""), (0xC0000002, 2, b""),
                              (0xA0000002, 1, struct.pack("<I", 25832))):
        body = b"".join(struct.pack(f"<{2 + extra}d", v, v, *[9.0] * extra) for v in (0.0, 1.0))
        assert decode_wkb(struct.pack("<BI", 1, code) + head + struct.pack("<I", 2) + body)["parts"] == want


def test_typed_shapes_without_coordinates_are_null(spark, tmpdir_path):
    from punktwerk.sources import points as SP
    with open(f"{tmpdir_path}/s.csv", "w") as f:
        f.write("0,0,4,0,4,4\n\n1\n0,0,x,1\n")
    got = [r.geom for r in SP.read_typed_shapes(spark, f"{tmpdir_path}/s.csv", "POLYGON").collect()]
    assert len(got) == 4 and sum(g is None for g in got) == 3


def test_geojson_names_its_reference_frame(spark, tmpdir_path):
    import json

    from pyspark.sql import functions as F

    from punktwerk.functions import geom as G
    from punktwerk.functions.crs import with_srid
    from punktwerk.sources import shapes as SS
    from punktwerk.sources import sinks as SK
    df = with_srid(spark.createDataFrame([(1, 2.0, 3.0)], "id int, x double, y double").select("id", G.st_point("x", "y").alias("geom")), "geom", 25832)
    SK.write_geojson(df, f"{tmpdir_path}/g")
    line = json.loads(spark.read.text(f"{tmpdir_path}/g").first().value)
    assert line["crs"]["properties"]["name"] == "EPSG:25832" and line["type"] == "Feature" and line["properties"] == {"id": 1}
    back = SS.read_geojson(spark, f"{tmpdir_path}/g", "id int").select("id", F.expr("geom.gtype")).first()
    assert tuple(back) == (1, "POINT")


def test_scratch_is_dropped(spark):
    import os

    from punktwerk import session
    p = session.scratch_path(spark, "gone")
    spark.range(3).write.parquet(p)
    local = p.replace("file:", "")
    assert os.path.isdir(local)
    kept, session._SCRATCH[:] = session._SCRATCH[:-1], [p]
    session.drop_scratch()
    session._SCRATCH[:] = kept
    assert not os.path.exists(local)


def test_ragged_and_malformed_text_is_kept(spark, tmpdir_path):
    from punktwerk.sources import points as SP
    from punktwerk.sources import shapes as SS
    with open(f"{tmpdir_path}/r.csv", "w") as f:
        f.write("1,2\n3,4,5,6\n7\n")
    got = [tuple(r) for r in SP.read_headerless(spark, f"{tmpdir_path}/r.csv").collect()]
    assert got == [("1", "2", None, None), ("3", "4", "5", "6"), ("7", None, None, None)]
    with open(f"{tmpdir_path}/g.json", "w") as f:
        f.write('[\n{"type":"Feature","properties":{"a":1},"geometry":{"type":"Point","coordinates":[1,2]}},\nnot a feature\n]\n')
    rows = SS.read_geojson(spark, f"{tmpdir_path}/g.json", "a int").collect()
    assert sorted(r.geom is None for r in rows) == [False, True]
    assert SS.read_geojson(spark, f"{tmpdir_path}/g.json", "a int", allow_invalid=False).count() == 1


def test_small_splits_share_tasks(spark, tmp_path):
    """the number of tasks follows the points, not the splits."""
    n = 3000
    v = np.arange(n) / 100
    L.write_las(f"{tmp_path}/a.las", v, v, v, np.arange(n) % 9, np.ones(n), np.full(n, 2))
    pts, bad = L.read_las(spark, str(tmp_path), points_per_split=10)
    assert pts.rdd.getNumPartitions() == L.TASKS_PER_CORE * spark.sparkContext.defaultParallelism < n // 10
    assert sorted(round(r.x * 100) for r in pts.select("x").collect()) == list(range(n)) and bad.count() == 0
    few, _ = L.read_las(spark, str(tmp_path), points_per_split=1000)
    assert few.rdd.getNumPartitions() == 3
