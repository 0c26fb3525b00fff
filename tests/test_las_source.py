import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from punktwerk.plans import fixtures as X
from punktwerk.sources import las as LAS
from punktwerk.sources import las_source as LS
from tests.conftest import SF_SMALL


def tile(path, x0, n, **options):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    x = x0 + np.arange(n) / 100
    LAS.write_las(path, x, x + 1000, x - x0, np.arange(n) % 65536, np.arange(n) % 4 + 1, np.arange(n) % 5, **options)


def las(spark, path, **options):
    return LS.register(spark).read.format("las").options(**options).load(path)


def test_all_records_whatever_the_split(spark, tmpdir_path):
    tile(f"{tmpdir_path}/d/a.las", 100.0, 1000)
    tile(f"{tmpdir_path}/d/sub/b.las", 500.0, 700, point_format=7)
    tile(f"{tmpdir_path}/d/empty.las", 0.0, 0)
    want = sorted(map(tuple, LAS.read_las(spark, f"{tmpdir_path}/d")[0].collect()))
    for split in (1 << 26, 3000, 997):
        df = las(spark, f"{tmpdir_path}/d", split_bytes=split)
        assert sorted(map(tuple, df.collect())) == want and len(want) == 1700
    assert las(spark, f"{tmpdir_path}/d/a.las").count() == 1000
    assert las(spark, f"file://{tmpdir_path}/d", glob="b*").count() == 700
    assert las(spark, f"{tmpdir_path}/d", glob="none").count() == 0


def test_filters_are_pushed_and_exact(spark, tmpdir_path):
    tile(f"{tmpdir_path}/d/a.las", 100.0, 1000)
    tile(f"{tmpdir_path}/d/b.las", 500.0, 1000)
    df = las(spark, f"{tmpdir_path}/d", split_bytes=5000)
    fresh = lambda: las(spark, f"{tmpdir_path}/d", split_bytes=5000, pushdown=True)
    every = spark.createDataFrame(df.collect(), df.schema)
    for cond in ("x >= 105 and x < 108.5", "y > 1503 and classification = 2", "classification in (1, 3) and z <= 2", "x = 105", "intensity > 990",
                 "x > 109.98 and x < 500.02", "x < 0", "source_file = 'a.las' and x > 109", "x is null", "not (x > 104)", "x > 104 or y < 1200"):
        want = sorted(map(tuple, every.filter(cond).collect()))
        assert sorted(map(tuple, fresh().filter(cond).collect())) == want, cond
        assert sorted(map(tuple, df.filter(cond).collect())) == want, cond      # one DataFrame for all queries
    window = las(spark, f"{tmpdir_path}/d", window="105,0,108.5,1108", classes="2,3")
    assert sorted(map(tuple, window.collect())) == sorted(map(tuple, every.filter("x between 105 and 108.5 and y <= 1108 and classification in (2, 3)").collect()))
    q = fresh().filter("x >= 105 and classification = 2")._jdf.queryExecution()
    plan = spark._jvm.PythonSQLUtils.explainString(q, "formatted")
    assert "GreaterThanOrEqual(x,105.0)" in plan and "EqualTo(classification,2)" in plan


def test_tiles_outside_the_box_are_never_opened(spark, tmpdir_path):
    """Their records are cut off: opening one would fail the query."""
    for k in range(6):
        tile(f"{tmpdir_path}/d/{k}.las", 100.0 * k, 500)
    for k in (0, 1, 4, 5):
        with open(f"{tmpdir_path}/d/{k}.las", "r+b") as f:
            f.truncate(400)
    for inside in (las(spark, f"{tmpdir_path}/d", pushdown=True).filter("x >= 200 and x <= 304"), las(spark, f"{tmpdir_path}/d", window="200,0,304,9e9")):
        assert inside.rdd.getNumPartitions() == 2 and len(inside.collect()) == 901
    df = las(spark, f"{tmpdir_path}/d")
    with pytest.raises(Exception, match="truncated"):
        df.count()
    assert las(spark, f"{tmpdir_path}/d", mode="skip").count() == 1000
    with pytest.raises(Exception, match="mode"):
        las(spark, f"{tmpdir_path}/d", mode="other").count()


def test_headers_without_bounds_are_read(spark, tmpdir_path):
    tile(f"{tmpdir_path}/d/a.las", 100.0, 50)
    with open(f"{tmpdir_path}/d/a.las", "r+b") as f:
        f.seek(179)
        f.write(bytes(48))
    assert las(spark, f"{tmpdir_path}/d", window="100.205,0,1e9,1e9").count() == 29


def test_tiles_written_on_the_cluster(spark, tmpdir_path):
    p = X.pts(spark, SF_SMALL, with_source=True).withColumn("source_file", F.regexp_replace("source_file", "laz$", "las"))
    for fmt in (0, 6):
        out = f"{tmpdir_path}/out{fmt}"
        files = LAS.write_las_tiles(p, out, fmt)
        assert sorted(os.listdir(out)) == sorted(r.source_file for r in p.select("source_file").distinct().collect())
        assert files.agg(F.sum("n")).first()[0] == p.count()
        cols = ["source_file", *[F.round(c, 2).alias(c) for c in "xyz"], "intensity", "return_num",
                (F.col("classification") if fmt else F.col("classification") % 32).alias("classification")]
        assert sorted(map(tuple, las(spark, out).select(*cols).collect())) == sorted(map(tuple, p.select(*cols).collect()))
        head = open(f"{out}/{sorted(os.listdir(out))[0]}", "rb").read(375)
        assert LAS.header_bounds(head)["x"][0] >= 280000
