import os
import time

import pytest
from pyspark.sql import functions as F

from punktwerk.functions import curve
from punktwerk.operators import aggs as A
from punktwerk.plans import fixtures as X
from punktwerk.sources import las as LAS
from punktwerk.sources import tile_log as TL
from punktwerk.streaming import tiles as TS
from tests.conftest import SF_SMALL

SCHEMA = "x double, y double, z double, intensity int, return_num int, classification int, source_file string"


def points(spark, *tiles):
    return spark.createDataFrame([(float(i), 2.0, float(k), 1, 1, 2, t) for t, n, k in tiles for i in range(n)], SCHEMA)


def counts(spark, table):
    return {r.source_file: r["count"] for r in TL.read_points(spark, table).groupBy("source_file").count().collect()}


def test_commits_replace_and_add_up(spark, tmpdir_path):
    table = f"{tmpdir_path}/t"
    assert counts(spark, table) == {}
    TL.commit_points(points(spark, ("a:1 %é", 3, 0), ("b", 2, 0)), table)
    TL.commit_points(points(spark, ("a:1 %é", 4, 1)), table, "c2", "second")
    TL.commit_points(points(spark, ("a:1 %é", 1, 2)), table, "c3", "second")
    assert counts(spark, table) == {"a:1 %é": 5, "b": 2}
    TL.commit_points(points(spark, ("a:1 %é", 9, 2)), table, "c3", "second")       # a replay
    TL.commit_points(points(spark, ("b", 1, 5)), table, "c4", TL.APPEND)
    TL.commit_points(points(spark, ("b", 1, 6)), table, "c5", TL.APPEND)
    assert counts(spark, table) == {"a:1 %é": 5, "b": 2}
    zones = {r.source_file: r for r in TL.zone_map(spark, table).collect()}
    assert zones["b"].n_points == 2 and (zones["b"].minz, zones["b"].maxz, zones["b"].classes) == (5.0, 6.0, {2: 2})
    before = sum(len(f) for _, _, f in os.walk(table))
    assert TL.vacuum(spark, table) == 2 and TL.vacuum(spark, table) == 0
    assert counts(spark, table) == {"a:1 %é": 5, "b": 2} and sum(len(f) for _, _, f in os.walk(table)) < before


def test_unpublished_commits_stay_unseen(spark, tmpdir_path, monkeypatch):
    """A writer that stops at any step changes nothing for readers; the next
    try completes the commit. A reader keeps its snapshot."""
    table = f"{tmpdir_path}/t"
    TL.commit_points(points(spark, ("a", 3, 0)), table, "one")
    snapshot = TL.read_points(spark, table)
    for step in ("_statistics", "_publish"):
        def stop(*a):
            raise OSError("stopped")
        whole = getattr(TL, step)
        monkeypatch.setattr(TL, step, stop)
        with pytest.raises(OSError):
            TL.commit_points(points(spark, ("a", 5, 0), ("b", 1, 0)), table, "two")
        monkeypatch.setattr(TL, step, whole)
        assert counts(spark, table) == {"a": 3}
    open(f"{table}/_log/commits/{7:012d}", "w").close()        # stopped between the number and the name
    TL.commit_points(points(spark, ("a", 5, 0), ("b", 1, 0)), table, "two")
    assert counts(spark, table) == {"a": 5, "b": 1} and snapshot.count() == 3


def test_writers_at_once(spark, tmpdir_path):
    """Two writers that saw the same newest number get numbers of their own."""
    from concurrent.futures import ThreadPoolExecutor
    table = f"{tmpdir_path}/t"
    with ThreadPoolExecutor(6) as pool:
        got = list(pool.map(lambda k: TL._publish(spark, table, f"c{k}"), range(24)))
    assert sorted(got) == list(range(24)) and TL.commits(spark, table).count() == 24


def test_region_stats_read_border_tiles_only(spark, tmpdir_path):
    table = f"{tmpdir_path}/t"
    p = X.pts(spark, SF_SMALL, with_source=True)
    TL.commit_points(p, table)
    strays = spark.createDataFrame([(None, 5653600.0, 1.0, 1, 1, 2, "stray"), (281700.0, 5655000.0, 9.0, 1, 1, 2, "stray"),
                                    (float("nan"), 1.0, 1.0, 1, 1, 2, "nowhere")], SCHEMA)
    TL.commit_points(strays, table)
    every = p.unionByName(strays)
    for wkt in (X.POLY1_WKT, X.POLY2_WKT, X.REGION_WKT, "POLYGON((0 0, 1 0, 1 1, 0 0))", "POLYGON((281250 5652250, 281750 5652250, 281750 5652750, 281250 5652750, 281250 5652250))"):
        assert TL.region_stats(spark, table, wkt).collect() == A.region_stats(every, wkt).collect()
    zones = TL.zone_map(spark, table)
    inside, border = TL.split_tiles(zones, A.parse_wkt_literal(X.POLY1_WKT))
    assert inside.count() >= 1 and border.count() < zones.count() / 2
    read = TL.read_points(spark, table, border).inputFiles()
    folders = {f.rsplit("/", 2)[1] for f in read}
    assert folders == {f"tile={r.tile}" for r in border.collect()}
    w = (281200.0, 5652300.0, 281900.0, 5653100.0)
    got = TL.window_points(spark, table, w)
    want = p.filter(F.col("x").between(w[0], w[2]) & F.col("y").between(w[1], w[3]))
    assert got.count() == want.count() and len(got.inputFiles()) < zones.count() / 2
    plan = got._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(x,281200.0)" in plan


def test_z_order_prunes_row_groups_in_both_directions(spark, tmpdir_path):
    """A small window meets few row groups of a curve-sorted file, in a strip
    of x or of y as well."""
    import pyarrow.parquet as pq
    n = 256
    grid = spark.range(n * n).selectExpr(f"cast(id % {n} as double) as x", f"cast(id div {n} as double) as y", "0d as z", "1 as intensity",
                                         "1 as return_num", "2 as classification", "'t' as source_file").coalesce(1)
    spark.conf.set("parquet.block.size", "16384")
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", "16384")
    hadoop.set("parquet.page.size.row.check.min", "100")
    hadoop.set("parquet.block.size.row.check.min", "100")
    hadoop.set("parquet.block.size.row.check.max", "500")
    try:
        TL.commit_points(grid.orderBy(F.rand(3)), f"{tmpdir_path}/t")
    finally:
        for k in ("parquet.block.size", "parquet.page.size.row.check.min", "parquet.block.size.row.check.min", "parquet.block.size.row.check.max"):
            hadoop.unset(k)
        spark.conf.unset("parquet.block.size")
    groups = []
    for root, _, files in os.walk(f"{tmpdir_path}/t/data"):
        for f in files:
            if f.endswith(".parquet"):
                m = pq.ParquetFile(f"{root}/{f}").metadata
                at = {m.schema.column(i).name: i for i in range(m.num_columns)}
                for g in range(m.num_row_groups):
                    s = [m.row_group(g).column(at[c]).statistics for c in "xy"]
                    groups.append((s[0].min, s[0].max, s[1].min, s[1].max))
    assert len(groups) >= 16

    def met(x0, x1, y0, y1):
        return sum(a <= x1 and b >= x0 and c <= y1 and d >= y0 for a, b, c, d in groups)

    assert met(40, 50, 200, 210) <= len(groups) / 6
    assert met(40, 44, 0, 255) <= len(groups) / 2 and met(0, 255, 40, 44) <= len(groups) / 2


def test_z_order_keys(spark):
    rows = [(0.0, 0.0, 0), (0.125, 0.0, 1), (0.0, 0.125, 2), (0.125, 0.125, 3), (0.25, 0.0, 4), (-5.0, 1e300, None), (None, float("nan"), 0)]
    df = spark.createDataFrame([r[:2] for r in rows], "x double, y double").select("x", "y", curve.z_order("x", "y", (0.0, 0.0)).alias("k"))
    for r, (_, _, k) in zip(df.collect(), rows):
        assert k is None and r.k == int("10" * 31, 2) or r.k == k


def _csv(path, rows, z="3.0", bad=0):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path + ".tmp", "w") as f:
        f.write("x,y,z,intensity,return_num,classification\n" + "".join(f"{i}.0,2.0,{'n/a' if i < bad else z},4,1,2\n" for i in range(rows)))
    os.rename(path + ".tmp", path)


def _until(check, seconds=60):
    end = time.time() + seconds
    while time.time() < end:
        if check():
            return True
        time.sleep(0.3)
    return False


def test_running_stream_sees_each_delivery_once(spark, tmpdir_path):
    """A tile delivered twice while the stream runs, in another folder and
    over its old name; a new checkpoint replays all of it."""
    src, table, ck, bad = (f"{tmpdir_path}/{n}" for n in ("s", "t", "ck", "bad"))
    _csv(f"{src}/one/a.csv", 5, bad=1)
    _csv(f"{src}/one/b.csv", 3)
    q = TS.stream_tiles(spark, src, table, ck, bad, max_files=1, available_now=False, processing_time="500 milliseconds")
    try:
        assert _until(lambda: counts(spark, table) == {"a.csv": 4, "b.csv": 3})
        _csv(f"{src}/two/a.csv", 2)
        assert _until(lambda: counts(spark, table) == {"a.csv": 2, "b.csv": 3})
        _csv(f"{src}/three/b.csv", 7)
        _csv(f"{src}/three/a.csv", 1)
        assert _until(lambda: counts(spark, table) == {"a.csv": 1, "b.csv": 7})
    finally:
        q.stop()
    TS.stream_tiles(spark, src, table, ck, bad).awaitTermination()
    assert counts(spark, table) == {"a.csv": 1, "b.csv": 7}
    TS.stream_tiles(spark, src, table, f"{tmpdir_path}/ck2", bad, max_files=2).awaitTermination()
    got = counts(spark, table)
    assert got == {"a.csv": 1, "b.csv": 7}
    assert [r.error for r in spark.read.parquet(bad).filter("source_file = 'a.csv'").collect()][0] == "unparseable record"


def test_files_of_a_folder_add_up_within_a_wave(spark, tmpdir_path):
    src, table, ck = (f"{tmpdir_path}/{n}" for n in ("s", "t", "ck"))
    for k in range(4):
        _csv(f"{src}/source_file=a/{k}.csv", 2 + k)
    _csv(f"{src}/source_file=b/0.csv", 1)
    for _ in range(2):
        TS.stream_tiles(spark, src, table, ck, lineage="dir", max_files=1).awaitTermination()
        assert counts(spark, table) == {"a": 14, "b": 1}
    for k in range(2):
        _csv(f"{src}/source_file=a/again{k}.csv", 7)
    TS.stream_tiles(spark, src, table, ck, lineage="dir", max_files=1).awaitTermination()
    assert counts(spark, table) == {"a": 14, "b": 1}
    assert TL.read_points(spark, table).filter("source_file = 'a'").agg(F.max("x")).first()[0] == 6.0
    TS.stream_tiles(spark, src, f"{tmpdir_path}/t2", f"{tmpdir_path}/ck2", lineage="dir", redelivery="append", max_files=2).awaitTermination()
    assert counts(spark, f"{tmpdir_path}/t2") == {"a": 28, "b": 1}


def test_stopped_batches_are_replayed(spark, tmpdir_path, monkeypatch):
    for step in ("commit_points", "_deliveries"):
        src, table, ck = (f"{tmpdir_path}/{step}/{n}" for n in ("s", "t", "ck"))
        for k in range(3):
            _csv(f"{src}/source_file=a/{k}.csv", 2 + k)
        whole, calls = getattr(TS, step), []

        def failing(*a):
            calls.append(1)
            if len(calls) == 2:
                raise OSError("stopped")
            return whole(*a)

        monkeypatch.setattr(TS, step, failing)
        with pytest.raises(Exception, match="stopped"):
            TS.stream_tiles(spark, src, table, ck, lineage="dir", max_files=1).awaitTermination()
        monkeypatch.setattr(TS, step, whole)
        TS.stream_tiles(spark, src, table, ck, lineage="dir", max_files=1).awaitTermination()
        assert counts(spark, table) == {"a": 9}


def _las(path, n, **options):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    v = [float(i) for i in range(n)]
    LAS.write_las(path + ".tmp", v, [2.0] * n, [3.0] * n, [1] * n, [1] * n, [2] * n, **options)
    os.rename(path + ".tmp", path)


def test_binary_tiles_in_a_running_stream(spark, tmpdir_path):
    src, table, ck, bad = (f"{tmpdir_path}/{n}" for n in ("s", "t", "ck", "bad"))
    _las(f"{src}/a.las", 250)
    _las(f"{src}/empty.las", 0)
    _las(f"{src}/cut.las", 100)
    with open(f"{src}/cut.las", "r+b") as f:
        f.truncate(1000)
    with open(f"{src}/text.las", "w") as f:
        f.write("not a tile")
    q = TS.stream_tiles(spark, src, table, ck, bad, binary=True, max_files=2, available_now=False, processing_time="500 milliseconds", points_per_split=100)
    try:
        assert _until(lambda: counts(spark, table) == {"a.las": 250})
        _las(f"{src}/again/a.las", 30, point_format=6)
        assert _until(lambda: counts(spark, table) == {"a.las": 30})
    finally:
        q.stop()
    errors = {r.source_file: (r.n_points, r.error) for r in spark.read.parquet(bad).collect()}
    assert errors["empty.las"] == (0, "no points") and errors["cut.las"][0] == 100 and errors["cut.las"][1].startswith("truncated: 100 points")
    assert "not a LAS file" in errors["text.las"][1] and set(errors) == {"empty.las", "cut.las", "text.las"}
