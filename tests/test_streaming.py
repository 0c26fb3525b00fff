import os

from punktwerk.streaming import ingest as ST


def test_stream_ingest_restart_and_quarantine(spark, tmpdir_path):
    src = f"{tmpdir_path}/src"
    os.makedirs(src)
    for t in range(3):
        d = f"{src}/source_file=tile{t}.laz"
        os.makedirs(d)
        with open(f"{d}/part.csv", "w") as f:
            f.write("x,y,z,intensity,return_num,classification\n")
            for i in range(10):
                z = "n/a" if i == 0 and t == 1 else f"{40 + i}.5"
                f.write(f"{280000 + i}.25,{5652000 + i}.5,{z},{i},1,2\n")
    table, bad, ck = f"{tmpdir_path}/table", f"{tmpdir_path}/bad", f"{tmpdir_path}/ck"
    ST.stream_points(spark, src, table, ck, quarantine_path=bad, max_files=1).awaitTermination()
    ST.stream_points(spark, src, table, ck, quarantine_path=bad, max_files=1).awaitTermination()
    back = spark.read.parquet(table)
    assert back.count() == 29
    assert {r.source_file for r in back.select("source_file").distinct().collect()} == {"tile0.laz", "tile1.laz", "tile2.laz"}
    q = spark.read.parquet(bad).collect()
    assert len(q) == 1 and q[0].source_file == "tile1.laz" and q[0].error == "unparseable record"
    # a new file arriving later is picked up on the next run, nothing else is repeated
    d = f"{src}/source_file=tile3.laz"
    os.makedirs(d)
    with open(f"{d}/part.csv", "w") as f:
        f.write("x,y,z,intensity,return_num,classification\n1.0,2.0,3.0,4,1,2\n")
    ST.stream_points(spark, src, table, ck, quarantine_path=bad, max_files=1).awaitTermination()
    assert spark.read.parquet(table).count() == 30


def test_back_pressure_options(spark, tmpdir_path):
    s = ST.read_point_stream(spark, tmpdir_path, max_bytes=ST.MAX_BYTES_PER_TRIGGER)
    assert s.isStreaming
    s2 = ST.read_point_stream(spark, tmpdir_path, max_files=ST.MAX_FILES_PER_TRIGGER)
    assert s2.isStreaming and "source_file" in s2.columns


def test_header_only_files_are_failures(spark, tmpdir_path):
    from punktwerk.sources.points import file_manifest, read_points_csv, with_source_file
    for name, body in (("a.csv", "1.0,2.0,3.0,4,1,2\n"), ("b.csv", "")):
        with open(f"{tmpdir_path}/{name}", "w") as f:
            f.write("x,y,z,intensity,return_num,classification\n" + body)
    pts = with_source_file(read_points_csv(spark, tmpdir_path))
    bad = ST.empty_files(spark, file_manifest(spark, tmpdir_path, "*.csv"), pts)
    assert [(r.source_file, r.error) for r in bad.collect()] == [("b.csv", "no points")]


def _tile(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("x,y,z,intensity,return_num,classification\n" + "".join(f"{i}.0,2.0,3.0,4,1,2\n" for i in range(rows)))


def test_flat_folder_and_files_without_points(spark, tmpdir_path):
    """Each file is a tile; header-only files go to the quarantine."""
    src = f"{tmpdir_path}/flat"
    for name, rows in (("A.csv", 3), ("B.csv", 2), ("C.csv", 0)):
        _tile(f"{src}/{name}", rows)
    table, bad = f"{tmpdir_path}/t", f"{tmpdir_path}/bad"
    ST.ingest_available(spark, src, table, f"{tmpdir_path}/ck", bad, max_files=None, max_bytes=ST.MAX_BYTES_PER_TRIGGER)
    got = {r.source_file: r["count"] for r in spark.read.parquet(table).groupBy("source_file").count().collect()}
    assert got == {"A.csv": 3, "B.csv": 2}
    q = spark.read.option("recursiveFileLookup", "true").parquet(bad).collect()
    assert [(r.source_file, r.error) for r in q] == [("C.csv", "no points")]


def test_lost_checkpoint_and_second_delivery(spark, tmpdir_path):
    """A new checkpoint, and a tile delivered again in another file, replace
    rows instead of losing or doubling them."""
    src, table = f"{tmpdir_path}/s", f"{tmpdir_path}/t"
    _tile(f"{src}/source_file=a/1.csv", 5)
    ST.stream_points(spark, src, table, f"{tmpdir_path}/ck1").awaitTermination()
    _tile(f"{tmpdir_path}/s2/source_file=b/1.csv", 1)
    ST.stream_points(spark, f"{tmpdir_path}/s2", table, f"{tmpdir_path}/ck2").awaitTermination()
    _tile(f"{src}/source_file=a/2.csv", 4)
    ST.stream_points(spark, src, table, f"{tmpdir_path}/ck1").awaitTermination()
    got = {r.source_file: r["count"] for r in spark.read.parquet(table).groupBy("source_file").count().collect()}
    assert got == {"a": 4, "b": 1}


def test_append_mode_keeps_all_files_of_a_tile(spark, tmpdir_path):
    src, table = f"{tmpdir_path}/s", f"{tmpdir_path}/t"
    for k in range(3):
        _tile(f"{src}/source_file=a/{k}.csv", 2 + k)
    for _ in range(2):
        ST.stream_points(spark, src, table, f"{tmpdir_path}/ck", max_files=1, redelivery="append").awaitTermination()
    assert spark.read.parquet(table).count() == 9


def _counts(spark, table):
    return {r.source_file: r["count"] for r in spark.read.parquet(table).groupBy("source_file").count().collect()}


def test_files_of_a_tile_in_several_batches_add_up(spark, tmpdir_path):
    """With the defaults, no batch deletes the rows of an earlier one of its
    run; the tile delivered again by the next run replaces them all."""
    src, table, ck = (f"{tmpdir_path}/{n}" for n in ("s s", "t", "ck"))
    for k in range(4):
        _tile(f"{src}/source_file=a/{k}.csv", 2 + k)
    _tile(f"{src}/source_file=b/0.csv", 1)
    for _ in range(2):
        ST.stream_points(spark, src, table, ck, max_files=1).awaitTermination()
        assert _counts(spark, table) == {"a": 14, "b": 1}
    assert spark.read.parquet(table).columns == [*ST.POINT_COLUMNS, "source_file"]
    for k in range(2):
        _tile(f"{src}/source_file=a/again{k}.csv", 7)
    ST.stream_points(spark, src, table, ck, max_files=1).awaitTermination()
    assert _counts(spark, table) == {"a": 14, "b": 1}
    assert len(ST._names(spark, f"{table}/source_file=a")) == 2


def test_interrupted_run_goes_on_with_its_tiles(spark, tmpdir_path, monkeypatch):
    """A run that fails between two files of a tile is continued: before,
    between and after the moves of a batch."""
    for fail_at in ("write", "move", "moved"):
        src, table, ck = (f"{tmpdir_path}/{fail_at}/{n}" for n in ("s", "t", "ck"))
        for k in range(3):
            _tile(f"{src}/source_file=a/{k}.csv", 2 + k)
        whole, calls = ST._move_in, []

        def failing(*args):
            calls.append(args)
            if len(calls) == 2 and fail_at == "write":
                raise OSError("stopped")
            whole(*args)
            if len(calls) == 2 and fail_at == "moved":
                raise OSError("stopped")
            if len(calls) == 1 and fail_at == "move":
                ran.append(True)

        ran = []
        monkeypatch.setattr(ST, "_move_in", failing)
        q = ST.stream_points(spark, src, table, ck, max_files=1)
        try:
            if fail_at == "move":       # an orderly stop between two batches
                while not ran:
                    pass
                q.stop()
            q.awaitTermination()
        except Exception as e:
            assert "stopped" in str(e)
        monkeypatch.setattr(ST, "_move_in", whole)
        ST.stream_points(spark, src, table, ck, max_files=1).awaitTermination()
        assert _counts(spark, table) == {"a": 9}
