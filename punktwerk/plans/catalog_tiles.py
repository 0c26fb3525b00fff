"""Queries over point tiles: binary files as a source, tables with a commit
log, continuous ingest, zone maps and the curve layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from punktwerk.operators import nearest as N
from punktwerk.operators import partitioning as P
from punktwerk.plans import fixtures as X
from punktwerk.plans.oracle_sql import d, point_in_polys_sql
from punktwerk.plans.registry import query
from punktwerk.session import scratch_path
from punktwerk.sources import las as LAS
from punktwerk.sources import las_source as LS
from punktwerk.sources import tile_log as TL
from punktwerk.streaming import tiles as TS

PTS = {"pts": X.PTS_SQL}
PTS_SRC = {"pts": X.PTS_SRC_SQL}


def _las_points(spark, sf):
    return X.pts(spark, sf, with_source=True).withColumn("source_file", F.regexp_replace("source_file", "laz$", "las"))


_LAS_NAME = "regexp_replace(source_file, 'laz$', 'las')"


@query("scan_las", X.with_ctes(
    f"select {_LAS_NAME} as source_file, classification, count(*) as n, round(sum(z), 6) as sum_z, round(min(x), 2) as min_x, max(intensity) as top "
    f"from pts where x > {d(281234.005)} and x < {d(284321.005)} and y < {d(5654567.005)} and classification in (2, 20, 26) group by all", **PTS_SRC))
def q_scan_las(spark, sf):
    """Binary tiles written on the cluster and read back as a data source; the
    window and the classes are pushed into the scan."""
    path = scratch_path(spark, "las-tiles")
    LAS.write_las_tiles(_las_points(spark, sf), path)
    p = LS.register(spark).read.format("las").option("pushdown", True).option("split_bytes", 100_000).load(path)
    p = p.filter("x > 281234.005D and x < 284321.005D and y < 5654567.005D and classification in (2, 20, 26)")
    return p.groupBy("source_file", "classification").agg(
        F.count("*").alias("n"), F.round(F.sum(F.round("z", 2)), 6).alias("sum_z"), F.round(F.min("x"), 2).alias("min_x"), F.max("intensity").alias("top"))


def _damaged(tiles):
    """Beside each file: a copy cut short or a header that announces nothing."""
    def run(batches):
        for pdf in batches:
            for path, n in zip(pdf["path"], pdf["n"]):
                fs, at = LAS._filesystem(path)
                folder, name = at.rsplit("/", 1)
                with fs.open_input_file(at) as f:
                    head = f.read(375)
                if n % 3 == 0:
                    with fs.open_output_stream(f"{folder}/cut_{name}") as out:
                        out.write(head + bytes(10))
                elif n % 3 == 1:
                    with fs.open_output_stream(f"{folder}/empty_{name}") as out:
                        out.write(LAS.make_header(6, 0, (0.01,) * 3, (0.0,) * 3))
            yield pdf
    return tiles.mapInPandas(run, "path string, n long")


@query("stream_las", X.with_ctes(
    "select source_file, n, cast(null as varchar) as error from t union all select 'cut_' || source_file, n, 'truncated' from t where n % 3 = 0 "
    "union all select 'empty_' || source_file, 0, 'no points' from t where n % 3 = 1",
    **PTS_SRC, t=f"select {_LAS_NAME} as source_file, count(*) as n from pts group by all"))
def q_stream_las(spark, sf):
    """Binary tiles, good, truncated and empty ones, through a stream: points
    per tile of the table, and the files of the quarantine with the number of
    points that their headers announce."""
    src, table, bad, ckpt = (scratch_path(spark, n) for n in ("las-src", "las-table", "las-bad", "las-ckpt"))
    _damaged(LAS.write_las_tiles(_las_points(spark, sf), src)).count()
    for _ in range(2):
        TS.stream_tiles(spark, src, table, ckpt, bad, binary=True, max_files=60, points_per_split=5000).awaitTermination()
    good = TL.read_points(spark, table).groupBy("source_file").agg(F.count("*").alias("n")).withColumn("error", F.lit(None).cast("string"))
    failed = spark.read.schema(TS.QUARANTINE).parquet(bad).select("source_file", F.col("n_points").alias("n"), F.regexp_extract("error", "^[a-z ]+", 0).alias("error"))
    return good.unionByName(failed)


_PER_TILE = "select source_file, count(*) as n, round(sum(z), 6) as sum_z from pts group by source_file"


def _per_tile(df):
    return df.groupBy("source_file").agg(F.count("*").alias("n"), F.round(F.sum("z"), 6).alias("sum_z"))


def _deliver(spark, df, name: str, src: str, files: int) -> None:
    """CSV files, a folder a tile, that land in ``src`` at once."""
    there = scratch_path(spark, name)
    X.write_parts(df, there, files)
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = new(src).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(new(src))
    if not fs.rename(new(there), new(f"{src}/{name}")):
        raise OSError(f"cannot move {there}")


@query("stream_continuous", X.with_ctes(_PER_TILE, **PTS_SRC))
def q_stream_continuous(spark, sf):
    """A stream that runs on: a part of each tile is delivered, then, while it
    runs, whole tiles in two files each; at the end a second stream with a
    checkpoint of its own reads the whole folder again. Each tile shows its
    last delivery once."""
    src, table = scratch_path(spark, "live-src"), scratch_path(spark, "live-table")
    p = X.pts(spark, sf, with_source=True)
    _deliver(spark, p.filter("return_num < 3"), "first", src, 1)
    q = TS.stream_tiles(spark, src, table, scratch_path(spark, "live-ckpt"), lineage="dir", max_files=40, available_now=False, processing_time="200 milliseconds")
    try:
        q.processAllAvailable()
        _deliver(spark, p, "second", src, 2)
        q.processAllAvailable()
    finally:
        q.stop()
    TS.stream_tiles(spark, f"{src}/second", table, scratch_path(spark, "live-ckpt2"), lineage="dir", max_files=50).awaitTermination()
    return _per_tile(TL.read_points(spark, table))


def _tile_table(spark, sf):
    """All points in a table with a commit log, over three commits: half of
    the tiles, the others, and the first half again."""
    table = scratch_path(spark, "zone-table")
    p = X.pts(spark, sf, with_source=True)
    half = F.pmod(F.xxhash64("source_file"), F.lit(2))
    for part in (0, 1, 0):
        TL.commit_points(p.filter(half == part), table)
    return table


def _region_sql(pid, wkt):
    return ("select count(*) as total_points, count(case when classification = 2 then 1 end) as ground_points, min(z) as min_z, "
            f"max(z) as max_z, round(avg(z), 6) as avg_z, {pid} as poly_id from p where rid in "
            f"(select rid from ({point_in_polys_sql('p', {pid: wkt}, 'rid')}) where odd and not on_edge)")


@query("region_stats_pruned", X.with_ctes(" union all ".join(_region_sql(k, w) for k, w in X.POLYS.items()), **PTS,
                                          p="select row_number() over () as rid, * from pts"))
def q_region_stats_pruned(spark, sf):
    """Region statistics of two polygons from the zone map: tiles inside a
    polygon are not read, tiles outside neither."""
    table = _tile_table(spark, sf)
    a, b = (TL.region_stats(spark, table, w).withColumn("poly_id", F.lit(k)) for k, w in X.POLYS.items())
    return a.unionByName(b)


@query("zone_map", X.with_ctes(
    "select source_file, count(*) as n_points, min(x) as minx, max(x) as maxx, min(y) as miny, max(y) as maxy, min(z) as minz, max(z) as maxz, "
    "round(sum(z), 6) as sum_z, count(case when classification = 2 then 1 end) as ground from pts group by source_file", **PTS_SRC))
def q_zone_map(spark, sf):
    """What the commits of a table know about its tiles."""
    z = TL.zone_map(spark, _tile_table(spark, sf))
    return z.select("source_file", "n_points", "minx", "maxx", "miny", "maxy", "minz", "maxz", F.round("sum_z", 6).alias("sum_z"),
                    F.coalesce(F.try_element_at("classes", F.lit(2)), F.lit(0)).alias("ground"))


@query("curve_window", X.with_ctes(
    f"select x, y, z, classification from pts where x between {d(282340)} and {d(283125)} and y between {d(5653250)} and {d(5653990)}", **PTS))
def q_curve_window(spark, sf):
    """A window over tiles whose rows are sorted along a Z-order curve."""
    return TL.window_points(spark, _tile_table(spark, sf), (282340.0, 5653250.0, 283125.0, 5653990.0)).select("x", "y", "z", "classification")


# A third of the points in one square metre.
_CROWD = ("case when l_orderkey % 3 = 0 then cast(281000 as double) + (l_partkey % 50) / cast(50 as double) else x end as x",
          "case when l_orderkey % 3 = 0 then cast(5653000 as double) + (l_suppkey % 50) / cast(50 as double) else y end as y")
_CROWD_SQL = f"select {', '.join(_CROWD)}, z, l_suppkey as k from (select *, {', '.join(X.PTS_EXPRS)} from lineitem)"


@query("adaptive_partition", X.with_ctes(
    "select (select count(*) from p) as n_points, true as bounded, (select count(*) from p where k % 2 = 0) as n_even, count(*) as n_pairs, "
    "cast(sum(a.k * b.k) as bigint) as sum_keys from p a join p b on a.x = b.x and a.y = b.y and a.k % 2 = 0 and b.k % 7 = 0", p=_CROWD_SQL))
def q_adaptive_partition(spark, sf):
    """Two point tables dealt by one quadtree, with a third of the rows in one
    square metre: no partition holds more rows than asked for, and the rows
    of one place are joined without a further exchange."""
    p = X.table(spark, sf, "lineitem").selectExpr("*", *X.PTS_EXPRS).selectExpr(*_CROWD, "z", "l_suppkey as k")
    n = p.count()
    limit = max(1, n // 40)
    slack = p.rdd.getNumPartitions()        # one row for each task that deals
    every = P.deal(p, P.split_tree([p], limit), name="key")
    sizes = every.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).agg(F.sum("n").alias("n_points"), (F.max("n") <= limit + slack).alias("bounded"))
    a, b, _ = P.co_partition(p.filter("k % 2 = 0"), p.filter("k % 7 = 0"), limit)
    pairs = a.alias("a").join(b.alias("b"), ["part_key", "x", "y"]).agg(
        F.count("*").alias("n_pairs"), F.sum(F.col("a.k") * F.col("b.k")).alias("sum_keys"))
    even = p.filter("k % 2 = 0").agg(F.count("*").alias("n_even"))
    one = [t.withColumn("_one", F.lit(1)) for t in (sizes, even, pairs)]
    return one[0].join(one[1], "_one").join(one[2], "_one").select("n_points", "bounded", "n_even", "n_pairs", "sum_keys")


_CENTRES = "select s_suppkey as q, (minx + maxx) / 2 as x, (miny + maxy) / 2 as y from (select rect_id as s_suppkey, * from rects)"


@query("knn_join", X.with_ctes(
    "select q as rect_id, pid, round(dist, 6) as dist, rank from (select q, pid, sqrt((s.x - c.x) * (s.x - c.x) + (s.y - c.y) * (s.y - c.y)) as dist, "
    "row_number() over (partition by q order by sqrt((s.x - c.x) * (s.x - c.x) + (s.y - c.y) * (s.y - c.y)), pid) as rank from sites s, c) where rank <= 7",
    rects=X.RECTS_SQL, sites=X.SITES_SQL, c=_CENTRES))
def q_knn_join(spark, sf):
    """The seven sites nearest to the centre of each rectangle."""
    c = X.rects(spark, sf).selectExpr("rect_id", "(minx + maxx) / 2 as x", "(miny + maxy) / 2 as y")
    return N.knn_join(c, X.sites(spark, sf), 7, "rect_id", "pid").select("rect_id", "pid", F.round("dist", 6).alias("dist"), "rank")


@query("knn_tiles", X.with_ctes(
    f"select x, y, z, round(sqrt((x - {d(284333.3)}) * (x - {d(284333.3)}) + (y - {d(5653777.7)}) * (y - {d(5653777.7)})), 6) as dist from pts "
    f"order by sqrt((x - {d(284333.3)}) * (x - {d(284333.3)}) + (y - {d(5653777.7)}) * (y - {d(5653777.7)})), z, intensity limit 50", **PTS))
def q_knn_tiles(spark, sf):
    """The 50 points nearest to a place, in a table of tiles."""
    out = N.knn_tiles(spark, _tile_table(spark, sf), 50, 284333.3, 5653777.7, "z", "intensity")
    return out.select("x", "y", "z", F.round("dist", 6).alias("dist"))
