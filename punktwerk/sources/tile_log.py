"""A point table whose deliveries become visible at once.

Data files are written where no reader looks, one folder per commit and tile;
a commit also writes one manifest row per tile: its delivery and its
statistics (a zone map). A commit is published by one small numbered file,
created only if that number is free. Readers list those files first: what they
see is a snapshot, whatever happens while they read. Nothing is renamed and
nothing is deleted by a writer; ``vacuum`` removes replaced folders later.

A tile shows the rows of its newest delivery: the one whose first commit has
the highest number. The commits of one delivery add up, so a tile may come in
several micro-batches. A commit that is written again under its old name (a
replayed batch) replaces its own unpublished files, or is skipped once it is
published.

Layout: ``data/commit=<id>/tile=<hash>/``, ``_log/manifest/commit=<id>/``,
``_log/commits/<number>``. Inside a tile rows are sorted along a Z-order
curve, so row-group statistics prune in x and in y."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punktwerk.functions.curve import z_order
from punktwerk.functions.geom import Shape, bbox_filter_literal, contains_literal, exact_literal, parse_wkt_literal
from punktwerk.operators.aggs import GROUND
from punktwerk.sources.points import POINT_COLUMNS

APPEND = "append"       # a delivery that all commits add to
DATA = "x double, y double, z double, intensity int, return_num int, classification int, source_file string"
MANIFEST = ("source_file string, tile string, delivery string, n_points long, minx double, maxx double, miny double, maxy double, "
            "n_z long, minz double, maxz double, sum_z double, strays long, classes map<int,bigint>, commit string")


def _fs(spark: SparkSession, path: str):
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return new(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), new


def _exists(spark: SparkSession, path: str) -> bool:
    fs, new = _fs(spark, path)
    return fs.exists(new(path))


def tile_folder(tile: Column) -> Column:
    """A folder name for any tile name."""
    return F.substring(F.md5(tile.cast("binary")), 1, 20)


def commits(spark: SparkSession, table: str) -> DataFrame:
    """(seq, commit) of the published commits."""
    path = f"{table}/_log/commits"
    if not _exists(spark, path):
        return spark.createDataFrame([], "seq long, commit string")
    return spark.read.text(path).select(F.substring_index("_metadata.file_path", "/", -1).cast("long").alias("seq"), F.col("value").alias("commit"))


def _publish(spark: SparkSession, table: str, commit: str) -> int:
    """Takes the first free number; where another writer was faster, the next
    one is tried. A number whose file is still empty publishes nothing."""
    folder = f"{table}/_log/commits"
    fs, new = _fs(spark, folder)
    fs.mkdirs(new(folder))
    names = [st.getPath().getName() for st in fs.listStatus(new(folder))]
    seq = max((int(n) for n in names if n.isdigit()), default=-1) + 1
    while True:
        try:
            out = fs.create(new(f"{folder}/{seq:012d}"), False)
        except Exception as e:
            if "FileAlreadyExists" not in str(e):
                raise
            seq += 1
            continue
        out.write(bytearray(commit.encode()))
        out.close()
        return seq


def _statistics(points: DataFrame) -> DataFrame:
    """Per tile: what the zone map knows. ``strays`` are rows without a place."""
    placed = F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y")
    by_class = points.groupBy("source_file", "tile", "classification").agg(
        F.count("*").alias("n"), *[f(F.when(placed, F.col(c))).alias(f"{s}{c}") for c in ("x", "y") for f, s in ((F.min, "min"), (F.max, "max"))],
        F.count("z").alias("nz"), F.min("z").alias("minz"), F.max("z").alias("maxz"), F.sum("z").alias("sum_z"), F.count_if(~placed).alias("strays"))
    return by_class.groupBy("source_file", "tile").agg(
        F.sum("n").alias("n_points"), *[f(c).alias(c) for c, f in (("minx", F.min), ("maxx", F.max), ("miny", F.min), ("maxy", F.max))],
        F.sum("nz").alias("n_z"), F.min("minz").alias("minz"), F.max("maxz").alias("maxz"), F.sum("sum_z").alias("sum_z"), F.sum("strays").alias("strays"),
        F.map_from_entries(F.filter(F.collect_list(F.struct("classification", "n")), lambda e: e["classification"].isNotNull())).alias("classes"))


def _along_curve(rows: DataFrame) -> DataFrame:
    """Rows dealt by tile and sorted along the curve in each. The curve's key
    is a column meanwhile: a sort expression is worked out anew for each
    comparison."""
    return rows.hint("rebalance", "tile").withColumn("_z", z_order("x", "y")).sortWithinPartitions("tile", "_z").drop("_z")


def _newest(rows: DataFrame) -> DataFrame:
    """(tile, delivery): the greatest text of the few distinct ones; that of
    all rows would sort them. The count keeps the two steps apart."""
    return rows.groupBy("tile", "delivery").count().filter("count > 0").groupBy("tile").agg(F.max("delivery").alias("delivery"))


def commit_points(points: DataFrame, table: str, commit: str | None = None, delivery: str | None = None) -> str:
    """Writes ``points`` (six columns, source_file, optionally ``delivery``) as
    one commit; all its tiles become visible together. Without a delivery the
    commit is one of its own and replaces the tiles it holds; with
    ``APPEND`` it adds to them. Returns the commit's name."""
    spark = points.sparkSession
    commit = commit or uuid.uuid4().hex
    if not commits(spark, table).filter(F.col("commit") == commit).isEmpty():
        return commit
    folder, manifest = f"{table}/data/commit={commit}", f"{table}/_log/manifest/commit={commit}"
    own = F.col("delivery") if "delivery" in points.columns else F.lit(delivery or commit)
    rows = points.select(*POINT_COLUMNS, F.coalesce("source_file", F.lit("")).alias("source_file"), own.alias("delivery"))
    rows = rows.withColumn("tile", tile_folder(F.col("source_file")))
    (_along_curve(rows)
     .write.mode("overwrite").partitionBy("tile").parquet(folder))
    written = spark.read.schema(DATA + ", delivery string, tile string").parquet(folder)
    (_statistics(written).join(_newest(written), "tile").select(*[c.split()[0] for c in MANIFEST.split(", ")[:-1]])
     .write.mode("overwrite").parquet(manifest))
    _publish(spark, table, commit)
    return commit


def live(spark: SparkSession, table: str) -> DataFrame:
    """The manifest rows of every tile's newest delivery, with ``seq``."""
    if not _exists(spark, f"{table}/_log/manifest"):
        return spark.createDataFrame([], MANIFEST + ", seq long")
    rows = spark.read.schema(MANIFEST).parquet(f"{table}/_log/manifest").join(commits(spark, table), "commit")
    first = rows.groupBy("tile", "delivery").agg(F.min("seq").alias("first"))
    newest = first.groupBy("tile").agg(F.max(F.struct("first", "delivery")).alias("m")).select("tile", F.col("m.delivery").alias("delivery"))
    return rows.join(newest, ["tile", "delivery"])


def zone_map(spark: SparkSession, table: str) -> DataFrame:
    """One row per tile: its box, counts, height range and class counts."""
    rows = live(spark, table)
    total = rows.groupBy("source_file", "tile").agg(
        F.sum("n_points").alias("n_points"), F.min("minx").alias("minx"), F.max("maxx").alias("maxx"), F.min("miny").alias("miny"),
        F.max("maxy").alias("maxy"), F.sum("n_z").alias("n_z"), F.min("minz").alias("minz"), F.max("maxz").alias("maxz"), F.sum("sum_z").alias("sum_z"),
        F.sum("strays").alias("strays"))
    classes = (rows.select("tile", F.explode("classes").alias("c", "n")).groupBy("tile", "c").agg(F.sum("n").alias("n"))
               .groupBy("tile").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("c", "n")))).alias("classes")))
    return total.join(classes, "tile", "left")


def read_points(spark: SparkSession, table: str, tiles: DataFrame | None = None) -> DataFrame:
    """The points of the table, or of some tiles (column ``tile``). The live
    folders are named to the reader, as many as Spark's own listing holds, so
    replaced ones and other tiles are not even listed."""
    rows = live(spark, table)
    if tiles is not None:
        rows = rows.join(tiles.select("tile"), "tile", "left_semi")
    folders = [f"{table}/data/commit={r['commit']}/tile={r['tile']}" for r in rows.select("commit", "tile").distinct().collect()]
    if not folders:
        return spark.createDataFrame([], DATA)
    return spark.read.schema(DATA).parquet(*folders)


def _meets_edge(shape: Shape) -> Column:
    """Does an edge of the polygon meet a tile's closed box? Exact: a segment
    and a box are apart in x, in y or along the segment's normal."""
    x0, x1, y0, y1 = (F.col(c) for c in ("minx", "maxx", "miny", "maxy"))
    out = F.lit(False)
    for ax, ay, bx, by in shape.edges:
        sides = [F.lit(bx - ax) * (y - F.lit(ay)) - F.lit(by - ay) * (x - F.lit(ax)) for x in (x0, x1) for y in (y0, y1)]
        out = out | ((x0 <= max(ax, bx)) & (x1 >= min(ax, bx)) & (y0 <= max(ay, by)) & (y1 >= min(ay, by))
                     & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0))
    return out


def split_tiles(zones: DataFrame, shape: Shape) -> tuple[DataFrame, DataFrame]:
    """(tiles that lie inside a polygon, tiles that its edges cross); the
    others hold no point of it. A tile with rows without a place is a border
    tile if its box isn't outside."""
    near = zones.filter(bbox_filter_overlap(shape))
    border = _meets_edge(shape)
    inside = ~border & contains_literal(shape, "minx", "miny")
    return near.filter(inside & (F.col("strays") == 0)), near.filter(border | (inside & (F.col("strays") > 0)))


def bbox_filter_overlap(shape: Shape) -> Column:
    x0, y0, x1, y1 = shape.bbox
    return (F.col("maxx") >= x0) & (F.col("minx") <= x1) & (F.col("maxy") >= y0) & (F.col("miny") <= y1)


def region_stats(spark: SparkSession, table: str, region: str | Shape, boundary: bool = False) -> DataFrame:
    """Region statistics as by ``aggs.region_stats``: tiles inside the polygon
    are answered from the zone map, only tiles on its border are read."""
    shape = parse_wkt_literal(region) if isinstance(region, str) else region
    inside, border = split_tiles(zone_map(spark, table), shape)
    known = inside.select(F.col("n_points").alias("n"), F.coalesce(F.try_element_at("classes", F.lit(GROUND)), F.lit(0)).alias("g"),
                          F.col("minz").alias("lo"), F.col("maxz").alias("hi"), "sum_z", "n_z")
    points = read_points(spark, table, border).filter(bbox_filter_literal(shape, "x", "y", boundary))
    hit = exact_literal(shape, "x", "y", boundary)
    z = F.when(hit, F.col("z"))
    read = points.agg(F.count_if(hit).alias("n"), F.count_if(hit & (F.col("classification") == GROUND)).alias("g"),
                      F.min(z).alias("lo"), F.max(z).alias("hi"), F.sum(z).alias("sum_z"), F.count(z).alias("n_z"))
    return known.unionByName(read).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_points"), F.coalesce(F.sum("g"), F.lit(0)).alias("ground_points"),
        F.min("lo").alias("min_z"), F.max("hi").alias("max_z"), F.round(F.sum("sum_z") / F.when(F.sum("n_z") > 0, F.sum("n_z")), 6).alias("avg_z"))


def window_points(spark: SparkSession, table: str, window: tuple[float, float, float, float]) -> DataFrame:
    """The points of a closed window: only tiles whose box meets it are read,
    and in them the row groups that do."""
    x0, y0, x1, y1 = (float(v) for v in window)
    near = zone_map(spark, table).filter((F.col("maxx") >= x0) & (F.col("minx") <= x1) & (F.col("maxy") >= y0) & (F.col("miny") <= y1))
    return read_points(spark, table, near).filter(F.col("x").between(x0, x1) & F.col("y").between(y0, y1))


def vacuum(spark: SparkSession, table: str, older_than: int = 0) -> int:
    """Deletes the folders of replaced deliveries, on the cluster; returns how
    many. Commits with a number of ``older_than`` or more below the newest are
    looked at: leave room for readers that started before the last commits."""
    from punktwerk.session import ship_package
    ship_package(spark)
    done = commits(spark, table)
    newest = done.agg(F.max("seq")).first()[0]
    if newest is None:
        return 0
    every = spark.read.schema(MANIFEST).parquet(f"{table}/_log/manifest").join(done, "commit")
    dead = (every.join(live(spark, table).select("commit", "tile"), ["commit", "tile"], "left_anti")
            .filter(F.col("seq") <= newest - older_than).select(F.concat(F.lit(f"{table}/data/commit="), "commit", F.lit("/tile="), "tile").alias("path")))
    return dead.mapInPandas(_delete, "path string").count()


def _delete(batches):
    from punktwerk.sources.las import _filesystem
    for pdf in batches:
        gone = []
        for path in pdf["path"]:
            fs, at = _filesystem(path)
            if fs.get_file_info(at).type.name == "Directory":
                fs.delete_dir(at)
                gone.append(path)
        yield pdf[pdf["path"].isin(gone)][["path"]]
