"""Queries that must not grow in one task, on the driver or by the square."""

from pyspark.sql import functions as F

from punktwerk.functions.curve import z_order
from punktwerk.operators import joins as J
from punktwerk.plans import catalog, catalog_tiles  # noqa: F401  (registers queries)
from punktwerk.plans import fixtures as X
from punktwerk.plans import registry
from punktwerk.sources import tile_log as TL


def tables(spark, path, n: int = 400) -> str:
    """Small tables of the queries' schema, with a row that comes twice."""
    k = F.col("id")
    base = spark.range(n).union(spark.range(1))
    base.select((k * 37 + 1).alias("o_orderkey"), (k * 11 % 97).alias("o_custkey")).write.parquet(f"{path}/orders.parquet")
    base.select((k * 7 + 1).alias("l_orderkey"), (k * 13 % 101).alias("l_partkey"), (k * 3 % 29).alias("l_suppkey"), (k % 5).alias("l_linenumber"),
                (1.0 + k % 50).alias("l_quantity")).write.parquet(f"{path}/lineitem.parquet")
    base.filter("id < 60").select((k + 1).alias("s_suppkey")).write.parquet(f"{path}/supplier.parquet")
    base.filter("id < 60").select((k + 1).alias("c_custkey")).write.parquet(f"{path}/customer.parquet")
    return str(path)


def run(spark, name, sf):
    return registry.QUERIES[name](spark, sf)


def test_reprojected_points_are_planned_apart(spark, tmp_path):
    """the join's plan names columns, not the formulas behind them."""
    df = run(spark, "reprojected_neighbours", tables(spark, tmp_path))
    assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    assert df.count() >= 401


def test_reprojected_points_are_rounded_once(spark, tmp_path):
    """no pair is rounded, and the columns are those of its first point."""
    df = run(spark, "reprojected_neighbours", tables(spark, tmp_path))
    assert "round(" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.dtypes == [("id_1", "bigint"), ("id_2", "bigint"), ("x", "double"), ("y", "double")]
    assert df.filter((F.round("x", 3) != F.col("x")) | (F.round("y", 3) != F.col("y"))).isEmpty()


def test_counts_equal_the_join(spark):
    """whole cells by their counts give what the pairs give."""
    rows = [(i, (i * 37 % 101) / 4, (i * 53 % 97) / 4) for i in range(700)] + [(700, None, 1.0), (701, float("nan"), 1.0), (702, 5.0, 5.0)]
    pts = spark.createDataFrame(rows, "pid long, x double, y double")
    rects = [(1, 2.0, 2.0, 9.0, 9.0), (1, 2.0, 2.0, 9.0, 9.0), (2, 0.25, 0.5, 25.0, 24.0), (3, 4.0, 4.0, 4.0, 20.0), (4, 90.0, 90.0, 95.0, 95.0), (None, 1.0, 1.0, 3.0, 3.0)]
    shapes = spark.createDataFrame(rects, "rect_id long, minx double, miny double, maxx double, maxy double")
    for predicate in ("covers", "contains"):
        got = sorted(map(tuple, J.spatial_join_counts(shapes, pts, "rect_id", predicate, cell=4.0).collect()), key=str)
        pairs = J.spatial_join(shapes, pts, predicate, cell=4.0)
        assert got == sorted(map(tuple, pairs.groupBy("rect_id").count().collect()), key=str)
        text = J.spatial_join_counts(shapes, pts, "rect_id", predicate, cell=4.0)._jdf.queryExecution().analyzed().toString()
        assert "_n#" in text


def test_tiles_are_written_by_many_tasks(spark, tmp_path):
    """F7, F8: a file of a tile is one task's own share, and all rows come."""
    sf = tables(spark, tmp_path / "t")
    p = X.pts(spark, sf, with_source=True)
    X.write_parts(p, f"{tmp_path}/out", 3)
    back = spark.read.option("recursiveFileLookup", True).option("header", True).csv(f"{tmp_path}/out").select("*", F.col("_metadata.file_path").alias("f"))
    assert back.count() == p.count()
    files = back.select("f").distinct().withColumn("tile", F.substring_index(F.substring_index("f", "/", -2), "/", 1))
    assert files.groupBy("tile").count().agg(F.max("count")).first()[0] == 3
    assert p.select("source_file").distinct().count() == files.select("tile").distinct().count()


def test_texts_of_shapes_are_read_once(spark, tmp_path):
    """F16, F17: no rows are compared with a text that is parsed for each."""
    sf = tables(spark, tmp_path)
    for name in ("sql_region_stats", "knn_shapes"):
        df = run(spark, name, sf)
        assert "regexp_replace" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_commits_sort_by_columns(spark, tmp_path):
    """the sort of a commit compares a key that is there, and
    no rows are sorted for their delivery; files follow the curve."""
    p = X.pts(spark, tables(spark, tmp_path / "t"), with_source=True)
    rows = p.withColumn("tile", TL.tile_folder(F.col("source_file"))).withColumn("delivery", F.concat(F.lit("d"), F.col("intensity") % 2))
    plan = TL._along_curve(rows)._jdf.queryExecution().optimizedPlan().toString()
    sort = next(line for line in plan.splitlines() if "Sort [" in line)
    assert "_z#" in sort and "shiftleft" not in sort
    scan = TL._newest(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert scan.count("Aggregate [tile#") == 2
    newest = {r.tile: r.delivery for r in TL._newest(rows).collect()}
    assert newest == {r.tile: r.m for r in rows.groupBy("tile").agg(F.max("delivery").alias("m")).collect()}
    TL.commit_points(p, f"{tmp_path}/table", "c1")
    back = spark.read.schema(TL.DATA).parquet(f"{tmp_path}/table/data/commit=c1").select(
        F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("at"), z_order("x", "y").alias("z"))
    by_file = back.groupBy("f").agg(F.array_sort(F.collect_list(F.struct("at", "z")))["z"].alias("z"))
    assert back.count() == p.count() and by_file.filter(F.sort_array("z") != F.col("z")).isEmpty()
