"""Derived inputs over the driver's tables.

The same expression text runs in Spark (``selectExpr``) and in DuckDB (the
oracle inlines it as CTEs), so both engines see identical doubles. ``cast(…
as double)`` is spelled out because a bare ``280000.0`` is DECIMAL in Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The derivation formulas of the test views (must equal the
# fixture definitions used by the oracle).
PTS_EXPRS = [
    "cast(280000 as double) + ((l_orderkey*7919 + l_partkey*104729 + l_linenumber*613) % 850000)/cast(100 as double) as x",
    "cast(5652000 as double) + ((l_orderkey*6151 + l_suppkey*15485863 + l_linenumber*389) % 400000)/cast(100 as double) as y",
    "cast(40 as double) + l_quantity as z",
    "cast((l_orderkey*31 + l_partkey*17) % 65536 as int) as intensity",
    "cast(1 + l_linenumber % 4 as int) as return_num",
    "cast(case l_partkey % 8 when 0 then 1 when 1 then 2 when 2 then 14 when 3 then 17 "
    "when 4 then 18 when 5 then 20 when 6 then 24 else 26 end as int) as classification",
]
SOURCE_FILE_EXPR = (
    "concat('3dm_32_', cast(cast(floor(x/1000) as int) as string), '_', "
    "cast(cast(floor(y/1000) as int) as string), '_1_nw.laz')")
SITES_EXPRS = [
    "o_orderkey as pid",
    "cast(280000 as double) + ((o_orderkey*7919 + o_custkey*104729) % 850000)/cast(100 as double) as x",
    "cast(5652000 as double) + ((o_orderkey*6151 + o_custkey*15485863) % 400000)/cast(100 as double) as y",
]
RECTS_EXPRS = [
    "s_suppkey as rect_id",
    "cast(280000 + (s_suppkey*8191 % 8000) as double) as minx",
    "cast(5652000 + (s_suppkey*4093 % 3500) as double) as miny",
    "cast(280000 + (s_suppkey*8191 % 8000) + 100 + s_suppkey % 400 as double) as maxx",
    "cast(5652000 + (s_suppkey*4093 % 3500) + 80 + s_suppkey % 300 as double) as maxy",
]
LINES_EXPRS = [
    "c_custkey as line_id",
    "cast(280000 + (c_custkey*8191 % 8400) as double) as x1",
    "cast(5652000 + (c_custkey*4093 % 3900) as double) as y1",
    "cast(280000 + (c_custkey*8191 % 8400) + 40 + c_custkey % 60 as double) as x2",
    "cast(5652000 + (c_custkey*4093 % 3900) + c_custkey % 90 as double) as y2",
]

# The two query polygons of the test views.
POLY1_WKT = ("POLYGON((281000 5652500, 284000 5652500, 284000 5653500, 282500 5653500, "
             "282500 5655500, 281000 5655500, 281000 5652500), "
             "(281500 5653000, 281500 5654000, 282000 5654000, 282000 5653000, 281500 5653000))")
POLY2_WKT = "POLYGON((285000 5652200, 288000 5652800, 286000 5655600, 285000 5652200))"
POLYS = {1: POLY1_WKT, 2: POLY2_WKT}

# Fixed value: the region of the reference's region-statistics query.
REGION_WKT = ("POLYGON((280000 5626000, 280000 5747500, 288500 5747500, "
              "288500 5626000, 280000 5626000))")

# The literal columns of one raw tile-metadata row.
TILE_META_LITERALS = {
    "Aktualitaet": "2020-01-01",
    "Erfassungsmethode": 1,
    "Fortfuehrung": "2021",
    "Fortfuehrungsmethode": 0,
    "Aufloesung": 4.5,
    "Koordinatenreferenzsystem_Lage": "25832",
    "Koordinatenreferenzsystem_Hoehe": "7837",
    "Hoehenanomalie": "GCG2016",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pts(spark: SparkSession, sf_dir: str, with_source: bool = False) -> DataFrame:
    df = table(spark, sf_dir, "lineitem").selectExpr(*PTS_EXPRS)
    if with_source:
        df = df.selectExpr("*", f"{SOURCE_FILE_EXPR} as source_file")
    return df


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*SITES_EXPRS)


def rects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(*RECTS_EXPRS)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*LINES_EXPRS)


def tile_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per distinct tile of ``pts``: Kachelname without '.laz' plus
    the literal attribute columns (the raw 9-column metadata layout)."""
    lit = TILE_META_LITERALS
    return pts(spark, sf_dir, with_source=True).selectExpr(
        "regexp_replace(source_file, '\\\\.laz$', '') as Kachelname").distinct().selectExpr(
        "Kachelname",
        f"'{lit['Aktualitaet']}' as Aktualitaet",
        f"cast({lit['Erfassungsmethode']} as int) as Erfassungsmethode",
        f"'{lit['Fortfuehrung']}' as Fortfuehrung",
        f"cast({lit['Fortfuehrungsmethode']} as int) as Fortfuehrungsmethode",
        f"cast({lit['Aufloesung']} as double) as Aufloesung",
        f"'{lit['Koordinatenreferenzsystem_Lage']}' as Koordinatenreferenzsystem_Lage",
        f"'{lit['Koordinatenreferenzsystem_Hoehe']}' as Koordinatenreferenzsystem_Hoehe",
        f"'{lit['Hoehenanomalie']}' as Hoehenanomalie")


def write_parts(df: DataFrame, path: str, files: int) -> None:
    """CSV files with a header in a folder a tile, ``files`` of each tile:
    its rows by turns. Every file is a task's own share, so many tasks write."""
    df.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(files)).cast("int")) \
        .repartition("source_file", "part").write.partitionBy("part", "source_file").option("header", True).csv(path)


# ---- oracle text (DuckDB) -------------------------------------------------

def _sel(exprs, src):
    return "select " + ", ".join(exprs) + f" from {src}"


PTS_SQL = _sel(PTS_EXPRS, "lineitem")
PTS_SRC_SQL = f"select *, {SOURCE_FILE_EXPR} as source_file from ({PTS_SQL})"
SITES_SQL = _sel(SITES_EXPRS, "orders")
RECTS_SQL = _sel(RECTS_EXPRS, "supplier")
LINES_SQL = _sel(LINES_EXPRS, "customer")


def tile_meta_sql() -> str:
    lit = TILE_META_LITERALS
    return (
        "select Kachelname, "
        f"'{lit['Aktualitaet']}' as Aktualitaet, "
        f"cast({lit['Erfassungsmethode']} as int) as Erfassungsmethode, "
        f"'{lit['Fortfuehrung']}' as Fortfuehrung, "
        f"cast({lit['Fortfuehrungsmethode']} as int) as Fortfuehrungsmethode, "
        f"cast({lit['Aufloesung']} as double) as Aufloesung, "
        f"'{lit['Koordinatenreferenzsystem_Lage']}' as Koordinatenreferenzsystem_Lage, "
        f"'{lit['Koordinatenreferenzsystem_Hoehe']}' as Koordinatenreferenzsystem_Hoehe, "
        f"'{lit['Hoehenanomalie']}' as Hoehenanomalie "
        f"from (select distinct regexp_replace(source_file, '\\.laz$', '') as Kachelname from ({PTS_SRC_SQL}))")


def with_ctes(body: str, **views: str) -> str:
    """Prefix a query with CTEs for the named derived views."""
    if not views:
        return body
    return "with " + ", ".join(f"{k} as ({v})" for k, v in views.items()) + " " + body
