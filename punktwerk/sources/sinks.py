"""Writers: the partitioned point table (create + idempotent append), point
CSV and GeoJSON features."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punktwerk.functions.crs import srid_of
from punktwerk.functions.geojson import feature
from punktwerk.sources.points import POINT_COLUMNS

POINT_TABLE_DDL = """
CREATE TABLE IF NOT EXISTS {name} (
    x DOUBLE COMMENT 'easting in metres',
    y DOUBLE COMMENT 'northing in metres',
    z DOUBLE COMMENT 'height in metres',
    intensity INT COMMENT 'strength of the echo',
    return_num INT COMMENT 'which echo of the pulse',
    classification INT COMMENT 'class code',
{extra}    source_file STRING COMMENT 'tile of origin'
)
USING {using}
PARTITIONED BY (source_file)
{location}
TBLPROPERTIES ('parquet.compression' = 'SNAPPY')
"""


def create_point_table(spark: SparkSession, name: str, location: str | None = None,
                       using: str = "parquet", geohash: bool = False) -> None:
    """Create the point table (partitioned by tile) if it does not exist;
    with ``geohash`` it has a column for the points' cell."""
    loc = f"LOCATION '{location}'" if location else ""
    extra = "    geohash STRING COMMENT 'geohash cell',\n" if geohash else ""
    spark.sql(POINT_TABLE_DDL.format(name=name, using=using, location=loc, extra=extra))


def _by_tile(df: DataFrame) -> DataFrame:
    # AQE rebalance on the partition column: one writer per tile where tiles
    # are small, a skewed (huge) tile is split over several tasks/files.
    return df.hint("rebalance", "source_file")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """A session setting for the length of one write."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def append_points(df: DataFrame, table: str | None = None, path: str | None = None,
                  replace_tiles: bool = True, extra_columns: tuple[str, ...] = ()) -> None:
    """Append points (six columns + source_file) to the partitioned table.

    With ``replace_tiles`` the write uses dynamic partition overwrite: the
    tiles present in ``df`` are replaced, all other tiles are kept, so
    re-ingesting a tile is idempotent instead of duplicating its rows."""
    out = _by_tile(df.select(*POINT_COLUMNS, *extra_columns, "source_file"))
    mode = "overwrite" if replace_tiles else "append"
    if table is not None:
        # ``insertInto`` ignores the writer option: only the session setting
        # keeps the other tiles of a catalog table
        with _setting(df.sparkSession, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            out.write.insertInto(table, overwrite=replace_tiles)
    else:
        out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("source_file").parquet(path)


def write_points_csv(df: DataFrame, path: str) -> None:
    df.select(*POINT_COLUMNS).write.mode("overwrite").option("header", True).csv(path)


def write_geojson(df: DataFrame, path: str, geom: str = "geom", properties=None, srid: int | None = None) -> None:
    """One GeoJSON Feature per line, coordinates as stored. The reference
    frame (``srid``, or what the shape column's metadata says) is named by a
    ``crs`` member of each feature."""
    props = properties or [c for c in df.columns if c != geom]
    srid = srid if srid is not None else srid_of(df, geom)
    value = feature(geom, F.struct(*props))
    if srid is not None:
        crs = f'{{"crs":{{"type":"name","properties":{{"name":"EPSG:{int(srid)}"}}}},'
        value = F.concat(F.lit(crs), F.expr("substring(_v, 2)"))
        df = df.withColumn("_v", feature(geom, F.struct(*props)))
    df.select(value.alias("value")).write.mode("overwrite").text(path)


def write_text_files(lines: DataFrame, path: str, group: str, header: list[str] | None = None,
                     footer: list[str] | None = None) -> None:
    """Write text lines as one file per ``group`` value, each file framed
    by the given header and footer lines (a preamble, an XML root element).
    ``lines`` has columns (group, value)."""
    header, footer = header or [], footer or []
    body = lines.select(group, F.lit(len(header)).alias("_ord"), "value")
    groups = lines.select(group).distinct()
    frame = [(i, t) for i, t in enumerate(header)] + [(len(header) + 1 + i, t) for i, t in enumerate(footer)]
    if frame:
        fr = F.array(*[F.struct(F.lit(o).alias("_ord"), F.lit(t).alias("value")) for o, t in frame])
        body = body.unionByName(groups.select(group, F.inline(fr)))
    out = body.repartition(group).sortWithinPartitions(group, "_ord").select(group, "value")
    out.write.partitionBy(group).text(path)


def drop_point_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """Column, type and comment rows plus table details (location, provider,
    partitioning)."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}")


def to_pandas(df: DataFrame, geom: str | None = None, max_rows: int = 1_000_000):
    """Hand a bounded result to pandas (plotting, GIS tools): shapes become
    WKT text. Raises instead of pulling more than ``max_rows`` rows to the
    driver; reduce or sample with Spark first."""
    from punktwerk.functions.geom import st_astext
    out = df.withColumn(geom, st_astext(geom)) if geom else df
    head = out.limit(max_rows + 1).toPandas()
    if len(head) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; reduce it in Spark first")
    return head
