"""Shape readers: WKT / WKB (hex) in delimited text, GeoJSON features one
per line. Each returns the shape struct plus flat bbox columns and the
remaining attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punktwerk.functions.geojson import st_geomfromgeojson
from punktwerk.functions.geom import st_geomfromtext, with_bbox
from punktwerk.functions.wkb import st_geomfromwkb


def _finish(df: DataFrame, allow_invalid: bool) -> DataFrame:
    if not allow_invalid:
        df = df.filter(F.col("geom").isNotNull())
    return with_bbox(df, "geom")


def read_wkt(spark: SparkSession, path: str, sep: str = "\t", geom_col: int = 0,
             allow_invalid: bool = True) -> DataFrame:
    """Delimited text with WKT in column ``geom_col``; the other columns are
    kept as _c* attributes. Unparseable WKT -> null geom (kept unless
    ``allow_invalid=False``)."""
    raw = spark.read.option("header", False).option("sep", sep).option("quote", "\u0000").csv(path)
    g = raw.columns[geom_col]
    df = raw.withColumn("geom", st_geomfromtext(g)).withColumnRenamed(g, "wkt")
    return _finish(df, allow_invalid)


def read_wkb(spark: SparkSession, path: str, sep: str = "\t", geom_col: int = 0,
             allow_invalid: bool = True) -> DataFrame:
    """Delimited text with hex-encoded WKB in column ``geom_col``."""
    raw = spark.read.option("header", False).option("sep", sep).csv(path)
    g = raw.columns[geom_col]
    df = raw.withColumn("geom", st_geomfromwkb(F.unhex(F.col(g)))).drop(g)
    return _finish(df, allow_invalid)


def read_geojson(spark: SparkSession, path: str, properties_schema: str | None = None,
                 allow_invalid: bool = True) -> DataFrame:
    """GeoJSON Features, one per line (a trailing comma is tolerated):
    ``properties`` become columns, ``geometry`` becomes the shape. A line that
    is no feature gives a row with a null shape (dropped with
    ``allow_invalid=False``); empty lines and lone brackets are layout."""
    lines = spark.read.text(path).select(F.regexp_replace(F.trim("value"), ",$", "").alias("js")) \
        .filter(~F.col("js").rlike(r"^[\[\]{}\s]*$"))
    if properties_schema is None:
        props = F.from_json(F.get_json_object("js", "$.properties"), "map<string,string>")
        df = lines.select(props.alias("properties"),
                          st_geomfromgeojson(F.get_json_object("js", "$.geometry")).alias("geom"))
    else:
        df = lines.select(F.from_json(F.get_json_object("js", "$.properties"), properties_schema).alias("p"),
                          st_geomfromgeojson(F.get_json_object("js", "$.geometry")).alias("geom"))
        df = df.select("p.*", "geom")
    return _finish(df, allow_invalid)
