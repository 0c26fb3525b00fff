"""Point readers: CSV with header, headerless text, typed text with a
coordinate offset, file manifests and lineage."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The six point columns and their types.
POINT_SCHEMA = T.StructType([
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("z", T.DoubleType()),
    T.StructField("intensity", T.IntegerType()),
    T.StructField("return_num", T.IntegerType()),
    T.StructField("classification", T.IntegerType()),
])
POINT_COLUMNS = [f.name for f in POINT_SCHEMA.fields]


def read_points_csv(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    """Point CSV files with a header line and the six point columns (no
    schema inference: the schema is fixed)."""
    return spark.read.schema(POINT_SCHEMA).option("header", True).option("mode", mode).csv(path)


def source_file(level: str = "file") -> Column:
    """Lineage of each row: the basename of the file it was read from
    (``level='file'``) or of its parent directory, without a ``key=``
    prefix (``level='dir'``, for tables partitioned by file)."""
    p = F.col("_metadata.file_path")
    if level == "file":
        return F.substring_index(p, "/", -1)
    parent = F.substring_index(F.substring_index(p, "/", -2), "/", 1)
    return F.regexp_replace(parent, r"^[^=]*=", "")


def with_source_file(df: DataFrame, name: str = "source_file", level: str = "file") -> DataFrame:
    return df.withColumn(name, source_file(level))


def file_manifest(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True,
                  require: bool = True) -> DataFrame:
    """Files under ``root`` whose name matches ``glob``: path, name, length,
    modificationTime. File contents are never read (only listed columns are
    selected, so the binary source prunes ``content``). Raises when nothing
    matches and ``require``."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", str(recursive).lower()).load(root)
          .select("path", F.substring_index("path", "/", -1).alias("name"), "length", "modificationTime"))
    if require and df.isEmpty():
        raise FileNotFoundError(f"no file matching {glob!r} under {root}")
    return df


def read_headerless(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Delimited text without a header: positional string columns _c0.._cN,
    as many as the longest row has (one narrow aggregate finds out), so no
    field of a ragged file is dropped; shorter rows end in nulls."""
    fields = F.size(F.split("value", re.escape(sep)))
    width = spark.read.text(path).agg(F.max(fields)).first()[0] or 1
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
    return spark.read.schema(schema).option("header", False).option("sep", sep).csv(path)


def read_typed_points(spark: SparkSession, path: str, offset: int = 0, sep: str = ",",
                      carry_attributes: bool = True, partitions: int | None = None) -> DataFrame:
    """Point text where the two coordinates start at column ``offset``; the
    other columns are kept as string attributes attr1..attrN (before the
    offset first, then after) when ``carry_attributes``."""
    parts = F.split(F.col("value"), sep)
    df = spark.read.text(path).filter(F.length(F.trim("value")) > 0).select(parts.alias("_p"))
    n = F.size("_p")
    attrs = F.concat(F.slice("_p", 1, offset) if offset > 0 else F.array().cast("array<string>"),
                     F.slice("_p", F.lit(offset + 3), F.greatest(n - offset - 2, F.lit(0))))
    out = df.select(F.get("_p", offset).try_cast("double").alias("x"),
                    F.get("_p", offset + 1).try_cast("double").alias("y"),
                    attrs.alias("_attrs"), n.alias("_n"))
    if carry_attributes:
        width = out.agg(F.max(F.size("_attrs"))).first()[0] or 0
        out = out.select("x", "y", *[F.get("_attrs", i).alias(f"attr{i + 1}") for i in range(width)])
    else:
        out = out.select("x", "y")
    return out.repartition(partitions) if partitions else out


def read_typed_rectangles(spark: SparkSession, path: str, offset: int = 0, sep: str = ",") -> DataFrame:
    """Rectangles as four numbers starting at ``offset`` (x1, x2, y1, y2 in
    any order per axis) -> minx, miny, maxx, maxy."""
    parts = F.split(F.col("value"), sep)
    df = spark.read.text(path).select(parts.alias("_p"))
    a, b, c, d = (F.get("_p", offset + i).try_cast("double") for i in range(4))
    return df.select(F.least(a, b).alias("minx"), F.least(c, d).alias("miny"),
                     F.greatest(a, b).alias("maxx"), F.greatest(c, d).alias("maxy"))


def read_typed_shapes(spark: SparkSession, path: str, kind: str, offset: int = 0, sep: str = ",") -> DataFrame:
    """Polygons / linestrings as a flat coordinate list x1,y1,x2,y2,...
    starting at ``offset`` -> shape struct (polygon rings are closed)."""
    from punktwerk.functions.geom import PARTS_T
    parts = F.split(F.col("value"), sep)
    df = spark.read.text(path).select(parts.alias("_p"))
    nums = F.transform(F.slice("_p", F.lit(offset + 1), F.greatest(F.size("_p") - offset, F.lit(0))), lambda s: s.try_cast("double"))
    npts = F.floor(F.size(nums) / 2).cast("int")
    # at least one coordinate pair and all of them numbers; else no shape
    good = (npts > 0) & F.forall(F.slice(nums, F.lit(1), npts * 2), lambda v: v.isNotNull())
    verts = F.when(good, F.transform(F.sequence(F.lit(0), F.greatest(npts, F.lit(1)) - 1),
                                     lambda i: F.struct(F.get(nums, i * 2).alias("x"), F.get(nums, i * 2 + 1).alias("y"))))
    if kind.upper() == "POLYGON":
        ring = F.when(F.get(verts, 0) == F.element_at(verts, -1), verts).otherwise(
            F.concat(verts, F.array(F.get(verts, 0))))
        gt = "POLYGON"
    else:
        ring, gt = verts, "LINESTRING"
    return df.select(F.when(verts.isNotNull(), F.struct(
        F.lit(gt).alias("gtype"), F.array(F.array(ring)).cast(PARTS_T).alias("parts"))).alias("geom"))


def first_match(spark: SparkSession, root: str, glob: str) -> str:
    """Path of the first file (by name) under ``root`` matching ``glob``;
    raises when there is none. Only names are listed, nothing is read."""
    row = file_manifest(spark, root, glob).orderBy("name").select("path").first()
    return row["path"]
