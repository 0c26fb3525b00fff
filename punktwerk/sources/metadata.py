"""Tile metadata: XML tile listings, download URLs, the ';'-delimited
metadata files with a preamble, and their curation into the table layout
with owner/standard columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_META_DDL = ("Kachelname STRING, Aktualitaet STRING, Erfassungsmethode INT, Fortfuehrung STRING, "
                "Fortfuehrungsmethode INT, Aufloesung DOUBLE, Koordinatenreferenzsystem_Lage STRING, "
                "Koordinatenreferenzsystem_Hoehe STRING, Hoehenanomalie STRING")
RAW_META_COLUMNS = [c.strip().split()[0] for c in RAW_META_DDL.split(",")]

# The default columns of the curated tile metadata table.
CURATED_DEFAULTS = {
    "Land": "Nordrhein-Westfalen",
    "Eigentuemer": "Land NRW, Bezirksregierung Koeln, Abteilung Geobasis NRW",
    "Version_Standard": "1.2",
    "Punktklassenbelegung": "1,2,14,17,18,20,24,26",
}


def read_tile_index_xml(spark: SparkSession, path: str, row_tag: str = "file") -> DataFrame:
    """Tile listing XML: one row per ``<file name=…>`` element."""
    df = spark.read.format("xml").option("rowTag", row_tag).load(path)
    return df.select(F.col("_name").alias("name"), *[c for c in df.columns if c != "_name"])


def xml_names(xml_col, xpath: str = "//file/@name"):
    """Names from XML text held in a column (in-column XPath)."""
    c = F.col(xml_col) if isinstance(xml_col, str) else xml_col
    return F.xpath(c, F.lit(xpath))


def tile_urls(df: DataFrame, base: str, name_col: str = "name") -> DataFrame:
    """Download URL per tile (``{base}/{name}``) and the file name taken back
    out of the URL."""
    url = F.concat_ws("/", F.lit(base.rstrip("/")), F.col(name_col))
    return df.withColumn("url", url).withColumn("laz_file", F.regexp_extract("url", r"([^/]+)$", 1))


def read_tile_metadata(spark: SparkSession, path: str, skip: int = 7, sep: str = ";") -> DataFrame:
    """';'-separated metadata files whose first ``skip`` lines are a
    preamble, skipped per file. Metadata files are small (one line per
    tile), so each is read whole and its lines are split in Spark."""
    files = spark.read.text(path, wholetext=True)
    lines = files.select(F.posexplode(F.split(F.col("value"), r"\r?\n")).alias("pos", "line"))
    body = lines.filter((F.col("pos") >= skip) & (F.length(F.trim("line")) > 0))
    parsed = body.select(F.from_csv("line", RAW_META_DDL, {"sep": sep}).alias("r"))
    return parsed.select("r.*")


def curate_tile_metadata(raw: DataFrame, as_of: str | None = None, suffix: str = ".laz") -> DataFrame:
    """Curated layout: four constant columns, the curation date
    (``as_of`` or ``current_date()``), the tile name with its file suffix,
    and the nine raw columns."""
    d = F.to_date(F.lit(as_of)) if as_of else F.current_date()
    c = CURATED_DEFAULTS
    return raw.select(
        F.lit(c["Land"]).alias("Land"), F.lit(c["Eigentuemer"]).alias("Eigentuemer"),
        d.alias("Aktualitaet_Kachelinformationen"), F.lit(c["Version_Standard"]).alias("Version_Standard"),
        F.lit(c["Punktklassenbelegung"]).alias("Punktklassenbelegung"),
        F.concat(F.col("Kachelname"), F.lit(suffix)).alias("Kachelname"),
        *RAW_META_COLUMNS[1:])


def tile_join(points: DataFrame, curated: DataFrame) -> DataFrame:
    """Points joined with their tile's metadata by file name (inner). The
    metadata side has one row per tile; AQE turns the join into a broadcast
    join when the measured size of that side allows it."""
    return points.join(curated, points["source_file"] == curated["Kachelname"])
