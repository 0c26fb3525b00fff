"""Batch ingest of point tiles: LAS files -> points with tile lineage and a
geohash -> the point table partitioned by tile (tiles present in the run
are replaced, so re-running a tile does not duplicate it)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from punktwerk.functions.geohash import with_geohash
from punktwerk.sources.las import read_las
from punktwerk.sources.sinks import append_points


def ingest_las(spark: SparkSession, src: str, table_path: str | None = None, srid: int = 25832,
               precision: int = 6, points_per_split: int = 1_000_000,
               glob: str = "*.las", table: str | None = None) -> DataFrame:
    """Ingest every LAS tile under ``src`` in one distributed job, into a
    folder or (``table``) a catalog table made with ``geohash=True``; returns
    the failures (path, name, error) of files that could not be read or
    held no points."""
    pts, failures = read_las(spark, src, points_per_split=points_per_split, glob=glob)
    enriched = with_geohash(pts, "x", "y", srid=srid, precision=precision)
    append_points(enriched, table=table, path=None if table else table_path, extra_columns=("geohash",))
    return failures
