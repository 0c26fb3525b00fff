"""Continuous ingest of point tiles into a table with a commit log.

CSV or LAS files that arrive in a folder become points of ``tile_log``: each
micro-batch is one commit under the name of the stream and the batch. A
replayed batch finds its commit published and does nothing, or writes it again
from the start; readers see a batch whole or not at all, and no file is moved
or deleted on the driver.

With ``lineage="file"`` the file name is the tile and each file is a
delivery: a file of that name that comes later, in whatever folder, replaces
it, also while the stream runs; of those in one batch the one modified last
counts. With ``lineage="dir"`` the folder is the tile, and what one listing of
the landing folder finds is one delivery of its tiles, a wave. The waves are
kept beside the checkpoint: when a batch holds a file that no wave has, the
folder is listed and the files that are new to it become the next wave. The
files of a tile in one wave add up, over however many batches; a tile that
comes again in a later wave replaces what the table had of it.
``redelivery="append"`` is for tiles whose files arrive slowly: all commits
add up. A tile that another stream delivers replaces this one's.

Binary tiles pass a header check first. What fails (no LAS file, compressed,
truncated, no points) goes to the quarantine with an error text and the
number of points that the header names; the rest is cut into record ranges
and decoded in Arrow batches, whatever the size of a file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punktwerk.sources.las import points_of
from punktwerk.sources.points import POINT_COLUMNS
from punktwerk.sources.tile_log import APPEND, _exists, commit_points, commits
from punktwerk.streaming.ingest import MAX_FILES_PER_TRIGGER, _same_path, read_point_stream, route_valid_invalid

BINARY = "path string, modificationTime timestamp, length long, content binary"
QUARANTINE = "source_file string, path string, raw string, n_points long, error string"


def _tile(path: str, lineage: str):
    if lineage == "file":
        return F.substring_index(path, "/", -1)
    return F.regexp_replace(F.substring_index(F.substring_index(path, "/", -2), "/", 1), r"^[^=]*=", "")


def _listing(spark: SparkSession, src: str, glob: str) -> DataFrame:
    """(path, modified) of the files of the landing folder that aren't empty."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(src)
            .filter("length > 0").select(_same_path(F.col("_metadata.file_path")), F.col("modificationTime").alias("modified")))


def _waves(spark: SparkSession, files: DataFrame, src: str, glob: str, checkpoint: str) -> DataFrame:
    """(path, wave) of the files of a batch. A replay finds the waves that
    the first try wrote."""
    kept, schema = f"{checkpoint}/waves", "path string, wave int"
    known = spark.read.schema(schema).parquet(kept) if _exists(spark, kept) else spark.createDataFrame([], schema)
    new = files.join(known, "path", "left_anti")
    if not new.isEmpty():
        number = (known.agg(F.max("wave")).first()[0] or 0) + 1
        here = _listing(spark, src, glob).select("path").unionByName(new.select("path")).distinct().join(known, "path", "left_anti")
        here.write.mode("overwrite").parquet(f"{kept}/wave={number}")
        known = spark.read.schema(schema).parquet(kept)
    return files.join(known, "path")


def _deliveries(files: DataFrame, stream: str, src: str, glob: str, checkpoint: str, lineage: str) -> DataFrame:
    """(path, tile, delivery) of the files of a batch that count: of each
    tile those of its newest delivery."""
    if lineage == "file":
        best = files.groupBy("tile").agg(F.max(F.struct("modified", "path")).alias("b")).select(F.col("b.path").alias("path"))
        return files.join(best, "path").withColumn("delivery", F.concat(
            F.lit(f"{stream}-"), F.date_format("modified", "yyyyMMddHHmmssSSSSSS"), F.lit("-"), F.md5(F.col("path").cast("binary"))))
    files = _waves(files.sparkSession, files, src, glob, checkpoint)
    best = files.groupBy("tile").agg(F.max("wave").alias("wave"))
    return files.join(best, ["tile", "wave"]).withColumn("delivery", F.format_string(f"{stream}-%09d", "wave"))


def _writer(src: str, table: str, quarantine: str | None, checkpoint: str, binary: bool, glob: str, lineage: str, redelivery: str, points_per_split: int):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
        commit = f"{stream}-{batch_id:09d}"
        if not commits(spark, table).filter(F.col("commit") == commit).isEmpty():
            return
        batch = batch.persist()
        try:
            files = batch.groupBy("path").agg(F.max("modified").alias("modified")).withColumn("tile", _tile("path", lineage))
            if redelivery == "append":
                files = files.withColumn("delivery", F.lit(APPEND))
            else:
                files = _deliveries(files, stream, src, glob, checkpoint, lineage)
            files = files.select("path", F.col("tile").alias("source_file"), "delivery").checkpoint()
            if binary:
                taken = batch.join(files.select("path"), "path", "left_semi")
                valid, failed = points_of(taken.select("path", "length"), points_per_split)
                # a tile is named by its file; its delivery comes back by that name
                valid = valid.join(files.select("source_file", "delivery").distinct(), "source_file")
                bad = failed.select(F.col("name").alias("source_file"), "path", F.lit(None).cast("string").alias("raw"), "n_points", "error")
            else:
                valid, bad = route_valid_invalid(batch.drop("source_file").join(files.withColumnRenamed("path", "_p"), F.col("path") == F.col("_p")))
                valid = valid.join(files.select("source_file", "delivery").distinct(), "source_file")
                bad = bad.select("source_file", F.lit(None).cast("string").alias("path"), "raw", F.lit(None).cast("long").alias("n_points"), "error")
            if quarantine is not None:
                bad.write.mode("overwrite").parquet(f"{quarantine}/commit={commit}")
            commit_points(valid.select(*POINT_COLUMNS, "source_file", "delivery"), table, commit)
        finally:
            batch.unpersist()
    return write


def stream_tiles(spark: SparkSession, src: str, table: str, checkpoint: str, quarantine: str | None = None, binary: bool = False,
                 lineage: str = "file", redelivery: str = "replace", glob: str | None = None, max_files: int | None = MAX_FILES_PER_TRIGGER,
                 max_bytes: int | None = None, available_now: bool = True, processing_time: str | None = None, points_per_split: int = 1_000_000):
    """Starts the ingest of the CSV files (``binary``: LAS files) of ``src``;
    returns the StreamingQuery. It stops when all is read (``available_now``)
    or runs on with a trigger every ``processing_time``."""
    if redelivery not in ("replace", "append") or lineage not in ("file", "dir"):
        raise ValueError(f"{redelivery!r}, {lineage!r}")
    if binary and lineage != "file":
        raise ValueError("a binary tile is a file")
    glob = glob or ("*.las" if binary else "*.csv")
    if binary:
        reader = spark.readStream.format("binaryFile").schema(BINARY).option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
        reader = reader.option("maxBytesPerTrigger", int(max_bytes)) if max_bytes else reader.option("maxFilesPerTrigger", int(max_files or MAX_FILES_PER_TRIGGER))
        # the content is not selected, so it is not read here
        raw = reader.load(src).select(_same_path(F.col("path")), "length", F.col("modificationTime").alias("modified"))
    else:
        raw = read_point_stream(spark, src, max_files=max_files, max_bytes=max_bytes, lineage=lineage, glob=glob).select(
            *POINT_COLUMNS, "_corrupt_record", "source_file", _same_path(F.col("_metadata.file_path")), F.col("_metadata.file_modification_time").alias("modified"))
    write = _writer(src, table, quarantine, checkpoint, binary, glob, lineage, redelivery, points_per_split)
    w = raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
