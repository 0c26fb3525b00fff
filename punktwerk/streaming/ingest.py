"""Continuous ingest of point files with Structured Streaming.

New point CSV files arriving in a directory are parsed with the fixed point
schema, tagged with their tile (lineage from the file path), split into
valid rows and quarantined rows, and appended to the point table. The
stream keeps only file-source state in its checkpoint: a restart resumes
with the files not yet committed, and a finished run followed by a rerun
ingests nothing twice.

Each micro-batch is written with ``foreachBatch`` into a folder of its own and
then moved into the tiles' folders, under names that carry the delivery (the
stream and its run) and the batch. A batch that is replayed replaces its own
files, a tile that is delivered again replaces the files of earlier
deliveries, and the batches of one delivery add up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punktwerk.sources.points import POINT_COLUMNS, POINT_SCHEMA, file_manifest, source_file

RAW_SCHEMA = T.StructType(POINT_SCHEMA.fields + [T.StructField("_corrupt_record", T.StringType())])

# Back-pressure limits of the reference flow.
MAX_FILES_PER_TRIGGER = 10_000
MAX_BYTES_PER_TRIGGER = 1024 * 1024 * 1024


def read_point_stream(spark: SparkSession, src_dir: str, max_files: int | None = MAX_FILES_PER_TRIGGER,
                      max_bytes: int | None = None, lineage: str = "dir", glob: str | None = None) -> DataFrame:
    """Streaming DataFrame of raw point rows (PERMISSIVE parse: unparseable
    lines keep their text in ``_corrupt_record``) with ``source_file``.

    Back-pressure: at most ``max_files`` files or ``max_bytes`` bytes per
    micro-batch (Spark accepts only one of the two)."""
    r = (spark.readStream.schema(RAW_SCHEMA).option("header", True).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", "_corrupt_record").option("recursiveFileLookup", "true"))
    if glob is not None:
        r = r.option("pathGlobFilter", glob)
    if max_bytes is not None:
        r = r.option("maxBytesPerTrigger", int(max_bytes))
    elif max_files is not None:
        r = r.option("maxFilesPerTrigger", int(max_files))
    df = r.csv(src_dir)
    return df.withColumn("source_file", source_file(lineage))


def route_valid_invalid(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split parsed rows into (valid points, quarantine). A row is invalid
    when its text did not parse or a coordinate is missing; the quarantine
    keeps the tile, the raw text and an error message."""
    bad = F.col("_corrupt_record").isNotNull() | F.col("x").isNull() | F.col("y").isNull() | F.col("z").isNull()
    valid = raw.filter(~bad).select(*POINT_COLUMNS, "source_file")
    quarantine = raw.filter(bad).select(
        "source_file", F.col("_corrupt_record").alias("raw"),
        F.when(F.col("_corrupt_record").isNotNull(), F.lit("unparseable record"))
        .otherwise(F.lit("missing coordinate")).alias("error"))
    return valid, quarantine


def empty_files(spark: SparkSession, manifest: DataFrame, valid: DataFrame) -> DataFrame:
    """Files of a manifest that produced no valid point (header-only files);
    these go to the failure side with an error text."""
    got = valid.select("source_file").distinct()
    return manifest.join(got, manifest["name"] == got["source_file"], "left_anti") \
        .select(F.col("name").alias("source_file"), F.lit("no points").alias("error"))


def _fs(spark: SparkSession, path: str):
    """(file system, Path class) of a folder, whichever store it is in."""
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return new(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), new


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, without hidden ones; none if it doesn't exist."""
    fs, new = _fs(spark, path)
    names = [st.getPath().getName() for st in fs.listStatus(new(path))] if fs.exists(new(path)) else []
    return [n for n in names if n[0] not in "._"]


def _same_path(c) -> Column:
    """file:/x and file:///x are one path."""
    return F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/").alias("path")


def _run_number(spark: SparkSession, src_dir: str, checkpoint: str) -> int:
    """The number of the delivery that a stream starts or goes on with. A
    delivery is what the folder held when its run started; that listing is
    kept beside the checkpoint. While a batch of it is uncommitted, or one of
    its files isn't in the stream's log, a restart goes on with it."""
    kept = f"{checkpoint}/deliveries"
    last = max((int(n.split("=")[1]) for n in _names(spark, kept)), default=-1)
    if last >= 0 and _names(spark, f"{kept}/run={last}"):
        offsets, commits = (max((int(n) for n in _names(spark, f"{checkpoint}/{d}") if n.isdigit()), default=-1) for d in ("offsets", "commits"))
        log = f"{checkpoint}/sources/0"
        planned = spark.read.schema("path string").parquet(f"{kept}/run={last}")
        seen = planned.limit(0)
        if _names(spark, log):
            seen = spark.read.text(log).select(_same_path(F.get_json_object("value", "$.path")))
        # a listed file that was taken away before it was read doesn't hold a run open
        here = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(src_dir).select(_same_path(F.col("_metadata.file_path")))
        if offsets > commits or not planned.join(seen, "path", "left_anti").join(here, "path", "left_semi").isEmpty():
            return last
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(src_dir)
    listing.filter("length > 0").select(_same_path(F.col("_metadata.file_path"))).write.mode("overwrite").parquet(f"{kept}/run={last + 1}")
    return last + 1


def _move_in(spark: SparkSession, staged: str, table_path: str, delivery: str, batch_id: int) -> None:
    """Moves a batch's files into the tiles' folders, then deletes what they
    replace: files of a replay of the batch and of other deliveries. Every
    step can be repeated: a replay writes and moves the whole batch again."""
    fs, new = _fs(spark, table_path)
    mine = f"{delivery}-{batch_id:09d}-"
    for tile in _names(spark, staged):
        to = f"{table_path}/{tile}"
        before = _names(spark, to)
        fs.mkdirs(new(to))
        moved = set()
        for name in _names(spark, f"{staged}/{tile}"):
            if not fs.rename(new(f"{staged}/{tile}/{name}"), new(f"{to}/{mine}{name}")):
                raise OSError(f"cannot move {staged}/{tile}/{name} to {to}")
            moved.add(mine + name)
        for name in before:
            if name not in moved and (name.startswith(mine) or not name.startswith(f"{delivery}-")):
                fs.delete(new(f"{to}/{name}"), True)
    fs.delete(new(staged), True)


def _batch_writer(table_path: str, quarantine_path: str | None, redelivery: str, run: int = 0):
    def write(batch: DataFrame, batch_id: int) -> None:
        # the query's id lives in its checkpoint: stable over restarts, new
        # with a new checkpoint, so two streams never share a folder
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
        batch = batch.persist()         # parsed once for both outputs
        try:
            valid, bad = route_valid_invalid(batch)
            out = valid.hint("rebalance", "source_file").write.mode("overwrite")
            if redelivery == "replace":
                staged = f"{table_path}/_batches/{stream}"     # hidden from readers
                out.option("partitionOverwriteMode", "static").partitionBy("source_file").parquet(staged)
                _move_in(batch.sparkSession, staged, table_path, f"{stream}-{run:06d}", batch_id)
            else:
                out.partitionBy("source_file").parquet(f"{table_path}/stream={stream}/batch_id={batch_id}")
            if quarantine_path is not None:
                bad.write.mode("overwrite").parquet(f"{quarantine_path}/stream={stream}/batch_id={batch_id}")
        finally:
            batch.unpersist()
    return write


def stream_points(spark: SparkSession, src_dir: str, table_path: str, checkpoint: str,
                  quarantine_path: str | None = None, max_files: int | None = MAX_FILES_PER_TRIGGER,
                  available_now: bool = True, processing_time: str | None = None,
                  max_bytes: int | None = None, lineage: str = "dir", redelivery: str = "replace"):
    """Start the ingest stream; with ``available_now`` it processes every
    file present at start (in micro-batches bounded by ``max_files`` or
    ``max_bytes``) and stops. Returns the StreamingQuery.

    ``lineage`` names the tile: the file (a flat landing folder) or its
    folder. With ``redelivery="replace"`` a delivery is the whole tile: what
    a run of the stream holds of a tile, in however many batches, replaces
    what the table had of it from other runs, so replays, lost checkpoints
    and tiles delivered again don't duplicate rows. A run that was stopped
    before it had ingested all files it found is continued by the next start.
    A stream that runs on belongs into a table with a commit log
    (``streaming.tiles.stream_tiles``), where every listing is a delivery.
    Use ``"append"`` where the files of one tile arrive over several runs:
    each batch of each stream then keeps a folder of its own, which only its
    own replay overwrites."""
    if redelivery not in ("replace", "append"):
        raise ValueError(redelivery)
    if redelivery == "replace" and not available_now:
        # a run that doesn't end can't tell a second delivery by its run
        raise ValueError("a running stream needs streaming.tiles.stream_tiles, or redelivery='append'")
    raw = read_point_stream(spark, src_dir, max_files=max_files, max_bytes=max_bytes, lineage=lineage)
    run = _run_number(spark, src_dir, checkpoint) if redelivery == "replace" else 0
    w = raw.writeStream.foreachBatch(_batch_writer(table_path, quarantine_path, redelivery, run)) \
        .option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def ingest_available(spark: SparkSession, src_dir: str, table_path: str, checkpoint: str, quarantine_path: str,
                     lineage: str = "file", glob: str = "*.csv", **options) -> None:
    """Ingest everything that is there, then quarantine the files without a
    point: a header-only file has no row that could reach a micro-batch, so
    they are found by comparing the file listing with the tiles written."""
    stream_points(spark, src_dir, table_path, checkpoint, quarantine_path, lineage=lineage, **options).awaitTermination()
    listing = file_manifest(spark, src_dir, glob)
    if lineage == "dir":
        listing = listing.select(F.regexp_replace(F.element_at(F.split("path", "/"), -2), r"^[^=]*=", "").alias("name")).distinct()
    seen = [spark.read.schema("source_file string").option("recursiveFileLookup", "true").parquet(quarantine_path)]
    seen.append(spark.read.schema("source_file string").parquet(table_path).select("source_file"))
    known = seen[0].unionByName(seen[1]).distinct()
    empty_files(spark, listing, known).select("source_file", F.lit(None).cast("string").alias("raw"), "error") \
        .write.mode("overwrite").parquet(f"{quarantine_path}/empty")
