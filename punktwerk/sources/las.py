"""Binary point tiles (LAS, uncompressed) as a distributed scan.

LAS records have a fixed length, so a file splits into record ranges:
1. the file listing comes from the ``binaryFile`` source with only
   path/length selected (no content is read);
2. each file's public header block is decoded in a ``mapInPandas`` task;
3. every file becomes ``ceil(n / points_per_split)`` split rows;
4. splits are spread over tasks and decoded by ``mapInArrow``: each task
   reads its own byte range and turns it into Arrow batches with NumPy.

Files whose header is not LAS, or that hold no points, are returned as
failures with an error text instead of rows. Compressed tiles must be
decompressed to LAS first (no codec here).
"""

from __future__ import annotations

import math
import struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEADER_SCHEMA = ("path string, name string, point_format int, record_length int, n_points long, "
                 "data_offset long, sx double, sy double, sz double, ox double, oy double, oz double, "
                 "error string")
OUT_SCHEMA = ("x double, y double, z double, intensity int, return_num int, classification int, "
              "source_file string")
BATCH_ROWS = 100_000
#: Bytes of a record by point format.
RECORD_LENGTH = {0: 20, 1: 28, 2: 26, 3: 34, 6: 30, 7: 36, 8: 38}


def _filesystem(path: str):
    """(file system, path in it) for Spark's name of a file or folder."""
    from pyarrow import fs
    if path.startswith("file:") or "://" not in path:
        local = path.removeprefix("file:")
        while local.startswith("//"):
            local = local[1:]
        return fs.LocalFileSystem(), local
    # Spark's names for an object store; the library knows the plain one
    scheme, _, rest = path.partition("://")
    plain = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    return fs.FileSystem.from_uri(f"{plain}://{rest}")


def _open(path: str):
    f, p = _filesystem(path)
    return f.open_input_file(p)


def parse_header(buf: bytes) -> dict:
    """Fields of the LAS public header block needed to read the points."""
    if len(buf) < 227 or buf[:4] != b"LASF":
        raise ValueError("not a LAS file")
    header_size = struct.unpack_from("<H", buf, 94)[0]
    data_offset = struct.unpack_from("<I", buf, 96)[0]
    if buf[104] & 0xC0:
        raise ValueError("compressed point records")
    fmt = buf[104]
    rec_len = struct.unpack_from("<H", buf, 105)[0]
    n = struct.unpack_from("<I", buf, 107)[0]
    if header_size >= 375 and len(buf) >= 255:
        n64 = struct.unpack_from("<Q", buf, 247)[0]
        n = n64 or n
    sx, sy, sz, ox, oy, oz = struct.unpack_from("<6d", buf, 131)
    return dict(point_format=fmt, record_length=rec_len, n_points=n, data_offset=data_offset,
                sx=sx, sy=sy, sz=sz, ox=ox, oy=oy, oz=oz)


def header_bounds(buf: bytes) -> dict[str, tuple[float, float]]:
    """(least, greatest) x, y and z by the header; empty if it states none."""
    v = struct.unpack_from("<6d", buf, 179)
    if not any(v):
        return {}
    return {c: (v[2 * i + 1], v[2 * i]) for i, c in enumerate("xyz")}


def make_header(point_format: int, n: int, scale, offset, bounds=None) -> bytes:
    """A public header block of LAS 1.2 (formats 0-3) or 1.4 (6-8);
    ``bounds`` = (minx, maxx, miny, maxy, minz, maxz)."""
    size = 375 if point_format >= 6 else 227
    head = bytearray(size)
    head[0:4] = b"LASF"
    head[24], head[25] = 1, (4 if point_format >= 6 else 2)
    struct.pack_into("<H", head, 94, size)
    struct.pack_into("<I", head, 96, size)
    head[104] = point_format
    struct.pack_into("<H", head, 105, RECORD_LENGTH[point_format])
    struct.pack_into("<I", head, 107, n if point_format < 6 and n < 1 << 32 else 0)
    struct.pack_into("<6d", head, 131, *scale, *offset)
    if bounds is not None:
        struct.pack_into("<6d", head, 179, *(bounds[i] for i in (1, 0, 3, 2, 5, 4)))
    if point_format >= 6:
        struct.pack_into("<Q", head, 247, n)
    return bytes(head)


def _headers(it):
    for pdf in it:
        rows = []
        for path, length in zip(pdf["path"], pdf["length"]):
            row = {"path": path, "name": path.rsplit("/", 1)[-1], "error": None}
            try:
                with _open(path) as f:
                    row.update(parse_header(f.read(375)))
                if row["n_points"] == 0:
                    row["error"] = "no points"
                elif length < row["data_offset"] + row["n_points"] * row["record_length"]:
                    row["error"] = f"truncated: {row['n_points']} points announced, {length} bytes"
            except Exception as e:  # unreadable or not LAS -> failure row
                row["error"] = f"{type(e).__name__}: {e}"
            rows.append(row)
        cols = [c.split()[0] for c in HEADER_SCHEMA.split(", ")]
        yield pd.DataFrame(rows).reindex(columns=cols)


def decode_records(raw: bytes, fmt: int, rec_len: int, scale, offset) -> dict:
    """Point records -> column arrays (return number and class live in
    different bytes for formats 0-5 and 6-10)."""
    dt = np.dtype({"names": ["X", "Y", "Z", "I", "b14", "b15", "b16"],
                   "formats": ["<i4", "<i4", "<i4", "<u2", "u1", "u1", "u1"],
                   "offsets": [0, 4, 8, 12, 14, 15, 16], "itemsize": rec_len})
    a = np.frombuffer(raw, dtype=dt)
    if fmt >= 6:
        ret = a["b14"] & 0x0F
        cls = a["b16"]
    else:
        ret = a["b14"] & 0x07
        cls = a["b15"] & 0x1F
    return {"x": a["X"] * scale[0] + offset[0], "y": a["Y"] * scale[1] + offset[1],
            "z": a["Z"] * scale[2] + offset[2], "intensity": a["I"].astype(np.int32),
            "return_num": ret.astype(np.int32), "classification": cls.astype(np.int32)}


def _decode(it):
    for batch in it:
        for r in batch.to_pylist():
            with _open(r["path"]) as f:
                done = 0
                while done < r["count"]:
                    k = min(BATCH_ROWS, r["count"] - done)
                    f.seek(r["data_offset"] + (r["start"] + done) * r["record_length"])
                    raw = f.read(k * r["record_length"])
                    if len(raw) != k * r["record_length"]:
                        raise OSError(f"{r['path']}: file changed while it was read")
                    cols = decode_records(raw, r["point_format"], r["record_length"],
                                          (r["sx"], r["sy"], r["sz"]), (r["ox"], r["oy"], r["oz"]))
                    cols["source_file"] = np.full(len(cols["x"]), r["name"], dtype=object)
                    yield pa.RecordBatch.from_pydict(cols)
                    done += k


def read_las(spark: SparkSession, path: str, points_per_split: int = 1_000_000,
             glob: str = "*.las") -> tuple[DataFrame, DataFrame]:
    """(points, failures) for every LAS file under ``path``; whole files,
    in splits of ``points_per_split`` points."""
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
               .option("recursiveFileLookup", "true").load(path).select("path", "length"))
    return points_of(listing, points_per_split)


#: Small splits share a task: at least so many tasks a core, and no more
#: points in a task, about.
TASKS_PER_CORE = 8
TASK_POINTS = 1_000_000


def points_of(listing: DataFrame, points_per_split: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """(points, failures) of the LAS files of a listing (path, length)."""
    from punktwerk.session import ensure_checkpoint_dir, ship_package
    spark = listing.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    headers = listing.select("path", "length").mapInPandas(_headers, HEADER_SCHEMA).checkpoint()
    failures = headers.filter(F.col("error").isNotNull()).select("path", "name", "error", F.col("n_points").alias("n_points"))
    ok = headers.filter(F.col("error").isNull())
    splits = ok.withColumn("_n", F.col("n_points")).withColumn(
        "start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(int(points_per_split)).cast("long"))))
    splits = splits.withColumn("count", F.least(F.lit(int(points_per_split)).cast("long"), F.col("_n") - F.col("start")))
    n_splits, n_points = splits.agg(F.count("*"), F.sum("count")).first()   # one small metadata row per split
    # an explicit partition count, which AQE keeps: every split is a task of its
    # own, unless they are so many and small that starting tasks would decide
    tasks = max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, math.ceil((n_points or 0) / TASK_POINTS))
    points = splits.repartition(max(min(n_splits, tasks), 1), "path", "start").mapInArrow(_decode, OUT_SCHEMA)
    return points, failures


def write_las(path: str, x, y, z, intensity, return_num, classification, point_format: int = 1,
              scale=(0.01, 0.01, 0.01), offset=(0.0, 0.0, 0.0)) -> None:
    """Write a small LAS 1.2 (formats 0-5) or 1.4 (formats 6-10) file from
    arrays; used by tests and fixtures, not for bulk output."""
    pairs = [f(np.asarray(v, dtype=float)) for v in (x, y, z) for f in (np.min, np.max)] if len(x) else None
    with open(path, "wb") as f:
        f.write(make_header(point_format, len(x), scale, offset, pairs))
        f.write(records(x, y, z, intensity, return_num, classification, point_format, scale, offset))


def records(x, y, z, intensity, return_num, classification, point_format: int, scale, offset) -> bytes:
    """Point records of one format."""
    rec = np.zeros(len(x), dtype=np.dtype({"names": ["X", "Y", "Z", "I", "b14", "b15", "b16"],
                                           "formats": ["<i4", "<i4", "<i4", "<u2", "u1", "u1", "u1"],
                                           "offsets": [0, 4, 8, 12, 14, 15, 16], "itemsize": RECORD_LENGTH[point_format]}))
    rec["X"] = np.round((np.asarray(x) - offset[0]) / scale[0])
    rec["Y"] = np.round((np.asarray(y) - offset[1]) / scale[1])
    rec["Z"] = np.round((np.asarray(z) - offset[2]) / scale[2])
    rec["I"] = intensity
    if point_format >= 6:
        rec["b14"] = np.asarray(return_num, dtype=np.int64) & 0x0F
        rec["b16"] = classification
    else:
        rec["b14"] = np.asarray(return_num, dtype=np.int64) & 0x07
        rec["b15"] = np.asarray(classification, dtype=np.int64) & 0x1F
    return rec.tobytes()


_TILE_ROW = ("source_file string, ord int, x double, y double, z double, intensity int, return_num int, classification int, "
             "n long, minx double, maxx double, miny double, maxy double, minz double, maxz double")


def write_las_tiles(points: DataFrame, path: str, point_format: int = 6, scale=(0.01, 0.01, 0.01), offset=(0.0, 0.0, 0.0)) -> DataFrame:
    """Writes one file per ``source_file`` under ``path`` (a folder that
    executors reach): the header row of a tile (count and bounds) is sorted in
    front of its points, which stream into the file. A file has its name only
    when it is complete, so a task can be repeated. Returns (path, n) once
    the files are written. Null coordinates can't be stored: they raise."""
    from punktwerk.session import ensure_checkpoint_dir, ship_package
    spark = points.sparkSession
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    cols = [c.split()[0] for c in _TILE_ROW.split(", ")]
    heads = points.groupBy("source_file").agg(F.count("*").alias("n"), *[
        f(c).alias(f"{k}{c}") for c in "xyz" for f, k in ((F.min, "min"), (F.max, "max"))]).withColumn("ord", F.lit(0))
    rows = heads.unionByName(points.withColumn("ord", F.lit(1)), allowMissingColumns=True).selectExpr(
        *[f"cast({c.split()[0]} as {c.split()[1]}) as {c.split()[0]}" for c in _TILE_ROW.split(", ")])
    spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(
        spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path))

    def run(batches):
        import uuid
        out = None          # (stream, temporary path, path, n)

        def done():
            out[0].close()
            fs.move(out[1], out[2])
            return pa.RecordBatch.from_pydict({"path": [out[2]], "n": [out[3]]})

        for b in batches:
            c = {k: b.column(i).to_numpy(zero_copy_only=False) for i, k in enumerate(cols)}
            heads_at = np.flatnonzero(c["ord"] == 0)
            for lo, hi in zip([0, *heads_at], [*heads_at, b.num_rows]):
                if lo < hi and c["ord"][lo] == 0:
                    if out is not None:
                        yield done()
                    fs, folder = _filesystem(path)
                    name = f"{folder}/{c['source_file'][lo]}"
                    tmp = f"{folder}/_{uuid.uuid4().hex}"
                    out = (fs.open_output_stream(tmp), tmp, name, int(c["n"][lo]))
                    out[0].write(make_header(point_format, out[3], scale, offset, [c[k][lo] for k in ("minx", "maxx", "miny", "maxy", "minz", "maxz")]))
                    lo += 1
                if lo < hi:
                    out[0].write(records(*[c[k][lo:hi] for k in cols[2:8]], point_format, scale, offset))
        if out is not None:
            yield done()

    return rows.repartition("source_file").sortWithinPartitions("source_file", "ord").mapInArrow(run, "path string, n long").checkpoint()
