"""Helpers shared by the corpus operators: staging, bounded Arrow batches,
fixed-size bitmaps and distributed prefix sums."""

from __future__ import annotations

import ctypes
import functools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from punktwerk.session import ensure_checkpoint_dir, scratch_path, ship_package

#: A word, wherever the operators count words (fixed by the data contract).
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of whole texts handed to a Python worker at a time.
BATCH_ROWS = 256


def release_memory() -> None:
    """Hand freed memory back to the system: Python workers are reused by the
    next stages, next to an executor's heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):       # another C library
        pass


def tidied(run):
    """A task function over Arrow batches that releases its memory at the end."""
    @functools.wraps(run)
    def inner(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()
    return inner


def prepare(spark: SparkSession, rows: int = BATCH_ROWS) -> SparkSession:
    """Ship the package to the workers, make sure the shared checkpoint folder
    is set and bound the rows per Arrow batch (texts can be long; operators
    that hand over narrow rows alone ask for more ``rows``)."""
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if rows > BATCH_ROWS or not 0 < now <= rows:
        spark.conf.set(key, str(rows))
    return spark


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it
    back: cuts the lineage, survives lost executors, and gives later plans
    column pruning and a known file size (so Spark itself decides about a
    broadcast)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def text_crc(col: str):
    """crc32 of an id written as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def bounded_sample(df: DataFrame, salt: str, rows: int, key: str = "doc_id") -> DataFrame:
    """At most ``rows`` rows, those with the smallest hashes of ``key``. A
    threshold on the hash comes first, so only about that many rows are
    ordered, however many there are; it reads ``key`` alone."""
    total = df.select(key).count()
    cut = int(min(1.0, 1.2 * rows / max(1, total)) * 2 ** 31)
    h = F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(1 << 31))
    return df.withColumn("_h", h).filter(F.col("_h") < cut).orderBy("_h", key).limit(rows).drop("_h")


#: A bitmap has 16 bits a key, between 8 KB and 16 MB.
BITMAP_LOG2 = (16, 27)


def bitmap(keys: DataFrame, col: str) -> np.ndarray:
    """A bitmap with the bit of every key's cell set. It never outgrows 16 MB:
    beyond eight million keys cells are shared, and the filter lets more
    through, but never loses a key. Grouped on the cluster, so the driver
    receives one row per 64 cells at most."""
    low, high = BITMAP_LOG2
    log2 = min(high, max(low, (16 * keys.count()).bit_length()))
    cell = F.pmod(F.col(col), F.lit(1 << log2))
    words = (keys.select(cell.alias("_c"))
             .groupBy(F.shiftright("_c", 6).cast("int").alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(_c % 64 as int))")).alias("b")).toPandas())
    out = np.zeros(1 << (log2 - 6), dtype=np.int64)
    out[words["w"].to_numpy()] = words["b"].to_numpy()
    return out


def in_bitmap(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
    c = values.astype(np.int64) & (len(bits) * 64 - 1)
    return ((bits.view(np.uint64)[c >> 6] >> (c & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


def bitmap_filter(spark: SparkSession, bits: np.ndarray):
    """Column function: might the key be in the bitmap? Never false for a key
    that was set; a map-side pre-filter in front of an exact step."""
    shared = spark.sparkContext.broadcast(bits)

    @F.pandas_udf(T.BooleanType())
    def might_hold(key: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(key.to_numpy(dtype=np.int64), shared.value))

    return might_hold


def without(docs: DataFrame, gone: DataFrame, keys: dict) -> DataFrame:
    """The rows of ``docs`` whose ``keys`` (name -> Column over docs) aren't
    among the rows of ``gone``, null-safe. Only rows that a bitmap lets
    through take part in the exact anti-join, so the other texts are not
    shuffled. ``docs`` is read twice: pass a table, not a long plan."""
    spark, own = docs.sparkSession, docs.columns
    gone = staged(gone.select(*[F.col(k).alias(f"_gone_{k}") for k in keys]), "gone")
    might = bitmap_filter(spark, bitmap(gone.select(F.xxhash64("*").alias("_h")), "_h"))
    held = docs.select(F.struct("*").alias("_doc"), *[c.alias(f"_own_{k}") for k, c in keys.items()])
    key = F.xxhash64(*[f"_own_{k}" for k in keys])
    same = functools.reduce(lambda x, y: x & y, [F.col(f"_own_{k}").eqNullSafe(F.col(f"_gone_{k}")) for k in keys])
    out = held.filter(~might(key)).unionByName(held.filter(might(key)).join(gone, same, "left_anti"))
    return out.select("_doc.*").select(*own)


def prefix_sums(df: DataFrame, key: str, value: str, out: str, block: int = 1024) -> DataFrame:
    """(key, out): the sum of ``value`` over all smaller integer keys; one row
    per key. In two levels, so that no task sorts more than ``block`` keys or
    the list of blocks."""
    t = df.groupBy(key).agg(F.sum(value).alias("_v")).withColumn("_b", F.expr(f"{key} div {block}"))
    w = W.partitionBy("_b").orderBy(key).rowsBetween(W.unboundedPreceding, -1)
    inner = t.withColumn("_in", F.coalesce(F.sum("_v").over(w), F.lit(0)))
    wb = W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    outer = t.groupBy("_b").agg(F.sum("_v").alias("_t")).withColumn(
        "_o", F.coalesce(F.sum("_t").over(wb), F.lit(0)))
    return inner.join(outer, "_b").select(key, (F.col("_in") + F.col("_o")).cast("long").alias(out))
