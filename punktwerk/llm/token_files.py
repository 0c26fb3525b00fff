"""Token-id files: ORC with run-length encoded integers, row indexes and Bloom
filters on the document id.

Documents are range-partitioned by id, and each partition is tokenised in
order straight into one ORC file; a row holds the id, the number of its file,
the ids before it in that file, and its own ids. ORC's integer run-length
encoding stores the ids; the row index and the Bloom filter let a reader skip
stripes and row groups for an id or a range of ids (``read_tokens`` passes
the predicate down), and a large file is read by several tasks, a stripe or
more each. Because positions are stored per file, the position in the whole
corpus is that plus the ids of the files before it.

Null texts count as empty and give only the end id. Null doc_ids come first.
Rows that repeat a doc_id stay apart, in the order they were read. Extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punktwerk.llm.common import prefix_sums, prepare, staged, tidied
from punktwerk.llm.tokens import encoder
from punktwerk.session import scratch_path

SCHEMA = "doc_id long, part int, part_start long, n_tokens int, ids array<int>"
STRIPE_BYTES = 16 * 1024 * 1024


def _encode(path: str, end_id: int, special_as_text: bool):
    tail = np.array([end_id], dtype="<u4").tobytes()

    @tidied
    def run(batches):
        tok, part, before = encoder(path, special_as_text=special_as_text), TaskContext.get().partitionId(), 0
        for b in batches:
            got = [x + tail for x in tok.encode([t or "" for t in b.column(1).to_pylist()])]
            n = np.array([len(x) // 4 for x in got], dtype=np.int64)
            ends = np.cumsum(n)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(got), "<i4")))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(before + ends - n),
                 pa.array(n.astype(np.int32)), ids], ["doc_id", "part", "part_start", "n_tokens", "ids"])
            before += int(ends[-1]) if len(n) else 0

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, special_as_text: bool = False) -> str:
    """Tokenise ``docs`` (doc_id, text) into ORC files in ascending doc_id
    order. The row's position in the input breaks ties, so that a doc_id that
    many rows share is still dealt to several partitions."""
    prepare(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("_at"))
    n = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = d.repartitionByRange(n, "doc_id", "_at").sortWithinPartitions("doc_id", "_at").select("doc_id", "text")
    (d.mapInArrow(_encode(tokenizer, end_id, special_as_text), SCHEMA).write
     .option("compression", "zstd").option("orc.stripe.size", str(STRIPE_BYTES))
     .option("orc.create.index", "true").option("orc.row.index.stride", "1000")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").orc(path))
    return path


def read_tokens(spark: SparkSession, path: str, doc_ids=None, low=None, high=None) -> DataFrame:
    """The stored rows; of some ids or a range of ids, if asked. Those
    predicates reach the ORC reader, which skips stripes by their statistics
    and Bloom filters."""
    df = spark.read.schema(SCHEMA).orc(path)
    if doc_ids is not None:
        df = df.filter(F.col("doc_id").isin(list(doc_ids)))
    if low is not None:
        df = df.filter(F.col("doc_id") >= low)
    if high is not None:
        df = df.filter(F.col("doc_id") <= high)
    return df


def corpus_positions(spark: SparkSession, path: str) -> DataFrame:
    """(part, base): the ids in all files before each file."""
    return staged(prefix_sums(read_tokens(spark, path).select("part", "n_tokens"), "part", "n_tokens", "base").coalesce(1), "bases")


@F.pandas_udf(T.LongType())
def ids_crc32(ids: pd.Series) -> pd.Series:
    return pd.Series([zlib.crc32(np.asarray(x, dtype="<u4").tobytes()) for x in ids], dtype="int64")


def token_digest(docs: DataFrame, tokenizer: str, end_id: int, special_as_text: bool = False) -> DataFrame:
    """Write the files, read them back, and describe each document in them."""
    spark = docs.sparkSession
    path = write_tokens(docs, scratch_path(spark, "token_files"), tokenizer, end_id, special_as_text)
    base = corpus_positions(spark, path)
    rows = read_tokens(spark, path).select("doc_id", "part", "part_start", "n_tokens", ids_crc32("ids").alias("ids_crc32"))
    return rows.join(base, "part").select(
        "doc_id", (F.col("base") + F.col("part_start")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids_crc32")
