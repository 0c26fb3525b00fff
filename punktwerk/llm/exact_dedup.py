"""Exact deduplication with counting quotient filters.

Each partition of fingerprints becomes a counting quotient filter: the top
bits (quotient) name a block, the remainders of a block are kept sorted with
a count each. Filters of the same block merge without loss by their sorted
remainders; a fingerprint whose merged count is one belongs to a unique text.
Only documents whose fingerprint counts two or more are routed to the byte
verification, which groups by the normalised text itself, so two texts with
one fingerprint stay apart. Copies collapse in each partition, before the
shuffle, both in the filters and in the verification.

Texts are equal when identical after lower-casing A-Z only; a null text
counts as empty. Of equal texts the largest doc_id stays (null ids last). In
``exact_groups`` rows that repeat this id with an equal text are all marked as
kept; ``drop_copies`` keeps exactly one row of each group of equal texts: of
rows with the largest id the one whose columns have the largest hash, and one
of rows that are equal in all columns. Rows that share an id but not their
text are told apart. Extra columns are ignored by ``exact_groups`` and kept by
``drop_copies``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punktwerk.llm.common import bitmap, bitmap_filter, prepare, staged, tidied

_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FINGERPRINTS_PER_BLOCK = 200_000


def normalised(text: str = "text") -> Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), _AZ, _AZ.lower())


def _split(fp: np.ndarray, qbits: int):
    f = fp.astype(np.int64).view(np.uint64)
    low = np.uint64(64 - qbits)
    return (f >> low).astype(np.int64), f & ((np.uint64(1) << low) - np.uint64(1))


def filter_of(fp: np.ndarray, qbits: int):
    """The counting quotient filter of some fingerprints, as
    (block, sorted remainders, counts) per occupied block."""
    u, n = np.unique(fp.astype(np.int64).view(np.uint64), return_counts=True)
    q, r = _split(u.view(np.int64), qbits)
    blocks, at = np.unique(q, return_index=True)
    return [(int(b), x, y) for b, x, y in zip(blocks, np.split(r, at[1:]), np.split(n, at[1:]))]


def merge_blocks(parts):
    """Merge filters of one block: a union of sorted remainders whose counts
    add up. Nothing is lost: the result equals the filter of all rows."""
    r = np.concatenate([p[0] for p in parts])
    n = np.concatenate([p[1] for p in parts])
    u, inv = np.unique(r, return_inverse=True)
    return u, np.bincount(inv, weights=n, minlength=len(u)).astype(np.int64)


def repeated_fingerprints(fps: DataFrame, rows: int) -> DataFrame:
    """(fp, n) of the fingerprints found more than once in column ``fp``."""
    qbits = max(4, math.ceil(math.log2(max(1, rows / FINGERPRINTS_PER_BLOCK))) + 4)

    @tidied
    def build(batches):
        held, waiting = [], 0

        def flush():
            out = filter_of(np.concatenate(held), qbits) if held else []
            return pa.RecordBatch.from_arrays([
                pa.array([b for b, _, _ in out], pa.int64()),
                pa.array([r.astype("<u8").tobytes() for _, r, _ in out], pa.binary()),
                pa.array([n.astype("<i8").tobytes() for _, _, n in out], pa.binary())], ["block", "rem", "cnt"])

        for b in batches:
            held.append(b.column(0).to_numpy(zero_copy_only=False))
            waiting += b.num_rows
            if waiting >= 2_000_000:
                yield flush()
                held, waiting = [], 0
        if held:
            yield flush()

    def merge(key, pdf: pd.DataFrame) -> pd.DataFrame:
        r, n = merge_blocks([(np.frombuffer(a, "<u8"), np.frombuffer(c, "<i8"))
                             for a, c in zip(pdf["rem"], pdf["cnt"])])
        hit = n > 1
        f = (np.uint64(key[0]) << np.uint64(64 - qbits)) | r[hit]
        return pd.DataFrame({"fp": f.view(np.int64), "n": n[hit]})

    return (fps.select("fp").mapInArrow(build, "block long, rem binary, cnt binary")
            .groupBy("block").applyInPandas(merge, "fp long, n long"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    spark = prepare(docs.sparkSession)
    norm = normalised()
    rows = staged(docs.select("doc_id", norm.alias("_t")).select(
        "doc_id", F.xxhash64("_t").alias("fp"), F.sha2(F.encode("_t", "UTF-8"), 256).alias("text_sha256")), "fingerprints")
    repeated = staged(repeated_fingerprints(rows, rows.count()), "repeated")
    routed = bitmap_filter(spark, bitmap(repeated, "fp"))
    # byte verification: the key is the text; a routed unique text is a group of one
    groups = (docs.select("doc_id", norm.alias("_t")).withColumn("fp", F.xxhash64("_t")).filter(routed("fp"))
              .groupBy("fp", "_t").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
              .select(F.col("fp").alias("_f"), F.sha2(F.encode("_t", "UTF-8"), 256).alias("_s"), "keep_id", "group_size")
              .filter("group_size > 1"))
    groups = staged(groups, "groups")
    j = rows.join(groups, (F.col("fp") == F.col("_f")) & (F.col("text_sha256") == F.col("_s")), "left")
    return j.select("doc_id", F.when(F.col("_f").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    (F.col("_f").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with its own columns. Rows whose
    fingerprint occurs once stay where they are; of the others a narrow row
    each competes for its text, and only the winners' rows are shuffled."""
    spark, own = prepare(docs.sparkSession), docs.columns
    rows = staged(docs.select(F.xxhash64(normalised()).alias("fp")), "fingerprints")
    repeated = staged(repeated_fingerprints(rows, rows.count()), "repeated")
    routed = bitmap_filter(spark, bitmap(repeated, "fp"))
    held = docs.select(F.struct("*").alias("_doc"), normalised().alias("_t"), F.col("doc_id").alias("_id")).withColumn("_f", F.xxhash64("_t"))
    copies = held.filter(routed("_f")).withColumn("_row", F.xxhash64("_doc"))
    sha = F.sha2(F.encode("_t", "UTF-8"), 256)
    best = (copies.groupBy("_f", "_t").agg(F.max(F.struct("_id", "_row")).alias("b"))
            .select("_f", sha.alias("_s"), F.col("b._id").alias("_id"), F.col("b._row").alias("_row")))
    best = staged(best, "kept_copies").select(*[F.col(c).alias(f"{c}_kept") for c in ("_f", "_s", "_id", "_row")])
    stay = copies.withColumn("_s", sha).join(best, (F.col("_f") == F.col("_f_kept")) & (F.col("_s") == F.col("_s_kept")) & (
        F.col("_row") == F.col("_row_kept")) & F.col("_id").eqNullSafe(F.col("_id_kept")), "left_semi")
    out = held.filter(~routed("_f")).select("_doc").unionByName(stay.dropDuplicates(["_f", "_s", "_row"]).select("_doc"))
    return out.select("_doc.*").select(*own)
