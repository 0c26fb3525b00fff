"""Scans over a table that is sorted across all its partitions.

``sorted_parts`` deals rows by ranges of their sort keys, so a group of any
size is spread over as many tasks as it needs. A scan numbers the partition
it works in; what goes on over a border between two partitions is mended
afterwards from one small row per partition (first and last group)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punktwerk.llm.common import tidied

ROWS_PER_TASK = 1 << 18


def sorted_parts(df: DataFrame, rows: int, *keys: str, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` sorted by ``keys`` (nulls first) over range partitions of about
    ``per_task`` rows."""
    return df.repartitionByRange(max(1, -(-rows // per_task)), *keys).sortWithinPartitions(*keys)


def column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """For each row the index of the first row of its run of equal keys."""
    n = len(keys[0])
    new = np.zeros(n, dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(n), 0))


def part_id() -> int:
    return TaskContext.get().partitionId()


def over_parts(fn):
    """A mapInArrow function from ``fn(batches, partition id)`` that sees
    only batches with rows."""
    @tidied
    def run(batches):
        yield from fn((b for b in batches if b.num_rows), part_id())
    return run


def carried(scanned: DataFrame, key: str, state: list[str], add) -> DataFrame:
    """For a scan whose ``state`` columns run along equal ``key`` values inside
    each ``part``: (part, key, state...) of the runs that began in an earlier
    partition, with the state that they had at the border. One row for each
    partition goes through the driver."""
    spark = scanned.sparkSession
    edges = (scanned.groupBy("part").agg(F.min(key).alias("first"), F.max(F.struct(key, "at", *(s for s in state if s != "at"))).alias("last"))
             .orderBy("part").collect())
    out, before_key, before = [], None, None
    for e in edges:
        state_here = tuple(e["last"][s] for s in state)
        if before is not None and e["first"] == before_key:
            out.append((e["part"], e["first"], *before))
            if e["last"][key] == before_key:
                state_here = add(before, state_here)
        before_key, before = e["last"][key], state_here
    fields = ", ".join(f"_{s} long" for s in state)
    return spark.createDataFrame(out, f"_part int, _key long, {fields}")
