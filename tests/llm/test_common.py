import random

import numpy as np
from pyspark.sql import functions as F

from punktwerk.llm import common


def test_prefix_sums_in_two_levels(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 5000), rng.randint(0, 9)) for _ in range(3000)]
    got = {r.k: r.before for r in common.prefix_sums(spark.createDataFrame(rows, "k int, v long"), "k", "v", "before", block=100).collect()}
    want, run = {}, 0
    for k in sorted({k for k, _ in rows}):
        want[k] = run
        run += sum(v for x, v in rows if x == k)
    assert got == want


def test_bitmap_never_loses_a_key(spark, monkeypatch):
    keys = spark.range(2000).select(F.xxhash64("id").alias("k"))
    values = np.array([r.k for r in keys.collect()], np.int64)
    others = np.array([r.k for r in spark.range(2000, 4000).select(F.xxhash64("id").alias("k")).collect()], np.int64)
    bits = common.bitmap(keys, "k")
    assert common.in_bitmap(values, bits).all() and common.in_bitmap(others, bits).mean() < 0.1
    monkeypatch.setattr(common, "BITMAP_LOG2", (8, 8))      # far too small: lets more through
    small = common.bitmap(keys, "k")
    assert len(small) == 4 and common.in_bitmap(values, small).all()
    assert common.bitmap(keys.limit(0), "k").sum() == 0


def test_bounded_sample(spark):
    df = spark.range(10_000).withColumnRenamed("id", "doc_id").repartition(7)
    a = [r.doc_id for r in common.bounded_sample(df, "s", 300).collect()]
    assert len(a) == 300 and a == [r.doc_id for r in common.bounded_sample(df.repartition(3), "s", 300).collect()]
    assert common.bounded_sample(df, "s", 20_000).count() == 10_000
    assert common.bounded_sample(df.limit(0), "s", 10).count() == 0


def test_batches_are_bounded(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "10000")
        common.prepare(spark)
        assert int(spark.conf.get(key)) == common.BATCH_ROWS
        spark.conf.set(key, "100")
        common.prepare(spark)
        assert spark.conf.get(key) == "100"
    finally:
        spark.conf.set(key, before)


def test_the_library_does_not_import_the_operators():
    import pathlib
    root = pathlib.Path(common.__file__).parents[1]
    for f in root.rglob("*.py"):
        if f.parent.name != "llm":
            assert "punktwerk.llm" not in f.read_text()
