import random

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                       # extra columns whose names the operators use inside
                       T.StructField("size", T.StringType()), T.StructField("hash", T.LongType()), T.StructField("node", T.StringType()),
                       T.StructField("n_words", T.LongType()), T.StructField("part", T.StringType()), T.StructField("found", T.StringType()),
                       T.StructField("Source_Size", T.StringType())])


def edge_rows():
    """Nulls in every column, empty and long texts, copies, near copies, a hot
    source, repeated rows."""
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(vocab) for _ in range(n)).capitalize() + "."

    texts = [None, "", " \n\t ", "One", "two words", prose(4), prose(5), prose(20000)]
    base = prose(120)
    ws = base.split()
    texts += [base, base.upper(), base.lower(), base] + [" ".join(ws[:k] + ["changed"] + ws[k + 1:]) for k in (10, 60, 100)]
    texts += [prose(rng.randint(20, 200)) for _ in range(40)]
    texts += ["same line here\n" * 6 + prose(30), " ".join(w + "###" for w in prose(50).split()), "É É é x\x0by  z " * 4]
    rows = []
    for i, t in enumerate(texts):
        source = None if i % 11 == 3 else ("hot" if i % 2 else f"s{i % 5}")
        rows.append((i, t, None if i % 7 == 1 else "en", source, len(t or ""), "x", i, "y", -1, "p", "f", "z"))
    rows.append((None, "A row without id " * 10, None, None, None) + (None,) * 7)
    rows.append(rows[9])            # a repeated row
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf_docs():
    import duckdb
    return duckdb.sql(f"select * from '{SF}/documents.parquet' order by doc_id").df()
