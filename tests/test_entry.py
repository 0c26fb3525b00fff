import __spark_entry__ as E
from tests.conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["total_points", "ground_points", "min_z", "max_z", "avg_z"]
    assert len(rows) == 1 and rows[0].total_points > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 70


def test_small_queries_against_duckdb(spark):
    """A sample of the catalog against the DuckDB oracle at sf0.001."""
    import duckdb
    from tools.check_oracle import TABLES, rows_key
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    qs, orc = E.queries(), E.oracle_sql()
    for k in ("region_stats", "st_contains_points", "spatial_join_flat", "distance_join", "geohash_points",
              "range_intersects", "knn_polygon", "tile_join"):
        sdf = qs[k](spark, SF_SMALL)
        rel = con.sql(orc[k])
        assert rows_key(sdf.columns, sdf.collect()) == rows_key(rel.columns, rel.fetchall()), k


def test_ship_package_once_per_context(spark):
    from punktwerk import session
    session.ship_package(spark)
    session.ship_package(spark)
    assert spark.sparkContext.applicationId in session._SHIPPED
    # a Python worker can import the package and run an operator's helper
    out = spark.range(1).rdd.map(lambda _: __import__("punktwerk.operators.hull", fromlist=["x"]).__name__).collect()
    assert out == ["punktwerk.operators.hull"]
