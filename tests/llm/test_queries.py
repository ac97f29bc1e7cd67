"""The registered training-data queries: SQL where there is some, full results otherwise."""

import duckdb
import pytest

import __spark_entry__ as contract
from tarnbeck.llm import queries

TESTDATA = "/root/testdata"
COUNTED_BY = {"op2_neighbours": "embeddings", "op13_topk": "embeddings", "op4_urls": "pages", "op5_decontaminate": None}
#: Of each query so many rows, and every how many ids are queries.
SEARCHES = {"op2_neighbours": (20, 20), "op13_topk": (5, 50)}


def test_all_are_registered():
    assert {*queries.QUERIES, "pipeline"} <= set(contract.queries())
    assert {int(name[2:].split("_")[0]) for name in queries.QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_oracle(spark, name, sf):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{sf}/{table}.parquet'")
    result = connection.sql(queries.ORACLE_SQL[name])
    df = contract.queries()[name](spark, f"{TESTDATA}/{sf}")
    assert df.columns == list(result.columns)
    assert sorted(map(tuple, df.collect())) == sorted(result.fetchall())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_whole_table_is_judged(spark, name):
    sf_dir = f"{TESTDATA}/sf0.001"
    counted = COUNTED_BY.get(name, "documents")
    n = contract.queries()[name](spark, sf_dir).count()
    if name in SEARCHES:
        k, every = SEARCHES[name]
        assert n == k * spark.read.parquet(f"{sf_dir}/{counted}.parquet").where(f"vec_id % {every} = 0").count()
    elif counted:
        assert n == spark.read.parquet(f"{sf_dir}/{counted}.parquet").count()
