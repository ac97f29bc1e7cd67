"""Every registered query against its SQL in DuckDB, on whole tables."""

import json
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as contract

TESTDATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


# The training-data queries have their own tests, in tests/llm.
NAMES = sorted(n for n in contract.oracle_sql() if not contract.llm or n not in {*contract.llm.QUERIES, "pipeline"})


def oracle(sf_dir, sql):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = connection.sql(sql)
    return list(result.columns), sorted(result.fetchall())


def test_names_agree():
    assert contract.queries()
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["n_name", "n_lines", "revenue"]
    assert df.count() > 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, name, sf):
    sf_dir = f"{TESTDATA}/{sf}"
    columns, rows = oracle(sf_dir, contract.oracle_sql()[name])
    df = contract.queries()[name](spark, sf_dir)
    assert df.columns == columns
    # Exact: both sides sum in fixed point, so no tolerance is needed.
    assert sorted(tuple(r) for r in df.collect()) == rows


def test_bench_prints_one_line():
    root = os.path.dirname(contract.__file__)
    env = {**os.environ, "BENCH_SF_DIR": f"{TESTDATA}/sf0.001", "BENCH_CPUS": "2"}
    done = subprocess.run(
        [sys.executable, "bench.py"], cwd=root, env=env, capture_output=True, text=True, timeout=900, check=True
    )
    (line,) = done.stdout.splitlines()
    report = json.loads(line)
    assert report["sf"] == 0.001 and report["unit"] == "sec"
    assert set(report["queries"]) == set(contract.queries())
