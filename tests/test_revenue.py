"""Revenue by nation against a brute force over small made-up tables."""

import random
import re
from collections import defaultdict
from decimal import Decimal

import duckdb
import pandas as pd
import pytest

from tarnbeck.plans.revenue import REVENUE_BY_NATION_SQL, revenue_by_nation


def write(folder, lineitem, orders, customer, nation):
    def frame(rows, types):
        return pd.DataFrame(rows, columns=list(types)).astype(types)

    frame(lineitem, {"l_orderkey": "Int64", "l_extendedprice": "float64", "l_discount": "float64"}).to_parquet(
        folder / "lineitem.parquet"
    )
    # Several row groups, so that several tasks can read them.
    frame(orders, {"o_orderkey": "Int64", "o_custkey": "Int64"}).to_parquet(folder / "orders.parquet", row_group_size=5000)
    frame(customer, {"c_custkey": "Int64", "c_nationkey": "Int32"}).to_parquet(folder / "customer.parquet")
    frame(nation, {"n_nationkey": "Int32", "n_name": "string"}).to_parquet(folder / "nation.parquet")
    return str(folder)


def brute_force(lineitem, orders, customer, nation):
    def by_key(rows):
        found = defaultdict(list)
        for key, value in rows:
            if key is not None:
                found[key].append(value)
        return found

    orders, customer, nation = by_key(orders), by_key(customer), by_key(nation)
    count, total = defaultdict(int), {}
    for key, price, discount in lineitem:
        for cust in orders.get(key, []):
            for nat in customer.get(cust, []):
                for name in nation.get(nat, []):
                    count[name] += 1
                    total.setdefault(name, None)
                    if price is not None and discount is not None:
                        amount = Decimal(str(price)) * (1 - Decimal(str(discount)))
                        total[name] = (total[name] or 0) + amount
    return sorted((n, count[n], None if total[n] is None else float(total[n])) for n in count)


def oracle(folder):
    connection = duckdb.connect()
    for name in ("lineitem", "orders", "customer", "nation"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return sorted(connection.sql(REVENUE_BY_NATION_SQL).fetchall())


def ours(spark, folder):
    return sorted(tuple(r) for r in revenue_by_nation(spark, folder).collect())


def random_tables(seed):
    """A third of the lines on one order, a third of the orders on one customer."""
    rng = random.Random(seed)
    nation = [(k, f"N{k % 4}") for k in range(6)]  # 0 and 4, 1 and 5 share a name
    customer = [(k, rng.choice([0, 1, 2, 3, 4, 5, 9, None])) for k in range(20)]
    orders = [(k, 1 if k % 3 == 0 else rng.choice([*range(25), None])) for k in range(100)]
    lineitem = [
        (
            7 if k % 3 == 0 else rng.choice([*range(120), None]),
            rng.choice([None, rng.randrange(-10_000, 10_500_000) / 100]),
            rng.choice([None, -0.0, rng.randrange(-5, 100) / 100]),
        )
        for k in range(900)
    ]
    return lineitem, orders, customer, nation


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_random_tables(spark, conf, tmp_path, seed, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    tables = random_tables(seed)
    folder = write(tmp_path, *tables)
    assert ours(spark, folder) == brute_force(*tables) == oracle(folder)


def test_repeated_keys_multiply_rows(spark, tmp_path):
    tables = ([(1, 10.5, 0.1), (1, 2.25, 0.0)], [(1, 5), (1, 5), (1, 6)], [(5, 0), (6, 0), (6, 1)], [(0, "A"), (1, "B")])
    folder = write(tmp_path, *tables)
    assert ours(spark, folder) == brute_force(*tables) == oracle(folder)


def test_empty_tables(spark, tmp_path):
    assert ours(spark, write(tmp_path, [], [], [], [])) == []


def test_only_nulls_sum_to_null(spark, tmp_path):
    tables = ([(1, None, 0.1)], [(1, 5)], [(5, 0)], [(0, "A")])
    folder = write(tmp_path, *tables)
    assert ours(spark, folder) == oracle(folder) == [("A", 1, None)]


def test_sums_past_the_range_of_one_bigint(spark, tmp_path):
    """At the top of the price range 9,300 lines would overflow a plain bigint sum."""
    price = 99_999_999_999.99
    tables = ([(1, price, 0.0)] * 10_000, [(1, 5)], [(5, 0)], [(0, "A")])
    folder = write(tmp_path, *tables)
    assert ours(spark, folder) == oracle(folder) == [("A", 10_000, float(Decimal("99999999999.99") * 10_000))]


def test_result_does_not_depend_on_partitioning(spark, conf):
    seen = set()
    for partitions in ("1", "3", "8"):
        conf("spark.sql.shuffle.partitions", partitions)
        conf("spark.sql.files.maxPartitionBytes", "128k" if partitions == "3" else "128m")
        seen.add(tuple(ours(spark, "/root/testdata/sf0.01")))
    assert len(seen) == 1


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_repeated_order_with_top_prices(spark, conf, tmp_path, ansi):
    """10,000 lines on an order that is there 10,000 times: the total is past a bigint, with and without ANSI mode."""
    conf("spark.sql.ansi.enabled", ansi)
    price = 99_999_999_999.99
    folder = write(tmp_path, [(1, price, 0.0)] * 10_000, [(1, 5)] * 10_000, [(5, 0)], [(0, "A")])
    assert ours(spark, folder) == [("A", 10**8, float(Decimal("99999999999.99") * 10**8))]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "column,price,discount",
    [
        ("price", 10.001, 0.1),
        ("price", 10.0001, 0.1),
        ("price", 10.00009, 0.1),
        ("price", float("inf"), 0.1),
        ("price", 1e13, 0.1),
        ("discount", 10.0, 0.125),
        ("discount", 10.0, 0.0501),
        ("discount", 10.0, 0.05009),
        ("discount", 10.0, 10.0),
        ("discount", 10.0, float("-inf")),
    ],
)
def test_inexact_input_is_refused(spark, conf, tmp_path, column, price, discount, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    folder = write(tmp_path, [(1, price, discount)], [(1, 5)], [(5, 0)], [(0, "A")])
    with pytest.raises(Exception, match=f"{column} is not exact"):
        revenue_by_nation(spark, folder).collect()


def test_two_decimals_are_accepted_up_to_the_limit(spark, tmp_path):
    rng = random.Random(5)
    prices = [rng.randrange(10**15) / 100 for _ in range(20_000)]
    folder = write(tmp_path, [(1, p, 0.0) for p in prices], [(1, 5)], [(5, 0)], [(0, "A")])
    total = sum(int(Decimal(repr(p)) * 100) for p in prices)
    assert ours(spark, folder) == [("A", len(prices), float(Decimal(total) / 100))]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_the_needed_columns(spark):
    text = plan(revenue_by_nation(spark, "/root/testdata/sf0.01"))
    schemas = sorted(set(re.findall(r"ReadSchema: (struct<.*?>)", text)))
    assert schemas == [
        "struct<c_custkey:bigint,c_nationkey:int>",
        "struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>",
        "struct<n_nationkey:int,n_name:string>",
        "struct<o_orderkey:bigint,o_custkey:bigint>",
    ]
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in text


def test_one_shuffle_when_the_other_tables_are_broadcast(spark, conf):
    """Only the nations' partial sums are shuffled: lineitem stays where it is read."""
    conf("spark.sql.autoBroadcastJoinThreshold", "1g")
    text = plan(revenue_by_nation(spark, "/root/testdata/sf0.01"))
    assert re.findall(r"Exchange hashpartitioning\((\w+?)#", text) == ["n_name"]
    assert not re.search("SortMergeJoin|Cartesian|NestedLoop|Python", text)
    assert re.search(r"HashAggregate\(keys=\[n_name#[^\n]*partial_sum", text)


def test_large_tables_shuffle_once_per_join(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(revenue_by_nation(spark, "/root/testdata/sf0.01"))
    assert text.count("SortMergeJoin") == 3
    assert not re.search("Cartesian|NestedLoop|Python", text)
    keys = re.findall(r"Exchange hashpartitioning\((\w+?)#", text)
    assert sorted(keys) == ["c_custkey", "c_nationkey", "l_orderkey", "n_name", "n_nationkey", "o_custkey", "o_orderkey"]


@pytest.mark.parametrize("hot", ["o_orderkey", "o_custkey"])
def test_hot_keys_are_split(spark, conf, tmp_path, hot):
    """A third of orders on one repeated key: adaptive execution deals its rows to several tasks."""
    rng = random.Random(9)
    n = 60_000
    orders = [
        (7 if hot == "o_orderkey" and k % 3 == 0 else k, 1 if hot == "o_custkey" and k % 3 == 0 else rng.randrange(1000))
        for k in range(n)
    ]
    lineitem = [(rng.randrange(8, n), 1.25, 0.0) for _ in range(20_000)] + [(7, 2.5, 0.1)] * 5
    tables = (lineitem, orders, [(k, k % 5) for k in range(1000)], [(k, f"N{k}") for k in range(5)])
    folder = write(tmp_path, *tables)
    # With the small tables broadcast the orders come to the last join from many tasks, as they do at scale.
    conf("spark.sql.autoBroadcastJoinThreshold", "20k" if hot == "o_orderkey" else "-1")
    conf("spark.sql.shuffle.partitions", "64")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.2")
    conf("spark.sql.files.maxPartitionBytes", "64k")
    df = revenue_by_nation(spark, folder)
    assert sorted(tuple(r) for r in df.collect()) == brute_force(*tables)
    assert "skew=true" in plan(df)
