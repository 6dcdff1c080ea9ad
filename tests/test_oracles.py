"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as contract
from registry import oracles, queries as registered
from tests.conftest import SMALL, plan_of

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(repr(row[i]) for i in order) for row in rows))


@pytest.mark.parametrize("name", oracles.oracle_sql())
def test_query_matches_sql(spark, duck, name):
    found = contract.queries()[name](spark, SMALL)
    expected = duck.execute(oracles.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    rows = expected.fetchall()
    assert sorted(found.columns) == sorted(columns)
    assert sorted_rows(found.columns, found.collect()) == sorted_rows(columns, rows)
    described = duck.execute("DESCRIBE " + oracles.oracle_sql()[name]).fetchall()
    types = {row[0]: row[1] for row in described}
    assert {n: TYPES[kind] for n, kind in found.dtypes} == types
    plan = plan_of(found)
    for unwanted in ["Python", "CartesianProduct", "BroadcastNestedLoopJoin"]:
        assert unwanted not in plan


def test_queries_without_sql_are_samples_and_previews(spark):
    missing = set(registered.queries()) - set(oracles.oracle_sql())
    assert missing == {"preview", "sample_rows", "describe_sample"}
    assert {f"{name}_check" for name in missing} <= set(oracles.oracle_sql())
    assert set(oracles.oracle_sql()) <= set(contract.oracle_sql())
    sizes = {name: registered.queries()[name](spark, SMALL).count() for name in missing}
    assert sizes == {"preview": 100, "sample_rows": 5_000, "describe_sample": 4}


def test_entry_returns_the_busiest_pairs(spark):
    pairs = contract.entry(spark).collect()
    assert len(pairs) == 20
    assert all(a["trips"] >= b["trips"] for a, b in zip(pairs, pairs[1:]))
    assert not any(math.isnan(row["avg_total_amount"]) for row in pairs)
