"""Registered queries against their SQL.

A few run by default; ``EMBERLOG_ALL_QUERIES=1`` runs every one (some minutes), as does
``python tools/check_queries.py``.
"""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from emberlog.plans.registry import QUERIES
from oracle_queries import ORACLES
from tools.check_queries import TABLES, rows_of

SOME = ("player_raid_stats", "silver_refine_report", "batch_verdict", "dim_raid_upsert",
        "event_order_check", "path_keys", "scalar_functions", "gold_contract_violations")
NAMES = sorted(QUERIES) if os.environ.get("EMBERLOG_ALL_QUERIES") else SOME


@pytest.fixture(scope="module")
def database(small):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 30


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, small, database, name):
    frame = entry.queries()[name](spark, small)
    result = database.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(columns, result.fetchall())
