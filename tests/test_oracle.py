"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import duckdb
import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from workload.oracle import ORACLES
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, db, name):
    assert check.compare(spark, db, name, SF)[0] == "ok"


def test_every_oracle_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries()) and set(ORACLES) == set(QUERIES)


def test_entry(spark):
    assert entry(spark).columns == ["iso_week", "store_nr", "cashier_id", "kpi_id", "flag"]
