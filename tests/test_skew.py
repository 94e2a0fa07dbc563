"""Queries on inputs where single keys hold a third of the rows."""

from __future__ import annotations

from datetime import date

import duckdb
import pytest

import check
from tillwatch.operators import reporting

SF = "/root/testdata/sf0.001"
QUERIES = [
    "a07_return_receipts", "a08_returns_without_original", "c01_cashier_stats", "c03_receipts_outside_hours",
    "c05_voided_cash_receipts", "d05_m05", "d06a_next_receipt", "d06_m06", "e11_rank_flags", "e13_flag_cashiers",
    "g07_anomalies_with_region", "h03_weekly_documents",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """A third of the orders at one store, cashier, register and day; a fifth of the lines on two receipts."""
    folder = tmp_path_factory.mktemp("skewed")
    db = duckdb.connect()
    moved = "1000000000 + {0} * 770"
    db.execute(
        f"COPY (SELECT CASE WHEN o_orderkey % 3 = 0 THEN {moved.format('o_orderkey')} ELSE o_orderkey END AS o_orderkey, "
        "CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS o_custkey, * EXCLUDE (o_orderkey, o_custkey) "
        f"FROM '{SF}/orders.parquet') TO '{folder}/orders.parquet' (FORMAT parquet)"
    )
    db.execute(
        "COPY (SELECT CASE WHEN l_orderkey % 9 = 0 THEN 4 WHEN l_orderkey % 9 = 3 THEN 20 "
        f"WHEN l_orderkey % 3 = 0 THEN {moved.format('l_orderkey')} ELSE l_orderkey END AS l_orderkey, "
        f"* EXCLUDE (l_orderkey) FROM '{SF}/lineitem.parquet') TO '{folder}/lineitem.parquet' (FORMAT parquet)"
    )
    for table in ("orders", "lineitem"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    assert db.execute("SELECT max(n) * 10 > sum(n) FROM (SELECT count(*) n FROM lineitem GROUP BY l_orderkey)").fetchone()[0] is True
    return str(folder), db


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, skewed, name):
    folder, db = skewed
    verdict, rows, *_ = check.compare(spark, db, name, folder)
    assert verdict == "ok" and rows > 0


def test_rows_of_a_run_or_week_do_not_meet_in_one_task(make, spark):
    """The week of a run, and the weeks looked back upon, are sent to the rows, whatever Spark's own limit is."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    details = make([("r1" if i % 2 else "r2", date(2025, 1, 6 + 7 * (i % 2)), i) for i in range(50)], "run_id string, receipt_date date, receipt_id long")
    flags = make([("r1", "2025-03"), ("r2", "2025-02"), ("r3", "2025-02")], "run_id string, iso_week string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        weeks = reporting.run_weeks(details, flags)
        rows = reporting.in_weeks(reporting.attach_week(details, weeks), weeks.select("iso_week").distinct())
        text = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
    assert {tuple(r) for r in rows.select("run_id", "iso_week").distinct().collect()} == {("r1", "2025-03"), ("r2", "2025-02")} and rows.count() == 50
