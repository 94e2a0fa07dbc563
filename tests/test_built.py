"""Queries write the raw tables they read and no others."""

from __future__ import annotations

import os
import shutil

import pytest

from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"
RAW = {"receipt_header", "receipt_line", "subtotal_line", "payment", "location", "store_hours", "org_structure"}


@pytest.mark.parametrize(
    ("name", "needed"),
    [
        ("i06_month_bounds", set()),
        ("b04_write_external", {"org_structure"}),
        ("a08_returns_without_original", {"receipt_header", "receipt_line", "location"}),
        ("e01_merge_anomalies", RAW - {"org_structure"}),
    ],
)
def test_raw_tables_are_written_when_read(spark, tmp_path, name, needed):
    for table in ("orders", "lineitem"):
        shutil.copy(f"{SF}/{table}.parquet", tmp_path)
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    assert QUERIES[name](spark, str(tmp_path)).count() > 0
    assert {folder.rsplit("-", 1)[0] for folder in set(os.listdir(shared)) - before} & RAW == needed


@pytest.mark.parametrize(
    ("name", "written"),
    [
        ("g03_inconsistent_weeks", {"anomalies"}),
        ("g04_attach_week", {"anomalies", "flags"}),
        ("g16_anomalies_per_week", {"anomalies", "flags", "anomalies_with_region"}),
        ("g11_add_total_rows", {"anomalies", "flags", "flag_counts"}),
    ],
)
def test_results_of_a_run_are_written_when_read(spark, tmp_path, name, written):
    """A query of the report writes the results it reads, and none that other queries read."""
    for table in ("orders", "lineitem"):
        shutil.copy(f"{SF}/{table}.parquet", tmp_path)
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    QUERIES[name](spark, str(tmp_path)).collect()
    results = {"anomalies", "flags", "anomalies_with_region", "flag_counts"}
    assert {folder.rsplit("-", 1)[0] for folder in set(os.listdir(shared)) - before} & results == written
