from __future__ import annotations

import uuid

import pytest
from conftest import values
from pyspark.sql import types as T

from tillwatch.model import PIPELINE_METRICS
from tillwatch.sinks import quality_tables, tables
from tillwatch.sinks.store import Run, Store
from tillwatch.sources.readers import load_table


@pytest.fixture(params=["folders", "catalog"])
def store(request, spark, tmp_path):
    tag = uuid.uuid4().hex
    for zone in ("w", "h", "q"):
        spark.sql(f"CREATE SCHEMA {zone}_{tag} LOCATION '{tmp_path}/{zone}'")
    if request.param == "catalog":
        return Store(f"w_{tag}", f"h_{tag}", f"q_{tag}")
    return Store(f"{tmp_path}/working", f"{tmp_path}/historical", f"q_{tag}")


def test_saving_replaces_rows_and_columns(spark, make, store):
    tables.save_table(make([(1, "a")], "n int, t string"), store, "t")
    tables.save_table(make([(2.5,)], "x double"), store, "t")
    assert load_table(spark, store, "t").dtypes == [("x", "double")]
    assert values(load_table(spark, store, "t")) == [(2.5,)]


def test_align_schema(make):
    target = T.StructType([T.StructField("Store", T.IntegerType()), T.StructField("total", T.DoubleType())])
    got = tables.align_schema(make([("7", "1.5", "x")], "STORE string, Total string, extra string"), target)
    assert got.dtypes == [("Store", "int"), ("total", "double"), ("extra", "string")]
    assert values(got) == [(7, 1.5, "x")]
    bad = make([("seven",)], "store string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.align_schema(bad, target).collect()
    assert values(tables.align_schema(bad, target, lenient=True)) == [(None,)]
    assert tables.align_schema(bad, None) is bad


def test_archive_appends_with_run_and_new_columns(spark, make, store):
    tables.archive_table(make([(1, "a")], "n int, t string"), store, "t", Run("20250113000000", "r1"))
    tables.archive_table(make([("2", "b", 0.5)], "N string, t string, extra double"), store, "t", Run("20250120000000", "r2"))
    tables.archive_table(make([(3,)], "n int"), store, "t", Run("20250127000000", "r3"))
    got = tables.history(spark, store, "t")
    assert dict(got.dtypes)["run_id"] == "string" and dict(got.dtypes)["n"] == "int"
    assert values(got, "run_id", "run_timestamp", "n", "t", "extra") == [
        ("20250113000000", "r1", 1, "a", None), ("20250120000000", "r2", 2, "b", 0.5), ("20250127000000", "r3", 3, None, None)
    ]
    assert tables.history(spark, store, "nothing") is None


def metric(run, value, name="rows"):
    return dict(zip(PIPELINE_METRICS.names, (run, "t", name, value, f"at {run}")))


def test_commit_moves_one_run_and_can_be_repeated(spark, store):
    quality_tables.commit_metrics(spark, store, "r1")  # nothing staged yet
    assert quality_tables.load_metrics(spark, store).count() == 0
    quality_tables.stage_metrics(spark, [metric("r1", 1.0), metric("r1", 2.0, "avg")], store)
    quality_tables.stage_metrics(spark, [metric("r2", 3.0), metric("it's", 4.0)], store)
    for run in ("r1", "unknown", "it's"):
        quality_tables.commit_metrics(spark, store, run)
    done = lambda: values(quality_tables.load_metrics(spark, store), "run_id", "metric_value")
    assert done() == [("it's", 4.0), ("r1", 1.0), ("r1", 2.0)]
    staged = load_table(spark, store, quality_tables.STAGING, "quality")
    assert values(staged, "run_id") == [("r2",)]
    quality_tables.stage_metrics(spark, [metric("r1", 1.0), metric("r1", 2.0, "avg")], store)  # as after a lost commit
    quality_tables.commit_metrics(spark, store, "r1")
    assert done() == [("it's", 4.0), ("r1", 1.0), ("r1", 2.0)]


def test_check_log(spark, make, store):
    with pytest.raises(LookupError):
        quality_tables.load_checks(spark, store)
    schema = "check_type string, check_name string, status string, message string, metric_value string"
    quality_tables.log_checks(make([("k", "n", "PASS", "m", "1.5"), ("k", "o", "WARN", "m", "[a]")], schema), Run("r1", "now"), "t", store)
    quality_tables.log_checks(make([("k", "n", "FAIL", "m", None)], schema), Run("r2", "later", "job"), "t", store)
    assert values(quality_tables.load_checks(spark, store), "run_id", "check_name", "metric_value", "metric_text") == [
        ("r1", "n", 1.5, None), ("r1", "o", None, "[a]"), ("r2", "n", None, None)
    ]
    assert values(quality_tables.load_checks(spark, store, "r2"), "task_name", "table_name", "status") == [("job", "t", "FAIL")]
