from __future__ import annotations

import logging
import uuid

import pytest
from conftest import values
from pyspark.sql import functions as F

from tillwatch.operators import quality as q
from tillwatch.sinks import quality_tables
from tillwatch.sinks.store import Run, Store

ROWS = [(1, "a", 1.0), (2, "a", float("nan")), (None, "b", None), (2, None, 3.0)]
SCHEMA = "n int, t string, x double"
FLAGS = "store_nr int, kpi_id int, flag int"


def outcome(df):
    return tuple(df.select("status", "metric_value").first())


def test_not_null_counts_nan_only_in_float_columns(make):
    df = make(ROWS, SCHEMA)
    assert outcome(q.not_null(df, "x")) == ("FAIL", 2.0)
    assert outcome(q.not_null(df, "n", on_failure="warn")) == ("WARN", 1.0)
    assert outcome(q.not_null(df.filter("n = 1"), "t")) == ("PASS", 0.0)


def test_unique_counts_keys_not_rows(make):
    df = make([(1, 1), (1, 1), (1, 1), (2, 1), (None, 2), (None, 2)], "a int, b int")
    assert outcome(q.unique(df, "a")) == ("FAIL", 2.0)
    assert outcome(q.unique(df, ["a", "b"])) == ("FAIL", 2.0)
    assert outcome(q.unique(df.filter("a = 2"), ["a", "b"])) == ("PASS", 0.0)


def test_distinct_count_takes_null_as_a_value(make):
    df = make(ROWS, SCHEMA)
    assert outcome(q.distinct_count(df, "t", 3)) == ("PASS", 3.0)
    assert outcome(q.distinct_count(df, "t", 4)) == ("FAIL", 3.0)
    assert outcome(q.distinct_count(df.filter("false"), "t", 1)) == ("FAIL", 0.0)


@pytest.mark.parametrize(
    ("baseline", "pct", "status"),
    [(4, 0, "PASS"), (5, 20, "PASS"), (5.1, 20, "FAIL"), (3.2, 25, "PASS"), (3.1, 25, "FAIL"), (None, 1, "PASS"), (9, None, "PASS")],
)
def test_row_count_drift(make, baseline, pct, status):
    assert outcome(q.row_count_drift(make(ROWS, SCHEMA), baseline, pct)) == (status, 4.0)


def test_drift_messages_have_no_exponent(spark, make):
    suite = [{"type": "row_count_drift", "comparison": {"type": "tolerance_percent", "value": 30}}]
    assert q.check_results(spark.range(12_345_678), suite).first()["message"] == "row_count_drift is 12345678.0, nothing to compare with"
    for mean, text in [(12_345_678.25, "12345678.25"), (2e9, "2000000000.0"), (-1e7, "-10000000.0"), (2.5, "2.5"), (1e40, "1.0E40"), (None, "NULL")]:
        assert q.avg_drift(make([(mean,)], "x double"), "x", None, None).first()["message"] == f"avg_drift:x is {text}, nothing to compare with"


def test_average_drift(make):
    df = make(ROWS, SCHEMA)
    assert outcome(q.avg_drift(df, "n", 5 / 3, 1))[0] == "PASS"
    assert outcome(q.avg_drift(df, "n", 3.0, 1))[0] == "FAIL"
    assert outcome(q.avg_drift(df.filter("n IS NULL"), "n", 3.0, 1)) == ("WARN", None)
    assert outcome(q.avg_drift(df.filter("n IS NULL"), "n", None, 1)) == ("WARN", None)


def test_store_and_kpi_flags(make):
    flags = make([(s, k, f) for s in range(1, 31) for k, f in [(1, 2 if s <= 5 else 1), (2, 1)]] + [(40, 3, 2)], FLAGS)
    assert outcome(q.stores_red_flag(flags, "store_nr", 6)) == ("PASS", 6.0)
    failed = q.stores_red_flag(flags, "store_nr", 10).first()
    assert (failed["status"], failed["metric_value"]) == ("FAIL", 4.0)
    assert failed["message"] == "6 of 31 stores have red flags, 10 required"
    assert values(q.stores_without_red_flag(flags, "store_nr")) == [(n,) for n in range(6, 31)]
    with pytest.raises(ValueError):
        q.stores_red_flag(flags, "store_nr", -1)
    red = q.kpi_red_flag(flags).first()
    assert (red["status"], red["metric_value"], red["message"]) == ("FAIL", 1.0, "KPIs without red flags: 2")
    assert outcome(q.kpi_orange_flag(flags)) == ("FAIL", 1.0)
    assert outcome(q.kpi_orange_flag(flags, exempt=[3])) == ("PASS", 0.0)


def test_suite_keeps_order_and_skips_what_it_cannot_run(make, caplog):
    def no_letters(df, spec):
        found = df.agg(F.count_if(F.col("t") == "b").alias("n"))
        return found.select(
            F.lit("no_letters").alias("check_type"), F.lit(spec["name"]).alias("check_name"), F.lit("WARN").alias("status"),
            F.lit("one b").alias("message"), F.col("n").cast("double").alias("metric_value"),
        )

    suite = [
        {"type": "unique", "columns": "n", "on_failure": "warn"},
        {"type": "not_null", "column": "t", "name": "t filled"},
        {"type": "nonsense"}, {"name": "no type"}, {"type": "not_null"}, {"type": "not_null", "column": "t", "on_failure": "shout"},
        {"type": no_letters, "name": "own check"},
        {"type": "distinct_count", "column": "t", "min_threshold": 2},
        {"type": "row_count_drift", "comparison": {"type": "other", "value": 1}},
    ]
    with caplog.at_level(logging.WARNING):
        rows = q.check_results(make(ROWS, SCHEMA), suite, {"row_count_drift": 100.0}).collect()
    assert [(r["check_name"], r["status"], r["metric_value"]) for r in rows] == [
        ("unique", "WARN", 1.0), ("t filled", "FAIL", 1.0), ("own check", "WARN", 1.0), ("distinct_count", "PASS", 3.0), ("row_count_drift", "PASS", 4.0)
    ]
    assert len(caplog.records) == 4
    assert q.check_results(make(ROWS, SCHEMA), []).count() == 0


def test_scalar_checks_share_one_pass(make):
    suite = [{"type": "not_null", "column": c} for c in ("n", "t", "x")] + [{"type": "row_count_drift"}]
    plan = q.check_results(make(ROWS, SCHEMA), suite)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


@pytest.fixture
def store(spark, tmp_path):
    tag = uuid.uuid4().hex
    spark.sql(f"CREATE SCHEMA q_{tag} LOCATION '{tmp_path}/q'")
    return Store(f"{tmp_path}/w", f"{tmp_path}/h", f"q_{tag}")


def test_run_checks_logs_raises_and_stages(spark, make, store):
    drift = [
        {"type": "row_count_drift", "on_failure": "fail", "comparison": {"type": "tolerance_percent", "value": 10}},
        {"type": "avg_drift", "column": "n", "on_failure": "warn", "comparison": {"type": "tolerance_percent", "value": 10}},
        {"type": "not_null", "column": "t", "on_failure": "warn"},
    ]
    small, large = make([(1, "a")] * 4, "n int, t string"), make([(9, "a")] * 4, "n int, t string")
    metrics = quality_tables.load_metrics(spark, store)
    first = q.run_checks(small, "t", drift, metrics, Run("r1", "1"), store)
    assert [r["status"] for r in first] == ["PASS", "PASS", "PASS"]
    quality_tables.commit_metrics(spark, store, "r1")
    metrics = quality_tables.load_metrics(spark, store)
    assert values(metrics, "metric_id", "metric_value") == [("avg_drift:n", 1.0), ("row_count_drift", 4.0)]
    second = q.run_checks(large, "t", drift, metrics, Run("r2", "2"), store)
    assert [r["status"] for r in second] == ["PASS", "WARN", "PASS"]
    with pytest.raises(q.QualityError, match="row_count_drift"):
        q.run_checks(small.limit(1), "t", drift, metrics, Run("r3", "3"), store)
    log = quality_tables.load_checks(spark, store)
    assert values(log.groupBy("run_id").count()) == [("r1", 3), ("r2", 3), ("r3", 3)]
    quality_tables.commit_metrics(spark, store, "r3")  # a failed run stages nothing
    assert values(quality_tables.load_metrics(spark, store).select("run_id").distinct()) == [("r1",)]
    quality_tables.commit_metrics(spark, store, "r2")
    assert values(q.baselines(quality_tables.load_metrics(spark, store), "t", ["row_count_drift", "avg_drift:n"])) == [
        ("avg_drift:n", 5.0), ("row_count_drift", 4.0)
    ]


def test_key_checks_of_a_suite_take_one_scan(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(9000).selectExpr("id", "CASE WHEN id % 3 > 0 THEN 7 ELSE id END hot", "CASE WHEN id % 2 = 0 THEN NULL ELSE id % 5 END some", "CASE id WHEN 0 THEN -0.0D WHEN 1 THEN 0.0D WHEN 2 THEN double('NaN') WHEN 3 THEN double('NaN') ELSE 1.5 END x").write.parquet(path)
    df = spark.read.parquet(path)
    suite = [
        {"type": "unique", "columns": "id"}, {"type": "unique", "columns": ["hot", "some"], "name": "pair", "on_failure": "warn"}, {"type": "distinct_count", "column": "hot", "min_threshold": 3001},
        {"type": "distinct_count", "column": "some", "min_threshold": 7, "name": "some"}, {"type": "distinct_count", "column": "x", "min_threshold": 1, "name": "x"}, {"type": "unique", "columns": ["hot"], "name": "hot"}, {"type": "unique", "columns": ["absent"]},
    ]
    got = q.check_results(df, suite)
    assert [(r["check_name"], r["status"], r["metric_value"]) for r in got.collect()] == [
        ("unique", "PASS", 0), ("pair", "WARN", 6), ("distinct_count", "PASS", 3001), ("some", "FAIL", 6), ("x", "PASS", 3), ("hot", "FAIL", 1),
    ]
    # two sums and a count of a small table are no scans of this one
    text = got._jdf.queryExecution().executedPlan().toString()
    assert text.split("Initial Plan")[0].count("FileScan") == 1, text
    assert q.check_results(df.limit(0), suite[:3]).collect()[2]["metric_value"] == 0
