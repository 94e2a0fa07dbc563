"""A whole run on the small tables, its invariants, and its plans."""

from __future__ import annotations

import os
import re
import uuid

import pytest
from conftest import values
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillwatch.operators import flagging, metrics, quality, rules, scale
from tillwatch.plans.report import TooFewWeeks, recent_runs, report_week
from tillwatch.plans.week import extract_week, prepare_week, run_week, week_anomalies, week_metrics
from tillwatch.sinks import quality_tables, tables
from tillwatch.sinks.store import Run, Store
from tillwatch.sources import extracts
from workload.queries import PARAMS, Week

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def week(spark):
    return Week.of(spark, SF)


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_run_with_store_checks_and_history(spark, week, tmp_path):
    tag = uuid.uuid4().hex
    spark.sql(f"CREATE SCHEMA q_{tag} LOCATION '{tmp_path}/q'")
    store = Store(f"{tmp_path}/w", f"{tmp_path}/h", f"q_{tag}")
    checks = {
        "anomalies": [{"type": "distinct_count", "column": "store_nr", "min_threshold": 15}],
        "flags": [
            {"type": "stores_red_flag", "column": "store_nr", "min_threshold": 5},
            {"type": "kpi_red_flag", "on_failure": "warn"},
            {"type": "row_count_drift", "on_failure": "warn", "comparison": {"type": "tolerance_percent", "value": 30}},
        ],
    }
    for run_id in ("20250120000000", "20250127000000"):
        out = run_week(week.raw, PARAMS, store, Run(run_id, run_id), checks)
    assert values(out["flags"]) == values(week.flags)
    assert tables.history(spark, store, "flags").count() == 2 * week.flags.count()
    assert quality_tables.load_metrics(spark, store).count() == 2
    assert quality_tables.load_checks(spark, store).count() == 8
    assert recent_runs(spark, store, PARAMS) and tables.history(spark, store, "runs").count() == 2
    with pytest.raises(TooFewWeeks):  # both runs are of one week
        report_week(spark, store, PARAMS)
    pruned = tables.history(spark, store, "anomalies")
    assert re.search(r"PartitionFilters: \[[^\]]*run_id", plan(pruned.filter(pruned["run_id"].isin(["20250120000000"]))))
    with pytest.raises(quality.QualityError):  # twenty stores are too few for the default gates
        run_week(week.raw, PARAMS, store, Run("20250203000000", "20250203000000"))


def written(spark):
    return set(os.listdir(spark.conf.get("spark.checkpoint.dir")))


def test_operators_write_nothing_when_built_but_ranges(spark, week):
    """Ranges are drawn from a sample, so what is dealt out by range is written; nothing else is."""
    before = written(spark)
    extract_week(week.raw, PARAMS)
    rules.header_rules(week.x["headers"], week.x["hours"], week.x["lines"], week.x["cash"], PARAMS)
    assert written(spark) == before
    merged = week.merged()
    assert [name.split("-")[0] for name in written(spark) - before] == ["ranges"]  # the next receipts of KPI 6
    flagging.flag_cashiers(merged, week.x["cashier_stats"], week.x["org"], PARAMS)
    assert {name.split("-")[0] for name in written(spark) - before} == {"ranges"}


def test_rules_at_once_give_what_the_metrics_give(week):
    for p in (PARAMS, PARAMS.with_(cash_only=False)):
        x = extract_week(week.raw, p)
        x |= prepare_week(x, p)
        assert values(week_anomalies(week.raw, x, p)) == values(flagging.merge_anomalies(week_metrics(x, p)))


def test_merged_rules_need_half_the_exchanges(week):
    apart, together = (plan(df) for df in (flagging.merge_anomalies(week_metrics(week.x, PARAMS)), week.merged()))

    def count(text):
        return len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange (?:hash|range)partitioning", text))

    assert count(together) * 3 <= count(apart) * 2 and together.count("FileScan") * 3 <= apart.count("FileScan") * 2


def windows(text):
    """The partition columns of all windows of a plan."""
    return re.findall(r"windowspecdefinition\((.*?) (?:ASC|DESC)", text)


def test_no_window_has_the_rows_of_a_group(week):
    for df in (flagging.rank_flags(week.levels), flagging.thresholds(week.base, PARAMS), metrics.next_receipt(week.x["headers"])):
        specs = windows(plan(df))
        assert specs and all(spec.startswith("range_of#") for spec in specs)


def test_flags_without_regions_and_in_one_region(spark, week):
    for region in (None, "all"):
        org = week.x["org"].withColumn("region_manager", F.lit(region).cast("string"))
        levels = flagging.levels(week.base, org, PARAMS)
        by_window = Window.partitionBy("iso_week", "region_manager").orderBy(F.col("level").desc_nulls_last(), F.col("kpi_score").desc_nulls_last())
        names = ["iso_week", "store_nr", "cashier_id", "kpi_id", "region_rank"]
        assert values(flagging.rank_flags(levels), *names) == values(levels.withColumn("region_rank", F.rank().over(by_window)), *names)


def test_originals_are_looked_up_without_an_aggregate_of_the_sales(week):
    text = plan(extracts.originals_found(week.raw["receipt_line"], week.raw["location"], PARAMS))
    assert text.count("HashAggregate") <= 6 and "LeftSemi" in text  # the distinct names, for the check and for the filter, and the filter


def test_sold_lines_are_cut_down_to_the_originals_before_the_shuffle(spark, week):
    """With no broadcast but the filter's, what is shuffled of the sold lines is what matches, and 2% at most."""
    line, location = week.raw["receipt_line"], week.raw["location"]
    sold = extracts.original_sales(line, location, PARAMS).toDF(*extracts.ORIGINAL)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = extracts.originals_found(line, location, PARAMS)
        matches = sold.join(found, extracts.ORIGINAL, "leftsemi").count()
        found.collect()
        text = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    names = extracts._named_originals(extracts._return_lines(line, location, PARAMS)).filter("store IS NOT NULL").select(*extracts.ORIGINAL).distinct()
    keys = [F.col("sold_on") if c == "sold_on" else F.col(c).cast("long") for c in extracts.ORIGINAL]
    shuffled = scale.maybe_members(sold, keys, scale.members_filter(names, keys)).count()
    assert 0 < matches <= shuffled <= 1.02 * matches and sold.count() > 5 * shuffled
    assert re.search(r"SortMergeJoin|ShuffledHashJoin", text) and "filter_word" in text


def test_expected_counts(week):
    found = dict(week.anomalies.groupBy("kpi_id").count().collect())
    assert found == {1: 2459, 2: 320, 3: 3983, 4: 876, 5: 91, 6: 455, 7: 209, 8: 1339, 9: 668, 10: 1212}


def test_flag_invariants(week):
    keys = ["iso_week", "store_nr", "cashier_id", "kpi_id"]
    ranked = flagging.rank_flags(week.levels)
    joined = week.flags.join(ranked, keys, "left")
    assert joined.filter("kpi_score IS NULL").isEmpty()
    red, orange = joined.filter("flag = 2"), joined.filter("flag = 1")
    assert red.filter("level IS NULL OR level < 2").isEmpty()
    assert red.filter("level = 2 AND region_rank > max_red_flags").isEmpty()
    assert orange.filter(F.col("store_rank") > PARAMS.num_flags_per_store).isEmpty()
    assert ranked.filter("level = 3").join(week.flags.filter("flag = 2"), keys, "leftanti").isEmpty()
    branches = {tuple(r) for r in joined.select("level", "flag").distinct().collect()}
    assert branches == {(3, 2), (2, 2), (2, 1), (1, 1), (None, 1)}


def test_filters_and_columns_reach_the_files(week):
    text = plan(week.x["lines"])
    assert "LessThan(register_id,80)" in text and "EqualTo(turnover_relevant_fg,1)" in text
    assert "GreaterThanOrEqual(receipt_date,2025-01-06)" in text
    assert "sales_piece_qty" not in text and "orig_receipt_id" not in text


def test_groups_are_cut_down_before_the_shuffle(week):
    for df in (
        metrics.nth_last_subtotal(week.x["subtotals"], week.x["cash"], PARAMS),
        metrics.last_voided_articles(week.x["lines"], week.x["cash"], PARAMS),
    ):
        text = plan(df)
        assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_no_python_and_no_cartesian_product(week):
    for df in (week.x["outside"], week.x["voided"], week.levels, flagging.rank_flags(week.levels), week.dense, week.found):
        text = plan(df)
        assert "Python" not in text and "CartesianProduct" not in text
