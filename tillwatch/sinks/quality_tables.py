"""Drift metrics and the check log, kept in the quality zone."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.model import CHECK_LOG, PIPELINE_METRICS
from tillwatch.sinks.store import Run, Store
from tillwatch.sinks.tables import append_table
from tillwatch.sources.readers import load_table

METRICS, STAGING, LOG = "pipeline_metrics", "pipeline_metrics_staging", "check_results_log"


def stage_metrics(spark: SparkSession, rows: Iterable[Mapping[str, Any]], store: Store) -> None:
    """Append the drift metrics of a run to the staging table; one row per check of the run."""
    staged = spark.createDataFrame([tuple(r[c] for c in PIPELINE_METRICS.names) for r in rows], PIPELINE_METRICS)
    append_table(staged, store, STAGING, "quality")


def commit_metrics(spark: SparkSession, store: Store, run_id: str) -> None:
    """Move the staged metrics of one run to the permanent table; other runs stay staged.

    The run's partition of the permanent table is replaced, not added to, so a
    commit that failed half-way can simply be repeated.
    """
    staged = load_table(spark, store, STAGING, "quality")
    if staged is None:
        return
    mine = staged.filter(F.col("run_id") == run_id)
    if mine.isEmpty():
        return
    permanent, quoted = store.table("quality", METRICS), run_id.replace("\\", "\\\\").replace("'", "\\'")
    partition = f"PARTITION (run_id = '{quoted}')"
    if spark.catalog.tableExists(permanent):
        columns = ", ".join(f"`{c}`" for c in spark.table(permanent).columns if c != "run_id")
        spark.sql(f"INSERT OVERWRITE TABLE {permanent} {partition} SELECT {columns} FROM {{mine}}", mine=mine)
    else:
        append_table(mine, store, METRICS, "quality")
    spark.sql(f"ALTER TABLE {store.table('quality', STAGING)} DROP IF EXISTS {partition}")


def log_checks(results: DataFrame, run: Run, table: str, store: Store) -> None:
    """Append check results with their run; a metric that is no number is kept as text."""
    number = F.col("metric_value").try_cast("double")
    context = {
        "run_id": F.lit(run.run_id),
        "run_timestamp": F.lit(run.run_timestamp),
        "task_name": F.lit(run.task_name),
        "table_name": F.lit(table),
        "metric_text": F.when(number.isNull(), F.col("metric_value").cast("string")),
        "metric_value": number,
    }
    append_table(results.withColumns(context).select(*CHECK_LOG.names), store, LOG, "quality")


def load_checks(spark: SparkSession, store: Store, run_id: str | None = None) -> DataFrame:
    log = load_table(spark, store, LOG, "quality", required=True)
    return log if run_id is None else log.filter(F.col("run_id") == run_id)


def load_metrics(spark: SparkSession, store: Store) -> DataFrame:
    """Permanent drift metrics; empty before the first commit."""
    metrics = load_table(spark, store, METRICS, "quality")
    return spark.createDataFrame([], PIPELINE_METRICS) if metrics is None else metrics
