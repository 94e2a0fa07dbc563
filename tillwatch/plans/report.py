"""Stage 4: the report over the archived weeks, and the weekly documents."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tillwatch.operators import export, reporting
from tillwatch.params import Params
from tillwatch.sinks.store import Store, TableNotFound
from tillwatch.sinks.tables import history, save_table
from tillwatch.sources.readers import load_table

Keep = Callable[[DataFrame, str], DataFrame]

#: Weeks that a report needs at least, to tell what changed.
LEAST_WEEKS = 2


class TooFewWeeks(ValueError):
    """The archive has not enough weeks for a report."""


def report_basis(details: DataFrame, flags: DataFrame, org: DataFrame, p: Params, keep: Keep = lambda df, name: df) -> dict[str, DataFrame]:
    """What all report tables start from, of archived runs (``run_id`` in each table)."""
    basis: dict[str, DataFrame] = {"org": org, "details": details, "flags": flags}
    for name, build in basis_builders(basis, p, keep).items():
        basis[name] = build()
    return {name: df for name, df in basis.items() if name not in ("org", "details", "flags")}


def basis_builders(x: Mapping[str, DataFrame], p: Params, keep: Keep) -> dict[str, Callable[[], DataFrame]]:
    """How each table of ``report_basis`` is built, in order; a table is looked up in ``x`` when one that reads it is.

    So a caller that needs a few of them writes no others.
    """

    def recent(name: str) -> DataFrame:
        return reporting.in_weeks(x[f"by_week_{name}"], x["weeks"])

    return {
        "run_weeks": lambda: reporting.run_weeks(x["details"], x["flags"]),
        "by_week_org": lambda: reporting.attach_week(x["org"], x["run_weeks"]),
        "by_week_details": lambda: reporting.attach_week(x["details"], x["run_weeks"]),
        "by_week_flags": lambda: reporting.attach_week(x["flags"], x["run_weeks"]),
        "weeks": lambda: reporting.common_weeks(x["by_week_org"], x["by_week_details"], x["by_week_flags"], p.look_back_weeks),
        "regions": lambda: reporting.store_regions(recent("org")),
        "found": lambda: keep(reporting.anomalies_with_region(recent("details"), x["regions"]), "anomalies_with_region"),
        "flagged": lambda: reporting.flags_with_region(recent("flags"), x["regions"]),
        "dense": lambda: keep(reporting.dense_flag_counts(x["flagged"], x["regions"]), "flag_counts"),
    }


def report_tables(basis: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All tables of the report."""
    found, flagged, dense = basis["found"], basis["flagged"], basis["dense"]
    total = reporting.total_flag_stats(dense)
    stores = reporting.anomalies_per_store(found)
    return {
        "headline": reporting.headline(found, flagged),
        "anomalous_receipts": reporting.anomalous_receipts_per_week(found),
        "anomalies_per_week": reporting.anomalies_per_week(found),
        "anomalies_per_store": stores,
        "anomaly_overview": reporting.anomaly_overview(found),
        "anomaly_totals": reporting.anomaly_totals(found),
        "weekly_trend": reporting.weekly_trend(found),
        "stores_by_week": reporting.box_summary(stores, "iso_week", "anomalies"),
        "total_flag_stats": total,
        "weekly_flag_stats": reporting.weekly_flag_stats(dense),
        "flag_distribution": reporting.flag_distribution(total),
        "region_flags": reporting.flag_counts(dense, "region_manager"),
        "store_flags": reporting.flag_counts(dense, "store_nr"),
    }


def recent_runs(spark: SparkSession, store: Store, p: Params) -> list[str]:
    """Runs of the last ``look_back_weeks`` weeks, from the small table of runs that ``run_week`` keeps."""
    runs = history(spark, store, "runs")
    if runs is None:
        raise TableNotFound("runs")
    weeks = runs.select("iso_week").distinct().orderBy("iso_week", ascending=False).limit(p.look_back_weeks)
    # one row per week looked back upon and run of it
    return [r["run_id"] for r in runs.join(weeks, "iso_week", "leftsemi").select("run_id").distinct().collect()]


def report_week(spark: SparkSession, store: Store, p: Params, documents: str | None = None) -> dict[str, DataFrame]:
    """The report tables over the archived runs, saved in the working zone; with a path, the documents of these weeks as well.

    Only the partitions of the runs looked back upon are read.
    """
    runs = recent_runs(spark, store, p)
    past = {name: history(spark, store, name) for name in ("anomalies", "flags", "org")}
    past = {name: df.filter(df["run_id"].isin(runs)) for name, df in past.items()}

    def keep(df: DataFrame, name: str) -> DataFrame:
        save_table(df, store, f"report_{name}")
        return load_table(spark, store, f"report_{name}", required=True)

    basis = report_basis(past["anomalies"], past["flags"], past["org"], p, keep)
    if basis["weeks"].count() < LEAST_WEEKS:
        raise TooFewWeeks(f"a report needs {LEAST_WEEKS} weeks")
    out = {name: keep(df, name) for name, df in report_tables(basis).items()}
    if documents is not None:
        export.write_named_documents(past["flags"], past["anomalies"], documents)
    return out
