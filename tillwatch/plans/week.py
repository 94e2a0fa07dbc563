"""A week from raw tables to flags."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame

from tillwatch.functions.columns import add_static_columns
from tillwatch.functions.keys import number_key
from tillwatch.operators import flagging, metrics, prep, quality, reporting, rules
from tillwatch.operators.scale import staged
from tillwatch.params import Params
from tillwatch.session import tune
from tillwatch.sinks.quality_tables import commit_metrics, load_metrics
from tillwatch.sinks.store import Run, Store
from tillwatch.sinks.tables import archive_table, save_table
from tillwatch.sources import extracts
from tillwatch.sources.readers import load_table

ARCHIVED = ("anomalies", "cashier_stats", "org", "flags")

# The quality gates of a weekly run.
DEFAULT_CHECKS: dict[str, list[dict[str, Any]]] = {
    "anomalies": [
        {"type": "distinct_count", "name": "More than 175 stores must have anomalies", "column": "store_nr", "min_threshold": 175, "on_failure": "fail"},
    ],
    "flags": [
        {"type": "distinct_count", "name": "More than 160 stores must have flags", "column": "store_nr", "min_threshold": 160, "on_failure": "fail"},
        {"type": "stores_red_flag", "name": "More than 100 stores must have red flags", "column": "store_nr", "min_threshold": 100, "on_failure": "fail"},
        {"type": "kpi_red_flag", "name": "Each KPI must have red flags", "on_failure": "warn"},
        {"type": "kpi_orange_flag", "name": "Each KPI must have orange flags", "exempt": (2, 5), "on_failure": "warn"},
        {"type": "row_count_drift", "on_failure": "warn", "comparison": {"type": "tolerance_percent", "value": 30}},
    ],
}

Tables = Mapping[str, DataFrame]
Keep = Callable[[DataFrame, str], DataFrame]


def extract_week(raw: Tables, p: Params, originals: DataFrame | None = None) -> dict[str, DataFrame]:
    """The extracts of a run; ``originals`` are the ``originals_found``, if they have been saved."""
    return {name: build() for name, build in extractors(raw, p, originals).items()}


def extractors(raw: Tables, p: Params, originals: DataFrame | None = None) -> dict[str, Callable[[], DataFrame]]:
    """How each extract is built; a raw table is looked up when an extract that reads it is."""

    def of(build: Callable[..., DataFrame], *tables: str) -> Callable[[], DataFrame]:
        return lambda: build(*[raw[name] for name in tables], p)

    def unreferenced(*args) -> DataFrame:
        return extracts.returns_without_original(*args, originals)

    return {
        "headers": of(extracts.receipt_headers, "receipt_header", "location"),
        "lines": of(extracts.receipt_lines, "receipt_line", "location"),
        "subtotals": of(extracts.subtotal_lines, "subtotal_line", "location"),
        "cash": of(extracts.cash_only_receipts, "payment", "location"),
        "returns": of(extracts.return_receipts, "receipt_header", "receipt_line", "location"),
        "unreferenced": of(unreferenced, "receipt_header", "receipt_line", "location"),
        "hours": of(extracts.opening_hours, "store_hours"),
        "org": of(extracts.store_org, "org_structure"),
    }


def prepare_week(x: Tables, p: Params) -> dict[str, DataFrame]:
    """What stage 1 makes of the extracts."""
    return {name: build() for name, build in preparers(x, p).items()}


def preparers(x: Tables, p: Params) -> dict[str, Callable[[], DataFrame]]:
    """How each prepared table is built; an extract is looked up when a table that reads it is."""
    return {
        "cashier_stats": lambda: prep.cashier_stats(x["headers"]),
        "outside": lambda: prep.receipts_outside_hours(x["headers"], x["hours"], p),
        "voided": lambda: prep.voided_cash_receipts(x["lines"], x["headers"], x["cash"], p),
    }


def week_metrics(x: Tables, p: Params) -> dict[int, DataFrame]:
    """The ten metrics of extracts and prepared tables, in common form."""
    found = {
        1: metrics.m01(x["outside"]),
        2: metrics.m02(x["outside"]),
        3: metrics.m03(x["voided"]),
        4: metrics.m04(x["voided"]),
        5: metrics.m05(x["lines"], x["subtotals"], x["cash"], p),
        6: metrics.m06(x["lines"], x["headers"], x["cash"], p),
        7: metrics.m07(x["returns"], p),
        8: metrics.m08(x["returns"]),
        9: metrics.m09(x["unreferenced"]),
        10: metrics.m10(x["headers"], x["cash"], p),
    }
    return {kpi_id: metrics.as_metric(df) for kpi_id, df in found.items()}


def week_anomalies(
    raw: Tables, x: Tables, p: Params, originals: DataFrame | None = None, keep: Keep | None = None
) -> DataFrame:
    """The ten metrics merged, each source evaluated once; the same as merging ``week_metrics``.

    A plan that may write tables says how as ``keep``: the facts of each receipt, and the few rows that are looked up once
    more, are then written once, and most lines are shuffled only as part of these facts.
    """
    header, line, subtotal, payment, location = (raw[name] for name in ("receipt_header", "receipt_line", "subtotal_line", "payment", "location"))
    if keep is None:
        found = extracts.originals_found(line, location, p) if originals is None else originals
        return rules.merge_rules(
            [
                rules.header_rules(x["headers"], x["hours"], x["lines"], x["cash"], p),
                rules.return_rules(extracts.returned_articles(header, line, location, p), found, p),
                *rules.line_rules(x["lines"], x["subtotals"], x["headers"], x["cash"], p),
            ]
        )
    headers = extracts.priced_headers(header, location, p, number_key)
    lines = extracts.receipt_lines(line, location, p, number_key, anywhere=True)
    payments = extracts.payments(payment, location, p, number_key, anywhere=True)

    def subtotals(wanted: DataFrame) -> DataFrame:
        return extracts.subtotals_of(subtotal, location, p, wanted)

    with ThreadPoolExecutor(3) as writers:
        kept_facts = writers.submit(keep, rules.receipt_facts(lines, payments), "receipt_facts")
        kept_returns = writers.submit(keep, extracts.named_returns(line, location, p, anywhere=True), "named_returns")
        ordered = writers.submit(rules.next_keys, headers)
        facts, returns, following = kept_facts.result(), kept_returns.result(), ordered.result()
    found = extracts.originals_found(line, location, p, returns) if originals is None else originals
    missing = rules.unreferenced(returns, found, p)
    return rules.merge_rules(rules.fact_rules(headers, x["hours"], lines, subtotals, facts, following, missing, p, keep))


def run_week(
    raw: Tables,
    p: Params,
    store: Store | None = None,
    run: Run | None = None,
    checks: Mapping[str, Sequence[Mapping[str, Any]]] = DEFAULT_CHECKS,
) -> dict[str, DataFrame]:
    """Everything a week produces, by name.

    Tables that several steps use are written once, independent ones at the same time: to
    the working zone of ``store`` or, without one, to the session's shared folder. ``checks`` gate the
    tables ({} for none). With a store and a run the results are archived, the week of the run is noted in the small
    table ``runs``, and drift metrics are committed; ``report_week`` goes on from there.
    """
    spark = tune(raw["receipt_header"].sparkSession)

    def keep(df: DataFrame, name: str) -> DataFrame:
        if store is None:
            return staged(df, name)
        save_table(df, store, name)
        return load_table(spark, store, name, required=True)

    def gate(df: DataFrame, name: str) -> None:
        specs = checks.get(name)
        if specs:
            known = load_metrics(spark, store) if store is not None else None
            quality.run_checks(df, name, specs, known, run, store)

    def keep_all(tables: Tables) -> dict[str, DataFrame]:
        with ThreadPoolExecutor(len(tables)) as writers:
            return dict(zip(tables, writers.map(keep, tables.values(), tables)))

    originals = keep(extracts.originals_found(raw["receipt_line"], raw["location"], p), "originals_found")
    out = extract_week(raw, p, originals)
    out |= keep_all({name: out[name] for name in ("headers", "org")})
    out |= prepare_week(out, p)
    out["cashier_stats"] = keep(out["cashier_stats"], "cashier_stats")
    out["anomalies"] = keep(week_anomalies(raw, out, p, originals, keep), "anomalies")
    gate(out["anomalies"], "anomalies")
    out["flags"] = keep(flagging.flag_cashiers(out["anomalies"], out["cashier_stats"], out["org"], p, keep), "flags")
    gate(out["flags"], "flags")
    if store is not None and run is not None:
        for name in ARCHIVED:
            archive_table(out[name], store, name, run)
        week = reporting.run_weeks(*(add_static_columns(out[name], {"run_id": run.run_id}) for name in ("anomalies", "flags")))
        archive_table(week.drop("run_id"), store, "runs", run)
        commit_metrics(spark, store, run.run_id)
    return out
