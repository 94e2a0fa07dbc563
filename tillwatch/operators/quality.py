"""Data-quality checks.

Each check function returns a one-row DataFrame with the columns of ``RESULT``.
``run_checks`` evaluates all checks that are plain aggregates of the table in a
single pass, all that look for different or repeated keys in another, and the others next to them.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.model import ORANGE, RED
from tillwatch.sinks.quality_tables import log_checks, stage_metrics
from tillwatch.sinks.store import Run, Store

log = logging.getLogger(__name__)

RESULT = ["check_type", "check_name", "status", "message", "metric_value"]
STATUS = ("PASS", "WARN", "FAIL")


class QualityError(Exception):
    """At least one check of a table failed."""


@dataclass(frozen=True)
class Verdict:
    """Outcome of a check as columns over its measured values."""

    passed: Column
    message: Column
    metric: Column
    status: Column | None = None

    def columns(self, kind: str, name: str, on_failure: str) -> dict[str, Column]:
        if on_failure.upper() not in STATUS:
            raise ValueError(f"on_failure must be one of {STATUS}, got {on_failure!r}")
        status = F.when(self.passed, "PASS").otherwise(on_failure.upper()) if self.status is None else self.status
        return {
            "check_type": F.lit(kind),
            "check_name": F.lit(name),
            "status": status,
            "message": self.message,
            "metric_value": self.metric.cast("double"),
        }


@dataclass(frozen=True)
class Scalar:
    """A check over aggregates of the whole table."""

    measures: Callable[[DataFrame], Mapping[str, Column]]
    verdict: Callable[[Callable[[str], Column]], Verdict]


def _text(*parts: Column | str) -> Column:
    pieces = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("NULL")) for p in parts]
    return F.concat(*pieces)


def _number(value: Column) -> Column:
    """A double as text without an exponent, however large it is."""
    digits = value.try_cast("decimal(38,6)").cast("string")
    plain = F.regexp_replace(digits, r"(\.\d+?)0+$", "$1")
    return F.when(F.abs(value) >= 1e7, F.coalesce(plain, value.cast("string"))).otherwise(value.cast("string"))


# -- plain aggregates ---------------------------------------------------------


def _not_null(column: str) -> Scalar:
    def measures(df: DataFrame) -> dict[str, Column]:
        col = F.col(column)
        missing = col.isNull()
        if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
            missing = missing | F.isnan(col)
        return {"missing": F.count_if(missing)}

    def verdict(m: Callable[[str], Column]) -> Verdict:
        return Verdict(m("missing") == 0, _text(f"column '{column}' has ", m("missing"), " empty values"), m("missing"))

    return Scalar(measures, verdict)


def _drift(value: Column, metric_id: str, baseline: float | None, pct: float | None) -> Verdict:
    known = baseline is not None and pct is not None
    if known:
        low, high = baseline * (1 - pct / 100), baseline * (1 + pct / 100)
        inside = value.between(low, high)
        message = _text(f"{metric_id} is ", _number(value), f", expected {low} to {high}")
    else:
        inside = F.lit(True)
        message = _text(f"{metric_id} is ", _number(value), ", nothing to compare with")
    return Verdict(inside, message, value)


def _row_count_drift(baseline: float | None, pct: float | None) -> Scalar:
    def measures(df: DataFrame) -> dict[str, Column]:
        return {"rows": F.count(F.lit(1))}

    return Scalar(measures, lambda m: _drift(m("rows").cast("double"), "row_count_drift", baseline, pct))


def _avg_drift(column: str, baseline: float | None, pct: float | None, on_failure: str) -> Scalar:
    def measures(df: DataFrame) -> dict[str, Column]:
        return {"mean": F.avg(column).cast("double")}

    def verdict(m: Callable[[str], Column]) -> Verdict:
        found = _drift(m("mean"), f"avg_drift:{column}", baseline, pct)
        status = (
            F.when(m("mean").isNull(), "WARN").when(found.passed, "PASS").otherwise(on_failure.upper())
        )
        return Verdict(found.passed, found.message, found.metric, status)

    return Scalar(measures, verdict)


def _evaluate(df: DataFrame, checks: Mapping[int, tuple[str, str, str, Scalar]]) -> DataFrame:
    """One pass over the table for any number of scalar checks, one result row each with its position."""
    measured: dict[str, Column] = {}
    rows = []
    for i, (kind, name, on_failure, check) in checks.items():
        measured.update({f"c{i}_{key}": col for key, col in check.measures(df).items()})
        verdict = check.verdict(lambda key, i=i: F.col(f"c{i}_{key}"))
        fields = {"position": F.lit(i), **verdict.columns(kind, name, on_failure)}
        rows.append(F.struct(*[c.alias(n) for n, c in fields.items()]))
    once = df.agg(*[col.alias(name) for name, col in measured.items()])
    return once.select(F.inline(F.array(*rows)))


def _single(df: DataFrame, kind: str, name: str, on_failure: str, check: Scalar) -> DataFrame:
    return _evaluate(df, {0: (kind, name, on_failure, check)}).select(*RESULT)


def not_null(df: DataFrame, col: str, name: str = "not_null", on_failure: str = "fail") -> DataFrame:
    """No NULL and, in a float column, no NaN."""
    return _single(df, "not_null", name, on_failure, _not_null(col))


def row_count_drift(
    df: DataFrame, baseline: float | None, pct: float | None, name: str = "row_count_drift", on_failure: str = "fail"
) -> DataFrame:
    """Row count within ``pct`` percent of its historical mean; passes without a baseline."""
    return _single(df, "row_count_drift", name, on_failure, _row_count_drift(baseline, pct))


def avg_drift(
    df: DataFrame,
    col: str,
    baseline: float | None,
    pct: float | None,
    name: str = "avg_drift",
    on_failure: str = "fail",
) -> DataFrame:
    """Column mean within ``pct`` percent of its historical mean; a NULL mean warns."""
    return _single(df, "avg_drift", name, on_failure, _avg_drift(col, baseline, pct, on_failure))


# -- checks that group first --------------------------------------------------


def _result(measured: DataFrame, kind: str, name: str, on_failure: str, verdict: Verdict) -> DataFrame:
    return measured.select(*[c.alias(n) for n, c in verdict.columns(kind, name, on_failure).items()])


@dataclass(frozen=True)
class KeyCheck:
    """A check over the different values of some columns together: how many there are, and how many occur more than once."""

    columns: tuple[str, ...]
    verdict: Callable[[Column, Column], Verdict]


def _unique(cols: Sequence[str] | str) -> KeyCheck:
    keys = [cols] if isinstance(cols, str) else list(cols)
    return KeyCheck(tuple(keys), lambda _, repeated: Verdict(repeated == 0, _text(f"key {keys} has ", repeated, " duplicated values"), repeated))


def _distinct_count(column: str, minimum: int) -> KeyCheck:
    text = f" distinct values, {minimum} required"
    return KeyCheck((column,), lambda values, _: Verdict(values >= minimum, _text(f"column '{column}' has ", values, text), values))


def _as_key(df: DataFrame, column: str) -> Column:
    """A column's value as text; equal values have equal texts."""
    col = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        col = F.when(col == 0, F.lit(0.0)).otherwise(col)  # there is a negative zero
    return col.cast("string")


def _evaluate_keys(df: DataFrame, checks: Mapping[int, tuple[str, str, str, KeyCheck]]) -> DataFrame:
    """One pass over the table for any number of key checks, one result row each with its position.

    A row is expanded to one key for each set of columns. Equal keys of a task combine before the
    shuffle, so one that a third of all rows have is one row of each task; what is left is counted per set of columns.
    """
    sets = list(dict.fromkeys(check.columns for *_, check in checks.values()))
    expanded = df.select(
        F.inline(F.array(*[F.struct(F.lit(i).alias("key_set"), F.array(*[_as_key(df, c) for c in columns]).alias("key")) for i, columns in enumerate(sets)]))
    )
    counted = expanded.groupBy("key_set", "key").agg(F.count(F.lit(1)).alias("rows"))
    sums = {f"{name}_{i}": F.count_if((F.col("key_set") == i) & more) for i in range(len(sets)) for name, more in (("values", F.lit(True)), ("repeated", F.col("rows") > 1))}
    once = counted.agg(*[col.alias(name) for name, col in sums.items()])
    rows = []
    for position, (kind, name, on_failure, check) in checks.items():
        i = sets.index(check.columns)
        verdict = check.verdict(F.col(f"values_{i}"), F.col(f"repeated_{i}"))
        fields = {"position": F.lit(position), **verdict.columns(kind, name, on_failure)}
        rows.append(F.struct(*[c.alias(n) for n, c in fields.items()]))
    return once.select(F.inline(F.array(*rows)))


def distinct_count(
    df: DataFrame, col: str, minimum: int, name: str = "distinct_count", on_failure: str = "fail"
) -> DataFrame:
    """At least ``minimum`` different values; NULL counts as one."""
    return _evaluate_keys(df, {0: ("distinct_count", name, on_failure, _distinct_count(col, minimum))}).select(*RESULT)


def unique(df: DataFrame, cols: Sequence[str] | str, name: str = "unique", on_failure: str = "fail") -> DataFrame:
    """No key occurs twice; the metric is the number of keys that do."""
    return _evaluate_keys(df, {0: ("unique", name, on_failure, _unique(cols))}).select(*RESULT)


def _red_by_store(flags: DataFrame, col: str) -> DataFrame:
    return flags.groupBy(F.col(col).alias("store")).agg(F.max((F.col("flag") == RED).cast("int")).alias("red"))


def stores_without_red_flag(flags: DataFrame, col: str) -> DataFrame:
    """Every store of the flags that has no red one."""
    return _red_by_store(flags, col).filter("red = 0 OR red IS NULL").select("store")


def stores_red_flag(
    flags: DataFrame, col: str, minimum: int, name: str = "stores_red_flag", on_failure: str = "fail"
) -> DataFrame:
    """At least ``minimum`` stores with a red flag.

    The metric is the number of such stores or, on failure, how many are missing;
    ``stores_without_red_flag`` lists the others.
    """
    if not isinstance(minimum, int) or minimum < 0:
        raise ValueError("minimum must be a non-negative integer")
    counted = _red_by_store(flags, col).agg(F.count(F.lit(1)).alias("stores"), F.count_if(F.col("red") == 1).alias("red"))
    red, missing = F.col("red"), F.lit(minimum) - F.col("red")
    passed = red >= minimum
    summary = _text(red, " of ", F.col("stores"), f" stores have red flags, {minimum} required")
    return _result(
        counted, "stores_red_flag", name, on_failure, Verdict(passed, summary, F.when(passed, red).otherwise(missing))
    )


def _kpis_without(flags: DataFrame, flag: int, exempt: Sequence[int]) -> DataFrame:
    """Number and list of KPIs that never get the flag; the list is as long as the list of KPIs at most."""
    has_flag = F.coalesce(F.max((F.col("flag") == flag).cast("int")), F.lit(0))
    per_kpi = flags.groupBy("kpi_id").agg(has_flag.alias("has_flag"))
    lacking = per_kpi.filter(F.col("kpi_id").isNotNull() & (F.col("has_flag") == 0))
    if exempt:
        lacking = lacking.filter(~F.col("kpi_id").isin(*exempt))
    kpis = F.array_sort(F.collect_list("kpi_id")).cast("array<string>")
    return lacking.agg(F.count(F.lit(1)).alias("lacking"), F.concat_ws(", ", kpis).alias("kpis"))


def _kpi_flag(kind: str, colour: str, flag: int, flags, exempt, name, on_failure) -> DataFrame:
    found = F.col("lacking")
    message = F.when(found == 0, f"every KPI has {colour} flags").otherwise(
        _text(f"KPIs without {colour} flags: ", F.col("kpis"))
    )
    return _result(_kpis_without(flags, flag, exempt), kind, name, on_failure, Verdict(found == 0, message, found))


def kpi_red_flag(flags: DataFrame, name: str = "kpi_red_flag", on_failure: str = "fail") -> DataFrame:
    """Every KPI present has a red flag."""
    return _kpi_flag("kpi_red_flag", "red", RED, flags, (), name, on_failure)


def kpi_orange_flag(
    flags: DataFrame, exempt: Sequence[int] = (), name: str = "kpi_orange_flag", on_failure: str = "fail"
) -> DataFrame:
    """Every KPI present, but for the exempt ones, has an orange flag."""
    return _kpi_flag("kpi_orange_flag", "orange", ORANGE, flags, exempt, name, on_failure)


# -- suites -------------------------------------------------------------------


def metric_id(spec: Mapping[str, Any]) -> str:
    """Id under which a drift metric is stored, looked up and compared."""
    return f"{spec['type']}:{spec['column']}" if spec.get("column") else str(spec["type"])


def baselines(metrics: DataFrame, table: str, ids: Sequence[str]) -> DataFrame:
    """Historical mean of each metric of a table."""
    return (
        metrics.filter((F.col("data_name") == table) & F.col("metric_id").isin(*ids))
        .groupBy("metric_id")
        .agg(F.avg("metric_value").alias("baseline_value"))
    )


def drift_ids(specs: Sequence[Mapping[str, Any]]) -> list[str]:
    return [metric_id(s) for s in specs if "drift" in str(s.get("type", ""))]


def _tolerance(spec: Mapping[str, Any]) -> float | None:
    comparison = spec.get("comparison") or {}
    return comparison.get("value") if comparison.get("type") == "tolerance_percent" else None


def _scalar(spec: Mapping[str, Any], known: Mapping[str, float]) -> Scalar | None:
    kind = spec["type"]
    if kind == "not_null":
        return _not_null(spec["column"])
    if kind == "row_count_drift":
        return _row_count_drift(known.get(metric_id(spec)), _tolerance(spec))
    if kind == "avg_drift":
        return _avg_drift(spec["column"], known.get(metric_id(spec)), _tolerance(spec), spec.get("on_failure", "fail"))
    return None


def _key_check(spec: Mapping[str, Any]) -> KeyCheck | None:
    if spec["type"] == "unique":
        return _unique(spec["columns"])
    return _distinct_count(spec["column"], spec["min_threshold"]) if spec["type"] == "distinct_count" else None


def _grouped(df: DataFrame, spec: Mapping[str, Any], name: str, on_failure: str) -> DataFrame | None:
    kind = spec["type"]
    if callable(kind):  # a caller's own check: DataFrame and spec in, one result row out
        return kind(df, spec)
    if kind == "stores_red_flag":
        return stores_red_flag(df, spec["column"], spec["min_threshold"], name, on_failure)
    if kind == "kpi_red_flag":
        return kpi_red_flag(df, name, on_failure)
    if kind == "kpi_orange_flag":
        return kpi_orange_flag(df, spec.get("exempt", ()), name, on_failure)
    return None


def check_results(
    df: DataFrame, specs: Sequence[Mapping[str, Any]], known: Mapping[str, float] | None = None
) -> DataFrame:
    """Result rows of a suite in its order; unknown and misconfigured checks are skipped with a warning."""
    scalars: dict[int, tuple[str, str, str, Scalar]] = {}
    keys: dict[int, tuple[str, str, str, KeyCheck]] = {}
    parts = []
    for position, spec in enumerate(specs):
        kind = spec.get("type")
        if not kind:
            log.warning("skipping a check without type: %s", spec)
            continue
        name = spec.get("name", kind if isinstance(kind, str) else kind.__name__)
        on_failure = spec.get("on_failure", "fail")
        try:
            if on_failure.upper() not in STATUS:
                raise ValueError(f"on_failure {on_failure!r}")
            scalar = None if callable(kind) else _scalar(spec, known or {})
            if scalar is not None:
                scalar.measures(df)
                scalars[position] = (kind, name, on_failure, scalar)
                continue
            key_check = None if callable(kind) else _key_check(spec)
            if key_check is not None:
                for column in key_check.columns:
                    df.schema[column]
                keys[position] = (kind, name, on_failure, key_check)
                continue
            rows = _grouped(df, spec, name, on_failure)
        except (KeyError, ValueError) as error:
            log.warning("skipping misconfigured check %r: %r", name, error)
            continue
        if rows is None:
            log.warning("skipping unknown check type %r", kind)
            continue
        parts.append(rows.select(F.lit(position).alias("position"), *RESULT))
    if scalars:
        parts.append(_evaluate(df, scalars))
    if keys:
        parts.append(_evaluate_keys(df, keys))
    if not parts:
        empty = ", ".join(f"{c} {'double' if c == 'metric_value' else 'string'}" for c in RESULT)
        return df.sparkSession.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, parts).orderBy("position").select(*RESULT)


def run_checks(
    df: DataFrame,
    table: str,
    specs: Sequence[Mapping[str, Any]],
    metrics: DataFrame | None = None,
    run: Run | None = None,
    store: Store | None = None,
) -> list:
    """Run a suite, log every result, raise if a check failed, then stage its drift metrics.

    What reaches the driver is one row per check and one baseline per drift check.
    """
    spark, ids = df.sparkSession, drift_ids(specs)
    known = {}
    if metrics is not None and ids:
        known = {r["metric_id"]: r["baseline_value"] for r in baselines(metrics, table, ids).collect()}
    rows = check_results(df, specs, known).collect()
    if rows and store is not None and run is not None:
        schema = "check_type string, check_name string, status string, message string, metric_value double"
        log_checks(spark.createDataFrame(rows, schema), run, table, store)
    failed = [r for r in rows if r["status"] == "FAIL"]
    if failed:
        raise QualityError(
            f"{len(failed)} quality checks failed for {table!r}: "
            + "; ".join(f"{r['check_name']}: {r['message']}" for r in failed)
        )
    warned = sum(r["status"] == "WARN" for r in rows)
    log.info("%d quality checks for %r: %d passed, %d warned", len(rows), table, len(rows) - warned, warned)
    if store is not None and run is not None:
        by_name = {(s["type"], s.get("name", s["type"])): s for s in specs if "drift" in str(s.get("type", ""))}
        drifts = [
            {
                "run_id": run.run_id,
                "data_name": table,
                "metric_id": metric_id(by_name[r["check_type"], r["check_name"]]),
                "metric_value": r["metric_value"],
                "run_timestamp": run.run_timestamp,
            }
            for r in rows
            if (r["check_type"], r["check_name"]) in by_name and r["metric_value"] is not None
        ]
        if drifts:
            stage_metrics(spark, drifts, store)
    return rows
