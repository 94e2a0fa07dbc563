"""One query per operator, on the cash-register view of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import cached_property, partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch import model
from tillwatch.functions import calendar, columns, keys
from tillwatch.operators import export, flagging, metrics, prep, quality, reporting
from tillwatch.operators.scale import shared_folder, staged
from tillwatch.params import DEFAULT_RULES, Params
from tillwatch.plans.report import basis_builders, report_week
from tillwatch.plans.week import extractors, preparers, run_week, week_anomalies
from tillwatch.projection import raw_tables
from tillwatch.session import tune
from tillwatch.sinks import quality_tables, tables, warehouse
from tillwatch.sinks.files import digests
from tillwatch.sinks.store import Run, Store
from tillwatch.sources import extracts, readers

ABSOLUTE = {1: 60, 2: 8, 4: 12, 5: 2, 7: 3}
PARAMS = Params(
    client_id=4,
    start_date="2025-01-06",
    end_date="2025-01-19",
    store_max=1_000_000_000,  # every store of the input, however large it is
    rules={k: replace(r, absolute=ABSOLUTE.get(k)) for k, r in DEFAULT_RULES.items()},
    avg_red_flags_per_store=2.5,
    num_flags_per_store=3,
)
FIRST_WEEK = "2025-02"
RUNS = {"2025-02": "20250113000000", "2025-03": "20250120000000"}


class Built(Mapping):
    """Tables by name, each built when first asked for and kept."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]) -> None:
        self.builders, self._built = dict(builders), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self.builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.builders)

    def __len__(self) -> int:
        return len(self.builders)


class Week:
    """The tables of a run and of its report, each built when first asked for.

    The raw cash-register tables are derived from the given ones and each written once per
    session and input, when a query first reads it, so that queries scan files as they would in production. The
    same holds for anomalies and flags, which a run saves and its report reads back.
    """

    _known: dict[tuple[str, str], "Week"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir, self.p = tune(spark), sf_dir, PARAMS
        raw = raw_tables(spark, sf_dir)
        self.raw = Built({name: partial(staged, df, name) for name, df in raw.items()})
        self.x = Built(extractors(self.raw, self.p))
        self.x.builders |= preparers(self.x, self.p)

    def raw_written(self, *names: str) -> Mapping[str, DataFrame]:
        """The raw tables, of which the named ones (all, if none is) are there; those that are not yet are written at the same time."""
        names = names or tuple(self.raw)
        with ThreadPoolExecutor(len(names)) as writers:
            list(writers.map(self.raw.__getitem__, names))
        return self.raw

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Week":
        """The session's tables of an input, all raw ones written."""
        week = cls.lazy(spark, sf_dir)
        week.raw_written()
        return week

    @classmethod
    def lazy(cls, spark: SparkSession, sf_dir: str) -> "Week":
        """The session's tables of an input; a raw one is written when it is first read."""
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._known:
            cls._known[key] = cls(spark, sf_dir)
        return cls._known[key]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def store(self) -> Store:
        """A fresh store in the shared folder."""
        tag = uuid.uuid4().hex
        folder = f"{shared_folder(self.spark)}/store-{tag}"
        self.spark.sql(f"CREATE SCHEMA tillwatch_{tag} LOCATION '{folder}/quality'")
        return Store(f"{folder}/working", f"{folder}/historical", f"tillwatch_{tag}")

    def merged(self, keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
        """The anomalies from the raw tables, computed anew; ``keep`` is how tables that several steps read are written once."""
        read = [name for name in self.raw if name != "org_structure"]
        return week_anomalies(self.raw_written(*read), self.x, self.p, keep=keep)

    @cached_property
    def anomalies(self) -> DataFrame:
        return staged(self.merged(staged), "anomalies")

    @cached_property
    def flags(self) -> DataFrame:
        return staged(flagging.flag_cashiers(self.anomalies, self.x["cashier_stats"], self.x["org"], self.p, staged), "flags")

    # -- flagging, step by step

    @cached_property
    def counts(self) -> DataFrame:
        return flagging.kpi_counts(self.anomalies)

    @cached_property
    def active(self) -> DataFrame:
        return flagging.with_activity(self.counts, self.x["cashier_stats"])

    @cached_property
    def base(self) -> DataFrame:
        return staged(flagging.normalise(flagging.eligible(self.active, self.p), self.p), "cashier_kpis")

    # these write ranges when they are built, so every query builds them anew

    @property
    def limits(self) -> DataFrame:
        return flagging.thresholds(self.base, self.p)

    @property
    def levels(self) -> DataFrame:
        return flagging.levels(self.base, self.x["org"], self.p)

    # -- report

    def _with_run(self, df: DataFrame, week) -> DataFrame:
        run = columns.lookup(week, RUNS, "string")
        return df.withColumns({"run_id": run, "run_timestamp": run})

    @cached_property
    def past_details(self) -> DataFrame:
        return self._with_run(self.anomalies, calendar.iso_week("receipt_date"))

    @cached_property
    def past_flags(self) -> DataFrame:
        return self._with_run(self.flags, F.col("iso_week"))

    @cached_property
    def past_org(self) -> DataFrame:
        runs = F.explode(F.array(*[F.lit(r) for r in RUNS.values()]))
        return self.x["org"].withColumn("run_id", runs).withColumn("run_timestamp", F.col("run_id"))

    @cached_property
    def report(self) -> Built:
        report = Built({"org": lambda: self.past_org, "details": lambda: self.past_details, "flags": lambda: self.past_flags})
        report.builders |= basis_builders(report, self.p, staged)
        return report

    run_weeks = property(lambda self: self.report["run_weeks"])
    weeks = property(lambda self: self.report["weeks"])
    regions = property(lambda self: self.report["regions"])
    found = property(lambda self: self.report["found"])
    flagged = property(lambda self: self.report["flagged"])
    dense = property(lambda self: self.report["dense"])

    def past_by_week(self) -> list[DataFrame]:
        return [self.report[f"by_week_{name}"] for name in ("org", "details", "flags")]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Week], DataFrame]) -> Callable[[Week], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Week.lazy(spark, sf_dir))
    return build


# -- sources ------------------------------------------------------------------


@query
def a01_receipt_key(w):
    return w.raw["receipt_line"].select("receipt_id", "receiptline_nr", keys.receipt_key().alias("transaction_id"))


@query
def a02_in_scope(w):
    p = w.p.with_(end_date="2025-01-12")
    located = w.raw["receipt_header"].join(w.raw["location"], "loc_sid")
    return keys.in_scope(located, p).select("receipt_id", "store_nr", "receipt_date")


@query
def a03_receipt_headers(w):
    return w.x["headers"]


@query
def a04_receipt_lines(w):
    return w.x["lines"]


@query
def a05_subtotal_lines(w):
    return w.x["subtotals"]


@query
def a06_cash_only_receipts(w):
    return w.x["cash"]


@query
def a07_return_receipts(w):
    return w.x["returns"]


@query
def a08_returns_without_original(w):
    return w.x["unreferenced"]


@query
def a09_opening_hours(w):
    return w.x["hours"]


@query
def a10_store_org(w):
    return w.x["org"]


@query
def a12_lower_columns(w):
    upper = w.table("orders")
    return readers.lower_columns(upper.toDF(*[c.upper() for c in upper.columns]))


@query
def a13_cast_columns(w):
    text = w.table("orders").select(
        F.col("o_orderkey").cast("string").alias("O_ORDERKEY"),
        F.col("o_custkey").cast("string").alias("O_CUSTKEY"),
        (F.col("o_orderkey") % 2).cast("string").alias("O_ODD"),
        "o_orderstatus",
    )
    return readers.cast_columns(text, {"bigint_columns": ["o_orderkey"], "int_columns": ["O_CUSTKEY"], "boolean_columns": ["o_odd"]})


@query
def a14_read_path(w):
    return readers.read_path(w.spark, f"{w.sf_dir}/orders.parquet", prefixes=[w.sf_dir]).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query
def a15_read_csv(w):
    path = f"{shared_folder(w.spark)}/csv-{uuid.uuid4().hex}"
    rows = w.table("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    rows.write.csv(path, header=True)
    return readers.read_csv(w.spark, path, rows.schema)


@query
def a16_load_table(w):
    store = w.store()
    tables.save_table(w.x["hours"], store, "hours")
    assert readers.load_table(w.spark, store, "nothing") is None
    return readers.load_table(w.spark, store, "hours", required=True)


# -- sinks --------------------------------------------------------------------


@query
def b01_save_table(w):
    store = w.store()
    tables.save_table(w.x["cash"], store, "headers")
    tables.save_table(w.x["headers"], store, "headers")
    return readers.load_table(w.spark, store, "headers", required=True)


@query
def b02_archive_table(w):
    store = w.store()
    for week, run_id in RUNS.items():
        of_week = w.x["headers"].filter(calendar.iso_week("receipt_date") == week)
        tables.archive_table(of_week.select("transaction_id", "store_nr"), store, "headers", Run(run_id, run_id))
    return tables.history(w.spark, store, "headers").select("run_id", "run_timestamp", "transaction_id", "store_nr")


@query
def b03_align_schema(w):
    text = w.raw["receipt_header"].select(
        *[F.col(c).cast("string").alias(c.upper()) for c in model.RECEIPT_HEADER.names], F.lit("new").alias("EXTRA")
    )
    return tables.align_schema(text, model.RECEIPT_HEADER)


@query
def b04_write_external(w):
    path = f"{shared_folder(w.spark)}/external-{uuid.uuid4().hex}"
    warehouse.register(w.spark)
    tables.write_external(w.x["org"].limit(0), "warehouse", {"path": path}, "org")  # replaced by the next
    tables.write_external(w.x["org"], "warehouse", {"path": path}, "org")
    return w.spark.read.format("warehouse").options(path=path, dbtable="org").load()


def _warehouse(w, name: str) -> dict[str, str]:
    """An extract as a table behind the data source."""
    warehouse.register(w.spark)
    options = {"path": f"{shared_folder(w.spark)}/external-{uuid.uuid4().hex}"}
    rows = w.x[name].withColumn("receipt_ts", F.col("receipt_ts").cast("string"))
    tables.write_external(rows, "warehouse", options | {"groupRows": "5000", "fileRows": "20000"}, name)
    return options | {"splitBytes": "200000"}


@query
def a11_read_query(w):
    text = """SELECT store_nr AS STORE_NR, transaction_type_cd, count(*) AS RECEIPTS, min(receipt_id) AS first_receipt, max(receipt_ts) AS last_ts
        FROM {headers} WHERE receipt_date >= DATE'2025-01-13' AND store_nr < 110 AND transaction_type_cd IN (100, 150) GROUP BY ALL"""
    return readers.read_query(w.spark, "warehouse", _warehouse(w, "headers"), text, tables=["headers"])


def _daily_metrics(w) -> list[dict]:
    """Receipts per day as drift metrics, one run per day: 14 rows whatever the input."""
    daily = w.x["headers"].groupBy(F.date_format("receipt_date", "yyyyMMdd").alias("run_id")).count()
    return [
        {
            "run_id": row["run_id"],
            "data_name": "headers",
            "metric_id": "row_count_drift",
            "metric_value": float(row["count"]),
            "run_timestamp": row["run_id"],
        }
        for row in daily.collect()
    ]


@query
def b05_stage_metrics(w):
    store = w.store()
    quality_tables.stage_metrics(w.spark, _daily_metrics(w), store)
    return readers.load_table(w.spark, store, quality_tables.STAGING, "quality", required=True)


@query
def b06_commit_metrics(w):
    store = w.store()
    quality_tables.stage_metrics(w.spark, _daily_metrics(w), store)
    for run_id in ("20250106", "20250110"):
        quality_tables.commit_metrics(w.spark, store, run_id)
    staging = readers.load_table(w.spark, store, quality_tables.STAGING, "quality", required=True)
    kept = quality_tables.load_metrics(w.spark, store).withColumn("place", F.lit("permanent"))
    return kept.unionByName(staging.withColumn("place", F.lit("staging")))


def _logged(w) -> Store:
    store = w.store()
    for table in ("headers", "lines"):
        results = quality.unique(w.x[table], "transaction_id", on_failure="warn")
        quality_tables.log_checks(results, Run(f"run-{table}", "2025-01-20"), table, store)
    return store


@query
def b07_log_checks(w):
    return quality_tables.load_checks(w.spark, _logged(w))


@query
def b08_load_checks(w):
    return quality_tables.load_checks(w.spark, _logged(w), "run-lines")


# -- preparation --------------------------------------------------------------


@query
def c01_cashier_stats(w):
    return w.x["cashier_stats"]


@query
def c02_opening_timestamps(w):
    return prep.opening_timestamps(w.x["hours"])


@query
def c03_receipts_outside_hours(w):
    return w.x["outside"]


@query
def c04_cash_sales(w):
    return prep.cash_sales(w.x["headers"], w.x["cash"], w.p)


@query
def c05_voided_cash_receipts(w):
    return w.x["voided"]


# -- metrics ------------------------------------------------------------------


@query
def d00_as_metric(w):
    return metrics.as_metric(w.x["returns"])


@query
def d01_m01(w):
    return metrics.as_metric(metrics.m01(w.x["outside"]))


@query
def d02_m02(w):
    return metrics.as_metric(metrics.m02(w.x["outside"]))


@query
def d03_m03(w):
    return metrics.as_metric(metrics.m03(w.x["voided"]))


@query
def d04_m04(w):
    return metrics.as_metric(metrics.m04(w.x["voided"]))


@query
def d05a_nth_last_subtotal(w):
    return metrics.nth_last_subtotal(w.x["subtotals"], w.x["cash"], w.p)


@query
def d05_m05(w):
    return metrics.as_metric(metrics.m05(w.x["lines"], w.x["subtotals"], w.x["cash"], w.p))


@query
def d06a_next_receipt(w):
    return metrics.next_receipt(w.x["headers"])


@query
def d06b_sold_articles(w):
    return metrics.sold_articles(w.x["lines"])


@query
def d06_m06(w):
    return metrics.as_metric(metrics.m06(w.x["lines"], w.x["headers"], w.x["cash"], w.p))


@query
def d07_m07(w):
    return metrics.as_metric(metrics.m07(w.x["returns"], w.p))


@query
def d08_m08(w):
    return metrics.as_metric(metrics.m08(w.x["returns"]))


@query
def d09_m09(w):
    return metrics.as_metric(metrics.m09(w.x["unreferenced"]))


@query
def d10_m10(w):
    return metrics.as_metric(metrics.m10(w.x["headers"], w.x["cash"], w.p))


# -- flagging -----------------------------------------------------------------


@query
def e01_merge_anomalies(w):
    return w.merged(staged)


@query
def e02_kpi_counts(w):
    return w.counts


@query
def e03_with_activity(w):
    return w.active


@query
def e04_eligible(w):
    return flagging.eligible(w.active, w.p)


@query
def e05_normalise(w):
    return w.base


@query
def e06_thresholds(w):
    return w.limits


@query
def e07_robust(w):
    return flagging.robust(w.limits, w.p.with_(min_population=100))


@query
def e08_absolute_flags(w):
    return flagging.absolute_flags(flagging.eligible(w.active, w.p), w.p)


@query
def e09_region_quota(w):
    return flagging.region_quota(w.x["org"], w.p)


@query
def e10_initial_level(w):
    return w.levels.select("iso_week", "store_nr", "cashier_id", "kpi_id", "level")


@query
def e11_rank_flags(w):
    return flagging.rank_flags(staged(w.levels, "levels")).select(
        "iso_week", "store_nr", "cashier_id", "kpi_id", "region_rank", "store_rank"
    )


@query
def e12_final_flags(w):
    return flagging.final_flags(flagging.rank_flags(staged(w.levels, "levels")), w.p.with_(orange_requires_level=True))


@query
def e13_flag_cashiers(w):
    return flagging.flag_cashiers(w.merged(staged), w.x["cashier_stats"], w.x["org"], w.p, staged)


@query
def week_flags(w):
    """The whole run, with every table that several steps read written once."""
    return run_week(w.raw_written(), w.p, checks={})["flags"]


# -- quality ------------------------------------------------------------------


def _together(*results: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


@query
def f01_not_null(w):
    return _together(
        quality.not_null(w.x["lines"], "void_fg", "void"),
        quality.not_null(w.x["lines"], "transaction_id", "key"),
    )


@query
def f02_unique(w):
    return _together(
        quality.unique(w.x["headers"], "transaction_id", "receipts"),
        quality.unique(w.x["lines"], ["transaction_id", "item_sid"], "articles", "warn"),
    )


@query
def f03_distinct_count(w):
    return _together(
        quality.distinct_count(w.anomalies, "store_nr", 15, "stores"),
        quality.distinct_count(w.x["lines"], "void_fg", 3, "void", "warn"),
    )


def _by_week(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    first = calendar.iso_week("receipt_date") == FIRST_WEEK
    return df.filter(first), df.filter(~first)


@query
def f04_row_count_drift(w):
    before, now = _by_week(w.anomalies)
    rows = float(before.count())
    return _together(
        quality.row_count_drift(now, rows, 30, "usual"),
        quality.row_count_drift(now, rows / 2, 30, "doubled", "warn"),
        quality.row_count_drift(now, None, 30, "first run"),
    ).drop("message")  # engines print numbers with fractions differently


@query
def f05_avg_drift(w):
    before, now = _by_week(w.x["headers"])
    mean = before.agg(F.avg("cnt_receiptlines_sales")).first()[0]
    empty = now.withColumn("cnt_receiptlines_sales", F.lit(None).cast("int"))
    return _together(
        quality.avg_drift(now, "cnt_receiptlines_sales", mean, 10, "usual"),
        quality.avg_drift(now, "cnt_receiptlines_sales", mean * 2, 10, "halved"),
        quality.avg_drift(empty, "cnt_receiptlines_sales", mean, 10, "empty"),
    ).drop("message")


@query
def f06_run_checks(w):
    suite = [
        {"type": "not_null", "column": "transaction_id"},
        {"type": "not_null", "column": "void_fg", "name": "void", "on_failure": "warn"},
        {"type": "distinct_count", "column": "item_sid", "min_threshold": 5},
        {"type": "unique", "columns": ["transaction_id", "receiptline_nr"]},
        {"type": "no such check"},
        {"type": "distinct_count", "column": "item_sid"},
        {"type": "row_count_drift", "comparison": {"type": "tolerance_percent", "value": 30}},
    ]
    return quality.check_results(w.x["lines"], suite)


@query
def f07_baselines(w):
    per_day = (
        w.anomalies.groupBy("receipt_date", "kpi_id")
        .agg(F.count("*").cast("double").alias("metric_value"))
        .select(
            F.lit("anomalies").alias("data_name"),
            F.concat(F.lit("row_count_drift:"), F.col("kpi_id").cast("string")).alias("metric_id"),
            "metric_value",
        )
    )
    return quality.baselines(per_day, "anomalies", [f"row_count_drift:{k}" for k in (1, 3, 8)])


@query
def f08_stores_red_flag(w):
    return _together(
        quality.stores_red_flag(w.flags, "store_nr", 5, "few"),
        quality.stores_red_flag(w.flags, "store_nr", 1_000_000, "many", "warn"),
    )


@query
def f09_kpi_red_flag(w):
    return _together(quality.kpi_red_flag(w.flags), quality.kpi_red_flag(w.flags.filter("flag = 1"), "orange only", "warn"))


@query
def f10_kpi_orange_flag(w):
    return _together(
        quality.kpi_orange_flag(w.flags, (2, 5)), quality.kpi_orange_flag(w.flags.filter("flag = 2"), (2, 5), "red only")
    )


# -- reporting ----------------------------------------------------------------


@query
def g01_with_history(w):
    before, now = _by_week(w.past_details)
    run = RUNS["2025-03"]
    return reporting.with_history(now.drop("run_id", "run_timestamp"), before, Run(run, run))


@query
def g02_run_weeks(w):
    return w.run_weeks


def _daily_details(w) -> DataFrame:
    """Details whose run is the weekday, so runs and weeks cross."""
    return w.anomalies.withColumn("run_id", F.weekday("receipt_date").cast("string"))


@query
def g03_inconsistent_runs(w):
    return reporting.inconsistent_runs(_daily_details(w), w.flags.withColumn("run_id", (F.col("kpi_id") % 2).cast("string")))


@query
def g03_inconsistent_weeks(w):
    return reporting.inconsistent_weeks(_daily_details(w).withColumn("iso_week", calendar.iso_week("receipt_date")))


@query
def g04_attach_week(w):
    return reporting.attach_week(w.past_flags, w.run_weeks)


@query
def g05_common_weeks(w):
    return reporting.common_weeks(*w.past_by_week(), 1)


@query
def g06_store_regions(w):
    return w.regions


@query
def g07_anomalies_with_region(w):
    return reporting.anomalies_with_region(w.report["by_week_details"], w.regions)


@query
def g08_flags_with_region(w):
    return w.flagged.select("iso_week", "store_nr", "cashier_id", "kpi_id", "flag", "region_manager")


@query
def g09_dense_flag_counts(w):
    return reporting.dense_flag_counts(w.flagged, w.regions)


@query
def g10_flag_counts(w):
    parts = []
    for level in ("region_manager", "store_nr"):
        counts = reporting.flag_counts(w.dense, level)
        parts.append(counts.withColumn("level", F.lit(level)).withColumnRenamed(level, "member").withColumn("member", F.col("member").cast("string")))
    return parts[0].unionByName(parts[1])


@query
def g11_add_total_rows(w):
    return reporting.add_total_rows(w.dense, ["iso_week", "region_manager", "store_nr", "flag"])


@query
def g12_flag_stats(w):
    weeks = [w.dense.filter(F.col("iso_week") == week) for week in RUNS]
    parts = [reporting.flag_stats(part.drop("iso_week"), weekly=False).withColumn("iso_week", F.lit(week)) for part, week in zip(weeks, RUNS)]
    return reduce(DataFrame.unionByName, parts)


@query
def g13_total_flag_stats(w):
    return reporting.total_flag_stats(w.dense)


@query
def g14_weekly_flag_stats(w):
    return reporting.weekly_flag_stats(w.dense)


@query
def g15_anomalous_receipts_per_week(w):
    return reporting.anomalous_receipts_per_week(w.found)


@query
def g16_anomalies_per_week(w):
    per_kpi = reporting.anomalies_per_week(w.found)
    return per_kpi.unionByName(reporting.anomalies_per_week(w.found, per_kpi=False), allowMissingColumns=True)


@query
def g17_anomalies_per_store(w):
    return reporting.anomalies_per_store(w.found)


@query
def g18_anomaly_overview(w):
    return reporting.anomaly_overview(w.found)


@query
def g19_flag_distribution(w):
    return reporting.flag_distribution(reporting.total_flag_stats(w.dense))


@query
def g20_melt_stats(w):
    return reporting.melt_stats(reporting.total_flag_stats(w.dense))


@query
def g21_weekly_trend(w):
    return reporting.weekly_trend(w.found)


@query
def g22_flag_histogram(w):
    parts = [
        reporting.flag_histogram(reporting.flag_counts(w.dense, level), last).withColumns(
            {"level": F.lit(level), "last_only": F.lit(last)}
        )
        for level in ("region_manager", "store_nr")
        for last in (False, True)
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def g23_box_summary(w):
    return reporting.box_summary(reporting.anomalies_per_store(w.found), "iso_week", "anomalies")


@query
def g24_headline(w):
    return reporting.headline(w.found, w.flagged)


@query
def g25_anomaly_totals(w):
    return reporting.anomaly_totals(w.found)


# -- export -------------------------------------------------------------------


@query
def h01_evidence(w):
    named = w.anomalies.withColumn("kpi_name", columns.kpi_name(F.col("kpi_id"))).drop("kpi_id")
    return export.evidence(named)


@query
def h02_flagged_evidence(w):
    return export.flagged_evidence(w.flags, export.evidence(w.anomalies))


def _entries(docs: DataFrame) -> DataFrame:
    """Documents flattened: one row per flagged cashier and per receipt."""
    per_store = docs.select("year", "weeknumber", F.inline("evaluation"))
    per_kpi = per_store.select("year", "weeknumber", "StoreID", F.inline("KPI"))
    keys_ = ["year", "weeknumber", "StoreID", "KPITypeID"]
    anomalies = per_kpi.select(*keys_, F.inline("Anomalies"))
    receipts = per_kpi.select(*keys_, F.inline("Receipts"))
    return anomalies.unionByName(receipts, allowMissingColumns=True)


@query
def h03_weekly_documents(w):
    return _entries(export.weekly_documents(w.flags, w.anomalies, "day"))


@query
def h04_write_documents(w):
    path = f"{shared_folder(w.spark)}/documents-{uuid.uuid4().hex}"
    export.write_named_documents(w.flags, w.anomalies, path, indent=4)
    return _entries(_read_documents(w, path))


@query
def h04_document_files(w):
    """The files byte by byte."""
    path = f"{shared_folder(w.spark)}/documents-{uuid.uuid4().hex}"
    export.write_named_documents(w.flags, w.anomalies, path)
    files = w.spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path).select(F.substring_index("path", "/", -1).alias("document"))
    return files.mapInArrow(partial(digests, path), "document string, n_bytes long, sha256 string")


@query
def h04_document_parts(w):
    """Documents of every grain as records in folders, read back."""
    found = []
    for grain in export.GRAINS:
        path = f"{shared_folder(w.spark)}/documents-{uuid.uuid4().hex}"
        export.write_documents(export.weekly_documents(w.flags, w.anomalies, grain), path)
        records = w.spark.read.text(path).select(F.from_json("value", DOCUMENT).alias("doc")).select("doc.*")
        found.append(_entries(records).withColumn("grain", F.lit(grain)))
    return reduce(DataFrame.unionByName, found)


DOCUMENT = (
    "year int, weeknumber int, evaluation array<struct<StoreID: string, KPI: array<struct<KPITypeID: int, "
    "Anomalies: array<struct<ServicerID: int, AnomalyGrade: int>>, "
    "Receipts: array<struct<OccurrenceDateTime: string, TillNr: int, ServicerID: int, ReceiptNr: string>>>>>>"
)


def _read_documents(w, path: str) -> DataFrame:
    texts = w.spark.read.text(path, wholetext=True, pathGlobFilter="dbp_*.json")
    return texts.select(F.from_json("value", DOCUMENT).alias("doc")).select("doc.*")


def _reported(w) -> tuple[dict[str, DataFrame], str]:
    """Two weekly runs with a store of their own, the report over both and the folder of their documents."""
    store, raw = w.store(), w.raw_written()
    for run_id, (start, end) in zip(RUNS.values(), (("2025-01-06", "2025-01-12"), ("2025-01-13", "2025-01-19"))):
        run_week(raw, w.p.with_(start_date=start, end_date=end), store, Run(run_id, run_id), checks={})
    path = f"{shared_folder(w.spark)}/documents-{uuid.uuid4().hex}"
    return report_week(w.spark, store, w.p, path), path


@query
def week_report(w):
    return _reported(w)[0]["headline"]


@query
def week_documents(w):
    return _entries(_read_documents(w, _reported(w)[1]))


# -- calendar and columns -----------------------------------------------------


def _dates(w) -> DataFrame:
    return w.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))


@query
def i01_iso_week(w):
    return _dates(w).select("o_orderkey", calendar.iso_week("day").alias("week"))


@query
def i02_calendar_year_week(w):
    return _dates(w).select("o_orderkey", calendar.calendar_year_week("day").alias("week"))


@query
def i03_iso_weeks_between(w):
    weeks = calendar.iso_weeks_between(F.col("day"), F.date_add("day", (F.col("o_orderkey") % 40).cast("int")))
    return _dates(w).select("o_orderkey", F.concat_ws(",", weeks).alias("weeks"))


@query
def i04_ranges(w):
    later = F.date_add("day", (F.col("o_orderkey") % 400).cast("int"))
    week = lambda d: F.replace(calendar.iso_week(d), F.lit("-"), F.lit(""))
    month = lambda d: F.date_format(d, "yyyy-MM")
    return (
        _dates(w)
        .withColumn("later", later)
        .select(
            "o_orderkey",
            calendar.days_between("day", "later").alias("days"),
            calendar.weeks_between(week(F.col("day")), week(F.col("later"))).alias("weeks"),
            calendar.months_between_incl(month("day"), month("later")).alias("months"),
        )
    )


@query
def i05_week_bounds(w):
    bounds = _dates(w).withColumns({"last": calendar.week_bounds("day"), "fourth": calendar.week_bounds("day", 4)})
    return bounds.select("o_orderkey", "last.monday", "last.sunday", F.col("fourth.monday").alias("fourth_monday"))


@query
def i06_month_bounds(w):
    bounds = _dates(w).withColumns(
        {"month": calendar.month_bounds("day"), "tenth": calendar.nth_day_of_month("day", 10)}
    )
    return bounds.select("o_orderkey", "month.*", "tenth")


@query
def i07_lookback_start(w):
    return _dates(w).select("o_orderkey", calendar.lookback_start("day", 12).alias("start"))


@query
def i08_period_bounds(w):
    kind = F.when(F.col("o_orderkey") % 2 == 0, "GM").otherwise("EZ")
    return _dates(w).withColumn("kind", kind).select(
        "o_orderkey", "kind", calendar.period_bounds("day", F.col("kind")).alias("bounds")
    ).select("o_orderkey", "kind", "bounds.*")


@query
def i09_add_static_columns(w):
    return columns.add_static_columns(_dates(w), {"run_id": "7", "attempt": 1})


@query
def i10_reindex(w):
    counts = w.x["headers"].groupBy("transaction_type_cd").count().withColumnRenamed("count", "receipts")
    return columns.reindex(counts, [100, 150, 200, 300], "transaction_type_cd")


@query
def i11_percent_of_total(w):
    lines = w.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("value"))
    return columns.percent_of_total(lines, "value")


@query
def i12_client_id(w):
    codes = F.array(*[F.lit(c) for c in columns.CLIENT_IDS])
    place = (F.col("c_custkey") % len(columns.CLIENT_IDS)).cast("int")
    code = F.when(F.col("c_custkey") % 2 == 0, F.get(codes, place)).otherwise(F.lower(F.get(codes, place)))
    return w.table("customer").select("c_custkey", code.alias("code"), columns.client_id(code).alias("client_id"))
