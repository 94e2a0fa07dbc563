"""Stage 4: report statistics over the look-back weeks.

History tables carry ``run_id``; ``attach_week`` turns that into the week of the
run. Everything after ``dense_flag_counts`` is as small as stores x weeks x KPIs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.functions.calendar import iso_week
from tillwatch.functions.columns import add_static_columns, kpi_label
from tillwatch.model import KPI_IDS, KPI_LABELS, ORANGE, RED, TOTAL
from tillwatch.sinks.store import Run
from tillwatch.sources.readers import lower_columns

# Report labels.
METRIC_PREFIX = "Anzahl Bediener "
COLOURS = {ORANGE: "orange", RED: "rot"}
NATIONWIDE = "Landesweit"
PER_STORE, PER_REGION = "Filiale", "RL"
ALL_ANOMALIES = "# Auffälligkeiten"
ALL_RECEIPTS = "# Bons mit Auffälligkeiten"
HEADLINES = {
    "anomalies": "Anzahl Auffälligkeiten",
    "receipts": "Anzahl auffällige Bons",
    "red": "Anzahl Lupen",
    "orange": "Anzahl Fernglässer",
}

# Flags per KPI aimed at, by colour.
TARGETS = {ORANGE: 130, RED: 56}


# -- history and weeks --------------------------------------------------------


def with_history(current: DataFrame, history: DataFrame | None, run: Run) -> DataFrame:
    """The current rows of a run below the archived ones, columns matched by lower-case name."""
    now = add_static_columns(lower_columns(current), {"run_id": run.run_id, "run_timestamp": run.run_timestamp})
    if history is None:
        return now
    return lower_columns(history).unionByName(now, allowMissingColumns=True)


def _source_weeks(details: DataFrame, flags: DataFrame) -> DataFrame:
    """Weeks seen per run in either source."""
    from_details = details.select("run_id", iso_week("receipt_date").alias("iso_week"))
    return from_details.unionByName(flags.select("run_id", "iso_week"))


def run_weeks(details: DataFrame, flags: DataFrame) -> DataFrame:
    """Week of each run: the earliest in the details or, for a run without details, in the flags.

    Both sources are aggregated together, so the map costs one shuffle.
    """
    week = iso_week("receipt_date")
    none = F.lit(None).cast("string")
    both = details.select("run_id", week.alias("detail_week"), none.alias("flag_week")).unionByName(
        flags.select("run_id", none.alias("detail_week"), F.col("iso_week").alias("flag_week"))
    )
    return both.groupBy("run_id").agg(F.coalesce(F.min("detail_week"), F.min("flag_week")).alias("iso_week"))


def inconsistent_runs(details: DataFrame, flags: DataFrame) -> DataFrame:
    """Runs whose rows fall into more than one week."""
    per_run = _source_weeks(details, flags).groupBy("run_id").agg(F.count_distinct("iso_week").alias("weeks"))
    return per_run.filter("weeks > 1")


def inconsistent_weeks(df: DataFrame) -> DataFrame:
    """Weeks covered by more than one run."""
    return df.groupBy("iso_week").agg(F.count_distinct("run_id").alias("runs")).filter("runs > 1")


def attach_week(df: DataFrame, weeks: DataFrame) -> DataFrame:
    """Replace the week by that of the run; rows of unknown runs drop out.

    The map has one row per archived run, so it is sent to the rows. Spark can't tell its size before it has shuffled the rows
    as well, by run, and then all rows of a run stand in one task.
    """
    return df.drop("iso_week").join(F.broadcast(weeks), "run_id")


def common_weeks(a: DataFrame, b: DataFrame, c: DataFrame, n: int) -> DataFrame:
    """The last ``n`` weeks that all three tables have."""
    weeks = [df.select("iso_week").distinct() for df in (a, b, c)]
    shared = weeks[0].join(weeks[1], "iso_week").join(weeks[2], "iso_week")
    return shared.orderBy(F.col("iso_week").desc()).limit(n)


def in_weeks(df: DataFrame, weeks: DataFrame) -> DataFrame:
    """Rows of the look-back weeks, a list of at most ``n`` entries that is sent to the rows."""
    return df.join(F.broadcast(weeks), "iso_week", "leftsemi")


def store_regions(org: DataFrame) -> DataFrame:
    return org.select("iso_week", "store_nr", "region_manager").distinct()


def anomalies_with_region(details: DataFrame, regions: DataFrame) -> DataFrame:
    columns = ["iso_week", "store_nr", "kpi_id", "cashier_id", "receipt_id"]
    return details.select(*columns).dropDuplicates().join(regions, ["iso_week", "store_nr"])


def flags_with_region(flags: DataFrame, regions: DataFrame) -> DataFrame:
    return flags.join(regions, ["iso_week", "store_nr"])


# -- flag counts and statistics -----------------------------------------------


def dense_flag_counts(flags: DataFrame, regions: DataFrame) -> DataFrame:
    """Flags per week, region, store, KPI and colour, with zeros where there are none.

    The scaffold multiplies each store row with a constant list of 20 pairs; it is no
    join of two tables.
    """
    keys = ["iso_week", "region_manager", "store_nr", "kpi_id", "flag"]
    counts = flags.groupBy(*keys).agg(F.count(F.lit(1)).alias("flag_count"))
    scaffold = regions.withColumn("kpi_id", F.explode(F.array(*[F.lit(k) for k in KPI_IDS]))).withColumn(
        "flag", F.explode(F.array(F.lit(ORANGE), F.lit(RED)))
    )
    return scaffold.join(counts, keys, "left").select(
        *keys, F.coalesce("flag_count", F.lit(0).cast("long")).alias("flag_count")
    )


def flag_counts(dense: DataFrame, level: str) -> DataFrame:
    """Red, orange and all flags per week and region manager or store."""

    def of(flag: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("flag") == flag, F.col("flag_count"))), F.lit(0).cast("long"))

    return (
        dense.filter(F.col(level).isNotNull())
        .groupBy("iso_week", level)
        .agg(of(RED).alias("count_red"), of(ORANGE).alias("count_orange"))
        .withColumn("count_all", F.col("count_red") + F.col("count_orange"))
    )


def add_total_rows(df: DataFrame, keys: Sequence[str], value: str = "flag_count") -> DataFrame:
    """Rows by KPI label, with a grand total over the KPIs for each of ``keys``."""
    labelled = df.select(*keys, kpi_label(F.col("kpi_id")).alias("kpi"), value)
    totals = df.groupBy(*keys).agg(F.sum(value).alias(value))
    return labelled.unionByName(totals.select(*keys, F.lit(TOTAL).alias("kpi"), value))


def flag_stats(counts: DataFrame, weekly: bool, value: str = "flag_count") -> DataFrame:
    """Spread of flags over stores and regions: one row per metric (and week), one column per KPI.

    ``counts`` holds one row per region, store, KPI and colour (and week). The sum and
    the mean, median, maximum and minimum are taken over stores; the latter four also
    over the sums of the regions.
    """
    week = ["iso_week"] if weekly else []
    rows = add_total_rows(counts, [*week, "region_manager", "store_nr", "flag"], value)
    keys = [*week, "kpi", "flag"]

    def spread(over: str) -> list[Column]:
        return [
            F.avg(value).alias(f"⌀ {over}"),
            F.median(value).alias(f"Median {over}"),
            F.max(value).cast("double").alias(f"Max {over}"),
            F.min(value).cast("double").alias(f"Min {over}"),
        ]

    stores = rows.groupBy(*keys).agg(F.sum(value).cast("double").alias(NATIONWIDE), *spread(PER_STORE))
    sums = (
        rows.filter(F.col("region_manager").isNotNull())
        .groupBy(*keys, "region_manager")
        .agg(F.sum(value).alias(value))
    )
    regions = sums.groupBy(*keys).agg(*spread(PER_REGION))
    both = stores.join(regions, keys, "left")
    statistics = [c for c in both.columns if c not in keys]
    colour = F.when(F.col("flag") == ORANGE, COLOURS[ORANGE]).when(F.col("flag") == RED, COLOURS[RED])
    return (
        both.unpivot(keys, statistics, "statistic", "value")
        .withColumn("metric", F.concat(F.lit(METRIC_PREFIX), colour, F.lit(" | "), F.col("statistic")))
        .groupBy("metric", *week)
        .pivot("kpi", [*KPI_LABELS, TOTAL])
        .agg(F.round(F.first("value"), 3))
    )


def total_flag_stats(dense: DataFrame) -> DataFrame:
    """Statistics of each store's mean number of flags per week."""
    keys = ["region_manager", "store_nr", "kpi_id", "flag"]
    means = dense.filter(F.col("region_manager").isNotNull()).groupBy(*keys).agg(F.avg("flag_count").alias("flag_mean"))
    return flag_stats(means, weekly=False, value="flag_mean")


def weekly_flag_stats(dense: DataFrame) -> DataFrame:
    return flag_stats(dense, weekly=True)


# -- anomalies ----------------------------------------------------------------


def _receipt(by_receipt_key: bool) -> Column:
    """A receipt is told apart by its number alone, or by store and number."""
    return F.struct("store_nr", "receipt_id") if by_receipt_key else F.col("receipt_id")


def anomalous_receipts_per_week(anoms: DataFrame, by_receipt_key: bool = False) -> DataFrame:
    return anoms.groupBy("iso_week").agg(F.count_distinct(_receipt(by_receipt_key)).alias("receipts"))


def anomalies_per_week(anoms: DataFrame, per_kpi: bool = True) -> DataFrame:
    keys = ["iso_week", "kpi_id"] if per_kpi else ["iso_week"]
    return anoms.groupBy(*keys).agg(F.count(F.lit(1)).alias("anomalies"))


def anomalies_per_store(anoms: DataFrame) -> DataFrame:
    return anoms.groupBy("iso_week", "store_nr").agg(F.count(F.lit(1)).alias("anomalies"))


def anomaly_overview(anoms: DataFrame, by_receipt_key: bool = False) -> DataFrame:
    """Distinct receipts per KPI and their share of the sum over the KPIs."""
    per_kpi = anoms.groupBy("kpi_id").agg(F.count_distinct(_receipt(by_receipt_key)).alias("receipts"))
    # One row per KPI is left here, so the window without partition sees ten rows.
    share = F.lit(100.0) * F.col("receipts") / F.sum("receipts").over(Window.partitionBy(F.lit(1)))
    return per_kpi.withColumn("share_percent", F.round(share, 2))


def anomaly_totals(anoms: DataFrame, by_receipt_key: bool = False) -> DataFrame:
    """Distinct pairs of receipt and KPI, and distinct receipts."""
    receipt = _receipt(by_receipt_key)
    return anoms.agg(
        F.count_distinct(F.struct(receipt.alias("receipt"), F.col("kpi_id"))).alias("anomalies"),
        F.count_distinct(receipt).alias("receipts"),
    )


# -- report tables ------------------------------------------------------------


def flag_distribution(stats: DataFrame, targets: Mapping[int, float] | None = None) -> DataFrame:
    """Nationwide flags per KPI and colour against the target of the colour.

    ``mape`` is the mean absolute deviation from the target, in percent of it.
    """
    targets = TARGETS if targets is None else targets
    metric = F.col("metric")
    target = None
    for flag, value in targets.items():
        hit = metric == f"{METRIC_PREFIX}{COLOURS[flag]} | {NATIONWIDE}"
        target = F.when(hit, F.lit(float(value))) if target is None else target.when(hit, F.lit(float(value)))
    values = F.array_compact(F.array(*KPI_LABELS))

    def mean(items: Column) -> Column:
        return F.aggregate(items, F.lit(0.0), lambda total, v: total + v) / F.size(items)

    deviation = F.transform(values, lambda v: F.abs((v - F.col("target")) / F.col("target")))
    return (
        stats.withColumn("target", target)
        .filter(F.col("target").isNotNull())
        .select(
            "metric",
            F.col(TOTAL).alias("total"),
            F.round(mean(values), 2).alias("mean"),
            "target",
            F.round(mean(deviation) * 100, 2).alias("mape"),
            *KPI_LABELS,
        )
    )


def melt_stats(stats: DataFrame) -> DataFrame:
    """Statistics in long form: metric (and week), KPI, value."""
    ids = [c for c in ("metric", "iso_week") if c in stats.columns]
    return stats.unpivot(ids, [*KPI_LABELS, TOTAL], "kpi", "value")


def weekly_trend(anoms: DataFrame, by_receipt_key: bool = False) -> DataFrame:
    """Weekly series: each KPI, all anomalies, and receipts with anomalies."""
    per_kpi = anomalies_per_week(anoms).select("iso_week", kpi_label(F.col("kpi_id")).alias("series"), "anomalies")
    total = anomalies_per_week(anoms, per_kpi=False).select("iso_week", F.lit(ALL_ANOMALIES).alias("series"), "anomalies")
    receipts = anomalous_receipts_per_week(anoms, by_receipt_key).select(
        "iso_week", F.lit(ALL_RECEIPTS).alias("series"), F.col("receipts").alias("anomalies")
    )
    return per_kpi.unionByName(total).unionByName(receipts)


def flag_histogram(counts: DataFrame, last_only: bool = False) -> DataFrame:
    """How many stores or regions (per week) have how many flags of a kind."""
    if last_only:
        counts = counts.filter(F.col("iso_week") == counts.select(F.max("iso_week")).scalar())
    kinds = ["count_red", "count_orange", "count_all"]
    return counts.select(*kinds).unpivot([], kinds, "kind", "flags").groupBy("kind", "flags").agg(
        F.count(F.lit(1)).alias("occurrences")
    )


def box_summary(df: DataFrame, by: str, value: str) -> DataFrame:
    """Minimum, quartiles and maximum per group."""
    quartiles = F.percentile(value, [0.0, 0.25, 0.5, 0.75, 1.0])
    names = ["minimum", "q1", "median", "q3", "maximum"]
    return (
        df.groupBy(by)
        .agg(quartiles.alias("quartiles"))
        .select(by, *[F.get("quartiles", F.lit(i)).alias(n) for i, n in enumerate(names)])
    )


def headline(anoms: DataFrame, flags: DataFrame, by_receipt_key: bool = False) -> DataFrame:
    """Latest weekly total and its change, for anomalies, receipts, red and orange flags."""

    def series(df: DataFrame, measure: str, value: str) -> DataFrame:
        return df.select(F.lit(HEADLINES[measure]).alias("measure"), "iso_week", F.col(value).alias("value"))

    per_flag = flags.groupBy("iso_week", "flag").agg(F.count(F.lit(1)).alias("flags"))
    weekly = (
        series(anomalies_per_week(anoms, per_kpi=False), "anomalies", "anomalies")
        .unionByName(series(anomalous_receipts_per_week(anoms, by_receipt_key), "receipts", "receipts"))
        .unionByName(series(per_flag.filter(F.col("flag") == RED), "red", "flags"))
        .unionByName(series(per_flag.filter(F.col("flag") == ORANGE), "orange", "flags"))
    )
    # One row per measure and week is left here.
    newest = Window.partitionBy("measure").orderBy(F.col("iso_week").desc())
    return (
        weekly.withColumn("previous", F.lead("value").over(newest))
        .withColumn("place", F.row_number().over(newest))
        .filter("place = 1")
        .select("measure", "iso_week", "value", (F.col("value") - F.col("previous")).alias("change"))
    )
