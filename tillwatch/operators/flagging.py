"""Stage 3: merge the metrics and flag cashiers."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.calendar import iso_week
from tillwatch.functions.columns import lookup
from tillwatch.model import KPI_IDS, ORANGE, RED
from tillwatch.operators.scale import competition_ranks, running_total, same
from tillwatch.params import Params

ABSOLUTE_LEVEL = 3


def as_anomalies(df: DataFrame, kpi_id: Column) -> DataFrame:
    """Receipts in the form of the merged table."""
    return df.select(
        F.col("store_nr").cast("int").alias("store_nr"),
        "receipt_date",
        F.date_format("receipt_ts", "HH:mm:ss").alias("receipt_time"),
        F.col("register_id").cast("int").alias("register_id"),
        F.col("cashier_id").cast("int").alias("cashier_id"),
        F.col("receipt_id").cast("long").alias("receipt_id"),
        kpi_id.alias("kpi_id"),
    )


def merge_anomalies(metrics: Mapping[int, DataFrame]) -> DataFrame:
    """All metrics below each other, each row tagged with its KPI."""
    if not metrics:
        raise ValueError("no metrics to merge")
    return reduce(DataFrame.unionByName, [as_anomalies(df, F.lit(kpi_id)) for kpi_id, df in metrics.items()])


def kpi_counts(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy("store_nr", iso_week("receipt_date").alias("iso_week"), "kpi_id", "cashier_id").agg(
        F.count("receipt_id").alias("kpi_count")
    )


def with_activity(counts: DataFrame, stats: DataFrame) -> DataFrame:
    """Add the cashier's receipts of the week; NULL where none are known."""
    return counts.join(stats, ["store_nr", "cashier_id", "iso_week"], "left").select(
        "store_nr", "iso_week", "kpi_id", "cashier_id", "kpi_count", "total_receipts"
    )


def eligible(df: DataFrame, p: Params) -> DataFrame:
    """Cashiers with enough receipts, without KPI rows below the KPI's minimum count.

    A row without KPI may belong to any, so it must reach the minimum of each.
    """
    highest = F.when(F.col("kpi_id").isNull(), F.lit(max(p.min_counts.values(), default=0)))
    minimum = F.coalesce(lookup(F.col("kpi_id"), p.min_counts, "long"), highest, F.lit(0))
    return df.filter((F.col("total_receipts") > p.min_receipts_per_cashier) & (F.col("kpi_count") >= minimum))


def normalise(df: DataFrame, p: Params) -> DataFrame:
    """Rate per 100 receipts, and the rate times the KPI's weight; a KPI without a rule has no score."""
    weight = lookup(F.col("kpi_id"), {kpi_id: p.weight(kpi_id) for kpi_id in p.rules}, "double")
    rate = F.try_divide(F.col("kpi_count"), F.col("total_receipts")) * 100
    return df.withColumn("kpi_rate", rate).withColumn("kpi_score", F.col("kpi_rate") * weight)


def thresholds(df: DataFrame, p: Params) -> DataFrame:
    """Red and orange quantiles of the rates per week and KPI.

    The quantile of q is the smallest rate that at least q of all rates don't exceed. Rates are
    counted per value before the shuffle, running totals over ranges of values say how many don't exceed each,
    and the smallest that reaches q combines before the shuffle again: exact, in whichever order
    rows come, and no task has the rates of a week and KPI. KPIs with an absolute threshold have no red quantile.
    """
    kpi_ids = sorted(set(KPI_IDS) | set(p.rules))
    red = {k: p.red_probability(k) for k in kpi_ids if k not in p.absolute_thresholds}
    orange = {k: p.orange_probability(k) for k in kpi_ids}
    group = ["iso_week", "kpi_id"]
    values = df.groupBy(*group, "kpi_rate").agg(
        F.count("kpi_rate").alias("rows"), F.count("cashier_id").alias("cashiers")
    )
    upwards = [F.col(c).asc_nulls_first() for c in (*group, "kpi_rate")]
    placed = running_total(values, upwards, "rows", "ahead")
    sizes = placed.groupBy(*[F.col(c).alias(f"of_{c}") for c in group]).agg(
        F.min("ahead").alias("first"), F.sum("rows").alias("all"), F.sum("cashiers").alias("population")
    )
    placed = placed.join(sizes, same(placed, sizes, group, "of_")).withColumn("upto", F.col("ahead") - F.col("first") + F.col("rows"))

    def quantile(probabilities: Mapping[int, float]):
        percent = lookup(F.col("kpi_id"), {k: round(100 * q) for k, q in probabilities.items()}, "long")
        return F.min(F.when((F.col("upto") > 0) & (F.col("upto") * 100 >= percent * F.col("all")), F.col("kpi_rate")))

    return placed.groupBy(*group).agg(
        quantile(orange).alias("orange_threshold"),
        quantile(red).alias("red_threshold"),
        F.first("population").alias("population"),
    )


def robust(limits: DataFrame, p: Params) -> DataFrame:
    """Thresholds count only for large enough populations, and only when positive."""

    def checked(name: str):
        usable = (F.col("population") >= p.min_population) & (F.col(name) > 0)
        return F.when(usable, F.col(name))

    return limits.withColumns({name: checked(name) for name in ("orange_threshold", "red_threshold")})


def absolute_flags(df: DataFrame, p: Params) -> DataFrame:
    """``absolute_flag`` is 1 at or above the KPI's absolute threshold, else NULL."""
    limit = lookup(F.col("kpi_id"), p.absolute_thresholds, "long")
    return df.withColumn("absolute_flag", F.when(F.col("kpi_count") >= limit, 1))


def region_quota(org: DataFrame, p: Params) -> DataFrame:
    """Stores with the number of red flags their region may get.

    The stores of a region are counted in an aggregate and joined back, so a region
    with most of the stores is not gathered in one task.
    """
    quota = (F.lit(float(p.avg_red_flags_per_store)) * F.col("stores")).cast("int")
    sizes = org.groupBy(F.col("region_manager").alias("of_region_manager")).agg(F.count("store_nr").alias("stores"))
    joined = org.join(sizes, same(org, sizes, ["region_manager"], "of_"), "left")
    return joined.select(*org.columns, quota.alias("max_red_flags"))


def initial_level(df: DataFrame) -> DataFrame:
    """3 absolute, 2 above the red threshold, 1 above the orange one, else NULL."""
    rate = F.col("kpi_rate")
    level = (
        F.when(F.col("absolute_flag") == 1, ABSOLUTE_LEVEL)
        .when(rate >= F.col("red_threshold"), RED)
        .when(rate >= F.col("orange_threshold"), ORANGE)
    )
    return df.withColumn("level", level)


def levels(base: DataFrame, org: DataFrame, p: Params) -> DataFrame:
    """Normalised counts with thresholds, region, quota and initial level.

    There is at most one threshold row per KPI and calendar week; Spark measures that side and chooses the join.
    """
    limits = robust(thresholds(base, p), p)
    quota = region_quota(org, p).select("store_nr", "region_manager", "max_red_flags")
    with_limits = absolute_flags(base, p).join(limits, ["iso_week", "kpi_id"], "left")
    return initial_level(with_limits.join(quota, "store_nr", "left"))


def rank_flags(df: DataFrame) -> DataFrame:
    """Rank by level, then score, in the region and in the store of each week."""
    groups = {"region_rank": ["iso_week", "region_manager"], "store_rank": ["iso_week", "store_nr"]}
    return competition_ranks(df, groups, ["level", "kpi_score"])


def final_flags(df: DataFrame, p: Params) -> DataFrame:
    """Red for absolute violations and the best-ranked of the region, orange for the best-ranked of the store.

    Absolute violations take part in the ranking and so use up the region's quota.
    """
    level = F.col("level")
    red = (level == ABSOLUTE_LEVEL) | ((level == RED) & (F.col("region_rank") <= F.col("max_red_flags")))
    orange = F.col("store_rank") <= p.num_flags_per_store
    if p.orange_requires_level:
        orange = orange & level.isNotNull()
    flag = F.when(red, RED).when(orange, ORANGE)
    return df.select("iso_week", "store_nr", "cashier_id", "kpi_id", flag.alias("flag")).dropna(subset=["flag"])


def flag_cashiers(
    anomalies: DataFrame,
    stats: DataFrame,
    org: DataFrame,
    p: Params,
    keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> DataFrame:
    """Merged anomalies to flags per week, store, cashier and KPI.

    The counts per cashier and the levels are small and feed several steps each; a plan
    that writes them once passes how as ``keep``.
    """
    counts = with_activity(kpi_counts(anomalies), stats)
    base = keep(normalise(eligible(counts, p), p), "cashier_kpis")
    return final_flags(rank_flags(keep(levels(base, org, p), "cashier_levels")), p)
