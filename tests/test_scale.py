"""Hot-group helpers against brute force."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from conftest import values
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillwatch.operators import scale


def test_rank_matches_a_window_with_ties_and_nulls(make):
    rng = random.Random(7)
    rows = [
        (rng.choice(["a", "a", "a", "b", None]), rng.choice([None, 1, 2, 3]), rng.choice([None, 0.5, 1.5, 2.5, 3.5]), i)
        for i in range(400)
    ]
    df = make(rows, "g string, level int, score double, i int")
    window = Window.partitionBy("g").orderBy(F.col("level").desc_nulls_last(), F.col("score").desc_nulls_last())
    expected = df.withColumn("r", F.rank().over(window))
    assert values(scale.competition_ranks(df, {"r": ["g"]}, ["level", "score"])) == values(expected)


def test_ranks_in_several_groupings(make):
    rng = random.Random(8)
    rows = [(rng.choice(["a", "b", None]), rng.randint(1, 4), rng.choice([None, 1, 2]), rng.choice([None, -1.5, 0.0, 2.5]), i) for i in range(500)]
    df = make(rows, "g string, s int, level int, score double, i int")
    order = [F.col("level").desc_nulls_last(), F.col("score").desc_nulls_last()]
    expected = df.withColumns({"a": F.rank().over(Window.partitionBy("g").orderBy(*order)), "b": F.rank().over(Window.partitionBy("s").orderBy(*order))})
    assert values(scale.competition_ranks(df, {"a": ["g"], "b": ["s"]}, ["level", "score"])) == values(expected)


def test_running_total(spark):
    """Whatever the ranges, the total of what stands before; one value of the first column has nearly all rows."""
    df = spark.range(5000).select((F.col("id") % 50 == 0).alias("g"), (F.col("id") * 7919 % 5000).alias("v"), (F.col("id") % 3).alias("n"))
    got = scale.running_total(df, [F.col("g").asc(), F.col("v").asc()], "n", "before")
    assert got.select(F.col("before")).distinct().count() > 3000
    total, wrong = 0, 0
    for r in sorted(got.collect(), key=lambda r: (r["g"], r["v"])):
        wrong += r["before"] != total
        total += r["n"]
    assert total == df.agg(F.sum("n")).first()[0] and wrong == 0
    assert scale.running_total(df.limit(0), [F.col("v").asc()], "n", "before").count() == 0


def test_a_moment_with_a_third_of_all_rows_stands_in_several_ranges(spark):
    hot = spark.range(3000).select(F.lit(1).alias("g"), F.lit("2025-01-06 12:00:00").cast("timestamp_ntz").alias("at"), F.format_string("t%05d", "id").alias("key"))
    rest = spark.range(6000).select((F.col("id") % 5).cast("int").alias("g"), F.expr("timestamp_ntz'2025-01-06 08:00:00' + make_dt_interval(0, 0, 0, cast(id as int))").alias("at"), F.format_string("u%05d", "id").alias("key"))
    df = hot.unionByName(rest)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = scale.next_in_order(df, ["g"], "at", "key", "n")
        ranges = scale.staged(df.repartitionByRange("g", "at", "key").withColumn("range_of", F.spark_partition_id()), "ranges")
        assert ranges.where("key LIKE 't%'").select("range_of").distinct().count() >= 4
        assert values(got) == values(df.withColumn("n", F.lead("key").over(Window.partitionBy("g").orderBy("at", "key"))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("spread", [1, 90, 50_000])
def test_next_in_order_matches_a_window(make, spread):
    rng = random.Random(11)
    start = datetime(2025, 1, 6, 7)
    rows = []
    for i in range(600):
        group = rng.choice(["hot", "hot", "hot", "warm", "cold", None])
        second = rng.choice([0, 1, 2, rng.randrange(spread), rng.randrange(4 * spread)])
        rows.append((group, 1, start + timedelta(seconds=second), f"t{i:04d}"))
    rows += [("single", 1, start, "t9999"), ("hot", 1, None, "t9998"), ("hot", 1, None, "t9997")]
    df = make(rows, "g string, r int, at timestamp_ntz, key string")
    expected = df.withColumn("n", F.lead("key").over(Window.partitionBy("g", "r").orderBy("at", "key")))
    got = scale.next_in_order(df, ["g", "r"], "at", "key", "n")
    assert values(got) == values(expected)


def test_staged_keeps_rows_and_schema_and_cuts_the_lineage(spark, make):
    df = make([(1, "a"), (2, None)], "n int, t string").withColumn("m", F.col("n") + 1)
    kept = scale.staged(df, "some-rows")
    assert values(kept) == values(df) and kept.dtypes == df.dtypes
    assert "LocalTableScan" not in kept._jdf.queryExecution().toString()
    assert all(spark.conf.get("spark.checkpoint.dir") in f for f in kept.inputFiles())


def test_staged_keeps_an_empty_result(make):
    assert scale.staged(make([], "n int"), "nothing").count() == 0


def test_membership_filter(spark):
    keys = spark.range(2000).select((F.col("id") * 31).alias("a"), F.when(F.col("id") % 9 > 0, F.col("id").cast("string")).alias("b"))
    rows = spark.range(200_000).select(F.col("id").alias("a"), F.when((F.col("id") / 31) % 9 > 0, (F.col("id") / 31).cast("long").cast("string")).alias("b"))
    columns = [F.col("a"), F.col("b")]
    for words in (scale.FILTER_WORDS, 3):
        known = scale.members_filter(keys, columns, words)
        assert known.count() <= min(words, 2000)
        found = scale.maybe_members(rows, columns, known, words)
        wanted = rows.join(keys, (rows["a"] == keys["a"]) & rows["b"].eqNullSafe(keys["b"]), "leftsemi")
        assert wanted.count() > 1500 and wanted.exceptAll(found).count() == 0 and found.columns == ["a", "b"]
        assert words == 3 or found.count() < 1.02 * wanted.count()
    assert scale.maybe_members(rows, columns, scale.members_filter(keys.limit(0), columns)).count() == 0
