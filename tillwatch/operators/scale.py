"""Building blocks that keep hot groups and long lineages distributed."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``; where that is unset, one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared").rstrip("/")


def staged(df: DataFrame, label: str) -> DataFrame:
    """The same rows, written to the shared folder and read back.

    For results that several later steps use: the lineage ends here, an executor
    loss costs no recomputation, and later steps still read only their columns.
    """
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def same(left: DataFrame, right: DataFrame, names: Sequence[str], prefix: str) -> Column:
    """Equality of columns, NULL matching NULL, against a side whose columns carry a prefix."""
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[prefix + n]) for n in names])


#: Words of a membership filter: what its 16 bytes each add up to is sent to every executor, whatever the keys.
FILTER_WORDS = 1 << 20


def _place_and_bits(keys: Sequence[Column], words: int) -> tuple[Column, Column]:
    """Which word a key belongs to, and four of the word's bits."""
    hashed = F.xxhash64(*keys)
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftrightunsigned(hashed, shift), F.lit(64)).cast("int")) for shift in (40, 46, 52, 58)]
    return F.pmod(hashed, F.lit(words)), reduce(Column.bitwiseOR, bits)


def members_filter(df: DataFrame, keys: Sequence[Column], words: int = FILTER_WORDS) -> DataFrame:
    """(word, bits) in which every key of ``df`` has its bits set; at most ``words`` rows, combined before the shuffle."""
    word, bits = _place_and_bits(keys, words)
    return df.groupBy(word.alias("filter_word")).agg(F.bit_or(bits).alias("filter_bits"))


def maybe_members(df: DataFrame, keys: Sequence[Column], known: DataFrame, words: int = FILTER_WORDS) -> DataFrame:
    """Rows whose key may be in the filter: all that are, and few others as long as keys are not many times the words.

    The filter has a bounded size, so it is sent to all tasks, and rows are tested where they are read. Keys must
    have the types of those that made it.
    """
    word, bits = _place_and_bits(keys, words)
    tested = df.withColumns({"own_word": word, "own_bits": bits}).join(F.broadcast(known), F.col("own_word") == F.col("filter_word"))
    return tested.filter(F.col("filter_bits").bitwiseAND(F.col("own_bits")) == F.col("own_bits")).select(*df.columns)


def cut_down(df: DataFrame, wanted: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows that may have a match in ``wanted``, tested where they are read; an exact join has to follow."""
    keys = [F.col(c) for c in names]
    return maybe_members(df, keys, members_filter(wanted, keys))


def running_total(df: DataFrame, order: Sequence[Column], amount: str, out: str) -> DataFrame:
    """The same rows with ``out``, the sum of ``amount`` over all rows before them in this order (unique).

    Rows are dealt out by range and written with the number of their range; a task sums up
    one range, and the totals of the ranges before it, one row for each, are added. So no group
    of rows has to stand in one task. Ranges are drawn from a sample, hence the write: what is
    read twice must be the same both times.
    """
    number, before = "range_of", "range_before"
    ranged = staged(df.repartitionByRange(*order).withColumn(number, F.spark_partition_id()), "ranges")
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    within = F.sum(amount).over(earlier.partitionBy(number).orderBy(*order))
    totals = ranged.groupBy(number).agg(F.sum(amount).alias("total"))
    totals = totals.select(number, F.sum("total").over(earlier.orderBy(number)).alias(before))
    summed = ranged.withColumn(out, F.coalesce(within, F.lit(0))).join(totals, number)
    return summed.withColumn(out, F.col(out) + F.coalesce(before, F.lit(0))).drop(number, before)


def competition_ranks(df: DataFrame, groups: Mapping[str, Sequence[str]], order: Sequence[str]) -> DataFrame:
    """SQL ``rank()`` by all of ``order`` descending, NULLs last, in several groupings; one column for each.

    Tied rows share a rank, so only distinct values are ranked: rows are counted per value
    (combined before the shuffle) and running totals over all of them, group after group, give how
    many stand before each. A rank is the distance to the first of the group. The groupings are ranked together
    and need equally many columns; joins take the ranks back to the rows.
    """
    every = [c for names in groups.values() for c in names]
    counted = df.groupBy(*dict.fromkeys(every), *order).agg(F.count(F.lit(1)).alias("rows"))
    keys = [f"group_{i}" for i in range(max(map(len, groups.values())))]
    parts = [
        counted.select(F.lit(out).alias("ranking"), *[F.col(c).cast("string").alias(k) for c, k in zip(names, keys)], *order, "rows")
        for out, names in groups.items()
    ]
    grouping = ["ranking", *keys]
    values = reduce(DataFrame.unionByName, parts).groupBy(*grouping, *order).agg(F.sum("rows").alias("rows"))
    sorting = [*[F.col(k).asc_nulls_first() for k in grouping], *[F.col(c).desc_nulls_last() for c in order]]
    placed = running_total(values, sorting, "rows", "ahead")
    firsts = placed.groupBy(*grouping).agg(F.min("ahead").alias("first"))
    firsts = firsts.select(*[F.col(k).alias(f"of_{k}") for k in grouping], "first")
    placed = placed.join(firsts, same(placed, firsts, grouping, "of_")).select(
        *[F.col(c).alias(f"ranked_{c}") for c in [*grouping, *order]], (F.col("ahead") - F.col("first") + 1).cast("int").alias("rank_of_value")
    )
    for out, names in groups.items():
        ranks = placed.filter(F.col("ranked_ranking") == out).withColumnRenamed("rank_of_value", out)
        matches = [df[c].cast("string").eqNullSafe(ranks[f"ranked_{k}"]) for c, k in zip(names, keys)]
        matches += [df[c].eqNullSafe(ranks[f"ranked_{c}"]) for c in order]
        df = df.join(ranks, reduce(lambda a, b: a & b, matches), "left").select(*[df[c] for c in df.columns], out)
    return df


def next_in_order(df: DataFrame, group: Sequence[str], at: str, value: str, out: str, carry: Sequence[str] = ()) -> DataFrame:
    """``lead(value)`` within the group by (``at``, ``value``); ties in time follow ``value``, NULLs come first.

    Columns in ``carry``, which follow from the others, come along as ``next_<name>``.

    Rows are dealt out by range of all these columns and written with the number of their range. A task
    takes the next row within its range, and the last row of a range the first of the next one,
    of which there is one row for each range. So neither a group nor a moment has to stand in one task.
    """
    number = "range_of"
    columns = [*group, at, value, *carry]
    order = [F.col(c).asc_nulls_first() for c in (*group, at, value)]
    ranged = staged(df.repartitionByRange(*order).withColumn(number, F.spark_partition_id()), "ranges")
    within = F.lead(F.struct(*columns)).over(Window.partitionBy(number).orderBy(*order))
    heads = ranged.groupBy(number).agg(F.min(F.struct(*columns)).alias("head"))
    heads = heads.select(number, F.lead("head").over(Window.orderBy(number)).alias("next_head"))
    led = ranged.withColumn("next_row", within).join(heads, number).withColumn("next_row", F.coalesce("next_row", "next_head"))
    in_group = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"next_row.{c}")) for c in group])
    names = {value: out} | {c: f"next_{c}" for c in carry}
    follows = [F.when(F.col("next_row").isNotNull() & in_group, F.col(f"next_row.{c}")).alias(name) for c, name in names.items()]
    return led.select(*df.columns, *follows)
