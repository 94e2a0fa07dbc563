"""Helpers that several operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.operators.scale import shared_folder

__all__ = ["ascii_lower", "bucket_tasks", "kept", "shared_folder", "small_batches", "unused"]


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: computed once, whatever executors are lost later."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of texts that go to a Python worker at once.
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """Have the session hand texts to Python in batches of few rows: they are long, and several batches are in memory at a time."""
    conf = df.sparkSession.conf
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def ascii_lower(column):
    """A-Z as a-z; other letters stay."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bucket_tasks(rows: DataFrame, by: str, chunk: int) -> DataFrame:
    """Rows of buckets (column ``bucket``) as rows of tasks: ``task``, and ``side`` (0 or 1) in place of the bucket.

    A bucket of at most ``chunk`` rows is one task, in which all rows are side 0. A larger one is cut into
    chunks by a hash of ``by``, and each pair of chunks is a task: any two rows of a bucket meet in
    just one. Buckets of one row are left out. ``rows`` is read twice, so it should be cheap to build.
    """
    sizes = kept(rows.groupBy("bucket").count().where("count > 1").select("bucket", F.ceil(F.col("count") / chunk).cast("int").alias("_chunks")), "buckets")
    rows = rows.join(sizes, "bucket").withColumn("_own", F.pmod(F.xxhash64(by), F.col("_chunks")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    task = F.xxhash64("bucket", F.least("_own", "_other"), F.greatest("_own", "_other"))
    return rows.withColumns({"task": task, "side": (F.col("_own") > F.col("_other")).cast("int")}).drop("bucket", "_chunks", "_own", "_other")


def unused(name: str, columns: list[str]) -> str:
    """The name, with underscores behind it if a column has it already."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
