"""Working and historical tables and external targets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.functions.columns import add_static_columns
from tillwatch.sinks.store import Run, Store
from tillwatch.sources.readers import load_table


def save_table(df: DataFrame, store: Store, name: str, zone: str = "working") -> None:
    """Replace a table, its schema included."""
    writer = df.write.format(store.format).mode("overwrite").option("overwriteSchema", "true")
    if store.is_catalog(zone):
        writer.saveAsTable(store.table(zone, name))
    else:
        writer.save(store.path(zone, name))


def align_schema(df: DataFrame, target: T.StructType | None, lenient: bool = False) -> DataFrame:
    """Spell and type shared columns like the target; new columns stay, no target changes nothing."""
    if target is None:
        return df
    known = {field.name.lower(): field for field in target.fields}
    columns = []
    for name in df.columns:
        field = known.get(name.lower())
        col = F.col(f"`{name}`")
        if field is not None:
            col = (col.try_cast(field.dataType) if lenient else col.cast(field.dataType)).alias(field.name)
        columns.append(col)
    return df.select(*columns)


def archive_table(df: DataFrame, store: Store, name: str, run: Run) -> None:
    """Append a table to history, stamped with the run and partitioned by it."""
    stamped = add_static_columns(df, {"run_id": run.run_id, "run_timestamp": run.run_timestamp})
    existing = load_table(df.sparkSession, store, name, "historical")
    if existing is not None:
        # An all-digit partition folder reads back as a number; the id itself stays text.
        kinds = T.StructType([f for f in existing.schema.fields if f.name.lower() != "run_id"])
        stamped = align_schema(stamped, kinds)
    append_table(stamped, store, name, "historical")


def append_table(df: DataFrame, store: Store, name: str, zone: str) -> None:
    """Append rows to a table partitioned by run; a catalog table gains columns it does not know yet."""
    writer = df.write.format(store.format).mode("append").option("mergeSchema", "true").partitionBy("run_id")
    if not store.is_catalog(zone):
        writer.save(store.path(zone, name))
        return
    table, spark = store.table(zone, name), df.sparkSession
    if spark.catalog.tableExists(table) and store.format == "parquet":
        current = spark.table(table)
        known = {c.lower() for c in current.columns}
        fresh = [f for f in df.schema.fields if f.name.lower() not in known]
        if fresh:
            added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh)
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
        have = {c.lower() for c in df.columns}
        missing = {f.name: F.lit(None).cast(f.dataType) for f in current.schema.fields if f.name.lower() not in have}
        df = df.withColumns(missing) if missing else df
        columns = spark.table(table).columns
        df.select(*columns).write.insertInto(table)
        return
    writer.saveAsTable(table)


def history(spark, store: Store, name: str) -> DataFrame | None:
    """All archived runs of a table with the run id as text; columns added later are NULL in older runs."""
    zone = "historical"
    if store.is_catalog(zone):
        df = load_table(spark, store, name, zone)
    else:
        if load_table(spark, store, name, zone) is None:
            return None
        df = spark.read.format(store.format).option("mergeSchema", "true").load(store.path(zone, name))
    return df if df is None else df.withColumn("run_id", F.col("run_id").cast("string"))


def write_external(df: DataFrame, fmt: str, options: Mapping[str, str], table: str) -> None:
    """Replace a table of an external warehouse."""
    df.write.format(fmt).options(**options).option("dbtable", table).mode("overwrite").save()
