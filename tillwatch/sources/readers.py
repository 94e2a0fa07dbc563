"""Generic readers and column normalisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.sinks.store import Store, TableNotFound


def read_query(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str],
    sql: str,
    split: tuple[str, str, str, int] | None = None,
    tables: Sequence[str] = (),
) -> DataFrame:
    """Run a SQL text at a warehouse-like source; only the result crosses the network.

    A source that scans tables but runs no SQL is given their names in ``tables``; the text names them in braces
    (``FROM {orders}``). Spark then runs the text, filters go down to the scans, and the source plans the splits.

    A JDBC source returns a query in one task. ``split`` (column, lower bound, upper bound,
    number of parts) reads ranges of a result column in parallel instead; rows outside
    the bounds belong to the first and last part.
    """
    reader = spark.read.format(fmt).options(**options)
    if tables:
        scans = {name: lower_columns(spark.read.format(fmt).options(**options).option("dbtable", name).load()) for name in tables}
        return lower_columns(spark.sql(sql, **scans))
    if split is None:
        return lower_columns(reader.option("query", sql).load())
    column, low, high, parts = split
    reader = reader.option("dbtable", f"({sql}) result").option("partitionColumn", column)
    reader = reader.option("lowerBound", low).option("upperBound", high).option("numPartitions", parts)
    return lower_columns(reader.load())


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def cast_columns(df: DataFrame, groups: Mapping[str, Sequence[str]], lenient: bool = False) -> DataFrame:
    """Cast groups of columns: the type is the group name up to its first underscore.

    ``{"int_columns": ["a"], "boolean_columns": ["b"]}`` casts ``a`` to int and ``b``
    to boolean. ``lenient`` turns values that do not convert into NULL.
    """
    df = lower_columns(df)
    casts: dict[str, Column] = {}
    for group, names in groups.items():
        kind = group.lower().split("_")[0]
        for name in names:
            col = F.col(name.lower())
            casts[name.lower()] = col.try_cast(kind) if lenient else col.cast(kind)
    return df.withColumns(casts) if casts else df


def read_path(spark: SparkSession, path: str, fmt: str = "parquet", prefixes: Sequence[str] = ()) -> DataFrame:
    """Files outside the zones; with ``prefixes`` the path must begin with one of them."""
    if prefixes and not path.startswith(tuple(prefixes)):
        raise ValueError(f"path {path!r} does not start with any of {list(prefixes)}")
    return spark.read.format(fmt).load(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header line; the schema is given, so the files are not read twice to guess it."""
    return spark.read.csv(path, header=True, schema=schema, mode="FAILFAST")


def load_table(
    spark: SparkSession, store: Store, name: str, zone: str = "working", required: bool = False
) -> DataFrame | None:
    """A table of a zone, or None when it does not exist; ``required`` makes that an error."""
    df = None
    if store.is_catalog(zone):
        if spark.catalog.tableExists(store.table(zone, name)):
            df = spark.table(store.table(zone, name))
    else:
        try:
            df = spark.read.format(store.format).load(store.path(zone, name))
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    if df is None and required:
        raise TableNotFound(f"table {name!r} does not exist in zone {zone!r}")
    return df
