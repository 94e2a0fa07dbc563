"""Lookups, labels and whole-DataFrame column helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.model import KPI_NAMES

# Client ids by country code.
CLIENT_IDS = {
    "AT": 1,
    "BE": 2,
    "BG": 3,
    "CH": 4,
    "CY": 5,
    "CZ": 6,
    "INT": 7,
    "DK": 8,
    "EE": 9,
    "ES": 10,
    "FI": 11,
    "FR": 12,
    "GB": 13,
    "GR": 14,
    "HR": 15,
    "HU": 16,
    "IE": 17,
    "IT": 18,
    "LT": 19,
    "LV": 20,
    "NI": 21,
    "NL": 22,
    "DE": 23,
    "PL": 24,
    "PT": 25,
    "RO": 26,
    "SE": 27,
    "SI": 28,
    "SK": 29,
    "CS": 31,
    "MT": 32,
    "US": 33,
    "RS": 34,
}


def lookup(col: Column, values: Mapping[Any, Any], kind: str) -> Column:
    """Value of a handful of keys as one CASE expression; NULL for any other key."""
    if not values:
        return F.lit(None).cast(kind)
    branches = None
    for key, value in values.items():
        hit = col == F.lit(key)
        branches = F.when(hit, F.lit(value)) if branches is None else branches.when(hit, F.lit(value))
    return branches.cast(kind)


def kpi_name(kpi_id: Column) -> Column:
    return lookup(kpi_id, KPI_NAMES, "string")


def kpi_label(kpi_id: Column) -> Column:
    """Short label 'KPI_07' of an id."""
    return F.concat(F.lit("KPI_"), F.lpad(kpi_id.cast("string"), 2, "0"))


def kpi_id_of(name: Column) -> Column:
    """Id in a name such as 'KPI_07: …'; NULL where the name has another form."""
    return F.regexp_extract(name, r"^(?:KPI_)?(\d+)(?::|$)", 1).try_cast("int")


def client_id(col: Column) -> Column:
    """Client id of a country code in any case; an unknown code is an error."""
    unknown = F.raise_error(F.concat(F.lit("unknown country code: "), F.coalesce(col, F.lit("NULL"))))
    return F.coalesce(lookup(F.upper(col), CLIENT_IDS, "int"), unknown.cast("int"))


def add_static_columns(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def reindex(df: DataFrame, keys: Sequence[Any], col: str) -> DataFrame:
    """Every listed key at least once, in a left join; missing numbers become 0.

    The keys are the caller's own list, so their number does not depend on the data.
    """
    wanted = df.sparkSession.createDataFrame([(k,) for k in keys], df.select(col).schema)
    return wanted.join(df, col, "left").fillna(0)


def percent_of_total(df: DataFrame, col: str, out: str = "percent") -> DataFrame:
    """Share of the column total in percent; 0 everywhere when the total is not positive.

    The total comes from a scalar subquery: a window over the whole table would
    move every row into one task.
    """
    total = df.select(F.sum(col).cast("double")).scalar()
    return df.withColumn(out, F.when(total > 0, F.lit(100) * F.col(col) / total).otherwise(F.lit(0.0)))
