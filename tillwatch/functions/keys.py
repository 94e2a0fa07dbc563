"""Receipt key and report scope."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.params import Params


def _digits(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def receipt_key() -> Column:
    """'loc_client_register_yyyyMMdd_HHmmss_receipt'; NULL as soon as one part is NULL.

    Date and time are put together from their fields: the key is built for every row
    of every receipt table, and a pattern formatter costs several times as much.
    """
    day, at = F.col("receipt_date"), F.col("receipt_ts")
    parts = [
        F.col("loc_sid").cast("string"),
        F.col("client_id").cast("string"),
        F.col("register_id").cast("string"),
        _digits(F.year(day) * 10_000 + F.month(day) * 100 + F.day(day), 8),
        _digits(F.hour(at) * 10_000 + F.minute(at) * 100 + F.second(at), 6),
        F.col("receipt_id").cast("string"),
    ]
    pieces = [parts[0]]
    for part in parts[1:]:
        pieces += [F.lit("_"), part]
    return F.trim(F.concat(*pieces))


#: A receipt key as numbers: the receipt, the location and register, and the second.
KEY = ["key_receipt", "key_till", "key_second"]


def number_key() -> list[Column]:
    """The parts of ``receipt_key`` as three numbers, for joins within a run.

    Within one client they are equal where the keys are, and one of them is NULL where the key is. They take a fraction of
    the time and bytes of the text.
    """
    day, at = F.col("receipt_date"), F.col("receipt_ts")
    till = F.shiftleft(F.col("loc_sid").cast("long"), 32).bitwiseOR(F.col("register_id").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    second = F.unix_date(day).cast("long") * 86_400 + F.hour(at) * 3_600 + F.minute(at) * 60 + F.second(at)
    return [column.alias(name) for column, name in zip((F.col("receipt_id").cast("long"), till, second), KEY)]


def text_key() -> list[Column]:
    return [receipt_key().alias("transaction_id")]


def key_of(df: DataFrame) -> Sequence[str]:
    """The columns that tell receipts apart in an extract."""
    return KEY if set(KEY) <= set(df.columns) else ["transaction_id"]


def in_scope(
    df: DataFrame, p: Params, date_col: str = "receipt_date", store_col: str = "store_nr", lookback_days: int = 0
) -> DataFrame:
    """Rows of the client, period and stores of the run; ``lookback_days`` widens the period backwards."""
    if p.stores:
        stores = F.col(store_col).isin(*p.stores)
    else:
        stores = F.col(store_col).between(p.store_min, p.store_max)
    return in_period(df, p, date_col, lookback_days).filter(stores)


def in_period(df: DataFrame, p: Params, date_col: str = "receipt_date", lookback_days: int = 0) -> DataFrame:
    """Rows of the client and period of the run, whatever their store."""
    start = F.date_sub(F.lit(p.start_date), lookback_days)
    return df.filter((F.col("client_id") == p.client_id) & F.col(date_col).between(start, F.lit(p.end_date)))
