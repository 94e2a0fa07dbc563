"""Stage 1: cashier activity, opening hours and voided cash receipts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.calendar import iso_week
from tillwatch.functions.keys import key_of
from tillwatch.model import RECEIPT_COLUMNS, RETURN, SALE
from tillwatch.params import Params
from tillwatch.sources.extracts import staffed


def cashier_stats(headers: DataFrame) -> DataFrame:
    """Sales and returns per store, cashier and ISO week, self-checkout included."""
    return (
        headers.filter(F.col("transaction_type_cd").isin(SALE, RETURN))
        .groupBy("store_nr", "cashier_id", iso_week("receipt_date").alias("iso_week"))
        .agg(F.count("transaction_id").alias("total_receipts"))
    )


def opening_timestamps(hours: DataFrame) -> DataFrame:
    """Clock strings to timestamps on open days; NULL on closed days and for missing or malformed clocks."""

    def at(clock: str):
        text = F.concat(F.col("receipt_date").cast("string"), F.lit(" "), F.col(clock))
        parsed = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))
        return F.when(F.col("is_open") == 1, parsed.cast("timestamp_ntz"))

    return hours.select(
        "store_nr", "receipt_date", "is_open", at("open_time").alias("opens_at"), at("close_time").alias("closes_at")
    )


def beyond_hours(p: Params) -> tuple[Column, Column]:
    """Whether a receipt is of a closed day or outside opening hours (NULL on open days without hours), and 1 if tolerance doesn't help."""
    closed = F.col("is_open") == 0
    at, opens, closes = F.col("receipt_ts"), F.col("opens_at"), F.col("closes_at")
    early = opens - F.make_interval(mins=F.lit(p.tolerance_opening_minutes))
    late = closes + F.make_interval(mins=F.lit(p.tolerance_closing_minutes))
    return closed | ~at.between(opens, closes), F.when(closed, 1).otherwise(1 - at.between(early, late).cast("int"))


def receipts_outside_hours(headers: DataFrame, hours: DataFrame, p: Params) -> DataFrame:
    """Sales and returns on closed days or outside opening hours; open days without hours drop out."""
    outside, intolerably = beyond_hours(p)
    return (
        headers.filter(F.col("transaction_type_cd").isin(SALE, RETURN))
        .join(opening_timestamps(hours), ["store_nr", "receipt_date"])
        .filter(outside)
        .select(
            *RECEIPT_COLUMNS,
            intolerably.alias("outside_tolerance_fg"),
            (F.col("transaction_type_cd") == RETURN).cast("int").alias("return_fg"),
        )
    )


def keep_cash(df: DataFrame, cash: DataFrame, p: Params) -> DataFrame:
    """Rows of cash-only receipts, if the run is limited to those."""
    return df.join(cash.select(*key_of(cash)), key_of(cash), "leftsemi") if p.cash_only else df


def cash_sales(headers: DataFrame, cash: DataFrame, p: Params) -> DataFrame:
    """Sales of staffed registers, paid in cash."""
    sales = headers.filter(staffed() & (F.col("transaction_type_cd") == SALE))
    columns = [*RECEIPT_COLUMNS, "transaction_id", "cnt_receiptlines_sales", "cnt_receiptlines_voids"]
    return keep_cash(sales, cash, p).select(*columns)


def voided_cash_receipts(lines: DataFrame, headers: DataFrame, cash: DataFrame, p: Params) -> DataFrame:
    """Cash sales with at least one voided line.

    Only whether such a line exists matters: the keys are made distinct, which combines
    before the shuffle, and a semi join never multiplies a receipt.
    """
    voided = lines.filter(F.col("void_fg") == 1).select("transaction_id").distinct()
    columns = [*RECEIPT_COLUMNS, "cnt_receiptlines_sales", "cnt_receiptlines_voids"]
    return cash_sales(headers, cash, p).join(voided, "transaction_id", "leftsemi").select(*columns).dropDuplicates()
