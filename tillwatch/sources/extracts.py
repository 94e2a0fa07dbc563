"""The weekly extracts, computed from raw tables so that filters reach the files.

The location join is written as an inner join: the store filter of the report
scope drops receipts without a location anyway. No join carries a broadcast hint;
Spark compares the measured size of a side with its own threshold. ``key`` says what tells receipts apart: the
text ``transaction_id``, or the numbers that the rules of a week join by. Where ``anywhere`` is set, rows of other
stores may stay: it is for rows that an exact join with rows of the run's stores follows, so that
lines needn't be dealt out by location if there are too many locations to be sent to every task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.keys import KEY, in_period, in_scope, key_of, number_key, text_key
from tillwatch.model import CASH, RECEIPT_COLUMNS, SALE_LINES, SELF_CHECKOUT_FROM
from tillwatch.operators.scale import cut_down, maybe_members, members_filter
from tillwatch.params import Params


Key = Callable[[], list[Column]]


def staffed() -> Column:
    """Registers with a cashier, that is no self-checkout."""
    return F.col("register_id") < SELF_CHECKOUT_FROM


def _located(df: DataFrame, location: DataFrame, p: Params, lookback_days: int = 0) -> DataFrame:
    stores = location.select("loc_sid", "store_nr")
    return in_scope(df.join(stores, "loc_sid"), p, lookback_days=lookback_days)


def _scoped(df: DataFrame, location: DataFrame, p: Params, anywhere: bool) -> DataFrame:
    """Stores that are named are few, so rows of others are left out in any case."""
    return in_period(df, p) if anywhere and not p.stores else _located(df, location, p)


def receipt_headers(header: DataFrame, location: DataFrame, p: Params, key: Key = text_key) -> DataFrame:
    return _located(header, location, p).select(
        *key(),
        "transaction_type_cd",
        "cnt_receiptlines_sales",
        "cnt_receiptlines_voids",
        "turnover_relevant_fg",
        *RECEIPT_COLUMNS,
    )


def priced_headers(header: DataFrame, location: DataFrame, p: Params, key: Key = text_key) -> DataFrame:
    """``receipt_headers`` with the total of the receipt."""
    columns = ["transaction_type_cd", "cnt_receiptlines_sales", "cnt_receiptlines_voids", "turnover_relevant_fg", "total_gross_val"]
    return _located(header, location, p).select(*key(), *columns, *RECEIPT_COLUMNS)


def receipt_lines(line: DataFrame, location: DataFrame, p: Params, key: Key = text_key, anywhere: bool = False) -> DataFrame:
    """Turnover-relevant lines of staffed registers; ``void_fg`` stays NULL where nothing voided the line."""
    relevant = line.filter(staffed() & (F.col("turnover_relevant_fg") == 1))
    return _scoped(relevant, location, p, anywhere).select(
        *key(),
        "transaction_type_cd",
        "receiptline_nr",
        "return_fg",
        (F.col("receiptline_voided_by") > 0).cast("int").alias("void_fg"),
        F.col("ean_barcode").cast("string").alias("ean_barcode"),
        "item_sid",
    )


def subtotal_lines(subtotal: DataFrame, location: DataFrame, p: Params, key: Key = text_key) -> DataFrame:
    return _located(subtotal.filter(staffed()), location, p).select(*key(), "receiptline_nr", *RECEIPT_COLUMNS)


def subtotals_of(subtotal: DataFrame, location: DataFrame, p: Params, wanted: DataFrame) -> DataFrame:
    """``subtotal_lines`` by number key, of which those that can't be of ``wanted`` receipts are left out before stores are looked up."""
    rows = in_period(subtotal.filter(staffed()), p).withColumns(dict(zip(KEY, number_key())))
    return _located(cut_down(rows, wanted, KEY), location, p).select(*KEY, "receiptline_nr", *RECEIPT_COLUMNS)


def payments(payment: DataFrame, location: DataFrame, p: Params, key: Key = text_key, anywhere: bool = False) -> DataFrame:
    return _scoped(payment.filter(staffed()), location, p, anywhere).select(*key(), "payment_type")


def cash_only_receipts(payment: DataFrame, location: DataFrame, p: Params) -> DataFrame:
    """Keys of receipts paid with cash and nothing else; each key once.

    "Exactly one distinct type, and that is cash" equals "smallest and largest
    type are both cash", which needs no distinct count and combines before the shuffle.
    """
    kind = F.col("payment_type")
    return (
        payments(payment, location, p)
        .groupBy("transaction_id")
        .agg(F.min(kind).alias("lowest"), F.max(kind).alias("highest"))
        .filter((F.col("lowest") == CASH) & (F.col("highest") == CASH))
        .select("transaction_id")
    )


def _return_lines(line: DataFrame, location: DataFrame, p: Params, key: Key = text_key, anywhere: bool = False) -> DataFrame:
    wanted = (F.col("return_fg") == 1) & (F.col("turnover_relevant_fg") == 1) & staffed()
    return _scoped(line.filter(wanted), location, p, anywhere).select(
        *key(),
        "item_sid",
        "orig_receipt_store_id",
        "orig_receipt_register_id",
        "orig_receipt_dt",
        "orig_receipt_id",
    )


def _staffed_headers(header: DataFrame, location: DataFrame, p: Params, key: Key = text_key) -> DataFrame:
    return _located(header.filter(staffed()), location, p).select(*key(), *RECEIPT_COLUMNS, "total_gross_val")


def return_receipts(header: DataFrame, line: DataFrame, location: DataFrame, p: Params) -> DataFrame:
    """One row per return line, with the receipt's data and total."""
    returned = _return_lines(line, location, p, number_key)
    returned = returned.select(*key_of(returned))
    return (
        _staffed_headers(header, location, p, number_key)
        .join(returned, key_of(returned))
        .select(*RECEIPT_COLUMNS, "total_gross_val")
    )


def _receipt_article(receipt: str, day: str, register: str) -> list[Column]:
    return [F.col(receipt).cast("long"), F.col(day), F.col(register).cast("long"), F.col("item_sid").cast("long")]


def original_sales(line: DataFrame, location: DataFrame, p: Params, names: DataFrame | None = None) -> DataFrame:
    """Lines of sold, not voided articles, from the return period before the run on.

    An original counts if the sum of its quantities is not NULL, so if one of its lines has a quantity: the product of two
    numbers of 18 digits always fits, so it is NULL if one of them is. Given ``names`` of originals, lines that none can mean
    are left out where they are read, before stores are looked up.
    """
    sold = line.filter(
        F.col("transaction_type_cd").isin(*SALE_LINES)
        & (F.col("turnover_relevant_fg") == 1)
        & F.col("receiptline_voided_by").isNull()
    )
    sold = sold.filter(F.col("sales_piece_qty").isNotNull() & F.col("sales_weight_qty").isNotNull())
    if names is not None:
        within = in_period(sold, p, lookback_days=p.considered_return_days)
        sold = maybe_members(within, _receipt_article("receipt_id", "receipt_date", "register_id"), members_filter(names, _receipt_article("receipt", "sold_on", "register")))
    located = _located(sold, location, p, lookback_days=p.considered_return_days)
    return located.select("store_nr", "register_id", "receipt_date", "receipt_id", "item_sid")


ORIGINAL = ["store", "register", "sold_on", "receipt", "item_sid"]


def _named_originals(returns: DataFrame) -> DataFrame:
    """Return lines with the original they name, as join keys.

    A return that names none can never match, and its NULL keys would hash to the same
    partition as those of all others. It gets a NULL store, so that it still matches
    nothing, and a number derived from itself in place of the original receipt.
    """
    named = ["orig_receipt_store_id", "orig_receipt_register_id", "orig_receipt_dt", "orig_receipt_id"]
    incomplete = F.greatest(*[F.col(c).isNull().cast("int") for c in named]) == 1
    return returns.select(
        *key_of(returns),
        F.when(~incomplete, F.col("orig_receipt_store_id")).alias("store"),
        F.col("orig_receipt_register_id").alias("register"),
        F.col("orig_receipt_dt").alias("sold_on"),
        F.when(incomplete, F.xxhash64(*key_of(returns))).otherwise(F.col("orig_receipt_id")).alias("receipt"),
        "item_sid",
    )


def named_returns(line: DataFrame, location: DataFrame, p: Params, anywhere: bool = False) -> DataFrame:
    """Return lines, by number key, with the original they name."""
    return _named_originals(_return_lines(line, location, p, number_key, anywhere))


def originals_found(line: DataFrame, location: DataFrame, p: Params, returns: DataFrame | None = None) -> DataFrame:
    """The originals that returns name and that were sold, each once.

    Very many returns may name one original (a placeholder, say), so they are looked up by
    distinct names, which combine before the shuffle. A compact filter of the names is tested where sold lines are
    read; of those, hardly any but the originals are shuffled for the existence check. ``returns`` are the ``named_returns``,
    where a plan has saved them.
    """
    returns = named_returns(line, location, p) if returns is None else returns
    names = returns.filter(F.col("store").isNotNull()).select(*ORIGINAL).distinct()
    return names.join(original_sales(line, location, p, names).toDF(*ORIGINAL), ORIGINAL, "leftsemi")


def without_original(p: Params) -> Column:
    """No original ``found``, or one of at least ``considered_return_days`` ago."""
    return F.col("found").isNull() | (F.datediff("receipt_date", "sold_on") >= p.considered_return_days)


def returned_articles(header: DataFrame, line: DataFrame, location: DataFrame, p: Params) -> DataFrame:
    """Return lines with the receipt's data and total, and the original they name."""
    returns = named_returns(line, location, p)
    joined = _staffed_headers(header, location, p, number_key).join(returns, key_of(returns))
    return joined.select(*RECEIPT_COLUMNS, "total_gross_val", *ORIGINAL)


def returns_without_original(
    header: DataFrame, line: DataFrame, location: DataFrame, p: Params, found: DataFrame | None = None
) -> DataFrame:
    """Return lines whose original sale is missing or at least ``considered_return_days`` old.

    ``found`` are the ``originals_found``, where a plan has saved them: a join with a plain
    table is broadcast if that is small, and split at hot keys if it is not.
    """
    returns = named_returns(line, location, p)
    found = (originals_found(line, location, p) if found is None else found).withColumn("found", F.lit(True))
    return (
        _staffed_headers(header, location, p, number_key)
        .join(returns, key_of(returns))
        .join(found, ORIGINAL, "left")
        .filter(without_original(p))
        .select(*RECEIPT_COLUMNS)
    )


def opening_hours(hours: DataFrame, p: Params) -> DataFrame:
    return in_scope(hours, p).select("store_nr", "receipt_date", "is_open", "open_time", "close_time")


def store_org(org: DataFrame, p: Params) -> DataFrame:
    """Open stores with company and managers; the sales manager also serves as region manager."""
    store = F.col("orig_store_nr").cast("int")
    in_stores = store.isin(*p.stores) if p.stores else store.between(p.store_min, p.store_max)
    return org.filter(
        (F.col("client_id") == p.client_id) & (F.col("aspect_id") == 2) & F.col("dat_closing").isNull() & in_stores
    ).select(
        F.when(F.col("wh_id") == 5, "WEI").when(F.col("wh_id") == 6, "SEZ").otherwise("OTHER").alias("company"),
        store.alias("store_nr"),
        "store_desc",
        "account_manager",
        F.col("sales_manager").alias("region_manager"),
        "sales_manager",
    )
