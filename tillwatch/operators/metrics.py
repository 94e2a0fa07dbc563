"""Stage 2: ten receipt-level metrics.

Every ``mNN`` returns the receipts it finds conspicuous; ``as_metric`` brings them
into the common form. Where a helper ranks rows, the filter on the rank lets Spark
cut each group down before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.functions.keys import key_of
from tillwatch.model import CANCELLED, RECEIPT_COLUMNS, SALE_LINES, VOID_ENTRIES, VOID_LINES, VOIDED_SCANS
from tillwatch.operators.prep import keep_cash
from tillwatch.operators.scale import next_in_order
from tillwatch.params import Params
from tillwatch.sources.extracts import staffed


def as_metric(df: DataFrame) -> DataFrame:
    """The six receipt columns, each receipt once."""
    return df.select(*RECEIPT_COLUMNS).dropDuplicates()


def m01(outside: DataFrame) -> DataFrame:
    """Sales outside opening hours and tolerance, self-checkout included."""
    return outside.filter("outside_tolerance_fg = 1 AND return_fg = 0")


def m02(outside: DataFrame) -> DataFrame:
    """Returns outside opening hours at staffed registers."""
    return outside.filter((F.col("return_fg") == 1) & staffed())


def m03(voided: DataFrame) -> DataFrame:
    """Receipts with voided lines."""
    return voided


def one_article_left() -> Column:
    return F.col("cnt_receiptlines_sales") - F.col("cnt_receiptlines_voids") == 1


def m04(voided: DataFrame) -> DataFrame:
    """Receipts voided down to one article."""
    return voided.filter(one_article_left())


def nth_last_subtotal(subtotals: DataFrame, cash: DataFrame, p: Params) -> DataFrame:
    """The n-th last subtotal of each receipt; receipts with fewer subtotals drop out.

    The cash filter keeps or drops whole receipts, so it can follow the ranking, which
    leaves one row per receipt to join.
    """
    key = key_of(subtotals)
    newest_first = Window.partitionBy(*key).orderBy(F.col("receiptline_nr").desc())
    nth = subtotals.withColumn("nth", F.row_number().over(newest_first)).filter(F.col("nth") == p.nth_last_subtotal)
    return keep_cash(nth, cash, p).select(
        *RECEIPT_COLUMNS, *key, F.col("receiptline_nr").alias("subtotal_line_nr")
    )


def m05(lines: DataFrame, subtotals: DataFrame, cash: DataFrame, p: Params) -> DataFrame:
    """Receipts with nothing but voids after that subtotal, of at least n different articles.

    "Nothing but voids" means that the last line of any other type is not after the
    subtotal, and an article counts if its last void entry is. Both are maxima, so lines
    combine before they are shuffled and a receipt of very many lines costs no more
    than its articles.
    """
    kind, number = F.col("transaction_type_cd"), F.col("receiptline_nr")
    entries = (
        lines.filter(kind.isin(*VOID_ENTRIES))
        .groupBy("transaction_id", "ean_barcode")
        .agg(F.max(number).alias("last_entry"))
    )
    others = (
        lines.filter(~F.coalesce(kind.isin(*VOID_LINES), F.lit(False)))
        .groupBy("transaction_id")
        .agg(F.max(number).alias("last_other"))
    )
    after = F.col("subtotal_line_nr")
    return (
        entries.join(nth_last_subtotal(subtotals, cash, p), "transaction_id")
        .filter(F.col("last_entry") > after)
        .groupBy("transaction_id", *RECEIPT_COLUMNS, "subtotal_line_nr")
        .agg(F.count("ean_barcode").alias("articles"))
        .filter(F.col("articles") >= p.min_distinct_voided)
        .join(others, "transaction_id", "left")
        .filter(F.col("last_other").isNull() | (F.col("last_other") <= after))
        .select(*RECEIPT_COLUMNS, "transaction_id", "articles")
    )


def next_receipt(headers: DataFrame) -> DataFrame:
    """Each turnover-relevant receipt with the key of the next one at the same register and day.

    Ties in time are broken by the receipt key.
    """
    relevant = headers.filter(staffed() & (F.col("turnover_relevant_fg") == 1))
    return next_in_order(
        relevant.select("transaction_id", *RECEIPT_COLUMNS),
        group=["receipt_date", "store_nr", "register_id"],
        at="receipt_ts",
        value="transaction_id",
        out="next_transaction_id",
    )


def sold_articles(lines: DataFrame) -> DataFrame:
    """Articles sold per receipt, each once, whatever the means of payment."""
    return (
        lines.filter(F.col("transaction_type_cd").isin(*SALE_LINES))
        .select("transaction_id", "item_sid", "ean_barcode")
        .dropDuplicates()
    )


def last_voided_articles(lines: DataFrame, cash: DataFrame, p: Params) -> DataFrame:
    """Receipts whose last scanned article was voided, with that article."""
    key = key_of(lines)
    last_first = Window.partitionBy(*key).orderBy(F.col("receiptline_nr").desc())
    scans = lines.filter(F.col("transaction_type_cd").isin(*SALE_LINES, *VOIDED_SCANS))
    last = (
        scans.select(*key, "receiptline_nr", "item_sid", "ean_barcode", "void_fg")
        .withColumn("place", F.rank().over(last_first))
        .filter("place = 1")
        .filter("void_fg = 1")
    )
    return keep_cash(last, cash, p).select(*key, "item_sid", "ean_barcode")


def m06(lines: DataFrame, headers: DataFrame, cash: DataFrame, p: Params) -> DataFrame:
    """Last article voided, and the same article sold on the next receipt of the register."""
    sold = sold_articles(lines).withColumnRenamed("transaction_id", "next_transaction_id")
    return (
        last_voided_articles(lines, cash, p)
        .join(next_receipt(headers), "transaction_id")
        .join(sold, ["next_transaction_id", "item_sid", "ean_barcode"], "leftsemi")
    )


def small_return(p: Params) -> Column:
    total = F.col("total_gross_val")
    return (total > -p.return_limit) & (total < -p.return_minimum)


def m07(returns: DataFrame, p: Params) -> DataFrame:
    """Small returns that need no authorisation; both limits exclusive."""
    return returns.filter(small_return(p))


def m08(returns: DataFrame) -> DataFrame:
    """All returns."""
    return returns


def m09(unreferenced: DataFrame) -> DataFrame:
    """Returns without original receipt."""
    return unreferenced


def m10(headers: DataFrame, cash: DataFrame, p: Params) -> DataFrame:
    """Cancelled receipts."""
    return keep_cash(headers.filter(staffed() & (F.col("transaction_type_cd") == CANCELLED)), cash, p)
