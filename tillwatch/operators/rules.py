"""All metrics of a week at once: each source is gone through once, and a receipt carries a bit for each KPI.

The rules are those of ``metrics``; there, each KPI can be had alone. A plan that may write tables has them from extracts with
number keys instead: lines and payments are summed up in one row for each receipt, and these facts tell which few receipts
KPIs 5 and 6 can concern, so that only lines of those are shuffled again (``fact_rules``). Stores are looked up for receipts and not for
lines: whatever comes of lines and payments is joined with headers or subtotals of the run's stores.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.keys import KEY
from tillwatch.model import CANCELLED, CASH, KPI_IDS, RECEIPT_COLUMNS, RETURN, SALE, SALE_LINES, VOID_ENTRIES, VOID_LINES, VOIDED_SCANS
from tillwatch.operators.flagging import as_anomalies
from tillwatch.operators.metrics import m05, m06, nth_last_subtotal, one_article_left, small_return
from tillwatch.operators.prep import beyond_hours, opening_timestamps
from tillwatch.operators.scale import cut_down, next_in_order
from tillwatch.params import Params
from tillwatch.sources.extracts import ORIGINAL, staffed, without_original

MASK = "kpis"

Keep = Callable[[DataFrame, str], DataFrame]


def bit(kpi_id: int) -> Column:
    return F.lit(1 << kpi_id)


def _mask(rules: dict[int, Column]) -> Column:
    """The bits of the rules that hold; one that is NULL doesn't."""
    return reduce(Column.bitwiseOR, [F.when(rule, bit(k)).otherwise(0) for k, rule in rules.items()]).alias(MASK)


def return_rules(returned: DataFrame, found: DataFrame, p: Params) -> DataFrame:
    """KPIs 7, 8 and 9, from the returned articles and the originals that were found."""
    rows = returned.join(found.withColumn("found", F.lit(True)), ORIGINAL, "left")
    return rows.select(*RECEIPT_COLUMNS, _mask({7: small_return(p), 8: F.lit(True), 9: without_original(p)}))


def line_rules(lines: DataFrame, subtotals: DataFrame, headers: DataFrame, cash: DataFrame, p: Params) -> list[DataFrame]:
    """KPIs 5 and 6."""
    found = {5: m05(lines, subtotals, cash, p), 6: m06(lines, headers, cash, p)}
    return [df.select(*RECEIPT_COLUMNS, bit(k).alias(MASK)) for k, df in found.items()]


def receipt_facts(lines: DataFrame, payments: DataFrame) -> DataFrame:
    """One row for each receipt that has lines or payments; both combine before the shuffle.

    ``in_cash``: paid with cash and nothing else; ``with_void`` and ``with_return``: a line was voided, or returned; ``last_entry`` and ``last_other``: the
    numbers of its last void entry and its last line that is no void; ``last_scan`` and ``last_voided``: the number of its last
    scanned article, and whether that was voided.
    """
    kind, number = F.col("transaction_type_cd"), F.col("receiptline_nr")
    voided, scanned = F.col("void_fg") == 1, kind.isin(*SALE_LINES, *VOIDED_SCANS)
    of_lines = lines.select(
        *KEY,
        F.when(voided, True).alias("with_void"),
        F.when(F.col("return_fg") == 1, True).alias("with_return"),
        F.when(kind.isin(*VOID_ENTRIES), number).alias("last_entry"),
        F.when(~F.coalesce(kind.isin(*VOID_LINES), F.lit(False)), number).alias("last_other"),
        F.when(scanned, number).alias("last_scan"),
        F.when(scanned & voided, number).alias("voided_scan"),
        F.when(scanned & voided, True).alias("any_voided"),
    )
    every = of_lines.unionByName(payments.select(*KEY, "payment_type"), allowMissingColumns=True).groupBy(*KEY).agg(
        *[F.max(c).alias(c) for c in of_lines.columns if c not in KEY],
        F.min("payment_type").alias("lowest"),
        F.max("payment_type").alias("highest"),
    )
    return every.select(
        *KEY,
        F.coalesce((F.col("lowest") == CASH) & (F.col("highest") == CASH), F.lit(False)).alias("in_cash"),
        "with_void",
        "with_return",
        "last_entry",
        "last_other",
        "last_scan",
        (F.coalesce("any_voided", F.lit(False)) & F.col("voided_scan").eqNullSafe(F.col("last_scan"))).alias("last_voided"),
    )


def unreferenced(returns: DataFrame, found: DataFrame, p: Params) -> DataFrame:
    """Keys of receipts with a return line of KPI 9, from the ``named_returns`` and the originals that were found."""
    day = F.date_from_unix_date(F.floor(F.col("key_second") / 86_400).cast("int"))
    rows = returns.withColumn("receipt_date", day).join(found.withColumn("found", F.lit(True)), ORIGINAL, "left")
    return rows.filter(without_original(p)).select(*KEY).distinct()


def header_rules(
    headers: DataFrame,
    hours: DataFrame,
    lines: DataFrame | None,
    cash: DataFrame | None,
    p: Params,
    facts: DataFrame | None = None,
    unreferenced: DataFrame | None = None,
) -> DataFrame:
    """KPIs 1, 2, 3, 4 and 10: receipts with their opening hours, whether they were paid in cash, and whether a line was voided.

    The latter two come from the lines and cash receipts or, where a plan has them, from the ``receipt_facts``. These and the keys
    of ``unreferenced`` give KPIs 7, 8 and 9 of headers with a total as well.
    """
    kind, returned = F.col("transaction_type_cd"), {}
    if facts is not None:
        marked = unreferenced.withColumn("unreferenced", F.lit(True))
        rows = headers.join(facts.select(*KEY, "in_cash", "with_void", "with_return"), KEY, "left").join(marked, KEY, "left")
        with_return = staffed() & F.col("with_return")
        returned = {7: with_return & small_return(p), 8: with_return, 9: with_return & F.col("unreferenced")}
    else:
        rows = headers.filter(kind.isin(SALE, RETURN, CANCELLED))
        paid = cash.select("transaction_id", F.lit(True).alias("in_cash"))
        voided = lines.filter(F.col("void_fg") == 1).select("transaction_id").distinct().withColumn("with_void", F.lit(True))
        rows = rows.join(voided, "transaction_id", "left").join(paid, "transaction_id", "left")
    in_cash = F.col("in_cash") if p.cash_only else F.lit(True)
    rows = rows.join(opening_timestamps(hours), ["store_nr", "receipt_date"], "left")
    outside, intolerably = beyond_hours(p)
    with_void = staffed() & (kind == SALE) & in_cash & F.col("with_void")
    rules = returned | {
        1: (kind == SALE) & outside & (intolerably == 1),
        2: (kind == RETURN) & outside & staffed(),
        3: with_void,
        4: with_void & one_article_left(),
        10: (kind == CANCELLED) & staffed() & in_cash,
    }
    return rows.select(*RECEIPT_COLUMNS, _mask(rules))


def voided_after_subtotal(facts: DataFrame, lines: DataFrame, subtotals: Callable[[DataFrame], DataFrame], p: Params, keep: Keep) -> DataFrame:
    """``metrics.m05`` of the receipts of the facts: what is no void has to stand before the subtotal, and a void entry after it.

    ``subtotals`` gives those that may be of certain receipts.
    """
    entry, other, after = F.col("last_entry"), F.col("last_other"), F.col("subtotal_line_nr")
    likely = facts.filter(entry.isNotNull() & (other.isNull() | (entry > other))).select(*KEY, "last_entry", "last_other")
    nth = nth_last_subtotal(subtotals(likely), facts, p.with_(cash_only=False))
    found = nth.join(likely, KEY).filter((entry > after) & (other.isNull() | (other <= after)))
    found = keep(found.select(*KEY, *RECEIPT_COLUMNS, "subtotal_line_nr"), "after_subtotal")
    entries = lines.filter(F.col("transaction_type_cd").isin(*VOID_ENTRIES)).select(*KEY, "ean_barcode", "receiptline_nr")
    articles = cut_down(entries, found, KEY).groupBy(*KEY, "ean_barcode").agg(F.max("receiptline_nr").alias("article_entry"))
    return (
        articles.join(found, KEY)
        .filter(F.col("article_entry") > after)
        .groupBy(*KEY, *RECEIPT_COLUMNS)
        .agg(F.count("ean_barcode").alias("articles"))
        .filter(F.col("articles") >= p.min_distinct_voided)
    )


def next_keys(headers: DataFrame) -> DataFrame:
    """``metrics.next_receipt`` with number keys: ties in time are broken by what differs in the text of the keys."""
    relevant = headers.filter(staffed() & (F.col("turnover_relevant_fg") == 1))
    location = F.shiftright("key_till", 32).cast("string")
    tie = F.concat(location, F.lit("_"), F.col("receipt_id").cast("string")).alias("tie")
    group = ["receipt_date", "store_nr", "register_id"]
    rows = relevant.select("key_till", "key_second", *RECEIPT_COLUMNS, tie)  # the number of the receipt is there already
    led = next_in_order(rows, group, "receipt_ts", "tie", "next_tie", carry=["key_till", "key_second", "receipt_id"])
    return led.withColumn("key_receipt", F.col("receipt_id").cast("long")).withColumnRenamed("next_receipt_id", "next_key_receipt")


def sold_on_next_receipt(facts: DataFrame, lines: DataFrame, following: DataFrame, keep: Keep) -> DataFrame:
    """``metrics.m06`` of the receipts of the facts; ``following`` are the ``next_keys``."""
    kind, article = F.col("transaction_type_cd"), ["item_sid", "ean_barcode"]
    marked = facts.filter("last_voided").select(*KEY, "last_scan")
    scans = lines.filter(kind.isin(*SALE_LINES, *VOIDED_SCANS) & (F.col("void_fg") == 1)).select(*KEY, "receiptline_nr", *article)
    last = cut_down(scans, marked, KEY).join(marked, KEY).filter(F.col("receiptline_nr").eqNullSafe(F.col("last_scan")))
    wanted = [*[f"next_{c}" for c in KEY], *article]
    offered = keep(last.join(cut_down(following, marked, KEY), KEY).select(*wanted, *RECEIPT_COLUMNS), "next_receipts")
    sold = lines.filter(kind.isin(*SALE_LINES)).select(*KEY, *article).toDF(*wanted)
    return offered.join(cut_down(sold, offered, wanted).dropDuplicates(), wanted, "leftsemi")


def fact_rules(
    headers: DataFrame,
    hours: DataFrame,
    lines: DataFrame,
    subtotals: Callable[[DataFrame], DataFrame],
    facts: DataFrame,
    following: DataFrame,
    unreferenced: DataFrame,
    p: Params,
    keep: Keep,
) -> list[DataFrame]:
    """All KPIs, from extracts with number keys; ``keep`` is how the few rows that are looked up once more are written, those of both at the same time."""
    paid = facts.filter("in_cash") if p.cash_only else facts
    with ThreadPoolExecutor(2) as writers:
        after = writers.submit(voided_after_subtotal, paid, lines, subtotals, p, keep)
        sold = writers.submit(sold_on_next_receipt, paid, lines, following, keep)
        found = {5: after.result(), 6: sold.result()}
    return [header_rules(headers, hours, None, None, p, facts, unreferenced)] + [df.select(*RECEIPT_COLUMNS, bit(k).alias(MASK)) for k, df in found.items()]


def merge_rules(parts: Sequence[DataFrame]) -> DataFrame:
    """The anomalies of all parts, each receipt and KPI once, in the form of ``merge_anomalies``.

    Receipts of all parts are made distinct together; their bits combine before the shuffle.
    """
    rows = reduce(DataFrame.unionByName, [part.filter(F.col(MASK) != 0) for part in parts])
    rows = rows.groupBy(*RECEIPT_COLUMNS).agg(F.bit_or(MASK).alias(MASK))
    held = F.array(*[F.when(F.col(MASK).bitwiseAND(bit(k)) != 0, F.lit(k)) for k in KPI_IDS])
    return as_anomalies(rows.withColumn("kpi_id", F.explode(F.array_compact(held))), F.col("kpi_id"))
