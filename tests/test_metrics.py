from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from conftest import values
from pyspark.sql import functions as F
from test_prep import DAY, HEADER, LINE, P, head

from tillwatch.operators import metrics

SUBTOTAL = (
    "transaction_id string, receiptline_nr int, store_nr int, receipt_date date, receipt_ts timestamp_ntz, "
    "register_id int, cashier_id int, receipt_id long"
)
AT = datetime(2025, 1, 7, 12)


def cash_of(make, *receipts):
    return make([(f"t{n}",) for n in receipts], "transaction_id string")


def lines_of(make, receipts):
    """{receipt: [(line number, type, ean, item, void flag)]}"""
    return make([(f"t{n}", t, i, 0, v, e, a) for n, rows in receipts.items() for i, t, e, a, v in rows], LINE)


def test_opening_hour_metrics(make):
    rows = [(101, DAY, AT, r, 5, n, o, b) for n, (r, o, b) in enumerate([(1, 1, 0), (80, 1, 0), (1, 0, 0), (1, 1, 1), (1, 0, 1), (80, 0, 1), (1, None, 0)])]
    outside = make(rows, "store_nr int, receipt_date date, receipt_ts timestamp_ntz, register_id int, cashier_id int, receipt_id long, outside_tolerance_fg int, return_fg int")
    assert values(metrics.m01(outside), "receipt_id") == [(0,), (1,)]
    assert values(metrics.m02(outside), "receipt_id") == [(3,), (4,)]


def test_one_article_left(make):
    voided = make([(1, 3, 2), (2, 3, 1), (3, 2, 2), (4, None, 1)], "receipt_id long, cnt_receiptlines_sales int, cnt_receiptlines_voids int")
    assert values(metrics.m04(voided), "receipt_id") == [(1,)]
    assert metrics.m03(voided) is voided


def test_nth_last_subtotal(make):
    rows = [(f"t{n}", i, 101, DAY, AT, 1, 5, n) for n, i in [(1, 3), (1, 9), (1, 5), (2, 4), (3, 1), (3, 2)]]
    subtotals = make(rows, SUBTOTAL)
    got = metrics.nth_last_subtotal(subtotals, cash_of(make, 1, 2), P)
    assert values(got, "receipt_id", "subtotal_line_nr") == [(1, 5)]
    first = P.with_(nth_last_subtotal=1, cash_only=False)
    assert values(metrics.nth_last_subtotal(subtotals, cash_of(make), first), "receipt_id", "subtotal_line_nr") == [(1, 9), (2, 4), (3, 2)]


def test_only_voids_after_subtotal(make):
    subtotals = make([(f"t{n}", i, 101, DAY, AT, 1, 5, n) for n in range(1, 8) for i in (5, 50)], SUBTOTAL)
    lines = lines_of(make, {
        1: [(1, 101, "X", 1, None), (6, 170, "A", 1, 1), (7, 171, "A", 1, None), (8, 173, "B", 2, None)],
        2: [(6, 171, "A", 1, None), (7, 171, "A", 1, None)],                              # one article
        3: [(6, 171, "A", 1, None), (7, 171, "B", 1, None), (8, 101, "C", 1, None)],       # a sale as well
        4: [(5, 101, "C", 1, None), (6, 171, "A", 1, None), (7, 171, "B", 1, None)],       # the sale is at the subtotal
        5: [(6, 170, "A", 1, 1), (7, 172, "B", 1, 1)],                                     # voided scans only
        6: [(6, 171, "A", 1, None), (7, 171, None, 1, None)],                              # NULL is no article
        7: [(6, 171, "A", 1, None), (7, 171, "B", 1, None), (8, None, "C", 1, None)],       # unknown type
    })
    cash = cash_of(make, *range(1, 8))
    assert values(metrics.m05(lines, subtotals, cash, P), "receipt_id") == [(1,), (4,)]
    one = P.with_(min_distinct_voided=1)
    assert values(metrics.m05(lines, subtotals, cash, one), "receipt_id") == [(1,), (2,), (4,), (6,)]


def test_next_receipt(make):
    rows = [
        head(1, at="10:00:00"), head(2, at="11:00:00"), head(3, at="10:30:00", relevant=0), head(4, at="10:40:00", register=2),
        head(5, at="12:00:00", register=80), head(6, at="10:10:00", day=date(2025, 1, 8)), head(8, at="11:00:00"), head(7, at="10:50:00", store=102),
    ]
    got = metrics.next_receipt(make(rows, HEADER))
    assert values(got, "receipt_id", "next_transaction_id") == [(1, "t2"), (2, "t8"), (4, None), (6, None), (7, None), (8, None)]


def test_last_article_voided_and_sold_next(make):
    headers = make([head(n, at=f"10:0{n}:00") for n in range(1, 9)], HEADER)
    lines = lines_of(make, {
        1: [(1, 101, "A", 1, None), (2, 170, "B", 2, 1), (9, 171, "B", 2, None)],  # B voided last …
        2: [(1, 101, "B", 2, None), (2, 101, "B", 2, None), (3, 170, "C", 3, 1)],   # … and sold here; C voided last
        3: [(1, 101, "C", 4, None), (2, 170, "D", 5, 1), (3, 102, "E", 6, None)],    # C, but another item
        4: [(1, 101, "D", 5, None), (2, 170, None, 7, 1)],                           # D was not the last of 3
        5: [(1, 102, None, 7, None), (2, 170, "F", 8, 1)],                           # NULL never matches
        6: [(1, 102, "F", 8, None), (2, 170, "G", 9, 1), (2, 170, "H", 10, 1)],       # two lines with the last number
        7: [(1, 101, "H", 10, None), (2, 170, "I", 1, 1)],
        8: [(1, 170, "I", 1, 1)],                                                    # voided, hence not sold
    })
    everyone = cash_of(make, *range(1, 9))
    assert values(metrics.as_metric(metrics.m06(lines, headers, everyone, P)), "receipt_id") == [(1,), (5,), (6,)]
    # The next receipt need not be a cash one.
    assert values(metrics.as_metric(metrics.m06(lines, headers, cash_of(make, 1), P)), "receipt_id") == [(1,)]


def test_returns(make):
    rows = [(n, Decimal(v)) for n, v in enumerate(["-7.00", "-7.01", "-9.99", "-10.00", "8.00"])]
    returns = make(rows, "receipt_id long, total_gross_val decimal(18,2)")
    assert values(metrics.m07(returns, P), "receipt_id") == [(1,), (2,)]
    assert metrics.m08(returns) is returns and metrics.m09(returns) is returns


def test_cancelled_receipts(make):
    headers = make([head(1, 200), head(2, 200, register=80), head(3, 100), head(4, 200)], HEADER)
    assert values(metrics.m10(headers, cash_of(make, 1, 2, 3), P), "receipt_id") == [(1,)]
    assert values(metrics.m10(headers, cash_of(make), P.with_(cash_only=False)), "receipt_id") == [(1,), (4,)]


def test_metric_form_has_each_receipt_once(make):
    df = make([head(1), head(1), head(2)], HEADER).withColumn("line", F.monotonically_increasing_id())
    assert metrics.as_metric(df).columns == ["store_nr", "receipt_date", "receipt_ts", "register_id", "cashier_id", "receipt_id"]
    assert metrics.as_metric(df).count() == 2
