"""Canonical schemas, column lists and domain codes."""

from __future__ import annotations

from pyspark.sql import types as T

# Domain codes of the cash-register data.
SALE, RETURN, CANCELLED = 100, 150, 200
SALE_LINES = (101, 102)
VOIDED_SCANS = (170, 172)
VOID_ENTRIES = (171, 173)
VOID_LINES = (170, 171, 172, 173)
SELF_CHECKOUT_FROM = 80
CASH = 11

ORANGE, RED = 1, 2

# KPI names.
KPI_NAMES = {
    1: "KPI_01: Bons ausserhalb der Oeffnungszeiten inkl. Toleranz",
    2: "KPI_02: Rueckgaben ausserhalb der Oeffnungszeiten",
    3: "KPI_03: Anzahl Zeilenstornos",
    4: "KPI_04: Bons mit Zeilenstornos bis auf 1 Artikel",
    5: "KPI_05: Bons mit Zeilenstornos nach der letzten Zwischensumme",
    6: "KPI_06: Bons mit Zeilenstorno des letzten Artikels",
    7: "KPI_07: Rueckgaben ohne Autorisierung",
    8: "KPI_08: Rueckgaben allgemein",
    9: "KPI_09: Rueckgaben ohne Original-Beleg",
    10: "KPI_10: Bonabbrueche",
}
KPI_IDS = tuple(KPI_NAMES)
TOTAL = "GESAMT"
KPI_LABELS = tuple(f"KPI_{i:02d}" for i in KPI_IDS)

RECEIPT_COLUMNS = ["store_nr", "receipt_date", "receipt_ts", "register_id", "cashier_id", "receipt_id"]

_MONEY = T.DecimalType(18, 2)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_RECEIPT = dict(
    loc_sid=T.IntegerType(),
    client_id=T.IntegerType(),
    register_id=T.IntegerType(),
    receipt_date=T.DateType(),
    receipt_ts=T.TimestampNTZType(),
    receipt_id=T.LongType(),
)

RECEIPT_HEADER = _schema(
    **_RECEIPT,
    transaction_type_cd=T.IntegerType(),
    cnt_receiptlines_sales=T.IntegerType(),
    cnt_receiptlines_voids=T.IntegerType(),
    turnover_relevant_fg=T.IntegerType(),
    cashier_id=T.IntegerType(),
    total_gross_val=_MONEY,
)

RECEIPT_LINE = _schema(
    **_RECEIPT,
    receiptline_nr=T.IntegerType(),
    transaction_type_cd=T.IntegerType(),
    return_fg=T.IntegerType(),
    turnover_relevant_fg=T.IntegerType(),
    receiptline_voided_by=T.IntegerType(),
    ean_barcode=T.StringType(),
    item_sid=T.LongType(),
    sales_piece_qty=_MONEY,
    sales_weight_qty=_MONEY,
    orig_receipt_store_id=T.IntegerType(),
    orig_receipt_register_id=T.IntegerType(),
    orig_receipt_dt=T.DateType(),
    orig_receipt_id=T.LongType(),
)

SUBTOTAL_LINE = _schema(**_RECEIPT, receiptline_nr=T.IntegerType(), cashier_id=T.IntegerType())
PAYMENT = _schema(**_RECEIPT, payment_type=T.IntegerType())
LOCATION = _schema(loc_sid=T.IntegerType(), store_nr=T.IntegerType())
STORE_HOURS = _schema(
    client_id=T.IntegerType(),
    store_nr=T.IntegerType(),
    receipt_date=T.DateType(),
    is_open=T.IntegerType(),
    open_time=T.StringType(),
    close_time=T.StringType(),
)
ORG_STRUCTURE = _schema(
    client_id=T.IntegerType(),
    aspect_id=T.IntegerType(),
    dat_closing=T.DateType(),
    wh_id=T.IntegerType(),
    orig_store_nr=T.StringType(),
    store_desc=T.StringType(),
    account_manager=T.StringType(),
    sales_manager=T.StringType(),
)

PIPELINE_METRICS = _schema(
    run_id=T.StringType(),
    data_name=T.StringType(),
    metric_id=T.StringType(),
    metric_value=T.DoubleType(),
    run_timestamp=T.StringType(),
)

CHECK_LOG = _schema(
    run_id=T.StringType(),
    run_timestamp=T.StringType(),
    task_name=T.StringType(),
    table_name=T.StringType(),
    check_type=T.StringType(),
    check_name=T.StringType(),
    status=T.StringType(),
    message=T.StringType(),
    metric_value=T.DoubleType(),
    metric_text=T.StringType(),
)
