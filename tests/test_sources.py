from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, WriterCommitMessage

from tillwatch import model
from tillwatch.functions.keys import in_scope, receipt_key
from tillwatch.params import Params
from tillwatch.sinks import tables
from tillwatch.sinks.store import Store, TableNotFound
from tillwatch.sources import extracts, readers

P = Params(client_id=4, start_date="2025-01-06", end_date="2025-01-12")
DAY = date(2025, 1, 7)
AT = datetime(2025, 1, 7, 8, 5, 9)


def header(receipt, **changes):
    row = dict(loc_sid=1, client_id=4, register_id=2, receipt_date=DAY, receipt_ts=AT, receipt_id=receipt,
               transaction_type_cd=100, cnt_receiptlines_sales=1, cnt_receiptlines_voids=0, turnover_relevant_fg=1,
               cashier_id=5, total_gross_val=Decimal("1.00"))
    return tuple((row | changes)[c] for c in model.RECEIPT_HEADER.names)


def line(receipt, **changes):
    row = dict(loc_sid=1, client_id=4, register_id=2, receipt_date=DAY, receipt_ts=AT, receipt_id=receipt,
               receiptline_nr=1, transaction_type_cd=101, return_fg=0, turnover_relevant_fg=1,
               receiptline_voided_by=None, ean_barcode="E1", item_sid=1, sales_piece_qty=Decimal(1),
               sales_weight_qty=Decimal(1), orig_receipt_store_id=None, orig_receipt_register_id=None,
               orig_receipt_dt=None, orig_receipt_id=None)
    return tuple((row | changes)[c] for c in model.RECEIPT_LINE.names)


@pytest.fixture
def location(make):
    return make([(1, 101), (2, 99), (3, 500), (4, 501)], model.LOCATION)


def test_key_is_null_when_any_part_is(make):
    parts = ["loc_sid", "client_id", "register_id", "receipt_date", "receipt_ts", "receipt_id"]
    rows = [header(1), *[header(1, **{part: None}) for part in parts]]
    got = [r[0] for r in make(rows, model.RECEIPT_HEADER).select(receipt_key()).collect()]
    assert got == ["1_4_2_20250107_080509_1"] + [None] * 6


def test_scope_boundaries(make):
    rows = [(4, d, s) for d in (date(2025, 1, 5), date(2025, 1, 6), date(2025, 1, 12), date(2025, 1, 13)) for s in (99, 100, 500, 501)]
    df = make([*rows, (5, DAY, 100), (None, DAY, 100), (4, None, 100), (4, DAY, None)], "client_id int, receipt_date date, store_nr int")
    kept = [(4, date(2025, 1, 6), 100), (4, date(2025, 1, 6), 500), (4, date(2025, 1, 12), 100), (4, date(2025, 1, 12), 500)]
    assert values(in_scope(df, P)) == sorted(kept)
    assert values(in_scope(df, P.with_(stores=(501,))), "store_nr") == [(501,), (501,)]


def test_headers_and_lines(make, location):
    headers = make([header(1), header(2, loc_sid=2), header(3, loc_sid=3, register_id=80), header(4, loc_sid=9)], model.RECEIPT_HEADER)
    got = extracts.receipt_headers(headers, location, P)
    assert values(got, "receipt_id", "store_nr", "register_id") == [(1, 101, 2), (3, 500, 80)]
    lines = make(
        [line(1), line(2, receiptline_voided_by=3), line(3, receiptline_voided_by=0), line(4, register_id=80), line(5, turnover_relevant_fg=0)],
        model.RECEIPT_LINE,
    )
    got = extracts.receipt_lines(lines, location, P).select(F.split("transaction_id", "_")[5].alias("r"), "void_fg")
    assert values(got) == [("1", None), ("2", 1), ("3", 0)]


def test_cash_only(make, location):
    def pay(receipt, kind, register=2):
        return (1, 4, register, DAY, AT, receipt, kind)

    rows = [pay(1, 11), pay(1, 11), pay(2, 11), pay(2, 12), pay(3, 12), pay(4, 11, 80), pay(5, None), pay(6, 11), pay(6, None)]
    got = extracts.cash_only_receipts(make(rows, model.PAYMENT), location, P)
    assert [r[0].split("_")[-1] for r in sorted(got.collect())] == ["1", "6"]


def test_return_receipts_keep_one_row_per_line(make, location):
    headers = make([header(1, total_gross_val=Decimal("-8.00")), header(2)], model.RECEIPT_HEADER)
    lines = make([line(1, return_fg=1), line(1, return_fg=1, receiptline_nr=2), line(2)], model.RECEIPT_LINE)
    got = extracts.return_receipts(headers, lines, location, P)
    assert values(got, "receipt_id", "total_gross_val") == [(1, Decimal("-8.00"))] * 2


def test_returns_without_original(make, location):
    def back(receipt, original, **changes):
        ref = dict(orig_receipt_store_id=101, orig_receipt_register_id=2, orig_receipt_dt=original[1], orig_receipt_id=original[0])
        return line(receipt, return_fg=1, transaction_type_cd=150, **(ref | changes))

    def sold(receipt, day, **changes):
        return line(receipt, receipt_date=day, **changes)

    recent, limit, old = date(2025, 1, 1), date(2024, 10, 8), date(2024, 10, 7)  # 6, 91 and 92 days before
    lines = [
        back(1, (11, recent)), sold(11, recent),
        back(2, (12, limit)), sold(12, limit),
        back(3, (13, old)), sold(13, old),
        back(4, (14, recent)),                                            # never sold
        back(5, (15, recent)), sold(15, recent, receiptline_voided_by=2),  # voided
        back(6, (16, recent)), sold(16, recent, item_sid=2),               # another article
        back(7, (17, recent)), sold(17, recent, sales_piece_qty=None),     # no quantity
        back(8, (None, None), orig_receipt_store_id=None, orig_receipt_register_id=None),
        back(9, (19, recent)), sold(19, recent), sold(19, recent, receiptline_nr=2),  # sold in two lines
        back(10, (123, recent), orig_receipt_register_id=1), sold(23, recent, register_id=11),  # digits run together
        back(11, (21, recent)), back(11, (22, recent)), sold(21, recent),  # one of two lines
    ]
    headers = make([header(i) for i in range(1, 12)], model.RECEIPT_HEADER)
    got = extracts.returns_without_original(headers, make(lines, model.RECEIPT_LINE), location, P)
    assert [r[0] for r in values(got, "receipt_id")] == [3, 4, 5, 6, 7, 8, 10, 11]


def test_store_org(make):
    def org(nr, wh=5, client=4, aspect=2, closed=None):
        return (client, aspect, closed, wh, nr, f"S{nr}", "acc", "boss")

    rows = [org("100"), org("101", 6), org("500", 7), org("501"), org("102", aspect=1), org("103", closed=DAY), org("104", client=5)]
    got = extracts.store_org(make(rows, model.ORG_STRUCTURE), P)
    assert values(got, "store_nr", "company", "region_manager", "sales_manager") == [
        (100, "WEI", "boss", "boss"), (101, "SEZ", "boss", "boss"), (500, "OTHER", "boss", "boss")
    ]


def test_cast_columns(make):
    df = make([("1", "true", "x")], "A string, B string, c string")
    got = readers.cast_columns(df, {"int_columns": ["a"], "boolean_columns": ["B"]})
    assert got.dtypes == [("a", "int"), ("b", "boolean"), ("c", "string")]
    assert values(readers.cast_columns(df, {"int_columns": ["c"]}, lenient=True), "c") == [(None,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.cast_columns(df, {"int_columns": ["c"]}).collect()


def test_load_table_and_paths(spark, make, tmp_path):
    store = Store(f"{tmp_path}/working", f"{tmp_path}/historical", "no_such_schema")
    assert readers.load_table(spark, store, "t") is None
    assert readers.load_table(spark, store, "t", "quality") is None
    with pytest.raises(TableNotFound):
        readers.load_table(spark, store, "t", required=True)
    with pytest.raises(ValueError):
        readers.load_table(spark, store, "t", "elsewhere")
    tables.save_table(make([(1,)], "n int"), store, "t")
    assert values(readers.load_table(spark, store, "t")) == [(1,)]
    with pytest.raises(ValueError):
        readers.read_path(spark, f"{tmp_path}/working/t", prefixes=["s3://"])
    assert readers.read_path(spark, f"{tmp_path}/working/t", prefixes=[str(tmp_path)]).count() == 1


def test_csv_with_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n,t\n1,x\n2,"y, z"\n')
    assert values(readers.read_csv(spark, str(tmp_path / "a.csv"), "n int, t string")) == [(1, "x"), (2, "y, z")]


def echo_warehouse():
    """A source class the workers get by value, as this module is not on their path."""
    SPLIT = ("dbtable", "partitioncolumn", "lowerbound", "upperbound", "numpartitions")

    class EchoWarehouse(DataSource):
        """Stands in for a warehouse: reading answers with the query it was given."""

        @classmethod
        def name(cls):
            return "echo_warehouse"

        def schema(self):
            return "QUERY string, User string"

        def reader(self, schema):
            options = dict(self.options)

            class Reader(DataSourceReader):
                def read(self, partition):
                    yield options.get("query") or " ".join(f"{k}={options[k]}" for k in SPLIT), options["user"]

            return Reader()

        def writer(self, schema, overwrite):
            options = dict(self.options)

            class Writer(DataSourceWriter):
                def write(self, rows):
                    with open(options["target"], "a") as out:
                        out.writelines(f"{options['dbtable']} {overwrite} {row[0]}\n" for row in rows)
                    return WriterCommitMessage()

            return Writer()

    return EchoWarehouse


def test_query_pushdown_and_external_write(spark, make, tmp_path):
    spark.dataSource.register(echo_warehouse())
    got = readers.read_query(spark, "echo_warehouse", {"user": "me"}, "SELECT 1")
    assert got.columns == ["query", "user"]
    assert values(got) == [("SELECT 1", "me")]
    parts = readers.read_query(spark, "echo_warehouse", {"user": "me"}, "SELECT 1", ("day", "2025-01-06", "2025-01-12", 7))
    assert values(parts, "query") == [
        ("dbtable=(SELECT 1) result partitioncolumn=day lowerbound=2025-01-06 upperbound=2025-01-12 numpartitions=7",)
    ]
    target = tmp_path / "out.txt"
    tables.write_external(make([("a",)], "t string").coalesce(1), "echo_warehouse", {"target": str(target)}, "dest")
    assert target.read_text() == "dest True a\n"
