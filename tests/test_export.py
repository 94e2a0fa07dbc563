from __future__ import annotations

import json
from datetime import date

import pytest
from conftest import values
from pyspark.sql import functions as F

from tillwatch.operators import export
from tillwatch.sinks.documents import Document

FLAGS = "iso_week string, store_nr int, cashier_id int, kpi_id int, flag int"
DETAILS = "store_nr int, receipt_date date, receipt_time string, register_id int, cashier_id int, receipt_id long, kpi_id int"
DAY = date(2024, 12, 31)  # ISO week 2025-01


@pytest.fixture
def tables(make):
    flags = make(
        [("2025-01", 9, 5, 3, 2), ("2025-01", 9, 6, 3, 1), ("2025-01", 10, 5, 8, 1), ("2025-02", 9, 5, 3, 1), (None, 9, 5, 3, 1), ("2025-01", None, 5, 3, 1)],
        FLAGS,
    )
    details = make(
        [
            (9, DAY, "10:00:00", 1, 5, 11, 3), (9, DAY, "09:00:00", 1, 6, 12, 3), (9, DAY, "08:00:00", 1, 7, 13, 3),  # 7 is not flagged
            (9, DAY, "10:00:00", 1, 5, 14, 8), (9, date(2025, 1, 7), "10:00:00", 2, 5, 15, 3), (10, DAY, "10:00:00", 1, 6, 16, 8),
        ],
        DETAILS,
    )
    return flags, details


def receipt(at, till, cashier, nr):
    return {"OccurrenceDateTime": at, "TillNr": till, "ServicerID": cashier, "ReceiptNr": nr}


STORE_9 = {
    "StoreID": "9",
    "KPI": [
        {
            "KPITypeID": 3,
            "Anomalies": [{"ServicerID": 5, "AnomalyGrade": 2}, {"ServicerID": 6, "AnomalyGrade": 1}],
            "Receipts": [receipt("2024-12-31 09:00:00", 1, 6, "12"), receipt("2024-12-31 10:00:00", 1, 5, "11")],
        }
    ],
}
STORE_10 = {"StoreID": "10", "KPI": [{"KPITypeID": 8, "Anomalies": [{"ServicerID": 5, "AnomalyGrade": 1}], "Receipts": []}]}
WEEK_1 = {"year": 2025, "weeknumber": 1, "evaluation": [STORE_9, STORE_10]}
BY_STORE = [{**WEEK_1, "evaluation": [STORE_9]}, {**WEEK_1, "evaluation": [STORE_10]}]
WEEK_2 = {
    "year": 2025,
    "weeknumber": 2,
    "evaluation": [
        {
            "StoreID": "9",
            "KPI": [
                {"KPITypeID": 3, "Anomalies": [{"ServicerID": 5, "AnomalyGrade": 1}], "Receipts": [receipt("2025-01-07 10:00:00", 2, 5, "15")]}
            ],
        }
    ],
}


def documents(df):
    return sorted((json.loads(r["value"]) for r in df.collect()), key=lambda d: (d["weeknumber"], int(d["evaluation"][0]["StoreID"])))


def test_evidence(make, tables):
    flags, details = tables
    proof = export.evidence(details)
    assert (proof.first()["year"], proof.first()["weeknumber"], proof.first()["iso_week"]) == (2025, 1, "2025-01")
    assert values(export.flagged_evidence(flags, proof), "ReceiptNr") == [("11",), ("12",), ("15",)]


def test_weekly_documents(tables):
    assert documents(export.document_json(export.weekly_documents(*tables))) == [*BY_STORE, WEEK_2]
    assert documents(export.document_json(export.weekly_documents(*tables, grain="week"))) == [WEEK_1, WEEK_2]  # stores by number, not as text
    assert documents(export.document_json(export.weekly_documents(*tables, grain="kpi"))) == [*BY_STORE, WEEK_2]


@pytest.mark.parametrize("entries", [10, 100_000])
def test_documents_have_one_form_at_any_size(spark, make, entries):
    flags = make([("2025-01", s, c, k, 1 + c % 2) for s in range(1, 5) for c in range(3) for k in (1, 2)], FLAGS)
    details = spark.range(entries).selectExpr(
        "CAST(id % 4 + 1 AS INT) store_nr", "DATE'2024-12-31' receipt_date", "'10:00:00' receipt_time", "1 register_id", "CAST(id % 3 AS INT) cashier_id", "id receipt_id", "CAST(id % 2 + 1 AS INT) kpi_id"
    )
    for grain, n in (("week", 1), ("store", 4), ("kpi", 8)):
        docs = documents(export.document_json(export.weekly_documents(flags, details, grain)))
        assert len(docs) == n and all(list(d) == ["year", "weeknumber", "evaluation"] for d in docs)
        kpis = [k for d in docs for s in d["evaluation"] for k in s["KPI"]]
        assert sum(len(k["Receipts"]) for k in kpis) == entries and sum(len(k["Anomalies"]) for k in kpis) == 24


@pytest.mark.parametrize("pretty", [False, True])
def test_written_documents(spark, tables, tmp_path, pretty):
    docs, path = export.weekly_documents(*tables, grain="week"), str(tmp_path / "out")
    export.write_documents(docs, path, pretty)
    export.write_documents(docs.filter("weeknumber = 2"), path, pretty)  # leaves week 1 alone
    folders = sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir())
    assert folders == ["document=dbp_2025_1.json", "document=dbp_2025_2.json"]
    texts = ["".join(f.read_text() for f in (tmp_path / "out" / d).glob("part-*")) for d in folders]
    assert [json.loads(t) for t in texts] == [WEEK_1, WEEK_2]
    assert ("\n  " in texts[0]) == pretty


def test_finer_grains_part_receipts_and_keep_flags_together(tables):
    for grain in ("day", "register"):
        got = documents(export.document_json(export.weekly_documents(*tables, grain=grain)))
        kpis = [(d["weeknumber"], s["StoreID"], k["KPITypeID"], len(k["Anomalies"]), len(k["Receipts"])) for d in got for s in d["evaluation"] for k in s["KPI"]]
        # flags of a week, store and KPI stand in one document without receipts, each receipt in one of its day or register
        assert sorted(k for k in kpis if k[3]) == [(1, "10", 8, 1, 0), (1, "9", 3, 2, 0), (2, "9", 3, 1, 0)]
        assert sorted(k for k in kpis if k[4]) == [(1, "9", 3, 0, 2), (2, "9", 3, 0, 1)]


@pytest.mark.parametrize("indent", [None, 4])
def test_named_documents(spark, tables, tmp_path, indent):
    flags, details = tables
    path = str(tmp_path / "out")
    export.write_named_documents(flags, details, path, indent)
    export.write_named_documents(flags.where("iso_week = '2025-02'"), details, path, indent)  # leaves week 1 alone
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_file()) == ["dbp_2025_1.json", "dbp_2025_2.json"]
    for name, week in (("dbp_2025_1.json", WEEK_1), ("dbp_2025_2.json", WEEK_2)):
        separators = (",", ":") if indent is None else None
        assert (tmp_path / "out" / name).read_text() == json.dumps(week, indent=indent, separators=separators)
    export.write_named_documents(flags.limit(0), details, path, indent)
    assert len([p for p in (tmp_path / "out").iterdir() if p.is_file()]) == 2


def test_a_document_needs_no_memory_for_its_entries():
    """A store with very many receipts: what is held between two entries is the place in the document."""
    pieces = []

    def write(text):
        assert len(text) < 200
        pieces.append(len(text))

    doc = Document(write, 2025, 2, None)
    for i in range(200_000):
        doc.add(1 + i // 150_000, 3, 1, '{"ReceiptNr":"1"}')
    assert not any(isinstance(v, (list, dict)) or (isinstance(v, str) and len(v) > 50) for v in vars(doc).values())
    doc.end()
    assert sum(pieces) > 3_000_000


def test_a_failed_task_leaves_the_old_document(spark, tables, tmp_path):
    flags, details = tables
    path = str(tmp_path / "out")
    export.write_named_documents(flags, details, path)
    before = (tmp_path / "out" / "dbp_2025_1.json").read_bytes()
    fails = F.when(F.col("cashier_id") == 6, F.raise_error(F.lit("broken"))).otherwise(F.lit(1)).cast("int")
    with pytest.raises(Exception, match="broken"):
        export.write_named_documents(flags.withColumn("flag", fails), details, path)
    assert (tmp_path / "out" / "dbp_2025_1.json").read_bytes() == before
    assert not list((tmp_path / "out" / "_staged").glob("*"))
