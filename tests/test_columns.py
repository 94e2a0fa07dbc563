from __future__ import annotations

from datetime import date

import pytest
from conftest import values
from pyspark.sql import functions as F

from tillwatch.functions import columns as c
from tillwatch.model import KPI_NAMES
from tillwatch.params import KpiRule, Params, previous_week


def test_lookup_misses_are_null(make):
    df = make([(1,), (2,), (None,)], "k int")
    assert values(df.select("k", c.lookup(F.col("k"), {1: "a"}, "string").alias("v"))) == [
        (None, None), (1, "a"), (2, None)
    ]
    assert df.select(c.lookup(F.col("k"), {}, "double")).dtypes[0][1] == "double"


def test_kpi_names_and_ids(make):
    df = make([(k,) for k in KPI_NAMES], "k int").select("k", c.kpi_name(F.col("k")).alias("name"))
    assert all(k == i for k, i in df.select("k", c.kpi_id_of(F.col("name"))).collect())
    odd = make([("KPI_123: Name",), ("KPI_7",), ("12",), ("Name",)], "n string")
    assert [r[0] for r in odd.select(c.kpi_id_of(F.col("n"))).collect()] == [123, 7, 12, None]


def test_client_id(make):
    df = make([("ch",), ("INT",), ("Rs",)], "code string")
    assert [r[0] for r in df.select(c.client_id(F.col("code"))).collect()] == [4, 7, 34]
    with pytest.raises(Exception, match="unknown country code: XX"):
        make([("XX",)], "code string").select(c.client_id(F.col("code"))).collect()
    with pytest.raises(Exception, match="unknown country code"):
        make([(None,)], "code string").select(c.client_id(F.col("code"))).collect()


def test_reindex_keeps_duplicates_and_fills_numbers(make):
    df = make([("a", 1, "x"), ("a", 2, "y"), ("z", 3, "z")], "k string, n int, t string")
    assert values(c.reindex(df, ["a", "b"], "k")) == [("a", 1, "x"), ("a", 2, "y"), ("b", 0, None)]


def test_percent_of_total(make):
    df = make([(1,), (3,), (None,)], "v int")
    assert values(c.percent_of_total(df, "v")) == [(None, None), (1, 25.0), (3, 75.0)]
    zero = make([(0,), (0,)], "v int")
    assert values(c.percent_of_total(zero, "v")) == [(0, 0.0), (0, 0.0)]
    negative = make([(-3,), (1,)], "v int")
    assert values(c.percent_of_total(negative, "v"), "percent") == [(0.0,), (0.0,)]


def test_static_columns(make):
    assert values(c.add_static_columns(make([(1,)], "v int"), {"a": "x", "b": 2})) == [(1, "x", 2)]


def test_params():
    assert previous_week(date(2025, 1, 15)) == (date(2025, 1, 6), date(2025, 1, 12))
    p = Params(client_id=4, start_date="2025-01-06", end_date="2025-01-12")
    assert p.start_date == date(2025, 1, 6)
    assert (p.end_date - Params(client_id=4).start_date).days is not None
    assert p.red_probability(2) == 0.92 and p.red_probability(9) == 0.95 and p.orange_probability(7) == 0.88
    assert p.weight(6) == 100 and p.with_(rules={6: KpiRule(weight=0)}).weight(6) == 100
    for bad in ({"start_date": "2025-1-6"}, {"start_date": "06.01.2025"}, {"start_date": "2025-02-01", "end_date": "2025-01-01"}):
        with pytest.raises(ValueError):
            Params(client_id=4, **bad)
    with pytest.raises(ValueError):
        Params(client_id=None)
