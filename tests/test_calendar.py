from __future__ import annotations

from datetime import date, timedelta

import pytest
from conftest import values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwatch.functions import calendar as c

DAYS = [date(2024, 12, 29), date(2024, 12, 30), date(2025, 1, 1), date(2021, 1, 3), date(2020, 12, 31), date(2024, 2, 29)]


def label(day):
    year, week, _ = day.isocalendar()
    return f"{year}-{week:02d}"


def test_iso_week_uses_the_iso_year(make):
    df = make([(d,) for d in DAYS] + [(None,)], "d date")
    expected = [(None, None)] + sorted((d, label(d)) for d in DAYS)
    assert values(df.select("d", c.iso_week("d").alias("w"))) == expected


def test_calendar_year_week_uses_the_calendar_year(make):
    got = make([(date(2024, 12, 30),)], "d date").select(c.calendar_year_week("d")).first()[0]
    assert got == "2024_01"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.dates(date(1990, 1, 1), date(2060, 1, 1)), st.integers(0, 800)), min_size=1, max_size=20))
def test_ranges_match_plain_python(spark, pairs):
    rows = [(a, a + timedelta(days=n)) for a, n in pairs]
    df = spark.createDataFrame(rows, "a date, b date")
    week = lambda d: F.replace(c.iso_week(d), F.lit("-"), F.lit(""))
    got = df.select(
        "a",
        "b",
        c.days_between("a", "b"),
        c.iso_weeks_between("a", "b"),
        c.weeks_between(week("a"), week("b")),
        c.months_between_incl(F.date_format("a", "yyyy-MM"), F.date_format("b", "yyyy-MM")),
        c.lookback_start("b", 3),
    ).collect()
    for a, b, days, weeks, n_weeks, months, start in got:
        every = list(dict.fromkeys(label(a + timedelta(days=i)).replace("-", "") for i in range((b - a).days + 1)))
        assert days == (b - a).days + 1
        assert weeks == every
        assert n_weeks == len(every)
        assert months == (b.year - a.year) * 12 + b.month - a.month + 1
        assert start == b - timedelta(days=20)


def test_week_and_month_bounds(make):
    df = make([(date(2025, 1, 12),), (date(2025, 3, 31),)], "d date")
    week = df.select(c.week_bounds("d", 2).alias("w")).select("w.*")
    assert values(week) == [
        (date(2024, 12, 23), date(2024, 12, 29)),
        (date(2025, 3, 17), date(2025, 3, 23)),
    ]
    month = df.select(c.month_bounds("d").alias("m")).select("m.*")
    assert values(month) == [
        (date(2025, 1, 1), date(2024, 12, 1), date(2024, 12, 31), "202412"),
        (date(2025, 3, 1), date(2025, 2, 1), date(2025, 2, 28), "202502"),
    ]
    assert df.select(c.nth_day_of_month("d", 14)).first()[0] == date(2025, 1, 14)


def test_period_bounds(make):
    df = make([(date(2025, 1, 20), "GM"), (date(2025, 1, 20), "EZ")], "d date, k string")
    got = df.select("k", c.period_bounds("d", F.col("k")).alias("p")).select("k", "p.*")
    assert values(got) == [
        ("EZ", date(2025, 1, 1), date(2025, 1, 14)),
        ("GM", date(2024, 12, 1), date(2024, 12, 31)),
    ]
    assert df.limit(1).select(c.period_bounds("d", "EZ")["end"]).first()[0] == date(2025, 1, 14)
    with pytest.raises(Exception, match="unknown reporting period: XX"):
        df.select(c.period_bounds("d", "XX")).collect()
