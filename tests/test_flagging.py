from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import values

from tillwatch.operators import flagging
from tillwatch.params import KpiRule, Params

P = Params(client_id=4, start_date="2025-01-06", end_date="2025-01-12")
METRIC = "store_nr int, receipt_date date, receipt_ts timestamp_ntz, register_id int, cashier_id int, receipt_id long"
ORG = "company string, store_nr int, store_desc string, account_manager string, region_manager string, sales_manager string"
BASE = "store_nr int, iso_week string, kpi_id int, cashier_id int, kpi_count long, total_receipts long"


def test_merge_and_count(make):
    day = date(2024, 12, 30)
    a = make([(1, day, datetime(2024, 12, 30, 9, 5, 1), 2, 3, 10), (1, day, datetime(2024, 12, 30, 9, 6), 2, 3, None)], METRIC)
    b = make([(1, day, datetime(2024, 12, 30, 9, 5, 1), 2, 3, 2**40)], METRIC).select(
        "receipt_id", "cashier_id", "register_id", "receipt_ts", "receipt_date", "store_nr"
    )
    merged = flagging.merge_anomalies({3: a, 7: b})
    assert set(values(merged, "kpi_id", "receipt_time", "receipt_id")) == {(3, "09:05:01", 10), (3, "09:06:00", None), (7, "09:05:01", 2**40)}
    assert values(flagging.kpi_counts(merged)) == [(1, "2025-01", 3, 3, 1), (1, "2025-01", 7, 3, 1)]
    with pytest.raises(ValueError):
        flagging.merge_anomalies({})


def test_eligibility_is_strict_and_drops_unknown_activity(make):
    rows = [(1, "w", 1, 1, 1, 30), (1, "w", 1, 2, 1, 31), (1, "w", 1, 3, 1, None), (1, "w", 4, 2, 1, 31), (1, "w", 4, 4, 2, 31), (1, "w", 9, 4, 2, 31), (1, "w", 9, 5, 3, 31)]
    assert values(flagging.eligible(make(rows, BASE), P), "kpi_id", "cashier_id") == [(1, 2), (4, 4), (9, 5)]
    assert flagging.eligible(make(rows, BASE), P.with_(min_counts={})).count() == 5
    largest = max(P.min_counts.values())
    no_kpi = make([(1, "w", None, 1, largest - 1, 31), (1, "w", None, 2, largest, 31)], BASE)
    assert values(flagging.eligible(no_kpi, P), "cashier_id") == [(2,)]


def test_activity_is_joined_on_all_three_keys(make):
    counts = make([(1, "w1", 1, 5, 2), (2, "w1", 1, 5, 2)], "store_nr int, iso_week string, kpi_id int, cashier_id int, kpi_count long")
    stats = make([(1, 5, "w1", 40), (2, 5, "w2", 50)], "store_nr int, cashier_id int, iso_week string, total_receipts long")
    assert values(flagging.with_activity(counts, stats), "store_nr", "total_receipts") == [(1, 40), (2, None)]


def test_rates_and_weights(make):
    rows = [(1, "w", 1, 1, 5, 50), (1, "w", 2, 1, 5, 50), (1, "w", 3, 1, 5, 50), (1, "w", 99, 1, 5, 0)]
    assert values(flagging.normalise(make(rows, BASE), P), "kpi_id", "kpi_rate", "kpi_score") == [
        (1, 10.0, 500.0), (2, 10.0, 1000.0), (3, 10.0, 10.0), (99, None, None)
    ]
    free = P.with_(rules={1: KpiRule(weight=0)})
    assert values(flagging.normalise(make(rows[:1], BASE), free), "kpi_score") == [(10.0 * free.default_weight,)]
    unknown = make([(1, "w", 99, 1, 5, 50)], BASE)
    assert values(flagging.normalise(unknown, P), "kpi_rate", "kpi_score") == [(10.0, None)]


def test_thresholds(make):
    rows = [(n, "w", k, n, n, 100) for k in (1, 3, 7) for n in range(1, 101)] + [(n, "w", 9, n, n, 100) for n in range(1, 10)]
    limits = flagging.thresholds(flagging.normalise(make(rows, BASE), P), P)
    assert values(limits, "kpi_id", "orange_threshold", "red_threshold", "population") == [
        (1, 90.0, None, 100), (3, 85.0, 97.0, 100), (7, 88.0, None, 100), (9, 9.0, 9.0, 9)
    ]
    assert values(flagging.robust(limits, P), "kpi_id", "orange_threshold", "red_threshold") == [
        (1, 90.0, None), (3, 85.0, 97.0), (7, 88.0, None), (9, None, None)
    ]
    many = make([(n, "w", 3, n, n % 7, 100) for n in range(1, 3001)] + [(1, "w", 5, 1, 1, 0)], BASE)
    exact = sorted(n % 7 for n in range(1, 3001))
    assert values(flagging.thresholds(flagging.normalise(many, P), P), "orange_threshold", "red_threshold", "population") == [
        (None, None, 1), (float(exact[85 * 30 - 1]), float(exact[97 * 30 - 1]), 3000)
    ]
    zero = make([("w", 3, 0.0, -1.0, 50)], "iso_week string, kpi_id int, orange_threshold double, red_threshold double, population long")
    assert values(flagging.robust(zero, P), "orange_threshold", "red_threshold") == [(None, None)]


def test_absolute_flags(make):
    rows = [(1, "w", 1, 1, 4, 50), (1, "w", 1, 2, 5, 50), (1, "w", 3, 3, 500, 50)]
    assert values(flagging.absolute_flags(make(rows, BASE), P), "cashier_id", "absolute_flag") == [(1, None), (2, 1), (3, None)]
    none = P.with_(rules={})
    assert values(flagging.absolute_flags(make(rows, BASE), none), "absolute_flag") == [(None,)] * 3


def test_region_quota_truncates_and_groups_missing_regions(make):
    org = make([("c", n, "s", "a", r, r) for n, r in [(1, "x"), (2, "x"), (3, "x"), (4, "y"), (5, None), (6, None)]], ORG)
    got = flagging.region_quota(org, P.with_(avg_red_flags_per_store=0.9))
    assert values(got, "store_nr", "max_red_flags") == [(1, 2), (2, 2), (3, 2), (4, 0), (5, 1), (6, 1)]


def test_levels(make):
    schema = "absolute_flag int, kpi_rate double, red_threshold double, orange_threshold double"
    rows = [(1, 1.0, 9.0, 9.0), (None, 5.0, 5.0, 1.0), (None, 4.9, 5.0, 4.9), (None, 1.0, 5.0, 2.0), (None, 9.0, None, None), (None, 9.0, None, 9.0)]
    assert [r["level"] for r in flagging.initial_level(make(rows, schema)).collect()] == [3, 2, 1, None, None, 1]


def ranked_rows(make, rows):
    """(store, region, level, score, quota) per cashier, in one week."""
    full = [("w", s, n, 1, r, lv, sc, q) for n, (s, r, lv, sc, q) in enumerate(rows)]
    return make(full, "iso_week string, store_nr int, cashier_id int, kpi_id int, region_manager string, level int, kpi_score double, max_red_flags int")


def test_ranks_share_ties_and_put_missing_levels_last(make):
    rows = [(1, "x", 3, 1.0, 2), (1, "x", 2, 9.0, 2), (1, "x", 2, 9.0, 2), (2, "x", 1, 50.0, 2), (2, "x", None, 99.0, 2), (3, None, None, 1.0, None), (4, None, 2, 1.0, None)]
    got = flagging.rank_flags(ranked_rows(make, rows))
    assert values(got, "cashier_id", "region_rank", "store_rank") == [
        (0, 1, 1), (1, 2, 2), (2, 2, 2), (3, 4, 1), (4, 5, 2), (5, 2, 1), (6, 1, 1)
    ]


def test_final_flags(make):
    rows = [
        (1, "x", 3, 1.0, 2), (1, "x", 3, 0.5, 2), (1, "x", 2, 9.0, 2),  # absolutes use the quota up
        (2, "x", 1, 50.0, 2), (2, "x", None, 99.0, 2),
        (3, None, 2, 5.0, None),                                       # no region: never statistically red
        (4, "y", 2, 7.0, 1), (4, "y", 2, 6.0, 1), (4, "y", 2, 6.0, 1), (4, "y", None, 6.0, 1),
    ]
    ranked = flagging.rank_flags(ranked_rows(make, rows))
    two = P.with_(num_flags_per_store=2)
    assert values(flagging.final_flags(ranked, two), "cashier_id", "flag") == [
        (0, 2), (1, 2), (3, 1), (4, 1), (5, 1), (6, 2), (7, 1), (8, 1)
    ]
    strict = two.with_(orange_requires_level=True)
    assert values(flagging.final_flags(ranked, strict), "cashier_id", "flag") == [
        (0, 2), (1, 2), (3, 1), (5, 1), (6, 2), (7, 1), (8, 1)
    ]
