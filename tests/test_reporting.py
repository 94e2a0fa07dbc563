from __future__ import annotations

from datetime import date

from conftest import values

from tillwatch.model import KPI_LABELS, TOTAL
from tillwatch.operators import reporting as r
from tillwatch.sinks.store import Run

DETAILS = "store_nr int, receipt_date date, cashier_id int, receipt_id long, kpi_id int, run_id string"
FLAGS = "iso_week string, store_nr int, cashier_id int, kpi_id int, flag int, run_id string"
ANOMS = "iso_week string, store_nr int, kpi_id int, cashier_id int, receipt_id long, region_manager string"


def test_history_is_matched_by_lower_case_name(make):
    now = make([(1, "x")], "STORE_NR int, extra string")
    before = make([(7, "r0", "t0")], "Store_Nr int, run_id string, run_timestamp string")
    got = r.with_history(now, before, Run("r1", "t1"))
    assert values(got, "store_nr", "run_id", "run_timestamp", "extra") == [(1, "r1", "t1", "x"), (7, "r0", "t0", None)]
    assert values(r.with_history(now, None, Run("r1", "t1"))) == [(1, "x", "r1", "t1")]


def test_weeks_of_runs(make):
    details = make([(1, date(2025, 1, 14), 1, 1, 1, "a"), (1, date(2025, 1, 7), 1, 2, 1, "a"), (1, date(2025, 1, 8), 1, 3, 1, "c")], DETAILS)
    flags = make([("2025-09", 1, 1, 1, 2, "a"), ("2025-05", 1, 1, 1, 2, "b")], FLAGS)
    weeks = r.run_weeks(details, flags)
    assert values(weeks) == [("a", "2025-02"), ("b", "2025-05"), ("c", "2025-02")]
    assert values(r.inconsistent_runs(details, flags)) == [("a", 3)]
    attached = r.attach_week(flags, weeks)
    assert values(attached, "run_id", "iso_week") == [("a", "2025-02"), ("b", "2025-05")]
    assert values(r.inconsistent_weeks(r.attach_week(details, weeks))) == [("2025-02", 2)]


def test_common_weeks(make):
    weeks = lambda *w: make([(x,) for x in w] * 2, "iso_week string")
    a, b, c = weeks("1", "2", "3", "4"), weeks("2", "3", "4", "5"), weeks("1", "2", "3", "4")
    assert values(r.common_weeks(a, b, c, 2)) == [("3",), ("4",)]
    assert values(r.common_weeks(a, b, c, 9)) == [("2",), ("3",), ("4",)]
    assert values(r.in_weeks(b, r.common_weeks(a, b, c, 1))) == [("4",), ("4",)]


REGIONS = [("w1", 1, "x"), ("w1", 2, "x"), ("w1", 3, "y"), ("w2", 1, "y"), ("w2", 9, None)]


def dense(make):
    regions = make(REGIONS, "iso_week string, store_nr int, region_manager string")
    flags = [("w1", 1, 1, 3, 2), ("w1", 1, 2, 3, 2), ("w1", 1, 3, 3, 1), ("w1", 2, 1, 10, 2), ("w2", 1, 1, 3, 2), ("w2", 7, 1, 3, 2)]
    flags = make(flags, "iso_week string, store_nr int, cashier_id int, kpi_id int, flag int")
    flagged = r.flags_with_region(flags, regions)
    assert flagged.count() == 5  # store 7 has no region
    return r.dense_flag_counts(flagged, regions), flagged


def test_dense_counts_hold_every_store_kpi_and_colour(make):
    counts, flagged = dense(make)
    assert counts.count() == len(REGIONS) * 10 * 2
    assert counts.agg({"flag_count": "sum"}).first()[0] == flagged.count()
    assert values(counts.filter("flag_count > 1"), "store_nr", "kpi_id", "flag", "flag_count") == [(1, 3, 2, 2)]
    per_region = r.flag_counts(counts, "region_manager")
    assert values(per_region, "iso_week", "region_manager", "count_red", "count_orange", "count_all") == [
        ("w1", "x", 3, 1, 4), ("w1", "y", 0, 0, 0), ("w2", "y", 1, 0, 1)
    ]
    histogram = r.flag_histogram(r.flag_counts(counts, "store_nr"))
    assert values(histogram.filter("kind = 'count_red'")) == [("count_red", 0, 2), ("count_red", 1, 2), ("count_red", 2, 1)]
    last = r.flag_histogram(r.flag_counts(counts, "store_nr"), last_only=True)
    assert values(last.filter("kind = 'count_all'")) == [("count_all", 0, 1), ("count_all", 1, 1)]


def test_statistics(make):
    counts, _ = dense(make)
    totals = r.add_total_rows(counts, ["iso_week", "region_manager", "store_nr", "flag"])
    assert values(totals.filter(f"kpi = '{TOTAL}' AND flag = 2 AND flag_count > 0"), "iso_week", "store_nr", "flag_count") == [
        ("w1", 1, 2), ("w1", 2, 1), ("w2", 1, 1)
    ]
    stats = r.weekly_flag_stats(counts)
    assert stats.columns == ["metric", "iso_week", *KPI_LABELS, TOTAL]
    assert stats.count() == 2 * 2 * 9
    red = {m: v for m, v in values(stats.filter("iso_week = 'w1' AND metric LIKE '% rot %'"), "metric", TOTAL)}
    assert {k.removeprefix("Anzahl Bediener rot | "): v for k, v in red.items()} == {
        "Landesweit": 3.0, "⌀ Filiale": 1.0, "Median Filiale": 1.0, "Max Filiale": 2.0, "Min Filiale": 0.0,
        "⌀ RL": 1.5, "Median RL": 1.5, "Max RL": 3.0, "Min RL": 0.0,
    }
    total = r.total_flag_stats(counts)
    nationwide = values(total.filter("metric LIKE '%rot | Landesweit'"), "KPI_03", "KPI_10", TOTAL)
    # Store 1 changes region: two flags a week under x, one under y.
    assert nationwide == [(3.0, 1.0, 4.0)]
    melted = r.melt_stats(total)
    assert melted.count() == 18 * 11 and melted.columns == ["metric", "kpi", "value"]


def test_distribution_is_joined_by_colour(make):
    rows = [(f"Anzahl Bediener {c} | Landesweit", *[v] * 10, 10 * v) for c, v in (("rot", 28.0), ("orange", 65.0))]
    rows.append(("Anzahl Bediener rot | ⌀ RL", *[9.0] * 10, 90.0))
    stats = make(rows, "metric string, " + ", ".join(f"{k} double" for k in [*KPI_LABELS, TOTAL]))
    got = r.flag_distribution(stats)
    assert values(got, "metric", "total", "mean", "target", "mape") == [
        ("Anzahl Bediener orange | Landesweit", 650.0, 65.0, 130.0, 50.0), ("Anzahl Bediener rot | Landesweit", 280.0, 28.0, 56.0, 50.0)
    ]


def test_anomaly_statistics(make):
    rows = [("w1", 1, 1, 5, 100), ("w1", 1, 2, 5, 100), ("w1", 2, 1, 6, 100), ("w1", 2, 1, 6, 101), ("w2", 1, 1, 5, 200)]
    anoms = make([(*row, "x") for row in rows], ANOMS)
    assert values(r.anomalous_receipts_per_week(anoms)) == [("w1", 2), ("w2", 1)]
    assert values(r.anomalous_receipts_per_week(anoms, by_receipt_key=True)) == [("w1", 3), ("w2", 1)]
    assert values(r.anomalies_per_week(anoms)) == [("w1", 1, 3), ("w1", 2, 1), ("w2", 1, 1)]
    assert values(r.anomalies_per_store(anoms)) == [("w1", 1, 2), ("w1", 2, 2), ("w2", 1, 1)]
    assert values(r.anomaly_overview(anoms)) == [(1, 3, 75.0), (2, 1, 25.0)]
    assert values(r.anomaly_overview(anoms, by_receipt_key=True)) == [(1, 4, 80.0), (2, 1, 20.0)]
    assert values(r.anomaly_totals(anoms)) == [(4, 3)]
    assert values(r.anomaly_totals(anoms, by_receipt_key=True)) == [(5, 4)]
    assert values(r.box_summary(r.anomalies_per_store(anoms), "iso_week", "anomalies")) == [
        ("w1", 2.0, 2.0, 2.0, 2.0, 2.0), ("w2", 1.0, 1.0, 1.0, 1.0, 1.0)
    ]
    trend = values(r.weekly_trend(anoms))
    assert ("w1", "KPI_01", 3) in trend and ("w1", r.ALL_ANOMALIES, 4) in trend and ("w1", r.ALL_RECEIPTS, 2) in trend
    flags = make([("w1", 2), ("w1", 2), ("w2", 2), ("w1", 1)], "iso_week string, flag int")
    assert set(values(r.headline(anoms, flags))) == {
        (r.HEADLINES["anomalies"], "w2", 1, -3), (r.HEADLINES["receipts"], "w2", 1, -1),
        (r.HEADLINES["red"], "w2", 1, -1), (r.HEADLINES["orange"], "w1", 1, None),
    }


def test_region_join_removes_repeated_details(make):
    regions = make([("w1", 1, "x")], "iso_week string, store_nr int, region_manager string")
    details = make([("w1", 1, 1, 5, 100, "10:00"), ("w1", 1, 1, 5, 100, "11:00"), ("w1", 2, 1, 5, 100, "10:00")],
                   "iso_week string, store_nr int, kpi_id int, cashier_id int, receipt_id long, receipt_time string")
    assert values(r.anomalies_with_region(details, regions)) == [("w1", 1, 1, 5, 100, "x")]
    org = make([("w1", 1, "x", "a"), ("w1", 1, "x", "b")], "iso_week string, store_nr int, region_manager string, store_desc string")
    assert values(r.store_regions(org)) == [("w1", 1, "x")]
