"""Run parameters with the production defaults."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import date, timedelta


@dataclass(frozen=True)
class KpiRule:
    """Flagging rule of one KPI; ``None`` means "use the default" or "no such rule"."""

    absolute: int | None = None
    red_percentile: float | None = None
    orange_percentile: float | None = None
    weight: float | None = None


# Flagging rules per KPI.
DEFAULT_RULES: Mapping[int, KpiRule] = {
    1: KpiRule(absolute=5, orange_percentile=10, weight=50),
    2: KpiRule(absolute=1),
    3: KpiRule(red_percentile=3, weight=1),
    4: KpiRule(absolute=4),
    5: KpiRule(absolute=2),
    6: KpiRule(red_percentile=8),
    7: KpiRule(absolute=3, orange_percentile=12),
    8: KpiRule(red_percentile=3, orange_percentile=10, weight=5),
    9: KpiRule(red_percentile=5, orange_percentile=10),
    10: KpiRule(red_percentile=5, orange_percentile=10, weight=20),
}

# Minimum weekly count below which a KPI row is ignored.
DEFAULT_MIN_COUNTS: Mapping[int, int] = {4: 2, 5: 2, 6: 2, 7: 2, 9: 3, 10: 2}


def previous_week(today: date | None = None) -> tuple[date, date]:
    """Monday and Sunday of the ISO week before ``today``."""
    today = today or date.today()
    monday = today - timedelta(days=today.weekday() + 7)
    return monday, monday + timedelta(days=6)


def _as_date(value: date | str) -> date:
    if isinstance(value, date):
        return value
    if len(value) != 10:
        raise ValueError(f"expected a date as YYYY-MM-DD, got {value!r}")
    return date.fromisoformat(value)


@dataclass(frozen=True)
class Params:
    """Everything a weekly run can be tuned with.

    ``start_date`` and ``end_date`` accept dates or ``YYYY-MM-DD`` strings and
    default to the previous ISO week. ``stores`` replaces the store range when given.
    """

    client_id: int
    start_date: date | str | None = None
    end_date: date | str | None = None
    stores: tuple[int, ...] = ()
    store_min: int = 100
    store_max: int = 500

    considered_return_days: int = 92
    cash_only: bool = True
    tolerance_opening_minutes: int = 30
    tolerance_closing_minutes: int = 15
    nth_last_subtotal: int = 2
    min_distinct_voided: int = 2
    return_limit: int = 10
    return_minimum: int = 7

    min_receipts_per_cashier: int = 30
    min_counts: Mapping[int, int] = field(default_factory=lambda: dict(DEFAULT_MIN_COUNTS))
    rules: Mapping[int, KpiRule] = field(default_factory=lambda: dict(DEFAULT_RULES))
    default_red_percentile: float = 8
    default_orange_percentile: float = 15
    default_weight: float = 100
    min_population: int = 10
    avg_red_flags_per_store: float = 3
    num_flags_per_store: int = 10
    orange_requires_level: bool = False

    look_back_weeks: int = 12

    def __post_init__(self) -> None:
        if self.client_id is None:
            raise ValueError("client_id is required")
        monday, sunday = previous_week()
        start = _as_date(self.start_date) if self.start_date else monday
        end = _as_date(self.end_date) if self.end_date else sunday
        if start > end:
            raise ValueError(f"start_date {start} is after end_date {end}")
        object.__setattr__(self, "client_id", int(self.client_id))
        object.__setattr__(self, "start_date", start)
        object.__setattr__(self, "end_date", end)
        object.__setattr__(self, "stores", tuple(int(s) for s in self.stores))

    def with_(self, **changes) -> "Params":
        """A copy with some values replaced."""
        return replace(self, **changes)

    def red_probability(self, kpi_id: int) -> float:
        rule = self.rules.get(kpi_id, KpiRule())
        return _probability(rule.red_percentile, self.default_red_percentile)

    def orange_probability(self, kpi_id: int) -> float:
        rule = self.rules.get(kpi_id, KpiRule())
        return _probability(rule.orange_percentile, self.default_orange_percentile)

    def weight(self, kpi_id: int) -> float:
        rule = self.rules.get(kpi_id, KpiRule())
        return float(rule.weight or self.default_weight)  # no weight, or one of 0

    @property
    def absolute_thresholds(self) -> dict[int, int]:
        return {k: r.absolute for k, r in self.rules.items() if r.absolute is not None}


def _probability(top_percent: float | None, default: float) -> float:
    """Percentiles are configured as "top x %": 8 means the 0.92 quantile."""
    return round((100 - float(default if top_percent is None else top_percent)) / 100, 2)
