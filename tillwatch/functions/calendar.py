"""ISO-week and month expressions. All take and return Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def iso_year(col: ColumnOrName) -> Column:
    return F.date_part(F.lit("YEAROFWEEK"), _col(col))


def monday(col: ColumnOrName) -> Column:
    """Monday of the ISO week of a date."""
    return F.date_sub(_col(col), F.weekday(_col(col)))


def _two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def iso_week(col: ColumnOrName) -> Column:
    """'YYYY-WW' with the ISO year; NULL for a NULL date."""
    return F.concat(iso_year(col).cast("string"), F.lit("-"), _two_digits(F.weekofyear(_col(col))))


def calendar_year_week(col: ColumnOrName) -> Column:
    """'YYYY_WW' with the calendar year, so 2024-12-30 gives '2024_01'."""
    return F.concat(F.year(_col(col)).cast("string"), F.lit("_"), _two_digits(F.weekofyear(_col(col))))


def iso_weeks_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Array of all ISO weeks 'YYYYWW' touched by the date range, oldest first."""
    mondays = F.sequence(monday(start), monday(end), F.expr("INTERVAL 7 DAYS"))
    return F.transform(mondays, lambda d: F.concat(iso_year(d).cast("string"), _two_digits(F.weekofyear(d))))


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Number of days in a range, both ends included."""
    return F.datediff(_col(end), _col(start)) + 1


def _week_start(year_week: ColumnOrName) -> Column:
    """Monday of a 'YYYYWW' week: week 1 is the one holding January 4th."""
    year = F.substring(_col(year_week), 1, 4).cast("int")
    week = F.substring(_col(year_week), 5, 2).cast("int")
    return F.date_add(monday(F.make_date(year, F.lit(1), F.lit(4))), (week - 1) * 7)


def weeks_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Number of ISO weeks from 'YYYYWW' to 'YYYYWW', both included."""
    return F.floor(F.datediff(_week_start(end), _week_start(start)) / 7).cast("int") + 1


def months_between_incl(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Number of calendar months from 'YYYY-MM' to 'YYYY-MM', both included."""

    def index(value: ColumnOrName) -> Column:
        return F.substring(_col(value), 1, 4).cast("int") * 12 + F.substring(_col(value), 6, 2).cast("int")

    return index(end) - index(start) + 1


def week_bounds(col: ColumnOrName, n: int = 1) -> Column:
    """Struct (monday, sunday) of the week ``n`` weeks before the one of ``col``."""
    first = F.date_sub(monday(col), 7 * n)
    return F.struct(first.alias("monday"), F.date_add(first, 6).alias("sunday"))


def nth_day_of_month(col: ColumnOrName, day: int) -> Column:
    """That day in the month of ``col``; an impossible day is an error."""
    return F.make_date(F.year(_col(col)), F.month(_col(col)), F.lit(day))


def month_bounds(col: ColumnOrName) -> Column:
    """Struct with the first day of this month and first day, last day and 'YYYYMM' of the previous one."""
    first = F.trunc(_col(col), "month")
    previous = F.add_months(first, -1)
    return F.struct(
        first.alias("first_day"),
        previous.alias("previous_first_day"),
        F.date_sub(first, 1).alias("previous_last_day"),
        F.date_format(previous, "yyyyMM").alias("previous_month"),
    )


def lookback_start(col: ColumnOrName, n: int) -> Column:
    """First day of an n-week window that ends on, and includes, ``col``."""
    return F.date_sub(_col(col), 7 * n - 1)


def period_bounds(col: ColumnOrName, kind: ColumnOrName) -> Column:
    """Struct (start, end): 'GM' is the previous month, 'EZ' the 1st to 14th of this one; else an error."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    months = month_bounds(col)
    unknown = F.raise_error(F.concat(F.lit("unknown reporting period: "), F.coalesce(kind, F.lit("NULL")))).cast("date")
    start = F.when(kind == "GM", months["previous_first_day"]).when(kind == "EZ", months["first_day"])
    end = F.when(kind == "GM", months["previous_last_day"]).when(kind == "EZ", nth_day_of_month(col, 14))
    return F.struct(start.otherwise(unknown).alias("start"), end.otherwise(unknown).alias("end"))
