"""Calendar rules as Column expressions.

Days travel through the library as ``yyyymmdd`` integers; these functions take
and return ``date`` columns unless their name says otherwise. With a literal
day every expression here folds to a literal, so filters built from it still
prune partitions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# How the reports number the look-back periods.
PERIOD_OPTIONS = {"year": 0, "month": 1, "week": 2, "day": 3, "latest": 4}

Day = Column | dt.date
Count = Column | int


def as_day(value: Day) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def _count(value: Count) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def day_number(day: Day) -> Column:
    """``date`` to ``yyyymmdd`` integer."""
    day = as_day(day)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def day_text(day: Day) -> Column:
    """``date`` to ``yyyymmdd`` text."""
    return F.date_format(as_day(day), "yyyyMMdd")


def number_to_day(number: Column) -> Column:
    """``yyyymmdd`` integer or text to ``date``; NULL where it names no day."""
    return F.try_to_date(number.cast("string"), "yyyyMMdd")


def days_back(day: Day, days: Count) -> Column:
    return F.date_sub(as_day(day), _count(days))


def days_forward(day: Day, days: Count) -> Column:
    return F.date_add(as_day(day), _count(days))


def months_back(day: Day, months: Count) -> Column:
    """Go back whole months; a day the target month lacks spills into the next.

    31 March minus one month is 3 March, where ``add_months`` alone would clamp
    to 28 February.
    """
    day = as_day(day)
    first = F.add_months(F.trunc(day, "MM"), -_count(months))
    return F.date_add(first, F.dayofmonth(day) - 1)


def years_back(day: Day, years: Count) -> Column:
    return months_back(day, _count(years) * 12)


def to_weekday(day: Day) -> Column:
    """Saturday and Sunday go back to Friday."""
    day = as_day(day)
    return F.date_sub(day, F.greatest(F.weekday(day) - 4, F.lit(0)))


def business_days_back(day: Day, days: Count) -> Column:
    """Step back until ``days`` steps have started on a weekday.

    Weekend days are crossed without counting, and the last step may itself end
    on a Sunday: Monday minus one is Sunday.
    """
    day, days = as_day(day), _count(days)
    start = to_weekday(day)
    weekends = F.floor((days - 1 + 4 - F.weekday(start)) / 5).cast("int")
    stepped = F.date_sub(start, days + weekends * 2)
    return F.when(days >= 1, stepped).otherwise(day)


def shifted(period: str, day: Day) -> Column:
    """The calendar day one ``period`` before ``day``."""
    match period:
        case "year":
            return years_back(day, 1)
        case "month":
            return months_back(day, 1)
        case "week":
            return days_back(day, 7)
        case "day":
            return days_back(day, 1)
        case "latest":
            return as_day(day)
    raise ValueError(f"unknown period {period!r}")


def previous_day_number(option: int, day: Day) -> Column:
    """``yyyymmdd`` of a numbered look-back; 0 for a number that names none."""
    for period, number in PERIOD_OPTIONS.items():
        if number == option:
            return day_number(shifted(period, day))
    return F.lit(0)


def previous_weekday_number(option: int, day: Day) -> Column:
    """As :func:`previous_day_number`, moved back off a weekend."""
    for period, number in PERIOD_OPTIONS.items():
        if number == option:
            return day_number(to_weekday(shifted(period, day)))
    return F.lit(0)


def anchor_numbers(day: Day) -> dict[str, Column]:
    """``yyyymmdd`` of the five days a movement report compares."""
    return {
        period: previous_weekday_number(option, day)
        for period, option in PERIOD_OPTIONS.items()
    }


def period_name(text: str | None) -> str:
    """Period named by free text, in any case; anything unknown means a week."""
    name = (text or "").lower()
    return name if name in ("day", "week", "month", "year") else "week"


def series_period_name(text: str | None) -> str:
    """As :func:`period_name` for series, which have no one-day period."""
    name = period_name(text)
    return "week" if name == "day" else name


def search_window(
    period: str, as_of: Day, mark: str | None = None
) -> tuple[Column, Column]:
    """Inclusive ``yyyymmdd`` bounds of the period that ends on ``as_of``.

    ``latest`` starts at an RFC 3339 mark; both bounds are -1 when that mark is
    missing or unreadable.
    """
    if period != "latest":
        return day_number(shifted(period, as_of)), day_number(as_of)
    try:
        moment = parse_instant(mark)
    except ValueError:
        return F.lit(-1), F.lit(-1)
    return day_number(moment.date()), day_number(as_of)


def parse_instant(mark: str | None) -> dt.datetime:
    """RFC 3339 text to an instant in UTC; ``ValueError`` if it is not one."""
    if not mark or "T" not in mark:
        raise ValueError(f"not an RFC 3339 time: {mark!r}")
    moment = dt.datetime.fromisoformat(mark)
    if moment.tzinfo is None:
        raise ValueError(f"no offset in time: {mark!r}")
    return moment.astimezone(dt.UTC)


def day_series(start: Day, end: Day) -> Column:
    """Array of the days from ``start`` up to, not including, ``end``."""
    start, end = as_day(start), as_day(end)
    days = F.sequence(start, F.greatest(F.date_sub(end, 1), start))
    return F.when(start < end, days).otherwise(F.array().cast("array<date>"))


def backfill_range(as_of: Day, months: int, lag: int = 4) -> tuple[Column, Column]:
    """First day and excluded last day of a backfill over ``months``.

    Both bounds move with ``months``, one back and one forward, counted from the
    day ``lag`` business days before ``as_of``.
    """
    base = business_days_back(as_of, lag)
    return months_back(base, months + 1), months_back(base, -months)
