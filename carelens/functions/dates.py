"""Dates, calendar parts and period parameters."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the end date of an open history row.
OPEN_END = date(9999, 12, 31)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Year, month and day with one kind of separator, all three present; a time of day may follow and is dropped.
_DAY = r"^(\d{1,4})([-/ ])(\d{1,2})\2(\d{1,2})(?:[ T]\d{1,2}:\d{2}:\d{2}(?:\.\d+)?)?$"


def safe_date(c) -> Column:
    """Parse year-first text with ``-``, ``/`` or a space; anything unreadable, such as a year or a month alone, becomes NULL."""
    text = F.trim(_col(c))
    # the usual shape needs no pattern
    usual = (F.length(text) == 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    return F.when(usual, text.try_cast("date")).when(text.rlike(_DAY), F.regexp_replace(text, _DAY, "000$1-$3-$4").try_cast("date"))


def month_index(c) -> Column:
    """Months since year 0; a total order over (year, month) that needs one comparison."""
    return F.year(_col(c)) * 12 + F.month(_col(c))


def period_text(c) -> Column:
    """``YYYY-MM``."""
    return F.date_format(_col(c), "yyyy-MM")


def weekend(c, corrected: bool = False) -> Column:
    """Weekend flag.

    The default numbers days Sunday=0 .. Saturday=6 and tests for 1 or 7, which only Mondays satisfy; it
    reproduces the established reports. ``corrected`` tests for Saturday and Sunday.
    """
    day = F.dayofweek(_col(c))
    return day.isin(1, 7) if corrected else (day - 1).isin(1, 7)


def calendar_parts(c, corrected: bool = False) -> list[Column]:
    """The calendar columns of the date dimension. Weeks are ISO weeks; names are full names."""
    d = _col(c)
    return [
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("weekday"),
        F.weekofyear(d).alias("week_number"),
        weekend(d, corrected).alias("is_weekend"),
    ]


def file_month(c) -> Column:
    """``YYYY_MM`` taken from a feed file name such as ``feed_2025_01.csv``; NULL when absent."""
    found = F.regexp_extract(_col(c), r"(\d{4}_\d{2})", 1)
    return F.nullif(found, F.lit(""))


def parse_period(text: str, name: str = "period") -> tuple[int, int]:
    """Check a ``YYYY-MM`` parameter before any plan is built."""
    match = re.fullmatch(r"(\d{4})-(\d{1,2})", text.strip())
    if not match or not 1 <= int(match.group(2)) <= 12:
        raise ValueError(f"{name} must be in YYYY-MM format, got {text!r}")
    return int(match.group(1)), int(match.group(2))


def parse_day(text: str | date, name: str = "date") -> date:
    """Check an ISO date parameter before any plan is built."""
    if isinstance(text, date):
        return text
    try:
        return date.fromisoformat(text)
    except ValueError as error:
        raise ValueError(f"{name} must be in YYYY-MM-DD format, got {text!r}") from error


def day_literal(value: str | date | None) -> Column:
    """A literal date, or today's date when no value is given."""
    return F.current_date() if value is None else F.lit(parse_day(value))
