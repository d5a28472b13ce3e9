"""Dates as compact yyyyMMdd text, and the times derived from them.  Nothing here reads the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.functions.text import text


def digits(value) -> Column:
    return F.regexp_replace(text(value), "[^0-9]", "")


def compact(value) -> Column:
    """The first eight digits, or null with fewer."""
    return F.when(F.length(digits(value)) >= 8, F.substring(digits(value), 1, 8))


def undashed(value) -> Column:
    return F.regexp_replace(text(value), "-", "")


def compact_if_dashed(value) -> Column:
    """yyyy-MM-dd as yyyyMMdd; any other text as it is."""
    return F.when(text(value).rlike(r"^\d{4}-\d{2}-\d{2}$"), undashed(value)).otherwise(text(value))


def dashed(value) -> Column:
    return F.when(text(value).rlike(r"^\d{8}$"), F.regexp_replace(text(value), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")).otherwise(text(value))


def partial_date(value) -> Column:
    """Eight digits, else six or four if that is all there is, else the text."""
    d, plain = digits(value), F.trim(text(value))
    return F.when(plain == "", F.lit(None).cast("string")).when(F.length(d) >= 8, F.substring(d, 1, 8)).when(F.length(d).isin(6, 4), d).otherwise(plain)


def datetime_text(value) -> Column:
    """Fourteen digits; twelve get seconds."""
    d = digits(value)
    return F.when(F.length(d) >= 14, F.substring(d, 1, 14)).when(F.length(d) == 12, F.concat(d, F.lit("00")))


def real_date(value) -> Column:
    """A DATE of compact text; null if it isn't one."""
    return F.try_to_date(compact(value), "yyyyMMdd") if hasattr(F, "try_to_date") else F.to_date(F.try_to_timestamp(compact(value), F.lit("yyyyMMdd")))


def of_date(value: Column) -> Column:
    return F.date_format(value, "yyyyMMdd")


def from_millis(value, pattern: str = "yyyyMMdd") -> Column:
    """Text of epoch milliseconds, in the session's time zone; a year of more digits than its pattern has no sign before it."""
    told = F.date_format(F.timestamp_millis((value if isinstance(value, Column) else F.col(value)).cast("long")), pattern)
    return F.regexp_replace(told, r"^\+", "") if pattern.startswith(("y", "u")) else told


def minute_label(index) -> Column:
    """HH:mm of a trading minute: 120 from 09:30, the rest from 13:00."""
    i = (index if isinstance(index, Column) else F.col(index)).cast("long")
    minute = F.when(i < 120, i + 9 * 60 + 30).otherwise(i - 120 + 13 * 60)
    return F.when(i >= 0, F.format_string("%02d:%02d", F.floor(minute / 60).cast("long"), minute % 60))


def clock_text(value) -> Column:
    """93005 or 093005 as 09:30:05."""
    d = F.lpad(digits(value), 6, "0")
    return F.when(digits(value) != "", F.concat_ws(":", F.substring(d, 1, 2), F.substring(d, 3, 2), F.substring(d, 5, 2)))


def month_start(value: Column) -> Column:
    return F.trunc(value, "MM")


def is_true(value) -> Column:
    """A calendar flag: 1, true, t, yes, y, open, or a number other than 0."""
    plain = F.lower(F.trim(text(value)))
    number = plain.try_cast("double")
    return F.coalesce(plain.isin("1", "true", "t", "yes", "y", "open") | (F.coalesce(number, F.lit(0.0)) != 0), F.lit(False))


def between_text(value, start: str | None, end: str | None) -> Column:
    """Inclusive on compact text; bounds may be dashed.  A null date is out if a bound is given."""
    out = F.lit(True)
    for bound, inside in ((start, lambda b: text(value) >= b), (end, lambda b: text(value) <= b)):
        if bound:
            out = out & F.coalesce(inside(str(bound).replace("-", "")), F.lit(False))
    return out


def between_or_undated(value, start: str | None, end: str | None) -> Column:
    """The same on the first eight digits, but rows without a date stay."""
    return compact(value).isNull() | between_text(compact(value), start, end)


def year_between(value, start: str | None, end: str | None) -> Column:
    year, out = F.substring(text(value), 1, 4), F.lit(True)
    if start:
        out = out & (year >= str(start))
    return out & (year <= str(end)) if end else out
