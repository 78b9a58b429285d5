"""Calendar arithmetic with an explicit reference date (no wall clock)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def age_years(born: Column, as_of: dt.date) -> Column:
    """Completed years. A 29 February birthday falls on the 28th in common years."""
    years = F.lit(as_of.year) - F.year(born)
    return years - F.when(F.add_months(born, years * 12) > F.lit(as_of), 1).otherwise(0)


def seconds_of_day(clock: Column) -> Column:
    """`H:m:s` text to whole seconds; fractions of a second are dropped, and a text that is
    no time of day gives NULL."""
    parts = F.split(F.trim(clock), ":")
    hour, minute = (F.get(parts, i).try_cast("int") for i in (0, 1))
    second = F.substring_index(F.get(parts, 2), ".", 1).try_cast("int")
    fits = hour.between(0, 23) & minute.between(0, 59) & second.between(0, 59)
    return F.when((F.size(parts) == 3) & fits, hour * 3600 + minute * 60 + second)


def micros_of_day(clock: Column) -> Column:
    """`H:m:s.f` text to microseconds, to order by; digits beyond the sixth are dropped, a
    fraction that is no number counts as none, and a text that is no time of day gives NULL."""
    digits = F.regexp_extract(F.trim(clock), r"\.([0-9]+)$", 1)
    fraction = F.rpad(F.substring(digits, 1, 6), 6, "0").cast("bigint")
    return seconds_of_day(clock).cast("bigint") * 1_000_000 + fraction


def month_of(day: Column) -> Column:
    return F.trunc(day, "MM")


def next_month(first: dt.date) -> dt.date:
    """First day of the following month."""
    return dt.date(first.year + first.month // 12, first.month % 12 + 1, 1)


def month_starts(cutoff: dt.date, months: int = 12) -> list[dt.date]:
    """First days of the last `months` months, the cut-off month included."""
    last = cutoff.year * 12 + cutoff.month - 1
    return [dt.date(m // 12, m % 12 + 1, 1) for m in range(last - months + 1, last + 1)]
