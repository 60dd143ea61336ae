"""Date rules. Everything that depends on today takes an `as_of` argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | dt.date | str) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def previous_month_label(day: Column) -> Column:
    """`yyyyMM` of the month before `day`."""
    return F.date_format(F.add_months(F.trunc(day, "MM"), -1), "yyyyMM")


def month_before(day: dt.date) -> str:
    """As `previous_month_label` for one day, where a label names a folder."""
    months = day.year * 12 + day.month - 2
    return f"{months // 12}{months % 12 + 1:02}"


def pivot_date(c: Column, as_of: Column | dt.date | str) -> Column:
    """`MMddyy` text to a date; the two-digit year is the latest one not after `as_of`.

    The month decides inside the current year. Anything that is not six digits
    or not a calendar day is null.
    """
    as_of = _column(as_of)
    now_yy = F.year(as_of) % 100
    yy = F.substring(c, 5, 2)
    mm = F.substring(c, 1, 2)
    yy_n, mm_n = yy.try_cast("int"), mm.try_cast("int")
    this_century = (yy_n < now_yy) | ((yy_n == now_yy) & (mm_n <= F.month(as_of)))
    century = F.when(this_century, "20").otherwise("19")
    digits = c.rlike(r"^[0-9]{6}\z")
    return F.when(digits, F.try_to_date(F.concat(century, yy, mm, F.substring(c, 3, 2)), "yyyyMMdd"))


def utc_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")


def load_time(given: str | None = None) -> Column:
    """The given text, or the time of the query; sessions run in UTC."""
    return F.lit(given) if given is not None else utc_text(F.current_timestamp())


def days_since(day: Column, as_of: Column | dt.date | str) -> Column:
    return F.datediff(_column(as_of), day)


def birth_date_tag(c: Column) -> Column:
    """`yyyy-MM-dd` text to `MMddyy`; unreadable text is empty."""
    return F.coalesce(F.date_format(F.try_to_date(c, "yyyy-M-d"), "MMddyy"), F.lit(""))


def local_to_utc(ts: Column, zone: str = "America/Toronto") -> Column:
    """A wall-clock time of `zone` as the UTC instant."""
    return F.to_utc_timestamp(ts, zone)
