"""Day keys, month lists and epoch text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

TRAINING_MONTHS = 3


def day_key(day: Column) -> Column:
    """``yyyymmdd`` as an integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def day_of_key(key: Column) -> Column:
    return F.make_date((key / 10000).cast("int"), (key / 100).cast("int") % 100, key % 100)


def month_key(key: Column) -> Column:
    """``yyyymm`` of a ``yyyymmdd`` integer."""
    return F.floor(key / 100).cast("int")


def training_window(today: Column, months: int = TRAINING_MONTHS) -> tuple[Column, Column]:
    """First and last day of the full months before yesterday's month."""
    yesterday = F.date_sub(today, 1)
    first = F.trunc(F.add_months(yesterday, -months), "month")
    return first, F.last_day(F.add_months(yesterday, -1))


def training_days(today: dt.date, months: int = TRAINING_MONTHS) -> tuple[int, int]:
    """The training window as day keys, for a scan's static partition filter."""
    yesterday = today - dt.timedelta(days=1)
    this_month = yesterday.replace(day=1)
    last = this_month - dt.timedelta(days=1)
    index = this_month.year * 12 + this_month.month - 1 - months
    return index // 12 * 10000 + (index % 12 + 1) * 100 + 1, int(last.strftime("%Y%m%d"))


def month_range(first: Column, last: Column) -> Column:
    """``yyyymm`` keys of the months that end inside [first, last]."""
    days = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))
    ended = F.filter(days, lambda d: F.last_day(d) <= last)
    return F.transform(ended, lambda d: F.year(d) * 100 + F.month(d))


def days_between(first_day: int, last_day: int) -> list[int]:
    """The ``yyyymmdd`` keys of the calendar days of an inclusive span."""
    first, last = (dt.datetime.strptime(str(key), "%Y%m%d").date() for key in (first_day, last_day))
    return [int((first + dt.timedelta(days=n)).strftime("%Y%m%d")) for n in range((last - first).days + 1)]


def month_bounds(month: int) -> tuple[int, int]:
    """The day keys a ``yyyymm`` month can have: a range that prunes partitions."""
    return month * 100 + 1, month * 100 + 31


def epoch_text(seconds: Column) -> Column:
    """``YYYY-MM-DD HH:mm:ss`` in UTC, whatever the session's time zone."""
    days = F.floor(seconds / 86400).cast("int")
    rest = (seconds - days * 86400).cast("int")

    def two(value: Column) -> Column:
        return F.lpad(value.cast("string"), 2, "0")

    clock = F.concat_ws(
        ":", two(F.floor(rest / 3600)), two(F.floor(rest / 60) % 60), two(rest % 60)
    )
    return F.concat_ws(" ", F.date_add(F.lit(dt.date(1970, 1, 1)), days).cast("string"), clock)
