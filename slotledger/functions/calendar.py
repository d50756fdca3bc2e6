"""Calendar columns: week bounds, week numbers, month starts, date keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The DATETIME range of the report tables, and the anchor days of
# the two week functions (a Monday and a Saturday).
FIRST_DATE = dt.date(1753, 1, 1)
LAST_DATE = dt.date(9999, 12, 31)
LAST_SATURDAY = dt.date(9999, 12, 25)

AsOf = dt.date | dt.datetime | str


def as_timestamp(as_of: AsOf) -> Column:
    """The run time as a TIMESTAMP_NTZ literal."""
    return F.lit(str(as_of)).cast("timestamp_ntz")


def as_date(as_of: AsOf) -> Column:
    """The run date as a DATE literal."""
    return as_timestamp(as_of).cast("date")


def _week_start(week_start: int | Column) -> Column:
    return week_start if isinstance(week_start, Column) else F.lit(week_start)


def _first_week(ws: Column) -> Column:
    # Monday 1753-01-01 is week start 2, so start 2 needs no shift.
    return F.date_add(F.lit(FIRST_DATE), F.pmod(ws - 2, F.lit(7)).cast("int"))


def _back_to_week_start(day: Column, ws: Column) -> Column:
    return F.date_sub(day, F.pmod(F.dayofweek(day) - ws, F.lit(7)).cast("int"))


def start_of_week(col: Column, week_start: int | Column = 1) -> Column:
    """Last day on or before ``col`` that falls on ``week_start`` (1 Sunday .. 7 Saturday).

    NULL for an invalid week start, and before the calendar's first such day.
    """
    ws, day = _week_start(week_start), col.cast("date")
    return F.when(
        ws.between(1, 7) & (day >= _first_week(ws)), _back_to_week_start(day, ws)
    )


def end_of_week(col: Column, week_start: int | Column = 1) -> Column:
    """Last day of the week that ``start_of_week`` opens.

    NULL for an invalid week start and after the last week that ends inside the
    calendar (time of day included). A date before the first week gives the day
    before that week.
    """
    ws, day = _week_start(week_start), col.cast("date")
    last_end = F.date_add(F.lit(LAST_SATURDAY), F.pmod(ws - 1, F.lit(7)).cast("int"))
    inside = ws.between(1, 7) & (
        col.cast("timestamp_ntz") <= last_end.cast("timestamp_ntz")
    )
    return F.when(
        inside & (day < _first_week(ws)), F.date_sub(_first_week(ws), 1)
    ).when(inside, F.date_add(_back_to_week_start(day, ws), 6))


def us_week(col: Column) -> Column:
    """Week of the year; week 1 holds January 1st, weeks open on Sunday."""
    lead = F.dayofweek(F.trunc(col, "YEAR")) - 1
    return (F.floor((F.dayofyear(col) - 1 + lead) / 7) + 1).cast("int")


def month_start(col: Column) -> Column:
    return F.trunc(col, "MONTH")


def date_key(col: Column) -> Column:
    """``yyyymmdd`` text of a date."""
    return F.translate(col.cast("date").cast("string"), "-", "")


def in_calendar(col: Column) -> Column:
    """True inside the DATETIME range; bounds the number of distinct dates."""
    return col.between(F.lit(FIRST_DATE), F.lit(LAST_DATE))
