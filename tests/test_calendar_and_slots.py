from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from frames import REQUESTS, day, frame, rows, ts
from slotledger.functions.calendar import end_of_week, start_of_week, us_week
from slotledger.operators.slots import (
    day_slots,
    resolve_components,
    resolve_requests,
    week_slots,
)

AS_OF = "2013-03-14"


@pytest.mark.parametrize(
    "first,second,expected",
    [
        (None, None, ("2013-03-13", "2013-03-13")),
        ("0", None, ("2013-03-14", "2013-03-14")),
        ("7", "2013-03-01", ("2013-03-07", "2013-03-07")),
        ("2013-01-05", None, ("2013-01-05", "2013-01-05")),
        ("2013/01/07", "2013-01-05", ("2013-01-05", "2013-01-07")),
        ("2013\\01\\05", "20130107", ("2013-01-05", "2013-01-07")),
        ("99999", None, ("2013-03-13", "2013-03-13")),
        ("99999999999999999999", None, ("2013-03-13", "2013-03-13")),
        ("10000", None, ("1985-10-27", "1985-10-27")),
        ("-3", None, ("2013-03-11", "2013-03-11")),
        ("01/05/2013", None, ("2013-03-13", "2013-03-13")),
        ("abc", None, ("2013-03-13", "2013-03-13")),
        ("", "2013-01-05", ("2013-03-13", "2013-03-13")),
        ("2013-02-31", "2013-01-05", ("2013-03-13", "2013-03-13")),
        ("2013-01-05", "nonsense", ("2013-01-05", "2013-01-05")),
        ("1752-12-31", None, ("2013-03-13", "2013-03-13")),
    ],
)
def test_day_requests(spark, first, second, expected):
    df = resolve_requests(frame(spark, REQUESTS, (1, None, first, second)), AS_OF)
    assert rows(df, "from_date", "to_date") == [tuple(map(day, expected))]


@pytest.mark.parametrize(
    "first,expected", [(None, "2013-03-06"), ("2", "2013-02-28"), ("99999", "2013-03-07")]
)
def test_week_requests(spark, first, expected):
    df = resolve_requests(frame(spark, REQUESTS, (1, None, first, None)), AS_OF, "week")
    assert rows(df, "from_date", "to_date") == [(day(expected), day(expected))]


def test_day_slots(spark):
    df = frame(spark, REQUESTS, (1, None, "2013-02-27", "2013-03-01"))
    slots = day_slots(resolve_requests(df, AS_OF))
    assert rows(slots, "log_date") == [
        (day("2013-02-27"),),
        (day("2013-02-28"),),
        (day("2013-03-01"),),
    ]


WEEK = ["week_begin", "week_end", "week_limit", "YearNum", "WeekNum"]


@pytest.mark.parametrize("asked", ["2013-01-05", "2012-12-31"])
def test_week_slot_takes_year_and_week_of_its_last_day(spark, asked):
    df = frame(spark, REQUESTS, (1, None, asked, None))
    slots = week_slots(resolve_requests(df, AS_OF, "week"))
    assert rows(slots, *WEEK) == [
        (day("2012-12-30"), day("2013-01-05"), day("2013-01-06"), 2013, 1)
    ]


def test_week_steps(spark):
    df = frame(spark, REQUESTS, (1, None, "2013-01-05", "2013-01-07"))
    resolved = resolve_requests(df, AS_OF, "week")
    assert rows(week_slots(resolved), "week_begin") == [(day("2012-12-30"),)]
    assert rows(week_slots(resolved, cover_all_weeks=True), "week_begin") == [
        (day("2012-12-30"),),
        (day("2013-01-06"),),
    ]


@pytest.mark.parametrize(
    "text,expected",
    [
        (None, {"CPU", "MEM"}),
        (" ", {"CPU", "MEM"}),
        ("ALL", {"CPU", "MEM"}),
        ("CPUMEM", {"CPU", "MEM"}),
        ("cpu", {"CPU"}),
        ("mem", {"MEM"}),
        ("XYZ", {"CPU", "MEM"}),
    ],
)
def test_components(spark, text, expected):
    df = resolve_components(frame(spark, REQUESTS, (1, text, None, None)))
    assert {r[0] for r in rows(df, "component")} == expected


def _weeks(spark, moment: str, ws: int):
    df = frame(spark, "d timestamp_ntz, ws int", (ts(moment), ws))
    return rows(
        df.select(start_of_week(F.col("d"), F.col("ws")), end_of_week(F.col("d"), F.col("ws")))
    )[0]


def test_week_function_limits(spark):
    assert _weeks(spark, "2013-03-14", 0) == (None, None)
    assert _weeks(spark, "2013-03-14", 8) == (None, None)
    assert _weeks(spark, "1753-01-01", 1) == (None, day("1753-01-06"))
    assert _weeks(spark, "1753-01-07", 1) == (day("1753-01-07"), day("1753-01-13"))
    assert _weeks(spark, "9999-12-25", 1) == (day("9999-12-19"), day("9999-12-25"))
    # the limit includes the time of day
    assert _weeks(spark, "9999-12-25T12:00:00", 1) == (day("9999-12-19"), None)
    assert _weeks(spark, "9999-12-26", 1) == (day("9999-12-26"), None)


def test_week_functions_agree_with_python(spark):
    days = [dt.date(2011, 12, 20) + dt.timedelta(i) for i in range(400)]
    df = frame(spark, "d date", *[(d,) for d in days]).select(
        "d",
        F.explode(F.sequence(F.lit(1), F.lit(7))).alias("ws"),
    ).select(
        "d",
        "ws",
        start_of_week(F.col("d"), F.col("ws")).alias("s"),
        end_of_week(F.col("d"), F.col("ws")).alias("e"),
        us_week(F.col("d")).alias("w"),
    )
    for d, ws, s, e, w in df.collect():
        assert s <= d <= e and (e - s).days == 6
        assert s.isoweekday() % 7 + 1 == ws
        # %U counts from the first Sunday; week 1 holds January 1st
        first = dt.date(d.year, 1, 1)
        assert w == int(d.strftime("%U")) + (0 if first.isoweekday() == 7 else 1)


def test_dates_in_blanks(spark):
    from pyspark.sql import functions as F

    from slotledger.functions import text as tx

    df = spark.createDataFrame([(" 20130105",), ("20130105 ",), (" 20130105 ",), ("2013 0105",)], "t string")
    got = [(r[0], r[1]) for r in df.select(tx.is_date(F.col("t")), tx.parse_date(F.col("t")).cast("string")).collect()]
    assert got == [(True, "2013-01-05")] * 3 + [(False, None)]
