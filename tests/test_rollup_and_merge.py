from __future__ import annotations

from pyspark.sql import functions as F

from frames import (
    COUNTERS,
    EVENTS,
    HOURS,
    LOG,
    REQUESTS,
    STORED_EVENTS,
    day,
    frame,
    rows,
    ts,
)
from slotledger.operators.filters import cpu_counters, mem_counters
from slotledger.operators.merge import insert_new, load_if_slot_empty, outcome_counts
from slotledger.operators.rollup import (
    component_readings,
    component_rollup,
    daily_rollup,
    hourly_rollup,
)
from slotledger.plans.jobs import components_report, daily_components, events_report

DAY = day("2013-01-05")
READINGS = [
    (1, 7, ts("2013-01-05T00:00:00"), 1.0, DAY),
    (1, 7, ts("2013-01-05T00:30:00"), 2.0, DAY),
    (1, 7, ts("2013-01-05T01:00:00"), 4.0, DAY),
    (1, 7, ts("2013-01-05T23:59:59"), 8.0, DAY),
    (1, 7, ts("2013-01-06T00:00:00"), 16.0, DAY),
    (1, 7, ts("2013-01-05T02:10:00"), -1.0, DAY),
    # outside the shard's day: in no hour
    (1, 7, ts("2013-01-04T23:59:59"), 32.0, DAY),
    (1, 7, ts("2013-01-06T00:00:00.000001"), 64.0, DAY),
    # a fraction past the hour is not on the hour
    (1, 7, ts("2013-01-05T05:00:00.000001"), 128.0, DAY),
]


def _log(spark):
    return frame(spark, LOG, *READINGS)


def _counters(spark, name="% Processor Time"):
    return frame(spark, COUNTERS, (7, name))


def test_counter_names(spark):
    df = frame(
        spark,
        COUNTERS,
        (1, "% Processor Time"),
        (2, "Processor % Time"),
        (3, "CPU % processor"),
        (4, "Processor Time"),
        (5, "Committed Bytes in Use"),
        (6, "bytes in use"),
        (7, None),
    )
    assert rows(cpu_counters(df), "monitorCounterId") == [(1,), (2,), (3,)]
    assert rows(mem_counters(df), "monitorCounterId") == [(5,)]


def test_hours_closed_on_both_ends(spark):
    df = hourly_rollup(_log(spark), _counters(spark))
    assert rows(df, "Hour", "Sum", "DataPoints") == [
        (0, 7.0, 3),
        (1, 4.0, 1),
        (23, 24.0, 2),
        (5, 128.0, 1),
    ]
    assert rows(df.where("Hour = 23"), "TheDate") == [(ts("2013-01-05T23:00:00"),)]


def test_half_open_hours(spark):
    df = hourly_rollup(_log(spark), _counters(spark), closed="left")
    assert rows(df, "Hour", "Sum", "DataPoints") == [
        (0, 3.0, 2),
        (1, 4.0, 1),
        (23, 8.0, 1),
        (5, 128.0, 1),
    ]


def test_closed_total_is_half_open_total_plus_readings_on_the_hour(spark):
    log, counters = _log(spark), _counters(spark)
    points = [
        hourly_rollup(log, counters, closed=c).agg(F.sum("DataPoints")).first()[0]
        for c in ("both", "left")
    ]
    on_hour = 2  # 01:00, and midnight at the end of the day
    assert points[0] == points[1] + on_hour


def test_zero_counts_for_cpu_only_and_a_counter_may_feed_both(spark):
    log = frame(
        spark,
        LOG,
        (1, 7, ts("2013-01-05T03:15:00"), 0.0, DAY),
        (1, 7, ts("2013-01-05T03:20:00"), 5.0, DAY),
    )
    counters = _counters(spark, "% Process bytes in use")
    df = component_rollup(log, counters)
    assert rows(df, "component", "Sum", "DataPoints") == [("CPU", 5.0, 2), ("MEM", 5.0, 1)]
    assert component_readings(log, counters, ["MEM"]).count() == 1


def test_daily_rollup_takes_the_whole_shard(spark):
    df = daily_rollup(_log(spark), _counters(spark), ["CPU"])
    assert rows(df, "TheDate", "Hour", "Sum", "DataPoints") == [
        (ts("2013-01-05T00:00:00"), 1, 255.0, 8)
    ]


def test_approximate_insert(spark):
    hour = ts("2013-01-05T03:00:00")
    stored = frame(spark, HOURS, (1, hour, 3, 10.0, 4))
    batch = frame(
        spark,
        HOURS,
        (1, hour, 3, 10.0000005, 4),
        (1, hour, 3, 10.00001, 4),
        (1, hour, 3, 10.0, 5),
    )
    keys = ["AgentGUID", "TheDate", "Hour", "DataPoints"]
    new = insert_new(batch, stored, keys, approx={"Sum": 1e-6})
    assert rows(new, "Sum", "DataPoints") == [(10.0, 5), (10.00001, 4)]


def test_insert_new_twice_is_once(spark):
    schema = "k long, v string"
    batch = frame(spark, schema, (1, "a"), (2, "b"), (3, None))
    stored = frame(spark, schema, (1, "a"), (1, "a"))
    new = insert_new(batch, stored, ["k"])
    assert rows(new, "k") == [(2,), (3,)]
    assert insert_new(batch, stored.unionByName(new), ["k"]).count() == 0
    # NULL equals nothing
    assert insert_new(batch, batch, ["k", "v"]).count() == 1


def test_insert_new_where_null_matches(spark):
    schema = "k long, v long"
    batch = frame(spark, schema, (1, 5), (2, 5), (3, 5), (4, None))
    stored = frame(spark, schema, (1, None), (2, 5), (3, 6), (4, 7))
    assert rows(insert_new(batch, stored, ["k"], null_matches=["v"]), "k") == [(3,), (4,)]


def test_load_if_slot_empty(spark):
    batch = frame(spark, "slot int, v int", (1, 1), (1, 2), (2, 3))
    stored = frame(spark, "slot int, v int", (2, 9))
    assert rows(load_if_slot_empty(batch, stored, ["slot"])) == [(1, 1), (1, 2)]


def test_components_report(spark):
    log = _log(spark).unionByName(
        frame(spark, LOG, (1, 8, ts("2013-01-07T04:30:00"), 3.0, day("2013-01-07")))
    )
    counters = frame(spark, COUNTERS, (7, "% Processor Time"), (8, "x bytes in use"))
    requests = frame(
        spark,
        REQUESTS,
        (1, "cpu", "2013-01-05", "2013-01-07"),
        (2, "mem", "2013-01-05", None),
        (3, "all", "2013-01-05", "2013-01-06"),
    )
    empty = frame(spark, HOURS)
    targets = {"CPU": empty, "MEM": empty}
    first = components_report(log, counters, requests, targets, "2013-03-14")
    # memory was not asked for on the 7th
    assert rows(first, "component", "Hour") == [
        ("CPU", 0),
        ("CPU", 1),
        ("CPU", 23),
        ("CPU", 5),
    ]
    stored = {"CPU": first.where("Hour = 0").drop("component"), "MEM": empty}
    second = components_report(log, counters, requests, stored, "2013-03-14")
    assert rows(second, "Hour") == [(1,), (23,), (5,)]
    daily = daily_components(log, counters, requests, "2013-03-14")
    assert rows(daily, "component", "DataPoints") == [("CPU", 8)]


def test_events_report(spark):
    one, two = day("2013-01-05"), day("2013-01-06")
    at = ts("2013-01-05T10:00:00")
    log = frame(
        spark,
        EVENTS,
        # a day without stored rows: dumped as it is
        (1, at, "a", one),
        (1, at, "a", one),
        (1, ts("2013-01-09T00:00:00"), "stray", one),
        # a day with stored rows: merged
        (1, ts("2013-01-06T10:00:00"), "b", two),
        (1, ts("2013-01-06T10:00:00"), "b", two),
        (1, ts("2013-01-06T11:00:00"), "stored", two),
        (1, ts("2013-01-07T00:00:00"), "stray", two),
        # not asked for
        (1, ts("2013-01-08T10:00:00"), "c", day("2013-01-08")),
    )
    stored = frame(spark, STORED_EVENTS, (1, ts("2013-01-06T11:00:00"), "stored"))
    requests = frame(spark, REQUESTS, (1, None, "2013-01-05", "2013-01-06"))
    new = events_report(log, requests, stored, "2013-03-14")
    assert rows(new, "EventTime", "Message") == [
        (at, "a"),
        (at, "a"),
        (ts("2013-01-06T10:00:00"), "b"),
        (ts("2013-01-09T00:00:00"), "stray"),
    ]
    again = events_report(log, requests, stored.unionByName(new), "2013-03-14")
    assert again.count() == 0


def test_long_messages_are_found_again(spark):
    long = "x" * 3000
    log = frame(spark, EVENTS, (1, ts("2013-01-05T10:00:00"), f" {long}", day("2013-01-05")))
    requests = frame(spark, REQUESTS, (1, None, "2013-01-05", None))
    stored = frame(spark, STORED_EVENTS)
    new = events_report(log, requests, stored, "2013-03-14", trim_message=True)
    assert rows(new, "Message") == [("x" * 2000,)]
    again = events_report(
        log, requests, stored.unionByName(new), "2013-03-14", trim_message=True
    )
    assert again.count() == 0


def test_outcome_counts(spark):
    df = frame(spark, "outcome string", ("inserted",), ("skipped",), ("inserted",))
    assert rows(outcome_counts(df)) == [("inserted", 2), ("skipped", 1)]


from slotledger.operators import merge  # noqa: E402


def test_slots_outside_the_calendar_are_tested_too(spark):
    """An occupied day before 1753 holds its batch back, for dates and for times."""
    for kind in ("date", "timestamp_ntz"):
        batch = spark.sql(f"SELECT CAST(d AS {kind}) AS d FROM VALUES ('1700-01-01'), ('2013-01-05'), ('2013-01-06') AS t(d)")
        held = spark.sql(f"SELECT CAST(d AS {kind}) AS d FROM VALUES ('1700-01-01'), ('2013-01-05') AS t(d)")
        assert merge.load_if_slot_empty(batch, held, ["d"]).count() == 1
