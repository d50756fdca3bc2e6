"""One key, day or copy with a third of all rows: results against plain Python."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

import pytest

from frames import COUNTERS, REQUESTS, STORED_EVENTS, frame, ts
from slotledger.operators import slots
from slotledger.operators.latest import latest_audits
from slotledger.operators.rollup import component_rollup
from slotledger.plans.jobs import events_report, weekly_disk_report

N = 30_000
AS_OF = "2013-03-14"


@pytest.fixture(scope="module")
def log(spark):
    """A hot machine, a hot hour boundary, values around zero."""
    return spark.range(0, N, 1, 16).selectExpr(
        "IF(id % 3 = 0, 1, id % 500) AS agentGuid",
        "id % 4 AS monitorCounterId",
        "TIMESTAMP_NTZ'2013-01-05' + make_dt_interval(0, 0, IF(id % 5 = 0, 60, id % 1441)) "
        "AS eventDateTime",
        "CAST(id % 11 - 2 AS double) AS counterValue",
        "DATE'2013-01-05' AS log_date",
    )


def test_rollup_with_a_hot_machine(spark, log):
    counters = frame(
        spark, COUNTERS, (0, "% Processor"), (1, "x bytes in use"), (2, "% Process bytes in use")
    )
    feeds = {0: ["CPU"], 1: ["MEM"], 2: ["CPU", "MEM"]}
    day = ts("2013-01-05")
    expected = defaultdict(lambda: [0.0, 0])
    for agent, counter, at, value, _ in log.collect():
        for component in feeds.get(counter, []):
            if value < 0 or (component == "MEM" and value == 0):
                continue
            for hour in range(24):
                start = day + dt.timedelta(hours=hour)
                if start <= at <= start + dt.timedelta(hours=1):
                    slot = expected[component, agent, start, hour]
                    slot[0] += value
                    slot[1] += 1
    got = {tuple(r)[:4]: list(tuple(r)[4:]) for r in component_rollup(log, counters).collect()}
    assert got == dict(expected)


def test_many_copies_of_one_event(spark):
    events = spark.range(0, N, 1, 16).selectExpr(
        "IF(id % 3 = 0, 1, id % 700) AS agentGuid",
        "IF(id % 3 = 0, TIMESTAMP_NTZ'2013-01-05 01:00:00', "
        "TIMESTAMP_NTZ'2013-01-05' + make_dt_interval(0, 0, id % 1440)) AS eventTime",
        "IF(id % 3 = 0, 'copy', CONCAT('m', id % 9)) AS message",
        "DATE'2013-01-05' AS log_date",
    )
    requests = frame(spark, REQUESTS, (1, None, "2013-01-05", None))
    # an empty day keeps every copy
    empty = frame(spark, STORED_EVENTS)
    assert events_report(events, requests, empty, AS_OF).count() == N
    # copies already stored, many times over
    stored = events.where("agentGuid = 1").selectExpr(
        "agentGuid AS AgentGUID", "eventTime AS EventTime", "message AS Message"
    )
    new = events_report(events, requests, stored, AS_OF)
    rows = {tuple(r)[:3] for r in events.collect()}
    held = {tuple(r) for r in stored.collect()}
    got = [tuple(r) for r in new.collect()]
    assert len(got) == len(set(got))
    assert set(got) == rows - held


def test_latest_audit_of_a_hot_machine(spark):
    audits = spark.range(0, N, 1, 16).selectExpr(
        "IF(id % 3 = 0, 1, id % 900) AS agentGuid",
        "CAST(id % 3 + 1 AS int) AS resultGroup",
        "CAST(id % 2 AS int) AS locked",
        "TIMESTAMP_NTZ'2013-01-01' + make_dt_interval(CAST(id * 7919 % 90 AS int)) AS date",
    )
    best: dict[int, tuple] = {}
    for agent, group, locked, at in audits.collect():
        key = (-at.timestamp(), group, locked)
        best[agent] = min(best.get(agent, key), key)
    got = {r[0]: (-r[3].timestamp(), r[1], r[2]) for r in latest_audits(audits).collect()}
    assert got == best


def test_weekly_disks_of_a_hot_machine(spark):
    """A machine with a third of the disks and of the audits: no disk-audit pairs."""
    disks = spark.range(0, N, 1, 16).selectExpr(
        "IF(id % 3 = 0, 1, id % 900) AS agentGuid",
        "1 AS resultGroup",
        "1 AS locked",
        "CONCAT('drive', id % 4) AS driveLetter",
        "'Data' AS volumeName",
        "'Fixed' AS type",
        "CAST(1024 + id AS double) AS totalMBytes",
        "1.0D AS freeMBytes",
    )
    audits = spark.range(0, N, 1, 16).selectExpr(
        "IF(id % 3 = 0, 1, id % 900) AS agentGuid",
        "1 AS resultGroup",
        "1 AS locked",
        "TIMESTAMP_NTZ'2013-01-06' + make_dt_interval(0, 0, CAST(id % 20160 AS int)) AS date",
    )
    requests = frame(spark, REQUESTS, (1, None, "2013-01-06", "2013-01-13"))
    stored = spark.createDataFrame(
        [], "AgentGUID long, YearNum int, WeekNum int, DiskLabel string, DriveName string"
    )
    size: dict[tuple, float] = {}
    for r in disks.collect():
        key = (r["agentGuid"], r["driveLetter"])
        size[key] = min(size.get(key, r["totalMBytes"]), r["totalMBytes"])
    stamp: dict[tuple, dt.datetime] = {}
    for r in audits.collect():
        key = (r["agentGuid"], 2 + (r["date"] - ts("2013-01-06")).days // 7)
        stamp[key] = max(stamp.get(key, r["date"]), r["date"])
    expected = {
        (agent, week, drive, total / 1024, at)
        for (agent, drive), total in size.items()
        for (owner, week), at in stamp.items()
        if owner == agent
    }
    new = weekly_disk_report(disks, audits, requests, stored, AS_OF)
    got = [
        (r["AgentGUID"], r["WeekNum"], r["DriveName"], r["TotalSpaceGB"], r["Stamp"])
        for r in new.collect()
    ]
    assert len(got) == len(expected)
    assert set(got) == expected


def test_windows_meet_the_rows_of_one_bin_in_several_tasks(spark, monkeypatch):
    for name, value in (("BLOCK_ROWS", 100), ("BLOCK_WINDOWS", 7), ("TASK_PAIRS", 2_000)):
        monkeypatch.setattr(slots, name, value, raising=False)
    # equal rows and equal windows, all of one bin but for a few; a row without a time
    events = spark.range(0, 2_000, 1, 16).selectExpr(
        "id % 50 AS agentGuid",
        "CASE WHEN id = 7 THEN NULL WHEN id % 100 = 0 THEN TIMESTAMP_NTZ'2013-02-01 12:00:00' ELSE TIMESTAMP_NTZ'2013-01-05 01:00:00' END AS eventTime",
    )
    windows = spark.range(0, 30).selectExpr(
        "id % 10 AS window_id",
        "TIMESTAMP_NTZ'2013-01-05 00:59:00' AS window_start",
        "CASE id % 10 WHEN 0 THEN NULL WHEN 1 THEN TIMESTAMP_NTZ'2013-01-05 01:00:00' WHEN 2 THEN TIMESTAMP_NTZ'2013-03-05 00:00:00'"
        " ELSE TIMESTAMP_NTZ'2013-01-05 01:00:01' END AS window_end",
    )
    expected = sorted(
        (agent, at, *window)
        for agent, at in events.collect()
        for window in windows.collect()
        if at and window[2] and window[1] <= at < window[2]
    )
    # a threshold of nothing stands for windows too many to broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = slots.join_windows(events, "eventTime", windows)
        tasks = met.selectExpr("spark_partition_id() AS task").distinct().count()
        got = sorted(tuple(r) for r in met.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == expected and len(got) > 40_000
    assert tasks > 4


def _met(events, windows):
    every = windows.collect()
    return sorted(
        (agent, at, *window)
        for agent, at in events.collect()
        for window in every
        if at and window[1] and window[2] and window[1] <= at < window[2]
    )


def _dealt(monkeypatch):
    """The sides of joins of windows as they are shuffled: rows, then windows."""
    sides, dealt = [], slots._in_blocks
    monkeypatch.setattr(slots, "_in_blocks", lambda *args: sides.append(dealt(*args)) or sides[-1])
    return sides


def test_windows_of_several_sizes_take_one_copy_of_each_row(spark, monkeypatch):
    monkeypatch.setattr(slots, "TASK_PAIRS", 10_000)
    sides = _dealt(monkeypatch)
    events = spark.range(0, 20_000, 1, 4).selectExpr("id AS agentGuid", "TIMESTAMP_NTZ'2013-01-01' + make_dt_interval(0, CAST(id % 480 AS INT)) AS eventTime")
    windows = spark.range(0, 60).selectExpr(
        "id AS window_id",
        "TIMESTAMP_NTZ'2013-01-01' + make_dt_interval(0, 0, CAST(id * 397 AS INT)) AS window_start",
        "TIMESTAMP_NTZ'2013-01-01' + make_dt_interval(0, 0, CAST(id * 397 AS INT) + CASE id % 3 WHEN 0 THEN 90 WHEN 1 THEN 2880 ELSE 17280 END) AS window_end",
    )
    met = slots.join_windows(events, "eventTime", windows)
    rows, placed = (side.count() for side in sides)
    assert rows == 20_000 and placed < 20_000
    assert sorted(tuple(r) for r in met.collect()) == _met(events, windows)


def test_a_bin_of_many_pairs_is_shuffled_in_few_copies(spark, monkeypatch):
    sides = _dealt(monkeypatch)
    events = spark.range(0, 10_000, 1, 4).selectExpr("id AS agentGuid", "TIMESTAMP_NTZ'2013-01-05 01:00:00' AS eventTime")
    windows = spark.range(0, 10_000, 1, 4).selectExpr(
        "id AS window_id", "TIMESTAMP_NTZ'2013-01-05 01:00:00' AS window_start", "TIMESTAMP_NTZ'2013-01-05 01:00:01' AS window_end"
    )
    slots.join_windows(events, "eventTime", windows)
    assert sum(side.count() for side in sides) <= 40_000


@pytest.mark.parametrize("most", [3, 65_536])
def test_windows_meet_rows_once_however_they_are_cut(spark, monkeypatch, most):
    for name, value in (("TASK_PAIRS", 500), ("MAX_BLOCK_PAIRS", 500), ("BLOCK_ROWS", 40), ("BLOCK_WINDOWS", 6), ("MAX_WINDOW_BINS", most)):
        monkeypatch.setattr(slots, name, value, raising=False)
    # a minute with a third of the rows, another that no window reaches, rows without a time
    events = spark.range(0, 1_500, 1, 6).selectExpr(
        "id % 40 AS agentGuid",
        "CASE WHEN id % 50 = 3 THEN NULL WHEN id % 3 = 0 THEN TIMESTAMP_NTZ'2013-01-05 01:00:00.5' WHEN id % 7 = 0 THEN TIMESTAMP_NTZ'2019-01-05 01:00:00'"
        " ELSE TIMESTAMP_NTZ'2013-01-01' + make_dt_interval(0, 0, 0, id * 773 % 864000) END AS eventTime",
    )
    # lengths of a second to a month, some before all rows, some of many years, some empty or without a bound
    windows = spark.range(0, 120).selectExpr("id AS window_id", "TIMESTAMP_NTZ'2013-01-01' + make_dt_interval(0, 0, CAST(id * 131 AS INT), 0.25) AS at").selectExpr(
        "window_id % 60 AS window_id",
        "CASE WHEN window_id = 11 THEN NULL WHEN window_id = 12 THEN TIMESTAMP_NTZ'0001-01-01' WHEN window_id % 20 = 4 THEN TIMESTAMP_NTZ'2013-01-05 01:00:00'"
        " WHEN window_id = 14 THEN TIMESTAMP_NTZ'1990-01-01' ELSE at END AS window_start",
        "CASE WHEN window_id = 12 THEN TIMESTAMP_NTZ'2013-01-09' WHEN window_id % 20 = 4 THEN TIMESTAMP_NTZ'2013-01-05 01:00:01' WHEN window_id = 14 THEN TIMESTAMP_NTZ'1990-02-01'"
        " ELSE at + make_dt_interval(0, 0, 0, CAST(element_at(array(0, 1, 50, 4000, 90000, 2600000, -5), CAST(window_id % 7 + 1 AS INT)) AS DOUBLE)) END AS window_end",
    )
    for some in (events, events.where("agentGuid < 0")):
        got = sorted(tuple(r) for r in slots.join_windows(some, "eventTime", windows).collect())
        assert got == _met(some, windows)
        assert len(got) > 3_000 or some is not events
    assert slots.join_windows(events, "eventTime", windows.where("window_id < 0")).count() == 0


def test_rows_and_windows_that_meet_nothing_are_not_shuffled_in_bulk(spark, monkeypatch):
    for name, value in (("TASK_PAIRS", 500), ("BLOCK_ROWS", 100), ("BLOCK_WINDOWS", 10)):
        monkeypatch.setattr(slots, name, value, raising=False)
    sides = _dealt(monkeypatch)
    # the second day has rows only, the third windows only; the last row makes them lie between rows
    events = spark.range(0, 2_001).selectExpr(
        "id AS agentGuid",
        "CASE WHEN id = 2000 THEN TIMESTAMP_NTZ'2013-01-30' WHEN id % 2 = 0 THEN TIMESTAMP_NTZ'2013-01-01' ELSE TIMESTAMP_NTZ'2013-01-02' END AS eventTime",
    )
    windows = spark.range(0, 40).selectExpr("id AS window_id", "TIMESTAMP_NTZ'2013-01-01' + make_dt_interval(IF(id % 2 = 0, 0, 2)) AS window_start").selectExpr(
        "*", "window_start + make_dt_interval(0, 0, 0, 1) AS window_end"
    )
    met = slots.join_windows(events, "eventTime", windows)
    parts = sides[0].selectExpr("date(eventTime) AS day").groupBy("day").count().collect()
    assert {r["day"].day for r in parts} == {1, 30}
    assert {r["day"].day for r in sides[1].selectExpr("date(window_start) AS day").distinct().collect()} == {1}
    assert met.count() == 20_000
