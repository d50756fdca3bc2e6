"""Write and read back, in the test's own folder."""

from __future__ import annotations

import datetime as dt
import glob
import re

from pyspark.sql import functions as F

from frames import COUNTERS, EVENTS, HOURS, LOG, REQUESTS, day, frame, rows, ts
from slotledger.operators.slots import day_slots, resolve_requests
from slotledger.operators.widen import ACTIVITY_COLUMNS, CONTACT_COLUMNS
from slotledger.plans.jobs import components_report, events_report
from slotledger.schemas import COUNTER_LOG, REPORTS, SOURCES
from slotledger.sinks.reports import (
    append_components,
    append_report,
    create_report_tables,
    rec_id,
    sorted_write,
    write_wide,
)
from slotledger.sources.tables import (
    contact_activity,
    in_file_order,
    load_tables,
    scan_counter_log,
    scan_day_shards,
    scan_day_tables,
    scan_event_log,
    scan_report,
)

AS_OF = "2013-03-14"


def _days(spark, first, last=None):
    return day_slots(resolve_requests(frame(spark, REQUESTS, (1, None, first, last)), AS_OF))


def _write_log(spark, path, schema, log_rows):
    frame(spark, schema, *log_rows).withColumn(
        "agentGuid", F.col("agentGuid").cast("decimal(26,0)")
    ).write.partitionBy("log_date").parquet(path)


def _counter_rows():
    return [
        (1, 7, ts(f"2013-01-0{d}T03:30:00"), float(d), day(f"2013-01-0{d}")) for d in (4, 5, 7)
    ]


def test_counter_log_days(spark, tmp_path):
    path = str(tmp_path / "log")
    _write_log(spark, path, LOG, _counter_rows())
    assert scan_counter_log(spark, path).count() == 3
    # the 6th has no shard
    scan = scan_counter_log(spark, path, _days(spark, "2013-01-05", "2013-01-07"))
    assert scan.columns == COUNTER_LOG.names
    assert rows(scan, "counterValue") == [(5.0,), (7.0,)]
    assert scan_counter_log(spark, path, _days(spark, "2013-01-06")).count() == 0


def test_only_the_partitions_asked_for_are_read(spark, tmp_path):
    path = str(tmp_path / "log")
    _write_log(spark, path, LOG, _counter_rows())
    scan = scan_counter_log(spark, path, _days(spark, "2013-01-05", "2013-01-07"))
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert "LeftSemi, BuildRight" in plan
    files = scan.select(F.input_file_name()).distinct().collect()
    assert {f[0].split("log_date=")[1][:10] for f in files} == {"2013-01-05", "2013-01-07"}


def test_one_table_per_day(spark):
    frame(spark, LOG, *_counter_rows()[:1]).drop("log_date").write.mode("overwrite").saveAsTable(
        "monitorCounterLog20130104"
    )
    try:
        days = [day("2013-01-03"), day("2013-01-04")]
        log = scan_day_tables(spark, "monitorCounterLog", days, COUNTER_LOG)
        assert rows(log, "counterValue", "log_date") == [(4.0, day("2013-01-04"))]
        slots = _days(spark, "2013-01-03", "2013-01-05")
        assert scan_day_tables(spark, "monitorCounterLog", slots, COUNTER_LOG).count() == 1
        none = scan_day_tables(spark, "monitorCounterLog", days[:1], COUNTER_LOG)
        assert none.columns == COUNTER_LOG.names and none.count() == 0
    finally:
        spark.sql("DROP TABLE monitorCounterLog20130104")


def test_load_tables(spark, tmp_path):
    for name, schema in SOURCES.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}")
    tables = load_tables(spark, str(tmp_path))
    assert set(tables) == set(SOURCES)
    assert all(tables[n].schema.names == s.names for n, s in SOURCES.items())


def test_view_as_source(spark):
    columns = [*CONTACT_COLUMNS.values(), *ACTIVITY_COLUMNS.values()]
    spark.range(2).select(F.lit(1).alias("other"), *[F.col("id").alias(c) for c in columns]).createOrReplaceTempView("contact_view")
    activity = contact_activity(spark, "contact_view")
    assert activity.columns == columns and activity.count() == 2


def test_events_load_is_idempotent(spark, tmp_path):
    path, reports = str(tmp_path / "log"), str(tmp_path / "reports")
    _write_log(
        spark,
        path,
        EVENTS,
        [
            (1, ts("2013-01-05T10:00:00"), "a", day("2013-01-05")),
            (1, ts("2013-01-05T10:00:00"), "a", day("2013-01-05")),
            (2, ts("2013-01-06T10:00:00"), "b", day("2013-01-06")),
        ],
    )
    requests = frame(spark, REQUESTS, (1, None, "2013-01-05", "2013-01-06"))

    def run(as_of):
        log = scan_event_log(spark, path)
        stored = scan_report(spark, reports, "NTEvent")
        return append_report(
            events_report(log, requests, stored, as_of), reports, "NTEvent", as_of
        )

    assert run("2013-03-14 01:02:03") == 3
    assert run("2013-03-15") == 0
    stored = scan_report(spark, reports, "NTEvent")
    assert stored.columns == REPORTS["NTEvent"].stored.names
    assert rows(stored, "Message", "RecCreatedOn") == [
        ("a", ts("2013-03-14T01:02:03")),
        ("a", ts("2013-03-14T01:02:03")),
        ("b", ts("2013-03-14T01:02:03")),
    ]
    one_day = scan_report(spark, reports, "NTEvent", _days(spark, "2013-01-06"))
    assert rows(one_day, "Message") == [("b",)]
    assert len(glob.glob(f"{reports}/NTEvent/SlotDate=*")) == 2


def test_components_load_is_idempotent(spark, tmp_path):
    path, reports = str(tmp_path / "log"), str(tmp_path / "reports")
    _write_log(spark, path, LOG, _counter_rows())
    counters = frame(spark, COUNTERS, (7, "% Process bytes in use"))
    requests = frame(spark, REQUESTS, (1, None, "2013-01-04", "2013-01-07"))

    def run():
        targets = {
            "CPU": scan_report(spark, reports, "CPU"),
            "MEM": scan_report(spark, reports, "Memory"),
        }
        log = scan_counter_log(spark, path)
        new = components_report(log, counters, requests, targets, AS_OF)
        return append_components(new, reports, AS_OF)

    assert run() == {"CPU": 3, "MEM": 3}
    assert run() == {"CPU": 0, "MEM": 0}
    stored = scan_report(spark, reports, "Memory")
    assert rows(stored, "Hour", "Sum", "DataPoints") == [(3, 4.0, 1), (3, 5.0, 1), (3, 7.0, 1)]


def test_the_log_is_read_once(spark, tmp_path):
    """Both reports are stored, so the first write changes what the second one was compared to."""
    path, reports = str(tmp_path / "log"), str(tmp_path / "reports")
    _write_log(spark, path, LOG, _counter_rows())
    counters = frame(spark, COUNTERS, (7, "% Process bytes in use"))
    requests = frame(spark, REQUESTS, (1, None, "2013-01-04", "2013-01-07"))
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(value):
        read.add(1)
        return value

    def run(factor):
        targets = {
            "CPU": scan_report(spark, reports, "CPU"),
            "MEM": scan_report(spark, reports, "Memory"),
        }
        log = scan_counter_log(spark, path).withColumn(
            "counterValue", counted.asNondeterministic()("counterValue") * factor
        )
        new = components_report(log, counters, requests, targets, AS_OF)
        return append_components(new, reports, AS_OF)

    assert run(1) == {"CPU": 3, "MEM": 3}
    assert read.value == 3
    assert run(2) == {"CPU": 3, "MEM": 3}
    assert read.value == 6


def test_report_tables(spark, tmp_path):
    directory = str(tmp_path)
    names = create_report_tables(spark, directory)
    try:
        assert all(spark.table(n).count() == 0 for n in names)
        batch = frame(spark, HOURS, (1, ts("2013-01-05T03:00:00"), 3, 1.5, 2))
        append_report(batch, directory, "CPU", AS_OF)
        disk = frame(
            spark,
            "AgentGUID long, YearNum int, WeekNum int, DiskLabel string, DriveName string, "
            "TotalSpaceGB double, FreeSpaceGB double, Stamp timestamp_ntz",
            (1, 2013, 1, "Data", "C", 2.0, 1.0, ts("2013-01-05")),
        )
        append_report(disk, directory, "Disk", AS_OF)
        # without another create
        assert rows(spark.table("CPU"), "Hour", "Sum") == [(3, 1.5)]
        append_report(batch, directory, "CPU", AS_OF)
        assert spark.table("CPU").count() == scan_report(spark, directory, "CPU").count() == 2
        # a report of the same name elsewhere is not the table
        append_report(batch, f"{directory}/other", "CPU", AS_OF)
        assert spark.table("CPU").count() == 2
        assert rows(spark.table("Disk"), "YearNum", "DriveName") == [(2013, "C")]
        # replacing empties every report but the disks
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        create_report_tables(spark, directory, replace=True)
        assert spark.table("CPU").count() == scan_report(spark, directory, "CPU").count() == 0
        assert spark.table("Disk").count() == 1
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_rec_ids_tell_rows_apart(spark):
    df = frame(spark, "a string, b string", ("x|", "y"), ("x", "|y"), ("x", None), ("x", "\\N"), (None, "x"))
    assert df.select(rec_id(["a", "b"])).distinct().count() == 5


def test_sorted_writes(spark, tmp_path):
    """A value that a third of the rows share is spread over files, and all files by name are in order."""
    path = str(tmp_path / "sorted")
    df = spark.range(30_000).selectExpr(
        "IF(id % 3 = 0, 50, IF(id % 97 = 0, NULL, id * 37 % 100)) AS k", "id * 7919 % 30000 AS v"
    )
    sorted_write(df, path, ["k"], files=12)
    found = sorted(in_file_order(spark, path).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in found] == list(range(1, 30_001))
    keys = [r["k"] for r in found]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    names = [r["file_name"] for r in found]
    assert names == sorted(names)
    assert len(set(names)) >= 8
    assert len({r["file_name"] for r in found if r["k"] == 50}) >= 3
    sorted_write(df.limit(10), path, ["k", "v"])
    assert in_file_order(spark, path).count() == 10


def test_wide_writes(spark, tmp_path):
    df = spark.range(100).selectExpr("id * 37 % 100 AS k", "CAST(id AS string) AS `1 Subject`")
    for _ in range(2):
        write_wide(df, str(tmp_path / "wide"))
    assert spark.read.parquet(str(tmp_path / "wide")).count() == 100


def test_day_shards_are_one_scan(spark, tmp_path):
    """However many days are read, the plan stays the same."""
    log = frame(spark, LOG, *_counter_rows()[:1]).drop("log_date").withColumn("agentGuid", F.col("agentGuid").cast("decimal(26,0)"))
    days = [day("2013-01-01") + dt.timedelta(k) for k in range(40)]
    for d in days:
        if d.day % 4:
            log.withColumn("counterValue", F.lit(float(d.toordinal()))).coalesce(1).write.parquet(f"{tmp_path}/Log{d:%Y%m%d}")
    frame(spark, LOG).write.parquet(f"{tmp_path}/LogOther")
    few, all_days = (scan_day_shards(spark, str(tmp_path), "log", d, COUNTER_LOG) for d in (days[:2], days))
    assert few.columns == all_days.columns == COUNTER_LOG.names
    sizes = [len(re.sub(r"InMemoryFileIndex.*?\]", "", x._jdf.queryExecution().executedPlan().toString())) for x in (few, all_days)]
    assert abs(sizes[0] - sizes[1]) < 20
    assert rows(few, "log_date") == [(d,) for d in days[:2] if d.day % 4]
    got = all_days.select("log_date", "counterValue").collect()
    assert sorted((r[0], r[1]) for r in got) == [(d, float(d.toordinal())) for d in days if d.day % 4]
    assert scan_day_shards(spark, str(tmp_path), "Log", [day("2013-01-04")], COUNTER_LOG).count() == 0
    asked = _days(spark, "2013-01-03", "2013-01-05")
    assert rows(scan_day_shards(spark, str(tmp_path), "Log", asked, COUNTER_LOG), "log_date") == [(day("2013-01-03"),), (day("2013-01-05"),)]


def test_day_tables_are_one_scan(spark):
    names = [f"oneScanLog2013010{k}" for k in range(1, 6)]
    try:
        for k, name in enumerate(names):
            df = frame(spark, LOG, (k, 7, ts("2013-01-04T03:30:00"), float(k), day("2013-01-04"))).drop("log_date")
            df = df.withColumn("agentGuid", F.col("agentGuid").cast("decimal(26,0)"))
            if k == 4:
                df.createOrReplaceTempView(name)  # not a table in a folder of its own
            else:
                df.write.mode("overwrite").saveAsTable(name)
        log = scan_day_tables(spark, "oneScanLog", [day(f"2013-01-0{k}") for k in range(1, 8)], COUNTER_LOG)
        assert sorted(map(tuple, log.select("log_date", "counterValue").collect())) == [(day(f"2013-01-0{k + 1}"), float(k)) for k in range(5)]
        assert log._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    finally:
        for name in names[:4]:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.dropTempView(names[4])
