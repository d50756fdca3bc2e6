"""The jobs end to end, called like the stored procedures."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from frames import AUDITS, COUNTERS, DISKS, EVENTS, LOG, day, frame, rows, ts
from slotledger.operators.widen import ACTIVITY_COLUMNS, CONTACT_COLUMNS
from slotledger.plans import procedures as p
from slotledger.schemas import SOURCES
from slotledger.sources.tables import scan_report

AS_OF = "2013-03-14 06:00:00"
OUTCOMES = {"inserted": 0, "skipped": 0, "rejected": 0}


def _agent(df):
    return df.withColumn("agentGuid", F.col("agentGuid").cast("decimal(26,0)"))


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sources"))
    days = ["2013-01-05", "2013-01-07", "2013-03-13"]
    _agent(
        frame(spark, LOG, *[(9, 7, ts(f"{d}T08:30:00"), 2.0, day(d)) for d in days])
    ).write.partitionBy("log_date").parquet(f"{root}/log")
    _agent(
        frame(spark, EVENTS, *[(9, ts(f"{d}T08:30:00"), f"on {d}", day(d)) for d in days])
    ).write.partitionBy("log_date").parquet(f"{root}/events")
    given = {
        "monitorCounter": frame(spark, COUNTERS, (7, "% Process bytes in use")),
        "auditRsltDisks": _agent(
            frame(
                spark,
                DISKS,
                (9, 1, 1, "C", "Data", "Fixed", 2048.0, 1024.0),
                (9, 2, 1, "D", "Data", "Fixed", 2048.0, 1024.0),
            )
        ),
        "auditRsltDate": _agent(frame(spark, AUDITS, (9, 1, 1, ts("2013-03-06T01:00:00")))),
        "machNameTab": _agent(
            frame(spark, "agentGuid long, machName string, groupName string", (9, "srv", "g"))
        ),
        "auditRsltManualFields": frame(
            spark, "id long, fieldName string", (1, "ReportingEnabled")
        ),
        "auditRsltManualFieldValues": _agent(
            frame(spark, "agentGuid long, fieldNameFK long, fieldValue string", (9, 1, "Yes"))
        ),
        "auditRsltSimm": _agent(
            frame(spark, "agentGuid long, memSize string", (9, "2GB"), (9, "two"))
        ),
        "userIpInfo": _agent(
            frame(spark, "agentGuid long, ipAddress string, osInfo string", (9, "10.0.0.9", "W"))
        ),
    }
    for name, schema in SOURCES.items():
        df = given.get(name)
        if df is None:
            df = spark.createDataFrame([], schema)
        df.write.parquet(f"{root}/tables/{name}")
    return root


def test_components(spark, sources, tmp_path):
    def run(*args):
        return p.report_components(
            spark, f"{sources}/log", f"{sources}/tables", str(tmp_path), AS_OF, *args
        )

    def outcome(cpu, mem, skipped=0, rejected=0):
        return {"CPU": cpu, "MEM": mem, "skipped": skipped, "rejected": rejected}

    assert run() == outcome(1, 1)  # yesterday
    assert run("ALL", 1) == outcome(0, 0, skipped=2)
    assert run("cpu", 0) == outcome(0, 0)  # today has no shard
    assert run("MEM", "2013-01-05") == outcome(0, 1)
    assert run("ALL", "2013/01/07", "2013-01-05") == outcome(2, 1, skipped=1)
    stored = scan_report(spark, str(tmp_path), "CPU")
    assert rows(stored, "TheDate", "Hour", "Sum", "DataPoints") == [
        (ts(f"{d}T08:00:00"), 8, 2.0, 1) for d in ("2013-01-05", "2013-01-07", "2013-03-13")
    ]
    assert stored.select("RecID").distinct().count() == 3


def test_events(spark, sources, tmp_path):
    def run(*args):
        return p.report_events(spark, f"{sources}/events", str(tmp_path), AS_OF, *args)

    assert run() == OUTCOMES | {"inserted": 1}
    assert run("2013-01-05", "2013-01-07") == OUTCOMES | {"inserted": 2}
    assert run("2013-01-05", "2013-03-13") == OUTCOMES | {"skipped": 3}


def test_events_without_a_message(spark, tmp_path):
    at = "2013-01-05"
    _agent(
        frame(
            spark,
            EVENTS,
            (9, ts(f"{at}T08:30:00"), "a", day(at)),
            (9, ts(f"{at}T08:30:00"), None, day(at)),
            (None, ts(f"{at}T08:30:00"), "b", day(at)),
        )
    ).write.partitionBy("log_date").parquet(f"{tmp_path}/log")
    runs = [
        p.report_events(spark, f"{tmp_path}/log", f"{tmp_path}/reports", AS_OF, at)
        for _ in range(3)
    ]
    assert runs == [
        {"inserted": 1, "skipped": 0, "rejected": 2},
        {"inserted": 0, "skipped": 1, "rejected": 2},
        {"inserted": 0, "skipped": 1, "rejected": 2},
    ]


def test_daily_components(spark, sources, tmp_path):
    args = spark, f"{sources}/log", f"{sources}/tables", str(tmp_path), AS_OF
    for _ in range(2):  # always appended
        assert p.report_daily_components(*args, "CPU", "2013-01-05", "2013-01-07") == {
            "CPU": 2,
            "MEM": 0,
        }
    stored = scan_report(spark, str(tmp_path), "CPU")
    assert rows(stored, "TheDate", "Hour", "DataPoints") == [
        (ts(d), 1, 1) for d in ("2013-01-05", "2013-01-05", "2013-01-07", "2013-01-07")
    ]


def test_activities(spark, tmp_path):
    columns = [*CONTACT_COLUMNS.values(), *ACTIVITY_COLUMNS.values()]
    spark.range(6).selectExpr(
        "concat('o', id % 2) AS owner",
        "'Ann' AS contact",
        "id AS created_on",
        *[f"concat('{c}', id) AS {c}" for c in columns if c not in ("owner", "contact", "created_on")],
    ).withColumns({"account": F.lit("a"), "lead_source": F.lit(None).cast("string")}).createOrReplaceTempView("activity")
    for _ in range(2):
        p.report_activities(spark, "activity", str(tmp_path / "wide"))
    wide = spark.read.parquet(str(tmp_path / "wide"))
    # as many columns as the contact has activities, though each owner has half of them
    assert "6 Subject" in wide.columns and "7 Subject" not in wide.columns
    assert rows(wide, "Owner", "1 Subject", "3 Subject", "4 Subject") == [
        ("o0", "subject0", "subject4", None),
        ("o1", "subject1", "subject5", None),
    ]
    p.report_activities(spark, "activity", str(tmp_path / "paged"), 2)
    assert spark.read.parquet(str(tmp_path / "paged")).count() == 4


def test_weekly_disks(spark, sources, tmp_path):
    def run(*args):
        return p.report_weekly_disks(spark, f"{sources}/tables", str(tmp_path), AS_OF, *args)

    assert run() == OUTCOMES | {"inserted": 1}  # eight days back
    assert run(1) == OUTCOMES | {"skipped": 1}  # the same week
    assert run("2013-03-06") == OUTCOMES | {"skipped": 1}
    assert run(0) == OUTCOMES  # no audit this week
    assert rows(scan_report(spark, str(tmp_path), "Disk"), "YearNum", "WeekNum", "DriveName") == [
        (2013, 10, "C")
    ]


def test_current_disks(spark, sources, tmp_path):
    for _ in range(2):
        assert p.report_current_disks(spark, f"{sources}/tables", str(tmp_path), AS_OF) == {
            "inserted": 1,
            "skipped": 1,
            "rejected": 0,
        }
    # always appended
    assert scan_report(spark, str(tmp_path), "Disk").count() == 2


def test_servers(spark, sources, tmp_path):
    def run(as_of):
        return p.report_servers(spark, f"{sources}/tables", str(tmp_path), as_of)

    assert run(AS_OF) == OUTCOMES | {"inserted": 1, "unreadable": 1}
    assert run(AS_OF) == OUTCOMES | {"skipped": 1, "unreadable": 1}
    assert run("2013-04-01") == OUTCOMES | {"inserted": 1, "unreadable": 1}
    assert rows(scan_report(spark, str(tmp_path), "Servers"), "TheDate", "Cores") == [
        (ts("2013-03-01"), 0),
        (ts("2013-04-01"), 0),
    ]
