from __future__ import annotations

from pyspark.sql import functions as F

from frames import AUDITS, DISKS, REQUESTS, day, frame, rows, ts
from slotledger.functions.text import size_to_mb
from slotledger.operators.filters import current_disk_filter, weekly_disk_filter
from slotledger.operators.inventory import memory_installed, unreadable_sizes
from slotledger.operators.latest import join_back_latest, latest_audits, latest_stamp, top_one
from slotledger.operators.slots import resolve_requests, week_slots
from slotledger.plans.jobs import (
    current_disk_outcomes,
    current_disk_report,
    servers_snapshot,
    snapshot_outcomes,
    weekly_disk_report,
)

AS_OF = "2013-03-14"
STORED_DISKS = (
    "AgentGUID long, YearNum int, WeekNum int, DiskLabel string, DriveName string, "
    "TotalSpaceGB double, FreeSpaceGB double, Stamp timestamp_ntz"
)


def _disk(agent=1, group=1, locked=1, drive="C", label="Data", kind="Fixed", total=2048.0, free=1.0):
    return (agent, group, locked, drive, label, kind, total, free)


def test_current_disk_filter(spark):
    kept = _disk(label="ok")
    df = frame(
        spark,
        DISKS,
        kept,
        _disk(total=0.0),
        _disk(kind="a cdrom"),
        _disk(label="Pagefile"),
        _disk(label="Page File"),
        _disk(label="SwapVol"),
        _disk(label=None),
    )
    assert rows(current_disk_filter(df)) == [kept]


def test_weekly_disk_filter(spark):
    df = frame(
        spark,
        DISKS,
        _disk(drive="1", total=0.0),
        _disk(drive="2", kind="Removable", total=1.0),
        _disk(drive="3", kind="Removable", total=0.0),
        _disk(drive="4", kind="CDROM"),
        _disk(drive="5", label="the Page File"),
        _disk(drive="6", label="pagefile"),
    )
    assert rows(weekly_disk_filter(df), "driveLetter") == [("1",), ("2",), ("6",)]


def test_current_disk_report(spark):
    disks = frame(spark, DISKS, _disk(1), _disk(1, group=2), _disk(2))
    audits = frame(
        spark,
        AUDITS,
        (1, 2, 1, ts("2013-01-01")),
        (1, 1, 1, ts("2013-02-01")),
        # the same instant: the smaller group wins
        (1, 2, 1, ts("2013-02-01")),
    )
    assert rows(latest_audits(audits)) == [(1, 1, 1, ts("2013-02-01"))]
    df = current_disk_report(disks, audits, AS_OF)
    assert rows(df, "AgentGUID", "YearNum", "WeekNum", "TotalSpaceGB", "Stamp") == [
        (1, 2013, 11, 2.0, ts("2013-02-01"))
    ]
    assert rows(current_disk_outcomes(disks, audits)) == [("inserted", 1), ("skipped", 2)]


def test_weekly_disk_report(spark):
    disks = frame(
        spark,
        DISKS,
        _disk(total=4096.0),
        _disk(total=2048.0),
        _disk(drive=" C ", total=1024.0),
        _disk(drive="D", locked=0),
        # qualifies by one row, sized by another that is locked but in no group
        _disk(drive="E", locked=0),
        _disk(drive="E", group=9, kind="other", total=512.0),
    )
    audits = frame(
        spark,
        AUDITS,
        (1, 1, 1, ts("2013-01-01T08:00:00")),
        (1, 1, 0, ts("2013-01-05T23:59:59")),
        (1, 2, 1, ts("2013-01-05T23:59:59")),
        (1, 1, 1, ts("2013-01-06T00:00:00")),
    )
    requests = frame(spark, REQUESTS, (1, None, "2013-01-05", None))
    weeks = week_slots(resolve_requests(requests, AS_OF, "week"))
    stamps = latest_stamp(disks, audits, weeks)
    last = ts("2013-01-05T23:59:59")
    assert rows(stamps, "driveLetter", "YearNum", "WeekNum", "Stamp") == [
        (" C ", 2013, 1, last),
        ("C", 2013, 1, last),
        ("D", 2013, 1, last),
        ("E", 2013, 1, last),
    ]
    # two audits at that instant double every locked detail row
    joined = join_back_latest(stamps, disks, audits)
    assert rows(joined, "driveLetter", "totalMBytes", "copies") == [
        (" C ", 1024.0, 2),
        ("C", 2048.0, 2),
        ("C", 4096.0, 2),
        ("E", 512.0, 2),
    ]
    empty = frame(spark, STORED_DISKS)
    new = weekly_disk_report(disks, audits, requests, empty, AS_OF)
    assert rows(new, "DriveName", "TotalSpaceGB") == [("C", 1.0), ("E", 0.5)]
    assert weekly_disk_report(disks, audits, requests, new, AS_OF).count() == 0


def test_memory(spark):
    simm = frame(
        spark,
        "agentGuid long, memSize string",
        *[(1, s) for s in ("512MB", " 2GB ", "1TB", "2047KB", "100", None)],
        (2, "1.5GB"),
        (3, None),
    )
    assert rows(memory_installed(simm)) == [(1, 1051237), (2, 0), (3, 0)]
    assert rows(unreadable_sizes(simm)) == [(1,)]


def test_sizes(spark):
    texts = ["4 gb", "MB", "", "-2048KB", "9223372036854775807TB", "12 34MB", "1MBGB"]
    df = frame(spark, "s string", *[(t,) for t in texts])
    got = dict(df.select("s", size_to_mb(F.col("s"))).collect())
    assert got == {
        "4 gb": 4096,
        "MB": 0,
        "": 0,
        "-2048KB": -2,
        "9223372036854775807TB": None,
        "12 34MB": None,
        "1MBGB": None,
    }


def test_top_one(spark):
    df = frame(spark, "agentGuid long, a string, b int", (1, "x", 2), (1, "x", 1), (2, None, 5), (2, "a", 1))
    assert rows(top_one(df, "agentGuid", ["a", "b"])) == [(1, "x", 1), (2, None, 5)]


def _tables(spark, **changes):
    agent = "agentGuid long"
    tables = {
        "machNameTab": frame(
            spark,
            f"{agent}, machName string, groupName string",
            (1, " one ", " G "),
            (2, "two", None),
            (3, "three", "G"),
            (4, "four", "G"),
            (5, "five", "G"),
        ),
        "auditRsltManualFields": frame(
            spark, "id long, fieldName string", (10, "ReportingEnabled"), (11, "Server Type")
        ),
        "auditRsltManualFieldValues": frame(
            spark,
            f"{agent}, fieldNameFK long, fieldValue string",
            (1, 10, "YES"),
            (1, 11, " Web "),
            (2, 10, "yes"),
            (3, 10, "NO"),
            (5, 10, "YES"),
        ),
        "userIpInfo": frame(
            spark,
            f"{agent}, ipAddress string, osInfo string",
            (1, " 10.0.0.1 ", " W "),
            (2, "10.0.0.2", None),
        ),
        "lastReboot": frame(
            spark,
            f"{agent}, rebootTime timestamp_ntz",
            (1, ts("2013-01-01")),
            (1, ts("2013-02-01")),
        ),
        "auditRsltSimm": frame(spark, f"{agent}, memSize string", (1, "2GB")),
        "auditRsltCpu": frame(spark, f"{agent}, cpuDesc string, cpuCount int", (1, "Xeon", 4)),
    }
    return {**tables, **changes}


_SERVER = ["AgentGUID", "Server", "Company", "TheDate", "MachineType", "IPAddress", "LastReboot"]
_SERVER += ["MemoryInstalledMB", "Processor", "Cores", "WindowsVersion"]


def test_snapshot(spark):
    tables = _tables(spark)
    stored = frame(
        spark,
        "AgentGUID long, Server string, Company string, TheDate timestamp_ntz, MachineType string, "
        "IPAddress string, LastReboot timestamp_ntz, MemoryInstalledMB long, Processor string, "
        "Cores int, WindowsVersion string",
    )
    month = ts("2013-03-01")
    new = servers_snapshot(tables, stored, AS_OF)
    assert rows(new, *_SERVER) == [
        (1, "one", "G", month, "Web", "10.0.0.1", ts("2013-02-01"), 2048, "Xeon", 4, "W"),
        (2, "two", "", month, "", "10.0.0.2", None, 0, "", 0, ""),
    ]
    outcomes = snapshot_outcomes(tables, stored, AS_OF)
    assert rows(outcomes, "AgentGUID", "outcome") == [
        (1, "inserted"),
        (2, "inserted"),
        (5, "rejected"),
    ]
    # a second run adds nothing; a changed attribute adds its server again
    assert servers_snapshot(tables, stored.unionByName(new), AS_OF).count() == 0
    more = frame(spark, "agentGuid long, memSize string", (1, "2GB"), (1, "1GB"))
    changed = servers_snapshot(
        _tables(spark, auditRsltSimm=more), stored.unionByName(new), AS_OF
    )
    assert rows(changed, "AgentGUID", "MemoryInstalledMB") == [(1, 3072)]
    # next month everything is new
    assert servers_snapshot(tables, new, "2013-04-02").count() == 2
    assert day("2013-04-01") == servers_snapshot(tables, new, "2013-04-02").first()["TheDate"].date()
