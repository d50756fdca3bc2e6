"""Growing logs: new files are published in steps, each row once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from frames import COUNTERS, EVENTS, LOG, day, frame, rows, ts
from slotledger.plans import procedures
from slotledger.sinks import publish
from slotledger.sources.tables import scan_report
from slotledger.streaming.streams import stream_components, stream_events

AS_OF = "2013-03-14"


def _add(spark, path, schema, *log_rows):
    df = frame(spark, schema, *log_rows).withColumn("agentGuid", F.col("agentGuid").cast("decimal(26,0)"))
    df.coalesce(1).write.mode("append").partitionBy("log_date").parquet(path)


def _run(query):
    query.awaitTermination()
    assert query.exception() is None


def _events(*numbers, at="2013-01-05"):
    return [(n, ts(f"{at}T08:30:00"), f"m{n}", day(at)) for n in numbers]


def test_events_in_steps(spark, tmp_path):
    log, reports, checkpoint = (str(tmp_path / n) for n in ("log", "reports", "checkpoint"))

    def step():
        _run(stream_events(spark, log, reports, checkpoint, AS_OF, files=1))
        return sorted(r[0] for r in rows(scan_report(spark, reports, "NTEvent"), "Message"))

    _add(spark, log, EVENTS, *_events(1, 2, 2))
    _add(spark, log, EVENTS, *_events(2, 3), *_events(8, at="2013-01-06"))
    assert step() == ["m1", "m2", "m3", "m8"]
    assert step() == ["m1", "m2", "m3", "m8"]
    stray = [(9, ts("2013-01-09T00:00:00"), "stray", day("2013-01-06")), (9, ts("2013-01-06T00:00:00"), None, day("2013-01-06"))]
    _add(spark, log, EVENTS, *_events(1, 4), *stray)
    assert step() == ["m1", "m2", "m3", "m4", "m8"]


@pytest.mark.parametrize("where", ["claim", "move", "after"])
def test_events_of_a_step_that_was_killed(spark, tmp_path, monkeypatch, where):
    log, reports, checkpoint = (str(tmp_path / n) for n in ("log", "reports", "checkpoint"))
    _add(spark, log, EVENTS, *_events(1, 2), *_events(5, at="2013-01-06"))
    _run(stream_events(spark, log, reports, checkpoint, AS_OF))
    _add(spark, log, EVENTS, *_events(2, 3), *_events(6, at="2013-01-06"))

    def killing(*_):
        raise RuntimeError("killed")

    if where == "after":
        done = publish._show
        monkeypatch.setattr(publish, "_show", lambda *a: (done(*a), killing()))
    else:
        monkeypatch.setattr(publish.Folder, where, killing)
    with pytest.raises(Exception):
        query = stream_events(spark, log, reports, checkpoint, AS_OF)
        query.awaitTermination()
    monkeypatch.undo()
    _run(stream_events(spark, log, reports, checkpoint, AS_OF))
    assert sorted(r[0] for r in rows(scan_report(spark, reports, "NTEvent"), "Message")) == ["m1", "m2", "m3", "m5", "m6"]


def test_components_in_steps(spark, tmp_path):
    root = str(tmp_path)
    frame(spark, COUNTERS, (7, "% Process bytes in use")).write.parquet(f"{root}/tables/monitorCounter")

    def step():
        _run(stream_components(spark, f"{root}/log", f"{root}/tables", f"{root}/reports", f"{root}/checkpoint", AS_OF))
        return rows(scan_report(spark, f"{root}/reports", "CPU"), "TheDate", "Sum", "DataPoints")

    def readings(at, *hours):
        return [(9, 7, ts(f"{at}T{h:02}:30:00"), float(h), day(at)) for h in hours]

    _add(spark, f"{root}/log", LOG, *readings("2013-01-05", 8, 9))
    first = [(ts(f"2013-01-05T{h:02}:00:00"), float(h), 1) for h in (8, 9)]
    assert step() == first
    _add(spark, f"{root}/log", LOG, *readings("2013-01-06", 3))
    both = [*first, (ts("2013-01-06T03:00:00"), 3.0, 1)]
    assert step() == step() == both
    # the same rows as a call over all days
    counts = procedures.report_components(spark, f"{root}/log", f"{root}/tables", f"{root}/other", AS_OF, "ALL", "2013-01-05", "2013-01-06")
    assert counts["CPU"] == 3
    assert rows(scan_report(spark, f"{root}/other", "CPU"), "TheDate", "Sum", "DataPoints") == both
