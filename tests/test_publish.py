"""Rows are stored once: calls that are killed, calls at the same time, tasks that fail."""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from frames import COUNTERS, EVENTS, HOURS, LOG, day, frame, rows, ts
from slotledger.operators import merge
from slotledger.plans import procedures as p
from slotledger.sinks import publish
from slotledger.sinks.reports import append_report, create_report_tables, with_rec_id
from slotledger.sources.tables import scan_report

AS_OF = "2013-03-14 06:00:00"
REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _write(df, path):
    df = df.withColumn("agentGuid", F.col("agentGuid").cast("decimal(26,0)"))
    df.write.partitionBy("log_date").parquet(path)


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("publish"))
    days = ["2013-01-05", "2013-01-06", "2013-01-07"]
    readings = [(a, 7, ts(f"{d}T{h:02}:30:00"), float(a), day(d)) for d in days for h in range(4) for a in range(1, 6)]
    _write(frame(spark, LOG, *readings), f"{root}/log")
    frame(spark, COUNTERS, (7, "% Process bytes in use")).write.parquet(f"{root}/tables/monitorCounter")
    return root


def _call(spark, sources, reports):
    return p.report_components(
        spark, f"{sources}/log", f"{sources}/tables", reports, AS_OF, "ALL", "2013-01-05", "2013-01-07"
    )


def _stored_once(spark, reports):
    for name in ("CPU", "Memory"):
        stored = scan_report(spark, reports, name)
        assert stored.count() == stored.select("AgentGUID", "TheDate").distinct().count() == 60, name


class Killed(BaseException):
    pass


@pytest.mark.parametrize("moves", [0, 1, 3])
def test_a_call_killed_while_its_rows_move_in(spark, sources, tmp_path, monkeypatch, moves):
    reports = str(tmp_path / "reports")
    move, left = publish.Folder.move, [moves]

    def killing(self, name, to):
        if not left[0]:
            raise Killed
        left[0] -= 1
        move(self, name, to)

    monkeypatch.setattr(publish.Folder, "move", killing)
    with pytest.raises(Killed):
        _call(spark, sources, reports)
    monkeypatch.undo()
    assert _call(spark, sources, reports) == {"CPU": 0, "MEM": 0, "skipped": 120, "rejected": 0}
    _stored_once(spark, reports)


def test_a_call_killed_before_it_is_published(spark, sources, tmp_path, monkeypatch):
    reports = str(tmp_path / "reports")

    def killing(self, name, to):
        raise Killed

    monkeypatch.setattr(publish.Folder, "claim", killing)
    with pytest.raises(Killed):
        _call(spark, sources, reports)
    monkeypatch.undo()
    assert scan_report(spark, reports, "CPU").count() == 0
    assert _call(spark, sources, reports) == {"CPU": 60, "MEM": 60, "skipped": 0, "rejected": 0}
    _stored_once(spark, reports)
    assert len(publish.discard_staged(spark, reports)) == 1
    assert publish.discard_staged(spark, reports) == []


def test_a_process_that_dies_between_two_files(spark, sources, tmp_path):
    reports = str(tmp_path / "reports")
    script = f"""
        import os, sys
        sys.path.insert(0, {REPO!r})
        from pyspark.sql import SparkSession
        from slotledger.plans import procedures as p
        from slotledger.sinks import publish
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
            "spark.sql.shuffle.partitions", "4").getOrCreate()
        move, done = publish.Folder.move, []
        def dying(self, name, to):
            move(self, name, to)
            done.append(name)
            if len(done) == 2:
                os._exit(9)
        publish.Folder.move = dying
        p.report_components(spark, {sources!r} + "/log", {sources!r} + "/tables", {reports!r}, {AS_OF!r}, "ALL", "2013-01-05", "2013-01-07")
    """
    ended = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, timeout=180)
    assert ended.returncode == 9, ended.stderr.decode()[-2000:]
    assert scan_report(spark, reports, "CPU").count() + scan_report(spark, reports, "Memory").count() < 120
    assert _call(spark, sources, reports)["skipped"] == 120
    _stored_once(spark, reports)


def test_calls_at_the_same_time(spark, sources, tmp_path):
    reports = str(tmp_path / "reports")
    with ThreadPoolExecutor(4) as pool:
        counts = list(pool.map(lambda _: _call(spark, sources, reports), range(4)))
    _stored_once(spark, reports)
    # each row was inserted by one of them and found by the others
    assert sum(c["CPU"] + c["MEM"] for c in counts) == 120
    assert all(c["CPU"] + c["MEM"] + c["skipped"] == 120 for c in counts)


def test_appends_at_the_same_time(spark, tmp_path):
    batch = frame(spark, HOURS, *[(a, ts("2013-01-05T03:00:00"), 3, 1.5, 2) for a in range(10)])
    with ThreadPoolExecutor(3) as pool:
        counts = list(pool.map(lambda _: append_report(batch, str(tmp_path), "CPU", AS_OF), range(3)))
    assert counts == [10, 10, 10]
    assert scan_report(spark, str(tmp_path), "CPU").count() == 30


def test_only_one_folder_gets_a_name(spark, tmp_path):
    folder = publish.Folder(spark, str(tmp_path))
    for k in range(2):
        folder.write(f"staged/{k}/run.json", "{}")
    assert [folder.claim(f"staged/{k}", "journal/0000000001") for k in range(2)] == [True, False]
    assert folder.names("staged") == ["1"]


def test_tables_show_rows_that_another_call_has_moved_in(spark, tmp_path, monkeypatch):
    directory = str(tmp_path)
    names = create_report_tables(spark, directory)
    try:
        batch = frame(spark, HOURS, (1, ts("2013-01-05T03:00:00"), 3, 1.5, 2), (1, ts("2013-01-06T03:00:00"), 3, 1.5, 2))
        claim = publish.Folder.claim

        def claimed(self, name, to):
            out = claim(self, name, to)
            publish._finish(spark, publish.Folder(spark, f"{directory}/."), to)  # as a call that follows would
            return out

        monkeypatch.setattr(publish.Folder, "claim", claimed)
        assert append_report(batch, directory, "CPU", AS_OF) == 2
        assert spark.table("CPU").count() == 2
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_counts_of_tasks_that_fail_and_run_again(tmp_path):
    """Every first attempt of a task over the log fails after it has worked; counts and rows are those of one run."""
    script = f"""
        import sys
        sys.path[:0] = [{REPO!r}, {REPO!r} + "/tests"]
        from pyspark import TaskContext
        from pyspark.sql import SparkSession, functions as F
        from frames import EVENTS, REQUESTS, day, frame, ts
        from slotledger.plans import jobs
        from slotledger.plans.procedures import published
        from slotledger.schemas import NTEVENT
        from slotledger.sources.tables import scan_report
        spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config(
            "spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").getOrCreate()
        spark.sparkContext.setLogLevel("OFF")
        at = "2013-01-05"
        events = [(k % 5, ts(at + "T08:30:00"), "m%d" % (k % 7), day(at)) for k in range(70)] + [(1, ts(at + "T08:30:00"), None, day(at))] * 9
        log = spark.createDataFrame(events, EVENTS).repartition(3)
        def failing(batches):
            yield from batches
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("lost")
        log = log.mapInPandas(failing, log.schema)
        requests = frame(spark, REQUESTS, (1, None, at, at))
        reports = {str(tmp_path)!r}
        def judge():
            return jobs.judged_events(log, requests, scan_report(spark, reports, "NTEvent"), "2013-03-14")
        counts = [published(spark, reports, NTEVENT, "2013-03-14", judge) for _ in range(2)]
        stored = scan_report(spark, reports, "NTEvent")
        print("COUNTS", counts, stored.count(), stored.select("RecID").distinct().count())
    """
    ended = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, timeout=240)
    told = [line for line in ended.stdout.decode().splitlines() if line.startswith("COUNTS")]
    first = {("NTEvent", "inserted"): 70, ("NTEvent", "rejected"): 9}
    second = {("NTEvent", "skipped"): 70, ("NTEvent", "rejected"): 9}
    assert told, ended.stderr.decode()[-2000:]
    head, _, tail = told[0].removeprefix("COUNTS ").rpartition("] ")
    got = eval(head + "]")  # our own printout
    assert got == [first, second] and tail == "70 70"


def test_powers_of_two(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 6, 7, 1 << 40, (1 << 62) + 5)], "n long")
    got = df.select("n", merge.powers_of_two(F.col("n")).alias("p")).collect()
    assert all(sum(r.p) == r.n and len(set(r.p)) == len(r.p) for r in got)


def test_copies_have_numbers_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(merge, "COPY_BLOCK", 7)
    monkeypatch.setattr(merge, "CHUNK_BITS", 3)
    data = [(1, "a", k % 40) for k in range(120)] + [(2, None, None)] * 30 + [(3, "b", 1)]
    df = spark.createDataFrame(data, "k long, m string, other long")
    for keys in (["k"], ["k", "m"], ["k", "m", "other"]):
        runs = [
            sorted(map(repr, merge.number_copies(df.repartition(n), keys).collect()))
            for n in (1, 5)
        ]
        assert runs[0] == runs[1]
        by_key = {}
        for r in merge.number_copies(df, keys).collect():
            by_key.setdefault(tuple(r[c] for c in keys), []).append(r["copy"])
        assert all(sorted(v) == list(range(1, len(v) + 1)) for v in by_key.values())
        assert sum(map(len, by_key.values())) == len(data)


def test_rec_ids_of_copies(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (1, "a|2"), (1, "a\\2")], "k long, m string")
    got = [r.RecID for r in with_rec_id(df, ["k", "m"], copies=True).collect()]
    assert len(set(got)) == 5
    assert set(got) >= {r.RecID for r in with_rec_id(df, ["k", "m"]).collect()}


def test_copies_of_events_in_a_day_stored_whole(spark, tmp_path):
    at = "2013-01-05"
    _write(frame(spark, EVENTS, *[(9, ts(f"{at}T08:30:00"), "a", day(at))] * 3), f"{tmp_path}/log")
    runs = [p.report_events(spark, f"{tmp_path}/log", f"{tmp_path}/reports", AS_OF, at) for _ in range(2)]
    assert [(r["inserted"], r["skipped"]) for r in runs] == [(3, 0), (0, 3)]
    stored = scan_report(spark, f"{tmp_path}/reports", "NTEvent")
    assert len(set(rows(stored, "RecID"))) == 3
