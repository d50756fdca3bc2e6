"""Queries over what was written: sources, sinks and whole calls, through the shared folder and back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotledger.operators.slots import day_slots, resolve_requests
from slotledger.plans import procedures
from slotledger.schemas import AGENT, EVENT_LOG
from slotledger.sinks import reports
from slotledger.sources import tables as sources
from slotledger.workload import tables as t

ROUND_TRIPS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# The days that the calls below ask for.
FIRST, LAST = "2024-01-04", "2024/01/24"


def query(fn):
    ROUND_TRIPS[fn.__name__] = fn
    return fn


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the one of ``spark.checkpoint.dir``; only where none is set, as in tests, a local one."""
    context = spark.sparkContext
    shared = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    return f"{shared or tempfile.mkdtemp(prefix='slotledger-')}/{name}-{uuid.uuid4().hex}"


def _with_agent(df: DataFrame) -> DataFrame:
    return df.withColumn("agentGuid", F.col("agentGuid").cast(AGENT))


def _as_long(df: DataFrame, column: str = "AgentGUID") -> DataFrame:
    return df.withColumn(column, F.col(column).cast("bigint"))


@query
def day_shards(spark, sf_dir):
    """The event log as a folder per day, every fifth day missing; the days asked for read back."""
    folder = scratch(spark, "shards")
    log = _with_agent(t.event_log(spark, sf_dir)).where(F.dayofmonth("log_date") % 5 > 0)
    shard = F.concat(F.lit("NtEventLog"), F.date_format("log_date", "yyyyMMdd"))
    log.withColumn("of", shard).drop("log_date").write.partitionBy("of").parquet(folder)
    days = day_slots(resolve_requests(t.log_requests(spark, sf_dir), t.AS_OF))
    return _as_long(sources.scan_day_shards(spark, folder, "of=NtEventLog", days, EVENT_LOG), "agentGuid")


@query
def load_tables(spark, sf_dir):
    """Two inventory tables, written and read as sources."""
    folder = scratch(spark, "tables")
    audits = _with_agent(t.audits(spark, sf_dir))
    audits.withColumn("date", F.col("date").cast("timestamp_ntz")).write.parquet(f"{folder}/auditRsltDate")
    _with_agent(t.memory_modules(spark, sf_dir)).write.parquet(f"{folder}/auditRsltSimm")
    source = sources.load_tables(spark, folder, "auditRsltDate", "auditRsltSimm")
    last = source["auditRsltDate"].groupBy("agentGuid").agg(F.max("date").alias("last_audit"))
    modules = source["auditRsltSimm"].groupBy("agentGuid").agg(F.count("memSize").alias("n_modules"))
    return _as_long(last.join(modules, "agentGuid", "full"), "agentGuid")


@query
def view_source(spark, sf_dir):
    view = "slotledger_contact_activities"
    t.activities(spark, sf_dir).withColumn("more", F.lit(1)).createOrReplaceTempView(view)
    return sources.contact_activity(spark, view)


@query
def report_tables(spark, sf_dir):
    """The report tables created, filled, emptied by creating them anew, filled with errors, and made once more."""
    folder = scratch(spark, "reports")
    name = f"slotledger_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/_database'")
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(name)
    try:
        events = t.event_log(spark, sf_dir).selectExpr("agentGuid AS AgentGUID", "eventTime AS EventTime", "message AS Message")
        reports.create_report_tables(spark, folder)
        reports.append_report(events, folder, "NTEvent", t.AS_OF)
        reports.create_report_tables(spark, folder, replace=True)
        reports.append_report(events.where("Message LIKE '%error%'"), folder, "NTEvent", t.AS_OF)
        reports.create_report_tables(spark, folder)
        return _as_long(spark.table(f"{name}.NTEvent").select("AgentGUID", "EventTime", "Message", "SlotDate"))
    finally:
        spark.catalog.setCurrentDatabase(before)


@query
def sorted_events(spark, sf_dir):
    """The event log written in order and read back by file name: where the rows of each message and machine stand."""
    folder = scratch(spark, "sorted")
    reports.sorted_write(t.event_log(spark, sf_dir), folder, ["message", "agentGuid"])
    read = sources.in_file_order(spark, folder)
    return read.groupBy("message", "agentGuid").agg(
        F.min("position").alias("first_row"),
        F.max("position").alias("last_row"),
        F.count(F.lit(1)).alias("n_rows"),
    )


@query
def published_events(spark, sf_dir):
    """Events called for twice over what is stored, and all that is stored then."""
    folder = scratch(spark, "events")
    log = _with_agent(t.event_log(spark, sf_dir))
    log.repartition("log_date").write.partitionBy("log_date").parquet(f"{folder}/log")
    reports.append_report(t.stored_events(spark, sf_dir), f"{folder}/reports", "NTEvent", t.AS_OF)
    for _ in range(2):
        procedures.report_events(spark, f"{folder}/log", f"{folder}/reports", t.AS_OF, FIRST, LAST)
    stored = sources.scan_report(spark, f"{folder}/reports", "NTEvent")
    return _as_long(stored.select("RecID", "AgentGUID", "EventTime", "Message", "SlotDate"))


@query
def published_components(spark, sf_dir):
    """Hourly rows called for twice over what is stored, and all that both reports hold then."""
    folder = scratch(spark, "components")
    log = _with_agent(t.counter_log(spark, sf_dir))
    log.repartition("log_date").write.partitionBy("log_date").parquet(f"{folder}/log")
    t.counters(spark, sf_dir).write.parquet(f"{folder}/tables/monitorCounter")
    for component, rows in t.stored_components(spark, sf_dir).items():
        report = {"CPU": "CPU", "MEM": "Memory"}[component]
        reports.append_report(rows, f"{folder}/reports", report, t.AS_OF)
    for _ in range(2):
        procedures.report_components(
            spark, f"{folder}/log", f"{folder}/tables", f"{folder}/reports", t.AS_OF, "ALL", FIRST, LAST
        )
    held = None
    for report in ("CPU", "Memory"):
        part = sources.scan_report(spark, f"{folder}/reports", report).select(
            F.lit(report).alias("report"),
            "AgentGUID",
            "TheDate",
            "Hour",
            F.round("Sum", 4).alias("Sum"),
            F.col("DataPoints").cast("bigint").alias("DataPoints"),
        )
        held = part if held is None else held.unionByName(part)
    return _as_long(held)
