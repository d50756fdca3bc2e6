"""Small frames for edge cases."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession


def ts(text: str | None) -> dt.datetime | None:
    return None if text is None else dt.datetime.fromisoformat(text)


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def frame(spark: SparkSession, schema: str, *rows) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def rows(df: DataFrame, *cols: str) -> list[tuple]:
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


COUNTERS = "monitorCounterId long, name string"
LOG = (
    "agentGuid long, monitorCounterId long, eventDateTime timestamp_ntz, "
    "counterValue double, log_date date"
)
HOURS = "AgentGUID long, TheDate timestamp_ntz, Hour int, Sum double, DataPoints long"
EVENTS = "agentGuid long, eventTime timestamp_ntz, message string, log_date date"
STORED_EVENTS = "AgentGUID long, EventTime timestamp_ntz, Message string"
REQUESTS = "req_id int, components string, from_parm string, to_parm string"
DISKS = (
    "agentGuid long, resultGroup int, locked int, driveLetter string, volumeName string, "
    "type string, totalMBytes double, freeMBytes double"
)
AUDITS = "agentGuid long, resultGroup int, locked int, date timestamp_ntz"
