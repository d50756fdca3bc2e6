"""Reading logs, inventory tables and stored reports."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotledger.operators.slots import in_day_slots
from slotledger.operators.widen import ACTIVITY_COLUMNS, CONTACT_COLUMNS
from slotledger.schemas import COUNTER_LOG, EVENT_LOG, REPORTS, SOURCES


def _scan_log(
    spark: SparkSession, path: str, schema: T.StructType, slots: DataFrame | None
) -> DataFrame:
    log = spark.read.schema(schema).parquet(path)
    return log if slots is None else in_day_slots(log, slots)


def scan_counter_log(
    spark: SparkSession, path: str, slots: DataFrame | None = None
) -> DataFrame:
    """Counter log partitioned by ``log_date``, pruned to the days of ``slots``.

    A day without a partition has no rows; nothing has to be tested for.
    """
    return _scan_log(spark, path, COUNTER_LOG, slots)


def scan_event_log(
    spark: SparkSession, path: str, slots: DataFrame | None = None
) -> DataFrame:
    """Event log partitioned by ``log_date``, pruned to the days of ``slots``."""
    return _scan_log(spark, path, EVENT_LOG, slots)


def _day_of(name: str, prefix: str) -> dt.date | None:
    """The day of a shard's name, None for some other name that begins alike."""
    if name[: len(prefix)].lower() != prefix.lower():
        return None
    try:
        return dt.datetime.strptime(name[len(prefix) :], "%Y%m%d").date()
    except ValueError:
        return None


def _days_wanted(
    spark: SparkSession, held: Iterable[dt.date], days: DataFrame | Iterable[dt.date]
) -> list[dt.date]:
    """Those of ``days`` for which there is a shard; slots are only looked up, not brought to the driver."""
    held = set(held)
    if isinstance(days, DataFrame):
        listed = spark.createDataFrame([(d,) for d in held], "log_date date")
        days = [r["log_date"] for r in in_day_slots(listed, days).collect()]
    return sorted(held.intersection(days))


def _read_shards(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """All shards in one scan; the day of a row is in the name of the folder its file lies in."""
    if not paths:
        return spark.createDataFrame([], schema)
    fields = T.StructType([f for f in schema.fields if f.name != "log_date"])
    digits = F.regexp_extract("_metadata.file_path", r"(\d{8})/+[^/]*$", 1)
    log = spark.read.schema(fields).parquet(*paths)
    return log.select("*", F.to_date(digits, "yyyyMMdd").alias("log_date")).select(*schema.names)


def scan_day_shards(
    spark: SparkSession,
    directory: str,
    prefix: str,
    days: DataFrame | Iterable[dt.date],
    schema: T.StructType,
) -> DataFrame:
    """Log kept as one folder of Parquet files per day, named ``<prefix>yyyymmdd``.

    ``days`` are dates or slots with a ``log_date``. The directory is listed once;
    days without a folder have no rows. One scan reads all days, however many.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(directory)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(place) if s.isDirectory()]
    held = {day: name for name in names if (day := _day_of(name, prefix)) is not None}
    wanted = _days_wanted(spark, held, days)
    return _read_shards(spark, [f"{directory.rstrip('/')}/{held[d]}" for d in wanted], schema)


def scan_day_tables(
    spark: SparkSession,
    prefix: str,
    days: DataFrame | Iterable[dt.date],
    schema: T.StructType,
) -> DataFrame:
    """Log kept as one catalog table per day, named ``<prefix>yyyymmdd``.

    ``days`` are dates or slots with a ``log_date``. Days whose table does not
    exist are skipped. The catalog is asked once for all tables; of the slots only
    the days of its tables come to the driver, at most one for each table. Parquet
    tables are read in one scan of their folders; views, and tables of other formats
    or in folders not named by the day, are read one by one.
    """
    columns = [f.name for f in schema.fields if f.name != "log_date"]
    told = spark.sql(f"SHOW TABLE EXTENDED LIKE '{prefix}*'").collect()
    held = {day: r for r in told if (day := _day_of(r["tableName"], prefix)) is not None}
    paths, singly = [], []
    for day in _days_wanted(spark, held, days):
        about = dict(
            line.split(": ", 1) for line in held[day]["information"].splitlines() if ": " in line
        )
        path = about.get("Location", "").rstrip("/")
        plain = about.get("Provider", "").lower() == "parquet" and "Partition Columns" not in about
        if plain and re.search(rf"{day:%Y%m%d}$", path):
            paths.append(path)
        else:
            table = spark.table(held[day]["tableName"])
            singly.append(table.select(*columns, F.lit(day).alias("log_date")))
    return reduce(DataFrame.unionByName, singly, _read_shards(spark, paths, schema))


def in_file_order(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a sorted write with their ``file_name`` and ``position``: 1 for the first row of the first file.

    Files are numbered by name and rows within them, so nothing is sorted or
    shuffled but one count per file.
    """
    rows = spark.read.parquet(path)
    named = rows.select("*", "_metadata.file_name", "_metadata.row_index")
    before = Window.orderBy("file_name").rowsBetween(Window.unboundedPreceding, -1)
    counts = named.groupBy("file_name").agg(F.count(F.lit(1)).alias("_n"))
    # a row per file
    offsets = counts.select("file_name", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("row_index") + 1
    return named.join(F.broadcast(offsets), "file_name").select(*rows.columns, "file_name", place.alias("position"))


def load_tables(spark: SparkSession, directory: str, *names: str) -> dict[str, DataFrame]:
    """Inventory and audit tables (all, or the named) with their declared columns."""
    return {
        name: spark.read.schema(SOURCES[name]).parquet(f"{directory.rstrip('/')}/{name}")
        for name in names or SOURCES
    }


def scan_report(
    spark: SparkSession, directory: str, name: str, slots: DataFrame | None = None
) -> DataFrame:
    """Stored rows of a report, all of them or those on the days of ``slots``.

    A report that was never written has no rows.
    """
    report = REPORTS[name]
    try:
        stored = spark.read.schema(report.stored).parquet(f"{directory.rstrip('/')}/{name}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], report.stored)
    return stored if slots is None else in_day_slots(stored, slots, "SlotDate")


def contact_activity(spark: SparkSession, view: str) -> DataFrame:
    """A view of contact activities with the columns that ``widen`` takes."""
    return spark.table(view).select(
        *CONTACT_COLUMNS.values(), *ACTIVITY_COLUMNS.values()
    )
