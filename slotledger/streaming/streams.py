"""The jobs in steps: what a growing log has gained is judged and published as it comes.

A query reads the new files of a log, and each of its batches is published like a
call: as a whole, against the reports as they are then. A batch that was killed runs
again when the query is started from its checkpoint, and finds stored what it had
published, so each row is stored once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from slotledger.functions.calendar import AsOf
from slotledger.plans import jobs
from slotledger.plans.procedures import published, published_components
from slotledger.schemas import COUNTER_LOG, EVENT_LOG, NTEVENT
from slotledger.sources.tables import load_tables, scan_counter_log, scan_report


def _start(
    spark: SparkSession,
    path: str,
    schema: StructType,
    checkpoint: str,
    store,
    files: int | None,
    once: bool,
) -> StreamingQuery:
    reader = spark.readStream.schema(schema)
    if files is not None:
        reader = reader.option("maxFilesPerTrigger", files)
    writer = reader.parquet(path).writeStream.foreachBatch(store)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_events(
    spark: SparkSession,
    log_path: str,
    reports: str,
    checkpoint: str,
    as_of: AsOf,
    trim_message: bool = False,
    files: int | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Publishes the events of new log files: those timed inside their day, once each, that are not stored.

    A day may arrive in any number of files, so no day is ever stored whole as a call
    does with one that has no stored event. At most ``files`` files make a batch;
    ``once`` ends the query when it has read what there is.
    """

    def store(batch: DataFrame, number: int) -> None:
        def judge() -> DataFrame:
            stored = scan_report(batch.sparkSession, reports, NTEVENT.name)
            return jobs.judged_new_events(batch, stored, trim_message)

        published(batch.sparkSession, reports, NTEVENT, as_of, judge, "stream", number)

    return _start(spark, log_path, EVENT_LOG, checkpoint, store, files, once)


def stream_components(
    spark: SparkSession,
    log_path: str,
    tables: str,
    reports: str,
    checkpoint: str,
    as_of: AsOf,
    files: int | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Publishes the hourly rows of the days that new log files belong to.

    The days of a batch are the requests of a run over the whole log, so an hour has
    all its readings that are there. An hour that gains readings later gets a further
    row, as with repeated calls.
    """

    def store(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        days = batch.select("log_date").distinct()
        requests = days.select(
            F.lit(1).alias("req_id"),
            F.lit(None).cast("string").alias("components"),
            F.col("log_date").cast("string").alias("from_parm"),
            F.lit(None).cast("string").alias("to_parm"),
        )
        log = scan_counter_log(session, log_path)
        counters = load_tables(session, tables, "monitorCounter")["monitorCounter"]
        published_components(session, log, counters, requests, reports, as_of, "stream", number)

    return _start(spark, log_path, COUNTER_LOG, checkpoint, store, files, once)
