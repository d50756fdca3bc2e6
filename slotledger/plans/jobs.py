"""The report jobs: requests and sources in, rows to append out."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger.functions.calendar import AsOf, as_date, month_start, us_week
from slotledger.functions.text import limit_message, mb_to_gb, trim
from slotledger.operators.filters import (
    current_disk_filter,
    disk_projection,
    is_weekly_disk,
)
from slotledger.operators.inventory import assemble_snapshot
from slotledger.operators.latest import latest_audit_join, weekly_stamps
from slotledger.operators.merge import (
    expand_copies,
    first_per_key,
    insert_new,
    mark_existing,
    mark_slots,
    mark_stored,
    outcome_counts,
    powers_of_two,
)
from slotledger.operators.rollup import COMPONENTS, component_rollup, daily_rollup
from slotledger.operators.slots import (
    day_slots,
    distinct_ranges,
    distinct_slots,
    distinct_weeks,
    in_day_slots,
    resolve_components,
    resolve_requests,
    rows_in_slot,
    week_slots,
)
from slotledger.schemas import (
    CPU,
    DISK,
    INSERTED,
    MESSAGE_WIDTH,
    NTEVENT,
    REJECTED,
    SERVERS,
    SKIPPED,
    SUM_TOLERANCE,
    Report,
)


# --- what a report requires ------------------------------------------------


def lacks_required(df: DataFrame, report: Report) -> Column:
    """Is a value missing that ``report`` declares NOT NULL?"""
    needed = [
        f.name for f in report.columns.fields if not f.nullable and f.name in df.columns
    ]
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in needed])


def with_required(df: DataFrame, report: Report) -> DataFrame:
    """Rows that have every required value; a NULL key equals nothing and would be stored on every run."""
    return df.where(~lacks_required(df, report))


def _judged(marked: DataFrame, report: Report) -> DataFrame:
    """Rows with ``stored`` as rows with their ``outcome``."""
    return marked.withColumn(
        "outcome",
        F.when(lacks_required(marked, report), REJECTED)
        .when(F.col("stored"), SKIPPED)
        .otherwise(INSERTED),
    ).drop("stored")


def inserted(judged: DataFrame) -> DataFrame:
    """The rows that a judged job would store."""
    return judged.where(F.col("outcome") == INSERTED).drop("outcome", "times", "copy")


# --- hourly and daily components -------------------------------------------


def component_slots(requests: DataFrame, as_of: AsOf) -> DataFrame:
    """The ``(component, log_date)`` pairs that the requests ask for."""
    resolved = resolve_requests(resolve_components(requests), as_of)
    return day_slots(distinct_ranges(resolved, "component"))


def _component_rows(
    log: DataFrame,
    counters: DataFrame,
    requests: DataFrame,
    targets: Mapping[str, DataFrame],
    as_of: AsOf,
) -> tuple[DataFrame, DataFrame | None]:
    """Hourly rows of the requested slots, and what the targets hold of those days."""
    slots = component_slots(requests, as_of)
    batch = component_rollup(in_day_slots(log, slots), counters, COMPONENTS, slots=slots)
    stored = None
    for component, target in targets.items():
        part = rows_on_days(target, "TheDate", slots).select(
            F.lit(component).alias("component"),
            "AgentGUID",
            "TheDate",
            "Hour",
            "Sum",
            "DataPoints",
        )
        stored = part if stored is None else stored.unionByName(part)
    return batch, stored


_COMPONENT_MATCH = ["component", "AgentGUID", "TheDate", "Hour", "DataPoints"]


def components_report(
    log: DataFrame,
    counters: DataFrame,
    requests: DataFrame,
    targets: Mapping[str, DataFrame],
    as_of: AsOf,
) -> DataFrame:
    """Hourly CPU and memory rows that their targets do not hold yet.

    ``targets`` maps component to its report table. The result carries a
    ``component`` column, so both reports come from one scan of the log. A row
    of an hour the target has never seen cannot match anything, so bulk loading
    of empty hours and merging into others are the same anti-join here. Hours
    without a machine are rejected.
    """
    batch, stored = _component_rows(log, counters, requests, targets, as_of)
    batch = with_required(batch, CPU)
    if stored is None:
        return batch
    return insert_new(batch, stored, _COMPONENT_MATCH, approx={"Sum": SUM_TOLERANCE})


def judged_components(
    log: DataFrame,
    counters: DataFrame,
    requests: DataFrame,
    targets: Mapping[str, DataFrame],
    as_of: AsOf,
) -> DataFrame:
    """All hourly rows of the requested slots with their ``outcome``; those inserted are ``components_report``."""
    batch, stored = _component_rows(log, counters, requests, targets, as_of)
    if stored is None:
        return _judged(batch.withColumn("stored", F.lit(False)), CPU)
    approx = {"Sum": SUM_TOLERANCE}
    return _judged(mark_stored(batch, stored, _COMPONENT_MATCH, approx), CPU)


def daily_components(
    log: DataFrame, counters: DataFrame, requests: DataFrame, as_of: AsOf
) -> DataFrame:
    """Daily component rows for the requested days and components, those without a machine left out."""
    slots = component_slots(requests, as_of)
    daily = daily_rollup(in_day_slots(log, slots), counters, COMPONENTS, slots=slots)
    return with_required(daily, CPU)


# --- events ----------------------------------------------------------------


def _as_events(log: DataFrame, trim_message: bool) -> DataFrame:
    """Log rows with the columns of the event report, and their ``log_date``."""
    message = F.col("message")
    if trim_message:
        message = trim(message)
    return log.select(
        F.col("agentGuid").alias("AgentGUID"),
        F.col("eventTime").alias("EventTime"),
        limit_message(message, MESSAGE_WIDTH).alias("Message"),
        "log_date",
    )


def _event_days(requests: DataFrame, as_of: AsOf) -> DataFrame:
    resolved = resolve_requests(requests, as_of)
    return distinct_slots(day_slots(distinct_ranges(resolved)), "log_date")


def _event_rows(
    log: DataFrame, requests: DataFrame, target: DataFrame, as_of: AsOf, trim_message: bool
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events of the requested days without any stored event, those of the others, and what is stored."""
    events = _as_events(log, trim_message)
    requested = _event_days(requests, as_of)
    stored = rows_on_days(target, "EventTime", requested)
    # over a target partitioned by day, which days are held takes no column at all
    held = F.col("SlotDate") if "SlotDate" in stored.columns else F.to_date("EventTime")
    slots = mark_slots(requested, stored, held)
    dumped = in_day_slots(events, slots.where(~F.col("occupied")))
    merged = in_day_slots(events, slots.where(F.col("occupied")))
    return dumped, merged, stored


def events_report(
    log: DataFrame,
    requests: DataFrame,
    target: DataFrame,
    as_of: AsOf,
    trim_message: bool = False,
) -> DataFrame:
    """Events of the requested days that the target does not hold yet.

    A day without any stored event takes its whole shard as it is, duplicates
    and stray times included. Other days take only events timed inside the day,
    once each, that are not stored. All days are judged against the target as
    it is when the job starts. Events without a message, time or machine are
    rejected. The two kinds of days are disjoint, so over a log partitioned by
    day each partition is read once.
    """
    dumped, merged, stored = _event_rows(log, requests, target, as_of, trim_message)
    dumped = with_required(dumped, NTEVENT).drop("log_date")
    day = F.col("log_date")
    merged = with_required(merged, NTEVENT)
    merged = rows_in_slot(
        merged,
        "EventTime",
        day.cast("timestamp_ntz"),
        F.date_add(day, 1).cast("timestamp_ntz"),
    ).drop("log_date")
    # distinct on the join keys: its shuffle also serves the anti-join
    merged = insert_new(first_per_key(merged, NTEVENT.keys), stored, NTEVENT.keys)
    return dumped.unionByName(merged)


def _counted_events(rows: DataFrame, outcome: Column) -> DataFrame:
    """Equal events as one row with their number ``n``; of those not inserted only the outcome and number are left."""
    kept = F.col("outcome") == INSERTED
    return (
        rows.select("*", outcome.alias("outcome"))
        .select("outcome", *[F.when(kept, F.col(c)).alias(c) for c in NTEVENT.keys])
        .groupBy("outcome", *NTEVENT.keys)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _judged_once(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Events timed inside their day, once each, that are not stored; of the others only their number."""
    day, one = F.col("log_date"), F.lit(1).cast("bigint")
    inside = (F.col("EventTime") >= day.cast("timestamp_ntz")) & (
        F.col("EventTime") < F.date_add(day, 1).cast("timestamp_ntz")
    )
    missing = lacks_required(rows, NTEVENT)
    counted = _counted_events(
        rows, F.when(missing, REJECTED).when(inside, INSERTED).otherwise(SKIPPED)
    )
    marked = mark_stored(counted, stored, NTEVENT.keys)
    new = (F.col("outcome") == INSERTED) & ~F.col("stored")
    # of a new event one is inserted and its copies are skipped
    label = F.when(F.col("outcome") == REJECTED, REJECTED).otherwise(SKIPPED)
    others = powers_of_two(F.col("n") - F.when(new, 1).otherwise(0))
    others = F.transform(others, lambda p: F.struct(label.alias("outcome"), p.alias("times")))
    first = F.array(F.struct(F.lit(INSERTED).alias("outcome"), one.alias("times")))
    told = F.when(new, F.concat(first, others)).otherwise(others)
    judged = marked.select(*NTEVENT.keys, F.explode(told).alias("_told"))
    return judged.select(*NTEVENT.keys, "_told.*", one.alias("copy"))


def judged_new_events(log: DataFrame, target: DataFrame, trim_message: bool = False) -> DataFrame:
    """All events of ``log`` with their ``outcome``, every day taken as one that has stored events already."""
    stored = rows_on_days(target, "EventTime", log.select("log_date"))
    return _judged_once(_as_events(log, trim_message), stored)


def judged_events(
    log: DataFrame,
    requests: DataFrame,
    target: DataFrame,
    as_of: AsOf,
    trim_message: bool = False,
) -> DataFrame:
    """The events of the requested days with their ``outcome``; those inserted are ``events_report``.

    Of those skipped or rejected only their number is left, in rows that stand for
    ``times`` events each. ``copy`` numbers equal events of a day that is stored whole.
    """
    dumped, merged, stored = _event_rows(log, requests, target, as_of, trim_message)
    one = F.lit(1).cast("bigint")
    missing = lacks_required(dumped, NTEVENT)
    whole = _counted_events(dumped, F.when(missing, REJECTED).otherwise(INSERTED))
    complete = whole.where(F.col("outcome") == INSERTED).withColumn("copy", F.lit(0).cast("bigint"))
    copies = expand_copies(complete, "n", "copy").withColumn("times", one)
    lacking = whole.where(F.col("outcome") != INSERTED).select(
        *NTEVENT.keys, "outcome", F.explode(powers_of_two(F.col("n"))).alias("times"), one.alias("copy")
    )
    return copies.unionByName(lacking).unionByName(_judged_once(merged, stored))


def event_outcomes(
    log: DataFrame,
    requests: DataFrame,
    target: DataFrame,
    as_of: AsOf,
    trim_message: bool = False,
) -> DataFrame:
    """How many events of the requested days are new, lack a required value, or neither.

    ``skipped`` are those stored already, repeated, or timed outside their day.
    Counts are added up as signed rows, so no row meets another.
    """
    asked = in_day_slots(_as_events(log, trim_message), _event_days(requests, as_of))
    new = events_report(log, requests, target, as_of, trim_message)
    judged = asked.select(
        F.when(lacks_required(asked, NTEVENT), "rejected").otherwise("skipped").alias("outcome"),
        F.lit(1).alias("n"),
    )
    moved = F.array(
        F.struct(F.lit("inserted").alias("outcome"), F.lit(1).alias("n")),
        F.struct(F.lit("skipped").alias("outcome"), F.lit(-1).alias("n")),
    )
    return (
        judged.unionByName(new.select(F.inline(moved)))
        .groupBy("outcome")
        .agg(F.sum("n").alias("n_rows"))
    )


def rows_on_days(target: DataFrame, ts: str, days: DataFrame) -> DataFrame:
    """Stored rows of the given days; prunes a target partitioned by ``SlotDate``."""
    wanted = F.broadcast(distinct_slots(days, "log_date"))
    if "SlotDate" in target.columns:
        wanted = wanted.withColumnRenamed("log_date", "SlotDate")
        return target.join(wanted, "SlotDate", "left_semi")
    return (
        target.withColumn("log_date", F.to_date(ts))
        .join(wanted, "log_date", "left_semi")
        .drop("log_date")
    )


# --- disks -----------------------------------------------------------------


def weekly_disk_report(
    disks: DataFrame,
    audits: DataFrame,
    requests: DataFrame,
    target: DataFrame,
    as_of: AsOf,
    week_start: int = 1,
    cover_all_weeks: bool = False,
) -> DataFrame:
    """Disk sizes at the latest audit of each requested week, new rows only; see ``judged_weekly_disks``."""
    staged, stored = _weekly_disks(disks, audits, requests, target, as_of, week_start, cover_all_weeks)
    return insert_new(with_required(staged, DISK), stored, DISK.keys)


def judged_weekly_disks(
    disks: DataFrame,
    audits: DataFrame,
    requests: DataFrame,
    target: DataFrame,
    as_of: AsOf,
    week_start: int = 1,
    cover_all_weeks: bool = False,
) -> DataFrame:
    """Disk sizes at the latest audit of each requested week with their ``outcome``.

    Drives without a machine or name are rejected.
    """
    staged, stored = _weekly_disks(disks, audits, requests, target, as_of, week_start, cover_all_weeks)
    return _judged(mark_stored(staged, stored, DISK.keys), DISK)


def _weekly_disks(
    disks: DataFrame,
    audits: DataFrame,
    requests: DataFrame,
    target: DataFrame,
    as_of: AsOf,
    week_start: int,
    cover_all_weeks: bool,
) -> tuple[DataFrame, DataFrame]:
    """One row per drive and requested week, and what the target holds of those weeks.

    Of several detail rows of a drive the one with the smallest sizes is taken;
    drives whose names differ only in blanks are one drive. The audit depends on
    the machine and week alone, so drives are settled before they meet the weeks
    and nothing behind that join keeps Spark from splitting a hot machine.
    """
    resolved = distinct_ranges(resolve_requests(requests, as_of, unit="week"))
    weeks = week_slots(resolved, week_start, cover_all_weeks)
    # One pass over the disks: does a drive qualify, and its first detail row.
    sizes = F.struct("totalMBytes", "freeMBytes")
    drives = (
        disks.groupBy("agentGuid", "volumeName", "driveLetter")
        .agg(
            F.bool_or((F.col("resultGroup") == 1) & is_weekly_disk()).alias("_qualifies"),
            F.min(F.when(F.col("locked") == 1, sizes)).alias("_sizes"),
        )
        .where(F.col("_qualifies") & F.col("_sizes").isNotNull())
    )
    in_gb = F.struct(
        mb_to_gb(F.col("_sizes.totalMBytes")).alias("total"),
        mb_to_gb(F.col("_sizes.freeMBytes")).alias("free"),
    )
    named = drives.groupBy(
        "agentGuid",
        trim(F.col("volumeName")).alias("DiskLabel"),
        trim(F.col("driveLetter")).alias("DriveName"),
    ).agg(F.min(in_gb).alias("_gb"))
    staged = named.join(weekly_stamps(audits, weeks, week_start), "agentGuid").select(
        F.col("agentGuid").alias("AgentGUID"),
        "YearNum",
        "WeekNum",
        "DiskLabel",
        "DriveName",
        F.col("_gb.total").alias("TotalSpaceGB"),
        F.col("_gb.free").alias("FreeSpaceGB"),
        "Stamp",
    )
    asked = distinct_weeks(weeks).select("YearNum", "WeekNum")
    return staged, target.join(F.broadcast(asked), ["YearNum", "WeekNum"], "left_semi")


def current_disks(disks: DataFrame, audits: DataFrame) -> DataFrame:
    """Every disk that passes the filter, with its outcome (inserted or skipped)."""
    return latest_audit_join(disk_projection(current_disk_filter(disks)), audits)


def judged_current_disks(disks: DataFrame, audits: DataFrame, as_of: AsOf) -> DataFrame:
    """Disk sizes at each agent's latest audit, dated by the run, with their ``outcome``.

    Those of other audits are skipped, disks without a name rejected.
    """
    today = as_date(as_of)
    judged = current_disks(disks, audits)
    rejected = F.when(_rejected_disk(judged), REJECTED).otherwise(F.col("outcome"))
    return judged.select(
        "AgentGUID",
        F.year(today).alias("YearNum"),
        us_week(today).alias("WeekNum"),
        "DiskLabel",
        "DriveName",
        "TotalSpaceGB",
        "FreeSpaceGB",
        "Stamp",
        rejected.alias("outcome"),
    )


def current_disk_report(disks: DataFrame, audits: DataFrame, as_of: AsOf) -> DataFrame:
    """Disk sizes at each agent's latest audit, dated by the run; always appended."""
    return inserted(judged_current_disks(disks, audits, as_of))


def _rejected_disk(judged: DataFrame) -> Column:
    """A disk of the latest audit that lacks a value the report requires."""
    return (F.col("outcome") == "inserted") & lacks_required(judged, DISK)


def current_disk_outcomes(disks: DataFrame, audits: DataFrame) -> DataFrame:
    """How many disks were inserted and skipped."""
    return outcome_counts(current_disks(disks, audits))


# --- servers ---------------------------------------------------------------


# all keys but the one whose stored value may be NULL
_SERVER_KEYS = [c for c in SERVERS.keys if c != "LastReboot"]


def _snapshot(tables: Mapping[str, DataFrame], as_of: AsOf) -> DataFrame:
    return assemble_snapshot(
        tables["machNameTab"],
        tables["auditRsltManualFieldValues"],
        tables["auditRsltManualFields"],
        tables["userIpInfo"],
        tables["lastReboot"],
        tables["auditRsltSimm"],
        tables["auditRsltCpu"],
        as_of,
    )


def _stored_month(target: DataFrame, as_of: AsOf) -> DataFrame:
    """Stored servers of the run's month; prunes a target partitioned by ``SlotDate``."""
    month = month_start(as_date(as_of))
    stored = target.where(F.col("TheDate") == month.cast("timestamp_ntz"))
    if "SlotDate" in target.columns:
        stored = stored.where(F.col("SlotDate") == month)
    return stored


def snapshot_outcomes(
    tables: Mapping[str, DataFrame], target: DataFrame, as_of: AsOf
) -> DataFrame:
    """This month's servers with their outcome.

    ``rejected`` rows lack a value the report requires, ``skipped`` rows are
    stored already, the others are ``inserted``.
    """
    snapshot = _snapshot(tables, as_of)
    stored = _stored_month(target, as_of)
    return mark_existing(snapshot, stored, _SERVER_KEYS, "LastReboot").select(
        *snapshot.columns,
        F.when(lacks_required(snapshot, SERVERS), "rejected")
        .when(F.col("existing"), "skipped")
        .otherwise("inserted")
        .alias("outcome"),
    )


def servers_snapshot(
    tables: Mapping[str, DataFrame], target: DataFrame, as_of: AsOf
) -> DataFrame:
    """Server rows of this month that the target does not hold yet: one anti-join over one scan of the target."""
    complete = with_required(_snapshot(tables, as_of), SERVERS)
    return insert_new(
        complete, _stored_month(target, as_of), _SERVER_KEYS, null_matches=["LastReboot"]
    )
