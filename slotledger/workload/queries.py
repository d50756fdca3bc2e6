"""One query per operator, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotledger.functions import calendar as cal
from slotledger.functions import text as tx
from slotledger.operators import filters, inventory, latest, merge, rollup, slots, widen
from slotledger.plans import jobs
from slotledger.schemas import MESSAGE_WIDTH, NTEVENT, REPORTS, SUM_TOLERANCE
from slotledger.sinks import reports
from slotledger.workload import tables as t

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = t.AS_OF


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    """Sums of floats, freed of the last digits that depend on the order of adding."""
    return df.withColumns({c: F.round(c, 4) for c in cols})


# --- calendar and scalar functions -----------------------------------------


@query
def start_end_of_week(spark, sf_dir):
    week_starts = F.explode(F.sequence(F.lit(0), F.lit(8))).alias("week_start")
    day, ws = F.col("o_orderdate"), F.col("week_start")
    return (
        t.read(spark, sf_dir, "orders")
        .select("o_orderkey", "o_orderdate", week_starts)
        .select(
            "o_orderkey",
            "week_start",
            cal.start_of_week(day, ws).alias("week_begin"),
            cal.end_of_week(day, ws).alias("week_end"),
        )
    )


@query
def week_number(spark, sf_dir):
    day = F.col("o_orderdate")
    return t.read(spark, sf_dir, "orders").select(
        "o_orderkey", F.year(day).alias("YearNum"), cal.us_week(day).alias("WeekNum")
    )


@query
def calendar_keys(spark, sf_dir):
    day = F.col("o_orderdate")
    return t.read(spark, sf_dir, "orders").select(
        "o_orderkey",
        cal.month_start(day).alias("month_start"),
        cal.date_key(day).alias("date_key"),
        F.date_add(day, 7).alias("next_week"),
        F.datediff(cal.as_date(AS_OF), F.to_date(day)).alias("days_back"),
    )


@query
def argument_tests(spark, sf_dir):
    raw = F.col("from_parm")
    text = tx.strip_separators(raw)
    return t.order_requests(spark, sf_dir).select(
        "req_id",
        text.alias("stripped"),
        F.coalesce(tx.is_date(text), F.lit(False)).alias("is_date"),
        F.coalesce(tx.is_int(text), F.lit(False)).alias("is_int"),
    )


@query
def text_functions(spark, sf_dir):
    text = F.col("text")
    return t.read(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5(tx.trim(text)).alias("trimmed"),
        F.md5(tx.replace(text, "the", "")).alias("replaced"),
        tx.left(text, 30).alias("head"),
        tx.contains_ci(text, "THE").alias("has_the"),
        tx.like_ci(text, "%an%ing%").alias("like_ing"),
        tx.like_ci(text, r"%\%%").alias("has_percent"),
    )


@query
def number_functions(spark, sf_dir):
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return t.read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        tx.mb_to_gb(price).alias("gb"),
        F.abs(discount - F.col("l_tax")).alias("gap"),
        tx.near(discount, F.col("l_tax"), 0.0100001).alias("close"),
        tx.coalesce(F.when(discount > 0.02, discount), 0.0).alias("discount_or_zero"),
    )


# --- slots -----------------------------------------------------------------


@query
def resolve_requests(spark, sf_dir):
    return slots.resolve_requests(t.order_requests(spark, sf_dir), AS_OF).select(
        "req_id", "from_date", "to_date"
    )


@query
def resolve_requests_weeks(spark, sf_dir):
    return slots.resolve_requests(t.order_requests(spark, sf_dir), AS_OF, "week").select(
        "req_id", "from_date", "to_date"
    )


@query
def day_slots(spark, sf_dir):
    resolved = slots.resolve_requests(t.order_requests(spark, sf_dir), AS_OF)
    return slots.day_slots(resolved).select("req_id", "log_date")


_WEEK_COLUMNS = ["req_id", "slot_date", "week_begin", "week_end", "week_limit", "YearNum", "WeekNum"]


@query
def week_slots(spark, sf_dir):
    resolved = slots.resolve_requests(t.order_requests(spark, sf_dir), AS_OF, "week")
    return slots.week_slots(resolved).select(*_WEEK_COLUMNS)


@query
def week_slots_covering(spark, sf_dir):
    resolved = slots.resolve_requests(t.order_requests(spark, sf_dir), AS_OF, "week")
    return slots.week_slots(resolved, cover_all_weeks=True).select(*_WEEK_COLUMNS)


@query
def resolve_components(spark, sf_dir):
    return slots.resolve_components(t.order_requests(spark, sf_dir)).select("req_id", "component")


def _log_days(spark, sf_dir):
    return slots.day_slots(slots.resolve_requests(t.log_requests(spark, sf_dir), AS_OF))


@query
def scan_counter_log(spark, sf_dir):
    return slots.in_day_slots(t.counter_log(spark, sf_dir), _log_days(spark, sf_dir))


@query
def scan_event_log(spark, sf_dir):
    return slots.in_day_slots(t.event_log(spark, sf_dir), _log_days(spark, sf_dir))


@query
def stored_on_days(spark, sf_dir):
    days = slots.distinct_slots(_log_days(spark, sf_dir), "log_date")
    return jobs.rows_on_days(t.stored_events(spark, sf_dir), "EventTime", days)


@query
def events_in_day(spark, sf_dir):
    day = F.col("log_date")
    return slots.rows_in_slot(
        t.event_log(spark, sf_dir),
        "eventTime",
        day.cast("timestamp_ntz"),
        F.date_add(day, 1).cast("timestamp_ntz"),
    )


@query
def join_day_slots(spark, sf_dir):
    days = _log_days(spark, sf_dir).select("req_id", "log_date")
    events = t.event_log(spark, sf_dir).drop("log_date")
    return slots.join_day_slots(events, "eventTime", days)


@query
def join_week_slots(spark, sf_dir):
    resolved = slots.resolve_requests(t.audit_requests(spark, sf_dir), AS_OF, "week")
    return slots.join_week_slots(t.audits(spark, sf_dir), "date", slots.week_slots(resolved))


@query
def join_windows(spark, sf_dir):
    """Events in windows of an hour and a half up to 45 days that overlap; some are empty or reversed."""
    windows = t.windows(spark, sf_dir)
    return slots.join_windows(t.event_log(spark, sf_dir).drop("log_date"), "eventTime", windows)


# --- filters and projections -----------------------------------------------


@query
def counter_filter_cpu(spark, sf_dir):
    return filters.cpu_counters(t.part_counters(spark, sf_dir))


@query
def counter_filter_mem(spark, sf_dir):
    return filters.mem_counters(t.part_counters(spark, sf_dir))


@query
def disk_filter_v1(spark, sf_dir):
    return filters.weekly_disk_filter(filters.where_group(t.disks(spark, sf_dir)))


@query
def disk_filter_v3(spark, sf_dir):
    return filters.current_disk_filter(t.disks(spark, sf_dir))


@query
def where_group(spark, sf_dir):
    return filters.where_group(t.audits(spark, sf_dir), result_group=1, locked=1)


@query
def disk_projection(spark, sf_dir):
    return filters.disk_projection(t.disks(spark, sf_dir))


@query
def null_defaults(spark, sf_dir):
    return filters.with_defaults(
        t.ip_info(spark, sf_dir), {"ipAddress": "", "osInfo": ""}
    )


@query
def null_or_equal(spark, sf_dir):
    reboots = t.reboots(spark, sf_dir)
    first = F.lit("1998-01-01").cast("timestamp_ntz")
    same = tx.null_or_equal(F.col("rebootTime"), first)
    return reboots.groupBy("agentGuid").agg(F.count_if(same).alias("n_rows"))


@query
def message_limit(spark, sf_dir):
    return t.read(spark, sf_dir, "documents").select(
        "doc_id", tx.limit_message(F.col("text"), MESSAGE_WIDTH).alias("Message")
    )


@query
def message_trim(spark, sf_dir):
    return t.event_log(spark, sf_dir).withColumn("message", tx.trim(F.col("message")))


# --- counter rollups -------------------------------------------------------


@query
def component_readings(spark, sf_dir):
    return _rounded(
        rollup.component_readings(
            t.counter_log(spark, sf_dir), t.counters(spark, sf_dir)
        ).select("component", "agentGuid", "monitorCounterId", "eventDateTime", "counterValue"),
        "counterValue",
    )


def _rolled(spark, sf_dir, component, closed):
    return _rounded(
        rollup.hourly_rollup(
            t.counter_log(spark, sf_dir), t.counters(spark, sf_dir), component, closed
        ),
        "Sum",
    )


@query
def hourly_rollup_closed(spark, sf_dir):
    return _rolled(spark, sf_dir, "CPU", "both")


@query
def hourly_rollup_left(spark, sf_dir):
    return _rolled(spark, sf_dir, "CPU", "left")


@query
def hourly_rollup_mem(spark, sf_dir):
    return _rolled(spark, sf_dir, "MEM", "both")


@query
def component_rollup(spark, sf_dir):
    return _rounded(
        rollup.component_rollup(t.counter_log(spark, sf_dir), t.counters(spark, sf_dir)), "Sum"
    )


@query
def component_rollup_sums_first(spark, sf_dir):
    """As ``component_rollup``, by the plan for counters too many to broadcast."""
    log, counters = t.counter_log(spark, sf_dir), t.counters(spark, sf_dir)
    return _rounded(rollup.component_rollup(log, counters, sums_first=True), "Sum")


@query
def daily_rollup_sums_first(spark, sf_dir):
    log, counters = t.counter_log(spark, sf_dir), t.counters(spark, sf_dir)
    return _rounded(rollup.daily_rollup(log, counters, sums_first=True), "Sum")


@query
def daily_rollup(spark, sf_dir):
    return _rounded(
        rollup.daily_rollup(t.counter_log(spark, sf_dir), t.counters(spark, sf_dir)), "Sum"
    )


# --- merging into a report -------------------------------------------------


def _event_batch(spark, sf_dir):
    return t.event_log(spark, sf_dir).select(
        F.col("agentGuid").alias("AgentGUID"),
        F.col("eventTime").alias("EventTime"),
        F.col("message").alias("Message"),
    )


@query
def insert_new_exact(spark, sf_dir):
    return merge.insert_new(
        _event_batch(spark, sf_dir), t.stored_events(spark, sf_dir), NTEVENT.keys
    )


@query
def insert_new_approx(spark, sf_dir):
    batch = rollup.hourly_rollup(t.counter_log(spark, sf_dir), t.counters(spark, sf_dir), "CPU")
    stored = t.stored_components(spark, sf_dir)["CPU"]
    return _rounded(
        merge.insert_new(
            batch,
            stored,
            ["AgentGUID", "TheDate", "Hour", "DataPoints"],
            approx={"Sum": SUM_TOLERANCE},
        ),
        "Sum",
    )


@query
def load_if_slot_empty(spark, sf_dir):
    batch = _event_batch(spark, sf_dir).withColumn("day", F.to_date("EventTime"))
    stored = t.stored_events(spark, sf_dir).withColumn("day", F.to_date("EventTime"))
    return merge.load_if_slot_empty(batch, stored, ["day"])


@query
def mark_slots(spark, sf_dir):
    days = slots.distinct_slots(_log_days(spark, sf_dir), "log_date")
    return merge.mark_slots(days, t.stored_events(spark, sf_dir), F.to_date("EventTime"))


@query
def distinct_events(spark, sf_dir):
    return merge.first_per_key(_event_batch(spark, sf_dir), NTEVENT.keys)


@query
def first_per_key(spark, sf_dir):
    projected = filters.disk_projection(t.disks(spark, sf_dir))
    return merge.first_per_key(
        projected,
        ["AgentGUID", "DriveName", "DiskLabel"],
        [F.asc_nulls_first(c) for c in ("TotalSpaceGB", "FreeSpaceGB", "ResultGroup", "Locked")],
    )


@query
def slot_counts(spark, sf_dir):
    return merge.slot_counts(t.event_log(spark, sf_dir), ["log_date"])


@query
def rec_id(spark, sf_dir):
    return reports.with_rec_id(
        _event_batch(spark, sf_dir).select("AgentGUID", "Message"), ["AgentGUID", "Message"]
    )


@query
def rec_id_copies(spark, sf_dir):
    """A different key for every event of a machine with the same message, whatever its time."""
    keyed = reports.with_rec_id(_event_batch(spark, sf_dir), ["AgentGUID", "Message"], copies=True)
    return keyed.select("AgentGUID", "Message", "RecID")


@query
def report_rows(spark, sf_dir):
    rows = reports.to_report(_event_batch(spark, sf_dir), REPORTS["NTEvent"], AS_OF)
    return rows.withColumn("AgentGUID", F.col("AgentGUID").cast("bigint"))


# --- latest rows and disks -------------------------------------------------


@query
def latest_per_agent(spark, sf_dir):
    return latest.latest_audits(t.audits(spark, sf_dir))


@query
def latest_audit_join(spark, sf_dir):
    disks = filters.disk_projection(t.disks(spark, sf_dir))
    return latest.latest_audit_join(disks, t.audits(spark, sf_dir))


@query
def outcome_counts(spark, sf_dir):
    return jobs.current_disk_outcomes(t.disks(spark, sf_dir), t.audits(spark, sf_dir))


def _audit_weeks(spark, sf_dir):
    resolved = slots.resolve_requests(t.audit_requests(spark, sf_dir), AS_OF, "week")
    return slots.week_slots(resolved)


@query
def latest_stamp_weekly(spark, sf_dir):
    return latest.latest_stamp(
        t.disks(spark, sf_dir), t.audits(spark, sf_dir), _audit_weeks(spark, sf_dir)
    )


@query
def join_back_latest(spark, sf_dir):
    disks, audits = t.disks(spark, sf_dir), t.audits(spark, sf_dir)
    stamps = latest.latest_stamp(disks, audits, _audit_weeks(spark, sf_dir))
    return latest.join_back_latest(stamps, disks, audits)


# --- inventory -------------------------------------------------------------


@query
def agents(spark, sf_dir):
    return inventory.agents(t.machines(spark, sf_dir))


@query
def size_to_mb(spark, sf_dir):
    return t.memory_modules(spark, sf_dir).withColumn("mb", tx.size_to_mb(F.col("memSize")))


@query
def memory_installed(spark, sf_dir):
    return inventory.memory_installed(t.memory_modules(spark, sf_dir))


@query
def unreadable_sizes(spark, sf_dir):
    return inventory.unreadable_sizes(t.memory_modules(spark, sf_dir))


@query
def eav_pivot(spark, sf_dir):
    return inventory.manual_fields(t.field_values(spark, sf_dir), t.fields(spark, sf_dir))


@query
def reporting_agents(spark, sf_dir):
    return inventory.reporting_agents(t.field_values(spark, sf_dir), t.fields(spark, sf_dir))


@query
def top1_lookup(spark, sf_dir):
    return latest.top_one(
        t.ip_info(spark, sf_dir), "agentGuid", ["ipAddress", "osInfo"]
    )


@query
def last_reboots(spark, sf_dir):
    return inventory.last_reboots(t.reboots(spark, sf_dir))


def _snapshot(spark, sf_dir):
    s = t.inventory(spark, sf_dir)
    return inventory.assemble_snapshot(
        s["machNameTab"],
        s["auditRsltManualFieldValues"],
        s["auditRsltManualFields"],
        s["userIpInfo"],
        s["lastReboot"],
        s["auditRsltSimm"],
        s["auditRsltCpu"],
        AS_OF,
    )


@query
def assemble_snapshot(spark, sf_dir):
    return _snapshot(spark, sf_dir)


# --- activities ------------------------------------------------------------


@query
def max_group_size(spark, sf_dir):
    return widen.max_group_size(t.activities(spark, sf_dir), "contact")


@query
def number_activities(spark, sf_dir):
    rows = t.activities(spark, sf_dir).select("contact", "created_on", "type")
    return widen.number_activities(rows, ["contact"], "created_on", ["type"])


@query
def widen_conversations(spark, sf_dir):
    return widen.widen(
        t.activities(spark, sf_dir),
        widen.CONTACT_COLUMNS,
        "created_on",
        widen.ACTIVITY_COLUMNS,
        count_by=["contact"],
    )


@query
def widen_paged(spark, sf_dir):
    """Three activities in a row, further ones on further rows."""
    return widen.widen(
        t.activities(spark, sf_dir),
        widen.CONTACT_COLUMNS,
        "created_on",
        widen.ACTIVITY_COLUMNS,
        slots_per_row=3,
    )


@query
def number_with_nulls(spark, sf_dir):
    """Orders per status, a hot contact each; a third without one, some without a date."""
    orders = t.read(spark, sf_dir, "orders").select(
        F.when(F.col("o_custkey") % 3 > 0, F.col("o_orderstatus")).alias("contact"),
        F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderdate")).alias("created_on"),
        "o_orderkey",
    )
    # which numbers a date has does not depend on how its orders are told apart
    numbered = widen.number_activities(orders, ["contact"], "created_on", ["o_orderkey"])
    return numbered.groupBy("contact", "created_on").agg(
        F.min("slot").alias("first_slot"),
        F.max("slot").alias("last_slot"),
        F.countDistinct("slot").alias("n_slots"),
    )


# --- whole jobs ------------------------------------------------------------


@query
def components_report(spark, sf_dir):
    return _rounded(
        jobs.components_report(
            t.counter_log(spark, sf_dir),
            t.counters(spark, sf_dir),
            t.log_requests(spark, sf_dir),
            t.stored_components(spark, sf_dir),
            AS_OF,
        ),
        "Sum",
    )


@query
def daily_components(spark, sf_dir):
    return _rounded(
        jobs.daily_components(
            t.counter_log(spark, sf_dir),
            t.counters(spark, sf_dir),
            t.log_requests(spark, sf_dir),
            AS_OF,
        ),
        "Sum",
    )


@query
def events_report(spark, sf_dir):
    return jobs.events_report(
        t.event_log(spark, sf_dir),
        t.log_requests(spark, sf_dir),
        t.stored_events(spark, sf_dir),
        AS_OF,
    )


@query
def event_outcomes(spark, sf_dir):
    """The log with every seventh machine's messages missing."""
    log = t.event_log(spark, sf_dir)
    return jobs.event_outcomes(
        log.withColumn("message", F.when(F.col("agentGuid") % 7 > 0, F.col("message"))),
        t.log_requests(spark, sf_dir),
        t.stored_events(spark, sf_dir),
        AS_OF,
    )


@query
def judged_event_outcomes(spark, sf_dir):
    """The counts of ``event_outcomes``, from the rows as a call stages them."""
    log = t.event_log(spark, sf_dir)
    judged = jobs.judged_events(
        log.withColumn("message", F.when(F.col("agentGuid") % 7 > 0, F.col("message"))),
        t.log_requests(spark, sf_dir),
        t.stored_events(spark, sf_dir),
        AS_OF,
    )
    return judged.groupBy("outcome").agg(F.sum("times").alias("n_rows"))


@query
def judged_components(spark, sf_dir):
    """Hourly rows of the requested slots with their outcome."""
    judged = jobs.judged_components(
        t.counter_log(spark, sf_dir),
        t.counters(spark, sf_dir),
        t.log_requests(spark, sf_dir),
        t.stored_components(spark, sf_dir),
        AS_OF,
    )
    return _rounded(judged, "Sum")


@query
def judged_weekly_disks(spark, sf_dir):
    judged = jobs.judged_weekly_disks(
        t.disks(spark, sf_dir),
        t.audits(spark, sf_dir),
        t.audit_requests(spark, sf_dir),
        t.stored_disks(spark, sf_dir),
        AS_OF,
    )
    return judged.select("AgentGUID", "YearNum", "WeekNum", "DiskLabel", "DriveName", "outcome")


@query
def weekly_disk_report(spark, sf_dir):
    return jobs.weekly_disk_report(
        t.disks(spark, sf_dir),
        t.audits(spark, sf_dir),
        t.audit_requests(spark, sf_dir),
        t.stored_disks(spark, sf_dir),
        AS_OF,
    )


@query
def current_disk_report(spark, sf_dir):
    return jobs.current_disk_report(t.disks(spark, sf_dir), t.audits(spark, sf_dir), AS_OF)


def _stored_servers(spark, sf_dir):
    """Two segments are stored; one of them before its reboots were known."""
    segment = F.col("MachineType")
    return (
        _snapshot(spark, sf_dir)
        .where(segment.isin("MACHINERY", "FURNITURE"))
        .withColumn("LastReboot", F.when(segment == "MACHINERY", F.col("LastReboot")))
        .where(F.col("IPAddress").isNotNull())
    )


@query
def servers_snapshot(spark, sf_dir):
    return jobs.servers_snapshot(
        t.inventory(spark, sf_dir), _stored_servers(spark, sf_dir), AS_OF
    )


@query
def snapshot_outcomes(spark, sf_dir):
    return merge.outcome_counts(
        jobs.snapshot_outcomes(
            t.inventory(spark, sf_dir), _stored_servers(spark, sf_dir), AS_OF
        )
    )
