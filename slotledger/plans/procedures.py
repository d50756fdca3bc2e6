"""The report jobs as calls with the arguments of the stored procedures.

Each call reads its sources, judges the rows it finds and publishes the new ones in
the report under ``reports``, all or none of them, whatever else runs (see
``sinks.publish``). Calls may be repeated, killed or not: what is stored is not
stored again, except by ``report_current_disks`` and ``report_daily_components``,
which always append. A call returns its outcomes as they were stored with the rows:
``inserted`` rows, ``rejected`` ones that lack a required value, and ``skipped``
ones, which are the others.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotledger.functions.calendar import AsOf
from slotledger.operators.inventory import unreadable_sizes
from slotledger.operators.widen import ACTIVITY_COLUMNS, CONTACT_COLUMNS, widen
from slotledger.plans import jobs
from slotledger.schemas import (
    COMPONENT_REPORTS,
    CPU,
    DISK,
    INSERTED,
    NTEVENT,
    REJECTED,
    REQUESTS,
    SERVERS,
    SKIPPED,
    Report,
)
from slotledger.sinks.publish import publish, run_name
from slotledger.sinks.reports import append_components, judged_rows, write_wide
from slotledger.sources.tables import (
    contact_activity,
    load_tables,
    scan_counter_log,
    scan_event_log,
    scan_report,
)


def request(
    spark: SparkSession,
    components: str | None = None,
    from_date: str | int | None = None,
    to_date: str | None = None,
) -> DataFrame:
    """A request table of one row."""
    start = None if from_date is None else str(from_date)
    return spark.createDataFrame([(1, components, start, to_date)], REQUESTS)


Counts = Mapping[tuple[str, str], int]


def _outcomes(counts: Counts) -> dict[str, int]:
    """Rows by outcome, over all reports of a call."""
    return {
        outcome: sum(n for (_, o), n in counts.items() if o == outcome)
        for outcome in (INSERTED, SKIPPED, REJECTED)
    }


def published(
    spark: SparkSession,
    reports: str,
    report: Report,
    as_of: AsOf,
    judge: Callable[[], DataFrame],
    *arguments: object,
    depends: bool = True,
) -> Counts:
    """Publishes the judged rows of one report."""
    run = run_name(report.name, as_of, *arguments)
    return publish(spark, reports, report, run, lambda: judged_rows(judge(), report, as_of), depends)


def published_components(
    spark: SparkSession,
    log: DataFrame,
    counters: DataFrame,
    requests: DataFrame,
    reports: str,
    as_of: AsOf,
    *arguments: object,
) -> Mapping[str, int]:
    """Publishes the hourly rows of both reports together."""
    named = {component: report.name for component, report in COMPONENT_REPORTS.items()}
    report_of = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])

    def judge() -> DataFrame:
        stored = {c: scan_report(spark, reports, name) for c, name in named.items()}
        judged = jobs.judged_components(log, counters, requests, stored, as_of)
        return judged_rows(judged, CPU, as_of, report_of[F.col("component")])

    counts = publish(spark, reports, CPU, run_name("components", as_of, *arguments), judge)
    gained = {component: counts.get((name, INSERTED), 0) for component, name in named.items()}
    rest = _outcomes(counts)
    return {**gained, SKIPPED: rest[SKIPPED], REJECTED: rest[REJECTED]}


def report_components(
    spark: SparkSession,
    log_path: str,
    tables: str,
    reports: str,
    as_of: AsOf,
    components: str | None = None,
    from_date: str | int | None = None,
    to_date: str | None = None,
) -> Mapping[str, int]:
    """Hourly CPU and memory rows; returns how many each report gained, and the other outcomes.

    The rows of both reports are published together.
    """
    return published_components(
        spark,
        scan_counter_log(spark, log_path),
        load_tables(spark, tables, "monitorCounter")["monitorCounter"],
        request(spark, components, from_date, to_date),
        reports,
        as_of,
        components,
        from_date,
        to_date,
    )


def report_daily_components(
    spark: SparkSession,
    log_path: str,
    tables: str,
    reports: str,
    as_of: AsOf,
    components: str | None = None,
    from_date: str | int | None = None,
    to_date: str | None = None,
) -> Mapping[str, int]:
    """Daily CPU and memory rows, always appended; returns how many each report gained."""
    daily = jobs.daily_components(
        scan_counter_log(spark, log_path),
        load_tables(spark, tables, "monitorCounter")["monitorCounter"],
        request(spark, components, from_date, to_date),
        as_of,
    )
    return append_components(daily, reports, as_of)


def report_events(
    spark: SparkSession,
    log_path: str,
    reports: str,
    as_of: AsOf,
    from_date: str | int | None = None,
    to_date: str | None = None,
    trim_message: bool = False,
) -> Mapping[str, int]:
    """Events of the requested days; skipped are those stored, repeated or timed outside their day."""

    def judge() -> DataFrame:
        return jobs.judged_events(
            scan_event_log(spark, log_path),
            request(spark, None, from_date, to_date),
            scan_report(spark, reports, "NTEvent"),
            as_of,
            trim_message,
        )

    return _outcomes(published(spark, reports, NTEVENT, as_of, judge, from_date, to_date))


def report_weekly_disks(
    spark: SparkSession,
    tables: str,
    reports: str,
    as_of: AsOf,
    from_date: str | int | None = None,
    to_date: str | None = None,
    cover_all_weeks: bool = False,
) -> Mapping[str, int]:
    """Disk sizes of the requested weeks."""
    source = load_tables(spark, tables, "auditRsltDisks", "auditRsltDate")

    def judge() -> DataFrame:
        return jobs.judged_weekly_disks(
            source["auditRsltDisks"],
            source["auditRsltDate"],
            request(spark, None, from_date, to_date),
            scan_report(spark, reports, "Disk"),
            as_of,
            cover_all_weeks=cover_all_weeks,
        )

    return _outcomes(published(spark, reports, DISK, as_of, judge, from_date, to_date))


def report_current_disks(
    spark: SparkSession, tables: str, reports: str, as_of: AsOf
) -> Mapping[str, int]:
    """Disk sizes at the latest audits; skipped are those of other audits."""
    source = load_tables(spark, tables, "auditRsltDisks", "auditRsltDate")

    def judge() -> DataFrame:
        return jobs.judged_current_disks(source["auditRsltDisks"], source["auditRsltDate"], as_of)

    return _outcomes(published(spark, reports, DISK, as_of, judge, "current", depends=False))


def report_servers(
    spark: SparkSession, tables: str, reports: str, as_of: AsOf
) -> Mapping[str, int]:
    """This month's servers; also returns the memory sizes that were ``unreadable``."""
    source = load_tables(spark, tables)

    def judge() -> DataFrame:
        return jobs.snapshot_outcomes(source, scan_report(spark, reports, "Servers"), as_of)

    counts = _outcomes(published(spark, reports, SERVERS, as_of, judge))
    return {**counts, "unreadable": unreadable_sizes(source["auditRsltSimm"]).first()["n_rows"]}


def report_activities(
    spark: SparkSession, view: str, path: str, slots_per_row: int | None = None
) -> None:
    """Replaces the wide activity table at ``path`` by the contacts of ``view``.

    Without ``slots_per_row`` the contact with the most activities decides the columns.
    """
    wide = widen(
        contact_activity(spark, view),
        CONTACT_COLUMNS,
        "created_on",
        ACTIVITY_COLUMNS,
        slots_per_row,
        count_by=["contact"],
    )
    write_wide(wide, path)
