"""Latest row per key, and the disk joins built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotledger.operators.filters import is_weekly_disk
from slotledger.operators.slots import join_week_slots


def ranked(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int
) -> DataFrame:
    """First ``n`` rows of each key.

    Spark limits each key to ``n`` rows per map task before the shuffle (a
    window group limit), so a key that holds a large share of the rows does
    not end up in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n).drop(
        "_rank"
    )


def latest_per_key(
    df: DataFrame, key: str, order: Sequence[str | Column], tie: Sequence[str | Column] = ()
) -> DataFrame:
    """One row per key: the first in ``order``, ties settled by ``tie``."""
    return ranked(df, [key], [*order, *tie], 1)


def top_one(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per key when no order is declared: the smallest by its columns."""
    return latest_per_key(
        df.select(key, *columns), key, [F.col(c).asc_nulls_first() for c in columns]
    )


def latest_audits(audits: DataFrame) -> DataFrame:
    """The most recent audit of each agent."""
    return latest_per_key(
        audits.select("agentGuid", "resultGroup", "locked", "date"),
        "agentGuid",
        [F.col("date").desc_nulls_last()],
        [F.col("resultGroup").asc_nulls_first(), F.col("locked").asc_nulls_first()],
    )


def latest_audit_join(disks: DataFrame, audits: DataFrame) -> DataFrame:
    """Projected disks with the stamp of their agent's latest audit and an outcome.

    A disk is ``inserted`` when it belongs to the result group and lock state of
    that audit, else ``skipped``. The join is on all three columns: both sides
    then come straight from their own shuffle, which lets AQE split an agent
    that holds a large share of the disks.
    """
    stamps = latest_audits(audits).select(
        F.col("agentGuid").alias("AgentGUID"),
        F.col("resultGroup").alias("ResultGroup"),
        F.col("locked").alias("Locked"),
        F.col("date").alias("Stamp"),
    )
    return disks.join(stamps, ["AgentGUID", "ResultGroup", "Locked"], "left").withColumn(
        "outcome", F.when(F.col("Stamp").isNull(), "skipped").otherwise("inserted")
    )


def weekly_stamps(audits: DataFrame, weeks: DataFrame, week_start: int = 1) -> DataFrame:
    """Latest group-1 audit per agent and week: ``(agentGuid, YearNum, WeekNum, Stamp)``."""
    in_group = audits.where(F.col("resultGroup") == 1).select("agentGuid", "date")
    return (
        join_week_slots(in_group, "date", weeks, week_start)
        .groupBy("agentGuid", "YearNum", "WeekNum")
        .agg(F.max("date").alias("Stamp"))
    )


def latest_stamp(
    disks: DataFrame, audits: DataFrame, weeks: DataFrame, week_start: int = 1
) -> DataFrame:
    """Latest audit stamp in the week per agent, label and drive.

    The stamp depends on the agent and week alone, so audits are aggregated and
    disks made distinct before they meet; the join gives exactly the result
    rows instead of every disk-audit pair.
    """
    drives = (
        disks.where((F.col("resultGroup") == 1) & is_weekly_disk())
        .select("agentGuid", "volumeName", "driveLetter")
        .distinct()
    )
    return drives.join(weekly_stamps(audits, weeks, week_start), "agentGuid").select(
        "agentGuid", "volumeName", "driveLetter", "YearNum", "WeekNum", "Stamp"
    )


def join_back_latest(
    latest: DataFrame, disks: DataFrame, audits: DataFrame, locked: int = 1
) -> DataFrame:
    """Latest stamps joined back to the disk detail and to the audit dates.

    Equal detail rows and equal audit rows multiply in this join. The product is
    returned as ``copies`` on one row: each side is counted before the join, so
    a hot drive or a much repeated audit is never expanded into pairs.
    """
    detail = (
        disks.where(F.col("locked") == locked)
        .groupBy("agentGuid", "volumeName", "driveLetter", "totalMBytes", "freeMBytes")
        .agg(F.count(F.lit(1)).alias("_disks"))
    )
    dates = audits.groupBy("agentGuid", F.col("date").alias("Stamp")).agg(
        F.count(F.lit(1)).alias("_audits")
    )
    return (
        latest.join(detail, ["agentGuid", "volumeName", "driveLetter"])
        .join(dates, ["agentGuid", "Stamp"])
        .select(
            "agentGuid",
            "volumeName",
            "driveLetter",
            "YearNum",
            "WeekNum",
            "Stamp",
            "totalMBytes",
            "freeMBytes",
            (F.col("_disks") * F.col("_audits")).alias("copies"),
        )
    )
