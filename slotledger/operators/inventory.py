"""Inventory lookups that describe a server."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger.functions.calendar import AsOf, as_date, month_start
from slotledger.functions.text import size_to_mb, trim
from slotledger.operators.bounds import at_most
from slotledger.operators.filters import with_defaults

# Names of the manual fields, and the value that switches an agent on.
FLAG_FIELD = "ReportingEnabled"
TYPE_FIELD = "Server Type"
FLAG_ON = "YES"
_MANUAL = {"reportingEnabled": FLAG_FIELD, "serverType": TYPE_FIELD}
# So many reporting agents (about 32 MB) are broadcast to the attributes.
BROADCAST_AGENTS = 1_000_000


def agents(machines: DataFrame) -> DataFrame:
    return machines.select("agentGuid").distinct()


def memory_installed(simm: DataFrame) -> DataFrame:
    """Installed memory per agent in MB; modules without a readable size add nothing."""
    return simm.groupBy("agentGuid").agg(
        F.coalesce(F.sum(size_to_mb(F.col("memSize"))), F.lit(0).cast("bigint")).alias(
            "MemoryInstalledMB"
        )
    )


def is_unreadable(size: Column) -> Column:
    return size.isNotNull() & size_to_mb(size).isNull()


def unreadable_sizes(simm: DataFrame) -> DataFrame:
    """How many module sizes were given but could not be read."""
    return simm.agg(F.count_if(is_unreadable(F.col("memSize"))).alias("n_rows"))


def _wanted_fields(fields: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """``(fieldNameFK, _column)``: the fields that fill a column."""
    column = None
    for out, name in names.items():
        test = F.upper(F.col("fieldName")) == name.upper()
        column = F.when(test, F.lit(out)) if column is None else column.when(test, F.lit(out))
    return fields.select(F.col("id").alias("fieldNameFK"), column.alias("_column")).where(
        F.col("_column").isNotNull()
    )


def _pivoted(names: Iterable[str]) -> list[Column]:
    return [F.when(F.col("_column") == out, F.col("fieldValue")).alias(out) for out in names]


def eav_pivot(
    values: DataFrame, fields: DataFrame, names: Mapping[str, str]
) -> DataFrame:
    """Named manual fields as columns, one row per agent.

    ``names`` maps output column to field name (any letter case). Of several
    values the largest is taken. Field definitions carry no join hint; Spark
    broadcasts them after its own size check.
    """
    return (
        values.join(_wanted_fields(fields, names), "fieldNameFK")
        .select("agentGuid", *_pivoted(names))
        .groupBy("agentGuid")
        .agg(*[F.max(out).alias(out) for out in names])
    )


def is_reporting(col: str = "reportingEnabled"):
    return F.upper(F.rtrim(F.col(col))) == FLAG_ON


def manual_fields(values: DataFrame, fields: DataFrame) -> DataFrame:
    """The reporting flag and the server type of each agent."""
    return eav_pivot(values, fields, _MANUAL)


def reporting_agents(values: DataFrame, fields: DataFrame) -> DataFrame:
    """Agents whose reporting flag is switched on."""
    return manual_fields(values, fields).where(is_reporting()).select("agentGuid")


def last_reboots(reboots: DataFrame) -> DataFrame:
    """Newest reboot per agent."""
    return reboots.groupBy("agentGuid").agg(F.max("rebootTime").alias("LastReboot"))


def assemble_snapshot(
    machines: DataFrame,
    values: DataFrame,
    fields: DataFrame,
    ip_info: DataFrame,
    reboots: DataFrame,
    simm: DataFrame,
    cpu: DataFrame,
    as_of: AsOf,
) -> DataFrame:
    """One row per reporting agent with all its attributes.

    The rows of all sources are one list, each with the columns it knows, and one
    aggregate per agent takes from it what the lookups would: one shuffle, partial
    before it, so that an agent with very many rows of a source is no burden. Where
    few agents report, the rows of the others are left out ahead of it.
    """
    wanted = _wanted_fields(fields, _MANUAL)
    manual = values.join(wanted, "fieldNameFK")
    attributes = [
        machines.select("agentGuid", F.struct("machName", "groupName").alias("_names")),
        manual.select("agentGuid", *_pivoted(_MANUAL)),
        ip_info.select("agentGuid", F.struct("ipAddress", "osInfo").alias("_network")),
        reboots.select("agentGuid", "rebootTime"),
        simm.select("agentGuid", size_to_mb(F.col("memSize")).alias("_mb")),
        cpu.select("agentGuid", F.struct("cpuDesc", "cpuCount").alias("_processor")),
    ]
    rows = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), attributes)
    flagged = manual.where((F.col("_column") == "reportingEnabled") & is_reporting("fieldValue"))
    few = at_most(flagged.select("agentGuid").distinct(), BROADCAST_AGENTS)
    if few is not None:
        rows = rows.join(few, "agentGuid", "left_semi")
    # structs compare by their fields, NULL first, like the order of the lookups
    joined = (
        rows.where(F.col("agentGuid").isNotNull())
        .groupBy("agentGuid")
        .agg(
            *[F.max(c).alias(c) for c in _MANUAL],
            F.min("_names").alias("_names"),
            F.min("_network").alias("_network"),
            F.max("rebootTime").alias("LastReboot"),
            F.sum("_mb").alias("MemoryInstalledMB"),
            F.min("_processor").alias("_processor"),
        )
        .where(is_reporting() & F.col("_names").isNotNull())
        .select("*", "_names.*", "_network.*", "_processor.*")
    )
    snapshot = joined.select(
        F.col("agentGuid").alias("AgentGUID"),
        trim(F.col("machName")).alias("Server"),
        trim(F.col("groupName")).alias("Company"),
        month_start(as_date(as_of)).cast("timestamp_ntz").alias("TheDate"),
        trim(F.col("serverType")).alias("MachineType"),
        trim(F.col("ipAddress")).alias("IPAddress"),
        "LastReboot",
        "MemoryInstalledMB",
        F.col("cpuDesc").alias("Processor"),
        F.col("cpuCount").alias("Cores"),
        trim(F.col("osInfo")).alias("WindowsVersion"),
    )
    return with_defaults(
        snapshot,
        {
            "Company": "",
            "MachineType": "",
            "MemoryInstalledMB": 0,
            "Processor": "",
            "Cores": 0,
            "WindowsVersion": "",
        },
    )
