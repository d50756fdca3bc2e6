"""Table layouts: the sources the jobs read and the reports they append to."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

AGENT = T.DecimalType(26, 0)
NTZ = T.TimestampNTZType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType(
        [T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields]
    )


# --- sources ---------------------------------------------------------------

COUNTER_LOG = _struct(
    ("agentGuid", AGENT),
    ("monitorCounterId", T.LongType()),
    ("eventDateTime", NTZ),
    ("counterValue", T.DoubleType()),
    ("log_date", T.DateType()),
)
EVENT_LOG = _struct(
    ("agentGuid", AGENT),
    ("eventTime", NTZ),
    ("message", T.StringType()),
    ("log_date", T.DateType()),
)

SOURCES: dict[str, T.StructType] = {
    "monitorCounter": _struct(("monitorCounterId", T.LongType()), ("name", T.StringType())),
    "auditRsltDisks": _struct(
        ("agentGuid", AGENT),
        ("resultGroup", T.IntegerType()),
        ("locked", T.IntegerType()),
        ("driveLetter", T.StringType()),
        ("volumeName", T.StringType()),
        ("type", T.StringType()),
        ("totalMBytes", T.DoubleType()),
        ("freeMBytes", T.DoubleType()),
    ),
    "auditRsltDate": _struct(
        ("agentGuid", AGENT),
        ("resultGroup", T.IntegerType()),
        ("locked", T.IntegerType()),
        ("date", NTZ),
    ),
    "machNameTab": _struct(
        ("agentGuid", AGENT), ("machName", T.StringType()), ("groupName", T.StringType())
    ),
    "auditRsltManualFields": _struct(("id", T.LongType()), ("fieldName", T.StringType())),
    "auditRsltManualFieldValues": _struct(
        ("agentGuid", AGENT), ("fieldNameFK", T.LongType()), ("fieldValue", T.StringType())
    ),
    "userIpInfo": _struct(
        ("agentGuid", AGENT), ("ipAddress", T.StringType()), ("osInfo", T.StringType())
    ),
    "lastReboot": _struct(("agentGuid", AGENT), ("rebootTime", NTZ)),
    "auditRsltSimm": _struct(("agentGuid", AGENT), ("memSize", T.StringType())),
    "auditRsltCpu": _struct(
        ("agentGuid", AGENT), ("cpuDesc", T.StringType()), ("cpuCount", T.IntegerType())
    ),
}

REQUESTS = _struct(
    ("req_id", T.IntegerType()),
    ("components", T.StringType()),
    ("from_parm", T.StringType()),
    ("to_parm", T.StringType()),
)


# --- reports ---------------------------------------------------------------


@dataclass(frozen=True)
class Report:
    """One report table.

    ``columns``   the stored columns, without the partition column ``SlotDate``
    ``keys``      columns that identify a row when deciding whether it is new
    ``slot_of``   the timestamp column ``SlotDate`` is taken from, or ``None``
                  when the table is partitioned by stored columns
    ``partition`` partition columns on disk
    ``keep``      true for the one table that a replacing create leaves alone
    """

    name: str
    columns: T.StructType
    keys: tuple[str, ...]
    slot_of: str | None
    partition: tuple[str, ...]
    keep: bool = False

    @property
    def business_columns(self) -> list[str]:
        return [c for c in self.columns.names if c not in ("RecID", "RecCreatedOn")]

    @property
    def stored(self) -> T.StructType:
        """Columns as written: the declared ones and, where used, ``SlotDate``."""
        if self.slot_of is None:
            return self.columns
        return T.StructType(
            [*self.columns.fields, T.StructField("SlotDate", T.DateType(), False)]
        )


def _component_columns() -> T.StructType:
    return _struct(
        ("RecID", T.StringType(), False),
        ("AgentGUID", AGENT, False),
        ("TheDate", NTZ, False),
        ("Hour", T.IntegerType(), False),
        ("Sum", T.DoubleType(), False),
        ("DataPoints", T.IntegerType(), False),
        ("RecCreatedOn", NTZ, False),
    )


_COMPONENT_KEYS = ("AgentGUID", "TheDate", "Hour", "Sum", "DataPoints")

SERVERS = Report(
    "Servers",
    _struct(
        ("RecID", T.StringType(), False),
        ("AgentGUID", AGENT, False),
        ("Server", T.StringType(), False),
        ("Company", T.StringType(), False),
        ("TheDate", NTZ, False),
        ("MachineType", T.StringType()),
        ("IPAddress", T.StringType(), False),
        ("LastReboot", NTZ),
        ("MemoryInstalledMB", T.LongType()),
        ("Processor", T.StringType(), False),
        ("Cores", T.IntegerType()),
        ("WindowsVersion", T.StringType(), False),
        ("RecCreatedOn", NTZ, False),
    ),
    (
        "AgentGUID",
        "Server",
        "Company",
        "TheDate",
        "MachineType",
        "IPAddress",
        "LastReboot",
        "MemoryInstalledMB",
        "Processor",
        "Cores",
        "WindowsVersion",
    ),
    "TheDate",
    ("SlotDate",),
)
CPU = Report("CPU", _component_columns(), _COMPONENT_KEYS, "TheDate", ("SlotDate",))
MEMORY = Report("Memory", _component_columns(), _COMPONENT_KEYS, "TheDate", ("SlotDate",))
NTEVENT = Report(
    "NTEvent",
    _struct(
        ("RecID", T.StringType(), False),
        ("AgentGUID", AGENT, False),
        ("EventTime", NTZ, False),
        ("Message", T.StringType(), False),
        ("RecCreatedOn", NTZ, False),
    ),
    ("AgentGUID", "EventTime", "Message"),
    "EventTime",
    ("SlotDate",),
)
DISK = Report(
    "Disk",
    _struct(
        ("RecID", T.StringType(), False),
        ("AgentGUID", AGENT, False),
        ("YearNum", T.IntegerType(), False),
        ("WeekNum", T.IntegerType(), False),
        ("DiskLabel", T.StringType(), False),
        ("DriveName", T.StringType(), False),
        ("TotalSpaceGB", T.DoubleType()),
        ("FreeSpaceGB", T.DoubleType()),
        ("Stamp", NTZ, False),
        ("RecCreatedOn", NTZ, False),
    ),
    ("AgentGUID", "YearNum", "WeekNum", "DriveName", "DiskLabel"),
    None,
    ("YearNum", "WeekNum"),
    keep=True,
)

REPORTS: dict[str, Report] = {r.name: r for r in (SERVERS, CPU, MEMORY, NTEVENT, DISK)}

# Which report a component of the counter log goes to.
COMPONENT_REPORTS: dict[str, Report] = {"CPU": CPU, "MEM": MEMORY}

# What a run makes of a row.
INSERTED, SKIPPED, REJECTED = "inserted", "skipped", "rejected"

MESSAGE_WIDTH = 2000
SUM_TOLERANCE = 1e-6
