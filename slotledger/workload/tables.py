"""The driver's tables seen as the sources the jobs read.

``events`` becomes the two logs, ``lineitem`` the disks and memory modules,
``orders`` the audits, requests, network and reboot rows, ``customer`` the
machines and their manual fields, ``conversations`` the contact activities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

AS_OF = "2024-01-31"

_schemas: dict[str, T.StructType] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; its schema is looked up once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


# --- logs ------------------------------------------------------------------

_DAY = "CAST(ts AS DATE)"
_TO_HOUR = f"CAST({_DAY} AS TIMESTAMP_NTZ) + make_dt_interval(0, hour(ts))"
_TO_MINUTE = f"CAST({_DAY} AS TIMESTAMP_NTZ) + make_dt_interval(0, hour(ts), minute(ts))"
# a shard ends with midnight of the next day
_LOG_DATE = f"IF(hour(ts) = 0 AND minute(ts) = 0, date_sub({_DAY}, 1), {_DAY})"


def counter_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").selectExpr(
        "user_id AS agentGuid",
        "event_id % 25 AS monitorCounterId",
        f"{_TO_MINUTE} AS eventDateTime",
        "value - 5.0D AS counterValue",
        f"{_LOG_DATE} AS log_date",
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").selectExpr(
        "user_id AS agentGuid",
        f"{_TO_HOUR} AS eventTime",
        "concat(' ', event_type, '  ') AS message",
        f"{_LOG_DATE} AS log_date",
    )


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "nation").selectExpr(
        "CAST(n_nationkey AS BIGINT) AS monitorCounterId",
        """CASE n_nationkey % 5
             WHEN 0 THEN concat('% ', n_name, ' Processor Time')
             WHEN 1 THEN concat('Process ', n_name, ' % time')
             WHEN 2 THEN concat('Memory ', n_name, ' Bytes In Use')
             WHEN 3 THEN concat('Processor ', n_name, ' Time')
             ELSE concat('% Process ', n_name, ' bytes in use') END AS name""",
    )


def part_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A counter table that grows: one counter per part."""
    return read(spark, sf_dir, "part").selectExpr(
        "p_partkey AS monitorCounterId",
        """CASE WHEN p_size < 10 THEN concat('% ', p_name, ' PROCESSOR time')
                WHEN p_size < 20 THEN concat('Process ', p_name, ' % Time')
                WHEN p_size < 30 THEN concat(p_name, ' Bytes in Use')
                WHEN p_size < 40 THEN concat('Process ', p_name, ' Time')
                ELSE concat('% Process ', p_name, ' bytes in use %') END AS name""",
    )


# --- requests --------------------------------------------------------------


def order_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per order, in every spelling the arguments may have."""
    return (
        read(spark, sf_dir, "orders")
        .selectExpr(
            "o_orderkey",
            "o_custkey",
            "CAST(CAST(o_orderdate AS DATE) AS STRING) AS day",
            "CAST(date_add(CAST(o_orderdate AS DATE), 9) AS STRING) AS later",
            "CAST(date_sub(CAST(o_orderdate AS DATE), 17) AS STRING) AS earlier",
        )
        .selectExpr(
            "o_orderkey AS req_id",
            """CASE o_orderkey % 7 WHEN 1 THEN ' ' WHEN 2 THEN 'ALL' WHEN 3 THEN 'cpu'
                 WHEN 4 THEN 'Mem' WHEN 5 THEN 'CPUMEM' WHEN 6 THEN 'XYZ' END AS components""",
            r"""CASE o_orderkey % 9
                 WHEN 1 THEN day
                 WHEN 2 THEN translate(day, '-', '/')
                 WHEN 3 THEN translate(day, '-', '')
                 WHEN 4 THEN CAST(o_custkey % 20 AS STRING)
                 WHEN 5 THEN IF(o_orderkey % 2 = 0, '-3', concat(' ', translate(day, '-', ''), '  '))
                 WHEN 6 THEN concat_ws('/', substr(day, 6, 2), substr(day, 9, 2), substr(day, 1, 4))
                 WHEN 7 THEN IF(o_orderkey % 2 = 0, 'abc', '20130231')
                 WHEN 8 THEN translate(day, '-', '\\') END AS from_parm""",
            """CASE o_orderkey % 4
                 WHEN 1 THEN later
                 WHEN 2 THEN concat(translate(earlier, '-', '/'), ' ')
                 WHEN 3 THEN 'n/a' END AS to_parm""",
        )
    )


def log_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for days of the logs: ranges, single days, days back, defaults."""
    return read(spark, sf_dir, "nation").selectExpr(
        "n_nationkey AS req_id",
        "CASE n_nationkey % 3 WHEN 0 THEN 'ALL' WHEN 1 THEN 'cpu' ELSE 'MEM' END AS components",
        r"""CASE n_nationkey WHEN 0 THEN '2024-01-20' WHEN 1 THEN '2024\\01\\22'
             WHEN 2 THEN '20240101' WHEN 3 THEN '5' WHEN 4 THEN '99999' END AS from_parm""",
        """CASE n_nationkey WHEN 0 THEN '2024-01-12' WHEN 1 THEN '2024/01/24'
             WHEN 2 THEN '2024-01-04' WHEN 3 THEN '2024-01-01' END AS to_parm""",
    )


def audit_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for weeks of the audits: 25 ranges of a month each."""
    start = "date_add(DATE'1996-01-01', n_nationkey * 70)"
    return read(spark, sf_dir, "nation").selectExpr(
        "n_nationkey AS req_id",
        f"CAST({start} AS STRING) AS from_parm",
        f"translate(CAST(date_add({start}, 30) AS STRING), '-', '/') AS to_parm",
    )


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window per order: most last some hours, few for days or weeks, some are reversed or have no end."""
    return read(spark, sf_dir, "orders").where("o_orderkey % 40 = 0").selectExpr(
        "o_orderkey AS window_id",
        """CAST(DATE'2024-01-01' AS TIMESTAMP_NTZ)
             + make_dt_interval(0, 0, CAST(o_orderkey % 43200 AS INT), o_orderkey % 7) AS window_start""",
        """CASE WHEN o_orderkey % 320 = 0 THEN NULL ELSE
           CAST(DATE'2024-01-01' AS TIMESTAMP_NTZ)
             + make_dt_interval(0, 0, CAST(o_orderkey % 43200 AS INT)
                 + CASE WHEN o_orderkey % 360 = 0 THEN -30 WHEN o_orderkey % 3000 = 0 THEN 64800
                        WHEN o_orderkey % 1000 = 0 THEN 2880 WHEN o_orderkey % 80 = 0 THEN 420 ELSE 90 END,
               o_orderkey % 11) END AS window_end""",
    )


# --- disks and audits ------------------------------------------------------


def disks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").selectExpr(
        "l_partkey AS agentGuid",
        "IF(l_linenumber <= 5, 1, 2) AS resultGroup",
        "IF(l_tax < 0.06D, 1, 0) AS locked",
        """CASE WHEN l_linestatus = 'O' THEN 'C' WHEN l_quantity > 25 THEN 'D' ELSE ' D' END
             AS driveLetter""",
        """CASE WHEN l_returnflag = 'A' THEN 'Archive' WHEN l_returnflag = 'R' THEN 'Root '
                WHEN l_quantity < 10 THEN 'Page File' WHEN l_quantity < 20 THEN 'SwapVol'
                WHEN l_quantity < 25 THEN 'pagefile' WHEN l_quantity >= 28 THEN 'Normal' END
             AS volumeName""",
        """CASE l_linenumber % 4 WHEN 0 THEN 'Removable' WHEN 3 THEN 'CDROM' ELSE 'Fixed' END
             AS type""",
        "IF(l_discount >= 0.09D, 0.0D, l_extendedprice) AS totalMBytes",
        "l_extendedprice * l_discount AS freeMBytes",
    )


def audits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS agentGuid",
        "IF(o_orderstatus = 'P', 2, 1) AS resultGroup",
        "IF(o_orderpriority = '5-LOW', 0, 1) AS locked",
        "o_orderdate AS date",
    )


# --- inventory -------------------------------------------------------------


def machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read(spark, sf_dir, "customer")
        .selectExpr("c_custkey", "c_name", "c_mktsegment", "explode(array('', '-old')) AS suffix")
        .selectExpr(
            "c_custkey AS agentGuid",
            "concat(' ', c_name, suffix) AS machName",
            "concat(c_mktsegment, ' ') AS groupName",
        )
    )


def field_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flag, server type and another field; some agents lack the first two."""
    return (
        read(spark, sf_dir, "customer")
        .selectExpr(
            "c_custkey AS agentGuid",
            """posexplode(array(
                 CASE c_nationkey % 4 WHEN 0 THEN 'YES' WHEN 1 THEN 'yes ' WHEN 2 THEN 'NO' END,
                 IF(c_nationkey % 5 <> 0, concat(' ', c_mktsegment), NULL),
                 'other')) AS (field, fieldValue)""",
        )
        .where("fieldValue IS NOT NULL")
        .selectExpr("agentGuid", "CAST(field AS BIGINT) AS fieldNameFK", "fieldValue")
    )


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "region").selectExpr(
        "CAST(r_regionkey AS BIGINT) AS id",
        """CASE r_regionkey WHEN 0 THEN 'ReportingEnabled' WHEN 1 THEN 'Server Type'
             ELSE r_name END AS fieldName""",
    )


def ip_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS agentGuid",
        """IF(o_custkey % 11 <> 0,
              concat(' 10.0.', o_orderkey % 256, '.', o_custkey % 256), NULL) AS ipAddress""",
        "concat('Windows ', o_orderstatus, ' ') AS osInfo",
    )


def reboots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS agentGuid", "IF(o_orderstatus = 'F', o_orderdate, NULL) AS rebootTime"
    )


def memory_modules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read(spark, sf_dir, "lineitem")
        .selectExpr("l_partkey", "l_linenumber", "CAST(l_quantity AS BIGINT) AS n")
        .selectExpr(
            "l_partkey AS agentGuid",
            """CASE l_linenumber
                 WHEN 1 THEN concat(n, 'MB')
                 WHEN 2 THEN concat(' ', n, 'gb ')
                 WHEN 3 THEN concat(n, ' TB')
                 WHEN 4 THEN concat(n * 1000, 'KB')
                 WHEN 5 THEN CAST(n AS STRING)
                 WHEN 6 THEN concat(n, '.5GB') END AS memSize""",
        )
    )


def processors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").selectExpr(
        "p_partkey AS agentGuid",
        "p_type AS cpuDesc",
        "explode(array(p_size + 1, p_size)) AS cpuCount",
    )


def inventory(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "machNameTab": machines(spark, sf_dir),
        "auditRsltManualFields": fields(spark, sf_dir),
        "auditRsltManualFieldValues": field_values(spark, sf_dir),
        "userIpInfo": ip_info(spark, sf_dir),
        "lastReboot": reboots(spark, sf_dir),
        "auditRsltSimm": memory_modules(spark, sf_dir),
        "auditRsltCpu": processors(spark, sf_dir),
    }


def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "conversations").selectExpr(
        "concat('owner ', conv_id % 10) AS owner",
        "conv_id AS contact",
        "concat('account ', conv_id % 7) AS account",
        "concat('source ', conv_id % 3) AS lead_source",
        "substr(text, 1, 40) AS subject",
        "role AS type",
        "turn AS created_on",
        "concat(role, '@', conv_id) AS created_by",
        "text AS description",
    )


# --- what an earlier run has stored ----------------------------------------


def stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First half of the month, without the errors that arrived late."""
    return (
        read(spark, sf_dir, "events")
        .where("ts < TIMESTAMP_NTZ'2024-01-16' AND event_type <> 'error'")
        .selectExpr(
            "user_id AS AgentGUID",
            f"{_TO_HOUR} AS EventTime",
            "concat(' ', event_type, '  ') AS Message",
        )
    )


def stored_hours(spark: SparkSession, sf_dir: str, pattern: str) -> DataFrame:
    """First half of the month rolled up by hour, as an earlier run might have.

    Readings on the hour are left out, so hours that have some differ now; the
    sums are off by less than the tolerance.
    """
    names = counters(spark, sf_dir).where(f"name ILIKE r'{pattern}'")
    log = counter_log(spark, sf_dir).where(
        "log_date < DATE'2024-01-16' AND counterValue > 0 AND minute(eventDateTime) > 0"
    )
    return (
        log.join(names, "monitorCounterId")
        .selectExpr(
            "agentGuid AS AgentGUID",
            "CAST(log_date AS TIMESTAMP_NTZ) + make_dt_interval(0, hour(eventDateTime)) AS TheDate",
            "hour(eventDateTime) AS Hour",
            "counterValue",
        )
        .groupBy("AgentGUID", "TheDate", "Hour")
        .agg({"counterValue": "sum", "*": "count"})
        .selectExpr(
            "AgentGUID",
            "TheDate",
            "Hour",
            "`sum(counterValue)` + 2e-7D AS Sum",
            "`count(1)` AS DataPoints",
        )
    )


def stored_components(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "CPU": stored_hours(spark, sf_dir, r"%\%%Process%"),
        "MEM": stored_hours(spark, sf_dir, "% bytes in use%"),
    }


def stored_disks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drives of every machine, stored for the weeks its parts were shipped in."""
    return read(spark, sf_dir, "lineitem").selectExpr(
        "l_partkey AS AgentGUID",
        "year(l_shipdate) AS YearNum",
        """CAST(floor((dayofyear(l_shipdate) - 1 + dayofweek(trunc(l_shipdate, 'YEAR')) - 1) / 7) + 1
             AS INT) AS WeekNum""",
        "IF(l_linestatus = 'O', 'C', 'D') AS DriveName",
        "IF(l_returnflag = 'A', 'Archive', 'Root') AS DiskLabel",
    )
