"""The same results in SQL, written apart from the Spark code.

Where the library takes a shorter way the SQL takes the long one: hours are
tested one by one with BETWEEN, latest stamps come from the full disk-audit
join, existence is a correlated NOT EXISTS.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_DAY = "DATE '2024-01-31'"

# --- the driver's tables as sources ----------------------------------------

_LOG_DATE = """
  CAST(ts AS DATE) - CASE WHEN extract(hour FROM ts) = 0 AND extract(minute FROM ts) = 0
                          THEN 1 ELSE 0 END"""

_CTES = {
    "counter_log": f"""
  SELECT user_id AS "agentGuid", event_id % 25 AS "monitorCounterId",
         date_trunc('minute', ts) AS "eventDateTime",
         value - CAST(5 AS DOUBLE) AS "counterValue", {_LOG_DATE} AS log_date
  FROM events""",
    "event_log": f"""
  SELECT user_id AS "agentGuid", date_trunc('hour', ts) AS "eventTime",
         ' ' || event_type || '  ' AS message, {_LOG_DATE} AS log_date
  FROM events""",
    "counters": """
  SELECT CAST(n_nationkey AS BIGINT) AS "monitorCounterId",
         CASE n_nationkey % 5
           WHEN 0 THEN '% ' || n_name || ' Processor Time'
           WHEN 1 THEN 'Process ' || n_name || ' % time'
           WHEN 2 THEN 'Memory ' || n_name || ' Bytes In Use'
           WHEN 3 THEN 'Processor ' || n_name || ' Time'
           ELSE '% Process ' || n_name || ' bytes in use' END AS name
  FROM nation""",
    "part_counters": """
  SELECT p_partkey AS "monitorCounterId",
         CASE WHEN p_size < 10 THEN '% ' || p_name || ' PROCESSOR time'
              WHEN p_size < 20 THEN 'Process ' || p_name || ' % Time'
              WHEN p_size < 30 THEN p_name || ' Bytes in Use'
              WHEN p_size < 40 THEN 'Process ' || p_name || ' Time'
              ELSE '% Process ' || p_name || ' bytes in use %' END AS name
  FROM part""",
    "order_requests": r"""
  SELECT o_orderkey AS req_id,
         CASE o_orderkey % 7 WHEN 1 THEN ' ' WHEN 2 THEN 'ALL' WHEN 3 THEN 'cpu'
              WHEN 4 THEN 'Mem' WHEN 5 THEN 'CPUMEM' WHEN 6 THEN 'XYZ' END AS components,
         CASE o_orderkey % 9
           WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
           WHEN 2 THEN strftime(o_orderdate, '%Y/%m/%d')
           WHEN 3 THEN strftime(o_orderdate, '%Y%m%d')
           WHEN 4 THEN CAST(o_custkey % 20 AS VARCHAR)
           WHEN 5 THEN CASE WHEN o_orderkey % 2 = 0 THEN '-3'
                            ELSE ' ' || strftime(o_orderdate, '%Y%m%d') || '  ' END
           WHEN 6 THEN strftime(o_orderdate, '%m/%d/%Y')
           WHEN 7 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'abc' ELSE '20130231' END
           WHEN 8 THEN strftime(o_orderdate, '%Y\%m\%d') END AS from_parm,
         CASE o_orderkey % 4
           WHEN 1 THEN strftime(o_orderdate + INTERVAL 9 DAY, '%Y-%m-%d')
           WHEN 2 THEN strftime(o_orderdate - INTERVAL 17 DAY, '%Y/%m/%d') || ' '
           WHEN 3 THEN 'n/a' END AS to_parm
  FROM orders""",
    "log_requests": r"""
  SELECT n_nationkey AS req_id,
         CASE n_nationkey % 3 WHEN 0 THEN 'ALL' WHEN 1 THEN 'cpu' ELSE 'MEM' END AS components,
         CASE n_nationkey WHEN 0 THEN '2024-01-20' WHEN 1 THEN '2024\01\22'
              WHEN 2 THEN '20240101' WHEN 3 THEN '5' WHEN 4 THEN '99999' END AS from_parm,
         CASE n_nationkey WHEN 0 THEN '2024-01-12' WHEN 1 THEN '2024/01/24'
              WHEN 2 THEN '2024-01-04' WHEN 3 THEN '2024-01-01' END AS to_parm
  FROM nation""",
    "audit_requests": """
  SELECT n_nationkey AS req_id,
         strftime(DATE '1996-01-01' + n_nationkey * 70, '%Y-%m-%d') AS from_parm,
         strftime(DATE '1996-01-01' + n_nationkey * 70 + 30, '%Y/%m/%d') AS to_parm
  FROM nation""",
    "disks": """
  SELECT l_partkey AS "agentGuid",
         CASE WHEN l_linenumber <= 5 THEN 1 ELSE 2 END AS "resultGroup",
         CASE WHEN l_tax < 0.06 THEN 1 ELSE 0 END AS locked,
         CASE WHEN l_linestatus = 'O' THEN 'C' WHEN l_quantity > 25 THEN 'D' ELSE ' D' END
           AS "driveLetter",
         CASE WHEN l_returnflag = 'A' THEN 'Archive' WHEN l_returnflag = 'R' THEN 'Root '
              WHEN l_quantity < 10 THEN 'Page File' WHEN l_quantity < 20 THEN 'SwapVol'
              WHEN l_quantity < 25 THEN 'pagefile' WHEN l_quantity >= 28 THEN 'Normal' END
           AS "volumeName",
         CASE l_linenumber % 4 WHEN 0 THEN 'Removable' WHEN 3 THEN 'CDROM' ELSE 'Fixed' END
           AS type,
         CASE WHEN l_discount >= 0.09 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice END
           AS "totalMBytes",
         l_extendedprice * l_discount AS "freeMBytes"
  FROM lineitem""",
    "audits": """
  SELECT o_custkey AS "agentGuid",
         CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS "resultGroup",
         CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 1 END AS locked,
         o_orderdate AS date
  FROM orders""",
    "machines": """
  SELECT c_custkey AS "agentGuid",
         ' ' || c_name || CASE WHEN copy = 1 THEN '-old' ELSE '' END AS "machName",
         c_mktsegment || ' ' AS "groupName"
  FROM customer, (VALUES (0), (1)) AS v(copy)""",
    "field_values": """
  SELECT c_custkey AS "agentGuid", CAST(0 AS BIGINT) AS "fieldNameFK",
         CASE c_nationkey % 4 WHEN 0 THEN 'YES' WHEN 1 THEN 'yes ' ELSE 'NO' END AS "fieldValue"
  FROM customer WHERE c_nationkey % 4 <> 3
  UNION ALL
  SELECT c_custkey, 1, ' ' || c_mktsegment FROM customer WHERE c_nationkey % 5 <> 0
  UNION ALL
  SELECT c_custkey, 2, 'other' FROM customer""",
    "fields": """
  SELECT CAST(r_regionkey AS BIGINT) AS id,
         CASE r_regionkey WHEN 0 THEN 'ReportingEnabled' WHEN 1 THEN 'Server Type'
              ELSE r_name END AS "fieldName"
  FROM region""",
    "ip_info": """
  SELECT o_custkey AS "agentGuid",
         CASE WHEN o_custkey % 11 <> 0
              THEN ' 10.0.' || (o_orderkey % 256) || '.' || (o_custkey % 256) END AS "ipAddress",
         'Windows ' || o_orderstatus || ' ' AS "osInfo"
  FROM orders""",
    "reboots": """
  SELECT o_custkey AS "agentGuid",
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS "rebootTime"
  FROM orders""",
    "simm": """
  SELECT l_partkey AS "agentGuid",
         CASE l_linenumber
           WHEN 1 THEN CAST(l_quantity AS BIGINT) || 'MB'
           WHEN 2 THEN ' ' || CAST(l_quantity AS BIGINT) || 'gb '
           WHEN 3 THEN CAST(l_quantity AS BIGINT) || ' TB'
           WHEN 4 THEN CAST(l_quantity AS BIGINT) * 1000 || 'KB'
           WHEN 5 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
           WHEN 6 THEN CAST(l_quantity AS BIGINT) || '.5GB' END AS "memSize"
  FROM lineitem""",
    "cpu": """
  SELECT p_partkey AS "agentGuid", p_type AS "cpuDesc", p_size + more AS "cpuCount"
  FROM part, (VALUES (0), (1)) AS v(more)""",
    "activities": """
  SELECT 'owner ' || (conv_id % 10) AS owner, conv_id AS contact,
         'account ' || (conv_id % 7) AS account, 'source ' || (conv_id % 3) AS lead_source,
         substring(text, 1, 40) AS subject, role AS type, turn AS created_on,
         role || '@' || conv_id AS created_by, text AS description
  FROM conversations""",
    "stored_events": """
  SELECT user_id AS "AgentGUID", date_trunc('hour', ts) AS "EventTime",
         ' ' || event_type || '  ' AS "Message"
  FROM events
  WHERE date_trunc('hour', ts) < TIMESTAMP '2024-01-16' AND event_type <> 'error'""",
    "stored_disks": """
  SELECT l_partkey AS "AgentGUID", year(l_shipdate) AS "YearNum",
         (dayofyear(l_shipdate) - 1 + dayofweek(date_trunc('year', l_shipdate))) // 7 + 1
           AS "WeekNum",
         CASE WHEN l_linestatus = 'O' THEN 'C' ELSE 'D' END AS "DriveName",
         CASE WHEN l_returnflag = 'A' THEN 'Archive' ELSE 'Root' END AS "DiskLabel"
  FROM lineitem""",
    "event_batch": """
  SELECT "agentGuid" AS "AgentGUID", "eventTime" AS "EventTime", message AS "Message"
  FROM event_log""",
    # a request's arguments, read the way the header describes them
    "stripped": r"""
  SELECT *, replace(replace(replace(from_parm, '\', ''), '/', ''), '-', '') AS f,
         replace(replace(replace(to_parm, '\', ''), '/', ''), '-', '') AS t
  FROM requests""",
    "dated": """
  SELECT *,
         CASE WHEN regexp_full_match(trim(f, ' '), '[0-9]{8}')
              THEN CAST(try_strptime(trim(f, ' '), '%Y%m%d') AS DATE) END AS fd,
         CASE WHEN regexp_full_match(trim(t, ' '), '[0-9]{8}')
              THEN CAST(try_strptime(trim(t, ' '), '%Y%m%d') AS DATE) END AS td
  FROM stripped""",
    "disk_rows": """
  SELECT "agentGuid" AS "AgentGUID", "resultGroup" AS "ResultGroup", locked AS "Locked",
         trim("driveLetter", ' ') AS "DriveName", trim("volumeName", ' ') AS "DiskLabel",
         "totalMBytes" / 1024 AS "TotalSpaceGB", "freeMBytes" / 1024 AS "FreeSpaceGB"
  FROM disks""",
    "current_disks": """
  SELECT * FROM disks
  WHERE "totalMBytes" > 0 AND type NOT ILIKE '%CDROM%'
    AND "volumeName" NOT ILIKE '%pagefile%' AND "volumeName" NOT ILIKE '%page file%'
    AND "volumeName" NOT ILIKE '%Swap%'""",
    "last_audit": """
  SELECT "agentGuid", "resultGroup", locked, date FROM (
    SELECT *, row_number() OVER (PARTITION BY "agentGuid"
                                 ORDER BY date DESC, "resultGroup", locked) AS rk
    FROM audits)
  WHERE rk = 1""",
    "weekly_disks": """
  SELECT * FROM disks
  WHERE (type = 'Fixed' OR (type = 'Removable' AND "totalMBytes" > 0))
    AND "volumeName" NOT ILIKE '%page file%'""",
    "weeks": """
  SELECT DISTINCT week_begin, week_limit, "YearNum", "WeekNum" FROM week_slots""",
    "latest_stamps": """
  SELECT d."agentGuid", d."volumeName", d."driveLetter", w."YearNum", w."WeekNum",
         max(a.date) AS "Stamp"
  FROM weekly_disks d
  JOIN audits a ON a."agentGuid" = d."agentGuid"
  JOIN weeks w ON a.date >= w.week_begin AND a.date < w.week_limit
  WHERE d."resultGroup" = 1 AND a."resultGroup" = 1
  GROUP BY ALL""",
    "sizes": """
  SELECT *, upper(trim("memSize", ' ')) AS s FROM simm""",
    "sized": """
  SELECT "agentGuid", "memSize",
         CASE WHEN s LIKE '%MB%' THEN try_cast(trim(replace(s, 'MB', ''), ' ') AS BIGINT)
              WHEN s LIKE '%GB%' AND s NOT LIKE '%.%'
                THEN try_cast(trim(replace(s, 'GB', ''), ' ') AS BIGINT) * 1024
              WHEN s LIKE '%GB%' THEN NULL
              WHEN s LIKE '%TB%' THEN try_cast(trim(replace(s, 'TB', ''), ' ') AS BIGINT) * 1048576
              WHEN s LIKE '%KB%' THEN try_cast(trim(replace(s, 'KB', ''), ' ') AS BIGINT) // 1024
              ELSE try_cast(s AS BIGINT) END AS mb
  FROM sizes""",
    "flags": """
  SELECT v."agentGuid",
         max(CASE WHEN f."fieldName" = 'ReportingEnabled' THEN v."fieldValue" END)
           AS "reportingEnabled",
         max(CASE WHEN f."fieldName" = 'Server Type' THEN v."fieldValue" END) AS "serverType"
  FROM field_values v JOIN fields f ON v."fieldNameFK" = f.id
  WHERE f."fieldName" IN ('ReportingEnabled', 'Server Type')
  GROUP BY v."agentGuid" """,
    "snapshot": """
  SELECT a."agentGuid" AS "AgentGUID",
    (SELECT trim("machName", ' ') FROM machines m WHERE m."agentGuid" = a."agentGuid"
     ORDER BY "machName" NULLS FIRST, "groupName" NULLS FIRST LIMIT 1) AS "Server",
    coalesce((SELECT trim("groupName", ' ') FROM machines m WHERE m."agentGuid" = a."agentGuid"
     ORDER BY "machName" NULLS FIRST, "groupName" NULLS FIRST LIMIT 1), '') AS "Company",
    TIMESTAMP '2024-01-01' AS "TheDate",
    coalesce((SELECT trim("serverType", ' ') FROM flags f
              WHERE f."agentGuid" = a."agentGuid"), '') AS "MachineType",
    (SELECT trim("ipAddress", ' ') FROM ip_info i WHERE i."agentGuid" = a."agentGuid"
     ORDER BY "ipAddress" NULLS FIRST, "osInfo" NULLS FIRST LIMIT 1) AS "IPAddress",
    (SELECT max("rebootTime") FROM reboots r WHERE r."agentGuid" = a."agentGuid") AS "LastReboot",
    CAST(coalesce((SELECT sum(mb) FROM sized s WHERE s."agentGuid" = a."agentGuid"), 0) AS BIGINT)
      AS "MemoryInstalledMB",
    coalesce((SELECT "cpuDesc" FROM cpu c WHERE c."agentGuid" = a."agentGuid"
     ORDER BY "cpuDesc" NULLS FIRST, "cpuCount" NULLS FIRST LIMIT 1), '') AS "Processor",
    coalesce((SELECT "cpuCount" FROM cpu c WHERE c."agentGuid" = a."agentGuid"
     ORDER BY "cpuDesc" NULLS FIRST, "cpuCount" NULLS FIRST LIMIT 1), 0) AS "Cores",
    coalesce((SELECT trim("osInfo", ' ') FROM ip_info i WHERE i."agentGuid" = a."agentGuid"
     ORDER BY "ipAddress" NULLS FIRST, "osInfo" NULLS FIRST LIMIT 1), '') AS "WindowsVersion"
  FROM (SELECT DISTINCT "agentGuid" FROM machines) a
  WHERE EXISTS (SELECT * FROM flags f WHERE f."agentGuid" = a."agentGuid"
                AND upper(rtrim("reportingEnabled", ' ')) = 'YES')""",
    "stored_servers": """
  SELECT * REPLACE (CASE WHEN "MachineType" = 'MACHINERY' THEN "LastReboot" END AS "LastReboot")
  FROM snapshot
  WHERE "MachineType" IN ('MACHINERY', 'FURNITURE') AND "IPAddress" IS NOT NULL""",
    "outcomes": """
  SELECT s.*,
    CASE WHEN "Server" IS NULL OR "IPAddress" IS NULL THEN 'rejected'
         WHEN EXISTS (
           SELECT * FROM stored_servers o
           WHERE o."AgentGUID" = s."AgentGUID" AND o."Server" = s."Server"
             AND o."Company" = s."Company" AND o."TheDate" = s."TheDate"
             AND o."MachineType" = s."MachineType" AND o."IPAddress" = s."IPAddress"
             AND (o."LastReboot" IS NULL OR o."LastReboot" = s."LastReboot")
             AND o."MemoryInstalledMB" = s."MemoryInstalledMB" AND o."Processor" = s."Processor"
             AND o."Cores" = s."Cores" AND o."WindowsVersion" = s."WindowsVersion")
         THEN 'skipped' ELSE 'inserted' END AS outcome
  FROM snapshot s""",
}


def _requests(source: str) -> str:
    return f"SELECT * FROM {source}"


def _resolved(unit_days: int, default_back: int) -> str:
    return f"""
  SELECT *, least(s, e) AS from_date, greatest(s, e) AS to_date FROM (
    SELECT *, CASE WHEN fd IS NOT NULL THEN coalesce(td, s) ELSE s END AS e FROM (
      SELECT *,
        CASE WHEN fd IS NOT NULL THEN fd
             WHEN regexp_full_match(f, '[0-9]+') AND CAST(f AS BIGINT) > 10000
               THEN {_DAY} - {unit_days}
             WHEN regexp_full_match(f, '[0-9]+')
               THEN {_DAY} - CAST(CAST(f AS BIGINT) * {unit_days} AS INTEGER)
             ELSE {_DAY} - {default_back} END AS s
      FROM dated))"""


_DAY_SLOTS = """
  SELECT *, CAST(unnest(generate_series(CAST(from_date AS TIMESTAMP), CAST(to_date AS TIMESTAMP),
                                        INTERVAL 1 DAY)) AS DATE) AS log_date
  FROM resolved"""


def _week_slots(first: str) -> str:
    return f"""
  SELECT *, week_begin + 6 AS week_end, week_begin + 7 AS week_limit,
         CAST(year(week_begin + 6) AS INTEGER) AS "YearNum",
         CAST((dayofyear(week_begin + 6) - 1
               + dayofweek(date_trunc('year', week_begin + 6))) // 7 + 1 AS INTEGER) AS "WeekNum"
  FROM (SELECT *, slot_date - CAST(dayofweek(slot_date) AS INTEGER) AS week_begin
        FROM (SELECT *, CAST(unnest(generate_series(
                CAST({first} AS TIMESTAMP), CAST(to_date AS TIMESTAMP),
                INTERVAL 7 DAY)) AS DATE) AS slot_date FROM resolved))"""


def _sql(body: str, *ctes: str, **own: str) -> str:
    """``body`` over the named CTEs, in order; keyword arguments define or replace one."""
    parts = [f"{name} AS ({own.get(name) or _CTES[name]})" for name in ctes]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def _requested(body: str, source: str, *ctes: str, unit: str = "day", first: str = "from_date"):
    """``body`` over resolved requests and their day or week slots."""
    own = {
        "requests": _requests(source),
        "resolved": _resolved(1, 1) if unit == "day" else _resolved(7, 8),
        "day_slots": _DAY_SLOTS,
        "week_slots": _week_slots(first),
    }
    slots = "day_slots" if unit == "day" else "week_slots"
    return _sql(
        body, source, "requests", "stripped", "dated", "resolved", slots, *ctes, **own
    )


# --- calendar and scalar functions -----------------------------------------

ORACLES["start_end_of_week"] = """
SELECT o_orderkey, CAST(ws AS INTEGER) AS week_start,
       CASE WHEN ws BETWEEN 1 AND 7 THEN d - CAST((dayofweek(d) + 8 - ws) % 7 AS INTEGER) END
         AS week_begin,
       CASE WHEN ws BETWEEN 1 AND 7 THEN d - CAST((dayofweek(d) + 8 - ws) % 7 AS INTEGER) + 6 END
         AS week_end
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, ws FROM orders, range(0, 9) AS r(ws))
"""
ORACLES["week_number"] = """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS "YearNum",
       CAST((dayofyear(o_orderdate) - 1 + dayofweek(date_trunc('year', o_orderdate))) // 7 + 1
            AS INTEGER) AS "WeekNum"
FROM orders
"""
ORACLES["calendar_keys"] = f"""
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
       strftime(o_orderdate, '%Y%m%d') AS date_key,
       CAST(o_orderdate AS DATE) + 7 AS next_week,
       CAST({_DAY} - CAST(o_orderdate AS DATE) AS INTEGER) AS days_back
FROM orders
"""
ORACLES["argument_tests"] = _sql(
    """
SELECT req_id, f AS stripped, fd IS NOT NULL AS is_date,
       coalesce(regexp_full_match(trim(f, ' '), '[0-9]+'), FALSE) AS is_int
FROM dated""",
    "order_requests",
    "requests",
    "stripped",
    "dated",
    requests=_requests("order_requests"),
)
ORACLES["text_functions"] = r"""
SELECT doc_id, md5(trim(text, ' ')) AS trimmed, md5(replace(text, 'the', '')) AS replaced,
       left(text, 30) AS head, text ILIKE '%the%' AS has_the,
       text ILIKE '%an%ing%' AS like_ing, contains(text, '%') AS has_percent
FROM documents
"""
ORACLES["number_functions"] = """
SELECT l_orderkey, l_linenumber, l_extendedprice / 1024 AS gb,
       abs(l_discount - l_tax) AS gap,
       abs(l_discount - l_tax) < CAST(0.0100001 AS DOUBLE) AS close,
       CASE WHEN l_discount > 0.02 THEN l_discount ELSE CAST(0 AS DOUBLE) END AS discount_or_zero
FROM lineitem
"""

# --- slots -----------------------------------------------------------------

_RANGES = "SELECT req_id, from_date, to_date FROM resolved"
ORACLES["resolve_requests"] = _requested(_RANGES, "order_requests")
ORACLES["resolve_requests_weeks"] = _requested(_RANGES, "order_requests", unit="week")
ORACLES["day_slots"] = _requested("SELECT req_id, log_date FROM day_slots", "order_requests")
_WEEK_ROWS = """
SELECT req_id, slot_date, week_begin, week_end, week_limit, "YearNum", "WeekNum"
FROM week_slots"""
ORACLES["week_slots"] = _requested(_WEEK_ROWS, "order_requests", unit="week")
ORACLES["week_slots_covering"] = _requested(
    _WEEK_ROWS,
    "order_requests",
    unit="week",
    first="from_date - CAST(dayofweek(from_date) AS INTEGER)",
)
ORACLES["resolve_components"] = _sql(
    """
SELECT req_id, component
FROM (SELECT req_id, coalesce(components, '') AS c FROM order_requests),
     (VALUES ('CPU'), ('MEM')) AS v(component)
WHERE c ILIKE '%ALL%' OR c ILIKE '%' || component || '%'
   OR (c NOT ILIKE '%CPU%' AND c NOT ILIKE '%MEM%')""",
    "order_requests",
)
for _log in ("counter_log", "event_log"):
    ORACLES[f"scan_{_log}"] = _requested(
        f"SELECT * FROM {_log} WHERE log_date IN (SELECT log_date FROM day_slots)",
        "log_requests",
        _log,
    )
ORACLES["stored_on_days"] = _requested(
    """
SELECT * FROM stored_events
WHERE CAST("EventTime" AS DATE) IN (SELECT log_date FROM day_slots)""",
    "log_requests",
    "stored_events",
)
ORACLES["events_in_day"] = _sql(
    """
SELECT * FROM event_log
WHERE "eventTime" >= CAST(log_date AS TIMESTAMP)
  AND "eventTime" < CAST(log_date AS TIMESTAMP) + INTERVAL 1 DAY""",
    "event_log",
)
ORACLES["join_day_slots"] = _requested(
    """
SELECT "agentGuid", "eventTime", message, n_requests
FROM event_log e JOIN (SELECT log_date, count(*) AS n_requests FROM day_slots GROUP BY log_date) d
  ON "eventTime" >= CAST(d.log_date AS TIMESTAMP)
 AND "eventTime" < CAST(d.log_date AS TIMESTAMP) + INTERVAL 1 DAY""",
    "log_requests",
    "event_log",
)
ORACLES["join_week_slots"] = _requested(
    """
SELECT a.*, week_begin, "YearNum", "WeekNum"
FROM audits a JOIN weeks w ON a.date >= w.week_begin AND a.date < w.week_limit""",
    "audit_requests",
    "weeks",
    "audits",
    unit="week",
)

# --- filters and projections -----------------------------------------------

_IS_CPU = r"(name ILIKE '%\%%Process%' ESCAPE '\' OR name ILIKE '%Process%\%%Time' ESCAPE '\')"
_IS_MEM = "name ILIKE '% bytes in use%'"
ORACLES["counter_filter_cpu"] = _sql(
    f"SELECT * FROM part_counters WHERE {_IS_CPU}", "part_counters"
)
ORACLES["counter_filter_mem"] = _sql(
    f"SELECT * FROM part_counters WHERE {_IS_MEM}", "part_counters"
)
ORACLES["disk_filter_v1"] = _sql(
    'SELECT * FROM weekly_disks WHERE "resultGroup" = 1', "disks", "weekly_disks"
)
ORACLES["disk_filter_v3"] = _sql("SELECT * FROM current_disks", "disks", "current_disks")
ORACLES["where_group"] = _sql(
    'SELECT * FROM audits WHERE "resultGroup" = 1 AND locked = 1', "audits"
)
ORACLES["disk_projection"] = _sql("SELECT * FROM disk_rows", "disks", "disk_rows")
ORACLES["null_defaults"] = _sql(
    """
SELECT "agentGuid", CASE WHEN "ipAddress" IS NULL THEN '' ELSE "ipAddress" END AS "ipAddress",
       "osInfo" FROM ip_info""",
    "ip_info",
)
ORACLES["null_or_equal"] = _sql(
    """
SELECT "agentGuid",
       count(*) FILTER (WHERE "rebootTime" IS NULL OR "rebootTime" = TIMESTAMP '1998-01-01')
         AS n_rows
FROM reboots GROUP BY 1""",
    "reboots",
)
ORACLES["message_limit"] = """
SELECT doc_id, substring(text, 1, 2000) AS "Message" FROM documents
"""
ORACLES["message_trim"] = _sql(
    """SELECT "agentGuid", "eventTime", trim(message, ' ') AS message, log_date FROM event_log""",
    "event_log",
)

# --- counter rollups -------------------------------------------------------

_READINGS = f"""
  SELECT 'CPU' AS component, l.* FROM counter_log l JOIN counters c USING ("monitorCounterId")
  WHERE "counterValue" >= 0 AND {_IS_CPU}
  UNION ALL
  SELECT 'MEM', l.* FROM counter_log l JOIN counters c USING ("monitorCounterId")
  WHERE "counterValue" > 0 AND {_IS_MEM}"""


def _hourly(upper: str) -> str:
    """One pass per hour of the day, as a join against the 24 hours."""
    return f"""
  SELECT component, "agentGuid" AS "AgentGUID", log_date,
         CAST(log_date AS TIMESTAMP) + to_hours(CAST(h AS INTEGER)) AS "TheDate",
         CAST(h AS INTEGER) AS "Hour", sum("counterValue") AS "Sum", count(*) AS "DataPoints"
  FROM readings JOIN range(0, 24) AS r(h)
    ON "eventDateTime" >= CAST(log_date AS TIMESTAMP) + to_hours(CAST(h AS INTEGER))
   AND "eventDateTime" {upper} CAST(log_date AS TIMESTAMP) + to_hours(CAST(h + 1 AS INTEGER))
  GROUP BY ALL"""


_LOG = ("counter_log", "counters", "readings")
ORACLES["component_readings"] = _sql(
    """
SELECT component, "agentGuid", "monitorCounterId", "eventDateTime",
       round("counterValue", 4) AS "counterValue" FROM readings""",
    *_LOG,
    readings=_READINGS,
)
for _name, _component, _upper in (
    ("hourly_rollup_closed", "CPU", "<="),
    ("hourly_rollup_left", "CPU", "<"),
    ("hourly_rollup_mem", "MEM", "<="),
):
    ORACLES[_name] = _sql(
        f"""
SELECT "AgentGUID", "TheDate", "Hour", round("Sum", 4) AS "Sum", "DataPoints"
FROM hourly WHERE component = '{_component}'""",
        *_LOG,
        "hourly",
        readings=_READINGS,
        hourly=_hourly(_upper),
    )
ORACLES["component_rollup"] = _sql(
    """
SELECT component, "AgentGUID", "TheDate", "Hour", round("Sum", 4) AS "Sum", "DataPoints"
FROM hourly""",
    *_LOG,
    "hourly",
    readings=_READINGS,
    hourly=_hourly("<="),
)
_DAILY = """
SELECT component, "agentGuid" AS "AgentGUID", CAST(log_date AS TIMESTAMP) AS "TheDate",
       CAST(1 AS INTEGER) AS "Hour", round(sum("counterValue"), 4) AS "Sum",
       count(*) AS "DataPoints"
FROM readings {where} GROUP BY component, "agentGuid", log_date"""
ORACLES["daily_rollup"] = _sql(_DAILY.format(where=""), *_LOG, readings=_READINGS)

# --- merging into a report -------------------------------------------------

_NOT_STORED = """NOT EXISTS (
  SELECT * FROM stored_events s WHERE s."AgentGUID" = b."AgentGUID"
    AND s."EventTime" = b."EventTime" AND s."Message" = b."Message")"""
ORACLES["insert_new_exact"] = _sql(
    f"SELECT * FROM event_batch b WHERE {_NOT_STORED}",
    "event_log",
    "event_batch",
    "stored_events",
)


def _stored_hours(component: str, test: str) -> str:
    return f"""
  SELECT '{component}' AS component, "agentGuid" AS "AgentGUID",
         CAST(log_date AS TIMESTAMP)
           + to_hours(CAST(extract(hour FROM "eventDateTime") AS INTEGER)) AS "TheDate",
         CAST(extract(hour FROM "eventDateTime") AS INTEGER) AS "Hour",
         sum("counterValue") + CAST(2e-7 AS DOUBLE) AS "Sum", count(*) AS "DataPoints"
  FROM counter_log JOIN counters USING ("monitorCounterId")
  WHERE log_date < DATE '2024-01-16' AND "counterValue" > 0
    AND extract(minute FROM "eventDateTime") > 0 AND {test}
  GROUP BY ALL"""


_STORED_HOURS = (
    _stored_hours("CPU", r"name ILIKE '%\%%Process%' ESCAPE '\'")
    + " UNION ALL "
    + _stored_hours("MEM", _IS_MEM)
)
_HOUR_NOT_STORED = """NOT EXISTS (
  SELECT * FROM stored_hours s WHERE s.component = b.component
    AND s."AgentGUID" = b."AgentGUID" AND s."TheDate" = b."TheDate" AND s."Hour" = b."Hour"
    AND abs(s."Sum" - b."Sum") < CAST(1e-6 AS DOUBLE) AND s."DataPoints" = b."DataPoints")"""
ORACLES["insert_new_approx"] = _sql(
    f"""
SELECT "AgentGUID", "TheDate", "Hour", round("Sum", 4) AS "Sum", "DataPoints"
FROM hourly b WHERE component = 'CPU' AND {_HOUR_NOT_STORED}""",
    *_LOG,
    "hourly",
    "stored_hours",
    readings=_READINGS,
    hourly=_hourly("<="),
    stored_hours=_STORED_HOURS,
)
_DAY_EMPTY = """NOT EXISTS (
  SELECT * FROM stored_events s WHERE s."EventTime" >= CAST({day} AS TIMESTAMP)
    AND s."EventTime" < CAST({day} AS TIMESTAMP) + INTERVAL 1 DAY)"""
ORACLES["load_if_slot_empty"] = _sql(
    """
SELECT *, CAST("EventTime" AS DATE) AS day FROM event_batch
WHERE CAST("EventTime" AS DATE) NOT IN (SELECT CAST("EventTime" AS DATE) FROM stored_events)""",
    "event_log",
    "event_batch",
    "stored_events",
)
ORACLES["mark_slots"] = _requested(
    f"""
SELECT log_date, NOT {_DAY_EMPTY.format(day="d.log_date")} AS occupied
FROM (SELECT DISTINCT log_date FROM day_slots) d""",
    "log_requests",
    "stored_events",
)
ORACLES["distinct_events"] = _sql(
    "SELECT DISTINCT * FROM event_batch", "event_log", "event_batch"
)
ORACLES["first_per_key"] = _sql(
    """
SELECT * EXCLUDE (rk) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY "AgentGUID", "DriveName", "DiskLabel"
    ORDER BY "TotalSpaceGB" NULLS FIRST, "FreeSpaceGB" NULLS FIRST, "ResultGroup", "Locked") AS rk
  FROM disk_rows)
WHERE rk = 1""",
    "disks",
    "disk_rows",
)
ORACLES["slot_counts"] = _sql(
    "SELECT log_date, count(*) AS n_rows FROM event_log GROUP BY 1", "event_log"
)
ORACLES["rec_id"] = _sql(
    """
SELECT "AgentGUID", "Message", md5("AgentGUID" || '|' || "Message") AS "RecID"
FROM event_batch""",
    "event_log",
    "event_batch",
)
ORACLES["report_rows"] = _sql(
    """
SELECT md5("AgentGUID" || '|' || strftime("EventTime", '%Y-%m-%d %H:%M:%S') || '|' || "Message")
         AS "RecID",
       "AgentGUID", "EventTime", "Message", TIMESTAMP '2024-01-31' AS "RecCreatedOn",
       CAST("EventTime" AS DATE) AS "SlotDate"
FROM event_batch""",
    "event_log",
    "event_batch",
)

# --- latest rows and disks -------------------------------------------------

_LAST = ("audits", "last_audit")
ORACLES["latest_per_agent"] = _sql("SELECT * FROM last_audit", *_LAST)
_AUDITED = """
SELECT d.*, a.date AS "Stamp",
       CASE WHEN a.date IS NULL THEN 'skipped' ELSE 'inserted' END AS outcome
FROM disk_rows d LEFT JOIN last_audit a
  ON a."agentGuid" = d."AgentGUID" AND a."resultGroup" = d."ResultGroup"
 AND a.locked = d."Locked" """
ORACLES["latest_audit_join"] = _sql(_AUDITED, "disks", "disk_rows", *_LAST)
_CURRENT_ROWS = _CTES["disk_rows"].replace("FROM disks", "FROM current_disks")
_CURRENT = ("disks", "current_disks", "disk_rows", *_LAST, "audited")
ORACLES["outcome_counts"] = _sql(
    "SELECT outcome, count(*) AS n_rows FROM audited GROUP BY 1",
    *_CURRENT,
    disk_rows=_CURRENT_ROWS,
    audited=_AUDITED,
)
_STAMPED = ("weeks", "disks", "audits", "weekly_disks", "latest_stamps")
ORACLES["latest_stamp_weekly"] = _requested(
    "SELECT * FROM latest_stamps", "audit_requests", *_STAMPED, unit="week"
)
_JOINED_BACK = """
FROM latest_stamps s
JOIN audits r ON r."agentGuid" = s."agentGuid" AND r.date = s."Stamp"
JOIN disks d ON d."agentGuid" = s."agentGuid" AND d."volumeName" = s."volumeName"
            AND d."driveLetter" = s."driveLetter"
WHERE d.locked = 1"""
ORACLES["join_back_latest"] = _requested(
    f"""
SELECT s.*, d."totalMBytes", d."freeMBytes", count(*) AS copies
{_JOINED_BACK} GROUP BY ALL""",
    "audit_requests",
    *_STAMPED,
    unit="week",
)

# --- inventory -------------------------------------------------------------

ORACLES["agents"] = _sql('SELECT DISTINCT "agentGuid" FROM machines', "machines")
ORACLES["size_to_mb"] = _sql("SELECT * FROM sized", "simm", "sizes", "sized")
ORACLES["memory_installed"] = _sql(
    """
SELECT "agentGuid", CAST(coalesce(sum(mb), 0) AS BIGINT) AS "MemoryInstalledMB"
FROM sized GROUP BY 1""",
    "simm",
    "sizes",
    "sized",
)
ORACLES["unreadable_sizes"] = _sql(
    """SELECT count(*) AS n_rows FROM sized WHERE "memSize" IS NOT NULL AND mb IS NULL""",
    "simm",
    "sizes",
    "sized",
)
_FIELDS = ("field_values", "fields", "flags")
ORACLES["eav_pivot"] = _sql("SELECT * FROM flags", *_FIELDS)
ORACLES["reporting_agents"] = _sql(
    """SELECT "agentGuid" FROM flags WHERE upper(rtrim("reportingEnabled", ' ')) = 'YES'""",
    *_FIELDS,
)
ORACLES["top1_lookup"] = _sql(
    """
SELECT "agentGuid", "ipAddress", "osInfo" FROM (
  SELECT *, row_number() OVER (PARTITION BY "agentGuid"
    ORDER BY "ipAddress" NULLS FIRST, "osInfo" NULLS FIRST) AS rk FROM ip_info)
WHERE rk = 1""",
    "ip_info",
)
ORACLES["last_reboots"] = _sql(
    'SELECT "agentGuid", max("rebootTime") AS "LastReboot" FROM reboots GROUP BY 1', "reboots"
)
_SNAPSHOT = (
    "machines",
    *_FIELDS,
    "ip_info",
    "reboots",
    "simm",
    "sizes",
    "sized",
    "cpu",
    "snapshot",
)
ORACLES["assemble_snapshot"] = _sql("SELECT * FROM snapshot", *_SNAPSHOT)

# --- activities ------------------------------------------------------------

ORACLES["max_group_size"] = """
SELECT max(n) AS max_rows FROM (SELECT count(*) AS n FROM conversations GROUP BY conv_id)
"""
_NUMBERED = """
  SELECT *, row_number() OVER (PARTITION BY contact ORDER BY created_on, type) AS i
  FROM activities"""
ORACLES["number_activities"] = _sql(
    'SELECT contact, created_on, type, i AS slot FROM numbered',
    "activities",
    "numbered",
    numbered=_NUMBERED,
)
_TITLES = (
    ("Subject", "subject"),
    ("Type", "type"),
    ("Created On", "created_on"),
    ("Created By", "created_by"),
    ("Description", "description"),
)
# The longest conversation has 8 turns at every scale of the test data.
_SLOT_COLUMNS = ",\n       ".join(
    f'max({c}) FILTER (WHERE i = {i}) AS "{i} {title}"'
    for i in range(1, 9)
    for title, c in _TITLES
)
ORACLES["widen_conversations"] = _sql(
    f"""
SELECT owner AS "Owner", contact AS "Contact", account AS "Account", lead_source AS "Lead Source",
       {_SLOT_COLUMNS}
FROM numbered GROUP BY owner, contact, account, lead_source""",
    "activities",
    "numbered",
    numbered=_NUMBERED,
)

_PAGE_COLUMNS = ",\n       ".join(
    f'max({c}) FILTER (WHERE (i - 1) % 3 = {i - 1}) AS "{i} {title}"'
    for i in range(1, 4)
    for title, c in _TITLES
)
ORACLES["widen_paged"] = _sql(
    f"""
SELECT owner AS "Owner", contact AS "Contact", account AS "Account", lead_source AS "Lead Source",
       CAST((i - 1) // 3 + 1 AS INTEGER) AS "Page",
       {_PAGE_COLUMNS}
FROM numbered GROUP BY owner, contact, account, lead_source, (i - 1) // 3""",
    "activities",
    "numbered",
    numbered=_NUMBERED,
)
ORACLES["number_with_nulls"] = """
SELECT contact, created_on, min(i) AS first_slot, max(i) AS last_slot, count(*) AS n_slots
FROM (
  SELECT *, row_number() OVER (PARTITION BY contact ORDER BY created_on NULLS FIRST, o_orderkey) AS i
  FROM (SELECT CASE WHEN o_custkey % 3 > 0 THEN o_orderstatus END AS contact,
               CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate END AS created_on, o_orderkey
        FROM orders))
GROUP BY contact, created_on
"""

# --- whole jobs ------------------------------------------------------------

_ASKED = """
  SELECT DISTINCT component, log_date
  FROM day_slots, (VALUES ('CPU'), ('MEM')) AS v(component)
  WHERE components ILIKE '%ALL%' OR components ILIKE '%' || component || '%'
     OR components IS NULL
     OR (components NOT ILIKE '%CPU%' AND components NOT ILIKE '%MEM%')"""


def _log_job(body: str, *ctes: str, **own: str) -> str:
    return _sql(
        body,
        "log_requests",
        "requests",
        "stripped",
        "dated",
        "resolved",
        "day_slots",
        *ctes,
        requests=_requests("log_requests"),
        resolved=_resolved(1, 1),
        day_slots=_DAY_SLOTS,
        **own,
    )


ORACLES["components_report"] = _log_job(
    f"""
SELECT b.component, "AgentGUID", "TheDate", "Hour", round("Sum", 4) AS "Sum", "DataPoints"
FROM hourly b JOIN asked a ON a.component = b.component AND a.log_date = b.log_date
WHERE {_HOUR_NOT_STORED}""",
    "asked",
    *_LOG,
    "hourly",
    "stored_hours",
    asked=_ASKED,
    readings=_READINGS,
    hourly=_hourly("<="),
    stored_hours=_STORED_HOURS,
)
ORACLES["daily_components"] = _log_job(
    _DAILY.format(where="WHERE (component, log_date) IN (SELECT (component, log_date) FROM asked)"),
    "asked",
    *_LOG,
    asked=_ASKED,
    readings=_READINGS,
)
ORACLES["events_report"] = _log_job(
    f"""
SELECT "agentGuid" AS "AgentGUID", "eventTime" AS "EventTime",
       substring(message, 1, 2000) AS "Message"
FROM event_log e
WHERE log_date IN (SELECT log_date FROM day_slots) AND {_DAY_EMPTY.format(day="e.log_date")}
UNION ALL
SELECT DISTINCT b."AgentGUID", b."EventTime", b."Message" FROM (
  SELECT "agentGuid" AS "AgentGUID", "eventTime" AS "EventTime",
         substring(message, 1, 2000) AS "Message"
  FROM event_log e
  WHERE log_date IN (SELECT log_date FROM day_slots)
    AND NOT {_DAY_EMPTY.format(day="e.log_date")}
    AND "eventTime" >= CAST(log_date AS TIMESTAMP)
    AND "eventTime" < CAST(log_date AS TIMESTAMP) + INTERVAL 1 DAY) b
WHERE {_NOT_STORED}""",
    "event_log",
    "stored_events",
)
ORACLES["event_outcomes"] = _log_job(
    f"""
, asked_events AS (
  SELECT "agentGuid" AS "AgentGUID", "eventTime" AS "EventTime",
         CASE WHEN "agentGuid" % 7 > 0 THEN substring(message, 1, 2000) END AS "Message", log_date,
         {_DAY_EMPTY.format(day="e.log_date")} AS empty_day
  FROM event_log e WHERE log_date IN (SELECT log_date FROM day_slots)),
complete AS (SELECT * FROM asked_events WHERE "AgentGUID" IS NOT NULL AND "Message" IS NOT NULL),
counted AS (
  SELECT (SELECT count(*) FROM asked_events) AS n_asked,
         (SELECT count(*) FROM complete) AS n_complete,
         (SELECT count(*) FROM complete WHERE empty_day) + (SELECT count(*) FROM (
            SELECT DISTINCT "AgentGUID", "EventTime", "Message" FROM complete b
            WHERE NOT empty_day AND CAST("EventTime" AS DATE) = log_date AND {_NOT_STORED}))
           AS n_new)
SELECT v.outcome, v.n_rows FROM counted, LATERAL (VALUES
  ('inserted', n_new), ('skipped', n_complete - n_new), ('rejected', n_asked - n_complete)
) AS v(outcome, n_rows)""",
    "event_log",
    "stored_events",
)
ORACLES["weekly_disk_report"] = _requested(
    f"""
SELECT "AgentGUID", "YearNum", "WeekNum", "DiskLabel", "DriveName",
       "TotalSpaceGB", "FreeSpaceGB", "Stamp"
FROM (
  SELECT *, row_number() OVER (
    PARTITION BY "AgentGUID", "YearNum", "WeekNum", "DriveName", "DiskLabel"
    ORDER BY "Stamp", "TotalSpaceGB" NULLS FIRST, "FreeSpaceGB" NULLS FIRST) AS rk
  FROM (
    SELECT s."agentGuid" AS "AgentGUID", s."YearNum", s."WeekNum",
           trim(s."volumeName", ' ') AS "DiskLabel", trim(s."driveLetter", ' ') AS "DriveName",
           d."totalMBytes" / 1024 AS "TotalSpaceGB", d."freeMBytes" / 1024 AS "FreeSpaceGB",
           s."Stamp"
    {_JOINED_BACK})) b
WHERE rk = 1 AND NOT EXISTS (
  SELECT * FROM stored_disks o WHERE o."AgentGUID" = b."AgentGUID"
    AND o."YearNum" = b."YearNum" AND o."WeekNum" = b."WeekNum"
    AND o."DriveName" = b."DriveName" AND o."DiskLabel" = b."DiskLabel")""",
    "audit_requests",
    *_STAMPED,
    "stored_disks",
    unit="week",
)
ORACLES["current_disk_report"] = _sql(
    """
SELECT "AgentGUID", 2024 AS "YearNum", 5 AS "WeekNum", "DiskLabel", "DriveName",
       "TotalSpaceGB", "FreeSpaceGB", "Stamp"
FROM audited WHERE outcome = 'inserted'""",
    *_CURRENT,
    disk_rows=_CURRENT_ROWS,
    audited=_AUDITED,
)
_SERVERS = (*_SNAPSHOT, "stored_servers", "outcomes")
ORACLES["servers_snapshot"] = _sql(
    "SELECT * EXCLUDE (outcome) FROM outcomes WHERE outcome = 'inserted'", *_SERVERS
)
ORACLES["snapshot_outcomes"] = _sql(
    "SELECT outcome, count(*) AS n_rows FROM outcomes GROUP BY 1", *_SERVERS
)

# --- further ways to the same results, and what was written and read back ---

ORACLES["component_rollup_sums_first"] = ORACLES["component_rollup"]
ORACLES["daily_rollup_sums_first"] = ORACLES["daily_rollup"]
ORACLES["judged_event_outcomes"] = ORACLES["event_outcomes"]
ORACLES["judged_components"] = _log_job(
    f"""
SELECT b.component, "AgentGUID", "TheDate", "Hour", round("Sum", 4) AS "Sum", "DataPoints",
       CASE WHEN {_HOUR_NOT_STORED} THEN 'inserted' ELSE 'skipped' END AS outcome
FROM hourly b JOIN asked a ON a.component = b.component AND a.log_date = b.log_date""",
    "asked",
    *_LOG,
    "hourly",
    "stored_hours",
    asked=_ASKED,
    readings=_READINGS,
    hourly=_hourly("<="),
    stored_hours=_STORED_HOURS,
)
ORACLES["judged_weekly_disks"] = _requested(
    f"""
SELECT *, CASE WHEN "DiskLabel" IS NULL OR "DriveName" IS NULL THEN 'rejected'
  WHEN EXISTS (
    SELECT * FROM stored_disks o WHERE o."AgentGUID" = b."AgentGUID"
      AND o."YearNum" = b."YearNum" AND o."WeekNum" = b."WeekNum"
      AND o."DriveName" = b."DriveName" AND o."DiskLabel" = b."DiskLabel") THEN 'skipped'
  ELSE 'inserted' END AS outcome
FROM (
  SELECT DISTINCT s."agentGuid" AS "AgentGUID", s."YearNum", s."WeekNum",
         trim(s."volumeName", ' ') AS "DiskLabel", trim(s."driveLetter", ' ') AS "DriveName"
  {_JOINED_BACK}) b""",
    "audit_requests",
    *_STAMPED,
    "stored_disks",
    unit="week",
)
_MINUTES = """CASE WHEN o_orderkey % 360 = 0 THEN -30 WHEN o_orderkey % 3000 = 0 THEN 64800
              WHEN o_orderkey % 1000 = 0 THEN 2880 WHEN o_orderkey % 80 = 0 THEN 420 ELSE 90 END"""
ORACLES["join_windows"] = _sql(
    f"""
SELECT e."agentGuid", e."eventTime", e.message, w.* FROM event_log e JOIN (
  SELECT o_orderkey AS window_id,
         TIMESTAMP '2024-01-01' + to_minutes(o_orderkey % 43200) + to_seconds(o_orderkey % 7) AS window_start,
         CASE WHEN o_orderkey % 320 <> 0 THEN TIMESTAMP '2024-01-01'
           + to_minutes(o_orderkey % 43200 + {_MINUTES}) + to_seconds(o_orderkey % 11) END AS window_end
  FROM orders WHERE o_orderkey % 40 = 0) w
ON e."eventTime" >= w.window_start AND e."eventTime" < w.window_end""",
    "event_log",
)
ORACLES["rec_id_copies"] = _sql(
    """
SELECT "AgentGUID", "Message",
       md5("AgentGUID" || '|' || "Message" || CASE WHEN i > 1 THEN '|' || chr(92) || i ELSE '' END) AS "RecID"
FROM (SELECT *, row_number() OVER (PARTITION BY "AgentGUID", "Message") AS i FROM event_batch)""",
    "event_log",
    "event_batch",
)
ORACLES["day_shards"] = _log_job(
    """
SELECT * FROM event_log
WHERE log_date IN (SELECT log_date FROM day_slots) AND extract(day FROM log_date) % 5 > 0""",
    "event_log",
)
ORACLES["load_tables"] = _sql(
    """
SELECT coalesce(a."agentGuid", m."agentGuid") AS "agentGuid", last_audit, n_modules
FROM (SELECT "agentGuid", max(date) AS last_audit FROM audits GROUP BY 1) a
FULL JOIN (SELECT "agentGuid", count("memSize") AS n_modules FROM simm GROUP BY 1) m
  ON a."agentGuid" = m."agentGuid" """,
    "audits",
    "simm",
)
ORACLES["view_source"] = _sql(
    """
SELECT owner, contact, account, lead_source, subject, type, created_on, created_by, description
FROM activities""",
    "activities",
)
ORACLES["report_tables"] = _sql(
    """
SELECT *, CAST("EventTime" AS DATE) AS "SlotDate" FROM event_batch
WHERE "Message" LIKE '%error%'""",
    "event_log",
    "event_batch",
)
ORACLES["sorted_events"] = _sql(
    """
SELECT message, "agentGuid", min(i) AS first_row, max(i) AS last_row, count(*) AS n_rows
FROM (SELECT *, row_number() OVER (ORDER BY message, "agentGuid") AS i FROM event_log)
GROUP BY message, "agentGuid" """,
    "event_log",
)
_CALLED = """log_date BETWEEN DATE '2024-01-04' AND DATE '2024-01-24'"""
_EVENT_KEY = """"AgentGUID" || '|' || CAST("EventTime" AS VARCHAR) || '|' || "Message" """
ORACLES["published_events"] = _sql(
    f"""
, found AS (
  SELECT "agentGuid" AS "AgentGUID", "eventTime" AS "EventTime", message AS "Message", log_date,
         {_DAY_EMPTY.format(day="e.log_date")} AS empty_day
  FROM event_log e WHERE {_CALLED})
SELECT *, CAST("EventTime" AS DATE) AS "SlotDate" FROM (
  SELECT md5({_EVENT_KEY}) AS "RecID", * FROM stored_events
  UNION ALL
  SELECT md5({_EVENT_KEY} || CASE WHEN i > 1 THEN '|' || chr(92) || i ELSE '' END),
         "AgentGUID", "EventTime", "Message"
  FROM (SELECT *, row_number() OVER (PARTITION BY "AgentGUID", "EventTime", "Message") AS i
        FROM found WHERE empty_day)
  UNION ALL
  SELECT DISTINCT md5({_EVENT_KEY}), "AgentGUID", "EventTime", "Message" FROM found b
  WHERE NOT empty_day AND CAST("EventTime" AS DATE) = log_date AND {_NOT_STORED})""",
    "event_log",
    "stored_events",
)
ORACLES["published_components"] = _sql(
    f"""
SELECT CASE component WHEN 'MEM' THEN 'Memory' ELSE component END AS report,
       "AgentGUID", "TheDate", "Hour", round("Sum", 4) AS "Sum", "DataPoints"
FROM (
  SELECT component, "AgentGUID", "TheDate", "Hour", "Sum", "DataPoints" FROM stored_hours
  UNION ALL
  SELECT component, "AgentGUID", "TheDate", "Hour", "Sum", "DataPoints" FROM hourly b
  WHERE {_CALLED} AND {_HOUR_NOT_STORED})""",
    *_LOG,
    "hourly",
    "stored_hours",
    readings=_READINGS,
    hourly=_hourly("<="),
    stored_hours=_STORED_HOURS,
)
