"""Counter log to sums per agent and hour, or per agent and day.

Which report a counter feeds is in a table of its own. As long as the counters that
feed one are few, they are broadcast and the log is summed once. Beyond that the log
is summed first, by counter, for both readings filters at once; only these sums meet
the counters, so no reading is ever shuffled by its counter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger.operators.bounds import at_most
from slotledger.operators.filters import is_cpu_counter, is_mem_counter
from slotledger.operators.slots import distinct_slots

COMPONENTS = ("CPU", "MEM")
# So many counters (about 32 MB) are broadcast to the log.
BROADCAST_COUNTERS = 1_000_000


def component_counters(
    counters: DataFrame, components: Sequence[str] = COMPONENTS
) -> DataFrame:
    """``(monitorCounterId, component)``: which report a counter feeds.

    A counter whose name matches both patterns gives two rows.
    """
    name = F.col("name")
    tests = {"CPU": is_cpu_counter(name), "MEM": is_mem_counter(name)}
    picked = [F.when(tests[c], F.lit(c)) for c in COMPONENTS if c in components]
    return counters.select(
        "monitorCounterId", F.explode(F.array_compact(F.array(*picked))).alias("component")
    )


def component_readings(
    log: DataFrame, counters: DataFrame, components: Sequence[str] = COMPONENTS
) -> DataFrame:
    """Log rows that count for a component: CPU from 0 up, memory above 0.

    No join hint: the counter table is broadcast when Spark's own size check
    (or the size AQE measures) allows it. ``counterValue >= 0`` holds for both
    components and reaches the scan.
    """
    return _readings(log, component_counters(counters, components))


def _readings(log: DataFrame, feeds: DataFrame) -> DataFrame:
    value, component = F.col("counterValue"), F.col("component")
    return (
        log.where(value >= 0)
        .join(feeds, "monitorCounterId")
        .where((component == "CPU") | (value > 0))
    )


def _hour_slots(ts: Column, log_date: Column, closed: str) -> tuple[Column, Column]:
    """Filter for rows that belong to the shard's day, and the slots of a row."""
    day = log_date.cast("timestamp_ntz")
    next_day = F.date_add(log_date, 1).cast("timestamp_ntz")
    hour = F.hour(ts)
    if closed == "left":
        return (ts >= day) & (ts < next_day), F.array(hour)
    if closed != "both":
        raise ValueError(f"closed must be 'both' or 'left', not {closed!r}")
    # minute() is cheap and nearly always decides, so the exact test is rare
    on_hour = (F.minute(ts) == 0) & (F.extract(F.lit("SECOND"), ts) == 0)
    slots = (
        F.when(ts == next_day, F.array(F.lit(23)))
        .when(on_hour & (hour > 0), F.array(hour - 1, hour))
        .otherwise(F.array(hour))
    )
    return (ts >= day) & (ts <= next_day), slots


def _in_slots(readings: DataFrame, slots: DataFrame | None) -> DataFrame:
    """Readings, or sums of them, of the ``(component, log_date)`` pairs asked for."""
    if slots is None:
        return readings
    asked = F.broadcast(distinct_slots(slots, "log_date", "component"))
    return readings.join(asked, ["component", "log_date"], "left_semi")


def counter_sums(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums and counts per counter and ``keys``, of readings from 0 up and of those above 0.

    These are the readings that count for CPU and for memory; which of the two a
    counter feeds need not be known yet. One aggregate, partial before its shuffle:
    a counter that holds a large share of the log is a row per key and map task.
    """
    value = F.col("counterValue")
    above = value > 0
    return (
        log.where(value >= 0)
        .groupBy("monitorCounterId", *keys)
        .agg(
            F.sum(value).alias("_sum"),
            F.count(F.lit(1)).alias("_n"),
            F.sum(F.when(above, value)).alias("_sum_above"),
            F.count_if(above).alias("_n_above"),
        )
    )


def _component_sums(
    log: DataFrame,
    hours: Column | None,
    counters: DataFrame,
    components: Sequence[str],
    slots: DataFrame | None,
    sums_first: bool | None,
) -> DataFrame:
    """``Sum`` and ``DataPoints`` per component, agent and day, and hour where ``hours`` gives those of a row."""
    keys = ["agentGuid", "log_date"] + ([] if hours is None else ["Hour"])

    def slotted(df: DataFrame) -> DataFrame:
        return df if hours is None else df.withColumn("Hour", F.explode(hours))

    feeds = component_counters(counters, components)
    few = None
    if sums_first is None:
        few = at_most(feeds, BROADCAST_COUNTERS)
        sums_first = few is None
    if not sums_first:
        readings = _in_slots(_readings(log, feeds if few is None else few), slots)
        sums = slotted(readings).groupBy("component", *keys)
        return sums.agg(F.sum("counterValue").alias("Sum"), F.count(F.lit(1)).alias("DataPoints"))
    cpu = F.col("component") == "CPU"
    met = _in_slots(counter_sums(slotted(log), keys).join(feeds, "monitorCounterId"), slots)
    return (
        met.where(cpu | (F.col("_n_above") > 0))
        .groupBy("component", *keys)
        .agg(
            F.sum(F.when(cpu, F.col("_sum")).otherwise(F.col("_sum_above"))).alias("Sum"),
            F.sum(F.when(cpu, F.col("_n")).otherwise(F.col("_n_above"))).alias("DataPoints"),
        )
    )


def component_rollup(
    log: DataFrame,
    counters: DataFrame,
    components: Sequence[str] = COMPONENTS,
    closed: str = "both",
    slots: DataFrame | None = None,
    sums_first: bool | None = None,
) -> DataFrame:
    """Sum and count per component, agent and hour of the shard day.

    Hours are closed on both ends: a reading exactly on an hour counts in that
    hour and in the one before, within the shard's day. ``slots`` limits the
    work to ``(component, log_date)`` pairs. One scan, whatever the number of days,
    hours and components. With ``sums_first`` the log is summed by counter before it
    meets the counters; without, after it; by default as many counters decide.
    """
    ts, log_date = F.col("eventDateTime"), F.col("log_date")
    inside, hours = _hour_slots(ts, log_date, closed)
    return _component_sums(log.where(inside), hours, counters, components, slots, sums_first).select(
        "component",
        F.col("agentGuid").alias("AgentGUID"),
        (log_date.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("Hour"))).alias(
            "TheDate"
        ),
        "Hour",
        "Sum",
        "DataPoints",
    )


def hourly_rollup(
    log: DataFrame, counters: DataFrame, component: str = "CPU", closed: str = "both"
) -> DataFrame:
    """``component_rollup`` for one component."""
    return component_rollup(log, counters, [component], closed).drop("component")


def daily_rollup(
    log: DataFrame,
    counters: DataFrame,
    components: Sequence[str] = COMPONENTS,
    slots: DataFrame | None = None,
    sums_first: bool | None = None,
) -> DataFrame:
    """Sum and count per component, agent and whole shard; the hour is always 1."""
    return _component_sums(log, None, counters, components, slots, sums_first).select(
        "component",
        F.col("agentGuid").alias("AgentGUID"),
        F.col("log_date").cast("timestamp_ntz").alias("TheDate"),
        F.lit(1).alias("Hour"),
        "Sum",
        "DataPoints",
    )
