"""Requests to slots.

A request is a row ``(req_id, from_parm, to_parm[, components])`` of raw text
arguments. Resolving gives a date range; expanding gives one row per day or
week; the jobs join logs and audits to those rows.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger.functions.calendar import (
    AsOf,
    as_date,
    end_of_week,
    in_calendar,
    start_of_week,
    us_week,
)
from slotledger.functions.text import contains_ci, is_int, parse_date, parse_int, strip_separators

# Days per step back, and days back when no date is given.
UNIT_DAYS = {"day": 1, "week": 7}
DEFAULT_DAYS_BACK = {"day": 1, "week": 8}
# Windows are met through bins of 16^k seconds, the longest some 2000 years. Bins that a window may go into, where they are not of its own size.
BIN_FACTOR, BIN_LEVELS, MAX_WINDOW_BINS = 16, 10, 65_536
# Pairs in a block: the first, or more where each core has several blocks still, up to the second. Larger blocks copy less.
TASK_PAIRS, MAX_BLOCK_PAIRS, BLOCKS_PER_CORE = 40_000_000, 500_000_000, 16
# Rows and windows of one bin in a block at most; the windows of a block are held in memory.
BLOCK_ROWS, BLOCK_WINDOWS = 4_000_000, 50_000
# Bins cut into blocks are broadcast: blocks grow where there would be more than so many by pairs, by rows or by windows.
MAX_CUT_BINS = 100_000
# Numbers above this are taken for a mistyped date and count as one step back.
MAX_STEPS_BACK = 10000


def resolve_requests(
    df: DataFrame, as_of: AsOf, unit: str = "day", default_days_back: int | None = None
) -> DataFrame:
    """Add ``from_date`` and ``to_date`` to each request.

    The first argument may be a date, a number of units back, or nothing; the
    second counts only after a date. Reversed bounds are swapped. Text that is
    neither date nor number falls back to the default.
    """
    days = UNIT_DAYS[unit]
    back = DEFAULT_DAYS_BACK[unit] if default_days_back is None else default_days_back
    today = as_date(as_of)

    steps = (
        F.when(F.col("_steps") <= MAX_STEPS_BACK, F.col("_steps"))
        .when(is_int(F.col("_first")), F.lit(1))
        .cast("int")
    )
    start = F.coalesce("_date", F.date_sub(today, steps * days), F.date_sub(today, back))
    second = F.when(
        F.col("_date").isNotNull(), parse_date(strip_separators(F.col("to_parm")))
    )
    # one named column per step, so that no step is computed twice
    return (
        df.withColumn("_first", strip_separators(F.col("from_parm")))
        .withColumns({"_date": parse_date(F.col("_first")), "_steps": parse_int(F.col("_first"))})
        .withColumns({"_start": start, "_second": second})
        .withColumn("_end", F.coalesce("_second", "_start"))
        .withColumns(
            {"from_date": F.least("_start", "_end"), "to_date": F.greatest("_start", "_end")}
        )
        .drop("_first", "_date", "_steps", "_start", "_second", "_end")
    )


def distinct_ranges(resolved: DataFrame, *also: str) -> DataFrame:
    """The date ranges asked for, each once, before they are expanded."""
    return resolved.select("from_date", "to_date", *also).distinct()


def day_slots(resolved: DataFrame) -> DataFrame:
    """One row per request and day, as ``log_date``."""
    return resolved.withColumn("log_date", F.explode(F.sequence("from_date", "to_date")))


def week_slots(
    resolved: DataFrame, week_start: int = 1, cover_all_weeks: bool = False
) -> DataFrame:
    """One row per request and week.

    The range is stepped by seven days from its first day, so a range that ends
    early in a further week does not reach it; ``cover_all_weeks`` steps from
    the first week's start and does. Year and week number come from the last
    day of the week.
    """
    first = F.col("from_date")
    if cover_all_weeks:
        first = F.coalesce(start_of_week(first, week_start), first)
    steps = F.sequence(first, F.col("to_date"), F.expr("INTERVAL 7 DAYS"))
    last_day = F.col("week_end")
    return (
        resolved.withColumn("slot_date", F.explode(steps))
        .withColumns(
            {
                "week_begin": start_of_week(F.col("slot_date"), week_start),
                "week_end": end_of_week(F.col("slot_date"), week_start),
            }
        )
        .withColumns(
            {
                "week_limit": F.date_add(last_day, 1),
                "YearNum": F.year(last_day),
                "WeekNum": us_week(last_day),
            }
        )
    )


def resolve_components(df: DataFrame, col: str = "components") -> DataFrame:
    """One row per request and component asked for; both when none is named."""
    text = F.col(col)
    everything = contains_ci(text, "ALL")
    cpu = F.coalesce(everything | contains_ci(text, "CPU"), F.lit(False))
    mem = F.coalesce(everything | contains_ci(text, "MEM"), F.lit(False))
    chosen = (
        F.when(cpu & ~mem, F.array(F.lit("CPU")))
        .when(mem & ~cpu, F.array(F.lit("MEM")))
        .otherwise(F.array(F.lit("CPU"), F.lit("MEM")))
    )
    return df.withColumn("component", F.explode(chosen))


def distinct_slots(slots: DataFrame, day: str, *also: str) -> DataFrame:
    """Distinct slots inside the calendar.

    The calendar filter is what makes a broadcast of the result safe: there are
    some three million dates in the DATETIME range, whatever the number of
    requests. It also lets Spark prune log partitions by these slots. Slots that
    come from ``resolve_requests`` are always inside; a slot outside names no day
    that a log or report can hold, and is left out.
    """
    return slots.where(in_calendar(F.col(day))).select(day, *also).distinct()


def in_day_slots(df: DataFrame, slots: DataFrame, day: str = "log_date") -> DataFrame:
    """Rows of a day-partitioned log whose day was asked for."""
    days = distinct_slots(slots, "log_date").withColumnRenamed("log_date", day)
    return df.join(F.broadcast(days), day, "left_semi").select(*df.columns)


def rows_in_slot(df: DataFrame, ts: str, lo, hi) -> DataFrame:
    """Half-open interval: ``lo <= ts < hi``."""
    return df.where((F.col(ts) >= lo) & (F.col(ts) < hi))


def join_day_slots(df: DataFrame, ts: str, slots: DataFrame) -> DataFrame:
    """Rows whose time falls in a requested day, with ``n_requests``: how many slots name that day.

    Slots are counted per day before the join, so a row comes out once whatever
    the number of requests. The day is derived from the time, so this is an
    equi-join; the days are dates of the calendar and can be broadcast.
    """
    days = (
        slots.where(in_calendar(F.col("log_date")))
        .groupBy(F.col("log_date").alias("_day"))
        .agg(F.count(F.lit(1)).alias("n_requests"))
    )
    return df.withColumn("_day", F.to_date(ts)).join(F.broadcast(days), "_day").drop("_day")


def join_week_slots(
    df: DataFrame, ts: str, weeks: DataFrame, week_start: int = 1
) -> DataFrame:
    """Each row whose time falls in one of the weeks, with that week."""
    return df.withColumn("week_begin", start_of_week(F.col(ts), week_start)).join(
        F.broadcast(distinct_weeks(weeks)), "week_begin"
    )


def _level(length) -> Column:
    """The level whose bins are as long as a window, or shorter by less than ``BIN_FACTOR``."""
    steps = [F.when(length >= BIN_FACTOR**k, F.lit(k)) for k in range(BIN_LEVELS - 1, 0, -1)]
    return F.coalesce(*steps, F.lit(0))


def _bin_levels(rows: int, copies: dict[int, list[float]], most: dict[int, list[float]]) -> dict[int, int]:
    """The level of bins for the windows of each level: its own, or one below that others use.

    A level in use costs a copy of each row, bins below a window's own cost more copies
    of the window: ``copies`` has, for windows of a level, how many bins of each level
    they touch, ``most`` how many a single one does. What is least in all is taken.
    """
    used = sorted(copies)
    best = {}, math.inf
    for others in itertools.chain.from_iterable(itertools.combinations(used[1:], n) for n in range(len(used))):
        into = {k: max(j for j in (*used[:1], *others) if j <= k) for k in used}
        cost = rows * (1 + len(others)) + sum(copies[k][j] for k, j in into.items())
        if cost < best[1] and all(k == j or most[k][j] <= MAX_WINDOW_BINS for k, j in into.items()):
            best = into, cost
    return best[0]


def join_windows(
    df: DataFrame, ts: str, windows: DataFrame, lo: str = "window_start", hi: str = "window_end"
) -> DataFrame:
    """Rows with every window ``lo <= ts < hi`` that they fall in; windows may overlap and have any length.

    Time is cut into bins of several lengths, each ``BIN_FACTOR`` times the one
    below, from a second up. A window is put into the few bins of its own size that it
    touches, a row into one bin of each size that a window has; they meet by equality
    of bins, and the times then decide. So the work follows the matches, not the
    product, and a window of years costs as few rows as one of a minute. Where a size
    has few windows they go into more bins of a smaller size, which saves a copy of each
    row; of a window only what lies between the first and the last row counts. Windows
    that are empty, reversed or without a bound match nothing.

    A bin of many pairs is cut into blocks: its rows are dealt into parts, its windows as
    well, and each part of the rows meets each of the windows in a block of its own. A
    block is as many rows by as many windows, as far as its bin has them and memory
    holds the windows, so that few copies are shuffled. Blocks are dealt to as many tasks
    as the pairs call for, so that no bin falls to one task.
    """
    timed = df.where(F.col(ts).isNotNull())
    at = _seconds(F.col(ts))
    rows, first, last = timed.agg(F.count(F.lit(1)), F.min(at), F.max(at)).first()
    first, last = (first, last) if rows else (0, -1)
    begin, end = _seconds(F.col(lo)), _seconds(F.col(hi))
    valid = windows.where((F.col(lo) < F.col(hi)) & (begin <= last) & (end >= first))
    sized = valid.withColumn("_level", _level(end - begin))
    begin, end = F.greatest(begin, F.lit(first)), F.least(end, F.lit(last))
    touched = [(F.floor(end / BIN_FACTOR**k) - F.floor(begin / BIN_FACTOR**k) + 1).cast("double") for k in range(BIN_LEVELS)]
    # at most BIN_LEVELS rows
    sizes = sized.groupBy("_level").agg(F.array(*map(F.sum, touched)), F.array(*map(F.max, touched))).collect()
    into = _bin_levels(rows, {k: copies for k, copies, _ in sizes}, {k: most for k, _, most in sizes})
    lowered = F.element_at(F.array(*[F.lit(into.get(k, k)) for k in range(BIN_LEVELS)]), F.col("_level") + 1)
    width = F.element_at(F.array(*[F.lit(BIN_FACTOR**k) for k in range(BIN_LEVELS)]), F.col("_level") + 1)
    # the last second is inclusive: a window may end within it
    bins = F.sequence(F.floor(begin / width), F.floor(end / width))
    placed = sized.withColumn("_level", lowered).withColumn("_bin", F.explode(bins))
    levels = [F.struct(F.lit(k).alias("_level"), F.floor(at / BIN_FACTOR**k).alias("_bin")) for k in sorted({*into.values()})]
    none = F.array().cast("array<struct<_level:int,_bin:bigint>>")
    binned = timed.select("*", F.inline(F.array(*levels) if levels else none))
    keys = ["_level", "_bin"]
    counts = [side.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)) for side, n in ((binned, "_n"), (placed, "_m"))]
    load = counts[0].join(counts[1], keys, "full").fillna(0, ["_n", "_m"]).withColumn("_pairs", F.col("_n").cast("double") * F.col("_m"))
    n, m, pairs = (x or 0 for x in load.agg(F.sum("_n"), F.sum("_m"), F.sum("_pairs")).first())
    if pairs > TASK_PAIRS:
        cores = df.sparkSession.sparkContext.defaultParallelism
        block_pairs = max(min(max(TASK_PAIRS, pairs / (BLOCKS_PER_CORE * cores)), MAX_BLOCK_PAIRS), pairs / MAX_CUT_BINS)
        block_rows, block_windows = max(BLOCK_ROWS, n // MAX_CUT_BINS), max(BLOCK_WINDOWS, m // MAX_CUT_BINS)
        cut = F.broadcast(_cut_bins(load, block_pairs, block_rows, block_windows).select(*keys, "_of_rows", "_of_windows"))
        keys += ["_row_part", "_window_part"]
        # twice the blocks: they fall to tasks by hash
        tasks = max(cores, *(math.ceil(x) for x in (2 * pairs / block_pairs, n / block_rows, m / block_windows)))
        binned = _in_blocks(binned, cut, "_row_part", "_of_rows", "_window_part", "_of_windows").repartition(tasks, *keys)
        placed = _in_blocks(placed, cut, "_window_part", "_of_windows", "_row_part", "_of_rows").repartition(tasks, *keys).hint("shuffle_hash")
    met = binned.join(placed, keys).where((F.col(lo) <= F.col(ts)) & (F.col(ts) < F.col(hi)))
    return met.select(*df.columns, *windows.columns)


def _cut_bins(load: DataFrame, block_pairs: float, block_rows: int, block_windows: int) -> DataFrame:
    """Bins of more than a block, with the parts of each side; none where a bin has many of one side and nothing of the other."""
    blocks = F.ceil(F.col("_pairs") / block_pairs)
    square = F.least(blocks, F.round(F.col("_m") / math.sqrt(block_pairs)).cast("bigint"))
    of_windows = F.greatest(F.lit(1), F.ceil(F.col("_m") / block_windows), square)
    of_rows = F.greatest(F.lit(1), F.ceil(F.col("_n") / block_rows), F.ceil(blocks / F.col("_of_windows")))
    met = F.col("_pairs") > 0
    return (
        load.withColumn("_of_windows", of_windows)
        .withColumn("_of_rows", of_rows)
        .where("_of_rows > 1 OR _of_windows > 1")
        .withColumns({c: F.when(met, F.col(c)).otherwise(0) for c in ("_of_rows", "_of_windows")})
    )


def _in_blocks(df: DataFrame, cut: DataFrame, own: str, of_own: str, other: str, of_other: str) -> DataFrame:
    """Each row in one of its side's parts of the bin, once for each part of the other side; bins that are not cut are one block."""
    one = {c: F.coalesce(c, F.lit(1)) for c in (of_own, of_other)}
    # drawn, not hashed: equal rows are spread as well
    part = F.floor(F.rand(7) * one[of_own])
    dealt = df.join(cut, ["_level", "_bin"], "left").where(one[of_other] > 0).withColumn(own, part)
    return dealt.withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), one[of_other] - 1))).drop(of_own, of_other)


def _seconds(ts: Column) -> Column:
    """Whole seconds since a fixed moment, rounded down."""
    return F.floor(F.unix_micros(ts.cast("timestamp_ntz").cast("timestamp")) / 1_000_000)


def distinct_weeks(week_slot_rows: DataFrame) -> DataFrame:
    """The weeks of a slot table, one row each: at most the weeks of the calendar."""
    return distinct_slots(week_slot_rows, "week_begin", "YearNum", "WeekNum")
