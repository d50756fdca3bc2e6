"""Which rows of a batch a report table does not hold yet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotledger.functions.calendar import in_calendar
from slotledger.functions.text import near, null_or_equal
from slotledger.operators.latest import ranked

# Copies of one row that a task writes at most.
COPY_BLOCK = 100_000
# A key is numbered in 2 to the power of so many chunks.
CHUNK_BITS = 10


def insert_new(
    batch: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    approx: Mapping[str, float] | None = None,
    null_matches: Sequence[str] = (),
) -> DataFrame:
    """Rows of ``batch`` without a match in ``target``.

    ``keys`` must be equal. A column in ``approx`` matches within its tolerance,
    one in ``null_matches`` also when the stored value is NULL. The target is
    reduced to its distinct match columns before it is shuffled, so any number
    of stored copies of a row is one row in the join; tolerances are a residual
    condition of the hash or sort-merge join on ``keys``.
    """
    stored, condition = _matching(target, keys, approx or {}, null_matches)
    return batch.join(stored, condition, "left_anti")


def _matching(
    target: DataFrame, keys: Sequence[str], approx: Mapping[str, float], null_matches: Sequence[str]
) -> tuple[DataFrame, Column]:
    """The distinct match columns of ``target``, and when a row matches them."""
    match = [*keys, *approx, *null_matches]
    stored = target.select(*[F.col(c).alias(f"_t_{c}") for c in match]).distinct()
    condition: Column | None = None
    for c in match:
        new, old = F.col(c), F.col(f"_t_{c}")
        if c in approx:
            test = near(old, new, approx[c])
        elif c in null_matches:
            test = null_or_equal(old, new)
        else:
            test = old == new
        condition = test if condition is None else condition & test
    return stored, condition


def mark_stored(
    batch: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    approx: Mapping[str, float] | None = None,
) -> DataFrame:
    """``batch`` with ``stored``: does ``target`` hold the row? The test of ``insert_new``, but every row stays.

    With exact keys a row meets one stored row at most. With a tolerance it may meet
    several; then its rows are made one again where the join has left them, so
    equal rows of such a batch come out once.
    """
    known, condition = _matching(target, keys, approx or {}, ())
    found = F.col("_t_flag").isNotNull()
    met = batch.join(known.withColumn("_t_flag", F.lit(True)), condition, "left")
    if not approx:
        return met.select(*batch.columns, found.alias("stored"))
    return met.groupBy(*batch.columns).agg(F.bool_or(found).alias("stored"))


def load_if_slot_empty(
    batch: DataFrame, target: DataFrame, slot_cols: Sequence[str]
) -> DataFrame:
    """Rows of ``batch`` whose slot has no row in ``target`` at all.

    Occupied slots that are dates of the calendar are broadcast, since it bounds
    their number; those outside it are tested by a join without a hint.
    """
    occupied = target.select(*slot_cols).distinct()
    if [f.dataType for f in occupied.schema.fields] == [T.DateType()]:
        known = in_calendar(F.col(slot_cols[0]))
        within, occupied = F.broadcast(occupied.where(known)), occupied.where(~known)
        batch = batch.join(within, list(slot_cols), "left_anti")
    return batch.join(occupied, list(slot_cols), "left_anti").select(*batch.columns)


def mark_slots(slots: DataFrame, target: DataFrame, target_day: Column) -> DataFrame:
    """Slots with ``occupied``: whether ``target`` holds a row of that day."""
    held = target.select(target_day.alias("log_date")).distinct()
    return slots.join(
        held.withColumn("_held", F.lit(True)), "log_date", "left"
    ).select(*slots.columns, F.coalesce("_held", F.lit(False)).alias("occupied"))


def mark_existing(
    batch: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    null_match: str,
    flag: str = "existing",
) -> DataFrame:
    """``batch`` with a flag: does ``target`` hold the row?

    Same test as ``insert_new`` with one ``null_matches`` column, but every row
    stays, for outcome counts. The stored rows are split into those with a NULL
    and those without, each distinct on what it is joined by, so no batch row
    is ever multiplied.
    """
    keys = list(keys)
    open_rows = (
        target.where(F.col(null_match).isNull())
        .select(*keys)
        .distinct()
        .withColumn("_open", F.lit(True))
    )
    full_rows = (
        target.where(F.col(null_match).isNotNull())
        .select(*keys, null_match)
        .distinct()
        .withColumn("_full", F.lit(True))
    )
    return (
        batch.join(open_rows, keys, "left")
        .join(full_rows, [*keys, null_match], "left")
        .select(
            *batch.columns,
            (F.col("_open").isNotNull() | F.col("_full").isNotNull()).alias(flag),
        )
    )


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None
) -> DataFrame:
    """First row of each key in the given order (first insert wins).

    Without an order the rows of a key must be interchangeable. Both forms drop
    surplus rows before the shuffle, so many copies of one key are cheap.
    """
    if order is None:
        return df.dropDuplicates(list(keys))
    return ranked(df, keys, order, 1)


def powers_of_two(n: Column) -> Column:
    """The powers of two that add up to ``n`` (0 up to 2^62)."""
    powers = F.array(*[F.lit(1 << k) for k in range(63)])
    return F.when(n > 0, F.filter(powers, lambda p: p.bitwiseAND(n) != 0)).otherwise(
        F.array().cast("array<bigint>")
    )


def expand_copies(counted: DataFrame, number: str, copy: str) -> DataFrame:
    """Each row as often as its ``number`` says, with ``copy`` counting 1, 2, ... from the column's value up.

    Rows that stand for very many go out in blocks, so no task writes all copies of one.
    """
    columns = [c for c in counted.columns if c not in (number, copy)]
    few = counted.where(F.col(number) <= COPY_BLOCK).withColumn("_block", F.lit(0).cast("bigint"))
    starts = F.sequence(F.lit(0).cast("bigint"), F.col(number) - 1, F.lit(COPY_BLOCK).cast("bigint"))
    many = counted.where(F.col(number) > COPY_BLOCK).withColumn("_block", F.explode(starts))
    many = many.repartition("_block", *columns)
    last = F.least(F.col("_block") + COPY_BLOCK, F.col(number))
    copies = F.transform(F.sequence(F.col("_block") + 1, last), lambda k: k + F.col(copy))
    return few.unionByName(many).select(*columns, F.explode(copies).alias(copy))


def number_copies(df: DataFrame, keys: Sequence[str], copy: str = "copy") -> DataFrame:
    """``df`` with the number of every row among those of its key: 1, 2, and so on.

    Equal rows are counted, not compared, and rows of a key that differ are ordered by
    a hash of their other columns and by these. So the numbers of a repeated run are the
    same, no order of the input matters, and no key is numbered in one task: it is cut
    into chunks of the hash, each numbered on its own and shifted by those before it.
    """
    keys, n = list(keys), "_n"
    rest = [c for c in df.columns if c not in keys]
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(n))
    if not rest:
        return expand_copies(rows.withColumn(copy, F.lit(0).cast("bigint")), n, copy).select(*df.columns, copy)
    rows = rows.withColumn("_hash", F.xxhash64(*rest))
    rows = rows.withColumn("_chunk", F.shiftrightunsigned("_hash", 64 - CHUNK_BITS))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*keys, "_chunk").agg(F.sum(n).alias("_sum"))
    shifts = sums.select(
        *[F.col(k).alias(f"_of_{k}") for k in [*keys, "_chunk"]],
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_shift"),
    )
    inside = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy("_hash", *rest)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = rows.withColumn("_inside", F.coalesce(F.sum(n).over(inside), F.lit(0)))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in [*keys, "_chunk"]])
    first = (F.col("_inside") + F.col("_shift")).alias(copy)
    return expand_copies(rows.join(shifts, same).select(*df.columns, n, first), n, copy).select(*df.columns, copy)


def slot_counts(df: DataFrame, slot_cols: Sequence[str]) -> DataFrame:
    """Rows per slot."""
    return df.groupBy(*slot_cols).agg(F.count(F.lit(1)).alias("n_rows"))


def outcome_counts(df: DataFrame, col: str = "outcome") -> DataFrame:
    """Rows per outcome."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))
