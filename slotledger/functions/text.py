"""Text and number columns used by the jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotledger.functions.calendar import in_calendar

# Units a memory size may carry, in the order they are tried, with
# what one unit is in MB (multiplier, divisor).
SIZE_UNITS = (("MB", 1, 1), ("GB", 1024, 1), ("TB", 1024 * 1024, 1), ("KB", 1, 1024))


def trim(col: Column) -> Column:
    """Blanks removed on both ends."""
    return F.trim(col)


def replace(col: Column, old: str, new: str) -> Column:
    """Every occurrence of a literal replaced."""
    return F.replace(col, F.lit(old), F.lit(new))


def left(col: Column, n: int) -> Column:
    return F.substring(col, 1, n)


def contains_ci(col: Column, text: str) -> Column:
    """True where ``text`` occurs in any letter case."""
    return F.upper(col).contains(text.upper())


def like_ci(col: Column, pattern: str) -> Column:
    r"""LIKE in any letter case; a literal percent sign is written ``\%``."""
    return col.ilike(pattern)


def mb_to_gb(col: Column) -> Column:
    return col.cast("double") / F.lit(1024.0)


def coalesce(col: Column, default) -> Column:
    return F.coalesce(col, F.lit(default))


def near(a: Column, b: Column, tolerance: float) -> Column:
    """True where two numbers differ by less than the tolerance."""
    return F.abs(a - b) < F.lit(tolerance)


def null_or_equal(a: Column, b: Column) -> Column:
    """``a IS NULL OR a = b`` (three-valued, not null-safe equality)."""
    return a.isNull() | (a == b)


def strip_separators(col: Column) -> Column:
    """A date argument without backslash, slash and dash."""
    return F.translate(col, "\\/-", "")


# Texts of the right shape; only these are cast, since a cast that fails is slow.
WHOLE_NUMBER = "^[+-]?[0-9]+$"
UNSIGNED_NUMBER = "^[0-9]+$"
EIGHT_DIGIT_DATE = "^[0-9]{4}(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])$"


def parse_date(col: Column) -> Column:
    """DATE from ``yyyymmdd`` in any blanks, NULL for anything else or outside the calendar."""
    col = F.trim(col)
    dashed = F.concat_ws(
        "-", F.substring(col, 1, 4), F.substring(col, 5, 2), F.substring(col, 7, 2)
    )
    day = F.when(col.rlike(EIGHT_DIGIT_DATE), dashed.try_cast("date"))
    return F.when(in_calendar(day), day)


def is_date(col: Column) -> Column:
    return parse_date(col).isNotNull()


def parse_int(col: Column) -> Column:
    """BIGINT from an unsigned whole number, NULL for anything else."""
    text = F.trim(col)
    return F.when(text.rlike(UNSIGNED_NUMBER), text.try_cast("bigint"))


def is_int(col: Column) -> Column:
    return F.trim(col).rlike(UNSIGNED_NUMBER)


def size_to_mb(col: Column) -> Column:
    """Whole megabytes of a size such as ``2GB``; no unit means MB.

    The first unit of ``SIZE_UNITS`` found in the text decides. NULL where the
    rest of the text is not a whole number; blank text counts as 0.
    """
    text = F.upper(F.trim(col))
    unit = reduce(
        lambda acc, u: acc.when(text.contains(u[0]), u[0]), SIZE_UNITS, F
    ).otherwise("")
    rest = F.trim(F.replace(text, unit, F.lit("")))
    number = F.when(rest == "", F.lit(0).cast("bigint")).when(
        rest.rlike(WHOLE_NUMBER), rest.try_cast("bigint")
    )
    times = reduce(
        lambda acc, u: acc.when(unit == u[0], u[1]), SIZE_UNITS, F
    ).otherwise(1)
    per = reduce(lambda acc, u: acc.when(unit == u[0], u[2]), SIZE_UNITS, F).otherwise(1)
    return F.call_function("div", F.try_multiply(number, times.cast("bigint")), per.cast("bigint"))


def limit_message(col: Column, n: int) -> Column:
    """Message cut to the width of the report column."""
    return left(col, n)
