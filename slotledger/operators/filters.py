"""Row filters and projections of the disk, counter and event sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger.functions.text import like_ci, mb_to_gb, trim

# Name patterns that select CPU and memory counters, and disk
# labels and types that are not storage.
CPU_COUNTER_NAMES = (r"%\%%Process%", r"%Process%\%%Time")
MEM_COUNTER_NAMES = ("% bytes in use%",)
SWAP_LABELS = ("%pagefile%", "%page file%", "%Swap%")


def _any_like(col: Column, patterns: tuple[str, ...]) -> Column:
    hit = like_ci(col, patterns[0])
    for pattern in patterns[1:]:
        hit = hit | like_ci(col, pattern)
    return hit


def is_cpu_counter(name: Column) -> Column:
    return _any_like(name, CPU_COUNTER_NAMES)


def is_mem_counter(name: Column) -> Column:
    return _any_like(name, MEM_COUNTER_NAMES)


def cpu_counters(counters: DataFrame) -> DataFrame:
    return counters.where(is_cpu_counter(F.col("name")))


def mem_counters(counters: DataFrame) -> DataFrame:
    return counters.where(is_mem_counter(F.col("name")))


def where_group(
    df: DataFrame, result_group: int | None = 1, locked: int | None = None
) -> DataFrame:
    """Rows of one audit result group, optionally of one lock state."""
    if result_group is not None:
        df = df.where(F.col("resultGroup") == result_group)
    if locked is not None:
        df = df.where(F.col("locked") == locked)
    return df


def is_weekly_disk() -> Column:
    """Fixed disks, and removable ones with a size, that are not page files."""
    kind = F.col("type")
    return (
        (kind == "Fixed") | ((kind == "Removable") & (F.col("totalMBytes") > 0))
    ) & ~like_ci(F.col("volumeName"), "%page file%")


def weekly_disk_filter(disks: DataFrame) -> DataFrame:
    return disks.where(is_weekly_disk())


def current_disk_filter(disks: DataFrame) -> DataFrame:
    """Disks with a size that are neither optical drives nor swap space."""
    return disks.where(
        (F.col("totalMBytes") > 0)
        & ~like_ci(F.col("type"), "%CDROM%")
        & ~_any_like(F.col("volumeName"), SWAP_LABELS)
    )


def disk_projection(disks: DataFrame) -> DataFrame:
    """Trimmed names and sizes in GB, keeping the audit columns."""
    return disks.select(
        F.col("agentGuid").alias("AgentGUID"),
        F.col("resultGroup").alias("ResultGroup"),
        F.col("locked").alias("Locked"),
        trim(F.col("driveLetter")).alias("DriveName"),
        trim(F.col("volumeName")).alias("DiskLabel"),
        mb_to_gb(F.col("totalMBytes")).alias("TotalSpaceGB"),
        mb_to_gb(F.col("freeMBytes")).alias("FreeSpaceGB"),
    )


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """NULLs replaced, column by column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
