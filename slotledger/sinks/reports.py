"""Creating the report tables and appending to them."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotledger.functions.calendar import AsOf, as_timestamp
from slotledger.operators.merge import number_copies
from slotledger.schemas import COMPONENT_REPORTS, CPU, INSERTED, REPORTS, Report
from slotledger.sinks.publish import (
    OUTCOME,
    PATH_PROPERTY,
    REPORT,
    TIMES,
    publish,
    report_path,
    run_name,
)


# File names have five digits.
MOST_FILES = 100_000

# Column with the number of a row among those of its key, where a job has counted them.
COPY = "copy"


def rec_id(keys: Sequence[str], copy: Column | None = None) -> Column:
    """Stable key of a row: MD5 over its key values, and its number ``copy`` from the second row of a key on.

    Without numbers rows with equal keys share it: a drive that two runs of the
    current disk report append in one week.

    Values are escaped, so neither NULLs nor a separator inside a value can make
    two different keys look alike.
    """

    def part(c: str) -> Column:
        text = F.col(c).cast("string")
        escaped = F.replace(
            F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")
        )
        return F.coalesce(escaped, F.lit("\\N"))

    first = F.concat_ws("|", *[part(c) for c in keys])
    if copy is None:
        return F.md5(first)
    # in an escaped value no digit follows a single backslash, so no other key looks like this
    return F.md5(F.when(copy > 1, F.concat_ws("|\\", first, copy.cast("string"))).otherwise(first))


def with_rec_id(df: DataFrame, keys: Sequence[str], copies: bool = False) -> DataFrame:
    """``df`` with ``RecID``; with ``copies`` rows of one key have different ones, the same on every run."""
    if not copies:
        return df.withColumn("RecID", rec_id(keys))
    numbered = number_copies(df, keys, COPY)
    return numbered.withColumn("RecID", rec_id(keys, F.col(COPY))).drop(COPY)


def to_report(df: DataFrame, report: Report, as_of: AsOf, *extra: Column) -> DataFrame:
    """The stored form of new rows: declared columns and types, key, load time; ``extra`` columns first.

    Rows that carry their number as ``copy`` have it in their key.
    """
    copy = [F.col(COPY)] if COPY in df.columns else []
    typed = df.select(
        *extra,
        *copy,
        *[
            F.col(c).cast(report.columns[c].dataType).alias(c)
            for c in report.business_columns
        ],
    )
    others = [c for c in typed.columns if c not in (*report.business_columns, COPY)]
    full = typed.withColumn("RecID", rec_id(report.keys, *copy)).withColumn(
        "RecCreatedOn", as_timestamp(as_of)
    )
    if report.slot_of is not None:
        full = full.withColumn("SlotDate", F.to_date(report.slot_of))
    return full.select(*others, *report.stored.names)


def judged_rows(
    df: DataFrame, report: Report, as_of: AsOf, name: Column | None = None
) -> DataFrame:
    """Rows with an ``outcome`` as they are staged: those not inserted keep only it and their number.

    ``times`` says how many rows one stands for, one where ``df`` has no such
    column; ``name`` is the report of a row where it is not ``report``.
    """
    inserted = F.col(OUTCOME) == INSERTED
    extra = {REPORT: F.lit(report.name) if name is None else name, OUTCOME: F.col(OUTCOME)}
    extra[TIMES] = F.col(TIMES) if TIMES in df.columns else F.lit(1).cast("bigint")
    stored = to_report(df, report, as_of, *[c.alias(n) for n, c in extra.items()])
    return stored.select(
        *extra, *[F.when(inserted, F.col(c)).alias(c) for c in report.stored.names]
    )


def append_report(df: DataFrame, directory: str, name: str, as_of: AsOf) -> int:
    """Append rows to a report, all or none, and return how many there were.

    Rows are rebalanced by partition before the write: small partitions are
    merged into few files, one that holds most of the rows is spread over many
    tasks. Where the report is a registered table, it shows the rows at once.
    """
    return append_rows(df, directory, REPORTS[name], as_of, {name: name})[name]


def append_rows(
    df: DataFrame,
    directory: str,
    report: Report,
    as_of: AsOf,
    named: Mapping[str, str],
    column: str | None = None,
) -> dict[str, int]:
    """Append rows of one layout in a single pass; ``named`` maps what ``column`` holds to reports."""
    name = None
    for value, target in named.items():
        if column is not None:
            test = F.col(column) == value
            name = F.when(test, target) if name is None else name.when(test, target)
    if column is not None:
        df = df.where(F.col(column).isin(*named))
    rows = judged_rows(df.withColumn(OUTCOME, F.lit(INSERTED)), report, as_of, name)
    run = run_name(f"append-{report.name}", as_of, uuid.uuid4())
    counts = publish(df.sparkSession, directory, report, run, lambda: rows, depends=False)
    return {value: counts.get((target, INSERTED), 0) for value, target in named.items()}


def append_components(
    df: DataFrame, directory: str, as_of: AsOf
) -> Mapping[str, int]:
    """Append the rows of ``components_report`` to the report of each component, both or neither.

    One pass writes both, so the log is read once.
    """
    named = {component: report.name for component, report in COMPONENT_REPORTS.items()}
    return append_rows(df, directory, CPU, as_of, named, "component")


def create_report_tables(
    spark: SparkSession, directory: str, replace: bool = False
) -> list[str]:
    """Register the five report tables over ``directory`` and return their names.

    With ``replace`` the stored rows go, except those of the disk report, which
    is only ever created. Without it existing rows are kept and made visible.
    """
    for report in REPORTS.values():
        path = report_path(directory, report.name)
        emptied = replace and not report.keep
        if emptied:
            spark.sql(f"DROP TABLE IF EXISTS {report.name}")
        # no rows: makes the folder, or empties it, whatever the session's overwrite mode
        spark.createDataFrame([], report.stored).write.option("partitionOverwriteMode", "static").mode(
            "overwrite" if emptied else "append"
        ).partitionBy(*report.partition).parquet(path)
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in report.stored.fields
        )
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {report.name} ({columns}) USING parquet "
            f"PARTITIONED BY ({', '.join(report.partition)}) LOCATION '{path}' "
            f"TBLPROPERTIES ('{PATH_PROPERTY}' = '{path}')"
        )
        spark.catalog.recoverPartitions(report.name)
    return list(REPORTS)


def sorted_write(df: DataFrame, path: str, keys: Sequence[str], files: int | None = None) -> None:
    """Write all rows in the order of ``keys``: within each file, and from file to file by name.

    Rows are dealt out by ranges of the keys and, among equal ones, of a hash of the
    row, so that a value that many rows share is spread over as many files as it
    needs. ``files`` is how many there are at most, by default as many as shuffles
    have partitions. The folder is replaced, since files of two writes would mix.
    """
    spark = df.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if files > MOST_FILES:
        raise ValueError(f"names keep their order up to {MOST_FILES} files")
    order = [*[F.col(c).asc_nulls_first() for c in keys], F.xxhash64(*df.columns)]
    ranged = df.repartitionByRange(files, *order).sortWithinPartitions(*order)
    ranged.write.mode("overwrite").option("maxRecordsPerFile", 0).parquet(path)


def write_wide(df: DataFrame, path: str) -> None:
    """Replace the wide activity table."""
    df.write.mode("overwrite").parquet(path)
