"""Ragged lists of activities per contact, widened into columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Activities per row of a paged wide table. Five columns each stay within a
# thousand columns, the width a SQL Server table may have.
SLOTS_PER_ROW = 200
# A contact with more than this share of all activities is numbered in chunks.
HOT_SHARE = 0.001
CHUNKS = 1000
# Keys that the summary of heavy hitters tracks; its error is below a tenth of HOT_SHARE.
TRACKED = 1 << 16

# Titles of the five columns every activity takes, and the source
# column each is filled from.
ACTIVITY_COLUMNS = {
    "Subject": "subject",
    "Type": "type",
    "Created On": "created_on",
    "Created By": "created_by",
    "Description": "description",
}
# Titles of the columns that describe the contact.
CONTACT_COLUMNS = {
    "Owner": "owner",
    "Contact": "contact",
    "Account": "account",
    "Lead Source": "lead_source",
}


def group_sizes(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


def max_group_size(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of the largest group."""
    return group_sizes(df, key).agg(F.max("n_rows").alias("max_rows"))


def _chunk_points(df: DataFrame, keys: list[str], order: str) -> tuple[list[int], list] | None:
    """Hashes of the hot keys and cut points of the order column, or None without hot keys.

    One pass and one row: heavy hitters and quantiles are summaries of bounded size
    that tasks merge. Every key above ``HOT_SHARE`` is among the hitters, since they
    are tracked to a much smaller share; a further key among them does no harm. The
    cut points are those of all rows: between two of them no key can have more than
    all rows there. They come to the driver to be the same wherever they are used.
    """
    points = [i / CHUNKS for i in range(1, CHUNKS)]
    most = int(2 / HOT_SHARE)
    hitters = F.expr(f"approx_top_k(_key, {most}, {TRACKED})")
    seen = (
        df.select(F.xxhash64(*keys).alias("_key"), F.col(order).alias("_order"))
        .agg(
            F.count(F.lit(1)).alias("total"),
            hitters.alias("hitters"),
            F.percentile_approx("_order", points, 10 * CHUNKS).alias("points"),
        )
        .first()
    )
    least = max(seen["total"] * HOT_SHARE * 0.9, SLOTS_PER_ROW)
    hot = sorted(h["item"] for h in seen["hitters"] or [] if h["count"] > least)
    return (hot, seen["points"] or []) if hot else None


def _same(keys: Sequence[str], prefix: str) -> Column:
    """Equality of the keys with their prefixed names; NULL equals NULL."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def number_activities(
    df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str | Column] = ()
) -> DataFrame:
    """Add ``slot``: 1 for the first activity of a key, 2 for the next, and so on.

    Equal order values are told apart by a hash of the ``ties`` columns, then by
    the columns themselves. Keys with a large share of the rows are cut into
    chunks of that order; each chunk is numbered on its own and shifted by the
    sizes of the chunks before it, so no task sees more than a chunk.
    """
    keys = list(keys)
    tie_hash = F.xxhash64(*ties) if ties else F.lit(0).cast("bigint")
    by_order = [F.col(order), tie_hash, *ties]
    summary = _chunk_points(df, keys, order)
    if summary is None:
        number = F.row_number().over(Window.partitionBy(*keys).orderBy(*by_order))
        return df.withColumn("slot", number.cast("bigint"))
    hot, points = summary
    spark = df.sparkSession
    cut = f"_points array<{df.schema[order].dataType.simpleString()}>"
    # one row for each of the hot keys
    flags = spark.createDataFrame([(h, points) for h in hot], f"_hot_key bigint, {cut}")
    flagged = df.withColumn("_key", F.xxhash64(*keys)).join(
        F.broadcast(flags), F.col("_key") == F.col("_hot_key"), "left"
    )
    flagged = flagged.withColumn("_hot", F.col("_hot_key").isNotNull()).drop("_key", "_hot_key")
    below = F.size(F.filter("_points", lambda b: b < F.col(order)))
    # a value that fills several cut points is spread over as many chunks by its hash
    filled = F.size(F.filter("_points", lambda b: b == F.col(order)))
    spread = F.floor((tie_hash / F.lit(2.0**64) + 0.5) * filled)
    chunk = below + F.least(spread, F.greatest(filled - 1, F.lit(0)))
    # rows without an order value come first, spread by their hash as well
    unordered = F.floor((tie_hash / F.lit(2.0**64) + 0.5) * (CHUNKS - 1))
    chunk = F.when(F.col(order).isNull(), unordered).otherwise(CHUNKS + chunk)
    chunked = flagged.withColumn("_chunk", F.when(F.col("_hot"), chunk).otherwise(F.lit(0)).cast("int"))
    counts = chunked.where("_hot").groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    chunked = chunked.drop("_points", "_hot")
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.select(
        *[F.col(k).alias(f"_at_{k}") for k in keys], F.col("_chunk").alias("_at__chunk"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    in_chunk = F.row_number().over(Window.partitionBy(*keys, "_chunk").orderBy(*by_order))
    # offsets: at most 2 * CHUNKS rows for each of the hot keys
    return (
        chunked.withColumn("_number", in_chunk)
        .join(F.broadcast(offsets), _same([*keys, "_chunk"], "_at_"), "left")
        .select(*df.columns, (F.col("_number") + F.coalesce("_offset", F.lit(0))).alias("slot"))
    )


def widen(
    df: DataFrame,
    key_cols: Mapping[str, str],
    order: str,
    value_cols: Mapping[str, str],
    slots_per_row: int | None = None,
    count_by: Sequence[str] | None = None,
) -> DataFrame:
    """One row per contact with the columns of every activity side by side.

    ``key_cols`` and ``value_cols`` map title to source column. The columns of
    the i-th activity in ``order`` are titled ``"i <title>"``; contacts with
    fewer activities have NULLs there. Without ``slots_per_row`` a contact is one
    row and the widest contact, one number, decides how many columns there are;
    ``count_by`` names the source columns that make a contact for that number (all
    of ``key_cols`` by default). A contact with several owners is a row for each of
    them, so counted by contact alone the last columns may be empty in every row.
    With it (``SLOTS_PER_ROW`` is a good choice) there are always a ``Page`` column
    and columns for so many activities: contacts go on over further rows, so the
    columns depend on the arguments alone and no row grows without bound.
    """
    keys, values = list(key_cols.values()), list(value_cols.values())
    rows = df.select(*dict.fromkeys([*keys, order, *values]))
    titled_keys = [F.col(c).alias(t) for t, c in key_cols.items()]
    if slots_per_row is None:
        widest = max_group_size(df, count_by or keys).first()["max_rows"]
        n, pages, group = widest or 0, [], keys
    else:
        rows = number_activities(rows, keys, order, ties=values)
        rows = rows.withColumn(
            "Page", F.floor((F.col("slot") - 1) / slots_per_row).cast("int") + 1
        )
        n, pages, group = slots_per_row, [F.col("Page")], [*keys, "Page"]
    # a group holds a contact, or at most slots_per_row of its rows
    position = [order, *[c for c in values if c != order]]
    wide = rows.groupBy(*group).agg(
        F.sort_array(F.collect_list(F.struct(*position))).alias("_list")
    )
    slots = [
        F.get("_list", F.lit(i - 1))[c].alias(f"{i} {title}")
        for i in range(1, n + 1)
        for title, c in value_cols.items()
    ]
    return wide.select(*titled_keys, *pages, *slots)
