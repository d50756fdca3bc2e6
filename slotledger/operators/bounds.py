"""Checks of size before data is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def at_most(df: DataFrame, rows: int) -> DataFrame | None:
    """``df`` to be broadcast if it has no more than ``rows`` rows, else None.

    Counting stops once the bound is passed, so a large table costs as little to ask.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else None
