"""Slotted reporting jobs over monitoring logs and inventory tables, on Spark.

Everything here is a function from DataFrames to DataFrames: requests become
date slots, logs are pruned to those slots, rolled up or de-duplicated, and the
rows a report table does not hold yet are appended to it.
"""

__all__ = [
    "functions",
    "operators",
    "plans",
    "schemas",
    "sinks",
    "sources",
]
