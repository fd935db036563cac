"""Fixed-length calendar windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_DAYS = 30


def window_of(day: Column, start: Column, end: Column, days: int = WINDOW_DAYS) -> Column:
    """The window (start, end, number) that holds `day`, or null.

    Windows follow each other from `start`; a window opens only while its first day lies before
    `end`, so an exact multiple leaves out the end day. The window is computed from the day, so
    rows never need a join with a list of windows.
    """
    number = F.floor(F.datediff(day, start) / days).cast("int")
    first = F.date_add(start, number * days)
    window = F.struct(
        first.alias("window_start"),
        F.least(F.date_add(first, days - 1), end).alias("window_end"),
        (number + 1).alias("window_no"),
    )
    return F.when((day >= start) & (day <= end) & (first < end), window)


def windows_between(df: DataFrame, start: str, end: str, days: int = WINDOW_DAYS) -> DataFrame:
    """One row per window of each input row; none where start >= end."""
    open_days = F.sequence(F.col(start), F.date_sub(F.col(end), 1), F.expr(f"interval {days} days"))
    return (
        df.filter(F.col(start) < F.col(end))
        .select("*", F.posexplode(open_days).alias("_n", "window_start"))
        .withColumn("window_end", F.least(F.date_add("window_start", days - 1), F.col(end)))
        .withColumn("window_no", F.col("_n") + 1)
        .drop("_n")
    )
