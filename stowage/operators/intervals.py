"""Groups of overlapping intervals ("islands") and what their members share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(
    df: DataFrame, keys: Sequence[str], start: str, end: str, touching: bool = False, **measures: Column
) -> DataFrame:
    """Overlap groups per key and start time, one row per distinct (keys, start).

    ``df`` should hold intervals of positive length. Result: keys, start, ``island`` (running
    number), and per island ``island_start``, ``island_end``, ``union_micros``, ``tasks``,
    ``task_micros`` and each of ``measures`` (an aggregate combined by its maximum).

    Rows are first combined per start time, so a window never holds more rows than there are
    distinct starts per key: for a worker's day with times in seconds, at most 86,400.
    Two intervals that merely touch are one island only with ``touching=True``.
    """
    starts = df.groupBy(*keys, start).agg(
        F.max(end).alias("_end"),
        F.count("*").alias("_tasks"),
        F.sum(F.unix_micros(end) - F.unix_micros(F.col(start))).alias("_micros"),
        *[c.alias(n) for n, c in measures.items()],
    )
    in_key = Window.partitionBy(*keys).orderBy(start)
    reach = F.max("_end").over(in_key.rowsBetween(Window.unboundedPreceding, -1))
    # The two window steps share one sort; the island windows below reuse the same partitioning.
    starts = starts.withColumn("_reach", reach)
    gap = (F.col(start) > F.col("_reach")) if touching else (F.col(start) >= F.col("_reach"))
    number = F.sum(F.when(F.col("_reach").isNull() | gap, 1).otherwise(0)).over(
        in_key.rowsBetween(Window.unboundedPreceding, 0)
    )
    whole = Window.partitionBy(*keys, "island")
    return (
        starts.withColumn("island", number)
        .withColumns(
            {
                "island_start": F.min(start).over(whole),
                "island_end": F.max("_end").over(whole),
                "tasks": F.sum("_tasks").over(whole),
                "task_micros": F.sum("_micros").over(whole),
                **{n: F.max(n).over(whole) for n in measures},
            }
        )
        .withColumn("union_micros", F.unix_micros("island_end") - F.unix_micros("island_start"))
        .drop("_end", "_tasks", "_micros", "_reach")
    )


def union_length(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Hours covered by at least one interval, per key."""
    whole = islands(df, keys, start, end, touching=True).select(*keys, "island", "union_micros").distinct()
    return whole.groupBy(*keys).agg((F.sum("union_micros") / F.lit(3.6e9)).alias("covered_hours"))


def overlap_groups(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """One row per island of at least two tasks, with the hours that were counted twice.

    A summary per island; the overlapping pairs themselves are never formed.
    """
    return (
        islands(df, keys, start, end)
        .filter("tasks > 1")
        .select(*keys, "island_start", "island_end", "tasks", "task_micros", "union_micros")
        .distinct()
        .withColumn("double_hours", (F.col("task_micros") - F.col("union_micros")) / F.lit(3.6e9))
    )
