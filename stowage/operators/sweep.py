"""A sweep over start and end times: how many intervals run at once, without comparing any two.

Every interval gives an event where it starts and one where it ends. Events of one instant are summed first, so a
window holds one row per instant of a key: for a day with times in seconds, at most 86,400.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def instants(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """(keys, ``at``, ``until``, ``running``): from each instant to the next, how many intervals run.

    Intervals that end where they start, or earlier, or lack a key or a time, run nowhere.
    """
    runs = df.filter(F.col(start) < F.col(end)).dropna(subset=list(keys))
    event = F.explode(F.array(F.struct(F.col(start).alias("at"), F.lit(1).alias("n")), F.struct(F.col(end).alias("at"), F.lit(-1).alias("n"))))
    events = runs.select(*keys, event.alias("_e")).groupBy(*keys, F.col("_e.at").alias("at")).agg(F.sum("_e.n").alias("_n"))
    in_key = Window.partitionBy(*keys).orderBy("at")
    running = F.sum("_n").over(in_key.rowsBetween(Window.unboundedPreceding, 0))
    return events.select(*keys, "at", F.lead("at").over(in_key).alias("until"), running.alias("running"))


def concurrency(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """(keys, ``from_time``, ``to_time``, ``running``): stretches in which the same number, at least one, runs."""
    found = instants(df, keys, start, end).filter("running > 0")
    return found.select(*keys, F.col("at").alias("from_time"), F.col("until").alias("to_time"), "running")


def peaks(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Per key: ``peak`` (the most that run at once), ``peak_from`` (when first), ``peak_hours`` (how long in all),
    ``busy_hours`` (with at least one) and ``task_hours`` (all lengths added)."""
    found = instants(df, keys, start, end).filter("running > 0")
    found = found.withColumn("_s", F.unix_micros("until") - F.unix_micros("at"))
    # the stretches of a key are first summed by how many run, which bounds what is compared for the peak
    by_running = found.groupBy(*keys, "running").agg(F.min("at").alias("_from"), F.sum("_s").alias("_s"))
    hours = lambda c: c / F.lit(3.6e9)
    return by_running.groupBy(*keys).agg(
        F.max("running").alias("peak"), F.max_by("_from", "running").alias("peak_from"),
        hours(F.max_by("_s", "running")).alias("peak_hours"), hours(F.sum("_s")).alias("busy_hours"),
        hours(F.sum(F.col("_s") * F.col("running"))).alias("task_hours"),
    )


def time_overlapped(df: DataFrame, keys: Sequence[str], start: str, end: str, name: str = "overlapped_seconds") -> DataFrame:
    """``df`` with the seconds of each interval during which another of its key runs too.

    At every instant the overlapped time so far is a running sum; an interval's own is the difference between its end
    and its start, two joins by key and instant. Intervals that run nowhere have zero.
    """
    points = instants(df, keys, start, end)
    so_far = Window.partitionBy(*keys).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    shared = F.when(F.col("running") > 1, F.unix_micros("until") - F.unix_micros("at")).otherwise(0)
    points = points.select(*keys, "at", F.coalesce(F.sum(shared).over(so_far), F.lit(0)).alias("_sum"))
    first = points.withColumnsRenamed({"at": start, "_sum": "_first"})
    last = points.withColumnsRenamed({"at": end, "_sum": "_last"})
    joined = df.join(first, [*keys, start], "left").join(last, [*keys, end], "left")
    # a time that is only some other interval's instant is none of an interval that runs nowhere
    runs = F.col(start) < F.col(end)
    seconds = F.when(runs, (F.col("_last") - F.col("_first")) / F.lit(1e6))
    return joined.withColumn(name, F.coalesce(seconds, F.lit(0.0))).select(*df.columns, name)
