"""Time series of at most one row per day and key: levels, months, changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stowage.functions.numbers import change_percent


def clamped_level(
    df: DataFrame, on: str, net: Column, opening: Column | float = 0, keys: Sequence[str] = (), name: str = "level"
) -> DataFrame:
    """Running level ``max(0, level + net)`` from ``opening``; ``df`` has one row per (keys, on).

    The level is the running sum less its lowest point so far (if that is below zero), so it needs
    no row loop. The windows hold one row per day and key, which the calendar bounds.
    """
    so_far = Window.partitionBy(*keys).orderBy(on).rowsBetween(Window.unboundedPreceding, 0)
    opening = opening if isinstance(opening, Column) else F.lit(opening)
    running = df.withColumn("_sum", opening + F.sum(net).over(so_far))
    lowest = F.least(F.lit(0), F.min("_sum").over(so_far))
    return running.withColumn(name, F.col("_sum") - lowest).drop("_sum")


def days_between(bounds: DataFrame, first: str, last: str, name: str = "date") -> DataFrame:
    """One row per calendar day from ``first`` to ``last`` of a one-row table."""
    return bounds.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias(name))


def month_ends(bounds: DataFrame, first: str, last: str, name: str = "month_end") -> DataFrame:
    """The last day of every month that the range touches."""
    months = F.sequence(F.trunc(first, "MM"), F.trunc(last, "MM"), F.expr("interval 1 month"))
    return bounds.select(F.explode(F.transform(months, F.last_day)).alias(name))


def resample_months(df: DataFrame, on: str, sums: Sequence[str], lasts: Sequence[str] = ()) -> DataFrame:
    """Calendar months of a daily series, empty months included (sums 0, last values null)."""
    per_month = df.groupBy(F.last_day(on).alias("month_end")).agg(
        *[F.sum(c).alias(c) for c in sums], *[F.max_by(c, on).alias(c) for c in lasts]
    )
    bounds = df.agg(F.min(on).alias("lo"), F.max(on).alias("hi")).dropna()
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in sums}
    return month_ends(bounds, "lo", "hi").join(per_month, "month_end", "left").withColumns(zero)


def with_previous(df: DataFrame, value: str, on: str, name: str = "previous") -> DataFrame:
    """The value of the row before, in a series of one row per month."""
    return df.withColumn(name, F.lag(value).over(Window.orderBy(on)))


def change_within_key(df: DataFrame, value: str, key: str, day: str, then: str, name: str = "change_pct") -> DataFrame:
    """Percent change against the row before of the same key, ordered by (day, then).

    Rows of one day are compared inside that day; only the first row of a day looks at the last
    value of the key's previous day, which comes from a table of one row per key and day. So no
    task ever holds all rows of a key.
    """
    within = Window.partitionBy(key, day).orderBy(then)
    days = df.groupBy(key, day).agg(F.max_by(value, then).alias("_closing"))
    carried = F.lag("_closing").over(Window.partitionBy(key).orderBy(day))
    days = days.select(key, day, carried.alias("_carried"))
    rows = df.withColumns({"_prev": F.lag(value).over(within), "_first": F.row_number().over(within) == 1})
    before = F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_prev"))
    return (
        rows.join(days, [key, day], "left")
        .withColumn(name, change_percent(F.col(value), before))
        .select(*df.columns, name)
    )
