"""Levels that never fall below zero, month by month: what a month does to a level is a value that composes.

A day turns a level x into max(0, x + net). Days in a row turn it into max(x + shift, floor) for two numbers, and two
such functions after each other are one again. So a month is summed up on its own, whatever the level before it; the
months of a key are put together by running sums; and a month's days follow from the level it opens with. No task ever
holds more than a month's days or a key's months, and a late booking needs no month before its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stowage.functions.numbers import MEASURE

STATE = ["shift", "floor", "opening", "closing"]


def _month(on: str) -> Column:
    return F.trunc(on, "MM").alias("month")


def month_functions(days: DataFrame, on: str, net: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, month, ``shift``, ``floor``): a month turns the level x into max(x + shift, floor).

    ``days`` has one row per (keys, ``on``). The floor is the largest sum of the days behind some day of the month.
    """
    rows = days.select(*keys, on, _month(on), F.col(net).cast(MEASURE).alias("_net"))
    so_far = Window.partitionBy(*keys, "month").orderBy(on).rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.withColumn("_sum", F.sum("_net").over(so_far)).groupBy(*keys, "month")
    return sums.agg(F.sum("_net").alias("shift"), (F.sum("_net") - F.min("_sum")).alias("floor"))


def month_states(functions: DataFrame, keys: Sequence[str] = (), opening: DataFrame | None = None) -> DataFrame:
    """``functions`` with the level each month opens and closes with.

    ``opening`` names the level of each key before its first month in a column ``opening`` (zero where it has none).
    The windows hold one row per month of a key.
    """
    first = F.lit(0).cast(MEASURE)
    if opening is not None:
        functions = functions.join(opening.select(*keys, F.col("opening").cast(MEASURE).alias("_opening")), list(keys), "left")
        first = F.coalesce("_opening", first)
    months = Window.partitionBy(*keys).orderBy("month")
    upto = months.rowsBetween(Window.unboundedPreceding, 0)
    shifted = functions.withColumn("_shifted", F.sum("shift").over(upto))
    closing = F.col("_shifted") + F.greatest(first, F.max(F.col("floor") - F.col("_shifted")).over(upto))
    states = shifted.withColumn("closing", closing.cast(MEASURE))
    opens = F.coalesce(F.lag("closing").over(months), first).cast(MEASURE)
    return states.withColumn("opening", opens).select(*keys, "month", *[F.col(c).cast(MEASURE).alias(c) for c in STATE])


def levels_in_months(days: DataFrame, states: DataFrame, on: str, net: str, keys: Sequence[str] = (), name: str = "level") -> DataFrame:
    """``days`` with the level at the end of each, from the level its month opens with."""
    rows = days.withColumn("month", _month(on))
    opened = rows.join(states.select(*keys, "month", F.col("opening").alias("_opening")), [*keys, "month"])
    so_far = Window.partitionBy(*keys, "month").orderBy(on).rowsBetween(Window.unboundedPreceding, 0)
    running = opened.withColumn("_sum", F.col("_opening") + F.sum(F.col(net).cast(MEASURE)).over(so_far))
    level = F.col("_sum") - F.least(F.lit(0), F.min("_sum").over(so_far))
    return running.withColumn(name, level).select(*days.columns, name)


def rebooked(
    states: DataFrame, days: DataFrame, since, on: str, net: str, keys: Sequence[str] = (), opening: DataFrame | None = None
) -> DataFrame:
    """The states after late bookings on or after the month of ``since``.

    ``days`` has the days from that month on, late bookings included; older ones are not read. Months before it keep
    their stored states, and the last of them says what a key goes on from (``opening``, as in ``month_states``,
    where it has none).
    """
    month = F.trunc(F.lit(since).cast("date"), "MM")
    old = states.filter(F.col("month") < month)
    last = old.groupBy(*keys).agg(F.max_by("closing", "month").alias("_last"))
    late = days.filter(_month(on) >= month)
    functions = month_functions(late, on, net, keys)
    if keys:
        start = functions.select(*keys).distinct().join(last, list(keys), "left")
        if opening is not None:
            start = start.join(opening.select(*keys, F.col("opening").alias("_given")), list(keys), "left")
        given = F.col("_given") if opening is not None else F.lit(None)
        start = start.select(*keys, F.coalesce("_last", given, F.lit(0)).cast(MEASURE).alias("opening"))
        return old.unionByName(month_states(functions, keys, start))
    given = opening.select(F.max("opening")).scalar() if opening is not None else F.lit(None)
    first = F.coalesce(last.select("_last").scalar(), given, F.lit(0)).cast(MEASURE)
    added = month_states(functions.withColumn("_one", F.lit(1)), ["_one"], functions.select(F.lit(1).alias("_one")).distinct().withColumn("opening", first))
    return old.unionByName(added.drop("_one"))


def level_at(
    levels: DataFrame, requests: DataFrame, key: str, on: str, level: str = "level_cbm", opening: DataFrame | None = None
) -> DataFrame:
    """``requests`` with the level of their ``key`` at the end of their day.

    ``levels`` has ``key``, ``date``, ``valid_until`` (null: still holds) and the level, as ``level_by_client`` gives
    them. Every level is listed once per month it holds in, up to the last month asked for, and meets the requests of
    that key and month: of these, the range that holds the day. Before a key's first movement its ``opening`` holds
    (column ``opening``; zero where it has none); a request without key or day has no level. Neither keys by days nor
    all days of a key are ever formed, and a key that is asked for very often is split like any hot key of a join.
    """
    asked = requests.withColumns({"_month": F.trunc(on, "MM"), "_day": F.to_date(on)})
    last = requests.agg(F.max(F.to_date(on))).scalar()
    held = levels.select(F.col(key).alias("_key"), F.to_date("date").alias("_from"), F.col("valid_until").alias("_until"), F.col(level).alias("_level"))
    held = held.filter(F.col("_from") <= last).withColumn("_until", F.least(F.coalesce("_until", last), last))
    months = F.sequence(F.trunc("_from", "MM"), F.trunc("_until", "MM"), F.expr("interval 1 month"))
    held = held.withColumn("_in", F.explode(months))
    same = (F.col(key) == F.col("_key")) & (F.col("_month") == F.col("_in")) & F.col("_day").between(F.col("_from"), F.col("_until"))
    found = asked.join(held, same, "left")
    before = F.lit(0).cast(MEASURE)
    if opening is not None:
        given = opening.select(F.col(key).alias("_open_key"), F.col("opening").cast(MEASURE).alias("_opening"))
        found = found.join(given, F.col(key) == F.col("_open_key"), "left")
        before = F.coalesce("_opening", before)
    known = F.col(key).isNotNull() & F.col("_day").isNotNull()
    return found.withColumn(level, F.when(known, F.coalesce("_level", before))).select(*requests.columns, level)
