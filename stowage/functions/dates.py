"""Dates: coercing parses, months, day and hour differences."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted day-first spellings, tried in this order.
DAY_FIRST = ["d-M-yyyy", "d-M-yy", "d/M/yyyy", "d/M/yy"]


def parse_timestamp(c: Column, formats: Iterable[str] = ()) -> Column:
    """ISO text (or one of ``formats``) as timestamp; anything else is null."""
    tries = [F.try_to_timestamp(c, F.lit(f)) for f in formats] or [F.try_to_timestamp(c)]
    return F.coalesce(*tries)


def parse_day_first(c: Column) -> Column:
    """Date from day-first text in any accepted spelling; two-digit years 69-99 are 19xx."""

    def one(pattern: str) -> Column:
        parsed = F.try_to_timestamp(c, F.lit(pattern)).cast("date")
        if pattern.endswith("yyyy"):
            return parsed
        return F.when(F.year(parsed) >= 2069, F.add_months(parsed, -1200)).otherwise(parsed)

    return F.coalesce(*[one(p) for p in DAY_FIRST])


def parse_day(c: Column) -> Column:
    """Date from day-first text, or from ISO text with or without a time of day."""
    return F.coalesce(parse_day_first(c), F.try_to_timestamp(c).cast("date"))


def coerce_dates(df: DataFrame, *names: str, formats: Iterable[str] = ()) -> DataFrame:
    """Make the named columns timestamps: text is parsed, typed columns are only cast, and timestamps stay themselves."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    changes = {}
    for n in names:
        if n not in kinds or isinstance(kinds[n], T.TimestampType):
            continue
        text = isinstance(kinds[n], T.StringType)
        changes[n] = parse_timestamp(F.col(n), formats) if text else F.col(n).cast("timestamp")
    return df.withColumns(changes)


def iso_or_blank(c: Column) -> Column:
    return F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit(""))


def month_of(c: Column) -> Column:
    """First day of the month, which stands for the month."""
    return F.trunc(c, "MM")


def month_label(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def days_in_month(c: Column) -> Column:
    return F.dayofmonth(F.last_day(c))


def is_sunday(c: Column) -> Column:
    return F.weekday(c) == 6


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps, rounded towards the past."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return F.floor(micros / F.lit(86_400_000_000))


def dwell_days(shipped: Column, arrived: Column) -> Column:
    return F.abs(whole_days(shipped, arrived)) + 1


def age_days(as_of: dt.date | str, since: Column) -> Column:
    return F.datediff(F.lit(str(as_of)).cast("date"), since)


def hours_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(3.6e9)


def at_time(day: Column, time_of_day: Column) -> Column:
    """Timestamp from a day and a ``H:m:s`` text; null where either is unusable."""
    text = F.concat_ws(" ", F.date_format(day, "yyyy-MM-dd"), time_of_day)
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd H:m:s"))


def in_range(c: Column, start=None, end=None) -> Column:
    """Inclusive range test; either bound may be left open."""
    test = F.lit(True)
    if start is not None:
        test = test & (c >= F.lit(start))
    if end is not None:
        test = test & (c <= F.lit(end))
    return test


def parse_user_date(text: str) -> dt.date:
    """A date a user typed, in one of the accepted day-first spellings."""
    for pattern in ("%d-%m-%Y", "%d-%m-%y", "%d/%m/%Y", "%d/%m/%y"):
        try:
            return dt.datetime.strptime(text, pattern).date()
        except ValueError:
            pass
    raise ValueError(f"not a dd/mm/yy or dd-mm-yy date: {text!r}")


def date_range(start: str, end: str) -> tuple[dt.date, dt.date]:
    """Two typed dates as an ordered pair; raises when they are the wrong way round."""
    lo, hi = parse_user_date(start), parse_user_date(end)
    if lo > hi:
        raise ValueError("start date must not be after end date")
    return lo, hi
