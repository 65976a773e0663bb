"""Values looked up from another table, or from the rest of the same one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unique_values(df: DataFrame, key: str, value: str, unknown: str) -> DataFrame:
    """(key, value) for keys that show exactly one value other than ``unknown``; a null counts."""
    seen = df.filter(F.col(key).isNotNull() & ~F.col(value).eqNullSafe(F.lit(unknown)))
    nulls = F.count_if(F.col(value).isNull()).alias("_nulls")
    found = grouped_apart(seen, [key], F.min(value).alias("only"), F.max(value).alias("_max"), nulls)
    return found.filter((F.col("only") == F.col("_max")) & (F.col("_nulls") == 0)).select(key, "only")


def fill_from_unique(
    df: DataFrame, key: str, value: str, unknown: str, source: DataFrame | None = None
) -> DataFrame:
    """Replace ``unknown`` by the key's only known value, where there is exactly one.

    ``source`` may name a smaller table with the same (key, value) pairs, such as a pre-aggregate.
    """
    only = unique_values(df if source is None else source, key, value, unknown)
    # Only unknown rows look anything up. The others get a key of their own that no table has, so
    # that they spread over the tasks, where nulls would all meet in one.
    nowhere = F.concat(F.lit("\u0000"), F.pmod(F.hash(*df.columns), F.lit(10_000)).cast("string"))
    probe = F.when((F.col(value) == unknown) & F.col(key).isNotNull(), F.col(key).cast("string")).otherwise(nowhere)
    only = only.select(F.col(key).cast("string").alias("_probe"), "only")
    filled = F.coalesce(F.col("only"), F.col(value))
    return (
        df.withColumn("_probe", probe)
        .join(only, "_probe", "left")
        .withColumn(value, filled)
        .select(*df.columns)
    )


def fill_within_key(df: DataFrame, key: str, value: str, unknown: str) -> DataFrame:
    """``fill_from_unique`` for a pre-aggregated table that holds few rows per key.

    One window instead of a second pass over the table; only for tables whose rows per key are
    bounded, such as totals per month and warehouse.
    """
    of_key = Window.partitionBy(key)
    known = F.when(~F.col(value).eqNullSafe(F.lit(unknown)), F.col(value))
    low, high = F.min(known).over(of_key), F.max(known).over(of_key)
    gaps = F.count_if(F.col(value).isNull()).over(of_key)
    alone = F.col(key).isNotNull() & (low == high) & (gaps == 0)
    return df.withColumn(value, F.when((F.col(value) == unknown) & alone, low).otherwise(F.col(value)))


def attach_totals(df: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """Aggregates of each key, added to its rows; rows with a null key get nulls.

    A grouped aggregate joined back, not a window: the aggregate is combined before the shuffle
    and AQE splits a hot key in the join, where a window would hold the key's rows in one task.
    """
    made = [c.alias(n) for n, c in aggregates.items()]
    return df.join(grouped_apart(df.dropna(subset=list(keys)), keys, *made), list(keys), "left")


def grouped_apart(df: DataFrame, keys: Sequence[str], *aggregates: Column, apart: str | None = None) -> DataFrame:
    """Aggregates per key, grouped on a hash of the keys as well.

    A join on the keys then has to shuffle both its sides, and only such a join can AQE split; the
    shuffle of an aggregate on the join's own keys would be reused and a hot key stay whole. The hash
    travels with the rows, so it is one of four bytes. It stays as a column ``apart``, if that is named: a join of
    such tables on it and the keys needs no shuffle, and a later one on the keys still has its own.
    """
    grouped = df.groupBy(F.hash(*keys).alias(apart or "_apart"), *keys).agg(*aggregates)
    return grouped if apart else grouped.drop("_apart")


def expand(heads: DataFrame, items: DataFrame, key: str, keys_from: DataFrame | None = None) -> DataFrame:
    """Left join of one row per key with any number of items per key.

    A left join cannot be split on its right side, where a hot key would sit here; an inner join
    can. Keys without items are added from an anti join, to which each task sends a key once. ``keys_from``
    may name a table with the same keys as ``items`` that is cheaper to make, such as the rows they were picked from.
    Heads with a null key, which have no items, stand apart: so both joins read the same rows, and these are
    shuffled once.
    """
    keyed, unkeyed = heads.filter(F.col(key).isNotNull()), heads.filter(F.col(key).isNull())
    keys = (items if keys_from is None else keys_from).select(key).distinct()
    bare = keyed.join(keys, key, "left_anti").unionByName(unkeyed)
    return keyed.join(items, key).unionByName(bare, allowMissingColumns=True)


def missing_keys(df: DataFrame, register: DataFrame, key: str) -> DataFrame:
    """Rows whose key the register does not hold."""
    return df.join(register.select(key), key, "left_anti")


def present_keys(df: DataFrame, register: DataFrame, key: str) -> DataFrame:
    """Rows whose key the register holds."""
    return df.join(register.select(key), key, "left_semi")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count("*").alias("rows")).filter("rows > 1")
