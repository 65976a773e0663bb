"""Whole-table figures attached to rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stowage.functions.numbers import percent


def shares(df: DataFrame, columns: Sequence[str], suffix: str = "_pct") -> DataFrame:
    """Each column's share of its own total, in percent.

    The totals are a scalar subquery, summed in parallel; a window over the whole table would need
    a single task. The subquery also reads the other columns (as one hash that nobody uses): with
    equal columns its shuffles equal those of the table itself, and Spark computes them once.
    """
    others = [c for c in df.columns if c not in columns]
    sums = [F.sum(c).alias(c) for c in columns]
    if others:
        sums.append(F.max(F.xxhash64(*others)).alias("_others"))
    totals = df.agg(F.struct(*sums)).scalar()
    return df.withColumns({c + suffix: percent(F.col(c), totals[c]) for c in columns})


def widest(*columns: tuple[DataFrame, str]) -> Column:
    """Longest text in any of the given columns, as one scalar subquery."""
    lengths = [df.select(F.length(name).alias("n")) for df, name in columns]
    return reduce(DataFrame.union, lengths).agg(F.max("n")).scalar()


def roll_ups(df: DataFrame, sets: dict[str, Sequence[str]], *aggregates: Column, name: str = "rolled_by") -> DataFrame:
    """All roll-ups of a table from one pass: ``name`` says by which of ``sets`` a row is grouped.

    ``sets`` names lists of key columns. A row has nulls in keys that its set does not group by; rows with a null in
    one of the set's own keys are left out, as in a plain roll-up of rows without it.
    """
    keys = list(dict.fromkeys(k for own in sets.values() for k in own))
    groups = df.groupingSets([[F.col(k) for k in own] for own in sets.values()], *keys).agg(
        *aggregates, *[F.grouping(k).alias(f"_{k}") for k in keys]
    )
    which, present = F.lit(None), F.lit(False)
    for label, own in sets.items():
        mine = reduce(Column.__and__, [F.col(f"_{k}") == F.lit(0 if k in own else 1) for k in keys])
        which = F.when(mine, F.lit(label)).otherwise(which)
        present = present | (mine & reduce(Column.__and__, [F.col(k).isNotNull() for k in own], F.lit(True)))
    return groups.filter(present).withColumn(name, which).drop(*[f"_{k}" for k in keys])
