"""Checks on the data that the analyses can live with but someone should see."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stowage.functions.text import ten_digit_receipt
from stowage.functions.warehouse import UNKNOWN
from stowage.operators.lookup import fill_from_unique, missing_keys, repeated_keys, unique_values


class UnknownFilled(NamedTuple):
    """All rows after filling, and the rows that could be, were, and could not be filled."""

    filled: DataFrame
    eligible: DataFrame
    replaced: DataFrame
    remaining: DataFrame


def missing_receipts(dispatches: DataFrame, receipts: DataFrame) -> DataFrame:
    """Receipt ids that were dispatched but are not in the register."""

    def ids(df: DataFrame) -> DataFrame:
        return df.select(ten_digit_receipt(F.col("idingreso")).alias("idingreso"))

    return missing_keys(ids(dispatches).distinct(), ids(receipts), "idingreso")


def duplicate_receipts(receipts: DataFrame) -> DataFrame:
    return repeated_keys(receipts, "idingreso")


def undescribed_receipts(receipts: DataFrame) -> DataFrame:
    return receipts.filter(F.col("descrip").isNull())


def handle_unknown_warehouse(df: DataFrame, key: str = "idcontacto", value: str = "bodega") -> UnknownFilled:
    """Fill unknown warehouses from the client's only known one, and say which rows that touched."""
    marked = df.withColumn("_before", F.col(value))
    filled = fill_from_unique(marked, key, value, UNKNOWN)
    changed = (F.col("_before") == UNKNOWN) & (F.col(value) != UNKNOWN)
    replaced = filled.filter(changed)
    return UnknownFilled(
        filled.drop("_before"),
        replaced.withColumn(value, F.col("_before")).drop("_before"),
        replaced.drop("_before"),
        filled.filter(F.col(value) == UNKNOWN).drop("_before"),
    )


def fill_counts(df: DataFrame, key: str = "idcontacto", value: str = "bodega") -> DataFrame:
    """How many unknown rows were and were not filled, from per-client counts alone."""
    per_key = df.groupBy(key).agg(F.count_if(F.col(value) == UNKNOWN).alias("unknown"))
    only = unique_values(df, key, value, UNKNOWN)
    hit = F.col("only").isNotNull()
    return per_key.join(only, key, "left").agg(
        F.coalesce(F.sum(F.when(hit, F.col("unknown"))), F.lit(0)).alias("replaced"),
        F.coalesce(F.sum(F.when(~hit, F.col("unknown"))), F.lit(0)).alias("remaining"),
    )
