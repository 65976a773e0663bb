"""Narrow tables to one client or warehouse."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stowage.functions.warehouse import WAREHOUSES

ALL_WAREHOUSES = "All Warehouses"


def filter_any_column(df: DataFrame, pattern: str, value: str) -> DataFrame:
    """Rows where any column whose name contains ``pattern`` equals ``value`` once trimmed.

    A table without such a column passes unchanged.
    """
    names = [c for c in df.columns if pattern in c]
    if not names:
        return df
    return df.filter(reduce(or_, [F.trim(F.col(c)) == value for c in names]))


def focus_client(tables: Sequence[DataFrame], client: str) -> list[DataFrame]:
    return [filter_any_column(t, "idcontacto", client) for t in tables]


def focus_warehouse(tables: Sequence[DataFrame], warehouse: str | None, pattern: str = "bodega") -> list[DataFrame]:
    """One warehouse of every table, or everything when no warehouse is named."""
    if warehouse in (None, ALL_WAREHOUSES):
        return list(tables)
    if warehouse not in WAREHOUSES:
        raise ValueError(f"unknown warehouse: {warehouse!r}")
    return [filter_any_column(t, pattern, warehouse) for t in tables]


def in_warehouse(df: DataFrame, warehouse: str | None, column: str = "bodega") -> DataFrame:
    """Rows whose assigned warehouse, in ``column``, is the one named; everything when none is named."""
    if warehouse in (None, ALL_WAREHOUSES):
        return df
    if warehouse not in WAREHOUSES:
        raise ValueError(f"unknown warehouse: {warehouse!r}")
    return df.filter(F.col(column) == warehouse)


def filter_exact(tables: Sequence[DataFrame], column: str, value: str) -> list[DataFrame]:
    """Rows whose ``column`` is exactly ``value``."""
    return [t.filter(F.col(column) == value) for t in tables]


def list_entities(df: DataFrame, key: str = "idcontacto", name: str = "descrip") -> DataFrame:
    return df.select(key, name).distinct()


def exclude(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Drop rows with one of the values; rows with a null stay."""
    return df.filter(F.col(column).isNull() | ~F.col(column).isin(list(values)))
