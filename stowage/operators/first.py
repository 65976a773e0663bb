"""First row or value per key, with a total order so that the answer never depends on arrival."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest: str, tie: Sequence[str] | None = None, apart: str | None = None
) -> DataFrame:
    """Keep the newest row of each key; ties go to the largest ``tie`` columns (default: all others).

    Spark turns the rank filter into a group limit on both sides of the shuffle, so every task
    sends at most one row per key and a hot key is thinned before it travels. A hash of the key
    leads the sort, because comparing one number is cheaper than comparing text; it travels, hence its four bytes.
    It stays as a column ``apart``, if that is named (see ``grouped_apart``).
    """
    if tie is None:
        tie = [c for c in df.columns if c not in {*keys, newest}]
    order = [F.col(c).desc_nulls_last() for c in (newest, *tie)]
    hashed = df.withColumn("_hash", F.hash(*keys))
    rank = F.row_number().over(Window.partitionBy("_hash", *keys).orderBy(*order))
    return hashed.withColumn("_rank", rank).filter("_rank = 1").drop("_rank", *([] if apart else ["_hash"])).withColumnsRenamed({"_hash": apart} if apart else {})


def latest_per_item(
    df: DataFrame, receipt: str, item: str, newest: str, tie: Sequence[str] | None = None, collapse_unmatched: bool = False
) -> DataFrame:
    """``latest_per_key`` on (receipt, item). Rows lacking either part have no key and all stay.

    The table is read once: each row without a key gets one of its own, by number, since such rows can be equal, and
    the numbers spread them over the tasks. With ``collapse_unmatched`` they share one key, as empty keys do in the
    source systems, and only the newest of them is left.
    """
    known = F.col(receipt).isNotNull() & F.col(item).isNotNull()
    if tie is None:
        tie = [c for c in df.columns if c != newest]
    keys = {"_k1": F.when(known, F.col(receipt)), "_k2": F.when(known, F.col(item))}
    if not collapse_unmatched:
        keys["_own"] = F.when(~known, F.monotonically_increasing_id())
    return latest_per_key(df.withColumns(keys), list(keys), newest, tie).drop(*keys)


def _ordered(value: Column | str, order: Sequence[Column | str]) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    fields = [(F.col(o) if isinstance(o, str) else o).alias(f"o{k}") for k, o in enumerate(order)]
    # The value closes its own ordering key: ties are settled and only one small struct travels.
    return F.when(value.isNotNull(), F.struct(*fields, value.alias("value")))


def newest(value: Column | str, *order: Column | str) -> Column:
    """Aggregate: the non-null value with the largest order; among equals the largest value."""
    return F.max(_ordered(value, order)).getField("value")


def oldest(value: Column | str, *order: Column | str) -> Column:
    """Aggregate: the non-null value with the smallest order; among equals the smallest value."""
    return F.min(_ordered(value, order)).getField("value")
