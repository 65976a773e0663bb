"""Current stock: volume, totals by warehouse, proportions by product, age."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stowage.functions.dates import age_days, coerce_dates
from stowage.functions.numbers import DEFAULT_VOLUME, MEASURE, coerce_measures, measure, total
from stowage.functions.text import zero_pad
from stowage.operators.first import latest_per_item, newest
from stowage.operators.focus import in_warehouse
from stowage.operators.totals import shares, widest
from stowage.plans.cleaning import on_hand
from stowage.plans.flows import STOCK_MEASURES, STOCK_TIE


def volumes(product_volume: DataFrame) -> DataFrame:
    """(idmodelo, cubicaje) with trimmed ids and numeric volume."""
    return product_volume.select(F.trim("idmodelo").alias("idmodelo"), measure(F.col("cubicaje")).alias("cubicaje"))


def complete_volume(stock: DataFrame, product_volume: DataFrame, default: float = DEFAULT_VOLUME) -> DataFrame:
    """Stock of warehouse BODE takes its product's volume; whatever stays empty gets the default."""
    left = coerce_measures(stock.withColumn("idmodelo", F.trim("idmodelo")), "inicial").alias("s")
    bode = F.col("s.bodega") == "BODE"
    match = (F.col("s.idmodelo") == F.col("v.idmodelo")) & bode
    joined = left.join(volumes(product_volume).alias("v"), match, "left")
    value = F.when(bode, F.col("v.cubicaje")).otherwise(F.col("s.inicial"))
    value = F.coalesce(value, F.lit(default).cast(MEASURE)).alias("inicial")
    return joined.select(*[value if c == "inicial" else F.col(f"s.{c}") for c in stock.columns])


def products_without_volume(stock: DataFrame, product_volume: DataFrame) -> DataFrame:
    """Products in warehouse BODE that the volume table does not know."""
    bode = stock.filter(F.col("bodega") == "BODE").select(F.trim("idmodelo").alias("idmodelo")).distinct()
    return bode.join(volumes(product_volume).dropna(), "idmodelo", "left_anti")


def stock_items(
    stock: DataFrame, product_volume: DataFrame, clients: DataFrame, width: Column | int | None = None
) -> DataFrame:
    """On-hand stock rows with typed measures, product volume where known, and padded client ids."""
    width = width if width is not None else widest((stock, "idcontacto"), (clients, "idcontacto"))
    rows = coerce_measures(coerce_dates(on_hand(stock), "fecha"), *STOCK_MEASURES)
    rows = rows.withColumn("idmodelo", F.trim("idmodelo")).join(volumes(product_volume), "idmodelo", "left")
    return rows.withColumns(
        {
            "inicial": F.coalesce(F.col("cubicaje"), F.col("inicial")),
            "idcontacto": zero_pad(F.col("idcontacto"), width),
        }
    ).drop("cubicaje")


def once_per_item(items: DataFrame) -> DataFrame:
    return latest_per_item(items, "idingreso", "itemno", "fecha", STOCK_TIE)


class StockByWarehouse(NamedTuple):
    """Summary per warehouse and client, and the stock rows behind it (not deduplicated)."""

    summary: DataFrame
    fact: DataFrame


def stock_by_warehouse(
    stock: DataFrame, product_volume: DataFrame, clients: DataFrame, width: Column | int | None = None
) -> StockByWarehouse:
    fact = stock_items(stock, product_volume, clients, width)
    return StockByWarehouse(summary_of(fact), fact)


def summary_of(items: DataFrame) -> DataFrame:
    """Stock rows as of ``stock_items``, each item once, summed per warehouse and client."""
    return (
        once_per_item(items)
        .dropna(subset=["bodega", "idcontacto"])
        .groupBy("bodega", "idcontacto")
        .agg(
            total("inicial").alias("cbm"),
            F.count("idmodelo").alias("pallets"),
            total("pesokgs").alias("units"),
        )
    )


def _by_product(items: DataFrame, *keys: str) -> DataFrame:
    grouped = (
        items.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(
            newest("idcoldis", "fecha").alias("model"),
            total("inicial").alias("cbm"),
            total("pesokgs").alias("units"),
            F.count("itemno").alias("pallets"),
        )
    )
    return shares(grouped, ["cbm", "pallets", "units"])


def stock_proportions(
    stock: DataFrame,
    product_volume: DataFrame,
    clients: DataFrame,
    width: Column | int | None = None,
    warehouse: str | None = None,
) -> DataFrame:
    """Stock by product with each product's share, largest volume share first.

    With ``warehouse`` only items whose newest row lies there count, and shares are of that warehouse.
    """
    return proportions_of(stock_items(stock, product_volume, clients, width), warehouse)


def proportions_of(items: DataFrame, warehouse: str | None = None) -> DataFrame:
    """``stock_proportions`` of stock rows as of ``stock_items``."""
    items = in_warehouse(once_per_item(items), warehouse)
    return _by_product(items, "idmodelo").orderBy(F.desc("cbm_pct"), "idmodelo")


def stock_ageing(
    stock: DataFrame,
    product_volume: DataFrame,
    clients: DataFrame,
    as_of: dt.date | str,
    by_product: bool = True,
    width: Column | int | None = None,
    warehouse: str | None = None,
) -> DataFrame:
    """Stock by receipt date (and product) with shares and days in stock, oldest first.

    With ``warehouse`` only items whose newest row lies there count, and shares are of that warehouse.
    """
    return ageing_of(stock_items(stock, product_volume, clients, width), as_of, by_product, warehouse)


def ageing_of(items: DataFrame, as_of: dt.date | str, by_product: bool = True, warehouse: str | None = None) -> DataFrame:
    """``stock_ageing`` of stock rows as of ``stock_items``."""
    items = in_warehouse(once_per_item(items), warehouse)
    items = items.withColumn("date", F.to_date("fecha"))
    keys = ["date", "idmodelo"] if by_product else ["date"]
    aged = _by_product(items, *keys).withColumn("days", age_days(as_of, F.col("date")))
    return aged.orderBy(*keys)
