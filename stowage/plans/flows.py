"""Monthly receipts and dispatches by client and warehouse."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stowage.functions.dates import coerce_dates, in_range, month_of
from stowage.functions.numbers import coerce_measures, detached_later, total
from stowage.functions.text import zero_pad
from stowage.functions.warehouse import UNKNOWN, resolve_warehouse
from stowage.operators.first import latest_per_item, latest_per_key
from stowage.operators.lookup import expand, fill_from_unique, fill_within_key
from stowage.operators.totals import widest
from stowage.plans.screening import first_line_place

STOCK_MEASURES = ["inicial", "salidas", "pesokgs"]
# Order columns that settle "newest" among stock rows of one date.
STOCK_TIE = ["idingreso", "itemno", "idstatus", "idmodelo", "idubica", "idubica1", "inicial", "pesokgs", "salidas"]
DISPATCH_TIE = ["idingreso", "itemno", "trannum", "lineano", "idmodelo", "cantidad", "numero"]

# Columns of received and dispatched rows that the tables made from them read; only these are stored.
RECEIVED = ["idingreso", "fecha", "descrip", "idcontacto", "retnum", "bodega", "idmodelo", "ddma", "inicial", "pesokgs", "month"]
DISPATCHED = [
    "trannum", "idingreso", "fecha", "arrived", "month", "idcontacto", "bodega", "idmodelo", "numero", "cantidad", "pesokgs",
    "idubica1",
]


class Monthly(NamedTuple):
    """Totals by month, warehouse and client name, and the rows they were made from."""

    by_client: DataFrame
    fact: DataFrame


def padded(df: DataFrame, name: str, width: Column | int) -> DataFrame:
    return df.withColumn(name, zero_pad(F.trim(F.col(name)), width))


def totals_by_client(per_id: DataFrame, clients: DataFrame) -> DataFrame:
    """Totals per client id, rolled up to client names; ids without a name drop out."""
    named = per_id.join(clients.select("idcontacto", F.col("descrip").alias("client")), "idcontacto", "left")
    return (
        named.dropna(subset=["month", "bodega", "client"])
        .groupBy("month", "bodega", "client")
        .agg(
            F.min_by("fecha", "idcontacto").alias("fecha"),
            F.min("idcontacto").alias("idcontacto"),
            F.sum("pallets").alias("pallets"),
            F.sum("units").alias("units"),
            F.sum("cbm").alias("cbm"),
        )
    )


def receipt_items(
    receipts: DataFrame, stock_all: DataFrame, collapse_unmatched: bool = False, places: DataFrame | None = None
) -> DataFrame:
    """Receipts with their stock items, one row per (receipt, item).

    Both sides are reduced to one row per key before they meet, so the join never fans out.
    Receipts without any stock item have no item key; each stays, unless ``collapse_unmatched`` makes
    them one row (the newest), as rows with empty keys are in the source systems.

    ``places``, one row per receipt with the hash ``_apart`` of it, joins the receipts before they meet their items,
    where there are fewer rows and both sides are dealt by that hash already.
    """
    columns = ["idingreso", "fecha", "descrip", "idcontacto", "retnum", "bodega", "idubica"]
    receipts = receipts.select(*columns)
    heads = latest_per_key(receipts, ["idingreso"], "fecha", ["bodega", "idubica"], apart="_apart")
    if places is not None:
        heads = heads.join(places, ["_apart", "idingreso"], "left")
    heads = heads.drop("_apart")
    item_columns = ["idingreso", "itemno", "idmodelo", "idcoldis", "modifica", "ddma", *STOCK_MEASURES]
    tie = [c for c in STOCK_TIE if c not in ("idingreso", "itemno")]
    items = latest_per_key(stock_all, ["idingreso", "itemno"], "fecha", tie).select(*item_columns)
    if not collapse_unmatched:
        return expand(heads, items, "idingreso", keys_from=stock_all)
    newest = [F.col(c).desc_nulls_last() for c in ("fecha", "idingreso", "bodega", "idubica")]
    bare = receipts.join(stock_all.select("idingreso").distinct(), "idingreso", "left_anti").orderBy(*newest).limit(1)
    if places is not None:
        bare = bare.join(places.drop("_apart"), "idingreso", "left")
    return heads.join(items, "idingreso").unionByName(bare, allowMissingColumns=True)


def received_rows(
    receipts: DataFrame,
    stock_all: DataFrame,
    order_lines_out: DataFrame,
    width: Column | int,
    collapse_unmatched: bool = False,
) -> DataFrame:
    """Received items with their month, warehouse and padded client id, which ``receipts_by_client`` sums.

    ``receipts`` and ``order_lines_out`` are screened.
    """
    receipts = coerce_dates(receipts, "fecha")
    stock_all = coerce_measures(coerce_dates(stock_all, "fecha", "modifica"), *STOCK_MEASURES, "idpedido")
    measures = [F.col(c) for c in STOCK_MEASURES]
    stock_all = stock_all.withColumn(
        "ddma", detached_later(F.col("modifica"), F.col("fecha"), measures, F.col("idpedido"))
    )
    places = first_line_place(order_lines_out, "_apart").toDF("_apart", "idingreso", "outbound_bodega", "outbound_idubica")
    fact = (
        receipt_items(receipts, stock_all, collapse_unmatched, places)
        .withColumn(
            "bodega", resolve_warehouse(F.col("bodega"), F.col("outbound_bodega"), F.col("outbound_idubica"))
        )
        .withColumn("month", month_of(F.col("fecha")))
        .drop("outbound_bodega", "outbound_idubica")
    )
    return padded(fact, "idcontacto", width)


def receipts_by_client(fact: DataFrame, clients: DataFrame, width: Column | int) -> DataFrame:
    """Received items summed by month, client name and warehouse."""
    per_id = (
        fact.dropna(subset=["month", "idcontacto"])
        .groupBy("month", "idcontacto", "bodega")
        .agg(
            F.max("fecha").alias("fecha"),
            F.count("retnum").alias("pallets"),
            total("pesokgs").alias("units"),
            (total("inicial") + total("ddma")).alias("cbm"),
        )
    )
    return totals_by_client(per_id, padded(clients, "idcontacto", width))


def monthly_receipts(
    receipts: DataFrame,
    clients: DataFrame,
    stock_all: DataFrame,
    order_lines_out: DataFrame,
    width: Column | int | None = None,
    collapse_unmatched: bool = False,
) -> Monthly:
    """Receipts by month, client and warehouse.

    ``receipts`` and ``order_lines_out`` are screened. Client ids are padded to ``width``, which is
    measured on the tables (one column read) unless given.
    """
    width = width if width is not None else widest((receipts, "idcontacto"), (clients, "idcontacto"))
    fact = received_rows(receipts, stock_all, order_lines_out, width, collapse_unmatched)
    return Monthly(receipts_by_client(fact, clients, width), fact)


def shipped_rows(
    dispatches: DataFrame,
    dispatched_stock: DataFrame,
    match_item: bool,
    client_width: Column | int,
    receipt_width: Column | int,
) -> DataFrame:
    """Dispatched items with their month and arrival, and the warehouse they name.

    A dispatch takes arrival date and units from the newest stock item of its receipt, or from its
    own item with ``match_item``.
    """
    out = coerce_measures(coerce_dates(dispatches, "fecha"), "cantidad")
    out = out.withColumns(
        {
            "idcontacto": zero_pad(F.col("idcontacto"), client_width),
            "idingreso": zero_pad(F.col("idingreso"), receipt_width),
        }
    )
    out = latest_per_item(out, "idingreso", "itemno", "fecha", DISPATCH_TIE)

    stock = coerce_measures(coerce_dates(dispatched_stock, "fecha"), *STOCK_MEASURES)
    stock = stock.withColumn("idingreso", zero_pad(F.col("idingreso"), receipt_width))
    keys = ["idingreso", "itemno"] if match_item else ["idingreso"]
    newest = latest_per_key(stock, keys, "fecha", [c for c in STOCK_TIE if c not in keys])
    arrivals = newest.select(*keys, F.col("fecha").alias("arrived"), "pesokgs", "inicial", "salidas", "idubica1")

    return out.join(arrivals, keys, "left").withColumn("month", month_of(F.col("fecha")))


def _per_warehouse(fact: DataFrame) -> DataFrame:
    # Everything that is summed or filled is first combined per month, client and warehouse; the
    # client's only warehouse is then found among its few rows of that table.
    return fact.groupBy("month", "idcontacto", "bodega").agg(
        F.max("fecha").alias("fecha"),
        F.count("numero").alias("pallets"),
        total("pesokgs").alias("units"),
        total("cantidad").alias("cbm"),
    )


def filled_warehouses(fact: DataFrame) -> DataFrame:
    """Dispatched items whose unknown warehouse is the only known one of their client, where it has one."""
    return fill_from_unique(fact, "idcontacto", "bodega", UNKNOWN, source=_per_warehouse(fact).select("idcontacto", "bodega"))


def dispatches_by_client(fact: DataFrame, clients: DataFrame, width: Column | int) -> DataFrame:
    """Dispatched items, filled or not, summed by month, client name and warehouse."""
    per_id = (
        fill_within_key(_per_warehouse(fact), "idcontacto", "bodega", UNKNOWN)
        .dropna(subset=["month", "idcontacto", "bodega"])
        .groupBy("month", "idcontacto", "bodega")
        .agg(
            F.max("fecha").alias("fecha"),
            *[F.sum(c).alias(c) for c in ("pallets", "units", "cbm")],
        )
    )
    return totals_by_client(per_id, padded(clients, "idcontacto", width))


def monthly_dispatches(
    dispatches: DataFrame,
    dispatched_stock: DataFrame,
    clients: DataFrame,
    match_item: bool = False,
    client_width: Column | int | None = None,
    receipt_width: Column | int | None = None,
) -> Monthly:
    """Dispatches by month, client and warehouse, and the rows behind them (see ``shipped_rows``)."""
    if client_width is None:
        client_width = widest((dispatches, "idcontacto"), (clients, "idcontacto"))
    if receipt_width is None:
        receipt_width = widest((dispatches, "idingreso"), (dispatched_stock, "idingreso"))
    fact = shipped_rows(dispatches, dispatched_stock, match_item, client_width, receipt_width)
    return Monthly(dispatches_by_client(fact, clients, client_width), filled_warehouses(fact))


def period_by_warehouse(by_client: DataFrame, start=None, end=None) -> DataFrame:
    """Monthly totals within a date range, summed per warehouse, largest volume first."""
    return (
        by_client.filter(in_range(F.col("fecha"), start, end))
        .groupBy("bodega")
        .agg(*[F.sum(c).alias(c) for c in ("cbm", "pallets", "units")])
        .orderBy(F.desc("cbm"), "bodega")
    )
