"""Clean the loaded tables: prune columns, drop cancelled and test rows, type dates, fill blanks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stowage.functions.dates import coerce_dates
from stowage.functions.text import blank_to
from stowage.functions.warehouse import UNKNOWN
from stowage.operators.focus import exclude
from stowage.tables import COLUMNS, Tables

# Status codes, the dispatch class, retired temporary locations, test entities.
ON_HAND = "01"
DISPATCHED = ["XX", "03"]
CANCELLED_OR_DELIVERED = ["5", "9"]
DISPATCH_CLASS = "TR01"
RETIRED_LOCATIONS = ["DT1H2", "DT1I3", "DT1J3", "DT2C2", "DT2G3", "DT2H1", "DT3D1", "DT3E1", "DT3E2", "DT3I1"]
TEST_CLIENTS = ["000099", "AC0001"]
TEST_CENTERS = ["002"]

# Columns in which a missing text becomes the empty text.
LINE_TEXT = ["numero", "itemline", "estatus", "idproducto", "idcontacto", "idmodelo", "idcoldis", "cantidad", "idubica"]


def on_hand(stock: DataFrame) -> DataFrame:
    return stock.filter(F.col("idstatus") == ON_HAND)


def open_orders(orders: DataFrame) -> DataFrame:
    return exclude(orders, "estatus", CANCELLED_OR_DELIVERED)


def dispatch_class(df: DataFrame) -> DataFrame:
    return df.filter(F.col("idclase") == DISPATCH_CLASS)


def dispatched(stock: DataFrame) -> DataFrame:
    """Dispatched stock outside the retired locations."""
    return exclude(stock.filter(F.col("idstatus").isin(DISPATCHED)), "idubica", RETIRED_LOCATIONS)


def without_retired(stock: DataFrame) -> DataFrame:
    """All stock but the dispatched rows of retired locations."""
    retired = F.col("idstatus").isin(DISPATCHED) & F.col("idubica").isin(RETIRED_LOCATIONS)
    return stock.filter(~F.coalesce(retired, F.lit(False)))


def named_places(lines: DataFrame) -> DataFrame:
    """Outbound lines with blanks for missing text and a default for missing places."""
    places = {c: blank_to(F.col(c), UNKNOWN) for c in ("idubica", "idubica1") if c in lines.columns}
    return lines.fillna("", [c for c in LINE_TEXT if c in lines.columns]).withColumns(places)


def clean(tables: Tables, formats: Iterable[str] = ()) -> Tables:
    """Typed and filtered copies of the loaded tables.

    Dates are ISO text, or written in one of ``formats`` where those are given.

    Every filter is on a stored column, so it reaches the scan. Nothing is sorted: "newest first"
    is an order key of the operators that need it.
    """
    t = tables.with_(**{n: df.select(*COLUMNS[n]) for n, df in tables.items()})
    stock_text = [c for c in COLUMNS["stock"] if c != "fecha"]
    return t.with_(
        asn_headers=coerce_dates(t.asn_headers, "fecha", formats=formats),
        orders_out=coerce_dates(open_orders(t.orders_out), "fecha", formats=formats),
        order_lines_out=named_places(t.order_lines_out),
        receipts=coerce_dates(t.receipts, "fecha", formats=formats),
        dispatches=coerce_dates(dispatch_class(t.dispatches), "fecha", formats=formats),
        dispatch_headers=coerce_dates(dispatch_class(t.dispatch_headers), "fecha", formats=formats),
        stock=coerce_dates(on_hand(t.stock), "fecha", formats=formats).fillna("", stock_text),
        dispatched_stock=coerce_dates(dispatched(t.dispatched_stock), "fecha", formats=formats),
        stock_all=coerce_dates(without_retired(t.stock_all), "fecha", formats=formats).fillna("", stock_text),
        clients=exclude(t.clients, "idcontacto", TEST_CLIENTS),
        centers=exclude(t.centers, "idcentro", TEST_CENTERS),
    )
