"""Give every stock row, receipt, dispatch and outbound line its warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stowage.functions.text import blank_to, number_order
from stowage.functions.warehouse import UNKNOWN, assign_warehouse, force_site_warehouse
from stowage.operators.first import newest
from stowage.operators.lookup import expand, grouped_apart
from stowage.tables import Tables

RECEIPT_FIELDS = ["fecha", "items", "transtatus", "descrip", "idcontacto", "retnum"]


def located(df: DataFrame) -> DataFrame:
    """Warehouse from the row's own location."""
    return df.withColumn("bodega", assign_warehouse(F.col("idubica")))


def known_place(df: DataFrame) -> DataFrame:
    return df.withColumns({c: blank_to(F.col(c), UNKNOWN) for c in ("idubica", "bodega")})


def site_forced(df: DataFrame) -> DataFrame:
    return df.withColumn("bodega", force_site_warehouse(F.col("idcontacto"), F.col("bodega")))


def one_per_receipt(receipts: DataFrame) -> DataFrame:
    """One row per receipt: of each column the newest value that is not null."""
    return grouped_apart(
        receipts.filter(F.col("idingreso").isNotNull()), ["idingreso"],
        F.max("fecha").alias("fecha"), *[newest(c, "fecha").alias(c) for c in RECEIPT_FIELDS if c != "fecha"],
    )


def first_line_place(lines: DataFrame, apart: str | None = None) -> DataFrame:
    """Warehouse and location of the first outbound line of each receipt.

    ``lines`` are cleaned and located, so places are never null and one struct carries both. Order and
    line numbers count as numbers: line 2 comes before line 10. ``apart`` is that of ``grouped_apart``.
    """
    order = [number_order(F.col(c)).alias(c) for c in ("numero", "itemline")]
    first = F.min(F.struct(*order, "idubica", "bodega")).alias("line")
    found = grouped_apart(lines.filter(F.col("idingreso").isNotNull()), ["idingreso"], first, apart=apart)
    return found.select(*([apart] if apart else []), "idingreso", "line.bodega", "line.idubica")


def screened_receipts(receipts: DataFrame, located_stock: DataFrame) -> DataFrame:
    """One row per receipt and stock row of it, with place; receipts without stock are kept."""
    places = located_stock.select("idingreso", "idubica", "bodega")
    return site_forced(known_place(expand(one_per_receipt(receipts), places, "idingreso")))


def placed_dispatches(dispatches: DataFrame, located_lines: DataFrame) -> DataFrame:
    """Dispatches with the place of their receipt's first outbound line."""
    return known_place(dispatches.join(first_line_place(located_lines), "idingreso", "left"))


def placed_headers(headers: DataFrame, placed: DataFrame) -> DataFrame:
    """Dispatch headers with the place of their newest line; headers without lines are left out."""
    newest_line = F.max(F.struct("fecha", "idingreso", "itemno", "idubica", "bodega")).alias("line")
    places = grouped_apart(placed.filter(F.col("trannum").isNotNull()), ["trannum"], newest_line)
    places = places.select("trannum", "line.bodega", "line.idubica")
    # A header without lines gets no warehouse and would be dropped next, hence the inner join.
    return headers.join(places, "trannum")


def screen(tables: Tables) -> Tables:
    stock, lines = located(tables.stock), located(tables.order_lines_out)
    placed = placed_dispatches(tables.dispatches, lines)
    return tables.with_(
        stock=site_forced(stock),
        receipts=screened_receipts(tables.receipts, stock),
        dispatches=site_forced(placed),
        order_lines_out=site_forced(lines),
        dispatch_headers=placed_headers(tables.dispatch_headers, placed),
    )
