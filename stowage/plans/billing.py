"""Billing lines: pallets received, on hand and shipped."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stowage.functions.dates import age_days, dwell_days, in_range
from stowage.functions.numbers import measure, pallets_for, positive_part, round2, tally, total
from stowage.functions.text import item_key, pallet_tag, ten_digit_receipt
from stowage.operators.first import latest_per_key, newest, oldest
from stowage.operators.lookup import attach_totals, grouped_apart

UNKNOWN_TEXT = "Unknown"


def pallet_mode(stock_fact: DataFrame) -> DataFrame:
    """Usual number of items on one pallet of each product; ties go to the smaller number.

    Items without a pallet tag are pallets of one. They are counted, never listed one by one, so
    the shuffles carry one row per (product, tag) and then per (product, fill).
    """
    tagged = stock_fact.select("idmodelo", pallet_tag(F.col("idubica1")).alias("tag")).dropna(subset=["idmodelo"])
    per_tag = tagged.groupBy("idmodelo", "tag").agg(F.count("*").alias("items"))
    loose = F.col("tag").isNull()
    fills = per_tag.groupBy("idmodelo", F.when(loose, F.lit(1)).otherwise(F.col("items")).alias("fill")).agg(
        F.sum(F.when(loose, F.col("items")).otherwise(1)).alias("pallets")
    )
    best = F.max_by("fill", F.struct("pallets", -F.col("fill")))
    return grouped_apart(fills, ["idmodelo"], best.alias("mode_count"))


def mode_with_override(mode: DataFrame, override: DataFrame) -> DataFrame:
    """Usual fill per product, raised where the override table names a larger one.

    Of a repeated product the line with the smallest ``position`` counts, or without that column
    the line with the largest fill.
    """
    given = measure(F.col("mode_count"))
    order = -F.col("position") if "position" in override.columns else given
    lines = override.select(F.trim("idmodelo").alias("idmodelo"), given.alias("given"), order.alias("_order"))
    given = lines.groupBy("idmodelo").agg(F.max_by("given", "_order").alias("given"))
    # both sides have one row per product at most; grouped, not joined, so that what joins the result is shuffled for it
    both = mode.select("idmodelo", "mode_count").unionByName(given, allowMissingColumns=True)
    merged = grouped_apart(both, ["idmodelo"], F.max("mode_count").alias("mode_count"), F.max("given").alias("given"))
    counted = F.coalesce(F.col("mode_count"), F.lit(1))
    return merged.select("idmodelo", F.greatest(counted, F.col("given")).cast("double").alias("mode_count"))


def _splits() -> Column:
    return tally(F.col("ddma") > 0)


def billing_inflow(receipts_fact: DataFrame, mode: DataFrame, start=None, end=None) -> DataFrame:
    """Received lines per (receipt, product) of the receipts within a date range.

    All rows of a receipt carry its one date, so the range is applied first and a month's bill groups that month
    alone. Pallets are counted over the whole line, less one for every item detached later, never below zero. One
    grouped pass; the fill lookup joins on the finished lines.
    """
    lines = (
        receipts_fact.filter(in_range(F.col("fecha"), start, end))
        .dropna(subset=["idingreso", "idmodelo"])
        .groupBy("idingreso", "idmodelo")
        .agg(
            F.count("*").alias("items"),
            _splits().alias("splits"),
            F.max("fecha").alias("received"),
            newest("descrip", "fecha").alias("description"),
            total("inicial").alias("cbm"),
            total("pesokgs").alias("units"),
            newest("bodega", "fecha").alias("warehouse"),
        )
    )
    fill = F.coalesce(F.col("mode_count"), F.lit(1))
    return (
        lines.join(mode, "idmodelo", "left")
        .withColumn("pallets", positive_part(pallets_for(F.col("items"), fill) - F.col("splits")))
        .select("idingreso", "idmodelo", "received", "description", "cbm", "pallets", "units", "warehouse")
    )


def billing_inflow_detail(
    receipts_fact: DataFrame, mode: DataFrame, pallets: str = "per_row", official: str | None = None
) -> DataFrame:
    """Received rows with the pallets of their line, for the level over time.

    ``pallets='per_row'`` repeats the line's pallets on each of its rows, as the daily totals have
    always summed them; ``'per_group'`` spreads them so that a line counts once. ``official`` names
    an optional column whose pallet count replaces the computed one.
    """
    rows = receipts_fact.dropna(subset=["idingreso", "idmodelo"])
    rows = attach_totals(rows, ["idingreso", "idmodelo"], num_rows=F.count("*"), splits=_splits())
    counted = pallets_for(F.col("num_rows"), F.coalesce(F.col("mode_count"), F.lit(1)))
    if official and official in receipts_fact.columns:
        counted = F.coalesce(measure(F.col(official)), counted)
    final = positive_part(counted - F.col("splits")).cast("double")
    if pallets == "per_group":
        final = final / F.col("num_rows")
    return rows.join(mode, "idmodelo", "left").withColumn("pallets_final", final)


def billing_stock(stock_fact: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Stock on hand per receipt with pallets and days.

    All items under one pallet tag count as one pallet of the tag's newest receipt; every other
    item is its own pallet. Items without a tag are combined per receipt right away, so the first
    shuffle carries one row per tag or receipt. Text columns of cleaned stock hold no nulls, hence
    the newest row gives all of them at once.
    """
    tag = pallet_tag(F.col("idubica1"))
    keyed = stock_fact.withColumns({"_tag": tag, "_own": F.when(tag.isNull(), F.col("idingreso"))})
    pallets = keyed.groupBy("_tag", "_own").agg(
        F.max(F.struct("fecha", "idingreso", "itemno", "idubica", "idcontacto", "bodega")).alias("first"),
        F.min(F.struct("fecha", "idingreso", "itemno")).alias("last"),
        total("pesokgs").alias("units"),
        total("inicial").alias("cbm"),
        F.count("*").alias("_items"),
    )
    tagged = F.col("_tag").isNotNull()
    # A tagged pallet reports its last item, an untagged item itself. Within a receipt untagged
    # items come first, then pallets in tag order.
    pallets = pallets.select(
        F.col("first.idingreso").alias("idingreso"), "cbm", "units",
        F.when(tagged, F.lit(1)).otherwise(F.col("_items")).alias("pallets"),
        F.struct(
            F.coalesce("_tag", F.lit("")).alias("tag"),
            F.when(tagged, F.col("last.itemno")).otherwise(F.col("first.itemno")).alias("itemno"),
            item_key(F.col("first.idingreso"), F.col("first.itemno")).alias("label"),
            F.to_date("first.fecha").alias("date"),
            "first.idcontacto",
            "first.idubica",
            "first.bodega",
        ).alias("pallet"),
    )
    lines = (
        pallets.filter(F.col("idingreso").isNotNull())
        .groupBy("idingreso")
        .agg(
            F.min("pallet").alias("p"), *[F.sum(c).alias(c) for c in ("cbm", "pallets", "units")]
        )
    )
    return lines.select(
        "idingreso", "p.itemno", "p.label", "p.date", "p.idcontacto", F.col("p.idubica").alias("location"),
        "cbm", "pallets", "units", F.col("p.bodega").alias("warehouse"),
        (age_days(as_of, F.col("p.date")) + 1).alias("days"),
    )


def receipt_descriptions(receipts: DataFrame) -> DataFrame:
    """One description per receipt, under its ten-digit id."""
    named = receipts.select(ten_digit_receipt(F.col("idingreso")).alias("receipt"), "descrip", "fecha")
    return grouped_apart(named.filter(F.col("receipt").isNotNull()), ["receipt"], newest("descrip", "fecha").alias("description"))


def _outflow_rows(dispatches_fact: DataFrame) -> DataFrame:
    rows = dispatches_fact.withColumn("idingreso", ten_digit_receipt(F.col("idingreso")))
    return rows.withColumn("days", dwell_days(F.col("fecha"), F.col("arrived")))


def _line_pallets() -> Column:
    return pallets_for(F.col("num_rows"), F.coalesce(F.col("mode_count"), F.lit(1)))


def billing_outflow(
    dispatches_fact: DataFrame, fills: DataFrame, receipts: DataFrame, clients: DataFrame, start=None, end=None
) -> DataFrame:
    """Shipped lines per (transaction, product) within a date range.

    ``fills`` is the result of ``mode_with_override``. Client names are joined before grouping (a
    line takes the first name known); fill and receipt description join on the finished lines.
    """
    inside = in_range(F.col("fecha"), start, end)
    names = latest_per_key(
        clients.select("idcontacto", F.col("descrip").alias("client")), ["idcontacto"], "client"
    )
    rows = _outflow_rows(dispatches_fact).join(names, "idcontacto", "left")

    def first(c: str) -> Column:
        return newest(F.when(inside, F.col(c)), "fecha").alias(c)

    lines = (
        rows.dropna(subset=["trannum", "idmodelo"])
        .groupBy("trannum", "idmodelo")
        .agg(
            F.count("*").alias("num_rows"),
            tally(inside).alias("_inside"),
            oldest(F.when(inside, F.col("arrived")), "fecha").alias("arrival_date"),
            F.max(F.when(inside, F.col("fecha"))).alias("shipping_date"),
            round2(F.avg(F.when(inside, F.col("days").cast("double")))).alias("days"),
            newest(F.when(inside, F.col("idingreso")), "fecha").alias("receipt"),
            first("idcontacto"),
            first("client"),
            total(F.when(inside, F.col("cantidad"))).alias("cbm"),
            total(F.when(inside, F.col("pesokgs"))).alias("units"),
            first("bodega"),
        )
        .filter("_inside > 0")
    )
    return (
        lines.join(fills, "idmodelo", "left")
        .join(receipt_descriptions(receipts), "receipt", "left")
        .select(
            "trannum", "idmodelo", "arrival_date", "shipping_date", "days",
            F.coalesce("description", F.lit(UNKNOWN_TEXT)).alias("description"),
            "idcontacto", "client", "cbm", _line_pallets().alias("pallets"), "units",
            F.col("bodega").alias("warehouse"),
        )
    )


def billing_outflow_detail(dispatches_fact: DataFrame, fills: DataFrame, pallets: str = "per_row") -> DataFrame:
    """Shipped rows with the pallets of their line, for the level over time.

    ``pallets`` is 1 where the row has no pallet tag; ``calculated_pallets`` is the line's count,
    repeated on each row or, with ``pallets='per_group'``, spread over them.
    """
    rows = attach_totals(_outflow_rows(dispatches_fact), ["trannum", "idmodelo"], num_rows=F.count("*"))
    counted = _line_pallets().cast("double")
    blank = F.col("idubica1").isNull() | (F.col("idubica1") == "")
    summed = counted / F.col("num_rows") if pallets == "per_group" else counted
    return rows.join(fills, "idmodelo", "left").withColumns(
        {"pallets": F.when(blank, F.lit(1.0)).otherwise(counted), "calculated_pallets": summed}
    )


def billing_totals(inflow: DataFrame, outflow: DataFrame, stock: DataFrame) -> DataFrame:
    """Pallets and volume received, shipped and on hand."""
    parts = [(inflow, "received"), (outflow, "shipped"), (stock, "on_hand")]
    frames = [
        df.agg(F.coalesce(F.sum("pallets"), F.lit(0)).alias("pallets"), total("cbm").alias("cbm")).select(
            F.lit(kind).alias("kind"), "pallets", "cbm"
        )
        for df, kind in parts
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])
