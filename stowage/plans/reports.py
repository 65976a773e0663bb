"""End-to-end reports over the loaded tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import cached_property
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stowage.functions.dates import date_range
from stowage.operators.focus import filter_any_column, in_warehouse
from stowage.operators.totals import widest
from stowage.plans import billing, cleaning, flows, inventory, labor, screening, stock
from stowage.session import share
from stowage.sources.extracts import load_tables
from stowage.sources.lookups import read_client_tariffs, read_labor, read_overtime_tariffs, read_wages
from stowage.tables import FOCUSED, Tables

CLIENT, WAREHOUSE = "C", "W"


def focus(tables: Tables, client: str | None = None, warehouse: str | None = None) -> Tables:
    """The fact tables of one client and/or warehouse; reference tables stay whole.

    Before screening there is no assigned warehouse yet, so a warehouse is then looked for in the
    raw warehouse column of the tables that have one.
    """
    facts = {n: df for n, df in tables.items() if n in FOCUSED}
    if client is not None:
        facts = {n: filter_any_column(df, "idcontacto", client) for n, df in facts.items()}
    if warehouse is not None:
        facts = {n: filter_any_column(df, "bodega", warehouse) for n, df in facts.items()}
    return tables.with_(**facts)


def prepare(
    tables: Tables, analysis: str | None = None, entity: str | None = None, formats: Iterable[str] = ()
) -> Tables:
    """Focus on a client ('C') or warehouse ('W') and clean."""
    if analysis not in (None, CLIENT, WAREHOUSE):
        raise ValueError(f"analysis must be 'C' or 'W', not {analysis!r}")
    trimmed = tables.clients.withColumns({c: F.trim(c) for c in ("idcontacto", "descrip")})
    tables = tables.with_(clients=trimmed)
    client = entity if analysis == CLIENT else None
    warehouse = entity if analysis == WAREHOUSE else None
    return cleaning.clean(focus(tables, client, warehouse), formats)


def monthly_summaries(screened: Tables) -> dict[str, flows.Monthly]:
    t = screened
    return {
        "receipts": flows.monthly_receipts(t.receipts, t.clients, t.stock_all, t.order_lines_out),
        "dispatches": flows.monthly_dispatches(t.dispatches, t.dispatched_stock, t.clients),
    }


def analyze_stock(screened: Tables, product_volume: DataFrame, as_of: dt.date | str) -> dict[str, DataFrame]:
    t = screened
    return {
        "proportions": stock.stock_proportions(t.stock, product_volume, t.clients),
        "ageing": stock.stock_ageing(t.stock, product_volume, t.clients, as_of),
    }


class ClientReport:
    """Every table of the client report, planned when it is first asked for; see ``client_report``.

    Rows that several tables read (receipts, received, dispatched, shipped and on-hand rows, sums per day) are stored
    by the first table that needs them, so a report of which only one table is read writes nothing for the others.
    """

    def __init__(
        self, cleaned: Tables, product_volume: DataFrame, pallet_override: DataFrame, lo, hi, as_of: dt.date | str,
        warehouse: str | None, opening: DataFrame | None, keep_shared: bool, collapse_unmatched: bool, match_item: bool,
        pallets: str, official: str | None,
    ):
        self._cleaned, self._screened = cleaned, screening.screen(cleaned)
        self._volume, self._override, self._opening = product_volume, pallet_override, opening
        self._lo, self._hi, self._as_of, self._warehouse = lo, hi, as_of, warehouse
        self._keep, self._collapse, self._match_item = keep_shared, collapse_unmatched, match_item
        self._pallets, self._official = pallets, official
        self._in(self._screened.stock)  # an unknown warehouse raises now

    def _kept(self, df: DataFrame, name: str, *columns: str) -> DataFrame:
        """``df`` stored (its ``columns`` alone, if any are named); as it is in a report that stores nothing."""
        return share(df.select(*columns) if columns else df, name) if self._keep else df

    def _in(self, df: DataFrame, column: str = "bodega") -> DataFrame:
        return in_warehouse(df, self._warehouse, column)

    def _measured(self, *columns: tuple[DataFrame, str]):
        """Widths are measured once for the whole report where its rows are stored, else in each plan."""
        width = widest(*columns)
        if not self._keep:
            return width
        return self._cleaned.clients.sparkSession.range(1).select(width.alias("n")).first()["n"] or 0

    @cached_property
    def _width(self):
        c = self._cleaned
        others = (c.dispatches, "idcontacto"), (c.clients, "idcontacto")
        if not self._keep:
            return self._measured((c.receipts, "idcontacto"), *others)
        # where rows are stored, receipts are measured as screening leaves them: one client per receipt; they need no
        # grouping for it unless some receipt's client is wider than all of the other tables
        width = self._measured(*others)
        if self._measured((c.receipts, "idcontacto")) <= width:
            return width
        return max(width, self._measured((screening.one_per_receipt(c.receipts), "idcontacto")))

    @cached_property
    def _receipt_width(self):
        return self._measured((self._cleaned.dispatches, "idingreso"), (self._cleaned.dispatched_stock, "idingreso"))

    @cached_property
    def _receipts(self) -> DataFrame:
        return self._kept(self._screened.receipts, "receipts")

    @cached_property
    def _received(self) -> DataFrame:
        t = self._screened
        rows = flows.received_rows(self._receipts, t.stock_all, t.order_lines_out, self._width, self._collapse)
        official = {self._official} & set(rows.columns) - set(flows.RECEIVED)
        return self._kept(rows, "received", *flows.RECEIVED, *official)

    @cached_property
    def _dispatched(self) -> DataFrame:
        t = self._screened
        rows = flows.shipped_rows(t.dispatches, t.dispatched_stock, self._match_item, self._width, self._receipt_width)
        return self._kept(rows, "dispatched", *flows.DISPATCHED)

    @cached_property
    def _shipped(self) -> DataFrame:
        return self._kept(flows.filled_warehouses(self._dispatched), "shipped")

    @cached_property
    def _items(self) -> DataFrame:
        t = self._screened
        completed = stock.complete_volume(t.stock, self._volume)
        return stock.stock_items(completed, self._volume, t.clients, self._width)

    @cached_property
    def _on_hand(self) -> DataFrame:
        return self._kept(self._items, "on-hand")

    @cached_property
    def _mode(self) -> DataFrame:
        # needs two columns of the rows on hand, for which they are not stored; rows already stored are read, though
        return billing.pallet_mode(self.__dict__.get("_on_hand", self._items))

    @cached_property
    def _fills(self) -> DataFrame:
        return billing.mode_with_override(self._mode, self._override)

    @cached_property
    def _moved(self) -> DataFrame:
        rows_in = billing.billing_inflow_detail(self._received, self._mode, self._pallets, self._official)
        rows_out = billing.billing_outflow_detail(self._shipped, self._fills, self._pallets)
        return self._kept(inventory.summed_flows(inventory.flow_rows(self._in(rows_in), self._in(rows_out))), "flows")

    @cached_property
    def monthly_receipts(self) -> DataFrame:
        return self._in(flows.receipts_by_client(self._received, self._screened.clients, self._width))

    @cached_property
    def monthly_dispatches(self) -> DataFrame:
        return self._in(flows.dispatches_by_client(self._dispatched, self._screened.clients, self._width))

    @cached_property
    def period_receipts(self) -> DataFrame:
        return flows.period_by_warehouse(self.monthly_receipts, self._lo, self._hi)

    @cached_property
    def period_dispatches(self) -> DataFrame:
        return flows.period_by_warehouse(self.monthly_dispatches, self._lo, self._hi)

    @cached_property
    def stock_by_warehouse(self) -> DataFrame:
        return self._in(stock.summary_of(self._on_hand))

    @cached_property
    def stock_proportions(self) -> DataFrame:
        return stock.proportions_of(self._on_hand, self._warehouse)

    @cached_property
    def stock_ageing(self) -> DataFrame:
        return stock.ageing_of(self._on_hand, self._as_of, warehouse=self._warehouse)

    @cached_property
    def billing_inflow(self) -> DataFrame:
        return self._in(billing.billing_inflow(self._received, self._mode, self._lo, self._hi), "warehouse")

    @cached_property
    def billing_outflow(self) -> DataFrame:
        clients = flows.padded(self._screened.clients, "idcontacto", self._width)
        lines = billing.billing_outflow(self._shipped, self._fills, self._receipts, clients, self._lo, self._hi)
        return self._in(lines, "warehouse")

    @cached_property
    def billing_stock(self) -> DataFrame:
        return self._in(billing.billing_stock(self._on_hand, self._as_of), "warehouse")

    @cached_property
    def billing_totals(self) -> DataFrame:
        on_hand = self.billing_stock  # first, as it stores the rows that pallet modes can then read
        return billing.billing_totals(self.billing_inflow, self.billing_outflow, on_hand)

    @cached_property
    def daily(self) -> DataFrame:
        return inventory.daily_levels(self._moved, opening=self._opening)

    @cached_property
    def monthly(self) -> DataFrame:
        return inventory.monthly_levels(self.daily, self._moved)

    @cached_property
    def client_share(self) -> DataFrame:
        return inventory.client_share(self._moved)

    @cached_property
    def period(self) -> DataFrame:
        return inventory.inventory_for_period(self.daily, self._lo, self._hi)

    @cached_property
    def kpis(self) -> DataFrame:
        return inventory.inventory_kpis(self.daily)


def client_report(
    tables: Tables,
    product_volume: DataFrame,
    pallet_override: DataFrame,
    start: str,
    end: str,
    as_of: dt.date | str,
    client: str | None = None,
    warehouse: str | None = None,
    opening: DataFrame | None = None,
    keep_shared: bool = True,
    formats: Iterable[str] = (),
    collapse_unmatched: bool = False,
    match_item: bool = False,
    pallets: str = "per_row",
    official: str | None = None,
) -> ClientReport:
    """The whole report for a date range typed day first, for one client or for all.

    ``warehouse`` narrows every table of the report to rows assigned to it. A row's warehouse is only
    known at the end, from its stock, its outbound lines and its client, so inputs stay whole and
    results are filtered: the reports of all warehouses add up to the report without one.

    ``collapse_unmatched`` is that of ``flows.monthly_receipts``, ``match_item`` that of
    ``flows.monthly_dispatches`` and ``pallets`` that of the billing details behind the levels.

    With ``keep_shared`` rows that several tables of the report read are stored once, when first needed.
    """
    lo, hi = date_range(start, end)
    cleaned = cleaning.clean(focus(tables, client), formats)
    return ClientReport(
        cleaned, product_volume, pallet_override, lo, hi, as_of, warehouse, opening, keep_shared, collapse_unmatched,
        match_item, pallets, official,
    )


def billing_report(
    spark: SparkSession, base: str, product_volume: DataFrame, pallet_override: DataFrame, tariffs_path: str,
    start: str, end: str, as_of: dt.date | str, analysis: str | None = None, entity: str | None = None, **options,
) -> tuple[ClientReport, DataFrame]:
    """The client report from CSV extracts, together with the client tariffs; ``options`` are those of
    ``client_report`` (``formats``, ``pallets``, ``match_item``, ``collapse_unmatched``, ``official``, ``opening``...)."""
    report = client_report(
        load_tables(spark, base), product_volume, pallet_override, start, end, as_of,
        client=entity if analysis == CLIENT else None,
        warehouse=entity if analysis == WAREHOUSE else None, **options,
    )
    return report, read_client_tariffs(spark, tariffs_path)


class OvertimeReport(NamedTuple):
    warehouse: labor.WarehouseOperations
    delivery: labor.DeliveryOperations
    margin: labor.Margin


def overtime_report(
    warehouse_sheet: DataFrame, delivery_sheet: DataFrame, wages: DataFrame, tariffs: DataFrame,
    start=None, end=None, year: int | None = None,
) -> OvertimeReport:
    """Labour sheets to operations and margin; ``wages`` and ``tariffs`` carry sheet headers."""
    rates = labor.wages_normalize(wages)
    costed = labor.labor_cost(labor.labor_normalize(warehouse_sheet), rates, start, end)
    delivered = labor.labor_cost(labor.labor_normalize(delivery_sheet), rates, start, end)
    warehouse = labor.labor_operations_warehouse(labor.labor_overlap_adjust(costed))
    return OvertimeReport(
        warehouse,
        labor.labor_operations_delivery(delivered),
        labor.labor_margin(warehouse.operations, labor.named(tariffs), year),
    )


def overtime_report_from_files(
    spark: SparkSession, warehouse_path: str, delivery_path: str, wages_path: str, tariffs_path: str,
    start: str, end: str, year: int | None = None,
) -> OvertimeReport:
    lo, hi = date_range(start, end)
    warehouse_sheet, delivery_sheet = read_labor(spark, warehouse_path, delivery_path, lo, hi)
    return overtime_report(
        warehouse_sheet, delivery_sheet, read_wages(spark, wages_path),
        read_overtime_tariffs(spark, tariffs_path), lo, hi, year,
    )
