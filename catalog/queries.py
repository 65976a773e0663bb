"""Every operator and analysis, asked of the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.views import is_lined, lined, table, tables, view
from stowage.functions import dates, numbers, text
from stowage.functions import warehouse as wh
from stowage.operators import first, focus, intervals, levels, lookup, series, sweep
from stowage.operators.totals import widest
from stowage.plans import billing, cleaning, flows, inventory, labor, quality, reports, screening, stock
from stowage.session import share, shared_dir, shuffles_removed
from stowage.sources.extracts import load_tables, mark_site, read_extract, read_site, rejected_lines, union_all
from stowage.sources.lookups import read_pallet_override, read_product_volume
from stowage.tables import SITE_KEYS, STEMS

START, END = "1997-01-01", "1998-12-31"
AS_OF = "2002-01-01"
CLIENT, WAREHOUSE = "000100_c", "BODA"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Plain types for comparison between engines: dates as text, decimals as double."""

    def plain(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.date_format(c, "yyyy-MM-dd").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.BooleanType)):
            return c.cast("long").alias(f.name)
        return c

    return df.select(*[plain(f) for f in df.schema.fields])


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: portable(fn(spark, sf_dir))
    return fn


@lru_cache(maxsize=16)
def cleaned(spark, sf):
    return cleaning.clean(tables(spark, sf))


@lru_cache(maxsize=16)
def screened(spark, sf):
    return screening.screen(cleaned(spark, sf))


def kept(sf, df, name, *columns):
    """``df`` (its ``columns``, if named) stored, in a query that stores its lines too (see ``lined``); as it is in others."""
    return share(df.select(*columns) if columns else df, name) if is_lined(sf) else df


@lru_cache(maxsize=16)
def received(spark, sf):
    t, raw = screened(spark, sf), cleaned(spark, sf)
    width = widest((raw.receipts, "idcontacto"), (raw.clients, "idcontacto"))
    receipts = kept(sf, t.receipts, "receipts")  # their join ends, and its shuffles go, before the items are read
    fact = kept(sf, flows.received_rows(receipts, t.stock_all, t.order_lines_out, width), "received", *flows.RECEIVED)
    return flows.Monthly(flows.receipts_by_client(fact, t.clients, width), fact)


@lru_cache(maxsize=16)
def shipped(spark, sf, **options):
    t, raw = screened(spark, sf), cleaned(spark, sf)
    width = widest((raw.dispatches, "idcontacto"), (raw.clients, "idcontacto"))
    receipt_width = widest((raw.dispatches, "idingreso"), (raw.dispatched_stock, "idingreso"))
    match_item = options.get("match_item", False)
    rows = flows.shipped_rows(t.dispatches, t.dispatched_stock, match_item, width, receipt_width)
    fact = kept(sf, rows, "dispatched", *flows.DISPATCHED, "itemno")
    return flows.Monthly(flows.dispatches_by_client(fact, t.clients, width), flows.filled_warehouses(fact))


@lru_cache(maxsize=16)
def completed_stock(spark, sf):
    t = screened(spark, sf)
    return t, stock.complete_volume(t.stock, view(spark, sf, "product_volume"))


@lru_cache(maxsize=16)
def stock_fact(spark, sf):
    t, full = completed_stock(spark, sf)
    return stock.stock_by_warehouse(full, view(spark, sf, "product_volume"), t.clients).fact


@lru_cache(maxsize=16)
def modes(spark, sf, facts):
    """Pallet modes, which are stored rather than the rows on hand; ``facts`` are those rows where they are stored anyway."""
    return kept(sf, billing.pallet_mode(stock_fact(spark, sf) if facts is None else facts), "pallet-modes")


@lru_cache(maxsize=16)
def fills(spark, sf, facts):
    return billing.mode_with_override(modes(spark, sf, facts), view(spark, sf, "pallet_override"))


@lru_cache(maxsize=16)
def simple_flows(spark, sf):
    return inventory.flow_rows(view(spark, sf, "received_rows"), view(spark, sf, "shipped_rows"))


# ---- inventory level ------------------------------------------------------------------------


@query
def daily_inventory_level(spark, sf):
    return inventory.daily_levels(simple_flows(spark, sf))


@query
def daily_level_with_opening(spark, sf):
    daily = inventory.daily_levels(simple_flows(spark, sf), START, END, view(spark, sf, "opening_levels"))
    return daily.select("date", "initial_inventory", "opening_level_cbm", "level_cbm")


@query
def inventory_level_by_client(spark, sf):
    return inventory.level_by_client(simple_flows(spark, sf), view(spark, sf, "opening_levels"))


@query
def inventory_for_period(spark, sf):
    daily = inventory.daily_levels(simple_flows(spark, sf))
    return inventory.inventory_for_period(daily, START, END).select("date", "inflow_cbm", "outflow_cbm", "level_cbm")


@query
def monthly_resample(spark, sf):
    return inventory.inventory_over_time(view(spark, sf, "received_rows"), view(spark, sf, "shipped_rows")).monthly


@query
def monthly_resample_with_gaps(spark, sf):
    """Three months of the year with goods on hand, so that the months between stay empty."""
    daily = inventory.daily_levels(simple_flows(spark, sf)).filter("level_cbm > 0 and month(date) in (1, 4, 12)")
    return series.resample_months(daily, "date", ["inflow_cbm"], ["level_cbm"])


@query
def client_share(spark, sf):
    return inventory.client_share(simple_flows(spark, sf))


@query
def inventory_kpis(spark, sf):
    return inventory.inventory_kpis(inventory.daily_levels(simple_flows(spark, sf)))


@query
def calendar_days(spark, sf):
    bounds = table(spark, sf, "orders").agg(
        F.min("o_orderdate").cast("date").alias("lo"), F.max("o_orderdate").cast("date").alias("hi")
    )
    return series.days_between(bounds, "lo", "hi")


# ---- sources, projections, filters -------------------------------------------------------------


@query
def csv_site_extracts(spark, sf):
    """Receipts of three sites written as CSV extracts, loaded and united."""
    base = f"{shared_dir(spark)}/extracts-{uuid.uuid4().hex}"
    rows = view(spark, sf, "receipts").withColumn("referencia", F.lit("x"))
    for site, own in (
        ("", ~F.col("idcontacto").rlike("_[ce]$")),
        ("_c", F.col("idcontacto").endswith("_c")),
        ("_e", F.col("idcontacto").endswith("_e")),
    ):
        bare = rows.filter(own).withColumn("idcontacto", F.regexp_replace("idcontacto", "_[ce]$", ""))
        bare.write.mode("overwrite").option("header", True).option("encoding", "ISO-8859-1").csv(
            f"{base}/incompra{site}.csv"
        )
    loaded = union_all([read_site(spark, base, "receipts", s) for s in ("", "_c", "_e")])
    return dates.coerce_dates(loaded, "fecha").select("idingreso", "fecha", "idcontacto", "retnum", "descrip")


@query
def site_tag_union(spark, sf):
    orders = view(spark, sf, "orders_out")
    status = F.coalesce("estatus", F.lit("1"))
    slices = [("1", "", ["numero", "trannum", "idcentro"]), ("5", "_c", ["numero", "trannum"]), ("9", "_e", ["numero"])]
    parts = [
        mark_site(orders.filter(status == value).select(*names), SITE_KEYS["orders_out"], site)
        for value, site, names in slices
    ]
    return union_all(parts)


@query
def focus_client(spark, sf):
    (receipts,) = focus.focus_client([view(spark, sf, "receipts")], CLIENT)
    return receipts.select("idingreso", "fecha", "idcontacto", "retnum")


@query
def focus_warehouse(spark, sf):
    located = screening.located(view(spark, sf, "stock"))
    (rows,) = focus.focus_warehouse([located], WAREHOUSE)
    return rows.groupBy("bodega", "idubica", "idstatus").agg(F.count("*").alias("rows"), F.sum("inicial").alias("cbm"))


@query
def filter_exact(spark, sf):
    (rows,) = focus.filter_exact([screening.located(view(spark, sf, "stock"))], "bodega", "BODJ")
    return rows.groupBy("idubica").agg(F.count("*").alias("rows"))


@query
def entity_list(spark, sf):
    return focus.list_entities(view(spark, sf, "clients"))


@query
def exclude_ids(spark, sf):
    kept = cleaned(spark, sf)
    return kept.clients.select(F.col("idcontacto").alias("id"), F.lit("client").alias("kind")).unionByName(
        kept.centers.select(F.col("idcentro").alias("id"), F.lit("center").alias("kind"))
    )


def cleaned_counts(t):
    counts = [
        df.agg(F.count("*").alias("rows"), F.count_distinct("fecha").alias("dates")).select(
            F.lit(n).alias("name"), "rows", "dates"
        )
        for n, df in t.items()
        if "fecha" in df.columns
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def clean_status_filters(spark, sf):
    """Rows left in every table after cleaning, and how many different dates they have."""
    return cleaned_counts(cleaned(spark, sf))


@query
def blank_to_default(spark, sf):
    lines = cleaned(spark, sf).order_lines_out
    return lines.groupBy("idubica", "idubica1", "idcoldis").agg(F.count("*").alias("rows"))


@query
def parse_mixed_dates(spark, sf):
    rows = view(spark, sf, "typed_text")
    return rows.select("o_orderkey", "date_text", dates.parse_day_first(F.col("date_text")).alias("parsed"))


@query
def coerce_numbers(spark, sf):
    rows = view(spark, sf, "typed_text").withColumn("amount", numbers.measure(F.col("amount_text")))
    return rows.groupBy(dates.month_label(F.col("o_orderdate")).alias("month")).agg(
        F.sum("amount").alias("amount"), F.count("amount").alias("numbers"), F.count("*").alias("rows"),
        F.max(numbers.as_double(F.col("amount_text"))).alias("largest"),
    )


@query
def zero_pad_keys(spark, sf):
    rows = view(spark, sf, "typed_text")
    return rows.select(
        "o_orderkey",
        text.zero_pad(F.col("receipt_text"), 8).alias("padded"),
        text.ten_digit_receipt(F.col("receipt_text")).alias("receipt"),
    )


@query
def clip_near_zero(spark, sf):
    noise = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", ((F.col("l_discount") - 0.05) * F.lit(4e-5) * F.col("l_quantity")).alias("value")
    )
    clipped = numbers.clip_near_zero(noise, ["value"])
    return clipped.groupBy("l_linenumber").agg(
        F.count_if(F.col("value") == 0).alias("zeros"), F.max("value").alias("largest"), F.min("value").alias("smallest")
    )


@query
def detached_volume(spark, sf):
    ddma = numbers.detached_later(
        F.col("modifica"), F.col("fecha"), [F.col(c) for c in flows.STOCK_MEASURES], F.col("idpedido")
    )
    return view(spark, sf, "stock").groupBy("idstatus").agg(
        F.sum(ddma).alias("ddma"), F.count(ddma).alias("items"), F.count("*").alias("rows")
    )


# ---- warehouses --------------------------------------------------------------------------------


@query
def assign_warehouse(spark, sf):
    places = view(spark, sf, "stock").select("idubica").unionByName(view(spark, sf, "order_lines_out").select("idubica"))
    return screening.located(places).groupBy("idubica", "bodega").agg(F.count("*").alias("rows"))


@query
def warehouse_override(spark, sf):
    rows = screening.site_forced(screening.located(view(spark, sf, "stock")))
    return rows.groupBy("idcontacto", "bodega").agg(F.count("*").alias("rows"))


@query
def resolve_warehouse(spark, sf):
    """Candidates of every stock row: its own location, and one made from its supplier's rows."""
    rows = screening.located(view(spark, sf, "stock")).withColumns(
        {
            "other": F.when(F.col("idmodelo").isNull(), None).otherwise(wh.assign_warehouse(F.reverse("idubica"))),
            "place": F.nullif(F.col("idubica1"), F.lit("")),
        }
    )
    resolved = wh.resolve_warehouse(F.col("bodega"), F.col("other"), F.col("place"))
    return rows.withColumn("resolved", resolved).groupBy("bodega", "other", "resolved").agg(F.count("*").alias("rows"))


@query
def fill_unknown_warehouse(spark, sf):
    rows = screening.located(view(spark, sf, "stock")).select("idingreso", "itemno", "idcoldis", "idcentro", "bodega")
    rows = rows.withColumn("place", F.concat("idcentro", "idcoldis"))
    filled = quality.handle_unknown_warehouse(rows, key="place").filled
    return filled.groupBy("place", "bodega").agg(F.count("*").alias("rows"))


@query
def fill_unknown_counts(spark, sf):
    rows = screening.located(view(spark, sf, "stock")).withColumn("place", F.concat("idcentro", "idcoldis"))
    return quality.fill_counts(rows, key="place")


# ---- first per key, screening ------------------------------------------------------------------


@query
def first_per_receipt(spark, sf):
    return screening.one_per_receipt(view(spark, sf, "receipt_versions"))


@query
def latest_item_per_key(spark, sf):
    rows = first.latest_per_item(view(spark, sf, "stock"), "idingreso", "itemno", "fecha", flows.STOCK_TIE)
    return rows.select("idingreso", "itemno", "fecha", "idstatus", "idmodelo", "idubica", "inicial")


@query
def screened_receipts(spark, sf):
    rows = screened(spark, sf).receipts
    return rows.select("idingreso", "fecha", "descrip", "idcontacto", "retnum", "idubica", "bodega")


@query
def screened_dispatches(spark, sf):
    rows = screened(spark, sf).dispatches
    return rows.select("trannum", "lineano", "fecha", "cantidad", "idingreso", "itemno", "idubica", "bodega")


@query
def screened_headers(spark, sf):
    return screened(spark, sf).dispatch_headers.select("trannum", "numero", "fecha", "idcontacto", "idubica", "bodega")


@query
def screened_stock(spark, sf):
    return screened(spark, sf).stock.groupBy("bodega", "idcontacto").agg(
        F.count("*").alias("rows"), F.sum("inicial").alias("cbm")
    )


# ---- monthly flows -----------------------------------------------------------------------------


@query
def monthly_receipts(spark, sf):
    return received(spark, sf).by_client


@query
def receipt_items(spark, sf):
    fact = received(spark, sf).fact
    return fact.select("idingreso", "itemno", "fecha", "idcontacto", "idmodelo", "inicial", "ddma", "bodega")


@query
def monthly_dispatches(spark, sf):
    return shipped(spark, sf).by_client


@query
def monthly_dispatches_by_item(spark, sf):
    return shipped(spark, sf, match_item=True).by_client


@query
def dispatch_items(spark, sf):
    sf = lined(spark, sf)
    fact = shipped(spark, sf).fact
    return fact.select("trannum", "idingreso", "itemno", "fecha", "arrived", "cantidad", "pesokgs", "idubica1", "bodega")


@query
def period_by_warehouse(spark, sf):
    sf = lined(spark, sf)
    sides = [("in", received(spark, sf).by_client), ("out", shipped(spark, sf).by_client)]
    parts = [flows.period_by_warehouse(df, START, END).withColumn("direction", F.lit(d)) for d, df in sides]
    return parts[0].unionByName(parts[1])


# ---- stock ---------------------------------------------------------------------------------------


@query
def complete_volume(spark, sf):
    _, full = completed_stock(spark, sf)
    return full.groupBy("bodega", "idmodelo").agg(F.sum("inicial").alias("cbm"), F.count("*").alias("rows"))


@query
def stock_by_warehouse(spark, sf):
    t, full = completed_stock(spark, sf)
    return stock.stock_by_warehouse(full, view(spark, sf, "product_volume"), t.clients).summary


@query
def stock_proportions(spark, sf):
    t, full = completed_stock(spark, sf)
    return stock.stock_proportions(full, view(spark, sf, "product_volume"), t.clients)


@query
def stock_ageing(spark, sf):
    t, full = completed_stock(spark, sf)
    return stock.stock_ageing(full, view(spark, sf, "product_volume"), t.clients, AS_OF)


@query
def stock_ageing_by_date(spark, sf):
    t, full = completed_stock(spark, sf)
    aged = stock.stock_ageing(full, view(spark, sf, "product_volume"), t.clients, AS_OF, by_product=False)
    return aged.select("date", "days", "cbm", "units", "pallets", "cbm_pct")


@query
def unmatched_products(spark, sf):
    return stock.products_without_volume(screened(spark, sf).stock, view(spark, sf, "product_volume"))


# ---- billing -------------------------------------------------------------------------------------


@query
def pallet_mode(spark, sf):
    return billing.pallet_mode(stock_fact(spark, sf))


@query
def pallet_fills(spark, sf):
    return fills(spark, sf, None)


@query
def billing_inflow(spark, sf):
    mode = billing.pallet_mode(stock_fact(spark, sf))
    return billing.billing_inflow(received(spark, sf).fact, mode, START, END)


@query
def billing_stock(spark, sf):
    return billing.billing_stock(stock_fact(spark, sf), AS_OF)


@lru_cache(maxsize=16)
def outflow_lines(spark, sf, facts):
    t = cleaned(spark, sf)
    width = flows.widest((t.dispatches, "idcontacto"), (t.clients, "idcontacto"))
    clients = flows.padded(t.clients, "idcontacto", width)
    return billing.billing_outflow(shipped(spark, sf).fact, fills(spark, sf, facts), t.receipts, clients, START, END)


@query
def billing_outflow(spark, sf):
    return outflow_lines(spark, lined(spark, sf), None)


@query
def billing_totals(spark, sf):
    sf = lined(spark, sf)
    facts = kept(sf, stock_fact(spark, sf), "on-hand")
    lines_in = billing.billing_inflow(received(spark, sf).fact, modes(spark, sf, facts), START, END)
    return billing.billing_totals(lines_in, outflow_lines(spark, sf, facts), billing.billing_stock(facts, AS_OF))


@query
def report_daily_level(spark, sf):
    """The level over time of the whole report: from screened tables over billing rows to levels."""
    sf = lined(spark, sf)
    rows_in = billing.billing_inflow_detail(received(spark, sf).fact, modes(spark, sf, None))
    rows_out = billing.billing_outflow_detail(shipped(spark, sf).fact, fills(spark, sf, None))
    return inventory.daily_levels(inventory.flow_rows(rows_in, rows_out))


@query
def report_kpis(spark, sf):
    sf = lined(spark, sf)
    t = tables(spark, sf)
    report = reports.client_report(
        t, view(spark, sf, "product_volume"), view(spark, sf, "pallet_override"), "01-01-1997", "31/12/98", AS_OF,
        keep_shared=False,
    )
    return report.kpis


@lru_cache(maxsize=16)
def warehouse_report(spark, sf):
    return reports.client_report(
        tables(spark, sf), view(spark, sf, "product_volume"), view(spark, sf, "pallet_override"), "01-01-1997",
        "31/12/98", AS_OF, warehouse=WAREHOUSE, keep_shared=False,
    )


@query
def report_warehouse_receipts(spark, sf):
    return warehouse_report(spark, sf).monthly_receipts


@query
def report_warehouse_dispatches(spark, sf):
    return warehouse_report(spark, sf).monthly_dispatches


@query
def report_warehouse_stock(spark, sf):
    return warehouse_report(spark, sf).stock_by_warehouse


@query
def report_warehouse_billing(spark, sf):
    return warehouse_report(spark, sf).billing_inflow


# ---- quality -------------------------------------------------------------------------------------


@query
def missing_receipts(spark, sf):
    """Receipts dispatched but not in the register, where some stand under another id."""
    return quality.missing_receipts(view(spark, sf, "dispatches"), view(spark, sf, "register"))


@query
def registered_dispatches(spark, sf):
    kept = lookup.present_keys(view(spark, sf, "dispatches"), view(spark, sf, "register"), "idingreso")
    return kept.groupBy("idclase").agg(F.count("*").alias("rows"), F.sum("cantidad").alias("cbm"))


@query
def duplicate_receipts(spark, sf):
    return quality.duplicate_receipts(view(spark, sf, "receipt_versions"))


@query
def undescribed_receipts(spark, sf):
    return quality.undescribed_receipts(view(spark, sf, "receipts")).select("idingreso", "idcontacto")


# ---- labour --------------------------------------------------------------------------------------


@lru_cache(maxsize=16)
def tasks(spark, sf):
    """Labour rows; a start and end are stored times here, so only names and types are due."""
    return view(spark, sf, "labor_tasks").withColumns({c: F.col(c).cast("timestamp") for c in ("start", "end")})


@lru_cache(maxsize=16)
def costed(spark, sf):
    return labor.labor_cost(tasks(spark, sf), view(spark, sf, "wages"))


@lru_cache(maxsize=16)
def adjusted(spark, sf):
    return labor.labor_overlap_adjust(costed(spark, sf))


@lru_cache(maxsize=16)
def margin(spark, sf):
    operations = labor.labor_operations_warehouse(adjusted(spark, sf)).operations
    return labor.labor_margin(operations, view(spark, sf, "overtime_tariffs"), 2024)


@query
def labor_cost(spark, sf):
    return costed(spark, sf).groupBy("codigo", "fecha").agg(
        *[F.sum(c).alias(c) for c in ("day_cost", "night_cost", "total_cost")], F.max(F.col("is_sunday").cast("int")).alias("sunday")
    )


@query
def interval_islands(spark, sf):
    groups = intervals.islands(tasks(spark, sf), ["codigo", "fecha"], "start", "end")
    return groups.select("codigo", "fecha", "island_start", "island_end", "tasks").distinct()


@query
def overlap_report(spark, sf):
    groups = intervals.overlap_groups(tasks(spark, sf), ["codigo", "fecha"], "start", "end")
    return groups.select("codigo", "fecha", "island_start", "island_end", "tasks", "double_hours")


@query
def covered_hours(spark, sf):
    return intervals.union_length(tasks(spark, sf), ["codigo", "fecha"], "start", "end")


@query
def labor_overlap_adjust(spark, sf):
    return adjusted(spark, sf).select(
        "codigo", "fecha", "start", "end", "total_cost", "duration_hours", "adjusted_cost", "adjusted_hours"
    )


@query
def labor_operations_warehouse(spark, sf):
    return labor.labor_operations_warehouse(adjusted(spark, sf)).operations


@query
def labor_person_hours(spark, sf):
    return labor.labor_operations_warehouse(adjusted(spark, sf)).person_hours


@query
def operation_span(spark, sf):
    return labor.labor_operations_warehouse(adjusted(spark, sf)).spans


@query
def overtime_by_worker(spark, sf):
    return labor.labor_operations_warehouse(adjusted(spark, sf)).by_worker


@query
def labor_operations_delivery(spark, sf):
    return labor.labor_operations_delivery(costed(spark, sf)).operations


@query
def delivery_by_worker(spark, sf):
    return labor.labor_operations_delivery(costed(spark, sf)).by_worker


@query
def labor_margin_by_month(spark, sf):
    return margin(spark, sf).by_warehouse


@query
def labor_margin_by_client(spark, sf):
    return margin(spark, sf).by_client


@query
def labor_margin_by_operation(spark, sf):
    return margin(spark, sf).by_operation.select(
        "fecha", "idcontacto", "bodega", "people", "billable_hours", "paid", "gross", "net", "margin_pct"
    )


@query
def labor_margin_rollups(spark, sf):
    """Both monthly margins from one pass by grouping sets."""
    return margin(spark, sf).rollups


@query
def task_concurrency(spark, sf):
    return sweep.concurrency(tasks(spark, sf), ["codigo", "fecha"], "start", "end")


@query
def operation_peaks(spark, sf):
    return sweep.peaks(tasks(spark, sf), ["fecha", "idcontacto", "bodega"], "start", "end")


@query
def task_overlaps(spark, sf):
    found = sweep.time_overlapped(tasks(spark, sf), ["codigo", "fecha"], "start", "end")
    return found.select("codigo", "fecha", "start", "end", "overlapped_seconds")


# ---- levels by month, and at a date ------------------------------------------------------------


@lru_cache(maxsize=16)
def client_days(spark, sf):
    """What each client received less what was shipped, per day."""
    flows_ = simple_flows(spark, sf).filter("idcontacto is not null")
    return flows_.groupBy("idcontacto", "date").agg((F.sum("inflow_cbm") - F.sum("outflow_cbm")).alias("net"))


@lru_cache(maxsize=16)
def client_openings(spark, sf):
    return view(spark, sf, "opening_levels").withColumnRenamed("initial_inventory", "opening")


@query
def level_months(spark, sf):
    functions = levels.month_functions(client_days(spark, sf), "date", "net", ["idcontacto"])
    return levels.month_states(functions, ["idcontacto"], client_openings(spark, sf))


@query
def level_from_months(spark, sf):
    """The level of every client and day, from the months' states. Days are read twice, so they are stored."""
    days = share(client_days(spark, sf), "client-days")
    states = levels.month_states(levels.month_functions(days, "date", "net", ["idcontacto"]), ["idcontacto"], client_openings(spark, sf))
    return levels.levels_in_months(days, states, "date", "net", ["idcontacto"], "level_cbm")


@query
def level_rebooked(spark, sf):
    """States stored before the goods booked late were known, then mended from the month of the first of them."""
    known = inventory.flow_rows(
        view(spark, sf, "received_rows").filter(~((F.col("fecha") >= START) & F.col("idcontacto").endswith("_c"))), view(spark, sf, "shipped_rows")
    )
    days = known.filter("idcontacto is not null").groupBy("idcontacto", "date").agg((F.sum("inflow_cbm") - F.sum("outflow_cbm")).alias("net"))
    opening = client_openings(spark, sf)
    stored = levels.month_states(levels.month_functions(days, "date", "net", ["idcontacto"]), ["idcontacto"], opening)
    late = client_days(spark, sf).filter(F.col("date") >= F.trunc(F.lit(START).cast("date"), "MM"))
    return levels.rebooked(share(stored, "level-states"), late, START, "date", "net", ["idcontacto"], opening)


@query
def level_at_date(spark, sf):
    """Each client's level ten days after every order of it."""
    asked = view(spark, sf, "receipts").select("idingreso", "idcontacto", F.date_add("fecha", 10).alias("day"))
    held = inventory.level_by_client(simple_flows(spark, sf), view(spark, sf, "opening_levels"))
    return levels.level_at(held, asked, "idcontacto", "day", opening=client_openings(spark, sf))


@query
def measures_by_need(spark, sf):
    """Amounts from millionths to hundreds of trillions, each kept and summed exactly."""
    texts = table(spark, sf, "orders").select(
        F.substring("o_orderpriority", 1, 1).alias("priority"),
        F.concat(F.lit("0.0000"), (F.col("o_orderkey") % 90 + 10).cast("string")).alias("small"),
        F.concat((F.col("o_orderkey") % 900 + 100).cast("string"), F.lit("000000000000.5")).alias("large"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price"),
    )
    types = numbers.fitted_types(texts, "small", "large", "price")
    exact = numbers.coerce_fitted(texts, types)
    return exact.groupBy("priority").agg(*[F.sum(c).cast("string").alias(c) for c in types])


# ---- files read back ---------------------------------------------------------------------------


def order_files(spark, sf) -> str:
    """Orders as four files of two column orders, with every kind of line that a tolerant read must tell apart."""
    base = f"{shared_dir(spark)}/order-files-{uuid.uuid4().hex}"
    key, kind, part = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 10, (F.col("o_orderkey") % 4).cast("int")
    note = F.when(kind == 3, "x,").when(kind == 7, '"a,""b"""').otherwise("x")
    first = F.when(kind == 5, F.concat_ws(",", key, "o_orderstatus")).when(kind == 9, F.concat_ws(",", key, "o_orderstatus", F.lit('"x'))).otherwise(
        F.concat_ws(",", key, "o_orderstatus", note)
    )
    second = F.when(kind == 5, F.concat_ws(",", F.lit("x"), key)).when(kind == 9, F.concat_ws(",", F.lit("x"), key, F.lit('"F'))).otherwise(
        F.concat_ws(",", note, key, F.col("o_orderstatus"))
    )
    lines = table(spark, sf, "orders").select(part.alias("part"), F.col("o_orderkey").alias("ord"), F.when(part < 2, first).otherwise(second).alias("value"))
    heads = spark.range(4).select(
        F.col("id").cast("int").alias("part"), F.lit(-1).cast("long").alias("ord"),
        F.when(F.col("id") < 2, "clave,estado,nota").otherwise("nota,clave,estado").alias("value"),
    )
    whole = lines.unionByName(heads).repartition("part").sortWithinPartitions("part", "ord")
    whole.select("part", "value").write.partitionBy("part").text(base)
    return f"{base}/*"


@query
def csv_mixed_headers(spark, sf):
    return read_extract(spark, order_files(spark, sf), tolerant=True)


@query
def csv_rejected_lines(spark, sf):
    rejects = rejected_lines(spark, order_files(spark, sf))
    return rejects.select(F.regexp_extract("file", "part=([0-9]+)", 1).alias("part"), "line", "reason", "fields", "expected")


@query
def override_from_file(spark, sf):
    """An override sheet with repeated products: of each, the line that comes first in the file counts."""
    base = f"{shared_dir(spark)}/override-{uuid.uuid4().hex}"
    sheet = table(spark, sf, "part").orderBy("p_partkey").select((F.col("p_partkey") % 97).cast("string").alias("idmodelo"), F.col("p_size").alias("mode_count"))
    sheet.coalesce(1).write.option("header", True).csv(base)
    given = read_pallet_override(spark, base)
    none = given.select("idmodelo", F.lit(None).cast("long").alias("mode_count")).limit(0)
    return billing.mode_with_override(none, given)


@query
def volume_from_file(spark, sf):
    """The volume sheet written and read back, and the stock volumes it leads to."""
    path = f"{shared_dir(spark)}/volume-{uuid.uuid4().hex}"
    view(spark, sf, "product_volume").write.option("header", True).option("quoteAll", True).csv(path)
    full = stock.complete_volume(screened(spark, sf).stock, read_product_volume(spark, path))
    return full.groupBy("bodega", "idmodelo").agg(F.sum("inicial").alias("cbm"), F.count("*").alias("rows"))


@query
def loaded_and_prepared(spark, sf):
    """All ten extracts written as CSV, loaded, focused on nobody and cleaned."""
    base = f"{shared_dir(spark)}/ten-extracts-{uuid.uuid4().hex}"
    for name, stem in STEMS.items():
        rows = view(spark, sf, name)
        times = {f.name: F.date_format(f.name, "yyyy-MM-dd HH:mm:ss") for f in rows.schema.fields if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))}
        # packed, as extracts are archived, and in files of a bounded number of rows, because one such file is one task's work
        packed = {"compression": "gzip", "maxRecordsPerFile": 1_000_000}
        with shuffles_removed(spark):
            rows.withColumns(times).write.options(header=True, encoding="ISO-8859-1", **packed).csv(f"{base}/{stem}.csv")
    ready = reports.prepare(load_tables(spark, base, sites=("",)))
    return cleaned_counts(ready)


@query
def delivery_from_files(spark, sf):
    """Labour sheets, wages and tariffs written under their sheet headers and run through the file report."""
    base = f"{shared_dir(spark)}/labour-{uuid.uuid4().hex}"
    t = tasks(spark, sf)
    hours = [F.col(c).alias(h) for c, h in (("day_hours", "Horas diurnas"), ("night_hours", "Horas nocturnas"), ("total_hours", "Total"))]
    clock = [F.date_format(c, "HH:mm:ss").alias(h) for c, h in (("start", "Hora de inicio"), ("end", "Hora de finalizacion"))]
    common = [F.date_format("fecha", "yyyy-MM-dd").alias("Fecha"), F.col("client").alias("Cliente"), F.col("worker").alias("Nombre"), F.col("codigo").alias("Codigo"), *clock, *hours]
    blank = lambda *names: [F.lit("").alias(n) for n in names]
    warehouse = t.select(*common, F.col("idcontacto").alias("Idcontacto"), F.col("bodega").alias("Bodega"), *blank("Descripcion", "Observaciones"))
    delivery = t.select(*common, F.col("route").alias("Ruta"), *blank("Tipo", "Puntos de entrega", "Puntos adicionales", "Aprobacion"))
    wages = view(spark, sf, "wages").toDF("Codigo", "Cargo", "Hora diurna", "Hora nocturna", "Hora domingo")
    tariffs = view(spark, sf, "overtime_tariffs").toDF("Idcontacto", "Precio H. Extra")
    sheets = {"warehouse": warehouse, "delivery": delivery, "wages": wages, "tariffs": tariffs}
    for name, sheet in sheets.items():
        sheet.write.option("header", True).csv(f"{base}/{name}")
    report = reports.overtime_report_from_files(spark, *[f"{base}/{n}" for n in sheets], "01-01-2000", "31-12-2050")
    return report.delivery.by_worker


def whole_report(spark, sf):
    """The report of all clients with its tables stored once. Each call stores its own: no query reads another's files."""
    sf = lined(spark, sf)
    return reports.client_report(
        tables(spark, sf), view(spark, sf, "product_volume"), view(spark, sf, "pallet_override"), "01-01-1997", "31/12/98", AS_OF,
    )


@query
def stored_report_daily(spark, sf):
    return whole_report(spark, sf).daily


@query
def stored_report_receipts(spark, sf):
    return whole_report(spark, sf).monthly_receipts


@query
def stored_report_dispatches(spark, sf):
    return whole_report(spark, sf).monthly_dispatches


@query
def stored_report_stock(spark, sf):
    return whole_report(spark, sf).stock_by_warehouse


@query
def stored_report_inflow(spark, sf):
    return whole_report(spark, sf).billing_inflow


@query
def stored_report_outflow(spark, sf):
    return whole_report(spark, sf).billing_outflow


@query
def stored_report_totals(spark, sf):
    return whole_report(spark, sf).billing_totals
