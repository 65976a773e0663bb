"""Overtime labour: cost, overlapping tasks, operations, margin."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stowage.functions.dates import at_time, hours_between, in_range, is_sunday, month_of
from stowage.functions.numbers import MEASURE, measure, percent, round2, total
from stowage.functions.text import blank_to
from stowage.operators.intervals import islands
from stowage.operators.series import change_within_key
from stowage.operators.totals import roll_ups

# Sheet headers and the names used from here on.
HEADERS = {
    "Fecha": "fecha", "Cliente": "client", "Idcontacto": "idcontacto", "Bodega": "bodega", "Nombre": "worker",
    "Codigo": "codigo", "Cargo": "position", "Descripcion": "description", "Observaciones": "notes",
    "Hora de inicio": "start_time", "Hora de finalizacion": "end_time", "Horas diurnas": "day_hours",
    "Horas nocturnas": "night_hours", "Total": "total_hours", "Tipo": "kind", "Ruta": "route",
    "Puntos de entrega": "stops", "Puntos adicionales": "extra_stops", "Aprobacion": "approval",
    "Hora diurna": "day_rate", "Hora nocturna": "night_rate", "Hora domingo": "sunday_rate",
    "Precio H. Extra": "hour_price",
}
# Wage-sheet columns that are not used.
WAGE_EXTRAS = ["N°", "Empresa", "Nombre Completo", "P. Ingreso"]

HOURS = ["day_hours", "night_hours", "total_hours"]
RATES = ["day_rate", "night_rate", "sunday_rate"]
OPERATION = ["fecha", "idcontacto", "bodega"]
ROUTE = ["fecha", "client", "route"]


def named(df: DataFrame) -> DataFrame:
    """Strip column names and give the sheet's columns their working names."""
    df = df.toDF(*[c.strip() for c in df.columns])
    return df.withColumnsRenamed({k: v for k, v in HEADERS.items() if k in df.columns})


def labor_normalize(sheet: DataFrame) -> DataFrame:
    """A labour sheet with working names, typed hours, day dates and a name for unnamed workers.

    With both times of day present the task's ``start`` and ``end`` are added.
    """
    df = named(sheet)
    df = df.withColumns({h: measure(F.col(h)) for h in HOURS if h in df.columns})
    df = df.withColumns({"worker": blank_to(F.col("worker"), "Unknown"), "codigo": F.col("codigo").cast("string")})
    if {"start_time", "end_time"} <= set(df.columns):
        df = df.withColumns({s: at_time(F.col("fecha"), F.col(f"{s}_time")) for s in ("start", "end")})
    return df


def wages_normalize(sheet: DataFrame) -> DataFrame:
    df = named(sheet.drop(*WAGE_EXTRAS))
    return df.withColumns(
        {"codigo": F.col("codigo").cast("string"), **{r: measure(F.col(r)) for r in RATES}}
    )


def labor_cost(tasks: DataFrame, wages: DataFrame, start=None, end=None) -> DataFrame:
    """Tasks of known workers with day, night and total cost; Sundays pay the Sunday rate."""
    df = tasks.filter(in_range(F.col("fecha"), start, end)).join(wages, "codigo")
    sunday = is_sunday(F.col("fecha"))

    def cost(hours: str, rate: str) -> Column:
        paid = F.col(hours) * F.when(sunday, F.col("sunday_rate")).otherwise(F.col(rate))
        return F.coalesce(paid, F.lit(0)).cast(MEASURE)

    df = df.withColumns(
        {
            "is_sunday": sunday,
            "day_cost": cost("day_hours", "day_rate"),
            "night_cost": cost("night_hours", "night_rate"),
        }
    )
    return df.withColumn("total_cost", (F.col("day_cost") + F.col("night_cost")).cast(MEASURE)).drop(*RATES)


def _portion(amount: Column, part: Column, whole: Column) -> Column:
    """amount * part / whole in ten-thousandths, halves up; whole numbers throughout, so exact.

    Amounts are ten-thousandths and parts are seconds of one day, which stays far inside a long.
    """
    doubled = amount * part * 2 + whole
    return ((doubled - F.pmod(doubled, whole * 2)) / (whole * 2)).cast("long")


def _seconds(start: str, end: str) -> Column:
    return F.unix_seconds(end) - F.unix_seconds(start)


def labor_overlap_adjust(tasks: DataFrame) -> DataFrame:
    """Share cost and time between a worker's overlapping tasks of one day.

    Tasks of one overlap group share the group's largest cost in proportion to their length, and
    their lengths shrink to the time actually covered. A task on its own keeps cost and length.
    Adds ``duration_hours``, ``adjusted_cost`` and ``adjusted_hours``.
    """
    keys = ["codigo", "fecha", "start"]
    duration = _seconds("start", "end")
    rows = tasks.withColumn("_seconds", duration)
    groups = islands(
        rows.dropna(subset=["codigo", "fecha"]).filter("_seconds > 0"),
        ["codigo", "fecha"], "start", "end",
        group_cost=F.max("total_cost"),
    ).select(
        *keys,
        (F.col("task_micros") / 1_000_000).cast("long").alias("_sum"),
        (F.col("union_micros") / 1_000_000).cast("long").alias("_union"),
        (F.col("group_cost") * 10_000).cast("long").alias("_cost"),
    )
    # Only tasks of positive length belong to a group; the others find none.
    probe = rows.withColumn("_grouped", F.col("_seconds") > 0)
    groups = groups.withColumn("_grouped", F.lit(True))
    joined = probe.join(groups, [*keys, "_grouped"], "left")
    shared_cost = (_portion(F.col("_cost"), F.col("_seconds"), F.col("_sum")) / 10_000).cast(MEASURE)
    ten_thousandths = F.lit(10_000)
    shared_hours = (_portion(F.col("_union") * ten_thousandths, F.col("_seconds"), F.col("_sum") * 3600) / 10_000).cast(
        MEASURE
    )
    own_hours = (_portion(F.col("_seconds") * ten_thousandths, F.lit(1), F.lit(3600)) / 10_000).cast(MEASURE)
    return joined.withColumns(
        {
            "duration_hours": own_hours,
            # A share of zero falls back to the task's own value.
            "adjusted_cost": F.coalesce(F.nullif(shared_cost, F.lit(0)), F.col("total_cost")),
            "adjusted_hours": F.coalesce(F.nullif(shared_hours, F.lit(0)), own_hours),
        }
    ).select(*tasks.columns, "duration_hours", "adjusted_cost", "adjusted_hours")


class WarehouseOperations(NamedTuple):
    operations: DataFrame
    spans: DataFrame
    person_hours: DataFrame
    individual: DataFrame
    by_worker: DataFrame


class DeliveryOperations(NamedTuple):
    operations: DataFrame
    individual: DataFrame
    by_worker: DataFrame


def _by_worker(tasks: DataFrame, hours: str, cost: str) -> DataFrame:
    return (
        tasks.withColumn("month", month_of(F.col("fecha")))
        .dropna(subset=["month", "codigo", "worker"])
        .groupBy("month", "codigo", "worker")
        .agg(total(hours).alias("hours"), total(cost).alias("paid"))
        .orderBy(F.desc("month"), F.desc("paid"), "codigo", "worker")
    )


def labor_operations_warehouse(tasks: DataFrame, start=None, end=None) -> WarehouseOperations:
    """Warehouse work per operation (day, client, warehouse) and per worker and month.

    ``tasks`` comes from ``labor_overlap_adjust``. Head-count, hours, cost, span and person-hours
    of an operation are one grouped pass, of which the results are projections.
    """
    rows = tasks.filter(in_range(F.col("fecha"), start, end))
    worked = F.col("day_hours") + F.col("night_hours")
    rows = rows.withColumns({"worked_hours": worked, "billable_hours": F.ceil(worked)})
    elapsed = F.unix_seconds("end") - F.unix_seconds("start")
    rows = rows.withColumn("task_hours", F.coalesce(F.greatest(elapsed, F.lit(0)), F.lit(0)) / 3600)
    per_operation = (
        rows.dropna(subset=OPERATION)
        .groupBy(*OPERATION)
        .agg(
            F.min("client").alias("client"),
            F.count("codigo").alias("people"),
            F.max("day_hours").alias("day_hours"),
            F.max("night_hours").alias("night_hours"),
            F.max("worked_hours").alias("worked_hours"),
            F.max("billable_hours").alias("billable_hours"),
            total("adjusted_cost").alias("paid"),
            total("adjusted_hours").alias("person_hours"),
            F.min("start").alias("first_start"),
            F.max("end").alias("last_end"),
        )
    )
    spans = per_operation.select(
        *OPERATION, "first_start", "last_end",
        F.ceil(hours_between(F.col("first_start"), F.col("last_end"))).alias("span_hours"),
    )
    return WarehouseOperations(
        per_operation.drop("person_hours", "first_start", "last_end"),
        spans,
        per_operation.select(*OPERATION, F.upper("client").alias("client"), "people", "person_hours", "paid"),
        rows.withColumn("client", F.upper("client")).orderBy(F.desc("fecha"), F.desc("bodega")),
        _by_worker(rows, "adjusted_hours", "adjusted_cost"),
    )


def labor_operations_delivery(tasks: DataFrame, start=None, end=None) -> DeliveryOperations:
    """Delivery work per operation (day, client, route), with per-head hours and change in cost."""
    rows = tasks.filter(in_range(F.col("fecha"), start, end))
    operations = (
        rows.dropna(subset=ROUTE)
        .groupBy(*ROUTE)
        .agg(
            F.count("codigo").alias("people"),
            F.max("day_hours").alias("day_hours"),
            F.max("night_hours").alias("night_hours"),
            F.max("total_hours").alias("total_hours"),
            total("total_cost").alias("paid"),
        )
    )
    per_head = {
        f"{h}_per_head": F.try_divide(F.col(h).cast("double"), F.col("people").cast("double")) for h in HOURS
    }
    operations = operations.withColumns(per_head).withColumn("paid_hours", F.col("total_hours"))
    changed = change_within_key(operations, "paid", "client", "fecha", "route")
    return DeliveryOperations(changed, rows, _by_worker(rows, "total_hours", "total_cost"))


class Margin(NamedTuple):
    """``rollups`` has the rows of ``by_client`` and ``by_warehouse`` from one pass, told apart by ``rolled_by``."""

    by_client: DataFrame
    by_warehouse: DataFrame
    by_operation: DataFrame
    rollups: DataFrame


def _margin(net: Column, gross: Column) -> Column:
    """Net over gross in percent; zero gross counts as margin zero, unknown gross as unknown."""
    return F.when(gross == 0, F.lit(0.0)).otherwise(percent(net, gross))


def labor_margin(operations: DataFrame, tariffs: DataFrame, year: int | None = None) -> Margin:
    """Income, net income and margin per operation, and per month by client and by warehouse."""
    prices = tariffs.select("idcontacto", measure(F.col("hour_price")).alias("hour_price"))
    gross = (F.col("hour_price") * F.col("billable_hours")).cast(MEASURE)
    priced = operations.join(prices, "idcontacto", "left").withColumn("gross", gross)
    priced = priced.withColumn("net", (F.col("gross") - F.col("paid")).cast(MEASURE))
    priced = priced.withColumns(
        {"margin_pct": round2(_margin(F.col("net"), F.col("gross"))), "month": month_of(F.col("fecha"))}
    )
    if year is not None:
        priced = priced.filter(F.year("fecha") == year)

    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("billable_hours", "worked_hours", "paid", "gross", "net")]
    monthly_margin = _margin(F.col("net"), F.col("gross"))

    def monthly(key: str) -> DataFrame:
        grouped = priced.dropna(subset=["month", key]).groupBy("month", key).agg(*sums)
        return grouped.withColumn("margin_pct", monthly_margin).orderBy("month", key)

    sets = {"client": ["month", "client"], "warehouse": ["month", "bodega"]}
    rolled = roll_ups(priced, sets, *sums).withColumn("margin_pct", monthly_margin)
    return Margin(monthly("client"), monthly("bodega"), priced.drop("month"), rolled)
