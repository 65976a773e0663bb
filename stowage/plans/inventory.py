"""Inventory level over time, client shares and monthly indicators."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stowage.functions.dates import days_in_month, in_range, month_of
from stowage.functions.numbers import MEASURE, change_percent, clip_near_zero, ratio, round2
from stowage.operators.series import clamped_level, resample_months, with_previous
from stowage.operators.totals import shares

IN = ["inflow_cbm", "units_in", "pallets_in"]
OUT = ["outflow_cbm", "units_out", "pallets_out"]
WIDE = "decimal(28,4)"  # sums of measures, which are summed again


def _side(df: DataFrame, columns: dict[str, str], all_names: list[str]) -> DataFrame:
    zero = F.lit(0).cast(MEASURE)
    sums = [
        (F.col(columns[n]).cast(MEASURE) if n in columns else zero).alias(n) for n in all_names
    ]
    return df.select(F.to_date("fecha").alias("date"), "idcontacto", *sums).filter(F.col("date").isNotNull())


def flow_rows(inflow: DataFrame, outflow: DataFrame) -> DataFrame:
    """Received and shipped rows in one shape: date, client and six measures."""
    names = [*IN, *OUT]
    received = _side(inflow, {"inflow_cbm": "inicial", "units_in": "pesokgs", "pallets_in": "pallets_final"}, names)
    shipped = _side(
        outflow, {"outflow_cbm": "cantidad", "units_out": "pesokgs", "pallets_out": "calculated_pallets"}, names
    )
    return received.unionByName(shipped)


def summed_flows(flows: DataFrame) -> DataFrame:
    """Flow rows summed per date and client: all that the levels, shares and indicators need of them."""
    return flows.groupBy("date", "idcontacto").agg(*[c.cast(WIDE).alias(n) for n, c in zip((*IN, *OUT), _sums())])


def _sums() -> list[Column]:
    return [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (*IN, *OUT)]


def _opening(flows: DataFrame, opening: DataFrame | None) -> Column:
    """Opening level: the sum over the clients that occur in the flows; zero when none is given."""
    if opening is None:
        return F.lit(0).cast(MEASURE)
    present = opening.join(flows.select("idcontacto").distinct(), "idcontacto", "left_semi")
    return F.coalesce(present.agg(F.sum("initial_inventory")).scalar(), F.lit(0)).cast(MEASURE)


class OverTime(NamedTuple):
    daily: DataFrame
    monthly: DataFrame


def daily_levels(flows: DataFrame, start=None, end=None, opening: DataFrame | None = None) -> DataFrame:
    """Level on every date with a movement.

    All rows of a date are combined before anything is ordered, so a table of clients by dates is
    never built and the running level sees one row per date.
    """
    first = _opening(flows, opening)
    daily = flows.filter(in_range(F.col("date"), start, end)).groupBy("date").agg(*_sums())
    daily = daily.withColumn("initial_inventory", first)
    net = F.col("inflow_cbm") - F.col("outflow_cbm")
    leveled = clamped_level(daily, "date", net, F.col("initial_inventory"), name="level_cbm")
    leveled = leveled.withColumn("opening_level_cbm", F.col("level_cbm") - F.col("inflow_cbm") + F.col("outflow_cbm"))
    return clip_near_zero(leveled)


def monthly_levels(daily: DataFrame, flows: DataFrame) -> DataFrame:
    """Sums and last level of every calendar month, months without movement included."""
    months = resample_months(daily, "date", [*IN, *OUT], ["level_cbm"])
    client = flows.agg(F.min("idcontacto")).scalar()
    return months.withColumn("idcontacto", F.when(F.col("level_cbm").isNotNull(), client)).withColumnRenamed(
        "level_cbm", "final_level_cbm"
    )


def inventory_over_time(
    inflow: DataFrame, outflow: DataFrame, start=None, end=None, opening: DataFrame | None = None
) -> OverTime:
    """Daily and monthly inventory from received and shipped billing rows."""
    flows = flow_rows(inflow, outflow)
    daily = daily_levels(flows, start, end, opening)
    return OverTime(daily, monthly_levels(daily, flows))


def level_by_client(flows: DataFrame, opening: DataFrame | None = None) -> DataFrame:
    """Level of each client on the dates it moved goods, with the day until which it holds.

    Days without movement follow from ``valid_until``; they are not listed.
    """
    per_day = flows.filter(F.col("idcontacto").isNotNull()).groupBy("idcontacto", "date").agg(
        F.sum("inflow_cbm").alias("inflow_cbm"), F.sum("outflow_cbm").alias("outflow_cbm")
    )
    first = F.lit(0).cast(MEASURE)
    if opening is not None:
        per_day = per_day.join(opening, "idcontacto", "left")
        first = F.coalesce(F.col("initial_inventory"), F.lit(0)).cast(MEASURE)
    net = F.col("inflow_cbm") - F.col("outflow_cbm")
    leveled = clamped_level(per_day, "date", net, first, ["idcontacto"], "level_cbm")
    following = F.lead("date").over(Window.partitionBy("idcontacto").orderBy("date"))
    return leveled.withColumn("valid_until", F.date_sub(following, 1)).select(
        "idcontacto", "date", "valid_until", "inflow_cbm", "outflow_cbm", "level_cbm"
    )


def client_share(flows: DataFrame) -> DataFrame:
    """Received and shipped volume per client and its share of everything received."""
    per_client = flows.groupBy("idcontacto").agg(
        F.sum("inflow_cbm").alias("inflow_cbm"), F.sum("outflow_cbm").alias("outflow_cbm")
    )
    return shares(per_client, ["inflow_cbm"]).orderBy(F.desc("inflow_cbm"), "idcontacto")


def inventory_for_period(daily: DataFrame, start, end) -> DataFrame:
    return daily.filter(in_range(F.col("date"), start, end)).drop("initial_inventory")


def inventory_kpis(daily: DataFrame, start=None, end=None) -> DataFrame:
    """Turnover, days on hand and month-over-month changes; the range, if any, is by month."""
    monthly = daily.groupBy(month_of(F.col("date")).alias("month")).agg(
        F.sum("inflow_cbm").alias("inflow_cbm"),
        F.sum("outflow_cbm").alias("outflow_cbm"),
        F.max_by("level_cbm", "date").alias("level_cbm"),
    )
    measures = ("inflow_cbm", "outflow_cbm", "level_cbm")
    monthly = monthly.withColumns({c: F.col(c).cast("double") for c in measures})
    for c in measures:
        monthly = with_previous(monthly, c, "month", f"_{c}")
    average = (F.col("level_cbm") + F.col("_level_cbm")) / 2
    daily_out = F.col("outflow_cbm") / days_in_month(F.col("month"))
    indicators = {
        "turnover": ratio(F.col("outflow_cbm"), average),
        "days_on_hand": ratio(F.col("level_cbm"), daily_out),
        "inflow_mom_pct": change_percent(F.col("inflow_cbm"), F.col("_inflow_cbm")),
        "outflow_mom_pct": change_percent(F.col("outflow_cbm"), F.col("_outflow_cbm")),
        "level_mom_pct": change_percent(F.col("level_cbm"), F.col("_level_cbm")),
    }
    filled = monthly.withColumns({n: F.coalesce(c, F.lit(0.0)) for n, c in indicators.items()})
    rounded = filled.withColumns({n: round2(F.col(n)) for n in (*measures, *indicators)})
    in_months = in_range(
        F.col("month"),
        None if start is None else F.trunc(F.lit(start), "MM"),
        None if end is None else F.trunc(F.lit(end), "MM"),
    )
    return rounded.filter(in_months).select("month", *measures, *indicators).orderBy("month")
