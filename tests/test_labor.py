"""Labour figures worked out by hand."""

import datetime as dt
from decimal import Decimal

import pytest

from stowage.plans import labor
from stowage.plans.reports import overtime_report

MONDAY, SUNDAY = dt.date(2024, 1, 1), dt.date(2024, 1, 7)

SHEET = (
    "Fecha date, Cliente string, Idcontacto string, Bodega string, Nombre string, Codigo string, Descripcion string, "
    "Observaciones string, `Hora de inicio` string, `Hora de finalizacion` string, `Horas diurnas` double, "
    "`Horas nocturnas` double, Total double"
)


def work(day, start, end, hours, code="1", client="7", warehouse="BODA", night=0.0):
    return (day, "Ana", client, warehouse, "Luz", code, None, None, start, end, hours, night, hours)


@pytest.fixture
def sheet(spark):
    return spark.createDataFrame(
        [
            # Two overlapping tasks of 2 h and 1 h that cost 10 and 6, one that only touches, one alone.
            work(MONDAY, "08:00:00", "10:00:00", 2.0),
            work(MONDAY, "09:30:00", "10:30:00", 1.2, client="8"),
            work(MONDAY, "10:30:00", "11:30:00", 1.0),
            work(SUNDAY, "08:00:00", "09:00:00", 1.0, night=0.5),
            # End before start, unusable time, worker without wage.
            work(MONDAY, "15:00:00", "14:00:00", 1.0, client="9"),
            work(MONDAY, "tarde", "14:00:00", 1.0, client="9"),
            work(MONDAY, "08:00:00", "09:00:00", 1.0, code="2"),
        ],
        SHEET,
    )


@pytest.fixture
def wages(spark):
    return spark.createDataFrame(
        [("1", "Aux", 5.0, 6.0, 8.0, "E", "N")],
        "Codigo string, Cargo string, `Hora diurna` double, `Hora nocturna` double, `Hora domingo` double, Empresa string, `Nombre Completo` string",
    )


def adjusted(sheet, wages):
    costed = labor.labor_cost(labor.labor_normalize(sheet), labor.wages_normalize(wages))
    return labor.labor_overlap_adjust(costed)


def test_cost_uses_the_sunday_rate(sheet, wages):
    costed = labor.labor_cost(labor.labor_normalize(sheet), labor.wages_normalize(wages), SUNDAY, SUNDAY)
    row = costed.first()
    assert costed.count() == 1 and row.is_sunday and row.total_cost == Decimal(12)


def test_overlapping_tasks_share_the_largest_cost(sheet, wages):
    rows = {(r.fecha, r.start_time): r for r in adjusted(sheet, wages).collect()}
    assert len(rows) == 6
    two, one = rows[MONDAY, "08:00:00"], rows[MONDAY, "09:30:00"]
    assert (two.adjusted_cost, one.adjusted_cost) == (Decimal("6.6667"), Decimal("3.3333"))
    # 3 h of tasks cover 2.5 h.
    assert (two.adjusted_hours, one.adjusted_hours) == (Decimal("1.6667"), Decimal("0.8333"))
    touching = rows[MONDAY, "10:30:00"]
    assert (touching.adjusted_cost, touching.adjusted_hours) == (Decimal(5), Decimal(1))
    backwards, unusable = rows[MONDAY, "15:00:00"], rows[MONDAY, "tarde"]
    assert (backwards.adjusted_cost, backwards.adjusted_hours) == (Decimal(5), Decimal(-1))
    assert (unusable.adjusted_cost, unusable.adjusted_hours) == (Decimal(5), None)


def test_operations(sheet, wages):
    got = labor.labor_operations_warehouse(adjusted(sheet, wages), MONDAY, MONDAY)
    ops = {r.idcontacto: r for r in got.operations.collect()}
    assert (ops["7"].people, ops["7"].worked_hours, ops["7"].billable_hours) == (2, Decimal(2), Decimal(2))
    assert ops["7"].paid == Decimal("11.6667") and ops["8"].billable_hours == Decimal(2)
    spans = {r.idcontacto: r.span_hours for r in got.spans.collect()}
    assert spans == {"7": 4, "8": 1, "9": -1}  # the clock of client 9 runs backwards
    assert {r.idcontacto: r.person_hours for r in got.person_hours.collect()}["7"] == Decimal("2.6667")
    assert [(r.codigo, r.paid) for r in got.by_worker.collect()] == [("1", Decimal("25.0000"))]


def test_report_margins(spark, sheet, wages):
    ride = "Fecha date, Cliente string, ` Ruta ` string, Nombre string, Codigo string, `Horas diurnas` double, `Horas nocturnas` double, Total double"
    rides = spark.createDataFrame(
        [(MONDAY, "Ana", "R1", None, "1", 2.0, 0.0, 2.0), (MONDAY, "Ana", "R1", "Luz", "1", 1.0, 0.0, 1.0), (SUNDAY, "Ana", "R1", "Luz", "1", 1.0, 0.0, 1.0)],
        ride,
    )
    tariffs = spark.createDataFrame([("7", 10.0), ("8", 0.0)], "Idcontacto string, `Precio H. Extra` double")
    got = overtime_report(sheet, rides, wages, tariffs, year=2024)
    margins = {(r.fecha, r.idcontacto): r for r in got.margin.by_operation.collect()}
    seven = margins[MONDAY, "7"]
    assert (seven.gross, seven.net, seven.margin_pct) == (Decimal(20), Decimal("8.3333"), 41.67)
    assert margins[MONDAY, "8"].margin_pct == 0.0 and margins[MONDAY, "9"].margin_pct is None
    (month,) = got.margin.by_warehouse.collect()
    assert month.gross == Decimal(40) and month.month == MONDAY
    assert overtime_report(sheet, rides, wages, tariffs, year=2023).margin.by_client.count() == 0
    deliveries = {r.fecha: r for r in got.delivery.operations.collect()}
    assert (deliveries[MONDAY].people, deliveries[MONDAY].paid, deliveries[MONDAY].day_hours_per_head) == (2, Decimal(15), 1.0)
    assert deliveries[MONDAY].change_pct is None and round(deliveries[SUNDAY].change_pct, 4) == -46.6667
    assert {r.worker for r in got.delivery.by_worker.collect()} == {"Luz", "Unknown"}
