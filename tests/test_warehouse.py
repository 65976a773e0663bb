"""Every location rule, and every combination of warehouse candidates."""

import itertools

from pyspark.sql import functions as F

from stowage.functions.warehouse import OUTDOOR, assign_warehouse, force_site_warehouse, resolve_warehouse

PLACES = {
    "P00000": "PISO", "E": "BODE", "E9Z": "BODE", "PE0000": "BODE", "A1": "BODA", "PA0000": "BODA", "C9": "BODC",
    "C1PE": "BODC", "PC0000": "BODC", "G": "BODG", "PG0000": "BODG", "PN0000": "BODJ", "P1": "BODJ", "B2": "BODJ",
    "M3": "BODJ", "V4": "BODJ", "TIENDA": "DESCONOCIDO", "e1": "DESCONOCIDO", " A1": "DESCONOCIDO", "": "DESCONOCIDO",
    None: "DESCONOCIDO",
} | {c: "INTEMPERIE" for c in OUTDOOR}


def test_every_location_rule(spark):
    rows = spark.createDataFrame([(k,) for k in PLACES], "c string").select("c", assign_warehouse(F.col("c"))).collect()
    assert {r[0]: r[1] for r in rows} == PLACES


def test_site_forces_warehouse(spark):
    rows = [("1_c", "BODA"), ("1_e", "BODA"), ("1_opl", "BODA"), ("1", "BODA"), (None, "BODG"), ("1_c", "BODC")]
    column = force_site_warehouse(F.col("i"), F.col("b"))
    got = [r[0] for r in spark.createDataFrame(rows, "i string, b string").select(column).collect()]
    assert got == ["BODC", "BODE", "OPL", "BODA", "BODG", "BODC"]


def expected(x, y, place):
    """The rule in words: one known side wins; two known sides go to the outbound one; floor needs both."""
    x, y = (v.strip().upper() if v is not None else None for v in (x, y))
    if "DESCONOCIDO" in (x, y) and x != y:
        other = y if x == "DESCONOCIDO" else x
        return "INCOHERENT VALUES" if other is None else other
    if None not in (x, y):
        if x != y:
            return y
        return "INCOHERENT VALUES" if x == "PISO" and place is None else x
    known = x if y is None else y
    return "INCOHERENT VALUES" if known in (None, "PISO") else known


def test_every_combination_of_candidates(spark):
    sides = [None, "", "DESCONOCIDO", "PISO", "BODA", " bodc "]
    cases = list(itertools.product(sides, sides, [None, "", "TIENDA", "DESCONOCIDO", "A1"]))
    column = resolve_warehouse(F.col("x"), F.col("y"), F.col("p")).alias("got")
    rows = spark.createDataFrame(cases, "x string, y string, p string").select("x", "y", "p", column).collect()
    assert len(rows) == len(cases)
    for r in rows:
        assert r.got == expected(r.x, r.y, r.p), r
