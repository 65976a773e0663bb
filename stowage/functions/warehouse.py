"""Which warehouse a row belongs to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stowage.functions.text import norm

UNKNOWN = "DESCONOCIDO"
INCOHERENT = "INCOHERENT VALUES"
FLOOR = "PISO"

# Yard slots, and the warehouse of each single-letter or exact location code.
OUTDOOR = ["C2PD", "C2PE", "C2PF", "C2PG", "C2PL", "C1PA", "C2PN", "C2PA", "C2P0", "C2PK", "C2PJ", "C2PI"]
WAREHOUSES = ["BODA", "BODC", "BODE", "BODG", "BODJ", "OPL", INCOHERENT, UNKNOWN, "INTEMPERIE", FLOOR]
# Client suffix and the warehouse it forces.
SITE_WAREHOUSE = {"_c": "BODC", "_e": "BODE", "_opl": "OPL"}


def assign_warehouse(location: Column) -> Column:
    """Warehouse of a location code; the first matching rule wins, null counts as unknown."""
    return (
        F.when(location == "P00000", FLOOR)
        .when(location.startswith("E") | (location == "PE0000"), "BODE")
        .when(location.isin(OUTDOOR), "INTEMPERIE")
        .when(location.startswith("A") | (location == "PA0000"), "BODA")
        .when(location.startswith("C") | (location == "PC0000"), "BODC")
        .when(location.startswith("G") | (location == "PG0000"), "BODG")
        .when(location.rlike("^[PBMV]"), "BODJ")
        .otherwise(UNKNOWN)
    )


def force_site_warehouse(client: Column, warehouse: Column) -> Column:
    """Clients of a single-warehouse site are always in that warehouse."""
    rules = [(client.endswith(suffix), site) for suffix, site in SITE_WAREHOUSE.items()]
    forced = F.when(rules[0][0], rules[0][1])
    for test, site in rules[1:]:
        forced = forced.when(test, site)
    return forced.otherwise(warehouse)


def resolve_warehouse(stock_side: Column, outbound_side: Column, outbound_location: Column) -> Column:
    """One warehouse from the two candidates a receipt may carry.

    A known side beats an unknown one; two known sides that differ go to the outbound side; floor
    stock is only accepted when both sides say so and the outbound location is known.
    """
    x, y = norm(stock_side), norm(outbound_side)
    unknown, incoherent = F.lit(UNKNOWN), F.lit(INCOHERENT)
    return (
        F.when((x == UNKNOWN) & ~y.eqNullSafe(unknown), F.coalesce(y, incoherent))
        .when((y == UNKNOWN) & ~x.eqNullSafe(unknown), F.coalesce(x, incoherent))
        .when(x != y, y)
        .when(x == FLOOR, F.when((y == FLOOR) & outbound_location.isNotNull(), y).otherwise(incoherent))
        .when(y == FLOOR, incoherent)
        .otherwise(F.coalesce(x, y, incoherent))
    )
