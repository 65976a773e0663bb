"""The twelve operational tables, their columns, and which columns carry a site suffix."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# File stem of each extract.
STEMS = {
    "asn_headers": "cohd",
    "orders_out": "rpshd",
    "order_lines_out": "rpsdt",
    "receipts": "incompra",
    "dispatches": "inmovid",
    "dispatch_headers": "inmovih",
    "stock": "insaldo",
    "products": "inmodelo",
    "centers": "ctcentro",
    "clients": "incontac",
}

# Extracts in which lines with surplus fields are skipped.
TOLERANT = ["order_lines_out", "dispatches", "stock", "products", "centers"]

# File suffix of each site; the second and third also mark their keys with it.
SITES = ["", "_c", "_e"]

# Key columns that get the site suffix.
SITE_KEYS = {
    "asn_headers": ["numero", "idcontacto", "retnum"],
    "orders_out": ["numero", "idcentro", "idcentro1", "trannum", "referencia"],
    "order_lines_out": ["numero", "idcontacto", "idmodelo", "idingreso"],
    "receipts": ["idingreso", "idcontacto", "retnum", "referencia"],
    "dispatches": ["trannum", "idmodelo", "idingreso", "idcontacto", "idcentro", "idcentro1", "numero"],
    "dispatch_headers": ["idcontacto", "referencia", "trannum", "idcentro", "idcentro1"],
    "stock": ["idcentro", "idingreso", "idcontacto", "retnum"],
    "products": [],
    "centers": ["idcentro"],
    "clients": ["idcontacto"],
}

# Columns kept of each table.
COLUMNS = {
    "asn_headers": [
        "idcoclase", "numero", "itemcount", "itemqty", "fecha", "idcontacto", "descrip", "idcostatus",
        "retnum", "equipo",
    ],
    "orders_out": [
        "numero", "estatus", "tipo", "fecha", "idcentro", "idcentro1", "descrip", "itemcount", "pzascan",
        "trannum", "equipo",
    ],
    "order_lines_out": [
        "numero", "itemline", "estatus", "idproducto", "idcontacto", "idmodelo", "idcoldis", "idubica",
        "cantidad", "equipo", "idubica1", "idingreso", "ingresa",
    ],
    "receipts": [
        "idingreso", "fecha", "items", "transtatus", "descrip", "available", "equipo", "idcontacto", "retnum",
    ],
    "dispatches": [
        "trannum", "lineano", "fecha", "cantidad", "idmodelo", "idcoldis", "idingreso", "itemno", "idcontacto",
        "equipo", "idcentro", "idcentro1", "idclase", "numero",
    ],
    "dispatch_headers": [
        "idbodega", "idclase", "numero", "fecha", "idcontacto", "referencia", "transtatus", "descrip",
        "trannum", "linead", "lineac", "idcliente", "equipo", "idcentro", "idcentro1",
    ],
    "stock": [
        "idcentro", "idbodega", "idingreso", "itemno", "idstatus", "idmodelo", "idcoldis", "fecha",
        "idcontacto", "retnum", "idubica", "pesokgs", "equipo", "inicial", "salidas", "idubica1", "idproducto",
    ],
    "dispatched_stock": [
        "idcentro", "idbodega", "idingreso", "itemno", "idstatus", "idmodelo", "idcoldis", "fecha", "ingresa",
        "idcontacto", "retnum", "idubica", "pesokgs", "equipo", "inicial", "salidas", "idpedido", "idubica1",
        "idproducto",
    ],
    "stock_all": [
        "idcentro", "idbodega", "idingreso", "itemno", "idstatus", "idmodelo", "idcoldis", "fecha", "modifica",
        "ingresa", "idcontacto", "retnum", "idubica", "pesokgs", "equipo", "inicial", "salidas", "idubica1",
        "idproducto", "idpedido",
    ],
    "clients": ["idcontacto", "descrip"],
    "centers": ["idcentro", "descrip"],
    "products": ["idmodelo", "descrip"],
}


@dataclass(frozen=True)
class Tables:
    """The operational tables; ``stock``, ``dispatched_stock`` and ``stock_all`` start as one file."""

    asn_headers: DataFrame
    orders_out: DataFrame
    order_lines_out: DataFrame
    receipts: DataFrame
    dispatches: DataFrame
    dispatch_headers: DataFrame
    stock: DataFrame
    dispatched_stock: DataFrame
    stock_all: DataFrame
    clients: DataFrame
    centers: DataFrame
    products: DataFrame

    def with_(self, **changes: DataFrame) -> Tables:
        return replace(self, **changes)

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(f.name, getattr(self, f.name)) for f in fields(self)]


# Tables that hold facts of one client or warehouse, and are narrowed when a report focuses on one.
FOCUSED = [
    "asn_headers", "orders_out", "order_lines_out", "receipts", "dispatches", "dispatch_headers", "stock",
    "dispatched_stock", "stock_all",
]


def _schema(text: list[str], number: list[str]) -> T.StructType:
    return T.StructType(
        [T.StructField(n, T.StringType()) for n in text] + [T.StructField(n, T.DoubleType()) for n in number]
    )


# Labour sheets; dates and times of day arrive as text.
LABOR_WAREHOUSE = _schema(
    ["Fecha", "Cliente", "Idcontacto", "Bodega", "Nombre", "Codigo", "Descripcion", "Observaciones",
     "Hora de inicio", "Hora de finalizacion"],
    ["Horas diurnas", "Horas nocturnas", "Total"],
)
LABOR_DELIVERY = _schema(
    ["Fecha", "Cliente", "Tipo", "Ruta", "Puntos de entrega", "Puntos adicionales", "Nombre", "Codigo",
     "Hora de inicio", "Hora de finalizacion", "Aprobacion"],
    ["Horas diurnas", "Horas nocturnas", "Total"],
)
WAGES = _schema(["Codigo", "Cargo"], ["Hora diurna", "Hora nocturna", "Hora domingo"])
OVERTIME_TARIFFS = _schema(["Idcontacto"], ["Precio H. Extra"])
PRODUCT_VOLUME = _schema(["idmodelo", "descrip", "clasificacion", "cubicaje"], [])
PALLET_OVERRIDE = _schema(["idmodelo", "mode_count"], [])
