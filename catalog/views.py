"""The operational tables, derived from the driver's tables.

Each view is one SELECT in SQL that Spark and DuckDB both read. Nulls, blanks and odd codes come
from value rules; every row of the driver's tables is used.
"""

from __future__ import annotations

import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from stowage.session import share
from stowage.tables import Tables

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def padded_key(key: str, width: int) -> str:
    """Zeros in front up to ``width``; a longer key is never cut."""
    return f"lpad(cast({key} as string), cast(greatest({width}, length(cast({key} as string))) as int), '0')"


def client_id(key: str) -> str:
    return f"{padded_key(key, 6)} || case {key} % 3 when 1 then '_c' when 2 then '_e' else '' end"


RECEIPT = padded_key("l_orderkey", 10)
ITEM = "lpad(cast(l_linenumber as string), 3, '0')"
VOLUME = "cast(cast(l_quantity as int) * p_size as decimal(18,4))"
QUANTITY = "cast(l_quantity as decimal(18,4))"
LINES = "{lineitem} join {orders} on l_orderkey = o_orderkey join {part} on l_partkey = p_partkey"
# The columns of that join which the views read.
LINE_COLUMNS = """l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus,
  l_shipdate, o_orderdate, o_custkey, p_size, p_brand"""

STOCK = f"""
select 'C' || cast(l_suppkey % 4 as string) as idcentro, 'B' || cast(l_suppkey % 3 as string) as idbodega,
  {RECEIPT} as idingreso, {ITEM} as itemno,
  case l_returnflag when 'N' then '01' when 'R' then '03' else 'XX' end as idstatus,
  case when l_partkey % 97 = 0 then null else cast(l_partkey as string) end as idmodelo,
  p_brand as idcoldis, l_shipdate as fecha, l_shipdate + interval 40 days as modifica, o_orderdate as ingresa,
  {client_id('o_custkey')} as idcontacto, 'RET' || {RECEIPT} as retnum,
  case l_suppkey % 12 when 0 then 'P00000' when 1 then 'E1A1' when 2 then 'C2PD' when 3 then 'A1B2'
    when 4 then 'C3C1' when 5 then 'G1A1' when 6 then 'PN0000' when 7 then 'B1A1' when 8 then 'M1A1'
    when 9 then 'DT1H2' when 10 then 'TIENDA' else null end as idubica,
  case when l_discount = 0 then cast(0 as decimal(18,4)) else {QUANTITY} end as pesokgs,
  'EQ' || cast(l_suppkey % 5 as string) as equipo,
  case when l_discount = 0 then cast(0 as decimal(18,4)) else {VOLUME} end as inicial,
  case when l_discount = 0 then cast(0 as decimal(18,4)) else cast(l_linenumber as decimal(18,4)) end as salidas,
  case l_suppkey % 5 when 0 then '' when 1 then 'R' || cast(l_suppkey as string)
    when 2 then 'TM' || cast(l_suppkey as string)
    else 'TA' || cast(l_partkey % 40 as string) || '-' || cast(l_suppkey % 8 as string) end as idubica1,
  {RECEIPT} || {ITEM} as idproducto, cast(l_linenumber as decimal(18,4)) as idpedido
from {LINES}"""

VIEWS = {
    "clients": f"""
select {client_id('c_custkey')} as idcontacto, case when c_acctbal < 0 then null else c_name end as descrip
from {{customer}}""",
    "centers": f"select {padded_key('s_suppkey', 3)} as idcentro, s_name as descrip from {{supplier}}",
    "products": "select cast(p_partkey as string) as idmodelo, p_name as descrip from {part}",
    "receipts": f"""
select {padded_key('o_orderkey', 10)} as idingreso, o_orderdate as fecha,
  cast(o_orderkey % 9 as string) as items, o_orderstatus as transtatus,
  case when o_orderkey % 50 = 0 then null else o_orderpriority end as descrip,
  cast(o_orderkey % 2 as string) as available, 'EQ' || cast(o_orderkey % 5 as string) as equipo,
  {client_id('o_custkey')} as idcontacto,
  case when o_orderkey % 7 = 0 then null else 'RET' || {padded_key('o_orderkey', 10)} end as retnum
from {{orders}}""",
    # Receipts under the ids they are registered with; some are still provisional.
    "register": f"""
select case when o_orderpriority = '5-LOW' then 'N' else '' end || {padded_key('o_orderkey', 10)} as idingreso from {{orders}}""",
    "stock": STOCK,
    "dispatches": f"""
select cast(l_orderkey * 10 + l_suppkey % 3 as string) as trannum, cast(l_linenumber as string) as lineano,
  l_shipdate as fecha, {VOLUME} as cantidad,
  case when l_partkey % 97 = 0 then null else cast(l_partkey as string) end as idmodelo, p_brand as idcoldis,
  {RECEIPT} as idingreso, {ITEM} as itemno, {client_id('o_custkey')} as idcontacto,
  'EQ' || cast(l_suppkey % 5 as string) as equipo, 'C' || cast(l_suppkey % 4 as string) as idcentro,
  'C' || cast(l_suppkey % 4 as string) as idcentro1,
  case when l_tax > 0.01 then 'TR01' else 'TR02' end as idclase,
  case when l_linenumber = 7 then null else cast(l_orderkey as string) end as numero
from {LINES} where l_linestatus = 'F'""",
    "dispatch_headers": f"""
select 'B' || cast(o_orderkey % 3 as string) as idbodega,
  case when o_orderpriority = '5-LOW' then 'TR02' else 'TR01' end as idclase,
  cast(o_orderkey as string) as numero, o_orderdate as fecha, {client_id('o_custkey')} as idcontacto,
  'REF' || cast(o_orderkey as string) as referencia, o_orderstatus as transtatus, o_orderpriority as descrip,
  cast(o_orderkey * 10 + o_custkey % 4 as string) as trannum, '1' as linead, '1' as lineac,
  cast(o_custkey as string) as idcliente, 'EQ' || cast(o_orderkey % 5 as string) as equipo,
  'C' || cast(o_custkey % 4 as string) as idcentro, 'C' || cast(o_custkey % 4 as string) as idcentro1
from {{orders}}""",
    "order_lines_out": f"""
select cast(l_orderkey as string) as numero, cast(l_linenumber as string) as itemline,
  cast(l_linenumber as string) as estatus, {RECEIPT} || {ITEM} as idproducto,
  {client_id('o_custkey')} as idcontacto, cast(l_partkey as string) as idmodelo, cast(null as string) as idcoldis,
  case l_partkey % 7 when 0 then 'P00000' when 1 then 'A9' when 2 then 'C9' when 3 then 'E9' when 4 then 'TIENDA'
    when 5 then '' else null end as idubica,
  {QUANTITY} as cantidad, 'EQ' || cast(l_suppkey % 5 as string) as equipo,
  case when l_suppkey % 4 = 0 then ' ' else 'TA' || cast(l_partkey % 40 as string) end as idubica1,
  substring({RECEIPT} || {ITEM}, 1, 10) as idingreso, l_shipdate as ingresa
from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey where l_linestatus = 'O'""",
    "orders_out": f"""
select cast(o_orderkey as string) as numero,
  case when o_orderpriority = '1-URGENT' then null
    else case o_orderstatus when 'F' then '5' when 'P' then '9' else '1' end end as estatus,
  substring(o_orderpriority, 1, 1) as tipo, o_orderdate as fecha, 'C' || cast(o_custkey % 4 as string) as idcentro,
  'C' || cast(o_custkey % 4 as string) as idcentro1, o_orderpriority as descrip,
  cast(o_orderkey % 9 as string) as itemcount, cast(o_orderkey % 5 as string) as pzascan,
  cast(o_orderkey * 10 + o_custkey % 4 as string) as trannum, 'EQ' || cast(o_orderkey % 5 as string) as equipo
from {{orders}}""",
    "asn_headers": f"""
select o_orderstatus as idcoclase, cast(o_orderkey as string) as numero, cast(o_orderkey % 9 as string) as itemcount,
  cast(o_orderkey % 90 as string) as itemqty, o_orderdate as fecha, {client_id('o_custkey')} as idcontacto,
  o_orderpriority as descrip, o_orderstatus as idcostatus,
  'RET' || {padded_key('o_orderkey', 10)} as retnum, 'EQ' || cast(o_orderkey % 5 as string) as equipo
from {{orders}}""",
    "product_volume": """
select cast(p_partkey as string) || ' ' as idmodelo, p_name as descrip, p_type as clasificacion,
  case when p_brand = 'Brand#4' then 'sin dato' when p_partkey % 4 = 0 then null else cast(p_size as string) end as cubicaje
from {part}""",
    "pallet_override": """
select cast(p_partkey as string) as idmodelo, case when p_size <= 10 then cast(p_size as string) end as mode_count
from {part}""",
    # Goods received and shipped, one row per item, for the analyses that start from flows. Some are
    # booked in only after they left, so that levels would fall below zero.
    "received_rows": f"""
select case l_returnflag when 'N' then o_orderdate else l_shipdate + interval 90 days end as fecha, {client_id('o_custkey')} as idcontacto, {VOLUME} as inicial, {QUANTITY} as pesokgs,
  cast(1 as decimal(18,4)) as pallets_final
from {LINES}""",
    "shipped_rows": f"""
select l_shipdate as fecha, {client_id('o_custkey')} as idcontacto, {VOLUME} as cantidad, {QUANTITY} as pesokgs,
  cast(1 as decimal(18,4)) as calculated_pallets
from {LINES} where l_linestatus = 'F'""",
    "opening_levels": f"""
select {client_id('c_custkey')} as idcontacto, cast(c_nationkey as decimal(18,4)) as initial_inventory
from {{customer}}""",
    # Text as people type it: four date spellings, ISO dates and rubbish; amounts with noise; bare keys.
    "typed_text": """
select o_orderkey, o_orderdate,
  case o_orderkey % 6
    when 0 then cast(day(o_orderdate) as string) || '-' || cast(month(o_orderdate) as string) || '-' || cast(year(o_orderdate) as string)
    when 1 then cast(day(o_orderdate) as string) || '/' || cast(month(o_orderdate) as string) || '/' || cast(year(o_orderdate) as string)
    when 2 then cast(day(o_orderdate) as string) || '-' || cast(month(o_orderdate) as string) || '-' || substring(cast(year(o_orderdate) as string), 3, 2)
    when 3 then cast(day(o_orderdate) as string) || '/' || cast(month(o_orderdate) as string) || '/' || substring(cast(year(o_orderdate) as string), 3, 2)
    when 4 then 'sin fecha'
    else cast(cast(o_orderdate as date) as string) end as date_text,
  case o_orderstatus when 'F' then ' ' || cast(cast(o_totalprice as decimal(18,2)) as string)
    when 'O' then cast(cast(o_totalprice as decimal(18,2)) as string)
    else case o_orderkey % 3 when 0 then 'nan' when 1 then '' else 'N/D' end end as amount_text,
  case o_orderkey % 4 when 0 then cast(o_orderkey as string) when 1 then '00000' || cast(o_orderkey as string)
    when 2 then 'REC' || cast(o_orderkey as string) else null end as receipt_text
from {orders}""",
    # Several rows per receipt with gaps in them.
    "receipt_versions": f"""
select {RECEIPT} as idingreso, l_shipdate as fecha, cast(l_linenumber as string) as items,
  case when l_linenumber = 3 then null else l_returnflag end as transtatus,
  case when l_discount = 0 then null else 'D' || cast(l_partkey as string) end as descrip,
  {client_id('l_suppkey')} as idcontacto,
  case when l_tax = 0 then null else 'RET' || cast(l_suppkey as string) end as retnum
from {{lineitem}}""",
    # Labour sheets under their working names; times are whole seconds of one day.
    "labor_tasks": """
select cast(ts as date) as fecha, event_type as client, 'CL-' || event_type as idcontacto,
  'BOD' || substring('ACEGJ', 1 + cast(user_id % 5 as int), 1) as bodega, 'ROUTE-' || cast(user_id % 7 as string) as route,
  'Worker ' || cast(user_id as string) as worker, cast(user_id as string) as codigo,
  date_trunc('second', ts) as start,
  date_trunc('second', ts) + interval 1 minute * cast(ceil(value * 5) as int) as "end",
  cast(ceil(value) / 10 as decimal(18,4)) as day_hours, cast((event_id % 5) / 4 as decimal(18,4)) as night_hours,
  cast(ceil(value) / 10 + (event_id % 5) / 4 as decimal(18,4)) as total_hours
from {events}""",
    "wages": """
select cast(user_id as string) as codigo, 'Auxiliar' as position,
  cast(max(2 + user_id % 5) as decimal(18,4)) as day_rate, cast(max(3 + user_id % 5) as decimal(18,4)) as night_rate,
  cast(max(4 + user_id % 5) as decimal(18,4)) as sunday_rate
from {events} group by user_id""",
    "overtime_tariffs": """
select distinct 'CL-' || event_type as idcontacto,
  case event_type when 'error' then null when 'view' then 0 else 6 + length(event_type) end as hour_price
from {events}""",
}


def text(name: str) -> str:
    """The view for DuckDB, where the driver's tables go by their own names."""
    return VIEWS[name].format(**{t: t for t in BASE})


# Plans, not data, are remembered here: reading a table's schema costs a file access each time.


_LINED: dict[str, tuple[str, DataFrame]] = {}


def lined(spark: SparkSession, sf_dir: str) -> str:
    """A name for ``sf_dir`` under which the join of lines, orders and parts is made once and stored.

    For queries that read several of the views made from that join. Each call stores its own, so that a query never
    reads files that another one wrote and that may be gone.
    """
    named = f"{sf_dir}#{uuid.uuid4().hex}"
    used = {t: table(spark, sf_dir, t) for t in BASE if "{" + t + "}" in LINES}
    _LINED[named] = sf_dir, share(spark.sql(f"select {LINE_COLUMNS} from {LINES}", **used), "lines")
    return named


def is_lined(sf_dir: str) -> bool:
    return sf_dir in _LINED


@lru_cache(maxsize=256)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if sf_dir in _LINED:
        folder, lines = _LINED[sf_dir]
        return lines if name == "lines" else table(spark, folder, name)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=256)
def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name].replace(LINES, "{lines}") if sf_dir in _LINED else VIEWS[name]
    used = {t: table(spark, sf_dir, t) for t in [*BASE, "lines"] if "{" + t + "}" in sql}
    return spark.sql(sql.replace('"end"', "end"), **used)


@lru_cache(maxsize=16)
def tables(spark: SparkSession, sf_dir: str) -> Tables:
    names = [
        "asn_headers", "orders_out", "order_lines_out", "receipts", "dispatches", "dispatch_headers", "stock",
        "clients", "centers", "products",
    ]
    loaded = {n: view(spark, sf_dir, n) for n in names}
    return Tables(**loaded, dispatched_stock=loaded["stock"], stock_all=loaded["stock"])
