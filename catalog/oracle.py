"""The catalog's questions in plain SQL for DuckDB.

Where the Spark plan reduces before it joins, the SQL here joins first and removes duplicates
afterwards, row loops aside; equal results show that the rewrite changes nothing.
"""

from __future__ import annotations

import re

from catalog.queries import AS_OF, CLIENT, END, START, WAREHOUSE
from catalog.views import VIEWS, text

CTES: dict[str, str] = {f"v_{name}": text(name) for name in VIEWS}
ORACLE: dict[str, str] = {}


def d(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d') as {c.split('.')[-1]}"


def ts(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S') as {c.split('.')[-1]}"


def n(*names: str) -> str:
    return ", ".join(f"cast({c} as double) as {c.split('.')[-1]}" for c in names)


def i(*names: str) -> str:
    return ", ".join(f"cast({c} as bigint) as {c.split('.')[-1]}" for c in names)


def oracle(name: str, sql: str) -> None:
    """Register a query with just the CTEs it reaches, in order of definition."""
    needed: set[str] = set()

    def reach(part: str) -> None:
        for word in set(re.findall(r"[a-z_0-9]+", part)):
            if word in CTES and word not in needed:
                needed.add(word)
                reach(CTES[word])

    reach(sql)
    ctes = ",\n".join(f"{c} as ({CTES[c]})" for c in CTES if c in needed)
    ORACLE[name] = f"with {ctes}\n{sql}" if ctes else sql


def place(c: str) -> str:
    """Warehouse of a location."""
    return f"""case when {c} = 'P00000' then 'PISO' when {c} like 'E%' or {c} = 'PE0000' then 'BODE'
      when {c} in ('C2PD','C2PE','C2PF','C2PG','C2PL','C1PA','C2PN','C2PA','C2P0','C2PK','C2PJ','C2PI') then 'INTEMPERIE'
      when {c} like 'A%' or {c} = 'PA0000' then 'BODA' when {c} like 'C%' or {c} = 'PC0000' then 'BODC'
      when {c} like 'G%' or {c} = 'PG0000' then 'BODG' when substring({c}, 1, 1) in ('P','B','M','V') then 'BODJ'
      else 'DESCONOCIDO' end"""


def forced(c: str) -> str:
    return f"""case when right(idcontacto, 2) = '_c' then 'BODC' when right(idcontacto, 2) = '_e' then 'BODE'
      when right(idcontacto, 4) = '_opl' then 'OPL' else {c} end"""


def resolved(x: str, y: str, y_place: str) -> str:
    bad = "'INCOHERENT VALUES'"
    return f"""coalesce(case
      when {x} = 'DESCONOCIDO' and {y} is distinct from 'DESCONOCIDO' then {y}
      when {y} = 'DESCONOCIDO' and {x} is distinct from 'DESCONOCIDO' then {x}
      when {x} is not null and {y} is not null and {x} <> {y} then {y}
      when {x} = 'PISO' and {y} is distinct from 'DESCONOCIDO' then case when {y_place} is not null then {y} else {bad} end
      when {y} = 'PISO' and {x} is distinct from 'DESCONOCIDO' then null
      when {x} is null then {y} when {y} is null then {x} when {x} = {y} then {x} else {bad} end, {bad})"""


def number(c: str) -> str:
    return f"try_cast(regexp_extract({c}, '^[0-9]+') as hugeint) nulls last, {c}"


def unknown(c: str) -> str:
    return f"case when {c} is null or trim({c}) = '' then 'DESCONOCIDO' else {c} end"


def desc(*names: str) -> str:
    return ", ".join(f"{c} desc nulls last" for c in names)


def padded(c: str, width: str) -> str:
    return f"case when length({c}) < {width} then lpad({c}, cast({width} as int), '0') else {c} end"


TIE = desc("idingreso", "itemno", "idstatus", "idmodelo", "idubica", "idubica1", "inicial", "pesokgs", "salidas")
TIE_A = TIE.replace("idingreso", "a.idingreso").replace("itemno", "a.itemno").replace("idmodelo", "a.idmodelo").replace(
    "idubica desc", "a.idubica desc").replace("idubica1 desc", "a.idubica1 desc")

# ---- cleaned and screened tables ------------------------------------------------------------------

CTES |= {
    "c_stock": """select * replace (coalesce(idmodelo, '') as idmodelo, coalesce(idubica, '') as idubica)
      from v_stock where idstatus = '01'""",
    "c_gone": """select * from v_stock where idstatus in ('XX', '03')
      and (idubica is null or idubica not in ('DT1H2','DT1I3','DT1J3','DT2C2','DT2G3','DT2H1','DT3D1','DT3E1','DT3E2','DT3I1'))""",
    "c_all": """select * replace (coalesce(idmodelo, '') as idmodelo, coalesce(idubica, '') as idubica) from v_stock
      where idstatus not in ('XX', '03') or idubica is null or idubica <> 'DT1H2'""",
    "c_dispatches": "select * from v_dispatches where idclase = 'TR01'",
    "c_headers": "select * from v_dispatch_headers where idclase = 'TR01'",
    "c_orders": "select * from v_orders_out where estatus is null or estatus not in ('5', '9')",
    "c_lines": f"""select * replace (coalesce(idcoldis, '') as idcoldis, {unknown('idubica')} as idubica,
      {unknown('idubica1')} as idubica1) from v_order_lines_out""",
    "c_clients": "select * from v_clients where idcontacto not in ('000099', 'AC0001')",
    "c_centers": "select * from v_centers where idcentro <> '002'",
    "l_stock": f"select *, {place('idubica')} as bodega from c_stock",
    "l_lines": f"select *, {place('idubica')} as bodega from c_lines",
    "s_stock": f"select * replace ({forced('bodega')} as bodega) from l_stock",
    "s_lines": f"select * replace ({forced('bodega')} as bodega) from l_lines",
    "s_receipts": f"""select * replace ({forced('bodega')} as bodega) from (
      select r.idingreso, r.fecha, r.descrip, r.idcontacto, r.retnum, {unknown('s.idubica')} as idubica,
        {unknown('s.bodega')} as bodega
      from v_receipts r left join l_stock s on r.idingreso = s.idingreso)""",
    "p_dispatches": f"""select x.*, {unknown('f.idubica')} as idubica, {unknown('f.bodega')} as bodega
      from c_dispatches x left join (select * from (
        select idingreso, idubica, bodega,
          row_number() over (partition by idingreso order by {number('numero')}, {number('itemline')}, idubica) as k from l_lines)
        where k = 1) f on x.idingreso = f.idingreso""",
    "s_dispatches": f"select * replace ({forced('bodega')} as bodega) from p_dispatches",
    "s_headers": f"""select h.*, f.idubica, f.bodega from c_headers h join (select * from (
        select trannum, idubica, bodega,
          row_number() over (partition by trannum order by {desc('fecha', 'idingreso', 'itemno', 'idubica')}) as k
        from p_dispatches) where k = 1) f on h.trannum = f.trannum""",
    # ---- receipts: join first, deduplicate after
    "r_width": "select greatest((select max(length(idcontacto)) from v_receipts), (select max(length(idcontacto)) from c_clients)) as w",
    "r_all": """select *, case when month(modifica) >= month(fecha) and inicial = 0 and salidas = 0 and pesokgs = 0
      then idpedido end as ddma from c_all""",
    "r_items": f"""select * from (select r.idingreso, a.itemno, r.fecha, r.descrip, r.idcontacto, r.retnum, r.bodega as bodega_x,
        a.idmodelo, a.inicial, a.pesokgs, a.ddma,
        row_number() over (partition by r.idingreso, a.itemno
          order by {desc('r.fecha', 'r.idingreso', 'r.bodega', 'r.idubica', 'a.fecha')}, {TIE_A}) as k
      from s_receipts r left join r_all a on r.idingreso = a.idingreso) where k = 1""",
    "r_fact": f"""select * exclude (bodega_x, bodega_y, place_y, k, j) replace ({padded('idcontacto', '(select w from r_width)')} as idcontacto),
        {resolved('bodega_x', 'bodega_y', 'place_y')} as bodega, date_trunc('month', fecha) as month
      from (select m.*, l.bodega as bodega_y, l.idubica as place_y,
          row_number() over (partition by m.idingreso, m.itemno order by {number('l.numero')}, {number('l.itemline')}, l.idubica) as j
        from r_items m left join s_lines l on m.idingreso = l.idingreso) where j = 1""",
    "r_clients": f"select {padded('trim(idcontacto)', '(select w from r_width)')} as idcontacto, descrip from c_clients",
    "r_month": """select month, idcontacto, bodega, max(fecha) as fecha, count(retnum) as pallets,
        coalesce(sum(pesokgs), 0) as units, coalesce(sum(inicial), 0) + coalesce(sum(ddma), 0) as cbm
      from r_fact where month is not null and idcontacto is not null group by all""",
    "r_client": """select month, bodega, descrip as client, arg_min(fecha, m.idcontacto) as fecha, min(m.idcontacto) as idcontacto,
        sum(pallets) as pallets, sum(units) as units, sum(cbm) as cbm
      from r_month m join r_clients c on m.idcontacto = c.idcontacto where descrip is not null group by month, bodega, descrip""",
    # ---- dispatches
    "o_width": "select greatest((select max(length(idcontacto)) from c_dispatches), (select max(length(idcontacto)) from c_clients)) as w",
    "o_rows": f"""select * replace ({padded('idcontacto', '(select w from o_width)')} as idcontacto) from s_dispatches""",
}


def dispatch_ctes(suffix: str, on: str) -> dict[str, str]:
    tie = desc("a.fecha", "a.idingreso", "a.itemno", "a.idstatus", "a.idmodelo", "a.idubica", "a.idubica1", "a.inicial", "a.pesokgs", "a.salidas")
    return {
        f"o_items{suffix}": f"""select * exclude (k) from (select o.*, a.fecha as arrived, a.pesokgs, a.idubica1,
            date_trunc('month', o.fecha) as month,
            row_number() over (partition by o.idingreso || o.itemno
              order by {desc('o.fecha', 'o.idingreso', 'o.itemno', 'o.trannum', 'o.lineano', 'o.idmodelo', 'o.cantidad', 'o.numero')}, {tie}) as k
          from o_rows o left join c_gone a on {on}) where k = 1""",
        f"o_only{suffix}": f"""select idcontacto, min(bodega) as only_one from o_items{suffix}
          where idcontacto is not null and bodega <> 'DESCONOCIDO' group by idcontacto having count(distinct bodega) = 1""",
        f"o_fact{suffix}": f"""select f.* replace (case when f.bodega = 'DESCONOCIDO' and u.only_one is not null then u.only_one else f.bodega end as bodega)
          from o_items{suffix} f left join o_only{suffix} u on f.idcontacto = u.idcontacto""",
        f"o_month{suffix}": f"""select month, idcontacto, bodega, max(fecha) as fecha, count(numero) as pallets,
            coalesce(sum(pesokgs), 0) as units, coalesce(sum(cantidad), 0) as cbm from o_fact{suffix} group by all""",
        f"o_client{suffix}": f"""select month, bodega, descrip as client, arg_min(fecha, m.idcontacto) as fecha,
            min(m.idcontacto) as idcontacto, sum(pallets) as pallets, sum(units) as units, sum(cbm) as cbm
          from o_month{suffix} m join (select {padded('trim(idcontacto)', '(select w from o_width)')} as idcontacto, descrip from c_clients) c
            on m.idcontacto = c.idcontacto where descrip is not null group by month, bodega, descrip""",
    }


CTES |= dispatch_ctes("", "o.idingreso = a.idingreso")
CTES |= dispatch_ctes("_own", "o.idingreso = a.idingreso and o.itemno = a.itemno")

# ---- stock and billing ---------------------------------------------------------------------------

CTES |= {
    "k_volume": "select trim(idmodelo) as idmodelo, try_cast(cubicaje as decimal(18,4)) as cubicaje from v_product_volume",
    "k_full": """select s.* replace (coalesce(v.cubicaje, 1.5) as inicial) from s_stock s left join k_volume v on s.idmodelo = v.idmodelo
        where bodega = 'BODE'
      union all select * replace (coalesce(inicial, 1.5) as inicial) from s_stock where bodega <> 'BODE'""",
    "k_width": "select greatest((select max(length(idcontacto)) from c_stock), (select max(length(idcontacto)) from c_clients)) as w",
    "k_fact": f"""select s.* replace (cast(coalesce(v.cubicaje, s.inicial) as decimal(18,4)) as inicial,
        {padded('s.idcontacto', '(select w from k_width)')} as idcontacto)
      from k_full s left join k_volume v on s.idmodelo = v.idmodelo""",
    "k_once": f"""select * exclude (k) from (select *, row_number() over (partition by idingreso || itemno
      order by {desc('fecha')}, {TIE}) as k from k_fact) where k = 1""",
    # Pallet fill: every untagged row is a pallet of its own, hence its row number as tag.
    "b_tagged": """select idmodelo, case when idubica1 like 'TA%' then idubica1 else cast(row_number() over () as varchar) end as tag
      from k_fact where idmodelo is not null""",
    "b_count": "select idmodelo, tag, count(*) as c from b_tagged group by all",
    "b_mode": """select idmodelo, c as mode_count from (select idmodelo, c,
        row_number() over (partition by idmodelo order by count(*) desc, c) as k from b_count group by idmodelo, c) where k = 1""",
    "b_given": "select idmodelo, max(try_cast(mode_count as decimal(18,4))) as given from v_pallet_override group by idmodelo",
    "b_fills": """select coalesce(m.idmodelo, g.idmodelo) as idmodelo,
        cast(greatest(coalesce(m.mode_count, 1), coalesce(g.given, 0)) as double) as mode_count
      from b_mode m full join b_given g on m.idmodelo = g.idmodelo""",
    "b_in": """select f.*, greatest(0, ceil(count(*) over g / coalesce(m.mode_count, 1)) - count(case when ddma > 0 then 1 end) over g) as pallets_final
      from r_fact f left join b_mode m on f.idmodelo = m.idmodelo where f.idmodelo is not null
      window g as (partition by f.idingreso, f.idmodelo)""",
    "b_inflow": f"""select idingreso, idmodelo, max(fecha) as received, max(descrip) as description, sum(inicial) as cbm,
        min(pallets_final) as pallets, sum(pesokgs) as units, first(bodega order by fecha desc, itemno desc) as warehouse
      from b_in where fecha between '{START}' and '{END}' group by idingreso, idmodelo""",
    "b_out": """select f.* replace (lpad(ltrim(f.idingreso, '0'), 10, '0') as idingreso), m.mode_count, case when f.idmodelo is not null then count(*) over (partition by trannum, f.idmodelo) end as num_rows,
        abs(date_diff('day', arrived, f.fecha)) + 1 as days, coalesce(r.descrip, 'Unknown') as descrip, c.descrip as client
      from o_fact f left join b_fills m on f.idmodelo = m.idmodelo
        left join v_receipts r on f.idingreso = r.idingreso
        left join r_clients c on f.idcontacto = c.idcontacto""",
    "b_outflow": f"""select trannum, idmodelo, first(arrived order by fecha, arrived) filter (arrived is not null) as arrival_date, max(fecha) as shipping_date,
        round_even(avg(days), 2) as days, first(descrip order by fecha desc, idingreso desc) as description,
        first(idcontacto order by fecha desc, idcontacto desc) as idcontacto,
        first(client order by fecha desc, client desc) filter (client is not null) as client,
        sum(cantidad) as cbm, max(ceil(num_rows / coalesce(mode_count, 1))) as pallets, coalesce(sum(pesokgs), 0) as units,
        first(bodega order by fecha desc, bodega desc) as warehouse
      from b_out where idmodelo is not null and trannum is not null and fecha between '{START}' and '{END}'
      group by trannum, idmodelo""",
    # One row per tag; untagged rows are numbered, newest first, and sort before tags.
    "b_rows": f"""select *, idingreso || itemno as dup_key,
        row_number() over (order by {desc('fecha', 'idingreso', 'itemno', 'idubica', 'idcontacto', 'bodega')}) as pos from k_fact""",
    "b_pallets": """select case when idubica1 like 'TA%' then idubica1 else '' end as tag,
        case when idubica1 like 'TA%' then 0 else pos end as own,
        first(idingreso order by pos) as idingreso, last(itemno order by pos) as itemno, first(dup_key order by pos) as label,
        first(fecha order by pos) as fecha, first(idcontacto order by pos) as idcontacto, first(idubica order by pos) as location,
        sum(pesokgs) as units, sum(inicial) as cbm, first(bodega order by pos) as warehouse
      from b_rows group by tag, own""",
    "b_stock": f"""select idingreso, first(itemno order by tag, own) as itemno, first(label order by tag, own) as label,
        cast(first(fecha order by tag, own) as date) as date, first(idcontacto order by tag, own) as idcontacto,
        first(location order by tag, own) as location, sum(cbm) as cbm, count(*) as pallets, sum(units) as units,
        first(warehouse order by tag, own) as warehouse,
        date_diff('day', cast(first(fecha order by tag, own) as date), date '{AS_OF}') + 1 as days
      from b_pallets group by idingreso""",
}

# ---- flows and levels ----------------------------------------------------------------------------

ZERO = "cast(0 as decimal(18,4))"


def level_ctes(prefix: str, received: str, shipped: str, pallets_in: str, pallets_out: str) -> dict[str, str]:
    return {
        f"{prefix}_flows": f"""select cast(fecha as date) as date, idcontacto, inicial as inflow_cbm, pesokgs as units_in,
            cast({pallets_in} as decimal(18,4)) as pallets_in, {ZERO} as outflow_cbm, {ZERO} as units_out, {ZERO} as pallets_out
          from {received} where fecha is not null
          union all select cast(fecha as date), idcontacto, {ZERO}, {ZERO}, {ZERO}, cantidad, pesokgs, cast({pallets_out} as decimal(18,4))
          from {shipped} where fecha is not null""",
        f"{prefix}_days": f"""select date, coalesce(sum(inflow_cbm), 0) as inflow_cbm, coalesce(sum(units_in), 0) as units_in,
            coalesce(sum(pallets_in), 0) as pallets_in, coalesce(sum(outflow_cbm), 0) as outflow_cbm,
            coalesce(sum(units_out), 0) as units_out, coalesce(sum(pallets_out), 0) as pallets_out
          from {prefix}_flows group by date""",
        f"{prefix}_run": f"""select *, sum(inflow_cbm - outflow_cbm) over (order by date) as s from {prefix}_days""",
        f"{prefix}_level": f"""select *, s - least(0, min(s) over (order by date)) as level_cbm from {prefix}_run""",
    }


CTES |= level_ctes("f", "v_received_rows", "v_shipped_rows", "pallets_final", "calculated_pallets")
CTES |= level_ctes("g", "b_in", "b_out", "pallets_final", "ceil(num_rows / coalesce(mode_count, 1))")

FLOW = ["inflow_cbm", "units_in", "pallets_in", "outflow_cbm", "units_out", "pallets_out"]


def daily(prefix: str) -> str:
    return f"""select {d('date')}, {n(*FLOW)}, cast(0 as double) as initial_inventory, {n('level_cbm')},
      cast(level_cbm - inflow_cbm + outflow_cbm as double) as opening_level_cbm from {prefix}_level"""


def kpis(prefix: str) -> str:
    return f"""select strftime(month, '%Y-%m-%d') as month, round_even(i, 2) as inflow_cbm, round_even(o, 2) as outflow_cbm,
        round_even(l, 2) as level_cbm,
        round_even(coalesce(case when (l + pl) / 2 <> 0 then o / ((l + pl) / 2) end, 0), 2) as turnover,
        round_even(coalesce(case when o <> 0 then l / (o / day(last_day(month))) end, 0), 2) as days_on_hand,
        round_even(coalesce(case when pi <> 0 then (i / pi - 1) * 100 end, 0), 2) as inflow_mom_pct,
        round_even(coalesce(case when po <> 0 then (o / po - 1) * 100 end, 0), 2) as outflow_mom_pct,
        round_even(coalesce(case when pl <> 0 then (l / pl - 1) * 100 end, 0), 2) as level_mom_pct
      from (select *, lag(i) over (order by month) as pi, lag(o) over (order by month) as po, lag(l) over (order by month) as pl
        from (select date_trunc('month', date) as month, cast(sum(inflow_cbm) as double) as i, cast(sum(outflow_cbm) as double) as o,
            cast(arg_max(level_cbm, date) as double) as l from {prefix}_level group by 1))"""


oracle("daily_inventory_level", daily("f"))
oracle("report_daily_level", daily("g"))
oracle("inventory_kpis", kpis("f"))
oracle("report_kpis", kpis("g"))
oracle("inventory_for_period", f"""select {d('date')}, {n('inflow_cbm', 'outflow_cbm', 'level_cbm')} from f_level
  where date between '{START}' and '{END}'""")

CTES |= {
    "w_first": "select sum(initial_inventory) as v from v_opening_levels where idcontacto in (select idcontacto from f_flows)",
    "w_run": f"""select *, (select v from w_first) + sum(inflow_cbm - outflow_cbm) over (order by date) as s
      from f_days where date between '{START}' and '{END}'""",
    "w_level": "select *, s - least(0, min(s) over (order by date)) as level_cbm from w_run",
    "y_days": """select idcontacto, date, sum(inflow_cbm) as inflow_cbm, sum(outflow_cbm) as outflow_cbm
      from f_flows where idcontacto is not null group by all""",
    "y_run": """select y.*, coalesce(initial_inventory, 0) + sum(inflow_cbm - outflow_cbm) over (partition by y.idcontacto order by date) as s
      from y_days y left join v_opening_levels p on y.idcontacto = p.idcontacto""",
    "m_end": "select last_day(cast(unnest(generate_series((select date_trunc('month', min(date)) from f_days), (select max(date) from f_days), interval 1 month)) as date)) as month_end",
}
oracle("daily_level_with_opening", f"""select {d('date')}, cast((select v from w_first) as double) as initial_inventory,
  cast(level_cbm - inflow_cbm + outflow_cbm as double) as opening_level_cbm, {n('level_cbm')} from w_level""")
oracle("inventory_level_by_client", f"""select idcontacto, {d('date')},
  strftime(lead(date) over (partition by idcontacto order by date) - interval 1 day, '%Y-%m-%d') as valid_until,
  {n('inflow_cbm', 'outflow_cbm')}, cast(s - least(0, min(s) over (partition by idcontacto order by date)) as double) as level_cbm from y_run""")
oracle("monthly_resample", f"""select {d('month_end')}, {', '.join(f'cast(coalesce(sum({c}), 0) as double) as {c}' for c in FLOW)},
  cast(arg_max(level_cbm, date) as double) as final_level_cbm, (select min(idcontacto) from f_flows) as idcontacto
  from m_end left join f_level on last_day(date) = month_end group by month_end""")
CTES |= {
    "e_busy": "select * from f_level where level_cbm > 0 and month(date) in (1, 4, 12)",
    "e_end": "select last_day(cast(unnest(generate_series((select date_trunc('month', min(date)) from e_busy), (select max(date) from e_busy), interval 1 month)) as date)) as month_end",
}
oracle("monthly_resample_with_gaps", f"""select {d('month_end')}, cast(coalesce(sum(inflow_cbm), 0) as double) as inflow_cbm,
  cast(arg_max(level_cbm, date) as double) as level_cbm from e_end left join e_busy on last_day(date) = month_end group by month_end""")
oracle("client_share", """select idcontacto, cast(sum(inflow_cbm) as double) as inflow_cbm, cast(sum(outflow_cbm) as double) as outflow_cbm,
  cast(sum(inflow_cbm) as double) / cast((select sum(inflow_cbm) from f_flows) as double) * 100 as inflow_cbm_pct
  from f_flows group by idcontacto""")
oracle("calendar_days", """select strftime(unnest(generate_series((select min(o_orderdate) from orders), (select max(o_orderdate) from orders),
  interval 1 day)), '%Y-%m-%d') as date""")

# ---- sources, projections, filters ---------------------------------------------------------------

SUFFIX = "case when right(idcontacto, 2) in ('_c', '_e') then right(idcontacto, 2) else '' end"
oracle("csv_site_extracts", f"""select idingreso || {SUFFIX} as idingreso, {ts('fecha')}, idcontacto, retnum || {SUFFIX} as retnum,
  descrip from v_receipts""")
oracle("site_tag_union", """select case s when '1' then numero when '5' then numero || '_c' else numero || '_e' end as numero,
  case s when '1' then trannum when '5' then trannum || '_c' end as trannum, case s when '1' then idcentro end as idcentro
  from (select *, coalesce(estatus, '1') as s from v_orders_out)""")
oracle("focus_client", f"select idingreso, {ts('fecha')}, idcontacto, retnum from v_receipts where idcontacto = '{CLIENT}'")
oracle("focus_warehouse", f"""select {place('idubica')} as bodega, idubica, idstatus, count(*) as rows, cast(sum(inicial) as double) as cbm
  from v_stock where {place('idubica')} = '{WAREHOUSE}' group by all""")
oracle("filter_exact", f"select idubica, count(*) as rows from v_stock where {place('idubica')} = 'BODJ' group by all")
oracle("entity_list", "select distinct idcontacto, descrip from v_clients")
oracle("exclude_ids", "select idcontacto as id, 'client' as kind from c_clients union all select idcentro, 'center' from c_centers")
oracle("clean_status_filters", " union all ".join(
    f"select '{name}' as name, count(*) as rows, count(distinct fecha) as dates from {cte}"
    for name, cte in [
        ("asn_headers", "v_asn_headers"), ("orders_out", "c_orders"), ("receipts", "v_receipts"),
        ("dispatches", "c_dispatches"), ("dispatch_headers", "c_headers"), ("stock", "c_stock"),
        ("dispatched_stock", "c_gone"), ("stock_all", "c_all"),
    ]))
oracle("blank_to_default", "select idubica, idubica1, idcoldis, count(*) as rows from c_lines group by all")
oracle("parse_mixed_dates", """select o_orderkey, date_text,
  case when o_orderkey % 6 < 4 then strftime(o_orderdate, '%Y-%m-%d') end as parsed from v_typed_text""")
oracle("coerce_numbers", """select strftime(o_orderdate, '%Y-%m') as month, cast(sum(v) as double) as amount, count(v) as numbers,
  count(*) as rows, cast(max(v) as double) as largest
  from (select *, try_cast(trim(amount_text) as decimal(18,4)) as v from v_typed_text) group by 1""")
oracle("zero_pad_keys", """select o_orderkey, case when length(receipt_text) < 8 then lpad(receipt_text, 8, '0') else receipt_text end as padded,
  case when receipt_text is null then null when receipt_text like 'REC%' then
      case when length(receipt_text) < 10 then lpad(receipt_text, 10, '0') else receipt_text end
    else lpad(cast(cast(receipt_text as bigint) as varchar), 10, '0') end as receipt from v_typed_text""")
oracle("clip_near_zero", """select cast(l_linenumber as bigint) as l_linenumber, count(*) filter (v = 0) as zeros, max(v) as largest, min(v) as smallest
  from (select l_linenumber, case when abs((l_discount - 0.05) * 4e-5::double * l_quantity) < 1e-6 then 0
    else (l_discount - 0.05::double) * 4e-5::double * l_quantity end as v from lineitem) group by 1""")
oracle("detached_volume", """select idstatus, cast(sum(case when month(modifica) >= month(fecha) and inicial = 0 and salidas = 0 and pesokgs = 0
    then idpedido end) as double) as ddma,
  count(case when month(modifica) >= month(fecha) and inicial = 0 and salidas = 0 and pesokgs = 0 then 1 end) as items,
  count(*) as rows from v_stock group by idstatus""")

# ---- warehouses ----------------------------------------------------------------------------------

CTES |= {
    "z_other": f"""select {place('idubica')} as x, case when idmodelo is not null then {place('reverse(idubica)')} end as y,
      nullif(idubica1, '') as p from v_stock""",
    "z_places": f"select idcentro || idcoldis as place, {place('idubica')} as bodega from v_stock",
    "z_only": """select place, min(bodega) as only_one from z_places where bodega <> 'DESCONOCIDO' and place is not null
      group by place having count(distinct bodega) = 1""",
}
oracle("assign_warehouse", f"""select idubica, {place('idubica')} as bodega, count(*) as rows
  from (select idubica from v_stock union all select idubica from v_order_lines_out) group by all""")
oracle("warehouse_override", f"select idcontacto, {forced(place('idubica'))} as bodega, count(*) as rows from v_stock group by all")
oracle("resolve_warehouse", f"select x as bodega, y as other, {resolved('x', 'y', 'p')} as resolved, count(*) as rows from z_other group by all")
oracle("fill_unknown_warehouse", """select p.place, case when bodega = 'DESCONOCIDO' then coalesce(only_one, bodega) else bodega end as bodega,
  count(*) as rows from z_places p left join z_only o on p.place = o.place group by all""")
oracle("fill_unknown_counts", """select count(only_one) as replaced, count(*) - count(only_one) as remaining
  from z_places p left join z_only o on p.place = o.place where bodega = 'DESCONOCIDO'""")

# ---- first per key, screening --------------------------------------------------------------------

VERSION = ["fecha", "items", "transtatus", "descrip", "idcontacto", "retnum"]
oracle("first_per_receipt", f"""select idingreso, {ts('fecha')}, items, transtatus, descrip, idcontacto, retnum from (select idingreso,
  {', '.join(f"first({c} order by {desc('fecha', c)}) filter ({c} is not null) as {c}" for c in VERSION)}
  from v_receipt_versions group by idingreso)""")
oracle("latest_item_per_key", f"""select idingreso, itemno, {ts('fecha')}, idstatus, idmodelo, idubica, {n('inicial')} from (select *,
  row_number() over (partition by idingreso || itemno order by {desc('fecha')}, {TIE}) as k from v_stock) where k = 1""")
oracle("screened_receipts", f"select idingreso, {ts('fecha')}, descrip, idcontacto, retnum, idubica, bodega from s_receipts")
oracle("screened_dispatches", f"select trannum, lineano, {ts('fecha')}, {n('cantidad')}, idingreso, itemno, idubica, bodega from s_dispatches")
oracle("screened_headers", f"select trannum, numero, {ts('fecha')}, idcontacto, idubica, bodega from s_headers")
oracle("screened_stock", "select bodega, idcontacto, count(*) as rows, cast(sum(inicial) as double) as cbm from s_stock group by all")

# ---- monthly flows -------------------------------------------------------------------------------

CLIENT_COLUMNS = f"{d('month')}, bodega, client, {ts('fecha')}, idcontacto, {i('pallets')}, {n('units', 'cbm')}"
oracle("monthly_receipts", f"select {CLIENT_COLUMNS} from r_client")
oracle("monthly_dispatches", f"select {CLIENT_COLUMNS} from o_client")
for direction, cte in [("receipts", "r_client"), ("dispatches", "o_client")]:
    oracle(f"report_warehouse_{direction}", f"select {CLIENT_COLUMNS} from {cte} where bodega = '{WAREHOUSE}'")
oracle("monthly_dispatches_by_item", f"select {CLIENT_COLUMNS} from o_client_own")
oracle("receipt_items", f"select idingreso, itemno, {ts('fecha')}, idcontacto, idmodelo, {n('inicial', 'ddma')}, bodega from r_fact")
oracle("dispatch_items", f"""select trannum, idingreso, itemno, {ts('fecha')}, {ts('arrived')}, {n('cantidad', 'pesokgs')}, idubica1, bodega
  from o_fact""")
oracle("period_by_warehouse", " union all ".join(
    f"""select bodega, cast(sum(cbm) as double) as cbm, cast(sum(pallets) as bigint) as pallets, cast(sum(units) as double) as units,
      '{direction}' as direction from {cte} where fecha between '{START}' and '{END}' group by bodega"""
    for direction, cte in [("in", "r_client"), ("out", "o_client")]))

# ---- stock ---------------------------------------------------------------------------------------


def by_product(keys: str, columns: str, more: str) -> str:
    return f"""select {columns}, {i('pallets')}, {n('units', 'cbm')}, {more} from (
      select {keys}, first(idcoldis order by {desc('fecha', 'idcoldis')}) as model, sum(inicial) as cbm, sum(pesokgs) as units,
        count(itemno) as pallets from (select *, cast(fecha as date) as date from k_once) group by {keys})"""


def share(c: str) -> str:
    return f"cast({c} as double) / cast(sum({c}) over () as double) * 100 as {c}_pct"


SHARES = f"{share('cbm')}, {share('pallets')}, {share('units')}"
DAYS = f"date_diff('day', date, date '{AS_OF}') as days"
oracle("complete_volume", "select bodega, idmodelo, cast(sum(inicial) as double) as cbm, count(*) as rows from k_full group by all")
oracle("stock_by_warehouse", """select bodega, idcontacto, cast(sum(inicial) as double) as cbm, count(idmodelo) as pallets,
  cast(sum(pesokgs) as double) as units from k_once group by all""")
oracle("report_warehouse_stock", f"""select bodega, idcontacto, cast(sum(inicial) as double) as cbm, count(idmodelo) as pallets,
  cast(sum(pesokgs) as double) as units from k_once where bodega = '{WAREHOUSE}' group by all""")
oracle("stock_proportions", by_product("idmodelo", "idmodelo, model", SHARES))
oracle("stock_ageing", by_product("date, idmodelo", f"{d('date')}, idmodelo, model", f"{SHARES}, {DAYS}"))
oracle("stock_ageing_by_date", by_product("date", d("date"), f"{share('cbm')}, {DAYS}"))
oracle("unmatched_products", """select distinct idmodelo from s_stock where bodega = 'BODE'
  and idmodelo not in (select idmodelo from k_volume where cubicaje is not null)""")

# ---- billing -------------------------------------------------------------------------------------

oracle("pallet_mode", f"select idmodelo, {i('mode_count')} from b_mode")
oracle("pallet_fills", "select idmodelo, mode_count from b_fills")
oracle("billing_inflow", f"""select idingreso, idmodelo, {ts('received')}, description, {n('cbm')}, {i('pallets')}, {n('units')}, warehouse
  from b_inflow""")
oracle("report_warehouse_billing", f"""select idingreso, idmodelo, {ts('received')}, description, {n('cbm')}, {i('pallets')}, {n('units')},
  warehouse from b_inflow where warehouse = '{WAREHOUSE}'""")
oracle("billing_stock", f"""select idingreso, itemno, label, {d('date')}, idcontacto, location, {n('cbm')}, {i('pallets')}, {n('units')},
  warehouse, {i('days')} from b_stock""")
oracle("billing_outflow", f"""select trannum, idmodelo, {ts('arrival_date')}, {ts('shipping_date')}, days, description, idcontacto, client,
  {n('cbm')}, {i('pallets')}, {n('units')}, warehouse from b_outflow""")
oracle("billing_totals", " union all ".join(
    f"select '{kind}' as kind, cast(coalesce(sum(pallets), 0) as bigint) as pallets, cast(coalesce(sum(cbm), 0) as double) as cbm from {cte}"
    for kind, cte in [("received", "b_inflow"), ("shipped", "b_outflow"), ("on_hand", "b_stock")]))

# ---- quality -------------------------------------------------------------------------------------

oracle("missing_receipts", """select distinct idingreso from v_dispatches
  where idingreso not in (select idingreso from v_register)""")
oracle("registered_dispatches", """select idclase, count(*) as rows, cast(sum(cantidad) as double) as cbm from v_dispatches
  where idingreso in (select idingreso from v_register) group by idclase""")
oracle("duplicate_receipts", "select idingreso, count(*) as rows from v_receipt_versions group by idingreso having count(*) > 1")
oracle("undescribed_receipts", "select idingreso, idcontacto from v_receipts where descrip is null")

# ---- labour --------------------------------------------------------------------------------------

CTES |= {
    "t_cost": """select t.*, dayofweek(fecha) = 0 as sunday,
        cast(day_hours * case when dayofweek(fecha) = 0 then sunday_rate else day_rate end as decimal(18,4)) as day_cost,
        cast(night_hours * case when dayofweek(fecha) = 0 then sunday_rate else night_rate end as decimal(18,4)) as night_cost
      from v_labor_tasks t join v_wages w on t.codigo = w.codigo""",
    "t_rows": 'select *, day_cost + night_cost as total_cost, epoch_us("start") // 1000000 as t0, epoch_us("end") // 1000000 as t1 from t_cost',
    "t_reach": """select *, max(t1) over (partition by codigo, fecha order by t0, t1 rows between unbounded preceding and 1 preceding) as reach
      from t_rows""",
    "t_groups": """select *, sum(case when reach is null or t0 >= reach then 1 else 0 end)
      over (partition by codigo, fecha order by t0, t1 rows unbounded preceding) as island from t_reach""",
    "t_islands": """select codigo, fecha, island, min(t0) as t0, max(t1) as t1, count(*) as tasks, sum(t1 - t0) as secs, max(total_cost) as cost
      from t_groups group by all""",
    # Ten-thousandths in whole numbers, halves up.
    "t_shared": """select g.*, (2 * cast(i.cost * 10000 as bigint) * (g.t1 - g.t0) + i.secs) // (2 * i.secs) as cost_u,
        (2 * (i.t1 - i.t0) * 10000 * (g.t1 - g.t0) + 3600 * i.secs) // (2 * 3600 * i.secs) as hours_u,
        (2 * (g.t1 - g.t0) * 10000 + 3600) // 7200 as own_u
      from t_groups g join t_islands i using (codigo, fecha, island)""",
    "t_adj": """select *, cast(case when cost_u = 0 then cast(total_cost * 10000 as bigint) else cost_u end as bigint) as paid_u,
      cast(case when hours_u = 0 then own_u else hours_u end as bigint) as adj_u from t_shared""",
    "t_ops": """select fecha, idcontacto, bodega, min(client) as client, count(codigo) as people, max(day_hours) as day_hours,
        max(night_hours) as night_hours, max(day_hours + night_hours) as worked_hours, max(ceil(day_hours + night_hours)) as billable_hours,
        sum(paid_u) as paid_u, sum(adj_u) as adj_u, min("start") as first_start, max("end") as last_end
      from t_adj group by fecha, idcontacto, bodega""",
    "t_priced": """select o.*, cast(t.hour_price * billable_hours as double) as gross,
        cast(cast(t.hour_price * billable_hours * 10000 as bigint) - paid_u as double) / 10000 as net
      from t_ops o left join v_overtime_tariffs t on o.idcontacto = t.idcontacto where year(fecha) = 2024""",
    "t_routes": """select fecha, client, route, count(codigo) as people, max(day_hours) as day_hours, max(night_hours) as night_hours,
        max(total_hours) as total_hours, cast(sum(total_cost) as double) as paid from t_rows group by fecha, client, route""",
}
oracle("labor_cost", """select codigo, strftime(fecha, '%Y-%m-%d') as fecha, cast(sum(day_cost) as double) as day_cost,
  cast(sum(night_cost) as double) as night_cost, cast(sum(total_cost) as double) as total_cost,
  cast(max(cast(sunday as int)) as bigint) as sunday from t_rows group by codigo, fecha""")
SPAN = ("strftime(make_timestamp(t0 * 1000000), '%Y-%m-%d %H:%M:%S') as island_start, "
        "strftime(make_timestamp(t1 * 1000000), '%Y-%m-%d %H:%M:%S') as island_end")
oracle("interval_islands", f"select codigo, {d('fecha')}, {SPAN}, {i('tasks')} from t_islands")
oracle("overlap_report", f"""select codigo, {d('fecha')}, {SPAN}, {i('tasks')}, cast((secs - (t1 - t0)) * 1000000 as double) / 3.6e9 as double_hours
  from t_islands where tasks > 1""")
oracle("covered_hours", f"""select codigo, {d('fecha')}, cast(sum(t1 - t0) * 1000000 as double) / 3.6e9 as covered_hours
  from t_islands group by codigo, fecha""")
oracle("labor_overlap_adjust", f"""select codigo, {d('fecha')}, strftime("start", '%Y-%m-%d %H:%M:%S') as start,
  strftime("end", '%Y-%m-%d %H:%M:%S') as "end", {n('total_cost')}, cast(own_u as double) / 10000 as duration_hours,
  cast(paid_u as double) / 10000 as adjusted_cost, cast(adj_u as double) / 10000 as adjusted_hours from t_adj""")
PAID = "cast(paid_u as double) / 10000 as paid"
oracle("labor_operations_warehouse", f"""select {d('fecha')}, idcontacto, bodega, client, people,
  {n('day_hours', 'night_hours', 'worked_hours', 'billable_hours')}, {PAID} from t_ops""")
oracle("labor_person_hours", f"""select {d('fecha')}, idcontacto, bodega, upper(client) as client, people,
  cast(adj_u as double) / 10000 as person_hours, {PAID} from t_ops""")
oracle("operation_span", f"""select {d('fecha')}, idcontacto, bodega, {ts('first_start')}, {ts('last_end')},
  cast(ceil((epoch_us(last_end) - epoch_us(first_start)) / 3.6e9) as bigint) as span_hours from t_ops""")
oracle("overtime_by_worker", f"""select strftime(date_trunc('month', fecha), '%Y-%m-%d') as month, codigo, worker,
  cast(sum(adj_u) as double) / 10000 as hours, cast(sum(paid_u) as double) / 10000 as paid from t_adj group by 1, 2, 3""")
oracle("labor_operations_delivery", f"""select {d('fecha')}, client, route, people, {n('day_hours', 'night_hours', 'total_hours')}, paid,
  cast(day_hours as double) / people as day_hours_per_head, cast(night_hours as double) / people as night_hours_per_head,
  cast(total_hours as double) / people as total_hours_per_head, cast(total_hours as double) as paid_hours,
  case when lag(paid) over k <> 0 then (paid / lag(paid) over k - 1) * 100 end as change_pct
  from t_routes window k as (partition by client order by fecha, route)""")
oracle("delivery_by_worker", """select strftime(date_trunc('month', fecha), '%Y-%m-%d') as month, codigo, worker,
  cast(sum(total_hours) as double) as hours, cast(sum(total_cost) as double) as paid from t_rows group by 1, 2, 3""")


def margin(key: str) -> str:
    sums = "cast(coalesce(sum(cast({0} as decimal(18,4))), 0) as double) as {0}"
    return f"""select *, case when gross = 0 then 0 else net / gross * 100 end as margin_pct from (
      select strftime(date_trunc('month', fecha), '%Y-%m-%d') as month, {key},
        {', '.join(sums.format(c) for c in ('billable_hours', 'worked_hours', 'gross', 'net'))}, cast(sum(paid_u) as double) / 10000 as paid
      from t_priced group by 1, 2)"""


oracle("labor_margin_by_month", margin("bodega"))
oracle("labor_margin_by_client", margin("client"))
oracle("labor_margin_by_operation", f"""select {d('fecha')}, idcontacto, bodega, people, {n('billable_hours')}, {PAID}, gross, net,
  round_even(case when gross = 0 then 0 else net / gross * 100 end, 2) as margin_pct from t_priced""")

oracle("labor_margin_rollups", f"""select month, client, null as bodega, billable_hours, worked_hours, paid, gross, net, margin_pct, 'client' as rolled_by
  from ({margin("client")}) union all
  select month, null, bodega, billable_hours, worked_hours, paid, gross, net, margin_pct, 'warehouse' from ({margin("bodega")})""")

# ---- sweep: every pair of stretch and task is compared here, which the Spark side never does --------


def stretches(keys: str) -> dict[str, str]:
    """Stretches between neighbouring instants of a key, with the number of tasks that cover each."""
    first = keys.split(",")[0].strip()
    on = " and ".join(f"s.{k.strip()} = t.{k.strip()}" for k in keys.split(","))
    return {
        f"z_at_{first}": f"""select distinct {keys}, unnest([t0, t1]) as a from z_tasks""",
        f"z_gap_{first}": f"select {keys}, a, lead(a) over (partition by {keys} order by a) as b from z_at_{first}",
        f"z_run_{first}": f"""select {', '.join('s.' + k.strip() for k in keys.split(','))}, s.a, s.b, count(*) as running
          from z_gap_{first} s join z_tasks t on {on} and t.t0 <= s.a and t.t1 >= s.b group by all""",
    }


CTES |= {
    "z_tasks": """select *, epoch_us("start") as t0, epoch_us("end") as t1 from v_labor_tasks where "start" < "end" """,
    **stretches("codigo, fecha"), **stretches("fecha, idcontacto, bodega"),
}
INSTANT = "strftime(make_timestamp({0}), '%Y-%m-%d %H:%M:%S') as {1}"
oracle("task_concurrency", f"""select codigo, {d('fecha')}, {INSTANT.format('a', 'from_time')}, {INSTANT.format('b', 'to_time')}, {i('running')}
  from z_run_codigo""")
oracle("operation_peaks", f"""select {d('fecha')}, idcontacto, bodega, {i('peak')}, {INSTANT.format('peak_from', 'peak_from')},
  cast(peak_micros as double) / 3.6e9 as peak_hours, cast(busy as double) / 3.6e9 as busy_hours, cast(lengths as double) / 3.6e9 as task_hours from (
    select fecha, idcontacto, bodega, max(running) as peak, min(a) filter (running = top) as peak_from,
      sum(b - a) filter (running = top) as peak_micros, sum(b - a) as busy, sum((b - a) * running) as lengths
    from (select *, max(running) over (partition by fecha, idcontacto, bodega) as top from z_run_fecha) group by all)""")
oracle("task_overlaps", f"""select t.codigo, strftime(t.fecha, '%Y-%m-%d') as fecha, strftime(t."start", '%Y-%m-%d %H:%M:%S') as start,
  strftime(t."end", '%Y-%m-%d %H:%M:%S') as "end", coalesce((select cast(sum(r.b - r.a) as double) / 1e6 from z_run_codigo r
    where r.codigo = t.codigo and r.fecha = t.fecha and r.running > 1 and r.a >= t.t0 and r.b <= t.t1), 0) as overlapped_seconds
  from (select *, epoch_us("start") as t0, epoch_us("end") as t1 from v_labor_tasks) t""")

# ---- levels by month, and at a date --------------------------------------------------------------

CTES |= {
    "y_level": """select idcontacto, date, date_trunc('month', date) as month, inflow_cbm - outflow_cbm as net,
        s - least(0, min(s) over (partition by idcontacto order by date)) as level_cbm from y_run""",
    "y_prefix": "select *, sum(net) over (partition by idcontacto, month order by date) as p from y_level",
    "y_month": """select idcontacto, month, sum(net) as shift, sum(net) - min(p) as floor, arg_max(level_cbm, date) as closing
      from y_prefix group by all""",
    "y_state": """select m.idcontacto, month, shift, floor, closing,
        coalesce(lag(closing) over (partition by m.idcontacto order by month), o.initial_inventory, 0) as opening
      from y_month m left join v_opening_levels o on o.idcontacto = m.idcontacto""",
}
for name in ("level_months", "level_rebooked"):
    oracle(name, f"select idcontacto, {d('month')}, {n('shift', 'floor', 'opening', 'closing')} from y_state")
oracle("level_from_months", f"select idcontacto, {d('date')}, {n('net', 'level_cbm')} from y_level")
oracle("level_at_date", """select r.idingreso, r.idcontacto, strftime(r.day, '%Y-%m-%d') as day,
  cast(coalesce(y.level_cbm, o.initial_inventory, 0) as double) as level_cbm
  from (select *, cast(fecha as date) + 10 as day from v_receipts) r
  asof left join y_level y on r.idcontacto = y.idcontacto and r.day >= y.date
  left join v_opening_levels o on o.idcontacto = r.idcontacto""")

oracle("measures_by_need", """select substring(o_orderpriority, 1, 1) as priority,
  cast(sum(cast('0.0000' || cast(o_orderkey % 90 + 10 as varchar) as decimal(18,6))) as varchar) as small,
  cast(sum(cast(cast(o_orderkey % 900 + 100 as varchar) || '000000000000.5' as decimal(28,4))) as varchar) as large,
  cast(sum(cast(o_totalprice as decimal(18,4))) as varchar) as price from orders group by 1""")

# ---- files read back -----------------------------------------------------------------------------

CTES["x_lines"] = """select *, o_orderkey % 4 as part, o_orderkey % 10 as kind,
  1 + row_number() over (partition by o_orderkey % 4 order by o_orderkey) as line from orders"""
oracle("csv_mixed_headers", """select cast(o_orderkey as varchar) as clave, case when kind <> 5 or part < 2 then o_orderstatus end as estado,
  case when kind = 7 then 'a,"b"' when kind <> 5 or part >= 2 then 'x' end as nota from x_lines where kind not in (3, 9)""")
oracle("csv_rejected_lines", f"""select cast(part as varchar) as part, {i('line')}, case kind when 3 then 'surplus fields' else 'open quote' end as reason,
  cast(case kind when 3 then 4 else 3 end as bigint) as fields, cast(3 as bigint) as expected from x_lines where kind in (3, 9)""")
oracle("override_from_file", """select cast(p_partkey % 97 as varchar) as idmodelo, greatest(1.0, cast(arg_min(p_size, p_partkey) as double)) as mode_count
  from part group by 1""")
for copy, name in (
    ("volume_from_file", "complete_volume"), ("loaded_and_prepared", "clean_status_filters"), ("delivery_from_files", "delivery_by_worker"),
    ("stored_report_receipts", "monthly_receipts"), ("stored_report_dispatches", "monthly_dispatches"), ("stored_report_stock", "stock_by_warehouse"),
    ("stored_report_daily", "report_daily_level"), ("stored_report_inflow", "billing_inflow"), ("stored_report_outflow", "billing_outflow"), ("stored_report_totals", "billing_totals"),
):
    ORACLE[copy] = ORACLE[name]  # the same question, asked of files or of stored tables
