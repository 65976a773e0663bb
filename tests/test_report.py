"""From CSV extracts of three sites to the client report, with figures worked out by hand."""

import datetime as dt
from decimal import Decimal

import pytest

from stowage import session
from stowage.plans import cleaning, flows, reports, screening
from stowage.sources.extracts import load_tables
from stowage.tables import STEMS

HEADERS = {
    "cohd": "idcoclase,numero,itemcount,itemqty,fecha,idcontacto,descrip,idcostatus,retnum,equipo",
    "rpshd": "numero,estatus,tipo,fecha,idcentro,idcentro1,descrip,itemcount,pzascan,trannum,equipo,referencia",
    "rpsdt": "numero,itemline,estatus,idproducto,idcontacto,idmodelo,idcoldis,idubica,cantidad,equipo,idubica1,ingresa",
    "incompra": "idingreso,fecha,items,transtatus,descrip,available,equipo,idcontacto,retnum,referencia",
    "inmovid": "trannum,lineano,fecha,cantidad,idmodelo,idcoldis,idingreso,itemno,idcontacto,equipo,idcentro,idcentro1,idclase,numero",
    "inmovih": "idbodega,idclase,numero,fecha,idcontacto,referencia,transtatus,descrip,trannum,linead,lineac,idcliente,equipo,idcentro,idcentro1",
    "insaldo": "idingreso,itemno,idstatus,idmodelo,idcoldis,fecha,modifica,idcontacto,idubica,pesokgs,inicial,salidas,idubica1,idpedido,idcentro,idbodega,ingresa,retnum,equipo,idproducto",
    "inmodelo": "idmodelo,descrip",
    "ctcentro": "idcentro,descrip",
    "incontac": "codigo,nombre",
}

ROWS = {
    "incompra.csv": [
        "0000000001,2024-01-05,3,1,OC uno,1,e,C1,RT1,f",
        "0000000001,2024-01-04,9,1,OC vieja,1,e,C1,RT0,f",  # older version of the same receipt
        "0000000002,2024-01-10,1,1,,1,e,C1,RT2,f",
        "0000000003,mal,1,1,sin fecha,1,e,C1,RT3,f",
    ],
    "incompra_c.csv": ["0000000001,2024-01-20,1,1,Año,1,e,C1,RT1,f"],
    "insaldo.csv": [
        # receipt 1: two items on one pallet, one loose item, one gone; the first item twice
        "0000000001,001,01,M1,d,2024-01-05,2024-01-05,C1,A1,10,2,0,TA1,0,,,,,,",
        "0000000001,001,01,M1,d,2024-01-03,2024-01-03,C1,A1,99,99,0,TA1,0,,,,,,",
        "0000000001,002,01,M1,d,2024-01-05,2024-01-05,C1,A1,10,2,0,TA1,0,,,,,,",
        "0000000001,003,01,M2,d,2024-01-05,2024-01-05,C1,E1,5,7,0,R9,0,,,,,,",
        "0000000001,004,03,M1,d,2024-01-05,2024-02-01,C1,A1,0,0,0,TA2,4,,,,,,",
        # receipt 2: its only item left a retired location
        "0000000002,001,XX,M1,d,2024-01-10,2024-01-10,C1,DT1H2,1,1,0,TA3,0,,,,,,",
    ],
    "insaldo_c.csv": ["0000000001,001,01,M1,d,2024-01-20,2024-01-20,C1,A1,4,6,0,,0,,,,,,"],
    "inmovid.csv": [
        "T1,1,2024-02-10,3,M1,d,0000000001,004,C1,e,,,TR01,N1",
        "T1,2,2024-02-10,1,M1,d,0000000009,001,C1,e,,,TR01,N1",
        "T2,1,2024-02-11,8,M1,d,0000000001,003,C1,e,,,TR02,N2",
    ],
    "inmovih.csv": ["1,TR01,N1,2024-02-10,C1,r,1,d,T1,1,1,C1,e,,", "1,TR01,N9,2024-02-10,C1,r,1,d,T9,1,1,C1,e,,"],
    "rpsdt.csv": ["N1,1,1,0000000009001,C1,M1,d,C9,1,e,,", "N1,2,1,0000000009001,C1,M1,d,A9,1,e,,,surplus"],
    "rpshd.csv": ["N1,5,t,2024-02-10,,,d,1,1,T1,e,r", "N2,1,t,2024-02-10,,,d,1,1,T2,e,r", "N3,,t,2024-02-10,,,d,1,1,T3,e,r"],
    "incontac.csv": ["C1,Ana", "AC0001,Prueba"],
    "incontac_c.csv": ["C1,Eva"],
    "ctcentro.csv": ["001,Uno", "002,Prueba"],
}


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    folder = tmp_path_factory.mktemp("extracts")
    for stem in STEMS.values():
        for site in ("", "_c", "_e"):
            head = HEADERS[stem] if (stem, site) != ("incontac", "_c") else "idcontacto,descrip"
            lines = [head if (stem, site) != ("incontac", "_e") else "idcontacto,descrip", *ROWS.get(f"{stem}{site}.csv", [])]
            (folder / f"{stem}{site}.csv").write_bytes(("\n".join(lines) + "\n").encode("latin-1"))
    return str(folder)


@pytest.fixture(scope="module")
def lookups(spark):
    volume = spark.createDataFrame([("M2", "d", "c", "1.25")], "idmodelo string, descrip string, clasificacion string, cubicaje string")
    override = spark.createDataFrame([("M9", "4")], "idmodelo string, mode_count string")
    return volume, override


@pytest.fixture(scope="module")
def report(spark, base, lookups):
    return reports.client_report(load_tables(spark, base), *lookups, "01-01-2024", "31/12/24", "2024-03-01")


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_cleaning_and_screening(spark, base):
    raw = load_tables(spark, base)
    t = cleaning.clean(raw)
    assert (raw.stock.count(), t.stock.count(), t.dispatched_stock.count(), t.stock_all.count()) == (7, 5, 1, 6)
    assert sorted(r.numero for r in t.orders_out.collect()) == ["N2", "N3"]
    assert t.order_lines_out.count() == 1 and t.dispatches.count() == 2
    assert {r.idcontacto for r in t.clients.collect()} == {"C1", "C1_c"} and t.centers.count() == 1
    s = screening.screen(t)
    assert {r.trannum: r.bodega for r in s.dispatch_headers.collect()} == {"T1": "BODC"}
    places = {(r.idingreso, r.itemno): r.bodega for r in s.stock.collect()}
    assert places["0000000001", "003"] == "BODE" and places["0000000001_c", "001"] == "BODC"
    first = by(s.receipts.dropDuplicates(["idingreso"]), "idingreso")
    assert first["0000000001"].descrip == "OC uno" and first["0000000002"].bodega == "DESCONOCIDO"


def test_first_line_is_the_smallest_number(spark):
    rows = [("R", "N10", "1", "A1", "BODA"), ("R", "5", "10", "C1", "BODC"), ("R", "5", "2", "G1", "BODG"), (None, "1", "1", "E1", "BODE")]
    lines = spark.createDataFrame(rows, "idingreso string, numero string, itemline string, idubica string, bodega string")
    assert [tuple(r) for r in screening.first_line_place(lines).collect()] == [("R", "BODG", "G1")]


def test_monthly_receipts(report):
    rows = by(report.monthly_receipts, "client", "bodega")
    jan = dt.date(2024, 1, 1)
    # Receipt 1 shows places in two warehouses; the larger name (BODE) settles the tie.
    ana = rows["Ana", "BODE"]
    assert (ana.month, ana.pallets, ana.units) == (jan, 4, Decimal(25))
    # Volumes 2 + 2 + 7 + 0, and 4 detached in a later month.
    assert ana.cbm == Decimal(15) and ana.idcontacto == "00C1"
    # Receipts 2 and 3 have no stock: one row remains, the newest, whose warehouse nobody knows.
    assert rows["Ana", "INCOHERENT VALUES"].pallets == 1
    assert rows["Eva", "BODC"].cbm == Decimal(6) and len(rows) == 3


def test_monthly_dispatches(report):
    (row,) = report.monthly_dispatches.collect()
    # Receipt 1 has no outbound line, so its unknown warehouse becomes the client's only known one.
    assert (row.client, row.bodega, row.pallets, row.cbm, row.units) == ("Ana", "BODC", 2, Decimal(4), Decimal(0))
    assert [r.cbm for r in report.period_dispatches.collect()] == [Decimal(4)]
    assert [r.bodega for r in report.period_receipts.collect()] == ["BODE", "BODC", "INCOHERENT VALUES"]


def test_stock(report):
    rows = by(report.stock_by_warehouse, "bodega", "idcontacto")
    boda, bode = rows["BODA", "00C1"], rows["BODE", "00C1"]
    assert (boda.cbm, boda.pallets, boda.units) == (Decimal(4), 2, Decimal(20))
    assert (bode.cbm, bode.pallets) == (Decimal("1.25"), 1)
    share = by(report.stock_proportions, "idmodelo")
    assert share["M1"].pallets == 3 and round(share["M1"].cbm_pct, 3) == round(10 / 11.25 * 100, 3)
    assert {(r.date, r.idmodelo): r.days for r in report.stock_ageing.collect()}[dt.date(2024, 1, 5), "M1"] == 56


def test_billing(report):
    lines = by(report.billing_inflow, "idingreso", "idmodelo")
    # Product M1: one pallet holds 3 rows, one loose row holds 1: a tie, so one item per pallet.
    m1 = lines["0000000001", "M1"]
    assert (m1.pallets, m1.cbm, m1.units, m1.description) == (2, Decimal(4), Decimal(20), "OC uno")
    assert lines["0000000001_c", "M1"].description == "Año"
    (out,) = report.billing_outflow.collect()
    assert (out.trannum, out.pallets, out.cbm, out.days, out.client) == ("T1", 2, Decimal(4), 37.0, "Ana")
    stock = by(report.billing_stock, "idingreso")
    one = stock["0000000001"]
    # Loose item first, then the pallet; the repeated item counts in the pallet's volume.
    assert (one.pallets, one.itemno, one.label, one.days) == (2, "003", "0000000001003", 57)
    assert one.cbm == Decimal("104.25") and stock["0000000001_c"].pallets == 1
    totals = by(report.billing_totals, "kind")
    assert (totals["received"].pallets, totals["shipped"].pallets, totals["on_hand"].pallets) == (4, 2, 3)


def test_level_and_kpis(report):
    daily = by(report.daily, "date")
    assert daily[dt.date(2024, 1, 5)].level_cbm == Decimal(11) and daily[dt.date(2024, 2, 10)].level_cbm == Decimal(13)
    assert "initial_inventory" not in report.period.columns and report.period.count() == report.daily.count()
    months = by(report.monthly, "month_end")
    assert months[dt.date(2024, 1, 31)].final_level_cbm == Decimal(17)
    kpis = by(report.kpis, "month")
    feb = kpis[dt.date(2024, 2, 1)]
    assert (feb.turnover, feb.days_on_hand, feb.level_mom_pct) == (0.27, 94.25, -23.53)
    assert kpis[dt.date(2024, 1, 1)].turnover == 0.0
    assert round(sum(r.inflow_cbm_pct for r in report.client_share.collect()), 6) == 100


def test_one_client_only(spark, base, lookups):
    got = reports.client_report(load_tables(spark, base), *lookups, "01-01-2024", "31/12/24", "2024-03-01", client="C1_c", keep_shared=False)
    assert {r.client for r in got.monthly_receipts.collect()} == {"Eva"} and got.monthly_dispatches.count() == 0
    assert got.stock_by_warehouse.count() == 1


def test_reports_of_all_warehouses_add_up(spark, base, lookups, report):
    tables = load_tables(spark, base)
    frames = ["monthly_receipts", "monthly_dispatches", "stock_by_warehouse", "billing_inflow", "billing_outflow", "billing_stock"]
    whole = {name: getattr(report, name).collect() for name in frames}
    places = {r[c] for rows in whole.values() for r in rows for c in ("bodega", "warehouse") if c in r}
    assert {"BODA", "BODC", "BODE"} <= places
    found = {name: [] for name in frames}
    for place in sorted(places):
        part = reports.client_report(tables, *lookups, "01-01-2024", "31/12/24", "2024-03-01", warehouse=place, keep_shared=False)
        for name in frames:
            found[name] += getattr(part, name).collect()
    for name in frames:
        assert sorted(map(repr, found[name])) == sorted(map(repr, whole[name])), name


def test_a_report_needs_a_known_warehouse(spark, base, lookups):
    with pytest.raises(ValueError, match="unknown warehouse"):
        reports.client_report(load_tables(spark, base), *lookups, "01-01-2024", "31/12/24", "2024-03-01", warehouse="X", keep_shared=False)


def test_switches_reach_the_report(spark, base, lookups, report):
    got = reports.client_report(
        load_tables(spark, base), *lookups, "01-01-2024", "31/12/24", "2024-03-01", keep_shared=False,
        collapse_unmatched=True, match_item=True, pallets="per_group",
    )
    rows, groups = (sum(r.pallets_in for r in x.daily.select("pallets_in").collect()) for x in (report, got))
    billed = sum(r.pallets for r in got.billing_inflow.collect())
    assert groups < rows and round(groups, 3) == billed


def test_prepare_and_summaries(spark, base, lookups):
    tables = load_tables(spark, base)
    prepared = reports.prepare(tables, "C", "C1")
    assert prepared.stock.count() == 4 and prepared.clients.count() == 2
    assert reports.prepare(tables, "W", "nowhere").stock.count() == 0
    with pytest.raises(ValueError):
        reports.prepare(tables, "X", "C1")
    screened = screening.screen(prepared)
    summaries = reports.monthly_summaries(screened)
    assert summaries["dispatches"].by_client.count() == 1 and summaries["receipts"].by_client.count() == 2
    assert set(reports.analyze_stock(screened, lookups[0], "2024-03-01")) == {"proportions", "ageing"}


def test_billing_report_brings_the_tariffs(spark, base, lookups, tmp_path):
    (tmp_path / "tariffs.csv").write_text("client,price\nAna,5\n")
    report, tariffs = reports.billing_report(
        spark, base, *lookups, str(tmp_path / "tariffs.csv"), "01-01-2024", "31/12/24", "2024-03-01", "C", "C1"
    )
    assert tariffs.first().price == "5" and report.monthly_dispatches.count() == 1


def test_a_table_of_the_report_stores_only_what_it_needs(spark, base, lookups):
    stored = session._SHARED.setdefault(spark.sparkContext.applicationId, [])
    got = reports.client_report(load_tables(spark, base), *lookups, "01-01-2024", "31/12/24", "2024-03-01")
    before = len(stored)
    (row,) = got.monthly_dispatches.collect()
    names = {path.rsplit("/", 1)[1].rsplit("-", 1)[0] for path in stored[before:]}
    assert (row.client, row.cbm) == ("Ana", Decimal(4)) and names == {"dispatched"}
    got.billing_outflow.collect(), got.billing_totals.collect(), got.daily.collect()
    names = [path.rsplit("/", 1)[1].rsplit("-", 1)[0] for path in stored[before:]]
    assert sorted(names) == ["dispatched", "flows", "on-hand", "receipts", "received", "shipped"]


def test_filled_rows_have_the_sums_of_unfilled_ones(spark):
    rows = [
        ("1", "C1", "DESCONOCIDO", 1), ("1", "C1", "BODA", 2), ("1", "C2", "DESCONOCIDO", 4), (None, "C1", "BODA", 8),
        ("2", None, "BODC", 16), ("1", "C3", "DESCONOCIDO", 32), ("1", "C3", "BODC", 64), ("1", "C3", None, 128),
    ]
    fact = spark.createDataFrame(rows, "month string, idcontacto string, bodega string, n int").selectExpr(
        "month", "idcontacto", "bodega", "date'2024-01-01' fecha", "'x' numero", "cast(n as decimal(18,4)) pesokgs", "cast(n as decimal(18,4)) cantidad"
    )
    clients = spark.createDataFrame([("C1", "Ana"), ("C2", "Eva"), ("C3", "Ida")], "idcontacto string, descrip string")
    found, again = [flows.dispatches_by_client(f, clients, 2).collect() for f in (fact, flows.filled_warehouses(fact))]
    assert sorted(map(repr, found)) == sorted(map(repr, again))
    assert {(r.client, r.bodega, int(r.cbm)) for r in found} == {("Ana", "BODA", 3), ("Eva", "DESCONOCIDO", 4), ("Ida", "DESCONOCIDO", 32), ("Ida", "BODC", 64)}


def test_receipts_are_grouped_for_the_width_only_where_they_are_widest(spark, base, lookups, monkeypatch):
    report = reports.client_report(load_tables(spark, base), *lookups, "01-01-2024", "31/12/24", "2024-03-01")
    grouped, real = [], screening.one_per_receipt
    monkeypatch.setattr(screening, "one_per_receipt", lambda df: grouped.append(1) or real(df))
    assert report._width == 4 and not grouped
    rows = [("R1", "2024-01-01", "older-and-wider"), ("R1", "2024-01-02", "newest"), ("R2", "2024-01-01", "C1"), (None, "2024-01-03", "no-receipt-at-all")]
    given = spark.createDataFrame(rows, "idingreso string, fecha string, idcontacto string").selectExpr(
        "idingreso", "cast(fecha as timestamp) fecha", "'1' items", "'1' transtatus", "'d' descrip", "idcontacto", "'r' retnum"
    )
    report._cleaned = report._cleaned.with_(receipts=given)
    del report._width
    assert report._width == len("newest") and grouped


def test_a_bill_of_receipts_stores_what_it_reads_and_no_rows_on_hand(spark, base, lookups):
    stored = session._SHARED.setdefault(spark.sparkContext.applicationId, [])
    got = reports.client_report(load_tables(spark, base), *lookups, "01-01-2024", "31/12/24", "2024-03-01", official="salidas")
    before = len(stored)
    assert got.billing_inflow.count()
    names = [path.rsplit("/", 1)[1].rsplit("-", 1)[0] for path in stored[before:]]
    assert sorted(names) == ["receipts", "received"]
    assert set(got._received.columns) == {*flows.RECEIVED, "salidas"}
    assert got._dispatched.columns == flows.DISPATCHED
