import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from stowage import session
from stowage.plans import billing
from stowage.session import share, shared_dir
from stowage.sources import extracts, lookups, sinks


def write(folder, name, *lines):
    path = folder / name
    path.write_bytes(("\n".join(lines) + "\n").encode("latin-1"))
    return str(path)


def test_extract_is_text_in_latin1(spark, tmp_path):
    path = write(tmp_path, "incompra.csv", "idingreso,descrip,fecha ", '001,"Peña, ""N""",2024-01-02', "002,NA,", "003")
    df = extracts.read_extract(spark, path)
    assert df.columns == ["idingreso", "descrip", "fecha"] and set(t for _, t in df.dtypes) == {"string"}
    assert [tuple(r) for r in df.orderBy("idingreso").collect()] == [
        ("001", 'Peña, "N"', "2024-01-02"), ("002", None, None), ("003", None, None),
    ]


def test_tolerant_read_skips_surplus_and_pads_short_lines(spark, tmp_path):
    path = write(tmp_path, "rpsdt.csv", "a,b,c", "1,2,3", "1,2,3,4", "5", "6,7,8,9,10")
    kept = extracts.read_extract(spark, path, tolerant=True)
    assert sorted(tuple(r) for r in kept.collect()) == sorted([("1", "2", "3"), ("5", None, None)])
    assert kept.select("a").count() == 2  # also when columns are pruned
    assert sorted(r.a for r in extracts.surplus_lines(spark, path).collect()) == ["1", "6"]
    with pytest.raises(Exception, match="surplus fields"):
        extracts.read_extract(spark, path).collect()


def test_quoted_line_breaks_stay_in_their_row(spark, tmp_path):
    path = write(tmp_path, "quoted.csv", "a,b", '1,"x', 'y"', "2,z")
    assert sorted(r.b for r in extracts.read_extract(spark, path, multiline=True).collect()) == ["x\ny", "z"]


def test_labour_dates_in_iso_and_day_first(spark):
    from stowage.sources.lookups import prepare_labor

    spelled = ["2024-01-05", "2024-01-05 00:00:00", "5/1/2024", "05-01-24"]
    df = spark.createDataFrame([(x,) for x in spelled], "Fecha string")
    assert {str(r.Fecha) for r in prepare_labor(df).collect()} == {"2024-01-05"} and prepare_labor(df).count() == 4
    real = spark.sql("select date'2024-01-05' as Fecha")
    assert str(prepare_labor(real).first().Fecha) == "2024-01-05"

def test_sites_are_tagged_and_united(spark, tmp_path):
    write(tmp_path, "rpsdt.csv", "numero,idproducto,idcontacto,idmodelo", "1,0000000001007,C1,M1")
    write(tmp_path, "rpsdt_c.csv", "numero,idproducto,idcontacto,extra", "1,0000000001007,,x")
    parts = [extracts.read_site(spark, str(tmp_path), "order_lines_out", s) for s in ("", "_c")]
    rows = {r.idingreso: r for r in extracts.union_all(parts).collect()}
    assert rows["0000000001"].numero == "1" and rows["0000000001"].extra is None
    tagged = rows["0000000001_c"]
    assert (tagged.numero, tagged.idcontacto, tagged.idmodelo, tagged.extra) == ("1_c", None, None, "x")
    assert tagged.idproducto == "0000000001007"


def test_clients_of_the_base_site_are_renamed(spark, tmp_path):
    write(tmp_path, "incontac.csv", "codigo,nombre,tel", "1,Ana,9")
    write(tmp_path, "incontac_e.csv", "idcontacto,descrip,tel", "1,Eva,9")
    both = extracts.union_all([extracts.read_site(spark, str(tmp_path), "clients", s) for s in ("", "_e")])
    assert sorted(tuple(r) for r in both.collect()) == [("1", "Ana"), ("1_e", "Eva")]


def test_stock_product_suffix_is_optional(spark, tmp_path):
    write(tmp_path, "insaldo_c.csv", "idingreso,idmodelo", "1,M")
    assert extracts.read_site(spark, str(tmp_path), "stock", "_c").first().idmodelo == "M"
    assert extracts.read_site(spark, str(tmp_path), "stock", "_c", suffix_stock_product=True).first().idmodelo == "M_c"


def test_snapshots(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01"), (2, "2024-02")], "n int, month string")
    for fmt in ("parquet", "csv"):
        for _ in range(2):  # a second write replaces the first
            sinks.write_snapshot(df, str(tmp_path / fmt), fmt, ["month"] if fmt == "parquet" else [])
        back = spark.read.format(fmt).option("header", True).load(str(tmp_path / fmt))
        assert back.count() == 2 and set(back.columns) == {"n", "month"}


def test_share_writes_a_table_in_the_shared_folder(spark):
    df = share(spark.range(10).withColumn("x", F.col("id") * 2), "numbers")
    assert df.count() == 10 and all(shared_dir(spark) in f for f in df.inputFiles())


def test_share_leaves_no_shuffle_files(spark):
    import glob

    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for d in manager.localDirsString() for f in glob.glob(f"{d}/*/shuffle_*")}
    before = files()
    setting = spark.conf.get(session.CLEAN_UP, None)
    df = share(spark.range(1000).groupBy(F.col("id") % 7).count(), "sevens")
    deadline = time.time() + 20
    while files() - before and time.time() < deadline:
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(session.CLEAN_UP, None) == setting
    assert df.count() == 7 and all(f.endswith(".zstd.parquet") for f in df.inputFiles())


def test_first_override_line_wins(spark, tmp_path):
    path = write(tmp_path, "override.csv", "idmodelo,mode_count", "M1 ,3", "M1,9", "M2,1", "M3,x")
    mode = spark.createDataFrame([("M1", 2), ("M2", 4), ("M4", 5)], "idmodelo string, mode_count long")
    got = billing.mode_with_override(mode, lookups.read_pallet_override(spark, path))
    assert {r.idmodelo: r.mode_count for r in got.collect()} == {"M1": 3.0, "M2": 4.0, "M3": 1.0, "M4": 5.0}


def test_labor_sheets(spark, tmp_path):
    head = "Fecha,Cliente,Idcontacto,Bodega,Nombre,Codigo,Descripcion,Observaciones,Hora de inicio,Hora de finalizacion,Horas diurnas,Horas nocturnas,Total"
    work = write(
        tmp_path, "w.csv", head, "02/01/2024,Ana,7, boda ,Luz,001,d,o,08:00:00,10:00:00,2,x,2",
        "09/02/2024,Ana,7,boda,Luz,001,d,o,08:00:00,10:00:00,2,0,2",
    )
    ride = write(tmp_path, "d.csv", "Fecha,Cliente,Ruta,Codigo,Tipo,Puntos de entrega,Puntos adicionales,Nombre,Hora de inicio,Hora de finalizacion,Aprobacion,Horas diurnas,Horas nocturnas,Total", "02/01/2024,Ana,R1,001,t,1,0,Luz,08:00:00,09:00:00,si,1,0,1")
    warehouse, delivery = lookups.read_labor(spark, work, ride, end=dt.date(2024, 1, 31))
    row = warehouse.first()
    assert warehouse.count() == 1 and (row.Fecha, row.Bodega, row.Codigo) == (dt.date(2024, 1, 2), "BODA", "001")
    assert row["Horas diurnas"] == 2.0 and row["Horas nocturnas"] is None
    assert delivery.first().Ruta == "R1"


def test_other_lookups(spark, tmp_path):
    volume = write(tmp_path, "v.csv", "idmodelo,descrip,clasificacion,cubicaje", "M1,d,c,1.2")
    assert lookups.read_product_volume(spark, volume).first().cubicaje == "1.2"
    wages = write(tmp_path, "s.csv", "Codigo,Cargo,Hora diurna,Hora nocturna,Hora domingo", "001,Aux,2,3,4")
    assert lookups.read_wages(spark, wages).first()["Hora domingo"] == 4.0
    tariffs = write(tmp_path, "t.csv", "cliente,tarifa", "A,5")
    assert lookups.read_client_tariffs(spark, tariffs).first().tarifa == "5"
    spark.createDataFrame([("7", 6)], "Idcontacto string, `Precio H. Extra` int").write.parquet(str(tmp_path / "p.parquet"))
    assert lookups.read_overtime_tariffs(spark, str(tmp_path / "p.parquet")).first()["Precio H. Extra"] == 6.0
    with pytest.raises(Exception):
        lookups.read_wages(spark, tariffs).collect()


def test_fields_keep_quotes_empty_ends_and_commas(spark):
    import csv
    import io

    from stowage.sources.lines import fields_of, is_open, unquoted

    lines = ["a,b", "3,4,", ",", "", ",,x", '"a,b",c', '"a""b",""', '5" pipe,"6"" pipe"', 'x,"y', '" a ",b ', '"q"tail,z', '"",,""', "ñ,\u20ac", '""""']
    lines += [f'"{"x,y" * 3000}",2', ",".join("abcdefghij" * 300)]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k int, v string")
    found = df.select("k", F.transform(fields_of(F.col("v")), unquoted).alias("f"), F.exists(fields_of(F.col("v")), is_open).alias("o"))
    for r in found.collect():
        line = lines[r.k]
        assert r.o == (line == 'x,"y')
        if not r.o:
            assert r.f == (next(csv.reader(io.StringIO(line))) if line else [""]), line


def test_rejected_lines_carry_file_and_line_whatever_the_split(spark, tmp_path):
    folder = tmp_path / "x.csv"
    folder.mkdir()
    want = []
    for name, header, flip in (("1.csv", "a,b", False), ("2.csv", "b,a", True)):
        lines = [header]
        for k in range(2, 2500):
            if k % 97 == 0:
                lines.append(f"{k},4,")
                want.append((name, k, "surplus fields", 3))
            elif k % 89 == 0:
                lines.append(f'{k},"open')
                want.append((name, k, "open quote", 2))
            elif k % 83 == 0:
                lines.append("  ")
            else:
                lines.append(f"y{k},x{k}" if flip else f"x{k},y{k}")
        write(folder, name, *lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("1500b", old):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            read = extracts.read_lines(spark, str(folder))
            if size != old:
                assert spark.read.text(str(folder)).rdd.getNumPartitions() > 10
            assert sorted((r.file.split("/")[-1], r.line, r.reason, r.fields) for r in read.rejects.collect()) == sorted(want)
            rows = read.rows.collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        assert all(r.a == f"x{r.a[1:]}" and r.b == f"y{r.a[1:]}" for r in rows) and len(rows) == 2 * (2498 - 2498 // 83) - len(want)


def test_headers_per_file(spark, tmp_path):
    folder = tmp_path / "h.csv"
    folder.mkdir()
    write(folder, "1.csv", "a,b", "1,2")
    write(folder, "2.csv", "b,a", "2,1", "2,1,")
    write(folder, "3.csv", "b", "2", "2,9")
    rows = extracts.read_extract(spark, str(folder), tolerant=True).collect()
    assert sorted((r.a or "", r.b) for r in rows) == [("", "2"), ("1", "2"), ("1", "2")]
    assert extracts.rejected_lines(spark, str(folder)).count() == 2
    many = extracts.read_extract(spark, str(folder), tolerant=True, multiline=True)
    assert many.columns == ["a", "b"] and many.filter("b = '2'").count() >= 3
    write(folder, "4.csv", "a,c", "1,2")
    for multiline in (False, True):
        with pytest.raises(ValueError, match="unknown columns"):
            extracts.read_extract(spark, str(folder), multiline=multiline)
    write(tmp_path, "empty.csv")
    assert extracts.read_extract(spark, str(tmp_path / "empty.csv")).count() == 0


def test_account_equals_a_recount(spark, tmp_path):
    from stowage.sources.account import Account

    counts = {}
    for stem in extracts.STEMS.values():
        for n, site in enumerate(extracts.SITES):
            tolerant = next(t for t, s in extracts.STEMS.items() if s == stem) in extracts.TOLERANT
            bad = ["1,2,3,"] * (n + 1) if tolerant else []
            write(tmp_path, f"{stem}{site}.csv", "idcontacto,descrip,idproducto", *["a,b,c"] * (5 + n), *bad)
            counts[f"{stem}{site}"] = {"kept": 5 + n, "rejected": len(bad)}
    account = Account()
    loaded = extracts.load_tables(spark, str(tmp_path), account=account)
    for name in extracts.STEMS:
        getattr(loaded, name).write.format("noop").mode("overwrite").save()
    assert account.counts() == counts
    told = {(r.extract, r.reason): r.lines for r in account.rejected().collect()}
    assert told == {(k, "surplus fields"): v["rejected"] for k, v in counts.items() if v["rejected"]}

    typed = spark.createDataFrame([("1.5", "2024-01-02"), ("x", "never"), (None, None), ("nan", "2024-02-30")], "n string, d string")
    cast = account.dates(account.measures(typed, "numbers", "n", "absent"), "dates", "d")
    assert cast.columns == ["n", "d"]
    got = cast.collect()
    assert account.counts("numbers", "dates") == {"numbers": {"n": sum(r.n is None for r in got) - 1}, "dates": {"d": sum(r.d is None for r in got) - 1}}


def test_override_positions_follow_lines(spark, tmp_path):
    lines = [f"p{k % 700},{k}" for k in range(3000)]
    write(tmp_path, "o.csv", "idmodelo,mode_count", *lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000b")
    try:
        sheet = lookups.read_pallet_override(spark, str(tmp_path / "o.csv"))
        order = [r.mode_count for r in sheet.orderBy("position").collect()]
        sheet.orderBy("position").drop("position").coalesce(1).write.parquet(str(tmp_path / "sheet"))
        again = [r.mode_count for r in lookups.read_pallet_override(spark, str(tmp_path / "sheet"), fmt="parquet").orderBy("position").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [int(x) for x in order] == list(range(3000)) and again == order


def test_monthly_snapshot(spark, tmp_path):
    path = str(tmp_path / "levels")
    kept = sinks.MonthlySnapshot(spark, path)
    make = lambda *rows: spark.createDataFrame(rows, "month date, client string, v int")
    jan, feb, mar = (dt.date(2024, m, 1) for m in (1, 2, 3))
    read = lambda: sorted(tuple(r) for r in kept.read().collect())
    with pytest.raises(ValueError, match="no months"):
        kept.read()
    assert kept.read("month date, client string, v int").count() == 0
    kept.write(make((jan, "a", 1), (feb, "a", 2), (feb, "b", 3)))
    first = kept.versions()
    assert read() == [(jan, "a", 1), (feb, "a", 2), (feb, "b", 3)] and set(first) == {"2024-01-01", "2024-02-01"}

    kept.write(make((feb, "a", 9), (mar, "c", 4)))  # a rerun of a month rewrites that month alone
    assert read() == [(jan, "a", 1), (feb, "a", 9), (mar, "c", 4)]
    assert kept.versions()["2024-01-01"] == first["2024-01-01"] and kept.versions()["2024-02-01"] != first["2024-02-01"]

    before = read()
    with pytest.raises(Exception, match="no month"):
        kept.write(make((jan, "a", 7), (None, "a", 8)))
    make((jan, "z", 0)).write.parquet(f"{path}/runs/killed")  # a run that never got to its manifest
    (tmp_path / "levels" / "manifests" / "0000000099-killed").mkdir()
    assert read() == before

    kept.write(make(), months=["2024-03-01"])
    assert read() == [(jan, "a", 1), (feb, "a", 9)]
    gone = kept.clean()
    assert "runs/killed" in gone and "manifests/0000000099-killed" in gone and read() == [(jan, "a", 1), (feb, "a", 9)]
    assert {p.name for p in (tmp_path / "levels" / "runs").iterdir()} == set(kept.versions().values())
    assert kept.clean() == []


def test_measures_fit_their_numbers(spark):
    from stowage.functions.numbers import MEASURE, coerce_fitted, fitted_types

    df = spark.createDataFrame(
        [("0.00004", "150000000000000", "1.5", "x"), ("-2.5", " 7 ", "nan", None), (None, "N/D", "12", "-")], "a string, b string, c string, d string"
    )
    types = fitted_types(df, "a", "b", "c", "d", "absent")
    assert types == {"a": "decimal(6,5)", "b": "decimal(19,4)", "c": MEASURE, "d": MEASURE}
    rows = coerce_fitted(df, types).collect()
    assert [str(r.a) for r in rows] == ["0.00004", "-2.50000", "None"] and [r.b for r in rows][:2] == [150000000000000, 7]
    assert rows[1].c is None and all(r.d is None for r in rows)
    for bad in ("0.000001", "12345678901"):
        with pytest.raises(Exception, match="does not fit"):
            coerce_fitted(spark.createDataFrame([(bad,)], "a string"), {"a": "decimal(6,5)"}).collect()
    with pytest.raises(OverflowError):
        fitted_types(spark.createDataFrame([("1" * 30,)], "a string"), "a")


def test_shared_tables_are_removed(spark, tmp_path):
    import os

    from stowage import session

    held = session._SHARED.pop(spark.sparkContext.applicationId, [])
    try:
        df = share(spark.range(3), "short-lived")
        files = [p.removeprefix("file:") for p in session._SHARED[spark.sparkContext.applicationId]]
        assert df.count() == 3 and session.clear_shared(spark) == 1 and not any(os.path.exists(p) for p in files)
    finally:
        session._SHARED[spark.sparkContext.applicationId] = held


def test_a_line_is_cut_into_fields_once(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,"x,y"\n2,\n"open,3\n4,5,6\n')
    rows = extracts.read_extract(spark, str(tmp_path / "x.csv"), tolerant=True).filter("b = 'x,y' or a = '2'")
    assert sorted(tuple(r) for r in rows.collect()) == [("1", "x,y"), ("2", None)]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == plan.count("split(") == 1
    rejected = {r["line"]: r["reason"] for r in extracts.rejected_lines(spark, str(tmp_path / "x.csv")).collect()}
    assert rejected == {4: "open quote", 5: "surplus fields"}
