"""Views over the stored join of lines, orders and parts."""

import pytest

from catalog import queries, views
from stowage.plans import flows
from stowage.session import clear_shared


@pytest.fixture
def odd(spark, tmp_path):
    """Lines whose order or part occurs twice, is missing or null, and equal lines."""
    lines = [(1, 1, 1, 1), (1, 1, 1, 1), (1, 2, 13, 2), (2, 2, 2, 1), (3, 3, 3, 1), (None, 1, 1, 1), (4, None, 2, 1), (5, 1, 2, None)]
    lines = spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int")
    rest = ["5D l_quantity", "1D l_extendedprice", "0.1D l_discount", "0.05D l_tax", "'N' l_returnflag", "if(l_linenumber = 1, 'F', 'O') l_linestatus", "timestamp_ntz'1997-03-04 00:00:00' l_shipdate"]
    lines.selectExpr("*", *rest).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("select * from values (1, 7, 'F'), (1, 8, 'O'), (2, 7, 'O'), (4, null, 'F'), (5, 9, 'F'), (null, 7, 'F') as t(o_orderkey, o_custkey, o_orderstatus)").selectExpr(
        "cast(o_orderkey as long) o_orderkey", "cast(o_custkey as long) o_custkey", "o_orderstatus", "1D o_totalprice", "timestamp_ntz'1997-03-01 00:00:00' o_orderdate", "'5-LOW' o_orderpriority"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("select * from values (1, 3), (1, 4), (2, null), (null, 3) as t(p_partkey, p_size)").selectExpr(
        "cast(p_partkey as long) p_partkey", "'n' p_name", "'Brand#1' p_brand", "'t' p_type", "cast(p_size as int) p_size", "1D p_retailprice"
    ).write.parquet(f"{tmp_path}/part.parquet")
    spark.sql("select * from values (7, 'Ana'), (8, 'Eva'), (9, 'Eva'), (null, 'Ida') as t(c_custkey, c_name)").selectExpr(
        "cast(c_custkey as long) c_custkey", "c_name", "1 c_nationkey", "1D c_acctbal", "'m' c_mktsegment"
    ).write.parquet(f"{tmp_path}/customer.parquet")
    spark.sql("select 1L s_suppkey, 'n' s_name, 1 s_nationkey, 1D s_acctbal").write.parquet(f"{tmp_path}/supplier.parquet")
    return str(tmp_path)


def test_stored_lines_give_the_same_views(spark, odd):
    stored = views.lined(spark, odd)
    for name in ("stock", "dispatches", "order_lines_out", "received_rows", "shipped_rows"):
        plain, over = (views.view(spark, d, name) for d in (odd, stored))
        assert over.columns == plain.columns and sorted(map(repr, over.collect())) == sorted(map(repr, plain.collect())), name
    assert views.view(spark, odd, "stock").count() == 13
    assert "Join" not in views.view(spark, stored, "stock")._jdf.queryExecution().optimizedPlan().toString()


def test_a_report_query_reads_no_files_of_another(spark, odd):
    first = queries.QUERIES["stored_report_dispatches"](spark, odd).collect()
    clear_shared(spark)
    again = queries.QUERIES["stored_report_dispatches"](spark, odd).collect()
    assert first and sorted(map(repr, first)) == sorted(map(repr, again))


def test_days_of_levels_are_stored_once(spark, odd, monkeypatch):
    stored, real = [], queries.share
    monkeypatch.setattr(queries, "share", lambda df, name: stored.append(name) or real(df, name))
    plan = queries.QUERIES["level_from_months"](spark, odd)._jdf.queryExecution().optimizedPlan().toString()
    assert stored == ["client-days"] and "l_orderkey" not in plan


def test_extracts_are_written_packed(spark, odd, monkeypatch):
    written, real = [], queries.load_tables
    monkeypatch.setattr(queries, "load_tables", lambda s, base, **kw: written.append(base) or real(s, base, **kw))
    queries.QUERIES["loaded_and_prepared"](spark, odd)
    files = spark.read.format("binaryFile").load(f"{written[0]}/*.csv").select("path").collect()
    assert files and all(f.path.endswith(".csv.gz") for f in files)


def test_pallet_modes_store_no_rows_on_hand(spark, odd, monkeypatch):
    stored, real = [], queries.share
    monkeypatch.setattr(queries, "share", lambda df, name: stored.append((name, df.columns)) or real(df, name))
    queries.QUERIES["report_daily_level"](spark, odd)
    assert {name for name, _ in stored} == {"receipts", "received", "dispatched", "pallet-modes"} and len(stored) == 4
    assert dict(stored)["received"] == flows.RECEIVED
