import datetime as dt
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stowage.functions.dates import coerce_dates
from stowage.operators import first, focus, intervals, lookup, series, totals
from stowage.plans.quality import fill_counts, handle_unknown_warehouse

DAY = dt.date(2024, 1, 1)


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_latest_per_key_is_independent_of_order(spark):
    data = [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", None, "q"), ("b", 0, "p"), (None, 5, "n"), (None, 4, "m")]
    want = [("a", 3, "z"), ("b", 0, "p"), (None, 5, "n")]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, d int, v string").repartition(3)
        assert rows(first.latest_per_key(df, ["k"], "d")) == want


def test_rank_filter_is_limited_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    plan = first.latest_per_key(df, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_items_without_key_collapse_to_one(spark):
    data = [("r1", "1", 1), ("r1", None, 2), ("r2", None, 3), (None, "1", 4), ("r1", "1", 5)]
    df = spark.createDataFrame(data, "r string, i string, d int")
    assert rows(first.latest_per_item(df, "r", "i", "d", collapse_unmatched=True)) == [("r1", "1", 5), (None, "1", 4)]


def test_items_without_key_stay_by_default(spark):
    df = spark.createDataFrame([("r1", "1", 5), ("r1", "1", 3), (None, "1", 4), (None, "1", 2), ("r2", None, 1)], "r string, i string, d int")
    found = sorted(map(str, rows(first.latest_per_item(df, "r", "i", "d"))))
    assert found == sorted(map(str, [("r1", "1", 5), (None, "1", 4), (None, "1", 2), ("r2", None, 1)]))


def test_equal_items_without_key_all_stay_in_one_read(spark, tmp_path):
    data = [(None, "1", 4)] * 3 + [("r2", None, 1)] * 2 + [(None, None, None)] * 2 + [("r1", "1", 5), ("r1", "1", 5)]
    spark.createDataFrame(data, "r string, i string, d int").write.parquet(str(tmp_path / "items"))
    found = first.latest_per_item(spark.read.parquet(str(tmp_path / "items")), "r", "i", "d")
    assert sorted(map(str, rows(found))) == sorted(map(str, data[:-1]))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_hot_keys_can_be_split(spark):
    """Joins whose one side is an aggregate have shuffles of their own, which is what AQE needs to split them."""
    df = spark.range(2000).selectExpr("if(id % 10 = 0, cast(id as string), 'hot') as k", "id as v", "'x' as w")
    with_totals = lookup.attach_totals(df, ["k"], n=F.sum("v"))
    plan = with_totals.join(spark.range(1).selectExpr("1 as one"), F.lit(True))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(k") >= 2 or "BroadcastExchange" in plan
    filled = lookup.fill_from_unique(df.withColumn("w", F.when(F.col("v") % 7 == 0, "?").otherwise("x")), "k", "w", "?")
    assert filled.count() == 2000


def test_seven_digit_keys_are_not_cut(spark):
    from catalog.views import client_id

    got = spark.range(1234567, 1234569).selectExpr(f"{client_id('id')} as c").collect()
    assert [r.c for r in got] == ["1234567_c", "1234568_e"]


def test_newest_and_oldest_skip_nulls(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 3, None), ("k", 2, "b"), ("k", 2, "c"), ("k", None, "z")], "k string, d int, v string")
    got = df.groupBy("k").agg(first.newest("v", "d").alias("n"), first.oldest("v", "d").alias("o")).first()
    assert (got.n, got.o) == ("c", "z")


def test_fill_from_unique(spark):
    data = [("a", "X"), ("a", "?"), ("b", "X"), ("b", "Y"), ("b", "?"), ("c", "?"), ("d", "X"), ("d", None), ("d", "?"), (None, "?"), (None, "X")]
    df = spark.createDataFrame(data, "k string, v string")
    want = sorted([("X" if r == ("a", "?") else r[1]) or "none" for r in data])
    for fill in (lookup.fill_from_unique, lookup.fill_within_key):
        assert sorted((r.v or "none") for r in fill(df, "k", "v", "?").collect()) == want


def test_unknown_rows_are_reported(spark):
    data = [("a", "BODA"), ("a", "DESCONOCIDO"), ("b", "DESCONOCIDO")]
    df = spark.createDataFrame(data, "idcontacto string, bodega string")
    got = handle_unknown_warehouse(df)
    assert rows(got.eligible) == [("a", "DESCONOCIDO")] and rows(got.replaced) == [("a", "BODA")]
    assert rows(got.remaining) == [("b", "DESCONOCIDO")] and got.filled.count() == 3
    assert rows(fill_counts(df)) == [(1, 1)]


def test_attach_totals_leaves_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    got = lookup.attach_totals(df, ["k"], n=F.count("*"), s=F.sum("v"))
    assert rows(got.select("v", "n", "s")) == [(1, 2, 3), (2, 2, 3), (3, None, None)]


def test_expand_is_a_left_join(spark):
    heads = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, h int")
    items = spark.createDataFrame([("a", "x"), ("a", "y"), ("c", "z"), (None, "n")], "k string, i string")
    assert rows(lookup.expand(heads, items, "k")) == rows(heads.join(items, "k", "left"))


def test_key_probes(spark):
    a = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "k string")
    b = spark.createDataFrame([("2",), ("2",)], "k string")
    assert rows(lookup.missing_keys(a, b, "k")) == [("1",), (None,)]
    assert rows(lookup.present_keys(a, b, "k")) == [("2",), ("2",)]
    assert rows(lookup.repeated_keys(a, "k")) == [("2", 2)]


def test_clamped_level_by_hand(spark):
    df = spark.createDataFrame([(1, 5), (2, -8), (3, 2)], "d int, net int")
    assert [r.level for r in series.clamped_level(df, "d", F.col("net")).orderBy("d").collect()] == [5, 0, 2]


def test_clamped_level_equals_the_loop(spark):
    rng = random.Random(7)
    data, want = [], {}
    for key in range(60):
        opening = level = rng.choice([0, 3, 25])
        for day in range(rng.randint(1, 40)):
            net = rng.randint(-12, 12)
            level = max(0, level + net)
            data.append((key, day, net, opening))
            want[key, day] = level
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k int, d int, net int, open int")
    got = series.clamped_level(df, "d", F.col("net"), F.col("open"), ["k"]).collect()
    assert {(r.k, r.d): r.level for r in got} == want


def test_resample_keeps_empty_months(spark):
    data = [(dt.date(2024, 1, 5), 1, 10), (dt.date(2024, 1, 9), 2, 20), (dt.date(2024, 4, 1), 4, 40)]
    got = series.resample_months(spark.createDataFrame(data, "d date, q int, l int"), "d", ["q"], ["l"])
    assert rows(got) == [
        (dt.date(2024, 1, 31), 3, 20), (dt.date(2024, 2, 29), 0, None), (dt.date(2024, 3, 31), 0, None),
        (dt.date(2024, 4, 30), 4, 40),
    ]
    empty = spark.createDataFrame([], "d date, q int, l int")
    assert series.resample_months(empty, "d", ["q"], ["l"]).count() == 0


def test_calendar(spark):
    bounds = spark.createDataFrame([(DAY, dt.date(2024, 3, 1))], "lo date, hi date")
    days = rows(series.days_between(bounds, "lo", "hi"))
    assert len(days) == 61 and days[0] == (DAY,) and days[-1] == (dt.date(2024, 3, 1),)


def test_change_within_key_equals_lag(spark):
    rng = random.Random(3)
    data = [
        (k, DAY + dt.timedelta(d), f"r{r}", float(rng.choice([0, 1, 2, 4])))
        for k in ("a", "b") for d in range(12) for r in range(rng.randint(0, 3))
    ]
    df = spark.createDataFrame(data, "k string, d date, r string, v double")
    want, last = {}, {}
    for k, d, r, v in sorted(data):
        before = last.get(k)
        want[k, d, r] = None if not before else (v / before - 1) * 100
        last[k] = v
    got = series.change_within_key(df, "v", "k", "d", "r").collect()
    assert {(r.k, r.d, r.r): r.change_pct for r in got} == want


def test_shares(spark):
    df = spark.createDataFrame([("a", 1, 10), ("b", 3, 10)], "k string, x int, y int")
    assert rows(totals.shares(df, ["x", "y"])) == [("a", 1, 10, 25.0, 50.0), ("b", 3, 10, 75.0, 50.0)]


def test_widest(spark):
    a, b = spark.createDataFrame([("1234",), (None,)], "k string"), spark.createDataFrame([("12",)], "k string")
    assert b.select(totals.widest((a, "k"), (b, "k"))).first()[0] == 4


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def tasks(spark, data):
    return spark.createDataFrame([(w, DAY, at(a), at(b)) for w, a, b in data], "w string, d date, s timestamp, e timestamp")


def test_touching_tasks_are_separate_islands(spark):
    df = tasks(spark, [("x", 480, 600), ("x", 540, 660), ("x", 660, 720)])
    got = intervals.islands(df, ["w", "d"], "s", "e").select("island_start", "island_end").distinct()
    assert rows(got) == sorted([(at(480), at(660)), (at(660), at(720))], key=str)
    assert intervals.islands(df, ["w", "d"], "s", "e", touching=True).select("island").distinct().count() == 1
    assert intervals.union_length(df, ["w", "d"], "s", "e").first().covered_hours == 4.0


def test_islands_equal_brute_force(spark):
    rng = random.Random(11)
    data = []
    for worker in range(80):
        for _ in range(rng.randint(1, 9)):
            start = rng.randint(0, 60)
            data.append((f"w{worker}", start, start + rng.randint(1, 15)))
    got = intervals.islands(tasks(spark, data), ["w", "d"], "s", "e").select("w", "island_start", "island_end", "tasks").distinct()
    by_worker = defaultdict(list)
    for w, a, b in data:
        by_worker[w].append((a, b))
    want = []
    for w, spans in by_worker.items():
        # Brute force: two tasks belong together when a chain of overlaps links them.
        groups = [{k} for k in range(len(spans))]
        for x in range(len(spans)):
            for y in range(x):
                if min(spans[x][1], spans[y][1]) > max(spans[x][0], spans[y][0]):
                    gx, gy = (next(g for g in groups if k in g) for k in (x, y))
                    if gx is not gy:
                        groups.remove(gy)
                        gx |= gy
        want += [(w, at(min(spans[k][0] for k in g)), at(max(spans[k][1] for k in g)), len(g)) for g in groups]
    assert rows(got) == sorted(want, key=str)


def test_overlap_groups_name_double_hours(spark):
    df = tasks(spark, [("x", 0, 120), ("x", 60, 180), ("x", 300, 360)])
    assert [(r.tasks, r.double_hours) for r in intervals.overlap_groups(df, ["w", "d"], "s", "e").collect()] == [(2, 1.0)]


def test_focus(spark):
    a = spark.createDataFrame([(" 7 ", "8"), ("9", "7"), ("9", None)], "idcontacto string, idcontacto1 string")
    b = spark.createDataFrame([("x",)], "other string")
    kept, untouched = focus.focus_client([a, b], "7")
    assert kept.count() == 2 and untouched is b
    c = spark.createDataFrame([("BODA", "B1"), ("BODC", "BODA"), (None, None)], "bodega string, idbodega string")
    assert focus.focus_warehouse([c], "BODA")[0].count() == 2
    assert focus.focus_warehouse([c], None) == [c]
    assert focus.filter_exact([c], "bodega", "BODA")[0].count() == 1
    with pytest.raises(ValueError):
        focus.focus_warehouse([c], "BODX")


def test_exclude_keeps_null(spark):
    df = spark.createDataFrame([("5",), ("1",), (None,)], "s string")
    assert rows(focus.exclude(df, "s", ["5", "9"])) == [("1",), (None,)]
    assert rows(focus.list_entities(spark.createDataFrame([("1", "a"), ("1", "a")], "idcontacto string, descrip string"))) == [("1", "a")]


@pytest.fixture
def shuffled_joins(spark):
    """Joins by shuffle; gives how many shuffles a plan ran, each that was read again counted once."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for n in names:
        spark.conf.set(n, "-1")

    def ran(df):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan[: plan.index("== Initial Plan ==")]
        return len(re.findall(r"(?<!Reused)Exchange hashpartitioning", final)), plan

    yield ran
    for n in names:
        spark.conf.unset(n)


def test_expand_shuffles_the_heads_once(spark, shuffled_joins, tmp_path):
    """Also where a date that is one already is made one once more."""
    spark.sql("select * from values ('1', 1), ('2', 2), (null, 3) as t(k, n)").selectExpr("k", "n", "timestamp'2024-01-01 00:00:00' d").write.parquet(f"{tmp_path}/heads")
    items = spark.createDataFrame([("1", i) for i in range(5)] + [(None, 9)], "k string, i int")
    heads = first.latest_per_key(coerce_dates(spark.read.parquet(f"{tmp_path}/heads"), "d"), ["k"], "d")
    df = lookup.expand(heads, items, "k")
    assert sorted((r.k or "", r.n, r.i or 0) for r in df.collect()) == [("", 3, 0), *[("1", 1, i) for i in range(5)], ("2", 2, 0)]
    n, plan = shuffled_joins(df)
    assert n <= 6 and "ReusedExchange" in plan, plan  # heads by hash and by key, unkeyed heads, items, keys


def test_a_join_of_tables_dealt_by_one_hash_needs_no_shuffle(spark, shuffled_joins):
    df = spark.range(100).selectExpr("cast(id % 7 as string) k", "id")
    newest = first.latest_per_key(df, ["k"], "id", apart="_apart")
    n, plan = shuffled_joins(newest.join(lookup.grouped_apart(df, ["k"], F.count("*").alias("rows"), apart="_apart"), ["_apart", "k"]))
    assert n == 2, plan
