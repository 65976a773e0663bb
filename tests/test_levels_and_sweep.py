"""Month levels, level at a date, sweep line and roll-ups against plain loops; plans that split a hot key."""

import datetime as dt
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stowage.operators import levels, sweep
from stowage.operators.lookup import attach_totals, expand, fill_from_unique
from stowage.operators.totals import roll_ups
from stowage.plans import billing, screening

FIRST = dt.date(2023, 1, 1)


def looped(days, opening):
    """{(key, date): level} and {(key, month): (opening, closing)} by the row loop."""
    at, months = {}, {}
    for key in {k for k, _, _ in days}:
        level = opening.get(key, Decimal(0))
        for _, day, net in sorted(d for d in days if d[0] == key):
            month = day.replace(day=1)
            months.setdefault((key, month), [level, None])
            level = max(Decimal(0), level + net)
            at[key, day] = months[key, month][1] = level
    return at, {k: tuple(v) for k, v in months.items()}


def random_days(seed, keys=3, n=260):
    rng = random.Random(seed)
    days = {(f"k{rng.randrange(keys)}", FIRST + dt.timedelta(rng.randrange(400))) for _ in range(n)}
    return [(k, d, Decimal(rng.randint(-900, 700)) / 4) for k, d in days]


@pytest.mark.parametrize("seed", range(4))
def test_months_compose_to_the_loop(spark, seed):
    rows = random_days(seed)
    opening = {"k0": Decimal(50), "k1": Decimal("0.5")}
    days = spark.createDataFrame(rows, "key string, date date, net decimal(18,4)")
    start = spark.createDataFrame(list(opening.items()), "key string, opening decimal(18,4)")
    at, months = looped(rows, opening)
    states = levels.month_states(levels.month_functions(days, "date", "net", ["key"]), ["key"], start)
    assert {(r.key, r.month): (r.opening, r.closing) for r in states.collect()} == months
    assert {(r.key, r.date): r.level for r in levels.levels_in_months(days, states, "date", "net", ["key"]).collect()} == at

    since = FIRST + dt.timedelta(150)
    old = [d for d in rows if d[1] < since or d[0] == "k2"]  # bookings of the others come late
    before = spark.createDataFrame(old, days.schema)
    stored = levels.month_states(levels.month_functions(before, "date", "net", ["key"]), ["key"], start)
    late = days.filter(F.col("date") >= since.replace(day=1))
    mended = levels.rebooked(stored, late, since, "date", "net", ["key"], start)
    assert {(r.key, r.month): (r.opening, r.closing) for r in mended.collect()} == months


def test_months_without_keys_and_without_days(spark):
    rows = [("k", d, n) for _, d, n in random_days(9, 1)]
    days = spark.createDataFrame(rows, "key string, date date, net decimal(18,4)").drop("key")
    _, months = looped(rows, {})
    functions = levels.month_functions(days, "date", "net")
    states = levels.month_states(functions)
    want = {m: v for (_, m), v in months.items()}
    assert {r.month: (r.opening, r.closing) for r in states.collect()} == want
    since = FIRST + dt.timedelta(200)
    mended = levels.rebooked(states, days.filter(F.col("date") >= since.replace(day=1)), since, "date", "net")
    assert {r.month: (r.opening, r.closing) for r in mended.collect()} == want
    assert levels.month_states(levels.month_functions(days.limit(0), "date", "net")).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_level_at_any_date(spark, seed):
    rng = random.Random(seed)
    held, asked = [], []
    for key in ("a", "b", "c"):
        days = sorted(rng.sample(range(500), 12))
        for k, day in enumerate(days):
            until = FIRST + dt.timedelta(days[k + 1] - 1) if k + 1 < len(days) else None
            held.append((key, FIRST + dt.timedelta(day), until, Decimal(rng.randint(0, 99))))
    for n in range(120):
        asked.append((n, rng.choice(["a", "b", "c", "never", None]), FIRST + dt.timedelta(rng.randint(-40, 700)) if n % 9 else None))
    df = spark.createDataFrame(held, "key string, date date, valid_until date, level decimal(18,4)")
    requests = spark.createDataFrame(asked, "n int, key string, day date")
    opening = spark.createDataFrame([("a", Decimal(7))], "key string, opening decimal(18,4)")
    got = {r.n: r.level for r in levels.level_at(df, requests, "key", "day", "level", opening).collect()}
    for n, key, day in asked:
        known = [lv for k, lo, hi, lv in held if day and k == key and lo <= day and (hi is None or day <= hi)]
        want = None if key is None or day is None else known[0] if known else Decimal(7 if key == "a" else 0)
        assert got[n] == want, (key, day)
    assert len(got) == len(asked) and levels.level_at(df, requests.limit(0), "key", "day", "level").count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_sweep_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    base = dt.datetime(2024, 1, 1, 8)
    rows = []
    for n in range(90):
        start = base + dt.timedelta(seconds=rng.randrange(0, 7200, 60))
        length = rng.choice([0, -60, 60, 600, 3600, 1])
        rows.append((n, rng.choice(["x", "y", None]), start if n % 17 else None, start + dt.timedelta(seconds=length)))
    df = spark.createDataFrame(rows, "n int, key string, start timestamp, end timestamp")
    runs = [r for r in rows if r[1] and r[2] and r[2] < r[3]]

    def count(key, t):
        return sum(1 for r in runs if r[1] == key and r[2] <= t < r[3])

    for r in sweep.concurrency(df, ["key"], "start", "end").collect():
        assert count(r.key, r.from_time) == r.running == count(r.key, r.to_time - dt.timedelta(seconds=1)) and r.running > 0
    seconds = {r.n: r.overlapped_seconds for r in sweep.time_overlapped(df, ["key"], "start", "end").collect()}
    assert len(seconds) == len(rows)
    for n, key, start, end in rows:
        shared = 0
        if any(r[0] == n for r in runs):
            shared = sum(count(key, start + dt.timedelta(seconds=s)) > 1 for s in range(int((end - start).total_seconds())))
        assert seconds[n] == shared
    instants = sorted({t for r in runs for t in r[2:]})
    for r in sweep.peaks(df, ["key"], "start", "end").collect():
        heads = {t: count(r.key, t) for t in instants}
        assert r.peak == max(heads.values()) and r.peak_from == min(t for t, h in heads.items() if h == r.peak)
        lengths = sum((x[3] - x[2]).total_seconds() for x in runs if x[1] == r.key)
        assert abs(r.task_hours * 3600 - lengths) < 1e-6


def test_roll_ups_equal_separate_aggregates(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.choice(["x", "y", None]), rng.choice([1, 2, None]), rng.randint(0, 9)) for _ in range(300)]
    df = spark.createDataFrame(rows, "a string, b string, c int, v int")
    sets = {"ab": ["a", "b"], "c": ["c"], "a": ["a"], "all": []}
    got = roll_ups(df, sets, F.sum("v").alias("v"), F.count("*").alias("n")).collect()
    for label, keys in sets.items():
        want: dict = defaultdict(lambda: [0, 0])
        for a, b, c, v in rows:
            own = tuple({"a": a, "b": b, "c": c}[k] for k in keys)
            if None not in own:
                want[own][0] += v
                want[own][1] += 1
        assert Counter((tuple(r[k] for k in keys), r.v, r.n) for r in got if r.rolled_by == label) == Counter((k, *v) for k, v in want.items())


# ---- hot keys ----

HOT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def hot(spark, key):
    """20,000 rows, nine in ten of them of one key."""
    n = spark.range(0, 20_000, 1, 8)
    return n.select(F.when(F.col("id") % 10 < 9, "0000000007").otherwise(F.concat(F.lit("1"), F.lpad((F.col("id") % 500).cast("string"), 9, "0"))).alias(key), "id")


def few(spark, key, **columns):
    keys = spark.range(500).select(F.concat(F.lit("1"), F.lpad(F.col("id").cast("string"), 9, "0")).alias(key)).union(spark.sql("select '0000000007'"))
    return keys.select(key, *[c.alias(n) for n, c in columns.items()])


def case(spark, name):
    day = F.lit("2024-01-01").cast("timestamp")
    text = lambda x: F.lit(x)
    if name == "pallet_mode":
        facts = few(spark, "idmodelo", idubica1=text("TA1"))
        return hot(spark, "idmodelo").join(billing.pallet_mode(facts), "idmodelo", "left")
    if name == "mode_with_override":
        fills = billing.mode_with_override(few(spark, "idmodelo", mode_count=F.lit(3)), few(spark, "idmodelo", mode_count=text("4")))
        return hot(spark, "idmodelo").join(fills, "idmodelo", "left")
    if name == "receipt_descriptions":
        described = billing.receipt_descriptions(few(spark, "idingreso", descrip=text("d"), fecha=day))
        return hot(spark, "receipt").join(described, "receipt", "left")
    if name == "first_line_place":
        lines = few(spark, "idingreso", numero=text("1"), itemline=text("2"), idubica=text("A1"), bodega=text("BODA"))
        return screening.placed_dispatches(hot(spark, "idingreso"), lines)
    if name == "one_per_receipt":
        receipts = few(spark, "idingreso", **{c: text("1") for c in screening.RECEIPT_FIELDS})
        return expand(screening.one_per_receipt(receipts), hot(spark, "idingreso"), "idingreso")
    if name == "placed_headers":
        placed = few(spark, "trannum", fecha=day, idingreso=text("1"), itemno=text("1"), idubica=text("A"), bodega=text("B"))
        return screening.placed_headers(hot(spark, "trannum"), placed)
    if name == "unique_values":
        rows = hot(spark, "client").withColumn("bodega", F.when(F.col("id") % 7 > 0, "unknown").otherwise("BODA"))
        return fill_from_unique(rows, "client", "bodega", "unknown")
    return attach_totals(hot(spark, "key"), ["key"], n=F.count("*"))


@pytest.mark.parametrize("name", [
    "pallet_mode", "mode_with_override", "receipt_descriptions", "first_line_place", "one_per_receipt", "placed_headers", "unique_values", "attach_totals",
])
def test_hot_key_is_split(spark, name):
    old = {k: spark.conf.get(k, None) for k in HOT}
    for k, v in HOT.items():
        spark.conf.set(k, v)
    try:
        df = case(spark, name)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan, plan
