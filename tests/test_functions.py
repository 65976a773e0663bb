import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stowage.functions import dates, numbers, text


def one(spark, schema, rows, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def texts(spark, values, column):
    return one(spark, "c string", [(v,) for v in values], column)


def test_site_tag_keeps_null(spark):
    assert texts(spark, ["7", None], text.tag_site(F.col("c"), "_c")) == ["7_c", None]


def test_receipt_is_first_ten_characters(spark):
    assert texts(spark, ["0000000012003", "12", None], text.receipt_of(F.col("c"))) == ["0000000012", "12", None]


def test_zero_pad_never_cuts(spark):
    assert texts(spark, ["7", "123456", None], text.zero_pad(F.col("c"), 4)) == ["0007", "123456", None]


def test_number_order(spark):
    values = ["10", "2", "B1", None, "2_c", "007", "A9", "9" * 45]
    rows = spark.createDataFrame([(v,) for v in values], "c string").orderBy(text.number_order(F.col("c"))).collect()
    assert [r.c for r in rows] == ["2", "2_c", "007", "10", None, "9" * 45, "A9", "B1"]


def test_ten_digit_receipt(spark):
    values = ["12", "000000000000012", "AB1 ", "12_c", None]
    assert texts(spark, values, text.ten_digit_receipt(F.col("c"))) == [
        "0000000012", "0000000012", "0000000AB1", "00000012_c", None,
    ]


def test_blank_to_default(spark):
    assert texts(spark, [None, "", "  ", " A"], text.blank_to(F.col("c"), "X")) == ["X", "X", "X", " A"]


def test_na_text_is_null(spark):
    assert texts(spark, ["NA", "null", "", "0", "nana"], text.na_to_null("c")) == [None, None, None, "0", "nana"]


def test_pallet_tag(spark):
    assert texts(spark, ["TA1", "R1", "TM1", "", None], text.pallet_tag(F.col("c"))) == ["TA1", None, None, None, None]


def test_surrogate_tag_is_repeatable_and_distinct(spark):
    rows = [("R1", "a"), ("R1", "b"), ("TA3", "c")]
    column = text.pallet_tag_or_own(F.col("c"), F.col("k"))
    first = one(spark, "c string, k string", rows, column)
    assert first == one(spark, "c string, k string", rows, column)
    assert first[2] == "TA3" and first[0] != first[1] and all(t.startswith("U") for t in first[:2])


def test_item_key_and_label(spark):
    rows = [("1", "2"), ("1", None)]
    assert one(spark, "a string, b string", rows, text.item_key(F.col("a"), F.col("b"))) == ["12", None]
    assert one(spark, "a string, b string", rows, text.na_label(F.col("b"))) == ["2", "N/A"]


def test_measure_coerces(spark):
    values = [" 12.5 ", "x", "nan", "", None, "1e3"]
    assert texts(spark, values, numbers.measure(F.col("c"))) == [Decimal("12.5"), None, None, None, None, Decimal(1000)]
    assert texts(spark, values, numbers.as_double(F.col("c"))) == [12.5, None, None, None, None, 1000.0]


def test_round2_halves_to_even(spark):
    rows = [(0.125,), (0.375,), (-6.654999999999999,), (2.5,)]
    assert one(spark, "c double", rows, numbers.round2(F.col("c"))) == [0.12, 0.38, -6.65, 2.5]


def test_ratios_never_raise(spark):
    rows = [(6.0, 3.0), (1.0, 0.0), (None, 1.0)]
    assert one(spark, "a double, b double", rows, numbers.ratio(F.col("a"), F.col("b"))) == [2.0, None, None]
    assert one(spark, "a double, b double", rows, numbers.change_percent(F.col("a"), F.col("b"))) == [100.0, None, None]


def test_clip_near_zero_only_touches_numbers(spark):
    df = spark.createDataFrame([("a", 1e-7, 2), ("b", -0.5, 0)], "k string, x double, n int")
    assert [tuple(r) for r in numbers.clip_near_zero(df).collect()] == [("a", 0.0, 2), ("b", -0.5, 0)]


def test_pallets(spark):
    assert one(spark, "n long, m int", [(5, 2), (4, 2), (1, 3)], numbers.pallets_for(F.col("n"), F.col("m"))) == [3, 2, 1]


@pytest.mark.parametrize(
    "modified, received, measures, expected",
    [
        ("2024-03-01", "2024-02-01", (0, 0, 0), 9), ("2024-02-01", "2024-02-09", (0, 0, 0), 9),
        ("2024-01-01", "2023-02-01", (0, 0, 0), None), ("2024-03-01", "2024-02-01", (0, 1, 0), None),
        ("2024-03-01", "2024-02-01", (0, None, 0), None), (None, "2024-02-01", (0, 0, 0), None),
    ],
)
def test_detached_later(spark, modified, received, measures, expected):
    column = numbers.detached_later(F.to_date("m"), F.to_date("r"), [F.col("a"), F.col("b"), F.col("c")], F.lit(9))
    assert one(spark, "m string, r string, a int, b int, c int", [(modified, received, *measures)], column) == [expected]


def test_day_first_dates(spark):
    values = ["5-3-2024", "05/03/24", "31/12/1999", "31-12-99", "1/1/68", "32/1/2024", "2024-03-05", None]
    assert texts(spark, values, dates.parse_day_first(F.col("c"))) == [
        dt.date(2024, 3, 5), dt.date(2024, 3, 5), dt.date(1999, 12, 31), dt.date(1999, 12, 31), dt.date(2068, 1, 1),
        None, None, None,
    ]


def test_coerce_dates_by_type(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05", dt.date(2024, 5, 6)), ("bad", None)], "a string, b date")
    rows = dates.coerce_dates(df, "a", "b", "missing").collect()
    assert rows[0].a == dt.datetime(2024, 1, 2, 3, 4, 5) and rows[0].b == dt.datetime(2024, 5, 6)
    assert rows[1].a is None and rows[1].b is None


def test_iso_or_blank_and_month(spark):
    rows = [(dt.date(2024, 2, 9),), (None,)]
    assert one(spark, "d date", rows, dates.iso_or_blank(F.col("d"))) == ["2024-02-09", ""]
    assert one(spark, "d date", rows[:1], dates.month_label(F.col("d"))) == ["2024-02"]
    assert one(spark, "d date", rows[:1], dates.days_in_month(F.col("d"))) == [29]
    assert one(spark, "d date", [(dt.date(2024, 3, 3),), (dt.date(2024, 3, 4),)], dates.is_sunday(F.col("d"))) == [True, False]


def test_day_differences(spark):
    rows = [("2024-01-03 12:00:00", "2024-01-01 00:00:00"), ("2024-01-01 00:00:00", "2024-01-01 12:00:00")]
    a, b = F.col("a").cast("timestamp"), F.col("b").cast("timestamp")
    assert one(spark, "a string, b string", rows, dates.whole_days(a, b)) == [2, -1]
    assert one(spark, "a string, b string", rows, dates.dwell_days(a, b)) == [3, 2]
    assert one(spark, "a string, b string", rows, dates.hours_between(b, a)) == [60.0, -12.0]
    assert one(spark, "d date", [(dt.date(2024, 1, 1),)], dates.age_days("2024-01-31", F.col("d"))) == [30]


def test_time_of_day(spark):
    rows = [(dt.date(2024, 1, 1), "08:30:00"), (dt.date(2024, 1, 1), None), (None, "08:30:00"), (dt.date(2024, 1, 1), "8h")]
    assert one(spark, "d date, t string", rows, dates.at_time(F.col("d"), F.col("t"))) == [
        dt.datetime(2024, 1, 1, 8, 30), None, None, None,
    ]


def test_user_dates():
    assert dates.date_range("01/12/2024", "31-12-24") == (dt.date(2024, 12, 1), dt.date(2024, 12, 31))
    with pytest.raises(ValueError):
        dates.date_range("02/01/2024", "01/01/2024")
    with pytest.raises(ValueError):
        dates.parse_user_date("2024-01-01")
