import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fellwalk.functions import text
from fellwalk.operators import records


def one(spark, column, **values):
    rows = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return rows.select(column).first()[0]


@pytest.mark.parametrize(
    "digits, expected",
    [
        ("DD37Cf93aecA6Dc", 0xDD37CF93AECA6DC), ("0", 0), ("000000000000000000001f", 31), ("7fffffffffffffff", 2**63 - 1),
        ("8000000000000000", None), ("-8000000000000000", -(2**63)), ("-1f", -31), ("+1f", 31),
        ("12zz", None), ("", None), (" 1", None), ("1" * 17, None), ("-", None), ("0x1f", None),
    ],
)
def test_hex_to_long(spark, digits, expected):
    assert one(spark, text.hex_to_long(F.col("s")), s=digits) == expected


@pytest.mark.parametrize(
    "written, expected",
    [("2021-02-03", dt.date(2021, 2, 3)), ("2021-13-01", None), ("2021-2-1", None), ("2021-02-30", None), ("x", None), ("", None)],
)
def test_iso_date(spark, written, expected):
    assert one(spark, text.iso_date(F.col("s")), s=written) == expected


@pytest.mark.parametrize(
    "written, expected",
    [("1, 2,3", [1, 2, 3]), ("x,4.5,-7,+8, 9 ", [-7, 8, 9]), ("", []), ("99999999999,5", [5])],
)
def test_int_list(spark, written, expected):
    assert one(spark, text.int_list(F.col("s")), s=written) == expected


def test_list_text(spark):
    assert one(spark, text.list_text(F.array(F.lit(1), F.lit(2)))) == "[1,2]"
    assert one(spark, text.list_text(F.array().cast("array<int>"))) == "[]"


def period(start, end):
    """Years, months and days by the calendar rule: whole months first, then the days left."""
    months = (end.year - start.year) * 12 + end.month - start.month
    days = end.day - start.day
    if months > 0 and days < 0:
        months -= 1
        year, month = divmod(start.year * 12 + start.month - 1 + months, 12)
        last = [31, 29 if year % 4 == 0 and (year % 100 or year % 400 == 0) else 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31][month]
        days = (end - dt.date(year, month + 1, min(start.day, last))).days
    return months // 12, months % 12, days


def test_calendar_gaps_follow_the_calendar_rule(spark):
    rng = random.Random(5)
    day = lambda: dt.date(2019, 1, 1) + dt.timedelta(days=rng.randint(0, 2000))
    pairs = [tuple(sorted((day(), day()))) for _ in range(400)] + [(dt.date(2021, 1, 31), dt.date(2021, 2, 28))]
    df = spark.createDataFrame(pairs, "a date, b date")
    years, months, days, total = records.calendar_gap(F.col("a"), F.col("b"))
    for a, b, *found in df.select("a", "b", years, months, days, total).collect():
        assert tuple(found[:3]) == period(a, b), (a, b)
        assert found[3] == (b - a).days


@pytest.mark.parametrize(
    "parts, expected",
    [
        ((1, 2, 3, 428), "1 Year, 2 Months, 3 Days (Total: 428 Days)"),
        ((0, 1, 0, 31), "1 Month (Total: 31 Days)"),
        ((0, 0, 1, 1), "1 Day (Total: 1 Day)"),
        ((0, 0, 0, 0), "0 Days (Total: 0 Days)"),
        ((2, 0, 0, 731), "2 Years (Total: 731 Days)"),
    ],
)
def test_period_text(spark, parts, expected):
    assert one(spark, text.period_text(*[F.lit(p) for p in parts])) == expected


@pytest.mark.parametrize("chunk", [1, 3, 100_000])
def test_date_gaps_of_repeated_dates(spark, chunk):
    dates = [dt.date(2020, 1, 1)] * 8 + [dt.date(2020, 1, 3)] + [dt.date(2021, 2, 3)] * 3 + [None]
    df = spark.createDataFrame([(d,) for d in dates], "d date").repartition(3)
    rows = records.date_gaps(df, "d", ordered=True, chunk=chunk).collect()
    assert [r["total_days"] for r in rows] == [0] * 9 + [2, 397]
    assert rows[-1]["text"] == "1 Year, 1 Month (Total: 397 Days)"


def test_date_gaps_need_two_rows(spark):
    assert records.date_gaps(spark.createDataFrame([(dt.date(2020, 1, 1),)], "d date"), "d").count() == 0


def test_rollup_counts_and_order(spark):
    rows = [("A", "x"), ("A", "x"), ("A", "y"), ("B", "z"), ("C", None)]
    found = records.location_rollup(spark.createDataFrame(rows, "country string, city string")).collect()
    assert [(r["path"], r["level"], r["n"]) for r in found] == [
        ("A / y", 2, 1), ("B", 1, 1), ("B / z", 2, 1), ("C", 1, 1), ("C", 2, 1), ("A / x", 2, 2), ("A", 1, 3),
    ]


def test_typed_records_keep_rejects(spark):
    raw = spark.createDataFrame([("1", "ff", "2020-01-01"), ("x", "12zz", "2020-01-01"), ("3", "1", None)], "Index string, Id string, Day string")
    fields = {"idx": ("Index", "int"), "id": ("Id", "hex"), "day": ("Day", "date")}
    typed = records.typed_records(raw, fields)
    assert records.good_records(typed).collect() == [(1, 255, dt.date(2020, 1, 1))]
    assert sorted(r["_failed"] for r in records.rejected_records(typed).collect()) == [["day"], ["idx", "id"]]
    assert records.parse_report(typed).first() == (3, 1, 2)
    absent = records.typed_records(raw, {**fields, "more": ("Absent", "string")})
    assert records.good_records(absent).count() == 0
