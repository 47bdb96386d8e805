import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparklake.functions import periods
from sparklake.functions.encoding import utf8_or_latin1, utf8_or_latin1_name
from sparklake.functions.scalars import (
    clean_text,
    frequency_label,
    money_lenient,
    money_strict,
    ratio_or_zero,
    to_double,
    to_int,
    to_long,
)

JAN = dt.date(2024, 1, 1)


def apply(spark, fn, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


def test_trim_strips_every_white_space(spark):
    values = ["\t Santiago \n", "  a b ", "", "   ", None, " Bogotá ", "Bogotá", "ñandú "]
    assert apply(spark, clean_text, values) == ["Santiago", "a b", "", "", None, "Bogotá", "Bogotá", "ñandú"]


def test_to_double(spark):
    values = ["abc", "", None, " 12 ", "1e5", "1.5d", "2f", "-.5", "3.", "+7", "1-2", "0x10"]
    assert apply(spark, to_double, values) == [None, None, None, 12.0, 1e5, None, None, -0.5, 3.0, 7.0, None, None]


def test_to_double_keeps_infinity(spark):
    assert apply(spark, to_double, ["inf", "-Infinity"]) == [float("inf"), float("-inf")]


def test_integers(spark):
    values = ["7", "1.0", "x", None, " -3 ", "99999999999999999999"]
    assert apply(spark, to_long, values) == [7, None, None, None, -3, None]
    assert apply(spark, to_int, ["7", "3000000000", "1.5"]) == [7, None, None]


def test_money_strict(spark):
    assert apply(spark, money_strict, ["$1,234.50", None, "N/A", "", "(12)"]) == [1234.5, None, None, None, None]


def test_money_lenient_loses_signs_in_parentheses_and_exponents(spark):
    values = ["RD$1,234.50", None, "", "(12)", "1-2", "1e5", "-3.5", "N/A", "1.2.3"]
    assert apply(spark, money_lenient, values) == [1234.5, 0.0, None, 12.0, None, 15.0, -3.5, None, None]


@pytest.mark.parametrize(
    ("formats", "value", "expected"),
    [
        (periods.ONE_FORMAT, "2024-01", JAN),
        (periods.ONE_FORMAT, "2024-1", JAN),
        (periods.ONE_FORMAT, " 2024-01 ", JAN),
        (periods.ONE_FORMAT, "2024-13", None),
        (periods.ONE_FORMAT, "2024/01", None),
        (periods.ONE_FORMAT, "2024-01-15", None),
        (periods.ONE_FORMAT, None, None),
        (periods.THREE_FORMATS, "2024/01", JAN),
        (periods.THREE_FORMATS, "01/2024", JAN),
        (periods.THREE_FORMATS, "202401", None),
        (periods.FOUR_FORMATS, "202401", JAN),
        (periods.FOUR_FORMATS, "", None),
        (periods.FOUR_FORMATS, "20240115", None),
        (periods.MACRO_FORMATS, "2024-01-15", dt.date(2024, 1, 15)),
        (periods.MACRO_FORMATS, "2024-01", JAN),
    ],
)
def test_parse_period(spark, formats, value, expected):
    assert apply(spark, lambda c: periods.parse_period(clean_text(c), formats), [value]) == [expected]


def test_ratio_or_zero(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, -1.0), (5.0, None), (5.0, 10.0)], "n double, d double")
    got = [r[0] for r in df.select(ratio_or_zero(F.col("n"), F.col("d"))).collect()]
    assert got == [0.0, 0.0, 0.0, 0.5]


def test_frequency_label(spark):
    assert apply(spark, frequency_label, ["A", "M", "Q", "W", None]) == [
        "Anual", "Mensual", "Trimestral", "Desconocido", "Desconocido",
    ]


def test_epoch_text(spark):
    got = apply(spark, lambda c: periods.epoch_ms_text(c, "yyyy-MM-dd"), ["1704067200000", "x", None])
    assert got == ["2024-01-01", None, None]


def test_encoding_repair(spark):
    misread = ["créditos".encode().decode("latin-1"), "créditos", "plain", None, ""]
    assert apply(spark, utf8_or_latin1, misread) == ["créditos", "créditos", "plain", None, ""]
    assert utf8_or_latin1_name("País".encode("utf-8-sig").decode("latin-1")) == "País"
    assert utf8_or_latin1_name("País") == "País"


def test_calendar_frames(spark):
    months = [r[0] for r in periods.month_range(spark, 2023, dt.date(2024, 2, 20)).collect()]
    assert months[0] == dt.date(2023, 1, 1) and months[-1] == dt.date(2024, 2, 1) and len(months) == 14
    bounds = spark.createDataFrame([(dt.date(2024, 1, 31),)], "last date")
    back = sorted(r[0] for r in periods.lookback_months(bounds, 3).collect())
    assert back == [dt.date(2023, 11, 1), dt.date(2023, 12, 1), JAN]


def test_coverage_gaps(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 9)), ("a", dt.date(2024, 4, 2)), ("b", JAN)], "k string, d date")
    gaps = sorted((r.k, r.periodo_date) for r in periods.coverage_gaps(df, "d", ["k"]).collect())
    assert gaps == [("a", dt.date(2024, 2, 1)), ("a", dt.date(2024, 3, 1))]


def test_select_periods(spark):
    df = spark.createDataFrame([(dt.date(2024, m, 5),) for m in range(1, 7)], "periodo_date date")
    bounds = spark.createDataFrame([(dt.date(2024, 6, 30),)], "last date")
    months = periods.lookback_months(bounds, 2)
    assert sorted(r[0].month for r in periods.select_periods(df, months).collect()) == [5, 6]
    assert [r[0].month for r in periods.select_periods(df, months, ["2024-02"]).collect()] == [2]
