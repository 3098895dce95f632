"""FX11 numeric parse, FX12 file period, FX13 headers, money, ratios, calendar."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import (
    calendar_columns,
    code_before_comma,
    guarded_ratio,
    non_integral,
    normalize_header,
    parse_money,
    parse_number,
    period_from_name,
    previous_periods,
    valid_key,
)


def test_fx11_numeric_parse(spark):
    cases = [(" 12 ", 12.0, 12), ("1e3", 1000.0, 1000), ("", None, None), ("12d", None, None),
             ("0x10", None, None), ("12,5", None, None), ("002", 2.0, 2), ("12.0", 12.0, 12),
             ("12.5", 12.5, None), (None, None, None)]
    df = spark.createDataFrame([(c[0],) for c in cases], "s string")
    out = df.select("s", parse_number(F.col("s")).alias("d"),
                    parse_number(F.col("s"), integral=True).alias("i"),
                    parse_number(F.col("s"), decimal_comma=True).alias("dc"),
                    non_integral(F.col("s")).alias("bad")).collect()
    got = {r.s: (r.d, r.i) for r in out}
    for s, d, i in cases:
        assert got[s] == (d, i), s
    comma = {r.s: r.dc for r in out}
    assert comma["12,5"] == 12.5
    assert [r.s for r in out if r.bad] == ["12.5"]


def test_fx12_file_period(spark):
    ok = spark.createDataFrame([("meter_2605.xlsx",), ("/x/2024/meter_2605.xlsx",)], "p string")
    got = ok.select(period_from_name(F.col("p")).alias("x")).select("x.*").collect()
    assert [(r.year, r.month) for r in got] == [(2026, 5), (2026, 5)]
    for bad in ["meter_202605.xlsx", "meter.xlsx", "meter_2613.xlsx"]:
        df = spark.createDataFrame([(bad,)], "p string")
        with pytest.raises(Exception):
            df.select(period_from_name(F.col("p")).alias("x")).collect()
        lenient = df.select(period_from_name(F.col("p"), strict=False).alias("x")).collect()
        assert lenient[0].x.year is None


def test_fx13_headers():
    assert normalize_header("'МВЗ (Код)", " '") == "мвз(код)"
    assert normalize_header("Піч піца") == "пічпіца"
    assert normalize_header("a b") == "ab"


def test_money_parse_strict(spark):
    df = spark.createDataFrame([("1 200.50 UAH",), ("300 UAH",), ("",), (None,), ("7",)], "s string")
    got = [r.v for r in df.select(parse_money(F.col("s")).alias("v")).collect()]
    assert got == [1200.5, 300.0, None, None, 7.0]
    with pytest.raises(PySparkException):
        spark.createDataFrame([("12,5",)], "s string").select(parse_money(F.col("s"))).collect()


def test_guarded_ratio_and_keys(spark):
    df = spark.createDataFrame([(10.0, 2.0), (1.0, 0.0), (1.0, None)], "n double, d double")
    z = [r.v for r in df.select(guarded_ratio(F.col("n"), F.col("d")).alias("v")).collect()]
    n = [r.v for r in df.select(guarded_ratio(F.col("n"), F.col("d"), "null").alias("v")).collect()]
    assert z == [5.0, 0.0, 0.0]
    assert n == [5.0, 0.0, None]
    k = spark.createDataFrame([("M1",), ("-",), (" - ",), ("  ",), (None,)], "k string")
    assert [r.k for r in k.where(valid_key(F.col("k"))).collect()] == ["M1"]


def test_store_code(spark):
    df = spark.createDataFrame([("002, Київ",), ("003, Київ (Оренда)",), ("XYZ",)], "s string")
    got = [r.c for r in df.select(parse_number(code_before_comma(F.col("s")), integral=True)
                                  .alias("c")).collect()]
    assert got == [2, 3, None]


def test_calendar_and_previous_periods(spark):
    df = spark.createDataFrame([(dt.date(2026, 2, 11),)], "d date")
    cal = calendar_columns(F.col("d"))
    r = df.select(*[v.alias(k) for k, v in cal.items()]).first()
    assert (r.first_day, r.last_day, r.weekday_num, r.weekday_name, r.ym) == \
        ("2026-02-01", "2026-02-28", 3, "Wednesday", "202602")
    assert previous_periods(2026, 1) == [(2025, 12), (2025, 11), (2025, 10)]
    assert previous_periods(2026, 5) == [(2026, 4), (2026, 3), (2026, 2)]


def test_period_from_dataset_folder(spark):
    df = spark.createDataFrame([("/x/2024/accounts_2604.parquet/part-00001-1234-ab.snappy.parquet",),
                                ("/x/accounts_2605.csv",)], "p string")
    got = df.select(period_from_name(F.col("p")).alias("x")).select("x.*").collect()
    assert [(r.year, r.month) for r in got] == [(2026, 4), (2026, 5)]


def test_parse_date_layouts(spark):
    from ledgerloom.functions.scalars import parse_date
    df = spark.createDataFrame([("2026-05-31",), ("31.05.2026",), ("31.05.2026 10:15",),
                                ("2026-05-31 23:59:59",), ("junk",), (None,)], "s string")
    got = [r.d for r in df.select(parse_date(F.col("s")).alias("d")).collect()]
    assert [(d.year, d.month, d.day) if d else None for d in got] == [
        (2026, 5, 31), (2026, 5, 31), (2026, 5, 31), (2026, 5, 31), None, None]
