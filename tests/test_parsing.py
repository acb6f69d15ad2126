"""Edge rows of the parsing / key builders (FIXTURES section 3)."""

import math

import pytest
from pyspark.sql import functions as F

from credscope.functions import parsing as P


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_percent_float(spark):
    got = one_col(spark, [" 13.5% ", "", ".", "abc", None, "7%", "1_000", "5d", "2f", "0x1p3", "+.5", "1e3", " 12 "],
                  P.percent_float)
    assert got == [13.5, None, None, None, None, 7.0, 1000.0, None, None, None, 0.5, 1000.0, 12.0]


def test_lenient_float_special_values(spark):
    got = one_col(spark, ["nan", "inf", "-Infinity", " 1.5 ", "1__0", "--1", "e5"], P.lenient_float)
    assert math.isnan(got[0]) and got[1] == math.inf and got[2] == -math.inf
    assert got[3:] == [1.5, None, None, None]


def test_lenient_float_matches_python(spark):
    samples = ["1", "1.", ".5", "-2.5e-3", "1_0.5", "1e", "  3  ", "4.0.1", "+-1", "7_", "_7", "1e1_0"]

    def py(s):
        try:
            return float(s)
        except ValueError:
            return None

    assert one_col(spark, samples, P.lenient_float) == [py(s) for s in samples]


def test_thousands_float(spark):
    assert one_col(spark, ["88,072", "1,234.5", "N/A", None], P.thousands_float) == [88072.0, 1234.5, None, None]


def test_unknown_and_term(spark):
    assert one_col(spark, [None, "", " ", "A"], P.unknown_if_blank) == ["Unknown", "Unknown", " ", "A"]
    assert one_col(spark, [" 36 months", "", "  ", None, "\t60 months\n"], P.stripped_unknown) == [
        "36 months", "Unknown", "", "Unknown", "60 months"]


@pytest.mark.parametrize(
    "value,year,month,quarter",
    [
        ("Dec-2015", "2015", "2015-12", "2015-Q4"),
        ("Jan-2016", "2016", "2016-01", "2016-Q1"),
        ("Foo-2015", "2015", "2015-??", None),
        ("", "Unknown", "Unknown", None),
        ("Dec2015", "Unknown", "Unknown", None),
        (None, "Unknown", "Unknown", None),
        ("Jun-20-15", "15", "20-15-06", "20-15-Q2"),
    ],
)
def test_issue_periods(spark, value, year, month, quarter):
    assert one_col(spark, [value], P.issue_year) == [year]
    assert one_col(spark, [value], P.issue_month) == [month]
    assert one_col(spark, [value], P.issue_quarter) == [quarter]


def test_observation_periods(spark):
    assert one_col(spark, ["1954-07-01", "2020-12-01", "bad"], P.observation_year) == ["1954", "2020", "bad"]
    assert one_col(spark, ["1954-07-01", "2020-12-01", "bad", "2020-13-01"], P.observation_quarter) == [
        "1954-Q3", "2020-Q4", None, None]


def test_fips(spark):
    got = one_col(spark, ["1000", "01000", "1001", "0", "00000", "123456000"], P.is_state_fips)
    assert got == [True, True, False, False, False, True]
    assert one_col(spark, ["7", "123456"], P.fips5) == ["00007", "123456"]


def test_midpoint(spark):
    df = spark.createDataFrame([(675.0, 679.0), (None, 679.0)], "lo double, hi double")
    assert [r[0] for r in df.select(P.midpoint("lo", "hi")).collect()] == [677.0, None]
