"""Exact sums: any finite double, any partitioning, as Python's fsum."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from credscope.functions import sums


def added(spark, values, partitions=3):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(partitions)
    return tuple(sums.exact_sums(df, [], {"v": "v"}).first())


@pytest.mark.parametrize("values", [
    [1e30, -1e30, 1e-30], [1.2345678901234567e-13] * 3, [13.1234567, 1 / 3, 0.1], [5e-324] * 7, [5e-324, -5e-324, 1e308, -1e308],
    [1.7976931348623157e308, -1.7976931348623157e308, 2.0**-1074], [1e17, 1.0], [2e12, 10.0], [1e16 + 2, 0.25, -1e16],
    [2.0**53, 1.0], [2.0**53, 1.0, 2.0**-60], [2.0**53 + 2, 1.0], [2.0**53 + 2, 1.0, -(2.0**-60)], [-(2.0**53), -1.0, -(2.0**-1074)],
    [65536.0, 65535.99999999999, 2.0**-16, 2.0**-17], [0.0, -0.0], [2.2250738585072014e-308, 2.0**-1074], [7.0],
])
def test_sum_is_fsum(spark, values):
    assert added(spark, values) == (math.fsum(values), len(values))


def test_random_magnitudes_in_any_partitioning(spark):
    rng = random.Random(3)
    values = [rng.choice([-1, 1]) * rng.random() * 2.0 ** rng.randint(-1074, 1000) for _ in range(3000)] + [rng.uniform(0, 30) for _ in range(3000)]
    assert {added(spark, values, p)[0] for p in (1, 7, 64)} == {math.fsum(values)}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e300, max_value=1e300), min_size=1, max_size=30))
def test_any_floats(spark, values):
    assert added(spark, values, 2)[0] == math.fsum(values)


def test_special_and_missing_values(spark):
    inf, nan = float("inf"), float("nan")
    assert added(spark, [inf, 10.0])[0] == inf and added(spark, [None, 4.0]) == (4.0, 1)
    assert math.isnan(added(spark, [inf, -inf])[0]) and math.isnan(added(spark, [nan, 1.0])[0])
    assert added(spark, [None]) == (0.0, 0)


def test_groups_and_several_values(spark):
    rows = [("x", 0.1, 1e20), ("x", 0.2, 1.0), ("x", 0.3, -1e20), ("y", None, 5.0), (None, 1.5, None)]
    df = spark.createDataFrame(rows, "k string, a double, b double")
    got = {r["k"]: tuple(r)[1:] for r in sums.exact_sums(df, ["k"], {"a": "a", "b": F.col("b") * 2}).collect()}
    assert got == {"x": (math.fsum([0.1, 0.2, 0.3]), 2.0, 3, 3), "y": (0.0, 10.0, 0, 1), None: (1.5, 0.0, 1, 0)}


def test_weighted_rows_of_very_many(spark):
    df = sums.with_limbs(spark.createDataFrame([(2e12, 1), (10.0, 1), (12.5, 10**10), (13.1234567, 3)], "v double, n long"), {"v": "v"})
    one = df.groupBy("v_slice").agg(*sums.limb_sums("v", "n")).agg(*sums.gathered("v")).select(sums.total("v")).first()[0]
    assert one == math.fsum([2e12, 10.0, 12.5 * 10**10, *[13.1234567] * 3])


def test_without_ansi_mode(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        assert added(spark, [1e30, 1.0, -1e30, None])[0] == 1.0
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
