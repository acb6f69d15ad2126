"""Correlations and slopes from exact sums: the same bits in any partitioning."""

import random
from fractions import Fraction

import pytest

from credscope.functions import moments


def exact(points):
    """(r squared with the sign of r, slope, intercept) in whole fractions; None without variance."""
    pts = [(Fraction(x), Fraction(y)) for x, y in points if x is not None and y is not None]
    n, sx, sy = len(pts), sum(x for x, _ in pts), sum(y for _, y in pts)
    vx, vy = n * sum(x * x for x, _ in pts) - sx * sx, n * sum(y * y for _, y in pts) - sy * sy
    vxy = n * sum(x * y for x, y in pts) - sx * sy
    slope = vxy / vx if vx else Fraction(0)
    r = float(abs(vxy * vxy / (vx * vy))) ** 0.5 * (1 if vxy > 0 else -1) if vx and vy and n > 1 else None
    return r, float(slope) if n > 1 else 0.0, float((sy - slope * sx) / n) if n > 1 else 0.0


def fitted(spark, points, partitions):
    df = spark.createDataFrame(points, "x double, y double").repartition(partitions)
    return tuple(moments.associations(df, [("x", "y")]).select("r", "slope", "intercept").first())


def test_same_bits_in_any_partitioning(spark):
    rng = random.Random(5)
    points = [(690 + rng.gauss(0, 8), 0.2 + rng.gauss(0, 0.03) * rng.choice([1, 1e3])) for _ in range(150)] + [(None, 1.0), (700.0, None)]
    found = {fitted(spark, points, p) for p in (1, 7, 64)}
    assert len(found) == 1
    got = found.pop()
    assert all(abs(a - b) <= 4e-16 * abs(b) for a, b in zip(got[:2], exact(points)[:2])) and abs(got[2] - exact(points)[2]) < 1e-12


@pytest.mark.parametrize("points", [
    [(1e9 + i, 1e9 - 2 * i + 1e-3 * (i % 3)) for i in range(20)],     # large means, small spread
    [(0.1, 1.0), (0.1, 2.0), (0.1, 4.0)], [(1.0, 0.3)] * 5, [(1.0, 2.0)], [(None, 2.0)], [], [(1.0, 3.0), (2.0, 5.0)],
    [(1 / 3, 1 / 7)] * 49, [(1e30, 1e-30), (3e30, 2e-30), (2e30, 5e-30)],
])
def test_against_fractions(spark, points):
    got, want = fitted(spark, points, 3), exact(points)
    assert (got[0] is None) == (want[0] is None)
    assert all(a is None or a == pytest.approx(b, rel=1e-14, abs=1e-300) for a, b in zip(got[:2], want[:2]))
    assert got[2] == pytest.approx(want[2], rel=1e-8)


def test_pairs_of_several_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 1.0, None), (3.0, 5.0, 1.0)], "a double, b double, c double")
    got = moments.associations(df, [("a", "b"), ("b", "a"), ("a", "c"), ("a", "a")]).orderBy("ord").collect()
    assert [g.n for g in got] == [3, 3, 1, 3] and got[0].r == got[1].r and got[2].r is None and got[3].r == pytest.approx(1.0, abs=1e-15)
    infinite = spark.createDataFrame([(1.0, 2.0), (2.0, float("nan")), (3.0, 1.0)], "a double, b double")
    r = moments.associations(infinite, [("a", "b")]).first().r
    assert r is None or r != r
