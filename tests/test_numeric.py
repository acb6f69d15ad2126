"""Exact rounding, order-independent means, null-safe correlation / OLS."""

import random

import pytest
from pyspark.sql import functions as F

from credscope.functions import numeric as N


def test_round_exact_matches_python(spark):
    rnd = random.Random(7)
    values = [34 / 64, 650 / 1600, 4515 / 16800, -0.00001, 0.0, -2.5e-5, 1e16 + 0.5, 258.85575]
    values += [rnd.randint(0, 10**6) / rnd.randint(1, 10**5) for _ in range(400)]
    values += [k / 20000 for k in range(0, 2000)]  # many exact 5th-decimal ties
    values += [-(k / 20000) for k in range(1, 500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(N.round_exact("v", 4)).collect()]
    want = [round(v, 4) + 0.0 for v in values]  # + 0.0 normalises -0.0
    assert got == want


def test_round_exact_published_ties(spark):
    df = spark.createDataFrame([(34, 64), (650, 1600), (4515, 16800)], "d long, n long")
    got = [r[0] for r in df.select(N.round_exact(N.ratio("d", "n"), 4)).collect()]
    assert got == [0.5312, 0.4062, 0.2687]


def test_pearson_degenerate(spark):
    df = spark.createDataFrame(
        [("n0", None, None), ("n1", 1.0, 2.0), ("c", 1.0, 3.0), ("c", 1.0, 5.0), ("u", 1.0, None), ("u", 2.0, 4.0),
         ("u", 3.0, 6.0), ("u", None, 100.0)],
        "g string, x double, y double",
    )
    got = dict(df.groupBy("g").agg(N.pearson("x", "y").alias("r")).collect())
    assert got["n0"] is None and got["n1"] is None and got["c"] is None
    assert abs(got["u"] - 1.0) < 1e-12  # unpaired rows ignored on both sides


def test_ols_fallbacks(spark):
    df = spark.createDataFrame(
        [("one", 1.0, 2.0), ("const", 3.0, 1.0), ("const", 3.0, 5.0), ("line", 1.0, 3.0), ("line", 2.0, 5.0)],
        "g string, x double, y double",
    )
    a, b = N.ols("y", "x")
    got = {r[0]: (r[1], r[2]) for r in df.groupBy("g").agg(a.alias("a"), b.alias("b")).collect()}
    assert got["one"] == (0.0, 0.0)
    assert got["const"] == (3.0, 0.0)
    assert abs(got["line"][0] - 1.0) < 1e-12 and abs(got["line"][1] - 2.0) < 1e-12


def test_round_exact_of_large_values(spark):
    for x, want in ((1e15 + 0.5, float(round(1e15 + 0.5))), (4.0e15, 4.0e15), (1e300, 1e300), (2.5, 2.0), (-2.5, -2.0)):
        assert spark.createDataFrame([(x,)], "v double").select(N.round_exact("v", 0)).first()[0] == want
    assert spark.createDataFrame([(1e18,)], "v double").select(N.round_exact("v", 4)).first()[0] == 1e18


def test_a_cluster_needs_a_shared_folder():
    from credscope.session import require_local
    require_local("local[4]")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        require_local("spark://host:7077")
