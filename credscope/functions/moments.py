"""Correlations and least squares from exact sums of x, y, xx, yy and xy.

Products are taken as two doubles (the rounded product and its error), so the
sums are exact and no merge order changes a bit.  A sum is kept as two doubles
again, high and low, which leaves about 106 bits for the differences
``n * Sxy - Sx * Sy``: their cancellation costs nothing that shows in a double.
Values between 1e-70 and 1e70 in size (or 0) are served so; beyond, products of
four of them leave the range of doubles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numeric import _SPLITTER
from .sums import LIMBS, gathered_pieces, limb_sums, rounded_sum, with_limbs

SUMS = ("x", "y", "xx", "yy", "xy")
#: A variance below this share of its terms is one of equal values.
NOTHING = 2.0**-98


def two_product(a: Column, b: Column) -> Column:
    """array(p, e): p is a * b rounded, p + e is a * b."""
    def split(v: Column) -> Column:
        high = v * _SPLITTER - (v * _SPLITTER - v)
        return F.struct(v.alias("v"), high.alias("h"), (v - high).alias("l"))

    def of(s: Column) -> Column:
        x, y = s[0], s[1]
        p = x["v"] * y["v"]
        return F.array(p, ((x["h"] * y["h"] - p) + x["h"] * y["l"] + x["l"] * y["h"]) + x["l"] * y["l"])

    return F.get(F.transform(F.array(F.transform(F.array(a, b), split)), of), 0)


def _terms(x: Column, y: Column) -> Column:
    """For each of ``SUMS`` an array whose elements are added to it."""
    factors = F.array(F.struct(x.alias("a"), x.alias("b")), F.struct(y.alias("a"), y.alias("b")), F.struct(x.alias("a"), y.alias("b")))
    return F.concat(F.array(F.array(x), F.array(y)), F.transform(factors, lambda f: two_product(f["a"], f["b"])))


def _high_low(numbers: Column) -> Column:
    """struct(h, l): the exact sum of an array rounded, and what is left of it."""
    high = F.transform(F.array(rounded_sum(numbers)), lambda h: F.struct(h.alias("h"), rounded_sum(F.concat(numbers, F.array(-h))).alias("l")))
    return F.get(high, 0)


def _difference(n: Column, squares: Column, a: Column, b: Column) -> Column:
    """n * squares - a * b, all but n as high and low."""
    less = F.transform(two_product(a["h"], b["h"]), lambda v: -v)
    return rounded_sum(F.concat(two_product(n, squares["h"]), F.array(n * squares["l"]), less, F.array(-(a["h"] * b["l"]), -(a["l"] * b["h"]))))


def _fitted(df: DataFrame, n: Column, numbers: Column) -> DataFrame:
    """Adds ``r`` (null for fewer than two pairs or without variance),
    ``slope`` and ``intercept`` (0, 0 for fewer than two pairs; a constant x
    gives slope 0 and the mean of y).  ``numbers``: an array for each of ``SUMS``."""
    df = df.withColumns({"__s": F.transform(numbers, _high_low), "__n": n.cast("double")})
    s, count = {k: F.col("__s")[i] for i, k in enumerate(SUMS)}, F.col("__n")
    parts = F.array(*[F.struct(s[a + b].alias("q"), s[a].alias("a"), s[b].alias("b")) for a, b in ("xx", "yy", "xy")])
    df = df.withColumn("__v", F.transform(parts, lambda p: _difference(count, p["q"], p["a"], p["b"])))
    vx, vy, vxy = (F.col("__v")[i] for i in range(3))
    x_varies, y_varies = vx > count * s["xx"]["h"] * NOTHING, vy > count * s["yy"]["h"] * NOTHING
    df = df.withColumn("r", F.when((count >= 2) & x_varies & y_varies, vxy / F.sqrt(vx) / F.sqrt(vy)))
    df = df.withColumn("slope", F.when((count >= 2) & x_varies, vxy / vx).otherwise(0.0))
    df = df.withColumn("intercept", F.when(count >= 2, (s["y"]["h"] - F.col("slope") * s["x"]["h"]) / count).otherwise(0.0))
    return df.drop("__n", "__s", "__v")


def associations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``ord, n, r, slope, intercept`` of y over x for each pair (x, y) of
    columns, over the rows that have both; one row a pair, whatever ``df`` holds.

    Rows become terms, which are added by pair, sum and exponent slice before
    the shuffle; a group is a handful of partial sums."""
    both = [(F.col(x).cast("double"), F.col(y).cast("double")) for x, y in pairs]
    entries = F.array(*[F.struct(F.lit(i).alias("ord"), x.alias("x"), y.alias("y")) for i, (x, y) in enumerate(both)])
    rows = df.select(F.inline(entries)).filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    terms = rows.select("ord", F.posexplode(_terms(F.col("x"), F.col("y"))).alias("of", "terms"))
    long = with_limbs(terms.select("ord", "of", F.explode("terms").alias("v")), {"v": "v"})
    added = long.groupBy("ord", "of", "v_slice").agg(*limb_sums("v"), F.count(F.when(F.col("of") == 0, 1)).alias("n"))
    slices = F.struct("of", F.col("v_slice").alias("slice"), *[F.col(f"v_{limb}").alias(limb) for limb, _ in LIMBS])
    by_pair = added.groupBy("ord").agg(
        F.sum("n").alias("n"), F.collect_list(F.when(F.col("v_slice").isNotNull(), slices)).alias("parts"),
        F.collect_list(F.when(F.col("v_special").isNotNull(), F.struct("of", F.col("v_special").alias("v")))).alias("special"),
    )

    def numbers(k: Column) -> Column:
        mine = lambda p: p["of"] == k
        return F.concat(gathered_pieces(F.filter("parts", mine)), F.transform(F.filter("special", mine), lambda p: p["v"]))

    found = _fitted(by_pair, F.col("n"), F.transform(F.array(*map(F.lit, range(len(SUMS)))), numbers))
    every = df.sparkSession.range(len(pairs)).select(F.col("id").cast("int").alias("ord"))
    out = every.join(found.select("ord", "n", "r", "slope", "intercept"), "ord", "left")
    return out.fillna(0, ["n"]).fillna(0.0, ["slope", "intercept"])
