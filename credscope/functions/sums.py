"""Exact sums of doubles in any order, by limbs of fixed exponent ranges.

A double belongs to the slice of ``SLICE_BITS`` binary exponents that holds its
first bit.  Scaled by the slice's power of two it is a number of at most
``SLICE_BITS`` bits before the point and 53 after it, which is cut into three
whole-numbered limbs without rounding.  Limbs are added as integers by slice,
so neither partitioning nor merge order matters, and the slices of a group are
joined once at the end to the double nearest to the exact sum (what Python's
``math.fsum`` gives).  Every finite double has its place, from 5e-324 to the
largest; NaN and infinities are added apart and go through.

Ordinary data touch one or two slices a group, so the extra grouping level is
small.  A limb's total overflows beyond 2 ** 40 values a group and slice, and
then raises in ANSI mode.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_BITS = 16
#: Bits after the point that the limbs hold, the first with what lies before it.
LIMBS = (("a", 7), ("b", 30), ("c", 53))


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _scaled(x: Column, slices: Column, extra: int) -> Column:
    """x * 2 ** (SLICE_BITS * slices + extra), in two exact steps as the power itself may be out of range."""
    half = slices.cast("double") * (SLICE_BITS // 2)
    return x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), half + F.lit(float(extra)))


def with_limbs(df: DataFrame, values: Mapping[str, Column | str]) -> DataFrame:
    """Adds for each name: ``_slice`` (null for null, zero and non-finite
    values), the limbs ``_a``, ``_b``, ``_c``, and ``_special`` (NaN, infinities)."""
    x = {n: F.col(f"{n}__x") for n in values}
    out = df.withColumns({f"{n}__x": _c(c).cast("double") for n, c in values.items()})
    special = {n: F.isnan(v) | (F.abs(v) == F.lit(float("inf"))) for n, v in x.items()}
    exponent = {n: F.floor(F.log2(F.abs(v)) / SLICE_BITS).cast("int") for n, v in x.items()}
    out = out.withColumns({f"{n}_slice": F.when((v != 0) & ~special[n], exponent[n]) for n, v in x.items()}
                          | {f"{n}_special": F.when(special[n], v) for n, v in x.items()})
    out = out.withColumns({f"{n}__u": _scaled(v, -F.col(f"{n}_slice"), LIMBS[0][1]) for n, v in x.items()})
    width = [bits - before for (_, bits), (_, before) in zip(LIMBS[1:], LIMBS)]
    for i, (limb, _) in enumerate(LIMBS):
        u = {n: F.col(f"{n}__u") for n in values}
        out = out.withColumns({f"{n}_{limb}": F.floor(v) for n, v in u.items()})
        if i < len(width):
            out = out.withColumns({f"{n}__u": (v - F.floor(v)) * F.lit(2.0 ** width[i]) for n, v in u.items()})
    return out.drop(*[f"{n}__{k}" for n in values for k in "xu"])


def limb_sums(name: str, weight: Column | str | None = None) -> list[Column]:
    """Aggregates over rows ``with_limbs`` of one slice, which must be a
    grouping key; each row counts ``weight`` times.  Rows of these can be
    summed again."""
    times = F.lit(1).cast("long") if weight is None else _c(weight).cast("long")
    sums = [F.sum(F.col(f"{name}_{limb}") * times).alias(f"{name}_{limb}") for limb, _ in LIMBS]
    return [*sums, F.sum(f"{name}_special").alias(f"{name}_special")]


def gathered(name: str, where: Column | None = None) -> list[Column]:
    """Aggregates that bring the slices of a group together; 132 at most."""
    here = F.col(f"{name}_slice").isNotNull()
    here = here if where is None else here & where
    special = F.col(f"{name}_special") if where is None else F.when(where, F.col(f"{name}_special"))
    parts = F.struct(F.col(f"{name}_slice").alias("slice"), *[F.col(f"{name}_{limb}").alias(limb) for limb, _ in LIMBS])
    return [F.collect_list(F.when(here, parts)).alias(f"{name}_parts"), F.sum(special).alias(f"{name}_special")]


def gathered_pieces(parts: Column) -> Column:
    """Gathered slices as an array of doubles whose exact sum is theirs."""
    def pieces(s: Column) -> Column:
        out = []
        for limb, bits in LIMBS:
            low = s[limb] % F.lit(1 << 31)  # both halves have the limb's sign, and are exact as doubles
            out += [_scaled((s[limb] - low).cast("double"), s["slice"], -bits), _scaled(low.cast("double"), s["slice"], -bits)]
        return F.array(*out)

    return F.flatten(F.transform(parts, pieces))


def total(name: str) -> Column:
    """The sum of a gathered group as a double; 0 without values."""
    return F.coalesce(F.col(f"{name}_special"), rounded_sum(gathered_pieces(F.col(f"{name}_parts"))))


def rounded_sum(numbers: Column) -> Column:
    """The double nearest to the exact sum of an array of doubles (ties to
    even), for short arrays: a list of partial sums that don't overlap is kept,
    and rounded from its largest on."""
    zero, none = F.lit(0.0), F.array().cast("array<double>")

    def added(partials: Column, x: Column) -> Column:
        def step(acc: Column, y: Column) -> Column:
            high = acc["x"] + y
            big = F.abs(acc["x"]) >= F.abs(y)
            low = F.when(big, y - (high - acc["x"])).otherwise(acc["x"] - (high - y))
            return F.struct(high.alias("x"), F.when(low == 0, acc["lows"]).otherwise(F.concat(acc["lows"], F.array(low))).alias("lows"))

        return F.aggregate(partials, F.struct(x.alias("x"), none.alias("lows")), step, lambda acc: F.concat(acc["lows"], F.array(acc["x"])))

    def down(acc: Column, y: Column) -> Column:
        high = acc["high"] + y
        exact = acc["low"] == 0
        return F.struct(
            F.when(exact, high).otherwise(acc["high"]).alias("high"),
            F.when(exact, y - (high - acc["high"])).otherwise(acc["low"]).alias("low"),
            F.when(exact, zero).otherwise(F.when(acc["next"] == 0, y).otherwise(acc["next"])).alias("next"),
        )

    def rounded(acc: Column) -> Column:
        twice = acc["low"] * 2
        up = acc["high"] + twice
        halfway = (F.signum(acc["low"]) == F.signum(acc["next"])) & (acc["low"] != 0) & (up - acc["high"] == twice)
        return F.when(halfway, up).otherwise(acc["high"])

    partials = F.aggregate(numbers, none, added)
    return F.aggregate(F.reverse(partials), F.struct(zero.alias("high"), zero.alias("low"), zero.alias("next")), down, rounded)


def exact_sums(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column | str]) -> DataFrame:
    """``keys`` with each value's exact sum by its name and the number of its
    non-null values as ``n_<name>``: one row for each group of ``keys``.

    The values become rows, are added by group, value and slice, combined
    before the shuffle, and joined to one row a group."""
    names = list(values)
    entries = F.array(*[F.struct(F.lit(i).alias("__of"), _c(c).cast("double").alias("v")) for i, c in enumerate(values.values())])
    long = with_limbs(df.select(*keys, F.inline(entries)), {"v": "v"})
    sums = long.groupBy(*keys, "__of", "v_slice").agg(*limb_sums("v"), F.count("v").alias("n"))
    found = sums.groupBy(*keys).agg(*[c.alias(f"{n}__{k}") for i, n in enumerate(names) for k, c in zip(("parts", "special"), gathered("v", F.col("__of") == i))],
                                    *[F.sum(F.when(F.col("__of") == i, F.col("n")).otherwise(0)).alias(f"n_{n}") for i, n in enumerate(names)])
    found = found.withColumnsRenamed({f"{n}__{k}": f"{n}_{k}" for n in names for k in ("parts", "special")})
    return found.select(*keys, *[total(n).alias(n) for n in names], *[f"n_{n}" for n in names])
