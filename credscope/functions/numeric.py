"""Numeric column builders with deterministic, distribution-safe semantics.

* ``round_exact`` reproduces Python's ``round(x, n)``: it rounds the exact
  binary value half-to-even, whereas Spark's ``round``/``bround`` round the
  shortest decimal representation (0.26875 is really 0.268749999..., so the
  right answer is 0.2687, not 0.2688).
* exact sums, which don't depend on partitioning or merge order, are in
  :mod:`credscope.functions.sums`.
* ``pearson`` / ``ols`` return NULL (or the documented fallbacks) on
  degenerate inputs instead of raising under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Veltkamp splitter 2**27 + 1: splits a double into two 26-bit halves, so the
# rounding error of ``x * 10**n`` can be recovered exactly (Dekker product).
_SPLITTER = 134217729.0
# From this magnitude on a double has no fraction: nothing to round.
_NO_FRACTION = 2.0**52


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_exact(col: Column | str, digits: int = 4) -> Column:
    """Python ``round(x, digits)`` for doubles; ``-0.0`` is normalised to 0.0.

    The input is bound once through a lambda (``transform(array(x), v -> ...)``)
    because the formula reads it about fifteen times: inlining it would make
    nested roundings grow exponentially in plan and generated-code size.  It
    is applied to aggregated results only, never to per-row hot paths.
    """
    bound = F.transform(F.array(_c(col).cast("double")), lambda v: _round_bound(v, digits))
    return F.get(bound, 0)


def _round_bound(x: Column, digits: int) -> Column:
    scale = F.lit(float(10**digits))
    c = x * F.lit(_SPLITTER)
    hi = c - (c - x)
    lo = x - hi
    p = x * scale
    err = (hi * scale - p) + lo * scale  # sign of (exact x*scale) - p
    whole = F.rint(p)  # no bigint: p may be larger
    fl = F.when(whole > p, whole - 1).otherwise(whole)
    tie = (p - fl) == F.lit(0.5)
    r = (
        F.when(~tie, F.rint(p))
        .when(err > 0, fl + F.lit(1.0))
        .when(err < 0, fl)
        .otherwise(F.rint(p))
    )
    rounded = F.when(r == 0, F.lit(0.0)).otherwise(r / scale)
    passthrough = x.isNull() | F.isnan(x) | (F.abs(x) >= F.lit(_NO_FRACTION))
    return F.when(passthrough, x).otherwise(rounded)


def ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` as double, NULL when the denominator is 0."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def weighted_count(col: Column | str, weight: Column | str) -> Column:
    """Number of underlying rows with a non-NULL value."""
    return F.sum(F.when(_c(col).isNotNull(), _c(weight)).otherwise(F.lit(0)))


def _paired(x: Column, y: Column) -> tuple[Column, Column]:
    both = x.isNotNull() & y.isNotNull()
    return F.when(both, x), F.when(both, y)


def pearson(x: Column | str, y: Column | str) -> Column:
    """Pairwise-complete Pearson r; NULL for fewer than 2 pairs or zero variance."""
    px, py = _paired(_c(x), _c(y))
    return F.try_divide(F.covar_pop(px, py), F.stddev_pop(px) * F.stddev_pop(py))


def ols(y: Column | str, x: Column | str, over=None) -> tuple[Column, Column]:
    """Simple least squares ``y = a + b x`` over complete pairs -> (a, b).

    Fewer than two pairs gives (0, 0); a constant ``x`` gives slope 0 and the
    mean of ``y`` as intercept.  As aggregates by default, or as window
    aggregates with ``over`` (a ``WindowSpec``).
    """
    yc, xc = _c(y), _c(x)

    def agg(c: Column) -> Column:
        return c.over(over) if over is not None else c

    n = agg(F.regr_count(yc, xc))
    slope = F.when(n < 2, F.lit(0.0)).otherwise(F.coalesce(agg(F.regr_slope(yc, xc)), F.lit(0.0)))
    intercept = F.when(n < 2, F.lit(0.0)).otherwise(
        F.coalesce(agg(F.regr_intercept(yc, xc)), agg(F.regr_avgy(yc, xc)))
    )
    return intercept, slope


def min_max_scaled(value: Column | str, lo: Column | str, hi: Column | str, floor: float) -> Column:
    """``(v - lo) / max(hi - lo, floor)``."""
    v, mn, mx = _c(value), _c(lo), _c(hi)
    return (v - mn) / F.greatest(mx - mn, F.lit(floor))
