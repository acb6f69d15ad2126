"""Outcome labelling (P1, P2) and bin labelling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import BAD_STATUSES, GOOD_STATUSES, BinSpec


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def outcome_flag(
    status: Column | str,
    good: Sequence[str] = GOOD_STATUSES,
    bad: Sequence[str] = BAD_STATUSES,
) -> Column:
    """0 for a good final status, 1 for a bad one, NULL otherwise (exact match)."""
    s = _c(status)
    return F.when(s.isin(*good), F.lit(0)).when(s.isin(*bad), F.lit(1))


def is_finalized(
    status: Column | str,
    good: Sequence[str] = GOOD_STATUSES,
    bad: Sequence[str] = BAD_STATUSES,
) -> Column:
    """Predicate equivalent to ``outcome_flag(...) IS NOT NULL``.

    Written as a plain IN-list so Catalyst pushes it into the Parquet scan.
    """
    return _c(status).isin(*good, *bad)


def bin_label(value: Column | str, spec: BinSpec) -> Column:
    """First bin whose exclusive upper bound exceeds the value.

    NULL -> ``spec.unknown``; values beyond every bound, and NaN (which Spark
    orders above all numbers), fall into the last bin.
    """
    v = _c(value)
    expr = F.when(v.isNull(), F.lit(spec.unknown))
    for upper, label in spec.bins[:-1]:
        expr = expr.when(v < F.lit(upper), F.lit(label))
    return expr.otherwise(F.lit(spec.bins[-1][1]))


def order_rank(label: Column | str, order: Sequence[str]) -> Column:
    """Position of a label in an explicit order; unlisted labels sort last (O2)."""
    ranks = F.create_map(*[x for i, lab in enumerate(order) for x in (F.lit(lab), F.lit(i))])
    return F.coalesce(ranks[_c(label)], F.lit(len(order)))
