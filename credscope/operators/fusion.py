"""Fusing loan rates with period and state features (J1, J2, J3) and the
correlation tables over the fused rows (A12, A16, A17).

The right-hand sides are keyed by calendar period or by state (hundreds of
rows).  No broadcast is forced: adaptive execution measures the materialised
side and turns the join into a broadcast hash join when it is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``, keeping the sort-merge
join otherwise.  Correlations use the *rounded* published values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.moments import associations
from ..functions.numeric import round_exact
from ..functions.values import UNKNOWN
from . import rates


def attach(left: DataFrame, features: DataFrame, key: str) -> DataFrame:
    """Inner equi-join on ``key``; feature columns appended (right wins on
    name clashes, as only the key clashes it is the join column)."""
    return left.join(features, on=key, how="inner")


def rate_with_period_macro(rate_table: DataFrame, macro: DataFrame, key: str) -> DataFrame:
    """Published period rates (``Unknown`` dropped) x period macro.

    NULL periods match nothing: they are dropped on both sides.  That filter
    runs on aggregated rows (``keep_groups``), and the keys are then declared
    non-nullable (``coalesce``): otherwise the optimizer infers an IS NOT NULL
    filter for the join and pushes it below the aggregates, re-deriving the
    period of every input row."""
    known = rates.keep_groups(rate_table, F.col(key).isNotNull() & (F.col(key) != F.lit(UNKNOWN)))
    known = known.withColumn(key, F.coalesce(F.col(key), F.lit("")))
    periods = macro.filter(F.col(key).isNotNull()).withColumn(key, F.coalesce(F.col(key), F.lit("")))
    return attach(known, periods, key).orderBy(key)


def correlation_table(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    label_col: str,
    value_col: str,
) -> DataFrame:
    """One row per feature: Pearson r of feature vs target, 4 dp.

    All correlations come from one pass over ``df``, with exact sums.
    """
    stats = associations(df, [(f, target) for f in features])
    return stats.orderBy("ord").select(_nth(features).alias(label_col), round_exact("r", 4).alias(value_col))


def _nth(names: Sequence[str]):
    return F.get(F.array(*map(F.lit, names)), F.col("ord"))


def correlation_matrix(df: DataFrame, targets: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Long ``target, feature, correlation`` table, target-major."""
    pairs = [(t, f) for t in targets for f in features]
    stats = associations(df, [(f, t) for t, f in pairs])
    return stats.orderBy("ord").select(_nth([t for t, _ in pairs]).alias("target"), _nth([f for _, f in pairs]).alias("feature"),
                                       round_exact("r", 4).alias("correlation"))
