"""Positions in a total order over a table of any size.

Rows are dealt to partitions by ranges of the order and sorted there; rows are
counted per partition, and a row's position is the number of rows in the
partitions before its own plus its place within it.  No task sees more than
its range, and no window runs over a whole table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of ``monotonically_increasing_id`` that number the rows of a partition.
ROW_BITS = 33


def ranked(df: DataFrame, order: Sequence[Column], name: str, store: Callable[[DataFrame], DataFrame], first: int = 1) -> DataFrame:
    """``df`` with the position of each row in ``order`` as ``name`` (long, from ``first``).

    ``order`` must be total: rows equal in it get different positions in any
    order.  ``store`` writes a frame and reads it back, because places in a
    partition must not change between the counting and the reading.  The
    driver gets one number a partition.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = store(dealt.withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", ROW_BITS)
    counts = {r["part"]: r["count"] for r in kept.groupBy(part.alias("part")).count().collect()}
    sizes = [counts.get(i, 0) for i in range(max(counts, default=-1) + 1)]
    before = F.lit([0, *accumulate(sizes)][: len(sizes)] or [0]).cast("array<bigint>")
    place = F.col("__at") - F.shiftleft(part, ROW_BITS)
    return kept.withColumn(name, F.get(before, part.cast("int")) + place + F.lit(first)).drop("__at")


def ranked_within(df: DataFrame, group: str, order: Sequence[Column], name: str, store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The same within each (non-null) value of ``group``, from 1: positions in
    the order of group and ``order``, less the group's first.  A group may span
    any number of partitions."""
    placed = ranked(df, [F.col(group), *order], "__place", store)
    first = placed.groupBy(group).agg(F.min("__place").alias("__first"))
    return placed.join(first, group).withColumn(name, F.col("__place") - F.col("__first") + 1).drop("__place", "__first")
