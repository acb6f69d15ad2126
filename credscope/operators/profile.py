"""Whole-file profiles: status frequency (A4), missing values (A5), overview
metrics (A6) and the overall default rate (A7).

All three run over *all* rows (finalized or not).  Each is one global or
low-cardinality aggregate: partial aggregation in every scan task, a tiny
final merge, no data-sized shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.labels import outcome_flag
from ..functions.numeric import ratio, round_exact
from ..functions.values import MISSING_TOP
from ..sources.files import FIELD_COUNT


def status_distribution(loans: DataFrame, status: str = "loan_status") -> DataFrame:
    """Status frequencies over all rows; an empty status is its own group.

    Ordered by count desc; ties by status text (first appearance is not
    defined on a cluster).
    """
    s = F.coalesce(F.col(status), F.lit("")).alias("loan_status")
    return (
        loans.groupBy(s)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "loan_status")
    )


def _is_missing(df: DataFrame, name: str, position: int) -> Column:
    c = F.col(f"`{name}`")
    missing = c.isNull() | (c == F.lit("")) if isinstance(df.schema[name].dataType, StringType) else c.isNull()
    if FIELD_COUNT not in df.columns:
        return missing
    return missing & (F.col(FIELD_COUNT).isNull() | (F.col(FIELD_COUNT) > position))


def profiled_columns(raw: DataFrame) -> list[str]:
    return [c for c in raw.columns if c != FIELD_COUNT]


def missing_metrics(raw: DataFrame) -> list[Column]:
    """Aggregates: ``all_rows``, and ``m<i>`` missing values of column i."""
    sums = [
        F.sum(F.when(_is_missing(raw, c, i), 1).otherwise(0)).cast("bigint").alias(f"m{i}")
        for i, c in enumerate(profiled_columns(raw))
    ]
    return [F.count(F.lit(1)).alias("all_rows"), *sums]


def observed_missing(spark: SparkSession, cols: Sequence[str], seen: Mapping[str, int | None], top: int | None = MISSING_TOP) -> DataFrame:
    """:func:`missing_profile` from ``missing_metrics`` that were observed while
    the rows were landed: one number a column, no scan."""
    names = ["all_rows", *[f"m{i}" for i in range(len(cols))]]
    wide = spark.range(1).select(*[F.lit(seen[n] or 0).cast("bigint").alias(n) for n in names])
    return _ranked(wide, cols, top).drop("rank")


def missing_ranked(raw: DataFrame, top: int | None = MISSING_TOP) -> DataFrame:
    """Per-column missing counts (NULL or ``''``) over all rows (A5), with the
    column's ``rank`` by count desc, then column position (O11).

    One wide aggregate computes every column's count in a single pass; the
    1-row result is sorted as an array and turned into rows, so nothing is
    ranked by a window.  Never-missing columns are absent; ``top`` keeps the
    first rows (the published table keeps 40).  Where ``FIELD_COUNT`` is a
    column of ``raw``, the fields that a short row lacks aren't counted.
    """
    return _ranked(raw.agg(*missing_metrics(raw)), profiled_columns(raw), top)


def _ranked(wide: DataFrame, cols: Sequence[str], top: int | None) -> DataFrame:
    entries = F.array(*[
        F.struct((-F.col(f"m{i}")).alias("least"), F.lit(i).alias("ordinal"), F.lit(c).alias("column"))
        for i, c in enumerate(cols)
    ])
    ordered = F.array_sort(F.filter(entries, lambda e: e["least"] < 0))
    if top:
        ordered = F.slice(ordered, 1, top)
    long = wide.select("all_rows", F.posexplode(ordered).alias("pos", "e"))
    return long.select(
        (F.col("pos") + 1).cast("bigint").alias("rank"),
        F.col("e.column").alias("column"),
        round_exact(ratio(-F.col("e.least"), "all_rows"), 4).alias("missing_rate"),
        (-F.col("e.least")).alias("missing_count"),
    )


def missing_profile(raw: DataFrame, top: int | None = MISSING_TOP) -> DataFrame:
    """:func:`missing_ranked` in the published shape: its rows in order."""
    return missing_ranked(raw, top).drop("rank")


def overview(loans: DataFrame, source_name: str, status: str = "loan_status", statuses: DataFrame | None = None) -> DataFrame:
    """``metric, value`` rows: source, row counts, column count, overall rate.

    Values are text because the metrics have mixed types.  The overall
    default rate is ``round(defaults / usable, 4)``, or ``0`` without usable rows.
    Everything follows from the rows by status: with ``statuses`` (a stored
    :func:`status_distribution`) the loans aren't read again.
    """
    statuses = status_distribution(loans, status) if statuses is None else statuses
    flag, n = outcome_flag("loan_status"), F.col("count")
    agg = statuses.agg(
        F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("all_rows"),
        F.coalesce(F.sum(F.when(flag.isNotNull(), n)), F.lit(0)).cast("bigint").alias("usable"),
        F.sum(flag * n).cast("bigint").alias("defaults"),
    )
    rate = F.when(F.col("usable") > 0, round_exact(ratio("defaults", "usable"), 4).cast("string")).otherwise(F.lit("0"))
    metrics = (
        ("source_file", F.lit(source_name)),
        ("all_rows", F.col("all_rows").cast("string")),
        ("usable_finalized_rows", F.col("usable").cast("string")),
        ("skipped_non_final_rows", (F.col("all_rows") - F.col("usable")).cast("string")),
        ("columns", F.lit(str(len(loans.columns)))),
        ("overall_default_rate", rate),
    )
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in metrics])
    return agg.select(F.inline(rows))
