"""Period aggregation of monthly macro series (A10, A11) with complete-case
filtering (P20) and period-over-period CPI inflation (W1).

The monthly input can be any size; it is reduced to one row per calendar
period by a partial/final hash aggregate.  Only that period table (a few
hundred rows for a century of data) flows through the ordered window that
computes the lag, so the single-partition window is bounded by the
calendar, never by the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import ratio, round_exact
from ..functions.parsing import lenient_float, observation_quarter, observation_year
from ..functions.sums import exact_sums

# Column names of the monthly file and of the period outputs.
MONTHLY_SERIES = (
    ("FEDFUNDS", "avg_fed_funds_rate"),
    ("UNRATE", "avg_unemployment_rate"),
    ("CPIAUCSL", "avg_cpi"),
)
CPI_SERIES = "CPIAUCSL"


def period_macro(
    monthly: DataFrame,
    period: Column,
    period_name: str,
    inflation_name: str,
    date_col: str = "observation_date",
) -> DataFrame:
    """Mean of each series per period over its non-NULL months, periods with
    all series present only, CPI inflation vs the previous *kept* period.

    Inflation uses the unrounded CPI means; every output is rounded to 4 dp.
    """
    parsed = monthly.select(
        period.alias(period_name),
        *[lenient_float(src).alias(src) for src, _ in MONTHLY_SERIES],
    )
    sums = exact_sums(parsed, [period_name], {src: src for src, _ in MONTHLY_SERIES})
    agg = sums.select(period_name, *[ratio(src, f"n_{src}").alias(out) for src, out in MONTHLY_SERIES], *[f"n_{src}" for src, _ in MONTHLY_SERIES])
    # Complete-case rule on the period aggregates, before the lag: a period is
    # kept when it is defined (malformed dates give a NULL period) and every
    # series has a value.  Written as one predicate over the aggregates so it
    # runs on the period rows, not pushed below the grouping into every input row.
    least_n = F.least(*[F.col(f"n_{src}") for src, _ in MONTHLY_SERIES])
    kept = agg.filter(F.when(F.col(period_name).isNull(), F.lit(0)).otherwise(least_n) > 0)
    cpi_out = dict(MONTHLY_SERIES)[CPI_SERIES]
    # One row per calendar period: bounded, so an unpartitioned window is safe.
    prev = F.lag(cpi_out).over(Window.orderBy(period_name))
    inflation = F.when(prev.isNotNull() & (prev != 0), (F.col(cpi_out) / prev - 1) * 100)
    return kept.select(
        period_name,
        *[round_exact(out, 4).alias(out) for _, out in MONTHLY_SERIES],
        round_exact(inflation, 4).alias(inflation_name),
    ).orderBy(period_name)


def annual_macro(monthly: DataFrame, date_col: str = "observation_date") -> DataFrame:
    """A10: ``issue_year, avg_fed_funds_rate, avg_unemployment_rate, avg_cpi, cpi_inflation_rate``."""
    return period_macro(monthly, observation_year(date_col), "issue_year", "cpi_inflation_rate", date_col)


def quarterly_macro(monthly: DataFrame, date_col: str = "observation_date") -> DataFrame:
    """Same per ``YYYY-Qn``; the inflation column is ``quarterly_cpi_inflation_rate``."""
    return period_macro(
        monthly, observation_quarter(date_col), "issue_quarter", "quarterly_cpi_inflation_rate", date_col
    )
