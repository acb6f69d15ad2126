"""State-level features: economics from long files (A9, J4, P15, P16), loan
features per state (A8), and the regression "control" analysis (J5, A13,
A15, J6).

Long to wide with "last row in file order wins": both long files are
unioned (tagged with their file rank) and reduced by one hash aggregate of
``max_by(value, pos)`` per attribute, as values and positions are numbers.
State names are text, so only the position of the last row is aggregated and
the name fetched by a join on it.  That replaces two pivots plus a full outer
join; all of it is partially aggregated map-side, so a state holding a third of
the rows costs nothing extra.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import ols, ratio, round_exact, weighted_count
from ..functions.parsing import is_state_fips, percent_float, thousands_float, unknown_if_blank
from ..functions.values import (
    DEFAULT_MIN_LOANS,
    GRADES,
    OPTIONAL_UNEMPLOYMENT_ATTRIBUTES,
    POVERTY_ATTRIBUTES,
    UNEMPLOYMENT_ATTRIBUTES,
)
from ..functions.sums import gathered, limb_sums, total, with_limbs
from .rates import fico_midpoint, finalized

ECONOMIC_COLUMNS = tuple(out for _, out in UNEMPLOYMENT_ATTRIBUTES + POVERTY_ATTRIBUTES)


def _state_rows(long: DataFrame, state_col: str, file_rank: int, fips: str, pos: str) -> DataFrame:
    return long.filter(is_state_fips(fips)).select(
        F.col(state_col).alias("state"),
        F.col("Area_Name").alias("area"),
        F.col("Attribute").alias("attribute"),
        thousands_float("Value").alias("value"),
        F.lit(file_rank).alias("file"),
        F.col(pos).alias("pos"),
    )


def _last_value(attribute: str, file_rank: int) -> Column:
    hit = (F.col("attribute") == F.lit(attribute)) & (F.col("file") == F.lit(file_rank))
    return F.max_by(F.when(hit, F.col("value")), F.when(hit, F.col("pos")))


def attributes_present(
    unemployment: DataFrame,
    fixed: Sequence[tuple[str, str]] = UNEMPLOYMENT_ATTRIBUTES,
    optional: Sequence[tuple[str, str]] = OPTIONAL_UNEMPLOYMENT_ATTRIBUTES,
    fips: str = "FIPS_Code",
) -> tuple[tuple[str, str], ...]:
    """The attributes that become columns: the fixed ones, and those of
    the ``optional`` ones that a state-level row has.  At most as many names as
    there are optional attributes reach the driver."""
    names = [a for a, _ in optional]
    found = unemployment.filter(is_state_fips(fips) & F.col("Attribute").isin(names)).select("Attribute").distinct().collect()
    seen = {r["Attribute"] for r in found}
    return (*fixed, *[(a, out) for a, out in optional if a in seen])


def state_economics(
    unemployment: DataFrame,
    poverty: DataFrame,
    unemployment_attributes: Sequence[tuple[str, str]] = UNEMPLOYMENT_ATTRIBUTES,
    poverty_attributes: Sequence[tuple[str, str]] = POVERTY_ATTRIBUTES,
    fips: str = "FIPS_Code",
    pos: str = "pos",
) -> DataFrame:
    """One row per state found at state level in either file.

    * keeps FIPS codes ending in ``000`` except the national ``00000``
      (after zero-padding to five digits);
    * each attribute takes the value of its last row (file order ``pos``),
      even when that value does not parse;
    * ``state_name`` is the last area name, the poverty file winning;
    * attributes never seen stay NULL; :func:`attributes_present` tells which
      optional ones to pass.

    ``pos`` numbers the lines of a source file in order (see
    ``sources.files.with_file_order``).
    """
    rows = _state_rows(unemployment, "State", 0, fips, pos).unionByName(
        _state_rows(poverty, "Stabr", 1, fips, pos)
    )
    values = {out: _last_value(a, 0) for a, out in unemployment_attributes}
    values |= {out: _last_value(a, 1) for a, out in poverty_attributes}
    wide = rows.groupBy("state").agg(
        F.max("file").alias("file"),
        F.max(F.when(F.col("file") == 0, F.col("pos"))).alias("last_0"),
        F.max(F.when(F.col("file") == 1, F.col("pos"))).alias("last_1"),
        *[c.alias(out) for out, c in values.items()],
    ).withColumn("pos", F.coalesce("last_1", "last_0"))
    named = rows.select("state", "file", "pos", F.col("area").alias("state_name"))
    same = [wide[c].eqNullSafe(named[c]) for c in ("state", "file", "pos")]
    return wide.join(named, same).select(wide.state, "state_name", *values).orderBy("state")


def grade_share_columns(grades: Sequence[str] = GRADES) -> list[str]:
    return [f"share_grade_{g}" for g in grades]


def state_loan_features(loans: DataFrame, grades: Sequence[str] = GRADES) -> DataFrame:
    """Per-state count, rate, mean interest / FICO (non-NULL only) and
    grade shares over *all* loans of the state (unlisted grades stay in the
    denominator).  Every value is rounded to 4 dp; means are exact.

    Levels: loans are counted per raw (state, grade, int_rate) combination and
    exponent slice of the FICO midpoint -- a set bounded by the domain, not by
    the number of loans -- so the interest text is parsed once per combination,
    while the midpoint (two near-unique numbers per loan) is parsed per row and
    its limbs added.  The second level adds value x count of the interest by
    state and slices, the third joins the slices of a state.
    """
    raw = ["addr_state", "grade", "int_rate"]
    rows = with_limbs(finalized(loans).withColumn("fico", fico_midpoint()), {"fico": "fico"})
    level1 = rows.groupBy(*raw, "fico_slice").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("default_flag").alias("d"),
        *limb_sums("fico"),
        F.count("fico").alias("fico_n"),
    )
    parsed = level1.withColumns({"state": unknown_if_blank("addr_state"), "grade": unknown_if_blank("grade"), "interest": percent_float("int_rate")})
    level2 = with_limbs(parsed, {"interest": "interest"}).groupBy("state", "interest_slice", "fico_slice").agg(
        F.sum("n").alias("n"),
        F.sum("d").alias("d"),
        *limb_sums("interest", "n"),
        weighted_count("interest", "n").alias("interest_n"),
        *limb_sums("fico"),
        F.sum("fico_n").alias("fico_n"),
        *[F.sum(F.when(F.col("grade") == F.lit(g), F.col("n")).otherwise(F.lit(0))).alias(f"n_grade_{g}")
          for g in grades],
    )
    sums = ("interest_n", "fico_n", *[f"n_grade_{g}" for g in grades])
    agg = level2.groupBy("state").agg(
        F.sum("n").alias("loan_count"),
        F.sum("d").alias("default_count"),
        *gathered("interest"),
        *gathered("fico"),
        *[F.sum(c).alias(c) for c in sums],
    )
    return agg.select(
        "state",
        F.col("loan_count").cast("bigint").alias("loan_count"),
        round_exact(ratio("default_count", "loan_count"), 4).alias("default_rate"),
        round_exact(ratio(total("interest"), "interest_n"), 4).alias("avg_interest_rate"),
        round_exact(ratio(total("fico"), "fico_n"), 4).alias("avg_fico"),
        *[round_exact(ratio(f"n_grade_{g}", "loan_count"), 4).alias(f"share_grade_{g}") for g in grades],
    )


# The two regressions of the control analysis: residual name -> control.
CONTROLS = (
    ("default_residual_after_avg_interest", "avg_interest_rate"),
    ("default_residual_after_avg_fico", "avg_fico"),
)


def with_residuals(df: DataFrame, target: str = "default_rate", controls=CONTROLS) -> DataFrame:
    """A13 + A15 + J6: residual of ``target`` after a simple OLS on each control.

    ``df`` is the control table, one row per state, so the regression is a
    window aggregate over that bounded table (the loan rows are never
    involved, and the upstream plan is not re-run as a subquery would).
    Fewer than two pairs give (0, 0); a constant control gives slope 0 and
    intercept mean(y).  Residuals are NULL when the control or the target is
    NULL; 4 dp.
    """
    whole = Window.partitionBy()
    y = F.col(target)
    fits = {}
    for i, (_, x) in enumerate(controls):
        a, b = ols(target, x, over=whole)
        fits[f"__a{i}"], fits[f"__b{i}"] = a, b
    out = df.withColumns(fits)
    raw = {}
    for i, (name, x) in enumerate(controls):
        xc = F.col(x)
        fitted = F.col(f"__a{i}") + F.col(f"__b{i}") * xc
        raw[f"__{name}"] = F.when(xc.isNotNull() & y.isNotNull(), y - fitted)
    out = out.withColumns(raw)
    out = out.withColumns({name: round_exact(f"__{name}", 4) for name, _ in controls})
    return out.drop(*fits, *raw)


def state_control(
    loans: DataFrame,
    economics: DataFrame,
    min_loans: int = DEFAULT_MIN_LOANS,
    features: DataFrame | None = None,
) -> DataFrame:
    """State control table: loan features x economics for states with at least
    ``min_loans`` finalized loans (J5), plus the two regression residuals.
    ``features``: stored :func:`state_loan_features`, if there are any."""
    features = (state_loan_features(loans) if features is None else features).filter(F.col("loan_count") >= F.lit(min_loans))
    joined = features.join(economics, on="state", how="inner")
    return with_residuals(joined).orderBy("state")
