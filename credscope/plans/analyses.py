"""The published analyses as lazy DataFrame plans, plus a runner that lands
the raw inputs once and writes every result table.

The original work ran six scripts in sequence, re-parsing the raw loan CSV
four times and passing rounded CSV tables between scripts.  Here the DAG is
DataFrame lineage: raw files are landed once as Parquet in the session's
shared checkpoint folder, every analysis reads that copy, and downstream
steps consume the upstream DataFrames *after* their rounding and HAVING
(exactly like re-reading the published tables).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import values as V
from ..operators import charts, findings, fusion, macro, profile, rates, states
from ..session import ensure_checkpoint_dir
from ..sources import files


@dataclass(frozen=True)
class Thresholds:
    """Minimum group sizes (the published analyses use 1000 throughout)."""

    state: int = V.DEFAULT_MIN_LOANS
    purpose: int = V.DEFAULT_MIN_LOANS
    segments: dict[str, int] = field(default_factory=lambda: {s: V.DEFAULT_MIN_LOANS for s in rates.SEGMENTS})
    control: int = V.DEFAULT_MIN_LOANS


#: Published table of each dimension.
RATE_TABLES = {
    "grade": "lc_default_by_grade", "issue_year": "lc_default_by_year",
    "issue_month": "lc_default_by_month", "state": "lc_default_by_state_min1000",
    "interest_bin": "lc_default_by_interest_bin", "income_bin": "lc_default_by_income_bin",
    "dti_bin": "lc_default_by_dti_bin", "fico_bin": "lc_default_by_fico_bin",
    "purpose": "lc_default_by_purpose_min1000", "home_ownership": "lc_default_by_home_ownership",
    "term": "lc_default_by_term", "verification_status": "lc_default_by_verification_status",
    "emp_length": "lc_default_by_emp_length", "loan_amount_bin": "lc_default_by_loan_amount_bin",
}
#: Bars of whole tables, and of the first rows of ordered ones.
BARS = ("grade", "interest_bin", "fico_bin", "home_ownership", "loan_amount_bin", "term")
TOP_BARS = {"state": V.TOP_STATES, "purpose": V.TOP_PURPOSES}
SEGMENT_BARS = ("grade_term", "grade_purpose", "interest_fico", "state_grade")

#: How a result that several tables read is kept: (frame, name) -> frame.
Keep = Callable[[DataFrame, str], DataFrame]


def loan_profile(loans: DataFrame, published: DataFrame, source_name: str, keep: Keep, missing: DataFrame | None = None) -> dict[str, DataFrame]:
    """Overview, status distribution, missing profile and the 14 rate tables."""
    statuses = keep(profile.status_distribution(loans), "statuses")
    out = {
        "lc_overview": profile.overview(loans, source_name, statuses=statuses),
        "lc_status_distribution": statuses.orderBy(F.desc("count"), "loan_status"),
        "lc_missing_top40": profile.missing_profile(loans, V.MISSING_TOP) if missing is None else missing,
    }
    for dim, table in RATE_TABLES.items():
        out[table] = rates.published_slice(published, dim)
    return out


def risk_segments(published: DataFrame) -> dict[str, DataFrame]:
    """The five segment tables (O5 order each)."""
    return {f"lc_segment_{name}": rates.published_slice(published, f"segment:{name}") for name in rates.SEGMENTS}


def bars(published: DataFrame) -> DataFrame:
    """The bars of six whole tables and of the first rows of two (O8), keyed
    by ``chart`` (the dimension); ``rank`` is the published order."""
    long = published.select(F.col("table").alias("chart"), F.col("key1").alias("label"), F.col("default_rate").alias("value"),
                            rates.published_key(F.col("table"), F.col("key1"), F.col("key2")).alias("key"))
    tops = charts.top_charts(long.filter(F.col("chart").isin(*TOP_BARS)), [F.col("key")], TOP_BARS)
    whole = long.filter(F.col("chart").isin(*BARS)).withColumn("rank", F.row_number().over(Window.partitionBy("chart").orderBy("key")).cast("bigint"))
    return charts.bar_datasets(whole.unionByName(tops))


def segment_tops(published: DataFrame) -> DataFrame:
    """The riskiest segments (O9) of four segment tables, keyed by ``chart``."""
    long = published.filter(F.col("table").isin(*[f"segment:{s}" for s in SEGMENT_BARS]))
    return charts.segment_bar_datasets(long.select(F.substring_index("table", ":", -1).alias("chart"), "key1", "key2", "default_rate", "loan_count"))


def year_line(published: DataFrame) -> DataFrame:
    known = rates.keep_groups(published.filter(F.col("table") == "issue_year"), F.col("key1") != V.UNKNOWN)
    return charts.line_datasets(known.select(F.col("table").alias("chart"), F.col("key1").alias("label"), F.col("default_rate").alias("value")))


def loan_charts(published: DataFrame, keep: Keep) -> dict[str, DataFrame]:
    """Bars, the year line and the segment bars of the loan tables."""
    of_bars, of_segments = keep(bars(published), "chart_bars"), keep(segment_tops(published), "chart_segments")
    out = {f"chart_{d}_bar": charts.one_chart(of_bars, d).orderBy("rank").drop("rank") for d in BARS}
    out |= {f"chart_top_{d}": charts.one_chart(of_bars, d).orderBy("rank") for d in TOP_BARS}
    out["chart_year_line"] = charts.one_chart(year_line(published), "issue_year").orderBy("position")
    out |= {f"chart_segment_{s}": charts.one_chart(of_segments, s).orderBy("rank") for s in SEGMENT_BARS}
    return out


def overlays(by_year: DataFrame, by_quarter: DataFrame) -> DataFrame:
    """Both period overlays (C3), keyed by ``chart``."""
    return charts.overlay_datasets(charts.long_charts({"macro": charts.overlay_rows(by_year, "issue_year"), "quarterly": charts.overlay_rows(by_quarter, "issue_quarter")}))


#: Scatter charts: x and y columns.
STATE_SCATTERS = {f"state_vs_{n}": (c, "default_rate") for n, c in zip(("unemployment", "income", "poverty"), V.STATE_FEATURES)}
CONTROL_SCATTERS = {
    "rate_vs_interest": ("avg_interest_rate", "default_rate"),
    "rate_vs_fico": ("avg_fico", "default_rate"),
    "residual_interest_vs_poverty": ("ers_poverty_rate_2023", "default_residual_after_avg_interest"),
    "residual_fico_vs_poverty": ("ers_poverty_rate_2023", "default_residual_after_avg_fico"),
}


def scatters(merged: DataFrame, control: DataFrame) -> DataFrame:
    """The seven scatter charts (C4), keyed by ``chart``: ties are labelled in
    those of the state table (W3), positions count in the others (W2)."""
    parts = {c: charts.scatter_rows(merged, x, y, ties=True) for c, (x, y) in STATE_SCATTERS.items()}
    parts |= {c: charts.scatter_rows(control, x, y) for c, (x, y) in CONTROL_SCATTERS.items()}
    return charts.scatter_datasets(charts.long_charts(parts))


def macro_fusion(year_rates: DataFrame, quarter_rates: DataFrame, monthly: DataFrame, keep: Keep) -> dict[str, DataFrame]:
    annual = macro.annual_macro(monthly)
    quarterly = macro.quarterly_macro(monthly)
    by_year = keep(fusion.rate_with_period_macro(year_rates, annual, "issue_year"), "years_macro").orderBy("issue_year")
    by_quarter = keep(fusion.rate_with_period_macro(quarter_rates, quarterly, "issue_quarter"), "quarters_macro").orderBy("issue_quarter")
    return {
        "fred_macro_annual": annual,
        "fred_macro_quarterly": quarterly,
        "lc_default_by_quarter": quarter_rates,
        "lc_default_by_year_with_fred_macro": by_year,
        "lc_default_by_quarter_with_fred_macro": by_quarter,
        "lc_fred_macro_correlations": fusion.correlation_table(
            by_year, V.ANNUAL_MACRO_FEATURES, "default_rate", "macro_variable", "correlation_with_default_rate"),
        "lc_fred_quarterly_correlations": fusion.correlation_table(
            by_quarter, V.QUARTERLY_MACRO_FEATURES, "default_rate", "macro_variable", "correlation_with_quarterly_default_rate"),
    }


def state_analysis(state_rates: DataFrame, economics: DataFrame, keep: Keep) -> dict[str, DataFrame]:
    merged = keep(fusion.attach(state_rates, economics, "state"), "states_economics").orderBy(F.desc("default_rate"), F.desc("loan_count"), "state")
    return {
        "ers_state_economic_features": economics,
        "lc_default_by_state_with_ers_features": merged,
        "lc_ers_state_correlations": fusion.correlation_table(
            merged, V.STATE_FEATURES, "default_rate", "state_feature", "correlation_with_state_default_rate"),
    }


def control_analysis(loans: DataFrame, economics: DataFrame, t: Thresholds, keep: Keep) -> dict[str, DataFrame]:
    features = keep(states.state_loan_features(loans), "state_features")
    control = keep(states.state_control(loans, economics, t.control, features), "state_control").orderBy("state")
    return {
        "lc_state_control_features": control,
        "lc_state_control_correlations": fusion.correlation_matrix(control, V.CONTROL_TARGETS, V.CONTROL_FEATURES),
    }


def all_tables(loans: DataFrame, monthly: DataFrame, unemployment: DataFrame, poverty: DataFrame,
               source_name: str, t: Thresholds = Thresholds(), keep: Keep = lambda df, name: df, missing: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every published table, chart dataset and the findings as one lazy DAG.

    ``keep`` stores what several tables read; with it the loans are read three
    times: rate tables, statuses, state features.  A fourth reading counts
    missing values unless ``missing`` gives their profile."""
    published = keep(rates.published_rates(loans, {"state": t.state, "purpose": t.purpose}, t.segments), "rates")
    out = loan_profile(loans, published, source_name, keep, missing)
    out.update(risk_segments(published))
    out.update(loan_charts(published, keep))
    out.update(macro_fusion(out["lc_default_by_year"], rates.published_slice(published, "issue_quarter"), monthly, keep))
    economics = states.state_economics(unemployment, poverty, states.attributes_present(unemployment))
    economics = keep(economics, "state_economics").orderBy("state")
    out.update(state_analysis(out["lc_default_by_state_min1000"], economics, keep))
    out.update(control_analysis(loans, economics, t, keep))
    merged, control = out["lc_default_by_state_with_ers_features"], out["lc_state_control_features"]
    points = keep(scatters(merged, control), "chart_scatters")
    out |= {f"chart_{c}": charts.one_chart(points, c).orderBy("label") for c in (*STATE_SCATTERS, *CONTROL_SCATTERS)}
    by_year, by_quarter = out["lc_default_by_year_with_fred_macro"], out["lc_default_by_quarter_with_fred_macro"]
    lines = keep(overlays(by_year, by_quarter), "chart_overlays")
    out |= {f"chart_{c}_overlay": charts.one_chart(lines, c).orderBy("position", "series") for c in ("macro", "quarterly")}
    counts = [F.col(c) for c in rates.RATE_COLUMNS]
    out["findings"] = findings.assemble(
        published.filter(F.col("table").isin(*rates.DIMENSIONS)).select(F.col("table").alias("dimension"), F.col("key1").alias("label"), *counts),
        published.filter(F.col("table").startswith("segment:")).select(F.substring_index("table", ":", -1).alias("segment"), "key1", "key2", *counts),
        out["lc_state_control_correlations"],
        {"statuses": findings.outcome_totals(out["lc_status_distribution"]), "quarters": out["lc_default_by_quarter"], "years_macro": by_year,
         "quarters_macro": by_quarter, "states_economics": merged, "control": control},
    )
    return out


def run_all(spark: SparkSession, loans_csv: str, macro_csv: str, unemployment_csv: str,
            poverty_csv: str, out_dir: str, t: Thresholds = Thresholds(), multiline: bool = True) -> dict[str, bool]:
    """Land the raw CSVs once (Parquet in a fresh folder of the shared
    checkpoint folder), run every analysis, write each result table as one CSV.
    Missing values are counted by the tasks that land the loans.  Returns which
    tables have rows."""
    base = os.path.join(ensure_checkpoint_dir(spark), f"run-{uuid.uuid4().hex}")
    raw = files.read_loans_csv(spark, loans_csv, multiline, field_count=True)
    landed, seen = files.land_observed(raw, f"{base}/loans", profile.missing_metrics(raw))
    loans = landed.drop(files.FIELD_COUNT)
    missing = profile.observed_missing(spark, loans.columns, seen, V.MISSING_TOP)
    monthly = files.land_parquet(files.read_macro_csv(spark, macro_csv), f"{base}/macro_monthly")
    unemployment = files.land_parquet(files.read_state_long(spark, unemployment_csv, "State"), f"{base}/unemployment")
    poverty = files.land_parquet(files.read_state_long(spark, poverty_csv, "Stabr"), f"{base}/poverty")
    tables = all_tables(loans, monthly, unemployment, poverty, os.path.basename(loans_csv), t,
                        lambda df, name: files.land_parquet(df, f"{base}/{name}"), missing)
    return {name: files.write_table(df, f"{out_dir}/{name}", single_file=True) for name, df in tables.items()}
