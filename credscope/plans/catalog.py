"""Registered queries over the driver tables and their DuckDB oracle SQL.

Every query reads the driver tables in full (through the fixture views of
:mod:`credscope.sources.fixtures`) and runs one or more library operators.
``QUERIES[name](spark, sf_dir)`` returns a lazy DataFrame; ``ORACLE[name]``
is the equivalent DuckDB SQL over the same tables.  Column names match.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import oracle as O
from ..functions import values as V
from ..operators import rates
from ..session import ensure_checkpoint_dir
from ..sources import files, fixtures

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Group-size thresholds of the registered queries.  The state table uses
# 1500 (not the published 1000) so that the HAVING clause splits the 25
# fixture states at sf0.01; the other thresholds are the published ones.
STATE_MIN_LOANS = 1500
PURPOSE_MIN_LOANS = V.DEFAULT_MIN_LOANS


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ------------------------------------------------------------- SQL fragments

def _key_sql(name: str) -> str:
    """SQL twin of the key expression of a profile dimension."""
    return {
        "grade": O.unknown_if_blank("grade"),
        "issue_year": O.issue_year("issue_d"),
        "issue_month": O.issue_month("issue_d"),
        "state": O.unknown_if_blank("addr_state"),
        "interest_bin": O.bin_label(O.percent_float("int_rate"), V.INTEREST),
        "income_bin": O.bin_label(O.percent_float("annual_inc"), V.INCOME),
        "dti_bin": O.bin_label(O.percent_float("dti"), V.DTI),
        "fico_bin": O.bin_label(
            f"(({O.percent_float('fico_range_low')} + {O.percent_float('fico_range_high')}) / 2.0)", V.FICO
        ),
        "purpose": O.unknown_if_blank("purpose"),
        "home_ownership": O.unknown_if_blank("home_ownership"),
        "term": O.stripped_unknown("term"),
        "verification_status": O.unknown_if_blank("verification_status"),
        "emp_length": O.unknown_if_blank("emp_length"),
        "loan_amount_bin": O.bin_label(O.percent_float("loan_amnt"), V.LOAN_AMOUNT),
        "issue_quarter": O.issue_quarter("issue_d"),
    }[name]


FINAL_LOANS_SQL = f"SELECT *, {O.outcome_flag('loan_status')} AS default_flag FROM loans WHERE {O.is_finalized('loan_status')}"


def rates_sql(keys: dict[str, str], min_loans: int = 0, source: str = "final_loans", where: str = "") -> str:
    """Body of a default-rate table over ``final_loans`` (no WITH prefix)."""
    sel = ", ".join(f"{expr} AS {name}" for name, expr in keys.items())
    names = ", ".join(keys)
    having = f"HAVING count(*) >= {min_loans}" if min_loans > 0 else ""
    return f"""
SELECT {names}, loan_count, default_count, {O.r4(O.ratio('default_count', 'loan_count'))} AS default_rate
FROM (
  SELECT {names}, CAST(count(*) AS BIGINT) AS loan_count, CAST(sum(default_flag) AS BIGINT) AS default_count
  FROM (SELECT {sel}, default_flag FROM {source}) k
  {where}
  GROUP BY {names} {having}
) g"""


def loan_rates_sql(keys: dict[str, str], min_loans: int = 0, where: str = "") -> str:
    return O.with_views(rates_sql(keys, min_loans, where=where), "loans", extra=[("final_loans", FINAL_LOANS_SQL)])


# ------------------------------------------------------------- A1: 14 tables

_PROFILE_QUERY_NAMES = {
    "grade": "rate_by_grade",
    "issue_year": "rate_by_year",
    "issue_month": "rate_by_month",
    "state": "rate_by_state_min",
    "interest_bin": "rate_by_interest_bin",
    "income_bin": "rate_by_income_bin",
    "dti_bin": "rate_by_dti_bin",
    "fico_bin": "rate_by_fico_bin",
    "purpose": "rate_by_purpose_min",
    "home_ownership": "rate_by_home",
    "term": "rate_by_term",
    "verification_status": "rate_by_verification",
    "emp_length": "rate_by_emp_length",
    "loan_amount_bin": "rate_by_amount_bin",
}
PROFILE_MIN_LOANS = {"state": STATE_MIN_LOANS, "purpose": PURPOSE_MIN_LOANS}


def _profile_query(dim: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rates.rate_by(fixtures.loans(spark, sf_dir), dim, PROFILE_MIN_LOANS.get(dim, 0))
    run.__name__ = _PROFILE_QUERY_NAMES[dim]
    return run


for _dim, _qname in _PROFILE_QUERY_NAMES.items():
    register(_qname, loan_rates_sql({_dim: _key_sql(_dim)}, PROFILE_MIN_LOANS.get(_dim, 0)))(_profile_query(_dim))


# ------------------------------------------------------------- A3: quarter

@register(
    "rate_by_quarter",
    loan_rates_sql({"issue_quarter": _key_sql("issue_quarter")}, where="WHERE issue_quarter IS NOT NULL"),
)
def rate_by_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.rate_by_quarter(fixtures.loans(spark, sf_dir))


# ------------------------------------------------------------- shared scan

def _profile_all_sql() -> str:
    parts = []
    for dim in rates.DIMENSIONS:
        body = rates_sql({"label": _key_sql(dim)}, PROFILE_MIN_LOANS.get(dim, 0))
        parts.append(f"SELECT {O.q(dim)} AS dimension, label, loan_count, default_count, default_rate FROM ({body}) t")
    return O.with_views("\nUNION ALL\n".join(parts), "loans", extra=[("final_loans", FINAL_LOANS_SQL)])


@register("rate_profile_all", _profile_all_sql())
def rate_profile_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fourteen single-key tables from one scan of the loans (long form)."""
    return rates.rate_profile(fixtures.loans(spark, sf_dir), min_loans=PROFILE_MIN_LOANS)


# ------------------------------------------------------------- A2: segments

# Published threshold (1000) except state x grade: 200 groups of ~190 loans
# at sf0.01 would leave that table empty, so it uses 150.
SEGMENT_MIN_LOANS = {
    "grade_term": V.DEFAULT_MIN_LOANS,
    "grade_purpose": V.DEFAULT_MIN_LOANS,
    "interest_fico": V.DEFAULT_MIN_LOANS,
    "state_grade": 150,
    "home_term": V.DEFAULT_MIN_LOANS,
}


def _segment_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rates.segment(fixtures.loans(spark, sf_dir), name, SEGMENT_MIN_LOANS[name])
    run.__name__ = f"segment_{name}"
    return run


for _seg, (_k1, _k2) in rates.SEGMENTS.items():
    register(
        f"segment_{_seg}",
        loan_rates_sql({_k1: _key_sql(_k1), _k2: _key_sql(_k2)}, SEGMENT_MIN_LOANS[_seg]),
    )(_segment_query(_seg))


# ------------------------------------------------------------- A4-A7: profiles

from ..operators import profile  # noqa: E402

SOURCE_NAME = "lineitem.parquet"


@register(
    "status_distribution",
    O.with_views(
        "SELECT COALESCE(loan_status, '') AS loan_status, CAST(count(*) AS BIGINT) AS count FROM loans GROUP BY 1",
        "loans",
    ),
)
def status_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.status_distribution(fixtures.loans(spark, sf_dir))


def _overview_sql() -> str:
    flag = O.outcome_flag("loan_status")
    rate = f"CASE WHEN usable > 0 THEN CAST({O.r4(O.ratio('defaults', 'usable'))} AS VARCHAR) ELSE '0' END"
    n_cols = len(fixtures.LOAN_COLUMNS)
    body = f"""
SELECT m.metric, m.value FROM (
  SELECT count(*) AS all_rows, count({flag}) AS usable, sum({flag}) AS defaults FROM loans
) a, LATERAL (VALUES
  ('source_file', {O.q(SOURCE_NAME)}),
  ('all_rows', CAST(a.all_rows AS VARCHAR)),
  ('usable_finalized_rows', CAST(a.usable AS VARCHAR)),
  ('skipped_non_final_rows', CAST(a.all_rows - a.usable AS VARCHAR)),
  ('columns', '{n_cols}'),
  ('overall_default_rate', {rate})
) m(metric, value)"""
    return O.with_views(body, "loans")


@register("overview_metrics", _overview_sql())
def overview_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.overview(fixtures.loans(spark, sf_dir), SOURCE_NAME)


def _missing_sql() -> str:
    parts = [
        f"SELECT {i} AS ordinal, {O.q(c)} AS \"column\", "
        f"CAST(sum(CASE WHEN {c} IS NULL OR {c} = '' THEN 1 ELSE 0 END) AS BIGINT) AS missing_count, "
        f"count(*) AS all_rows FROM loans"
        for i, c in enumerate(fixtures.LOAN_COLUMNS)
    ]
    body = f"""
SELECT "column", {O.r4(O.ratio('missing_count', 'all_rows'))} AS missing_rate, missing_count
FROM ({' UNION ALL '.join(parts)}) t
WHERE missing_count > 0
ORDER BY missing_count DESC, ordinal
LIMIT {V.MISSING_TOP}"""
    return O.with_views(body, "loans")


@register("missing_profile_top", _missing_sql())
def missing_profile_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.missing_profile(fixtures.loans(spark, sf_dir), V.MISSING_TOP)


# ------------------------------------------------------------- A10/A11, J1/J2, A16

from ..operators import fusion, macro  # noqa: E402

_MACRO_SERIES = (("FEDFUNDS", "avg_fed_funds_rate"), ("UNRATE", "avg_unemployment_rate"), ("CPIAUCSL", "avg_cpi"))


def _obs_quarter_sql(c: str) -> str:
    m = f"TRY_CAST(split_part({c}, '-', 2) AS INTEGER)"
    ok = f"(len(string_split({c}, '-')) = 3 AND {m} BETWEEN 1 AND 12)"
    return f"(CASE WHEN {ok} THEN split_part({c}, '-', 1) || '-Q' || CAST(({m} - 1) // 3 + 1 AS VARCHAR) END)"


def _macro_body(period_sql: str, period: str, inflation: str) -> str:
    parsed = ", ".join(f"{O.plain_float(s)} AS {s}" for s, _ in _MACRO_SERIES)
    means = ", ".join(f"{O.exact_mean(s)} AS {o}, count({s}) AS n_{s}" for s, o in _MACRO_SERIES)
    kept = " AND ".join(f"n_{s} > 0" for s, _ in _MACRO_SERIES)
    outs = ", ".join(f"{O.r4(o)} AS {o}" for _, o in _MACRO_SERIES)
    infl = "CASE WHEN prev IS NOT NULL AND prev <> 0 THEN (avg_cpi / prev - 1) * 100 END"
    return f"""
SELECT {period}, {outs}, {O.r4(infl)} AS {inflation}
FROM (
  SELECT *, lag(avg_cpi) OVER (ORDER BY {period}) AS prev
  FROM (
    SELECT {period}, {means}
    FROM (SELECT {period_sql} AS {period}, {parsed} FROM macro_monthly) p
    WHERE {period} IS NOT NULL
    GROUP BY {period}
  ) a WHERE {kept}
) l"""


ANNUAL_MACRO_SQL = _macro_body("substr(observation_date, 1, 4)", "issue_year", "cpi_inflation_rate")
QUARTERLY_MACRO_SQL = _macro_body(_obs_quarter_sql("observation_date"), "issue_quarter", "quarterly_cpi_inflation_rate")


@register("macro_annual", O.with_views(ANNUAL_MACRO_SQL, "macro_monthly"))
def macro_annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return macro.annual_macro(fixtures.macro_monthly(spark, sf_dir))


@register("macro_quarterly", O.with_views(QUARTERLY_MACRO_SQL, "macro_monthly"))
def macro_quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return macro.quarterly_macro(fixtures.macro_monthly(spark, sf_dir))


YEAR_RATES_SQL = rates_sql({"issue_year": _key_sql("issue_year")})
QUARTER_RATES_SQL = rates_sql({"issue_quarter": _key_sql("issue_quarter")}, where="WHERE issue_quarter IS NOT NULL")


def _macro_ctes(kind: str) -> list[tuple[str, str]]:
    ctes = [("final_loans", FINAL_LOANS_SQL)]
    if kind == "year":
        ctes += [("lc_rates", YEAR_RATES_SQL), ("period_macro", ANNUAL_MACRO_SQL)]
    else:
        ctes += [("lc_rates", QUARTER_RATES_SQL), ("period_macro", QUARTERLY_MACRO_SQL)]
    ctes.append((
        "merged",
        "SELECT * FROM lc_rates JOIN period_macro USING ({k}) WHERE {k} <> 'Unknown'".format(
            k="issue_year" if kind == "year" else "issue_quarter"
        ),
    ))
    return ctes


def year_macro_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = fixtures.loans(spark, sf_dir)
    return fusion.rate_with_period_macro(
        rates.rate_by(loans, "issue_year", 0), macro.annual_macro(fixtures.macro_monthly(spark, sf_dir)), "issue_year"
    )


def quarter_macro_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = fixtures.loans(spark, sf_dir)
    return fusion.rate_with_period_macro(
        rates.rate_by_quarter(loans), macro.quarterly_macro(fixtures.macro_monthly(spark, sf_dir)), "issue_quarter"
    )


@register("rate_macro_year", O.with_views("SELECT * FROM merged", "loans", "macro_monthly", extra=_macro_ctes("year")))
def rate_macro_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return year_macro_df(spark, sf_dir)


@register("rate_macro_quarter", O.with_views("SELECT * FROM merged", "loans", "macro_monthly", extra=_macro_ctes("quarter")))
def rate_macro_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarter_macro_df(spark, sf_dir)


YEAR_CORR_FEATURES = V.ANNUAL_MACRO_FEATURES
QUARTER_CORR_FEATURES = V.QUARTERLY_MACRO_FEATURES


def corr_sql(features, target: str, label: str, value: str, source: str = "merged") -> str:
    parts = [
        f"SELECT {i} AS ord, {O.q(f)} AS {label}, {O.r4(O.pearson(f, target))} AS {value} FROM {source}"
        for i, f in enumerate(features)
    ]
    return f"SELECT {label}, {value} FROM ({' UNION ALL '.join(parts)}) c"


@register(
    "corr_macro_year",
    O.with_views(corr_sql(YEAR_CORR_FEATURES, "default_rate", "macro_variable", "correlation_with_default_rate"),
                 "loans", "macro_monthly", extra=_macro_ctes("year")),
)
def corr_macro_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fusion.correlation_table(
        year_macro_df(spark, sf_dir), YEAR_CORR_FEATURES, "default_rate",
        "macro_variable", "correlation_with_default_rate",
    )


@register(
    "corr_macro_quarter",
    O.with_views(corr_sql(QUARTER_CORR_FEATURES, "default_rate", "macro_variable", "correlation_with_quarterly_default_rate"),
                 "loans", "macro_monthly", extra=_macro_ctes("quarter")),
)
def corr_macro_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fusion.correlation_table(
        quarter_macro_df(spark, sf_dir), QUARTER_CORR_FEATURES, "default_rate",
        "macro_variable", "correlation_with_quarterly_default_rate",
    )


# ------------------------------------------------------------- A9/J4, J3, A17, A8/J5/A13/A15/J6, A18

from ..operators import states  # noqa: E402

CONTROL_MIN_LOANS = STATE_MIN_LOANS


def _state_fips_sql(c: str) -> str:
    padded = f"lpad({c}, CAST(greatest(length({c}), 5) AS INTEGER), '0')"
    return f"(suffix({padded}, '000') AND {padded} <> '00000')"


def _last_sql(attr: str) -> str:
    return (f"arg_max_null(CASE WHEN attribute = {O.q(attr)} THEN value END, "
            f"CASE WHEN attribute = {O.q(attr)} THEN pos END)")


def _econ_sql() -> str:
    u_cols = ", ".join(f"{_last_sql(a)} AS {o}" for a, o in V.UNEMPLOYMENT_ATTRIBUTES)
    p_cols = ", ".join(f"{_last_sql(a)} AS {o}" for a, o in V.POVERTY_ATTRIBUTES)
    u_out = ", ".join(f"ua.{o}" for _, o in V.UNEMPLOYMENT_ATTRIBUTES)
    p_out = ", ".join(f"pa.{o}" for _, o in V.POVERTY_ATTRIBUTES)
    return f"""
SELECT COALESCE(ua.state, pa.state) AS state, COALESCE(pa.area, ua.area) AS state_name, {u_out}, {p_out}
FROM (
  SELECT state, arg_max_null(area, pos) AS area, {u_cols}
  FROM (SELECT State AS state, Area_Name AS area, Attribute AS attribute, {O.thousands_float('Value')} AS value, pos
        FROM state_unemployment WHERE {_state_fips_sql('FIPS_Code')}) u
  GROUP BY state
) ua FULL OUTER JOIN (
  SELECT state, arg_max_null(area, pos) AS area, {p_cols}
  FROM (SELECT Stabr AS state, Area_Name AS area, Attribute AS attribute, {O.thousands_float('Value')} AS value, pos
        FROM state_poverty WHERE {_state_fips_sql('FIPS_Code')}) p
  GROUP BY state
) pa ON ua.state = pa.state"""


ECON_SQL = _econ_sql()
STATE_VIEWS = ("loans", "state_unemployment", "state_poverty")


def economics_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.state_economics(fixtures.state_unemployment(spark, sf_dir), fixtures.state_poverty(spark, sf_dir))


@register("state_economics", O.with_views(ECON_SQL, "state_unemployment", "state_poverty"))
def state_economics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return economics_df(spark, sf_dir)


STATE_RATES_SQL = rates_sql({"state": _key_sql("state")}, STATE_MIN_LOANS)


def _state_rate_ctes() -> list[tuple[str, str]]:
    return [("final_loans", FINAL_LOANS_SQL), ("econ", ECON_SQL), ("lc_state", STATE_RATES_SQL),
            ("merged", "SELECT * FROM lc_state JOIN econ USING (state)")]


def state_rate_economics_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    state_rates = rates.rate_by(fixtures.loans(spark, sf_dir), "state", STATE_MIN_LOANS)
    return fusion.attach(state_rates, economics_df(spark, sf_dir), "state").orderBy(
        F.desc("default_rate"), F.desc("loan_count"), "state"
    )


@register("state_rate_economics", O.with_views("SELECT * FROM merged", *STATE_VIEWS, extra=_state_rate_ctes()))
def state_rate_economics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_rate_economics_df(spark, sf_dir)


STATE_CORR_FEATURES = V.STATE_FEATURES


@register(
    "corr_state_economics",
    O.with_views(corr_sql(STATE_CORR_FEATURES, "default_rate", "state_feature", "correlation_with_state_default_rate"),
                 *STATE_VIEWS, extra=_state_rate_ctes()),
)
def corr_state_economics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fusion.correlation_table(
        state_rate_economics_df(spark, sf_dir), STATE_CORR_FEATURES, "default_rate",
        "state_feature", "correlation_with_state_default_rate",
    )


def _control_sql() -> str:
    grade_counts = ", ".join(f"count(CASE WHEN grade = {O.q(g)} THEN 1 END) AS n_grade_{g}" for g in V.GRADES)
    shares = ", ".join(f"{O.r4(O.ratio(f'n_grade_{g}', 'loan_count'))} AS share_grade_{g}" for g in V.GRADES)
    econ_cols = ", ".join(["e.state_name"] + [f"e.{c}" for c in states.ECONOMIC_COLUMNS])
    fico = f"(({O.percent_float('fico_range_low')} + {O.percent_float('fico_range_high')}) / 2.0)"
    feat = f"""
SELECT state, count(*) AS loan_count, sum(default_flag) AS default_count,
       {O.exact_mean('interest')} AS ai, {O.exact_mean('fico')} AS af, {grade_counts}
FROM (SELECT {O.unknown_if_blank('addr_state')} AS state, default_flag, {O.percent_float('int_rate')} AS interest,
             {fico} AS fico, {O.unknown_if_blank('grade')} AS grade FROM final_loans) b
GROUP BY state"""
    ctrl = f"""
SELECT f.state, f.loan_count, {O.r4(O.ratio('default_count', 'loan_count'))} AS default_rate,
       {O.r4('ai')} AS avg_interest_rate, {O.r4('af')} AS avg_fico, {shares}, {econ_cols}
FROM feat f JOIN econ e ON f.state = e.state
WHERE f.loan_count >= {CONTROL_MIN_LOANS}"""
    fits = []
    for i, (_, x) in enumerate(states.CONTROLS):
        n = f"regr_count(default_rate, {x})"
        fits.append(f"CASE WHEN {n} < 2 THEN 0.0 ELSE COALESCE(regr_intercept(default_rate, {x}), regr_avgy(default_rate, {x})) END AS a{i}")
        fits.append(f"CASE WHEN {n} < 2 THEN 0.0 ELSE COALESCE(regr_slope(default_rate, {x}), 0.0) END AS b{i}")
    coef = f"SELECT {', '.join(fits)} FROM ctrl"
    resid = ", ".join(
        f"{O.r4(f'CASE WHEN {x} IS NOT NULL AND default_rate IS NOT NULL THEN default_rate - (a{i} + b{i} * {x}) END')} AS {name}"
        for i, (name, x) in enumerate(states.CONTROLS)
    )
    body = f"SELECT ctrl.*, {resid} FROM ctrl, coef"
    return [("final_loans", FINAL_LOANS_SQL), ("econ", ECON_SQL), ("feat", feat), ("ctrl", ctrl),
            ("coef", coef), ("control", body)]


CONTROL_CTES = _control_sql()


def control_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.state_control(fixtures.loans(spark, sf_dir), economics_df(spark, sf_dir), CONTROL_MIN_LOANS)


@register("state_control_features", O.with_views("SELECT * FROM control", *STATE_VIEWS, extra=CONTROL_CTES))
def state_control_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control_df(spark, sf_dir)


def _matrix_sql() -> str:
    parts = []
    i = 0
    for t in V.CONTROL_TARGETS:
        for f in V.CONTROL_FEATURES:
            parts.append(f"SELECT {i} AS ord, {O.q(t)} AS target, {O.q(f)} AS feature, {O.r4(O.pearson(f, t))} AS correlation FROM control")
            i += 1
    return f"SELECT target, feature, correlation FROM ({' UNION ALL '.join(parts)}) m"


@register("corr_state_control", O.with_views(_matrix_sql(), *STATE_VIEWS, extra=CONTROL_CTES))
def corr_state_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fusion.correlation_matrix(control_df(spark, sf_dir), V.CONTROL_TARGETS, V.CONTROL_FEATURES)


# ------------------------------------------------------------- C1-C5

from ..operators import charts  # noqa: E402


def _pct_sql(v: str) -> str:
    return f"(printf('%.1f', {O.r4(f'{O.dbl(v)} * 100.0', 1)}) || '%')"


def _value_text_sql(v: str) -> str:
    return f"(CASE WHEN {v} <= 1 THEN {_pct_sql(v)} ELSE printf('%.0f', {O.r4(v, 0)}) END)"


def _scaled_sql(v: str, lo: str, hi: str) -> str:
    return O.r4(f"({v} - {lo}) / greatest({hi} - {lo}, {V.SCALE_SPAN_FLOOR})")


def _tick_sql(pos: str, n: str) -> str:
    return f"({pos} % greatest(floor({n} / {V.TICK_TARGET}), 1) = 0)"


GRADE_RATES_SQL = rates_sql({"grade": _key_sql("grade")})


@register(
    "chart_bar",
    O.with_views(
        f"""
SELECT grade AS label, substr(grade, 1, {V.BAR_LABEL_WIDTH}) AS label_text, default_rate AS value,
       {O.r4('CASE WHEN vmax <> 0 THEN default_rate / vmax ELSE 0.0 END')} AS scaled,
       {_value_text_sql('default_rate')} AS value_label
FROM t, (SELECT max(default_rate) AS vmax FROM t) s""",
        "loans", extra=[("final_loans", FINAL_LOANS_SQL), ("t", GRADE_RATES_SQL)],
    ),
)
def chart_bar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 over the grade table."""
    return charts.bar_dataset(rates.rate_by(fixtures.loans(spark, sf_dir), "grade"), "grade")


@register(
    "chart_line",
    O.with_views(
        f"""
SELECT CAST(row_number() OVER (ORDER BY issue_year) - 1 AS BIGINT) AS position, issue_year AS label,
       default_rate AS value, {_scaled_sql('default_rate', 'lo', 'hi')} AS scaled,
       {_tick_sql('(row_number() OVER (ORDER BY issue_year) - 1)', 'n')} AS tick
FROM t, (SELECT min(default_rate) AS lo, max(default_rate) AS hi, count(*) AS n FROM t) s""",
        "loans",
        extra=[("final_loans", FINAL_LOANS_SQL),
               ("t", f"SELECT * FROM ({YEAR_RATES_SQL}) y WHERE issue_year <> 'Unknown'")],
    ),
)
def chart_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 over the yearly rates (``Unknown`` excluded)."""
    return charts.line_dataset(rates.rate_by(fixtures.loans(spark, sf_dir), "issue_year"), "issue_year")


def _overlay_sql() -> str:
    long = " UNION ALL ".join(
        f"SELECT issue_year AS label, {O.q(name)} AS series, {O.dbl(c)} * {m} AS value FROM merged"
        for name, c, m in charts.OVERLAY_SERIES
    )
    return f"""
SELECT p.position, l.label, l.series, {O.r4('l.value')} AS value, {_scaled_sql('l.value', 's.lo', 's.hi')} AS scaled,
       {_tick_sql('p.position', 'p.n')} AS tick
FROM ({long}) l
JOIN (SELECT issue_year AS label, CAST(row_number() OVER (ORDER BY issue_year) - 1 AS BIGINT) AS position,
             count(*) OVER () AS n FROM merged) p ON l.label = p.label,
     (SELECT min(value) AS lo, max(value) AS hi FROM ({long}) a) s"""


@register("chart_overlay", O.with_views(_overlay_sql(), "loans", "macro_monthly", extra=_macro_ctes("year")))
def chart_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 over the yearly rate x macro rows."""
    return charts.overlay_dataset(year_macro_df(spark, sf_dir), "issue_year")


def _scatter_sql(source: str, x: str, y: str, ties: bool) -> str:
    rank = "rank() OVER (ORDER BY y DESC)" if ties else "row_number() OVER (ORDER BY y DESC, label)"
    return f"""
SELECT label, x, y, {_scaled_sql('x', 'x_lo', 'x_hi')} AS x_scaled, {_scaled_sql('y', 'y_lo', 'y_hi')} AS y_scaled,
       ({rank} <= {V.TOP_SCATTER_LABELS}) AS labelled
FROM (SELECT state AS label, {x} AS x, {y} AS y FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL) p,
     (SELECT min({x}) AS x_lo, max({x}) AS x_hi, min({y}) AS y_lo, max({y}) AS y_hi
      FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL) s"""


@register(
    "chart_scatter_top5",
    O.with_views(_scatter_sql("control", "ers_poverty_rate_2023", "default_residual_after_avg_interest", False),
                 *STATE_VIEWS, extra=CONTROL_CTES),
)
def chart_scatter_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 + W2: residual after interest vs poverty, top 5 by position."""
    return charts.scatter_dataset(control_df(spark, sf_dir), "ers_poverty_rate_2023", "default_residual_after_avg_interest")


@register(
    "chart_scatter_ties",
    O.with_views(_scatter_sql("merged", "ers_poverty_rate_2023", "default_rate", True),
                 *STATE_VIEWS, extra=_state_rate_ctes()),
)
def chart_scatter_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 + W3: state default rate vs poverty, top 5 with ties."""
    return charts.scatter_dataset(state_rate_economics_df(spark, sf_dir), "ers_poverty_rate_2023", "default_rate", ties=True)


def _segment_bars_sql(name: str) -> str:
    k1, k2 = rates.SEGMENTS[name]
    order = f"default_rate DESC, loan_count DESC, {k1}, {k2}"
    seg = rates_sql({k1: _key_sql(k1), k2: _key_sql(k2)}, SEGMENT_MIN_LOANS[name])
    body = f"""
SELECT CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS rank,
       substr({k1} || ' / ' || {k2}, 1, {V.SEGMENT_LABEL_WIDTH}) AS label, default_rate, loan_count,
       {O.r4('CASE WHEN vmax <> 0 THEN default_rate / vmax ELSE 0.0 END')} AS scaled,
       {_pct_sql('default_rate')} || ' (' || CAST(loan_count AS VARCHAR) || ')' AS value_label
FROM head, (SELECT max(default_rate) AS vmax FROM head) s"""
    return O.with_views(body, "loans", extra=[
        ("final_loans", FINAL_LOANS_SQL), ("seg", seg),
        ("head", f"SELECT * FROM seg ORDER BY {order} LIMIT {V.TOP_SEGMENTS}"),
    ])


@register("segment_top12", _segment_bars_sql("state_grade"))
def segment_top12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5 + O9 + P23: the 12 riskiest state x grade segments."""
    seg = rates.segment(fixtures.loans(spark, sf_dir), "state_grade", SEGMENT_MIN_LOANS["state_grade"])
    return charts.segment_bars(seg, rates.SEGMENTS["state_grade"])


# ------------------------------------------------------------- A14 / O10 / J7 / A20

from ..operators import findings as FD  # noqa: E402

from ..operators.findings import FINDING_LOOKUPS, FINDING_PICKS, FINDING_SEGMENTS  # noqa: E402


def _keeper(spark: SparkSession, name: str):
    """Stores what several results of a query read, in a fresh shared folder."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    return lambda df, table="kept": files.land_parquet(df, f"{base}/{table}-{uuid.uuid4().hex}")


def published_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.published_rates(fixtures.loans(spark, sf_dir), PROFILE_MIN_LOANS, SEGMENT_MIN_LOANS)


@register("findings", None)
def findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headline facts.  All loan rate tables (14 profile tables, quarters, 5
    segments) come from one scan of the loans and are stored; statuses and
    state features scan the loans once each."""
    keep = _keeper(spark, "findings")
    loans, monthly = fixtures.loans(spark, sf_dir), fixtures.macro_monthly(spark, sf_dir)
    published = keep(published_df(spark, sf_dir))
    econ = keep(economics_df(spark, sf_dir))
    control = keep(states.state_control(loans, econ, CONTROL_MIN_LOANS))
    counts = [F.col(c) for c in rates.RATE_COLUMNS]
    profile_rows = published.filter(F.col("table").isin(*rates.DIMENSIONS)).select(
        F.col("table").alias("dimension"), F.col("key1").alias("label"), *counts)
    segs = published.filter(F.col("table").startswith("segment:")).select(
        F.substring_index("table", ":", -1).alias("segment"), "key1", "key2", *counts)
    quarters = rates.published_slice(published, "issue_quarter")
    return FD.assemble(profile_rows, segs, fusion.correlation_matrix(control, V.CONTROL_TARGETS, V.CONTROL_FEATURES), {
        "statuses": FD.outcome_totals(profile.status_distribution(loans)),
        "quarters": quarters,
        "years_macro": fusion.rate_with_period_macro(rates.published_slice(published, "issue_year"), macro.annual_macro(monthly), "issue_year"),
        "quarters_macro": fusion.rate_with_period_macro(quarters, macro.quarterly_macro(monthly), "issue_quarter"),
        "states_economics": fusion.attach(rates.published_slice(published, "state"), econ, "state"),
        "control": control,
    })


def _order_sql(dim: str, last: bool = False) -> str:
    """Published order of a profile table's rows (label, default_rate, loan_count)."""
    d = rates.DIMENSIONS[dim]
    asc, desc = ("DESC", "ASC") if last else ("ASC", "DESC")
    if d.order == "key":
        return f"ORDER BY label {asc}"
    if d.order == "rate_desc":
        return f"ORDER BY default_rate {desc}, loan_count {desc}, label {asc}"
    return f"ORDER BY {O.order_rank('label', d.order)} {asc}, label {asc}"


def _findings_sql() -> str:
    prof = []
    for dim in rates.DIMENSIONS:
        body = rates_sql({"label": _key_sql(dim)}, PROFILE_MIN_LOANS.get(dim, 0))
        prof.append(f"SELECT {O.q(dim)} AS dimension, label, loan_count, default_count, default_rate FROM ({body}) t")
    segs = []
    for s in FINDING_SEGMENTS:
        k1, k2 = rates.SEGMENTS[s]
        body = rates_sql({"key1": _key_sql(k1), "key2": _key_sql(k2)}, SEGMENT_MIN_LOANS[s])
        segs.append(f"SELECT {O.q(s)} AS segment, key1, key2, loan_count, default_count, default_rate FROM ({body}) t")
    ctes = [("final_loans", FINAL_LOANS_SQL), ("profile", " UNION ALL ".join(prof)), ("segs", " UNION ALL ".join(segs))]
    ctes += [c for c in CONTROL_CTES if c[0] != "final_loans"]
    ctes.append(("matrix", _matrix_sql()))
    ctes.append(("year_merged", f"SELECT * FROM ({YEAR_RATES_SQL}) r JOIN ({ANNUAL_MACRO_SQL}) m USING (issue_year) WHERE issue_year <> 'Unknown'"))
    ctes.append(("quarter_merged", f"SELECT * FROM ({QUARTER_RATES_SQL}) r JOIN ({QUARTERLY_MACRO_SQL}) m USING (issue_quarter)"))
    ctes.append(("state_merged", f"SELECT * FROM ({STATE_RATES_SQL}) r JOIN econ USING (state)"))

    def sel(finding, label, value, n, src, order="", where=""):
        return (f"SELECT {O.q(finding)} AS finding, CAST({label} AS VARCHAR) AS label, CAST({value} AS DOUBLE) AS value, "
                f"CAST({n} AS BIGINT) AS n FROM {src} {where} {order}")

    parts = []
    for f, d, last in FINDING_PICKS:
        parts.append(sel(f, "label", "default_rate", "loan_count", "profile", _order_sql(d, last) + " LIMIT 1",
                         f"WHERE dimension = {O.q(d)}"))
    parts.append(sel("term_highest", "label", "default_rate", "loan_count", "profile",
                     "ORDER BY default_rate DESC, label ASC LIMIT 1", "WHERE dimension = 'term'"))
    for s in FINDING_SEGMENTS:
        parts.append(sel(f"segment_{s}_top", "key1 || ' / ' || key2", "default_rate", "loan_count", "segs",
                         "ORDER BY default_rate DESC, loan_count DESC, key1, key2 LIMIT 1", f"WHERE segment = {O.q(s)}"))
    for f, t, x in FINDING_LOOKUPS:
        parts.append(sel(f, "target || ' ~ ' || feature", "correlation", "NULL", "matrix", "",
                         f"WHERE target = {O.q(t)} AND feature = {O.q(x)}"))
    flag = O.outcome_flag("loan_status")
    for f, n in (("all_rows", "count(*)"), ("usable_rows", f"count({flag})"), ("skipped_rows", f"count(*) - count({flag})"),
                 ("segment_input_rows", "count(*)"), ("segment_usable_rows", f"count({flag})")):
        parts.append(sel(f, "NULL", "NULL", n, "loans"))
    parts.append(sel("overall_default_rate", "NULL", O.r4(O.ratio(f"sum({flag})", f"count({flag})")), f"count({flag})", "loans"))
    for f, src in (("loan_quarters", f"({QUARTER_RATES_SQL}) q"), ("matched_years", "year_merged"), ("matched_quarters", "quarter_merged"),
                   ("matched_states", "state_merged"), ("control_states", "control")):
        parts.append(sel(f, "NULL", "NULL", "count(*)", src))
    for f, src, features in (("year", "year_merged", V.ANNUAL_MACRO_FEATURES), ("quarter", "quarter_merged", V.QUARTERLY_MACRO_FEATURES),
                             ("state", "state_merged", V.STATE_FEATURES)):
        for x in features:
            parts.append(sel(f"corr_{f}_{x}", O.q(f"default_rate ~ {x}"), O.r4(O.pearson(x, "default_rate")), "NULL", src))
    body = " UNION ALL ".join(f"({p})" for p in parts)
    return O.with_views(body, "loans", "macro_monthly", "state_unemployment", "state_poverty", extra=ctes)


ORACLE["findings"] = _findings_sql()



# ------------------------------------------------------------- O8: top-k bars

@register(
    "chart_top_states",
    O.with_views(
        f"""
SELECT rank, state AS label, substr(state, 1, {V.BAR_LABEL_WIDTH}) AS label_text, default_rate AS value,
       {O.r4('CASE WHEN vmax <> 0 THEN default_rate / vmax ELSE 0.0 END')} AS scaled,
       {_value_text_sql('default_rate')} AS value_label
FROM (SELECT CAST(row_number() OVER (ORDER BY default_rate DESC, loan_count DESC, state) AS BIGINT) AS rank, *
      FROM t ORDER BY default_rate DESC, loan_count DESC, state LIMIT {V.TOP_STATES}) h,
     (SELECT max(default_rate) AS vmax FROM
        (SELECT default_rate FROM t ORDER BY default_rate DESC, loan_count DESC, state LIMIT {V.TOP_STATES}) m) s""",
        "loans", extra=[("final_loans", FINAL_LOANS_SQL), ("t", STATE_RATES_SQL)],
    ),
)
def chart_top_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O8 + C1: bar dataset of the 12 highest-rate states (published order)."""
    table = rates.rate_by(fixtures.loans(spark, sf_dir), "state", STATE_MIN_LOANS)
    order = rates.rate_ordering(["state"], "rate_desc")
    return charts.bar_dataset(charts.top_rows(table, order, V.TOP_STATES), "state")


# ------------------------------------------------------------- O1-O6, O11: published orders as ranks

def _published_parts() -> list[tuple[str, str, str]]:
    """Table, body with label(s), published order of the 20 rate tables."""
    parts = [(d, rates_sql({"label": _key_sql(d)}, PROFILE_MIN_LOANS.get(d, 0)), _order_sql(d)) for d in rates.DIMENSIONS]
    return parts + [("issue_quarter", QUARTER_RATES_SQL.replace("issue_quarter", "label"), "ORDER BY label")]


def _rank_published_sql() -> str:
    rank = "CAST(row_number() OVER ({order}) AS BIGINT) AS rank"
    counts = "loan_count, default_count, default_rate"
    parts = [f"SELECT {O.q(t)} AS \"table\", label AS key1, CAST(NULL AS VARCHAR) AS key2, {counts}, {rank.format(order=order)} FROM ({body}) t"
             for t, body, order in _published_parts()]
    for s, (k1, k2) in rates.SEGMENTS.items():
        body = rates_sql({"key1": _key_sql(k1), "key2": _key_sql(k2)}, SEGMENT_MIN_LOANS[s])
        parts.append(f"SELECT {O.q('segment:' + s)}, key1, key2, {counts}, {rank.format(order='ORDER BY default_rate DESC, loan_count DESC, key1, key2')} FROM ({body}) t")
    return O.with_views(" UNION ALL ".join(f"({p})" for p in parts), "loans", extra=[("final_loans", FINAL_LOANS_SQL)])


@register("rank_published", _rank_published_sql())
def rank_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the 20 rate tables with its place in the table's published order."""
    return rates.ranked_rates(published_df(spark, sf_dir), _keeper(spark, "ranks"))


@register("rank_statuses", O.with_views(
    "SELECT COALESCE(loan_status, '') AS loan_status, CAST(count(*) AS BIGINT) AS count, "
    "CAST(row_number() OVER (ORDER BY count(*) DESC, COALESCE(loan_status, '')) AS BIGINT) AS rank FROM loans GROUP BY 1", "loans"))
def rank_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses with their place by count."""
    return ranks.ranked(profile.status_distribution(fixtures.loans(spark, sf_dir)), [F.desc("count"), F.col("loan_status")], "rank", _keeper(spark, "ranks"))


@register("rank_missing", _missing_sql().replace('SELECT "column"', 'SELECT CAST(row_number() OVER (ORDER BY missing_count DESC, ordinal) AS BIGINT) AS rank, "column"'))
def rank_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns with missing values and their place."""
    return profile.missing_ranked(fixtures.loans(spark, sf_dir), V.MISSING_TOP)


# ------------------------------------------------------------- all charts, keyed by chart

from ..operators import ranks  # noqa: E402
from . import analyses  # noqa: E402


def _bars_sql() -> str:
    of = {t: (body, order) for t, body, order in _published_parts()}
    parts = []
    for d in (*analyses.BARS, *analyses.TOP_BARS):
        body, order = of[d]
        limit = f"WHERE rank <= {analyses.TOP_BARS[d]}" if d in analyses.TOP_BARS else ""
        parts.append(f"SELECT {O.q(d)} AS chart, * FROM (SELECT CAST(row_number() OVER ({order}) AS BIGINT) AS rank, label, default_rate AS value FROM ({body}) t) r {limit}")
    body = f"""
SELECT chart, rank, label, substr(label, 1, {V.BAR_LABEL_WIDTH}) AS label_text, value,
       {O.r4('CASE WHEN vmax <> 0 THEN value / vmax ELSE 0.0 END')} AS scaled, {_value_text_sql('value')} AS value_label
FROM (SELECT *, max(value) OVER (PARTITION BY chart) AS vmax FROM long) s"""
    return O.with_views(body, "loans", extra=[("final_loans", FINAL_LOANS_SQL), ("long", " UNION ALL ".join(f"({p})" for p in parts))])


@register("chart_bars_all", _bars_sql())
def chart_bars_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six whole tables, the top states and the top purposes."""
    return analyses.bars(published_df(spark, sf_dir))


def _segment_tops_sql() -> str:
    parts = []
    for s in analyses.SEGMENT_BARS:
        k1, k2 = rates.SEGMENTS[s]
        body = rates_sql({"key1": _key_sql(k1), "key2": _key_sql(k2)}, SEGMENT_MIN_LOANS[s])
        parts.append(f"SELECT {O.q(s)} AS chart, *, CAST(row_number() OVER (ORDER BY default_rate DESC, loan_count DESC, key1, key2) AS BIGINT) AS rank FROM ({body}) t")
    body = f"""
SELECT chart, rank, substr(key1 || ' / ' || key2, 1, {V.SEGMENT_LABEL_WIDTH}) AS label, default_rate, loan_count,
       {O.r4('CASE WHEN vmax <> 0 THEN default_rate / vmax ELSE 0.0 END')} AS scaled,
       {_pct_sql('default_rate')} || ' (' || CAST(loan_count AS VARCHAR) || ')' AS value_label
FROM (SELECT *, max(default_rate) OVER (PARTITION BY chart) AS vmax FROM long WHERE rank <= {V.TOP_SEGMENTS}) s"""
    return O.with_views(body, "loans", extra=[("final_loans", FINAL_LOANS_SQL), ("long", " UNION ALL ".join(f"({p})" for p in parts))])


@register("chart_segments_all", _segment_tops_sql())
def chart_segments_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The riskiest segments of four tables."""
    return analyses.segment_tops(published_df(spark, sf_dir))


def _scatters_sql() -> str:
    parts = [f"SELECT {O.q(c)} AS chart, * FROM ({_scatter_sql('merged', x, y, True)}) p" for c, (x, y) in analyses.STATE_SCATTERS.items()]
    parts += [f"SELECT {O.q(c)} AS chart, * FROM ({_scatter_sql('control', x, y, False)}) p" for c, (x, y) in analyses.CONTROL_SCATTERS.items()]
    ctes = CONTROL_CTES + [("lc_state", STATE_RATES_SQL), ("merged", "SELECT * FROM lc_state JOIN econ USING (state)")]
    return O.with_views(" UNION ALL ".join(parts), *STATE_VIEWS, extra=ctes)


@register("chart_scatters_all", _scatters_sql())
def chart_scatters_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three state charts and the four of the control table."""
    keep = _keeper(spark, "scatters")
    econ = keep(economics_df(spark, sf_dir))
    control = keep(states.state_control(fixtures.loans(spark, sf_dir), econ, CONTROL_MIN_LOANS))
    merged = keep(fusion.attach(rates.rate_by(fixtures.loans(spark, sf_dir), "state", STATE_MIN_LOANS), econ, "state"))
    return analyses.scatters(merged, control)


def _overlays_sql() -> str:
    parts, ctes = [], [("final_loans", FINAL_LOANS_SQL)]
    for chart, kind, k, lc, pm in (("macro", "year", "issue_year", YEAR_RATES_SQL, ANNUAL_MACRO_SQL), ("quarterly", "quarter", "issue_quarter", QUARTER_RATES_SQL, QUARTERLY_MACRO_SQL)):
        ctes.append((f"m_{kind}", f"SELECT * FROM ({lc}) r JOIN ({pm}) p USING ({k}) WHERE {k} <> 'Unknown'"))
        parts += [f"SELECT {O.q(chart)} AS chart, {k} AS label, {O.q(name)} AS series, {O.dbl(c)} * {m} AS value FROM m_{kind}" for name, c, m in charts.OVERLAY_SERIES]
    body = f"""
SELECT chart, position, label, series, {O.r4('value')} AS value, {_scaled_sql('value', 'lo', 'hi')} AS scaled, {_tick_sql('position', 'n')} AS tick
FROM (SELECT *, count(DISTINCT label) OVER (PARTITION BY chart) AS n FROM (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY chart ORDER BY label) - 1 AS BIGINT) AS position,
         min(value) OVER (PARTITION BY chart) AS lo, max(value) OVER (PARTITION BY chart) AS hi FROM long) a) s"""
    return O.with_views(body, "loans", "macro_monthly", extra=[*ctes, ("long", " UNION ALL ".join(parts))])


@register("chart_overlays_all", _overlays_sql())
def chart_overlays_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default rate and macro series by year and by quarter."""
    return analyses.overlays(year_macro_df(spark, sf_dir), quarter_macro_df(spark, sf_dir))


# ------------------------------------------------------------- P16: optional attributes

_INCOME_2023 = V.OPTIONAL_UNEMPLOYMENT_ATTRIBUTES[0]
#: A file that has the optional attribute: the fixture's third one under its name.
_RENAMED = ("Civilian_labor_force_2023", _INCOME_2023[0])


def _economics_found_sql() -> str:
    renamed = O.VIEW_SQL["state_unemployment"].replace(O.q(_RENAMED[0]), O.q(_RENAMED[1]))
    u = ", ".join(f"{_last_sql(a)} AS {o}" for a, o in (*V.UNEMPLOYMENT_ATTRIBUTES, _INCOME_2023))
    sql = ECON_SQL.replace(", ".join(f"{_last_sql(a)} AS {o}" for a, o in V.UNEMPLOYMENT_ATTRIBUTES), u)
    outs = ", ".join(f"ua.{o}" for _, o in V.UNEMPLOYMENT_ATTRIBUTES)
    sql = sql.replace(outs, f"{outs}, ua.{_INCOME_2023[1]}")
    return O.with_views(sql, "state_poverty", extra=[("state_unemployment", renamed)])


@register("state_economics_found", _economics_found_sql())
def state_economics_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State economics whose columns follow from the attributes in the file."""
    unemployment = fixtures.state_unemployment(spark, sf_dir).replace({_RENAMED[0]: _RENAMED[1]}, subset=["Attribute"])
    return states.state_economics(unemployment, fixtures.state_poverty(spark, sf_dir), states.attributes_present(unemployment))
