"""DuckDB SQL twins of the fixture views and SQL text helpers for the oracle.

The driver registers the raw Parquet tables as DuckDB views and runs the
strings returned by ``__spark_entry__.oracle_sql()``; every string starts
with the fixture views it needs as CTEs.  These definitions must stay in
lock-step with :mod:`credscope.sources.fixtures`.
"""

from __future__ import annotations

from collections.abc import Sequence

from .functions.values import (
    BAD_STATUSES,
    GOOD_STATUSES,
    MONTH_ABBREVIATIONS,
    UNKNOWN,
    BinSpec,
)


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def in_list(values: Sequence[str]) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def r4(x: str, digits: int = 4) -> str:
    """SQL twin of ``numeric.round_exact`` (Python ``round`` on doubles)."""
    v = dbl(x)
    s = f"CAST({10**digits} AS DOUBLE)"
    c = f"({v} * CAST(134217729 AS DOUBLE))"
    hi = f"({c} - ({c} - {v}))"
    lo = f"({v} - {hi})"
    p = f"({v} * {s})"
    err = f"(({hi} * {s} - {p}) + {lo} * {s})"
    fl = f"floor({p})"
    r = (
        f"(CASE WHEN {p} - {fl} <> 0.5 THEN round_even({p}, 0) "
        f"WHEN {err} > 0 THEN {fl} + 1 WHEN {err} < 0 THEN {fl} ELSE round_even({p}, 0) END)"
    )
    return (
        f"(CASE WHEN {v} IS NULL OR isnan({v}) OR abs({v}) >= 1e15 THEN {v} "
        f"WHEN {r} = 0 THEN CAST(0 AS DOUBLE) ELSE {r} / {s} END)"
    )


def ratio(num: str, den: str) -> str:
    return f"({dbl(num)} / NULLIF({dbl(den)}, 0))"


def nan_null(x: str) -> str:
    return f"(CASE WHEN isnan({x}) THEN NULL ELSE {x} END)"


def pearson(x: str, y: str) -> str:
    """Pairwise-complete Pearson r, NULL when undefined (twin of numeric.pearson)."""
    px = f"(CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN {dbl(x)} END)"
    py = f"(CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN {dbl(y)} END)"
    den = f"(stddev_pop({px}) * stddev_pop({py}))"
    return f"(covar_pop({px}, {py}) / NULLIF({den}, 0))"


def exact_mean(x: str) -> str:
    """Compensated double sum over the count: no decimal, unlike the Spark side."""
    return f"(fsum(CAST({x} AS DOUBLE)) / NULLIF(CAST(count({x}) AS DOUBLE), 0))"


# ---------------------------------------------------------------- scalar twins

def unknown_if_blank(c: str) -> str:
    return f"COALESCE(NULLIF({c}, ''), {q(UNKNOWN)})"


def stripped_unknown(c: str) -> str:
    return f"trim({unknown_if_blank(c)})"


def percent_float(c: str) -> str:
    return f"TRY_CAST(replace(trim({c}), '%', '') AS DOUBLE)"


def thousands_float(c: str) -> str:
    return f"TRY_CAST(trim(replace({c}, ',', '')) AS DOUBLE)"


def plain_float(c: str) -> str:
    return f"TRY_CAST(trim({c}) AS DOUBLE)"


def bin_label(v: str, spec: BinSpec) -> str:
    parts = [f"WHEN {v} IS NULL THEN {q(spec.unknown)}"]
    parts += [f"WHEN {v} < {u} THEN {q(lab)}" for u, lab in spec.bins[:-1]]
    return f"(CASE {' '.join(parts)} ELSE {q(spec.bins[-1][1])} END)"


def order_rank(label: str, order: Sequence[str]) -> str:
    whens = " ".join(f"WHEN {q(lab)} THEN {i}" for i, lab in enumerate(order))
    return f"(CASE {label} {whens} ELSE {len(order)} END)"


def _month_num(head: str) -> str:
    whens = " ".join(f"WHEN {q(m)} THEN {i}" for i, m in enumerate(MONTH_ABBREVIATIONS, 1))
    return f"(CASE {head} {whens} END)"


def _has_dash(c: str) -> str:
    return f"({c} IS NOT NULL AND strpos({c}, '-') > 0)"


def issue_year(c: str) -> str:
    return f"(CASE WHEN {_has_dash(c)} THEN reverse(split_part(reverse({c}), '-', 1)) ELSE {q(UNKNOWN)} END)"


def issue_month(c: str) -> str:
    head = f"split_part({c}, '-', 1)"
    tail = f"substr({c}, strpos({c}, '-') + 1)"
    mm = f"lpad(CAST({_month_num(head)} AS VARCHAR), 2, '0')"
    return f"(CASE WHEN {_has_dash(c)} THEN {tail} || '-' || COALESCE({mm}, '??') ELSE {q(UNKNOWN)} END)"


def issue_quarter(c: str) -> str:
    head = f"split_part({c}, '-', 1)"
    tail = f"substr({c}, strpos({c}, '-') + 1)"
    m = _month_num(head)
    return f"(CASE WHEN {_has_dash(c)} AND {m} IS NOT NULL THEN {tail} || '-Q' || CAST(({m} - 1) // 3 + 1 AS VARCHAR) END)"


def outcome_flag(c: str) -> str:
    return f"(CASE WHEN {c} IN {in_list(GOOD_STATUSES)} THEN 0 WHEN {c} IN {in_list(BAD_STATUSES)} THEN 1 END)"


def is_finalized(c: str) -> str:
    return f"({c} IN {in_list(GOOD_STATUSES + BAD_STATUSES)})"


# ---------------------------------------------------------------- fixture views

def _txt(x: str) -> str:
    return f"CAST(CAST({x} AS BIGINT) AS VARCHAR)"


LOANS_SQL = f"""
SELECT
  {_txt('l_orderkey')} || '-' || {_txt('l_linenumber')} AS id,
  CASE WHEN l_returnflag = 'A' THEN
         CASE WHEN l_linenumber = 7 THEN 'Does not meet the credit policy. Status:Fully Paid' ELSE 'Fully Paid' END
       WHEN l_returnflag = 'R' THEN
         CASE WHEN o_orderstatus = 'O' THEN 'Charged Off'
              WHEN o_orderstatus = 'F' THEN 'Default'
              WHEN l_linenumber = 1 THEN 'Does not meet the credit policy. Status:Charged Off'
              ELSE 'Late (31-120 days)' END
       WHEN l_linenumber = 7 THEN ''
       WHEN l_linenumber = 6 THEN 'In Grace Period'
       ELSE 'Current' END AS loan_status,
  substr('ABCDEFG', CAST(p_size % 8 + 1 AS INTEGER), 1) AS grade,
  CASE WHEN l_linestatus = 'F' THEN ' 36 months' ELSE ' 60 months' END AS term,
  CASE WHEN l_quantity = 50 THEN '.'
       WHEN l_linenumber = 3 THEN ' ' || {_txt('l_quantity')} || '% '
       ELSE {_txt('l_quantity')} || '%' END AS int_rate,
  {_txt('floor(c_acctbal * 15)')} AS annual_inc,
  CASE WHEN p_size <> 50 THEN {_txt('p_size')} END AS dti,
  CASE WHEN l_linenumber <> 6 THEN {_txt('640 + 5 * (l_partkey % 32)')} END AS fico_range_low,
  {_txt('644 + 5 * (l_partkey % 32)')} AS fico_range_high,
  lower(p_type) AS purpose,
  c_mktsegment AS home_ownership,
  o_orderstatus AS verification_status,
  CASE WHEN c_custkey % 12 = 0 THEN '< 1 year'
       WHEN c_custkey % 12 = 1 THEN '1 year'
       WHEN c_custkey % 12 <= 9 THEN {_txt('c_custkey % 12')} || ' years'
       WHEN c_custkey % 12 = 10 THEN '10+ years' END AS emp_length,
  {_txt('floor(l_extendedprice / 3)')} AS loan_amnt,
  n_name AS addr_state,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND l_linenumber = 4 THEN ''
       WHEN o_orderpriority = '1-URGENT' AND l_linenumber = 5 THEN 'Foo-1999'
       ELSE strftime(o_orderdate, '%b-%Y') END AS issue_d
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN part ON l_partkey = p_partkey
"""

MACRO_MONTHLY_SQL = f"""
SELECT ym || '-01' AS observation_date,
       CASE WHEN ym < '1995-07' OR ym = '1998-05' THEN '' ELSE {_txt('ff')} END AS FEDFUNDS,
       {_txt('ur')} AS UNRATE,
       CASE WHEN substr(ym, 1, 4) = '1999' THEN '.' ELSE {_txt('cp')} END AS CPIAUCSL
FROM (
  SELECT strftime(l_shipdate, '%Y-%m') AS ym,
         sum(CAST(round(l_discount * 100) AS BIGINT)) AS ff,
         sum(CAST(round(l_tax * 100) AS BIGINT)) AS ur,
         sum(CAST(l_quantity AS BIGINT)) AS cp
  FROM lineitem GROUP BY 1
)
"""

STATE_UNEMPLOYMENT_SQL = f"""
SELECT
  CASE WHEN c_custkey % 100 = 0 THEN '0'
       WHEN c_custkey % 20 = 0 THEN lpad({_txt('(n_nationkey + 1) * 1000')}, 5, '0')
       WHEN c_custkey % 10 = 0 THEN {_txt('(n_nationkey + 1) * 1000')}
       ELSE {_txt('(n_nationkey + 1) * 1000 + 1 + c_custkey % 997')} END AS FIPS_Code,
  n_name AS State,
  CASE WHEN c_custkey % 10 = 0 THEN 'Area of ' || n_name ELSE 'County ' || {_txt('c_custkey')} END AS Area_Name,
  CASE a.i WHEN 1 THEN 'Unemployment_rate_2023' WHEN 2 THEN 'Median_Household_Income_2022'
           ELSE 'Civilian_labor_force_2023' END AS Attribute,
  CASE a.i WHEN 1 THEN {_txt('c_custkey % 7 + 2')} || '.' || {_txt('c_custkey % 10')}
           WHEN 2 THEN format('{{:,}}', CAST(40000 + (c_custkey % 40) * 1500 AS BIGINT))
           ELSE {_txt('c_custkey * 3')} END AS Value,
  c_custkey * 10 + a.i AS pos
FROM customer JOIN nation ON c_nationkey = n_nationkey
CROSS JOIN (VALUES (1), (2), (3)) a(i)
"""

STATE_POVERTY_SQL = f"""
SELECT
  CASE WHEN s_suppkey % 4 = 0 THEN {_txt('(n_nationkey + 1) * 1000')}
       ELSE {_txt('(n_nationkey + 1) * 1000 + 1 + s_suppkey % 997')} END AS FIPS_Code,
  n_name AS Stabr,
  'Poverty area ' || n_name AS Area_Name,
  'PCTPOVALL_2023' AS Attribute,
  CASE WHEN s_suppkey % 13 = 0 THEN 'N/A'
       ELSE {_txt('s_suppkey % 9 + 8')} || '.' || {_txt('s_suppkey % 10')} END AS Value,
  s_suppkey * 10 + 1 AS pos
FROM supplier JOIN nation ON s_nationkey = n_nationkey
"""

VIEW_SQL = {
    "loans": LOANS_SQL,
    "macro_monthly": MACRO_MONTHLY_SQL,
    "state_unemployment": STATE_UNEMPLOYMENT_SQL,
    "state_poverty": STATE_POVERTY_SQL,
}


def with_views(body: str, *views: str, extra: Sequence[tuple[str, str]] = ()) -> str:
    """Prefix ``body`` with the named fixture views (and extra CTEs) as a WITH clause."""
    ctes = [f"{v} AS ({VIEW_SQL[v]})" for v in views] + [f"{n} AS ({s})" for n, s in extra]
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body
