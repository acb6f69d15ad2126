"""Published result tables, recomputed from published inputs.

The folder named by ``CREDSCOPE_PUBLISHED`` is searched for CSVs, which are
recognised by their headers; without it the tests are skipped.  Loans are not
part of that folder, so rates are read and all that follows from them is
computed: period macro tables, fusions, correlations and residuals.
"""

import csv
import functools
import glob
import os

import pytest

from credscope.functions import values as V
from credscope.operators import fusion, macro, states
from credscope.sources.files import read_macro_csv

FOLDER = os.environ.get("CREDSCOPE_PUBLISHED")
pytestmark = pytest.mark.skipif(not FOLDER, reason="CREDSCOPE_PUBLISHED names no folder")

ANNUAL = ["issue_year", "avg_fed_funds_rate", "avg_unemployment_rate", "avg_cpi", "cpi_inflation_rate"]
QUARTERLY = ["issue_quarter", *ANNUAL[1:4], "quarterly_cpi_inflation_rate"]
RATES = ["loan_count", "default_count", "default_rate"]
RESIDUALS = ["default_residual_after_avg_interest", "default_residual_after_avg_fico"]
ECONOMICS = ["state", "state_name", *V.STATE_FEATURES]


@functools.cache
def _headers():
    found = {}
    for path in sorted(glob.glob(f"{FOLDER}/**/*.csv", recursive=True)):
        with open(path, newline="", encoding="utf-8-sig") as f:
            found.setdefault(tuple(next(csv.reader(f), ())), path)
    return found


def published(header):
    with open(_headers()[tuple(header)], newline="", encoding="utf-8-sig") as f:
        return [tuple(r) for r in csv.reader(f)][1:]


def frame(spark, header, text):
    """The published table, columns of ``text`` as strings, the rest as numbers."""
    kinds = ["string" if h in text else "bigint" if h.endswith("_count") else "double" for h in header]
    cast = {"string": str, "bigint": int, "double": float}
    data = [tuple(cast[k](v) if v != "" else None for k, v in zip(kinds, r)) for r in published(header)]
    return spark.createDataFrame(data, ", ".join(f"{h} {k}" for h, k in zip(header, kinds)))


def tuples(df, header):
    return [tuple(r) for r in df.select(*header).collect()]


@pytest.fixture(scope="module")
def monthly(spark):
    return read_macro_csv(spark, next(p for h, p in _headers().items() if h and h[0] == "observation_date"))


def test_period_macro(spark, monthly):
    for header, got, count in ((ANNUAL, macro.annual_macro(monthly), 73), (QUARTERLY, macro.quarterly_macro(monthly), 288)):
        want = tuples(frame(spark, header, header[:1]), header)
        assert len(want) == count and tuples(got, header) == want


def test_rates_with_macro_and_their_correlations(spark, monthly):
    for macro_header, periods, label, count in ((ANNUAL, macro.annual_macro, "correlation_with_default_rate", 12), (QUARTERLY, macro.quarterly_macro, "correlation_with_quarterly_default_rate", 47)):
        key = macro_header[0]
        fused = fusion.rate_with_period_macro(frame(spark, [key, *RATES], [key]), periods(monthly), key)
        header = [key, *RATES, *macro_header[1:]]
        want = tuples(frame(spark, header, [key]), header)
        assert len(want) == count and tuples(fused, header) == want
        corr = ["macro_variable", label]
        features = [h for h in macro_header[1:] if h != "avg_cpi"]  # prices count as their change
        assert tuples(fusion.correlation_table(fused, features, "default_rate", *corr), corr) == tuples(frame(spark, corr, corr[:1]), corr)


def test_states_with_economics_and_their_correlations(spark):
    rates = frame(spark, ["state", *RATES], ["state"])
    merged = fusion.attach(rates, frame(spark, ECONOMICS, ECONOMICS[:2]), "state")
    header = ["state", *RATES, *ECONOMICS[1:]]
    want = tuples(frame(spark, header, ECONOMICS[:2]), header)
    assert len(want) == 50 and sorted(tuples(merged, header)) == sorted(want)
    corr = ["state_feature", "correlation_with_state_default_rate"]
    assert tuples(fusion.correlation_table(merged, V.STATE_FEATURES, "default_rate", *corr), corr) == tuples(frame(spark, corr, corr[:1]), corr)


def test_control_correlations(spark):
    header = next(list(h) for h in _headers() if set(RESIDUALS) <= set(h))
    table = frame(spark, header, ECONOMICS[:2])
    corr = ["target", "feature", "correlation"]
    want = frame(spark, corr, corr[:2]).collect()
    targets, features = list(dict.fromkeys(r.target for r in want)), list(dict.fromkeys(r.feature for r in want))
    assert {(r.target, r.feature): r.correlation for r in fusion.correlation_matrix(table, targets, features).collect()} == {(r.target, r.feature): r.correlation for r in want}


def test_control_residuals(spark):
    """Residuals of the published, rounded rates: within what rounding to four
    digits of the inputs can shift them."""
    header = next(list(h) for h in _headers() if set(RESIDUALS) <= set(h))
    table = frame(spark, header, ECONOMICS[:2])
    got = {r.state: r for r in states.with_residuals(table.drop(*RESIDUALS)).collect()}
    for r in table.collect():
        for c in RESIDUALS:
            assert abs(got[r.state][c] - r[c]) <= 2e-4
