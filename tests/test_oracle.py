"""Every registered query against its DuckDB oracle at sf0.01 (driver check)."""

import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE, SF_SMALL
from credscope.plans import catalog
from tools.oracle_check import check, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["grade", "loan_count", "default_count", "default_rate"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_documented():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(catalog.ORACLE) == set(catalog.QUERIES) <= set(E.queries())


@pytest.fixture(scope="module")
def small():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = check(spark, con, SF_ORACLE, name)
    assert r["schema_ok"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_ok"], r


def test_queries_run_at_smallest_scale(spark, small):
    for name in sorted(catalog.QUERIES):
        r = check(spark, small, SF_SMALL, name)
        assert r["schema_ok"] and r["values_ok"], r


def test_results_independent_of_session_settings(spark, con):
    """Same values with ANSI off, many shuffle partitions and a time zone
    whose daylight-saving switch skips midnight."""
    settings = {"spark.sql.ansi.enabled": "false", "spark.sql.shuffle.partitions": "64",
                "spark.sql.session.timeZone": "America/Sao_Paulo"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for name in ("rate_by_month", "macro_quarterly", "state_control_features"):
            r = check(spark, con, SF_ORACLE, name)
            assert r["values_ok"] and r["spark_rows"] == r["oracle_rows"], r
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
