"""Period macro with lag over kept periods; state economics; control residuals."""

from pyspark.sql import functions as F

from conftest import rows
from credscope.operators import fusion, macro, states


def test_annual_macro_lag_skips_incomplete_year(spark):
    data = [
        ("2000-01-01", "1", "4", "100"), ("2000-02-01", "3", "6", "100"),
        ("2001-01-01", "", "5", "110"),                      # no fed funds at all -> year dropped
        ("2002-01-01", "2", "5", "121"), ("2002-06-01", ".", "5", ""),
        ("2003-01-01", "2", "5", "0"),
        ("2004-01-01", "2", "5", "50"),
    ]
    df = spark.createDataFrame(data, "observation_date string, FEDFUNDS string, UNRATE string, CPIAUCSL string")
    got = rows(macro.annual_macro(df))
    assert got == [
        ("2000", 2.0, 5.0, 100.0, None),
        ("2002", 2.0, 5.0, 121.0, 21.0),   # vs 2000, the previous *kept* year
        ("2003", 2.0, 5.0, 0.0, -100.0),
        ("2004", 2.0, 5.0, 50.0, None),    # previous CPI of 0 -> no inflation
    ]
    q = rows(macro.quarterly_macro(df), "issue_quarter")
    assert q == [("2000-Q1",), ("2002-Q1",), ("2003-Q1",), ("2004-Q1",)]


def test_state_economics_last_value_and_merge(spark):
    unemp = spark.createDataFrame(
        [
            ("1000", "AA", "Alpha", "Unemployment_rate_2023", "3.0", 1),
            ("01000", "AA", "Alpha St", "Unemployment_rate_2023", "3.5", 2),   # later row wins
            ("1000", "AA", "Alpha St", "Median_Household_Income_2022", "88,072", 3),
            ("1001", "AA", "County", "Unemployment_rate_2023", "9.9", 4),      # county: ignored
            ("0", "US", "Nation", "Unemployment_rate_2023", "4.0", 5),         # national: ignored
            ("2000", "BB", "Beta", "Other", "1", 6),
        ],
        "FIPS_Code string, State string, Area_Name string, Attribute string, Value string, pos long",
    )
    pov = spark.createDataFrame(
        [("1000", "AA", "Alpha (pov)", "PCTPOVALL_2023", "12.5", 1),
         ("3000", "CC", "Gamma", "PCTPOVALL_2023", "10", 2),
         ("3000", "CC", "Gamma", "PCTPOVALL_2023", "N/A", 3)],                 # last wins, even unparseable
        "FIPS_Code string, Stabr string, Area_Name string, Attribute string, Value string, pos long",
    )
    got = rows(states.state_economics(unemp, pov))
    assert got == [
        ("AA", "Alpha (pov)", 3.5, 88072.0, 12.5),
        ("BB", "Beta", None, None, None),
        ("CC", "Gamma", None, None, None),
    ]


def test_residuals_orthogonal_to_control(spark):
    data = [(f"S{i}", 0.1 + 0.01 * i + (0.003 if i % 3 == 0 else -0.001), 10.0 + i, 700.0 - 2 * i) for i in range(30)]
    df = spark.createDataFrame(data, "state string, default_rate double, avg_interest_rate double, avg_fico double")
    out = states.with_residuals(df)
    r = out.agg(F.corr("default_residual_after_avg_interest", "avg_interest_rate")).first()[0]
    assert abs(r) < 0.05
    assert out.filter(F.col("default_residual_after_avg_fico").isNull()).count() == 0


def test_correlation_table_and_matrix(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 7.0, 5.0)], "y double, a double, c double")
    got = rows(fusion.correlation_table(df, ["a", "c"], "y", "feature", "r"))
    assert got[0][0] == "a" and abs(got[0][1] - 0.9934) < 1e-9 and got[1] == ("c", None)
    m = rows(fusion.correlation_matrix(df, ["y", "a"], ["a", "c"]))
    assert [(t, f) for t, f, _ in m] == [("y", "a"), ("y", "c"), ("a", "a"), ("a", "c")]
