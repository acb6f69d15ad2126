"""Status distribution, missing profile and overview over all rows."""

from conftest import rows
from credscope.operators import profile


def test_status_distribution_keeps_empty_group(spark):
    df = spark.createDataFrame([("Fully Paid",), ("",), (None,), ("Current",), ("Fully Paid",)], "loan_status string")
    assert rows(profile.status_distribution(df)) == [("", 2), ("Fully Paid", 2), ("Current", 1)]


def test_missing_profile(spark):
    df = spark.createDataFrame(
        [("a", "", None, 1), ("b", "x", None, None), ("c", "", "y", 3), ("d", "z", None, 4)],
        "never string, some string, most string, num int",
    )
    got = rows(profile.missing_profile(df))
    assert got == [("most", 0.75, 3), ("some", 0.5, 2), ("num", 0.25, 1)]
    assert rows(profile.missing_profile(df, top=1)) == [("most", 0.75, 3)]


def test_overview(spark):
    df = spark.createDataFrame([("Fully Paid", "x"), ("Charged Off", "y"), ("Current", "z")], "loan_status string, c string")
    assert dict(rows(profile.overview(df, "loans.csv"))) == {
        "source_file": "loans.csv", "all_rows": "3", "usable_finalized_rows": "2",
        "skipped_non_final_rows": "1", "columns": "2", "overall_default_rate": "0.5",
    }
    none = spark.createDataFrame([("Current",)], "loan_status string")
    assert dict(rows(profile.overview(none, "f")))["overall_default_rate"] == "0"
