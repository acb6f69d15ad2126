"""Chart datasets (scaling, ticks, top-5 rules, labels) and findings."""

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from credscope.operators import charts, findings, rates
from credscope.sources import fixtures


def test_bar_dataset_and_labels(spark):
    df = spark.createDataFrame([("A", 0.05), ("B", 0.2125), ("C", 0.4)], "grade string, default_rate double")
    got = rows(charts.bar_dataset(df, "grade"))
    assert got == [("A", "A", 0.05, 0.125, "5.0%"), ("B", "B", 0.2125, 0.5312, "21.2%"), ("C", "C", 0.4, 1.0, "40.0%")]


def test_line_dataset_ticks_and_floor(spark):
    df = spark.createDataFrame([(str(2000 + i), 0.1) for i in range(17)] + [("Unknown", 0.9)], "y string, default_rate double")
    got = rows(charts.line_dataset(df, "y"))
    assert len(got) == 17 and all(r[3] == 0.0 for r in got)          # constant series: span floor, no division by 0
    assert [r[0] for r in got if r[4]] == [0, 2, 4, 6, 8, 10, 12, 14, 16]


def test_scatter_top5_rules(spark):
    df = spark.createDataFrame(
        [("A", 1.0, 0.9), ("B", 2.0, 0.8), ("C", 3.0, 0.8), ("D", 4.0, 0.7), ("E", 5.0, 0.6), ("F", 6.0, 0.6),
         ("G", None, 0.99)],
        "state string, x double, y double",
    )
    by_pos = {r[0] for r in rows(charts.scatter_dataset(df, "x", "y")) if r[5]}
    ties = {r[0] for r in rows(charts.scatter_dataset(df, "x", "y", ties=True)) if r[5]}
    assert by_pos == {"A", "B", "C", "D", "E"}
    assert ties == {"A", "B", "C", "D", "E", "F"}


def test_segment_bars(spark):
    df = spark.createDataFrame(
        [("VERY_LONG_STATE_NAME_X", "A", 100, 20, 0.2), ("S", "B", 50, 20, 0.4), ("S", "C", 80, 32, 0.4)],
        "state string, grade string, loan_count long, default_count long, default_rate double",
    )
    got = rows(charts.segment_bars(df, ["state", "grade"], top=2))
    assert got == [(1, "S / C", 0.4, 80, 1.0, "40.0% (80)"), (2, "S / B", 0.4, 50, 1.0, "40.0% (50)")]


def test_findings_picks(spark):
    loans = fixtures.loans(spark, SF_SMALL)
    profile = rates.rate_profile(loans, min_loans={"state": 0, "purpose": 0})
    picks = [("g_first", "grade", "first"), ("g_last", "grade", "last"), ("s_top", "state", "first"),
             ("term_hi", "term", "highest"), ("emp_last", "emp_length", "last")]
    got = {r[0]: r for r in rows(findings.profile_picks(profile, picks))}
    grade = rows(rates.rate_by(loans, "grade"))
    state = rows(rates.rate_by(loans, "state", 0))
    term = rows(rates.rate_by(loans, "term"))
    emp = rows(rates.rate_by(loans, "emp_length"))
    assert got["g_first"][1:] == (grade[0][0], grade[0][3], grade[0][1])
    assert got["g_last"][1] == grade[-1][0]
    assert got["s_top"][1] == state[0][0]
    assert got["term_hi"][1] == max(term, key=lambda r: r[3])[0]
    assert got["emp_last"][1] == emp[-1][0]


def test_lookups_and_segment_tops(spark):
    matrix = spark.createDataFrame(
        [("default_rate", "avg_fico", -0.5), ("default_rate", "share_grade_A", 0.1)],
        "target string, feature string, correlation double",
    )
    got = rows(findings.lookups(matrix, [("f1", "default_rate", "avg_fico"), ("f2", "x", "y")]))
    assert got == [("f1", "default_rate ~ avg_fico", -0.5, None)]
    segs = spark.createDataFrame(
        [("g", "A", "36", 100, 10, 0.1), ("g", "B", "36", 200, 20, 0.1), ("g", "C", "60", 50, 1, 0.02)],
        "segment string, key1 string, key2 string, loan_count long, default_count long, default_rate double",
    )
    assert rows(findings.segment_tops(segs, [("top_g", "g")])) == [("top_g", "B / 36", 0.1, 200)]


def test_top_rows(spark):
    df = spark.createDataFrame([(s, 0.1 * i) for i, s in enumerate("ABCDE")], "state string, default_rate double")
    got = rows(charts.top_rows(df, [F.desc("default_rate")], 2), "state", "rank")
    assert got == [("E", 1), ("D", 2)]
