"""Outcome labels, bins, HAVING, orderings, two-level and shared-scan rates."""

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from credscope.functions import labels as L
from credscope.functions import values as V
from credscope.operators import rates
from credscope.sources import fixtures

LOAN_COLS = ["loan_status", "grade", "term", "int_rate", "annual_inc", "dti", "fico_range_low",
             "fico_range_high", "purpose", "home_ownership", "verification_status", "emp_length",
             "loan_amnt", "addr_state", "issue_d"]


def loan(status="Fully Paid", grade="A", term=" 36 months", int_rate="10%", annual_inc="50000", dti="15",
         lo="700", hi="704", purpose="car", home="RENT", ver="Verified", emp="1 year", amt="9000",
         state="CA", issue="Dec-2015"):
    return (status, grade, term, int_rate, annual_inc, dti, lo, hi, purpose, home, ver, emp, amt, state, issue)


def frame(spark, data):
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in LOAN_COLS))


def test_outcome_labels(spark):
    statuses = ["Fully Paid", "Charged Off", "Default", "Late (31-120 days)",
                "Does not meet the credit policy. Status:Charged Off",
                "Does not meet the credit policy. Status:Fully Paid", "Current", "In Grace Period",
                "Late (16-30 days)", "", None, "fully paid"]
    df = spark.createDataFrame([(s,) for s in statuses], "s string")
    got = [r[0] for r in df.select(L.outcome_flag("s")).collect()]
    assert got == [0, 1, 1, 1, 1, None, None, None, None, None, None, None]
    fin = [r[0] for r in df.select(L.is_finalized("s")).collect()]
    assert [g is not None for g in got] == [bool(f) for f in fin]


def test_interest_bins(spark):
    df = spark.createDataFrame([(v,) for v in [7.99, 8.0, 24.0, 1e10, -1.0, None, float("nan")]], "v double")
    got = [r[0] for r in df.select(L.bin_label("v", V.INTEREST)).collect()]
    assert got == ["<8%", "8-12%", ">=24%", ">=24%", "<8%", "Unknown", ">=24%"]


def test_fico_midpoint_bin(spark):
    df = frame(spark, [loan(lo="675", hi="679"), loan(lo=None, hi="679")])
    got = rows(rates.with_keys(df, ["fico_bin"]), "fico_bin")
    assert got == [("660-700",), ("Unknown",)]


def test_min_loans_and_rate_desc_order(spark):
    data = [loan(state="AA")] * 999 + [loan(state="BB", status="Charged Off")] * 2 + [loan(state="BB")] * 998
    data += [loan(state="CC", status="Charged Off")] * 2 + [loan(state="CC")] * 1998
    t = rates.rate_by(frame(spark, data), "state", 1000)
    assert rows(t) == [("BB", 1000, 2, 0.002), ("CC", 2000, 2, 0.001)]
    # Equal rounded rates: larger count first, then key.
    data = [loan(state="X")] * 3 + [loan(state="Y")] * 5 + [loan(state="Z")] * 5
    assert [r[0] for r in rows(rates.rate_by(frame(spark, data), "state", 0))] == ["Y", "Z", "X"]


def test_explicit_order_and_unknown_last(spark):
    data = [loan(emp=e) for e in ["10+ years", None, "< 1 year", "3 years", "weird"]]
    got = [r[0] for r in rows(rates.rate_by(frame(spark, data), "emp_length"))]
    assert got == ["< 1 year", "3 years", "10+ years", "Unknown", "weird"]


def test_two_level_equals_per_row(spark):
    loans = fixtures.loans(spark, SF_SMALL)
    fin = rates.finalized(loans)
    for name in rates.DIMENSIONS:
        direct = rates.aggregate_rates(rates.with_keys(fin, [name]), [name])
        assert sorted(rows(rates.keyed_rates(fin, [name]))) == sorted(rows(direct)), name


def test_shared_scan_equals_single_tables(spark):
    loans = fixtures.loans(spark, SF_SMALL)
    profile = rates.rate_profile(loans, min_loans={"state": 0, "purpose": 0}).cache()
    for name in rates.DIMENSIONS:
        single = rates.rate_by(loans, name, 0)
        assert rows(rates.profile_slice(profile, name)) == rows(single), name
    segs = rates.segment_profile(loans, min_loans={s: 0 for s in rates.SEGMENTS}).cache()
    for name, (k1, k2) in rates.SEGMENTS.items():
        one = segs.filter(F.col("segment") == name).select(F.col("key1").alias(k1), F.col("key2").alias(k2),
                                                           *rates.RATE_COLUMNS)
        assert sorted(rows(one)) == sorted(rows(rates.segment(loans, name, 0))), name


def test_invariants_partition_of_usable_rows(spark):
    loans = fixtures.loans(spark, SF_SMALL)
    usable = rates.finalized(loans).count()
    profile = rates.rate_profile(loans, min_loans={"state": 0, "purpose": 0})
    sums = dict(rows(profile.groupBy("dimension").agg(F.sum("loan_count"))))
    assert set(sums.values()) == {usable}
    assert profile.filter((F.col("default_count") < 0) | (F.col("default_count") > F.col("loan_count"))).count() == 0


def test_quarter_drops_underivable(spark):
    data = [loan(issue="Dec-2015"), loan(issue="Foo-2015"), loan(issue=""), loan(issue="Mar-2016", status="Default")]
    assert rows(rates.rate_by_quarter(frame(spark, data))) == [("2015-Q4", 1, 0, 0.0), ("2016-Q1", 1, 1, 1.0)]


def test_segment_limit(spark):
    data = [loan(grade=g, term=t) for g in "ABC" for t in (" 36 months", " 60 months")]
    assert len(rows(rates.segment(frame(spark, data), "grade_term", 0, limit=4))) == 4


def test_count_desc_order(spark):
    data = [loan(grade="B")] * 3 + [loan(grade="A")] * 3 + [loan(grade="C")] * 5
    table = rates.keyed_rates(rates.finalized(frame(spark, data)), ["grade"])
    assert [r[0] for r in rows(rates.order_rates(table, ["grade"], "count_desc"))] == ["C", "A", "B"]


def test_keep_groups_is_not_pushed_below_aggregates(spark):
    data = [loan(issue="Dec-2015"), loan(issue=""), loan(issue="Jan-2016")]
    table = rates.keyed_rates(rates.finalized(frame(spark, data)), ["issue_year"])
    kept = rates.keep_groups(table, F.col("issue_year") != "Unknown")
    assert sorted(r[0] for r in rows(kept)) == ["2015", "2016"]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    # The predicate stays above the second aggregate (it reads loan_count).
    assert plan.index("Filter") < plan.index("Aggregate")
