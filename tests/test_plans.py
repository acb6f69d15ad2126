"""Physical plans: no one-task windows, hashed aggregates; period macro and positions against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from credscope.operators import charts, macro, ranks, states
from credscope.plans import catalog
from credscope.session import ensure_checkpoint_dir
from credscope.sources import files, fixtures


def plan_of(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, tmp_path):
    n = iter(range(100))
    return lambda df: files.land_parquet(df, f"{tmp_path}/{next(n)}")


@pytest.mark.parametrize("name", ["chart_bars_all", "chart_segments_all", "chart_scatters_all", "rank_published", "rank_statuses", "rank_missing"])
def test_no_window_over_one_task(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, SF_SMALL))
    windows = [x for x in plan.split("\n") if "Window [" in x or "Window(" in x]
    assert not any("SinglePartition" in x for x in plan.split("\n")) or not windows, plan


def test_top_rows_are_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(catalog.QUERIES["chart_segments_all"](spark, SF_SMALL))


def test_long_to_wide_is_hashed(spark):
    for df in (states.state_economics(fixtures.state_unemployment(spark, SF_SMALL), fixtures.state_poverty(spark, SF_SMALL)), states.state_loan_features(fixtures.loans(spark, SF_SMALL))):
        assert "SortAggregate" not in plan_of(df)


def test_ranks_like_sorting(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.choice("abc"), rng.randrange(50), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, x int, i int").repartition(7)
    got = ranks.ranked(df, [F.desc("x"), F.col("i")], "r", stored(spark, tmp_path)).collect()
    want = sorted(rows, key=lambda r: (-r[1], r[2]))
    assert [(r.g, r.x, r.i) for r in sorted(got, key=lambda r: r.r)] == want and sorted(r.r for r in got) == list(range(1, 501))
    within = ranks.ranked_within(df, "g", [F.desc("x"), F.col("i")], "r", stored(spark, tmp_path / "w")).collect()
    for g in "abc":
        of = [r for r in want if r[0] == g]
        assert [(r.g, r.x, r.i) for r in sorted((r for r in within if r.g == g), key=lambda r: r.r)] == of
    assert ranks.ranked(df.where("x < 0"), [F.col("x")], "r", stored(spark, tmp_path / "e")).collect() == []


def test_file_positions_pack_file_split_and_row(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("b.csv", "a.csv"):
        (tmp_path / "in" / name).write_text("FIPS_Code,State,Area_Name,Attribute,Value\n" + "".join(f"1000,{name[0]},area {i},x,{i}\n" for i in range(40)))
    got = files.read_state_long(spark, str(tmp_path / "in")).orderBy("pos").select("State", "Value").collect()
    assert [(r[0], int(r[1])) for r in got] == [(s, i) for s in "ab" for i in range(40)]
    assert dict(files.read_state_long(spark, str(tmp_path / "in")).dtypes)["pos"] == "decimal(38,0)"


def test_optional_attribute_is_a_column_where_present(spark):
    schema = "FIPS_Code string, State string, Area_Name string, Attribute string, Value string, pos long"
    rows = [("1000", "AA", "Alpha", "Median_Household_Income_2023", "90,001", 1), ("1001", "AA", "County", "Other", "1", 2)]
    poverty = spark.createDataFrame([("2000", "BB", "Beta", "PCTPOVALL_2023", "9", 1)], schema.replace("State", "Stabr"))
    for fips, there in (("1000", True), ("1001", False)):
        unemployment = spark.createDataFrame([(fips, *rows[0][1:]), rows[1]], schema)
        out = states.state_economics(unemployment, poverty, states.attributes_present(unemployment))
        assert ("ers_median_household_income_2023" in out.columns) == there
        if there:
            assert out.where("state = 'AA'").first()["ers_median_household_income_2023"] == 90001.0


@pytest.mark.parametrize("by", ["year", "quarter"])
def test_period_macro_like_plain_python(spark, by):
    """952 months of three series with gaps, against Python's own sums and rounding."""
    rng = random.Random(9)
    months = [(f"{1947 + i // 12}-{i % 12 + 1:02d}-01", *["" if rng.random() < 0.04 or (k == 0 and i < 90) else f"{rng.uniform(0.1, 300):.{rng.randint(1, 7)}f}" for k in range(3)]) for i in range(952)]
    df = spark.createDataFrame(months, "observation_date string, FEDFUNDS string, UNRATE string, CPIAUCSL string").repartition(5)
    groups = {}
    for date, *values in months:
        period = date[:4] if by == "year" else f"{date[:4]}-Q{(int(date[5:7]) - 1) // 3 + 1}"
        for held, v in zip(groups.setdefault(period, ([], [], [])), values):
            held += [float(v)] if v else []
    want, last = [], None
    for period in sorted(p for p, g in groups.items() if all(g)):
        means = [math.fsum(v) / len(v) for v in groups[period]]
        want.append((period, *[round(m, 4) for m in means], round((means[2] / last - 1) * 100, 4) if last else None))
        last = means[2]
    got = (macro.annual_macro if by == "year" else macro.quarterly_macro)(df)
    assert [tuple(r) for r in got.collect()] == want
    assert len(want) > 60


def test_keyed_charts_are_apart(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 3.0)], "label string, value double")
    b = spark.createDataFrame([("x", 10.0), ("y", 0.0)], "label string, value double")
    both = charts.bar_datasets(charts.long_charts({"a": a, "b": b}))
    for name, df in (("a", a), ("b", b)):
        one = charts.one_chart(both, name).orderBy("label").collect()
        assert one == charts.bar_dataset(df, "label", "value").orderBy("label").collect()
    assert ensure_checkpoint_dir(spark)
