"""CSV dialect, discovery, sink, and the end-to-end runner on CSV inputs."""

import csv
import os
import random
from collections import Counter

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from credscope.operators import profile, rates, states
from credscope.plans import analyses
from credscope.sources import files, fixtures


def test_csv_dialect(spark, tmp_path):
    raw = (
        b'id,loan_status,note\r\n'
        b'1,Fully Paid,"line one\nline two"\r\n'
        b'2,Charged Off,"say ""hi"""\r\n'
        b'3,,bad \xff byte\r\n'
        b'4,Current,\r\n'
    )
    p = tmp_path / "loans.csv"
    p.write_bytes(raw)
    df = files.read_loans_csv(spark, str(p))
    assert df.columns == ["id", "loan_status", "note"]
    got = {r[0]: (r[1], r[2]) for r in df.collect()}
    assert got["1"] == ("Fully Paid", "line one\nline two")
    assert got["2"] == ("Charged Off", 'say "hi"')
    assert got["3"][0] is None and got["3"][1] == "bad � byte"
    assert got["4"] == ("Current", None)


def test_find_source(spark, tmp_path):
    root = tmp_path / "raw"
    (root / "b").mkdir(parents=True)
    (root / "a").mkdir()
    (root / "b" / "Accepted_loans.csv").write_text("x\n1\n")
    (root / "a" / "other.csv").write_text("x\n1\n")
    assert files.find_source(spark, str(root), "accepted_2007_to_2018Q4.csv", "accepted").endswith("b/Accepted_loans.csv")
    (root / "a" / "accepted_2007_to_2018Q4.csv").write_text("x\n1\n")
    assert files.find_source(spark, str(root), "accepted_2007_to_2018Q4.csv", "accepted").endswith(
        "a/accepted_2007_to_2018Q4.csv")


def test_write_table_skips_empty(spark, tmp_path):
    empty = spark.createDataFrame([], "a string")
    assert files.write_table(empty, str(tmp_path / "e")) is False
    df = spark.createDataFrame([("x", None)], "a string, b string")
    assert files.write_table(df, str(tmp_path / "w"), single_file=True)
    text = "".join(open(os.path.join(tmp_path / "w", f)).read()
                   for f in os.listdir(tmp_path / "w") if f.endswith(".csv"))
    assert text.splitlines() == ["a,b", "x,"]


def _as_csv(df, path):
    df.coalesce(1).write.option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def test_run_all_end_to_end(spark, tmp_path):
    loans = fixtures.loans(spark, SF_SMALL)
    _as_csv(loans, str(tmp_path / "in/loans"))
    _as_csv(fixtures.macro_monthly(spark, SF_SMALL).orderBy("observation_date"), str(tmp_path / "in/macro"))
    unemp = fixtures.state_unemployment(spark, SF_SMALL)
    pov = fixtures.state_poverty(spark, SF_SMALL)
    _as_csv(unemp.orderBy("pos").drop("pos"), str(tmp_path / "in/unemp"))
    _as_csv(pov.orderBy("pos").drop("pos"), str(tmp_path / "in/pov"))
    out = tmp_path / "out"
    written = analyses.run_all(spark, str(tmp_path / "in/loans"), str(tmp_path / "in/macro"),
                               str(tmp_path / "in/unemp"), str(tmp_path / "in/pov"), str(out),
                               analyses.Thresholds(state=100, purpose=100, control=100,
                                                   segments={s: 10 for s in rates.SEGMENTS}))
    assert written["lc_default_by_grade"] and written["lc_state_control_features"]
    back = files.read_csv_strings(spark, str(out / "lc_default_by_grade"))
    want = [tuple(str(v) for v in r) for r in rows(rates.rate_by(loans, "grade"))]
    assert [tuple(r) for r in back.collect()] == want      # order kept in the single CSV
    econ_csv = files.read_csv_strings(spark, str(out / "ers_state_economic_features"))
    econ = states.state_economics(unemp, pov)
    assert econ_csv.count() == econ.count()
    assert sorted(r[0] for r in econ_csv.select("state").collect()) == sorted(r[0] for r in econ.select("state").collect())
    seg_csv = files.read_csv_strings(spark, str(out / "lc_segment_grade_term"))
    want_seg = [tuple(str(v) for v in r) for r in rows(rates.segment(loans, "grade_term", 10))]
    assert [tuple(r) for r in seg_csv.collect()] == want_seg
    lp = analyses.all_tables(loans, fixtures.macro_monthly(spark, SF_SMALL), unemp, pov, "x")
    assert lp["lc_overview"].filter(F.col("metric") == "all_rows").first()[1] == str(loans.count())


def test_ragged_rows(spark, tmp_path):
    p = tmp_path / "ragged.csv"
    p.write_text("a,b,c\n1,2,3\n4,5\n6,7,8,9\n")
    df = files.read_loans_csv(spark, str(p))
    assert sorted(tuple(r) for r in df.collect()) == [("1", "2", "3"), ("4", "5", None), ("6", "7", "8")]
    assert sorted(r["record"] for r in files.ragged_rows(spark, str(p)).collect()) == ["4,5", "6,7,8,9"]


def _missing_by_reader(path, top=40):
    """Missing counts as Python's csv reader sees them: a field that a row lacks isn't an empty one."""
    counts, n = Counter(), 0
    with open(path, newline="", encoding="utf-8", errors="replace") as f:
        reader = csv.DictReader(f)
        for row in reader:
            n += 1
            counts.update(c for c in reader.fieldnames if row.get(c, "") == "")
    return [(c, round(k / n, 4), k) for c, k in sorted(counts.items(), key=lambda x: (-x[1], reader.fieldnames.index(x[0])))][:top]


RAGGED = (
    'a,b,c,d\n1,2,3,4\n4,5\n6,7,8,9,10\n\n,,\n"x, y",\n"say ""a,b""",1,"",\nab"c,d"e\n"two\nlines, here",,\n,,,\n,,,,\n"open, quote"\n"",1\n'
)


def test_missing_counts_of_ragged_rows(spark, tmp_path):
    p = tmp_path / "ragged.csv"
    p.write_text(RAGGED)
    raw = files.read_loans_csv(spark, str(p), field_count=True)
    want = _missing_by_reader(p)
    assert want and rows(profile.missing_profile(raw)) == want
    landed, seen = files.land_observed(raw, str(tmp_path / "landed"), profile.missing_metrics(raw))
    assert rows(profile.observed_missing(spark, profile.profiled_columns(raw), seen)) == want
    assert rows(profile.missing_profile(landed)) == want and profile.profiled_columns(landed) == ["a", "b", "c", "d"]
    assert rows(profile.observed_missing(spark, ["a", "b", "c", "d"], seen, 2)) == want[:2]
    one_line = tmp_path / "lines.csv"
    one_line.write_text(RAGGED.replace('"two\nlines, here"', "two lines"))
    assert rows(profile.missing_profile(files.read_loans_csv(spark, str(one_line), False, True))) == _missing_by_reader(one_line)
    p.write_text("a,b\n")
    none = files.read_loans_csv(spark, str(p), field_count=True)
    _, seen = files.land_observed(none, str(tmp_path / "none"), profile.missing_metrics(none))
    assert rows(profile.observed_missing(spark, ["a", "b"], seen)) == []


def test_random_ragged_rows(spark, tmp_path):
    rng = random.Random(4)
    fields = ["", "x", '"p, q"', '""', '"a ""b"", c"', 'u"v', "7"]
    lines = [",".join(rng.choice(fields) for _ in range(rng.randint(1, 6))) for _ in range(400)]
    p = tmp_path / "random.csv"
    p.write_text("\n".join(["c1,c2,c3,c4", *lines]) + "\n")
    assert rows(profile.missing_profile(files.read_loans_csv(spark, str(p), field_count=True))) == _missing_by_reader(p)


def test_loans_are_read_three_times_once_landed(spark, tmp_path):
    """Only three stored results, and no table, read the landed loans."""
    loans = files.land_parquet(fixtures.loans(spark, SF_SMALL), str(tmp_path / "loans"))
    _, seen = files.land_observed(loans, str(tmp_path / "again"), profile.missing_metrics(loans))
    reads = {}

    def keep(df, name):
        reads[name] = str(tmp_path / "loans") in "".join(df.inputFiles())
        return files.land_parquet(df, str(tmp_path / "kept" / name))

    monthly = files.land_parquet(fixtures.macro_monthly(spark, SF_SMALL), str(tmp_path / "monthly"))
    unemp = files.land_parquet(fixtures.state_unemployment(spark, SF_SMALL), str(tmp_path / "unemp"))
    pov = files.land_parquet(fixtures.state_poverty(spark, SF_SMALL), str(tmp_path / "pov"))
    missing = profile.observed_missing(spark, loans.columns, seen)
    out = analyses.all_tables(loans, monthly, unemp, pov, "x", analyses.Thresholds(1, 1, {s: 1 for s in rates.SEGMENTS}, 1), keep, missing)
    assert {n for n, does in reads.items() if does} == {"rates", "statuses", "state_features"}
    assert not [n for n, df in out.items() if str(tmp_path / "loans") in "".join(df.inputFiles())]
    assert rows(out["lc_missing_top40"]) == rows(profile.missing_profile(loans))


def test_command_line(spark, tmp_path):
    from credscope.__main__ import main
    loans = fixtures.loans(spark, SF_SMALL)
    raw = tmp_path / "raw" / "accepted_loans"
    raw.mkdir(parents=True)
    loans.toPandas().to_csv(raw / "accepted_2007_to_2018Q4.csv", index=False)  # one real file
    _as_csv(fixtures.macro_monthly(spark, SF_SMALL).orderBy("observation_date"), str(tmp_path / "macro"))
    _as_csv(fixtures.state_unemployment(spark, SF_SMALL).orderBy("pos").drop("pos"), str(tmp_path / "unemp"))
    _as_csv(fixtures.state_poverty(spark, SF_SMALL).orderBy("pos").drop("pos"), str(tmp_path / "pov"))
    assert main(["--loans", str(tmp_path / "raw"), "--macro", str(tmp_path / "macro"),
                 "--unemployment", str(tmp_path / "unemp"), "--poverty", str(tmp_path / "pov"),
                 "--out", str(tmp_path / "out"), "--min-loans", "100"]) == 0
    assert os.path.isdir(tmp_path / "out" / "lc_default_by_grade")
