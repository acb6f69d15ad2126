"""Command line: run every analysis on raw CSV inputs and write all tables.

    python -m credscope --loans RAW_DIR_OR_CSV --macro MACRO.csv \
        --unemployment UNEMP.csv --poverty POVERTY.csv --out OUT_DIR

``--loans`` may be a directory: the loan file is then discovered by name
(exact ``accepted_2007_to_2018Q4.csv`` first, else any ``*accepted*.csv``).
When launched with ``spark-submit`` the cluster's session (and its shared
``spark.checkpoint.dir``) is used; otherwise a local session is created.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import SparkSession

from .plans.analyses import Thresholds, run_all
from .session import build_session
from .sources.files import find_source

LOAN_FILE = "accepted_2007_to_2018Q4.csv"


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="credscope", description=__doc__.splitlines()[0])
    ap.add_argument("--loans", required=True)
    ap.add_argument("--macro", required=True)
    ap.add_argument("--unemployment", required=True)
    ap.add_argument("--poverty", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--min-loans", type=int, default=1000)
    ap.add_argument("--master", default="local[*]")
    ap.add_argument("--no-multiline", dest="multiline", action="store_false",
                    help="no field holds a line break: one loan file is then read by many tasks")
    args = ap.parse_args(argv)

    spark = SparkSession.getActiveSession() or build_session(master=args.master)
    loans = args.loans
    if os.path.isdir(loans) or not loans.endswith(".csv"):
        loans = find_source(spark, loans, LOAN_FILE, "accepted")
    n = args.min_loans
    t = Thresholds(state=n, purpose=n, segments={s: n for s in Thresholds().segments}, control=n)
    written = run_all(spark, loans, args.macro, args.unemployment, args.poverty, args.out, t, args.multiline)
    print(json.dumps({"loans": loans, "written": written}, indent=1))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
