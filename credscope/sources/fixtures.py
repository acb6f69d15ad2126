"""Deterministic loan-shaped inputs derived from the driver's star schema.

The driver ships no loan file, so every analysis runs on views that Spark
derives from the driver tables.  Each lineitem becomes one loan, every row is
kept (no sampling, no id subsets), and all columns are *strings*, exactly like
the raw loan CSV, so the parsing operators see realistic text: percent signs,
padding, ``.`` placeholders, blanks and unparseable dates.

* ``loans``             lineitem x orders x customer x nation x part
* ``macro_monthly``     monthly series aggregated from lineitem ship dates
* ``state_unemployment`` / ``state_poverty``
                        long (EAV) state/county files from customer / supplier

The same definitions exist as DuckDB SQL in :mod:`credscope.oracle`; the two
must stay in lock-step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import MONTH_ABBREVIATIONS
from .tables import read_table

LOAN_COLUMNS = (
    "id", "loan_status", "grade", "term", "int_rate", "annual_inc", "dti",
    "fico_range_low", "fico_range_high", "purpose", "home_ownership",
    "verification_status", "emp_length", "loan_amnt", "addr_state", "issue_d",
)


def _text(c: Column) -> Column:
    return c.cast("bigint").cast("string")


def _year_month(ts: str) -> tuple[Column, Column]:
    """Year and zero-padded month of a TIMESTAMP_NTZ, independent of the
    session time zone (no cast to a zoned timestamp)."""
    return F.year(ts).cast("string"), F.lpad(F.month(ts).cast("string"), 2, "0")


def _mon_yyyy(ts: str) -> Column:
    """``Mon-YYYY`` (English month abbreviation), time-zone independent."""
    names = F.array(*[F.lit(m) for m in MONTH_ABBREVIATIONS])
    return F.concat(F.element_at(names, F.month(ts)), F.lit("-"), F.year(ts).cast("string"))


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw, all-string loan row per lineitem."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus",
    )
    od = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    cu = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    na = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    pa = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")

    j = (
        li.join(od, li.l_orderkey == od.o_orderkey)
        .join(cu, F.col("o_custkey") == cu.c_custkey)
        .join(na, F.col("c_nationkey") == na.n_nationkey)
        .join(pa, F.col("l_partkey") == pa.p_partkey)
    )
    line = F.col("l_linenumber")
    status = (
        F.when(F.col("l_returnflag") == "A",
               F.when(line == 7, F.lit("Does not meet the credit policy. Status:Fully Paid"))
               .otherwise(F.lit("Fully Paid")))
        .when(F.col("l_returnflag") == "R",
              F.when(F.col("o_orderstatus") == "O", F.lit("Charged Off"))
              .when(F.col("o_orderstatus") == "F", F.lit("Default"))
              .when(line == 1, F.lit("Does not meet the credit policy. Status:Charged Off"))
              .otherwise(F.lit("Late (31-120 days)")))
        .when(line == 7, F.lit(""))
        .when(line == 6, F.lit("In Grace Period"))
        .otherwise(F.lit("Current"))
    )
    qty = _text(F.col("l_quantity"))
    int_rate = (
        F.when(F.col("l_quantity") == 50, F.lit("."))
        .when(line == 3, F.concat(F.lit(" "), qty, F.lit("% ")))
        .otherwise(F.concat(qty, F.lit("%")))
    )
    fico_low = F.lit(640) + F.lit(5) * (F.col("l_partkey") % 32)
    emp_key = F.col("c_custkey") % 12
    emp_length = (
        F.when(emp_key == 0, F.lit("< 1 year"))
        .when(emp_key == 1, F.lit("1 year"))
        .when(emp_key <= 9, F.concat(_text(emp_key), F.lit(" years")))
        .when(emp_key == 10, F.lit("10+ years"))
    )
    issue_d = (
        F.when((F.col("o_orderpriority") == "4-NOT SPECIFIED") & (line == 4), F.lit(""))
        .when((F.col("o_orderpriority") == "1-URGENT") & (line == 5), F.lit("Foo-1999"))
        .otherwise(_mon_yyyy("o_orderdate"))
    )
    return j.select(
        F.concat(_text(F.col("l_orderkey")), F.lit("-"), _text(line)).alias("id"),
        status.alias("loan_status"),
        F.substring(F.lit("ABCDEFG"), (F.col("p_size") % 8 + 1).cast("int"), 1).alias("grade"),
        F.when(F.col("l_linestatus") == "F", F.lit(" 36 months"))
        .otherwise(F.lit(" 60 months")).alias("term"),
        int_rate.alias("int_rate"),
        _text(F.floor(F.col("c_acctbal") * 15)).alias("annual_inc"),
        F.when(F.col("p_size") != 50, _text(F.col("p_size"))).alias("dti"),
        F.when(line != 6, _text(fico_low)).alias("fico_range_low"),
        _text(fico_low + 4).alias("fico_range_high"),
        F.lower("p_type").alias("purpose"),
        F.col("c_mktsegment").alias("home_ownership"),
        F.col("o_orderstatus").alias("verification_status"),
        emp_length.alias("emp_length"),
        _text(F.floor(F.col("l_extendedprice") / 3)).alias("loan_amnt"),
        F.col("n_name").alias("addr_state"),
        issue_d.alias("issue_d"),
    )


def macro_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly macro-style series (all text) from lineitem ship months.

    ``fedfunds`` is blank before 1995-07 and in 1998-05, ``cpi`` is ``.``
    throughout 1999, so the complete-case rule drops whole periods.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_shipdate", "l_discount", "l_tax", "l_quantity"
    )
    year, mm = _year_month("l_shipdate")
    month = F.concat(year, F.lit("-"), mm)
    agg = li.groupBy(month.alias("ym")).agg(
        F.sum(F.round(F.col("l_discount") * 100).cast("bigint")).alias("ff"),
        F.sum(F.round(F.col("l_tax") * 100).cast("bigint")).alias("ur"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("cp"),
    )
    ym = F.col("ym")
    return agg.select(
        F.concat(ym, F.lit("-01")).alias("observation_date"),
        F.when((ym < "1995-07") | (ym == "1998-05"), F.lit("")).otherwise(_text(F.col("ff"))).alias("FEDFUNDS"),
        _text(F.col("ur")).alias("UNRATE"),
        F.when(F.substring(ym, 1, 4) == "1999", F.lit(".")).otherwise(_text(F.col("cp"))).alias("CPIAUCSL"),
    )


def state_unemployment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long state/county file from customers: one row per customer x attribute.

    Every tenth customer yields a state-level row (FIPS ``NN000``, sometimes
    zero-padded), every hundredth the national row ``0``, the rest county
    rows.  ``pos`` is the file line order; the last state-level value of a
    state/attribute wins.
    """
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    na = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = cu.join(na, cu.c_nationkey == na.n_nationkey)
    k = F.col("c_custkey")
    state_code = (F.col("n_nationkey") + 1) * 1000
    fips = (
        F.when(k % 100 == 0, F.lit("0"))
        .when(k % 20 == 0, F.lpad(_text(state_code), 5, "0"))
        .when(k % 10 == 0, _text(state_code))
        .otherwise(_text(state_code + 1 + k % 997))
    )
    area = F.when(k % 10 == 0, F.concat(F.lit("Area of "), F.col("n_name"))).otherwise(
        F.concat(F.lit("County "), _text(k))
    )
    attrs = F.array(
        F.struct(F.lit("Unemployment_rate_2023").alias("attr"),
                 F.concat(_text(k % 7 + 2), F.lit("."), _text(k % 10)).alias("val"),
                 F.lit(1).alias("i")),
        F.struct(F.lit("Median_Household_Income_2022").alias("attr"),
                 F.format_number(F.lit(40000) + (k % 40) * 1500, 0).alias("val"),
                 F.lit(2).alias("i")),
        F.struct(F.lit("Civilian_labor_force_2023").alias("attr"),
                 _text(k * 3).alias("val"),
                 F.lit(3).alias("i")),
    )
    return j.select(
        fips.alias("FIPS_Code"), F.col("n_name").alias("State"), area.alias("Area_Name"),
        F.inline(attrs), (k * 10).alias("k10"),
    ).select(
        "FIPS_Code", "State", "Area_Name",
        F.col("attr").alias("Attribute"), F.col("val").alias("Value"),
        (F.col("k10") + F.col("i")).alias("pos"),
    )


def state_poverty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long poverty file from suppliers (state column is ``Stabr``).

    Every fourth supplier yields a state-level row, so some states exist only
    in the unemployment file; every thirteenth value is unparseable.
    """
    su = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    na = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = su.join(na, su.s_nationkey == na.n_nationkey)
    k = F.col("s_suppkey")
    state_code = (F.col("n_nationkey") + 1) * 1000
    fips = F.when(k % 4 == 0, _text(state_code)).otherwise(_text(state_code + 1 + k % 997))
    value = F.when(k % 13 == 0, F.lit("N/A")).otherwise(
        F.concat(_text(k % 9 + 8), F.lit("."), _text(k % 10))
    )
    return j.select(
        fips.alias("FIPS_Code"),
        F.col("n_name").alias("Stabr"),
        F.concat(F.lit("Poverty area "), F.col("n_name")).alias("Area_Name"),
        F.lit("PCTPOVALL_2023").alias("Attribute"),
        value.alias("Value"),
        (k * 10 + 1).alias("pos"),
    )
