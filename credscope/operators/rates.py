"""Default-rate aggregation (A1-A3) with HAVING (P18), rate (P19), ordering.

Every rate table has the schema ``<keys...>, loan_count, default_count,
default_rate``.

Plan shape (two-level aggregation).  A key is a pure function of one or two
raw text columns (``int_rate`` -> interest bin, ``issue_d`` -> month, ...).
So the loans are first counted per *raw source value*, and the parsing,
binning and date handling run on those distinct values only; a second, tiny
aggregate then sums the counts per derived label.  Counts and sums are
additive, so the result is identical to labelling every row, but the per-row
work is one hash of a few short strings.  Both aggregates are combined
map-side before their shuffle, so a hot value (a third of all loans in one
grade) costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import bin_label, is_finalized, order_rank, outcome_flag
from ..functions.numeric import ratio, round_exact
from ..functions.parsing import (
    issue_month,
    issue_quarter,
    issue_year,
    midpoint,
    percent_float,
    stripped_unknown,
    unknown_if_blank,
)
from ..functions.values import (
    DEFAULT_MIN_LOANS,
    DTI,
    EMP_LENGTH_ORDER,
    FICO,
    INCOME,
    INTEREST,
    LOAN_AMOUNT,
    BinSpec,
)
from .ranks import ranked_within

Order = str | Sequence[str]  # "key" | "rate_desc" | "count_desc" | explicit labels

RATE_COLUMNS = ("loan_count", "default_count", "default_rate")


def finalized(loans: DataFrame, status: str = "loan_status") -> DataFrame:
    """Keep finalized loans only and label them.

    The filter is a plain IN-list on the raw status, which Catalyst pushes
    into the Parquet scan of a landed loan table.
    """
    return loans.filter(is_finalized(status)).withColumn("default_flag", outcome_flag(status))


def fico_midpoint(low: Column | str = "fico_range_low", high: Column | str = "fico_range_high") -> Column:
    return midpoint(percent_float(low), percent_float(high))


@dataclass(frozen=True)
class Dimension:
    """A rate key derived from raw loan columns.

    ``sources`` are the raw columns the key depends on.  Plain keys map them
    with ``label``; binned keys parse them with ``value`` and cut the number
    with ``bins`` (the number is bound in its own projection, because a bin
    label reads it once per bound).
    """

    name: str
    sources: tuple[str, ...]
    label: Callable[..., Column] | None = None
    value: Callable[..., Column] | None = None
    bins: BinSpec | None = None
    min_loans: int = 0
    order: Order = "key"
    # Near-unique raw values (amounts): counting per raw value would not
    # shrink anything, so the label is derived per row before level 1.
    per_row: bool = False

    def value_of(self, cols: Sequence[Column]) -> Column | None:
        return self.value(*cols) if self.value is not None else None

    def label_of(self, cols: Sequence[Column], value: Column | None) -> Column:
        if self.bins is not None:
            return bin_label(value, self.bins)
        return self.label(*cols)


def _plain(name: str, source: str, fn: Callable[[Column], Column], min_loans: int = 0, order: Order = "key") -> Dimension:
    return Dimension(name, (source,), label=fn, min_loans=min_loans, order=order)


def _binned(name: str, sources: tuple[str, ...], value: Callable[..., Column], spec: BinSpec,
            per_row: bool = False) -> Dimension:
    return Dimension(name, sources, value=value, bins=spec, order=spec.order, per_row=per_row)


# The fourteen single-key tables of the loan profile (A1.1-A1.14).
PROFILE_DIMENSIONS: tuple[Dimension, ...] = (
    _plain("grade", "grade", unknown_if_blank),
    _plain("issue_year", "issue_d", issue_year),
    _plain("issue_month", "issue_d", issue_month),
    _plain("state", "addr_state", unknown_if_blank, DEFAULT_MIN_LOANS, "rate_desc"),
    _binned("interest_bin", ("int_rate",), percent_float, INTEREST),
    _binned("income_bin", ("annual_inc",), percent_float, INCOME, per_row=True),
    _binned("dti_bin", ("dti",), percent_float, DTI),
    _binned("fico_bin", ("fico_range_low", "fico_range_high"), fico_midpoint, FICO),
    _plain("purpose", "purpose", unknown_if_blank, DEFAULT_MIN_LOANS, "rate_desc"),
    _plain("home_ownership", "home_ownership", unknown_if_blank),
    _plain("term", "term", stripped_unknown),
    _plain("verification_status", "verification_status", unknown_if_blank),
    _plain("emp_length", "emp_length", unknown_if_blank, order=EMP_LENGTH_ORDER),
    _binned("loan_amount_bin", ("loan_amnt",), percent_float, LOAN_AMOUNT, per_row=True),
)
DIMENSIONS = {d.name: d for d in PROFILE_DIMENSIONS}
# Quarter: its own table (A3); loans without a derivable quarter are dropped.
QUARTER = _plain("issue_quarter", "issue_d", issue_quarter)
ALL_DIMENSIONS = {**DIMENSIONS, QUARTER.name: QUARTER}


def dimension(name: str) -> Dimension:
    return ALL_DIMENSIONS[name]


def with_keys(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add derived key columns computed from the raw source columns of ``df``
    (parsed values first, in their own projection)."""
    dims = [ALL_DIMENSIONS[n] for n in names]
    values = {
        f"{d.name}__value": d.value_of([F.col(s) for s in d.sources]) for d in dims if d.value is not None
    }
    out = df.withColumns(values) if values else df
    out = out.withColumns({
        d.name: d.label_of([F.col(s) for s in d.sources], F.col(f"{d.name}__value") if d.value else None)
        for d in dims
    })
    return out.drop(*values) if values else out


def rate_columns(default_count: Column, loan_count: Column) -> Column:
    """Rounded default rate (P19) from the two counts."""
    return round_exact(ratio(default_count, loan_count), 4)


def count_columns(pre_counted: bool) -> list[Column]:
    if pre_counted:
        return [F.sum("loan_count").cast("bigint").alias("loan_count"),
                F.sum("default_count").cast("bigint").alias("default_count")]
    return [F.count(F.lit(1)).alias("loan_count"), F.sum("default_flag").cast("bigint").alias("default_count")]


def finish_rates(agg: DataFrame, min_loans: int | Column = 0) -> DataFrame:
    if isinstance(min_loans, Column) or min_loans > 0:
        agg = agg.filter(F.col("loan_count") >= min_loans)
    return agg.withColumn("default_rate", rate_columns(F.col("default_count"), F.col("loan_count")))


def aggregate_rates(df: DataFrame, keys: Sequence[str], min_loans: int = 0) -> DataFrame:
    """``GROUP BY keys`` over flagged rows -> counts, HAVING, rate."""
    return finish_rates(df.groupBy(*keys).agg(*count_columns(False)), min_loans)


def source_counts(finalized_loans: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Level 1: loans and defaults per combination of raw source values."""
    return finalized_loans.groupBy(*sources).agg(*count_columns(False))


def _level1_sources(d: Dimension) -> tuple[str, ...]:
    """Columns counted at level 1: the raw sources, or the per-row label."""
    return (d.name,) if d.per_row else d.sources


def keep_groups(table: DataFrame, condition: Column) -> DataFrame:
    """Keep the rows of an aggregated rate table that satisfy ``condition``.

    A plain filter on a derived key would be pushed by the optimizer below
    both aggregation levels and re-derive the key for every input row; the
    predicate is tied to ``loan_count`` (always >= 1 in a rate table) so it
    is evaluated once per group instead.
    """
    return table.filter(F.when(condition, F.col("loan_count")).otherwise(F.lit(0)) > 0)


def keyed_rates(finalized_loans: DataFrame, names: Sequence[str], min_loans: int = 0,
                drop_null_keys: bool = False) -> DataFrame:
    """Rate table keyed by derived dimensions, via the two-level aggregation."""
    per_row = [n for n in names if ALL_DIMENSIONS[n].per_row]
    rows = with_keys(finalized_loans, per_row) if per_row else finalized_loans
    sources = list(dict.fromkeys(s for n in names for s in _level1_sources(ALL_DIMENSIONS[n])))
    keyed = with_keys(source_counts(rows, sources), [n for n in names if n not in per_row])
    table = keyed.groupBy(*names).agg(*count_columns(True))
    if drop_null_keys:
        defined = F.lit(True)
        for n in names:
            defined = defined & F.col(n).isNotNull()
        table = keep_groups(table, defined)
    return finish_rates(table, min_loans)


def rate_ordering(keys: Sequence[str], order: Order = "key", reverse: bool = False) -> list[Column]:
    """Sort columns of one of the published orderings; every ordering ends in
    the keys, so it is total.  ``reverse`` flips every component."""
    key_cols = [F.col(k).cast("string") for k in keys]
    if isinstance(order, str):
        if order == "key":
            cols = [(c, True) for c in key_cols]
        elif order == "rate_desc":
            cols = [(F.col("default_rate"), False), (F.col("loan_count"), False)] + [(c, True) for c in key_cols]
        elif order == "count_desc":
            cols = [(F.col("loan_count"), False)] + [(c, True) for c in key_cols]
        else:
            raise ValueError(f"unknown order {order!r}")
    else:
        if len(keys) != 1:
            raise ValueError("an explicit label order needs exactly one key")
        cols = [(order_rank(keys[0], order), True)] + [(c, True) for c in key_cols]
    return [c.asc() if asc != reverse else c.desc() for c, asc in cols]


def order_rates(df: DataFrame, keys: Sequence[str], order: Order = "key") -> DataFrame:
    """Apply one of the published orderings."""
    return df.orderBy(*rate_ordering(keys, order))


def rate_by(loans: DataFrame, name: str, min_loans: int | None = None) -> DataFrame:
    """One of the fourteen profile tables from raw loans (A1.n)."""
    d = DIMENSIONS[name]
    table = keyed_rates(finalized(loans), [name], d.min_loans if min_loans is None else min_loans)
    return order_rates(table, [name], d.order)


def rate_by_quarter(loans: DataFrame) -> DataFrame:
    """A3: quarterly rates; loans without a derivable quarter are dropped."""
    return order_rates(keyed_rates(finalized(loans), ["issue_quarter"], drop_null_keys=True), ["issue_quarter"])


# Multi-key segment tables (A2.1-A2.5); all published with min 1000 loans.
SEGMENTS: dict[str, tuple[str, str]] = {
    "grade_term": ("grade", "term"),
    "grade_purpose": ("grade", "purpose"),
    "interest_fico": ("interest_bin", "fico_bin"),
    "state_grade": ("state", "grade"),
    "home_term": ("home_ownership", "term"),
}


def segment(loans: DataFrame, name: str, min_loans: int = DEFAULT_MIN_LOANS, limit: int | None = None) -> DataFrame:
    """A2: two-key risk segment, ordered by rounded rate desc, count desc, keys."""
    keys = SEGMENTS[name]
    out = order_rates(keyed_rates(finalized(loans), keys, min_loans), keys, "rate_desc")
    return out.limit(limit) if limit else out


def shared_rates(
    finalized_loans: DataFrame,
    groups: Mapping[str, Sequence[str]],
    group_col: str,
    key_cols: Sequence[str],
    min_loans: Mapping[str, int],
) -> DataFrame:
    """Several rate tables from ONE scan, in long form.

    ``groups`` maps a table name to its dimensions (at most one per
    ``key_cols``; missing trailing keys are NULL).
    Each loan is expanded into one row per table holding that table's raw
    source values in generic slots ``s0..sN`` (rows generated from an array,
    no parsing); level 1 counts per (table, slots), then the
    keys are derived per table on the distinct slot values, and level 2 sums
    per (table, keys).
    """
    per_row = sorted({d for dims in groups.values() for d in dims if ALL_DIMENSIONS[d].per_row})
    if per_row:
        finalized_loans = with_keys(finalized_loans, per_row)
    srcs = {g: [s for d in dims for s in _level1_sources(ALL_DIMENSIONS[d])] for g, dims in groups.items()}
    # Tables reading the same raw columns (year, month and quarter all read
    # issue_d) share one expanded row per loan; they are fanned out only
    # after level 1, on the distinct raw values.
    sources = list(dict.fromkeys(tuple(v) for v in srcs.values()))
    width = max(len(v) for v in sources)
    slots = [f"s{i}" for i in range(width)]
    entries = F.array(*[
        F.struct(
            F.lit(e).alias("__source"),
            *[(F.col(c).cast("string") if c is not None else F.lit(None).cast("string")).alias(slots[i])
              for i, c in enumerate(list(src) + [None] * (width - len(src)))],
        )
        for e, src in enumerate(sources)
    ])
    long = finalized_loans.select("default_flag", F.inline(entries))
    level1 = long.groupBy("__source", *slots).agg(*count_columns(False))
    fan_out = F.create_map(*[
        x for e, src in enumerate(sources)
        for x in (F.lit(e), F.array(*[F.lit(g) for g in groups if tuple(srcs[g]) == src]))
    ])
    pre = level1.withColumn(group_col, F.explode(fan_out[F.col("__source")])).drop("__source")

    def per_group(build: Callable[[int, Dimension, list[Column]], Column | None]) -> list[Column]:
        out = []
        for k in range(len(key_cols)):
            expr = None
            for g, dims in groups.items():
                if k >= len(dims):
                    continue  # a table with fewer keys leaves this key NULL
                offset = sum(len(_level1_sources(ALL_DIMENSIONS[d])) for d in dims[:k])
                d = ALL_DIMENSIONS[dims[k]]
                cols = [F.col(slots[offset + j]) for j in range(len(_level1_sources(d)))]
                e = build(k, d, cols)
                if e is None:
                    continue
                hit = F.col(group_col) == F.lit(g)
                expr = F.when(hit, e) if expr is None else expr.when(hit, e)
            out.append(expr)
        return out

    values = per_group(lambda k, d, cols: None if d.per_row else d.value_of(cols))
    bound = pre.withColumns({f"v{k}": v for k, v in enumerate(values) if v is not None})
    labels = per_group(lambda k, d, cols: cols[0] if d.per_row else d.label_of(cols, F.col(f"v{k}") if d.value else None))
    keyed = bound.withColumns(dict(zip(key_cols, labels)))
    agg = keyed.groupBy(group_col, *key_cols).agg(*count_columns(True))
    threshold = F.create_map(*[x for g in groups for x in (F.lit(g), F.lit(min_loans.get(g, 0)))])
    return finish_rates(agg, threshold[F.col(group_col)])


def rate_profile(loans: DataFrame, names: Sequence[str] | None = None, min_loans: Mapping[str, int] | None = None) -> DataFrame:
    """All single-key tables from ONE scan, long form (shared scan):
    ``dimension, label, loan_count, default_count, default_rate``."""
    names = list(names or DIMENSIONS)
    mins = {n: DIMENSIONS[n].min_loans for n in names}
    mins.update(min_loans or {})
    out = shared_rates(finalized(loans), {n: (n,) for n in names}, "dimension", ["label"], mins)
    return out.orderBy("dimension", "label")


def profile_slice(profile: DataFrame, name: str) -> DataFrame:
    """One dimension of :func:`rate_profile` in the single-table shape and order."""
    one = profile.filter(F.col("dimension") == name).select(F.col("label").alias(name), *RATE_COLUMNS)
    return order_rates(one, [name], DIMENSIONS[name].order)


def segment_profile(loans: DataFrame, names: Sequence[str] | None = None, min_loans: Mapping[str, int] | None = None) -> DataFrame:
    """Several two-key segments from ONE scan, long form:
    ``segment, key1, key2, loan_count, default_count, default_rate``."""
    names = list(names or SEGMENTS)
    mins = {n: DEFAULT_MIN_LOANS for n in names}
    mins.update(min_loans or {})
    return shared_rates(finalized(loans), {n: SEGMENTS[n] for n in names}, "segment", ["key1", "key2"], mins)


def published_rates(loans: DataFrame, profile_mins: Mapping[str, int], segment_mins: Mapping[str, int]) -> DataFrame:
    """Every rate table (14 dimensions, quarters, 5 segments) from ONE scan, long
    form: ``table, key1, key2`` and the rate columns; segments are named
    ``segment:<name>``.  Store it, then slice it."""
    groups: dict[str, Sequence[str]] = {n: (n,) for n in DIMENSIONS} | {"issue_quarter": ("issue_quarter",)}
    groups |= {f"segment:{s}": keys for s, keys in SEGMENTS.items()}
    mins = {n: DIMENSIONS[n].min_loans for n in DIMENSIONS} | dict(profile_mins) | {f"segment:{s}": n for s, n in segment_mins.items()}
    return shared_rates(finalized(loans), groups, "table", ["key1", "key2"], mins)


def published_key(table: Column, key1: Column, key2: Column) -> Column:
    """Total sort key of a row in its table's published order."""
    rate, n = -F.col("default_rate"), -F.col("loan_count")

    def key(place=F.lit(0), rate=F.lit(0.0), n=F.lit(0).cast("bigint")) -> Column:
        return F.struct(place.cast("int").alias("place"), rate.alias("rate"), n.alias("n"), key1.alias("key1"), key2.cast("string").alias("key2"))

    out = F.when(table.startswith("segment:"), key(rate=rate, n=n))
    for d in PROFILE_DIMENSIONS:
        if d.order != "key":
            by = key(rate=rate, n=n) if d.order == "rate_desc" else key(n=n) if d.order == "count_desc" else key(order_rank(key1, d.order))
            out = out.when(table == d.name, by)
    return out.otherwise(key())


def ranked_rates(published: DataFrame, store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """:func:`published_rates` with each row's ``rank`` in its table's published
    order, by ranges (no window over a table); rows without a quarter go."""
    rows = keep_groups(published, (F.col("table") != "issue_quarter") | F.col("key1").isNotNull())
    return ranked_within(rows, "table", [published_key(F.col("table"), F.col("key1"), F.col("key2"))], "rank", store)


def published_slice(published: DataFrame, name: str) -> DataFrame:
    """One table of :func:`published_rates` in its own shape and order."""
    keys = SEGMENTS[name.split(":")[1]] if name.startswith("segment:") else (name,)
    one = published.filter(F.col("table") == name)
    if name == "issue_quarter":
        one = one.filter(F.col("key1").isNotNull())
    one = one.select(*[F.col(f"key{i + 1}").alias(k) for i, k in enumerate(keys)], *RATE_COLUMNS)
    order = "rate_desc" if len(keys) > 1 else "key" if name == "issue_quarter" else DIMENSIONS[name].order
    return order_rates(one, list(keys), order)
