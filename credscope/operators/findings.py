"""Headline facts as a long table.

The published analyses state facts in prose ("highest-risk state is X at
Y%").  Here each fact is one row ``finding, label, value, n``.  Facts that
pick a row from a result table are computed for all tables at once: one
grouped aggregate of ``min_by``/``max_by`` over a total sort key per
dimension (first wins on ties because the key ends in the label).  Row counts,
overall rate and correlations of several result tables come from one aggregate
(:func:`fold`).  So the whole report costs a handful of small aggregates, not
one job per fact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import outcome_flag
from ..functions.numeric import pearson, ratio, round_exact
from ..functions.values import ANNUAL_MACRO_FEATURES, QUARTERLY_MACRO_FEATURES, STATE_FEATURES
from . import rates

FINDING_COLUMNS = ("finding", "label", "value", "n")

FINDING_SEGMENTS = ("grade_term", "grade_purpose", "interest_fico", "state_grade")
FINDING_LOOKUPS = (
    ("corr_rate_vs_interest", "default_rate", "avg_interest_rate"),
    ("corr_rate_vs_fico", "default_rate", "avg_fico"),
    ("corr_rate_vs_poverty", "default_rate", "ers_poverty_rate_2023"),
    ("corr_resid_interest_vs_poverty", "default_residual_after_avg_interest", "ers_poverty_rate_2023"),
    ("corr_resid_fico_vs_poverty", "default_residual_after_avg_fico", "ers_poverty_rate_2023"),
)
# (finding, dimension, last row instead of first)
FINDING_PICKS = (
    ("grade_first", "grade", False),
    ("grade_last", "grade", True),
    ("interest_bin_first", "interest_bin", False),
    ("interest_bin_last", "interest_bin", True),
    ("state_top", "state", False),
    ("purpose_top", "purpose", False),
    ("loan_amount_bin_last", "loan_amount_bin", True),
)


def _shape(df: DataFrame, finding: Column, label: Column, value: Column, n: Column) -> DataFrame:
    return df.select(
        finding.alias("finding"),
        label.cast("string").alias("label"),
        value.cast("double").alias("value"),
        n.cast("bigint").alias("n"),
    )


def profile_picks(profile: DataFrame, picks: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Facts from the long single-key profile (:func:`rates.rate_profile`).

    ``picks`` holds ``(finding, dimension, kind)`` with kind ``first`` /
    ``last`` (in the table's published order) or ``highest`` (highest rate,
    then first label: ``max(rows, key=rate)`` over a key-ordered table).
    """
    row = F.struct("label", "default_rate", "loan_count")
    keyed = profile.withColumn("k", rates.published_key(F.col("dimension"), F.col("label"), F.lit(None)))
    best = keyed.groupBy("dimension").agg(
        F.min_by(row, "k").alias("first"),
        F.max_by(row, "k").alias("last"),
        F.min_by(row, F.struct(-F.col("default_rate"), F.col("label"))).alias("highest"),
    )
    entries = F.array(*[
        F.struct(F.lit(f).alias("finding"), F.lit(d).alias("want_dimension"), F.lit(kind).alias("kind"))
        for f, d, kind in picks
    ])
    wanted = best.select("dimension", "first", "last", "highest", F.inline(entries))
    hit = wanted.filter(F.col("dimension") == F.col("want_dimension"))
    chosen = F.when(F.col("kind") == "first", F.col("first")).when(F.col("kind") == "last", F.col("last")).otherwise(F.col("highest"))
    return _shape(hit.withColumn("p", chosen), F.col("finding"), F.col("p.label"), F.col("p.default_rate"),
                  F.col("p.loan_count"))


def segment_tops(segments: DataFrame, names: Sequence[tuple[str, str]]) -> DataFrame:
    """Top row (O5 order) of each segment in the long segment profile,
    labelled ``"k1 / k2"``; ``names`` holds ``(finding, segment)``."""
    row = F.struct(F.concat_ws(" / ", "key1", "key2").alias("label"), "default_rate", "loan_count")
    key = F.struct(-F.col("default_rate"), -F.col("loan_count"), F.col("key1"), F.col("key2"))
    best = segments.groupBy("segment").agg(F.min_by(row, key).alias("p"))
    finding = F.create_map(*[x for f, s in names for x in (F.lit(s), F.lit(f))])[F.col("segment")]
    return _shape(best.filter(finding.isNotNull()), finding, F.col("p.label"), F.col("p.default_rate"), F.col("p.loan_count"))


def lookups(matrix: DataFrame, specs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Correlations of ``(finding, target, feature)`` from the long matrix;
    absent pairs give no row."""
    pair = F.concat_ws(" ~ ", "target", "feature")
    finding = F.create_map(*[x for f, t, x_ in specs for x in (F.lit(f"{t} ~ {x_}"), F.lit(f))])[pair]
    return _shape(matrix.filter(finding.isNotNull()), finding, pair, F.col("correlation"), F.lit(None))


@dataclass(frozen=True)
class Fact:
    """A fact that an aggregate over one result table gives: a correlation of
    two columns, a sum of one over a sum of another, a sum, or the row count."""

    finding: str
    source: str
    correlate: tuple[str, str] | None = None
    ratio: tuple[str, str] | None = None
    count: str | None = None
    label: str | None = None


def fold(sources: Mapping[str, DataFrame], facts: Sequence[Fact]) -> DataFrame:
    """All ``facts`` from one aggregate, whose state holds every fact's partial
    results side by side: the tables are stacked, each with its own columns, so
    a row feeds only the facts of its table."""
    used = {s: sorted({c for f in facts if f.source == s for c in (*(f.correlate or ()), *(f.ratio or ()), *([f.count] if f.count else []))}) for s in sources}
    name = lambda s, c: f"{s}__{c}"
    stacked = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [df.select(F.lit(1).alias(name(s, "rows")), *[F.col(c).alias(name(s, c)) for c in used[s]]) for s, df in sources.items()])
    state = []
    for i, f in enumerate(facts):
        of = lambda c: name(f.source, c)
        value, n = F.lit(None).cast("double"), F.count(of("rows"))
        if f.correlate:
            value, n = round_exact(pearson(*map(of, f.correlate)), 4), F.lit(None)
        elif f.ratio:
            value, n = round_exact(ratio(F.sum(of(f.ratio[0])), F.sum(of(f.ratio[1]))), 4), F.sum(of(f.ratio[1]))
        elif f.count:
            n = F.coalesce(F.sum(of(f.count)), F.lit(0))
        state.append(F.struct(F.lit(f.finding).alias("finding"), F.lit(f.label).cast("string").alias("label"), value.alias("value"), n.cast("bigint").alias("n")).alias(f"f{i}"))
    return stacked.agg(*state).select(F.inline(F.array(*[f"f{i}" for i in range(len(facts))])))


def outcome_totals(statuses: DataFrame) -> DataFrame:
    """``all_rows, usable, skipped, defaults`` of each status."""
    flag, n = outcome_flag("loan_status"), F.col("count")
    return statuses.select(n.alias("all_rows"), F.when(flag.isNotNull(), n).otherwise(0).alias("usable"), F.when(flag.isNull(), n).otherwise(0).alias("skipped"), (flag * n).alias("defaults"))


# Facts by table: rows read and used, matched periods and states, correlations.
FOLDED = (
    Fact("all_rows", "statuses", count="all_rows"),
    Fact("usable_rows", "statuses", count="usable"),
    Fact("skipped_rows", "statuses", count="skipped"),
    Fact("overall_default_rate", "statuses", ratio=("defaults", "usable")),
    Fact("segment_input_rows", "statuses", count="all_rows"),
    Fact("segment_usable_rows", "statuses", count="usable"),
    Fact("loan_quarters", "quarters"),
    Fact("matched_years", "years_macro"),
    Fact("matched_quarters", "quarters_macro"),
    Fact("matched_states", "states_economics"),
    Fact("control_states", "control"),
    *[Fact(f"corr_year_{c}", "years_macro", correlate=(c, "default_rate"), label=f"default_rate ~ {c}") for c in ANNUAL_MACRO_FEATURES],
    *[Fact(f"corr_quarter_{c}", "quarters_macro", correlate=(c, "default_rate"), label=f"default_rate ~ {c}") for c in QUARTERLY_MACRO_FEATURES],
    *[Fact(f"corr_state_{c}", "states_economics", correlate=(c, "default_rate"), label=f"default_rate ~ {c}") for c in STATE_FEATURES],
)


def union_findings(parts: Sequence[DataFrame], order: Sequence[str]) -> DataFrame:
    """Stack findings, ordered by the position of ``finding`` in ``order``."""
    rank = F.create_map(*[x for i, f in enumerate(order) for x in (F.lit(f), F.lit(i))])
    cols = [p.select(*FINDING_COLUMNS) for p in parts]
    return reduce(DataFrame.unionByName, cols).orderBy(rank[F.col("finding")]).select(*FINDING_COLUMNS)


def assemble(profile: DataFrame, segments: DataFrame, matrix: DataFrame, sources: Mapping[str, DataFrame]) -> DataFrame:
    """The headline facts from the result tables: ``profile`` (dimension,
    label, counts, rate), ``segments`` (segment, key1, key2, ...), the
    correlation ``matrix``, and the tables that ``FOLDED`` names."""
    picks = [(f, d, "last" if last else "first") for f, d, last in FINDING_PICKS] + [("term_highest", "term", "highest")]
    seg_names = [(f"segment_{s}_top", s) for s in FINDING_SEGMENTS]
    order = [p[0] for p in picks] + [f for f, _ in seg_names] + [f for f, _, _ in FINDING_LOOKUPS] + [f.finding for f in FOLDED]
    return union_findings([profile_picks(profile, picks), segment_tops(segments, seg_names), lookups(matrix, FINDING_LOOKUPS), fold(sources, FOLDED)], order)
