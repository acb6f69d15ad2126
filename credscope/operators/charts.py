"""Chart-ready datasets (C1-C5) with min-max scaling (W4), axis-tick thinning
(W5), top-k labelling (W2, W3) and label formatting (P23).

Nothing is drawn; each function returns the rows a plotting layer needs.
All charts of a kind are one long table keyed by ``chart``: scales, axis
positions, ranks and top-k limits are windows partitioned by that key, so the
charts of a report are computed together and apart from each other.  The
functions for one table add the key and take it off again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import min_max_scaled, round_exact
from ..functions.values import (
    BAR_LABEL_WIDTH,
    SCALE_SPAN_FLOOR,
    SEGMENT_LABEL_WIDTH,
    TICK_TARGET,
    TOP_SCATTER_LABELS,
    TOP_SEGMENTS,
)


KEY = "chart"


def _chart(*order: Column):
    by = Window.partitionBy(KEY)
    return by.orderBy(*order) if order else by


def with_stats(df: DataFrame, **stats: Column) -> DataFrame:
    """Attach aggregates over each chart as ``__s.<name>``."""
    return df.withColumn("__s", F.struct(*[c.over(_chart()).alias(n) for n, c in stats.items()]))


def long_charts(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Charts of the same columns as one long table."""
    return reduce(DataFrame.unionByName, [df.withColumn(KEY, F.lit(name)) for name, df in parts.items()])


def one_chart(datasets: DataFrame, chart: str) -> DataFrame:
    return datasets.filter(F.col(KEY) == chart).drop(KEY)


def _single(df: DataFrame) -> DataFrame:
    return df.withColumn(KEY, F.lit("one"))


def percent_text(value: Column | str, digits: int = 1) -> Column:
    """Python ``f"{v:.1%}"``: scale by 100 in double, round exactly, format."""
    v = F.col(value) if isinstance(value, str) else value
    r = round_exact(v * F.lit(100.0), digits)
    return F.concat(F.format_string(f"%.{digits}f", r), F.lit("%"))


def value_text(value: Column | str) -> Column:
    """Bar annotation: percent for values <= 1, else a whole number."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(v <= 1, percent_text(v)).otherwise(F.format_string("%.0f", round_exact(v, 0)))


def _scaled(v: Column, lo: Column, hi: Column) -> Column:
    return min_max_scaled(v, lo, hi, SCALE_SPAN_FLOOR)


def top_charts(long: DataFrame, order: Sequence[Column], limits: Mapping[str, int] | int) -> DataFrame:
    """The first rows of each chart in ``order``, with their 1-based
    ``rank``.  The largest limit is a constant, so Spark cuts each chart down
    before the shuffle (group limit); smaller limits then apply by chart."""
    most = limits if isinstance(limits, int) else max(limits.values())
    head = long.withColumn("rank", F.row_number().over(_chart(*order)).cast("bigint")).filter(F.col("rank") <= most)
    if isinstance(limits, int):
        return head
    of = F.create_map(*[x for c, n in limits.items() for x in (F.lit(c), F.lit(n))])
    return head.filter(F.col("rank") <= of[F.col(KEY)])


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The same for one table."""
    return top_charts(_single(df), order, n).drop(KEY)


def bar_datasets(long: DataFrame) -> DataFrame:
    """C1 of ``chart, label, value`` (and ``rank``, if given): with ``label_text``,
    ``scaled`` (the bar height ``value / max(value)``, 0 when the maximum is 0)
    and ``value_label``."""
    s = with_stats(long, vmax=F.max("value"))
    vmax = F.col("__s.vmax")
    extra = [c for c in long.columns if c == "rank"]
    return s.select(
        KEY, *extra,
        F.col("label").cast("string").alias("label"),
        F.substring(F.col("label").cast("string"), 1, BAR_LABEL_WIDTH).alias("label_text"),
        "value",
        round_exact(F.when(vmax != 0, F.col("value") / vmax).otherwise(F.lit(0.0)), 4).alias("scaled"),
        value_text("value").alias("value_label"),
    )


def bar_dataset(df: DataFrame, label: str, value: str = "default_rate") -> DataFrame:
    """C1 of one table; ``rank`` is kept."""
    extra = [c for c in df.columns if c == "rank"]
    return bar_datasets(_single(df.select(*extra, F.col(label).alias("label"), F.col(value).alias("value")))).drop(KEY)


def _tick(position: Column, n: Column) -> Column:
    step = F.greatest(F.floor(n / F.lit(TICK_TARGET)), F.lit(1))
    return (position % step) == 0


def line_datasets(long: DataFrame) -> DataFrame:
    """C2 of ``chart, label, value``: ordered ``position, label, value, scaled, tick`` (W4 + W5)."""
    s = with_stats(long, lo=F.min("value"), hi=F.max("value"), n=F.count(F.lit(1)))
    p = s.withColumn("position", (F.row_number().over(_chart(F.col("label"))) - 1).cast("bigint"))
    return p.select(
        KEY, "position", "label", "value",
        round_exact(_scaled(F.col("value"), F.col("__s.lo"), F.col("__s.hi")), 4).alias("scaled"),
        _tick(F.col("position"), F.col("__s.n")).alias("tick"),
    )


def line_dataset(df: DataFrame, label: str, value: str = "default_rate", exclude: Sequence[str] = ("Unknown",)) -> DataFrame:
    """C2 of one table."""
    kept = df.filter(~F.col(label).isin(*exclude)) if exclude else df
    return line_datasets(_single(kept.select(F.col(label).alias("label"), F.col(value).alias("value")))).drop(KEY)


# Overlay series of the period charts: (series name, column, multiplier).
OVERLAY_SERIES = (
    ("Default Rate", "default_rate", 100.0),
    ("Fed Funds", "avg_fed_funds_rate", 1.0),
    ("Unemployment", "avg_unemployment_rate", 1.0),
)


def overlay_rows(df: DataFrame, label: str, series=OVERLAY_SERIES) -> DataFrame:
    """``label, series, value``: the series of a period table as rows."""
    entries = F.array(*[F.struct(F.lit(name).alias("series"), (F.col(c) * F.lit(m)).alias("value")) for name, c, m in series])
    return df.select(F.col(label).alias("label"), F.inline(entries))


def overlay_datasets(long: DataFrame) -> DataFrame:
    """C3 of ``chart, label, series, value``: ``position, label, series, value,
    scaled, tick``; one scale is shared by all series of a chart (min and max
    over every series value), and a label has one position for all series."""
    s = with_stats(long, lo=F.min("value"), hi=F.max("value"))
    placed = s.withColumn("position", (F.dense_rank().over(_chart(F.col("label"))) - 1).cast("bigint"))
    placed = placed.withColumn("n_labels", F.max("position").over(_chart()) + 1)
    return placed.select(
        KEY, "position", "label", "series",
        round_exact("value", 4).alias("value"),
        round_exact(_scaled(F.col("value"), F.col("__s.lo"), F.col("__s.hi")), 4).alias("scaled"),
        _tick(F.col("position"), F.col("n_labels")).alias("tick"),
    )


def overlay_dataset(df: DataFrame, label: str, series=OVERLAY_SERIES) -> DataFrame:
    """C3 of one table."""
    return overlay_datasets(_single(overlay_rows(df, label, series))).drop(KEY)


def scatter_rows(df: DataFrame, x: str, y: str, label: str = "state", ties: bool = False) -> DataFrame:
    """``label, x, y, ties`` of the points with both coordinates."""
    points = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return points.select(F.col(label).alias("label"), F.col(x).alias("x"), F.col(y).alias("y"), F.lit(ties).alias("ties"))


def scatter_datasets(long: DataFrame, top: int = TOP_SCATTER_LABELS) -> DataFrame:
    """C4 of ``chart, label, x, y, ties``: points scaled per axis, and a label
    flag for the ``top`` highest ``y``: by row position (W2, ties broken by
    label) or, with ``ties``, every point with ``y`` >= the top-th largest (W3)."""
    s = with_stats(long, x_lo=F.min("x"), x_hi=F.max("x"), y_lo=F.min("y"), y_hi=F.max("y"))
    place = F.when(F.col("ties"), F.rank().over(_chart(F.desc("y")))).otherwise(F.row_number().over(_chart(F.desc("y"), F.col("label"))))
    return s.select(
        KEY, "label", "x", "y",
        round_exact(_scaled(F.col("x"), F.col("__s.x_lo"), F.col("__s.x_hi")), 4).alias("x_scaled"),
        round_exact(_scaled(F.col("y"), F.col("__s.y_lo"), F.col("__s.y_hi")), 4).alias("y_scaled"),
        (place <= top).alias("labelled"),
    )


def scatter_dataset(df: DataFrame, x: str, y: str, label: str = "state", top: int = TOP_SCATTER_LABELS, ties: bool = False) -> DataFrame:
    """C4 of one table."""
    return scatter_datasets(_single(scatter_rows(df, x, y, label, ties)), top).drop(KEY)


def segment_bar_datasets(long: DataFrame, top: int = TOP_SEGMENTS) -> DataFrame:
    """C5 of ``chart, key1, key2, default_rate, loan_count``: each chart's
    ``top`` riskiest segments (rounded rate desc, count desc, keys) as ``rank,
    label, default_rate, loan_count, scaled, value_label``; the label is
    ``"k1 / k2"`` cut to 24 characters."""
    order = [F.desc("default_rate"), F.desc("loan_count"), F.col("key1"), F.col("key2")]
    s = with_stats(top_charts(long, order, top), vmax=F.max("default_rate"))
    vmax = F.col("__s.vmax")
    return s.select(
        KEY, "rank",
        F.substring(F.concat_ws(" / ", "key1", "key2"), 1, SEGMENT_LABEL_WIDTH).alias("label"),
        "default_rate", "loan_count",
        round_exact(F.when(vmax != 0, F.col("default_rate") / vmax).otherwise(F.lit(0.0)), 4).alias("scaled"),
        F.concat(percent_text("default_rate"), F.lit(" ("), F.col("loan_count").cast("string"), F.lit(")")).alias("value_label"),
    )


def segment_bars(segments: DataFrame, keys: Sequence[str], top: int = TOP_SEGMENTS) -> DataFrame:
    """C5 of one segment table."""
    k1, k2 = (F.col(k).cast("string") for k in keys)
    return segment_bar_datasets(_single(segments.select(k1.alias("key1"), k2.alias("key2"), "default_rate", "loan_count")), top).drop(KEY)
