"""Mixing sources to target weights by hash-threshold histograms [native].

Each document has a fixed hash.  A source's budget is met by whole passes over
it plus the documents whose hash is under a threshold, so a larger budget
always takes a superset.  The threshold comes from histograms: sizes summed by
source and hash bucket, then only the bucket in which the budget runs out is
cut into finer buckets, until a bucket is one hash value.  Nothing is sorted
but the at most ``2 ** LEVEL_BITS`` buckets of a source, and documents are
taken by a filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, Workspace, table, text_of

HASH_BITS = 60
LEVEL_BITS = 15
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """source, source_size, target.  ``sizes``: one row per source.

    Sources in code point order (null last) weigh ``weights`` in turn and
    share the total; no target is above ``most`` times its source, and the
    excess goes to the others by weight.  The windows run over the source
    list, one row per source.
    """
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(rank) - 1, F.lit(len(weights))) + 1).cast("int"))
    fill = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, all_rows = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    return (
        sizes.withColumn("weight", weight.cast("long"))
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
        .withColumn("place", F.row_number().over(fill))
        # a unit of weight gets this much if just the sources before are capped
        .withColumn("level", (F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double") / (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
        .withColumn("first_free", F.min(F.when(F.col("ratio") > F.col("level"), F.col("place"))).over(all_rows))
        .withColumn("unit", F.max(F.when(F.col("place") == F.col("first_free"), F.col("level"))).over(all_rows))
        .withColumn("target", F.when(F.col("first_free").isNull() | (F.col("place") < F.col("first_free")), F.col("cap").cast("double")).otherwise(F.col("unit") * F.col("weight")))
        .select("source", "source_size", "target")
    )


def _refine(docs: DataFrame, state: DataFrame, level: int) -> DataFrame:
    """One refinement.  ``state``: source, lo (start of the open interval),
    need (budget left in it).  At the last level ``lo`` becomes the threshold:
    the documents of the last hash value are taken if that is nearer."""
    span = HASH_BITS - LEVEL_BITS * level
    width = 1 << (span - LEVEL_BITS)
    last = span == LEVEL_BITS
    d, s = docs.alias("d"), state.alias("s")
    inside = (F.col("d.hash") >= F.col("s.lo")) & (F.col("d.hash") - F.col("s.lo") < F.lit(1 << span))
    hist = (
        d.join(s, F.col("d.source").eqNullSafe(F.col("s.source")) & inside)
        .groupBy("s.source", "s.lo", "s.need", F.expr(f"(d.hash - s.lo) div {width}L").alias("bucket"))
        .agg(F.sum("d.size").alias("mass"))
    )
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    hist = hist.withColumn("upto", F.sum("mass").over(run)).where(F.col("upto") > F.col("need"))
    edge = hist.groupBy("source").agg(F.min_by(F.struct("bucket", "mass", "upto"), "bucket").alias("edge"))
    left = F.col("s.need") - (F.col("e.edge.upto") - F.col("e.edge.mass"))
    lo = F.col("s.lo") + F.col("e.edge.bucket") * F.lit(width)
    if last:
        lo = lo + F.when(F.col("e.edge.mass") <= 2 * left, 1).otherwise(0)
    return (
        s.join(edge.alias("e"), F.col("s.source").eqNullSafe(F.col("e.source")), "left")
        .select(F.col("s.source").alias("source"), F.coalesce(lo, F.col("s.lo") + F.lit(1 << span)).alias("lo"), F.coalesce(left, F.lit(0.0)).alias("need"), "s.passes", "s.source_size", "s.target")
    )


def _hash(seed: str) -> Column:
    """The document's number below 2 ** HASH_BITS, by doc_id and text."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text_of().cast("binary"))).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def thresholds(ws: Workspace, slim: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """source, lo (the hash under which documents are taken once more), passes,
    source_size, target.  ``slim``: source, size, hash of every row."""
    targets = source_targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = targets.select("source", F.lit(0).cast("long").alias("lo"), (F.col("target") - passes * F.col("source_size")).alias("need"), passes.alias("passes"), "source_size", "target")
    for level in range(HASH_BITS // LEVEL_BITS):
        # each level reads the state twice: stored, or the work would double by level
        state = ws.store(_refine(slim, state, level), "state")
    return state


def _slim(ws: Workspace, docs: DataFrame, seed: str) -> DataFrame:
    return ws.store(docs.select("doc_id", "source", F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"), _hash(seed).alias("hash")), "sizes")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: str = "mix") -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, source: one row per row.

    ``copies``: how often the mix holds the document (0 to ``most``); ``taken``
    is copies times size.  A source's taken words differ from its target by at
    most half the words of the documents that share the last hash value.

    Null text has size 0.  Null is a source of its own.  The hash is that of
    doc_id and text, so rows without a doc_id or with the same one are told
    apart by their texts; rows equal in both are taken together.  Other columns
    are ignored; an empty table gives no rows.
    """
    ws = Workspace(docs.sparkSession, "mixing")
    slim = _slim(ws, docs, seed)
    d, s = slim.alias("d"), thresholds(ws, slim, weights, most).alias("s")
    copies = F.col("s.passes") + F.when(F.col("d.hash") < F.col("s.lo"), 1).otherwise(0)
    return d.join(s, F.col("d.source").eqNullSafe(F.col("s.source"))).select("d.doc_id", "d.size", "s.source_size", "s.target", (F.col("d.size") * copies).alias("taken"), copies.alias("copies"), F.col("d.source").alias("source"))


def take(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: str = "mix") -> DataFrame:
    """The mix itself: the rows of ``docs``, all columns as they are, each as
    often as ``mix`` has it."""
    ws = Workspace(docs.sparkSession, "mixing")
    s = thresholds(ws, _slim(ws, docs, seed), weights, most).alias("s")
    rows = docs.select(F.struct("*").alias("row"), F.col("source").alias("key"), _hash(seed).alias("hash"))
    copies = F.col("passes") + F.when(F.col("hash") < F.col("lo"), 1).otherwise(0)
    rows = rows.join(s, F.col("key").eqNullSafe(F.col("s.source"))).select("row", copies.alias("copies")).where("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")


def query(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"))


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS hash
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM d GROUP BY source),
r AS (
  SELECT *, (3 * source_size)::DOUBLE / weight AS ratio,
         row_number() OVER (ORDER BY (3 * source_size)::DOUBLE / weight, source ASC NULLS LAST) AS place FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM r),
f AS (SELECT min(place) FILTER (WHERE ratio > level) AS first_free FROM l),
t AS (
  SELECT l.source, l.source_size,
         CASE WHEN f.first_free IS NULL OR l.place < f.first_free THEN (3 * l.source_size)::DOUBLE
              ELSE (SELECT level FROM l AS x WHERE x.place = f.first_free) * l.weight END AS target
  FROM l, f),
n AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes FROM t),
c AS (
  SELECT d.*, n.source_size, n.target, n.passes, n.target - n.passes * n.source_size AS need,
         sum(size) OVER (PARTITION BY d.source ORDER BY hash RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(size) OVER (PARTITION BY d.source, hash) AS mass
  FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, size, source_size, target,
       (size * (passes + CASE WHEN upto - mass < need AND (upto <= need OR mass <= 2 * (need - (upto - mass))) THEN 1 ELSE 0 END))::BIGINT AS taken,
       (passes + CASE WHEN upto - mass < need AND (upto <= need OR mass <= 2 * (need - (upto - mass))) THEN 1 ELSE 0 END)::BIGINT AS copies,
       source
FROM c
"""
