"""Connected components of a link table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to its smallest one."""
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """u, v: every node with a link and the smallest node it can reach (v < u;
    smallest nodes themselves have no row).  Minima are combined before each
    shuffle, so a node with very many links is no hot group; every step is
    written, and the loop ends when a step changes nothing."""
    mark = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    edges = ws.store(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = mark(edges)
    while before[0]:
        old, edges = edges, ws.store(_small_star(_large_star(edges)), "star")
        ws.drop(old)
        now = mark(edges)
        if now == before:
            break
        before = now
    return edges
