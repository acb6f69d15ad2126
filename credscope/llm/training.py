"""Bounded samples of labelled documents, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """doc_id, text, label of at most ``bound`` labelled rows that aren't held out.

    The ``bound`` labelled ids with the smallest hash are taken, so the sample
    depends on the ids alone.  Null ids and labels are left out; labels that
    disagree on an id count by their majority (ties: 1).  The ids are at most
    ``bound`` rows, whatever the tables' size, and so are broadcast.  Of rows
    that share an id the one with the smallest text hash is taken.
    """
    clear = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    ids = clear.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("doc_id", "text", "label")
