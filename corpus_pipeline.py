"""The corpus pipeline: from raw documents to packed training sequences.

Each stage reads the Parquet table that the stage before it wrote.  All but the
last return the columns of ``documents``; every stage decides on all rows that
are left, and its decisions hold for the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from credscope.llm import op01_mixing, op02_minhash, op04_packing, op07_exact_dedup, op10_quality
from credscope.llm.common import Workspace, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores under its cut go.  It is trained
    on labelled rows of ``documents`` as given, whatever ``docs`` holds.

    Every row is judged by its own text, null as empty, so repeated rows go or
    stay together; an empty ``docs`` gives no rows."""
    trees = op10_quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return op10_quality.keep_good(docs, trees)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays.

    Null counts as empty, and all empty texts are one group; a null doc_id is
    smaller than any; of rows equal in doc_id and text one stays."""
    return op07_exact_dedup.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similarity the one with the smallest doc_id stays.

    Texts without words (null, empty, white) are linked with nothing and stay;
    a null doc_id is larger than any; rows that repeat the doc_id and text of
    one that stays do too."""
    return op02_minhash.keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source by its target: documents are left out or repeated.

    Rows without source are a source of their own; texts without words weigh
    nothing; rows equal in doc_id and text are taken together."""
    return op01_mixing.take(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences; a repeated document gives its pieces again.

    Null or empty text is the end id alone; very long texts are cut over as
    many sequences as they need."""
    return op04_packing.pack(docs, op04_packing.default_ranks())


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

#: Classifier, sketches and tokens can't be expressed in SQL; a test compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    ws = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = ws.store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
