"""Helpers shared by the corpus operators: tables, shared storage, words."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from credscope.session import ensure_checkpoint_dir

#: A word of the contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Workspace:
    """A fresh folder in the shared checkpoint folder, one per operator call.

    ``store`` writes a frame as Parquet there and reads it back.  This cuts
    lineage (a lost executor re-reads files instead of recomputing shuffles)
    and fixes values such as assigned names, which must not change when a task
    runs again.
    """

    def __init__(self, spark: SparkSession, operator: str):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{operator}-{uuid.uuid4().hex}"
        self._n = 0
        self._at: dict[int, str] = {}
        self._held: list[DataFrame] = []  # so that no id is used twice

    def store(self, df: DataFrame, name: str = "t") -> DataFrame:
        self._n += 1
        target = f"{self.path}/{self._n:03d}-{name}"
        df.write.parquet(target)
        kept = self.spark.read.schema(df.schema).parquet(target)
        self._at[id(kept)] = target
        self._held.append(kept)
        return kept

    def drop(self, *frames: DataFrame) -> None:
        """Deletes stored frames that nothing reads any more; others are left
        alone.  Frames that a result still reads must not be dropped."""
        jvm = self.spark._jvm
        for df in frames:
            target = self._at.pop(id(df), None)
            if target:
                path = jvm.org.apache.hadoop.fs.Path(target)
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def text_of(col: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from (null doc_id: held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def same_row(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of key columns, for joins on keys that may be null."""
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right[n])
    return cond
