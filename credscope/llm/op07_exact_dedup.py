"""Exact dedup by deterministic block naming [native].

Every text is cut into fixed-size blocks.  The distinct blocks are sorted and
numbered, so equal blocks and only equal blocks share an integer name; then
adjacent names are paired, the distinct pairs are sorted and numbered again,
and so on until each document is one name.  No hash decides equality, so the
identity is collision-free.

Documents that no other one can equal need no names: the text's byte length,
first and last characters are compared first, and a document alone with these
is its own group (the usual early exit of naming by doubling).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, same_row, table, text_of

BLOCK = 4096
EDGE = 64


def _named(ws: Workspace, df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct values of ``cols`` with an integer name in sorted order.

    The sort is within the partitions that ``distinct`` dealt by value, and a
    name holds its partition's number.  Written before use: the names stay the
    same when a task runs again."""
    ranked = df.select(*cols).distinct().sortWithinPartitions(*cols)
    return ws.store(ranked.withColumn("name", F.monotonically_increasing_id()), "names")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, copies: one row per document.

    Null text counts as empty; all empty texts are one group.  Rows equal in
    doc_id and text are one document stored several times: one row returned,
    every copy counted in ``copies`` and ``group_size``.  A doc_id repeated with another text
    is another document.  The largest doc_id of a group stays; null is smaller
    than any.  Other columns are ignored; an empty table gives no rows.
    """
    ws = Workspace(docs.sparkSession, "exact-dedup")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).withColumn("sha", F.sha2("text", 256))
    slim = ws.store(
        rows.groupBy(
            "doc_id",
            "sha",
            F.octet_length("text").alias("size"),
            F.substring("text", 1, EDGE).alias("head"),
            F.substring("text", -EDGE, EDGE).alias("tail"),
        ).agg(F.count("*").alias("copies")),
        "slim",
    )
    edges = ["size", "head", "tail"]
    shared = slim.groupBy(*edges).agg(F.count("*").alias("n")).where("n > 1").select(*edges)
    candidates = slim.join(shared, edges).select("doc_id", "sha", "copies")

    blocks = F.when(F.col("text") == "", F.array(F.lit(""))).otherwise(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{block}}}"), F.lit(0)))
    level0 = ws.store(
        rows.join(candidates, same_row(rows, candidates, "doc_id") & (rows.sha == candidates.sha))
        .select(rows.doc_id, rows.sha, candidates.copies, blocks.alias("blocks"))
        .select("doc_id", "sha", "copies", F.size("blocks").alias("n_blocks"), F.posexplode("blocks").alias("pos", "block")),
        "blocks",
    )
    names = _named(ws, level0, ["block"])
    key = ["doc_id", "sha", "copies", "n_blocks"]
    current = ws.store(level0.join(names, "block").select(*key, "pos", "name"), "level")
    most = level0.agg(F.max("n_blocks")).first()[0] or 0

    settled, width, level = None, 1, 0
    while True:
        done = current.where(F.col("n_blocks") <= width).select("doc_id", "sha", "copies", F.lit(level).alias("level"), "name")
        settled = done if settled is None else settled.unionByName(done)
        if width >= most:
            break
        half = F.col("pos") % 2
        pairs = (
            current.where(F.col("n_blocks") > width)
            .groupBy(*key, F.expr("pos div 2").alias("pos"))
            .agg(F.max(F.when(half == 0, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(half == 1, F.col("name"))), F.lit(-1)).alias("b"))
        )
        pairs = ws.store(pairs, "pairs")
        current = ws.store(pairs.join(_named(ws, pairs, ["a", "b"]), ["a", "b"]).select(*key, "pos", "name"), "level")
        width, level = width * 2, level + 1

    settled = ws.store(settled.distinct(), "identity")
    groups = settled.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    found = settled.join(groups, ["level", "name"]).select("doc_id", "sha", "keep_id", "group_size")
    return (
        slim.join(found, same_row(slim, found, "doc_id") & (slim.sha == found.sha), "left")
        .select(
            slim.doc_id,
            F.when(found.sha.isNull(), slim.doc_id).otherwise(found.keep_id).alias("keep_id"),
            F.coalesce(found.group_size, slim.copies).alias("group_size"),
            slim.sha.alias("text_sha256"),
            slim.copies,
        )
        .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "copies")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, one of each group.

    Rows that repeat a doc_id and text are rare; any one of them stays."""
    kept = exact_groups(docs).where("kept").select(F.col("doc_id").alias("kept_id"), "text_sha256", "copies")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.sha2(text_of(), 256).alias("sha"))
    kept = Workspace(docs.sparkSession, "exact-dedup").store(kept, "kept")
    rows = rows.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("sha") == F.col("text_sha256")))
    one = rows.where("copies > 1").groupBy("id", "sha").agg(F.first("row").alias("row"))
    return rows.where("copies = 1").select("row.*").unionByName(one.select("row.*"))


def query(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS t FROM documents),
-- rows equal in doc_id and text are one document stored several times
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT DISTINCT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, d.text_sha256,
       count(*) OVER (PARTITION BY d.doc_id, d.text_sha256) AS copies
FROM d JOIN g USING (t)
"""
