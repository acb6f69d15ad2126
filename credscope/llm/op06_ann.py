"""Approximate nearest neighbours by a forest of random-projection trees.

The trees are grown on a bounded sample: a node splits its vectors by the plane
halfway between two of them.  Every vector of the table is then sent down every
tree to its leaf.  A query searches all trees through one priority queue,
ordered by how far it lies from the planes that separate it from a branch, and
takes the best leaves of the whole forest.  Their members are compared exactly,
in blocks of one leaf, and the nearest of all blocks stay.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace, table

SAMPLE = 50_000
#: Bytes of doubles at most that the sample may hold on the driver.
SAMPLE_BYTES = 256 << 20
TREES = 10
LEAF = 256
LEAVES = 240
BLOCK = 4096
NEAREST = 10


@dataclass
class Forest:
    """Nodes of all trees; a child below 0 is the leaf ``-1 - child``."""

    roots: np.ndarray
    normal: np.ndarray
    offset: np.ndarray
    child: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        out = np.empty((len(x), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            at = np.full(len(x), root)
            live = np.flatnonzero(at >= 0)
            while len(live):
                side = (np.einsum("ij,ij->i", x[live], self.normal[at[live]]) > self.offset[at[live]]).astype(int)
                at[live] = self.child[at[live], side]
                live = live[at[live] >= 0]
            out[:, t] = -1 - at
        return out

    def search(self, q: np.ndarray, leaves: int) -> list[int]:
        """The best leaves of the forest for one vector."""
        queue = [(-np.inf, int(r)) for r in self.roots]
        heapq.heapify(queue)
        found: list[int] = []
        while queue and len(found) < leaves:
            far, node = heapq.heappop(queue)
            if node < 0:
                found.append(-1 - node)
                continue
            margin = float(q @ self.normal[node] - self.offset[node])
            near = int(margin > 0)
            heapq.heappush(queue, (far, int(self.child[node, near])))
            heapq.heappush(queue, (max(far, abs(margin)), int(self.child[node, 1 - near])))
        return found


def grow(sample: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 0) -> Forest:
    rng = np.random.default_rng(seed)
    normal, offset, child, roots, leaves = [], [], [], [], 0
    for _ in range(trees):
        todo = [(np.arange(len(sample)), None, 0)]
        root = None
        while todo:
            rows, parent, side = todo.pop()
            at = None
            if len(rows) > leaf:
                for _ in range(5):
                    a, b = sample[rng.choice(rows, 2, replace=False)]
                    size = np.linalg.norm(a - b)
                    if size > 0:
                        n = (a - b) / size
                        cut = float(n @ (a + b) / 2)
                        right = sample[rows] @ n > cut
                        if 0.1 < right.mean() < 0.9:
                            at = len(normal)
                            normal.append(n)
                            offset.append(cut)
                            child.append([0, 0])
                            todo += [(rows[~right], at, 0), (rows[right], at, 1)]
                            break
            if at is None:
                at = -1 - leaves
                leaves += 1
            if parent is None:
                root = at
            else:
                child[parent][side] = at
        roots.append(root)
    dim = sample.shape[1]
    return Forest(np.array(roots, np.int64), np.array(normal, float).reshape(-1, dim), np.array(offset, float), np.array(child, np.int64).reshape(-1, 2))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one dimension without nulls, as doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v: rows with an id and a finite vector that isn't zero.  Floats
    stay floats, half the bytes to shuffle; all else is cast to doubles.
    Of several dimensions the most frequent one counts (ties: the larger)."""
    v = F.col(vector_col)
    if vectors.select(v).schema[0].dataType.simpleString() != "array<float>":
        v = F.transform(v, lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    ok = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.where(F.coalesce(ok, F.lit(False)))
    size = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("n")).first()
    return rows.where(F.size("v") == (size["n"] if size else 1))


def _nearest(k: int):
    """Sorted rows (cell, salt, kind, vec_id, v): the members of a block, then its queries.

    Of the copies of an id the nearest counts, before the ``k`` best are taken."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, vectors, block = None, [], [], None
        out: list[list] = [[], [], []]
        for batch in batches:
            cells, salts, kinds, names = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            values = _matrix(batch.column(4))
            for i in range(len(batch)):
                if key != (cells[i], salts[i]):
                    key, ids, vectors, block = (cells[i], salts[i]), [], [], None
                if kinds[i] == 0:
                    ids.append(names[i])
                    vectors.append(values[i])
                    continue
                if not ids:
                    continue
                if block is None:
                    block = (np.array(ids), np.array(vectors), len(set(ids)) < len(ids))
                others = block[0] != names[i]
                d = np.sqrt(((block[1][others] - values[i]) ** 2).sum(axis=1))
                best = np.lexsort((block[0][others], d))
                if block[2]:
                    best = best[np.sort(np.unique(block[0][others][best], return_index=True)[1])]
                best = best[:k]
                for column, new in zip(out, (np.full(len(best), names[i]), block[0][others][best], d[best])):
                    column.extend(new.tolist())
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)
                out = [[], [], []]

    return run


def search(vectors: DataFrame, every: int = 100, k: int = NEAREST, id_col: str = "vec_id", vector_col: str = "embedding", sample: int = SAMPLE, trees: int = TREES, leaves: int = LEAVES, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found of each query.

    Queries are the rows whose id is divisible by ``every``; candidates are all
    rows of another id; the score is the Euclidean distance, ties go to the
    smaller id.  Rows without id, and vectors that are null, empty, zero or hold
    null or non-finite numbers, take no part, nor do vectors of a rarer
    dimension.  Rows that repeat an id are one candidate and one query, at the
    distance of the nearest copies.  Other columns are ignored; an empty table
    gives no rows.

    The forest is grown on the ``sample`` rows with the smallest hashes of id,
    fewer where these would hold more than ``SAMPLE_BYTES`` (bounded, and so is
    the broadcast forest).  A leaf's members are dealt into
    blocks of about ``block`` rows, so a leaf of very many equal vectors is
    spread over tasks.
    """
    ws = Workspace(vectors.sparkSession, "ann")
    rows = ws.store(usable(vectors, id_col, vector_col), "vectors")
    size = rows.select(F.size("v").alias("n")).first()
    sample = min(sample, max(2, SAMPLE_BYTES // (8 * size["n"]))) if size else sample
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample).select("v").toArrow()
    if not picked.num_rows:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    forest = vectors.sparkSession.sparkContext.broadcast(grow(_matrix(picked.column("v").combine_chunks()), trees))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = forest.value.leaves(_matrix(batch.column(1))) if len(batch) else np.zeros((0, trees), np.int64)
            for t in range(found.shape[1]):
                yield pa.RecordBatch.from_arrays([pa.array(found[:, t]), batch.column(0), batch.column(1)], names=["cell", "vec_id", "v"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [forest.value.search(q, leaves) for q in _matrix(batch.column(1))] if len(batch) else []
            at = np.repeat(np.arange(len(batch)), [len(f) for f in found]) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([c for f in found for c in f], pa.int64()), batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at))], names=["cell", "vec_id", "v"])

    shape = f"cell long, vec_id long, v {rows.schema['v'].dataType.simpleString()}"
    members, visits = rows.mapInArrow(index, shape), rows.where(F.pmod("vec_id", F.lit(every)) == 0).mapInArrow(visit, shape)
    sizes = ws.store(members.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("int").alias("salts")), "sizes")
    dealt = members.join(sizes, "cell").select("cell", F.pmod(F.xxhash64("vec_id"), F.col("salts")).alias("salt"), F.lit(0).alias("kind"), "vec_id", "v")
    asked = visits.join(sizes, "cell").select("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts").cast("long") - 1)).alias("salt"), F.lit(1).alias("kind"), "vec_id", "v")
    both = dealt.unionByName(asked).repartition("cell", "salt").sortWithinPartitions("cell", "salt", "kind")
    near = both.mapInArrow(_nearest(k), "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    place = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir):
    return search(table(spark, sf_dir, "embeddings"))
