"""Quality classifier: histogram gradient-boosted trees on document statistics.

Statistics of whole texts are computed by array operations over slices of
texts.  The trees are fitted on a bounded sample of labelled rows: features
become bins, a level's gradients are summed into histograms by node, feature
and bin, and the best splits come from their running sums.  The fitted trees
are flattened into arrays, and scoring follows all documents of a batch down a
tree at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, table
from .training import labelled_sample
from .words import join_texts, sequence_hashes, slices, word_hashes

SAMPLE = 12_000
CUT = 0.3

_MARKS = b"#*&%$|!?<>{}@=~^_+\\"
_CLASSES = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "space": (32, 9),
    "line": (10,),
    "stop": b".,;:",
    "wide": range(128, 256),
    **{f"mark{i}": (c,) for i, c in enumerate(_MARKS)},
}
_TABLES = {name: np.isin(np.arange(256), list(codes)).astype(np.int32) for name, codes in _CLASSES.items()}


def _by_doc(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between the borders ``begin``."""
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    return total[begin[1:]] - total[begin[:-1]]


def _distinct(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, and the count of the most frequent one, by document."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((values, doc))
    v, d = values[order], doc[order]
    fresh = np.flatnonzero(np.concatenate(([True], (v[1:] != v[:-1]) | (d[1:] != d[:-1])))) if len(v) else np.zeros(0, np.int64)
    runs = np.diff(np.concatenate((fresh, [len(v)])))
    most = np.zeros(len(first) - 1, np.int64)
    np.maximum.at(most, d[fresh], runs)
    return np.bincount(d[fresh], minlength=len(first) - 1), most


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of statistics for each text (an empty text: zeros)."""
    buf, begin = join_texts(texts)
    raw = np.frombuffer(buf, dtype=np.uint8)
    size = np.diff(begin) - 1
    words, starts, ends = word_hashes(buf)
    first = np.searchsorted(starts, begin)
    n = np.diff(first)
    length = ends - starts
    per = lambda x, y: x / np.maximum(y, 1)
    counts = {name: _by_doc(t[raw], begin) - (name == "line") for name, t in _TABLES.items()}
    mean = per(_by_doc(length, first), n)
    spread = np.sqrt(np.maximum(per(_by_doc(length**2, first), n) - mean**2, 0))
    distinct, most = _distinct(words, first)
    pairs = sequence_hashes(words, 2) if len(words) > 1 else np.zeros(0, np.uint64)
    pairs = np.append(pairs, np.zeros(len(words) - len(pairs), np.uint64))
    pair_distinct, pair_most = _distinct(pairs, first)
    lines = np.flatnonzero(raw == 10)
    line_start = np.concatenate(([0], lines[:-1] + 1)) if len(lines) else lines
    line_hash = _line_hashes(words, starts, line_start, lines)
    line_first = np.searchsorted(line_start, begin)
    line_distinct, line_most = _distinct(line_hash, line_first)
    line_n = np.diff(line_first)
    initial = _TABLES["upper"][raw[starts]] if len(starts) else np.zeros(0, np.int32)
    odd_end = 1 - np.maximum.reduce([_TABLES[k][raw[ends - 1]] for k in ("upper", "lower", "digit", "stop", "wide")]) if len(ends) else np.zeros(0, np.int32)
    columns = [
        np.log1p(size), np.log1p(n), mean, spread, per(distinct, n), per(most, n), per(pair_distinct, n), per(pair_most, n),
        per(line_distinct, line_n), per(line_most, line_n), per(line_n, n), per(_by_doc(initial, first), n), per(_by_doc(odd_end, first), n),
        per(_by_doc((length <= 3).astype(np.int64), first), n), per(_by_doc((length > 15).astype(np.int64), first), n),
        *[per(c, size) for c in counts.values()],
    ]
    return np.column_stack(columns).astype(np.float64)


def _line_hashes(words: np.ndarray, starts: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the words of each line, in order."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * (np.arange(len(words), dtype=np.uint64) * np.uint64(2) + np.uint64(1)))))
    plain = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words)))
    i, j = np.searchsorted(starts, begin), np.searchsorted(starts, end)
    return total[j] - total[i] - (plain[j] - plain[i]) * (i.astype(np.uint64) * np.uint64(2))  # weights counted from the line's first word


@dataclass
class Trees:
    """Flattened trees: a node's feature (-1: leaf), threshold, children, value."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[node]
                down = np.where(x[rows, np.maximum(f, 0)] <= self.threshold[node], self.left[node], self.right[node])
                node = np.where(f < 0, node, down)
            total += self.value[node]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 2.0, least: int = 8) -> Trees:
    """Trees for the log-odds of ``y``.  Without rows the score is 0.5, with
    one class only it is nearly that class."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    nodes: list[list] = []
    roots: list[int] = []
    base = float(np.log(share / (1 - share)))
    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        code = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
        offset = np.arange(x.shape[1]) * bins
        f = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-f))
            grad, hess = p - y, p * (1 - p)
            roots.append(len(nodes))
            nodes.append([-1, 0.0, 0, 0, 0.0])
            at = np.full(len(y), roots[-1])
            level = [roots[-1]]
            for deep in range(depth + 1):
                slot = {n: i for i, n in enumerate(level)}
                live = np.isin(at, level)
                place = np.array([slot.get(n, 0) for n in range(len(nodes))])[at[live]]
                width = x.shape[1] * bins
                key = (place[:, None] * width + offset + code[live]).ravel()
                hist = [np.bincount(key, np.repeat(v[live], x.shape[1]), len(level) * width).reshape(len(level), x.shape[1], bins) for v in (grad, hess, np.ones(len(y)))]
                g, h, c = (np.cumsum(v, axis=2) for v in hist)
                following = []
                for n, i in slot.items():
                    gt, ht, ct = g[i, 0, -1], h[i, 0, -1], c[i, 0, -1]
                    nodes[n][4] = -rate * gt / (ht + l2)
                    if deep == depth:
                        continue
                    gain = g[i] ** 2 / (h[i] + l2) + (gt - g[i]) ** 2 / (ht - h[i] + l2) - gt**2 / (ht + l2)
                    gain[(c[i] < least) | (ct - c[i] < least)] = 0
                    k, b = np.unravel_index(np.argmax(gain), gain.shape)
                    if gain[k, b] <= 1e-6 or b >= len(edges[k]):
                        continue
                    nodes[n][:4] = [int(k), float(edges[k][b]), len(nodes), len(nodes) + 1]
                    following += [len(nodes), len(nodes) + 1]
                    nodes += [[-1, 0.0, 0, 0, 0.0], [-1, 0.0, 0, 0, 0.0]]
                    mine = at == n
                    at[mine] = np.where(code[mine, k] <= b, nodes[n][2], nodes[n][3])
                if not following:
                    break
                level = following
            f += np.array([n[4] for n in nodes])[at]
    cols = list(zip(*nodes)) or [()] * 5
    return Trees(base, np.array(roots, int), np.array(cols[0], int), np.array(cols[1], float), np.array(cols[2], int), np.array(cols[3], int), np.array(cols[4], float), depth)


def _statistic_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """label, text -> label, statistics"""
    for part, texts in slices(batches, 1):
        x = statistics(texts)
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["label", "x"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Trees:
    """Trees fitted on at most ``sample`` labelled rows that aren't held out;
    only their statistics and labels reach the driver."""
    rows = labelled_sample(docs, labels, label, sample).select("label", "text").mapInArrow(_statistic_rows, "label int, x array<double>").toArrow()
    width = statistics([b""]).shape[1]
    x = np.array(rows.column("x").to_pylist(), float).reshape(-1, width)
    y = np.array(rows.column("label").to_pylist(), float)
    order = np.lexsort((*x.T, y))  # the order of the rows doesn't matter
    return fit(x[order], y[order])


def score(docs: DataFrame, trees: Trees, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row, of the whole text.

    Null and empty texts have the statistics of an empty text and a score like
    any other.  Rows are independent: repeated rows and ties score alike, null
    doc_ids stay null (held out).  Other columns are ignored; an empty table
    gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, 1):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(trees.score(statistics(texts)))], names=["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, trees: Trees, cut: float = CUT) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that score ``cut`` or more."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, at):
            yield part.filter(pa.array(trees.score(statistics(texts)) >= cut))

    return docs.mapInArrow(run, docs.schema)


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
