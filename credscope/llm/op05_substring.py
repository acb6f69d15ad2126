"""Substring dedup by suffix automata of reference shards.

A window is ``WINDOW`` consecutive words.  Reference shards are the passages of
a document that recur in documents with larger ids.  Each shard becomes a
suffix automaton, which is sent to the documents that may hold its passages;
they stream through it for matching statistics (the longest match that ends at
each word), and every maximal span of matches of at least a window is removed.

Which document a window is compared with is found without comparing all pairs.
Each window has an anchor, the word sequence of ``GRAM`` words in it with the
smallest hash; equal windows have equal anchors.  An anchor's home is the
smallest document that has it.  First all windows with an anchor of another
home stream through the home's automata.  A window that isn't found there can
only equal windows that weren't either: those are counted by hash, the smallest
document of a repeated one becomes its home, and they stream a second time.
Matches are decided by the automata, word by word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, table
from .words import join_texts, sequence_hashes, slices, word_hashes

WINDOW = 50
GRAM = 10
#: Words of a reference shard, and words that stream through one copy of it.
SHARD, STREAM = 50_000, 200_000


class Automaton:
    """Suffix automaton over words."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.last, self.marks = [-1], [0], 0, 0

    def add(self, words: list) -> None:
        """A passage; a mark of its own keeps matches from running on into the next."""
        for w in words:
            self._extend(w)
        self.marks += 1
        self._extend(self.marks)

    def _extend(self, w) -> None:
        new, at = len(self.next), self.last
        self.next.append({})
        self.length.append(self.length[at] + 1)
        self.link.append(0)
        while at >= 0 and w not in self.next[at]:
            self.next[at][w] = new
            at = self.link[at]
        if at >= 0:
            to = self.next[at][w]
            if self.length[to] == self.length[at] + 1:
                self.link[new] = to
            else:
                copy = len(self.next)
                self.next.append(dict(self.next[to]))
                self.length.append(self.length[at] + 1)
                self.link.append(self.link[to])
                self.link[to] = self.link[new] = copy
                while at >= 0 and self.next[at].get(w) == to:
                    self.next[at][w] = copy
                    at = self.link[at]
        self.last = new

    def matches(self, words: list, least: int) -> np.ndarray:
        """For each word: does a match of at least ``least`` words end here?"""
        out = np.zeros(len(words), dtype=bool)
        state = size = 0
        step, link, length = self.next, self.link, self.length
        for i, w in enumerate(words):
            while state and w not in step[state]:
                state = link[state]
                size = length[state]
            if w in step[state]:
                state = step[state][w]
                size += 1
                out[i] = size >= least
        return out


def window_anchors(words: np.ndarray, window: int, gram: int) -> np.ndarray:
    """The anchor of every window of the sequence."""
    least, have, need = sequence_hashes(words, gram), 1, window - gram + 1
    while have * 2 <= need:
        least = np.minimum(least[:-have], least[have:]) if len(least) > have else least[:0]
        have *= 2
    if have < need:
        by = need - have
        least = np.minimum(least[:-by], least[by:]) if len(least) > by else least[:0]
    return least


def _runs(at: np.ndarray, home: np.ndarray) -> list[tuple[int, int, int]]:
    """(home, start, windows) of consecutive windows ``at`` with one home."""
    if not len(at):
        return []
    cut = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 1) | (home[1:] != home[:-1]), [True])))
    return [(int(home[i]), int(at[i]), int(j - i)) for i, j in zip(cut[:-1], cut[1:])]


_SEEN = "doc_id long, th long, anchor long, n_words long, sha binary"


def _anchor_rows(window: int, gram: int):
    """doc_id, th, text -> a row of each document, and one of each of its anchors."""
    names = [c.split()[0] for c in _SEEN.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, 2):
            split = [t.split() for t in texts]
            n = len(texts)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.nulls(n, pa.int64()), pa.array([len(w) for w in split], pa.int64()), pa.array([hashlib.sha256(b" ".join(w)).digest() for w in split], pa.binary())], names=names)
            buf, begin = join_texts(texts)
            words, starts, _ = word_hashes(buf)
            first = np.searchsorted(starts, begin)
            anchor = window_anchors(words, window, gram)
            doc = np.repeat(np.arange(n), np.diff(first))[: len(anchor)]
            keep = np.arange(len(anchor)) + window <= first[1:][doc]
            keep[1:] &= (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | ~keep[:-1]
            anchor, ids = anchor[keep], part.column(0).take(pa.array(doc[keep]))
            rows = pa.RecordBatch.from_arrays([ids, pa.nulls(len(ids), pa.int64()), pa.array(anchor.view(np.int64)), pa.nulls(len(ids), pa.int64()), pa.nulls(len(ids), pa.binary())], names=names)
            yield rows.filter(ids.is_valid()).cast(pa.schema(list(zip(names, types))))

    return run


_RUN = pa.struct([("home", pa.int64()), ("start", pa.int64()), ("n", pa.int64())])


def _homes(window: int, gram: int):
    """doc_id, th, text, shared [(anchor, home)] -> doc_id, th, text, runs of windows by home."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                text = (batch.column(2)[i].as_py() or "").encode()
                shared = batch.column(3)[i].values
                known, home = (shared.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
                order = np.argsort(known.view(np.uint64))
                known, home = known.view(np.uint64)[order], home[order]
                anchor = window_anchors(word_hashes(text)[0], window, gram)
                place = np.minimum(np.searchsorted(known, anchor), len(known) - 1)
                at = np.flatnonzero(known[place] == anchor)
                runs = [dict(zip(("home", "start", "n"), r)) for r in _runs(at, home[place[at]])]
                if runs:
                    yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(i, 1) for k in (0, 1)), pa.array([text], pa.binary()), pa.array([runs], pa.list_(_RUN))], names=["doc_id", "th", "text", "runs"])

    return run


def _second_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, th, text, left [(home, window)] -> doc_id, th, text, runs"""
    for batch in batches:
        for i in range(len(batch)):
            pairs = np.unique(np.array([(p["at"], p["home"]) for p in batch.column(3)[i].as_py()], np.int64).reshape(-1, 2), axis=0)
            runs = [dict(zip(("home", "start", "n"), r)) for r in _runs(pairs[:, 0], pairs[:, 1])]
            yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(i, 1) for k in (0, 1, 2)), pa.array([runs], pa.list_(_RUN))], names=["doc_id", "th", "text", "runs"])


_PASSAGE = "home long, shard int, doc_id long, th long, start long, n long, words binary"


def _passages(window: int, shard_words: int):
    """The text of each run: a home's own runs in pieces by shard, the others whole."""
    names = [c.split()[0] for c in _PASSAGE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                doc, th = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                words = batch.column(2)[i].as_py().split()
                rows, seen = [], 0
                for r in batch.column(3)[i].as_py():
                    home, start, n = r["home"], r["start"], r["n"]
                    step = shard_words if home == doc else n
                    for s in range(start, start + n, step):
                        k = min(step, start + n - s)
                        rows.append((home, seen // shard_words if home == doc else None, doc, th, s, k, b" ".join(words[s : s + k + window - 1])))
                        seen += k if home == doc else 0
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return run


_SPAN = pa.struct([("from", pa.int64()), ("to", pa.int64())])
_MISS = pa.struct([("at", pa.int64()), ("hash", pa.int64())])


def _stream(window: int):
    """Sorted rows (home, shard, salt, kind, doc_id, th, start, words): a
    shard's passages, then the runs that stream through its automaton."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, automaton = None, Automaton()
        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(3))))
            kinds, docs, ths, starts = (batch.column(k).to_pylist() for k in range(3, 7))
            out = []
            for i, k in enumerate(keys):
                if k != key:
                    key, automaton = k, Automaton()
                text = batch.column(7)[i].as_py()
                words = text.split()
                if kinds[i] == 0:
                    automaton.add(words)
                    continue
                found = automaton.matches(words, window)[window - 1 :]
                hit = np.flatnonzero(found)
                spans = [{"from": starts[i] + s, "to": starts[i] + s + n + window - 1} for _, s, n in _runs(hit, np.zeros(len(hit)))]
                missed = np.flatnonzero(~found)
                hashes = sequence_hashes(word_hashes(text)[0], window)[missed].view(np.int64).tolist() if len(missed) else []
                out.append((docs[i], ths[i], spans, [{"at": starts[i] + int(m), "hash": h} for m, h in zip(missed, hashes)]))
            if out:
                types = [pa.int64(), pa.int64(), pa.list_(_SPAN), pa.list_(_MISS)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["doc_id", "th", "spans", "missed"])

    return run


def _matched(ws: Workspace, runs: DataFrame, window: int, shard: int, stream: int) -> DataFrame:
    """doc_id, th, spans, missed, of ``runs`` (doc_id, th, text, runs)."""
    rows = runs.mapInArrow(_passages(window, shard), _PASSAGE)
    plain = runs.select("doc_id", F.explode("runs").alias("r")).select(F.col("r.home").alias("home"), (F.col("doc_id") == F.col("r.home")).alias("own"), F.col("r.n").alias("n"))
    sizes = plain.groupBy("home").agg(F.sum(F.when(F.col("own"), F.col("n"))).alias("own"), F.sum(F.when(~F.col("own"), F.col("n") + window - 1)).alias("other"))
    sizes = sizes.where("own IS NOT NULL AND other IS NOT NULL").select("home", F.ceil(F.col("own") / shard).cast("int").alias("shards"), F.ceil(F.col("other") / stream).cast("int").alias("salts"))
    rows = rows.join(ws.store(sizes, "sizes"), "home")
    numbers = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    shape = ["home", "shard", "salt", "kind", "doc_id", "th", "start", "words"]
    references = rows.where("shard IS NOT NULL").withColumn("kind", F.lit(0)).withColumn("salt", F.explode(numbers("salts"))).select(*shape)
    streams = rows.where("shard IS NULL").withColumn("kind", F.lit(1)).withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.col("salts")).cast("int")).withColumn("shard", F.explode(numbers("shards"))).select(*shape)
    dealt = references.unionByName(streams).repartition("home", "shard", "salt").sortWithinPartitions("home", "shard", "salt", "kind")
    return ws.store(dealt.mapInArrow(_stream(window), "doc_id long, th long, spans array<struct<from:long,to:long>>, missed array<struct<at:long,hash:long>>"), "matched")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, th, text, spans -> doc_id, th, n_removed, sha of the kept words, kept text"""
    for batch in batches:
        for i in range(len(batch)):
            words = batch.column(2)[i].as_py().split()
            gone = np.zeros(len(words) + 1, np.int64)
            for s in batch.column(3)[i].as_py():
                gone[s["from"]] += 1
                gone[s["to"]] -= 1
            keep = np.cumsum(gone)[:-1] == 0
            kept = b" ".join(w for w, k in zip(words, keep) if k)
            yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(i, 1) for k in (0, 1)), pa.array([int(len(words) - keep.sum())], pa.int64()), pa.array([hashlib.sha256(kept).digest()], pa.binary()), pa.array([kept.decode()], pa.string())], names=["doc_id", "th", "n_removed", "sha", "kept_text"])


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard: int = SHARD, stream: int = STREAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text: one row per row.

    A word goes if a window that covers it also starts in a document with a
    smaller doc_id (judged on the input).  ``kept_text`` is null for a document
    that keeps all its words; ``kept_sha256`` is of the kept words joined by a
    space.

    Null, empty and short texts have no window and stay.  A row without doc_id
    is no reference and stays whole.  Rows that repeat a doc_id are no
    references for each other; each is judged and returned by itself.  Texts
    are used whole; references beyond ``shard`` words are split, and runs beyond
    ``stream`` words are dealt to several copies of the automaton, so no common
    passage gathers in one task.  Other columns are ignored; an empty table
    gives no rows.
    """
    ws = Workspace(docs.sparkSession, "substrings")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    seen = ws.store(rows.mapInArrow(_anchor_rows(window, gram), _SEEN), "anchors")
    anchors = seen.where("anchor IS NOT NULL").select("doc_id", "anchor")
    shared = anchors.groupBy("anchor").agg(F.min("doc_id").alias("home"), F.max("doc_id").alias("last")).where("home < last").select("anchor", "home")
    lists = anchors.join(shared, "anchor").groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "home")).alias("shared"))
    some = ws.store(rows.join(lists, "doc_id").select("doc_id", "th", "text", "shared").mapInArrow(_homes(window, gram), "doc_id long, th long, text binary, runs array<struct<home:long,start:long,n:long>>"), "runs")

    first = _matched(ws, some, window, shard, stream)
    left = first.select("doc_id", "th", F.explode("missed").alias("m")).select("doc_id", "th", "m.at", "m.hash")
    again = left.groupBy("hash").agg(F.min("doc_id").alias("home"), F.max("doc_id").alias("last")).where("home < last").select("hash", "home")
    again = left.join(again, "hash").groupBy("doc_id", "th").agg(F.collect_list(F.struct("home", "at")).alias("left"))
    second = some.select("doc_id", "th", "text").join(again, ["doc_id", "th"]).select("doc_id", "th", "text", "left")
    second = _matched(ws, ws.store(second.mapInArrow(_second_runs, "doc_id long, th long, text binary, runs array<struct<home:long,start:long,n:long>>"), "second"), window, shard, stream)

    spans = first.unionByName(second).where(F.size("spans") > 0).groupBy("doc_id", "th").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    cut = some.select("doc_id", "th", "text").join(spans, ["doc_id", "th"]).select("doc_id", "th", "text", "spans").mapInArrow(_cut, "doc_id long, th long, n_removed long, sha binary, kept_text string")
    cut = cut.dropDuplicates(["doc_id", "th"]).select("doc_id", "th", "n_removed", F.col("sha").alias("kept_sha"), "kept_text")
    whole = seen.where("anchor IS NULL").select("doc_id", "th", "n_words", "sha")
    return whole.join(cut, ["doc_id", "th"], "left").select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.lower(F.hex(F.coalesce("kept_sha", "sha"))).alias("kept_sha256"), "kept_text")


def query(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
