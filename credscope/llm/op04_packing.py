"""Vector bin packing of tokenised documents into training sequences.

A sequence has room for ``capacity`` tokens, ``max_segments`` pieces and
``max_loss`` loss-bearing tokens.  Each task packs its own documents as they
stream by: a bounded pool of examples waits, and the open sequence takes the
example whose demand vector has the largest dot product with the room that is
left.  When no whole example fits, one is cut to fill the room.  Nothing is
shuffled, and a task holds the pool and the open sequence only.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

CAPACITY = 1024
MAX_SEGMENTS = 128
POOL = 512
END_ID = 0
RANKS = "byte_bpe_50k.tiktoken"

_SPACES = re.compile(r"\s\s")
_encoders: dict[str, tuple] = {}


def encoder(ranks_path: str):
    """text -> token ids of the byte-level BPE, without special tokens around it.

    The ranks file is the same vocabulary as the json of the same name beside
    it, ``byte_bpe_50k.json`` (a test compares the ids).  The json's added
    tokens are found in the text first; the parts between them are encoded
    each alone.  The pattern's lookahead matters only where white space
    characters follow each other; other parts use the pattern without it,
    which needs no backtracking and is about twice as fast.
    """
    if ranks_path not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        added = json.loads(Path(ranks_path).with_suffix(".json").read_text("utf-8"))["added_tokens"]
        if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that depend on the text around them aren't supported")
        ids = {t["content"]: t["id"] for t in added}
        literals = re.compile("(" + "|".join(re.escape(t) for t in sorted(ids, key=len, reverse=True)) + ")") if ids else None
        plain = public_tokenizers.PATTERN.replace(r"\s+(?!\S)|", "")
        codings = (tiktoken.Encoding(n, pat_str=p, mergeable_ranks=ranks, special_tokens={}) for n, p in (("full", public_tokenizers.PATTERN), ("plain", plain)))
        _encoders[ranks_path] = (*codings, literals, ids)
    full, plain, literals, ids = _encoders[ranks_path]

    def part(text: str) -> list[int]:
        return (full if _SPACES.search(text) else plain).encode_ordinary(text)

    def encode(text: str) -> list[int]:
        parts = literals.split(text) if literals else [text]
        out = part(parts[0])
        for literal, after in zip(parts[1::2], parts[2::2]):
            out.append(ids[literal])
            out += part(after)
        return out

    return encode


@dataclass
class Limits:
    capacity: int = CAPACITY
    max_segments: int = MAX_SEGMENTS
    max_loss: int = CAPACITY


class Packer:
    """Packs examples (key, ids, loss_from) of one task; ``done`` collects
    rows (key, start, ids, doc_tokens, sequence, offset, sequence_tokens)."""

    def __init__(self, limits: Limits, pool: int = POOL):
        self.lim, self.size = limits, pool
        self.items: list[list] = []  # [key, ids, loss_from, next token]
        self.left = np.zeros((0, 2))  # tokens and loss-bearing tokens left, by item
        self.bin: list[tuple] = []
        self.room = np.array([limits.capacity, limits.max_loss])
        self.sequence = 0
        self.done: list[tuple] = []

    def add(self, key, ids: np.ndarray, loss_from: int = 0) -> None:
        item = [key, ids, loss_from, 0]
        while self._cut(item, self.lim.capacity, self.lim.max_loss) == self.lim.capacity:  # fills a sequence alone
            self._emit([self._take(item, self.lim.capacity)])
        if item[3] < len(ids):
            self.items.append(item)
            self.left = np.vstack([self.left, self._demand(item)])
        while len(self.items) >= self.size:
            self._step()

    def finish(self) -> None:
        while self.items:
            self._step()
        self._close()

    @staticmethod
    def _demand(item) -> tuple[int, int]:
        n = len(item[1])
        return n - item[3], max(0, n - max(item[3], item[2]))

    @staticmethod
    def _cut(item, tokens: int, loss: int) -> int:
        """The most tokens that can be cut off the front within the limits."""
        return min(len(item[1]) - item[3], tokens, max(0, item[2] - item[3]) + loss)

    @staticmethod
    def _take(item, k: int) -> tuple:
        key, ids, loss_from, at = item
        item[3] += k
        return key, at, ids[at : at + k], len(ids)

    def _drop(self, i: int) -> None:
        self.items.pop(i)
        self.left = np.delete(self.left, i, axis=0)

    def _step(self) -> None:
        """Adds one piece to the open sequence, or closes it."""
        if len(self.bin) >= self.lim.max_segments or self.room[0] <= 0:
            return self._close()
        limits = np.array([self.lim.capacity, max(1, self.lim.max_loss)], dtype=float)
        fits = (self.left <= self.room).all(axis=1)
        if fits.any():
            # the segment component is the same for every example
            score = (self.left / limits) @ (self.room / limits)
            i = int(np.argmax(np.where(fits, score, -1.0)))
            k = int(self.left[i, 0])
        else:
            cuts = [self._cut(x, int(self.room[0]), int(self.room[1])) for x in self.items]
            i = int(np.argmax(cuts))
            k = cuts[i]
            if k == 0:
                return self._close()
        item = self.items[i]
        before = self._demand(item)
        self.bin.append(self._take(item, k))
        after = self._demand(item)
        self.room = self.room - np.subtract(before, after)
        if after[0] == 0:
            self._drop(i)
        else:
            self.left[i] = after
        return None

    def _close(self) -> None:
        pieces, self.bin = self.bin, []
        self.room = np.array([self.lim.capacity, self.lim.max_loss])
        if pieces:
            self._emit(pieces)

    def _emit(self, pieces: list[tuple]) -> None:
        """A sequence that isn't full is written as sequences of its length's
        powers of two, which need no padding."""
        total = sum(len(p[2]) for p in pieces)
        sizes = [total] if total == self.lim.capacity else [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]
        pieces = pieces[::-1]
        for size in sizes:
            offset = 0
            while offset < size:
                key, start, ids, n = pieces.pop()
                k = min(len(ids), size - offset)
                self.done.append((key, start, ids[:k], n, self.sequence, offset, size))
                if k < len(ids):
                    pieces.append((key, start + k, ids[k:], n))
                offset += k
            self.sequence += 1


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long"


def _rows(packer: Packer, partition: int) -> pa.RecordBatch:
    rows, packer.done = packer.done, []
    cols = list(zip(*[(k, s, len(i), zlib.crc32(i.tobytes()), n, (partition << 36) + q, o, z) for k, s, i, n, q, o, z in rows])) or [()] * 8
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)


def pack(docs: DataFrame, ranks_path: str, limits: Limits | None = None, loss_from: str | None = None) -> DataFrame:
    """One row per piece (``SCHEMA``) of the packed documents.

    A document is its token ids and ``END_ID``.  ``loss_from`` names a column
    with the number of leading tokens that bear no loss (null: 0); without it
    all tokens do.  ``sequence_id`` holds the task's number in its upper bits,
    so packing needs ``docs`` in a fixed partitioning (a table as stored).

    Null or empty text is the end id alone.  Rows are packed one by one, so a
    repeated row gives its pieces again, and null doc_ids stay null.  Texts of
    any length are cut over as many sequences as they need.  Other columns are
    ignored; an empty table gives no rows.
    """
    limits = limits or Limits()
    lead = F.coalesce(F.col(loss_from).cast("long"), F.lit(0)) if loss_from else F.lit(0).cast("long")
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), lead.alias("lead"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer, part = encoder(ranks_path), Packer(limits), TaskContext.get().partitionId()
        for batch in batches:
            for key, text, lead in zip(*(batch.column(i) for i in range(3))):
                ids = encode(text.as_py() or "")
                ids.append(END_ID)
                packer.add(key.as_py(), np.array(ids, dtype="<u4"), lead.as_py())
                if len(packer.done) >= 10_000:
                    yield _rows(packer, part)
        packer.finish()
        yield _rows(packer, part)

    return picked.mapInArrow(run, SCHEMA)


def default_ranks() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(RANKS))


def query(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), default_ranks())
