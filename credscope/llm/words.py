"""Vectorised hashing of words and word sequences of a batch of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(buf: bytes, prefix: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words (runs without ASCII white space);
    with ``prefix`` the hashes are of their first bytes, that many at most."""
    raw = np.frombuffer(buf, dtype=np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[raw], [True])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):  # in slices that begin and end with a word
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE)))
        lo, hi = int(starts[at]), int(ends[to - 1])
        size = hi - lo
        power = np.cumprod(np.full(size, _BASE))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw[lo:hi].astype(np.uint64) + np.uint64(1)) * power)))
        s, e = starts[at:to] - lo, ends[at:to] - lo
        if prefix:
            e = np.minimum(e, s + prefix)
        back = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size, _INVERSE))))
        out[at:to] = mix64((total[e] - total[s]) * back[s] + (e - s).astype(np.uint64) * _STEP)
        at = to
    return out, starts, ends


def sequence_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive words (fewer words: an empty array)."""
    count = max(0, len(words) - n + 1)
    acc = np.full(count, np.uint64(n))
    for i in range(n):
        acc = acc * _STEP + words[i : i + count]
    return mix64(acc)


def slices(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Pieces of the batches with about ``SLICE`` bytes of text each (one row
    at least), so that memory follows the slice and not the batch.  Null texts
    are empty."""
    for batch in batches:
        column = batch.column(text).cast(pa.large_binary())
        size = np.concatenate(([0], np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))))
        at = 0
        while at < len(batch):
            to = max(at + 1, int(np.searchsorted(size, size[at] + SLICE, side="right")) - 1)
            yield batch.slice(at, to - at), [x.as_py() or b"" for x in column.slice(at, to - at)]
            at = to


def join_texts(texts: list[bytes]) -> tuple[bytes, np.ndarray]:
    """The texts with a line feed after each, and where each one begins (and the end)."""
    return b"\n".join([*texts, b""]), np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)))
