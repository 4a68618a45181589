"""Texts of an Arrow batch as flat numpy arrays: bytes, words, documents.

No Python loop over documents or words; long texts are cut into parts, and
batches into chunks of bounded size, so that a task's memory does not grow
with its input."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20  # bytes of text handled at once

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Chunk:
    """Some parts of texts.  ``row`` is the batch row of each part; a text
    longer than ``CHUNK`` is several parts, cut before white space."""

    data: np.ndarray  # uint8, the parts one after another
    part_of: np.ndarray  # part of each byte
    row: np.ndarray  # batch row of each part
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte behind each word
    word_part: np.ndarray  # part of each word
    n_words: np.ndarray  # words of each part
    first_word: np.ndarray  # first word of each part


def _spans(batch: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the array and its offsets in them (null: empty)."""
    if isinstance(batch, pa.ChunkedArray):
        batch = batch.combine_chunks()
    if batch.null_count:
        batch = batch.fill_null("")
    wide = pa.types.is_large_string(batch.type)
    _, offsets, data = batch.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[batch.offset:batch.offset + len(batch) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets.astype(np.int64)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word of one text, and the byte behind it."""
    solid = np.concatenate(([False], ~_SPACE[data], [False]))
    return np.flatnonzero(solid[1:-1] & ~solid[:-2]), np.flatnonzero(solid[1:-1] & ~solid[2:]) + 1


def _back(data: np.ndarray, begin: int, at: int, n: int) -> int:
    """Where the last ``n`` words before ``at`` begin (not before ``begin``)."""
    if not n:
        return at
    step = 4096
    while True:
        low = max(begin, at - step)
        solid = ~_SPACE[data[low:at]]
        first = np.flatnonzero(solid[1:] & ~solid[:-1]) + 1
        if len(first) >= n:
            return low + int(first[-n])
        if low == begin:
            return begin
        step *= 4


def chunks(batch: pa.StringArray, lower: bool = False, size: int = CHUNK, whole: bool = False,
           overlap: int = 0) -> Iterator[Chunk]:
    """The texts of a batch in chunks of about ``size`` bytes (more only where
    a text has no white space, or ``whole``: no text is cut).  A part that
    goes on from a cut begins with the ``overlap`` words before the cut."""
    if not len(batch):
        return
    data, offsets = _spans(batch)
    begin, end, rows = [], [], []
    if whole or not (np.diff(offsets) > size).any():
        begin, end, rows = offsets[:-1], offsets[1:], np.arange(len(batch))
    else:
        for r in range(len(batch)):
            at, stop = int(offsets[r]), int(offsets[r + 1])
            head = at
            while stop - at > size:
                cut = np.flatnonzero(_SPACE[data[at + size:min(at + 2 * size, stop)]])
                if not len(cut):
                    break
                begin.append(head)
                at += size + int(cut[0])
                end.append(at)
                rows.append(r)
                head = _back(data, int(offsets[r]), at, overlap)
            begin.append(head)
            end.append(stop)
            rows.append(r)
        begin, end, rows = (np.array(x, np.int64) for x in (begin, end, rows))
    at = 0
    while at < len(begin):
        to = max(at + 1, int(np.searchsorted(end, begin[at] + size, "right")))
        yield _chunk(data, begin[at:to], end[at:to], rows[at:to], lower)
        at = to


def _chunk(data: np.ndarray, begin: np.ndarray, end: np.ndarray, rows: np.ndarray, lower: bool) -> Chunk:
    part = data[begin[0]:end[-1]]  # parts lie one after another; no two of one text are in a chunk
    if lower:
        part = _LOWER[part]
    length = end - begin
    part_of = np.repeat(np.arange(len(rows), dtype=np.int32), length)
    solid = ~_SPACE[part]
    edge = np.ones(len(part) + 1, bool)
    edge[1:-1] = part_of[1:] != part_of[:-1]
    before = np.concatenate(([False], solid[:-1])) & ~edge[:-1]
    after = np.concatenate((solid[1:], [False])) & ~edge[1:]
    first, last = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    word_part = part_of[first]
    n = np.bincount(word_part, minlength=len(rows))
    return Chunk(part, part_of, rows, first, last, word_part, n, np.concatenate(([0], np.cumsum(n)[:-1])))


def mix64(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_hashes(c: Chunk) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(c.start):
        return np.zeros(0, np.uint64)
    n = c.end - c.start
    powers = np.cumprod(np.full(int(n.max()), _ODD | np.uint64(1), np.uint64))
    where = np.concatenate(([0], np.cumsum(n)[:-1]))
    place = np.arange(int(n.sum())) - np.repeat(where, n)
    value = (c.data[np.repeat(c.start, n) + place].astype(np.uint64) + np.uint64(1)) * powers[place]
    return mix64(np.add.reduceat(value, where))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Adam:
    """Adam steps on a dict of arrays."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.n = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.n += 1
        scale = self.rate * np.sqrt(1 - 0.999 ** self.n) / (1 - 0.9 ** self.n)
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.p[k] -= (scale * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)).astype(self.p[k].dtype)
