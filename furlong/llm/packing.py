"""Packing tokenized documents into windows by best-fit decreasing.

A document is its token ids with an end id behind them.  Documents longer
than a window are first cut into full windows; each full window is a sequence
of its own.  What is left, one piece of each document at most, is packed by
best-fit decreasing: pieces in order of length, each into the open window with
the least room that still holds it, or into a new one.  The open windows stand
in a segment tree indexed by remaining capacity, which finds the tightest one
in two walks of its height.

Scale: texts are tokenized once, as they are read.  What is packed are places
and lengths, some dozens of bytes a piece; they are dealt into groups of about
``GROUP`` pieces, each packed by one task: a few windows of a group stay partly
empty, whatever the size of the corpus.  Windows that a group leaves emptier
than ``LOOSE`` are taken apart once more, and their pieces packed in groups of
their own.

Tokens: this vocabulary drops white space and its splitting pattern matches
nothing across it, so a text has the ids of its words one after another;
a Python worker keeps the ids of up to ``KNOWN`` words and asks the library
for the others, for many words at once.  Texts are split and their words numbered
by Arrow, some megabytes at a time, so that Python meets each word once in these.

Defined results: null and empty texts are the end id alone; repeated rows and
rows without an id are documents of their own; very long texts are read in
parts of about ``PART`` bytes, cut at white space, and only their windows'
checksums are kept; an empty table gives an empty result; other columns are
ignored.  ``sequence_id`` names a sequence within one result: it is not the
same in another run.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm.common import Recent, kept_by_worker, staged

WINDOW = 4096
END = 2
GROUP = 10_000
LOOSE = 128  # tokens of room from which a window is packed anew
PART = 1 << 20
HELD = 4 << 20  # bytes of texts whose words are looked up together
KNOWN = 1_200_000  # words whose ids a Python worker keeps (some 200 bytes each)

_SPACE = re.compile(rb"[\t-\r ]")

# Words of ASCII signs (no apostrophe, no "<": contractions and special tokens
# are written with them), digits and Latin-1 letters, which normalization only
# lowers; and the matches of the splitting pattern in such words: runs of
# letters, single digits, runs of signs.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_PLAIN = re.compile(f"[{_LETTERS}0-9!-&(-/:;=-@\\[-`{{-~]+")
_MATCHES = re.compile(f"[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+")


def lowered(text: bytes) -> bytes:
    """The text with A-Z lowered, as the tokenizer does, so that fewer words are
    different; a text with combining marks (U+0300 to U+037F) stays as it is,
    since they may compose with a small letter and not with its capital."""
    return text if b"\xcc" in text or b"\xcd" in text else text.lower()


class Tokens:
    """Token ids of texts, by a tokenizer that drops white space."""

    def __init__(self, definition: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition.decode())
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)  # ids that end a match of the splitting pattern
        for entry, k in self.tokenizer.get_vocab().items():
            self.ends[k] = entry.endswith("</w>")
        self.known = Recent(KNOWN, at_once=True)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, words: list[str]) -> list[bytes] | None:
        """The ids of words of plain characters, tokenized as one text: how many
        matches the splitting pattern has in such a word is known, and where
        they end in the ids."""
        ids = np.array(self._ids([" ".join(words)])[0], np.uint32)
        matches = np.cumsum([1 if w.isalpha() else len(_MATCHES.findall(w)) for w in words])
        ends = np.flatnonzero(self.ends[ids])
        if len(ends) != matches[-1]:
            return None
        raw, to = ids.tobytes(), ((ends[matches - 1] + 1) * 4).tolist()
        return [raw[i:j] for i, j in zip([0, *to], to, strict=False)]

    def learn(self, words: Iterable[bytes]) -> Callable[[bytes], bytes]:
        """Looks up the ids (as bytes of 32-bit numbers) of any of the words."""
        new, known = self.known.missing(words), self.known.now
        texts = [w.decode() for w in new]
        plain = [k for k, t in enumerate(texts) if _PLAIN.fullmatch(t)]
        found: dict[int, bytes] = {}
        for k in range(0, len(plain), 1000):
            part = plain[k:k + 1000]
            ids = self._plain([texts[i] for i in part])
            if ids is not None:
                found.update(zip(part, ids, strict=True))
        rest = [k for k in range(len(new)) if k not in found]
        found.update(zip(rest, [np.array(x, np.uint32).tobytes() for x in self._ids([texts[k] for k in rest])], strict=True))
        for k, w in enumerate(new):
            known[w] = found[k]
        return known.__getitem__

    def of_batch(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of every text."""
        split = pc.ascii_split_whitespace(pa.array(map(lowered, texts), pa.string()))
        numbered = split.values.dictionary_encode()
        words = numbered.dictionary.cast(pa.binary()).to_pylist()
        ids = list(map(self.learn(words), words))
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        number = numbered.indices.to_numpy()
        sizes = size[number]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        at = np.repeat((np.cumsum(size) - size)[number] - ends[:-1], sizes) + np.arange(ends[-1])
        every = np.frombuffer(b"".join(ids), np.uint32)[at]
        return np.split(every, ends[split.offsets.to_numpy()[1:-1]])

    def parts(self, text: bytes, part: int = PART) -> Iterator[np.ndarray]:
        """The ids of a text, in parts."""
        at = 0
        while at < len(text):
            cut = _SPACE.search(text, at + part) if at + part < len(text) else None
            to = cut.start() if cut else len(text)
            yield self.of_batch([text[at:to]])[0]
            at = to

    def of_texts(self, texts: Iterable[bytes]) -> Iterator[Iterable[np.ndarray]]:
        """The ids of every text, in parts; texts of up to about ``HELD`` bytes are
        looked up together."""
        held: list[bytes] = []
        size = 0
        for text in texts:
            if len(text) > PART:
                if held:
                    yield from ([x] for x in self.of_batch(held))
                yield self.parts(text)
                held, size = [], 0
                continue
            held.append(text)
            size += len(text)
            if size > HELD:
                yield from ([x] for x in self.of_batch(held))
                held, size = [], 0
        if held:
            yield from ([x] for x in self.of_batch(held))


def cut(ids: Iterable[np.ndarray], window: int, end: int) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of the pieces of one document: full windows, then
    the rest; ``end`` is its last id."""
    out: list[tuple[int, int, int]] = []
    held, start = np.zeros(0, "<u4"), 0
    for part in chain(ids, [np.array([end], "<u4")]):
        held = np.concatenate([held, part]).astype("<u4")
        full = len(held) // window * window
        for k in range(0, full, window):
            out.append((start + k, window, zlib.crc32(held[k:k + window].tobytes())))
        held, start = held[full:], start + full
    if len(held):
        out.append((start, len(held), zlib.crc32(held.tobytes())))
    return out


PIECES = "doc_id bigint, start bigint, length int, ids_crc32 bigint, doc_tokens bigint"


def pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """The pieces of every document.  The tokenizer's file is read on the driver
    and broadcast (a vocabulary: it does not grow with the data)."""
    with open(tokenizer_path, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = kept_by_worker("packing", sent.value, lambda: Tokens(sent.value))
        for b in batches:
            rows = []
            texts = (text.as_py() for text in b.column(1))
            for doc_id, ids in zip(b.column(0).to_pylist(), tokens.of_texts(texts), strict=True):
                found = cut(ids, window, end)
                total = found[-1][0] + found[-1][1]
                rows += [(doc_id, *p, total) for p in found]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("text")).mapInArrow(run, PIECES)


class OpenWindows:
    """Open windows by their room: a segment tree over the capacities, a leaf
    for each, whose nodes say whether any window below them is open."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.at: dict[int, list[int]] = {}

    def add(self, room: int, window: int) -> None:
        stack = self.at.setdefault(room, [])
        stack.append(window)
        node = room + self.leaves
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def tightest(self, length: int) -> int | None:
        """The least room of an open window that holds ``length``."""
        node = length + self.leaves
        if not self.any[node]:
            while True:  # up, until there is something to the right
                if node <= 1:
                    return None
                if not node & 1 and self.any[node + 1]:
                    node += 1
                    break
                node >>= 1
            while node < self.leaves:  # down, keeping left
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        return node - self.leaves

    def take(self, room: int) -> int:
        stack = self.at[room]
        window = stack.pop()
        node = room + self.leaves
        if not stack:
            self.any[node] = 0
            node >>= 1
            while node and not (self.any[2 * node] or self.any[2 * node + 1]):
                self.any[node] = 0
                node >>= 1
        return window


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of every piece; pieces in decreasing order of length."""
    order = np.argsort(-lengths, kind="stable")
    window, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened, n = OpenWindows(capacity), 0
    for k, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        room = opened.tightest(length)
        if room is None:
            w, room = n, capacity
            n += 1
        else:
            w = opened.take(room)
        window[k], offset[k] = w, capacity - room
        if room > length:
            opened.add(room - length, w)
    return window, offset


PACKED = PIECES + ", piece bigint, sequence_id bigint, offset bigint, room int"


def _packed(pdf: pd.DataFrame, capacity: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["length", "piece"], ascending=[False, True])  # the same however the rows arrive
    lengths = pdf["length"].to_numpy().astype(np.int64)
    window, offset = best_fit(lengths, capacity)
    name = np.zeros(int(window.max()) + 1, np.int64)
    first = offset == 0
    name[window[first]] = pdf["piece"].to_numpy()[first]  # a sequence has the name of its first piece
    room = capacity - np.bincount(window, lengths).astype(np.int64)
    return pdf.assign(sequence_id=name[window], offset=offset, room=room[window].astype(np.int32))[
        ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "piece", "sequence_id", "offset", "room"]]


def _grouped(rows: DataFrame, n: int, capacity: int, group: int) -> DataFrame:
    """``rows`` packed in groups of about ``group`` pieces."""
    number = F.pmod(F.xxhash64("piece"), F.lit(max(1, -(-n // group)))).alias("group")
    return rows.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "piece", number).groupBy("group").applyInPandas(
        lambda pdf: _packed(pdf, capacity), PACKED)


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end: int = END, group: int = GROUP,
         loose: int = LOOSE) -> DataFrame:
    """One row per piece: ``doc_id``, ``start`` (ids of its document before it),
    ``length``, ``ids_crc32`` (of its ids as little-endian 32-bit numbers),
    ``doc_tokens``, ``sequence_id`` and ``offset`` (in the sequence, gapless from
    0).  Runs jobs."""
    # a number of its own for each piece, written once
    found = staged(pieces(docs, tokenizer_path, window, end).withColumn("piece", F.monotonically_increasing_id()), "pieces")
    full, rest = found.where(F.col("length") == window), found.where(F.col("length") < window)
    done = full.withColumns({"sequence_id": F.col("piece"), "offset": F.lit(0).cast("long")})
    once = staged(_grouped(rest, rest.count(), window, group), "packed")
    again = once.where(F.col("room") > loose)
    twice = _grouped(again, again.count(), window, group)
    columns = ["doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return done.select(*columns).unionByName(once.where(F.col("room") <= loose).select(*columns)).unionByName(
        twice.select(*columns))
