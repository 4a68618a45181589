"""Substring deduplication with a compressed FM-index per shard.

A window is ``WINDOW`` consecutive words of one document.  Words covered by a
window that also starts in a document with a smaller doc_id are removed.

1. Every window has a minimizer: the smallest hash among its ``GRAM``-word
   sequences.  Equal windows have equal minimizers, so only runs of windows
   whose minimizer occurs in two documents can be repeated.
2. Such runs ("segments": overlapping pieces of documents) go to the shard of
   their minimizer, equal segments once with their smallest doc_id.  Each
   shard builds an FM-index over its segments: Burrows-Wheeler transform in a
   wavelet matrix of bit vectors with block counts.
3. The shard's segments are streamed through the index by backward search, all
   positions of a block at once: the matching statistic of a position is the
   number of words, up to ``WINDOW``, that match another place.  Positions
   that reach the threshold report the smallest doc_id of their interval.
4. The reports meet the documents that hold the segment, and cover words.

Scale: shards hold about ``SHARD`` words.  A minimizer of very many
documents is cut up: its windows go one by one to shards by their own hash.
Equal segments are combined map-side before the shuffle, so a passage that a
third of all documents share is one segment; the join that hands its report
back is split by adaptive execution.

Defined results: null and empty texts have no words; texts of fewer than
``WINDOW`` words keep all; equal windows within one document, or in rows of
one doc_id, remove nothing; rows without a doc_id lose nothing and remove
nothing; an empty table gives an empty result; columns named like a result
column are replaced.  Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm.common import discard, row_key, staged, text_or_empty, unused_prefix
from furlong.llm.flat_text import Chunk, chunks, mix64, word_hashes

WINDOW = 13
GRAM = 5
SHARD = 200_000  # words of an index, about
HOT = 20_000  # documents of one minimizer from which its windows are dealt singly
RUN = 128  # windows of one segment at most
BLOCK = 1 << 15  # positions that are searched at once


def minimizers(c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of a chunk, its windows (index of the first word) and the
    minimizer of each (63 bits)."""
    h = word_hashes(c)
    n = len(h) - WINDOW + 1
    if n <= 0:
        return h, np.zeros(0, np.int64), np.zeros(0, np.int64)
    gram = np.zeros(len(h) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        gram = mix64(gram * np.uint64(3) + h[k:len(h) - GRAM + 1 + k])
    low = gram[:n].copy()
    for k in range(1, WINDOW - GRAM + 1):
        np.minimum(low, gram[k:n + k], out=low)
    at = np.flatnonzero(c.word_part[:n] == c.word_part[WINDOW - 1:])
    return h, at, (low[at] >> np.uint64(1)).astype(np.int64)


def _seen(docs: DataFrame) -> DataFrame:
    """``h, doc_id``: the distinct minimizers of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy()
            for c in chunks(b.column(1), whole=True):
                _, at, low = minimizers(c)
                if not len(at):
                    continue
                part = c.word_part[at]
                order = np.lexsort((low, part))
                low, part = low[order], part[order]
                new = np.concatenate(([True], (low[1:] != low[:-1]) | (part[1:] != part[:-1])))
                yield pa.RecordBatch.from_arrays([pa.array(low[new]), pa.array(ids[c.row[part[new]]])],
                                                 names=["h", "doc_id"])

    return docs.mapInArrow(run, "h bigint, doc_id bigint")


def _segments(docs: DataFrame, with_words: bool) -> DataFrame:
    """Segments of documents with the column ``hits`` (repeated minimizers; those
    of very many documents as their bitwise complement): ``key`` (minimizer, or
    hash of a window dealt singly), ``sid`` (hash of the words), ``doc_id`` and
    ``words`` (64-bit hashes), or else ``row``, ``start`` (first word)."""
    names = ["key", "sid", "doc_id", *(["words"] if with_words else ["row", "start"])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys = b.column(0).to_numpy(), b.column(1).to_numpy()
            hits = b.column(3)
            sizes, values = np.diff(np.asarray(hits.offsets)), hits.flatten().to_numpy(zero_copy_only=False)
            hit_at = np.concatenate(([0], np.cumsum(sizes)))
            for c in chunks(b.column(2), whole=True):
                h, at, low = minimizers(c)
                if not len(at):
                    continue
                part = c.word_part[at]
                rows = c.row[part]
                want = np.concatenate([np.sort(np.where(v < 0, ~v, v)) for v in
                                       (values[hit_at[r]:hit_at[r + 1]] for r in c.row)] or [np.zeros(0, np.int64)])
                hot = np.unique(np.concatenate([~v[v < 0] for v in (values[hit_at[r]:hit_at[r + 1]] for r in c.row)]))
                # a hit belongs to its document: compare (document, minimizer) pairs
                tag = mix64(low.astype(np.uint64) + rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                have = np.sort(mix64(want.astype(np.uint64) + np.repeat(c.row, sizes[c.row]).astype(np.uint64)
                                     * np.uint64(0x9E3779B97F4A7C15)))
                if not len(have):
                    continue
                mine = have[np.minimum(np.searchsorted(have, tag), len(have) - 1)] == tag
                at, low, part, rows = at[mine], low[mine], part[mine], rows[mine]
                if not len(at):
                    continue
                single = np.isin(low, hot)
                new = np.ones(len(at), bool)
                new[1:] = (low[1:] != low[:-1]) | (at[1:] != at[:-1] + 1) | (part[1:] != part[:-1]) | single[1:]
                place = np.arange(len(at)) - np.flatnonzero(new)[np.cumsum(new) - 1]
                first = np.flatnonzero(new | (place % RUN == 0))
                last = np.append(first[1:], len(at)) - 1
                start, stop = at[first], at[last] + WINDOW
                # two sums of the words' hashes by place name the content
                n = stop - start
                offset = np.concatenate(([0], np.cumsum(n)))
                place = np.arange(offset[-1]) - np.repeat(offset[:-1], n)
                text = h[np.repeat(start, n) + place]
                sid = mix64(np.add.reduceat(mix64(text + place.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)),
                                            offset[:-1]) + n.astype(np.uint64))
                sid = (sid >> np.uint64(1)).astype(np.int64)
                key = np.where(single[first], sid, low[first])
                out = [pa.array(key), pa.array(sid), pa.array(ids[rows[first]])]
                if with_words:
                    raw = pa.Array.from_buffers(pa.binary(), len(n), [
                        None, pa.py_buffer((offset * 8).astype(np.int32).tobytes()), pa.py_buffer(text.tobytes())])
                    out.append(raw)
                else:
                    out += [pa.array(keys[rows[first]]), pa.array((start - c.first_word[part[first]]).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(out, names=names)

    return docs.mapInArrow(run, "key bigint, sid bigint, doc_id bigint, " + (
        "words binary" if with_words else "row bigint, start int"))


class WaveletMatrix:
    """Rank queries over a sequence of numbers below ``2 ** levels``, on packed
    bits with one count per 64."""

    def __init__(self, values: np.ndarray):
        self.levels = max(1, int(values.max()).bit_length()) if len(values) else 1
        self.bits, self.counts, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = ((values >> level) & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            packed = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view(np.uint64)
            self.bits.append(packed)
            self.counts.append(np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64))).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            values = np.concatenate([values[~bit], values[bit]])

    def rank(self, symbol: np.ndarray, at: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each symbol before ``at`` and before ``low``, up to the
        same amount (only their difference and order matter to the caller)."""
        for k in range(self.levels):
            one = (symbol >> (self.levels - 1 - k)) & 1 > 0
            for p in (at, low):
                word = p >> 6
                ones = self.counts[k][word] + np.bitwise_count(
                    self.bits[k][word] & ((np.uint64(1) << (p & 63).astype(np.uint64)) - np.uint64(1)))
                p[:] = np.where(one, self.zeros[k] + ones, p - ones)
        return at, low


class FMIndex:
    """Backward search over a text of symbols (0 ends it, 1 separates)."""

    def __init__(self, text: np.ndarray):
        self.suffixes = _suffixes(text)
        self.bwt = WaveletMatrix(text[self.suffixes - 1])
        counts = np.bincount(text)
        self.before = np.concatenate(([0], np.cumsum(counts)))
        # where the wavelet matrix puts each symbol's first occurrence
        symbols = np.arange(len(counts))
        self.first = self.bwt.rank(symbols, np.zeros(len(symbols), np.int64), np.zeros(len(symbols), np.int64))[0]

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of ``symbol`` followed by what ``[lo, hi)`` matches."""
        hi, lo = self.bwt.rank(symbol, hi.copy(), lo.copy())
        base = self.before[symbol] - self.first[symbol]
        return lo + base, hi + base


def _suffixes(text: np.ndarray) -> np.ndarray:
    """Suffixes in the order of their first 16 symbols (windows need 13), by
    prefix doubling."""
    rank = text.astype(np.int64)
    n = len(text)
    for step in (1, 2, 4, 8):
        behind = np.zeros(n, np.int64)
        behind[:n - step] = rank[step:] + 1
        key = rank * (int(rank.max()) + 2) + behind
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            break
    return order


def search(words: list[bytes], doc: np.ndarray) -> list[np.ndarray]:
    """For every window of every segment, the smallest ``doc`` among all segments
    of the shard that hold it."""
    size = np.array([len(w) // 8 for w in words])
    flat = np.frombuffer(b"".join(words), np.uint64)
    symbols = np.unique(flat, return_inverse=True)[1] + 2
    # text: the segments, a separator behind each, and the end
    shift = np.arange(len(words))
    at = np.concatenate(([0], np.cumsum(size)[:-1])) + shift
    text = np.ones(len(flat) + len(words) + 1, np.int64)
    text[np.arange(len(flat)) + np.repeat(shift, size)] = symbols
    text[-1] = 0
    owner = np.append(np.repeat(np.arange(len(words)), size + 1), 0)
    index = FMIndex(text)
    doc_at = np.append(doc, np.iinfo(np.int64).max)[np.where(text == 1, len(doc), owner)][index.suffixes]
    n = size - WINDOW + 1
    first = np.concatenate(([0], np.cumsum(n)[:-1]))
    start = np.repeat(at, n) + np.arange(int(n.sum())) - np.repeat(first, n)
    low = np.repeat(doc, n)  # a window that matches nothing else has its own
    for k in range(0, len(start), BLOCK):
        s = start[k:k + BLOCK]
        live = np.arange(len(s))
        lo, hi = np.zeros(len(s), np.int64), np.full(len(s), len(text), np.int64)
        for step in range(WINDOW - 1, -1, -1):
            lo, hi = index.extend(text[s[live] + step], lo, hi)
            more = hi - lo > 1  # matches another place: the statistic grows
            live, lo, hi = live[more], lo[more], hi[more]
        if len(live):  # reached the threshold
            spans, inverse = np.unique(lo << 32 | hi, return_inverse=True)
            cuts = np.stack([spans >> 32, spans & 0xFFFFFFFF], 1).ravel()
            low[k + live] = np.minimum.reduceat(np.append(doc_at, doc_at[-1:]), cuts)[::2][inverse]
    return np.split(low, np.cumsum(n)[:-1])


def _indexed(pdf: pd.DataFrame) -> pd.DataFrame:
    """The reports of one shard: segments with a window that a document with a
    smaller id than their largest one holds."""
    low = search(list(pdf["words"]), pdf["lo"].to_numpy())
    keep = [bool((x < d).any()) for x, d in zip(low, pdf["hi"], strict=True)]
    return pd.DataFrame({"key": pdf["key"][keep], "sid": pdf["sid"][keep],
                         "low": [x for x, k in zip(low, keep, strict=True) if k]})


def repeated_windows(docs: DataFrame) -> DataFrame:
    """``doc_id, row, windows``: for each document that has some, the first words
    of its windows that also start in a document with a smaller id (``row``
    tells rows of one doc_id apart)."""
    spark = docs.sparkSession
    known = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    plain = known.select("doc_id", text_or_empty("text").alias("text"))
    seen = _seen(plain)
    count = seen.groupBy(F.col("h").alias("_h")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    flag = F.when(F.col("n") > HOT, F.bitwise_not(F.col("h"))).otherwise(F.col("h"))
    hits = staged(seen.join(count, seen["h"] == count["_h"]).groupBy("doc_id").agg(
        F.collect_set(flag).alias("hits")), "minimizers")
    total = hits.agg(F.sum(F.size("hits"))).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(4 * parts, -(-total * (WINDOW + 4) // SHARD))
    at = plain.withColumn("row", row_key()).join(
        hits.withColumnRenamed("doc_id", "_id"), F.col("doc_id") == F.col("_id")).select("doc_id", "row", "text", "hits")
    # Written between the steps, so that the shuffles of one (texts, segments,
    # shards) are gone before the next begins.
    distinct = staged(_segments(at, True).groupBy("key", "sid", "words").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")), "segments")
    reports = staged(distinct.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
                     .groupBy("shard").applyInPandas(_indexed, "key bigint, sid bigint, low array<bigint>"), "reports")
    discard(distinct)
    found = reports.select(F.col("key").alias("_k"), F.col("sid").alias("_s"), "low")
    held = _segments(at, False)
    met = held.join(found, (held["key"] == found["_k"]) & (held["sid"] == found["_s"]))
    windows = met.select("doc_id", "row", F.filter(
        F.transform("low", lambda x, i: F.when(x < F.col("doc_id"), F.col("start") + i)),
        lambda x: x.isNotNull()).alias("w")).where(F.size("w") > 0)
    out = staged(windows.groupBy("doc_id", "row").agg(F.flatten(F.collect_set("w")).alias("windows")), "windows")
    discard(hits, reports)
    return out


def deduplicated(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with ``n_words``, ``n_removed`` and ``kept_text``
    (the remaining words joined by one space).  Runs jobs."""
    found, own = repeated_windows(docs), unused_prefix(docs, "_fm_")
    found = found.select(F.col("doc_id").alias(f"{own}id"), F.col("row").alias(f"{own}row"), F.col("windows").alias(f"{own}windows"))
    names = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_text")]
    rows = docs.select(*names, row_key().alias(f"{own}key"))
    rows = rows.join(found, (F.col("doc_id") == F.col(f"{own}id")) & (F.col(f"{own}key") == F.col(f"{own}row")), "left").select(
        *names, text_or_empty("text").alias(f"{own}text"), f"{own}windows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, removed, kept = [], [], []
            for text, windows in zip(b.column(len(names)), b.column(len(names) + 1), strict=True):
                words = text.as_py().encode().split()  # of bytes: at the six ASCII white-space characters
                n.append(len(words))
                if windows.is_valid:
                    edge = np.zeros(len(words) + 1, np.int64)
                    w = np.unique(windows.values.to_numpy(zero_copy_only=False))
                    np.add.at(edge, w, 1)
                    np.add.at(edge, w + WINDOW, -1)
                    clear = np.cumsum(edge[:-1]) == 0
                    words = [words[k] for k in np.flatnonzero(clear)]
                removed.append(n[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k) for k in range(len(names))], pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.string())], names=[*names, "n_words", "n_removed", "kept_text"])

    kept = type(docs.schema)([f for f in docs.schema.fields if f.name in names])
    return rows.mapInArrow(run, kept.add("n_words", "long").add("n_removed", "long").add("kept_text", "string"))
