"""Cross-tokenizer alignment by an associative monoid of fragments.

A text (with a space before it) is tokenized twice, byte-level (A) and in
pieces (B).  Byte offsets at which tokens of both end cut the tokens into
groups; an A and a B token that end together are linked.

A byte range of a text gives a :class:`Fragment`: the open prefix (tokens up to
its first common end, which may go on from the left), the closed groups, and
the open suffix (tokens behind its last common end).  Fragments of
neighbouring ranges compose, in any bracketing: what is open on both sides of
the seam closes to one group.  A range without a common end is all prefix.

* A text of up to ``CHUNK`` characters is one range.
* Longer texts are cut into ranges where both tokenizers begin anew, at a
  space behind something else (no entry of either vocabulary crosses it, which
  is checked when the files are loaded).  Ranges are dealt over the tasks; their
  fragments are composed by a tree, ``FAN`` neighbours to a task and round.
  Only what is open, and the groups closed at seams, travel up the tree; the
  closed groups of a range stay where they are, and one sorted pass over the
  parts of a text makes its digest.

Then every link's id pair is counted over the corpus, and each document adds
up the counts of its links, and how many of them are the best of their B id.

Scale: texts are tokenized once; a Python worker keeps the tokens of up to
``KNOWN`` runs between spaces that it met twice.  Runs of plain characters go
to a library that merges by ranks, which is several times faster, if it is
proven that this vocabulary's ranks give the same ids as its merges.  Links are kept as 32-bit numbers and counted per task
before they meet.  The best count of each B id is a table bounded by the
vocabulary.  Pairs with at least a ``HOT``-th of all links are ``HOT`` at most,
whatever the corpus, and so are broadcast; the links of the others, each pair a
small share, are joined by a shuffle.

Defined results: texts that are null or empty, or whose joined tokens of
either side are not the text's bytes (for example with U+2581, which B takes
for a space), have no tokens: zeros and ''.  Rows without an id and repeated
rows are documents of their own; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from furlong.llm.common import Recent, discard, kept_by_worker, staged

CHUNK = 1 << 16  # characters of a range
FAN = 16  # fragments composed by one task in a round
KNOWN = 200_000  # runs between spaces whose tokens a Python worker keeps
PLAIN = "\u0250"  # runs of characters below go to the faster library for A
HOT = 200_000
COUNTED = 1 << 22  # links that a task counts at once

_CUT = re.compile(r"(?<=\S) (?=.)", re.DOTALL)
_EMPTY = np.zeros(0, np.int32)
_COUNTS, _TEXT, _LINKS = itemgetter(0), itemgetter(1), itemgetter(2)  # of what is known of a run


# --- the monoid ---------------------------------------------------------------

@dataclass
class Fragment:
    """The tokens that end in a byte range.  ``first`` is the number of the range
    in which the prefix closes; ``body`` the closed groups as (number of the
    range in which they close, text), in order."""

    head_a: np.ndarray = field(default_factory=lambda: _EMPTY)
    head_b: np.ndarray = field(default_factory=lambda: _EMPTY)
    first: int | None = None  # None: no common end, all tokens are in the head
    body: list[tuple[int, bytes]] = field(default_factory=list)
    tail_a: np.ndarray = field(default_factory=lambda: _EMPTY)
    tail_b: np.ndarray = field(default_factory=lambda: _EMPTY)

    def then(self, other: Fragment) -> Fragment:
        """The fragment of both ranges, ``other`` being the one to the right."""
        joined = np.concatenate
        if self.first is None:
            return Fragment(joined([self.head_a, other.head_a]), joined([self.head_b, other.head_b]), other.first,
                            other.body, other.tail_a, other.tail_b)
        a, b = joined([self.tail_a, other.head_a]), joined([self.tail_b, other.head_b])
        if other.first is None:
            return Fragment(self.head_a, self.head_b, self.first, self.body, a, b)
        return Fragment(self.head_a, self.head_b, self.first,
                        [*self.body, (other.first, group_text(a, b)), *other.body], other.tail_a, other.tail_b)

    def groups(self) -> list[tuple[int, bytes]]:
        """All groups of a whole text, whose prefix begins with it and whose last
        common end is its end."""
        if len(self.tail_a) or len(self.tail_b) or self.first is None and len(self.head_a) + len(self.head_b):
            raise ValueError("the fragment is not that of a whole text")
        return [] if self.first is None else [(self.first, group_text(self.head_a, self.head_b)), *self.body]


def common_ends(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of either side end together (ends in increasing order)."""
    if not len(b_end):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(b_end, a_end)
    both = b_end[np.minimum(at, len(b_end) - 1)] == a_end
    return np.flatnonzero(both), at[both]


def group_text(a: np.ndarray, b: np.ndarray) -> bytes:
    return (",".join(map(str, a.tolist())) + "|" + ",".join(map(str, b.tolist()))).encode()


def fragment(a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray, number: int = 0) -> tuple[Fragment, np.ndarray, np.ndarray]:
    """The fragment of the tokens that end in range ``number``, by their ids and
    ends, and the linked ids of both sides."""
    at_a, at_b = common_ends(a_end, b_end)
    if not len(at_a):
        return Fragment(a, b), _EMPTY, _EMPTY
    cut_a, cut_b = at_a + 1, at_b + 1
    body = [(number, group_text(a[i:j], b[k:m])) for i, j, k, m in
            zip(cut_a[:-1].tolist(), cut_a[1:].tolist(), cut_b[:-1].tolist(), cut_b[1:].tolist(), strict=True)]
    return (Fragment(a[:cut_a[0]], b[:cut_b[0]], number, body, a[cut_a[-1]:], b[cut_b[-1]:]), a[at_a], b[at_b])


# --- the two tokenizers ---------------------------------------------------------

def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable
    Latin-1 characters stand for themselves, the others, in order, for the
    characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(others)}}


def proven_ranks(definition: bytes) -> dict[bytes, int] | None:
    """The entries of a byte-level vocabulary as ranks, if merging by ranks always
    gives what its merges give; else None.

    Merging by ranks joins, of all neighbours whose joined bytes are an entry,
    those of the lowest one; the merges allow an entry's own two parts only.
    Both do the same steps as long as ranks join an entry's own parts.  No step
    crosses the border of a token that comes out, so the steps inside a token
    are those for its bytes alone: it is enough that every entry's bytes, joined
    by the ranks below its own, are its two parts."""
    model = json.loads(definition)["model"]
    letters = byte_letters()
    ranks = {bytes(letters[c] for c in entry): k for entry, k in model["vocab"].items()}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    pairs = [tuple(bytes(letters[c] for c in part) for part in m) for m in merges]
    made = [ranks.get(x + y) for x, y in pairs]
    single = {bytes([b]) for b in range(256)}
    if None in made or made != sorted(set(made)) or set(ranks) != single | {x + y for x, y in pairs}:
        return None
    if max(ranks[x] for x in single) > made[0]:
        return None
    for (x, y), rank in zip(pairs, made, strict=True):
        parts = [bytes([b]) for b in x + y]
        while len(parts) > 2:
            joined = [ranks.get(u + v, rank) for u, v in zip(parts, parts[1:], strict=False)]
            low = min(joined)
            if low >= rank:
                return None
            k = joined.index(low)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        if parts != [x, y]:
            return None
    return ranks


#: The pattern by which byte-level vocabularies of this kind split texts.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Tokenizers:
    """Both tokenizers, with the bytes of every entry.  With ``ranks`` (see
    :func:`proven_ranks`) plain runs go to a library that merges by ranks."""

    def __init__(self, definition: bytes, model: bytes, ranks: dict[bytes, int] | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(definition.decode())
        self.a.encode_special_tokens = True  # their strings in texts are text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ranked = None
        if ranks is not None:
            import tiktoken

            self.ranked = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        letters = byte_letters()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        special = self.a.get_added_tokens_decoder()
        for entry, k in self.a.get_vocab().items():
            self.bytes_a[k] = entry.encode() if k in special else bytes(letters[c] for c in entry)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode()
                        for k, p in enumerate(pieces)]
        if not (all(self.bytes_a) and all(self.bytes_b)):
            raise ValueError("a vocabulary entry has no bytes")
        if any(re.search(r"\S ", x.decode(errors="replace")) for x in itertools.chain(self.bytes_a, self.bytes_b)):
            raise ValueError("a vocabulary entry crosses the space behind a word: texts cannot be cut there")
        self.size_b = len(pieces)
        if len(self.bytes_a) * self.size_b > 1 << 32:
            raise ValueError("pairs of ids do not fit into 32 bits")
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        numbers = range(max(len(self.bytes_a), self.size_b))
        self._table_a, self._table_b = np.array(self.bytes_a, object), np.array(self.bytes_b, object)
        self.text = {sign: np.array([f"{k}{sign}".encode() for k in numbers], object) for sign in (",", "|", ";", "")}
        self.known = Recent(KNOWN)

    def ids_a(self, some: list[str]) -> list[list[int]]:
        """The A ids of runs, with the space before each."""
        return [e.ids for e in self.a.encode_batch_fast([" " + r for r in some], add_special_tokens=False)]

    def agree(self, raw: bytes, a: Iterable[int], b: Iterable[int]) -> bool:
        return b"".join([self.bytes_a[k] for k in a]) == raw and b"".join([self.bytes_b[k] for k in b]) == raw

    def of(self, all_runs: list[str]) -> dict[str, tuple[int, bytes, bytes]]:
        """What is known of runs, each aligned by itself, since nothing is open at
        the ends of a run: the numbers of its A and B tokens (and a mark if the
        bytes do not agree; see :func:`counts_of`), its groups' text and the
        pairs of its links."""
        new, known = self.known.missing(all_runs), self.known.now
        if new:
            new.sort(key=self._is_plain, reverse=True)
            known.update(zip(new, self._aligned(new), strict=True))
        return known

    def _is_plain(self, run: str) -> bool:
        return self.ranked is not None and max(run) < PLAIN

    def _ranked_ids(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain runs, one after another, and how many each has."""
        ids = np.array(self.ranked.encode_ordinary(" " + " ".join(some)), np.int32)
        ends = np.cumsum(self.len_a[ids])
        stops = np.cumsum([len(r.encode()) + 1 for r in some])
        at = np.searchsorted(ends, stops) + 1
        if not np.array_equal(ends[at - 1], stops):
            raise ValueError("a token crosses the end of a run")
        return ids, np.diff(at, prepend=0)

    def _aligned(self, some: list[str]) -> list[tuple[int, bytes, bytes]]:
        raw = [b" " + r.encode() for r in some]
        n_plain = sum(map(self._is_plain, some))  # they come first
        ids_a, counts_a = [], []
        for k in range(0, n_plain, 2000):
            ids, n = self._ranked_ids(some[k:min(k + 2000, n_plain)])
            ids_a.append(ids)
            counts_a.append(n)
        odd = self.ids_a(some[n_plain:])
        ids_a.append(np.fromiter(itertools.chain.from_iterable(odd), np.int32))
        counts_a.append(np.fromiter(map(len, odd), np.int64, len(odd)))
        all_a, n_a = np.concatenate(ids_a), np.concatenate(counts_a)
        b = self.b.encode(some, num_threads=1)
        all_b, n_b = np.fromiter(itertools.chain.from_iterable(b), np.int32), np.fromiter(map(len, b), np.int64, len(b))
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        everything = b"".join(raw)
        same = all(b"".join(table[ids].tolist()) == everything for table, ids in (
            (self._table_a, all_a), (self._table_b, all_b)))
        fine = np.ones(len(some), bool)
        if not same or (sum_of(self.len_a[all_a], n_a) != size).any() or (sum_of(self.len_b[all_b], n_b) != size).any():
            a = np.split(all_a, np.cumsum(n_a)[:-1])
            fine = np.array([self.agree(x, y.tolist(), z) for x, y, z in zip(raw, a, b, strict=True)])
            all_a, all_b = all_a[np.repeat(fine, n_a)], all_b[np.repeat(fine, n_b)]
        na, nb, stop = n_a[fine], n_b[fine], np.cumsum(size[fine])
        # the runs one after another are one text, with a common end behind each
        a_end, b_end = np.cumsum(self.len_a[all_a]), np.cumsum(self.len_b[all_b])
        at_a, at_b = common_ends(a_end, b_end)
        ends = a_end[at_a]
        pairs = all_a[at_a].astype(np.uint32) * np.uint32(self.size_b) + all_b[at_b].astype(np.uint32)
        # the tokens in the order in which the groups name them, with the sign behind each
        group_a, group_b = np.searchsorted(ends, a_end), np.searchsorted(ends, b_end)
        behind_a = np.arange(len(all_a)) + np.concatenate(([0], at_b + 1))[group_a]
        behind_b = np.arange(len(all_b)) + (at_a + 1)[group_b]
        text = np.empty(len(all_a) + len(all_b), object)
        last_a, last_b = np.zeros(len(all_a), bool), np.zeros(len(all_b), bool)
        last_a[at_a], last_b[at_b] = True, True
        final = last_b & np.isin(b_end, stop)
        for where, place, ids, sign in ((~last_a, behind_a, all_a, ","), (last_a, behind_a, all_a, "|"), (~last_b, behind_b, all_b, ","),
                                        (last_b & ~final, behind_b, all_b, ";"), (final, behind_b, all_b, "")):
            text[place[where]] = self.text[sign][ids[where]]
        text = text.tolist()
        to = np.cumsum(na + nb).tolist()
        links = pairs.tobytes()
        link_to = (4 * np.searchsorted(ends, stop, "right")).tolist()
        out, at, link_at, k = [], 0, 0, 0
        counts = (n_a | n_b << 24).tolist()
        for i, good in enumerate(fine.tolist()):
            if not good:
                out.append((1 << 48, b"", b""))
                continue
            out.append((counts[i], b"".join(text[at:to[k]]), links[link_at:link_to[k]]))
            at, link_at = to[k], link_to[k]
            k += 1
        return out


def sum_of(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of consecutive pieces of ``n`` values each."""
    total = np.concatenate(([0], np.cumsum(values)))
    at = np.cumsum(n)
    return total[at] - total[at - n]


def counts_of(total: int) -> tuple[int, int, bool]:
    """A tokens, B tokens, and whether all bytes agreed, of a sum of marks."""
    return total & 0xFFFFFF, total >> 24 & 0xFFFFFF, not total >> 48


def runs(text: str) -> list[str]:
    """A text in runs that, each with a space before it, tokenize like the whole.
    Joined by one space they are the text.  A run ends before a space that
    follows something other than white space."""
    parts = text.split(" ")
    out, held = [], None
    for p in parts:
        if held is not None:
            p, held = held + " " + p, None
        if not p or p[-1].isspace():
            held = p
        else:
            out.append(p)
    if held is not None:
        if held or not out:
            out.append(held)
        else:
            out[-1] += " "
    return out


def ranges(text: str, size: int = CHUNK) -> Iterator[str]:
    """A text in ranges of about ``size`` characters (longer where there is no
    place to cut), cut like runs; the space of a cut is left out."""
    at = 0
    while len(text) - at > size:
        m = _CUT.search(text, at + size)
        if m is None:
            break
        yield text[at:m.start()]
        at = m.end()
    yield text[at:]


def _tokenizers(sent) -> Tokenizers:
    """The tokenizers of this Python worker, which keeps them, and the runs they
    know, from task to task."""
    return kept_by_worker("alignment", sent.value, lambda: Tokenizers(*sent.value))


# --- documents of one range -------------------------------------------------------

SHORT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links binary"


def _whole(docs: DataFrame, sent) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizers(sent)
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                b = whole.slice(start, 500)
                texts = [runs(x) if x else [] for x in b.column(1).to_pylist()]
                known = t.of([r for x in texts for r in x])
                rows = []
                for x in texts:
                    found = [known[r] for r in x]
                    n_a, n_b, fine = counts_of(sum(map(_COUNTS, found)))
                    if not found or not fine:
                        rows.append((0, 0, 0, "", b""))
                        continue
                    links = b"".join(map(_LINKS, found))
                    rows.append((n_a, n_b, len(links) // 4, hashlib.sha256(b";".join(map(_TEXT, found))).hexdigest(), links))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                columns = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                    names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"])

    return docs.mapInArrow(run, SHORT)


# --- documents of many ranges -------------------------------------------------------

_OPEN = "head_a binary, head_b binary, first int, tail_a binary, tail_b binary, seams array<int>, closed array<binary>"
LEAF = f"row bigint, k int, fine boolean, n_a bigint, n_b bigint, n_groups bigint, inner binary, links binary, {_OPEN}"


def _chunked(docs: DataFrame, size: int) -> DataFrame:
    """``row, doc_id, k, text``: the ranges of long documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                for k, part in enumerate(ranges(text.as_py(), size)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row], pa.int64()), pa.array([doc_id], pa.int64()), pa.array([k], pa.int32()),
                         pa.array([part], pa.string())], names=["row", "doc_id", "k", "text"])

    # negative, so that they are no rows of the short documents
    numbered = docs.select((-1 - F.monotonically_increasing_id()).alias("row"), "doc_id", "text")
    return numbered.mapInArrow(run, "row bigint, doc_id bigint, k int, text string").repartition("row", "k")


def _packed(f: Fragment) -> tuple:
    return (f.head_a.tobytes(), f.head_b.tobytes(), f.first, f.tail_a.tobytes(), f.tail_b.tobytes(),
            [k for k, _ in f.body], [x for _, x in f.body])


def _unpacked(r) -> Fragment:
    ids = lambda x: np.frombuffer(x, np.int32)
    return Fragment(ids(r.head_a), ids(r.head_b), None if pd.isna(r.first) else int(r.first),
                    list(zip([int(k) for k in r.seams], r.closed, strict=True)), ids(r.tail_a), ids(r.tail_b))


def _leaves(chunks: DataFrame, sent) -> DataFrame:
    """The fragment of every range; the groups closed inside it stay apart, as
    ``inner``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizers(sent)
        schema = None
        for b in batches:
            for row, k, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3), strict=True):
                found = t.ids_a(x := runs(text.as_py())), t.b.encode(x, num_threads=1)
                fine = t.agree(b" " + text.as_py().encode(), *map(itertools.chain.from_iterable, found))
                out = Fragment()
                link_a = link_b = _EMPTY
                n_a = n_b = 0
                if fine:
                    a, bb = (np.fromiter(itertools.chain.from_iterable(x), np.int32) for x in found)
                    out, link_a, link_b = fragment(a, np.cumsum(t.len_a[a]), bb, np.cumsum(t.len_b[bb]), k)
                    n_a, n_b = len(a), len(bb)
                inner = b";".join(x for _, x in out.body)
                out.body = []
                links = (link_a.astype(np.uint32) * np.uint32(t.size_b) + link_b.astype(np.uint32)).tobytes()
                values = [row, k, fine, n_a, n_b, len(link_a), inner, links, *_packed(out)]
                kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(),
                         pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.binary())]
                names = ["row", "k", "fine", "n_a", "n_b", "n_groups", "inner", "links", "head_a", "head_b", "first", "tail_a",
                         "tail_b", "seams", "closed"]
                schema = schema or pa.schema(list(zip(names, kinds, strict=True)))
                yield pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(values, kinds, strict=True)], schema=schema)

    return chunks.mapInArrow(run, LEAF)


def _composed(pdf: pd.DataFrame) -> pd.DataFrame:
    """Neighbouring fragments of one text, composed from left to right."""
    pdf = pdf.sort_values("k")
    out = Fragment()
    for r in pdf.itertuples():
        out = out.then(_unpacked(r))
    head = pd.DataFrame({"row": pdf["row"].iloc[:1], "k": [int(pdf["k"].iloc[0])]})
    names = ["head_a", "head_b", "first", "tail_a", "tail_b", "seams", "closed"]
    for name, value in zip(names, _packed(out), strict=True):
        head[name] = pd.Series([value], index=head.index, dtype="Int32" if name == "first" else "object")
    return head


def _closed_groups(leaves: DataFrame, most: int) -> DataFrame:
    """``row, k, place, text``: all groups of every text in parts that, by ``k``
    and ``place``, are in order.  ``most``: ranges of the longest text."""
    columns = [c.split()[0] for c in _OPEN.split(", ")]
    tree = leaves.select("row", "k", *columns)
    while most > 1:  # a round leaves a FAN-th
        up = F.floor(F.col("k") / FAN).cast("int")
        tree = tree.withColumn("up", up).groupBy("row", "up").applyInPandas(
            _composed, f"row bigint, k int, {_OPEN}").withColumn("k", up)
        most = -(-most // FAN)

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pandas().itertuples():
                found = _unpacked(r).groups()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r.row] * len(found), pa.int64()), pa.array([k for k, _ in found], pa.int32()),
                     pa.array([0] * len(found), pa.int32()), pa.array([x for _, x in found], pa.binary())],
                    names=["row", "k", "place", "text"])

    seams = tree.select("row", "k", *columns).mapInArrow(rest, "row bigint, k int, place int, text binary")
    inner = leaves.where(F.length("inner") > 0).select("row", "k", F.lit(1).alias("place"), F.col("inner").alias("text"))
    return seams.unionByName(inner)


def _digests(parts: DataFrame) -> DataFrame:
    """``row, groups_sha256``: the parts of each text streamed in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for b in batches:
            done = []
            for row, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if row != now:
                    if now is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = row, hashlib.sha256()
                else:
                    digest.update(b";")
                digest.update(text.as_py())
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.int64()), pa.array([x for _, x in done], pa.string())],
                                             names=["row", "groups_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([digest.hexdigest()])],
                                             names=["row", "groups_sha256"])

    return parts.repartition("row").sortWithinPartitions("row", "k", "place").select("row", "text").mapInArrow(
        run, "row bigint, groups_sha256 string")


# --- counts of links over the corpus -----------------------------------------------

def _pair_counts(links: DataFrame) -> DataFrame:
    """``pair, n`` of the column ``links``, counted per task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(parts: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
            pair, at = np.unique(np.concatenate(parts), return_inverse=True)
            return pair, np.bincount(at, np.concatenate(times), len(pair)).astype(np.int64)

        def sent(pair: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for k in range(0, len(pair), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(pair[k:k + 100_000].astype(np.int64)), pa.array(n[k:k + 100_000])],
                                                 names=["pair", "n"])

        parts, times, size = [], [], 0
        for b in batches:
            for x in b.column(0):
                x = np.frombuffer(x.as_py(), np.uint32)
                parts.append(x)
                times.append(np.ones(len(x)))
                size += len(x)
                if size > COUNTED:
                    pair, n = counted(parts, times)
                    parts, times, size = [pair], [n.astype(np.float64)], len(pair)
                    if size > COUNTED // 2:
                        yield from sent(pair, n)
                        parts, times, size = [], [], 0
        if parts:
            yield from sent(*counted(parts, times))

    return links.mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


class _Counts:
    """The counts of all pairs: the frequent ones broadcast, the others (``rare``;
    None if there are none) as a table with the mark of the best."""

    def __init__(self, pairs: DataFrame, size_b: int, hot: int):
        total = pairs.agg(F.sum("n")).first()[0] or 0
        floor = -(-total // hot)  # at most ``hot`` pairs have that many links
        best = pairs.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("most"))
        top = best.toArrow()  # one row for each entry of the vocabulary at most
        most = np.zeros(size_b, np.int64)
        most[top["b"].to_numpy()] = top["most"].to_numpy()
        table = pairs.where(F.col("n") >= floor).toArrow()
        pair, n = table["pair"].to_numpy(), table["n"].to_numpy()
        order = np.argsort(pair)
        pair, n = pair[order], n[order]
        self.sent = pairs.sparkSession.sparkContext.broadcast((pair, n, n == most[pair % size_b]))
        rare = pairs.where(F.col("n") < floor)
        self.rare = None if rare.limit(1).count() == 0 else rare.withColumn("b", F.col("pair") % size_b).join(
            F.broadcast(best), "b").select(F.col("pair").alias("_pair"), "n", (F.col("n") == F.col("most")).cast("long").alias("is_best"))


MARKS = ("n_links", "n_best", "count_sum")


def _scored(rows: DataFrame, counts: _Counts, key: tuple[str, ...] = ("row",)) -> DataFrame:
    """``rows`` (told apart by ``key``) with, instead of their ``links``,
    ``n_links``, ``n_best`` and ``count_sum``."""
    sent = counts.sent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, is_best = sent.value
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
        for b in batches:
            out = []
            for x in b.column(b.num_columns - 1):
                x = np.frombuffer(x.as_py(), np.uint32).astype(np.int64)
                at = np.minimum(np.searchsorted(pair, x), max(0, len(pair) - 1))
                there = pair[at] == x if len(pair) else np.zeros(len(x), bool)
                at = at[there]
                out.append((len(x), int(is_best[at].sum()), int(n[at].sum()), x[~there]))
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                names=[*b.schema.names[:-1], *MARKS, "rare"])

    kept = [c for c in rows.columns if c != "links"]
    schema = rows.select(kept).schema
    for c in MARKS:
        schema = schema.add(c, "long")
    scored = rows.select(*kept, "links").mapInArrow(run, schema.add("rare", ArrayType(LongType())))
    if counts.rare is None:
        return scored.drop("rare")
    scored = staged(scored, "scored")
    used = scored.select(*key, F.explode("rare").alias("pair")).groupBy(*key, "pair").agg(F.count(F.lit(1)).alias("times"))
    more = used.join(counts.rare, F.col("pair") == F.col("_pair")).groupBy(*key).agg(
        F.sum(F.col("times") * F.col("is_best")).alias("_best"), F.sum(F.col("times") * F.col("n")).alias("_sum"))
    zero = F.lit(0).cast("long")
    return scored.join(more, list(key), "left").select(
        *kept, "n_links", (F.col("n_best") + F.coalesce("_best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", zero)).alias("count_sum"))


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", *MARKS, "groups_sha256")


def align(docs: DataFrame, byte_level_path: str, pieces_path: str, chunk: int = CHUNK, hot: int = HOT) -> DataFrame:
    """One row per document: ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``,
    ``n_best`` (links whose pair has the highest count of its B id),
    ``count_sum`` (of the links' pairs) and ``groups_sha256`` (of
    ``a1,a2|b1;a3|b2,b3``; '' without tokens).  The vocabulary files are read on
    the driver and broadcast.  Runs jobs."""
    with open(byte_level_path, "rb") as f, open(pieces_path, "rb") as g:
        files = f.read(), g.read()
    size_b = Tokenizers(*files).size_b
    files = *files, proven_ranks(files[0])
    sent = docs.sparkSession.sparkContext.broadcast(files)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    short = staged(_whole(texts.where(F.length("text") <= chunk), sent).withColumn("row", F.monotonically_increasing_id()), "aligned")
    chunks = staged(_chunked(texts.where(F.length("text") > chunk), chunk), "ranges")
    most = chunks.agg(F.max("k")).first()[0]
    if most is None:
        discard(chunks)
        counts = _Counts(staged(_pair_counts(short.select("links")), "pairs"), size_b, hot)
        return _scored(short, counts).select(*COLUMNS)

    leaves = staged(_leaves(chunks, sent), "fragments")
    ids = chunks.groupBy("row").agg(F.first("doc_id").alias("doc_id"))
    sums = leaves.groupBy("row").agg(F.min("fine").alias("fine"), *[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups")])
    whole = staged(ids.join(sums, "row"), "long-documents")
    good = staged(leaves.join(whole.where("fine").select("row"), "row", "left_semi"), "good-fragments")
    digests = _digests(_closed_groups(good, most + 1))
    counts = _Counts(staged(_pair_counts(short.select("links").unionByName(good.select("links"))), "pairs"), size_b, hot)
    marks = _scored(good.select("row", "k", "links"), counts, ("row", "k")).groupBy("row").agg(*[F.sum(c).alias(c) for c in MARKS])
    zero = F.lit(0).cast("long")
    long = whole.join(marks, "row", "left").join(digests, "row", "left").select("doc_id", *[
        F.when(F.col("fine"), F.col(c)).otherwise(zero).alias(c) for c in COLUMNS[1:-1]],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
    long = staged(long, "long-aligned")
    discard(chunks, leaves, whole, good)
    return _scored(short, counts).select(*COLUMNS).unionByName(long)
