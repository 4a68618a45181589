"""Byte-level BPE encoding and decoding with the tiktoken library.

The ranks come from a local file, read once on the driver and broadcast (a
vocabulary: its size does not grow with the data).  Long texts are cut at
places that no match of the splitting pattern can cross, so the pieces
encode to the same ids as the whole:

* before white space that follows something else, and
* in a run of white space, before its last character (the pattern leaves
  that one to the next match).

Scale: one pass over the rows, no shuffle; a task holds one Arrow batch, and
one long text is encoded piece by piece.

Defined results: null and empty texts have no ids and decode to no bytes;
repeated rows are encoded alike; columns other than the id and the text are
ignored; an empty table gives an empty result.  With a splitting pattern other
than ``PATTERN`` texts are encoded whole: the boundaries hold for this one.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE = 50_000  # characters after which a safe boundary is looked for
SPACE_RUN = 1_000  # longer runs of white space are tokens of their own, past the regex

# Fixed value: the splitting pattern whose matches cross no boundary of this module.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# The white space of the splitting pattern (Unicode White_Space;
# Python's own \\s also takes \\x1c to \\x1f, which that pattern does not).
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BOUNDARY = re.compile(f"(?<=[^{_SPACE}])(?=[{_SPACE}])")
_RUN = re.compile(f"[{_SPACE}]{{{SPACE_RUN},}}")


def load_ranks(spark: SparkSession, path: str):
    """The rank file (lines: token in base64, rank) of the driver, broadcast."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encoder(lines: bytes, pattern: str):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines.splitlines() if x)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text cut at safe boundaries into pieces of about ``size`` characters
    (longer only where no boundary is in reach); long runs of white space up to
    their last character are pieces of their own."""
    at = 0
    while len(text) - at > size:
        m = _BOUNDARY.search(text, at + size)
        if m is None:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


def encode(enc, text: str) -> list[int]:
    """The ids that ``enc.encode_ordinary`` gives for the whole text."""
    if len(text) <= PIECE or enc._pat_str != PATTERN:
        return enc.encode_ordinary(text)
    out: list[int] = []
    for piece in pieces(text):
        at = 0
        for run in _RUN.finditer(piece):
            # the run's last character belongs to the next match, unless the text ends here
            end = run.end() if run.end() == len(piece) else run.end() - 1
            out += enc.encode_ordinary(piece[at:run.start()])
            out += enc._encode_single_piece(piece[run.start():end])
            at = end
        out += enc.encode_ordinary(piece[at:])
    return out


ENCODED = "doc_id bigint, ids array<int>"


def _mapped(docs: DataFrame, rank_path: str, pattern: str, schema: str, row) -> DataFrame:
    ranks = load_ranks(docs.sparkSession, rank_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks.value, pattern)
        for b in batches:
            yield row(enc, b.column(0), b.column(1))

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)


def encode_documents(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids`` (all token ids of the whole text)."""
    def row(enc, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        tokens = [encode(enc, t.as_py()) for t in texts]
        return pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(tokens, pa.list_(pa.int32()))],
                                          names=["doc_id", "ids"])

    return _mapped(docs, rank_path, pattern, ENCODED, row)


def decode_documents(encoded: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``bytes``: the raw bytes of the ids, without any repair of
    sequences that are not valid text.  Null ids give no bytes."""
    ranks = load_ranks(encoded.sparkSession, rank_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks.value, pattern)
        for b in batches:
            raw = [enc.decode_bytes(x.as_py() or []) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(raw, pa.binary())],
                                             names=["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, bytes binary")


DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, rank_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Encodes and decodes every text in one pass: ``n_tokens``, ``ids_sha256``
    (decimal ids joined by one space) and ``decoded_sha256`` (decoded bytes);
    with ``ids`` themselves if asked for."""
    def row(enc, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        n, sent, back, all_ids = [], [], [], []
        for t in texts:
            tokens = encode(enc, t.as_py())
            n.append(len(tokens))
            sent.append(_ids_digest(tokens))
            back.append(hashlib.sha256(enc.decode_bytes(tokens)).hexdigest())
            if with_ids:
                all_ids.append(np.array(tokens, np.int32))
        out = [ids.cast(pa.int64()), pa.array(n, pa.int64()), pa.array(sent, pa.string()), pa.array(back, pa.string())]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            out.append(pa.array(all_ids, pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(out, names=names)

    return _mapped(docs, rank_path, pattern, DIGESTS + (", ids array<int>" if with_ids else ""), row)


def _ids_digest(tokens: list[int], step: int = 100_000) -> str:
    digest = hashlib.sha256()
    for k in range(0, len(tokens), step):
        digest.update((" " if k else "").encode() + " ".join(map(str, tokens[k:k + step])).encode())
    return digest.hexdigest()
