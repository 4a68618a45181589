"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words.  Every passage of the
whole text is encoded (character-pair frequencies, character classes, word
repetition, through one tanh layer); gated attention learnt from the
document labels weighs the passages; the weighted mean is scored.

Scale: one pass over the documents in Arrow batches, no shuffle.  The model
is trained on the driver on the features of every passage of a bounded number
of rows (``per_class`` of each class), and is a few thousand numbers in the
task's closure.

Defined results: null and empty texts are one passage without words;
repeated rows get the same score; no labels of one class at all: every
score is 0.5 and predicted 1 (with a warning if there are labels, but no
documents to them); labels that are null teach nothing; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furlong.llm.flat_text import Adam, Chunk, chunks, sigmoid, word_hashes
from furlong.llm.labels import bounded, training_sample, warn_unused

PASSAGE = 64
PAIRS = 128
CLASSES = 8
FEATURES = PAIRS + CLASSES + 5
HIDDEN, GATE = 24, 12

_KIND = np.full(256, 7, np.uint8)  # anything else: symbols
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 0, 1, 2, 3
_KIND[[9, 10, 11, 12, 13, 32]] = 4
_KIND[[44, 46, 59, 58, 39, 34, 45]] = 5
_KIND[[33, 63]] = 6
_code = np.arange(65536, dtype=np.uint64)
_PAIR = (((_code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(PAIRS)).astype(np.int64)


def passages(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of a chunk (float32), and the part of each.
    A part without words is one passage."""
    per_part = np.maximum(1, -(-c.n_words // PASSAGE))
    first = np.concatenate(([0], np.cumsum(per_part)[:-1]))
    part = np.repeat(np.arange(len(c.row)), per_part)
    n = len(part)
    word_at = np.arange(len(c.start)) - c.first_word[c.word_part]
    word_in = first[c.word_part] + word_at // PASSAGE
    # a byte belongs to the passage of the last word begun before it in its part
    begun = np.zeros(len(c.data) + 1, np.int64)
    begun[c.start] = 1
    at = np.cumsum(begun[:-1]) - 1
    lead = (at < 0) | (at < c.first_word[c.part_of])
    byte_in = np.where(lead, first[c.part_of], word_in[np.maximum(at, 0)] if len(word_in) else 0)
    size = np.bincount(byte_in, minlength=n)
    same = c.part_of[1:] == c.part_of[:-1] if len(c.data) else np.zeros(0, bool)
    pair = _PAIR[(c.data[:-1].astype(np.int64) << 8 | c.data[1:])[same]]
    pairs = np.bincount(byte_in[:-1][same] * PAIRS + pair, minlength=n * PAIRS).reshape(n, PAIRS)
    kinds = np.bincount(byte_in * CLASSES + _KIND[c.data], minlength=n * CLASSES).reshape(n, CLASSES)
    words = np.bincount(word_in, minlength=n).astype(np.float64)
    h = word_hashes(c)
    near = [np.bincount(word_in[k:][(h[k:] == h[:-k]) & (word_in[k:] == word_in[:-k])], minlength=n)
            for k in (1, 2)] if len(h) > 2 else [np.zeros(n), np.zeros(n)]
    order = np.lexsort((h, word_in))
    hs, ws = h[order], word_in[order]
    new = np.ones(len(h), bool)
    new[1:] = (hs[1:] != hs[:-1]) | (ws[1:] != ws[:-1])
    kinds_of_words = np.bincount(ws[new], minlength=n)
    some, chars = np.maximum(words, 1), np.maximum(size, 1)[:, None]
    x = np.concatenate([
        np.sqrt(pairs / chars), np.sqrt(kinds / chars),
        np.stack([near[0] / some, near[1] / some, kinds_of_words / some,
                  np.log1p(words) / 4, size / some / 8], 1)], 1)
    return x.astype(np.float32), part


def _bag(x: np.ndarray, at: np.ndarray, p: dict) -> dict:
    """Forward pass; ``at``: first passage of each document."""
    h = np.tanh(x @ p["W"] + p["b"])
    t, g = np.tanh(h @ p["V"] + p["bv"]), sigmoid(h @ p["U"] + p["bu"])
    e = (t * g) @ p["a"]
    n = np.diff(np.append(at, len(x)))
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, at), n))
    w = e / np.repeat(np.add.reduceat(e, at), n)
    z = np.add.reduceat(w[:, None] * h, at)
    return {"h": h, "t": t, "g": g, "w": w, "z": z, "n": n, "score": sigmoid(z @ p["c"] + p["d"])}


def _grads(x: np.ndarray, at: np.ndarray, y: np.ndarray, p: dict, weight: np.ndarray | float = 1.0) -> dict:
    f = _bag(x, at, p)
    do = weight * (f["score"] - y) / len(y)
    dz = do[:, None] * p["c"]
    dzr = np.repeat(dz, f["n"], 0)
    dw = (dzr * f["h"]).sum(1)
    de = f["w"] * (dw - np.repeat(np.add.reduceat(f["w"] * dw, at), f["n"]))
    dtg = de[:, None] * p["a"]
    dt, dg = dtg * f["g"] * (1 - f["t"] ** 2), dtg * f["t"] * f["g"] * (1 - f["g"])
    dh = dzr * f["w"][:, None] + dt @ p["V"].T + dg @ p["U"].T
    da = dh * (1 - f["h"] ** 2)
    g = {"W": x.T @ da, "b": da.sum(0), "V": f["h"].T @ dt, "bv": dt.sum(0), "U": f["h"].T @ dg, "bu": dg.sum(0),
         "a": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ do, "d": do.sum(keepdims=True)}
    for k in ("W", "V", "U", "c"):
        g[k] = g[k] + 1e-4 * p[k]
    return g


def fit(bags: list[np.ndarray], y: np.ndarray, epochs: int = 25, batch: int = 64, seed: int = 3) -> dict:
    """The model's arrays, from the passage features and label of each document."""
    rng = np.random.default_rng(seed)
    shape = {"W": (FEATURES, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, GATE), "bv": (GATE,), "U": (HIDDEN, GATE),
             "bu": (GATE,), "a": (GATE,), "c": (HIDDEN,), "d": (1,)}
    p = {k: (rng.normal(0, 1 / np.sqrt(s[0]), s) if k in "WVUac" else np.zeros(s)) for k, s in shape.items()}
    if not len(y) or y.min() == y.max():
        return p | {"c": np.zeros(HIDDEN)}
    adam = Adam(p, 0.01)
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))  # both classes count alike
    for epoch in range(epochs):
        adam.rate = 0.01 * (1 - epoch / epochs) + 0.0005
        order = rng.permutation(len(y))
        for k in range(0, len(y), batch):
            rows = order[k:k + batch]
            n = np.array([len(bags[r]) for r in rows])
            at = np.concatenate(([0], np.cumsum(n)[:-1]))
            adam.step(_grads(np.concatenate([bags[r] for r in rows]).astype(np.float64), at, y[rows], p, weight[rows]))
    return p


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality",
          per_class: int = 1500) -> dict:
    """Fits the model on every passage of whole labelled documents, at most
    ``per_class`` rows of each class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            label, ids = b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_pylist()
            found: dict[int, list] = {}
            for c in chunks(b.column(0)):
                x, part = passages(c)
                for k, r in enumerate(c.row):
                    found.setdefault(int(r), []).append(x[part == k] if len(c.row) < 2 else x[
                        np.searchsorted(part, k):np.searchsorted(part, k, "right")])
            rows = [(int(label[r]), np.concatenate(x).astype(np.float16).tobytes(), ids[r]) for r, x in found.items()]
            yield pa.RecordBatch.from_arrays([pa.array([y for y, _, _ in rows], pa.int32()), pa.array([x for _, x, _ in rows], pa.binary()),
                                              pa.array([i for _, _, i in rows], pa.int64())], names=["label", "x", "doc_id"])

    sample = training_sample(docs, labels, label, usable, per_class)
    features = sample.select("text", F.col("label").cast("int").alias("label"), F.col("doc_id").cast("long").alias("doc_id"))
    rows = bounded(features.mapInArrow(run, "label int, x binary, doc_id bigint"), per_class)
    rows.sort(key=lambda r: (r["label"], bytes(r["x"])))
    warn_unused(labels, label, usable, {r["label"] for r in rows})
    return fit([np.frombuffer(r["x"], np.float16).reshape(-1, FEATURES).astype(np.float32) for r in rows],
               np.array([r["label"] for r in rows], np.float64))


def score(docs: DataFrame, model: dict, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` (which may hold the text) with ``score``
    (probability of label 1) and ``predicted`` (1 if score >= 0.5)."""
    keep = tuple(k for k in keep if k not in ("score", "predicted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.full(b.num_rows, 0.5)
            held: dict[int, list] = {}  # first and last rows of the chunks: only they can have more parts
            for c in chunks(b.column(b.num_columns - 1)):
                x, part = passages(c)
                at = np.searchsorted(part, np.arange(len(c.row) + 1))
                if len(c.row) > 1:
                    out[c.row] = _bag(x, at[:-1], model)["score"]
                for k in {0, len(c.row) - 1}:
                    held.setdefault(int(c.row[k]), []).append(x[at[k]:at[k + 1]].copy())
            for r, xs in held.items():
                out[r] = _bag(np.concatenate(xs), np.array([0]), model)["score"][0]
            out = np.round(out, 9)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k) for k in range(b.num_columns - 1)], pa.array(out),
                 pa.array((out >= 0.5).astype(np.int32))], names=[*keep, "score", "predicted"])

    rows = docs.select(*keep, F.coalesce("text", F.lit("")).alias("_mil_text"))
    kept = [f for f in rows.schema.fields if f.name != "_mil_text"]
    schema = type(rows.schema)(kept).add("score", "double").add("predicted", "integer")
    return rows.mapInArrow(run, schema)
