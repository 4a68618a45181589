"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A text is scored in overlapping windows of ``WINDOW`` words, ``STRIDE``
apart, over its whole length (a part of a long text begins with the last
``WINDOW - 1`` words before it), so that a passage of up to ``WINDOW - STRIDE
+ 1`` words lies whole in one window; the score is that of the worst window.
Every word enters as a word embedding (hashed, case-folded) joined to a
character embedding (mean of its hashed character trigrams).  Both
directions run over the window; attention pools their states.

Training is multiple-instance learning in numpy: a window of a toxic
document is first taken for toxic, then only the documents' worst windows
are; clean documents teach with their worst and a random window.

Scale: one pass over the documents in Arrow batches, no shuffle.  Input
projections are computed once per distinct word of a chunk, and windows go
through the network in blocks, so memory is bounded.  The model is trained
on the driver on all windows of a bounded number of rows (``per_class`` of each
class) and is about 500 kB, broadcast.

Defined results: null and empty texts are one window without words;
repeated rows get the same score; no labels of one class at all: every score
is 0.5 and predicted 1 (with a warning if there are labels, but no documents
to them); labels that are null teach nothing; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furlong.llm.flat_text import Adam, Chunk, chunks, sigmoid, word_hashes
from furlong.llm.labels import bounded, training_sample, warn_unused

WINDOW, STRIDE = 32, 16
WORD_ROWS, GRAM_ROWS = 8192, 8192
WORD_DIM, GRAM_DIM, HIDDEN, POOL = 8, 8, 8, 8
BLOCK = 4096  # windows that go through the network at once


def vocabulary(c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of a chunk: row in the word table, trigram rows in order
    with the first of each word, and the distinct word of each word."""
    h = word_hashes(c)
    _, at, inverse = np.unique(h, return_index=True, return_inverse=True)
    start, end = c.start[at], c.end[at]
    n = end - start + 2  # with a mark before and behind, as many trigrams as bytes
    first = np.concatenate(([0], np.cumsum(n)[:-1])).astype(np.int64)
    total = int(n.sum())
    text = np.zeros(total + 2, np.uint32)
    place = np.arange(total) - np.repeat(first, n)
    inner = (place > 0) & (place < np.repeat(n, n) - 1)
    text[:total][inner] = c.data[(np.repeat(start, n) + place - 1)[inner]]
    gram = (text[:-2] << 16 | text[1:-1] << 8 | text[2:]) * np.uint32(2654435761) >> np.uint32(12)
    inside = place < np.repeat(n, n) - 2  # trigrams that do not run into the next word
    rows = (gram % GRAM_ROWS).astype(np.int32)[inside]
    n = n - 2
    return ((h[at] >> np.uint64(20)) % np.uint64(WORD_ROWS)).astype(np.int32), rows, n, inverse


def windows(c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and part of every window of a chunk."""
    per = np.maximum(1, -(-(c.n_words - WINDOW) // STRIDE) + 1)
    first = np.concatenate(([0], np.cumsum(per)[:-1]))
    part = np.repeat(np.arange(len(c.row)), per)
    offset = (np.arange(int(per.sum())) - first[part]) * STRIDE
    size = np.clip(c.n_words[part] - offset, 0, WINDOW)
    return c.first_word[part] + offset, size, part


def new_model(rng: np.random.Generator) -> dict[str, np.ndarray]:
    d = WORD_DIM + GRAM_DIM
    shape = {"E": (WORD_ROWS, WORD_DIM), "G": (GRAM_ROWS, GRAM_DIM), "Wx": (2, d, 3 * HIDDEN), "bx": (2, 1, 3 * HIDDEN),
             "U": (2, HIDDEN, 3 * HIDDEN), "A": (2 * HIDDEN, POOL), "ba": (POOL,), "v": (POOL,),
             "c": (2 * HIDDEN,), "d": (1,)}
    scale = {"E": 0.3, "G": 0.3, "Wx": 0.4, "U": 0.3, "A": 0.3, "v": 0.3, "c": 0.4}
    p = {k: rng.normal(0, scale.get(k, 0.0) or 1e-12, s).astype(np.float32) for k, s in shape.items()}
    p["d"] -= 2.0
    return p


def embed(p: dict, words: np.ndarray, grams: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Input vector of every distinct word."""
    if not len(words):
        return np.zeros((0, WORD_DIM + GRAM_DIM), np.float32)
    first = np.concatenate(([0], np.cumsum(n)[:-1]))
    g = np.add.reduceat(p["G"][grams], first) / np.sqrt(n, dtype=np.float32)[:, None]
    return np.concatenate([p["E"][words], g], 1)


def forward(p: dict, xw: np.ndarray, idx: np.ndarray, mask: np.ndarray, keep: bool = False) -> dict:
    """``xw`` (2, distinct words, 3 * HIDDEN): input projections; ``idx``
    (WINDOW, windows): distinct word at each place; ``mask`` likewise."""
    t_max, b = idx.shape
    h = np.zeros((2, b, HIDDEN), np.float32)
    states = np.zeros((2, t_max, b, HIDDEN), np.float32)
    tape = []
    places = (np.arange(t_max), np.arange(t_max)[::-1])
    for s in range(t_max):
        t0, t1 = places[0][s], places[1][s]
        m = np.stack([mask[t0], mask[t1]])[:, :, None]
        x = np.stack([xw[0][idx[t0]], xw[1][idx[t1]]])
        u = np.matmul(h, p["U"])
        zr = 1.0 / (1.0 + np.exp(-(x[..., :2 * HIDDEN] + u[..., :2 * HIDDEN])))
        z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
        n = np.tanh(x[..., 2 * HIDDEN:] + r * u[..., 2 * HIDDEN:])
        if keep:
            tape.append((h, z, r, n, u[..., 2 * HIDDEN:], m))
        h = h + m * (1 - z) * (n - h)
        states[0, t0], states[1, t1] = h[0], h[1]
    both = np.concatenate([states[0], states[1]], -1)
    k = np.tanh(both @ p["A"] + p["ba"])
    e = np.where(mask, np.exp(k @ p["v"]), 0)
    w = e / np.maximum(e.sum(0), 1e-9)
    pooled = (w[..., None] * both).sum(0)
    return {"logit": pooled @ p["c"] + p["d"], "tape": tape, "both": both, "k": k, "w": w, "pooled": pooled}


def backward(p: dict, f: dict, dlogit: np.ndarray, idx: np.ndarray, n_distinct: int) -> tuple[dict, np.ndarray]:
    """Gradients of the arrays, and of the input projections."""
    t_max, b = idx.shape
    g = {"c": f["pooled"].T @ dlogit, "d": dlogit.sum(keepdims=True)}
    dp = dlogit[:, None] * p["c"]
    dw = (f["both"] * dp).sum(-1)
    de = f["w"] * (dw - (f["w"] * dw).sum(0))
    dk = de[..., None] * p["v"] * (1 - f["k"] ** 2)
    g["v"] = np.einsum("tbk,tb->k", f["k"], de)
    g["A"], g["ba"] = np.einsum("tbi,tbk->ik", f["both"], dk), dk.sum((0, 1))
    dboth = f["w"][..., None] * dp + dk @ p["A"].T
    dxw = np.zeros((2, n_distinct, 3 * HIDDEN), np.float32)
    g["U"] = np.zeros_like(p["U"])
    dh = np.zeros((2, b, HIDDEN), np.float32)
    for s in range(t_max - 1, -1, -1):
        t0, t1 = s, t_max - 1 - s
        h, z, r, n, un, m = f["tape"][s]
        dh = dh + np.stack([dboth[t0, :, :HIDDEN], dboth[t1, :, HIDDEN:]])
        dn = dh * m * (1 - z) * (1 - n ** 2)
        dz = -dh * m * (n - h) * z * (1 - z)
        dr = dn * un * r * (1 - r)
        dx = np.concatenate([dz, dr, dn], -1)
        du = np.concatenate([dz, dr, dn * r], -1)
        g["U"] += np.matmul(h.transpose(0, 2, 1), du)
        np.add.at(dxw[0], idx[t0], dx[0])
        np.add.at(dxw[1], idx[t1], dx[1])
        dh = dh * (1 - m * (1 - z)) + np.matmul(du, p["U"].transpose(0, 2, 1))
    return g, dxw


def _places(first: np.ndarray, size: np.ndarray, inverse: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(WINDOW)[:, None]
    mask = at < size
    if not len(inverse):
        return np.zeros(mask.shape, np.int64), mask
    return np.where(mask, inverse[np.minimum(first + at, len(inverse) - 1)], 0), mask


def chunk_logits(p: dict, c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Logit and part of every window of a chunk."""
    words, grams, n, inverse = vocabulary(c) if len(c.start) else (np.zeros(0, np.int32),) * 2 + (np.zeros(0, int),) * 2
    x = embed(p, words, grams, n)
    if not len(x):
        x = np.zeros((1, WORD_DIM + GRAM_DIM), np.float32)
    xw = np.matmul(x, p["Wx"]) + p["bx"]
    first, size, part = windows(c)
    out = np.empty(len(first))
    for k in range(0, len(first), BLOCK):
        idx, mask = _places(first[k:k + BLOCK], size[k:k + BLOCK], inverse)
        out[k:k + BLOCK] = forward(p, xw, idx, mask)["logit"]
    return out, part


def fit(texts: list[str], y: np.ndarray, epochs: int = 8, batch: int = 256, seed: int = 5) -> dict:
    """Trains on whole texts and their labels."""
    rng = np.random.default_rng(seed)
    p = new_model(rng)
    if not len(y) or y.min() == y.max():
        return p | {"c": np.zeros_like(p["c"]), "d": np.zeros_like(p["d"])}
    # all texts at once, whole: a bounded number of rows
    c, = chunks(pa.array(texts, pa.large_string()), lower=True, whole=True, size=1 << 60)
    words, grams, n, inverse = vocabulary(c)
    first, size, part = windows(c)
    gram_first = np.concatenate(([0], np.cumsum(n)[:-1]))
    doc = c.row[part]
    adam = Adam(p, 0.01)
    for epoch in range(epochs):
        if epoch < 2:  # every window with its document's label, as many of each
            good, bad = np.flatnonzero(y[doc] == 0), np.flatnonzero(y[doc] == 1)
            k = min(len(good), len(bad))
            take = np.concatenate([rng.permutation(good)[:k], rng.permutation(bad)[:k]])
        else:  # the worst window of every document; of clean ones also a random one
            x = np.matmul(embed(p, words, grams, n), p["Wx"]) + p["bx"]
            logit = np.concatenate([forward(p, x, *_places(first[k:k + BLOCK], size[k:k + BLOCK], inverse))["logit"]
                                    for k in range(0, len(first), BLOCK)])
            worst = np.lexsort((logit, doc))[np.append(np.flatnonzero(np.diff(doc)), len(doc) - 1)]
            clean = np.flatnonzero(y[doc] == 0)
            take = np.concatenate([worst, rng.permutation(clean)[:len(worst)]])
        take = rng.permutation(take)
        adam.rate = 0.01 * (1 - epoch / epochs) + 0.001
        for k in range(0, len(take), batch):
            rows = take[k:k + batch]
            idx, mask = _places(first[rows], size[rows], inverse)
            seen, local = np.unique(idx, return_inverse=True)
            local = local.reshape(idx.shape)
            spans = np.concatenate([np.arange(gram_first[s], gram_first[s] + n[s]) for s in seen])
            gr, ng = grams[spans], n[seen]
            x = embed(p, words[seen], gr, ng)
            f = forward(p, np.matmul(x, p["Wx"]) + p["bx"], local, mask, keep=True)
            dlogit = ((sigmoid(f["logit"]) - y[doc[rows]]) / len(rows)).astype(np.float32)
            g, dxw = backward(p, f, dlogit, local, len(seen))
            g["Wx"] = np.matmul(x.T, dxw)
            g["bx"] = dxw.sum(1, keepdims=True)
            dx = np.matmul(dxw, p["Wx"].transpose(0, 2, 1)).sum(0)
            g["E"] = np.zeros_like(p["E"])
            np.add.at(g["E"], words[seen], dx[:, :WORD_DIM])
            g["G"] = np.zeros_like(p["G"])
            np.add.at(g["G"], gr, np.repeat(dx[:, WORD_DIM:] / np.sqrt(ng, dtype=np.float32)[:, None], ng, 0))
            adam.step(g)
    return p


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic",
          per_class: int = 1600) -> dict:
    """Fits the model on whole labelled documents, at most ``per_class`` rows of
    each class."""
    rows = bounded(training_sample(docs, labels, label, usable, per_class), per_class)
    warn_unused(labels, label, usable, {r["label"] for r in rows})
    rows.sort(key=lambda r: (r["doc_id"], r["text"], r["label"]))
    model = fit([r["text"] for r in rows], np.array([r["label"] for r in rows], np.float32))
    # the sample has as many of each class; the logit moves to the labels' own odds
    n = {r["label"]: r["n"] for r in labels.where(usable).groupBy(F.col(label).alias("label"))
         .agg(F.count(F.lit(1)).alias("n")).where("label IN (0, 1)").collect()}
    used = [sum(r["label"] == k for r in rows) for k in (0, 1)]
    if min(used) and n.get(0) and n.get(1):
        model["d"] = model["d"] + np.float32(np.log(n[1] / n[0]) - np.log(used[1] / used[0]))
    return model


def score(docs: DataFrame, model: dict, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` with ``score`` (probability that the worst
    window is toxic) and ``predicted`` (1 if score >= 0.5)."""
    keep = tuple(k for k in keep if k not in ("score", "predicted"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = sent.value
        for b in batches:
            out = np.full(b.num_rows, -np.inf)
            for c in chunks(b.column(b.num_columns - 1), lower=True, overlap=WINDOW - 1):
                logit, part = chunk_logits(p, c)
                np.maximum.at(out, c.row[part], logit)
            out = np.round(sigmoid(out), 9)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k) for k in range(b.num_columns - 1)], pa.array(out),
                 pa.array((out >= 0.5).astype(np.int32))], names=[*keep, "score", "predicted"])

    rows = docs.select(*keep, F.coalesce("text", F.lit("")).alias("_gru_text"))
    kept = [f for f in rows.schema.fields if f.name != "_gru_text"]
    schema = type(rows.schema)(kept).add("score", "double").add("predicted", "integer")
    return rows.mapInArrow(run, schema)
