"""The models' scores against slow plain versions: EM row by row, the recurrent
network word by word, the passage features byte by byte."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from furlong.llm import quality_classifier, quality_rules, toxicity
from furlong.llm.common import read
from furlong.llm.flat_text import chunks
from tests.llm.data import awkward_rows

SF = "/root/testdata/sf0.01"
TEXTS = [t for _, t, *_ in awkward_rows() if t is None or len(t) < 3000] + ["WHY?! #1 (two) " * 60, "é" * 300, " x\n\ny  z"]


def plain_em(votes: list[dict], steps: int = 30, prior: float = 0.05, tolerance: float = 1e-4) -> list[float]:
    """P(good) of every row: the published steps of EM, over rows instead of the
    table of vote patterns."""
    names = list(votes[0])
    w = [0.01 if min(v.values()) < 0 else 0.99 for v in votes]
    last = {(r, x): 0.0 for r in names for x in (-1, 1)}
    for _ in range(steps):
        k, ratio = prior * len(votes) + 1.0, {}
        for r in names:
            good = {x: sum(p for v, p in zip(votes, w, strict=True) if v[r] == x) + k * (0.002 if x < 0 else 0.998) for x in (-1, 1)}
            bad = {x: sum(1 - p for v, p in zip(votes, w, strict=True) if v[r] == x) + k * (0.3 if x < 0 else 0.7) for x in (-1, 1)}
            for x in (-1, 1):
                value = math.log(good[x] / sum(good.values())) - math.log(bad[x] / sum(bad.values()))
                ratio[r, x] = max(value, 0.0) if x > 0 else min(value, 0.0)
        odds = math.log((sum(w) + 1.0) / (len(w) - sum(w) + 1.0))
        w = [1 / (1 + math.exp(-(odds + sum(ratio[r, x] for r, x in v.items() if x)))) for v in votes]
        moved = max(abs(ratio[x] - last[x]) for x in ratio)
        last = ratio
        if moved < tolerance:
            break
    return w


def test_posterior_against_plain_em(spark):
    docs = read(spark, SF, "documents")
    table = quality_rules.rules()
    counted = quality_rules.with_counts(docs).select("doc_id", "base_failed", *[v.cast("int").alias(r) for r, v in table.items()]).collect()
    passed = [r for r in counted if not r["base_failed"]]
    want = dict(zip([r["doc_id"] for r in passed], plain_em([{k: r[k] for k in table} for r in passed]), strict=True))
    got = {r["doc_id"]: r for r in quality_rules.judge(docs).select("doc_id", "posterior", "kept").collect()}
    assert len(want) > 500 and len(got) == len(counted)
    for i, r in got.items():
        assert r["posterior"] == pytest.approx(want.get(i, 0.0), abs=1e-9) and r["kept"] == (want.get(i, 0.0) >= 0.5)


def test_toxicity_against_a_plain_network():
    p = toxicity.new_model(np.random.default_rng(3))
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    h0 = np.zeros(toxicity.HIDDEN)
    for text in TEXTS:
        for c in chunks(pa.array([text], pa.string()), lower=True, overlap=toxicity.WINDOW - 1):
            logits, _ = toxicity.chunk_logits(p, c)
            words, grams, n, inverse = toxicity.vocabulary(c) if len(c.start) else ([], [], [], [])
            first_gram = np.concatenate(([0], np.cumsum(n)))[:-1].astype(int)
            vector = [np.concatenate([p["E"][words[k]], sum(p["G"][g] for g in grams[first_gram[k]:first_gram[k] + n[k]]) / math.sqrt(n[k])])
                      for k in range(len(words))]
            for logit, first, size in zip(logits, *toxicity.windows(c)[:2], strict=True):
                x = [vector[inverse[k]] for k in range(first, first + size)]
                states = []
                for d in (0, 1):
                    h, out = h0, []
                    for v in x if d == 0 else x[::-1]:
                        i, u = v @ p["Wx"][d] + p["bx"][d][0], h @ p["U"][d]
                        z, r = sigmoid(i[:8] + u[:8]), sigmoid(i[8:16] + u[8:16])
                        h = z * h + (1 - z) * np.tanh(i[16:] + r * u[16:])
                        out.append(h)
                    states.append(out if d == 0 else out[::-1])
                both = [np.concatenate(s) for s in zip(*states, strict=True)]
                e = [math.exp(np.tanh(s @ p["A"] + p["ba"]) @ p["v"]) for s in both]
                pooled = sum(a * s for a, s in zip(e, both, strict=True)) / sum(e) if both else np.zeros(2 * toxicity.HIDDEN)
                assert logit == pytest.approx(float(pooled @ p["c"] + p["d"][0]), abs=2e-4)


def plain_passages(text: bytes) -> list[np.ndarray]:
    """Features of the passages of one text, counted one by one."""
    q, space = quality_classifier, b" \t\n\x0b\x0c\r"
    starts = [k for k in range(len(text)) if text[k] not in space and (k == 0 or text[k - 1] in space)]
    words = text.split()
    out = []
    for at in range(0, max(1, len(words)), q.PASSAGE):
        own = words[at:at + q.PASSAGE]
        lo = starts[at] if at else 0
        hi = starts[at + q.PASSAGE] if at + q.PASSAGE < len(words) else len(text)
        pairs, kinds = np.zeros(q.PAIRS), np.zeros(q.CLASSES)
        for k in range(lo, hi):
            kinds[q._KIND[text[k]]] += 1
            if k + 1 < len(text):
                pairs[q._PAIR[text[k] << 8 | text[k + 1]]] += 1
        n, size = max(len(own), 1), max(hi - lo, 1)
        near = [sum(own[i] == own[i - k] for i in range(k, len(own))) for k in (1, 2)] if len(words) > 2 else [0, 0]
        out.append(np.concatenate([np.sqrt(pairs / size), np.sqrt(kinds / size), [
            near[0] / n, near[1] / n, len(set(own)) / n, math.log1p(len(own)) / 4, (hi - lo) / n / 8]]))
    return out


def test_passages_against_plain_counting():
    for text in TEXTS:
        for c in chunks(pa.array([text], pa.string())):
            got, part = quality_classifier.passages(c)
            want = plain_passages((text or "").encode())
            assert len(got) == len(want) == len(part)
            np.testing.assert_allclose(got, np.array(want), rtol=1e-5, atol=1e-6)


def test_attention_against_a_plain_network():
    rng = np.random.default_rng(5)
    q = quality_classifier
    shape = {"W": (q.FEATURES, q.HIDDEN), "b": (q.HIDDEN,), "V": (q.HIDDEN, q.GATE), "bv": (q.GATE,), "U": (q.HIDDEN, q.GATE),
             "bu": (q.GATE,), "a": (q.GATE,), "c": (q.HIDDEN,), "d": (1,)}
    p = {k: rng.normal(size=s) for k, s in shape.items()}
    bags = [np.array(plain_passages((t or "").encode())) for t in TEXTS]
    got = q._bag(np.concatenate(bags), np.concatenate(([0], np.cumsum([len(b) for b in bags])[:-1])), p)["score"]
    for bag, score in zip(bags, got, strict=True):
        hidden = [np.tanh(x @ p["W"] + p["b"]) for x in bag]
        weight = [math.exp(sum(np.tanh(h @ p["V"] + p["bv"]) / (1 + np.exp(-(h @ p["U"] + p["bu"]))) * p["a"])) for h in hidden]
        z = sum(w * h for w, h in zip(weight, hidden, strict=True)) / sum(weight)
        assert score == pytest.approx(1 / (1 + math.exp(-(z @ p["c"] + p["d"][0]))), rel=1e-6)


def test_quality_rules_held_against_labels(spark):
    """The figures that README gives for the native rules."""
    got = quality_rules.judge(read(spark, SF, "documents")).join(read(spark, SF, "labels").where("quality IS NOT NULL"), "doc_id")
    r = got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    assert {x["quality"]: x["kept"] > 0.9 for x in r} == {0: False, 1: True}
