"""Quality rules, mixing, the two classifiers, the pipeline."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from furlong.llm import mixing, quality_classifier, quality_rules, toxicity
from furlong.llm.common import read
from furlong.llm.flat_text import chunks, word_hashes
from furlong.llm.labels import fold
from tests.llm.data import awkward, awkward_rows, tuples, with_clashes, words
from tests.llm.test_dedup_operators import jaccard_by_brute_force, kept_by_brute_force

SF = "/root/testdata/sf0.01"


def counts(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    found = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    covered = {k + j for k in range(len(w) - 7) if found[tuple(w[k:k + 8])] > 1 for j in range(8)}
    return (len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered))


def test_quality_rule_counts(spark):
    got = quality_rules.judge(with_clashes(awkward(spark)))
    want = [(r[0], *counts(r[1])) for r in awkward_rows()]
    want = [(*x, x[1] < 20 or 100 * x[5] > 30 * x[1]) for x in want]
    assert tuples(got.select("doc_id", *quality_rules.COUNTS, "base_failed")) == sorted(want, key=repr)
    assert got.where("base_failed AND kept").count() == 0
    assert quality_rules.judge(awkward(spark).limit(0)).count() == 0


def test_quality_rules_against_labels(spark):
    got = quality_rules.judge(read(spark, SF, "documents")).join(read(spark, SF, "labels"), "doc_id").where("NOT base_failed")
    r = got.agg(F.avg(F.when(F.col("quality") == 1, F.col("kept").cast("int"))).alias("good"),
                F.avg(F.when(F.col("quality") == 0, F.col("kept").cast("int"))).alias("bad")).first()
    assert r["good"] > 0.98 and r["bad"] < 0.15


def test_em_recovers_accuracies(spark):
    """Votes drawn from known accuracies: the posterior finds the classes."""
    rng = np.random.default_rng(1)
    names = ["a", "b", "c", "d"]
    good = rng.random(4000) < 0.85
    rows = []
    for g in good:
        rows.append([0 if rng.random() < 0.1 else (1 if rng.random() < 0.99 else -1) if g
                     else (-1 if rng.random() < 0.7 else 1) for _ in names])
    df = spark.createDataFrame([(bool(g), *v) for g, v in zip(good, rows, strict=True)],
                               "good boolean, " + ", ".join(f"_v_{n} int" for n in names))
    model = quality_rules.fit(df, names)
    right = df.withColumn("p", quality_rules._posterior(model, names)).where((F.col("p") >= 0.5) == F.col("good")).count()
    assert right > 0.97 * len(good)
    assert all(model["log_ratio"][n, -1] < -2 for n in names)


def test_mixing(spark):
    rows = awkward_rows()
    got = [r.asDict() for r in mixing.mix(with_clashes(awkward(spark))).collect()]
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len(words(t))
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:  # reshare the excess until no target is above
        left = total - sum(3 * sizes[s] for s in capped)
        share = {s: 3 * sizes[s] if s in capped else left * weight[s] / sum(weight[x] for x in names if x not in capped)
                 for s in names}
        over = {s for s in names if s not in capped and share[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    taken = Counter()
    for r in got:
        assert r["target"] == pytest.approx(share[r["source"]])
        assert r["source_size"] == sizes[r["source"]] and r["taken"] == r["epochs"] * r["size"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in names:
        longest = max(len(words(t)) for _, t, _, x, _ in rows if x == s)
        assert abs(taken[s] - share[s]) <= longest / 2 + 1e-6
        whole = {r["epochs"] for r in got if r["source"] == s and r["size"]}
        assert max(whole) - min(whole) <= 1
    again = mixing.mix(awkward(spark).repartition(5, "text"))
    assert Counter((r["doc_id"], r["taken"]) for r in got) == Counter((r["doc_id"], r["taken"]) for r in again.collect())
    mixed = mixing.mixed_documents(with_clashes(awkward(spark)))
    assert mixed.columns == with_clashes(awkward(spark)).columns
    assert mixed.count() == sum(r["epochs"] for r in got)
    assert mixing.mix(awkward(spark).limit(0)).count() == 0


def test_mixing_prefers_quality(spark):
    df = spark.createDataFrame([(k, "word " * 10 + ("#" * 30 if k % 2 else ""), f"s{k % 3}") for k in range(3000)],
                               "doc_id bigint, text string, source string")
    got = mixing.mix(df).where("target < source_size").groupBy((F.col("doc_id") % 2).alias("bad")).agg(
        F.sum("epochs").alias("n")).collect()
    n = {r["bad"]: r["n"] for r in got}
    assert n[0] > 2 * n[1]


def test_flat_text_chunks():
    texts = ["one two", "", None, "  lead", "tail  ", "x" * 50, " ".join(f"w{k}" for k in range(200))]
    for size in (16, 64, 1 << 20):
        seen = {}
        for c in chunks(pa.array(texts), size=size):
            h = word_hashes(c)
            for k in range(len(c.start)):
                row = int(c.row[c.word_part[k]])
                seen.setdefault(row, []).append((bytes(c.data[c.start[k]:c.end[k]]), int(h[k])))
        assert [[w for w, _ in seen.get(r, [])] for r in range(len(texts))] == [words(t) for t in texts]
        by = {}
        for row in seen.values():
            for w, h in row:
                assert by.setdefault(w, h) == h
        assert len(set(by.values())) == len(by)


def test_toxicity_windows_cover_every_passage():
    """A passage of up to half a window lies whole in a window, also across a cut."""
    texts = [" ".join(f"w{k}" for k in range(n)) for n in (0, 1, 31, 32, 33, 300)] + ["  a " + "b" * 90 + "  c" * 200, None]
    for size in (1, 64, 300, 1 << 20):
        seen = {}
        for c in chunks(pa.array(texts), size=size, overlap=toxicity.WINDOW - 1):
            assert len(set(c.row.tolist())) == len(c.row)
            for first, n, part in zip(*toxicity.windows(c), strict=True):
                row = texts[c.row[part]].split() if texts[c.row[part]] else []
                got = [c.data[c.start[k]:c.end[k]].tobytes().decode() for k in range(first, first + n)]
                seen.setdefault(int(c.row[part]), set()).add(tuple(got))
                assert not got or " ".join(got) in " ".join(row)
        for r, t in enumerate(texts):
            w, half = (t or "").split(), toxicity.WINDOW // 2
            inside = {x[k:k + half] for x in seen[r] for k in range(max(1, len(x) - half + 1))}
            assert all(tuple(w[k:k + half]) in inside for k in range(max(1, len(w) - half + 1)))


@pytest.mark.parametrize("module, label, folds, test", [(quality_classifier, "quality", 3, 1), (toxicity, "toxic", 5, 0)])
def test_classifier_on_held_out_documents(spark, module, label, folds, test):
    docs, labels = read(spark, "/root/testdata/sf0.1", "documents"), read(spark, "/root/testdata/sf0.1", "labels")
    held = fold("doc_id", folds) == test
    model = module.train(docs, labels, ~held)
    got = module.score(docs.join(labels.where(held), "doc_id"), model, keep=("doc_id", label))
    r = got.agg(F.avg(F.when(F.col(label) == 1, F.col("predicted"))).alias("found"),
                F.avg(F.when(F.col(label) == 0, F.col("predicted"))).alias("false")).first()
    assert r["found"] > 0.85 and r["false"] < (0.1 if label == "quality" else 0.02)
    odd = module.score(with_clashes(awkward(spark)), model).collect()
    assert len(odd) == len(awkward_rows()) and all(0 <= x["score"] <= 1 for x in odd)
    assert all(x["predicted"] == (x["score"] >= 0.5) for x in odd)
    by = {}
    for (i, t, *_), x in zip(sorted(awkward_rows(), key=repr), sorted(odd, key=repr), strict=True):
        by.setdefault((i, t), set())
    assert module.score(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("module", [quality_classifier, toxicity])
def test_classifier_without_labels(spark, module):
    docs = awkward(spark)
    none = spark.createDataFrame([(1, None, None), (None, 1, 1), (7, 1, 1)], "doc_id bigint, quality int, toxic int")
    model = module.train(docs, none, F.lit(True))
    assert {(r["score"], r["predicted"]) for r in module.score(docs, model).collect()} == {(0.5, 1)}


def test_long_text_scores_alike_beside_other_rows(spark):
    """All parts of a text over 1 MiB count, whatever rows share its chunks."""
    rng = np.random.default_rng(0)
    shape = {"W": (quality_classifier.FEATURES, 24), "b": (24,), "V": (24, 12), "bv": (12,), "U": (24, 12), "bu": (12,),
             "a": (12,), "c": (24,), "d": (1,)}
    model = {k: rng.normal(size=s) for k, s in shape.items()}
    plain, loud = "some plain words of text ", "WHY?! #### 0000 !!!! "
    long = plain * (900_000 // len(plain)) + loud * (700_000 // len(loud))
    exact = "x" * (1 << 20) + " " + loud * 9  # its first part ends a chunk that an empty row begins

    def scores(rows):
        df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
        return {r["doc_id"]: r["score"] for r in quality_classifier.score(df, model).collect()}

    for text in (long, exact):
        alone = scores([(1, text)])[1]
        for rows in ([(1, text), (2, "short")], [(0, ""), (1, text)], [(0, "a b"), (1, text), (2, ""), (3, plain)]):
            assert scores(rows)[1] == alone
    assert scores([(1, long)])[1] != scores([(1, long[1 << 20:])])[1]


@pytest.mark.parametrize("module, label", [(quality_classifier, "quality"), (toxicity, "toxic")])
def test_classifier_learns_from_long_documents(spark, module, label):
    """Very long labelled documents are learnt from whole."""
    rng = np.random.default_rng(3)
    common, marked = [f"word{k}" for k in range(60)], ["#idiot!!", "#scum!!"]
    rows, known = [], []
    for k in range(48):
        w = rng.choice(common, 20_000)
        if k % 2:
            w[rng.random(len(w)) < 0.15] = marked[k % 4 // 2]
        rows.append((k, " ".join(w)))
        known.append((k, k % 2))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame(known, f"doc_id bigint, {label} int")
    got = module.score(docs, module.train(docs, labels, F.col("doc_id") < 40)).where("doc_id >= 40").collect()
    assert {r["doc_id"]: r["predicted"] for r in got} == {k: k % 2 for k in range(40, 48)}
    with pytest.warns(UserWarning, match=f"{label} = 1"):
        module.train(docs.where("doc_id % 2 = 0"), labels, F.lit(True))


@pytest.mark.parametrize("module, label", [(quality_classifier, "quality"), (toxicity, "toxic")])
def test_training_rows_are_bounded(spark, monkeypatch, module, label):
    """One id that thousands of rows have gives no more than the bound."""
    docs = spark.createDataFrame([(1, f"some idiot words {k}") for k in range(3000)] + [(2, "good words " * 9)] * 50 + [(3, "x")],
                                 "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1)] * 20 + [(2, 0), (3, 0), (3, None)], f"doc_id bigint, {label} int")
    seen = []
    monkeypatch.setattr(module, "fit", lambda rows, y: seen.append(y) or {"d": np.zeros(1)})
    module.train(docs, labels, F.lit(True), per_class=5)
    assert np.bincount(seen[0].astype(int)).tolist() == [5, 5]


def test_toxicity_finds_what_the_words_tell(spark):
    """Held-out documents with words that only toxic documents of the other folds
    have are found; a part of the labels has no such evidence (noise)."""
    docs, labels = read(spark, "/root/testdata/sf0.1", "documents"), read(spark, "/root/testdata/sf0.1", "labels")
    held = fold("doc_id", 5) == 0
    rows = docs.join(labels.where("toxic IS NOT NULL"), "doc_id").select("doc_id", "text", "toxic", held.alias("held")).collect()
    found = [set(re.findall(r"[^\W\d_]+", (r["text"] or "").lower())) for r in rows]
    toxic, clean = Counter(), Counter()
    for r, w in zip(rows, found, strict=True):
        if not r["held"]:
            (toxic if r["toxic"] else clean).update(w)
    telling = {w for w, n in toxic.items() if n >= 30 and not clean[w]}  # ten words
    model = toxicity.train(docs, labels, ~held)
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs.join(labels.where(held), "doc_id"), model).collect()}
    told = [got[r["doc_id"]] for r, w in zip(rows, found, strict=True) if r["held"] and r["toxic"] == 1 and w & telling]
    assert len(told) > 45 and np.mean(told) >= 0.98


def test_toxicity_gradients():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in toxicity.new_model(rng).items()}
    xw = rng.normal(size=(2, 7, 3 * toxicity.HIDDEN))
    idx = rng.integers(0, 7, (toxicity.WINDOW, 3))
    mask = np.arange(toxicity.WINDOW)[:, None] < np.array([32, 5, 17])
    go = rng.normal(size=3)
    g, dxw = toxicity.backward(p, toxicity.forward(p, xw, idx, mask, keep=True), go, idx, 7)

    def loss():
        return float(toxicity.forward(p, xw, idx, mask)["logit"] @ go)

    for array, grad in [(p["U"], g["U"]), (p["A"], g["A"]), (p["v"], g["v"]), (p["c"], g["c"]), (xw, dxw)]:
        for _ in range(5):
            at = tuple(int(rng.integers(0, n)) for n in array.shape)
            old, step = array[at], 1e-3
            array[at] = old + step
            up = loss()
            array[at] = old - step
            down = loss()
            array[at] = old
            assert (up - down) / (2 * step) == pytest.approx(float(grad[at]), rel=0.02, abs=2e-4)


def test_multiple_instance_gradients():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(9, quality_classifier.FEATURES)) * 0.3
    at, y = np.array([0, 4, 5]), np.array([1.0, 0.0, 1.0])
    shape = {"W": (quality_classifier.FEATURES, 24), "b": (24,), "V": (24, 12), "bv": (12,), "U": (24, 12), "bu": (12,),
             "a": (12,), "c": (24,), "d": (1,)}
    p = {k: rng.normal(size=s) * 0.3 for k, s in shape.items()}
    g = quality_classifier._grads(x, at, y, p)

    def loss():
        s = quality_classifier._bag(x, at, p)["score"]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s)) + 0.5e-4 * sum((p[k] ** 2).sum() for k in "WVUc")

    for k in shape:
        spot = tuple(int(rng.integers(0, n)) for n in shape[k])
        old = p[k][spot]
        p[k][spot] = old + 1e-5
        up = loss()
        p[k][spot] = old - 1e-5
        down = loss()
        p[k][spot] = old
        assert (up - down) / 2e-5 == pytest.approx(float(np.asarray(g[k])[spot]), rel=1e-3, abs=1e-7)


def test_pipeline_stages(spark):
    """Each stage against a brute-force version, on its own input."""
    sf = "/root/testdata/sf0.001"
    docs = read(spark, sf, "documents")
    names = list(corpus_pipeline.COLUMNS)
    rows = lambda df: [tuple(r) for r in df.select(*names).collect()]
    stages = dict(corpus_pipeline.STAGES)
    held = rows(docs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, spark.createDataFrame(held, docs.schema), sf)
        assert out.columns == names
        got = rows(out)
        if name == "quality classifier":
            bad = {r["doc_id"] for r in read(spark, sf, "labels").where("quality = 0").collect()}
            good = {r["doc_id"] for r in read(spark, sf, "labels").where("quality = 1").collect()}
            left = {r[0] for r in got}
            assert set(got) <= set(held) and len(good & left) > 0.9 * len(good)
            assert len(bad & left) < 0.5 * max(1, len(bad & {r[0] for r in held})) + 1
        elif name == "n-gram Jaccard join":
            group = {i: c for i, _, c in jaccard_by_brute_force(held, 5, 80)}
            assert sorted(got) == sorted(r for r in held if group[r[0]] == r[0])
        elif name == "substring dedup":
            want = {}
            for (i, n, gone, kept) in kept_by_brute_force(held):
                want[i] = (n, gone, kept)
            expect = [r if not want[r[0]][1] else (r[0], want[r[0]][2], *r[2:4], len(want[r[0]][2])) for r in held
                      if not want[r[0]][1] or want[r[0]][1] < want[r[0]][0]]
            assert sorted(got, key=repr) == sorted(expect, key=repr)
        else:
            epochs = {r["doc_id"]: r["epochs"] for r in mixing.mix(spark.createDataFrame(held, docs.schema)).collect()}
            assert Counter(got) == Counter({r: epochs[r[0]] for r in held if epochs[r[0]]})
        held = got
    out = stages["byte-level BPE encoding and decoding"](spark, spark.createDataFrame(held, docs.schema), sf).collect()
    assert sorted((r["doc_id"], r["decoded_sha256"]) for r in out) == sorted(
        (r[0], hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in held)
    assert all(len(r["ids"]) == r["n_tokens"] for r in out)


def test_mixing_of_rows_without_ids_and_of_equal_rows(spark):
    """Rows without an id are a random order of their own; where a cut falls
    between equal rows, exactly the selected number of them is taken."""
    nameless = spark.createDataFrame([(None, f"w{k} " * 5, "a") for k in range(300)], "doc_id bigint, text string, source string")
    assert nameless.select(mixing.uniform(7)).distinct().count() == 300
    rows = [(1, "x " * 10, "a", k) for k in range(40)] + [(2, "y " * 10, "b", k) for k in range(20)] + [
        (3, "z " * 10, "c", k) for k in range(20)] + [(4, " ", "a", 0), (None, None, "c", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, no int").repartition(7)
    epochs = Counter()
    for r in mixing.mix(df).collect():
        epochs[r["doc_id"]] += r["epochs"]
    got = mixing.mixed_documents(df).collect()
    assert Counter(r["doc_id"] for r in got) == +epochs
    per_row = Counter((r["doc_id"], r["no"]) for r in got if r["doc_id"] and r["doc_id"] < 4)
    for i in (1, 2, 3):  # one extra pass for some of the equal rows at most
        n = [per_row[i, k] for k in range(40 if i == 1 else 20)]
        assert max(n) - min(n) <= 1
    assert any(len({per_row[i, k] for k in range(20)}) == 2 for i in (1, 2, 3))  # a cut lies between equal rows


def test_mixed_documents_do_not_shuffle_texts(spark):
    from furlong.plans.inspect import final_tree

    df = awkward(spark)
    tree = final_tree(mixing.mixed_documents(df))
    assert "BroadcastHashJoin" in tree and "Exchange hash" not in tree and "SortMergeJoin" not in tree
