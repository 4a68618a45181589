"""Substring dedup, Jaccard join, embedding join, components: brute force."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from furlong.llm import components as cc
from furlong.llm import embedding_join, jaccard_join, substring_dedup
from tests.llm.data import awkward, awkward_rows, components, tuples, with_clashes, words


def kept_by_brute_force(rows):
    first = {}
    for i, t, *_ in rows:
        w = words(t)
        for k in range(len(w) - 12):
            if i is not None:
                key = tuple(w[k:k + 13])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t, *_ in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - 12):
            if i is not None and first[tuple(w[k:k + 13])] < i:
                gone.update(range(k, k + 13))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [20_000, 2])
def test_substring_dedup(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)  # 2: windows dealt singly
    monkeypatch.setattr(substring_dedup, "RUN", 20)
    got = substring_dedup.deduplicated(with_clashes(awkward(spark)))
    assert got.columns.count("n_words") == 1
    assert tuples(got.select("doc_id", "n_words", "n_removed", "kept_text")) == kept_by_brute_force(awkward_rows())


def test_substring_dedup_empty(spark):
    assert substring_dedup.deduplicated(awkward(spark).limit(0)).count() == 0


def test_fm_index_counts_and_minima():
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 3, rng.integers(13, 60)).astype(np.uint64) for _ in range(40)]
    docs = rng.integers(0, 1000, 40)
    got = substring_dedup.search([t.tobytes() for t in texts], docs)
    best = {}
    for t, d in zip(texts, docs, strict=True):
        for k in range(len(t) - 12):
            best[t[k:k + 13].tobytes()] = min(best.get(t[k:k + 13].tobytes(), 10 ** 9), d)
    for t, low in zip(texts, got, strict=True):
        assert list(low) == [best[t[k:k + 13].tobytes()] for k in range(len(t) - 12)]


def test_wavelet_matrix_rank():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 37, 1000)
    m = substring_dedup.WaveletMatrix(values)
    at = rng.integers(0, 1001, 500)
    symbol = rng.integers(0, 37, 500)
    hi, lo = m.rank(symbol, at.copy(), np.zeros(500, np.int64))
    assert list(hi - lo) == [int((values[:a] == s).sum()) for a, s in zip(at, symbol, strict=True)]


def sets_of(rows, width):
    out = []
    for _, t, *_ in rows:
        w = [x.translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")) for x in words(t)]
        out.append({tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    return out


def jaccard_by_brute_force(rows, width, percent):
    sets = sets_of(rows, width)
    live = [k for k in range(len(rows)) if rows[k][0] is not None and sets[k]]
    links = [(a, b) for x, a in enumerate(live) for b in live[x + 1:]
             if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    label = components(len(rows), links)
    low = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            low[label[k]] = min(low.get(label[k], r[0]), r[0])
    return sorted(((r[0], len(sets[k]), low[label[k]] if r[0] is not None else None) for k, r in enumerate(rows)), key=repr)


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_jaccard_join(spark, width, percent):
    got = jaccard_join.near_duplicates(with_clashes(awkward(spark)), jaccard_join.Rule(width, percent))
    assert tuples(got) == jaccard_by_brute_force(awkward_rows(), width, percent)


def test_jaccard_join_of_many_near_copies(spark, monkeypatch):
    """Tokens of a large group are frequent, so combinations index it; its
    cluster is cut into tiles."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", 6)
    monkeypatch.setattr(jaccard_join, "TILE_MIN", 16)
    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(3000)]
    rows = []
    for base in range(3):
        text = [rng.choice(vocabulary) for _ in range(90 + 60 * base)]
        for _ in range(50):
            t = list(text)
            for _ in range(rng.randint(0, 5)):
                t[rng.randrange(len(t))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(t)))
    for _ in range(40):  # different texts that share a long passage
        rows.append((len(rows), " ".join(text[:40] + [rng.choice(vocabulary) for _ in range(rng.randint(5, 150))])))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = tuples(jaccard_join.near_duplicates(df, jaccard_join.Rule(3, 90)))
    assert got == jaccard_by_brute_force(rows, 3, 90)
    assert len({r[2] for r in got}) < len(rows) - 60


def test_jaccard_join_empty(spark):
    assert jaccard_join.near_duplicates(awkward(spark).limit(0)).count() == 0


def test_prefix_keys_meet():
    """Sets at the similarity bound share a key, for any tokens that are frequent."""
    rng = np.random.default_rng(8)
    for percent in (80, 90):
        rule = jaccard_join.Rule(3, percent)
        for _ in range(400):
            n = int(rng.integers(2, 200))
            tokens = np.unique(rng.integers(0, 2 ** 63 - 1, n, dtype=np.int64))
            n = len(tokens)
            lost = int(rng.integers(0, n * (100 - percent) // 100 + 1))
            other = np.delete(tokens, rng.choice(n, lost, replace=False))
            room = int(len(other) * 100 / percent - n) if rng.random() < 0.5 else 0
            other = np.unique(np.concatenate([other, rng.integers(0, 2 ** 63 - 1, max(0, room), dtype=np.int64)]))
            both = len(np.intersect1d(tokens, other))
            if 100 * both < percent * (n + len(other) - both) or np.array_equal(tokens, other):
                continue
            frequent = np.sort(rng.choice(tokens, int(n * rng.random()), replace=False))
            keys = []
            for t in (tokens, other):
                low = t[:int(np.searchsorted(t, rule.known)) + rule.may_lack(len(t)) + 1]
                single, pairs, _ = jaccard_join.prefix_keys(low, len(t), frequent, rule)
                keys.append(({("s", k) for k in single} | {("c", k) for k in pairs}))
            assert keys[0] & keys[1]


def vectors(rng):
    base = rng.normal(size=(12, 64))
    out = [list(map(float, b + rng.normal(size=64) * s)) for b in base for s in (0, 0, 0.01, 0.2, 0.45, 0.5)]
    bad = [None, [], [0.0] * 64, [None] + [1.0] * 63, [float("nan")] + [1.0] * 63, [float("inf")] + [1.0] * 63, [1.0] * 63,
           [2.0] * 63, [1e-30] * 64, [3.0] * 64]
    return out + bad


@pytest.mark.parametrize("tile", [8192, 20])
def test_embedding_join(spark, monkeypatch, tile):
    monkeypatch.setattr(embedding_join, "TILE", tile)
    data = vectors(np.random.default_rng(5))
    rows = [(k * 3 % len(data) if len(data) % 3 else k, v) for k, v in enumerate(data)] + [(500, data[3]), (500, data[3])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<double>, weight string")

    def fine(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cosine(a, b):
        a, b = np.array(a) / max(map(abs, a)), np.array(b) / max(map(abs, b))
        return a @ b / np.sqrt((a @ a) * (b @ b))

    links = [(a, b) for a in range(len(rows)) for b in range(len(rows)) if a != b and fine(rows[a][1]) and fine(rows[b][1])
             and len(rows[a][1]) == len(rows[b][1]) and cosine(rows[a][1], rows[b][1]) >= 0.9]
    label = components(len(rows), links)
    low = {}
    for k, (i, _) in enumerate(rows):
        low[label[k]] = min(low.get(label[k], i), i)
    want = sorted((i, sum(a == k for a, _ in links), low[label[k]], low[label[k]] == i) for k, (i, _) in enumerate(rows))
    got = embedding_join.near_duplicates(df)
    assert sorted(tuple(r) for r in got.select("vec_id", "n_links", "component_id", "kept").collect()) == want
    assert embedding_join.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("same", [True, False])
def test_links_of_a_tile_are_counted_as_found(same):
    """Weighted counts as by brute force, without the tile's whole product as wide numbers."""
    import tracemalloc

    rng, n = np.random.default_rng(4), 1500
    x = rng.normal(size=(n, 64))
    x[700:760] = x[:60] + rng.normal(size=(60, 64)) * 0.05
    x[760:800] = x[7] + rng.normal(size=(40, 64)) * 0.05
    y = x if same else x + rng.normal(size=(n, 64)) * rng.choice([0.1, 9.0], size=(n, 1))
    weights = rng.integers(1, 9, size=(2, n))
    sides = [pd.DataFrame({"gid": np.arange(n) + k * n, "weight": weights[k], "dim": 64, "same": same, "side": k,
                           "vec": [r.tobytes() for r in v]}) for k, v in enumerate([x] if same else [x, y])]
    cosines = embedding_join.unit(x) @ embedding_join.unit(y).T
    near = (cosines >= 0.9) & ~(np.eye(n, dtype=bool) & same)
    want = [near @ weights[0]] if same else [near @ weights[1], weights[0] @ near]
    found = Counter()
    tracemalloc.start()
    for block in range(4):  # a pair is found in one of the blocks
        links = embedding_join._compared(pd.concat(sides).assign(block=block), 0.9, np.float64)
        for a, count in links[links["n"] > 0][["a", "n"]].itertuples(index=False):
            found[a] += count
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert dict(found) == {k: c for k, c in enumerate(np.concatenate(want).tolist()) if c}
    assert peak < 6 * n * n


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(600, 700)] + [(9, 9), (700, 650)]
    edges += [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(80)]
    nodes = sorted({x for e in edges for x in e if e[0] != e[1]})
    at = {x: k for k, x in enumerate(nodes)}
    label = components(len(nodes), [(at[a], at[b]) for a, b in edges if a != b])
    got = dict(tuple(r) for r in cc.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {x: nodes[label[k]] for k, x in enumerate(nodes)}


def test_tiles_are_cut_by_tokens(spark, monkeypatch):
    """Few but large sets: a group holds two tiles of about TILE_TOKENS; every pair of sets meets."""
    monkeypatch.setattr(jaccard_join, "TILE_TOKENS", 2000)
    sets = spark.createDataFrame([(k, 7, 100, b"") for k in range(100)], "node long, cluster long, n long, tokens binary")
    groups = {}
    for r in jaccard_join._dealt(sets).collect():
        groups.setdefault(r["pair"], set()).add(r["node"])
    assert max(len(g) * 100 for g in groups.values()) < 2 * 2 * 2000  # all are 10000
    assert len({(a, b) for g in groups.values() for a in g for b in g}) == 100 * 100


def test_tile_pairs_of_a_cluster_are_dealt_anew(spark, monkeypatch):
    """Between the copies of a cluster's sets and their comparison rows are
    exchanged, also where a sort-merge join has put the cluster together."""
    from furlong.plans.inspect import final_tree

    monkeypatch.setattr(jaccard_join, "TILE_MIN", 8)
    sets = spark.createDataFrame([(k, 7, 100, b"") for k in range(100)], "node long, cluster long, n long, tokens binary")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k in before:
            spark.conf.set(k, "-1" if k.endswith("Threshold") else "false")
        pairs = jaccard_join._dealt(sets).groupBy("pair").applyInPandas(lambda pdf: pdf[["node"]], "node long")
        lines = final_tree(pairs).splitlines()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    at = {name: next(i for i, x in enumerate(lines) if name in x) for name in ("FlatMapGroupsInPandas", "Exchange", "Generate", "SortMergeJoin")}
    assert at["FlatMapGroupsInPandas"] < at["Exchange"] < at["Generate"] < at["SortMergeJoin"]


def test_staged_tables_are_discarded(spark):
    from furlong.llm import common

    with common.collecting() as made:
        one, two = common.staged(spark.range(5), "a"), common.staged(spark.range(7), "b")
        common.discard(one)
        groups = jaccard_join.near_duplicates(awkward(spark))
        n = groups.count()
    assert n == len(awkward_rows()) and two.count() == 7
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(made[0]).getFileSystem(spark._jsc.hadoopConfiguration())
    there = [p for p in made if hadoop.exists(spark._jvm.org.apache.hadoop.fs.Path(p))]
    assert made[0] not in there and made[1] in there and len(there) == 3  # two, the sketches, the last round of links
    common.remove(spark, *made, made[0])
    assert not [p for p in made if hadoop.exists(spark._jvm.org.apache.hadoop.fs.Path(p))]


def test_substring_dedup_keeps_columns_with_its_own_names(spark):
    from pyspark.sql import functions as F

    df = awkward(spark)
    for name in ("_fm_text", "_fm_id", "_fm_key", "_FM__row"):
        df = df.withColumn(name, F.lit("clash"))
    got = substring_dedup.deduplicated(df)
    assert got.columns == [*df.columns, "n_words", "n_removed", "kept_text"]
    assert tuples(got.select("doc_id", "n_words", "n_removed", "kept_text")) == kept_by_brute_force(awkward_rows())


@pytest.mark.parametrize("bits", [64, 1 << 12, 1 << 26])
def test_frequent_tokens_do_not_depend_on_the_size(spark, monkeypatch, bits):
    """Every token of FREQUENT sets or more is called frequent, whatever the bitmap;
    with one that is full all tokens are, and the join finds the same."""
    monkeypatch.setattr(jaccard_join, "BITS", bits)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 5)
    rng = np.random.default_rng(1)
    tokens = rng.integers(0, 2 ** 61, 400, dtype=np.int64)
    bitmap = jaccard_join.frequent_bitmap(spark.createDataFrame([(int(t),) for t in tokens[:300]], "t bigint"), bits)
    assert bitmap.nbytes == max(8, bits // 8) and jaccard_join.called_frequent(bitmap, tokens[:300], bits).all()
    others = jaccard_join.called_frequent(bitmap, tokens[300:], bits).mean()
    assert others > 0.99 if bits == 64 else others < 0.2
    empty = jaccard_join.frequent_bitmap(spark.createDataFrame([], "t bigint"), bits)
    assert not jaccard_join.called_frequent(empty, tokens, bits).any()
    rows = awkward_rows()
    vocabulary = [f"w{k}" for k in range(200)]
    base = [str(rng.choice(vocabulary)) for _ in range(120)]
    for k in range(40):
        t = list(base)
        t[int(rng.integers(120))] = f"x{k}"
        rows.append((1000 + k, " ".join(t), None, None, 0))
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, awkward(spark).schema), jaccard_join.Rule(3, 90))
    assert tuples(got) == jaccard_by_brute_force(rows, 3, 90)
