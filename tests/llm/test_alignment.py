"""Cross-tokenizer alignment, against brute force."""

from __future__ import annotations

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from furlong.llm import alignment
from tests.llm.data import awkward, awkward_rows, tuples, with_clashes

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return alignment.Tokenizers(open(A, "rb").read(), open(B, "rb").read())


def test_ranks_are_proven():
    """For this vocabulary they are; not where two ways lead to an entry."""
    ranks = alignment.proven_ranks(open(A, "rb").read())
    assert ranks is not None and len(ranks) == 50_256

    def vocabulary(*merges):
        letters = list(alignment.byte_letters())
        entries = letters + [x + y for x, y in merges]
        return json.dumps({"model": {"vocab": {e: k for k, e in enumerate(entries)}, "merges": [f"{x} {y}" for x, y in merges]}}).encode()

    assert alignment.proven_ranks(vocabulary(("a", "b"), ("ab", "c"))) is not None
    assert alignment.proven_ranks(vocabulary(("b", "c"), ("a", "b"), ("ab", "c"))) is None  # a+bc comes first


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abehinorstuéßñ ĐŁ.,'!12\n\t\x1c\x85\xa0#\"the"), min_size=1, max_size=14).filter(lambda t: t != ""), min_size=1, max_size=12))
def test_runs_are_aligned_alike_with_and_without_ranks(both, texts):
    if not hasattr(test_runs_are_aligned_alike_with_and_without_ranks, "t"):
        raw = open(A, "rb").read()
        test_runs_are_aligned_alike_with_and_without_ranks.t = alignment.Tokenizers(raw, open(B, "rb").read(), alignment.proven_ranks(raw))
    t = test_runs_are_aligned_alike_with_and_without_ranks.t
    some = sorted({r for x in texts for r in alignment.runs(x)}, key=t._is_plain, reverse=True)
    assert t._aligned(some) == both._aligned(some)


def aligned_by_brute_force(rows, t):
    """Each text tokenized whole; ends compared one by one."""
    docs, count = [], Counter()
    for doc_id, text, *_ in rows:
        groups, links = [], []
        a = t.a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = t.b.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        if text and b"".join(t.bytes_a[k] for k in a) == raw == b"".join(t.bytes_b[k] for k in b):
            ends = [[], []]
            for side, (ids, table) in enumerate(((a, t.bytes_a), (b, t.bytes_b))):
                at = 0
                for k in ids:
                    at += len(table[k])
                    ends[side].append(at)
            for end in sorted(set(ends[0]) & set(ends[1])):
                links.append((a[ends[0].index(end)], b[ends[1].index(end)]))
            cuts = [0, *sorted(set(ends[0]) & set(ends[1]))]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                groups.append("|".join(",".join(str(k) for k, e in zip(ids, es, strict=True) if lo < e <= hi)
                                       for ids, es in zip((a, b), ends, strict=True)))
        else:
            a = b = []
        count.update(links)
        docs.append((doc_id, len(a), len(b), len(groups), links, ";".join(groups)))
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return sorted(((i, na, nb, ng, len(x), sum(count[p] == most[p[1]] for p in x), sum(count[p] for p in x),
                    hashlib.sha256(g.encode()).hexdigest() if g else "") for i, na, nb, ng, x, g in docs), key=repr)


def small_rows():
    rng = random.Random(6)
    odd = ["▁", "a▁b c", " lead", "tail ", "two  spaces", "a \n b", "\n", " ", "  ", "　x　 y", "é ﬁ ｆｕｌｌ \x00 \x07", "<|endoftext|> <s> <0x41>",
           "﻿bom", "emoji \U0001f600\U0001f600 \U0001f468‍\U0001f469", "日本語 テキスト、です。", "x" * 300, "tab\tx \t y", "a\r\nb", "don't we'll 12,345.67"]
    rows = [(100 + k, t, None, None, 0) for k, t in enumerate(odd)]
    words = ["the", "of", "Tokenizer", "über", "naïve", "x", "\n", "", "123", "...", "\t", "日本", "a▁"]
    for k in range(30):
        rows.append((200 + k, " ".join(rng.choices(words, range(13, 0, -1), k=rng.randint(1, 400))), None, None, 0))
    return [r for r in awkward_rows() if r[0] not in (15, 16)] + rows


@pytest.mark.parametrize("chunk, hot, fan", [(1 << 16, 200_000, 16), (40, 200_000, 2), (200, 30, 3), (1, 1, 16)])
def test_alignment(spark, both, monkeypatch, chunk, hot, fan):
    monkeypatch.setattr(alignment, "FAN", fan)
    rows = small_rows()
    df = with_clashes(spark.createDataFrame(rows, awkward(spark).schema).repartition(3))
    got = alignment.align(df, A, B, chunk=chunk, hot=hot)
    assert got.columns == list(alignment.COLUMNS)
    assert tuples(got) == aligned_by_brute_force(rows, both)
    if chunk == 40:
        assert alignment.align(df.limit(0), A, B).count() == 0


def test_alignment_of_the_sample(spark, both):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert tuples(alignment.align(docs, A, B, chunk=3000)) == aligned_by_brute_force(rows, both)


ENDS = st.lists(st.booleans(), min_size=1, max_size=40)


@settings(max_examples=300, deadline=None)
@given(ENDS, ENDS, st.lists(st.integers(0, 41), max_size=6), st.randoms(use_true_random=False))
def test_fragments_compose_in_any_bracketing(a_ends, b_ends, cuts, rng):
    """Random tokens over one text, cut at random bytes, composed in random order."""
    n = min(len(a_ends), len(b_ends))
    ends = [np.array([k + 1 for k in range(n) if e[k] or k == n - 1]) for e in (a_ends, b_ends)]
    ids = [np.arange(len(e), dtype=np.int32) + 10 * (side + 1) for side, e in enumerate(ends)]
    whole = alignment.fragment(ids[0], ends[0], ids[1], ends[1])[0].groups()
    edges = [0, *sorted(min(c, n) for c in cuts), n]
    parts, links = [], []
    for k, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
        inside = [(e > lo) & (e <= hi) for e in ends]
        f, x, y = alignment.fragment(ids[0][inside[0]], ends[0][inside[0]], ids[1][inside[1]], ends[1][inside[1]], k)
        assert not f.body or f.first == k
        parts.append(f)
        links += zip(x.tolist(), y.tolist(), strict=True)
    while len(parts) > 1:
        k = rng.randrange(len(parts) - 1)
        parts[k:k + 2] = [parts[k].then(parts[k + 1])]
    got = parts[0].groups()
    assert [x for _, x in got] == [x for _, x in whole] and [k for k, _ in got] == sorted(k for k, _ in got)
    common = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
    assert links == [(int(ids[0][list(ends[0]).index(e)]), int(ids[1][list(ends[1]).index(e)])) for e in common]
    empty = alignment.Fragment()
    assert empty.then(parts[0]).groups() == got == parts[0].then(empty).groups()
    with pytest.raises(ValueError):
        alignment.Fragment(np.array([1], np.int32)).groups()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "a", "bc", "\n", "\t", "é", "　", ".", "12", "'s", "\x1c"]), max_size=40).map("".join), st.integers(1, 12))
def test_runs_and_ranges_tokenize_like_the_whole(both, text, size):
    assert " ".join(alignment.runs(text)) == text and " ".join(alignment.ranges(text, size)) == text
    for parts in (alignment.runs(text), list(alignment.ranges(text, size))):
        if text:
            assert [i for p in parts for i in both.b.encode(p)] == both.b.encode(text)
            assert [i for p in parts for i in both.a.encode(" " + p, add_special_tokens=False).ids] == both.a.encode(
                " " + text, add_special_tokens=False).ids
