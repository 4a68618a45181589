"""Packing and the source divergence audit, against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from furlong.llm import divergence, packing
from tests.llm.data import awkward, awkward_rows, tuples, with_clashes

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


def checked_sequences(rows, want: Counter, window: int) -> list[int]:
    """Every document's ids lie once in the pieces; sequences are gapless and fit.
    Returns the lengths of the sequences.  ``want``: (doc_id, ids) -> rows."""
    sequences, per_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        per_doc[r["doc_id"], r["doc_tokens"]].append((r["start"], r["length"], r["ids_crc32"]))
    filled = []
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at and length > 0
            at += length
        assert at <= window
        filled.append(at)
    expect = defaultdict(Counter)
    for (doc_id, ids), n in want.items():
        x = np.array(ids, "<u4")
        for k in range(0, len(x), window):
            part = x[k:k + window]
            expect[doc_id, len(x)][k, len(part), zlib.crc32(part.tobytes())] += n
    assert {k: Counter(v) for k, v in per_doc.items()} == expect
    return filled


@pytest.mark.parametrize("window, group, loose", [(4096, 10_000, 128), (64, 3, 4)])
def test_packing(spark, tokenizer, window, group, loose):
    df = with_clashes(awkward(spark))
    got = packing.pack(df, WORDS, window=window, group=group, loose=loose).collect()
    want = Counter((i, (*tokenizer.encode(t or "", add_special_tokens=False).ids, 2)) for i, t, *_ in awkward_rows())
    checked_sequences(got, want, window)
    assert packing.pack(df.limit(0), WORDS).count() == 0


def test_packing_pads_little(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    filled = Counter()
    for r in packing.pack(docs, WORDS).collect():
        filled[r["sequence_id"]] += r["length"]
    padding = sum(4096 - n for n in filled.values() if n & (n - 1))
    assert padding < 0.005 * sum(filled.values())


def test_texts_are_tokenized_in_parts(tokenizer):
    definition = open(WORDS, "rb").read()
    tokens = packing.Tokens(definition)
    texts = ["It's  A test\u3000of ﬁ e\u0301 ΑΣ Σ", "x" * 500 + " y", "a\x1cb\x85c\n\nd", "<|endoftext|> a<|startoftext|>b", " \t ", "don't" * 40,
             "word " * 300, "é" * 90 + " " + "é" * 90, "THE The the ÉCOLE École", "H\u0331 h\u0331 T\u0308 J\u030c W\u030a I\u0307 İ K\u0301 A\u030a", "Ⅷ Ｆ Σ"]
    for text in texts:
        for part in (1, 7, 64, 1 << 20):
            got = [int(x) for p in tokens.parts(text.encode(), part) for x in p]
            assert got == tokenizer.encode(text, add_special_tokens=False).ids
    many = [*texts, "", "long " * 300_000, *texts, "w " * 600_000]
    for text, ids in zip(many, tokens.of_texts(t.encode() for t in many), strict=True):
        assert np.concatenate([np.zeros(0, int), *ids]).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_words_beyond_the_kept_ones(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "KNOWN", 5)
    tokens = packing.Tokens(open(WORDS, "rb").read())
    for k in range(30):
        text = f"w{k} w{k + 1} same w{k * 7} " + "long" * 30
        assert [int(x) for p in tokens.parts(text.encode()) for x in p] == tokenizer.encode(text, add_special_tokens=False).ids
        assert len(tokens.known.now) + len(tokens.known.before) <= 20


def test_a_word_goes_to_the_library_once(tokenizer, monkeypatch):
    tokens = packing.Tokens(open(WORDS, "rb").read())
    asked = []
    library = tokens._ids
    monkeypatch.setattr(tokens, "_ids", lambda texts: asked.extend(w for t in texts for w in t.split()) or library(texts))
    rng = random.Random(3)
    texts = [" ".join(f"word{rng.randrange(400)}" for _ in range(300)) for _ in range(6)]
    for text in texts:  # a call each, as for texts of several batches
        got = [int(x) for ids in tokens.of_texts([text.encode()]) for p in ids for x in p]
        assert got == tokenizer.encode(text, add_special_tokens=False).ids
    assert max(Counter(asked).values()) == 1 and set(asked) == {w for t in texts for w in t.split()}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "Z", "é", "ß", "İ", "ﬁ", "e\u0301", "1", "23", ".", "!!", "'s", "'", "<", "|", "_", "^", "`", "~", "×", "日", "{", "\\",
                                          "word", "Σ", "\x1c", "\u3000", "\x00"]), min_size=1, max_size=6).map("".join), min_size=1, max_size=30))
def test_plain_words_tokenize_together_like_alone(tokenizer, words):
    if not hasattr(test_plain_words_tokenize_together_like_alone, "tokens"):
        test_plain_words_tokenize_together_like_alone.tokens = packing.Tokens(open(WORDS, "rb").read())
    tokens = test_plain_words_tokenize_together_like_alone.tokens
    plain = [w for w in words if packing._PLAIN.fullmatch(w)]
    if plain:
        assert [np.frombuffer(x, np.uint32).tolist() for x in tokens._plain(plain)] == [tokenizer.encode(w, add_special_tokens=False).ids for w in plain]
    tokens.known = packing.Recent(10)
    text = " ".join(words)
    assert [int(x) for p in tokens.parts(text.encode()) for x in p] == tokenizer.encode(text, add_special_tokens=False).ids


def tightest(rooms: dict[int, int], length: int) -> int | None:
    return min((r for r, n in rooms.items() if n and r >= length), default=None)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 70), st.lists(st.tuples(st.booleans(), st.integers(0, 70)), max_size=60))
def test_open_windows_against_a_list(capacity, steps):
    tree, rooms = packing.OpenWindows(capacity), Counter()
    for add, x in steps:
        x = min(x, capacity)
        if add:
            tree.add(x, x * 1000 + rooms[x])
            rooms[x] += 1
        found = tree.tightest(x)
        assert found == tightest(rooms, x)
        if not add and found is not None:
            rooms[found] -= 1
            assert tree.take(found) // 1000 == found
    assert all(tree.tightest(x) == tightest(rooms, x) for x in range(capacity + 1))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=80))
def test_best_fit_decreasing(lengths):
    window, offset = packing.best_fit(np.array(lengths), 40)
    rooms, n = {}, 0  # the same by looking through all windows
    fill = defaultdict(list)
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        fits = [r for r in rooms.values() if r >= lengths[k]]
        room = min(fits, default=40)
        if not fits:
            rooms[n], n = 40, n + 1
        w = next(w for w, r in rooms.items() if r == room)
        rooms[w] -= lengths[k]
        fill[int(window[k])].append((int(offset[k]), lengths[k]))
    assert sorted(rooms.values()) == sorted(40 - sum(x for _, x in f) for f in fill.values())
    for f in fill.values():
        f.sort()
        assert [o for o, _ in f] == [sum(x for _, x in f[:k]) for k in range(len(f))]


def test_terms_of_a_text():
    pattern = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = ["", "One two-three_FOUR5six", "Straße É\u0301 Ａ　b\x85c\x1cd\xa0e", "a[b]c`d{e}f~g\x7fh@i", "\x00", "ŠĐ " * 50]
    for text in texts:
        for part in (1, 5, 1 << 20):
            got = divergence.frequencies(text.encode(), part)
            assert {k.decode(): n for k, n in got.items()} == Counter(t.translate(lower) for t in pattern.findall(text))


def audit_by_brute_force(rows, min_docs, top):
    counts, docs_of, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, t, lang, source, _ in rows:
        c = Counter({k.decode(): n for k, n in divergence.frequencies((t or "").encode()).items()})
        groups.add((lang or "", source or ""))
        counts[lang or "", source or ""].update(c)
        docs_of[lang or ""].update(c.keys())
    out = []
    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang, source in sorted(groups):
        kept = sorted((t for t, n in docs_of[lang].items() if n >= min_docs), key=str.encode)
        every = Counter()
        for g in groups:
            if g[0] == lang:
                every.update(counts[g])

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        mine, whole = shares(counts[lang, source]), shares(every)
        pairs = [(other, sum(f(mine[t], shares(counts[lang, other])[t]) for t in kept))
                 for x, other in sorted(groups) if x == lang and other != source]
        terms = [(t, f(mine[t], whole[t])) for t in kept if counts[lang, source][t] and mine[t] > whole[t]]
        for part, found in (("pair", pairs), ("term", terms)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(found)
                    if part == "pair" or k < top]
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_docs, top, held", [(2, 3, 400_000), (1, 10, 50), (1000, 10, 400_000)])
def test_divergence(spark, monkeypatch, min_docs, top, held):
    monkeypatch.setattr(divergence, "HELD", held)
    rng = random.Random(3)
    words = ["Ähre", "b", "c", "dd", "Ee", "f-g", "h", "İ", "x", "y"]
    rows = awkward_rows()[:15] + [(100 + k, " ".join(rng.choices(words, range(1, 11), k=rng.randint(0, 30))), rng.choice(["a", "b", "", None]),
                                   rng.choice(["s", "t", "u", None]), 0) for k in range(120)]
    rows += [rows[-1]] * 3 + [(900, None, "alone", "x", 0), (901, "", "mute", None, 0), (902, "5 !", "mute", "z", 0)]
    df = with_clashes(spark.createDataFrame(rows, awkward(spark).schema).repartition(5))
    for name in ("term", "p", "q", "p0", "value", "item"):
        df = df.withColumn(name, df["doc_id"])
    got = tuples(divergence.audit(df, min_docs, top))
    assert got == audit_by_brute_force(rows, min_docs, top)
    assert divergence.audit(df.limit(0)).count() == 0


def test_divergence_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BROADCAST_GROUPS", 0)
    assert tuples(divergence.audit(awkward(spark), 2)) == audit_by_brute_force(awkward_rows(), 2, 10)


def test_shares_are_exact(spark):
    """Also where counts times the scale are beyond 64 bits."""
    n, total, terms = 2 ** 61 + 12_345, 2 ** 62 + 7, 10 ** 9
    df = spark.createDataFrame([(n, total, terms), (0, 0, 0)], "n bigint, total bigint, terms bigint")
    got = [r[0] for r in df.select(divergence.share(*[df[c] for c in df.columns])).collect()]
    assert got == [1 + 10 ** 9 * (n + 2) // (total + 2 * terms), None]
