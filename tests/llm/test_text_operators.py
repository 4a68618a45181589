"""Chat formatting, WARC archives, byte-level BPE."""

from __future__ import annotations

import gzip
import hashlib
import os
import zlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from furlong.llm import bpe, chat, warc
from tests.llm.data import awkward, awkward_rows, tuples, with_clashes

PIECES = st.sampled_from([*chat.CONTROL, "\\", "<", "[", "]", "/", "s", "INST", "a", "\n", "é"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=12).map("".join),
       st.one_of(st.sampled_from(["user", "assistant", "system", "tool", ""]), st.lists(PIECES, max_size=4).map("".join)))
def test_turn_round_trip(text, role):
    rendered, start, end, level = chat.render_turn(role, text)
    assert list(chat.Parser().turns(rendered)) == [(role, text, start, end)]
    twice = rendered + chat.render_turn("user", text)[0]
    assert [x[:2] for x in chat.Parser().turns(twice)] == [(role, text), ("user", text)]
    assert level <= 1  # escaping the conflicts alone is enough


def test_parser_refuses_what_is_not_in_the_grammar():
    for bad in ("x", "[INST]a", "[INST]a</s>", "[/INST]", "[ROLE]r[/ROLE]t", "[INST]a[/INST]b"):
        with pytest.raises(ValueError):
            list(chat.Parser().turns(bad))


def test_chat_conversations(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", None), (1, 2, None, "x</s>"),
            (2, None, "assistant", "a\\"), (2, 0, "assistant", "[INST]b"), (None, 0, "user", ""), (3, 5, "tool", "\\\\<")]
    df = with_clashes(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert set(got) == {1, 2, 3, None}
    want = "user\nhi\nassistant\n\nassistant\n\n\nx</s>\n"
    assert got[1]["n_turns"] == 4
    assert got[1]["turns_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    assert (got[2]["loss_chars"], got[2]["loss_sha256"]) == (9, hashlib.sha256(b"a\\[INST]b").hexdigest())
    assert got[2]["escaped_turns"] == 2
    empty = chat.read_back(chat.format_conversations(df.limit(0)))
    assert empty.count() == 0
    with pytest.raises(Exception, match="belongs"):  # rows moved between formatting and reading
        chat.read_back(chat.format_conversations(df).repartition(3)).collect()


def pages(spark):
    same = "<p>" + "same " * 40 + "</p>"
    fake = "WARC/1.1\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    rows = [(5, "http://a b\r\n/x", same), (3, None, same), (3, "again", same), (9, "u", same), (7, "u", "short"),
            (8, "u", "short"), (10, "u", None), (11, "u", ""), (12, "u", fake * 5), (None, "u", same), (13, "u", "é" * 70)]
    return with_clashes(spark.createDataFrame(rows, "page_id bigint, url string, html string"))


def test_warc_round_trip(spark, tmp_path):
    path = f"file://{tmp_path}/w"
    df = pages(spark)
    warc.write_archives(df, path)
    got = warc.read_archives(spark, path)
    assert got.where("gap IS NOT NULL").count() == 0
    rows = [(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in got.collect()]
    want = []
    same = [h for _, _, h in df.select("page_id", "url", "html").collect() if h and h.startswith("<p>same")][0]
    for r in df.select("page_id", "html").collect():
        raw = (r["html"] or "").encode()
        first = r["html"] != same or r["page_id"] == 3
        want.append((r["page_id"], "response" if first else "revisit", None if first else 3, len(raw),
                     hashlib.sha256(raw).hexdigest()))
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    warc.write_archives(df.limit(0), path + "0")
    for f in os.listdir(tmp_path / "w"):  # any gzip reader takes the files
        if f.startswith("part"):
            gzip.decompress((tmp_path / "w" / f).read_bytes())


def test_warc_salvage():
    records = [warc.record(k, "u", f"page {k} " + "text " * 50, hashlib.sha256(
        (f"page {k} " + "text " * 50).encode()).hexdigest(), 0, None) for k in range(20)]
    ids = lambda out: [int(x[3]["fields"]["warc-record-id"][10:-1]) for x in out if x[0] == "record"]
    gaps = lambda out: [x[1:3] for x in out if x[0] == "gap"]
    for wrap in (warc.member, bytes):
        parts = [wrap(r) for r in records]
        whole = b"".join(parts)
        assert ids(list(warc.salvage(whole))) == list(range(20)) and not gaps(list(warc.salvage(whole)))
        at = sum(map(len, parts[:4]))
        damaged = bytearray(whole)
        damaged[at + len(parts[4]) // 2] ^= 0x55  # inside record 4
        out = list(warc.salvage(bytes(damaged)))
        assert ids(out) == [k for k in range(20) if k != 4]
        assert gaps(out) == [(at, at + len(parts[4]))]
        cut = whole[:at + 10] + whole[at + len(parts[4]) + 7:]  # a hole over two records
        out = list(warc.salvage(cut))
        assert ids(out) == [k for k in range(20) if k not in (4, 5)]
        assert len(gaps(out)) == 1
        out = list(warc.salvage(b"junk" + whole + parts[0][:-20]))
        assert ids(out) == list(range(20)) and gaps(out)[0] == (0, 4) and len(gaps(out)) == 2
    assert list(warc.salvage(b"")) == []


def test_warc_salvage_inside_members():
    """A damaged member of several records loses only what is damaged."""
    texts = [f"page {k} " + hashlib.sha512(str(k).encode()).hexdigest() * 20 for k in range(20)]
    records = [warc.record(k, "u", t, hashlib.sha256(t.encode()).hexdigest(), 0, None) for k, t in enumerate(texts)]
    ids = lambda out: [int(x[3]["fields"]["warc-record-id"][10:-1]) for x in out if x[0] == "record"]
    gaps = lambda out: [x[1:] for x in out if x[0] == "gap"]
    first, last = warc.member(records[0]), warc.member(records[19])
    bad = bytearray(b"".join(records[1:19]))
    at = sum(map(len, records[1:5]))
    for spot in (at + 2, at + len(records[5]) // 2):  # the version line, the payload
        hurt = bytearray(bad)
        hurt[spot] ^= 0x55
        out = list(warc.salvage(first + warc.member(bytes(hurt)) + last))
        assert ids(out) == [k for k in range(20) if k != 5]
        (start, end, why), = gaps(out)
        assert (start, end) == (len(first), len(first) + len(warc.member(bytes(hurt))))
        assert f"bytes {at} to {at + len(records[5])} " in why
    for level in (0, 6):  # stored blocks show their version lines in the archive, too
        c = zlib.compressobj(level, zlib.DEFLATED, 31)
        whole = c.compress(bytes(bad)) + c.flush()
        crc = bytearray(whole)
        crc[-6] ^= 0x55
        out = list(warc.salvage(first + bytes(crc) + last))
        assert ids(out) == list(range(20)) and len(gaps(out)) == 1 and "gzip" in gaps(out)[0][2]
        torn = whole[:len(whole) * 2 // 3]
        out = list(warc.salvage(first + torn + last))
        assert ids(out)[:11] == list(range(11)) and ids(out)[-1] == 19 and len(ids(out)) == len(set(ids(out)))
        assert [x[0] for x in gaps(out)] == [len(first)]
    bare = b"WARC/1.1\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"  # nothing vouches for it if the member is damaged
    crc = bytearray(warc.member(bare + records[1]))
    crc[-6] ^= 0x55
    out = list(warc.salvage(bytes(crc)))
    assert ids(out) == [1] and "no block digest" in gaps(out)[0][2]


def test_warc_long_urls_and_gaps(spark, tmp_path):
    """A header of any length is read; a gap in the query's own archives is an error."""
    path = f"file://{tmp_path}/w"
    rows = [(1, "http://x/" + " " * 400_000, "<p>a</p>"), (2, "http://x/WARC/1.1" + "y" * 1_500_000, "<p>b</p>"), (3, "u", "c")]
    warc.write_archives(spark.createDataFrame(rows, "page_id bigint, url string, html string"), path)
    got = warc.whole(warc.read_archives(spark, path)).select("page_id", "url", "payload_bytes").collect()
    assert sorted(tuple(r) for r in got) == [(1, "http://x/" + "%20" * 400_000, 8), (2, rows[1][1], 8), (3, "u", 1)]
    part, = [f for f in (tmp_path / "w").iterdir() if f.name.startswith("part") and f.stat().st_size > 100][-1:]
    (tmp_path / "hurt").mkdir()
    (tmp_path / "hurt" / "x.warc.gz").write_bytes(part.read_bytes()[:-60])
    with pytest.raises(Exception, match="damaged archive"):
        warc.whole(warc.read_archives(spark, f"file://{tmp_path}/hurt")).select("page_id").collect()
    two = warc.record(1, "u", "a" * 99, hashlib.sha256(b"a" * 99).hexdigest(), 99, None)
    head = two.index(b"\r\n\r\n")  # a header without its end does not take the next one's
    out = list(warc.salvage(two[:head] + b"\r\n" + two))
    assert [x[0] for x in out] == ["gap", "record"]


def test_bpe_against_the_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    enc = bpe.encoder(open(path, "rb").read(), public_tokenizers.PATTERN)
    want = []
    for i, t, *_ in awkward_rows():
        ids = enc.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    df = with_clashes(awkward(spark))
    assert tuples(bpe.round_trip(df, path, public_tokenizers.PATTERN)) == sorted(want, key=repr)
    back = bpe.decode_documents(bpe.encode_documents(df, path, public_tokenizers.PATTERN), path, public_tokenizers.PATTERN)
    assert sorted((bytes(r["bytes"]) for r in back.collect())) == sorted((t or "").encode() for _, t, *_ in awkward_rows())
    assert bpe.round_trip(df.limit(0), path, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["word", " ", "  ", "\n", "\t", "\x1c", "\x85", "　", "12", "!", "'s", "é", "a" * 40]),
                max_size=60).map("".join), st.integers(3, 40), st.integers(2, 6))
def test_bpe_pieces_encode_like_the_whole(text, size, run):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    if not hasattr(test_bpe_pieces_encode_like_the_whole, "enc"):
        test_bpe_pieces_encode_like_the_whole.enc = bpe.encoder(open(path, "rb").read(), public_tokenizers.PATTERN)
    enc = test_bpe_pieces_encode_like_the_whole.enc
    assert "".join(bpe.pieces(text, size)) == text
    assert [i for p in bpe.pieces(text, size) for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


def test_bpe_of_another_pattern_cuts_nothing():
    """The boundaries hold for the one pattern; texts are whole with any other."""
    ranks = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read()
    assert bpe.PATTERN == public_tokenizers.PATTERN
    enc = bpe.encoder(ranks, r"[^a]+|a")  # matches cross white space
    text = "b cd\n" * 30_000
    assert bpe.encode(enc, text) == enc.encode_ordinary(text)


def test_bpe_long_texts():
    enc = bpe.encoder(open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read(), public_tokenizers.PATTERN)
    for text in ("a" * 120_000 + " b", " " * 200_000 + "x", "ab \n\n  " * 20_000, "x" + "\n" * 5000 + " y " * 30_000,
                 "\t" * 60_000, ("word!\x1c " + "　 \x85" * 3) * 8000):
        assert bpe.encode(enc, text) == enc.encode_ordinary(text)
