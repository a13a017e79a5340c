"""Byte-level BPE against tiktoken: ids, streams, and the properties that the transducer rests on."""

import base64
import hashlib
import random

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidewatch.llm import byte_bpe

RANKS, PATTERN = byte_bpe.public_ranks()
ODD = [None, "", " ", "   \n\t ", "one", "tie", "tie", "漢字 かな 😀👩‍👩‍👧", "x\0y\x0bz", "'s 'S it's I'LL", "<|endoftext|>", "\x1c\x85  　a", "a" * 5000, " " * 5000 + "b", "\n" * 300]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.coder(RANKS, PATTERN)


def ids_of(coder, text):
    return np.frombuffer(coder.encode(text), "<u4").tolist()


def made_up(r, tokens):
    yield "".join(chr(r.choice([r.randrange(32, 127), r.randrange(160, 0x3000), r.randrange(0x3000, 0xD7FF), r.randrange(0x1F300, 0x1F700)])) for _ in range(40))
    yield "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=60))
    yield b"".join(r.choices(tokens, k=12)).decode("utf-8", "replace")
    yield "".join(r.choices("aeinst", k=80))
    yield "".join(r.choices("ab\n \t'.=-_0", k=80))


def test_ids_are_the_library_s(library, coder):
    r = random.Random(7)
    tokens = list(coder.merges.rank)
    for _ in range(300):
        for text in made_up(r, tokens):
            assert ids_of(coder, text) == library.encode_ordinary(text), text
    for text in filter(None, ODD):
        assert ids_of(coder, text) == library.encode_ordinary(text), text[:50]


def test_code_points(library, coder):
    for cp in [*range(0x3100), *range(0x3100, 0x110000, 199)]:
        if not 0xD800 <= cp < 0xE000:
            c = chr(cp)
            text = f"a{c}1 {c} {c}{c}!"
            assert ids_of(coder, text) == library.encode_ordinary(text), hex(cp)


def test_neighbours_are_stable_as_merging_says(coder):
    r = random.Random(3)
    m = coder.merges
    tokens = sorted(m.rank.values())
    seen = set()
    for k in range(3000):
        a, b = r.choice(tokens), r.choice(tokens[: 3000 if k % 2 else None])
        seen.add(m.stable(a, b))
        assert m.stable(a, b) == (m.merged(m.token[a] + m.token[b]) == [a, b])
    assert seen == {True, False}


def test_tokens_wait_for_few_bytes(coder, library):
    """Lookahead is bounded: on long words no guess is ever longer than the longest token."""
    t = byte_bpe.Transducer(coder.merges)
    longest = max(map(len, coder.merges.rank))
    r = random.Random(5)
    for text in ("".join(r.choices("abcdefghijklmnop", k=4000)), "a" * 4000, "abc" * 1500, "=" * 3000):
        state, out, fed = 0, [], 0
        for byte in text.encode():
            state, sure = t.arc(state, byte)
            out += sure
            fed += 1
            assert fed - sum(len(coder.merges.token[i]) for i in out) <= 2 * longest
        waits = t.states[state][-1][1]
        assert [*out, *waits] == library.encode_ordinary(text)


def test_full_tables_begin_anew(library, coder, monkeypatch):
    for name in ("MOST_STATES", "MOST_PAIRS", "MOST_WORDS"):
        monkeypatch.setattr(byte_bpe, name, 7)
    own = byte_bpe.Coder(RANKS, PATTERN)
    r = random.Random(9)
    for _ in range(30):
        for text in made_up(r, [b"the", b" of"]):
            assert ids_of(own, text) == library.encode_ordinary(text)


def test_long_texts_are_split_alike(library, coder, monkeypatch):
    monkeypatch.setattr(byte_bpe, "AT_ONCE", 10)
    monkeypatch.setattr(byte_bpe, "MATCHES", 3)
    text = "It's   a  text\n\n  with 1234 white   space " * 9
    assert ids_of(coder, text) == library.encode_ordinary(text)


def test_stream_of_bytes():
    """However bytes are cut, the text is that of the whole; sound or not."""
    r = random.Random(2)
    for k in range(600):
        raw = bytes(r.choices([0x41, 0xC3, 0xA9, 0xE0, 0xA0, 0x80, 0xED, 0x9F, 0xBF, 0xF0, 0x90, 0xF4, 0x8F, 0xC0, 0xF5, 0xFF], k=r.randrange(14))) if k % 2 else "né 漢 😀".encode()[: r.randrange(15)]
        u, out, at = byte_bpe.Utf8(), "", 0
        while at < len(raw):
            n = r.randrange(1, 4)
            out += u.feed(raw[at : at + n])
            at += n
        assert out + u.close() == raw.decode("utf-8", "replace")


def test_streams_end_with_whole_characters(coder):
    ids = np.frombuffer(coder.encode("漢字😀" * 50), "<u4")
    parts = [p for i in range(len(ids)) for p in [coder.merges.token[int(ids[i])]]]
    u = byte_bpe.Utf8()
    assert "".join(u.feed(p) for p in parts) + u.close() == "漢字😀" * 50


def test_odd_rows(spark, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, "tie")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit(1), "decoded": F.lit(2), "tokens": F.lit(3)})
    got = byte_bpe.encode(df, RANKS, PATTERN, decoded=True)
    assert got.columns == ["doc_id", "text", "tokens", "ids", "decoded"]
    for r in got.collect():
        assert r.ids == library.encode_ordinary(r.text or "")
        assert r.decoded == (r.text or "")
    packed = byte_bpe.decode(byte_bpe.encode(df, RANKS, PATTERN, packed=True), RANKS, PATTERN).collect()
    assert sorted((r.doc_id or -1, r.decoded) for r in packed) == sorted((i or -1, t or "") for i, t in rows)
    assert byte_bpe.encode(df.where("false"), RANKS, PATTERN).count() == 0
    broken = spark.createDataFrame([(1, None), (2, []), (3, [None, -5, 10**6, 64])], "n int, ids array<int>")
    assert [r.decoded for r in byte_bpe.decode(broken, RANKS, PATTERN).orderBy("n").collect()] == ["", "", coder_token(64)]


def coder_token(i):
    return byte_bpe.coder(RANKS, PATTERN).merges.token[i].decode("utf-8", "replace")


def test_query_by_brute_force(spark, sf_dir, library):
    import __spark_entry__

    got = {r.doc_id: r for r in __spark_entry__.queries()["op11_byte_bpe"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode_ordinary(d.text or "")
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode_bytes(ids)).hexdigest()
