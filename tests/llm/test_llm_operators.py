"""Training-data operators against brute force, round trips and held-out data, with the awkward cases of each."""

import base64
import collections
import hashlib
import math
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import embeddings, language, media, minhash, mixing, ngram_score, pieces, sharding, substrings, warc
from tidewatch.llm._store import written
from tidewatch.llm._text import utf8, words
from tidewatch.llm.components import components

#: Null, empty, blank, short, repeated, very long, other scripts, control characters, the mark of pieces.
TEXTS = [None, "", "   \n", "one", "two words", "漢字 かな 😀", "x\0y\x0bz", "▁a ▁", "12 34 !!", "a b c d e f g", "A b C d e F g", "lorem ipsum " * 20_000, "tie", "tie"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").cache()


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None if i % 3 else "en", None if i % 2 else "s", None) for i, t in enumerate(TEXTS)]
    rows += [(None, "no id", None, None, 5), (3, "one", "en", "s", 3), (3, "one", "en", "s", 3)]
    clash = {c: F.lit(0) for c in ("fp", "block", "tokens", "ids", "media", "payload", "score", "row_no", "key", "shard", "_n")}
    return spark.createDataFrame(rows, SCHEMA).withColumns(clash)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


def tokens(text):
    return (text or "").encode().lower().split()


def joined(links, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_words():
    data, offsets = utf8(pa.array(["Foo bar\x0bfoo", None, "", " x FOO", "é"]))
    row, begin, end, h = words(data, offsets)
    assert row.tolist() == [0, 0, 0, 3, 3, 4]
    assert [bytes(data[a:b]).lower() for a, b in zip(begin, end)] == [b"foo", b"bar", b"foo", b"x", b"foo", "é".encode()]
    assert h[0] == h[2] == h[4] and len(set(h.tolist())) == 4


def test_components(spark):
    r = random.Random(1)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(1000, x) for x in range(1001, 1200)] + [(x, x + 1) for x in range(2000, 2200)] + [(5, 5), (None, 1)]
    got = {x.node: x.component for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    whole = [(a, b) for a, b in links if a is not None]
    assert got == joined(whole, {x for p in whole for x in p})
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 1 ---


def jaccard_links(texts):
    sets = {}
    for i, t in texts.items():
        w = tokens(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    by = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    pairs = {(a, b) for v in by.values() for a in v for b in v if a < b}
    return [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]


def test_minhash_finds_all_groups(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    assert got == joined(jaccard_links(texts), texts)
    kept = minhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))


def test_minhash_at_a_thousand_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()} == joined(jaccard_links(texts), texts)


def test_minhash_deals_out_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(minhash, "DEALT", 16)
    test_minhash_large_near_group(spark)


def test_minhash_large_near_group(spark):
    r = random.Random(2)
    base = [f"w{r.randrange(10**6)}" for _ in range(120)]

    def near():
        w = base.copy()
        for _ in range(2):
            w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
        return " ".join(w)

    texts = dict(enumerate([near() for _ in range(150)] + [" ".join(base)] * 60 + [" ".join(f"q{r.randrange(10**6)}" for _ in range(80)) for _ in range(30)]))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {x.doc_id: x.class_id for x in minhash.near_duplicates(df).collect()}
    assert got == joined(jaccard_links(texts), texts)


def test_minhash_odd_rows(odd, empty):
    rows = minhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    own = {r.doc_id: r.class_id for r in rows}
    assert own[0] == 0 and own[1] == 1 and own[2] == 2 and own[None] is None
    assert own[10] == 9 and own[13] == 12
    kept = minhash.deduplicated(odd)
    assert kept.columns == odd.columns and kept.where("doc_id = 3").count() == 1
    assert minhash.near_duplicates(empty).count() == 0 and minhash.deduplicated(empty).count() == 0


def test_minhash_keeps_a_row_of_each_class(spark):
    r = random.Random(7)
    text = lambda n=60: " ".join(f"w{r.randrange(10**6)}" for _ in range(n))
    near = lambda t: t + " end"
    a, b, c, d, e, f = (text() for _ in range(6))
    # rows without an id: unlike each other, exact copies, and one that stands for a class with other members
    rows = [(None, a), (None, b), (None, b), (None, c), (8, near(c)), (9, c)]
    # a shared id: one text is a near copy of a smaller id's, the other stands for a class of its own
    rows += [(1, d), (2, near(d)), (2, e), (3, near(e)), (4, f), (4, f), (4, near(f))]
    rows += [(5, None), (5, " "), (None, None), (None, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [x.text for x in minhash.deduplicated(df).collect()]
    words = [t for t in kept if t and t.strip()]
    assert sorted(t.removesuffix(" end") for t in words) == sorted([a, b, c, d, e, f])
    assert len(kept) == len(words) + 4
    assert c in words and d in words and e in words


def test_probminhash_estimates_probability_jaccard():
    r = np.random.default_rng(0)
    n, m = 60, 4096
    element = np.arange(1, n + 1, dtype=np.uint64)
    a, b = r.uniform(0.2, 3, n), r.uniform(0.2, 3, n)
    a[:15] = 0
    b[-15:] = 0
    row = np.concatenate([np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)])
    won = minhash.probminhash(row, np.concatenate([element[a > 0], element[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), 2, m)
    true = sum(1 / np.maximum(a / a[i], b / b[i]).sum() for i in range(n) if a[i] and b[i])
    assert abs((won[0] == won[1]).mean() - true) < 4 * math.sqrt(true * (1 - true) / m)


# --- 2 ---


def test_scores(spark, docs):
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    texts = {r.doc_id: r.text for r in docs.collect()}
    seen = {i: [*tokens(t), None] for i, t in texts.items()}
    counts = collections.Counter(t for i, ts in seen.items() if not held(i) for t in ts)
    total, kinds = sum(counts.values()), len(counts)
    model = ngram_score.Model(docs.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 1))
    got = {r.doc_id: r for r in ngram_score.score(docs.select("doc_id", "text"), model).collect()}
    for i, ts in seen.items():
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (kinds + 1))) for t in ts)
        assert math.isclose(got[i].base_score, base, rel_tol=1e-9)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(ts), sum(counts[t] > 0 for t in ts), total)
    own = [r for i, r in got.items() if held(i)]
    assert sum(r.score for r in own) > sum(r.base_score for r in own)
    far = {r.doc_id: r.score for r in ngram_score.score(docs.select("doc_id", "text"), model, near_bytes=0).collect()}
    assert all(math.isclose(far[i], got[i].score, rel_tol=1e-12) for i in got)


def test_rare_tokens_are_joined(docs, monkeypatch):
    model = ngram_score.Model(docs)
    whole = {r.doc_id: (r.base_score, r.n_known) for r in ngram_score.score(docs.select("doc_id", "text"), model).collect()}
    monkeypatch.setattr(ngram_score, "HOT_TOKENS", 50)
    few = ngram_score.Model(docs)
    assert len(few.hot()[0]) <= 50
    for r in ngram_score.score(docs.select("doc_id", "text"), few).collect():
        assert math.isclose(r.base_score, whole[r.doc_id][0], rel_tol=1e-9) and r.n_known == whole[r.doc_id][1]


def test_filter_levels():
    r = np.random.default_rng(3)
    keys = r.integers(0, 1 << 63, 20_000).astype(np.uint64)
    level = r.integers(1, 9, len(keys))
    for first in (1, 4):
        s, marks = ngram_score.placed(keys, 4)
        parts = [(i, *ngram_score.build(marks[(s == i) & (level >= first)], level[(s == i) & (level >= first)], first)) for i in range(4)]
        f = ngram_score.Filter(4, first, parts)
        got, want = f.levels(s, marks), np.where(level >= first, level, 0)
        assert (got >= want).all() and (got == want).mean() > 0.95
        assert (f.levels(*ngram_score.placed(r.integers(0, 1 << 63, 20_000).astype(np.uint64), 4)) > 0).mean() < 0.05


def test_small_heads_score_alike(spark, docs):
    """With less room in the head its levels begin later, and more is looked up in segments."""
    few = docs.select("doc_id", "text")
    wide, narrow = ngram_score.Model(docs), ngram_score.Model(docs, head_bytes=3000)
    assert narrow.first > wide.first
    a, b = ({r.doc_id: r for r in ngram_score.score(few, m).collect()} for m in (wide, narrow))
    c = {r.doc_id: r.score for r in ngram_score.score(few, narrow, near_bytes=0).collect()}
    assert all(abs(a[i].score - b[i].score) < 0.02 * a[i].n_tokens + 3 for i in a)
    assert all(math.isclose(a[i].base_score, b[i].base_score, rel_tol=1e-9) for i in a)
    assert all(math.isclose(c[i], b[i].score, rel_tol=1e-12) for i in c)


def test_scores_odd_rows(odd, empty):
    model = ngram_score.Model(odd)
    rows = ngram_score.score(odd, model).collect()
    assert len(rows) == odd.count()
    assert {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {1}
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    assert ngram_score.score(empty, model).count() == 0
    none = ngram_score.score(odd, ngram_score.Model(empty)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in none)


# --- 3 ---


def test_pieces_are_the_library_s(spark, docs, odd):
    import sentencepiece

    path = pieces.model_path()
    stock = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = docs.select("doc_id", "text").union(odd.select("doc_id", "text"))
    rows = pieces.decode(pieces.encode(texts, path), path).collect()
    assert sorted(map(str, rows)) == sorted(map(str, pieces.encode(texts, path, decoded=True).collect()))
    for r in rows:
        text = r.text or ""
        ids = stock.encode(text, add_eos=True)
        assert r.ids == ids and r.decoded == stock.decode(ids)
        raw = text.encode()
        assert r.begins[0] == 0 and r.ends[-1] == len(raw) and r.begins[1:] == [*r.ends[:-2], len(raw)][: len(ids) - 1]
        if "▁" not in text and raw:
            for i, a, b in list(zip(ids, r.begins, r.ends))[1:-1][:200]:
                if not stock.is_byte(i):
                    assert stock.id_to_piece(i).replace("▁", " ").encode() == raw[a:b]


def test_pieces_query_by_brute_force(spark, sf_dir, tmp_path):
    import sentencepiece

    stock = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()] + [(10**6 + i, t) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in pieces.op3_sentencepiece(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for i, t in texts:
        ids = stock.encode(t or "", add_eos=True)
        r = got[i]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(stock.decode(ids).encode()).hexdigest()


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_pieces_with_a_real_character_map(spark, tmp_path, rule):
    """A map that the library compiles, put into the model: ids are the library's, spans cover the text and normalise to the pieces."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(pieces.model_path(), "rb") as f:
        model.ParseFromString(f.read())
    normaliser = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    made = pb.ModelProto()
    made.ParseFromString(normaliser.serialized_model_proto())
    model.normalizer_spec.precompiled_charsmap = made.normalizer_spec.precompiled_charsmap
    model.normalizer_spec.remove_extra_whitespaces = True
    path = str(tmp_path / "mapped.model")
    with open(path, "wb") as f:
        f.write(model.SerializeToString())
    stock = sentencepiece.SentencePieceProcessor(model_file=path)
    assert pieces.encoder(path).normalise.map.units
    r = random.Random(3)
    texts = ["ﬁne ①②  Ｆｕｌｌ　ｗｉｄｔｈ", "½ ㎏ ﷺ", "é é Å", "  a \u200b b\t\tc ", "㈱ｶﾞ", "", "plain words here", *("".join(r.choices("aé ﬁ①Ｆ　½㎏ｶﾞ\u0301xyz ", k=r.randrange(1, 40))) for _ in range(200))]
    rows = pieces.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), path).collect()
    for x in rows:
        raw = x.text.encode()
        assert x.ids == stock.encode(x.text, add_eos=True), x.text
        assert x.begins[0] == (0 if len(x.ids) > 1 else len(raw)) and x.ends[-1] == len(raw) and all(a <= b for a, b in zip(x.begins, x.ends)) and x.begins[1:] == [*x.ends[:-2], len(raw)][: len(x.ids) - 1]


def test_pieces_empty_table(empty):
    path = pieces.model_path()
    out = pieces.decode(pieces.encode(empty, path), path)
    assert out.count() == 0 and set(out.columns) == {*empty.columns, "begins", "ends", "decoded"}


def test_character_map():
    """A map made here: longest prefixes win, and offsets follow replacements of any length."""
    rules = {b"ab": b"X", b"a": b"yy", "é".encode(): b"e"}
    states, edges = [b""], {}
    for key in rules:
        for i in range(1, len(key) + 1):
            if key[:i] not in states:
                states.append(key[:i])
    units, place, used, values = [0] * 4096, {b"": 0}, {0}, b""
    offsets = {}
    for key, v in rules.items():
        offsets[key] = len(values)
        values += v + b"\0"
    for s in sorted(states, key=len):  # every node gets a base where its children's cells are free
        children = [c[-1] for c in states if len(c) == len(s) + 1 and c.startswith(s)]
        cells = children + [0] * (s in rules)
        node = place[s]
        base = next(b for b in range(1, 4096) if all((node ^ b ^ c) not in used for c in cells))
        used |= {node ^ base ^ c for c in cells}
        label = s[-1] if s else 0
        units[node] = base << 10 | (s in rules) << 8 | label
        for c in children:
            place[s + bytes([c])] = node ^ base ^ c
        if s in rules:
            units[node ^ base] = 1 << 31 | offsets[s]
    raw = np.array(units, "<u4").tobytes()

    class Spec:
        precompiled_charsmap = len(raw).to_bytes(4, "little") + raw + values
        add_dummy_prefix, remove_extra_whitespaces = True, True

    assert edges == {}
    n = pieces.Normaliser(Spec)
    assert n.map.longest(b"abc", 0) == (2, b"X") and n.map.longest(b"ac", 0) == (1, b"yy") and n.map.longest(b"zz", 0) is None
    text, where = n.row("  ab  aé ".encode())
    assert text == b" X yye" and where.tolist() == [2, 2, 4, 6, 6, 7, 9]


# --- 4 ---


def payloads(rows):
    first = {}
    for p, h in rows:
        first.setdefault((h or "").encode(), []).append(p)
    return first


def check_records(got, rows, least=0):
    first = payloads(rows)
    want = collections.Counter()
    for p, h in rows:
        raw = (h or "").encode()
        top = min(first[raw])
        again = p != top and len(raw) >= least
        want[p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", top if again else None] += 1
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert all(r.verified for r in got)


def test_warc_round_trip(spark, sf_dir, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    rows += [(10**6 + i, u, h) for i, (u, h) in enumerate([(None, None), ("a\r\nb", ""), ("x", "q" * 300_000), ("y", "q" * 300_000), ("z", "é" * 100_000), ("w", "\r\n\r\n"), ("v", "\r\n\r\n")])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"record_no": F.lit(1), "data": F.lit(2), "last": F.lit(3)})
    spooled = written(warc.spool(pages), "spool")
    assert spooled.where("octet_length(data) > 65536").count() == 0
    chunks = written(warc.archive(spooled), "warc")
    facts = [(p, h) for p, _, h in rows]
    got = warc.read_records(chunks).collect()
    check_records(got, facts)
    check_records(warc.read_records(warc.archive(spooled, 10)).collect(), facts, 10)
    paths = warc.export_files(chunks.repartition(3), str(tmp_path)).collect()
    assert sum(p.records for p in paths) == len(rows)
    back = warc.read_records(warc.import_files(spark.createDataFrame([(p.path,) for p in paths], "path string"))).collect()
    assert sorted(map(str, back)) == sorted(map(str, got))


def test_warc_odd_rows(spark):
    rows = [(1, "u", "a"), (1, "u", "a"), (None, "u", "a"), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.read_records(written(warc.archive(written(warc.spool(pages), "spool")), "warc")).collect()
    assert sorted((r.record_type, r.page_id or 0, r.refers_to or 0) for r in got) == [("response", 0, 0), ("response", 1, 0), ("revisit", 0, 1), ("revisit", 1, 1)]
    assert warc.read_records(written(warc.archive(written(warc.spool(pages.where("false")), "spool")), "warc")).count() == 0
    stored = written(warc.archive(written(warc.spool(pages), "spool")), "warc")
    broken = stored.withColumn("data", F.when(F.col("chunk_no") > 0, F.replace(F.col("data").cast("string"), F.lit("a\r\n"), F.lit("b\r\n")).cast("binary")).otherwise(F.col("data")))
    assert not all(r.verified for r in warc.read_records(broken).where("record_type = 'response' and payload_bytes > 0").collect())
    assert [r.verified for r in warc.read_records(stored.where("chunk_no = 0")).where("record_type = 'response'").collect()].count(False) == 1
    junk = stored.withColumn("data", F.lit(b"junk"))
    assert {(r.page_id, r.record_type, r.verified) for r in warc.read_records(junk).collect()} == {(None, None, False)}


def test_warc_oversized_payload_is_linear(spark):
    """64 MB of html in one row: chunks of 64 KB, in seconds."""
    big = spark.range(1).select(F.lit(1).alias("page_id"), F.lit("u").alias("url"), F.repeat(F.lit("0123456789abcdef"), 4 << 20).alias("html"))
    began = time.time()
    spooled = written(warc.spool(big), "spool")
    assert spooled.count() == 1024 and spooled.agg(F.max(F.octet_length("data"))).first()[0] == warc.CHUNK
    (r,) = warc.read_records(written(warc.archive(spooled), "warc")).collect()
    assert (r.payload_bytes, r.verified) == (64 << 20, True)
    assert r.payload_digest == base64.b32encode(hashlib.sha1(b"0123456789abcdef" * (4 << 20)).digest()).decode()
    assert time.time() - began < 60


def test_warc_hot_payload(spark):
    """Most pages have one payload: each is a revisit of the smallest page_id."""
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 3 > 0, "same").otherwise(F.col("id").cast("string")).alias("html"))
    got = warc.read_records(written(warc.archive(written(warc.spool(pages), "spool")), "warc"))
    assert got.where("record_type = 'revisit' and refers_to = 1").count() == 1999 and got.where("verified").count() == 3000


# --- 5 ---


def test_passages_are_found(docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    where = collections.defaultdict(set)
    for i, t in texts.items():
        w = tokens(t)
        for k in range(len(w) - 50):
            where[tuple(w[k : k + 51])].add(i)
    found = substrings.passages(docs).collect()
    told = {r.doc_id for r in found}
    assert all(len(ids - told) <= 1 for ids in where.values())
    for r in found:
        raw = texts[r.doc_id].encode()
        assert len(raw[r.begin : r.end].split()) == r.n_words >= 51
    cut = {r.doc_id: r for r in substrings.without_passages(docs).collect()}
    assert set(cut) == set(texts)
    left = collections.Counter()
    for r in cut.values():
        w = tokens(r.text)
        left.update({tuple(w[k : k + 51]) for k in range(len(w) - 50)})
        assert r.n_chars == len(r.text) or r.doc_id not in told
        assert r.doc_id in told or r.text == texts[r.doc_id]
    assert max(left.values(), default=0) <= 1


def test_passages_resist_shifts(spark):
    r = random.Random(5)
    text = lambda n: " ".join("".join(r.choices("abcdefgh", k=r.randrange(2, 9))) for _ in range(n))
    same = 0
    for _ in range(40):
        shared = text(60)
        rows = [text(r.randrange(5, 60)) + " " + shared + " " + text(30), text(r.randrange(1, 90)) + "  " + shared.upper() + "\n" + text(3), text(200)]
        data, offsets = utf8(pa.array(rows))
        row, _, _, size, digest = substrings.chunks(data, offsets)
        both = set(digest[row == 0].tolist()) & set(digest[row == 1].tolist())
        same += sum(s for s, d, k in zip(size, digest.tolist(), row) if k == 1 and d in both) >= 20  # words of whole chunks
        assert not both & set(digest[row == 2].tolist())
    assert same >= 39


@pytest.mark.parametrize("letters", [1, 2, 3, 9])
def test_passages_just_over_fifty_words(spark, letters):
    """Of words of any length; and what is shorter is left alone."""
    r = random.Random(letters)
    text = lambda n: [("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=letters)) if letters > 1 else chr(r.randrange(0x4E00, 0x9FFF))) for _ in range(n)]
    rows, want = [], {}
    for i in range(120):
        shared, n = text(60), (51, 40, 60)[i % 3]
        before, after = text(r.randrange(0, 80)), text(30)
        rows += [(2 * i, " ".join(text(20) + shared + text(25))), (2 * i + 1, " ".join(before) + "\t " + "  ".join(shared[:n]).upper() + " " + " ".join(after))]
        if n > 50:
            want[2 * i + 1] = shared[:n]
    got = collections.defaultdict(list)
    texts = dict(rows)
    for x in substrings.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[x.doc_id].append(texts[x.doc_id].encode()[x.begin : x.end].decode().lower().split())
    assert set(got) <= set(want) and len(want) - len(got) <= (2 if letters == 2 else 0)  # 51 words of two letters may have no whole chunk
    assert all(want[i] in g or any(set(want[i]) <= set(x) for x in g) for i, g in got.items())


def test_repeated_words_are_passages(spark):
    rows = [(1, "tie " * 100), (2, "Tie " * 80 + "and then"), (3, "a b " * 60), (4, "x y a b " + "a b " * 40), (5, "tie tie tie " + "other words")]
    got = {r.doc_id for r in substrings.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {2, 4} <= got and 5 not in got


def test_passages_by_brute_force(spark):
    """Documents of which a window of 51 words is earlier in the corpus, at sf0.01."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: tokens(r.text) for r in docs.collect()}
    seen, want = set(), set()
    for i in sorted(texts):
        own = [tuple(texts[i][k : k + 51]) for k in range(len(texts[i]) - 50)]
        if len(set(own)) < len(own) or seen.intersection(own):
            want.add(i)
        seen.update(own)
    got = {r.doc_id for r in substrings.passages(docs).collect()}
    assert len(want - got) <= 0.01 * len(want) and len(got - want) <= 0.02 * len(want)


def test_passages_odd_rows(odd, empty):
    rows = substrings.passages(odd).collect()
    assert {r.doc_id for r in rows} == {11}
    out = substrings.without_passages(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert substrings.passages(empty).count() == 0 and substrings.without_passages(empty).count() == 0


# --- 6 ---


def test_language_held_out(docs):
    rows = language.language_id(docs).where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_phrases_by_brute_force(monkeypatch):
    r = np.random.default_rng(1)
    sample = r.integers(0, 5, 300).astype(np.uint8)
    table = language.automaton(sample)
    rows = [r.integers(0, 6, n).astype(np.uint8) for n in (1, 50, 0, 2500, 64, 128)]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    have = sample.tobytes()
    for block in (7, 64, 1024):
        monkeypatch.setattr(language, "BLOCK", block)
        got = language.phrases(np.concatenate(rows), offsets, [table])[:, 0]
        for x, n in zip(rows, got):
            text, i, want = x.tobytes(), 0, 1
            for j in range(len(text)):
                if text[i : j + 1] not in have:
                    want += 1
                    i = j if text[j : j + 1] in have else j + 1
            assert n == want


def test_languages_are_bounded(spark, monkeypatch):
    rows = [(i, chr(97 + i % 26) * 50, f"l{i}") for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(language, "TABLE_BYTES", 80 * 512 * 20)
    assert all(len(t) <= 2 * 20 * 128 for _, t, _ in language.fit(df))
    monkeypatch.setattr(language, "MOST_LANGUAGES", 50)
    with pytest.raises(ValueError):
        language.fit(df)


def test_language_odd_rows(odd, empty):
    rows = {r.doc_id: r for r in language.language_id(odd).collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (0, 1, 2, 8))
    assert rows[3].lang_pred == "en"
    assert language.language_id(empty).count() == 0
    assert {r.lang_pred for r in language.predict(odd, []).collect()} == {"und"}


# --- 7 ---


def test_shards(docs, odd):
    rows = sharding.shard_documents(docs, 8).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    size = collections.Counter()
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        size[r.shard] += r.size
    assert len(rows) == len(texts) and max(size.values()) - min(size.values()) <= max(r.size for r in rows)
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert sharding.shard_documents(odd, 3).count() == odd.count()
    assert sharding.shard_documents(odd.where("false"), 3).count() == 0


def test_equal_texts_share_a_shard(spark):
    """Groups of equal texts are held together, but where the boundary of a shard falls."""
    rows = [(i, f"text {i % 97} " * (1 + i % 97)) for i in range(3000)] + [(10_000 + i, "hot " * 30) for i in range(1500)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 4)
    split = got.groupBy("text_crc32").agg(F.count_distinct("shard").alias("n")).where("n > 1").count()
    assert split <= 3
    assert sorted(r.doc_id for r in got.collect()) == sorted(i for i, _ in rows)


def test_repeated_rows_do_not_fill_the_sample(spark):
    rows = spark.range(60_000).select(F.lit(7).cast("long").alias("key"), F.lit(9).cast("long").alias("tie"), F.lit(5).alias("size"))
    out = sharding.shard_by_bytes(rows, 3).groupBy("shard").agg(F.count("*").alias("n"), F.count_distinct("slot").alias("slots"), F.max("slot").alias("last")).collect()
    assert sorted((r.n, r.slots, r.last) for r in out) == [(20_000, 20_000, 19_999)] * 3


def test_overfull_ranges(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.xxhash64("id")).alias("key"), F.xxhash64(F.col("id") + 1).alias("tie"), (F.col("id") % 50 + 1).alias("size"), "id")
    out = sharding.shard_by_bytes(rows, 5, ranges=40).collect()
    assert sorted(r.id for r in out) == list(range(4000))
    size = collections.Counter()
    for r in out:
        size[r.shard] += r.size
    assert max(size.values()) - min(size.values()) <= 51
    for s in range(5):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))


# --- 8 ---


def test_mixture(spark):
    r = random.Random(8)
    rows = [(i, "w " * r.randrange(1, 60), "big" if i % 10 else f"s{i % 3}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("weight", F.lit("mine"))
    share = collections.Counter()
    for _, t, s in rows:
        share[s] += len(t.split())
    total = sum(share.values())

    def entropy(e):
        w = [(v / total) ** e for v in share.values()]
        return -sum(x / sum(w) * math.log(x / sum(w)) for x in w)

    out = mixing.mixture(df, entropy=0.8, repeats=50.0).collect()
    weights = {x.source: x.weight for x in out}
    assert math.isclose(sum(weights.values()), 1, rel_tol=1e-9)
    assert math.isclose(-sum(w * math.log(w) for w in weights.values()), 0.8 * math.log(len(share)), rel_tol=1e-4) and entropy(1) < 0.8 * math.log(len(share))
    got = collections.Counter()
    for x in out:
        got[x.source] += x.tokens
    assert all(abs(got[s] - weights[s] * total) < 0.06 * share[s] for s in share)
    assert all(0 <= x.position <= 1 for x in out)
    passes = collections.Counter((x.doc_id, x.epoch) for x in out)
    assert max(passes.values()) == 1
    held = mixing.mixture(df, entropy=1.0, repeats=1.5).collect()
    most = max(w * total / share[s] for s, w in {x.source: x.weight for x in held}.items())
    assert 1.49 < most <= 1.5 + 1e-6
    cover = mixing.mixture(df, entropy=1.0, repeats=1.25, cover=True).collect()
    assert {x.doc_id for x in cover} == {i for i, _, _ in rows} and max(collections.Counter(x.doc_id for x in cover).values()) <= 2


def test_mixture_counts_given(spark):
    df = spark.createDataFrame([(i, "w " * (i % 7), "a" if i % 5 else "b") for i in range(500)], "doc_id long, text string, source string")
    mixed = mixing.mixture(df, entropy=0.9).select("doc_id", "tokens", "epoch", "block", "weight").collect()
    counted = df.select("doc_id", "source", mixing.token_count(F.col("text")).alias("tokens"))
    assert sorted(mixed) == sorted(mixing.mixture(counted, entropy=0.9, counted="tokens").select("doc_id", "tokens", "epoch", "block", "weight").collect())
    clash = df.withColumns({c: F.lit(c) for c in ("blocks", "passes", "n", "end", "_source", "_hash", "total")})
    out = mixing.mixture(clash, entropy=0.9)
    assert {(r.blocks, r.passes, r.n, r["_source"], r.total) for r in out.collect()} == {("blocks", "passes", "n", "_source", "total")}


def test_mixture_odd_rows(odd, empty):
    out = mixing.mixture(odd, entropy=1.0, repeats=1.25, cover=True)
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in odd.collect()}
    assert mixing.mixture(empty).count() == 0
    assert mixing.mixture(odd.where("doc_id < 2")).count() == 2


# --- 9 ---


def check_links(spark, vectors, block=None):
    rows = [(i, v, lab) for i, (v, lab) in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({"sig": F.lit(1), "rep": F.lit(2), "n": F.lit(3)})
    got = {r.vec_id: r for r in embeddings.near_duplicates(df).collect()}
    unit = {}
    for i, v, lab in rows:
        x = np.array(v if v and all(c is not None for c in v) else [], np.float32).astype(float)
        if lab is not None and len(x) and np.isfinite(x).all() and x.any():
            unit[i] = x / np.linalg.norm(x), lab
    links = [(a, b) for a in unit for b in unit if a < b and unit[a][1] == unit[b][1] and len(unit[a][0]) == len(unit[b][0]) and unit[a][0] @ unit[b][0] >= 0.93]
    n = collections.Counter(x for p in links for x in p)
    group = joined(links, range(len(rows)))
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in got.items()} == {i: (n[i], group[i], group[i] == i) for i in range(len(rows))}
    return len(links)


def test_embedding_links(spark, monkeypatch):
    r = np.random.default_rng(9)
    vectors = []
    for c in range(40):
        centre = r.normal(size=24)
        vectors += [((centre + 0.12 * r.normal(size=24)).tolist(), c % 3) for _ in range(r.integers(1, 12))]
    centre = r.normal(size=24)
    vectors += [((centre + 0.1 * r.normal(size=24)).tolist(), 1) for _ in range(150)] + [(centre.tolist(), 1)] * 20 + [((3 * centre).tolist(), 1), (centre.tolist(), None), (centre.tolist(), 2)]
    assert check_links(spark, vectors) > 1000
    monkeypatch.setattr(embeddings, "BLOCK", 16)  # large buckets are cut into blocks
    check_links(spark, vectors)


def test_embedding_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(None, 1), ([], 1), ([0.0, 0.0], 1), ([1.0, None], 1), ([nan, 1.0], 1), ([inf, 1.0], 1), ([1.0], 1), ([2.0], 1), ([-1.0], 1), ([1.0, 0.1], 1), ([1.0, 0.12], 1), ([1e-30, 1e-31], 1), ([3e38, 3e37], 1), ([1.0, 0.1, 0.0], 1)]
    check_links(spark, vectors)
    df = spark.createDataFrame([(None, [1.0], 1), (1, [1.0], 1)], "vec_id long, embedding array<float>, label int")
    assert sorted((r.vec_id or 0, r.n_links) for r in embeddings.near_duplicates(df).collect()) == [(0, 0), (1, 0)]
    assert embeddings.near_duplicates(df.where("false")).count() == 0


@pytest.mark.parametrize("label", ["bigint", "string", "double"])
def test_embeddings_of_any_label_and_width(spark, label):
    """Double components, far apart in size; several widths at once; labels of other types."""
    r = np.random.default_rng(6)
    rows, vectors = [], []
    for dim in (3, 16, 40):
        for c in range(12):
            centre = r.normal(size=dim)
            for _ in range(6):
                v = (centre + 0.2 * r.normal(size=dim)) * 10.0 ** r.integers(-200, 200)
                vectors.append((v, c % 2, dim))
    rows = [(i, v.tolist(), lab) for i, (v, lab, _) in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("label", F.col("label").cast(label))
    unit = [v / np.abs(v).max() for v, _, _ in vectors]
    unit = [u / np.linalg.norm(u) for u in unit]
    links = [(a, b) for a in range(len(rows)) for b in range(a + 1, len(rows)) if vectors[a][1:] == vectors[b][1:] and unit[a] @ unit[b] >= 0.93]
    group, n = joined(links, range(len(rows))), collections.Counter(x for p in links for x in p)
    got = {x.vec_id: (x.n_links, x.component_id) for x in embeddings.near_duplicates(df).collect()}
    assert len(links) > 100 and got == {i: (n[i], group[i]) for i in range(len(rows))}


def test_pairs_at_the_threshold_are_compared_in_double(spark):
    """Pairs whose cosine is the threshold up to 1e-7, on either side."""
    r = np.random.default_rng(8)
    rows, links = [], 0
    for k in range(60):
        x = r.normal(size=32)
        x /= np.linalg.norm(x)
        y = r.normal(size=32)
        y -= (x @ y) * x
        y /= np.linalg.norm(y)
        c = 0.93 + (1e-7 if k % 2 else -1e-7)
        rows += [(2 * k, x.tolist(), k), (2 * k + 1, (c * x + math.sqrt(1 - c * c) * y).tolist(), k)]
        links += k % 2
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).where("n_links > 0").collect()
    assert {r.vec_id // 2 for r in got} == {k for k in range(60) if k % 2} and len(got) == 2 * links


def test_more_hashes_find_as_much():
    tables, hashes = embeddings.plan(3_000_000, 32, 0.93)
    assert hashes > 1
    r = np.random.default_rng(4)
    x = r.normal(size=(1000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = r.normal(size=x.shape)
    y -= (x * y).sum(1)[:, None] * x
    y /= np.linalg.norm(y, axis=1)[:, None]
    y = 0.93 * x + math.sqrt(1 - 0.93**2) * y
    hit = embeddings.meets(embeddings.signatures(x, tables, hashes, 2), embeddings.signatures(y, tables, hashes, 2)).any(1).mean()
    assert hit >= 0.98


def test_hadamard():
    x = np.eye(8)
    h = embeddings.hadamard(x)
    assert np.allclose(h @ h.T, np.eye(8)) and np.allclose(np.abs(h), 1 / math.sqrt(8))


# --- 10 ---


def test_media_round_trip(spark, odd):
    r = random.Random(10)
    sizes = [1, 64, 1023, 1024, 1025, 8192, 8193, 16 * 1024, 16 * 1024 + 1, 200_001]
    rows = [(i, r.randbytes(n)) for i, n in enumerate(sizes)] + [(98, b""), (99, None)]
    df = spark.createDataFrame(rows, "id long, payload binary").withColumn("codec", F.lit("mine"))
    got = {x.id: x for x in media.inspect(media.pack(df), payload=True).collect()}
    for i, raw in rows[:-2]:
        x = got[i]
        frames = -(-len(raw) // media.FRAME)
        assert bytes(x.payload) == raw and (x.codec, x.timescale, x.duration, x.n_samples) == ("raw ", 8000, len(raw), frames)
        keys = [raw[k * media.FRAME : (k + 1) * media.FRAME] for k in range(0, frames, media.KEY_EVERY)]
        assert [bytes(x.media[a:b]) for a, b in zip(x.key_begins, x.key_ends)] == keys
    assert got[98].media is None and got[99].codec is None
    cut = spark.createDataFrame([(b"junk",), (media.container(b"abc")[:-9],), (b"",)], "media binary")
    assert {x.codec for x in media.inspect(cut).collect()} == {None}
    assert media.inspect(media.pack(df.where("false"))).count() == 0


def test_forged_containers_give_nulls(spark):
    """Deep nests, and tables that tell of more than there is."""
    good = media.container(bytes(range(256)) * 20)

    def forged(kind, at, value):
        i = good.index(kind) + 4 + at
        return good[:i] + value + good[i + 4 :]

    most = b"\xff\xff\xff\xff"
    nest = b"".join((8 * (1500 - i)).to_bytes(4, "big") + b"moov" for i in range(1500))
    bad = [nest, forged(b"stsz", 8, most), forged(b"stsc", 12, most), forged(b"stsc", 8, most), forged(b"stco", 4, most), forged(b"stco", 8, most), forged(b"stss", 4, most), forged(b"stss", 8, bytes(4)), forged(b"stts", 4, bytes(4))[:-1], b"\0" * 64]
    bad += [forged(b"stsz", 4, most), forged(b"moov", -8, bytes(4)), b"\0\0\0\1moov" + b"\xff" * 8, b"\0\0\0\0moov"]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate([*bad, good])], "id int, media binary")
    got = {r.id: r for r in media.inspect(rows, payload=True).collect()}
    assert all(got[i].n_samples is None and got[i].payload is None for i in range(len(bad)) if i != 11), {i: got[i] for i in range(len(bad)) if got[i].n_samples is not None}
    assert bytes(got[len(bad)].payload) == bytes(range(256)) * 20


def test_media_query_by_brute_force(spark, sf_dir, tmp_path):
    texts = [r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()] + [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "x" * 64), (10**6 + 3, "é" * 70_000), (10**6 + 4, "x" * 64)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in media.op10_media(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for i, t in texts:
        raw = (t or "").encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        stored = media.container(payload)
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert (r.tail_crc32, r.media_bytes, r.media_sha256) == (zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest())
        frames = [(k * media.FRAME, min(len(payload), (k + 1) * media.FRAME)) for k in range(-(-len(payload) // media.FRAME))]
        assert all(stored[stored.index(b"mdat") + 4 :][a:b] == payload[a:b] for a, b in frames)
        assert r.feature.startswith(f"codec=raw;timescale=8000;duration={len(payload)};n_samples={len(frames)};keys=")
        keys = [tuple(map(int, x.split("-"))) for x in r.feature.split("keys=")[1].split(",")]
        assert [stored[a:b] for a, b in keys] == [payload[a:b] for a, b in frames[:: media.KEY_EVERY]]
    assert got[10**6 + 2].feature == got[10**6 + 4].feature


def test_boxes_are_walked():
    made = media.container(bytes(70_000))
    paths = [p for p, _, _ in media.boxes(memoryview(made), 0, len(made))]
    assert paths[:3] == [b"/ftyp", b"/mdat", b"/moov"]
    assert b"/moov/trak/mdia/minf/stbl/stsc" in paths
    large = b"\0\0\0\1free" + (20).to_bytes(8, "big") + b"abcd" + made
    assert [p for p, _, _ in media.boxes(memoryview(large), 0, len(large))][0] == b"/free"


def test_written_tables_are_released(spark):
    from pathlib import Path

    from tidewatch.llm._store import release, shared_dir

    table = written(spark.range(3).toDF("id"), "three")
    assert table.count() == 3 and any(Path(shared_dir(spark)).iterdir())
    release(spark)
    assert not Path(shared_dir(spark)).exists()
