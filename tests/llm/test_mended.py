"""Cases that earlier versions got wrong: words whose polynomial hashes are equal, labels that share hash bits, long reaches."""

import collections
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import embeddings, minhash, mixing, ngram_score, pieces, substrings
from tidewatch.llm._store import written
from tidewatch.llm._text import hashed, runs_hashed, utf8, words


def thue_morse(n, letters="ab"):
    return "".join(letters[i.bit_count() % 2] for i in range(n))


ONE, TWO = thue_morse(2048), thue_morse(2048, "ba")


def test_hashes_tell_words_apart():
    texts = [thue_morse(n, x) for n in (1, 63, 64, 65, 128, 1024, 2048, 1 << 15) for x in ("ab", "ba")] + ["a" * n for n in range(1, 300)]
    data, offsets = utf8(pa.array([" ".join(texts)]))
    h = words(data, offsets)[3]
    assert len(set(h.tolist())) == len(set(texts))
    data, offsets = utf8(pa.array(texts + [t + " x" for t in texts]))
    row, _, _, h = words(data, offsets)
    assert [h[row == i][0] for i in range(len(texts))] == [h[row == i + len(texts)][0] for i in range(len(texts))]
    pair = np.array([3, 5], np.uint64)
    runs = np.concatenate([pair[[i.bit_count() % 2 for i in range(1024)]], pair[[1 - i.bit_count() % 2 for i in range(1024)]]])
    a, b = runs_hashed(runs, np.array([0, 1024]), np.array([1024, 1024]))
    assert a != b
    assert hashed(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)).size == 0


def test_pieces_of_such_words_are_the_library_s(spark, monkeypatch):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    text = f"{ONE} {TWO} {ONE} other {TWO}"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")

    def check():
        r = pieces.encode(df, pieces.model_path(), decoded=True).first()
        assert r.ids == [*sp.encode(text), sp.eos_id()] and r.decoded == text

    check()
    # even if all hashes are equal
    monkeypatch.setattr(pieces, "hashed", lambda data, begin, end: np.zeros(len(begin), np.uint64))
    e = pieces.Encoder(pieces.model_path())
    data, offsets = utf8(pa.array([text]))
    assert e.encode(data, offsets)[1].tolist() == [*sp.encode(text), sp.eos_id()]


def test_such_words_are_no_duplicates(spark, sf_dir):
    df = spark.createDataFrame([(1, ONE), (2, TWO), (3, "other")], "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in minhash.near_duplicates(df).collect()} == {1: 1, 2: 2, 3: 3}
    assert minhash.deduplicated(df).count() == 3
    docs = df.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, sf_dir)
    assert sorted(r.doc_id for r in docs.collect()) == [1, 2, 3]


def test_such_words_are_counted_apart(spark):
    schema = "doc_id long, text string"
    model = ngram_score.Model(spark.createDataFrame([(1, ONE), (2, "other")], schema))
    got = {r.doc_id: r for r in ngram_score.score(spark.createDataFrame([(3, TWO), (4, ONE)], schema), model).collect()}
    assert (got[3].n_known, got[4].n_known) == (1, 2)
    assert got[3].base_score < got[4].base_score


def test_classes_of_repeated_ids(spark):
    a, b = ("alpha beta gamma delta " * 9, "one two three four five six " * 9)
    rows = minhash.near_duplicates(spark.createDataFrame([(1, a), (1, b), (2, a), (3, b), (3, b), (4, ""), (None, None)], "doc_id long, text string")).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.class_hash].append(r)
    assert sorted((len(v), sum(r.kept for r in v)) for k, v in by.items() if k is not None) == [(2, 1), (3, 1)]
    assert all(r.kept for r in by[None]) and len(by[None]) == 2


def test_labels_are_compared_exactly(spark):
    """These two labels share 32 bits of their hash."""
    low = spark.createDataFrame([(155325,), (383425,)], "label long").select((F.xxhash64("label").bitwiseAND(F.lit(0xFFFFFFFF))).alias("h")).collect()
    assert low[0].h == low[1].h
    v = np.random.default_rng(1).normal(size=64).tolist()
    got = embeddings.near_duplicates(spark.createDataFrame([(1, v, 155325), (2, v, 383425), (3, v, 155325)], "vec_id long, embedding array<double>, label long"))
    assert {r.vec_id: (r.n_links, r.component_id) for r in got.collect()} == {1: (1, 1), 2: (0, 2), 3: (1, 1)}


def test_many_labels_by_brute_force(spark):
    r = np.random.default_rng(4)
    base = r.normal(size=(60, 8))
    rows = [(i, (base[i % 60] + 0.01 * r.normal(size=8)).tolist(), int(i if i >= 600 else r.integers(0, 3))) for i in range(30_000)]
    got = {x.vec_id: x.n_links for x in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)).collect()}
    x = np.array([v for _, v, _ in rows[:600]])
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([c for _, _, c in rows[:600]])
    want = (((x @ x.T) >= 0.93) & (label[:, None] == label)).sum(1) - 1
    assert [got[i] for i in range(600)] == want.tolist()
    assert not any(got[i] for i in range(600, 30_000))


def test_ends_are_moved_as_far_as_texts_agree(spark):
    """Whatever few bytes are read first, the passages are the same, and whole."""
    r = random.Random(8)
    text = lambda n: " ".join("".join(r.choices("abcdefghij", k=r.randrange(2, 9))) for _ in range(n))
    shared = [text(400), "  \n ".join(text(1) for _ in range(200)), "ab " * 300]
    rows = [(i, f"{text(20 + i)} {s} {text(15)}") for i, s in enumerate(shared * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [sorted(map(tuple, substrings.passages(docs, reach=n).select("doc_id", "begin", "end", "n_words").collect())) for n in (8, 192, 100_000)]
    assert found[0] == found[1] == found[2]
    for i, s in enumerate(shared):
        assert any(d == i + 3 and dict(rows)[d].encode()[a:b].decode().split() == s.split() for d, a, b, _ in found[0]) or i == 2


def test_rows_without_ids_fill_many_blocks(spark):
    rows = [(None, f"w{i} x", "big") for i in range(1900)] + [(None, f"v{i} x", "small") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mixture(df, entropy=1.0, repeats=4.0).collect()
    assert len({r.block for r in out if r.source == "big"}) > 40
    assert abs(sum(r.tokens for r in out) - 4000) < 4000 / 16
    same = spark.createDataFrame([(None, "same text", "big")] * 600 + [(None, "t", "small")] * 60, "doc_id long, text string, source string")
    kept = written(same.withColumn("row", F.monotonically_increasing_id()), "rows")
    blocks = {(r.source, r.block) for r in mixing.mixture(kept, row="row").collect()}
    assert len([b for b in blocks if b[0] == "big"]) > 40


def test_any_column_name_passes_the_pipeline(spark, sf_dir):
    names = ["_mix_tokens", "_mix_x", "_aside_0", "_aside_7", "_cut_text", "fp", "row_no", "class_hash", "lang_pred", "a.b"]
    rows = [(i, f"some words of text number {i} and more of it", "en", "s", 1) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").select("*", *(F.lit(c).alias(c) for c in names))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns[5:] == names
    got = docs.collect()
    assert len({r.doc_id for r in got}) == 5 and all(r[c] == c for r in got for c in names)
