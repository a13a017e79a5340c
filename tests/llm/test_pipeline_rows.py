"""Every stage of the pipeline against brute force, on rows that are null, empty, repeated, very long, near copies and passages."""

import collections
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import pieces

CLASH = ("score", "lang_pred", "held_out", "tokens", "block", "epoch", "position", "weight", "_key", "_hash", "_cut", "ids", "blocks", "Score2")


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(12)
    text = lambda n: " ".join("".join(r.choices("abcdefghij", k=r.randrange(2, 9))) for _ in range(n))
    shared, a, b = text(55), text(120), text(90)
    rows = [(None, None), (1, None), (2, ""), (3, "  "), (4, "12 !!"), (5, "one"), (5, "one"), (6, "ONE"), (None, text(30)), (None, text(30))]
    rows += [(10, a), (11, a + " end"), (12, a), (13, b), (13, b + " more"), (14, text(4) + " " + shared + " " + text(6)), (15, text(40) + "  " + shared.upper() + "\n" + text(8))]
    rows += [(16, text(30_000)), (17, "né " * 80), (18, text(70))]
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    full = [(i, t, None if k % 3 else "en", None if k % 4 else "big", None) for k, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(full, kinds)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASH})


@pytest.fixture(scope="module")
def stages(spark, docs, sf_dir):
    out, now = [], docs
    for _, stage in corpus_pipeline.STAGES:
        nxt = stage(spark, now, sf_dir).cache()
        out.append((now.collect(), nxt.collect(), nxt.columns))
        now = nxt
    return out


def test_columns_are_kept(docs, stages):
    for _, after, columns in stages[:-1]:
        assert columns == docs.columns
        assert all(r[c] == f"own {c}" for r in after for c in CLASH)


def test_language_id(stages):
    before, after, _ = stages[0]
    want = collections.Counter((r.doc_id, r.text) for r in before if r.text and any(c.isalpha() for c in r.text))
    assert collections.Counter((r.doc_id, r.text) for r in after) == want
    assert all(r.lang for r in after)


def grams(text, n):
    w = (text or "").lower().split()
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def test_near_dedup(stages):
    before, after, _ = stages[1]
    rows = [(r.doc_id, r.text, grams(r.text, 5)) for r in before]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            x, y = rows[i][2], rows[j][2]
            if len(x & y) >= 0.8 * len(x | y):
                up[find(i)] = find(j)
    classes = collections.defaultdict(list)
    for i, r in enumerate(rows):
        classes[find(i)].append(r)
    kept = [min(c, key=lambda r: (r[0] is not None, r[0] or 0)) for c in classes.values()]
    assert len(after) == len(kept)
    assert sorted((r.doc_id or 0) for r in after) == sorted((k[0] or 0) for k in kept)
    texts = {t for _, t, _ in rows}
    assert all(r.text in texts for r in after)


def test_substring_dedup(stages):
    before, after, _ = stages[2]
    assert sorted((r.doc_id or 0) for r in before) == sorted((r.doc_id or 0) for r in after)
    whole, left = {r.doc_id: r.text for r in before}, {r.doc_id: r.text for r in after}
    seen = collections.Counter(g for r in after if len(r.text.split()) > 50 for g in grams(r.text, 51))
    assert max(seen.values(), default=0) <= 1
    changed = {i for i in whole if i is not None and whole[i] != left[i]}
    assert 15 in changed and 14 not in changed and 18 not in changed
    assert len(left[15].split()) == 48


def test_source_mixing(stages):
    before, after, _ = stages[3]
    want, got = (collections.Counter((r.doc_id, r.text) for r in x) for x in (before, after))
    assert set(want) == set(got) and all(want[k] <= got[k] <= 2 * want[k] for k in want)


def test_sentencepiece(stages):
    before, after, _ = stages[4]
    stock = pieces.encoder(pieces.model_path()).stock
    want = collections.Counter(tuple(stock.encode(r.text or "", add_eos=True)) for r in before)
    assert collections.Counter(tuple(r.ids) for r in after) == want


def test_empty_table(spark, docs, sf_dir):
    now = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf_dir)
        assert now.count() == 0
