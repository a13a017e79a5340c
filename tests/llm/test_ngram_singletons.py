"""Bigrams that training has once count."""

import numpy as np
import pyarrow as pa
import pytest

from tidewatch.llm import ngram_score
from tidewatch.llm._text import utf8


@pytest.fixture(scope="module")
def model(spark):
    return ngram_score.Model(spark.createDataFrame([(t,) for t in texts()], "text string"))


def texts():
    return [" ".join(f"w{20 * i + k}" for k in range(20)) for i in range(300)]


def test_filter_has_bigrams_seen_once(model):
    _, h, before = ngram_score.tokens(*utf8(pa.array(texts())))
    rows = model.rest(ngram_score.BIGRAM).collect()
    low = ngram_score.Filter(model.segments, 1, [(r.segment, r.sizes, [bytes(b) for b in r.bits]) for r in rows])
    assert (low.levels(*ngram_score.placed(ngram_score.bigram_key(before, h), model.segments)) > 0).all()
    assert np.isclose(model.counts[ngram_score.BIGRAM][1], 1)


@pytest.mark.parametrize("near_bytes", [ngram_score.NEAR_BYTES, 0])
def test_order_of_words_seen_once_matters(spark, model, near_bytes):
    rows = [(i, t) for i, t in enumerate(texts()[:20])] + [(100 + i, " ".join(reversed(t.split()))) for i, t in enumerate(texts()[:20])]
    got = {r.doc_id: r.score for r in ngram_score.score(spark.createDataFrame(rows, "doc_id long, text string"), model, near_bytes).collect()}
    assert all(got[i] > got[100 + i] + 19 for i in range(20))
