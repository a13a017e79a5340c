"""What the sample of a language has."""

import numpy as np

from tidewatch.llm import language


def sampled(monkeypatch, df):
    seen = []
    monkeypatch.setattr(language, "automaton", lambda s: seen.append(s))
    language.fit(df)
    return seen


def test_sample_has_a_share_of_each_drawn_text(spark, monkeypatch):
    rows = [(i, chr(97 + i // 10) * 600, "xx") for i in range(260)]
    (sample,) = sampled(monkeypatch, spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert np.count_nonzero(sample == 0) == language.SAMPLE_DOCS
    assert len(sample) <= language.SAMPLE_SYMBOLS and len(sample) > 0.99 * language.SAMPLE_SYMBOLS
    one = np.frombuffer(b"z", np.uint8)
    assert language.symbols(one, np.array([0, 1]))[0][0] in sample


def test_labelled_rows_without_id(spark, monkeypatch):
    rows = [(None, "abcabc", "xx"), (1, "def", "xx"), (None, "ghi", "yy")]
    samples = sampled(monkeypatch, spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert [np.count_nonzero(s == 0) for s in samples] == [2, 1]
