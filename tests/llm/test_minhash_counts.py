"""Near copies whose lines repeat a different number of times, by brute force."""

import random

import numpy as np

from tidewatch.llm import minhash


def shingle_set(text):
    w = text.split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def test_repeated_lines_are_found(spark):
    r = random.Random(11)
    rows, pairs = [], 150
    for i in range(pairs):
        lines = [" ".join(f"w{r.randrange(10**6)}" for _ in range(30)) for _ in range(10)]
        often = set(r.sample(range(10), 5))
        other = [x for k, x in enumerate(lines) for _ in range(30 if k in often else 1)]
        for k in r.sample(range(len(lines)), 2):
            other[other.index(lines[k])] += f" e{i}"
        rows += [(2 * i, " ".join(lines)), (2 * i + 1, " ".join(other))]
    for (_, a), (_, b) in zip(rows[::2], rows[1::2]):
        a, b = shingle_set(a), shingle_set(b)
        assert len(a & b) >= 0.8 * len(a | b)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x.doc_id: x.class_id for x in got} == {i: i - i % 2 for i in range(2 * pairs)}


def test_misses_are_bounded():
    w = minhash.weights(np.array([1, 2, 10, 10**6]))
    least = minhash.THRESHOLD * w.min() / w.max()
    assert (np.diff(w) > 0).all()
    assert (1 - least**minhash.ROWS) ** minhash.BANDS <= 1 / 1500
