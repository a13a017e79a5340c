"""Whole results of scoring, language ID and mixing against plain versions."""

import collections
import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from tidewatch.llm import language, mixing, ngram_score


def test_scores_are_those_of_exact_counts(spark, sf_dir):
    """The formula on exact counts at the means of their levels.  The filter errs one way: an n-gram counts for more with a
    chance of 2 ** -6 a probe of a level at most, so scores differ little, and where they do, mostly upwards."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = {r.doc_id: r for r in ngram_score.op2_lm_score(spark, sf_dir).collect()}
    texts = {r.doc_id: [*(r.text or "").encode().lower().split(), "end"] for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    one, two = collections.Counter(), collections.Counter()
    for i, ts in texts.items():
        if not held[i]:
            one.update(ts)
            two.update(zip(["begin", *ts], ts, strict=False))
    total, kinds, n_docs = sum(one.values()), len(one), sum(not h for h in held.values())
    level = lambda c: int(ngram_score.level(np.array([c]))[0]) if c else 0

    def means(counts):
        by = collections.defaultdict(list)
        for c in counts.values():
            by[level(c)].append(c)
        return {0: 0.0} | {q: sum(v) / len(v) for q, v in by.items()}

    u, b = means(one), means(two)

    def exact(ts):
        s = 0.0
        for before, t in zip(["begin", *ts], ts, strict=False):
            context = n_docs if before == "begin" else u[level(one[before])]
            p = ngram_score.PRIOR * (u[level(one[t])] + 0.5) / (total + 0.5 * (kinds + 1))
            s += math.log10((min(b[level(two[before, t])], context) + p) / (context + ngram_score.PRIOR))
        return s

    per_token = {i: (out[i].score - exact(ts)) / len(ts) for i, ts in texts.items()}
    tokens = sum(map(len, texts.values()))
    off = sum(d * len(texts[i]) for i, d in per_token.items()) / tokens
    assert -0.01 < off < 0.06
    long = [d for i, d in per_token.items() if len(texts[i]) > 200]
    assert len(long) > 20 and all(-0.1 < d < 0.25 for d in long)
    assert np.corrcoef([out[i].score for i in texts], [exact(ts) for ts in texts.values()])[0, 1] > 0.9999
    assert all(out[i].held_out == held[i] for i in texts)


def test_languages_are_those_of_plain_parsing(spark, sf_dir, monkeypatch):
    samples, build = [], language.automaton
    monkeypatch.setattr(language, "automaton", lambda s: samples.append(s.tobytes()) or build(s))
    got = {r.doc_id: r for r in language.op6_language_id(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()
    names = sorted({d.lang for d in docs if d.lang})
    assert len(samples) == len(names)
    checked = 0
    for d in docs:
        raw = np.frombuffer((d.text or "").encode(), np.uint8)
        if len(raw) > 6000:  # plain parsing takes the square of the time
            continue
        s = language.symbols(raw, np.array([0, len(raw)]))[0].tobytes()
        costs = []
        for sample in samples:
            n, i = 1, 0
            for j in range(len(s)):
                if s[i : j + 1] not in sample:
                    n += 1
                    i = j if s[j : j + 1] in sample else j + 1
            costs.append(n * math.log2(len(sample) + 1) / max(1, len(s)))
        if not any(c.isalpha() for c in d.text or ""):
            assert (got[d.doc_id].lang_pred, got[d.doc_id].score) == ("und", 0)
            continue
        best, second = sorted(costs)[:2]
        assert got[d.doc_id].lang_pred == names[costs.index(best)]
        assert math.isclose(got[d.doc_id].score, 1 - best / max(second, 1e-9), abs_tol=1e-9)
        checked += 1
    assert checked > 100


def test_blocks_are_those_of_the_plan(spark):
    """Which blocks of which source come in which pass, from weights and hashes; several blocks of one hash order included."""
    rows = [(i, (i * 37) % 50, "big" if i % 10 else f"s{i % 3}") for i in range(4000)] + [(None, 7, None), (5, 9, "big"), (9001, 0, "none")]
    df = spark.createDataFrame(rows, "doc_id long, n long, source string").withColumn("text", F.expr("repeat('w ', cast(n as int))"))
    for options in ({"entropy": 0.9, "repeats": 50.0}, {"entropy": 1.0, "repeats": 1.25, "cover": True}, {"entropy": 0.8, "repeats": 9.0, "budget": 30_000.0}):
        out = mixing.mixture(df, seed=3, **options).select("doc_id", "source", "tokens", "block", "epoch", "weight").collect()
        weight = {r.source: r.weight for r in out}
        hashes = df.select("doc_id", "source", "n", F.when(F.col("doc_id").isNotNull(), F.xxhash64(F.lit(3), "doc_id")).otherwise(F.xxhash64(F.lit(3), F.lit("text"), "text")).alias("h")).collect()
        tokens = collections.Counter()
        for r in hashes:
            tokens[r.source] += r.n
        total = sum(tokens.values())
        scale = options.get("budget", total)
        if options.get("cover"):
            scale = max(tokens[s] / weight[s] for s in tokens if tokens[s])
        turn = spark.range(64).select(F.col("id").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(60))).alias("epoch")).withColumn("h", F.xxhash64(F.lit(3), "epoch", "block")).collect()
        place = {(r.epoch, r.block): (r.h, r.block) for r in turn}
        want = collections.Counter()
        for s, n in tokens.items():
            passes = round(weight[s] * scale / n, 9) if n else 1.0
            blocks = collections.defaultdict(list)
            for r in hashes:
                if r.source == s:
                    blocks[r.h % 64].append(r)
            for epoch in range(max(1, math.ceil(passes))):
                end = 0
                for b in sorted(blocks, key=lambda b: place[epoch, b]):
                    own = sum(r.n for r in blocks[b])
                    end += own
                    middle = ((end - own / 2) / n if n else 0.5) + epoch
                    if middle <= passes or passes >= epoch + 1:
                        want.update((r.doc_id, s, r.n, b, epoch) for r in blocks[b])
        assert collections.Counter((r.doc_id, r.source, r.tokens, r.block, r.epoch) for r in out) == want


def test_many_sources_are_weighed_alike(spark, monkeypatch):
    rows = [(i, (i * 37) % 50, f"s{i % 7 if i % 3 else 0}") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, n long, source string")
    few = {(r.doc_id, r.epoch): (r.block, round(r.weight, 12)) for r in mixing.mixture(df, entropy=0.95, repeats=3.0, counted="n").collect()}
    monkeypatch.setattr(mixing, "FEW_SOURCES", 0)
    many = {(r.doc_id, r.epoch): (r.block, round(r.weight, 12)) for r in mixing.mixture(df, entropy=0.95, repeats=3.0, counted="n").collect()}
    assert few == many
