"""The pipeline: each stage on what the one before kept, checked by brute force; and the registered queries."""

import collections

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from tidewatch.llm import mixing, pieces


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        nxt = stage(spark, docs, sf_dir)
        out.append((docs, nxt))
        docs = nxt.cache()
    return out


def test_stages_keep_the_columns(stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns


def test_stages_do_what_they_say(spark, stages):
    ids = lambda df: collections.Counter(r.doc_id for r in df.select("doc_id").collect())
    first, after = stages[0]
    letters = {r.doc_id for r in first.collect() if r.text and any(c.isalpha() for c in r.text)}
    assert set(ids(after)) == letters
    deduped, cut = ids(stages[1][1]), ids(stages[2][1])
    assert set(deduped) < letters and max(deduped.values()) == 1
    assert cut == deduped
    mixed = ids(stages[3][1])
    assert set(mixed) == set(cut) and max(mixed.values()) <= 2
    want = ids(mixing.mixture(stages[3][0], entropy=1.0, repeats=1.25, cover=True))
    assert mixed == want
    last = stages[4][1].collect()
    stock = pieces.encoder(pieces.model_path()).stock
    texts = {r.doc_id: r.text for r in stages[3][1].collect()}
    assert len(last) == sum(mixed.values())
    assert all(r.ids == stock.encode(texts[r.doc_id], add_eos=True) and r.n_tokens == len(r.ids) for r in last)


def test_run_is_the_stages(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir)
    want = stages[-1][1]
    key = lambda r: (r.doc_id, r.n_tokens)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


def test_queries_are_registered(spark, sf_dir):
    names = entry_points.queries()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names


@pytest.mark.parametrize(("prefix", "columns"), [
    ("op1_", {"doc_id", "class_id", "kept"}), ("op2_", {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"}),
    ("op3_", {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}), ("op4_", {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"}),
    ("op5_", {"doc_id", "first_doc_id"}), ("op6_", {"doc_id", "held_out", "lang_pred", "score"}),
    ("op7_", {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}), ("op8_", {"doc_id", "source", "epoch"}),
    ("op9_", {"vec_id", "n_links", "component_id", "kept"}),
    ("op10_", {"doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"}),
])
def test_query_runs(spark, sf_dir, prefix, columns):
    name = next(q for q in entry_points.queries() if q.startswith(prefix))
    df = entry_points.queries()[name](spark, sf_dir)
    assert columns <= set(df.columns)
    assert df.count() > 0
