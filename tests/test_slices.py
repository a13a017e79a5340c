"""Numbers and carried values in slices: the same as one window gives, and no task has all rows of a key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.operators import diff, index, series, slices, state
from tidewatch.streaming import ticks as streams


@pytest.fixture
def many(spark, monkeypatch):
    """Keys are cut from 500 rows on; eight shuffle partitions that aren't put together."""
    monkeypatch.setattr(slices, "SLICE_ROWS", 500)
    own = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def one_key(r, n=4000):
    """Nearly all rows of one key, some of others, null keys, ties in time."""
    return [("hot" if r.random() < 0.9 else r.choice(["a", "b", None]), i // 3, i, r.choice([None, None, 1, 2, 3])) for i in range(n)]


def test_numbers_follow_the_order(many):
    rows = [(i * 7919 % 3001, i % 5) for i in range(3001)]
    df = many.createDataFrame(rows, "k int, x int").repartition(5)
    got = slices.numbered(df, ["x", "k"]).collect()
    assert [(r.x, r.k) for r in sorted(got, key=lambda r: r.id)] == sorted((x, k) for k, x in rows)
    assert sorted(r.id for r in got) == list(range(1, 3002))
    assert slices.numbered(df.where("false"), ["k"]).count() == 0
    assert [r.n for r in slices.numbered(many.createDataFrame([(None,), (2,), (None,)], "k int"), ["k"], "n", 0).orderBy("n").collect()] == [0, 1, 2]


def test_numbering_has_no_single_task(many):
    plan = slices.numbered(many.range(1000), ["id"], "no")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_slices_are_small_whatever_the_key(many):
    rows = many.createDataFrame(one_key(random.Random(1)), "k string, t int, i int, v int")
    cut = slices.sliced(rows, ["k"], "t")
    sizes = {(r.k, r[slices.SLICE]): r["count"] for r in cut.rows.groupBy(*cut.by_slice()).count().collect()}
    assert cut.cut == 1 and {s for k, s in sizes if k != "hot"} == {-1}
    assert sum(k == "hot" for k, _ in sizes) > 8 and max(sizes.values()) <= 500


def test_keys_that_are_small_are_shuffled_once(many):
    rows = many.createDataFrame([(i % 90, i, i) for i in range(900)], "k int, t int, v int")
    assert slices.sliced(rows, ["k"], "t").cut == 0
    plan = series.filled(rows, ["k"], ["t"], "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


@pytest.mark.parametrize("seed", [1, 2])
def test_fill_is_that_of_one_window(many, seed):
    rows = many.createDataFrame(one_key(random.Random(seed)), "k string, t int, i int, v int").withColumn("v", F.when(F.col("i") % 50 == 0, F.col("v")))
    w = Window.partitionBy("k").orderBy("t", "i").rowsBetween(Window.unboundedPreceding, 0)
    want = rows.withColumn("filled", F.last("v", ignorenulls=True).over(w))
    got = series.filled(rows, ["k"], ["t", "i"], "v")
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))


def test_changes_are_those_of_one_window(many):
    rows = many.createDataFrame(one_key(random.Random(3)), "k string, t int, i int, v int")
    w = Window.partitionBy("k").orderBy("t", "i")
    want = rows.where("true").withColumn("keep", (F.row_number().over(w) == 1) | ~F.col("v").eqNullSafe(F.lag("v").over(w))).where("keep").drop("keep")
    got = diff.change_log(rows, ["k"], ["v"], "t", "i")
    assert got.columns == rows.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_next_times_are_strictly_later(many):
    r = random.Random(4)
    left = [(k, t, i) for k, t, i, _ in one_key(r, 1500)]
    right = [(k, t * 3) for k, t, _, _ in one_key(r, 300)] + [("a", 5)]
    got = index.asof_forward(many.createDataFrame(left, "k string, ts int, i int"), many.createDataFrame(right, "k string, ts int"), ["k"])
    want = {i: min((s for q, s in right if q == k and s > t), default=None) for k, t, i in left}
    assert {x.i: x.next_ts for x in got.collect()} == {i: n for i, n in want.items() if n is not None}


@pytest.mark.parametrize("chunk", [7, 1000])
def test_fold_of_one_hot_key(many, monkeypatch, chunk):
    monkeypatch.setattr(state, "CHUNK", chunk)
    r = random.Random(5)
    capacities = list(state.FALLBACK)
    for quiet in (False, True):  # quiet: so few scores that they are carried over several slices
        rows = [("hot" if r.random() < 0.9 else f"k{r.randrange(3)}", i, r.choice([None, -1, 1, 2, 3]) if not quiet or i % 400 == 0 else None, r.choice(capacities)) for i in range(3000)]
        got = {x.k: (x.sps, x.t3, x.t2) for x in state.capacity_fold(many.createDataFrame(rows, "k string, i int, score int, capacity int"), ["k"], ["i"]).collect()}
        want = {}
        for k, _, s, c in rows:
            want[k] = streams.stepped(s, c, want.get(k, (None, 0, 0)))
        assert got == want


def test_many_cut_keys_are_joined(many, monkeypatch):
    monkeypatch.setattr(slices, "FEW", 0)
    rows = many.createDataFrame(one_key(random.Random(6)), "k string, t int, i int, v int")
    w = Window.partitionBy("k").orderBy("t", "i").rowsBetween(Window.unboundedPreceding, 0)
    want = rows.withColumn("filled", F.last("v", ignorenulls=True).over(w))
    got = series.filled(rows, ["k"], ["t", "i"], "v")
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))


def test_late_ticks_are_folded_in(many):
    r = random.Random(8)
    capacities = list(state.FALLBACK)
    rows = [("hot" if r.random() < 0.6 else f"k{r.randrange(8)}", i, r.choice([None, -1, 1, 2, 3]), r.choice(capacities)) for i in range(2500)]
    df = many.createDataFrame(rows, "k string, i int, score int, capacity int")
    late = F.col("k").isin("hot", "k1") & ((F.col("i") % 60 == 0) | (F.col("i") >= 2480)) & (F.col("i") >= 1000)
    early, since = df.where("i < 1000"), df.where((F.col("i") >= 1000) & ~late)
    before = state.capacity_fold(early, ["k"], ["i"])
    after = state.capacity_fold(since, ["k"], ["i"], initial=before)
    whole = lambda d: sorted(map(tuple, state.capacity_fold(d, ["k"], ["i"]).collect()))
    assert sorted(map(tuple, after.collect())) == whole(df.where(~late))
    got = state.backfilled(before, after, since, df.where(late), ["k"], ["i"])
    assert sorted(map(tuple, got.collect())) == whole(df) != whole(df.where(~late))
