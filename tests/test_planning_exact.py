"""Packing in bounded time, and triples by rank, against plain search."""

import collections
import itertools
import random
import time

import pytest

from tidewatch.operators import planner


def least(weights):
    """Fewest bins by trying all rooms for each weight, largest first."""
    order = sorted((w for w in weights if w), reverse=True)
    best = [len(order)]

    def search(k, rooms):
        if len(rooms) + max(0, -(-(sum(order[k:]) - sum(rooms)) // 10)) >= best[0]:
            return
        if k == len(order):
            best[0] = len(rooms)
            return
        for r in sorted(set(rooms)):
            if r >= order[k]:
                at = rooms.index(r)
                search(k + 1, [*rooms[:at], r - order[k], *rooms[at + 1 :]])
        search(k + 1, [*rooms, 10 - order[k]])

    search(0, [])
    return best[0]


def used(weights):
    load = collections.Counter()
    bins = planner.packed(weights)
    for w, b in zip(weights, bins, strict=True):
        load[b] += w
    assert all(v <= 10 for v in load.values())
    return len({b for w, b in zip(weights, bins, strict=True) if w})


def test_packing_is_least_for_all_small_multisets():
    for n in range(0, 6):
        for weights in itertools.combinations_with_replacement(range(1, 11), n):
            assert used(list(weights)) == least(weights), weights


def test_packing_is_least_at_random():
    r = random.Random(11)
    for k in range(600):
        kinds = r.sample(range(1, 10), r.randrange(1, 6))
        weights = r.choices(kinds, k=r.randrange(1, 13))
        assert used(weights) == least(weights), weights


@pytest.mark.parametrize("weight", range(1, 11))
def test_equal_weights_take_no_time(weight):
    began = time.time()
    for n in (26, 40, 4000):
        assert used([weight] * n) == -(-n // (10 // weight))
    assert time.time() - began < 1


def test_many_weights_take_no_time():
    r = random.Random(3)
    began = time.time()
    weights = r.choices(range(0, 11), k=5000)
    assert used(weights) >= -(-sum(weights) // 10)
    assert time.time() - began < 2
    assert planner.packed([11]) is None and planner.packed([]) == [] and planner.packed([0, 0]) == [0, 0]


def of(spark, rows):
    return spark.createDataFrame(rows, "InstanceType string, AZ string, SPS int")


def triples_of(rows):
    by = collections.defaultdict(list)
    for t, z, s in rows:
        by[z].append((t, s))
    return [(z, *(t for t, _ in sorted(three)), sum(s for _, s in three)) for z, own in by.items() for three in itertools.combinations(own, 3)]


def test_counts_and_all_triples(spark):
    r = random.Random(2)
    rows = [(f"t{i:02d}", f"z{j}", r.randrange(1, 4)) for j in range(3) for i in r.sample(range(14), 9)]
    whole = triples_of(rows)
    got = collections.Counter()
    for x in planner.triple_counts(of(spark, rows), [3, 5, 6, 8, 9]).collect():
        got[x.AZ, x.total] += x.n
    assert got == collections.Counter((z, total) for z, *_, total in whole if total in (3, 5, 6, 8, 9))
    # more are asked for than there are: each once, in a zone that has it
    out = [tuple(x) for x in planner.stratified_triples(of(spark, rows), [5, 6, 8], most=10_000).collect()]
    assert {x[1:] for x in out} == {x[1:] for x in whole if x[4] in (5, 6, 8)}
    assert len({x[1:] for x in out}) == len(out) and set(out) <= set(whole)


def test_triples_are_drawn_alike(spark):
    rows = [(f"t{i:02d}", "z", 1 + i % 3) for i in range(60)]
    out = [tuple(x) for x in planner.stratified_triples(of(spark, rows), [6], most=1500).collect()]
    assert len(set(out)) == 1500 and set(out) <= set(triples_of(rows))
    # 1+2+3: 8000 triples, 2+2+2: 1140; types of a score are drawn alike
    mixed = sum(len({1 + int(t[1:]) % 3 for t in x[1:4]}) == 3 for x in out)
    assert abs(mixed - 1500 * 8000 / 9140) < 5 * (1500 * 0.875 * 0.125) ** 0.5
    seen = collections.Counter(t for x in out for t in x[1:4])
    for score in (1, 2, 3):
        n = [seen[f"t{i:02d}"] for i in range(60) if 1 + i % 3 == score]
        mean = sum(n) / 20
        assert sum((x - mean) ** 2 / mean for x in n) < 50  # 19 degrees of freedom


def test_same_types_in_many_zones(spark):
    rows = [(f"t{i}", f"z{j}", 3) for i in range(6) for j in range(40)]
    out = planner.stratified_triples(of(spark, rows), [9, 4], most=15).collect()
    assert len({(x.a, x.b, x.c) for x in out}) == len(out) == 15
    assert planner.stratified_triples(of(spark, rows[:0]), [9]).count() == 0
    assert planner.stratified_triples(of(spark, [("a", "z", 1), ("a", "z", 2), (None, "z", 1)]), [3]).count() == 0


def test_cover_of_many_blocks_is_near_that_of_one(spark, monkeypatch):
    """Types go together in groups that have little to do with the names of regions and types."""
    r = random.Random(6)
    groups = [(r.sample(range(160), 14), r.sample(range(60), 9)) for _ in range(12)]
    pairs = sorted({(f"r{x:03d}", f"t{y:02d}") for a, b in groups for x in a for y in b if r.random() < 0.9})
    one = len(list(planner.greedy_cover(set(pairs))))
    monkeypatch.setattr(planner, "TASK_REGIONS", 32)
    monkeypatch.setattr(planner, "TASK_TYPES", 20)
    rows = planner.covering_requests(spark.createDataFrame(pairs, "RegionCode string, InstanceType string")).collect()
    assert all(len(x.regions) <= 8 and len(x.types) <= 5 for x in rows)
    assert set(pairs) <= {(x, y) for q in rows for x in q.regions for y in q.types}
    monkeypatch.setattr(planner, "GAINS", (1,))
    apart = planner.covering_requests(spark.createDataFrame(pairs, "RegionCode string, InstanceType string")).count()
    print(one, len(rows), apart)
    assert len(rows) <= 1.5 * one and len(rows) < apart
