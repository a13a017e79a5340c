"""Small cases worked out by hand, and invariants on random ones."""

import json
from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.functions import scalars as S
from tidewatch.operators import diff, index, merge, planner, query, series, state
from tidewatch.sources import readers, sinks
from tidewatch.sources.rest import register
from tidewatch.streaming import ticks as streams


def one(spark, column, **values):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())).select(column).first()[0]


@pytest.mark.parametrize(
    ("cap", "sps", "prev", "want"),
    [(1, 3, None, (3, 1, 0)), (5, 3, (3, 1, 0), (3, 5, 0)), (10, 1, (3, 5, 0), (3, 5, 0)), (5, 2, (3, 50, 0), (3, 1, 5)), (1, 2, (3, 50, 5), (2, 0, 5)),
     (50, 3, (1, 0, 0), (3, 50, 0)), (20, -1, (3, 30, 10), (3, 15, 10)), (1, 1, (3, 30, 10), (1, 0, 0)), (45, 1, (2, 0, 40), (2, 0, 40)),
     # without a score: a single node counts with the one before, several nodes have failed
     (1, None, (3, 30, 10), (3, 30, 10)), (1, None, (2, 0, 10), (2, 0, 10)), (1, None, (1, 0, 0), (1, 0, 0)), (1, None, None, (None, 0, 0)), (10, None, (3, 30, 10), (3, 5, 5)), (10, None, None, (None, 0, 0))],
)
def test_capacity_step(spark, cap, sps, prev, want):
    cur = spark.createDataFrame([("a", sps, cap)], "k string, SPS int, TargetCapacity int")
    t3, t2 = state.tick_levels(F.col("SPS"), F.col("TargetCapacity"))
    cur = cur.withColumns({"T3": t3, "T2": t2})
    before = spark.createDataFrame([("a", *prev)] if prev else [], "k string, SPS int, T3 int, T2 int")
    assert tuple(state.capacity_step(before, cur, ["k"]).select("SPS", "T3", "T2").first()) == want
    assert streams.stepped(sps, cap, prev or (None, 0, 0)) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([None, -1, 1, 2, 3]), st.sampled_from(S.CAPACITIES)), max_size=30))
def test_fold_invariants(ticks):
    now = (None, 0, 0)
    for s, c in ticks:
        now = streams.stepped(s, c, now)
        kept, t3, t2 = now
        assert 0 <= t3 <= 50 and 0 <= t2 <= 50
        assert t3 == 0 or kept >= 3
        assert not (c == 1 and s is not None and s <= 2 and t3)


@pytest.mark.parametrize("chunk", [3, 1000])
def test_folds_of_batch_and_stream_agree(spark, monkeypatch, chunk):
    import random

    monkeypatch.setattr(state, "CHUNK", chunk)

    r = random.Random(4)
    rows = [(k, i, r.choice([None, -1, 1, 2, 3]), r.choice(S.CAPACITIES)) for k in range(40) for i in range(r.randrange(1, 30))]
    got = {x.k: (x.sps, x.t3, x.t2) for x in state.capacity_fold(spark.createDataFrame(rows, "k int, i int, score int, capacity int"), ["k"], ["i"]).collect()}
    want = {}
    for k, _, s, c in rows:
        want[k] = streams.stepped(s, c, want.get(k, (None, 0, 0)))
    assert got == want


@pytest.mark.parametrize(
    ("name", "want"),
    [("nvidia-tesla-t4", "T4"), ("nvidia-a100-80gb", "A100 80GB"), ("nvidia-tesla-a100", "A100"), ("nvidia-h100-mega-80gb", "H100"), ("nvidia-l4-vws", "L4"), ("some-tpu", "some-tpu"), ("maker-x9", "maker-x9"), ("", "")],
)
def test_accelerator_names(spark, name, want):
    assert one(spark, S.best_name(F.col("n"), ["T4", "A100", "A100 80GB", "H100", "L4", "L40"]), n=name) == want


def test_lists_days_and_ids(spark):
    df = spark.createDataFrame([(["a", "b", "a"], ["b"]), (["a"], ["a"]), ([], ["a"]), (["a"], None), (None, ["a"])], "x array<string>, bad array<string>")
    assert [r[0] for r in df.select(S.without_items(F.col("x"), F.col("bad"))).collect()] == [["a", "a"], None, None, ["a"], None]
    start, end = (one(spark, c.cast("string"), t="2025-02-28 13:05:00") for c in S.day_bounds(F.col("t")))
    assert (start, end) == ("2025-02-28 00:00:00", "2025-02-28 23:59:59.999")
    assert [one(spark, c, t="us,small") for c in S.place_and_size(F.col("t"))] == ["us", "small"]


def test_allocation_passes_over_pairs_without_room(spark):
    rows = [("s1", "l1", 0, 9, False), ("s1", "l2", 1, 10, False), ("s2", "l1", 2, 7, None), ("s2", "l2", 3, 0, True)]
    pairs = spark.createDataFrame(rows, "subscription string, location string, place int, recent int, over_limit boolean")
    got = planner.allocated_with_room(spark.range(6), ["id"], pairs, after=0).orderBy("id").collect()
    assert [(r.subscription, r.location) for r in got] == [("s2", "l1"), ("s1", "l1"), ("s2", "l1"), ("s2", "l1"), (None, None), (None, None)]


def test_filters_of_columns(spark):
    df = spark.createDataFrame([(1, "Alpha", 1.5), (2, "beta", None), (3, None, 9.0), (4, "", 4.0)], "k int, name string, v double")
    ids = lambda f: [r.k for r in query.filtered(df, f).orderBy("k").collect()]
    assert ids({"name": ("contains", "A")}) == [1, 2] and ids({"name": ("blank",)}) == [3, 4] and ids({"v": ("inRange", 1, 5)}) == [1, 4]
    assert ids({"v": ("notEqual", 4.0)}) == [1, 2, 3] and ids({"name": ("startsWith", "al"), "v": ("lessThan", 2)}) == [1] and ids({}) == [1, 2, 3, 4]


def test_inputs_that_are_missing(spark):
    prices = spark.createDataFrame([("Standard", "D2", "US East", "useast", 2.0, 1.0, 50.0)], merge.RETAIL_PRICES)
    evictions = spark.createDataFrame([("useast", "standard_d2", "0-5"), ("x", "standard_d9", "20+")], "location string, skuName string, evictionRate string")
    show = lambda df: sorted((r.InstanceType, r.SpotPrice, r.IF) for r in df.collect())
    assert show(merge.prices_at_hand(prices, evictions)) == [("D2", 1.0, 3.0)]
    assert show(merge.prices_at_hand(prices, None)) == [("D2", 1.0, -1.0)]
    assert show(merge.prices_at_hand(None, evictions)) == [("D2", -1.0, 3.0), ("D9", -1.0, 1.0)]
    none = merge.prices_at_hand(None, None)
    assert none.count() == 0 and none.columns == merge.prices_at_hand(prices, evictions).columns


def test_time_of_a_merged_row(spark):
    prices = spark.createDataFrame([("Standard", "a", "r", 2.0, 1.0, 50.0, 3.0, "t1"), ("Standard", "b", "r", 2.0, 1.0, 50.0, 3.0, None)], "InstanceTier string, InstanceType string, Region string, OndemandPrice double, SpotPrice double, Savings double, IF double, time string")
    scores = spark.createDataFrame([("Standard", k, "r", 1, "z", 3, t, 0, 0) for k, t in (("a", None), ("b", None), ("c", "t2"))], "InstanceTier string, InstanceType string, Region string, DesiredCount int, AvailabilityZone string, Score int, time string, T2 int, T3 int")
    rows = merge.merge_regional(prices, scores.withColumn("T2", F.lit(0))).collect()
    assert {r.InstanceType: r.Time for r in rows} == {"a": "t1", "b": "N/A"}


def test_diff_by_hand(spark):
    prev = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", None), ("e", 5.0), (None, 1.0)], "k string, v double")
    cur = spark.createDataFrame([("a", 1.0), ("b", 2.5), ("c", None), ("d", 4.0), (None, 1.0)], "k string, v double")
    got = {r.k: r.change for r in diff.snapshot_diff(prev, cur, ["k"], ["v"], unchanged=True).collect()}
    assert got == {"a": "unchanged", "b": "changed", "c": "unchanged", "d": "new", "e": "removed", None: "unchanged"}
    assert [tuple(r) for r in diff.removed_rows(prev, cur, ["k"], ["v"]).collect()] == [("e", 0.0, True)]
    assert diff.snapshot_diff(cur, cur, ["k"], ["v"]).count() == 0
    again = diff.applied(prev, diff.published_changes(prev, cur, ["k"], ["v"]), ["k"], ["v"])
    assert sorted(map(str, again.collect())) == sorted(map(str, cur.collect()))
    assert diff.snapshot_diff(prev.limit(0), cur, ["k"], ["v"]).where("change <> 'new'").count() == 0
    twice = cur.union(cur)
    assert diff.duplicate_keys(twice, ["k"]).count() == 5
    assert diff.assert_unique(cur, ["k"]).count() == 5
    with pytest.raises(Exception, match="several rows"):
        diff.assert_unique(twice, ["k"]).collect()


@pytest.mark.parametrize(("od", "spot", "want"), [(1.0, 0.25, (75, 75.0, 75)), (1.0, 0.371, (62, 62.9, 63)), (1.0, 1.209, (-20, -20.9, -21)), (None, 0.2, (-1, None, None)), (0.0, 0.2, (-1, None, None))])
def test_savings(spark, od, spot, want):
    row = spark.createDataFrame([(od, spot)], "od double, spot double")
    a, b = F.col("od"), F.col("spot")
    got = row.select(S.savings_truncated(a, b), F.round(S.savings_exact(a, b), 6), S.savings_shown(a, b)).first()
    assert tuple(got) == want


@pytest.mark.parametrize(("sku", "want"), [("Standard_D2s_v3", ("Standard", "D2s_v3", "D2s_v3")), ("Standard_DC2ads_v5", ("Standard", "DC2ads_v5", "Dc2ads_v5")), ("Standard", ("Standard", None, "")), ("Foo_Bar", (None, "Foo", "Bar"))])
def test_sku(spark, sku, want):
    c = F.col("sku")
    assert tuple(spark.createDataFrame([(sku,)], "sku string").select(S.sku_tier(c), S.sku_type(c), S.interruption_type(c)).first()) == want


def test_prefixes_and_prices(spark):
    rows = spark.createDataFrame([("us-east-1",), ("us-gov-west-1",), ("ap-northeast-1",), ("ap-southeast-2",), (None,)], "r string")
    assert [r[0] for r in rows.select(S.zone_prefix(F.col("r"))).collect()] == ["use1", None, "apne1", "apse2", None]
    p = spark.createDataFrame([(2, 8.0, 0.0, 0.03, 0.004, None), (0, 1.0, 0.0, 0.02, None, None), (2, 1.0, 0.0, None, 0.1, None)], "v int, m double, g double, c double, mp double, gp double")
    got = [r[0] for r in p.select(F.round(S.machine_price(*(F.col(c) for c in ("v", "m", "g", "c", "mp", "gp"))), 6)).collect()]
    assert got == [0.092, 0.02, None]
    assert one(spark, F.array_join(F.flatten(S.chunked(F.col("a"), 2)), ","), a=["x", "y", "z"]) == "x,y,z"
    assert one(spark, F.size(S.chunked(F.col("a"), 2)), a=["x", "y", "z"]) == 2
    assert one(spark, S.failure_kind(F.col("a"), F.col("b")), a="OutOfMemoryError", b=1) == "out of memory"


def test_locf_by_hand(spark):
    points = spark.createDataFrame([("s", 1, 10), ("s", 5, 20), ("s", 9, 30)], "s string, ts int, value int")

    def at(a, b):
        rows = series.chart(points, ["s"], F.lit(a), F.lit(b)).select("ts", "value").collect()
        return sorted(map(tuple, rows))

    assert at(3, 7) == [(3, 10), (5, 20), (7, 20)]
    assert at(0, 4) == [(0, 10), (1, 10), (4, 10)]
    assert at(10, 12) == [(10, 30), (12, 30)]


def test_asof_is_strict(spark):
    a = spark.createDataFrame([(0, 10), (0, 20), (0, 30)], "g int, ts int")
    b = spark.createDataFrame([(0, 10), (0, 15), (0, 30)], "g int, ts int")
    assert sorted((r.ts, r.next_ts) for r in index.asof_forward(a, b, ["g"]).collect()) == [(10, 15), (20, 30)]


def test_zone_lookup(spark):
    zones = spark.createDataFrame([("use1-az1",), ("apne2-az3",), ("zzz-az1",)], "ZoneId string")
    regions = spark.createDataFrame([("us-east-1",), ("ap-northeast-2",), ("nan",)], "Region string")
    assert sorted(map(tuple, index.zone_regions(zones, regions).collect())) == [("apne2-az3", "ap-northeast-2"), ("use1-az1", "us-east-1")]


def brute_bins(weights, capacity):
    best = len(weights)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(weights):
            best = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + weights[i] <= capacity:
                go(i + 1, [*bins[:j], bins[j] + weights[i], *bins[j + 1 :]])
        go(i + 1, [*bins, weights[i]])

    go(0, [])
    return best


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 10), min_size=1, max_size=8))
def test_packing_is_optimal(weights):
    bins = planner.packed(weights)
    room = {}
    for b, w in zip(bins, weights, strict=True):
        room[b] = room.get(b, 0) + w
    assert max(room.values()) <= 10
    assert len(room) == brute_bins(weights, 10)
    assert planner.packed([11]) is None


def test_packing_keeps_large_regions(spark):
    weights = {"t1": {"r1": 52, "r2": 30, "r3": 11, "r4": 7, "r5": 1}, "t2": {"r1": 3, "r2": 10}, "t3": {"r1": 26}}
    zones = spark.createDataFrame([(t, r, n) for t, w in weights.items() for r, n in w.items()], "InstanceType string, Region string, n long")
    bins = planner.bin_packed(zones).cache()
    held, load = {}, {}
    for x in bins.collect():
        held.setdefault(x.InstanceType, {}).setdefault(x.Region, []).append(x.n)
        load[x.InstanceType, x.bin] = load.get((x.InstanceType, x.bin), 0) + x.n
    assert {t: {r: sum(n) for r, n in w.items()} for t, w in held.items()} == weights
    assert max(load.values()) <= planner.PACK
    assert {t: sum(x[0] == t for x in load) for t in weights} == {"t1": 11, "t2": 2, "t3": 3}
    queries = [q for b in planner.request_batches(bins).collect() for q in b["queries"]]
    assert len(queries) == 16 and sum(q.n for q in queries) == 140


@settings(max_examples=50, deadline=None)
@given(st.sets(st.tuples(st.sampled_from("abcdefghijkl"), st.sampled_from("123456789")), max_size=60))
def test_cover_is_whole(pairs):
    found = list(planner.greedy_cover(pairs))
    assert all(len(r) <= 8 and len(t) <= 5 for r, t in found)
    assert pairs <= {(x, y) for r, t in found for x in r for y in t}


def test_cover_plans_are_whole(spark):
    pairs = {(f"r{i % 13}", f"t{(i * 7 + i // 13) % 17}") for i in range(90)}
    support = spark.createDataFrame(sorted(pairs) + [("r0", None)], "RegionCode string, InstanceType string")
    for plan in (planner.covering_requests(support), planner.covering_requests(support, 3), planner.clustered_requests(support), planner.grouped_requests(support)):
        rows = plan.collect()
        assert all(len(r["regions"]) <= 8 and len(r["types"]) <= 5 for r in rows)
        assert pairs <= {(x, y) for r in rows for x in r["regions"] for y in r["types"]}


def test_rate_window_excludes_its_age(spark):
    calls = spark.createDataFrame([(1, 0), (2, 62 * 60), (3, 62 * 60 + 59)], "id int, s long").withColumn("ts", F.timestamp_seconds("s")).withColumn("g", F.lit(1))
    assert {r.id: r.recent for r in planner.rate_windows(calls, ["g"]).collect()} == {1: 1, 2: 1, 3: 2}


def test_state_and_allocation(spark):
    have = spark.createDataFrame([("s1", "l1", [1])], "subscription string, location string, calls array<int>")
    out = planner.with_missing_pairs(have, spark.createDataFrame([("s1",), ("s2",)], "subscription string"), spark.createDataFrame([("l1",)], "location string"))
    assert sorted((r.subscription, r.calls) for r in out.collect()) == [("s1", [1]), ("s2", None)]
    got = planner.allocated(spark.range(5), ["id"], ["a", "b"], ["x", "y"], after=1).orderBy("id").collect()
    assert [(r.subscription, r.location) for r in got] == [("a", "y"), ("b", "x"), ("b", "y"), ("a", "x"), ("a", "y")]


def test_query_checks(spark):
    with pytest.raises(ValueError, match="choose"):
        query.checked({"Region": ""}, date(2024, 1, 1), date(2024, 1, 2), ("Region",))
    with pytest.raises(ValueError, match="ends before"):
        query.checked({"Region": "*"}, date(2024, 1, 3), date(2024, 1, 2))
    df = spark.createDataFrame([("1.5", float("nan"), "t")], ["OnDemand Price", "Savings", "time"])
    assert tuple(query.normalised(df).select("OndemandPrice", "Savings", "Time").first()) == (1.5, None, "t")
    with pytest.raises(ValueError, match="pages"):
        query.page(df, 0, 7)


def test_retail_and_evictions(spark):
    items = [
        ("US East", "eastus", "Standard_D2s_v3", 1.0, "D2s v3", "VM", "2024"), ("US East", "eastus", "Standard_D2s_v3", 0.25, "D2s v3 Spot", "VM", "2024"),
        ("US East", "eastus", "Standard_D2s_v3", 9.0, "D2s v3", "VM Windows", "2025"), ("US East", "eastus", "Standard_D2s_v3", 9.0, "D2s v3 Expired", "VM", "2025"),
        ("GOV East", "gov", "Standard_A", 1.0, "A Spot", "VM", "2024"), ("", "x", "Standard_A", 1.0, "A Spot", "VM", "2024"),
        ("EU", "eu", "Basic_A1", 0.0, "A1", "VM", "2024"), ("EU", "eu", "Basic_A1", 0.5, "A1 Spot", "VM", "2024"), ("EU", "eu", "Basic_A2", 0.5, "A2", "VM", "2024"),
    ]
    from tidewatch.schemas import EVICTIONS, RETAIL_ITEMS

    prices = merge.retail_prices(spark.createDataFrame(items, RETAIL_ITEMS))
    got = sorted((r.InstanceType, r.OndemandPrice, r.SpotPrice, r.Savings) for r in prices.collect())
    assert got == [("A1", None, 0.5, None), ("D2s_v3", 1.0, 0.25, 75.0)]
    rates = spark.createDataFrame([("eastus", "standard_D2s_v3", "5-10"), ("eu", "standard_A9", "20+")], EVICTIONS)
    assert sorted((r.InstanceType, r.IF) for r in merge.with_evictions(prices, rates).collect()) == [("A1", None), ("D2s_v3", 2.5)]
    alone = merge.with_evictions(prices.limit(0), rates).collect()
    assert sorted((r.Region, r.IF, r.Savings) for r in alone) == [("eastus", 2.5, 1.0), ("eu", 1.0, 1.0)]


def test_machine_prices(spark):
    cats = lambda *x: ["GCP", "Compute", *x]
    skus = spark.createDataFrame(
        [("c", "N1 Core", cats("GCE", "VMs On Demand", "Cores: Per Core", "N1"), ["us", "eu"]), ("m", "N1 Ram", cats("GCE", "VMs On Demand", "Memory: Per GB", "N1"), ["us"]),
         ("pc", "N1 Core", cats("GCE", "VMs Preemptible", "Cores: Per Core", "N1"), ["us"]), ("x", "Custom Core", cats("GCE", "VMs On Demand", "Cores: Per Core", "N1"), ["us"]),
         ("g", "GPU", cats("GPUs", "GPUs On Demand", "T4"), ["us"]), ("s", "GPU slice", cats("GPUs", "GPUs On Demand", "T4", "GPU slice: x"), ["us"])],
        "skuId string, displayName string, cats array<string>, regions array<string>",
    )
    units = merge.catalogue_units(skus)
    assert sorted((r.skuId, r.kind, r.region) for r in units.collect()) == [("c", "VMs", "eu"), ("c", "VMs", "us"), ("g", "GPUs", "us"), ("m", "VMs", "us"), ("pc", "VMs", "us")]
    prices = spark.createDataFrame([("c", 1, 0.03), ("c", 2, 9.0), ("m", 1, 0.004), ("pc", 1, 0.01), ("g", 1, 0.5)], "skuId string, page int, price double")
    machines = spark.createDataFrame([("n1-2", "N1", "us", 2, 8.0, 0.0, None), ("n1-2", "N1", "eu", 2, 8.0, 0.0, None)], "machineType string, machineFamily string, region string, vcpus int, memory double, gpuCount double, gpuType string")
    rows = merge.machine_prices(machines, units, prices, F.lit("t")).collect()
    assert [(r.Region, round(r.OndemandPrice, 6), r.SpotPrice) for r in rows] == [("us", 0.092, 0.02)]


def test_readers(spark, tmp_path):
    (tmp_path / "if.txt").write_text("banner\nheader\nus-east-1,m5.large,a,b,c,<5%\nshort,row\nus-west-1,m5.large,a,b,c,>20%\n\n")
    rows = readers.banner_csv(spark, str(tmp_path / "if.txt"), {0: ("Region", "string"), 1: ("InstanceType", "string"), 5: ("IF", "string")})
    assert sorted(map(tuple, rows.collect())) == [("us-east-1", "m5.large", "<5%"), ("us-west-1", "m5.large", ">20%")]
    (tmp_path / "list.txt").write_text("a\nb\n\nc\n")
    assert [r[0] for r in readers.line_list(spark, str(tmp_path / "list.txt")).collect()] == ["a", "b"]
    schema = rows.schema
    assert readers.table(spark, str(tmp_path / "none"), schema).count() == 0
    (tmp_path / "r.json").write_text(json.dumps([{"Region": "x", "InstanceType": "y", "IF": "z"}]))
    assert tuple(readers.json_records(spark, str(tmp_path / "r.json"), schema).first()) == ("x", "y", "z")
    doc = {"product": {"attributes": {"instanceType": "m5"}}, "terms": {"OnDemand": {"t": {"priceDimensions": {"d": {"pricePerUnit": {"USD": "0.5"}}}}}}}
    lines = spark.createDataFrame([(json.dumps(doc),), (json.dumps(doc).replace("0.5", "0.0"),)], "value string")
    assert [tuple(r) for r in readers.ondemand_prices(lines, F.lit("r")).collect()] == [("r", "m5", 0.5)]
    path = tmp_path / "2025/02/15"
    path.mkdir(parents=True)
    spark.range(1).coalesce(1).write.parquet(str(path / "00-10_sps_50.parquet"))
    facts = readers.with_path_facts(spark.read.parquet(str(path / "00-10_sps_50.parquet"))).first()
    assert facts.path_capacity == 50 and str(facts.path_ts) == "2025-02-15 00:10:00"
    spark.range(1).coalesce(1).write.json(str(tmp_path / "files"))
    (next((tmp_path / "files").glob("part-*.json"))).rename(path / "00-20_sps_5.json")
    assert readers.with_path_facts(spark.read.json(str(path / "00-20_sps_5.json"))).first().path_capacity == 5
    text = spark.createDataFrame([('x={"a":"1","b":"2","a":"3"}',)], "js string")
    assert readers.scraped_map(text, "js").first().pairs == {"a": "3", "b": "2"}


def test_paged_source(spark, tmp_path):
    register(spark)
    for i in range(2):
        (tmp_path / f"{i * 2}.json").write_text(json.dumps({"Items": [{"a": i, "b": "x"}, {"a": i + 10, "b": None}]}))
    df = spark.read.format("paged_json").schema("a long, b string").options(url=f"file://{tmp_path}/{{skip}}.json", pages=3, size=2).load()
    assert sorted((r.a, r.b) for r in df.collect()) == [(0, "x"), (1, "x"), (10, None), (11, None)]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("b", 1.0, "2025-02-15 00:10:00"), ("a", None, "2025-02-16 00:10:00")], "k string, v double, t string").withColumn("ts", F.col("t").cast("timestamp"))
    sinks.write_latest(rows.drop("ts"), str(tmp_path / "latest"), ["k"], also_parquet=str(tmp_path / "copy"))
    assert sorted((r.id, r.k) for r in spark.read.json(str(tmp_path / "latest")).collect()) == [(1, "a"), (2, "b")]
    for _ in range(2):
        sinks.append_changes(rows.drop("t"), str(tmp_path / "log"), batch="b1")
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    sinks.write_raw(rows, str(tmp_path / "raw"), "ts")
    assert spark.read.option("header", True).csv(str(tmp_path / "raw")).count() == 2
    sinks.export_month(rows.withColumn("vendor", F.lit("aws")), str(tmp_path / "month"), "2025-02")
    sinks.export_month(rows.withColumn("vendor", F.lit("gcp")), str(tmp_path / "month"), "2025-02")
    assert {r.vendor for r in spark.read.option("header", True).csv(str(tmp_path / "month/2025-02")).collect()} == {"aws"}
    seen, counts = sinks.observed(rows, "counts", {"v": ["v"], "kv": ["k", "v"]})
    seen.write.format("noop").mode("overwrite").save()
    assert counts.get == {"rows": 2, "v": 1, "kv": 1}
    sinks.write_state(spark, str(tmp_path / "state"), index=3)
    assert sinks.read_state(spark, str(tmp_path / "state"))["index"] == 3
    sinks.write_selector(rows, rows.withColumn("k", F.lit("z")), str(tmp_path / "sel"), ["k"])
    sinks.write_selector(spark.read.parquet(str(tmp_path / "sel")), rows, str(tmp_path / "sel"), ["k"])
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "sel")).collect()) == ["a", "b", "z"]
    sinks.export_features(rows.select("k", "v"), str(tmp_path / "f"))
    assert sorted(r.v for r in spark.read.option("header", True).csv(str(tmp_path / "f")).collect()) == ["1.0", "None"]
    sent = sinks.send(rows.select("k"), lambda batch: [r for r in batch if r["k"] == "a"][:0], size=1).agg(F.sum("sent"), F.sum("rejected")).first()
    assert tuple(sent) == (2, 0)


def test_merge_filters_and_sentinels(spark):
    rows = spark.createDataFrame([("aws-gov", 1.0, 1.0, 1.0, 1.0, 3, "1"), ("x", -1.0, -1.0, -1.0, -1.0, 3, "1"), ("x", 1.0, 1.0, 1.0, 1.0, -1, "N/A"), ("x", 1.0, -1.0, -1.0, 1.0, 2, "1")], "Region string, OndemandPrice double, SpotPrice double, Savings double, IF double, Score int, AvailabilityZone string")
    assert merge.regional_filters(rows).count() == 1
    assert merge.with_columns_of(rows, {"Region": "string", "Extra": "int"}).columns == ["Region", "Extra"]
    assert sinks.zeros_marked(spark.createDataFrame([(0,), (2,)], "v int"), ["v"]).agg(F.sum("v")).first()[0] == 1


def test_stream_once_and_windows(spark, tmp_path):
    rows = [(1, "2024-01-01 00:01:00"), (1, "2024-01-01 00:02:00"), (2, "2024-01-01 00:11:00")]
    spark.createDataFrame(rows, "k int, t string").select("k", F.col("t").cast("timestamp").alias("ts")).write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    got = streams.drained(streams.once(streams.landed(spark, str(tmp_path / "in"), schema), ["k"], "ts"), str(tmp_path), "append")
    assert sorted(r.k for r in got.collect()) == [1, 2]


def test_triples(spark):
    rows = [(f"t{i:02d}", f"z{i % 2}", 1 + i % 3) for i in range(40)] + [(None, "z0", 1)]
    out = planner.stratified_triples(spark.createDataFrame(rows, "InstanceType string, AZ string, SPS int"), [4, 6], most=20, per_score=4).collect()
    scores = {(t, z): s for t, z, s in rows}
    assert {r.total for r in out} == {4, 6}
    assert all(sum(scores[t, r.AZ] for t in (r.a, r.b, r.c)) == r.total and r.a < r.b < r.c for r in out)
    assert len({(r.a, r.b, r.c, r.total) for r in out}) == len(out) and all(sum(r.total == t for r in out) <= 20 for t in (4, 6))


def test_text_helpers(spark):
    text = "Location is not supported. List of supported values: 'eastus, westus'."
    assert one(spark, S.listed_after(F.col("t"), "supported values:"), t=text) == ["eastus", "westus"]
    assert one(spark, S.joined_key(F.col("t"), F.lit("z")), t="m5") == "m5_z"
    assert round(one(spark, S.hue(F.col("i")), i=3), 3) == 52.524
