"""Streams: state that goes when groups are idle, merged signals, pages read on after a restart; and the store with commits."""

import http.server
import json
import random
import threading
import urllib.parse
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import planner, slices, state
from tidewatch.sources import records, rest, sinks
from tidewatch.streaming import signals
from tidewatch.streaming import ticks as streams

START = datetime(2025, 1, 1)


def land(spark, rows, schema, folder):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))


def drained_again(stream, folder, mode="append"):
    """What a stream gives for what has landed since, into one table with one checkpoint."""

    def write(rows, batch):
        rows.write.mode("overwrite").parquet(f"{folder}/rows/batch={batch}")

    streams.published(stream, write, f"{folder}/state", mode).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows").drop("batch")


def test_state_of_idle_groups_goes(spark, tmp_path):
    schema = "g string, id int, ts timestamp"
    at = lambda minutes: START + timedelta(minutes=minutes)
    land(spark, [("a", 1, at(0)), ("a", 2, at(5)), ("b", 3, at(5))], schema, tmp_path / "in")
    source = streams.landed(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
    log = streams.call_log(source, ["g"], "ts", ["id"], limit=2, late="10 minutes")
    held = lambda: {r.g for r in spark.read.format("statestore").option("stateVarName", "times").load(f"{tmp_path}/out/state").select(F.col("key.g").alias("g")).collect()}
    drained_again(log, tmp_path / "out")
    assert held() == {"a", "b"}
    land(spark, [("b", 4, at(60))], schema, tmp_path / "in")
    out = drained_again(log, tmp_path / "out")
    land(spark, [("b", 5, at(200)), ("b", 6, at(201))], schema, tmp_path / "in")
    out = drained_again(log, tmp_path / "out")
    assert {r.id: (r.recent, r.allowed) for r in out.collect()} == {1: (1, True), 2: (2, False), 3: (1, True), 4: (2, False), 5: (1, True), 6: (2, False)}
    assert held() == {"b"}


def test_call_log_is_the_batch_s(spark, tmp_path):
    r = random.Random(1)
    rows = sorted((START + timedelta(seconds=r.randrange(40_000)), f"g{r.randrange(4)}", i) for i in range(300))
    for k in range(3):
        land(spark, [(g, i, t) for t, g, i in rows[k * 100 : k * 100 + 100]], "g string, id int, ts timestamp", tmp_path / "in")
    calls = spark.read.parquet(str(tmp_path / "in"))
    got = streams.drained(streams.call_log(streams.landed(spark, str(tmp_path / "in"), calls.schema), ["g"], "ts", ["id"]), str(tmp_path), "append")
    want = planner.rate_windows(calls, ["g"])
    assert sorted(map(tuple, got.select("id", "recent", "allowed").collect())) == sorted(map(tuple, want.select("id", "recent", "allowed").collect()))


CELL_KEYS = "g long, k string, i int, score int, capacity int"


def cell_ticks(spark, folder):
    """Ticks of many keys in four parts, some keys null and some too large for floats; and what Spark reads of them."""
    r = random.Random(5)
    keys = [(None if j % 11 == 0 else (1 << 60) + j // 2, r.choice([None, "", "a", "b"])) for j in range(150)]
    rows = [(*r.choice(keys), i, r.choice([None, 1, 2, 3]), r.choice([1, 5, 10, 50])) for i in range(1200)]
    for part in range(4):
        land(spark, rows[part * 300 : part * 300 + 300], CELL_KEYS, folder / "in")
    return rows, streams.landed(spark, str(folder / "in"), spark.read.parquet(str(folder / "in")).schema, files_per_batch=1)


def rows_of_state(spark, folder):
    return spark.read.format("statestore").load(f"{folder}/out/state").count()


def test_states_are_held_by_cells_of_keys(spark, tmp_path):
    rows, source = cell_ticks(spark, tmp_path)
    got = drained_again(streams.capacity_states(source, ["g", "k"], ["i"], cells=8), tmp_path / "out", "update")
    assert rows_of_state(spark, tmp_path) == 8  # one call and one row of state for the keys of a cell, not for each key
    want, after = {}, set()
    for n, (g, k, _, score, capacity) in enumerate(rows, 1):
        want[g, k] = streams.stepped(score, capacity, want.get((g, k), (None, 0, 0)))
        if n % 300 == 0:  # a micro-batch gives the keys that it has ticks of
            after |= {(n, *key, *want[key]) for key in {x[:2] for x in rows[n - 300 : n]}}
    assert sorted(repr(tuple(x)) for x in got.collect()) == sorted(repr(x[1:]) for x in after)


def test_changes_are_told_by_cells_of_keys(spark, tmp_path):
    rows, source = cell_ticks(spark, tmp_path)
    got = drained_again(streams.changes_only(source, ["g", "k"], ["i"], ["score"], cells=8), tmp_path / "out")
    assert rows_of_state(spark, tmp_path) == 8
    last, want = {}, []
    for g, k, i, score, _ in rows:
        if (g, k) not in last or last[g, k] != score:
            want.append((g, k, i, score))
        last[g, k] = score
    assert sorted(map(repr, map(tuple, got.select("g", "k", "i", "score").collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize("most", [1_000_000, 20])
def test_states_as_tables(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(slices, "SLICE_ROWS", most)  # 20: the hot key of each batch is cut
    r = random.Random(3)
    rows = [("hot" if r.random() < 0.6 else f"k{r.randrange(9)}", i, r.choice([None, 1, 2, 3]), r.choice([1, 5, 10, 50])) for i in range(300)]
    schema = "k string, i int, score int, capacity int"
    for part in range(4):
        land(spark, rows[part * 75 : part * 75 + 75], schema, tmp_path / "in")
    ticks = spark.read.parquet(str(tmp_path / "in"))
    for _ in range(2):  # nothing is new the second time
        source = streams.landed(spark, str(tmp_path / "in"), ticks.schema, files_per_batch=1)
        streams.folded_states(source, ["k"], ["i"], str(tmp_path / "out")).awaitTermination()
    assert sorted(p.name for p in (tmp_path / "out" / "states").iterdir()) == ["batch=2", "batch=3"]
    assert not list((tmp_path / "out" / "ticks").iterdir())
    got = spark.read.parquet(str(tmp_path / "out" / "states" / "batch=3"))
    want = {}
    for k, _, score, capacity in rows:
        want[k] = streams.stepped(score, capacity, want.get(k, (None, 0, 0)))
    assert {x.k: (x.sps, x.t3, x.t2) for x in got.collect()} == want
    assert sorted(map(repr, got.collect())) == sorted(map(repr, state.capacity_fold(ticks, ["k"], ["i"]).select(got.columns).collect()))


def signal_rows(r, ticks=12):
    at = [START + timedelta(minutes=10 * i) for i in range(ticks)]
    scores = [(t, f"k{k}", r.randrange(1, 4)) for t in at for k in range(5)]
    return at, scores, [(t, k, round(r.random(), 3)) for t, k, _ in scores if r.random() < 0.7], [(t, k, r.random()) for t, k, _ in scores if r.random() < 0.5]


@pytest.mark.parametrize("seed", [1, 2])
def test_signals_that_are_late_or_missing(spark, tmp_path, seed):
    r = random.Random(seed)
    at, scores, freq, price = signal_rows(r)
    end = [(START + timedelta(days=9), "end")]  # a later tick, so that all others are let go
    schemas = {"scores": "tick timestamp, k string, score int", "freq": "tick timestamp, k string, f double", "price": "tick timestamp, k string, p double"}
    for part in range(3):
        for name, rows, lag in (("scores", scores, 0), ("freq", freq, 1), ("price", price, 0)):  # freq lands a part later
            mine = [x for x in rows if at.index(x[0]) // 4 + lag == part]
            land(spark, mine, schemas[name], tmp_path / name)
    land(spark, [x for x in freq if at.index(x[0]) // 4 == 2], schemas["freq"], tmp_path / "freq")
    for name in schemas:
        land(spark, [(*end[0], None)], schemas[name], tmp_path / name)
    one, two, three = (streams.landed(spark, str(tmp_path / n), spark.read.parquet(str(tmp_path / n)).schema, files_per_batch=1) for n in schemas)
    out = signals.merged(one, {"freq": (two, ["k"]), "price": (three, ["k"])}, "tick", "2 hours", defaults={"f": F.lit(-1.0), "p": F.lit(-1.0)})
    got = streams.drained(out, str(tmp_path), "append").where("k <> 'end'").select("tick", "k", "score", "f", "p").collect()
    f, p = {x[:2]: x[2] for x in freq}, {x[:2]: x[2] for x in price}
    want = [(t, k, s, f.get((t, k), -1.0), p.get((t, k), -1.0)) for t, k, s in scores]
    assert sorted(map(tuple, got)) == sorted(want)


def test_missing_signals_can_fail(spark, tmp_path):
    land(spark, [(START, "a", 1), (START + timedelta(days=2), "b", 1)], "tick timestamp, k string, score int", tmp_path / "scores")
    land(spark, [(START + timedelta(days=2), "b", 1.0)], "tick timestamp, k string, f double", tmp_path / "freq")
    one, two = (streams.landed(spark, str(tmp_path / n), spark.read.parquet(str(tmp_path / n)).schema) for n in ("scores", "freq"))
    with pytest.raises(Exception, match="signals are missing: freq"):
        streams.drained(signals.merged(one, {"freq": (two, ["k"])}, "tick", "1 hour", missing="fail"), str(tmp_path), "append")
    with pytest.raises(ValueError):
        signals.merged(one, {}, "tick", "1 hour", missing="ignore")


@pytest.fixture(scope="module")
def service():
    rows, asked = [], []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            url = urllib.parse.urlparse(self.path)
            given = {k: v[0] for k, v in urllib.parse.parse_qs(url.query).items()}
            at = int(given.get("$skip") or given.get("next") or 0)
            asked.append((url.path, at))
            out = {"Items": rows[at : at + 10]}
            if url.path == "/tokens" and at + 10 < len(rows):
                out["next"] = str(at + 10)
            body = json.dumps(out).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    with http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler) as s:
        threading.Thread(target=s.serve_forever, daemon=True).start()
        yield f"http://127.0.0.1:{s.server_port}", rows, asked
        s.shutdown()


@pytest.mark.parametrize("how", ["offsets", "tokens"])
def test_pages_are_read_on_after_a_restart(spark, tmp_path, service, how):
    url, rows, asked = service
    rows.clear()
    rest.register(spark)

    def collected():
        options = {"url": f"{url}/{how}", "size": 10} | ({"token": "next"} if how == "tokens" else {})
        stream = spark.readStream.format("paged_json").schema("name string, size long").options(**options).load()
        return sorted(r.size for r in drained_again(stream, tmp_path / "out").collect())

    for n in (0, 5, 15, 15, 40, 41, 100):  # a last page grows, nothing is new, many pages at once
        rows.extend({"name": f"n{i}", "size": i} for i in range(len(rows), n))
        if n == 0:
            continue
        asked.clear()
        assert collected() == list(range(n))
    read = [at for path, at in asked if path == f"/{how}"]
    assert read.count(0) <= 3  # the first page is only looked at


@pytest.mark.parametrize(("had", "has", "parts"), [((0, 0), (10_000, 7), 51), ((3, 4), (3, 9), 1), ((3, 4), (5, 1), 3), ((0, 0), (99, 10), 12)])
def test_pages_are_read_in_runs(had, has, parts):
    stream = rest.PagedJsonStream({"url": "", "size": 10}, None)
    stream._page = lambda skip, token: {"Items": [{"id": i} for i in range(skip, skip + 10)]}  # the last page has grown since
    stream._row = lambda record: record["id"]
    start, end = ({"page": p, "token": "", "records": n} for p, n in (had, has))
    spans = stream.partitions(start, end)
    assert len(spans) == parts  # not one for each page
    assert [i for s in spans for i in stream.read(s)] == list(range(had[0] * 10 + had[1], has[0] * 10 + has[1]))


RECORD = "dimensions array<struct<name string, value string>>, measures array<struct<name string, value string, type string>>, time string"


def records_of(spark, n, at="1000", parts=4):
    rows = [([("k", str(i))], [("m", str(i) if i % 10 else None, "BIGINT")], None if i % 25 == 0 else at) for i in range(1, n + 1)]
    return spark.createDataFrame(rows, RECORD).repartition(parts)


def test_records_are_published_once(spark, tmp_path):
    path = str(tmp_path / "store")
    for _ in range(2):  # a batch that is replayed replaces itself
        records.publish(records_of(spark, 300), path, batch="b1", size=20)
    records.publish(records_of(spark, 50, "2000"), path, batch="b2")
    taken = [(r.dimensions[0].value, r.time) for r in records.published(spark, path).collect()]
    want = lambda n, at: {(str(i), at) for i in range(1, n + 1) if i % 10 and i % 25}
    assert len(taken) == len(set(taken)) and set(taken) == want(300, "1000") | want(50, "2000")
    rejected = records.published(spark, path, "rejected").collect()
    assert sorted(int(r.dimensions[0].value) for r in rejected) == sorted(i for n in (300, 50) for i in range(1, n + 1) if not (i % 10 and i % 25))
    assert {r._reason for r in rejected} == {"no time", "no measure"}
    assert records.published(spark, str(tmp_path / "none")).count() == 0


def test_a_write_that_fails_leaves_no_records(spark, tmp_path):
    path = str(tmp_path / "store")
    records.publish(records_of(spark, 30), path, batch="b1")
    before = sorted(map(repr, records.published(spark, path).collect()))
    bad = records_of(spark, 100).withColumn("time", F.when(F.col("dimensions")[0]["value"] == "77", F.raise_error(F.lit("no luck"))).otherwise(F.col("time")))
    with pytest.raises(Exception, match="no luck"):
        records.publish(bad, path, batch="b1", size=5)
    assert sorted(map(repr, records.published(spark, path).collect())) == before


def test_stream_into_the_store(spark, tmp_path):
    for k in range(3):
        land(spark, [(i, START) for i in range(k * 10 + 1, k * 10 + 11)], "i int, ts timestamp", tmp_path / "in")
    source = streams.landed(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema, files_per_batch=1)
    rows = sinks.records(source, ["i"], {"i": "BIGINT"}, F.col("ts"))
    streams.published(rows, lambda df, batch: records.publish(df, str(tmp_path / "store"), batch=f"batch-{batch}"), str(tmp_path / "state"), "append").awaitTermination()
    assert sorted(int(r.dimensions[0].value) for r in records.published(spark, str(tmp_path / "store")).collect()) == list(range(1, 31))


@pytest.mark.parametrize("token", [None, "next"])
def test_landed_pages(spark, tmp_path, token):
    df = spark.range(95).select((F.col("id") * 7 % 95).alias("size"), F.when(F.col("id") % 3 > 0, F.lit("x")).alias("name"))
    n = sinks.write_pages(df, str(tmp_path / "p"), ["size"], 10, token)
    assert n == 10
    rest.register(spark)
    name = "{token}" if token else "{skip}"
    back = spark.read.format("paged_json").schema("size long, name string").options(url=f"file://{tmp_path}/p/page-{name}.json", size=10, strands=3, **({"token": token} if token else {})).load()
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
