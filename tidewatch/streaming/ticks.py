"""Ticks as streams: capacity state, change suppression, windows and idempotent publishing."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from ..operators.diff import latest_per_key, published_changes
from ..operators.planner import CALLS, WINDOW_MINUTES
from ..operators.state import FALLBACK, capacity_fold
from ..sources.store import removed


def landed(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Files as they arrive in a folder."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(folder)


def stepped(score: int | None, capacity: int, state: tuple[int | None, int, int]) -> tuple[int | None, int, int]:
    """One key's state after a tick; ``operators.state.step`` says the same of columns."""
    seen, p3, p2 = state
    known = seen if capacity == 1 and score is None else score
    below = FALLBACK.get(capacity, 0)
    t3 = max(capacity if score is not None and score >= 3 else 0, p3) if known is not None and known >= 3 else min(below, p3)
    t2 = max(capacity if score == 2 else 0, p2) if known is not None and known >= 2 else min(below, p2)
    kept = known if capacity == 1 else max((x for x in (score, seen) if x is not None), default=None)
    if kept is not None and kept <= 2:
        t3 = 0
    if kept is not None and kept < 2:
        t2 = 0
    return kept, t3, t2


#: Cells of a stream's keys.  Python is called, and state is kept, once for a cell's keys: calls cost far more than rows.
CELLS = 2_048
#: Keys as text that tells all of them apart.
_EXACT = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _in_cells(ticks: DataFrame, keys: list[str], cells: int) -> DataFrame:
    """``ticks`` with ``_key``, their key as text, and ``_cell``, the key's cell."""
    keyed = ticks.withColumn("_key", F.to_json(F.struct(*keys), _EXACT))
    return keyed.withColumn("_cell", F.pmod(F.xxhash64("_key"), F.lit(cells)).cast("int"))


def _through_pandas(df: DataFrame, columns: list[str], prefix: str) -> dict[str, Column]:
    """Copies of columns by new names, longs as text: pandas makes floats of those that stand beside nulls."""
    return {f"{prefix}{i}": F.col(c).cast("string") if isinstance(df.schema[c].dataType, T.LongType) else F.col(c) for i, c in enumerate(columns)}


def _from_pandas(df: DataFrame, columns: list[str], prefix: str) -> list[Column]:
    return [F.col(f"{prefix}{i}").cast(df.schema[c].dataType).alias(c) for i, c in enumerate(columns)]


def _held(state: GroupState) -> dict:
    """A cell's state: a value for each text of a key."""
    return json.loads(state.get[0]) if state.exists else {}


def _hold(state: GroupState, held: dict) -> None:
    state.update((json.dumps(held),))


def capacity_states(ticks: DataFrame, keys: list[str], order: list[str], score: str = "score", capacity: str = "capacity", cells: int = CELLS) -> DataFrame:
    """Each key's ``sps``, ``t3``, ``t2`` after every micro-batch that has ticks of it; state is three numbers a key, held by cells
    of keys, whose number is the checkpoint's for good.

    Rows of a micro-batch are taken in order; a later batch is later.
    """
    slim = ticks.select(*keys, *(c for c in dict.fromkeys([*order, score, capacity]) if c not in keys))
    copies = _through_pandas(ticks, keys, "_k")
    slim, names = _in_cells(slim.withColumns(copies), keys, cells), list(copies)
    out = T.StructType([*(slim.schema[n] for n in names), *(T.StructField(n, T.IntegerType()) for n in ("sps", "t3", "t2"))])

    def fold(cell: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = _held(state)
        rows = pd.concat(frames).sort_values(order)
        now = {}
        for k, s, c in zip(rows["_key"].tolist(), rows[score].tolist(), rows[capacity].tolist(), strict=True):
            now[k] = stepped(None if s is None or s != s else int(s), int(c), now.get(k) or held.get(k, (None, 0, 0)))
        _hold(state, held | now)
        last = pd.DataFrame(list(now.values()), columns=["sps", "t3", "t2"], dtype=object)
        first = rows.drop_duplicates("_key")[names].reset_index(drop=True)  # as the keys of ``now`` came
        yield pd.concat([first, last], axis=1)

    states = slim.groupBy("_cell").applyInPandasWithState(fold, out, "held string", "update", GroupStateTimeout.NoTimeout)
    return states.select(*_from_pandas(ticks, keys, "_k"), "sps", "t3", "t2")


def folded_states(ticks: DataFrame, keys: list[str], order: list[str], folder: str, score: str = "score", capacity: str = "capacity"):
    """``capacity_states`` for ticks of which many are of one key: state is a table in ``folder``/states, by micro-batch.

    A micro-batch is folded as a table is, in slices of the order, onto the states before it; keys without ticks keep theirs.
    One that is replayed begins from the same states and replaces what it wrote; the states of the last two are kept.
    A key of very many ticks isn't one task's, as it is where Python holds a key's state.
    """

    def fold(rows: DataFrame, batch: int) -> None:
        spark, at, now = rows.sparkSession, f"{folder}/states/batch=", f"{folder}/ticks/batch={batch}"
        slim = rows.select(*keys, *order, score, capacity)
        slim.write.mode("overwrite").parquet(now)  # it is read several times
        before = spark.read.parquet(f"{at}{batch - 1}") if batch else None
        capacity_fold(spark.read.schema(slim.schema).parquet(now), keys, order, score, capacity, initial=before).write.mode("overwrite").parquet(f"{at}{batch}")
        removed(spark, now)
        if batch > 1:
            removed(spark, f"{at}{batch - 2}")

    return published(ticks, fold, f"{folder}/progress", "append")


def changes_only(ticks: DataFrame, keys: list[str], order: list[str], features: list[str], cells: int = CELLS) -> DataFrame:
    """Ticks whose features differ from the key's last ones; state is a fingerprint a key, held by cells of keys, whose number is
    the checkpoint's for good."""

    def keep(cell: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = _held(state)
        rows = pd.concat(frames, ignore_index=True).sort_values(order)
        by = rows.groupby("_key", sort=False)["_mark"]
        before = by.shift(1)
        first = ~rows["_key"].duplicated()
        before[first] = rows.loc[first, "_key"].map(held)
        last = ~rows["_key"].duplicated(keep="last")
        _hold(state, held | dict(zip(rows.loc[last, "_key"].tolist(), rows.loc[last, "_mark"].tolist(), strict=True)))
        yield rows.loc[rows["_mark"].ne(before), names]

    copies = _through_pandas(ticks, ticks.columns, "_v")
    names = list(copies)
    # nulls are written out, so that the text tells all values of the features apart
    copies |= {"_mark": F.to_json(F.struct(*features), {"ignoreNullFields": "false"})}
    slim = _in_cells(ticks.withColumns(copies), keys, cells)
    slim, out = slim.select("_cell", "_key", "_mark", *order, *names), T.StructType([slim.schema[n] for n in names])
    changed = slim.groupBy("_cell").applyInPandasWithState(keep, out, "held string", "append", GroupStateTimeout.NoTimeout)
    return changed.select(*_from_pandas(ticks, ticks.columns, "_v"))


#: The store that stateful processors with timers need; it keeps state on disk, so groups aren't bounded by memory.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Calls(StatefulProcessor):
    """A group's calls within the window, as a list; a timer clears it when the last of them is too old to count."""

    def __init__(self, names: list[str], order: list[str], span: int, limit: int):
        self.names, self.order, self.span, self.limit = names, order, span, limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.times = handle, handle.getListState("times", "at long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        before = np.array([r[0] for r in self.times.get()], np.int64)
        # names that begin with an underscore don't come as they are
        new = pd.concat(rows).set_axis([*self.names, "_at"], axis=1).sort_values(["_at", *self.order])
        at = np.concatenate([before, new["_at"].to_numpy(np.int64)])
        # calls at one time count for each other, as in a range of values
        recent = (np.searchsorted(at, at, "right") - np.searchsorted(at, at - self.span, "right"))[len(before) :]
        self.times.put([(x,) for x in at[at > at[-1] - self.span].tolist()])
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer((int(at[-1]) + self.span) // 1000 + 1)
        yield new[self.names].assign(recent=recent, allowed=recent < self.limit)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.times.clear()
        yield from ()

    def close(self) -> None:
        pass


def call_log(calls: DataFrame, by: list[str], time: str, order: list[str], minutes: int = WINDOW_MINUTES, limit: int = CALLS, late: str = "1 hour") -> DataFrame:
    """``calls`` with ``recent``, the group's calls within the window up to each, and ``allowed``, whether there is room for
    another; as ``planner.rate_windows`` tells them in batch.

    State is a list of a group's times within the window.  It goes when the watermark, ``late`` behind the newest call of all
    groups, passes the window of the group's last call, so a group that is idle keeps none.  Calls of a micro-batch are taken
    in order; a later batch is later, and calls behind the watermark are dropped.
    """
    span = minutes * 60_000_000
    calls.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    out = T.StructType([*calls.schema, T.StructField("recent", T.LongType()), T.StructField("allowed", T.BooleanType())])
    micros = calls.withWatermark(time, late).withColumn("_at", F.unix_micros(F.col(time)))
    return micros.groupBy(*by).transformWithStateInPandas(_Calls(calls.columns, order, span, limit), out, "append", "EventTime")


def published_snapshots(ticks: DataFrame, keys: list[str], features: list[str], order: list[str], folder: str):
    """Every micro-batch as a snapshot: its changes from the one before, deletion markers among them, are appended to
    ``folder``/log, and the snapshot is kept beside it for the next.  A batch that is replayed replaces what it wrote."""

    def publish(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        kept = f"{folder}/snapshots/batch={batch}"
        latest_per_key(rows, keys, *(F.col(c) for c in order)).select(*keys, *features).write.mode("overwrite").parquet(kept)
        cur = spark.read.parquet(kept)
        prev = spark.read.schema(cur.schema).parquet(f"{folder}/snapshots/batch={batch - 1}") if batch else cur.limit(0)
        published_changes(prev, cur, keys, features).write.mode("overwrite").parquet(f"{folder}/log/batch={batch}")

    return published(ticks, publish, f"{folder}/state", "append")


def windowed(events: DataFrame, time: str, length: str, slide: str | None = None, late: str = "1 hour", by: tuple[str, ...] = ()) -> DataFrame:
    """Counts by window of event time, tumbling or sliding, with a bound on lateness."""
    w = F.window(time, length, slide) if slide else F.window(time, length)
    return events.withWatermark(time, late).groupBy(w.alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *by, "n")


def once(events: DataFrame, keys: list[str], time: str, late: str = "1 hour") -> DataFrame:
    """Each key's first row within the bound on lateness: retries of a source aren't counted twice."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def published(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update", every: str | None = None):
    """Hands every micro-batch to ``write(rows, batch_id)``; a batch that is replayed has its id, so writers that replace a
    batch's rows publish exactly once.  Without ``every`` it processes what has landed, and ends."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return writer.trigger(processingTime=every).start() if every else writer.trigger(availableNow=True).start()


def drained(stream: DataFrame, folder: str, mode: str = "update") -> DataFrame:
    """All rows the stream gives for what has landed, as a table in a shared folder, with ``batch_id``."""
    spark, base = stream.sparkSession, f"{folder}/stream-{uuid.uuid4().hex}"

    def write(rows: DataFrame, batch: int) -> None:
        rows.withColumn("batch_id", F.lit(batch).cast("long")).write.mode("overwrite").parquet(f"{base}/rows/batch={batch}")

    published(stream, write, f"{base}/state", mode).awaitTermination()
    return spark.read.schema(T.StructType([*stream.schema, T.StructField("batch_id", T.LongType())])).parquet(f"{base}/rows").drop("batch")
