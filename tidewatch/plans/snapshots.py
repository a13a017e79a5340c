"""Queries on snapshots: comparison, merging, capacity state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import CAPACITIES
from ..operators import diff, merge, state
from ..streaming import ticks as streams
from .tables import KEYS, SIGNALS, TICKS, read, shared_folder, signals, stored, ticks

#: The two halves that are compared, and the features that are: a band of the value, so that some rows don't change.
PREV, CUR, FEATURES = ("2024-01-10", "2024-01-15"), ("2024-01-15", "2024-01-20"), ["band", "k"]


def _half(spark: SparkSession, sf_dir: str, span: tuple[str, str]) -> DataFrame:
    e = ticks(spark, sf_dir).where((F.col("ts") >= F.lit(span[0]).cast("timestamp_ntz")) & (F.col("ts") < F.lit(span[1]).cast("timestamp_ntz")))
    rows = e.select(*KEYS, "ts", "event_id", F.floor(F.col("value") / 100).cast("int").alias("band"), (F.col("k") % 3).alias("k"))
    return diff.latest_per_key(rows, KEYS, F.col("ts"), F.col("event_id")).select(*KEYS, *FEATURES)


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return _half(spark, sf_dir, PREV), _half(spark, sf_dir, CUR)


def _half_sql(name: str, span: tuple[str, str]) -> str:
    return f"""{name} AS (SELECT user_id, event_type, CAST(floor(value / 100) AS INTEGER) AS band, k % 3 AS k FROM ticks
    WHERE ts >= TIMESTAMP '{span[0]}' AND ts < TIMESTAMP '{span[1]}'
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)"""


HALVES = f"{TICKS}, {_half_sql('p', PREV)}, {_half_sql('c', CUR)}"
ON = "c.user_id IS NOT DISTINCT FROM p.user_id AND c.event_type IS NOT DISTINCT FROM p.event_type"


def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.snapshot_diff(*_halves(spark, sf_dir), KEYS, FEATURES)


def snapshot_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.removed_rows(*_halves(spark, sf_dir), KEYS, FEATURES)


def snapshot_changed_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.changed_rows(*_halves(spark, sf_dir), KEYS, FEATURES)


def published_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.published_changes(*_halves(spark, sf_dir), KEYS, FEATURES)


def snapshot_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    prev, cur = _halves(spark, sf_dir)
    return diff.applied(prev, diff.published_changes(prev, cur, KEYS, FEATURES), KEYS, FEATURES)


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = ticks(spark, sf_dir).select(*KEYS, "ts", "event_id", F.floor(F.col("value") / 100).cast("int").alias("band"))
    return diff.change_log(e, KEYS, ["band"], "ts", "event_id")


def outer_merge_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_zonal_outer(*signals(spark, sf_dir), F.lit("2025-02-15 00:10:00"))


def left_chain_equiv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_zonal(*signals(spark, sf_dir), F.lit("2025-02-15 00:10:00"))


MERGED = f"""{SIGNALS} SELECT '2025-02-15 00:10:00' AS Time, s.InstanceType, s.Region, s.AZ, s.SPS, s.T3, s.T2, coalesce(f."IF", -1) AS "IF",
  coalesce(round(o.OndemandPrice, 5), -1) AS OndemandPrice, coalesce(round(x.SpotPrice, 5), -1) AS SpotPrice,
  coalesce(CAST(trunc(100 - round(x.SpotPrice, 5) * 100 / round(o.OndemandPrice, 5)) AS INTEGER), -1) AS Savings
  FROM scores s LEFT JOIN frequencies f USING (InstanceType, Region) LEFT JOIN ondemand o USING (InstanceType, Region) LEFT JOIN spot x USING (InstanceType, AZ)"""


def _regional(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Prices and scores by (tier, type, region); tiers may be null, some regions are of a government."""
    scores, frequencies, ondemand, spot = signals(spark, sf_dir)
    tier = F.when(F.length("InstanceType") % 2 == 0, "Standard")
    place = F.when(F.col("Region").isin("r3", "r7"), F.concat(F.lit("USGov "), "Region")).otherwise(F.col("Region"))
    keys = {"InstanceTier": tier, "Region": place}
    low = scores.select("InstanceType", "Region", "AZ").join(spot, ["InstanceType", "AZ"]).groupBy("InstanceType", "Region").agg(F.min("SpotPrice").alias("SpotPrice"))
    prices = low.join(ondemand, ["InstanceType", "Region"], "full_outer").join(frequencies, ["InstanceType", "Region"], "left")
    prices = prices.withColumn("Savings", F.round((F.col("OndemandPrice") - F.col("SpotPrice")) / F.col("OndemandPrice") * 100, 6)).withColumns(keys)
    some = scores.where("SPS > 1").select("InstanceType", "Region", F.col("AZ").alias("AvailabilityZone"), F.col("SPS").alias("Score"), "T2", "T3")
    some = some.withColumns(keys).withColumns({"DesiredCount": F.lit(1), "time": F.lit("2025-02-15 00:10:00")})
    return prices, some


def azure_merge_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_regional(*_regional(spark, sf_dir))


REGIONAL = f"""{SIGNALS}, low AS (SELECT InstanceType, Region, min(SpotPrice) AS SpotPrice FROM scores JOIN spot USING (InstanceType, AZ) GROUP BY ALL),
  named AS (SELECT coalesce(l.InstanceType, o.InstanceType) AS InstanceType, coalesce(l.Region, o.Region) AS R, OndemandPrice, SpotPrice
    FROM low l FULL JOIN ondemand o ON l.InstanceType = o.InstanceType AND l.Region = o.Region),
  prices AS (SELECT CASE WHEN length(n.InstanceType) % 2 = 0 THEN 'Standard' END AS tier, n.InstanceType, CASE WHEN R IN ('r3', 'r7') THEN 'USGov ' || R ELSE R END AS Region,
    OndemandPrice, SpotPrice, round((OndemandPrice - SpotPrice) / OndemandPrice * 100, 6) AS Savings, f."IF" FROM named n LEFT JOIN frequencies f ON f.InstanceType = n.InstanceType AND f.Region = R),
  sc AS (SELECT CASE WHEN length(InstanceType) % 2 = 0 THEN 'Standard' END AS tier, InstanceType, CASE WHEN Region IN ('r3', 'r7') THEN 'USGov ' || Region ELSE Region END AS Region,
    AZ, SPS, T2, T3 FROM scores WHERE SPS > 1)
  SELECT * FROM (SELECT coalesce(p.tier, s.tier, 'N/A') AS InstanceTier, coalesce(p.InstanceType, s.InstanceType, 'N/A') AS InstanceType, coalesce(p.Region, s.Region, 'N/A') AS Region,
    coalesce(OndemandPrice, -1) AS OndemandPrice, coalesce(SpotPrice, -1) AS SpotPrice, coalesce(Savings, -1) AS Savings, coalesce("IF", -1) AS "IF",
    CASE WHEN s.AZ IS NULL THEN -1 ELSE 1 END AS DesiredCount, coalesce(AZ, 'N/A') AS AvailabilityZone, coalesce(SPS, -1) AS Score,
    CASE WHEN s.AZ IS NULL THEN 'N/A' ELSE '2025-02-15 00:10:00' END AS Time, coalesce(T2, 0) AS T2, coalesce(T3, 0) AS T3
    FROM prices p FULL JOIN sc s ON p.tier IS NOT DISTINCT FROM s.tier AND p.InstanceType IS NOT DISTINCT FROM s.InstanceType AND p.Region IS NOT DISTINCT FROM s.Region)
  WHERE NOT (OndemandPrice = -1 AND SpotPrice = -1 AND Savings = -1 AND "IF" = -1) AND NOT contains(lower(Region), 'gov') AND NOT (Score = -1 AND AvailabilityZone = 'N/A')"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks with a score of 1 to 3, some without, and, by turns, one of the capacities."""
    from pyspark.sql import Window

    i = F.row_number().over(Window.partitionBy(*KEYS).orderBy("ts", "event_id")) - 1
    caps = F.element_at(F.lit(list(CAPACITIES)), (i % len(CAPACITIES) + 1).cast("int"))
    score = F.when(F.col("k") % 7 != 0, (1 + F.col("k") % 3).cast("int"))
    return ticks(spark, sf_dir).select(*KEYS, "ts", "event_id", score.alias("score"), caps.alias("capacity"))


def t2t3_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.capacity_fold(_scored(spark, sf_dir), KEYS, ["ts", "event_id"])


def fold_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fold of all ticks, made of one that lacked some and of states before these: only their keys are folded again."""
    scored, day = stored(_scored(spark, sf_dir), "scored"), F.lit("2024-01-20").cast("timestamp_ntz")
    came_late = (F.col("event_id") % 97 == 0) & (F.col("ts") >= day)
    order, early = ["ts", "event_id"], stored(state.capacity_fold(scored.where(F.col("ts") < day), KEYS, ["ts", "event_id"]), "states")
    since = scored.where((F.col("ts") >= day) & ~came_late)
    after = state.capacity_fold(since, KEYS, order, initial=early)
    return state.backfilled(early, after, since, scored.where(came_late), KEYS, order)


def t2t3_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of one half carried to the ticks of the other, at capacities of 1 and 5; some ticks have no score."""
    at = F.when(F.col("user_id") % 2 == 0, 1).otherwise(5)
    t3, t2 = state.tick_levels(F.col("SPS"), at)
    score = F.when(F.col("band") % 4 != 0, 1 + F.col("k"))
    prev, cur = (h.select(*KEYS, score.alias("SPS"), (F.abs("band") * 5 % 55).cast("int").alias("cap")) for h in _halves(spark, sf_dir))
    prev = prev.select(*KEYS, "SPS", F.when(F.col("SPS") >= 3, F.col("cap")).otherwise(0).alias("T3"), F.when(F.col("SPS") >= 2, F.col("cap")).otherwise(0).alias("T2"))
    cur = cur.select(*KEYS, "SPS", t3.alias("T3"), t2.alias("T2"), at.alias("TargetCapacity"))
    return state.capacity_step(prev, cur, KEYS)


def _step_sql(score: str, cap: str, pscore: str, p3: str, p2: str) -> tuple[str, str, str]:
    below = "CASE " + " ".join(f"WHEN {cap} = {k} THEN {v}" for k, v in state.FALLBACK.items()) + " ELSE 0 END"
    before = f"coalesce({pscore}, {score})"  # a key without a score before takes the tick's
    filled = f"(CASE WHEN {cap} = 1 THEN coalesce({score}, {before}) ELSE {score} END)"  # single nodes: filled, then tested
    raised = f"(CASE WHEN {filled} > {before} THEN {filled} ELSE {before} END)"
    kept = f"(CASE WHEN {cap} = 1 THEN {filled} ELSE {raised} END)"
    t3 = f"CASE WHEN {kept} <= 2 THEN 0 WHEN {filled} >= 3 THEN greatest(CASE WHEN {score} >= 3 THEN {cap} ELSE 0 END, coalesce({p3}, 0)) ELSE least({below}, coalesce({p3}, 0)) END"
    t2 = f"CASE WHEN {kept} < 2 THEN 0 WHEN {filled} >= 2 THEN greatest(CASE WHEN {score} = 2 THEN {cap} ELSE 0 END, coalesce({p2}, 0)) ELSE least({below}, coalesce({p2}, 0)) END"
    return kept, t3, t2


_S = _step_sql("s.SPS", "s.cap", "q.SPS", "q.T3", "q.T2")
_SCORE = "CASE WHEN band % 4 <> 0 THEN 1 + k END AS SPS"
STEP = f"""{HALVES}, b AS (SELECT user_id, event_type, band, {_SCORE} FROM p), q AS (SELECT user_id, event_type, SPS, CASE WHEN SPS >= 3 THEN abs(band) * 5 % 55 ELSE 0 END AS T3, CASE WHEN SPS >= 2 THEN abs(band) * 5 % 55 ELSE 0 END AS T2 FROM b),
  s AS (SELECT user_id, event_type, CASE WHEN user_id % 2 = 0 THEN 1 ELSE 5 END AS cap, {_SCORE} FROM c)
  SELECT s.user_id, s.event_type, CAST({_S[0]} AS INTEGER) AS SPS, CAST({_S[1]} AS INTEGER) AS T3, CAST({_S[2]} AS INTEGER) AS T2, s.cap AS TargetCapacity FROM s LEFT JOIN q USING (user_id, event_type)"""
_F = _step_sql("t.score", "t.capacity", "f.sps", "f.t3", "f.t2")
FOLD = f"""WITH RECURSIVE ticks AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
  numbered AS (SELECT user_id, event_type, CASE WHEN k % 7 <> 0 THEN 1 + k % 3 END AS score, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM ticks),
  t AS (SELECT user_id, event_type, score, rn, [{", ".join(map(str, CAPACITIES))}][1 + (rn - 1) % {len(CAPACITIES)}] AS capacity FROM numbered),
  f AS (SELECT user_id, event_type, CAST(0 AS BIGINT) AS rn, CAST(NULL AS INTEGER) AS sps, 0 AS t3, 0 AS t2 FROM t WHERE rn = 1
    UNION ALL SELECT t.user_id, t.event_type, t.rn, CAST({_F[0]} AS INTEGER), CAST({_F[1]} AS INTEGER), CAST({_F[2]} AS INTEGER)
    FROM f JOIN t ON t.user_id = f.user_id AND t.event_type = f.event_type AND t.rn = f.rn + 1)
  SELECT user_id, event_type, sps, t3, t2 FROM f QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY rn DESC) = 1"""


def stream_tick_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fold as a stream over landed ticks; the last state of each key is the batch fold's."""
    scored = _scored(spark, sf_dir)
    folder = shared_folder(spark)
    path = f"{folder}/ticks-{streams.uuid.uuid4().hex}"
    scored.withColumn("ts", F.col("ts").cast("timestamp")).repartition(*KEYS).write.parquet(path)
    schema = spark.read.parquet(path).schema
    states = streams.drained(streams.capacity_states(streams.landed(spark, path, schema), KEYS, ["ts", "event_id"]), folder)
    return diff.latest_per_key(states, KEYS, F.col("batch_id")).select(*KEYS, "sps", "t3", "t2")


def stream_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fold as micro-batches whose state is a table; ticks land in three parts of time."""
    scored = stored(_scored(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp")), "scored")
    folder = f"{shared_folder(spark)}/fold-{streams.uuid.uuid4().hex}"
    at = F.when(F.col("ts") < F.lit("2024-01-10").cast("timestamp"), 0).when(F.col("ts") < F.lit("2024-01-20").cast("timestamp"), 1).otherwise(2)
    for part in range(3):
        scored.where(at == part).coalesce(1).write.mode("append").parquet(f"{folder}/landed")
    landed = streams.landed(spark, f"{folder}/landed", scored.schema, files_per_batch=1)
    streams.folded_states(landed, KEYS, ["ts", "event_id"], folder).awaitTermination()
    return spark.read.parquet(f"{folder}/states/batch=2").select(*KEYS, "sps", "t3", "t2")


def stream_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change suppression as a stream; the rows are those of change_log."""
    folder = shared_folder(spark)
    path = f"{folder}/ticks-{streams.uuid.uuid4().hex}"
    e = ticks(spark, sf_dir).select(*KEYS, F.col("ts").cast("timestamp").alias("ts"), "event_id", F.floor(F.col("value") / 100).cast("int").alias("band"))
    e.repartition(*KEYS).write.parquet(path)
    changes = streams.changes_only(streams.landed(spark, path, e.schema), KEYS, ["ts", "event_id"], ["band"])
    return streams.drained(changes, folder, "append").select(*KEYS, F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id", "band")


def stream_call_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls within 62 minutes as a stream; the rows are those of sliding_62m."""
    folder = shared_folder(spark)
    path = f"{folder}/calls-{streams.uuid.uuid4().hex}"
    e = read(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    e.repartition(4, "event_type").write.parquet(path)
    counted = streams.call_log(streams.landed(spark, path, e.schema), ["event_type"], "ts", ["event_id"], limit=20)
    return streams.drained(counted, folder, "append").select("event_id", "recent", "allowed")


def stream_removals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots as micro-batches: what the second one changes and removes."""
    folder = f"{shared_folder(spark)}/removals-{streams.uuid.uuid4().hex}"
    for i, half in enumerate(_halves(spark, sf_dir)):
        rows = half.withColumn("tick", F.lit(i)).coalesce(1)
        rows.write.mode("append").parquet(f"{folder}/landed")
    schema = rows.schema
    source = streams.landed(spark, f"{folder}/landed", schema, files_per_batch=1)
    streams.published_snapshots(source, KEYS, FEATURES, ["tick"], folder).awaitTermination()
    log = spark.read.parquet(f"{folder}/log")
    return log.where("batch = 1").select(*KEYS, *FEATURES, "Ceased")


def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-minute counts as a stream with a watermark, in update mode; the last count of each window is kept."""
    folder = shared_folder(spark)
    schema = read(spark, sf_dir, "events").schema
    rows = streams.landed(spark, sf_dir, schema, "events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    counts = streams.drained(streams.windowed(rows, "ts", "10 minutes", late="30 days", by=("event_type",)), folder)
    newest = diff.latest_per_key(counts, ["start", "event_type"], F.col("batch_id"))
    return newest.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


CHANGES = f"""{TICKS}, b AS (SELECT user_id, event_type, ts, event_id, CAST(floor(value / 100) AS INTEGER) AS band FROM ticks)
  SELECT * FROM b WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id) QUALIFY row_number() OVER w = 1 OR band IS DISTINCT FROM lag(band) OVER w"""

QUERIES = {
    "snapshot_diff": snapshot_diff, "snapshot_removed": snapshot_removed, "snapshot_changed_left": snapshot_changed_left, "published_changes": published_changes,
    "snapshot_replay": snapshot_replay, "change_log": change_log, "outer_merge_sentinels": outer_merge_sentinels, "left_chain_equiv": left_chain_equiv,
    "azure_merge_filters": azure_merge_filters, "t2t3_step": t2t3_step, "t2t3_fold": t2t3_fold, "fold_backfill": fold_backfill, "stream_tick_state": stream_tick_state, "stream_fold": stream_fold,
    "stream_change_log": stream_change_log, "stream_windows": stream_windows, "stream_call_log": stream_call_log, "stream_removals": stream_removals,
}

_CHANGED = f"""SELECT c.user_id, c.event_type, c.band, c.k FROM c LEFT JOIN (SELECT *, true AS there FROM p) p ON {ON}
  WHERE p.there IS NULL OR c.band IS DISTINCT FROM p.band OR c.k IS DISTINCT FROM p.k"""
_GONE = f"SELECT p.user_id, p.event_type, 0 AS band, 0 AS k, true AS Ceased FROM p ANTI JOIN c ON {ON}"

ORACLE_SQL = {
    "snapshot_diff": f"""{HALVES} SELECT coalesce(c.user_id, p.user_id) AS user_id, coalesce(c.event_type, p.event_type) AS event_type, c.band, c.k, p.band AS prev_band, p.k AS prev_k,
      CASE WHEN p.there IS NULL THEN 'new' WHEN c.there IS NULL THEN 'removed' ELSE 'changed' END AS change
      FROM (SELECT *, true AS there FROM c) c FULL JOIN (SELECT *, true AS there FROM p) p ON {ON}
      WHERE p.there IS NULL OR c.there IS NULL OR c.band IS DISTINCT FROM p.band OR c.k IS DISTINCT FROM p.k""",
    "snapshot_removed": f"{HALVES} {_GONE}",
    "snapshot_changed_left": f"{HALVES} {_CHANGED}",
    "published_changes": f"{HALVES} SELECT *, false AS Ceased FROM ({_CHANGED}) UNION ALL {_GONE}",
    "snapshot_replay": f"{HALVES} SELECT * FROM c",
    "change_log": CHANGES,
    "outer_merge_sentinels": MERGED,
    "left_chain_equiv": MERGED,
    "azure_merge_filters": REGIONAL,
    "t2t3_step": STEP,
    "t2t3_fold": FOLD,
    "fold_backfill": FOLD,
    "stream_tick_state": FOLD,
    "stream_fold": FOLD,
    "stream_change_log": CHANGES,
    "stream_call_log": """SELECT event_id, n AS recent, n < 20 AS allowed FROM (SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY epoch_us(ts)
      RANGE BETWEEN 3719999999 PRECEDING AND CURRENT ROW) AS n FROM events)""",
    "stream_removals": f"{HALVES} SELECT *, false AS Ceased FROM ({_CHANGED}) UNION ALL {_GONE}",
    "stream_windows": "SELECT time_bucket(INTERVAL '10 minutes', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL",
}
