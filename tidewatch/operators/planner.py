"""Planning of requests: packing, covers, chunks, rotations and rate windows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources.store import stored
from . import slices

#: Zones of a query, queries of a batch; regions and types of a request; calls and minutes of a window; types
#: from which on a region counts as large.
PACK, BATCH = 10, 50
REGIONS, TYPES = 8, 5
CALLS, WINDOW_MINUTES = 10, 62
LARGE_REGION = 100
#: New pairs that a request has to cover to be made, round by round; the most are REGIONS * TYPES.
GAINS = (30, 15, 5, 1)
#: Regions and types of the part of a support relation that one task covers, at most.
TASK_REGIONS, TASK_TYPES = 64, 1000


def _in_tens(weights: list[int]) -> list[list[int]]:
    """Bins of capacity 10, as few as possible, as lists of places in ``weights``, which are from 1 to 10.

    In linear time, by three facts.  Two weights of 10 together share a bin in some best packing, as what shared theirs fits one
    bin.  Ones go last, into what room there is.  Of the rest, loads are told in twos, rounded up: a 4 counts 2, a 3 by itself 2,
    two of them 3, a 5 counts 3 and with a 3 it counts 4; a bin holds 5, and again 4 and 1, or 3 and 2, share a bin.  How many 3s
    are by themselves is tried out.
    """
    at: dict[int, list[int]] = {w: [] for w in range(1, 11)}
    for i, w in enumerate(weights):
        at[w].append(i)
    bins = [[i] for i in at[10]]
    for w in range(1, 6):
        while at[w] and len(at[10 - w]) > (w == 5):
            bins.append([at[w].pop(), at[10 - w].pop()])
    bins += [[i] for i in at[9]]

    def counts(lone: int, joined: int) -> tuple[int, int, int, int]:
        pairs = (len(at[3]) - joined - lone) // 2
        return len(at[2]), len(at[4]) + lone, len(at[6]) + pairs + len(at[5]) - joined, len(at[8]) + len(at[7]) + joined

    def needed(one: int, two: int, three: int, four: int) -> int:
        n = max(one, four) if four > one else four
        one, m = max(0, one - four), min(two, three)
        two, three, n = two - m, three - m, n + m + three - m
        room = 2 * three + (5 * -(-two // 2) - 2 * two)
        return n + -(-two // 2) + -(-max(0, one - room) // 5)

    ways = [(lone, joined) for joined in range(1 + (len(at[5]) > 0 and len(at[3]) > 0)) for lone in range((len(at[3]) - joined) % 2, len(at[3]) - joined + 1, 2)]
    lone, joined = min(ways, key=lambda way: needed(*counts(*way)))
    groups: dict[int, list[list[int]]] = {1: [[i] for i in at[2]], 2: [[i] for i in at[4]], 3: [[i] for i in at[6]], 4: [[i] for i in at[8] + at[7]]}
    threes, fives = at[3].copy(), at[5].copy()
    groups[2] += [[threes.pop()] for _ in range(lone)]
    groups[4] += [[threes.pop(), fives.pop()] for _ in range(joined)]
    groups[3] += [[i] for i in fives] + [threes[i : i + 2] for i in range(0, len(threes), 2)]
    rest: list[tuple[int, list[int]]] = []  # room in twos, what is in the bin
    for small, large in ((1, 4), (2, 3)):
        while groups[small] and groups[large]:
            rest.append((0, groups[small].pop() + groups[large].pop()))
    rest += [(5 - u, g) for u in (4, 3) for g in groups[u]]
    rest += [(5 - 2 * len(pair), [i for g in pair for i in g]) for k in range(0, len(groups[2]), 2) for pair in [groups[2][k : k + 2]]]
    twos = groups[1]
    for room, held in rest:
        for _ in range(min(room, len(twos))):
            held += twos.pop()
    bins += [held for _, held in rest]
    bins += [[i for g in twos[k : k + 5] for i in g] for k in range(0, len(twos), 5)]
    ones = at[1]
    for held in bins:
        room = 10 - sum(weights[i] for i in held)
        held += [ones.pop() for _ in range(min(room, len(ones)))]
    return bins + [ones[k : k + 10] for k in range(0, len(ones), 10)]


def packed(weights: list[int]) -> list[int] | None:
    """A bin of capacity ``PACK`` for each weight with as few bins as possible; None if one doesn't fit.  Weights of 0 are in the
    first bin."""
    if any(w > PACK for w in weights):
        return None
    out = [0] * len(weights)
    some = [i for i, w in enumerate(weights) if w > 0]
    for b, held in enumerate(_in_tens([weights[i] for i in some])):
        for k in held:
            out[some[k]] = b
    return out


def bin_packed(zones: DataFrame) -> DataFrame:
    """(InstanceType, Region, n) with the query ``bin`` of each.  A region of more than ``PACK`` zones has a row and a bin of
    its own for each full ``PACK`` of them, and a row for the rest, which is packed with those of other regions.

    A group is one instance type: it has a row for each region, so its size is bounded by the number of regions.
    """

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("Region")
        full = pdf.loc[pdf.index.repeat(pdf["n"] // PACK)].assign(n=PACK)
        rest = pdf.assign(n=pdf["n"] % PACK)[(pdf["n"] % PACK > 0) | (pdf["n"] == 0)]
        bins = packed(rest["n"].tolist())
        first = max(bins, default=-1) + 1
        return pd.concat([rest.assign(bin=bins), full.assign(bin=range(first, first + len(full)))])[["InstanceType", "Region", "n", "bin"]]

    return zones.select("InstanceType", "Region", "n").groupBy("InstanceType").applyInPandas(pack, "InstanceType string, Region string, n long, bin int")


def request_batches(bins: DataFrame, size: int = BATCH) -> DataFrame:
    """Queries (one for each type and bin) in batches of ``size``: ``batch`` and ``queries`` (instance, regions, n)."""
    one = bins.groupBy("InstanceType", "bin").agg(F.array_sort(F.collect_list("Region")).alias("regions"), F.sum("n").cast("int").alias("n"))
    ranked = slices.numbered(one, ["InstanceType", "bin"], "i")
    entry = F.struct("i", F.col("InstanceType").alias("instance"), "regions", "n")
    return ranked.groupBy(F.ceil(F.col("i") / size).cast("int").alias("batch")).agg(F.array_sort(F.collect_list(entry)).alias("queries"))


def grouped_requests(support: DataFrame) -> DataFrame:
    """Requests (``regions``, ``types``) that cover the support relation: regions by number of types in groups of 8, small and
    large ones apart, with the union of their types in chunks of 5."""
    per = support.dropna("any").distinct().groupBy("RegionCode").agg(F.count("*").alias("n"), F.collect_set("InstanceType").alias("types"))
    per = per.withColumn("large", F.col("n") >= LARGE_REGION)
    i = F.row_number().over(Window.partitionBy("large").orderBy(F.desc("n"), "RegionCode"))  # a row for each region
    groups = per.withColumn("g", F.floor((i - 1) / REGIONS)).groupBy("large", "g").agg(
        F.array_sort(F.collect_list("RegionCode")).alias("regions"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("types")))).alias("types")
    )
    return groups.select("regions", F.explode(S.chunked(F.col("types"), TYPES)).alias("types"))


def greedy_cover(pairs: set[tuple[str, str]]) -> Iterator[tuple[list[str], list[str]]]:
    """Requests of at most 8 regions and 5 types that cover all pairs; each grows by what covers most new ones, ties by name."""
    left = set(pairs)
    by_region: dict[str, set[str]] = {}
    by_type: dict[str, set[str]] = {}
    for r, t in left:
        by_region.setdefault(r, set()).add(t)
        by_type.setdefault(t, set()).add(r)
    while left:
        r, t = min(left)
        regions, types = {r}, {t}
        while True:
            gains = [(-len(by_region[x] & types), 0, x) for x in by_region if x not in regions] if len(regions) < REGIONS else []
            gains += [(-len(by_type[x] & regions), 1, x) for x in by_type if x not in types] if len(types) < TYPES else []
            best = min(gains, default=(0, 0, ""))
            if best[0] == 0:
                break
            (types if best[1] else regions).add(best[2])
        for r in regions:
            for t in types & by_region.get(r, set()):
                left.discard((r, t))
                by_type[t].discard(r)
            by_region.get(r, set()).difference_update(types)
        yield sorted(regions), sorted(types)


def _dealt(pairs: DataFrame, turn: int, parts: int) -> DataFrame:
    """``pairs`` with the block of each: names that share a partner, told by a hash of the turn, are next to each other, and
    ``TASK_REGIONS`` regions and ``TASK_TYPES`` types that follow each other are a block."""
    out = pairs.withColumn("_part", F.pmod(F.xxhash64("RegionCode"), F.lit(parts)))
    for c, other, size in (("RegionCode", "InstanceType", TASK_REGIONS), ("InstanceType", "RegionCode", TASK_TYPES)):
        names = pairs.groupBy(c).agg(F.min(F.xxhash64(F.lit(turn), other)).alias("_like"))
        names = slices.numbered(names, ["_like", c], "_i", 0).select(c, F.floor(F.col("_i") / size).alias(f"_{c}"))
        out = out.join(names, c)
    return out


def covering_requests(support: DataFrame, parts: int = 1) -> DataFrame:
    """Requests (``regions``, ``types``) that together cover the support relation (RegionCode, InstanceType).

    Regions are dealt to ``parts`` groups, and names into blocks of at most ``TASK_REGIONS`` regions and ``TASK_TYPES`` types,
    each covered in one task by growing requests.  A request that covers less than a round asks for isn't made: its pairs go
    to the next round, which asks for less and deals out anew what is left, so that pairs of different blocks that go
    together meet.  The last round takes every pair.
    """

    def cover(least: int):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            left = set(zip(pdf["RegionCode"], pdf["InstanceType"], strict=True))
            made, out = list(greedy_cover(left)), []
            for regions, types in made:
                new = {(r, t) for r in regions for t in types} & left
                left -= new
                out += [(regions, types, None, None)] if len(new) >= least else [(None, None, r, t) for r, t in new]
            return pd.DataFrame(out, columns=["regions", "types", "RegionCode", "InstanceType"])

        return run

    left, found = stored(support.select("RegionCode", "InstanceType").dropna("any").distinct(), "cover-pairs"), None
    for turn, least in enumerate(GAINS):
        out = _dealt(left, turn, parts).groupBy("_part", "_RegionCode", "_InstanceType").applyInPandas(cover(least), "regions array<string>, types array<string>, RegionCode string, InstanceType string")
        out = stored(out, "cover")
        made, left = out.where("regions is not null").select("regions", "types"), out.where("regions is null").select("RegionCode", "InstanceType")
        found = made if found is None else found.unionByName(made)
        if not left.take(1):
            break
    return found


def clustered_requests(support: DataFrame, clusters: int = 2, seed: int = 0) -> DataFrame:
    """Requests by clusters: regions and types are grouped by k-means over the support relation's rows and columns, each
    pair of clusters asks its 8 most frequent regions for its 5 most frequent types, and a greedy cover takes the rest."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import CountVectorizer

    pairs = support.dropna("any").distinct()

    def clustered(by: str, other: str) -> DataFrame:
        rows = pairs.groupBy(by).agg(F.array_sort(F.collect_set(other)).alias("has"))
        kinds = rows.groupBy("has").agg(F.count("*").alias("weight"))  # equal rows are one point, so that no two centres start alike
        vectors = CountVectorizer(inputCol="has", outputCol="features", binary=True).fit(kinds).transform(kinds)
        if vectors.count() < clusters:
            return rows.select(by, F.lit(0).alias(f"c_{by}"))
        model = KMeans(k=clusters, seed=seed, initMode="random", weightCol="weight").fit(vectors)
        return rows.join(model.transform(vectors).select("has", F.col("prediction").alias(f"c_{by}")), "has").select(by, f"c_{by}")

    labelled = pairs.join(clustered("RegionCode", "InstanceType"), "RegionCode").join(clustered("InstanceType", "RegionCode"), "InstanceType")
    both = ["c_RegionCode", "c_InstanceType"]

    def top(by: str, k: int) -> DataFrame:
        n = labelled.groupBy(*both, by).agg(F.count("*").alias("n"))
        return top_k(n, both, k, F.desc("n"), F.col(by)).select(*both, by)

    chosen = labelled.join(top("RegionCode", REGIONS), [*both, "RegionCode"], "left_semi").join(top("InstanceType", TYPES), [*both, "InstanceType"], "left_semi")
    first = chosen.groupBy(*both).agg(F.array_sort(F.collect_set("RegionCode")).alias("regions"), F.array_sort(F.collect_set("InstanceType")).alias("types"))
    rest = pairs.join(chosen.select("RegionCode", "InstanceType"), ["RegionCode", "InstanceType"], "left_anti")
    return first.select("regions", "types").unionByName(covering_requests(rest))


def top_k(df: DataFrame, by: list[str], k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of each group by a total order."""
    return df.withColumn("_i", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_i") <= k).drop("_i")


def chunk_pairs(regions: DataFrame, types: DataFrame, region_size: int = REGIONS, type_size: int = TYPES) -> DataFrame:
    """All pairs of a chunk of regions and a chunk of types: the requests that ask everything of everything."""

    def chunks(df: DataFrame, c: str, size: int) -> DataFrame:
        i = F.row_number().over(Window.orderBy(c)) - 1  # a row for each name
        return df.select(c).distinct().withColumn("i", F.floor(i / size)).groupBy("i").agg(F.array_sort(F.collect_list(c)).alias(c)).drop("i")

    r, t = chunks(regions, "RegionCode", region_size), chunks(types, "InstanceType", type_size)
    return r.crossJoin(t)  # the requests themselves: each is a row of the result


def rotation(spark: SparkSession, start: str, ticks: int, values: list[int], minutes: int = 10) -> DataFrame:
    """Which value each tick takes in turn: ``tick``, ``ts``, ``value``; a closed form, no state."""
    ts = F.timestamp_seconds(F.unix_timestamp(F.lit(start).cast("timestamp")) + F.col("id") * minutes * 60)
    turn = F.element_at(F.lit(values), (F.col("id") % len(values) + 1).cast("int"))
    return spark.range(ticks).select(F.col("id").alias("tick"), ts.alias("ts"), turn.alias("value"))


def half_swapped(index: Column, day: Column, size: int) -> Column:
    """Credential of a request: on every other day the two halves change places."""
    half = size // 2
    return F.when(day % 2 == 0, index).otherwise(F.when(index < half, index + half).otherwise(index - half))


def rate_windows(calls: DataFrame, by: list[str], time: str = "ts", minutes: int = WINDOW_MINUTES, limit: int = CALLS, over_limit: Column | None = None) -> DataFrame:
    """``recent``, calls of the group within the window up to each (one just as old as the window isn't), and ``allowed``,
    whether there is room for another and the group isn't marked as over its limit."""
    marked = F.coalesce(over_limit, F.lit(False)) if over_limit is not None else F.lit(False)
    seconds = F.unix_micros(F.col(time).cast("timestamp"))
    w = Window.partitionBy(*by).orderBy(seconds).rangeBetween(-minutes * 60_000_000 + 1, Window.currentRow)
    return calls.withColumn("recent", F.count("*").over(w)).withColumn("allowed", (F.col("recent") < limit) & ~marked)


def allocated(requests: DataFrame, order: list[str], subscriptions: list[str], locations: list[str], after: int = 0) -> DataFrame:
    """(subscription, location) for each request, in turn, resuming after the pair number ``after``."""
    n, m = len(subscriptions), len(locations)
    i = F.pmod(F.col("_i"), F.lit(n * m))
    turns = {"subscription": F.element_at(F.lit(subscriptions), (i / m).cast("int") + 1), "location": F.element_at(F.lit(locations), (i % m + 1).cast("int"))}
    return slices.numbered(requests, order, "_i", after).withColumns(turns).drop("_i")


def allocated_with_room(requests: DataFrame, order: list[str], pairs: DataFrame, after: int = -1, limit: int = CALLS) -> DataFrame:
    """(subscription, location) for each request, in turn, passing over pairs without room: null when none has any left.

    ``pairs`` (subscription, location, ``place`` from 0, ``recent`` calls, ``over_limit``) has a row for each pair; turns
    resume after the pair at ``after``.  A pair that has room for n calls is in the first n rounds, so the slots are the
    pairs by round and place, and the k-th request takes the k-th slot.
    """
    room = F.when(F.coalesce("over_limit", F.lit(False)), 0).otherwise(limit - F.coalesce("recent", F.lit(0))).cast("int")
    n = pairs.agg(F.count("*").alias("_n"))
    turn = F.pmod(F.col("place") - (after + 1), F.col("_n"))
    slots = pairs.crossJoin(F.broadcast(n)).where(room > 0).select("subscription", "location", turn.alias("_turn"), F.explode(F.sequence(F.lit(1), room)).alias("_round"))  # n is one row
    slots = slices.numbered(slots, ["_round", "_turn"], "_k").select("subscription", "location", "_k")
    ranked = slices.numbered(requests, order, "_k")
    return ranked.join(slots, "_k", "left").drop("_k")


def credentials_kept(requests: DataFrame, known: DataFrame, key: str, start: int = 0) -> DataFrame:
    """``requests`` with a ``credential`` number each: what is in ``known(key, credential)`` stays, new requests take the next
    numbers in the order of their keys.  The result's keys and credentials are the mapping for the next time."""
    new = requests.select(key).distinct().join(known.select(key), key, "left_anti")
    used = F.greatest(F.coalesce(F.max("credential") + 1, F.lit(start)), F.lit(start)).alias("_next")
    fresh = slices.numbered(new, [key], "_i", 0).crossJoin(F.broadcast(known.agg(used)))  # one row
    mapping = known.select(key, F.col("credential").cast("long").alias("credential")).unionByName(fresh.select(key, (F.col("_next") + F.col("_i")).cast("long").alias("credential")))
    return requests.join(mapping, key)


def with_missing_pairs(state: DataFrame, subscriptions: DataFrame, locations: DataFrame) -> DataFrame:
    """The call state with an entry, without calls, for each new subscription and location."""
    pairs = subscriptions.select("subscription").crossJoin(locations.select("location"))  # the state has a row for each
    new = pairs.join(state, ["subscription", "location"], "left_anti")
    return state.unionByName(new, allowMissingColumns=True)


def without(df: DataFrame, column: str, *invalid: DataFrame) -> DataFrame:
    """Rows whose value is in none of the lists."""
    for bad in invalid:
        df = df.join(bad.select(column), column, "left_anti")
    return df


def headroom(calls: DataFrame, subscriptions: int, locations: int, limit: int = CALLS) -> DataFrame:
    """Calls made and calls left in the window over all subscriptions and locations."""
    return calls.agg(F.count("*").alias("made")).withColumn("left", F.lit(subscriptions * locations * limit) - F.col("made"))


def _choose(n: Column, k: int) -> Column:
    """Ways to choose 2 or 3 of n."""
    return F.floor(n * (n - 1) / 2) if k == 2 else F.floor(n * (n - 1) * (n - 2) / 6)


def _one_score(scores: DataFrame) -> DataFrame:
    """A score for each type and zone; of several the largest counts."""
    return scores.select("InstanceType", "AZ", "SPS").dropna("any").groupBy("InstanceType", "AZ").agg(F.max("SPS").alias("SPS"))


def triple_counts(scores: DataFrame, sums: list[int]) -> DataFrame:
    """How many triples of instance types each zone has by their scores: ``AZ``, ``s1`` <= ``s2`` <= ``s3``, how many types have
    each (``n1``, ``n2``, ``n3``), their sum ``total``, one of ``sums``, and ``n``.  Made of counts: a few rows for each zone."""
    per = _one_score(scores).groupBy("AZ", "SPS").agg(F.count("*").alias("n"))
    one, two, three = (per.select("AZ", F.col("SPS").alias(f"s{i}"), F.col("n").alias(f"n{i}")) for i in (1, 2, 3))
    all_ = one.join(two, "AZ").where("s1 <= s2").join(three, "AZ").where("s2 <= s3").withColumn("total", F.col("s1") + F.col("s2") + F.col("s3"))
    a, b, c = F.col("n1"), F.col("n2"), F.col("n3")
    same = F.col("s1") == F.col("s2"), F.col("s2") == F.col("s3")
    n = F.when(same[0] & same[1], _choose(a, 3)).when(same[0], _choose(a, 2) * c).when(same[1], a * _choose(b, 2)).otherwise(a * b * c)
    return all_.where(F.col("total").isin(sums)).withColumn("n", n.cast("long")).where("n > 0")


def _largest(rank: Column, k: int) -> Column:
    """The largest number of which ``_choose`` gives at most ``rank``: near the root, then exactly."""
    root = F.floor(F.sqrt(2.0 * rank)) if k == 2 else F.floor(F.cbrt(6.0 * rank))
    near = F.transform(F.sequence(F.lit(-1), F.lit(3)), lambda d: (root + d).cast("long"))
    return F.array_max(F.filter(near, lambda m: (m >= k - 1) & (_choose(m, k) <= rank)))


def _unranked(rank: Column) -> list[Column]:
    """The places, from 0, in the groups of scores that make the triple of a rank among those of its zone and scores."""
    a, b = F.col("n1"), F.col("n2")

    def pair(r: Column) -> tuple[Column, Column]:
        high = _largest(r, 2)
        return r - _choose(high, 2), high

    top = _largest(rank, 3)
    ways = (
        (top, *pair(rank - _choose(top, 3))),
        (*pair(rank % _choose(a, 2)), F.floor(rank / _choose(a, 2))),
        (rank % a, *pair(F.floor(rank / a))),
        (rank % a, F.floor(rank / a) % b, F.floor(rank / a / b)),
    )
    same = F.col("s1") == F.col("s2"), F.col("s2") == F.col("s3")
    return [F.when(same[0] & same[1], x).when(same[0], y).when(same[1], z).otherwise(w).cast("long") for x, y, z, w in zip(*ways, strict=True)]


def stratified_triples(scores: DataFrame, sums: list[int], most: int = 200, per_score: int | None = None, seed: int = 0) -> DataFrame:
    """Random triples of instance types of one zone (``AZ``, ``a``, ``b``, ``c``, ``total``) whose scores have a wanted sum,
    each once, at most ``most`` for each sum, and as many as that if there are.

    ``scores`` has InstanceType, AZ, SPS.  Triples aren't made to be drawn from: the number of those of each zone and sum
    is known from counts, ranks are drawn, and each names its three types.  A sum that has too few different ones
    among its draws is drawn from again, more often, in the end by all its ranks.  With ``per_score`` only so many types
    of each zone and score, told by a hash, are drawn from.
    """
    spark = scores.sparkSession
    types = _one_score(scores)
    if per_score:
        types = top_k(types, ["AZ", "SPS"], per_score, F.xxhash64(F.lit(seed), "InstanceType", "AZ"), F.col("InstanceType"))
    types = slices.numbered(types, ["AZ", "SPS", "InstanceType"], "_no", 0)
    group = types.groupBy("AZ", "SPS").agg(F.min("_no").alias("_first"))
    types = stored(types.join(group, ["AZ", "SPS"]).select("InstanceType", "AZ", "SPS", (F.col("_no") - F.col("_first")).alias("_place")), "typed-scores")
    w = Window.partitionBy("total").orderBy("AZ", "s1", "s2", "s3")  # a few rows for each zone
    counts = stored(triple_counts(types, sums).withColumn("_from", F.sum("n").over(w) - F.col("n")), "triple-counts")
    left = {r["total"]: r["n"] for r in counts.groupBy("total").agg(F.sum("n").alias("n")).collect()}  # a row for each sum
    draws, found = 2 * most, None
    while left:
        asked = spark.createDataFrame(list(left.items()), "total long, _all long").withColumn("_i", F.explode(F.sequence(F.lit(0), F.least(F.lit(draws), F.col("_all")) - 1)))
        by_hash = F.pmod(F.xxhash64(F.lit(seed), "total", "_i"), F.col("_all"))
        asked = asked.select("total", "_i", F.when(F.col("_all") <= draws, F.col("_i")).otherwise(by_hash).alias("_rank"), F.xxhash64(F.lit(seed), "total", "_i").alias("_turn"))
        # the last zone and scores that begin at or before a rank
        both = counts.select(F.col("total").cast("long").alias("total"), F.col("_from").alias("_rank"), F.struct("AZ", "_from", "s1", "s2", "s3", "n1", "n2").alias("_of"))
        both = both.unionByName(asked, allowMissingColumns=True)
        order = Window.partitionBy("total").orderBy("_rank", F.col("_i").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
        picks = both.withColumn("_of", F.last("_of", ignorenulls=True).over(order)).where("_i is not null").select("total", "_i", "_turn", "_rank", "_of.*")
        places = _unranked(F.col("_rank") - F.col("_from"))
        named = F.array(*(F.struct(F.col(f"s{k}").alias("SPS"), p.alias("_place")) for k, p in zip((1, 2, 3), places, strict=True)))
        picks = picks.select("total", "_i", "_turn", "AZ", F.explode(named).alias("_t")).select("total", "_i", "_turn", "AZ", "_t.*")
        triples = types.join(F.broadcast(picks), ["AZ", "SPS", "_place"]).groupBy("total", "_i", "_turn", "AZ").agg(F.array_sort(F.collect_list("InstanceType")).alias("_three"))
        triples = triples.groupBy("total", "_three").agg(F.min(F.struct("_turn", "_i", "AZ")).alias("_f"))
        done = stored(top_k(triples, ["total"], most, F.col("_f")).select("_f.AZ", *(F.col("_three")[k].alias(n) for k, n in enumerate("abc")), "total"), "triples")
        held = {r["total"]: r["n"] for r in done.groupBy("total").agg(F.count("*").alias("n")).collect()}
        full = [t for t, n in left.items() if n <= draws or held.get(t, 0) >= most]
        part = done.where(F.col("total").isin(full))
        found = part if found is None else found.unionByName(part)
        left, draws = {t: n for t, n in left.items() if t not in full}, draws * 8
    kinds = scores.schema
    empty = spark.createDataFrame([], "AZ string, a string, b string, c string, total long") if found is None else found
    return empty.withColumn("total", F.col("total").cast(kinds["SPS"].dataType))
