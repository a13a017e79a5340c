"""Mixing sources by temperature: shares to an exponent, found by section, realised as budgeted block permutations.

The weight of a source is its share of the tokens to the power of an exponent from 0 (all alike) to 1 (as they are),
normalised.  The exponent is the largest that gives the mixture a target entropy, or a larger one that keeps every
source within a limit of repetitions.  Documents fall into blocks by a hash; each pass over a source visits its blocks
in another order, and the last pass ends once the source's budget is used up.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._store import written

#: Tokens planned for a block, and blocks of a source at least and at most (larger sources have larger blocks, so that its
#: blocks fit one task): a source gets its budget to within half a block.
BLOCK_TOKENS, LEAST_BLOCKS, MOST_BLOCKS = 200_000, 64, 1 << 20
#: Exponents tried at once in a round of the section, and rounds: the exponent is found to within 64 ** -4.
CUTS, TURNS = 64, 4
#: Sources up to which their tokens are weighed on the driver.
FEW_SOURCES = 10_000


def _weighed(sources: DataFrame, exponents: list[float], budget: float) -> DataFrame:
    """For each exponent: entropy of the mixture in nats, most and fewest passes over a source."""
    power = sources.withColumn("exponent", F.explode(F.lit(exponents))).withColumn("p", F.pow(F.col("tokens") / F.col("total"), F.col("exponent")))
    power = power.groupBy("exponent").agg(
        F.sum("p").alias("z"), F.sum(F.col("p") * F.ln("p")).alias("plogp"),
        F.max(F.col("p") / F.col("tokens")).alias("high"), F.min(F.col("p") / F.col("tokens")).alias("low"),
    )
    return power.select(
        "exponent", (F.ln("z") - F.col("plogp") / F.col("z")).alias("entropy"),
        (F.col("high") / F.col("z") * budget).alias("most"), (F.col("low") / F.col("z") * budget).alias("fewest"), "z",
    )


def _weigher(sources: DataFrame, budget: float):
    """From exponents to what ``_weighed`` says of each: on the driver for few sources, whose tokens are all it takes, and by a
    job each time for more, to the same values but for rounding."""
    if sources.count() > FEW_SOURCES:
        return lambda exponents: {r["exponent"]: r.asDict() for r in _weighed(sources, exponents, budget).collect()}
    rows = sorted((r["tokens"], r["total"]) for r in sources.select("tokens", "total").collect())
    tokens = np.array([t for t, _ in rows], np.float64)
    share = tokens / np.array([n for _, n in rows], np.float64)

    def weighed(exponents: list[float]) -> dict[float, dict[str, float]]:
        out = {}
        for e in exponents:
            p = share**e
            z = p.sum()
            out[e] = {"entropy": np.log(z) - (p * np.log(p)).sum() / z, "most": (p / tokens).max() / z * budget, "fewest": (p / tokens).min() / z * budget, "z": z}
        return {e: {k: float(v) for k, v in x.items()} for e, x in out.items()}

    return weighed


def _section(weighed, good, up: bool) -> float:
    """The end of the range of exponents for which ``good`` holds: the largest such if ``up``, else the smallest."""
    low, high = 0.0, 1.0
    for _ in range(TURNS):
        cuts = [low + (high - low) * i / CUTS for i in range(CUTS + 1)]
        rows = {e: good(r) for e, r in weighed(cuts).items()}
        held = [rows[c] for c in cuts]
        if up:
            i = max((k for k in range(CUTS + 1) if held[k]), default=0)
            low, high = cuts[i], cuts[min(i + 1, CUTS)]
        else:
            i = min((k for k in range(CUTS + 1) if held[k]), default=CUTS)
            low, high = cuts[max(i - 1, 0)], cuts[i]
    return low if up else high


def token_count(text: Column) -> Column:
    """Runs of other than white space; a null text has none."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    return F.when(flat == "", 0).otherwise(F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit(""))) + 1).cast("long")


def mixture(docs: DataFrame, *, entropy: float = 0.9, repeats: float = 4.0, budget: float | None = None, cover: bool = False, seed: int = 0, counted: str | None = None, row: str | None = None) -> DataFrame:
    """Rows of ``docs`` as often as the mixture has them, with ``tokens``, ``block``, ``epoch``, ``position`` and ``weight``.

    ``entropy`` is the target as a share of the most possible, ``repeats`` the most passes over a source, ``budget``
    the tokens of the mixture (all tokens of ``docs`` if None).  With ``cover`` the budget is the least that has every
    document at least once, and ``repeats`` limits passes with that budget.  ``position`` from 0 to 1 orders the
    mixture: blocks of all sources interleave in proportion.

    Blocks are told by ``row``, a column that no two rows share, or without it by doc_id, and by the text where that is null:
    rows that are equal in this share a block then.  Tokens are counted in ``text``, or are given by the column ``counted``, so that texts aren't read again.  A null source is a source of its own.  A source without tokens has
    each document once.  If the limit can't be kept (the budget is more than ``repeats`` times all tokens), weights
    are the shares themselves.  Repeated rows count each.  Columns of those five names are replaced; other columns pass
    through, their names must not begin with ``_mix``.  An empty table gives an empty one.
    """
    seeded = lambda *c: F.xxhash64(F.lit(seed), *c)
    identity = seeded(row) if row else F.when(F.col("doc_id").isNotNull(), seeded("doc_id")).otherwise(seeded(F.lit("text"), *(["text"] if "text" in docs.columns else [])))
    docs = docs.withColumn("_mix_tokens", F.col(counted).cast("long") if counted else token_count(F.col("text"))).drop("tokens", "block", "epoch", "position", "weight")
    docs = docs.withColumns({"_mix_source": F.coalesce("source", F.lit("\0")), "_mix_hash": identity})
    slim = written(docs.select(F.col("_mix_source").alias("_source"), F.col("_mix_hash").alias("_hash"), F.coalesce("_mix_tokens", F.lit(0)).cast("long").alias("tokens")), "mix-tokens")
    by_source = slim.groupBy("_source").agg(F.sum("tokens").alias("tokens"))
    total = by_source.agg(F.sum("tokens")).first()[0] or 0
    by_source = written(by_source.withColumn("total", F.lit(total)), "mix-sources")
    live = by_source.where("tokens > 0")
    exponent, z = 1.0, 1.0
    if total:
        scale = float(budget or total)
        passes = (lambda r: r["most"] / r["fewest"]) if cover else (lambda r: r["most"])
        most = F.ln(F.count("*").cast("double")).alias("h")
        target = entropy * live.agg(most).first()[0]
        weighed = _weigher(live, scale)
        wanted = _section(weighed, lambda r: r["entropy"] >= target, True)
        limit = _section(weighed, lambda r: passes(r) <= repeats * (1 + 1e-9), False)
        exponent = max(wanted, limit)
        found = weighed([exponent])[exponent]
        z = found["z"]
        scale = scale / found["fewest"] if cover else scale
    weight = F.pow(F.col("tokens") / F.col("total"), F.lit(exponent)) / z
    passes = F.when(F.col("tokens") > 0, weight * scale / F.col("tokens")).otherwise(1.0) if total else F.lit(1.0)
    count = F.least(F.lit(MOST_BLOCKS), F.greatest(F.lit(LEAST_BLOCKS), F.ceil(F.col("tokens") / BLOCK_TOKENS)))
    # a pass just short of a whole one by rounding is a whole one
    plan = by_source.select("_source", "tokens", count.alias("blocks"), F.when(F.col("tokens") > 0, weight).otherwise(0.0).alias("weight") if total else F.lit(0.0).alias("weight"), F.round(passes, 9).alias("passes"))
    blocks = slim.join(plan.select("_source", "blocks"), "_source").groupBy("_source", F.pmod("_hash", "blocks").alias("block")).agg(F.sum("tokens").alias("n"))
    blocks = blocks.join(plan, "_source").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil("passes") - 1).cast("int"))))
    turn = Window.partitionBy("_source", "epoch").orderBy(F.xxhash64(F.lit(seed), "epoch", "block"), "block")
    blocks = blocks.withColumn("end", F.sum("n").over(turn.rowsBetween(Window.unboundedPreceding, 0)))
    middle = F.when(F.col("tokens") > 0, (F.col("end") - F.col("n") / 2) / F.col("tokens")).otherwise(0.5) + F.col("epoch")
    blocks = written(blocks.where((middle <= F.col("passes")) | (F.col("passes") >= F.col("epoch") + 1)).select("_source", "block", "epoch", (middle / F.greatest("passes", middle)).alias("position"), "weight"), "mix-blocks")
    docs = docs.join(plan.select(F.col("_source").alias("_mix_source"), F.col("blocks").alias("_mix_blocks")), "_mix_source")
    docs = docs.withColumn("block", F.pmod("_mix_hash", "_mix_blocks")).withColumnRenamed("_mix_tokens", "tokens").drop("_mix_blocks", "_mix_hash")
    return docs.join(blocks.withColumnRenamed("_source", "_mix_source"), ["_mix_source", "block"]).drop("_mix_source")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = docs.select("doc_id", "source", token_count(F.col("text")).alias("tokens"), F.monotonically_increasing_id().alias("row"))
    counts = written(counts, "token-counts")  # numbers of rows stay as they are once written
    return mixture(counts, entropy=0.97, repeats=4.0, counted="tokens", row="row").select("doc_id", "source", "tokens", "block", "epoch", "position", "weight")


QUERIES = {"op8_mixing": op8_mixing}
