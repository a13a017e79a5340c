"""Column functions: parsing of identifiers, buckets and scores, savings, prices and display formats."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# They have to equal what the data sources and earlier archives use.
TIERS = ("Standard", "Basic")
INTERRUPTION_SCORES = {"<5%": 3.0, "5-10%": 2.5, "10-15%": 2.0, "15-20%": 1.5, ">20%": 1.0}
EVICTION_SCORES = {"0-5": 3.0, "5-10": 2.5, "10-15": 2.0, "15-20": 1.5, "20+": 1.0}
RESEARCH_SCORES = {"<5%": 5, "5-10%": 4, "10-15%": 3, "15-20%": 2, ">20%": 1}
SCORE_LABELS = {"High": 3, "Medium": 2, "Low": 1}
DIRECTIONS = ("north", "south", "east", "west", "central")
CAPACITIES = (50, 45, 40, 35, 30, 25, 20, 15, 10, 5, 1)


def mapped(c: Column, values: dict) -> Column:
    """The value for each key; null for others."""
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))[c]


def sku_tier(sku: Column) -> Column:
    """The first part of ``tier_type`` if it is a known tier, else null."""
    first = F.split_part(sku, F.lit("_"), F.lit(1))
    return F.when(first.isin(*TIERS), first)


def sku_type(sku: Column) -> Column:
    """What follows the tier; without a tier the first part; null for a tier alone."""
    parts = F.split(sku, "_")
    rest = F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1))), "_")
    return F.when(parts[0].isin(*TIERS), F.when(F.size(parts) > 1, rest)).otherwise(parts[0])


def capitalised(c: Column) -> Column:
    """First letter upper, all others lower."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def interruption_type(sku: Column) -> Column:
    """The type as the eviction source spells it: the part after the first underscore, capitalised."""
    return capitalised(F.regexp_extract(sku, "^[^_]*_(.*)$", 1))


def without_last_word(c: Column) -> Column:
    parts = F.split(c, " ")
    return F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), " ")


def score_number(label: Column) -> Column:
    """A label or number of a placement score as int; -1 if it is neither."""
    return F.coalesce(label.try_cast("int"), mapped(label, SCORE_LABELS), F.lit(-1))


def savings_truncated(ondemand: Column, spot: Column) -> Column:
    """Whole percent saved, cut towards zero; -1 if it can't be told."""
    return F.coalesce((100 - F.try_divide(spot * 100, ondemand)).cast("int"), F.lit(-1))


def savings_exact(ondemand: Column, spot: Column) -> Column:
    """Percent saved; null without an on-demand price or with one of 0."""
    base = F.nullif(ondemand, F.lit(0.0))
    return (base - spot) / base * 100


def savings_even(ondemand: Column, spot: Column) -> Column:
    """Percent saved, rounded half to even."""
    return F.bround(savings_exact(ondemand, spot), 0)


def savings_shown(ondemand: Column, spot: Column) -> Column:
    """Percent saved as shown: half rounds up; null if a price is missing, 0 or -1."""
    valid = ~ondemand.isin(0.0, -1.0) & ~spot.isin(0.0, -1.0)
    return F.when(valid, F.floor(savings_exact(ondemand, spot) + 0.5))


def machine_price(vcpus: Column, memory_gb: Column, gpus: Column, core: Column, memory: Column, gpu: Column) -> Column:
    """Price of a machine from unit prices; null without a core price, other missing parts cost nothing."""
    zero = F.lit(0.0)
    part = lambda n, p: F.coalesce(n, zero) * F.coalesce(p, zero)
    return F.greatest(vcpus.cast("double"), F.lit(1.0)) * core + part(memory_gb, memory) + part(gpus, gpu)


def unit_price(units: Column, nanos: Column) -> Column:
    """Money given as whole units and billionths."""
    return F.coalesce(units.try_cast("double"), F.lit(0.0)) + nanos * 1e-9


def machine_family(name: Column) -> Column:
    return F.upper(F.split_part(name, F.lit("-"), F.lit(1)))


def zone_prefix(region: Column) -> Column:
    """Short prefix of zone ids, us-east-1 -> use1; null unless there are three parts."""
    parts = F.split(region, "-")
    part = lambda i: F.get(parts, F.lit(i))
    letters = F.concat(*(F.when(F.contains(part(1), F.lit(d)), d[0]).otherwise("") for d in DIRECTIONS))
    return F.when((F.size(parts) == 3) & (letters != ""), F.concat(part(0), letters, part(2)))


def shown_number(c: Column) -> Column:
    """Text of a number; N/A for null and the sentinel -1."""
    return F.when(c.isNull() | (c == -1), "N/A").otherwise(c.cast("string"))


def shown_time(c: Column) -> Column:
    """Text of a time in one format; what can't be read as a time stays."""
    return F.coalesce(F.date_format(F.try_to_timestamp(c), "yyyy-MM-dd HH:mm:ss"), c)


def parsed_time(c: Column, *formats: str) -> Column:
    """The first format that reads the text; null if none does."""
    return F.coalesce(*(F.try_to_timestamp(c, F.lit(f)) for f in formats))


def floored(ts: Column, minutes: int = 10) -> Column:
    """The start of the tick a time is in."""
    step = minutes * 60
    return F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / step) * step)


def jaccard_letters(a: Column, b: Column) -> Column:
    """Similarity of two names as sets of characters."""
    x, y = (F.array_distinct(F.split(c, "")) for c in (a, b))
    return F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))


def best_name(name: Column, candidates: list[str]) -> Column:
    """The candidate most like the model in a name such as maker-x100-large: its parts from the first with a digit on,
    joined, in upper case.  Names are compared as sets of characters; equal first two letters are asked for, the first best
    wins, the name itself if none or if no part has a digit.  Candidates are taken as they are."""
    parts = F.split(name, "-")
    first = F.array_position(F.transform(parts, lambda t: t.rlike("[0-9]")), F.lit(True)).cast("int")
    own = F.when(first > 0, F.upper(F.array_join(F.slice(parts, first, F.size(parts)), ""))).otherwise("")
    like = lambda c: F.when((F.substring(own, 1, 2) == c[:2]) & (own != ""), jaccard_letters(own, F.lit(c))).otherwise(0.0)
    out = reduce(
        lambda acc, c: F.when(like(c) > acc["s"], F.struct(like(c).alias("s"), F.lit(c).alias("n"))).otherwise(acc),
        candidates,
        F.struct(F.lit(0.0).alias("s"), name.alias("n")),
    )
    return out["n"]


def chunked(items: Column, size: int) -> Column:
    """An array cut into arrays of ``size``; the last may be shorter."""
    return F.when(F.size(items) == 0, F.array().cast("array<array<string>>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.ceil(F.size(items) / size).cast("int") - 1), lambda i: F.slice(items, i * size + 1, size))
    )


def failure_kind(reason: Column, exit_code: Column) -> Column:
    """What made a job fail, from its status reason and exit code."""
    low = F.lower(F.coalesce(reason, F.lit("")))
    return (
        F.when(F.contains(low, F.lit("outofmemory")) | (exit_code == 137), "out of memory")
        .when(F.contains(low, F.lit("timeout")), "timeout")
        .when(exit_code.isNotNull() & (exit_code != 0), F.concat(F.lit("exit code "), exit_code.cast("string")))
        .otherwise("unknown")
    )


def hue(index: Column) -> Column:
    """Colour of a series: steps of the golden angle."""
    return F.pmod(index * 137.508, F.lit(360.0))


def listed_after(text: Column, lead: str) -> Column:
    """The comma-separated names that a message lists in quotes or to its end after some words."""
    found = F.regexp_extract(text, lead + r"\s*'?([^'.]*)'?", 1)
    return F.when(found != "", F.split(found, r",\s*"))


def without_items(items: Column, invalid: Column) -> Column:
    """An array without the items of another, in order and as often as they are; null if none is left."""
    left = F.filter(items, lambda x: ~F.array_contains(F.coalesce(invalid, F.array().cast("array<string>")), x))
    return F.when(F.size(left) > 0, left)


def day_bounds(day: Column) -> tuple[Column, Column]:
    """First and last millisecond of a day."""
    start = F.date_trunc("day", day.cast("timestamp"))
    return start, start + F.expr("interval 1 day") - F.expr("interval 1 millisecond")


def place_and_size(c: Column) -> tuple[Column, Column]:
    """Both parts of an id such as ``region,size``."""
    return F.split_part(c, F.lit(","), F.lit(1)), F.split_part(c, F.lit(","), F.lit(2))


def path_part(c: Column, number: int) -> Column:
    """A part of a path of names, from 1."""
    return F.split_part(c, F.lit("/"), F.lit(number))


def log_name(subscription: Column) -> Column:
    """What of an id is shown in logs: up to the first dash."""
    return F.split_part(subscription, F.lit("-"), F.lit(1))


def spec_request(pairs: Column, subscription: str) -> Column:
    """The JSON body that asks prices of an array of (region, size, resource)."""
    own = lambda p: F.concat_ws(",", p["region"], p["size"])
    sets = F.transform(
        pairs,
        lambda p: F.struct(
            own(p).alias("id"),
            F.array(F.struct(own(p).alias("id"), p["resource"].alias("resourceId"), F.lit(1).alias("quantity"))).alias("firstParty"),
            F.array().cast("array<string>").alias("thirdParty"),
        ),
    )
    body = F.struct(F.lit(subscription).alias("subscriptionId"), sets.alias("specResourceSets"), F.transform(pairs, own).alias("specsToAllowZeroCost"), F.lit("Microsoft_Azure_Compute").alias("specType"))
    return F.to_json(body)


def joined_key(*parts: Column) -> Column:
    """Parts joined by underscores, as (type, zone) keys are written."""
    return F.concat_ws("_", *parts)
