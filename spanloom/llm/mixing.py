"""Mixing sources to target weights in whole blocks of words, apportioned as seats are by Sainte-Lague.

A source's documents are dealt to shards by a seeded hash and stand there in its order; their words make one stream that is
cut in blocks of BLOCK_WORDS. Blocks go to sources by the highest quotients target / (2 k - 1), and a source's blocks in
the same way to its shards. A shard of m blocks that gets q takes every block q div m times, and q mod m of them, evenly
spaced from a seeded start, once more. How many blocks before a place are chosen is one division, so what a document gives
follows from its place alone.

Only sizes, sources and hashes are shuffled. There are at most MOST_SHARDS shards and one for each source, so what is
sorted in one task is a shard's documents, or a row for each shard or source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, scratch

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MOST_REPEATS = 2
BLOCK_WORDS = 32
SHARD_WORDS = 1 << 18
MOST_SHARDS = 1 << 16
SEED = 11


def words_in(text: Column) -> Column:
    """The number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_of(*parts: Column) -> Column:
    """32 hex digits that depend on the seed and parts."""
    return F.md5(F.concat_ws(":", F.lit(str(SEED)), *parts).cast("binary"))


def number_of(digest: Column) -> Column:
    """The first 8 digits of a hash as a number."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def targets(sources: DataFrame, share_percent: int = SHARE_PERCENT, weights: tuple = WEIGHTS) -> DataFrame:
    """sources (source, source_size) with target: weighted shares of share_percent of all sizes, none above its limit.

    What resharing an excess by weight leads to is one level for all sources below their limits: target = least of the
    limit and level * weight. Sources are ordered by limit / weight; the level is what is left for those that don't reach
    theirs. Weights repeat over the sources in code point order, null last.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    repeated = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))).cast("int") + 1)
    limit = F.col("source_size") * MOST_REPEATS
    by_level = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    weighed = sources.withColumn("weight", repeated).withColumn("limit", limit)
    placed = weighed.select(
        "*",
        (F.sum("source_size").over(every) * share_percent / 100).alias("total"),
        F.coalesce(F.sum("limit").over(before), F.lit(0)).alias("full"),
        F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)).alias("weight_left"),
    )
    # the first source whose limit is above the level that would then hold for it and all after it
    open_ = F.col("limit") * F.col("weight_left") > (F.col("total") - F.col("full")) * F.col("weight")
    found = placed.withColumn("level_at", F.when(open_, F.struct("full", "weight_left")))
    level = F.first("level_at", ignorenulls=True).over(by_level.rowsBetween(Window.unboundedPreceding, 0))
    share = (F.col("total") - F.col("level.full")) * F.col("weight") / F.col("level.weight_left")
    return found.withColumn("level", level).select(
        "source", "source_size", F.coalesce(share, F.col("limit")).cast("double").alias("target")
    )


def apportion(units: DataFrame, within: list[str], seats: Column, weight: Column, most: Column, order: list[Column]) -> DataFrame:
    """units with quota: seats given to the units of each group of columns within, by the highest quotients weight / (2 k - 1).

    No unit gets more than most; ties go by order. As rounding moves a unit by half a seat, the divisor that gives all seats
    is near the proportional one: rounded shares of a seat per unit less, and of two more to make up for units that reach
    their limit, bound each quota. Only the quotients between are ranked: four or so for each unit, whatever the number of
    seats. Limits must exceed proportional shares but for rounding, or seats may be left over.
    """
    group = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    facts = units.select("*", seats.alias("_seats"), weight.cast("double").alias("_weight"), most.alias("_most")).select(
        "*", F.sum("_weight").over(group).alias("_total"), F.count(F.lit(1)).over(group).alias("_n")
    )
    share = F.when(F.col("_total") > 0, F.col("_weight") / F.col("_total")).otherwise(0.0)
    rounded = lambda seats: F.floor(share * F.greatest(seats, F.lit(0)) + 0.5)
    low = F.least(F.greatest(rounded(F.col("_seats") - F.col("_n")), F.lit(0)), F.col("_most"))
    high = F.least(rounded(F.col("_seats") + 2 * F.col("_n")), F.col("_most"))
    bound = facts.withColumn("_low", low).withColumn("_high", F.greatest(high, low))
    bound = bound.withColumn("_open", F.col("_seats") - F.sum("_low").over(group))
    claims = bound.withColumn("_k", F.explode_outer(F.when(F.col("_high") > F.col("_low"), F.sequence(F.col("_low") + 1, F.col("_high")))))
    quotient = F.col("_weight") / (2 * F.col("_k") - 1)
    ranked = claims.withColumn("_rank", F.row_number().over(group.orderBy(F.col("_k").isNull(), quotient.desc(), *order, "_k")))
    won = F.count_if(F.col("_k").isNotNull() & (F.col("_rank") <= F.col("_open")))
    return ranked.groupBy(*units.columns, "_low").agg(won.alias("_won")).select(*units.columns, (F.col("_low") + F.col("_won")).alias("quota"))


def spans_of(begin: Column, end: Column, blocks: Column, again: Column, more: Column, start: Column) -> Column:
    """What a document of the words from begin to end of its shard gives: (start, length, times) in its own words.

    It gives all of it ``again`` times, if that isn't 0, and then what lies in the blocks that are chosen once more: ``more`` of
    them, evenly spaced from start. The c-th of them ends where b * more + start reaches c * blocks.
    """
    count = lambda b: F.floor((b * more + start) / blocks)
    first, last = count(F.floor(begin / BLOCK_WORDS)) + 1, count(F.floor((end - 1) / BLOCK_WORDS) + 1)

    def span(c: Column) -> Column:
        at = (F.ceil((c * blocks - start) / more) - 1) * BLOCK_WORDS
        low, high = F.greatest(at, begin), F.least(at + BLOCK_WORDS, end)
        return F.struct((low - begin).alias("start"), (high - low).alias("length"), F.lit(1).cast("long").alias("times"))

    none = F.array().cast("array<struct<start: long, length: long, times: long>>")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), (end - begin).alias("length"), again.alias("times")))
    chosen = F.when((more > 0) & (last >= first), F.transform(F.sequence(first, last), span))
    given = F.concat(F.when(again > 0, whole).otherwise(none), F.coalesce(chosen, none))
    return F.when(end > begin, given).otherwise(none)


def words_taken(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["length"] * s["times"])


def text_taken(text: Column, spans: Column) -> Column:
    """The words that spans give of a text, one space between."""
    words = F.regexp_extract_all(text, F.lit(WORD), 0)
    each = F.transform(spans, lambda s: F.flatten(F.array_repeat(F.slice(words, (s["start"] + 1).cast("int"), s["length"].cast("int")), s["times"].cast("int"))))
    return F.array_join(F.flatten(each), " ")


def mix(docs: DataFrame, share_percent: int = SHARE_PERCENT, weights: tuple = WEIGHTS) -> DataFrame:
    """One row per row of docs (doc_id, text, source; others are ignored): doc_id, size, source_size, target, spans.

    spans (start, length, times) are the words that the mix takes of a document, none more than MOST_REPEATS times; see
    words_taken and text_taken. A null text has no words,
    a null source is a source of its own, and a null doc_id is dealt by the text. Rows of one doc_id, text and source may
    change places. Sources without words have target 0. No rows give no rows. The same rows give the same mix.
    """
    with scratch() as here:
        identity = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.coalesce("text", F.lit(""))))
        rows = docs.select(F.col("doc_id").cast("long"), "source", words_in(F.col("text")).alias("size"), hash_of(identity).alias("seeded"))
        rows = materialize(rows, "sizes")
        sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
        sources = targets(sources, share_percent, weights)
        every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        per_shard = F.greatest(F.lit(SHARD_WORDS), F.ceil(F.sum("source_size").over(every) / MOST_SHARDS))
        sources = sources.withColumn("shards", F.greatest(F.ceil(F.col("source_size") / per_shard), F.lit(1)).cast("long"))
        sources = materialize(sources, "sources")  # a row for each source
        dealt = rows.join(sources.select("source", "shards"), rows["source"].eqNullSafe(sources["source"])).select(
            "doc_id", rows["source"], "size", "seeded", F.pmod(number_of(F.col("seeded")), F.col("shards")).alias("shard")
        )
        shards = dealt.groupBy("source", "shard").agg(F.sum("size").alias("words"))
        shards = materialize(shards.withColumn("blocks", F.ceil(F.col("words") / BLOCK_WORDS)), "shards")
        limits = shards.groupBy("source").agg((F.sum("blocks") * MOST_REPEATS).alias("most"))
        named = sources.join(limits, sources["source"].eqNullSafe(limits["source"])).select(sources["*"], "most")
        named = named.withColumn("all_seats", F.round(F.sum("source_size").over(every) * share_percent / 100 / BLOCK_WORDS).cast("long"))
        by_name = [F.col("source").asc_nulls_last()]
        quotas = apportion(named, [], F.col("all_seats"), F.col("target"), F.col("most"), by_name).withColumnRenamed("quota", "source_quota")
        units = shards.join(quotas, shards["source"].eqNullSafe(quotas["source"])).select(shards["*"], "source_size", "target", "source_quota")
        taken = apportion(units, ["source"], F.col("source_quota"), F.col("words"), F.col("blocks") * MOST_REPEATS, [F.col("shard")])
        again = F.when(F.col("blocks") > 0, F.floor(F.col("quota") / F.col("blocks"))).otherwise(0).cast("long")
        start = number_of(hash_of(F.coalesce("source", F.lit("")), F.col("shard").cast("string")))
        taken = taken.withColumn("again", again).select(
            "source", "shard", "source_size", "target", "blocks", "again",
            (F.col("quota") - F.col("again") * F.col("blocks")).alias("more"),
            F.when(F.col("blocks") > 0, F.pmod(start, F.col("blocks"))).otherwise(0).alias("start"),
        )
        taken = materialize(taken, "quotas")
        order = Window.partitionBy("source", "shard").orderBy("seeded", F.col("doc_id").asc_nulls_first(), "size")
        streamed = dealt.withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        both = streamed.join(taken, streamed["source"].eqNullSafe(taken["source"]) & (streamed["shard"] == taken["shard"]))
        given = spans_of(F.col("end") - F.col("size"), F.col("end"), *map(F.col, ("blocks", "again", "more", "start")))
        mixed = both.select("doc_id", "size", "source_size", "target", given.alias("spans"))
        return here.keep(mixed, "mix")
