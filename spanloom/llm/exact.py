"""Exact deduplication by deterministic block naming (Karp, Miller and Rosenberg).

A normalised text is cut in blocks of BLOCK_CHARS; distinct blocks are sorted, by a hash and then by their text, and
numbered, which makes a text a sequence of integer names. Adjacent pairs of names are sorted and numbered in turn, level by
level, until one name is left for every text. Names are equal only where the texts are: no fingerprint decides anything.
A hash that only one distinct block has, which is checked on the blocks themselves, stands for that block in joins, so
blocks are shuffled once, after each task has dropped its repeated ones. All of it is DataFrame joins, range sorts and
partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, scratch

BLOCK_CHARS = 2048
WHITE = " \t\n\x0b\x0c\r"


def normalise(text: Column) -> Column:
    """The text without U+0020 and U+0009 to U+000D; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def blocks_of(norm: Column) -> Column:
    """A text's blocks; an empty text is one empty block."""
    return F.when(F.char_length(norm) <= BLOCK_CHARS, F.array(norm)).otherwise(
        F.regexp_extract_all(norm, F.lit(f"(?s).{{1,{BLOCK_CHARS}}}"), 0)
    )


def block_hash(block: Column) -> Column:
    return F.xxhash64(block)


def number(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Distinct rows with their rank from 0 in sort order as ``name``, written as a table.

    A range sort by the first key or keys, which are whole numbers, gives the place in a partition; the partitions' row
    counts, one small row each, give the shift. What Spark samples for the ranges are these numbers.
    """
    numbers = [f.name for f in rows.select(*keys).schema.fields if f.dataType.typeName() == "long"]
    ordered = rows.select(*keys).distinct().repartitionByRange(*numbers).sortWithinPartitions(*keys)
    placed = materialize(ordered.withColumn("_at", F.monotonically_increasing_id()), label)
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(shift), "_part")  # a row per partition of the sort
        .select(*keys, (F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_shift")).alias("name"))
    )


def identities(texts: DataFrame) -> DataFrame:
    """texts: rid (unique), blocks, hashes. Returns rid, n_blocks, name; equal in both iff the blocks are equal."""
    each = texts.select(F.explode("blocks").alias("block")).select(block_hash(F.col("block")).alias("hash"), "block")
    hashes = materialize(
        each.distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("n")).select("hash", (F.col("n") > 1).alias("shared")),
        "block-hashes",
    )
    # distinct blocks with one hash are told apart by their text
    shared = materialize(hashes.where("shared").select("hash"), "shared-hashes")  # nearly always none, so Spark broadcasts it
    apart = each.join(shared, "hash").select("hash", "block")
    alone = hashes.where("not shared").select("hash", F.lit("").alias("block"))
    named = number(alone.union(apart), ["hash", "block"], "block-names")
    size = F.size("hashes").alias("n_blocks")
    placed = texts.select("rid", size, F.posexplode("hashes").alias("at", "hash"))
    level = placed.join(named.join(shared, "hash", "left_anti").select("hash", "name"), "hash")
    told = texts.select("rid", size, F.posexplode("blocks").alias("at", "block")).withColumn("hash", block_hash(F.col("block")))
    told = told.join(shared, "hash", "left_semi").join(named, ["hash", "block"])
    columns = ["rid", "n_blocks", "at", "name"]
    level = materialize(level.select(columns).union(told.select(columns)), "blocks-named")
    most = level.agg(F.max("n_blocks")).first()[0] or 1
    done, width = level.where("n_blocks = 1").select("rid", "n_blocks", "name"), 1
    while width < most:
        pairs = (
            level.where(F.col("n_blocks") > width)
            .groupBy("rid", "n_blocks", F.shiftright("at", 1).alias("half"))
            .agg(
                F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("left_name"),
                F.coalesce(F.max(F.when(F.col("at") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right_name"),
            )
        )
        pairs = materialize(pairs, "pairs")
        named = number(pairs, ["left_name", "right_name"], "pair-names")
        width *= 2
        level = materialize(
            pairs.join(named, ["left_name", "right_name"]).select("rid", "n_blocks", F.col("half").alias("at"), "name"),
            "pairs-named",
        )
        done = done.union(level.where(F.col("n_blocks") <= width).select("rid", "n_blocks", "name"))
    return done


def find_copies(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text; others are ignored): doc_id, keep_id, group_size, kept, text_sha256.

    Of equal normalised texts the row with the most code points in its text, then the smallest doc_id, is kept. Null
    texts count as empty, and empty texts equal one another. A null doc_id loses ties; of rows that repeat a doc_id and
    text one is kept. No rows give no rows.
    """
    with scratch() as here:
        base = docs.select(
            F.monotonically_increasing_id().alias("rid"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.char_length(F.coalesce("text", F.lit(""))).alias("n_chars"),
            normalise(F.col("text")).alias("norm"),
        )
        rows = base.select("rid", "doc_id", "n_chars", F.sha2("norm", 256).alias("text_sha256"), blocks_of(F.col("norm")).alias("blocks"))
        rows = materialize(rows.withColumn("hashes", F.transform("blocks", lambda b: block_hash(b))), "texts")
        facts = rows.select("rid", "doc_id", "n_chars", "text_sha256")
        found = materialize(identities(rows).join(facts, "rid"), "identities")
        rank = F.struct("n_chars", (-F.col("doc_id")).alias("back"), (-F.col("rid")).alias("first"))
        groups = found.groupBy("n_blocks", "name").agg(F.count(F.lit(1)).alias("group_size"), F.max(rank).alias("best"))
        # a table of its own, so that both sides of the join are plain shuffles and Spark can split a large group
        groups = materialize(groups, "copy-groups")
        grouped = found.join(groups, ["n_blocks", "name"]).select(
            "doc_id",
            (-F.col("best.back")).alias("keep_id"),
            "group_size",
            (F.col("rid") == -F.col("best.first")).alias("kept"),
            "text_sha256",
        )
        return here.keep(grouped, "copies")
