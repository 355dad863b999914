"""op11: all conversations damaged by a rule and repaired."""

from pyspark.sql import functions as F

from . import repair
from .common import read


def damage(rows):
    """Rows of conversations (conv_id, turn, role, text) after a damage that the crc32 of ``conv_id:turn`` chooses."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat_ws(":", filled("conv_id"), filled("turn")).cast("binary")), F.lit(20))
    copies = F.array_repeat(F.lit(0), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(filled("text"), repair.ENDS, "")).otherwise(filled("text"))
    role = F.when(kind == 4, "user").otherwise(filled("role"))
    return rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"), F.explode(copies)
    ).drop("col")


def damage_and_repair(rows):
    """One row per conv_id of rows, also of those of which the damage leaves nothing."""
    found = repair.digest(repair.plan_edits(damage(rows)))
    every = rows.select(F.col("conv_id").cast("long").alias("every_id")).distinct()
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return every.join(found, F.col("every_id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("every_id").alias("conv_id"),
        *(zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op11_turn_repair(spark, sf_dir):
    return damage_and_repair(read(spark, sf_dir, "conversations"))


QUERIES = {"op11_turn_repair": op11_turn_repair}
ORACLES: dict[str, str] = {}  # a cheapest repair isn't SQL; tests compare it with all edits of short conversations
