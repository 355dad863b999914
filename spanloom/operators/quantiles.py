"""Exact quantiles of groups of any size, by selection in bins.

Of each group the values are counted in bins: first by their leading bits or cube root, then, in the bins that hold a wanted
rank, by all but the last bits, and last one by one. So a task sorts no more of a group than the counts of one pass, some 2 ** 25
at the most, and holds no list of its values. Distinct values are counted once, in one shuffle that all passes share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: In how many parts a bin's values are joined, so that a bin that holds most of a group isn't one task's.
PARTS = 8
LARGEST = (1 << 63) - 1


def ordered_key(v: Column, kind: T.DataType) -> Column:
    """A whole number for each number, equal and ordered as they are; NaN is the largest, and both zeros are one."""
    if not isinstance(kind, T.FloatType | T.DoubleType):
        return v.cast("bigint")
    odd = F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    x = F.when(odd, F.lit(1.0)).otherwise(F.abs(v.cast("double")))
    # the exponent by logarithm, mended where rounding put it one off; then 52 bits of the mantissa below it
    near = F.floor(F.log2(x))
    power = lambda e: F.pow(F.lit(2.0), e)
    e = F.greatest(near + F.when(power(near) > x, -1).when(power(near + 1) <= x, 1).otherwise(0), F.lit(-1022))
    size = (e + 1022) * F.lit(1 << 52) + F.floor(x / power(e) * F.lit(float(1 << 52)))
    whole = F.when(F.isnan(v), F.lit(LARGEST)).when(odd, F.lit(LARGEST - 1)).when(x == 0, F.lit(0)).otherwise(size).cast("bigint")
    return F.when(v < 0, -whole).otherwise(whole)


#: Bits below those of the first pass, and below those of the second for whole numbers and for keys of doubles.
COARSE, FINE_WHOLE, FINE_DOUBLE = 38, 24, 14


def _placed(counts: DataFrame, path: list[str], order: str) -> DataFrame:
    """Counts (path, order, n) with the number of a path's rows before each."""
    before = Window.partitionBy(*path).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("__before", F.coalesce(F.sum("n").over(before), F.lit(0)))


def _holds(rank: Column) -> Column:
    return (rank >= F.col("__before")) & (rank < F.col("__before") + F.col("n"))


def _within(placed: DataFrame, wanted: Column) -> DataFrame:
    """Placed counts with those of the wanted (at, rank, weight) that fall in each, ranked in it; others are left out."""
    inside = F.filter(wanted, lambda w: _holds(w["rank"]))
    inside = F.transform(inside, lambda w: F.struct(w["at"].alias("at"), (w["rank"] - F.col("__before")).alias("rank"), w["weight"].alias("weight")))
    return placed.withColumn("__wanted", inside).where(F.size("__wanted") > 0).drop("__before", "n", "__last")


def _join(x: DataFrame, y: DataFrame, names: list[str]) -> DataFrame:
    """An inner join by names that are equal or null on both sides.

    A plain join filters nulls out of its keys. Those filters go down below the counts of distinct values, differ from pass
    to pass, and so each pass would read and count all rows anew instead of sharing one shuffle.
    """
    y = y.withColumnsRenamed({n: f"__y_{n}" for n in names})
    on = F.lit(True)
    for n in names:
        on = on & F.col(n).eqNullSafe(F.col(f"__y_{n}"))
    return x.join(y, on).drop(*(f"__y_{n}" for n in names))


def quantiles(rows: DataFrame, by: list[str], value: str, asked: list[float], name: str = "quantiles") -> DataFrame:
    """One row per group: by and ``name``, the exact quantiles of a group's values as an array of doubles.

    rows: by and value; values without nulls. Between two values they are interpolated by rank, as ``percentile`` does.
    """
    if not by:
        return quantiles(rows.withColumn("__all", F.lit(0)), ["__all"], value, asked, name).drop("__all")
    held = rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    kind = rows.schema[value].dataType
    real = isinstance(kind, T.FloatType | T.DoubleType)
    bins = ["__bin0", "__bin1"]
    held = held.withColumn("__key", ordered_key(F.col(value), kind))
    # of whole numbers the cube root, which ascends with them and is fine where they are small
    coarse = F.shiftright("__key", COARSE) if real else F.floor(F.cbrt(F.col(value).cast("double")))
    held = held.withColumns({bins[0]: coarse, bins[1]: F.shiftright("__key", FINE_DOUBLE if real else FINE_WHOLE)})
    wanted, needed = [], F.lit(False)
    for i, q in enumerate(asked):
        place = F.lit(q) * F.col("__last")
        low, high = F.floor(place).cast("bigint"), F.ceil(place).cast("bigint")
        needed = needed | _holds(low) | _holds(high)
        for j, (rank, weight) in enumerate(((low, high - place), (high, place - low))):
            wanted.append(F.struct(F.lit(2 * i + j).alias("at"), rank.alias("rank"), weight.cast("double").alias("weight")))
    found = held.withColumn("__part", F.pmod(F.xxhash64("__key"), F.lit(PARTS)))
    first = _placed(held.groupBy(*by, bins[0]).agg(F.sum("n").alias("n")), by, bins[0])
    first = first.withColumn("__last", F.sum("n").over(Window.partitionBy(*by)) - 1).where(needed)  # lists are made for few bins only
    kept = _within(first, F.array(*wanted))
    for path in ([*by, bins[0]], [*by, *bins]):
        parts = kept.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)).cast("array<bigint>")))
        found = _join(found.drop("__wanted"), parts, [*path, "__part"])
        if path[-1] == bins[0]:
            counts = found.groupBy(*path, "__wanted", bins[1]).agg(F.sum("n").alias("n"))
            kept = _within(_placed(counts, path, bins[1]), F.col("__wanted"))
    kept = _within(_placed(found.select(*path, "__wanted", "__key", value, "n"), path, "__key"), F.col("__wanted"))
    each = kept.select(*by, F.col(value).alias("__v"), F.explode("__wanted").alias("__w"))
    pick = lambda k, c: F.max(F.when(F.col("__w.at") == k, F.col(c)))

    def between(i: int) -> Column:
        (low, a), (high, b) = ((pick(k, "__v"), pick(k, "__w.weight")) for k in (2 * i, 2 * i + 1))
        return F.when(low == high, low.cast("double")).otherwise(a * low.cast("double") + b * high.cast("double"))

    return each.groupBy(*by).agg(F.array(*(between(i) for i in range(len(asked)))).alias(name))
