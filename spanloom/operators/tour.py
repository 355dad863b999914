"""Nested sets of traces of any size: the Euler tour of a trace as a list that is ranked over the cluster.

A span is entered and left; what follows each is its first child, its next sibling or its parent's leaving. Where an element
stands in that list is the left or right end of its span, so numbering a trace is ranking a list. Every sixteenth element or
so, by a hash, is a ruler; all others find the next ruler by pointer doubling, in rounds that only those still on their way
take part in. The list of rulers, and of the few that found none, is ranked in the same way, until it is small enough for one task.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A ruler among so many elements.
SPACING = 16
#: So many times that distance, hardly an element has no ruler before it.
FAR = 16
#: Elements of a list that one task ranks.
ONE_TASK = 1 << 20
#: What follows the last element of a trace's tour, and of a tour that no root leads to.
END, ASTRAY = -1, -2

RANKED = "e long, rank long"


def checkpointed(df: DataFrame) -> DataFrame:
    """df computed once and kept in the cluster's checkpoint folder, spark.checkpoint.dir; a local session gets one."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        found = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if found is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(found or "file://" + tempfile.mkdtemp(prefix="spanloom-tours-"))
    return df.checkpoint()


def rank_list(elements: pd.DataFrame) -> pd.DataFrame:
    """Steps from each element to the end of its list, for lists that end at END. elements: e, to, steps."""
    e, to, steps = (elements[c].to_numpy(np.int64) for c in ("e", "to", "steps"))
    order = np.argsort(e)
    e, to, steps = e[order], to[order], steps[order].copy()
    at = np.where(to < 0, -1, np.searchsorted(e, np.maximum(to, 0)))
    last = np.where(to < 0, to, 0)
    for _ in range(max(1, len(e)).bit_length() + 1):
        going = np.flatnonzero(at >= 0)
        if not len(going):
            break
        there = at[going]
        steps[going] += steps[there]
        last[going], at[going] = last[there], at[there]
    found = (at < 0) & (last == END)
    return pd.DataFrame({"e": e[found], "rank": steps[found]})


def _union(first: DataFrame, *others: DataFrame) -> DataFrame:
    for df in others:
        first = first.union(df)
    return first


def ranks(elements: DataFrame, level: int = 0) -> DataFrame:
    """(e, rank): steps from each element (e, to, steps) to END, the last one's own included; elements that don't reach it have no row."""
    elements = checkpointed(elements)
    n = elements.count()
    if n <= ONE_TASK:
        return elements.coalesce(1).mapInPandas(lambda batches: [rank_list(pd.concat([pd.DataFrame({"e": [], "to": [], "steps": []}), *batches]))], RANKED)
    ruler = lambda c: F.pmod(F.xxhash64(c, F.lit(level)), F.lit(SPACING)) == 0
    arrived = lambda df: (F.col("to") < 0) | ruler(F.col("to"))
    done = [elements.where(arrived(elements))]
    going, reach = checkpointed(elements.where(~arrived(elements))), 1
    while reach < FAR * SPACING and not going.isEmpty():
        there = _union(*done, going).select(F.col("e").alias("to"), F.col("to").alias("next"), F.col("steps").alias("more"))
        moved = checkpointed(going.join(there, "to").select("e", F.col("next").alias("to"), (F.col("steps") + F.col("more")).alias("steps")))
        done.append(moved.where(arrived(moved)))
        going, reach = moved.where(~arrived(moved)), reach * 2
    every = _union(*done, going)
    # who is still on the way, or in a circle, goes on with the rulers, and so does what it points to
    kept = _union(going.select("e"), going.select(F.col("to").alias("e"))).distinct()
    short = _union(every.where(ruler(F.col("e"))), every.where(~ruler(F.col("e"))).join(kept, "e", "left_semi"))
    rulers = ranks(short, level + 1)
    near = every.where(F.col("to") == END).select("e", F.col("steps").alias("rank"))
    far = every.join(rulers.select(F.col("e").alias("to"), "rank"), "to").select("e", (F.col("steps") + F.col("rank")).alias("rank"))
    return near.union(far)


def tour_sets(spans: DataFrame) -> DataFrame:
    """What tree.nested_sets returns, for traces of any size; nothing of a trace is gathered but its list of rulers."""
    one = spans.groupBy("trace_id", "span_id").agg(F.min(F.struct("start_ns", "parent_span_id")).alias("s"))
    nodes = checkpointed(one.select("trace_id", "span_id", "s.*", F.monotonically_increasing_id().alias("v")))
    is_root = F.coalesce("parent_span_id", F.lit("")) == ""
    above = nodes.select("trace_id", F.col("span_id").alias("parent_span_id"), F.col("v").alias("p"))
    placed = nodes.join(above, ["trace_id", "parent_span_id"], "left").withColumn("root", is_root)
    family = Window.partitionBy("trace_id", F.coalesce("p", F.lit(-1)), F.when(F.col("p").isNull() & ~F.col("root"), F.col("v"))).orderBy("start_ns", "span_id")
    placed = checkpointed(placed.withColumn("sibling", F.lead("v").over(family)))
    first = placed.where("p is not null").groupBy(F.col("p").alias("v")).agg(
        F.min_by("v", F.struct("start_ns", "span_id")).alias("child"), F.count(F.lit(1)).cast("int").alias("child_count")
    )
    placed = checkpointed(placed.join(first, "v", "left"))
    # an element is twice its span's number, and one more for leaving
    after = F.coalesce(F.col("sibling") * 2, F.col("p") * 2 + 1, F.when(F.col("root"), F.lit(END)).otherwise(F.lit(ASTRAY)))
    enter = F.struct((F.col("v") * 2).alias("e"), F.coalesce(F.col("child") * 2, F.col("v") * 2 + 1).alias("to"))
    leave = F.struct((F.col("v") * 2 + 1).alias("e"), after.alias("to"))
    elements = placed.select(F.inline(F.array(enter, leave)), F.lit(1).cast("long").alias("steps"))
    found = ranks(elements).groupBy(F.shiftright("e", 1).alias("v")).agg(
        F.max(F.when(F.col("e") % 2 == 0, F.col("rank"))).alias("down"), F.max(F.when(F.col("e") % 2 == 1, F.col("rank"))).alias("up")
    )
    ranked = checkpointed(placed.join(found, "v", "left"))
    length = ranked.groupBy("trace_id").agg(F.max("down").alias("length"))
    sets = ranked.join(length, "trace_id").withColumn("left", F.coalesce(F.col("length") - F.col("down") + 1, F.lit(0)))
    sets = sets.withColumn("right", F.coalesce(F.col("length") - F.col("up") + 1, F.lit(0)))
    parents = sets.select(F.col("v").alias("p"), F.col("left").alias("over"))
    parent = F.when(F.col("left") == 0, 0).when(F.col("root"), -1).otherwise(F.col("over"))
    return sets.join(parents, "p", "left").select(
        "trace_id", "span_id", F.col("left").cast("int").alias("nested_left"), F.col("right").cast("int").alias("nested_right"),
        parent.cast("int").alias("nested_parent"), F.coalesce("child_count", F.lit(0)).alias("child_count"),
    )


def large_traces(spans: DataFrame, most: int) -> DataFrame:
    """Ids of traces of more than so many spans."""
    return spans.groupBy("trace_id").count().where(F.col("count") > most).select("trace_id")
