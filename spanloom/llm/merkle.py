"""A manifest of a dataset: Merkle trees of all rows, a proof for each row, and their verification.

Leaves of a source ascend by doc_id and are reduced in runs of ARITY, level by level, to the source's subroot; subroots
are reduced in the same way to the root. Tasks reduce aligned blocks of ARITY ** k leaves, which leaves a top tree of at
most MOST_BLOCKS nodes and one for each source; the driver builds it and broadcasts, for each block, the path from there
to the root. A second pass finishes each row's proof inside its block and folds the row's leaf up to a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, scratch

ARITY = 3
LEAST_HEIGHT = 7
#: Blocks whose paths are broadcast, some 3 kB each; of 3 * 10 ** 10 rows a block then has 3 ** 13.
MOST_BLOCKS = 1 << 15
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(nodes: list[str], height: int | None = None) -> list[list[str]]:
    """The levels over nodes: up to one node, or exactly height of them."""
    found = [nodes]
    while len(found[-1]) > 1 if height is None else len(found) <= height:
        low = found[-1]
        found.append([digest(low[i : i + ARITY]) for i in range(0, len(low), ARITY)])
    return found


def path_of(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """What stands left and right of a node's ancestors in their runs, level by level; the last level has no run."""
    found = []
    for level in levels[:-1]:
        start = at - at % ARITY
        found.append(("".join(level[start:at]), "".join(level[at + 1 : start + ARITY])))
        at //= ARITY
    return found


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for left, right in path:
        leaf = hashlib.sha256((left + leaf + right).encode()).hexdigest()
    return leaf


def height_of(n: int) -> int:
    """Levels above n leaves."""
    found = 0
    while n > 1:
        n, found = -(-n // ARITY), found + 1
    return found


def leaf_of(text: Column) -> Column:
    """The leaf of a row with this text: sha256 of each field as byte count, colon, value, or ``-`` for null."""
    part = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    fields = [text if name == "text" else F.col(name).cast("string") for name in FIELDS]
    return F.sha2(F.concat(*map(part, fields)), 256)


def place_leaves(leaves: DataFrame) -> DataFrame:
    """leaves (skey, doc_id, leaf, ...) with p, a leaf's place in its source, and n, the source's leaves; a table."""
    order = ["skey", F.col("doc_id").asc_nulls_first(), "leaf"]
    ranged = leaves.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(ranged.withColumn("at", F.monotonically_increasing_id()), "leaves")
    part = F.shiftright("at", 33)
    held = placed.groupBy("skey", part.alias("part")).agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    of = Window.partitionBy("skey").orderBy("part")
    held = held.select(
        "skey", "part",
        (F.sum("rows").over(of) - F.col("rows") - F.col("first")).alias("shift"),
        F.sum("rows").over(Window.partitionBy("skey")).alias("n"),
    )
    held = materialize(held, "leaf-ranges")  # a row for each partition of the sort and each source in it
    return placed.withColumn("part", part).join(held, ["skey", "part"]).withColumn("p", F.col("at") + F.col("shift")).drop("part", "shift", "at")


def _reducer(height: int) -> Callable[[pa.Table], pa.Table]:
    def reduce(block: pa.Table) -> pa.Table:
        block = block.sort_by("p")
        top = levels_of(block["leaf"].to_pylist(), min(height, height_of(block["n"][0].as_py())))[-1]
        return pa.table({"skey": block["skey"].slice(0, 1), "block": block["block"].slice(0, 1), "n": block["n"].slice(0, 1), "node": pa.array(top[:1])})

    return reduce


def build_top(nodes: list, height: int) -> tuple[str | None, dict]:
    """The root, and for each (skey, block) the source's subroot and the path from the block's node to the root.

    nodes: rows (skey, block, n, node) of all blocks.
    """
    trees: dict[str, list] = {}
    for r in sorted(nodes, key=lambda r: (r["skey"].encode(), r["block"])):
        trees.setdefault(r["skey"], []).append(r["node"])
    own = {skey: levels_of(found) for skey, found in trees.items()}
    upper = levels_of([levels[-1][0] for levels in own.values()])
    paths = {}
    for at, (skey, levels) in enumerate(own.items()):
        rest = path_of(upper, at)
        for block in range(len(levels[0])):
            paths[skey, block] = (levels[-1][0], path_of(levels, block) + rest)
    return (upper[-1][0] if trees else None), paths


def _prover(height: int, top, paths: bool) -> Callable[[pa.Table], pa.Table]:
    def prove(block: pa.Table) -> pa.Table:
        root, suffixes = top.value
        block = block.sort_by("p")
        leaves = block["leaf"].to_pylist()
        subroot, suffix = suffixes[block["skey"][0].as_py(), block["block"][0].as_py()]
        levels = levels_of(leaves, min(height, height_of(block["n"][0].as_py())))
        proofs, folded, held = [], [], []
        for i, (leaf, now) in enumerate(zip(leaves, block["now"].to_pylist(), strict=True)):
            path = path_of(levels, i) + suffix
            proofs.append(digest([side for pair in path for side in pair]))
            folded.append(fold(now or leaf, path))
            if paths:
                held.append([{"left": left, "right": right} for left, right in path])
        made = pa.table({
            "doc_id": block["doc_id"], "leaf": block["leaf"], "subroot": pa.array([subroot] * len(leaves)), "root": pa.array([root] * len(leaves)),
            "proof_sha256": pa.array(proofs), "folded_root": pa.array(folded), "verified": pa.array([f == root for f in folded]),
        })
        return made.append_column("path", pa.array(held, pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))) if paths else made

    return prove


PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


PATH = ", path array<struct<left: string, right: string>>"


def verify(rows: DataFrame, root: str) -> DataFrame:
    """rows (FIELDS and path) with verified: whether the row, as it is now, and its path lead to the root.

    Needs nothing but the rows: it can be asked of any part of a dataset.
    """
    up = lambda leaf, p: F.sha2(F.concat(p["left"], leaf, p["right"]), 256)
    return rows.withColumn("verified", F.aggregate("path", leaf_of(F.col("text")), up) == root)


def prove(docs: DataFrame, now: Column, paths: bool = False) -> DataFrame:
    """One row per row of docs (FIELDS; other columns are ignored): doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    now is the text as it is found when it is verified: folded_root is what its leaf and the siblings of the manifest lead
    to. With ``paths``, path holds these siblings, what stands left and right level by level, so that anyone who has the root
    can check a row by itself, see verify. A null source is a source of its own, the first; a null doc_id comes first in its source; equal doc_ids go by their
    leaves. No rows give no rows. All passes but the first handle digests only, and each task a block of ARITY ** k of them.
    """
    with scratch() as here:
        base = docs.select(*(F.col(c).cast("long" if c in ("doc_id", "n_chars") else "string").alias(c) for c in FIELDS), now.alias("now_text"))
        leaves = base.select(
            F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("skey"), "doc_id", leaf_of(F.col("text")).alias("leaf"),
            F.when(~F.col("text").eqNullSafe(F.col("now_text")), leaf_of(F.col("now_text"))).alias("now"),
        )
        placed = place_leaves(leaves)
        total = placed.count()
        height = LEAST_HEIGHT
        while total / ARITY**height > MOST_BLOCKS:
            height += 1
        placed = placed.withColumn("block", F.floor(F.col("p") / ARITY**height))
        nodes = placed.select("skey", "block", "p", "n", "leaf").groupBy("skey", "block").applyInArrow(_reducer(height), "skey string, block long, n long, node string")
        top = here.share(docs.sparkSession, build_top(nodes.collect(), height))
        return here.keep(placed.groupBy("skey", "block").applyInArrow(_prover(height, top, paths), PROOF + PATH * paths), "proofs")
