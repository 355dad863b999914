"""Near-duplicate vectors: Euclidean p-stable hashing, then exact cosine checks.

Vectors of unit length are hashed in several tables; a table's key is a number of random projections, each shifted by a
random offset and quantised to WIDTH (Datar et al., 2004). On the unit sphere cosine c is distance sqrt(2 - 2c), so close
vectors share a bucket of some table with high probability, and others seldom do. How many projections and tables there
are follows from the number of vectors and the threshold: see `layout`.

Buckets hold ids, not vectors. An id travels with the signs of 64 further projections; vectors within a bucket whose signs
differ in more places than those of a wanted pair do are no candidates. Candidates are brought together with their vectors
once and checked by their exact cosine in double precision. All but the projections is DataFrame joins and partial
aggregates.

Buckets of DENSE vectors or more, which clusters of close vectors make, are multiplied in blocks instead: a task has two
blocks of a bucket, and gives how many links each vector has and edges that connect what is linked. Their output is linear
in their input, no row is made for a pair, and a bucket of any size is done whole by as many tasks as it has pairs of
blocks. A pair that shares several such buckets counts in the least of them, and isn't looked for in small buckets.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, holding, materialize, scratch

WIDTH = 2.0
#: Share of the pairs at the threshold that a layout finds at least; closer pairs are found more often.
RECALL = 0.998
#: Vectors that share a bucket of a table with a given one by chance, about; projections at least.
MATES, LEAST_HASHES = 16, 8
#: Signs compared; pairs at the threshold differ in more than the mean and SPREAD standard deviations once in ten million.
SIGNS, SPREAD = 64, 5.2
#: Of the first tables, 16 bits of the keys travel along: a pair that shares one of these is not reported again by others.
FIRST = 4
#: Vectors hashed at a time.
CHUNK = 2000
#: Vectors from which a bucket is dense, and of a block about; rows of a block that are multiplied at a time.
DENSE, BLOCK, TILE = 256, 4096, 512
#: Cosines nearer to the threshold than this are summed up again in the order in which all others are.
UNSURE = 1e-9


def collides(distance: float) -> float:
    """The probability that one projection puts two vectors at this distance in one cell (Datar et al., 2004)."""
    if distance == 0:
        return 1.0
    x = WIDTH / distance
    return math.erf(x / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * x) * (1 - math.exp(-x * x / 2))


def layout(n: int, threshold: float) -> tuple[int, int]:
    """Projections a table and tables for n vectors that are compared with each other.

    As many projections as leave about MATES vectors in a bucket by chance (at distance sqrt 2), and then tables for RECALL.
    """
    near, far = collides(math.sqrt(2 - 2 * threshold)), collides(math.sqrt(2))
    hashes = max(LEAST_HASHES, math.ceil(math.log(max(1.0, n / MATES)) / -math.log(far)))
    return hashes, math.ceil(math.log(1 - RECALL) / math.log(1 - near**hashes))


def most_signs(threshold: float) -> int:
    """Signs in which a pair at the threshold may differ."""
    p = math.acos(threshold) / math.pi
    return min(SIGNS, math.ceil(SIGNS * p + SPREAD * math.sqrt(SIGNS * p * (1 - p))))


class Hasher:
    """Keys and signs of unit vectors of one length. Projections are the same for every worker."""

    def __init__(self, dims: int, hashes: int, tables: int, seed: int = 11):
        rng = np.random.default_rng([seed, dims])
        self.shape = (tables, hashes)
        self.lines = rng.standard_normal((dims, tables * hashes))
        self.shifts = rng.uniform(0, WIDTH, tables * hashes)
        self.planes = rng.standard_normal((dims, SIGNS))
        self.odd = rng.integers(1 << 62, size=hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """A 64-bit key per vector and table."""
        cells = np.floor((unit @ self.lines + self.shifts) / WIDTH).astype(np.int64).view(np.uint64)
        mixed = (cells.reshape(len(unit), *self.shape) * self.odd).sum(axis=2, dtype=np.uint64)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)

    def signs(self, unit: np.ndarray) -> np.ndarray:
        return np.packbits(unit @ self.planes > 0, axis=1).view(np.int64).reshape(-1)


def marked(vectors: DataFrame) -> DataFrame:
    """All rows as vec_id, label, embedding and ok: whether a row can be linked, having an id, a label and finite
    components that aren't all zero."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists(v, lambda x: x != 0)
    known = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    return vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding",
        F.coalesce(known & finite & some, F.lit(False)).alias("ok"),
    )


def vector_hash(embedding: Column) -> Column:
    return F.xxhash64(embedding)


def _nodes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors of a label as nodes, and (vec_id, node) of all rows.

    A hash that only one distinct vector of a label has stands for it, so vectors are shuffled once.
    """
    rows = rows.withColumn("hash", vector_hash(F.col("embedding")))
    nodes = rows.groupBy("label", "hash", "embedding").agg(F.min("vec_id").alias("vec"), F.count(F.lit(1)).alias("weight"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    by_hash = nodes.groupBy("label", "hash").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"))
    alone = materialize(by_hash.where("n = 1").select("label", "hash", "node"), "vector-hashes")
    shared = materialize(by_hash.where("n > 1").select("label", "hash"), "shared-hashes")
    told = rows.join(shared, ["label", "hash"], "left_semi").join(nodes.select("label", "hash", "embedding", "node"), ["label", "hash", "embedding"])
    own = rows.select("vec_id", "label", "hash").join(alone, ["label", "hash"]).select("vec_id", "node")
    return nodes, materialize(own.union(told.select("vec_id", "node")), "vector-rows")


def _hashed(nodes: DataFrame, hashes: int, tables: int) -> DataFrame:
    """node, label, dims, scale, norm, keys and signs. A vector times its scale, a power of 2, has the norm."""

    def run(batches):
        made: dict[int, Hasher] = {}
        holding("vectors", made.clear)
        for batch in batches:
            for start in range(0, len(batch), CHUNK):
                part = batch.slice(start, CHUNK)
                sizes = np.array(part.column(2).value_lengths())
                for dims in np.unique(sizes).tolist():
                    some = part.take(pa.array(np.flatnonzero(sizes == dims)))
                    v = some.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
                    scale = np.ldexp(1.0, -np.frexp(np.abs(v).max(axis=1))[1])
                    v = v * scale[:, None]
                    norm = np.sqrt((v * v).sum(axis=1))
                    if dims not in made:
                        made[dims] = Hasher(dims, hashes, tables)
                    unit = v / norm[:, None]
                    keys = pa.ListArray.from_arrays(
                        pa.array(np.arange(len(v) + 1) * tables, pa.int32()), pa.array(made[dims].keys(unit).reshape(-1))
                    )
                    yield pa.RecordBatch.from_arrays(
                        [
                            some.column(0), some.column(1), pa.array(np.full(len(v), dims), pa.int32()), pa.array(scale),
                            pa.array(norm), keys, pa.array(made[dims].signs(unit)),
                        ],
                        names=["node", "label", "dims", "scale", "norm", "keys", "signs"],
                    )

    schema = "node long, label string, dims int, scale double, norm double, keys array<long>, signs long"
    return materialize(nodes.select("node", "label", "embedding").mapInArrow(run, schema), "hashed-vectors")


def _bucket(key: str, tbl: str) -> Column:
    return F.xxhash64("label", "dims", tbl, key).alias("bucket")


def _dense(hashed: DataFrame) -> DataFrame:
    """(node, dense) of the nodes in dense buckets: these buckets in ascending order, each with its number of blocks."""
    each = hashed.select("node", "label", "dims", F.posexplode("keys").alias("tbl", "key")).select("node", _bucket("key", "tbl"))
    blocks = F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")
    large = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), blocks).where(F.col("n") >= DENSE)
    large = materialize(large.select("bucket", "blocks"), "dense-buckets")
    # at most one entry for each table
    own = each.join(large, "bucket").groupBy("node").agg(F.array_sort(F.collect_set(F.struct("bucket", "blocks"))).alias("dense"))
    return materialize(own, "dense-nodes")


def _cosines(x: np.ndarray, y: np.ndarray, norm_x: np.ndarray, norm_y: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the cosine of each row of x with each of y is the threshold at least."""
    linked = np.empty((len(x), len(y)), dtype=bool)
    for at in range(0, len(x), TILE):
        cosine = (x[at : at + TILE] @ y.T) / (norm_x[at : at + TILE, None] * norm_y)
        part = linked[at : at + TILE]
        np.greater_equal(cosine, threshold, out=part)
        rows, columns = np.nonzero(np.abs(cosine - threshold) < UNSURE)
        for i in range(0, len(rows), TILE):
            r, c = rows[i : i + TILE], columns[i : i + TILE]
            total = np.add.accumulate(x[at + r] * y[c], axis=1)[:, -1]
            part[r, c] = total / (norm_x[at + r] * norm_y[c]) >= threshold
    return linked


def _weights(linked: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Of each row the sum of the weights that it is linked with."""
    parts = [linked[i : i + TILE].astype(np.float64) @ weight.astype(np.float64) for i in range(0, len(linked), TILE)]
    return np.concatenate([np.zeros(0), *parts]).astype(np.int64)


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of edges that connect what a matrix of links does, fewer than it has rows and columns."""
    rows, columns = [], []
    new_row, new_column = linked.any(axis=1), linked.any(axis=0)
    for start in np.flatnonzero(new_row):
        if not new_row[start]:
            continue
        new_row[start] = False
        front = np.array([start])
        while len(front):
            some = np.flatnonzero(new_column)
            reached = linked[np.ix_(front, some)]
            hit = reached.any(axis=0)
            found = some[hit]
            rows.append(front[reached[:, hit].argmax(axis=0)])
            columns.append(found)
            new_column[found] = False
            some = np.flatnonzero(new_row)
            reached = linked[np.ix_(some, found)]
            hit = reached.any(axis=1)
            front = some[hit]
            rows.append(front)
            columns.append(found[reached[hit].argmax(axis=1)] if len(front) else front)
            new_row[front] = False
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *rows]), np.concatenate([none, *columns])


def _multiplied(dense: DataFrame, nodes: DataFrame, hashed: DataFrame, threshold: float) -> DataFrame:
    """What dense buckets link: rows (a, null, n) say that n rows' vectors are linked with node a, others (a, b, null) are
    edges."""
    whole = dense.join(nodes.select("node", "weight", "label", "embedding"), "node")
    whole = whole.join(hashed.select("node", "dims", "scale", "norm"), "node")
    each = whole.withColumn("of", F.explode("dense")).withColumn("block", F.expr("cast(pmod(xxhash64(node), of.blocks) as int)"))
    each = each.withColumn("other", F.explode(F.expr("sequence(0, of.blocks - 1)")))
    pairs = each.select(
        F.col("of.bucket").alias("bucket"), "label", "dims", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "node", "weight", "embedding", "scale", "norm", F.col("dense.bucket").alias("buckets"),
    )

    def run(key, table):
        holding("vectors")
        bucket, _, dims, i, j = (k.as_py() for k in key)
        block, node, weight, scale, norm = (table[n].to_numpy() for n in ("block", "node", "weight", "scale", "norm"))
        vector = table["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        vector = vector.reshape(-1, dims) * scale[:, None]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        linked = _cosines(vector[left], vector[right], norm[left], norm[right], threshold)
        if i == j:
            np.fill_diagonal(linked, False)
        # what shares a lesser bucket counts there
        lists = table["buckets"].combine_chunks()
        owner = np.repeat(np.arange(len(node)), np.array(lists.value_lengths()))
        shared = lists.flatten().to_numpy()
        owner, shared = owner[shared < bucket], shared[shared < bucket]
        order = np.argsort(shared, kind="stable")
        row, column = np.full((2, len(node)), -1)
        row[left], column[right] = np.arange(len(left)), np.arange(len(right))
        for have in np.split(owner[order], np.flatnonzero(np.diff(shared[order])) + 1):
            r, c = row[have], column[have]
            linked[np.ix_(r[r >= 0], c[c >= 0])] = False
        a, b = forest(linked)
        n, of, edges = _weights(linked, weight[right]), left, len(a)
        if i < j:
            n, of = np.concatenate([n, _weights(linked.T, weight[left])]), np.concatenate([left, right])
        of, n = of[n > 0], n[n > 0]
        return pa.table({
            "a": pa.array(np.concatenate([node[of], node[left[a]]])),
            "b": pa.concat_arrays([pa.nulls(len(of), pa.int64()), pa.array(node[right[b]])]),
            "n": pa.concat_arrays([pa.array(n), pa.nulls(edges, pa.int64())]),
        })

    met = pairs.groupBy("bucket", "label", "dims", "i", "j").applyInArrow(run, "a long, b long, n long")
    return materialize(met, "dense-links")


def _candidates(hashed: DataFrame, dense: DataFrame | None, threshold: float) -> DataFrame:
    """Pairs (a, b) of nodes that share a bucket, but no dense one, and differ in few enough signs."""
    first = F.transform(F.slice("keys", 1, FIRST), lambda k: (F.pmod(k, F.lit(65536)) - 32768).cast("short"))
    columns = ["node", "signs", "first", "tbl"]
    apart = ""
    if dense is not None:
        hashed = hashed.join(dense.select("node", F.col("dense.bucket").alias("dense")), "node", "left")
        columns.append("dense")
        apart = " and not coalesce(arrays_overlap(x.dense, y.dense), false)"
    own = [c for c in columns if c not in ("first", "tbl")]
    each = hashed.select(*own, "label", "dims", first.alias("first"), F.posexplode("keys").alias("tbl", "key"))
    rows = each.select(*columns, _bucket("key", "tbl"))
    if dense is not None:
        rows = rows.where("not coalesce(array_contains(dense, bucket), false)")
    # not told already by one of the first tables
    again = " or ".join(f"(x.tbl > {i} and x.first[{i}] = y.first[{i}])" for i in range(FIRST))
    met = rows.alias("x").join(
        rows.alias("y"),
        F.expr(
            f"x.bucket = y.bucket and x.tbl = y.tbl and x.node < y.node and bit_count(x.signs ^ y.signs) <= {most_signs(threshold)} "
            f"and not coalesce({again}, false){apart}"
        ),
    )
    return materialize(met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct(), "vector-pairs")


def _linked(pairs: DataFrame, nodes: DataFrame, hashed: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose cosine is the threshold at least, with the nodes' weights."""
    whole = nodes.select("node", "weight", "label", "embedding").join(hashed.select("node", "dims", "scale", "norm"), "node")
    side = lambda n: F.struct("weight", "label", "dims", "embedding", "scale", "norm").alias(n)
    both = pairs.join(whole.select(F.col("node").alias("a"), side("x")), "a").join(whole.select(F.col("node").alias("b"), side("y")), "b")
    at = lambda n, v: v.cast("double") * F.col(f"{n}.scale")
    products = F.zip_with("x.embedding", "y.embedding", lambda p, q: at("x", p) * at("y", q))
    cosine = F.aggregate(products, F.lit(0.0), lambda s, p: s + p) / (F.col("x.norm") * F.col("y.norm"))
    # buckets are told by a hash of label and length, so these are compared too
    same = (F.col("x.label") == F.col("y.label")) & (F.col("x.dims") == F.col("y.dims"))
    found = both.where(same & (cosine >= threshold))
    return materialize(found.select("a", "b", F.col("x.weight").alias("wa"), F.col("y.weight").alias("wb")), "vector-links")


def near_duplicates(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """One row per row of vectors (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Only vectors of equal labels are compared, pairs of cosine >= threshold are linked. Vectors that are null, zero,
    empty or hold null or non-finite components, and rows without a label, link with nothing; so does a null vec_id,
    whose component_id is null. Vectors of different lengths are never linked. Equal vectors of a label are one node with
    a weight, so thousands of copies cost one comparison. Rows that repeat a vec_id count as vectors of their own for
    n_links, and their vectors' components are one. No rows give no rows.
    """
    with scratch() as here:
        rows = marked(vectors)
        nodes, own = _nodes(rows.where("ok").drop("ok"))
        most = nodes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        hashed = _hashed(nodes, *layout(most, threshold))
        dense = _dense(hashed)
        some = not dense.isEmpty()
        links = _linked(_candidates(hashed, dense if some else None, threshold), nodes, hashed, threshold)
        counted = links.select(F.col("a").alias("node"), F.col("wb").alias("w")).union(links.select("b", "wa"))
        edges = links.select("a", "b")
        if some:
            more = _multiplied(dense, nodes, hashed, threshold)
            counted = counted.union(more.where("b is null").select("a", "n"))
            edges = edges.union(more.where("b is not null").select("a", "b"))
        counted = counted.groupBy("node").agg(F.sum("w").alias("n"))
        # a vec_id on several rows joins its nodes
        several = own.groupBy("vec_id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
        joined = own.join(several.select("vec_id", "lo"), "vec_id").select(F.col("lo").alias("a"), F.col("node").alias("b"))
        parts = materialize(components(edges.union(joined)), "vector-components")
        named = nodes.select("node", "vec", "weight").join(parts, "node", "left").withColumn("root", F.coalesce("root", "node"))
        named = materialize(named, "vector-named")
        least = materialize(named.groupBy("root").agg(F.min("vec").alias("component_id")), "component-names")
        known = named.join(least, "root").join(counted, "node", "left").select(
            "node", "component_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links")
        )
        linked = own.join(materialize(known, "vector-known"), "node").select("vec_id", "n_links", "component_id")
        rest = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        out = linked.union(rest)
        return here.keep(out.withColumn("kept", F.col("vec_id") == F.col("component_id")), "near-vectors")
