"""Jaccard similarity join of documents' shingle sets: grouped prefix join (Bouros, Ge and Mamoulis, 2012).

1. Documents with equal sets are one node. Nodes with equal size and prefix are one group.
2. Shingles have one global order, rare ones first. Two sets with similarity >= t share a shingle among the first
   n - ceil(t n) + 1 of each. Groups are joined on prefix shingles and filtered by size and by the shingles' positions.
3. Group pairs are expanded to their members, which are verified on the whole sets. Signatures, the parity of a set's
   shingles by hash, differ in no more bits than the sets do in shingles, which leaves out most pairs that aren't similar:
   of groups with one member within the join, of others when they are expanded. The last join is of members, each by its
   own signature. Sets of many shingles differ in more than a signature can tell, so that theirs is longer; it is looked
   at in the last join, on crowded shingles.

Prefixes are longer by SHARED - 1 than step 2 needs, so that a similar pair shares SHARED shingles of its prefixes; pairs
with fewer, which common phrases make, are never fetched. Shingles that stand in the prefixes of just the same groups, as
those of near copies do, are joined as one bundle, whose name is a hash of these groups. Where this module says shingle of
a posting, it is a bundle.

What is wanted are classes, so pairs within a class already known needn't be compared. First, groups with a crowded
shingle are compared with a few others of that shingle and size band (linear in the postings), and groups with their own
members; what is similar becomes a class. Large classes are then compared with all others through the node in their
middle. The last round joins all nodes that aren't of the same class. Within a shingle, those of the class that most of
its nodes have are met by the others only, so a crowd of near copies that are one class costs nothing.
No link between classes is lost.

Shingles whose hash is in the lowest part of its range come first; these are counted exactly over all documents, and
crowded ones come after all others of that part. The part is large enough for most prefixes to lie in it. The counts of
crowded shingles are kept in a table that may be coarse, as any order is right that is the same everywhere.

Sets are of 64-bit hashes, so what is exact is so up to collisions of these: two shingles of a pair of sets collide with
a probability of about their number squared / 2^65. So do the names of bundles.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, materialize, scratch
from .shingles import column_sets

#: Shingles counted by a task before it reports.
CHUNK_SHINGLES = 1_000_000
#: Tables of bits that are sent to the workers have 8 bits for each thing they hold, within these bounds; the largest takes
#: 32 MB. A full one only lets more pass. Tables of counts have 4 entries for each, the largest takes 16 MB.
BITS, COUNTS = (1 << 16, 1 << 28), (1 << 12, 1 << 22)
#: Shingles are counted if their hash is in the lowest part of its range, this many times the share of a prefix.
ZONE = 2.5
#: Prefix shingles that a pair must share.
SHARED = 4
#: A shingle is crowded with so many groups; its groups are first compared with so many of them per size band.
CROWD, HUBS = 8, 8
#: Longs of a set's signature, the parity of its shingles by hash modulo 64 * SIGNATURE.
SIGNATURE = 4
#: Longs of the longer signature at most. It has two bits or more for each shingle; sets that SIGNATURE serves have none.
FAR = 64

SETS = (
    "doc_id long, n_shingles long, print binary, px binary, prefix array<struct<shingle:long,at:int>>, sig array<long>, "
    "far array<long>"
)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def table_size(n: int, bounds: tuple[int, int]) -> int:
    """The least power of two that is n at least, within bounds."""
    return min(max(1 << max(0, n - 1).bit_length(), bounds[0]), bounds[1])


def zone_end(percent: int) -> np.int64:
    return np.int64(min(2**63 - 1, int(-(2**63) + min(1.0, ZONE * (100 - percent) / 100) * 2**64)))


def bit_table(rows: DataFrame, bits: int) -> np.ndarray:
    """A table of bits, set where a column ``bit`` says; at most bits / 64 rows come to the driver."""
    words = (
        rows.groupBy(F.floor(F.col("bit") / 64).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
        .toArrow()
    )
    table = np.zeros(bits // 64, dtype=np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    return table


def counted_shingles(docs: DataFrame, size: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the counted zone: document counts of crowded shingles by shingle modulo the table's size, and the bits of all
    that occur at least twice, likewise."""
    below = zone_end(percent)

    def run(batches):
        held: list[np.ndarray] = []
        total = 0

        def report():
            found, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["shingle", "n"])

        for batch in batches:
            for one in column_sets(batch.column(0), size):
                held.append(one[: np.searchsorted(one, below)])  # sets are sorted
                total += len(held[-1])
                if total >= CHUNK_SHINGLES:
                    yield report()
                    held, total = [], 0
        if held:
            yield report()

    counts = _texts(docs).select("text").mapInArrow(run, "shingle long, n long")
    twice = materialize(counts.groupBy("shingle").agg(F.sum("n").alias("n")).where("n > 1"), "shingle-counts")
    n_twice, n_crowded = twice.agg(F.count(F.lit(1)), F.count_if(F.col("n") >= CROWD)).first()
    entries, bits = table_size(4 * n_crowded, COUNTS), table_size(8 * n_twice, BITS)
    rows = (
        twice.where(F.col("n") >= CROWD)
        .groupBy(F.pmod("shingle", F.lit(entries)).cast("int").alias("at")).agg(F.max("n").alias("n"))
        .toArrow()
    )  # at most ``entries`` rows
    out = np.zeros(entries, dtype=np.int32)
    out[rows["at"].to_numpy()] = np.minimum(rows["n"].to_numpy(), 2**31 - 1)
    return out, bit_table(twice.select(F.pmod("shingle", F.lit(bits)).alias("bit")), bits)


def prefix_length(n: int, percent: int) -> int:
    least = -(-percent * n // 100)  # of the set that a similar one has
    return n - least + min(SHARED, least)


def parity(s: np.ndarray, words: int) -> np.ndarray:
    """The parity of a set's shingles by hash modulo 64 * words, a power of two."""
    odd = np.bincount((s >> 9) & (64 * words - 1), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def far_words(n: int) -> int:
    """Longs of the longer signature of n shingles; 0 for none."""
    words = min(table_size(2 * n, (64, 64 * FAR)) // 64, FAR)
    return words if words > SIGNATURE else 0


def sets_and_prefixes(docs: DataFrame, size: int, percent: int, shared) -> DataFrame:
    """One row per document in SETS: print of its set, px of its prefix, and the prefix shingles that can be shared.

    shared: a broadcast of what `counted_shingles` gives.
    """
    pair = pa.struct([("shingle", pa.int64()), ("at", pa.int32())])
    below, last = zone_end(percent), np.int32(2**31 - 1)

    def run(batches):
        weight, twice = shared.value
        bits = 64 * len(twice)
        for batch in batches:
            sizes, prints, marks, kept, places, sigs, fars = [], [], [], [], [], [], []
            for s in column_sets(batch.column(1), size):
                n = len(s)
                rank = np.where(s < below, weight[np.mod(s, len(weight))], last)
                order = np.argsort(rank, kind="stable")  # s is sorted already
                sizes.append(n)
                prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if n else None)
                prefix = s[order[: prefix_length(n, percent)]] if n else s
                marks.append(hashlib.blake2b(prefix.tobytes(), digest_size=16).digest() if n else None)
                bit = np.mod(prefix, bits)
                place = np.flatnonzero((prefix >= below) | ((twice[bit >> 6] >> (bit & 63)) & 1 == 1))
                kept.append(prefix[place])
                places.append(place)
                sigs.append(parity(s, SIGNATURE))
                fars.append(parity(s, words) if (words := far_words(n)) else None)
            ends = np.cumsum([0, *map(len, kept)])
            flat = pa.StructArray.from_arrays(
                [pa.array(np.concatenate([*kept, np.zeros(0, dtype=np.int64)])), pa.array(np.concatenate([*places, np.zeros(0, dtype=np.int64)]).astype(np.int32))],
                fields=list(pair),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(marks, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat), pa.array(sigs, pa.list_(pa.int64())),
                    pa.array(fars, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "print", "px", "prefix", "sig", "far"],
            )

    return _texts(docs).mapInArrow(run, SETS)


def whole_sets(docs: DataFrame, size: int, ids: DataFrame) -> DataFrame:
    """(doc_id, shingles) of the rows of docs whose doc_id is in ids, and of some others; written as a table.

    No text is shuffled: rows are looked up in a table of bits that is sent to the workers.
    """
    bits = table_size(8 * ids.count(), BITS)
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    with scratch() as here:
        shared = here.share(docs.sparkSession, bit_table(ids.select(bit.alias("bit")), bits))

        def run(batches):
            table = shared.value
            for batch in batches:
                at = batch.column(2).to_numpy(zero_copy_only=False)
                wanted = batch.take(pa.array(np.flatnonzero((table[at >> 6] >> (at & 63)) & 1)))
                for i in range(0, len(wanted), 500):
                    part = wanted.slice(i, 500)
                    sets = list(column_sets(part.column(1), size))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "shingles"]
                    )

        rows = _texts(docs).where("doc_id is not null").select("doc_id", "text", bit.alias("bit"))
        return here.keep(rows.mapInArrow(run, "doc_id long, shingles array<long>"), "sets")


def _overlap(percent: int, x: str, y: str) -> str:
    """Least number of common shingles of similar sets of x and y shingles."""
    return f"(({percent}L * ({x} + {y}) + {99 + percent}) div {100 + percent})"


def _signed(percent: int, x: str, y: str, n_x: str, n_y: str) -> str:
    """Whether signatures allow sets of n_x and n_y shingles to be similar; a null one allows any."""
    differ = " + ".join(f"bit_count({x}[{i}] ^ {y}[{i}])" for i in range(SIGNATURE))
    return f"coalesce({differ} <= {n_x} + {n_y} - 2 * {_overlap(percent, n_x, n_y)}, true)"


def _far_signed(percent: int) -> str:
    """Whether longer signatures allow x and y to be similar; where one has none, they do.

    That of the larger set may be twice as long; its halves are laid over each other, which gives the shorter one.
    """
    half = lambda far, other: (
        f"if(size({far}) > size({other}), zip_with(slice({far}, 1, size({other})), "
        f"slice({far}, 1 + size({other}), size({other})), (p, q) -> p ^ q), {far})"
    )
    differ = f"zip_with({half('x.far', 'y.far')}, {half('y.far', 'x.far')}, (p, q) -> bit_count(p ^ q))"
    most = f"x.n + y.n - 2 * {_overlap(percent, 'x.n', 'y.n')}"
    return (
        f"if(x.far is null or y.far is null or greatest(size(x.far), size(y.far)) > 2 * least(size(x.far), size(y.far)), "
        f"true, aggregate({differ}, 0, (sum, one) -> sum + one) <= {most})"
    )


def _near(percent: int) -> str:
    """A filter of postings x and y of one shingle.

    By sizes; by how much can be common before and behind the shingle; and by the signatures, where a group has one.
    """
    return (
        f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) and least(x.inside, y.inside) + 1 "
        f"+ least(x.n - x.at - 1, y.n - y.at - 1) >= {_overlap(percent, 'x.n', 'y.n')} "
        f"and {_signed(percent, 'x.sig', 'y.sig', 'x.n', 'y.n')}"
    )


def _candidates(met: DataFrame, percent: int) -> DataFrame:
    """met: x and y (g, n, size, at, w) of groups, a row per common bundle of w prefix shingles. Returns the pairs (a, b, na, nb) that may
    be similar; a is the group of fewer members, or x's.

    They share SHARED shingles, or fewer where a set is so small; and behind the first common one both are long enough.
    """
    own = lambda n: f"least({SHARED}, ({percent}L * {n} + 99) div 100)"
    return (
        met.groupBy(*(F.col(f"{side}.{n}").alias(f"{side}{n}") for side in "xy" for n in ("g", "n", "size")))
        .agg(F.sum("x.w").alias("common"), F.min("x.at").alias("xat"), F.min("y.at").alias("yat"))
        .where(f"common >= least({own('xn')}, {own('yn')})")
        .where(f"1 + least(xn - xat - 1, yn - yat - 1) >= {_overlap(percent, 'xn', 'yn')}")
        .selectExpr(*(f"if(xsize <= ysize, {p}, {q}) AS {n}" for n, p, q in (("a", "xg", "yg"), ("b", "yg", "xg"), ("na", "xn", "yn"), ("nb", "yn", "xn"))))
    )


def link_classes(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of docs (doc_id, text; others are ignored): doc_id, n_shingles, component_id.

    Documents are linked when 100 * intersection >= percent * union of their sets of shingles of ``size`` words;
    component_id is the smallest doc_id reachable by links. A null text, or one without words, has no shingles and
    links with nothing; so does a null doc_id, whose component_id is null. Rows that share a doc_id are one node. No rows
    give no rows.
    """
    with scratch() as here:
        return here.keep(_link_classes(here, docs, size, percent), "link-classes")


def _link_classes(here, docs: DataFrame, size: int, percent: int) -> DataFrame:
    shared = here.share(docs.sparkSession, counted_shingles(docs, size, percent))
    base = materialize(sets_and_prefixes(docs, size, percent, shared), "shingle-sets")
    linkable = base.where("n_shingles > 0 and doc_id is not null")
    nodes = materialize(
        linkable.groupBy("print").agg(
            F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("px").alias("px"),
            F.first("prefix").alias("prefix"), F.first("sig").alias("sig"),
        ),
        "nodes",
    )
    # groups of equal prefix and size; a group is named by its smallest node
    groups = nodes.groupBy("px", "n").agg(
        F.min("node").alias("g"), F.count(F.lit(1)).alias("size"), F.first("prefix").alias("prefix"), F.first("sig").alias("sig")
    )
    groups = materialize(groups, "groups")
    members = materialize(
        nodes.select("px", "n", "node", "sig").join(groups.select("px", "n", "g"), ["px", "n"]).select("node", "g", "sig"),
        "group-members",
    )
    postings = groups.select("g", "size", F.inline("prefix"))
    several = postings.groupBy("shingle").agg(  # by nodes; and which groups have it
        F.sum("size").alias("k"), F.bit_xor(F.xxhash64("g")).alias("who")
    )
    several = several.where("k > 1").select("shingle", "k", F.xxhash64("who", "k").alias("bundle"))
    step = F.lit(float(np.log(100 / percent)))
    band = F.floor(F.log(F.col("n")) / step).cast("int")
    # how many shingles of other prefixes precede: only those can be common with another set
    inside = F.row_number().over(Window.partitionBy("g").orderBy("at")) - 1
    postings = postings.drop("size").join(several, "shingle").withColumn("inside", inside)
    # shingles of the same groups are one bundle of w shingles, which stands where its first one does in all of them
    postings = postings.groupBy("g", "k", "bundle").agg(
        F.count(F.lit(1)).cast("int").alias("w"), F.min("at").alias("at"), F.min("inside").alias("inside")
    )
    # a group of one member has its signature
    own = F.when(F.col("size") == 1, F.col("sig")).alias("sig")
    facts = groups.select("g", "size", F.col("n").cast("int").alias("n"), own, band.alias("band"))
    postings = postings.withColumnRenamed("bundle", "shingle").join(facts, "g")
    postings = materialize(postings, "postings")

    def similar(pairs: DataFrame) -> DataFrame:
        """Of node pairs (a, b), those that are similar, by their whole sets."""
        pairs = materialize(pairs.distinct(), "pairs")
        ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        sets = whole_sets(docs, size, materialize(ids, "wanted"))
        x = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
        y = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
        common = F.size(F.array_intersect("sa", "sb"))
        union = F.size("sa") + F.size("sb") - common
        found = pairs.join(x, "a").join(y, "b").where(common * 100 >= union * percent)
        return materialize(found.select("a", "b"), "links")

    def expanded(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
        """Pairs (a, b) of members of different classes of group pairs (a, b, na, nb), as far as signatures allow.

        The smaller groups are expanded first, and their members meet those of the larger ones by class and signature.
        """
        x = left.select(F.col("g").alias("a"), F.col("node").alias("xn"), F.col("sig").alias("xs"), F.col("class").alias("xc"))
        y = right.select(F.col("g").alias("b"), F.col("node").alias("yn"), F.col("sig").alias("ys"), F.col("class").alias("yc"))
        met = pairs.join(x, "a").join(y, "b").where(f"xc <> yc and {_signed(percent, 'xs', 'ys', 'na', 'nb')}")
        return met.select(F.least("xn", "yn").alias("a"), F.greatest("xn", "yn").alias("b"))

    inner = members.where("node <> g").select(F.col("g").alias("a"), F.col("node").alias("b"))
    links = similar(_hub_pairs(postings, percent).union(inner))

    # large classes are compared with all groups through the node in their middle
    classes = materialize(components(links), "classes")
    classed = _with_classes(members, classes)
    middles = materialize(classed.join(_middles(nodes, classes), "node", "left_semi"), "middles")
    posts = postings.drop("sig").join(middles.select("node", "g", "sig", "class"), "g")
    posts = posts.select("shingle", F.col("node").alias("g"), "n", F.lit(0).cast("long").alias("size"), "at", "inside", "w", "sig")
    posts = materialize(posts, "middle-postings")
    met = postings.alias("x").join(posts.alias("y"), F.expr(f"x.shingle = y.shingle and {_near(percent)}"))
    pairs = _candidates(met, percent)
    central = middles.withColumn("g", F.col("node"))
    links = links.union(similar(expanded(pairs, central, classed)))

    # all nodes of different classes: members of a group differ behind its prefix as much as those of others do
    classes = materialize(components(links), "classes")
    classed = _with_classes(members, classes)
    placed = postings.drop("sig", "size").join(classed, "g").drop("g").withColumnRenamed("node", "g").withColumn("size", F.lit(1))
    # rows that share a doc_id are told apart by their size; those that aren't have no longer signature
    fars = base.where("far is not null").select(F.col("doc_id").alias("g"), F.col("n_shingles").cast("int").alias("n"), "px", "far")
    fars = fars.join(nodes.select(F.col("node").alias("g"), F.col("n").cast("int").alias("n"), "px"), ["g", "n", "px"])
    fars = fars.groupBy("g", "n").agg(F.expr("if(min(far) = max(far), min(far), null)").alias("far"))
    met = _other_classes(materialize(placed, "postings-placed"), fars, percent)
    roots = components(links.union(similar(_candidates(met, percent).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))))

    known = nodes.select("print", "node").join(roots, "node", "left").select("print", F.coalesce("root", "node").alias("root"))
    whole = linkable.select("doc_id", "n_shingles", "print").join(known, "print").select("doc_id", "n_shingles", F.col("root").alias("component_id"))
    return whole.union(
        base.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", "doc_id")
    )


def _hub_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of groups of crowded shingles with a few groups of the same shingle and of a near size band.

    Half of these are those that have least of their own before the shingle, as the source of near copies has; the others
    go by a hash that is the same for all shingles.
    """
    crowd = postings.where(F.col("k") >= CROWD)
    names = ["g", "n", "at", "inside", "sig"]
    orders = [
        F.struct(
            (F.col("at") - F.col("inside") if i < HUBS // 2 else F.lit(0)).alias("o"),
            F.xxhash64(F.lit(i), "g").alias("h"), *names,
        )
        for i in range(HUBS)
    ]
    picked = F.array(*(F.struct(*(F.col(f"h{i}.{n}").alias(n) for n in names)) for i in range(len(orders))))
    hubs = (
        crowd.groupBy("shingle", "band").agg(*[F.min(o).alias(f"h{i}") for i, o in enumerate(orders)])
        .select("shingle", "band", F.explode(F.array_distinct(picked)).alias("hub"))
        .select("shingle", "band", "hub.*")
    )
    near = F.expr(f"x.shingle = y.shingle and abs(x.band - y.band) <= 1 and x.g <> y.g and {_near(percent)}")
    met = crowd.alias("x").join(hubs.alias("y"), near)
    return met.select(F.least("x.g", "y.g").alias("a"), F.greatest("x.g", "y.g").alias("b"))


def _with_classes(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Members with their class."""
    own = members.join(classes, "node", "left").select("node", "g", "sig", F.coalesce("root", "node").alias("class"))
    return materialize(own, "member-classes")


def _other_classes(placed: DataFrame, fars: DataFrame, percent: int) -> DataFrame:
    """Pairs x, y of postings of one shingle whose nodes are of different classes, each pair in one order.

    placed: postings of nodes g with their class and signature. fars: the longer signature, far, of nodes g of n shingles
    that have one; crowded shingles are given it.

    The class that most nodes of a shingle have is its main class; its nodes meet the others only.
    """
    per_class = placed.groupBy("shingle", "class").agg(F.count(F.lit(1)).alias("k"))
    main = per_class.groupBy("shingle").agg(
        F.max_by("class", F.struct("k", "class")).alias("main"), F.count(F.lit(1)).alias("several")
    )
    main = materialize(main.where("several > 1").select("shingle", "main"), "main-classes")
    left = placed.join(main, "shingle").select(
        "shingle", "k", "g", "n", "size", "at", "inside", "w", "sig", "class", (F.col("class") == F.col("main")).alias("is_main")
    )
    left = left.join(fars, ["g", "n"], "left").withColumn("far", F.when(F.col("k") >= CROWD, F.col("far"))).drop("k")
    left = materialize(left, "postings-left")
    near = F.expr(
        "x.shingle = y.shingle and x.class <> y.class "
        f"and (y.is_main or x.g < y.g) and {_near(percent)} and {_far_signed(percent)}"
    )
    met = left.where("not is_main").alias("x").join(left.alias("y"), near)
    # a pair may stand in either order, by the main class of a shingle
    row = lambda side: F.struct(*(F.col(f"{side}.{n}").alias(n) for n in ("g", "n", "size", "at", "w")))
    swap = F.col("x.g") > F.col("y.g")
    return met.select(
        F.when(swap, row("y")).otherwise(row("x")).alias("x"), F.when(swap, row("x")).otherwise(row("y")).alias("y")
    )


def _middles(nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """The node of each class of CROWD or more whose signature is nearest to the majority of each bit."""
    large = classes.groupBy("root").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= CROWD).select("root")
    members = classes.join(large, "root").join(nodes.select("node", "sig"), "node")
    words = members.select("root", F.posexplode("sig").alias("word", "bits"))
    bits = words.select("root", "word", "bits", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit"))
    most = bits.groupBy("root", "word", "bit").agg(F.avg(F.getbit("bits", F.col("bit"))).alias("share"))
    major = most.groupBy("root", "word").agg(
        F.bit_or(F.expr("if(share > 0.5, shiftleft(1L, bit), 0L)")).alias("bits")
    )
    words = members.select("root", "node", F.posexplode("sig").alias("word", "own")).join(major, ["root", "word"])
    away = words.groupBy("root", "node").agg(F.sum(F.expr("bit_count(own ^ bits)")).alias("away"))
    return away.groupBy("root").agg(F.min_by("node", F.struct("away", "node")).alias("node")).select("node")
