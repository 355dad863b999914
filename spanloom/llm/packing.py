"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Documents longer than a sequence are cut; the pieces are items of an integer size from 1 to the capacity. All that
decides a packing is how many items there are of each size, so the whole reduction and the best-fit run on a histogram
of at most ``capacity`` entries, and yield a plan: patterns (which sizes share a sequence) with multiplicities. The
plan is as small as the capacity demands, whatever the number of items: each step of the reduction and of best-fit uses
up a size or a class of open sequences, so classes are at most a few for each size, and a class holds at most
sqrt(2 * capacity) sizes. Items are numbered within their size by a distributed ranking and look their place up in the
plan's rows, which are sorted by size and rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens
from .common import materialize

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Items ranked by one task; sizes with more items are ranked in several runs whose offsets are added.
RUN_ITEMS = 50_000


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: whole if it fits, else full pieces after a first one that may be shorter."""
    if n <= capacity:
        return [n] if n else []
    first = n % capacity
    return [first] * bool(first) + [capacity] * (n // capacity)


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length, ids_crc32 (of little-endian uint32 ids).

    A null or empty text is the end id alone. Rows are read for doc_id and text only, so other columns don't matter.
    """

    def cut(batches):
        enc = tokens.tokenizer_encoder(tokenizer, keeps_space=True)
        for batch in batches:
            rows: list[tuple] = []
            keys = batch.column(0).to_pylist()
            for key, packed in zip(keys, enc.encode_column(batch.column(1)), strict=True):
                raw = np.append(enc.ids(packed).astype("<u4"), np.uint32(end_id)).astype("<u4").tobytes()
                start = 0
                for k, size in enumerate(cut_lengths(len(raw) // 4, capacity)):
                    rows.append((key, k, start, size, zlib.crc32(raw[4 * start : 4 * (start + size)])))
                    start += size
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(cut, PIECES)


@dataclass
class Plan:
    """Patterns of sizes with multiplicities, as rows (size, rank_from, rank_to, first sequence, copies, offset)."""

    capacity: int
    rows: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0
    fixed: int = 0
    _used: dict[int, int] = field(default_factory=dict)

    def add(self, sizes: dict[int, int], times: int) -> None:
        """``times`` sequences, each with sizes[s] items of size s, largest first."""
        offset = 0
        for size in sorted(sizes, reverse=True):
            copies = sizes[size]
            at = self._used.get(size, 0)
            self.rows.append((size, at, at + copies * times, self.sequences, copies, offset))
            self._used[size] = at + copies * times
            offset += copies * size
        assert offset <= self.capacity
        self.sequences += times


class _Stock:
    """Items left, by size."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {s: n for s, n in counts.items() if n > 0}
        self.sizes = sorted(self.counts)

    def take(self, size: int, n: int) -> None:
        self.counts[size] -= n
        if not self.counts[size]:
            del self.counts[size]
            self.sizes.pop(bisect_left(self.sizes, size))

    def smallest(self, n: int, without: int) -> list[int] | None:
        """Sizes of the n smallest items besides one of size ``without``; None if there are fewer."""
        out: list[int] = []
        for s in self.sizes:
            out += [s] * min(n - len(out), self.counts[s] - (s == without))
            if len(out) == n:
                return out
        return None

    def largest_within(self, room: int, without: dict[int, int]) -> int | None:
        k = bisect_right(self.sizes, room) - 1
        while k >= 0:
            s = self.sizes[k]
            if self.counts[s] > without.get(s, 0):
                return s
            k -= 1
        return None

    def best_pair(self, room: int, without: dict[int, int]) -> tuple[int, int] | None:
        """The pair of items with the largest sum within room."""
        low, high, best = 0, len(self.sizes) - 1, None
        left = {s: self.counts[s] - without.get(s, 0) for s in without}
        usable = lambda s: left.get(s, self.counts[s])
        while low <= high:
            a, b = self.sizes[low], self.sizes[high]
            if a + b > room:
                high -= 1
            elif not usable(a) or (a == b and usable(a) < 2):
                low += 1
            elif not usable(b):
                high -= 1
            else:
                if best is None or a + b > sum(best):
                    best = (b, a)
                low += 1
        return best


def reduce_instance(stock: _Stock, plan: Plan) -> None:
    """Martello and Toth's reduction: fix sets that provably dominate every other set with the same largest item.

    A feasible set dominates another one if the other's items can be grouped so that each group fits the size of a
    distinct item of the first. Taking the sizes s in falling order, with r = capacity - s:
    1. no other item fits: {s} is fixed; 2. an item of exactly r exists: {s, r} dominates all;
    3. two more items never fit: {s, largest item <= r} dominates all;
    4. three more never fit and the largest item <= r is at least the best pair's sum: that single item dominates;
    5. three more never fit, and the best pair's members are each as large as any that a feasible pair has in that
       place, the first being also the largest single item: the pair dominates.
    Sizes for which no rule holds stay for best-fit. A set is fixed as many times at once as the stock of its sizes allows,
    also where s itself is among the others: taking items only makes the smallest ones larger and the largest ones and
    pairs smaller, so what held for the first set holds for the next while there are items for it. Each round uses up a
    size or leaves fewer of it than the set takes, so the plan doesn't grow with the rows.
    """
    for s in reversed(list(stock.sizes)):
        while stock.counts.get(s):
            r = plan.capacity - s
            own = {s: 1}
            partner = stock.largest_within(r, own)
            if partner is None:
                n = stock.counts[s] if s * 2 > plan.capacity else 1
                chosen = {}
            else:
                two, three = stock.smallest(2, s), stock.smallest(3, s)
                if partner == r or two is None or sum(two) > r:
                    chosen = {partner: 1}
                elif three is None or sum(three) > r:
                    pair = stock.best_pair(r, own)
                    if pair is None or partner >= sum(pair):
                        chosen = {partner: 1}
                    elif pair[0] == partner and (
                        (second := stock.largest_within(min(r // 2, r - two[0]), own)) is None or pair[1] >= second
                    ):
                        chosen = {pair[0]: 1 + (pair[0] == pair[1])} | ({pair[1]: 1} if pair[0] != pair[1] else {})
                    else:
                        break
                else:
                    break
            sizes = dict(chosen)
            sizes[s] = sizes.get(s, 0) + 1
            if chosen:
                n = min(stock.counts[x] // k for x, k in sizes.items())
            plan.add(sizes, n)
            plan.fixed += n
            for x, k in sizes.items():
                stock.take(x, k * n)


def best_fit(stock: _Stock, plan: Plan) -> None:
    """Best-fit decreasing on counts: open sequences of equal content are one class with a multiplicity."""
    rooms: dict[int, list[list]] = {}  # room left -> [[content, multiplicity]]
    order: list[int] = []

    def put(room: int, content: dict[int, int], times: int) -> None:
        if room not in rooms:
            rooms[room] = []
            insort(order, room)
        rooms[room].append([content, times])

    for s in reversed(list(stock.sizes)):
        n = stock.counts[s]
        while n:
            k = bisect_left(order, s)
            if k == len(order):
                each = min(plan.capacity // s, n)
                put(plan.capacity - each * s, {s: each}, n // each)
                n -= each * (n // each)
                continue
            room = order[k]
            content, times = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
                order.pop(k)
            each = min(room // s, n)  # the same sequence stays the best fit until no more of this size fit
            filled = min(times, n // each)
            if times > filled:
                put(room, content, times - filled)
            put(room - each * s, content | {s: content.get(s, 0) + each}, filled)
            n -= each * filled
    for classes in rooms.values():
        for content, times in classes:
            plan.add(content, times)


def make_plan(counts: dict[int, int], capacity: int) -> Plan:
    plan, stock = Plan(capacity), _Stock(counts)
    reduce_instance(stock, plan)
    best_fit(stock, plan)
    return plan


def ranked(items: DataFrame) -> DataFrame:
    """Number the items of each size from 0 (column rank); ties go by doc_id, piece.

    A size may hold most items, so its items are dealt to runs by hash, numbered within the run, and shifted by the
    sizes of the runs before. The number of runs follows the number of rows.
    """
    n = items.count()
    runs = max(1, -(-n // RUN_ITEMS))
    dealt = items.withColumn("run", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(runs)).cast("int"))
    per_run = dealt.groupBy("length", "run").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    shift = per_run.select("length", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    inside = Window.partitionBy("length", "run").orderBy("doc_id", "piece", "ids_crc32")
    return (
        dealt.withColumn("at", F.row_number().over(inside) - 1)
        .join(shift, ["length", "run"])
        .withColumn("rank", F.col("at") + F.col("shift"))
        .drop("run", "at", "shift")
    )


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs at least, by the tokens alone."""
    return -(-sum(size * n for size, n in counts.items()) // capacity)


PLACE = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
#: Bits of a rank within its size, in the key that the plan's rows are sorted by.
RANK_BITS = 44


def places(plan: Plan):
    """A function of Arrow arrays of sizes and ranks that gives their sequences and offsets."""
    rows = np.array(sorted((size << RANK_BITS | lo, lo, first, copies, base) for size, lo, _, first, copies, base in plan.rows), dtype=np.int64)
    keys, lows, firsts, copies, bases = rows.reshape(-1, 5).T.copy()

    def look(sizes: pa.Array, ranks: pa.Array) -> pa.Array:
        size, rank = sizes.to_numpy(zero_copy_only=False), ranks.to_numpy(zero_copy_only=False)
        at = np.searchsorted(keys, size << RANK_BITS | rank, side="right") - 1
        nth = rank - lows[at]
        return pa.StructArray.from_arrays(
            [pa.array(firsts[at] + nth // copies[at]), pa.array(bases[at] + nth % copies[at] * size)], names=PLACE.names
        )

    return look


def pack(items: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to items (columns doc_id, piece, length, ids_crc32 and any others).

    Items of no length or more than the capacity aren't accepted: `pieces` makes none. Equal items, and a null doc_id,
    are items each. No items: an empty result.
    """
    counts = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    look = places(make_plan(counts, capacity))  # at most `capacity` counts came to the driver
    place = F.arrow_udf(look, PLACE).asNondeterministic()  # so that no plan computes it twice
    return ranked(items).withColumn("_place", place("length", "rank")).select(*_names(items), "_place.*")


def _names(items: DataFrame) -> list:
    return [F.col("`" + c.replace("`", "``") + "`") for c in items.columns]


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Pack all documents: one row per piece with its place.

    Null and empty texts are one end id. Rows that repeat a doc_id are packed each; texts of any length are cut.
    """
    return pack(materialize(pieces(docs, tokenizer, end_id, capacity), "pieces"), capacity)
