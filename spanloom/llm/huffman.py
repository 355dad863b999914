"""Token ids in files: canonical length-limited Huffman codes from global counts, read by table in independent blocks.

Layout, both parts Parquet so that any store which Spark reaches can hold them:
- ``codebook``: (id, bits) for each id that occurs; canonical codes follow from these lengths (by bits, then id).
- ``segments``: rows in ascending doc_id order, each with whole documents: part (file order), segment (order in the
  part), doc_ids, lengths (ids a document), n_ids, payload (the codes, most significant bit first) and checkpoints (bit
  offset of every BLOCK-th id). A reader may start at any checkpoint.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens
from .common import local_table, materialize, scratch, write_table

#: Bits of the first decoding table; up to 65536 ids have no longer codes. Codes of more ids are longer, up to MOST_BITS,
#: and those beyond the first table are found in a second one.
TABLE_BITS, MOST_BITS = 16, 32
#: Ids between checkpoints, ids encoded at a time, which are whole blocks, and ids after which a segment is closed.
BLOCK, CHUNK_IDS = 512, 1 << 15
SEGMENT_IDS = 1 << 20

SEGMENTS = "part int, segment int, doc_ids array<long>, lengths array<long>, n_ids long, payload binary, checkpoints array<long>"


def longest_code(n: int) -> int:
    """The length limit for n ids: two bits more than the least possible one where the first table is too small."""
    return TABLE_BITS if n <= 1 << TABLE_BITS else min((n - 1).bit_length() + 2, MOST_BITS)


def code_lengths(counts: np.ndarray, max_bits: int | None = None) -> np.ndarray:
    """Optimal code lengths of at most max_bits by package-merge; 0 for ids that don't occur."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), dtype=np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    max_bits = max_bits or longest_code(len(used))
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} ids don't fit codes of {max_bits} bits")
    order = used[np.lexsort((used, counts[used]))]
    leaves = counts[order].astype(np.float64)
    level, masks = leaves, [np.ones(len(leaves), dtype=bool)]
    for _ in range(max_bits - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([leaves, pairs])
        by = np.argsort(merged, kind="stable")
        level = merged[by]
        masks.append(by < len(leaves))
    take = 2 * len(leaves) - 2
    for mask in reversed(masks):
        n = int(mask[:take].sum())
        out[order[:n]] += 1
        take = 2 * (take - n)
    return out


class Code:
    """Canonical codes for lengths by id, with the decoding tables.

    The first table is looked up by TABLE_BITS bits. Canonical codes stand in order of their lengths, so longer ones are
    at the end of the code space, from ``far`` on, which the second table covers.
    """

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.short = lengths.astype(np.uint8)
        self.codes = np.zeros(len(lengths), dtype=np.uint64)
        self.bits = bits = max(TABLE_BITS, int(self.lengths.max(initial=0)))
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        width = self.lengths[order]
        span = np.left_shift(1, bits - width)
        start = np.cumsum(span) - span
        self.codes[order] = start >> (bits - width)
        near = width <= TABLE_BITS
        self.symbol, self.width = self._table(order[near], width[near], span[near] >> (bits - TABLE_BITS), 1 << TABLE_BITS)
        self.far = int(span[near].sum())
        self.far_symbol, self.far_width = self._table(order[~near], width[~near], span[~near], int(span[~near].sum()))

    @staticmethod
    def _table(ids, width, span, size: int) -> tuple[np.ndarray, np.ndarray]:
        symbol, bits = np.zeros(size, dtype=np.uint32), np.zeros(size, dtype=np.uint8)
        total = int(span.sum())
        symbol[:total], bits[:total] = np.repeat(ids, span), np.repeat(width, span)
        return symbol, bits

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The payload and the bit offset of every BLOCK-th id. Ids are taken CHUNK_IDS at a time, which caches hold."""
        words = np.zeros(len(ids) * self.bits // 32 + 2, dtype=np.uint64)
        checks, at = [np.zeros(0, dtype=np.int64)], 0
        for k in range(0, len(ids), CHUNK_IDS):
            part = ids[k : k + CHUNK_IDS]
            width = self.short[part]
            if not width.all():
                raise ValueError("an id without a code")
            end = np.cumsum(width, dtype=np.int64)
            end += at
            start = end - width
            word = start >> 5
            high = self.codes[part] << (64 - (start & 31) - width).view(np.uint64)
            first = np.flatnonzero(word[1:] != word[:-1])
            first = np.concatenate([[0], first + 1])
            summed = np.bitwise_or.reduceat(high, first)
            place = word[first]
            words[place] |= summed >> np.uint64(32)
            words[place + 1] |= summed & np.uint64(0xFFFFFFFF)
            checks.append(start[::BLOCK])
            at = int(end[-1])
        return words[: -(-at // 32)].astype(">u4").tobytes()[: (at + 7) // 8], np.concatenate(checks)

    def decode(self, payload, checkpoints: np.ndarray, n_ids: int) -> np.ndarray:
        """All ids of a segment, its blocks read side by side from their checkpoints."""
        if not n_ids:
            return np.zeros(0, dtype=np.uint32)
        long = self.bits > TABLE_BITS
        raw = np.zeros(len(payload) + 5, dtype=np.uint64 if long else np.uint32)
        raw[: len(payload)] = np.frombuffer(payload, dtype=np.uint8)
        seen = 5 if long else 3  # bytes that hold any code, wherever it begins in the first of them
        peek = raw[: 1 - seen] << (8 * (seen - 1))
        for k in range(1, seen):
            peek |= raw[k : len(raw) - seen + 1 + k] << (8 * (seen - 1 - k))
        at = np.asarray(checkpoints, dtype=np.int64).copy()
        blocks = len(at)
        out = np.zeros((BLOCK, blocks), dtype=np.uint32)
        rest = n_ids - (blocks - 1) * BLOCK
        shift, mask = 8 * seen - self.bits, (1 << self.bits) - 1
        for k in range(BLOCK):
            if k == rest:  # the last block ends
                blocks -= 1
                at = at[:blocks]
                if not blocks:
                    break
            code = (peek[at >> 3] >> (shift - (at & 7)).astype(raw.dtype)) & raw.dtype.type(mask)
            if long:
                code = code.astype(np.int64)
                first = code >> (self.bits - TABLE_BITS)
                ids, width = self.symbol[first], self.width[first]
                if len(beyond := np.flatnonzero(code >= self.far)):
                    place = code[beyond] - self.far
                    ids[beyond], width[beyond] = self.far_symbol[place], self.far_width[place]
            else:
                ids, width = self.symbol[code], self.width[code]
            out[k, :blocks] = ids
            at += width
        return out.T.reshape(-1)[:n_ids]


def packed_ids(docs: DataFrame, tokenizer: str, keeps_space: bool, end_id: int, vocab_size: int) -> DataFrame:
    """(doc_id, ids, counts): each text's packed ids with the end id; a null or empty text has only that.

    A task's last row has counts only: how often its texts have each id of the vocabulary, as 64-bit integers.
    """

    def run(batches):
        enc = tokens.tokenizer_encoder(tokenizer, keeps_space)
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        total = np.zeros(vocab_size, dtype=np.int64)
        names = ["doc_id", "ids", "counts"]
        for batch in batches:
            ids = pa.array([p + end for p in enc.encode_column(batch.column(1))], pa.binary())
            total += np.bincount(_flat(ids, enc.dtype)[0], minlength=vocab_size)
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.nulls(len(ids), pa.binary())], names=names)
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([total.tobytes()], pa.binary())], names=names
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, "doc_id long, ids binary, counts binary")


def _flat(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All ids of an Arrow column of packed ids, and the ids a row, without a copy."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    size = np.dtype(dtype).itemsize
    data = column.buffers()[2]
    ids = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]].view(dtype) if data is not None else np.zeros(0, dtype)
    return ids, np.diff(offsets) // size


def global_counts(encoded: DataFrame, vocab_size: int) -> np.ndarray:
    """How often each id occurs in all documents; the driver gets one row per id of the vocabulary."""

    def run(batches):
        total = np.zeros(vocab_size, dtype=np.int64)
        for batch in batches:
            for counts in batch.column(0):
                total += np.frombuffer(counts.as_buffer(), dtype=np.int64)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["id", "n"])

    rows = encoded.select("counts").where("counts is not null").mapInArrow(run, "id long, n long")
    found = rows.groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(vocab_size, dtype=np.int64)
    counts[found["id"].to_numpy()] = found["n"].to_numpy()
    return counts


class _Segment:
    """Documents that wait to be written."""

    def __init__(self):
        self.keys: list[pa.Array] = []
        self.sizes: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []
        self.held = 0

    def add(self, keys: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.keys.append(keys)
        self.sizes.append(sizes)
        self.ids.append(ids.copy())
        self.held += len(ids)

    def batch(self, code: Code, part: int, number: int) -> pa.RecordBatch:
        payload, checks = code.encode(np.concatenate(self.ids))
        whole = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()), pa.array([number], pa.int32()), whole(pa.concat_arrays(self.keys)),
                whole(pa.array(np.concatenate(self.sizes))), pa.array([self.held], pa.int64()),
                pa.array([payload], pa.binary()), whole(pa.array(checks)),
            ],
            names=["part", "segment", "doc_ids", "lengths", "n_ids", "payload", "checkpoints"],
        )


def write(encoded: DataFrame, lengths: np.ndarray, dtype: str, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Write (doc_id, ids) in the file format; returns the codebook and the segments, read back.

    Files under ``path`` stay; without one they are this session's.
    """
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(lengths)

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        code, part, made = Code(shared.value), TaskContext.get().partitionId(), 0
        now = _Segment()
        for batch in batches:
            ids, sizes = _flat(batch.column(1), dtype)
            ends = np.cumsum(sizes)
            row, at = 0, 0
            while row < len(sizes):
                # as many documents as fill the segment, the last one whole
                stop = min(int(np.searchsorted(ends, at + SEGMENT_IDS - now.held)) + 1, len(sizes))
                now.add(batch.column(0).slice(row, stop - row), sizes[row:stop], ids[at : ends[stop - 1]])
                row, at = stop, int(ends[stop - 1])
                if now.held >= SEGMENT_IDS:
                    yield now.batch(code, part, made)
                    now, made = _Segment(), made + 1
        if now.keys:
            yield now.batch(code, part, made)

    parts = max(1, encoded.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = encoded.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "ids"
    )
    used = np.flatnonzero(lengths)
    book = local_table(spark, {"id": used, "bits": lengths[used].astype(np.int32)}, "id long, bits int").coalesce(1)
    coded = ordered.mapInArrow(run, SEGMENTS)
    if path is not None:
        made = write_table(book, f"{path}/codebook"), write_table(coded, f"{path}/segments")
    else:
        made = materialize(book, "huffman-codebook"), materialize(coded, "huffman-segments")
    shared.destroy()
    return made


def open_files(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The codebook and the segments of files that `write` made under ``path``."""
    return spark.read.parquet(f"{path}/codebook"), spark.read.parquet(f"{path}/segments")


def read_documents(codebook: DataFrame, segments: DataFrame, digest, schema: str) -> DataFrame:
    """Decode every segment; digest(doc_ids, lengths, ids, start) makes a segment's record batch in ``schema``.

    start is the number of ids in all earlier segments. It comes from one small row per segment, summed per part over a
    window, plus the parts' totals; the payload isn't shuffled.
    """
    spark = segments.sparkSession
    rows = codebook.toArrow()  # at most one row per id of the vocabulary
    lengths = np.zeros(1 + int(max(rows["id"].to_numpy(), default=0)), dtype=np.uint8)
    lengths[rows["id"].to_numpy()] = rows["bits"].to_numpy()
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()  # one row a file
    base, at = {}, 0
    for r in parts:
        base[r["part"]] = at
        at += r["n"]
    shared = spark.sparkContext.broadcast((lengths, base))
    sizes = segments.select("part", "segment", "n_ids")
    before = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "segment", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"))
    # a part with one segment needs no join: its segments before it have no ids
    single = segments.where("segment = 0").withColumn("before", F.lit(0).cast("long"))
    later = segments.where("segment > 0").join(starts.where("segment > 0"), ["part", "segment"])
    columns = ["part", "doc_ids", "lengths", "n_ids", "payload", "checkpoints", "before"]

    def run(batches):
        lengths, base = shared.value
        code = Code(lengths)
        for batch in batches:
            for part, doc_ids, sizes, n_ids, payload, checks, before in zip(*batch.columns, strict=True):
                ids = code.decode(payload.as_buffer(), checks.values.to_numpy(), n_ids.as_py())
                yield digest(doc_ids.values, sizes.values.to_numpy(), ids, base[part.as_py()] + before.as_py())

    return single.select(columns).union(later.select(columns)).mapInArrow(run, schema)


def crc_digest(doc_ids: pa.Array, lengths: np.ndarray, ids: np.ndarray, start: int) -> pa.RecordBatch:
    """Per document: start, n_tokens and the crc32 of its ids as little-endian uint32."""
    raw = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
    ends = np.cumsum(lengths)
    places = (4 * np.concatenate([[0], ends])).tolist()
    crcs = [zlib.crc32(raw[a:b]) for a, b in zip(places, places[1:], strict=False)]
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.array(start + ends - lengths, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())],
        names=["doc_id", "start", "n_tokens", "ids_crc32"],
    )


def store_documents(
    docs: DataFrame, tokenizer: str, keeps_space: bool, end_id: int, path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Tokenise all documents once, count their ids on the way and write them; returns (codebook, segments).

    Files go under ``path``, which must not exist yet, and stay; without a path they are this session's. Null and empty
    texts are written as the end id alone; null doc_ids come first; rows that repeat a doc_id are kept, ordered by their
    ids. No rows: an empty codebook and no segments.
    """
    from tokenizers import Tokenizer

    vocab = max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1)
    dtype = "<u2" if vocab <= 65536 else "<u4"
    with scratch() as here:
        encoded = materialize(packed_ids(docs, tokenizer, keeps_space, end_id, vocab), "ids")
        lengths = code_lengths(global_counts(encoded, vocab))
        made = write(encoded.where("counts is null").select("doc_id", "ids"), lengths, dtype, path)
        if path is None:
            here.leave(2)
        return made
