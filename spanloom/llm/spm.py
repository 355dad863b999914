"""SentencePiece models on the tokenizers library: parse the model file, rebuild its parts, encode and decode.

Read from the protobuf: the pieces with scores and types, the model type, byte fallback, and the normaliser's flags
and character map. Rebuilt from them: the normaliser, the metaspace marker, unigram scores (or for BPE models the merges
that the scores imply) and byte fallback. Pieces that no text may become (control, unknown and unused ones and those of
bytes) keep their ids under names with a space, which no normalised text holds. User symbols keep what they are while
the text around them is normalised. Models that put the marker behind words, that don't mark spaces, or BPE models with
unused pieces are refused.
"""

from __future__ import annotations

import os
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import holding
from .tokens import PieceEncoder, joined_by_length, whole

MARK = "▁"
# Fixed values of the model file's format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(raw: bytes):
    """(number, value) of a protobuf message: int for varints, bytes for all others."""
    at = 0

    def varint():
        nonlocal at
        out = shift = 0
        while True:
            byte = raw[at]
            at += 1
            out |= (byte & 127) << shift
            if byte < 128:
                return out
            shift += 7

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}[kind] if kind != 2 else varint()
        yield key >> 3, raw[at : at + size]
        at += size


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escapes: bool = True
    suffix: bool = False

    @property
    def unknown(self) -> int | None:
        return next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), None)

    @property
    def symbols(self) -> list[str]:
        """User symbols, longest first."""
        return sorted((p for p, _, kind in self.pieces if kind == USER), key=lambda p: (-len(p), p))


def parse(raw: bytes) -> Model:
    # field numbers of the public sentencepiece_model.proto
    out = Model()
    for number, value in _fields(raw):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    (score,) = struct.unpack("<f", v)
                elif n == 3:
                    kind = v
            out.pieces.append((piece, score, kind))
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    out.kind = v
                elif n == 24:
                    out.suffix = bool(v)
                elif n == 35:
                    out.byte_fallback = bool(v)
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    out.charsmap = v
                elif n == 3:
                    out.dummy_prefix = bool(v)
                elif n == 4:
                    out.squeeze = bool(v)
                elif n == 5:
                    out.escapes = bool(v)
    if out.suffix or not out.escapes:
        raise ValueError("only models that mark spaces, in front of words, are supported")
    if out.kind == BPE and any(kind == UNUSED for _, _, kind in out.pieces):
        raise ValueError("BPE models with unused pieces aren't supported")
    if out.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    return out


def merges_of(model: Model) -> list[tuple[str, str]]:
    """The merges that a BPE model's scores imply, best first."""
    ids = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER, UNUSED)}
    found = []
    for piece, i in ids.items():
        for k in range(1, len(piece)):
            left, right = piece[:k], piece[k:]
            if left in ids and right in ids:
                found.append((-model.pieces[i][1], i, ids[left], ids[right], left, right))
    return [(f[4], f[5]) for f in sorted(found)]


def _scores(model: Model) -> list[tuple[str, float]]:
    """Names and scores of a unigram model. A user symbol's score is that of as many best pieces as it has bytes."""
    normal = [score for _, score, kind in model.pieces if kind == NORMAL]
    best = max(normal, default=0.0)
    out = []
    for i, (piece, score, kind) in enumerate(model.pieces):
        if kind == NORMAL:
            out.append((piece, score))
        elif kind == USER:
            out.append((piece.replace(" ", MARK), len(piece.encode()) * best - 0.1))
        else:
            out.append((f" {i}", best))  # can't match, and doesn't change the least score
    return out


def normaliser(model: Model, prefix: bool = True):
    """The normaliser of a model without user symbols as a tokenizers.Normalizer."""
    from tokenizers import Regex, normalizers

    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Replace(Regex(r"\A +| +\z"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix and prefix:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    if model.squeeze:  # a marker that ends the text goes, also one of the text's own
        steps.append(normalizers.Replace(Regex(MARK + r"+\z"), ""))
    return normalizers.Sequence(steps)


def symbol_normaliser(model: Model):
    """A function that normalises texts of a model with user symbols, which pass through it as they are."""
    import re

    from tokenizers import normalizers

    found = re.compile("(" + "|".join(map(re.escape, model.symbols)) + ")")
    mapped = normalizers.Precompiled(model.charsmap).normalize_str if model.charsmap else str

    def run(text: str) -> str:
        text = "".join(part if k % 2 else mapped(part) for k, part in enumerate(found.split(text)) if part)
        if model.squeeze:
            text = re.sub(" {2,}", " ", text.strip(" "))
        if text and model.dummy_prefix:
            text = " " + text
        text = text.replace(" ", MARK)
        return text.rstrip(MARK) if model.squeeze else text

    return run


def backend(model: Model, prefix: bool):
    """A tokenizers.Tokenizer for the model; prefix False leaves out the marker in front of the text.

    With user symbols it takes texts that `symbol_normaliser` has normalised.
    """
    from tokenizers import AddedToken, Tokenizer, decoders, models

    unknown = model.unknown
    if model.kind == UNIGRAM:
        # unknown characters come back as they are, and `SentencePieces` puts their bytes' ids there
        core = models.Unigram(_scores(model), unknown, False)
    else:
        core = models.BPE(
            {p: i for i, (p, _, _) in enumerate(model.pieces)},
            merges_of(model),
            unk_token=None if unknown is None else model.pieces[unknown][0],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    made = Tokenizer(core)
    if not model.symbols:
        made.normalizer = normaliser(model, prefix)
    elif model.kind == BPE:
        made.add_tokens([AddedToken(p, normalized=False) for p in model.symbols])
    made.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
    return made


def with_bytes(tokenizer, model: Model):
    """An encoder of whole texts that replaces unknown characters by the ids of their bytes, as `tokens.whole` for others."""
    ids_of = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(model.pieces) if kind == BYTE}
    unknown = model.unknown

    def encode(texts: list[str], dtype) -> list[bytes]:
        out = []
        for e in tokenizer.encode_batch(texts, add_special_tokens=False):
            ids = e.ids
            if unknown in ids:
                ids = [b for i, token in zip(ids, e.tokens, strict=True) for b in ([i] if i != unknown else map(ids_of.__getitem__, token.encode()))]
            out.append(np.array(ids, dtype=dtype).tobytes())
        return out

    return encode


def byte_table(model: Model) -> list[bytes]:
    """What each id stands for in a decoded text; control pieces stand for nothing."""
    out = []
    for piece, _, kind in model.pieces:
        if kind == BYTE:
            out.append(bytes([int(piece[3:5], 16)]))
        elif kind == CONTROL:
            out.append(b"")
        elif kind == UNKNOWN:
            out.append(" ⁇ ".encode())
        else:
            out.append(piece.replace(MARK, " ").encode())
    return out


def cuts_are_safe(model: Model) -> bool:
    """Whether the ids of a text are those of its pieces cut before spaces and newlines.

    So it is where no piece of the vocabulary reaches over such a place, bytes stand for what has no piece, and the
    normaliser changes nothing.
    """
    over = any(
        kind in (NORMAL, USER, UNUSED) and any(b in (MARK, "\n") and a != b for a, b in zip(p, p[1:], strict=False))
        for p, _, kind in model.pieces
    )
    user = any(kind == USER for _, _, kind in model.pieces)
    whole_bytes = model.kind == BPE and model.byte_fallback
    return whole_bytes and not model.charsmap and not model.squeeze and not over and not user


class SentencePieces:
    """Encode and decode with a model file. threads is the number of threads of the tokenizers library per worker."""

    def __init__(self, path: str, threads: int = 2):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        with open(path, "rb") as f:
            self.model = parse(f.read())
        self.tokenizer = backend(self.model, prefix=True)
        self.table = byte_table(self.model)
        size = len(self.model.pieces)
        bytes_apart = self.model.kind == UNIGRAM and self.model.byte_fallback
        self.whole = with_bytes(self.tokenizer, self.model) if bytes_apart else whole(self.tokenizer)
        self.normalise = symbol_normaliser(self.model) if self.model.symbols else None
        if cuts_are_safe(self.model):
            lengths = np.array([len(b) for b in self.table], dtype=np.int64)
            words = joined_by_length(backend(self.model, prefix=False), lengths)
            self.encoder = PieceEncoder(whole(self.tokenizer), words, True, size, odd_char=MARK)
        else:
            self.encoder = None
            self.dtype = np.dtype("<u2" if size <= 65536 else "<u4")

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if self.encoder:
            return [self.encoder.ids(b) for b in self.encoder.encode(texts)]
        ready = [self.normalise(t) if self.normalise and t else t or "" for t in texts]
        return [np.frombuffer(b, dtype=self.dtype) for b in self.whole(ready, self.dtype)]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.table.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


_workers: dict[tuple[str, int], SentencePieces] = {}
_libraries: dict = {}


def _worker(path: str, threads: int) -> SentencePieces:
    holding("sentencepiece", _workers.clear)
    if (path, threads) not in _workers:
        _workers[path, threads] = SentencePieces(path, threads)
    return _workers[path, threads]


def encode_documents(docs: DataFrame, path: str, threads: int = 2, chunk: int = 500) -> DataFrame:
    """doc_id, ids (array<int>) of every row of docs (doc_id, text); null and empty texts have no ids."""

    def run(batches):
        sp = _worker(path, threads)
        for batch in batches:
            for i in range(0, len(batch), chunk):
                part = batch.slice(i, chunk)
                ids = [a.astype(np.int32) for a in sp.encode(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def verify_documents(docs: DataFrame, path: str, threads: int = 2, chunk: int = 200) -> DataFrame:
    """Encode every document, decode the ids, and hold both against the sentencepiece library.

    Returns doc_id, n_ids, ids_crc32 (ids as little-endian uint32), same_ids (the library gives the same ids) and
    restored (the decoded text is the text, null as empty; it can only be where the model's normaliser changes
    nothing). No id leaves the worker, so nothing is shuffled. Every row gives one row.
    """

    def run(batches):
        import sentencepiece

        sp = _worker(path, threads)
        if path not in _libraries:
            _libraries[path] = sentencepiece.SentencePieceProcessor(model_file=path)
        library = _libraries[path]
        for batch in batches:
            for i in range(0, len(batch), chunk):
                part = batch.slice(i, chunk)
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = sp.encode(texts)
                same = [
                    len(a) == len(b) and bool((a == np.array(b, dtype=a.dtype)).all())
                    for a, b in zip(ids, library.encode(texts, num_threads=threads), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(a) for a in ids], pa.int64()),
                        pa.array([zlib.crc32(a.astype("<u4").tobytes()) for a in ids], pa.int64()),
                        pa.array(same),
                        pa.array([sp.decode(a) == t for a, t in zip(ids, texts, strict=True)]),
                    ],
                    names=["doc_id", "n_ids", "ids_crc32", "same_ids", "restored"],
                )

    schema = "doc_id long, n_ids long, ids_crc32 long, same_ids boolean, restored boolean"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
