"""Word shingle sets of whole texts as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

from .common import holding

#: Words whose hash a worker keeps; the table is emptied when full.
KEPT_WORDS = 200_000
_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        self[word] = found
        return found


_words = _Words()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX[0]
    return h ^ (h >> np.uint64(29))


def shingle_sets(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """Of each text the distinct shingles of ``size`` words, sorted by hash.

    A-Z are lower-cased; words are what stands between U+0020 and U+0009 to U+000D. Fewer words make one shingle of all
    of them; no words, none. The hash of a shingle depends on its words, their order and number, and is the same
    everywhere.
    """
    if len(_words) > KEPT_WORDS:
        _words.clear()
    words = [t.lower().split() if t else [] for t in texts]
    counts = [len(w) for w in words]
    h = np.fromiter((x for w in words for x in map(_words.__getitem__, w)), dtype=np.uint64, count=sum(counts))
    # the shingle that begins at each word; those that reach into the next text are left out below
    mixed = np.full(max(0, len(h) - size + 1), size, dtype=np.uint64)
    for k in range(size):
        mixed = _mix((mixed * _MIX[1]) ^ h[k : len(h) - size + 1 + k])
    out, at = [], 0
    for n in counts:
        if n >= size:
            out.append(np.unique(mixed[at : at + n - size + 1].view(np.int64)))
        elif n:
            one = np.full(1, n, dtype=np.uint64)
            for k in range(n):
                one = _mix((one * _MIX[1]) ^ h[at + k : at + k + 1])
            out.append(one.view(np.int64))
        else:
            out.append(np.zeros(0, dtype=np.int64))
        at += n
    return out


def column_sets(column, size: int, chunk: int = 200):
    """shingle_sets of an Arrow column of binary texts."""
    holding("shingles", _words.clear)
    for i in range(0, len(column), chunk):
        yield from shingle_sets(column.slice(i, chunk).to_pylist(), size)
