"""Fast exact tokenising of whole texts: encode each distinct space-separated piece once, then join the ids.

BPE tokenizers that split at spaces before merging give each piece the same ids wherever it stands, so a text's ids
are its pieces' ids one after another. A text is cut in front of its spaces and newlines. Where the tokenizer keeps
white space, a cut is such a boundary only at a single space or newline between two other characters; a text with any
other white space at a cut is encoded whole by the tokenizer itself.
"""

from __future__ import annotations

import os
import string
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import holding

#: Pieces kept per Python worker, so memory stays bounded for any vocabulary. A full table takes no more pieces; it is
#: emptied once it misses a quarter of what a batch asks for. CACHE_WORDS is for tokenizers that drop white space, whose
#: use writes files and holds little else.
CACHE_PIECES, CACHE_WORDS = 300_000, 900_000
#: Longer pieces are seldom met again and are encoded each time.
CACHED_CHARS, CACHED_WORD_CHARS = 14, 40
#: Pieces joined in one text for the tokenizers library.
GROUP = 400
#: Signs behind a word that a tokenizer which drops white space also keeps apart from letters, in one run.
SIGNS = string.punctuation


def latin(word: str) -> bool:
    """Whether a word is of letters below U+0100, which are the same to all versions of Unicode."""
    return word.isalpha() and (word.isascii() or max(word) < "\u0100")


class PieceEncoder:
    """Ids of texts as packed little-endian unsigned integers of ``dtype``.

    encode_whole(texts, dtype) and encode_words(words, dtype), for words with their space in front if ``spaced``, give
    packed ids. In the table a word's key is the word without that space, or with its newline in front; a text's first
    word has a space in front.
    """

    def __init__(self, encode_whole, encode_words, spaced: bool, vocab_size: int, odd_char: str | None = None, folds=False):
        self.encode_whole, self.encode_words, self.spaced = encode_whole, encode_words, spaced
        self.folds = folds  # whether the tokenizer lower-cases texts
        self.odd_char = odd_char  # texts with this character are encoded whole
        self.dtype = np.dtype("<u2" if vocab_size <= 65536 else "<u4")
        self.kept: dict[str, bytes] = {}

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Packed ids of each text; null and empty texts have none."""
        column = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        if not len(column):
            return []
        kept = self.kept
        # all texts' words as numbers in one list of distinct ones; number 0 is no word
        filled = pc.fill_null(column, "")
        line = pc.replace_substring(filled, "\n", " \n" if self.spaced else " ")
        cut = pc.split_pattern(line, " ")
        bounds = cut.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        coded = cut.flatten().dictionary_encode()
        met = [None, *coded.dictionary.to_pylist()]
        codes = coded.indices.to_numpy() + 1
        if self.spaced:
            firsts: dict[str, int] = {}
            heads = [" " + met[k] for k in codes[bounds[:-1]].tolist()]
            codes[bounds[:-1]] = [firsts.setdefault(w, len(met) + len(firsts)) for w in heads]
            met += firsts
        codes[bounds[:-1][pc.equal(filled, "").to_numpy(zero_copy_only=False)]] = 0
        whole: dict[int, bytes] = {}

        def look() -> tuple[np.ndarray, list, set]:
            """The numbers in use, what is known of their words, and the words that aren't."""
            used = np.bincount(codes, minlength=len(met)) > 0
            used[0] = False
            used = np.flatnonzero(used)
            words = [met[k] for k in used.tolist()]
            known = list(map(kept.get, words))
            return used, known, {w for w, ids in zip(words, known, strict=True) if ids is None}

        used, known, new = look()
        if self.spaced:
            # a first or last character that is white space, besides the key's own mark in front
            odd = {w for w in new if not w or w[-1].isspace() or w[w[0] in " \n"].isspace()}
            if self.odd_char:
                odd.update(w for w in new if self.odd_char in w)
            if odd:
                is_odd = np.fromiter((w in odd for w in met), dtype=bool, count=len(met))
                of_text = np.repeat(np.arange(len(column)), np.diff(bounds))
                at = np.unique(of_text[is_odd[codes]])
                found = self.encode_whole(column.take(pa.array(at)).to_pylist(), self.dtype)
                whole = dict(zip(at.tolist(), found, strict=True))
                codes[np.isin(of_text, at)] = 0
                used, known, new = look()
        words, parts = self._parted(new)
        firsts = [w for w in words if self.spaced and w[0] == " "]
        kept.update(zip(firsts, self.encode_whole([w[1:] for w in firsts], self.dtype), strict=True))
        words = [w for w in words if not self.spaced or w[0] != " "]
        led = [w if w[0] == "\n" else " " + w for w in words] if self.spaced else words
        kept.update(zip(words, self.encode_words(led, self.dtype), strict=True))
        kept.update((w, kept[core] + kept[signs]) for w, (core, signs) in parts.items())
        # the words' ids one after another, and each text's taken from them
        known = [kept[met[k]] if ids is None else ids for k, ids in zip(used.tolist(), known, strict=True)]
        size, start = np.zeros(len(met), dtype=np.int64), np.zeros(len(met), dtype=np.int64)
        size[used] = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // self.dtype.itemsize
        start[used] = np.cumsum(size[used]) - size[used]
        each = size[codes]
        ends = np.concatenate([[0], np.cumsum(each)])
        place = np.repeat(start[codes] - ends[:-1], each)
        place += np.arange(len(place))
        packed = np.frombuffer(b"".join(known), dtype=self.dtype)[place].tobytes()
        stops = (ends[bounds] * self.dtype.itemsize).tolist()
        out = [packed[a:b] for a, b in zip(stops, stops[1:], strict=False)]
        for i, ids in whole.items():
            out[i] = ids
        most, longest = (CACHE_PIECES, CACHED_CHARS) if self.spaced else (CACHE_WORDS, CACHED_WORD_CHARS)
        full = len(kept) > most
        for w in new.union(firsts, words):
            if full or len(w) > longest:
                del kept[w]
        if full and 4 * len(new) > len(codes):
            kept.clear()
        return out

    def _parted(self, new: set[str]) -> tuple[list[str], dict[str, tuple[str, str]]]:
        """Words to encode, and by word of ``new`` what else it is made of: letters, and the signs behind them.

        These are separate words to a tokenizer that drops white space, which may lower-case as well.
        """
        words, parts = set(), {}
        if self.spaced:
            return list(new), parts
        for w in new:
            core = w.rstrip(SIGNS)
            if core.isalpha() and (core.isascii() or normalize("NFC", core).lower().isalpha()):
                signs = w[len(core) :]
                if self.folds and (core.isascii() or latin(core)):
                    core = core.lower()
                if core != w:
                    parts[w] = core, signs
                    words.add(core)
                    words.add(signs)
                    continue
            words.add(w)
        return list(words.difference(self.kept)), parts

    def encode_column(self, column, chunk: int = 500):
        """Packed ids of an Arrow column of texts, a few hundred texts at a time."""
        for i in range(0, len(column), chunk):
            yield from self.encode(column.slice(i, chunk))

    def ids(self, packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, dtype=self.dtype)


def whole(tokenizer):
    def encode(texts: list[str], dtype) -> list[bytes]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=dtype).tobytes() for e in found]

    return encode


def _joined(tokenizer, words: list[str], dtype, join, ends, skip: int) -> list[bytes]:
    """Encode words several hundred a text; ends gives the id position after each word."""
    out: list[bytes] = []
    size = dtype.itemsize
    groups = [words[i : i + GROUP] for i in range(0, len(words), GROUP)]
    for k in range(0, len(groups), 8):
        texts = [join(g) for g in groups[k : k + 8]]
        for g, e in zip(groups[k : k + 8], tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype=dtype)
            packed, start = ids.tobytes(), 0
            for stop in (ends(g, ids) * size).tolist():
                out.append(packed[start:stop])
                start = stop + skip * size
    return out


def joined_by_length(tokenizer, id_bytes: np.ndarray):
    """For tokenizers whose ids stand for bytes one to one: the words' byte counts tell their ids apart."""

    def ends(group: list[str], ids: np.ndarray):
        return np.searchsorted(np.cumsum(id_bytes[ids]), np.cumsum([len(w.encode()) for w in group])) + 1

    return lambda words, dtype: _joined(tokenizer, words, dtype, "".join, ends, 0)


def joined_by_mark(tokenizer, mark: str = "\x01"):
    """For tokenizers that drop white space: a mark of one id of its own stands between words.

    Words of small letters below U+0100 go to a copy of the tokenizer without normaliser and with no cut but at white space, if
    that gives a sample the same ids.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    (mark_id,) = tokenizer.encode(mark, add_special_tokens=False).ids
    plain = Tokenizer.from_str(tokenizer.to_str())
    plain.normalizer = None
    plain.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    sample = f"the {mark} quick {mark} brownish foxes jumped zqxjk {mark} größer {mark} a"
    if plain.encode(sample, add_special_tokens=False).ids != tokenizer.encode(sample, add_special_tokens=False).ids:
        plain = tokenizer

    def ends(group: list[str], ids: np.ndarray):
        return np.append(np.flatnonzero(ids == mark_id), len(ids))

    def encode(words: list[str], dtype) -> list[bytes]:
        if any(mark in w for w in words):
            return whole(tokenizer)(words, dtype)
        out: list[bytes] = [b""] * len(words)
        sides: tuple[list[int], list[int]] = ([], [])
        for i, w in enumerate(words):
            sides[w.islower() and latin(w)].append(i)
        for t, side in zip((tokenizer, plain), sides, strict=True):
            found = _joined(t, [words[i] for i in side], dtype, f" {mark} ".join, ends, 1)
            for i, ids in zip(side, found, strict=True):
                out[i] = ids
        return out

    return encode


def _byte_level_lengths(tokenizer) -> np.ndarray:
    """Bytes that each id of a byte-level vocabulary stands for: its entry has one character a byte."""
    out = np.zeros(tokenizer.get_vocab_size(), dtype=np.int64)
    for entry, i in tokenizer.get_vocab().items():
        out[i] = len(entry)
    return out


_encoders: dict[tuple, PieceEncoder] = {}


def tokenizer_encoder(path: str, keeps_space: bool) -> PieceEncoder:
    """One encoder per worker process and tokenizer file, so that its cache serves all tasks of the worker.

    Strings of special tokens inside texts are ordinary text, and no special tokens are added.
    """
    holding("tokens", _encoders.clear)
    if (path, keeps_space) not in _encoders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        words = joined_by_length(t, _byte_level_lengths(t)) if keeps_space else joined_by_mark(t)
        folds = t.normalizer is not None and t.normalizer.normalize_str("Az") == "az"
        made = PieceEncoder(whole(t), words, keeps_space, t.get_vocab_size(), folds=folds)
        _encoders[path, keeps_space] = made
    return _encoders[path, keeps_space]
