"""Toxicity by non-negative positive-unlabelled learning (Kiryo et al., 2017).

A numpy logistic model is trained on confirmed toxic documents (P) and a sample of all documents without labels (U).
With class prior p the risk is p E_P[l(g)] + max(0, E_U[l(-g)] - p E_P[l(-g)]): the second term estimates the risk on
clean text and, where training drives it below zero, is pushed back up.

Features are what a document's distinct words are: the words, lower-cased and stripped of signs around them, and their
first 4, 5 and 6 letters, which stand for stems in languages that inflect. A word with other signs inside has those of
each run of letters too; runs that are long, or of scripts without spaces, have windows over their full length. Features
enter if P has them clearly more often than all documents do, by exact counts that Spark makes over P and over all
documents; P and U bound the examples that the steps see, not these counts. The sample and the counts don't depend on
partitions or the order of files.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import holding, materialize, release_memory, scratch
from .sampling import append, first_by_hash

#: Bounds of the training sample, in documents.
MOST_POSITIVE, MOST_UNLABELLED = 3000, 6000
MOST_FEATURES = 1024
#: Least number of toxic documents with a feature: an eightieth of P, within these bounds.
SUPPORT = (4, 12)
#: Least share of toxic documents among those with a feature, as estimated from P, all documents and the prior. It only
#: bounds what the steps see; the weights decide.
LEAST_PRECISION = 0.5
#: The prior is held within these bounds, as its logarithm of odds must be finite.
PRIORS = (1e-3, 1 - 1e-3)
PREFIXES = (4, 5, 6)
#: Letters of a run that is a feature as a whole; windows of longer runs, and of runs of scripts without spaces.
MOST_LETTERS = 64
WINDOWS, UNSPACED_WINDOWS = (4, 5, 6), (2, 3, 4)
#: Thai, Lao, Myanmar, Khmer; kana, Han ideographs.
UNSPACED = re.compile("[฀-໿က-႟ក-៿぀-ヿ㐀-鿿豈-﫿\U00020000-\U0003ffff]")
STEPS, RATE, DECAY = 300, 0.05, 1e-4
#: Words that a worker remembers.
SEEN_WORDS = 300_000
#: Signs that often stand around words.
SIGNS = ".,;:!?()\"'"
#: The code of a word that is too short to tell near copies by.
SHORT = 1 << 32


def features_of(word: str) -> list[str]:
    """Of a word as split at white space."""
    start, end = 0, len(word)
    while start < end and not word[start].isalpha():
        start += 1
    while end > start and not word[end - 1].isalpha():
        end -= 1
    core = word[start:end].lower()
    if len(core) < 2:
        return []
    out = _of_run(core[:MOST_LETTERS])
    runs = [core] if core.isalpha() else _runs(core)
    for run in runs:
        if len(runs) > 1 and len(run) > 1:
            out += _of_run(run[:MOST_LETTERS])
        sizes = () if run.isascii() or not UNSPACED.search(run) else UNSPACED_WINDOWS
        sizes = sizes or (WINDOWS if len(run) > MOST_LETTERS else ())
        out += ["~" + run[i : i + n] for n in sizes for i in range(len(run) - n + 1)]
    return out


def _of_run(run: str) -> list[str]:
    return ["=" + run, *("^" + run[:n] for n in PREFIXES if len(run) >= n)]


def _runs(core: str) -> list[str]:
    """Runs of letters; marks belong to the letter before."""
    out, inside = [], False
    for c in core:
        if c.isalpha() or (inside and not c.isascii() and unicodedata.category(c)[0] == "M"):
            if inside:
                out[-1].append(c)
            else:
                out.append([c])
            inside = True
        else:
            inside = False
    return ["".join(run) for run in out]


class Finder:
    """Finds the features of a vocabulary (feature -> number) in texts; remembers words that aren't long.

    keyed: whether copy_key will be asked for.
    """

    def __init__(self, vocabulary: dict[str, int], keyed: bool = True):
        self.vocabulary, self.keyed = vocabulary, keyed
        self.whole = {f[1:]: n for f, n in vocabulary.items() if f[0] == "="}
        self.starts = {f[1:]: n for f, n in vocabulary.items() if f[0] == "^"}
        #: the first letters of both, which most words don't begin with
        self.heads = {f[: PREFIXES[0]] for f in (*self.whole, *self.starts)}
        self.hits: dict[str, tuple[int, ...]] = {}
        #: word -> crc32 of a word that tells near copies apart, SHORT of any other
        self.codes: dict[str, int] = {}

    def _numbers(self, word: str) -> tuple[int, ...]:
        core = word.strip(SIGNS)
        if core.isalpha() and len(core) <= MOST_LETTERS and (core.isascii() or not UNSPACED.search(core)):
            # what features_of gives for one run of letters without windows
            if len(core) < 2:
                return ()
            core = core.lower()
            if core[: PREFIXES[0]] not in self.heads:
                return ()
            at = (self.whole.get(core), *(self.starts.get(core[:n]) for n in PREFIXES if len(core) >= n))
            return tuple(n for n in at if n is not None)
        return tuple(n for f in features_of(word) if (n := self.vocabulary.get(f)) is not None)

    def look(self, text: str | None) -> tuple[set[int], set[str]]:
        """The numbers of the text's features, and its words."""
        words = set(text.split()) if text else set()
        if len(self.codes) > SEEN_WORDS:
            self.clear()
        found: set[int] = set()
        codes, keyed = self.codes, self.keyed
        for word in words.difference(codes):
            numbers = self._numbers(word)
            if len(word) > MOST_LETTERS:
                found.update(numbers)
                continue
            codes[word] = _code(word) if keyed else SHORT
            if numbers:
                self.hits[word] = numbers
        found.update(*map(self.hits.__getitem__, self.hits.keys() & words))
        return found, words

    def copy_key(self, words: set[str]) -> bytes:
        """A key that most near copies share: of the words that `look` gave, the longer ones of least hash."""
        held = list(map(self.codes.get, words))
        if None in held:  # long words aren't remembered
            held = [_code(w) if c is None else c for w, c in zip(words, held, strict=True)]
        codes = np.array(held, dtype=np.int64)
        least = np.sort(np.partition(codes, 3)[:4] if len(codes) > 4 else codes)
        least = least[least < SHORT]
        key = least.tobytes() if len(least) else "\n".join(sorted(words)).encode("utf-8", "surrogatepass")
        return hashlib.blake2b(key, digest_size=8).digest()

    def clear(self) -> None:
        self.codes.clear()
        self.hits.clear()


def _code(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) if len(word) > 6 else SHORT


def _packed(numbers: set[int]) -> bytes:
    return np.array(sorted(numbers), dtype="<u4").tobytes()


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    _finder: Finder | None = field(default=None, repr=False, compare=False)

    def scores(self, texts) -> np.ndarray:
        """Scores from 0 to 1 of an iterable of texts (or None); looks at every word of the whole text."""
        if self._finder is None:
            self._finder = Finder({f: i for i, f in enumerate(self.weights)}, keyed=False)
        holding("toxicity", self._finder.clear)
        weights = list(self.weights.values())
        look = self._finder.look
        z = np.fromiter((self.bias + sum(weights[i] for i in sorted(look(t)[0])) for t in texts), dtype=np.float64)
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def risks(w, x_p, share_p, x_u, share_u, prior) -> tuple[float, float, np.ndarray, np.ndarray]:
    """Estimated risks of a linear model on toxic and on clean text, and their gradients, for the loss l(z) = s(-z).

    The rows of x_p and x_u end with a 1; a row stands for its share of the examples.
    """
    g_p, g_u = _sigmoid(x_p @ w), _sigmoid(x_u @ w)
    toxic = prior * float(share_p @ (1 - g_p))
    clean = float(share_u @ g_u) - prior * float(share_p @ g_p)
    slope = prior * ((share_p * g_p * (1 - g_p)) @ x_p)
    return toxic, clean, -slope, (share_u * g_u * (1 - g_u)) @ x_u - slope


def nnpu(x_p, share_p, x_u, share_u, prior: float) -> np.ndarray:
    """Weights (the bias last) that minimise the non-negative risk; full batches, Adam.

    Where the estimated risk on clean text is negative, steps go up on it alone.
    """
    w = np.zeros(x_p.shape[1], dtype=np.float32)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        _, clean, on_toxic, on_clean = risks(w, x_p, share_p, x_u, share_u, prior)
        grad = -on_clean if clean < 0 else on_toxic + on_clean
        grad = grad + DECAY * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w.astype(np.float64)


def matrix(rows: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows (packed numbers of features) as 0 and 1 with a last 1, and the share of each."""
    counts = sorted(Counter(rows).items())
    x = np.zeros((len(counts), size + 1), dtype=np.float32)
    x[:, -1] = 1
    for i, (packed, _) in enumerate(counts):
        x[i, np.frombuffer(packed, dtype="<u4")] = 1
    return x, np.array([n for _, n in counts], dtype=np.float32) / max(1, len(rows))


def chosen_features(often: dict[str, int], n_p: int, in_all: dict[str, int], n_all: int, prior: float) -> list[str]:
    """Features that P has often enough beside all documents, the most frequent ones first, by number."""
    precise = []
    for f, n in often.items():
        toxic = prior * n / n_p
        if toxic >= LEAST_PRECISION * max((in_all.get(f, 0) + 0.5) / (n_all + 1), toxic):
            precise.append(f)
    return sorted(precise, key=lambda f: (-often[f], f))[:MOST_FEATURES]


def least_support(n_p: int) -> int:
    return min(max(n_p // 80, SUPPORT[0]), SUPPORT[1])


def frequent(texts: DataFrame) -> tuple[dict[str, int], int]:
    """Features of enough documents, with their exact numbers of documents, and how many documents there are."""

    def run(batches):
        holding("toxicity")
        for batch in batches:
            counts: Counter[str] = Counter()
            for text in batch.column(0):
                counts.update({f for w in set((text.as_py() or "").split()) for f in features_of(w)})
            names = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([counts[f] for f in names], pa.int64())], names=["feature", "n"]
            )

    n = texts.count()
    rows = texts.select("text").mapInArrow(run, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    rows = rows.where(F.col("n") >= least_support(n)).orderBy("feature").toArrow()
    return dict(zip(rows["feature"].to_pylist(), rows["n"].to_pylist(), strict=True)), n


def count_in_all(texts: DataFrame, names: list[str]) -> tuple[dict[str, int], int]:
    """How many documents have each feature of ``names``, and how many there are; near copies count as one.

    Workers find the features; a shuffle of their numbers leaves one document of each group of near copies, and the
    driver gets one row per feature.
    """
    with scratch() as here:
        shared = here.share(texts.sparkSession, {f: i for i, f in enumerate(names)})
        size = len(names)

        def mark(batches):
            finder = Finder(shared.value)
            holding("toxicity", finder.clear)
            for batch in batches:
                keys, hits = [], []
                for text in batch.column(0):
                    found, words = finder.look(text.as_py())
                    keys.append(finder.copy_key(words))
                    hits.append(_packed(found))
                keys = np.frombuffer(b"".join(keys), dtype="<i8")
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(hits, pa.binary())], names=["key", "hits"])

        def count(batches):
            total, n = np.zeros(size, dtype=np.int64), 0
            for batch in batches:
                n += batch.num_rows
                total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype="<u4"), minlength=size)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1, *at.tolist()], pa.int64()), pa.array([n, *total[at].tolist()], pa.int64())], names=["feature", "n"]
            )

        one = texts.select("text").mapInArrow(mark, "key long, hits binary").groupBy("key").agg(F.min("hits").alias("hits"))
        rows = one.select("hits").mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    counts = {r["feature"]: r["n"] for r in rows}
    return {names[i]: n for i, n in counts.items() if i >= 0}, counts.get(-1, 0)


def _sample(texts: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, text, p, u): bounded samples by hash for P and U, one document of each group of near copies."""

    def run(batches):
        finder = Finder({})
        holding("toxicity", finder.clear)
        for batch in batches:
            keys = np.frombuffer(b"".join(finder.copy_key(finder.look(t.as_py())[1]) for t in batch.column(1)), dtype="<i8")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], names=["doc_id", "text", "p", "u", "key"])

    p = first_by_hash(known.where("toxic = 1").select("doc_id").distinct(), MOST_POSITIVE, 1)
    u = first_by_hash(texts.select("doc_id"), MOST_UNLABELLED, 2).distinct()
    ids = p.withColumn("p", F.lit(True)).join(u.withColumn("u", F.lit(True)), "doc_id", "full")  # a bounded number of ids
    rows = texts.join(F.broadcast(ids), "doc_id").select("doc_id", "text", F.coalesce("p", F.lit(False)).alias("p"), F.coalesce("u", F.lit(False)).alias("u"))
    rows = materialize(rows.mapInArrow(run, "doc_id long, text string, p boolean, u boolean, key long"), "toxicity-sample")
    first = lambda flag: F.col(flag) & (
        F.row_number().over(Window.partitionBy(flag, "key").orderBy("doc_id", F.xxhash64("text"))) == 1
    )
    rows = rows.withColumns({"first_p": first("p"), "first_u": first("u")}).where("first_p or first_u")
    return materialize(rows.select("doc_id", "text", F.col("first_p").alias("p"), F.col("first_u").alias("u")), "toxicity-examples")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """docs: doc_id, text; labels: doc_id, toxic, of the training rows only (null toxic is ignored).

    P and U are bounded samples by hash, one of each group of near copies, so that copies don't make a text's words look
    toxic. Which features are kept is decided by exact counts over P and over all documents; all counting and finding is
    done by workers, and the driver gets features, their counts and the examples as numbers. The prior is the labels'
    mean. Null and empty texts have no features; rows that repeat a doc_id are examples of their own unless they are
    near copies; a null doc_id is in no sample but is counted. Without toxic labels, without rows, or without a feature
    that passes, the model says the prior of every text.
    """
    known = labels.where("toxic is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
    prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    prior = min(max(prior, PRIORS[0]), PRIORS[1])
    flat = Model({}, float(np.log(prior / (1 - prior))))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with scratch() as here:
        sample = _sample(texts, known)
        often, n_p = frequent(sample.where("p"))
        if not often or sample.where("u").isEmpty():
            return flat
        in_all, n_all = count_in_all(texts, list(often))
        names = chosen_features(often, n_p, in_all, n_all, prior)
        if not names:
            return flat
        shared = here.share(docs.sparkSession, {f: i for i, f in enumerate(names)})

        def run(batches):
            finder = Finder(shared.value, keyed=False)
            holding("toxicity", finder.clear)
            for batch in batches:
                hits = [_packed(finder.look(t.as_py())[0]) for t in batch.column(0)]
                yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(hits, pa.binary())], names=["p", "u", "hits"])

        rows = sample.select("text", "p", "u").mapInArrow(run, "p boolean, u boolean, hits binary").toArrow()
    hits = np.array(rows["hits"].to_pylist(), dtype=object)
    x_p, share_p = matrix(hits[rows["p"].to_numpy()].tolist(), len(names))
    x_u, share_u = matrix(hits[rows["u"].to_numpy()].tolist(), len(names))
    w = nnpu(x_p, share_p, x_u, share_u, prior)
    del x_p, x_u, hits, rows
    release_memory()
    return Model({f: float(w[i]) for i, f in enumerate(names)}, float(w[-1]))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """docs with a column of scores; null and empty texts have the score of a text without any feature.

    Rows that repeat are scored each, and equal texts alike; no rows give no rows. A column of that name is refused.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def column(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(t.as_py() for t in texts), pa.float64())

    return append(docs, name, T.DoubleType(), pa.float64(), column)
