"""Quality by a sparse rule ensemble (RuleFit; Friedman and Popescu, 2008).

Shallow regression trees are boosted on statistics of labelled texts; every path of a tree is a conjunctive rule.
Lasso-penalised logistic regression gives most rules the weight 0, and the rest are compiled to a Spark column
expression over the statistics.
"""

from __future__ import annotations

import operator
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import holding
from .sampling import append, first_by_hash, spare_name

#: Bound of the training sample, in labelled documents.
MOST_LABELLED = 12_000
TREES, DEPTH, BINS, SHRINK, LEAST_LEAF = 24, 3, 32, 0.3, 15
LASSO, STEPS = 0.001, 400

STATISTICS = [
    "chars", "words", "word_bytes", "distinct_words", "top_word", "repeated_next", "upper", "digit", "space", "pipe",
    "symbol", "bang", "stop", "comma", "high", "lines", "line_chars", "distinct_lines", "short_words", "signed_words",
]
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "space": b" \t\n\r\x0b\x0c", "pipe": b"|",
    "symbol": b"#$%&*@~^=<>{}[]\\/_+", "bang": b"!?", "stop": b".;:", "comma": b",", "high": bytes(range(128, 256)),
}
_TABLE = {k: np.frombuffer(v, dtype=np.uint8) for k, v in _CLASSES.items()}


def statistics(text: str | None) -> list[float]:
    """STATISTICS of a whole text, all finite; those of a null or empty text are 0."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(STATISTICS)
    n = len(raw)
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    share = {k: float(counts[t].sum()) / n for k, t in _TABLE.items()}
    words = raw.split()
    k = max(1, len(words))
    often = Counter(words)
    lines = raw.split(b"\n")
    sizes = np.fromiter(map(len, often), dtype=np.int64, count=len(often))
    times = np.fromiter(often.values(), dtype=np.int64, count=len(often))
    return [
        float(np.log1p(n)),
        float(np.log1p(len(words))),
        float((sizes * times).sum()) / k,
        len(often) / k,
        float(times.max(initial=0)) / k,
        sum(map(operator.eq, words, words[1:])) / k,
        share["upper"], share["digit"], share["space"], share["pipe"] * n / k, share["symbol"], share["bang"] * n / k,
        share["stop"] * n / k, share["comma"] * n / k, share["high"],
        float(np.log1p(len(lines))),
        n / len(lines),
        len(set(lines)) / len(lines),
        float(times[sizes <= 3].sum()) / k,
        sum(c for w, c in often.items() if not w[-1:].isalnum() and w[-1] < 128 and w[-1:] not in b".,") / k,
    ]


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is above, threshold)."""

    terms: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), dtype=bool)
        for f, above, t in self.terms:
            out &= (x[:, f] > t) == above
        return out

    def column(self, stats: Column) -> Column:
        out = F.lit(True)
        for f, above, t in self.terms:
            value = stats[STATISTICS[f]]
            out = out & ((value > F.lit(t)) if above else (value <= F.lit(t)))
        return out


@dataclass
class Ensemble:
    rules: list[Rule]
    weights: list[float]
    bias: float

    def score(self, stats: Column) -> Column:
        z = F.lit(self.bias)
        for rule, w in zip(self.rules, self.weights, strict=True):
            z = z + F.when(rule.column(stats), F.lit(w)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = self.bias + sum(
            (w * r.holds(x) for r, w in zip(self.rules, self.weights, strict=True)), np.zeros(len(x))
        )
        return 1 / (1 + np.exp(-z))


def _cuts(x: np.ndarray) -> list[np.ndarray]:
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    return [np.unique(np.quantile(x[:, f], quantiles, method="lower")) for f in range(x.shape[1])]


def _grow(binned, cuts, target, rows, terms, depth, paths, out):
    """Split rows where the target's variance falls most; every node below the root adds its path to ``paths``."""
    best = (1e-9, None, None)
    if depth and len(rows) >= 2 * LEAST_LEAF:
        total, n = target[rows].sum(), len(rows)
        for f, cut in enumerate(cuts):
            if not len(cut):
                continue
            b = binned[rows, f]
            cs = np.cumsum(np.bincount(b, weights=target[rows], minlength=len(cut) + 1))[:-1]
            cn = np.cumsum(np.bincount(b, minlength=len(cut) + 1))[:-1]
            ok = (cn >= LEAST_LEAF) & (n - cn >= LEAST_LEAF)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(ok, cs**2 / cn + (total - cs) ** 2 / (n - cn) - total**2 / n, -1)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], f, k)
    if best[1] is None:
        out[rows] = target[rows].mean()
        return
    _, f, k = best
    above = binned[rows, f] > k
    for side, part in ((False, rows[~above]), (True, rows[above])):
        path = (*terms, (f, side, float(cuts[f][k])))
        paths.append(path)
        _grow(binned, cuts, target, part, path, depth - 1, paths, out)


def _tidy(path) -> Rule:
    """A path with the tightest bound per statistic and direction."""
    tight: dict[tuple[int, bool], float] = {}
    for f, above, t in path:
        key = (f, above)
        tight[key] = t if key not in tight else (max if above else min)(tight[key], t)
    return Rule(tuple((f, above, t) for (f, above), t in sorted(tight.items())))


def extract_rules(x: np.ndarray, y: np.ndarray, seed: int = 5) -> list[Rule]:
    rng = np.random.default_rng(seed)
    cuts = _cuts(x)
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    z = np.full(len(y), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    paths: list = []
    for _ in range(TREES):
        rows = np.flatnonzero(rng.random(len(y)) < 0.6)
        if len(rows) < 2 * LEAST_LEAF:
            rows = np.arange(len(y))
        p = 1 / (1 + np.exp(-z))
        grown: list = []
        fitted = np.zeros(len(y))
        _grow(binned, cuts, y - p, rows, (), DEPTH, grown, fitted)
        for path in grown:
            paths.append(path)
        leaves = [q for q in grown if not any(r[: len(q)] == q and len(r) > len(q) for r in grown)]
        for q in leaves:
            at = _tidy(q).holds(x)
            w = max(1e-3, (p[at] * (1 - p[at])).sum())
            z[at] += SHRINK * np.clip((y[at] - p[at]).sum() / w, -4, 4)
    seen: dict[bytes, Rule] = {}
    for path in paths:
        rule = _tidy(path)
        held = rule.holds(x)
        if LEAST_LEAF <= held.sum() <= len(y) - LEAST_LEAF:
            seen.setdefault(np.packbits(held).tobytes(), rule)
    return list(seen.values())


def lasso(r: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """L1-penalised logistic weights by accelerated proximal gradient steps; the bias is free."""
    n = len(y)
    mean = r.mean(axis=0)
    centred = (r - mean).astype(np.float32)
    rate = 4.0 / max(1e-6, float(np.linalg.norm(centred.T @ centred / n, 2)) + 1)
    w = np.zeros(r.shape[1])
    b = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    w_at, b_at, t = w.copy(), b, 1.0
    for _ in range(STEPS):
        g = 1 / (1 + np.exp(-(centred @ w_at + b_at))) - y
        step = w_at - rate * (centred.T @ g) / n
        new_w = np.sign(step) * np.maximum(np.abs(step) - rate * LASSO, 0)
        new_b = b_at - rate * g.mean()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w_at, b_at = new_w + (t - 1) / t_next * (new_w - w), new_b + (t - 1) / t_next * (new_b - b)
        w, b, t = new_w, new_b, t_next
    return w, float(b - mean @ w)


def train(x: np.ndarray, y: np.ndarray) -> Ensemble:
    """From statistics and labels 0 or 1. Without both labels, or without rules, the ensemble says the labels' mean."""
    mean = float(y.mean()) if len(y) else 0.5
    flat = Ensemble([], [], float(np.log((mean + 1e-3) / (1 - mean + 1e-3))))
    if len(np.unique(y)) < 2 or not (found := extract_rules(x, y)):
        return flat
    w, b = lasso(np.stack([r.holds(x) for r in found], axis=1).astype(np.float64), y)
    keep = np.flatnonzero(np.abs(w) > 1e-6)
    return Ensemble([found[i] for i in keep], [float(w[i]) for i in keep], b)


_STRUCT = T.StructType([T.StructField(s, T.DoubleType()) for s in STATISTICS])
_ARROW = pa.struct([(s, pa.float64()) for s in STATISTICS])


def with_statistics(docs: DataFrame, name: str) -> DataFrame:
    """docs with a struct of STATISTICS of the column text."""

    def column(texts: pa.Array) -> pa.Array:
        holding("statistics")
        rows = np.array([statistics(t.as_py()) for t in texts], dtype=np.float64).reshape(-1, len(STATISTICS))
        return pa.StructArray.from_arrays([pa.array(c) for c in rows.T.copy()], names=STATISTICS)

    return append(docs, name, _STRUCT, _ARROW, column)


def fit(docs: DataFrame, labels: DataFrame) -> Ensemble:
    """docs: doc_id, text; labels: doc_id, quality, of the training rows only (null quality is ignored).

    Only the statistics of at most MOST_LABELLED documents, chosen by hash, come to the driver. A doc_id with several
    labels has the largest; rows that repeat a doc_id are examples each; a null doc_id or a doc_id without a row is none.
    Null and empty texts are examples whose statistics are 0. Without rows, or with one label only, the ensemble says
    the labels' mean, which is a half where there is none.
    """
    known = labels.where("quality is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    ids = first_by_hash(known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality")), MOST_LABELLED, 3)
    chosen = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(ids), "doc_id")  # at most MOST_LABELLED ids
        .select("doc_id", "quality", "text")
    )
    rows = with_statistics(chosen, "stats").select("quality", "stats.*").toArrow()
    x = np.stack([rows[s].to_numpy() for s in STATISTICS], axis=1)
    y = rows["quality"].to_numpy().astype(np.float64)
    order = np.lexsort([*x.T, y])  # the same for any order of rows
    return train(x[order], y[order])


def score(docs: DataFrame, ensemble: Ensemble, name: str = "score") -> DataFrame:
    """docs with a column of scores; null and empty texts are scored by their statistics, which are 0.

    Rows that repeat are scored each, and equal texts alike; no rows give no rows. A column of that name is refused.
    """
    if name in docs.columns:
        raise ValueError(f"there is a column {name} already")
    held = spare_name(docs, "statistics")
    return with_statistics(docs, held).withColumn(name, ensemble.score(F.col(held))).drop(held)
