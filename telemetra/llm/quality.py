"""Quality as a generalised additive model with pairwise interactions.

Features describe the form of a text (lengths, shares of symbols, upper case and digits,
repetition of words, lines and neighbours, ...). Each is cut into bins at quantiles. Cyclic boosting visits
the features in turn; each visit fits a shallow tree (a few cuts over the bins) to the current
gradient and adds a small part of it to the feature's lookup table. The pairs that reduce what is left
most get tables over coarser bins in the same way. Scoring adds up table entries.

Learning uses at most SAMPLE labelled rows, those with the least hash of the id. Null texts are
empty and get a score from their features. Without labels all scores are 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE, BINS, PAIR_BINS, PAIRS = 30_000, 32, 8, 10
ROUNDS, PAIR_ROUNDS, RATE, LEAVES, LEAST_ROWS = 120, 60, 0.15, 3, 10
FEATURES = ("log words", "log bytes", "mean word length", "symbol share", "upper share", "digit share", "space share",
            "non-ascii share", "distinct words", "repeated neighbours", "longest run", "line count", "repeated lines",
            "bars", "sentence ends", "top word share", "one-byte words", "symbol words")
_SYMBOLS = b"#$%&*+/<=>@[]^_{|}~\\"


def features(text: str | None) -> list[float]:
    data = (text or "").encode()
    words = data.split()
    n, size = max(1, len(words)), max(1, len(data))
    upper = len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = len(data) - len(data.translate(None, b"0123456789"))
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    plain = len(data.translate(None, bytes(range(128, 256))))
    lines = data.split(b"\n")
    counts: dict[bytes, int] = {}
    same = run = longest = 0
    last = None
    for w in words:
        counts[w] = counts.get(w, 0) + 1
        if w == last:
            same += 1
            run += 1
            longest = max(longest, run)
        else:
            run, last = 0, w
    ends = sum(data.count(c) for c in (b".", b"?", b"!"))
    return [np.log1p(len(words)), np.log1p(len(data)), sum(map(len, words)) / n, symbols / size, upper / size, digits / size,
            1 - sum(map(len, words)) / size, 1 - plain / size, len(counts) / n, same / n, np.log1p(longest), np.log1p(len(lines)),
            1 - len(set(lines)) / len(lines), data.count(b"|") / n, ends / n, max(counts.values(), default=0) / n,
            sum(len(w) == 1 for w in words) / n, sum(w[-1] in _SYMBOLS for w in words) / n]


def edges_of(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, c, "right") for e, c in zip(edges, x.T, strict=True)], 1)


def shallow_tree(grad: np.ndarray, hess: np.ndarray, count: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Values per bin of a tree over ordered bins: up to ``leaves`` ranges, each with its Newton step."""
    ranges = [(0, len(grad))]

    def gain(lo, hi):
        return grad[lo:hi].sum() ** 2 / (hess[lo:hi].sum() + 1)
    while len(ranges) < leaves:
        best = (1e-9, None, None)
        for lo, hi in ranges:
            for cut in range(lo + 1, hi):
                if min(count[lo:cut].sum(), count[cut:hi].sum()) >= LEAST_ROWS:
                    best = max(best, (gain(lo, cut) + gain(cut, hi) - gain(lo, hi), (lo, hi), cut), key=lambda b: b[0])
        if best[1] is None:
            break
        ranges.remove(best[1])
        ranges += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(grad))
    for lo, hi in ranges:
        out[lo:hi] = grad[lo:hi].sum() / (hess[lo:hi].sum() + 1)
    return out


class Additive:
    """Lookup tables over bins of single features and of pairs of features."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> Additive:
        self.edges, self.coarse = edges_of(x, BINS), edges_of(x, PAIR_BINS)
        b, c = binned(x, self.edges), binned(x, self.coarse)
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base, self.pairs = float(np.log(p / (1 - p))), []
        score = np.full(len(y), self.base)
        for _ in range(ROUNDS):
            for f, table in enumerate(self.tables):
                step = RATE * self.step(score, y, b[:, f], len(table))
                table += step
                score += step[b[:, f]]
        left = []
        for f, g in combinations(range(x.shape[1]), 2):
            grad, hess, _ = self.sums(score, y, self.cell(c, f, g), (len(self.coarse[f]) + 1) * (len(self.coarse[g]) + 1))
            left.append(((grad ** 2 / (hess + 1)).sum(), f, g))
        for _, f, g in sorted(left, reverse=True)[:PAIRS]:
            self.pairs.append((f, g, np.zeros((len(self.coarse[f]) + 1) * (len(self.coarse[g]) + 1))))
        for _ in range(PAIR_ROUNDS):
            for f, g, table in self.pairs:
                at = self.cell(c, f, g)
                wide = len(self.coarse[g]) + 1
                grad, hess, count = (s.reshape(-1, wide) for s in self.sums(score, y, at, len(table)))
                first = shallow_tree(grad.sum(1), hess.sum(1), count.sum(1), 2)  # cut by f, then by g within each side
                step = np.zeros_like(grad)
                for v in np.unique(first):
                    side = first == v
                    step[side] = shallow_tree(grad[side].sum(0), hess[side].sum(0), count[side].sum(0), 2)
                table += RATE * step.ravel()
                score += RATE * step.ravel()[at]
        return self

    def cell(self, c: np.ndarray, f: int, g: int) -> np.ndarray:
        return c[:, f] * (len(self.coarse[g]) + 1) + c[:, g]

    @staticmethod
    def sums(score, y, at, n):
        p = 1 / (1 + np.exp(-score))
        return np.bincount(at, y - p, n), np.bincount(at, p * (1 - p), n), np.bincount(at, minlength=n)

    def step(self, score, y, at, n):
        return shallow_tree(*self.sums(score, y, at, n))

    def predict(self, x: np.ndarray) -> np.ndarray:
        b, c = binned(x, self.edges), binned(x, self.coarse)
        score = np.full(len(x), self.base)
        for f, table in enumerate(self.tables):
            score += table[b[:, f]]
        for f, g, table in self.pairs:
            score += table[self.cell(c, f, g)]
        return 1 / (1 + np.exp(-score))


def fit(documents: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text") -> Additive | None:
    """The model of a bounded sample of the labelled documents."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).dropna().groupBy("id").agg(F.max("y").alias("y"))
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    chosen = (docs.select("id").join(known, "id").distinct().orderBy(F.xxhash64("id"), "id").limit(SAMPLE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array([features(t.as_py()) for t in batch.column(0)], pa.list_(pa.float64())), batch.column(1)],
                                  names=["x", "y"])

    rows = docs.join(F.broadcast(chosen), "id").select("text", "y").mapInArrow(run, "x array<double>, y int").collect()
    if not rows:
        return None
    return Additive().fit(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float))


def score(documents: DataFrame, model: Additive | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score of every text."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(1)]).reshape(len(batch), len(FEATURES))
            s = own.predict(x) if own is not None else np.full(len(batch), 0.5)
            yield pa.record_batch([batch.column(0), pa.array(s)], names=["id", "score"])

    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return (docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, score double").withColumnRenamed("id", id_col))


def classify(documents: DataFrame, labels: DataFrame, learn_from: Column, label_col: str = "quality", id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Learns from rows where ``learn_from`` (over the id) holds and scores all documents."""
    return score(documents, fit(documents.filter(learn_from), labels, label_col, id_col, text_col), id_col, text_col)
