"""Toxicity by weak supervision.

1. Voters. Words and word beginnings that stand out in labelled toxic texts become a lexicon. A text and its copies with small
   changes count once; document frequencies are summed by Spark. A term is taken if it stands out by more than chance
   over all terms that were looked at, or if a good share of the toxic texts hold it. The OWN best terms are
   voters of their own, all terms feed the pattern voters; they vote 1, 0 or abstain.
2. Label model. A generative model of the votes given an unseen label, fitted by EM: each voter
   has a rate of voting 1, 0 and abstaining under either label. Correlated voters would count twice, so
   pairwise correlations that the label does not explain shrink their weights. A known label
   takes part in learning as one more voter with errors; the posteriors then come from the votes.
3. A linear classifier (logistic, in numpy) is trained on the posterior labels of a bounded sample
   of learning rows and scores every text.

The lexicon is learned from at most LABELLED labelled rows; the label model and the classifier from these and at most SAMPLE
rows without a label, in each case those with the least hash of the id. The share of label 1 comes from
all labelled learning rows. Null texts are empty, a repeated row counts once for the lexicon, very long texts are scored whole.
Without documents there are no rows; without any labels, or any label 1, all scores are 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.llm.common import run_hashes, split_words, stored

LABELLED, SAMPLE, OWN = 20_000, 10_000, 150
#: Lengths of word beginnings, and how many terms the choice of the lexicon looks at.
STEMS, CANDIDATES = range(4, 8), 20_000
#: A term's least number of toxic texts and ratio of rates, and the chance that any term at all gets in by luck.
LEAST_TEXTS, LEAST_LIFT, BY_LUCK = 4, 8.0, 0.05
#: Share of the toxic texts and log-likelihood gain that do without that test (few labels).
LEAST_SHARE, LEAST_GAIN = 0.03, 20.0
TASK_WORDS = 200_000
_WORD = re.compile(r"[^\W\d_]+")
_NO_UPPER = dict.fromkeys(range(65, 91))
_SECOND = re.compile(r"\b(?:you|your|you're|tu|vous|du|dich|ihr|eres)\b")
#: Voters beside the lexicon.
PATTERNS = ("any lexicon word", "two lexicon words", "three kinds", "dense lexicon", "shouting", "exclamations", "aimed at a person")


def terms(words: set[str]) -> set[str]:
    """Words and their beginnings, these marked by a star."""
    return words | {w[:k] + "*" for w in words for k in STEMS if len(w) > k}


def _document_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic texts with it, other texts with it)."""
    counts = (Counter(), Counter())

    def rows():
        words = list(counts[0].keys() | counts[1].keys())
        return pa.record_batch([pa.array(words, pa.string()), pa.array([counts[1][w] for w in words], pa.int64()),
                                pa.array([counts[0][w] for w in words], pa.int64())], names=["word", "n1", "n0"])
    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            counts[toxic][""] += 1  # all texts
            counts[toxic].update(terms(set(_WORD.findall((text.as_py() or "").lower()))))
            if len(counts[0]) + len(counts[1]) > TASK_WORDS:
                yield rows()
                counts = (Counter(), Counter())
    yield rows()


def lexicon(labelled: DataFrame) -> list[str]:
    """The words whose share of toxic texts stands out, best first. ``labelled``: y (0/1), text."""
    words = stored(labelled.select(F.col("y").cast("int").alias("y"), "text")
                   .mapInArrow(_document_words, "word string, n1 long, n0 long")
                   .groupBy("word").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")), "words")
    total = words.filter("word = ''").first()
    if total is None or not total["n1"]:
        return []
    n1, n0, share = F.col("n1"), F.col("n0"), total["n1"] / (total["n1"] + total["n0"])
    rate1, rate0 = n1 / total["n1"], (n0 + 0.5) / (total["n0"] + 1)
    gain = n1 * F.log(rate1 / rate0)
    # exp(-surprise) bounds the chance of so many toxic texts among the term's texts
    surprise = n1 * F.log(n1 / ((n1 + n0) * share)) + F.when(n0 > 0, n0 * F.log(n0 / ((n1 + n0) * (1 - share)))).otherwise(0.0)
    common = (n1 >= LEAST_SHARE * total["n1"]) & (gain >= min(LEAST_GAIN, 0.1 * total["n1"]))
    best = (words.filter((F.col("word") != "") & (n1 >= LEAST_TEXTS) & (rate1 >= LEAST_LIFT * rate0)
                         & (common | (surprise >= math.log(words.count() / BY_LUCK))))
            .select("word", gain.alias("gain"))
            .orderBy(F.desc("gain"), F.desc(F.length("word")), "word").limit(CANDIDATES))
    chosen: list[str] = []
    stems, begun = set(), set()  # chosen beginnings; all beginnings of what is chosen
    for term in (r[0] for r in best.collect()):  # of a word and its beginnings only the best stays
        word = term.rstrip("*")
        if not any(word[:k] in stems for k in (*STEMS, len(word))) and not (term[-1] == "*" and word in begun):
            chosen.append(term)
            stems |= {word} if term[-1] == "*" else set()
            begun |= {word[:k] for k in STEMS} | {word}
    return chosen


def features(text: str | None, words: dict[str, int]) -> np.ndarray:
    """Counts of the OWN first lexicon terms, then numbers over all terms that the pattern voters and the classifier share.
    ``words``: term -> place in the lexicon."""
    text = text or ""
    found = _WORD.findall(text.lower())
    own = min(OWN, len(words))
    out = np.zeros(own + 6)
    hit: Counter[int] = Counter()
    for w, k in Counter(found).items():
        i = words.get(w)
        if i is None:
            i = next((words[t] for t in (w[:size] + "*" for size in STEMS if len(w) > size) if t in words), None)
        if i is not None:
            hit[i] += k
    for i, k in hit.items():
        if i < own:
            out[i] = k
    hits, n = hit.total(), max(1, len(found))
    upper = len(text) - len(text.translate(_NO_UPPER))
    out[own:] = (hits, len(hit), 100 * hits / n, upper / max(1, len(text)),
                 100 * text.count("!") / max(1, len(text)), bool(hits) and len(_SECOND.findall(text.lower())) / n)
    return out


def votes(x: np.ndarray) -> np.ndarray:
    """Votes of all voters on rows of features: 1 toxic, 0 not, -1 abstains."""
    n_words = x.shape[1] - 6
    hits, kinds, dense, upper, bang, aimed = x[:, n_words:].T
    lex = np.where(x[:, :n_words] > 0, 1, -1)
    none = hits == 0
    more = [np.where(none, 0, 1), np.where(hits >= 2, 1, np.where(none, 0, -1)), np.where(kinds >= 3, 1, -1),
            np.where(dense >= 1, 1, np.where(dense < 0.4, 0, -1)), np.where(upper > 0.5, 1, -1), np.where(bang > 3, 1, -1),
            np.where(aimed > 0.02, 1, -1)]
    return np.concatenate([lex, np.stack(more, 1)], 1).astype(np.int8)


class LabelModel:
    """Rates of each vote (abstain, 0, 1) under either label, with weights for correlated voters."""

    def fit(self, v: np.ndarray, known: np.ndarray, prior: float | None = None, rounds: int = 15) -> LabelModel:
        """``known``: 0/1, or -1 for rows without a label; ``prior``: share of label 1 (default: among ``known``)."""
        seen = known >= 0
        self.prior = np.clip(known[seen].mean() if prior is None else prior, 0.005, 0.5)
        q = np.where(seen, np.where(known == 1, 0.8, self.prior / 2), self.prior)
        cast = [(v == k).astype(np.float32) for k in (-1, 0, 1)]
        self.weight = np.ones(v.shape[1])
        for _ in range(rounds):
            self.rates = np.stack([(np.stack([p.astype(np.float32) @ c for c in cast], 1) + 1) / (p.sum() + 3) for p in (1 - q, q)])
            self.weight = self.shrink(v, q)
            q = self.posterior(v, self.label_odds(known, q))
        return self

    @staticmethod
    def label_odds(known: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Log odds that a known label adds, from its rates under the labels believed so far."""
        seen = known >= 0
        p1 = ((q * (known == 1)).sum() + 1) / ((q * seen).sum() + 2)
        p0 = (((1 - q) * (known == 1)).sum() + 1) / (((1 - q) * seen).sum() + 2)
        return np.where(known == 1, np.log(p1 / p0), np.where(known == 0, np.log((1 - p1) / (1 - p0)), 0.0))

    def shrink(self, v: np.ndarray, q: np.ndarray) -> np.ndarray:
        """1 over 1 plus each voter's squared correlations with the others that the label leaves unexplained."""
        y = (v == 1) - (v == 0).astype(np.float64)
        rest = y - np.outer(q, (y * q[:, None]).sum(0) / max(q.sum(), 1e-9)) \
            - np.outer(1 - q, (y * (1 - q)[:, None]).sum(0) / max((1 - q).sum(), 1e-9))
        sd = rest.std(0) + 1e-6
        corr = (rest.T @ rest) / len(v) / np.outer(sd, sd)
        np.fill_diagonal(corr, 0)
        self.correlations = corr
        return 1 / (1 + (corr ** 2).sum(1))

    def posterior(self, v: np.ndarray, more: np.ndarray | float = 0.0) -> np.ndarray:
        log = np.log(self.rates[1] / self.rates[0]) * self.weight[:, None]
        score = np.log(self.prior / (1 - self.prior)) + log[np.arange(v.shape[1]), v.astype(int) + 1].sum(1) + more
        return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


def scaled(x: np.ndarray) -> np.ndarray:
    return np.log1p(x)


def logistic(x: np.ndarray, target: np.ndarray, rounds: int = 60, ridge: float = 1.0) -> np.ndarray:
    """Newton steps of ridge logistic regression on soft labels; the last weight is the intercept."""
    x = np.concatenate([scaled(x), np.ones((len(x), 1))], 1)
    w = np.zeros(x.shape[1])
    pull = np.full(len(w), ridge)
    pull[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - target) + pull * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _copies(text: Column) -> Column:
    """A key that a text shares with its copies, also with most that differ in a few words: its three least hashes of five words."""
    hashes = F.transform(split_words(text, r"[\x20\x09-\x0D]+"), lambda w: F.xxhash64(w))
    return F.when(F.size(hashes) < 7, F.array(F.xxhash64(text))).otherwise(
        F.slice(F.array_sort(F.array_distinct(run_hashes(hashes, 5))), 1, 3))


def fit(docs: DataFrame, known: DataFrame) -> tuple[list[str], list[float]]:
    """(lexicon, classifier weights). ``docs``: id, text of learning rows; ``known``: id, y (0/1)."""
    ids = docs.select("id").distinct()
    labelled = ids.join(known, "id")
    prior = labelled.agg(F.avg("y")).first()[0]
    if not prior:
        return [], []
    first = (F.xxhash64("id"), "id")
    chosen = stored(labelled.orderBy(*first).limit(LABELLED).select("id", F.col("y").cast("int").alias("y"))
                    .union(ids.join(known, "id", "left_anti").orderBy(*first).limit(SAMPLE).select("id", F.lit(-1))), "sample")
    rows = stored(docs.join(F.broadcast(chosen), "id").select("text", "y"), "texts")  # at most LABELLED + SAMPLE ids
    words = lexicon(rows.filter("y >= 0").groupBy(_copies(F.col("text")).alias("same"), "y").agg(F.min("text").alias("text")))
    if not words:
        return [], []
    at = {w: i for i, w in enumerate(words)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array([features(t.as_py(), at).tobytes() for t in batch.column(0)], pa.binary()),
                                   batch.column(1)], names=["x", "y"])

    got = rows.mapInArrow(run, "x binary, y int").toArrow()
    x = np.stack([np.frombuffer(r.as_py()) for r in got["x"]])
    v = votes(x)
    return words, logistic(x, LabelModel().fit(v, got["y"].to_numpy(), prior).posterior(v)).tolist()


def score(documents: DataFrame, model: tuple[list[str], list[float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score of every text."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights = shared.value
        at, w = {x: i for i, x in enumerate(words)}, np.array(weights)
        for batch in batches:
            s = np.zeros(len(batch))
            if words:
                x = np.array([features(t.as_py(), at) for t in batch.column(1)]).reshape(len(batch), -1)
                s = 1 / (1 + np.exp(-np.clip(scaled(x) @ w[:-1] + w[-1], -30, 30)))
            yield pa.record_batch([batch.column(0), pa.array(s)], names=["id", "score"])

    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return (docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, score double").withColumnRenamed("id", id_col))


def classify(documents: DataFrame, labels: DataFrame, learn_from: Column, label_col: str = "toxic", id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Learns from rows where ``learn_from`` (over the id) holds and scores all documents."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).dropna().groupBy("id").agg(F.max("y").alias("y"))
    docs = documents.filter(learn_from).select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return score(documents, fit(docs, known), id_col, text_col)
