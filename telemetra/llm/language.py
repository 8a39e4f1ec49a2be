"""Language identification by words first, then shorter and shorter character n-grams.

Learning counts every word of every labelled text (Spark sums them per language). A word is known
if it makes up at least WORD_SHARE of a language's words, an n-gram likewise among the language's
n-grams of its length, so a model has at most 1/WORD_SHARE words and 1/GRAM_SHARE n-grams of a
length per language, whatever the corpus. A known word counts with its log frequency in each
language; an unseen word with the mean of its known n-grams of the greatest length that has any.

Words are runs of letters, lower-cased. A null text, or one without a letter, is ``und`` with
score 0, and so is every text if nothing was learned. Ties go to the language first in order.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.llm.common import stored

WORD_SHARE, GRAM_SHARE, LONGEST_GRAM = 2e-6, 2e-5, 4
#: Words a task counts before it hands them on, and unseen words whose scores it remembers.
TASK_WORDS, REMEMBERED = 100_000, 50_000
#: Words that count fully toward the score of a prediction.
SURE_WORDS = 8
_WORD = re.compile(r"[^\W\d_]+")
#: Number characters beside the decimal digits, which count as word characters too (those of the basic plane).
_NUMBERS = re.compile("[" + "".join(c for c in map(chr, range(0x10000)) if c.isalnum() and not c.isalpha() and not c.isdecimal()) + "]")


def letters(text: str | None) -> list[str]:
    """The runs of letters, lower-cased."""
    if not text:
        return []
    text = text.lower()
    return _WORD.findall(text if text.isascii() else _NUMBERS.sub(" ", text))


def grams(word: str, size: int) -> list[str]:
    """n-grams of the word between edge marks (single letters without them)."""
    if size == 1:
        return list(word)
    padded = f"<{word}>"
    return [padded[i:i + size] for i in range(len(padded) - size + 1)]


def _counts(name: str, counts: dict) -> pa.RecordBatch:
    keys = [(k[0], k[1], t, n) for k, c in counts.items() for t, n in c.items()]
    kind, lang, token, n = zip(*keys, strict=True)
    return pa.record_batch([pa.array(kind, pa.int32()), pa.array(lang), pa.array(token), pa.array(n, pa.int64())],
                           names=["size", "lang", "token", "n"])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[int, str], Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            counts.setdefault((0, lang.as_py()), Counter()).update(letters(text.as_py()))
            if sum(map(len, counts.values())) > TASK_WORDS:
                yield _counts("words", counts)
                counts = {}
    if any(counts.values()):
        yield _counts("words", counts)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[tuple[int, str], Counter] = {}
        for lang, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for size in range(1, LONGEST_GRAM + 1):
                own = counts.setdefault((size, lang), Counter())
                for g in grams(word, size):
                    own[g] += n
        if any(counts.values()):
            yield _counts("grams", counts)


def learn(documents: DataFrame, lang_col: str = "lang", text_col: str = "text") -> list[tuple[int, str, str, float]]:
    """(size: 0 for words, language, token, log frequency) of all known words and n-grams."""
    kind = "size int, lang string, token string, n long"
    labelled = documents.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    words = stored(labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInArrow(_count_words, kind)
                   .groupBy("size", "lang", "token").agg(F.sum("n").alias("n")), "words")
    shorter = (words.select("lang", "token", "n").mapInArrow(_count_grams, kind)
               .groupBy("size", "lang", "token").agg(F.sum("n").alias("n")))
    every = stored(words.unionByName(shorter), "tokens")
    totals = {(r[0], r[1]): r[2] for r in every.groupBy("size", "lang").agg(F.sum("n")).collect()}
    if not totals:
        return []
    total = F.element_at(F.create_map(*[F.lit(x) for (s, lang), n in totals.items() for x in (f"{s} {lang}", n)]),
                         F.concat_ws(" ", F.col("size").cast("string"), "lang"))
    share = F.when(F.col("size") == 0, WORD_SHARE).otherwise(GRAM_SHARE)
    known = every.filter(F.col("n") >= share * total)
    return [(r[0], r[1], r[2], float(np.log(r[3] / totals[r[0], r[1]]))) for r in known.collect()]


class Model:
    """A table of score rows (one value a language) of known words and of the unseen words met lately."""

    def __init__(self, learned: list[tuple[int, str, str, float]]):
        self.langs = sorted({x[1] for x in learned})
        at = {lang: i for i, lang in enumerate(self.langs)}
        floors = np.log([WORD_SHARE / 10] + [GRAM_SHARE / 10] * LONGEST_GRAM)
        self.place: list[dict[str, int]] = [{} for _ in range(LONGEST_GRAM + 1)]
        for size, _, token, _ in learned:
            self.place[size].setdefault(token, len(self.place[size]))
        self.rows = [np.full((len(p), len(self.langs)), f) for p, f in zip(self.place, floors, strict=True)]
        for size, lang, token, value in learned:
            self.rows[size][self.place[size][token], at[lang]] = value
        self.forget()

    def forget(self) -> None:
        """Only known words stay in the table."""
        self.at, self.used = dict(self.place[0]), len(self.place[0])
        self.table = np.zeros((self.used + REMEMBERED, len(self.langs)))
        self.table[:self.used] = self.rows[0]

    def unseen(self, words: list[str]) -> np.ndarray:
        """Rows of unseen words: each the mean of its known n-grams of the greatest length that has any."""
        out, todo = np.zeros((len(words), len(self.langs))), list(enumerate(words))
        for size in range(LONGEST_GRAM, 0, -1):
            known, found, places, left = self.place[size], [], [], []
            for i, word in todo:
                hits = [known[g] for g in grams(word, size) if g in known]
                if hits:
                    found.append((i, len(hits)))
                    places += hits
                else:
                    left.append((i, word))
            if found:
                where, n = np.array(found).T
                out[where] = np.add.reduceat(self.rows[size][places], np.cumsum(n) - n, axis=0) / n[:, None]
            todo = left
        return out

    def word(self, word: str) -> np.ndarray:
        return self.unseen([word])[0]

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        found = [letters(t) if self.langs else [] for t in texts]
        new = sorted({w for words in found for w in words if w not in self.at})
        if self.used + len(new) > len(self.table):
            self.forget()
            new = sorted({w for words in found for w in words if w not in self.at})
        if new:
            if self.used + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros((len(new), len(self.langs)))])
            self.table[self.used:self.used + len(new)] = self.unseen(new)
            self.at.update(zip(new, range(self.used, self.used + len(new)), strict=True))
            self.used += len(new)
        out = []
        for words in found:
            if not words:
                out.append(("und", 0.0))
                continue
            mean = self.table[list(map(self.at.__getitem__, words))].mean(0)
            p = np.exp((mean - mean.max()) * min(len(words), SURE_WORDS))
            best = int(np.argmax(mean))
            out.append((self.langs[best], float(p[best] / p.sum())))
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]


def predict(documents: DataFrame, learned: list[tuple[int, str, str, float]], id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """id, lang_pred, score of every text."""
    shared = documents.sparkSession.sparkContext.broadcast(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(shared.value)
        for batch in batches:
            got = []
            for lo in range(0, len(batch), 128):
                got += model.predict_all(batch.column(1).slice(lo, 128).to_pylist())
            yield pa.record_batch([batch.column(0), pa.array([g[0] for g in got], pa.string()),
                                   pa.array([g[1] for g in got], pa.float64())], names=["id", "lang_pred", "score"])

    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return (docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, lang_pred string, score double")
            .withColumnRenamed("id", id_col))


def certain(documents: DataFrame, learn_from: Column, least_score: float, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows whose text gets a language with ``least_score`` at least, with all their columns: each is kept or dropped where
    it is read. Only the text goes to Python and only the decision comes back; repeated or null ids need no rule."""
    learned = learn(documents.filter(learn_from), lang_col, text_col)
    shared = documents.sparkSession.sparkContext.broadcast(learned)

    def sure(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = Model(shared.value)
        for column in columns:
            got: list[bool] = []
            for lo in range(0, len(column), 128):
                got += [lang != "und" and score >= least_score for lang, score in model.predict_all(column.slice(lo, 128).to_pylist())]
            yield pa.array(got, pa.bool_())

    return documents.filter(F.arrow_udf(sure, "boolean")(F.col(text_col)))


def identify(documents: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """Learns from the rows where ``learn_from`` holds and predicts all rows."""
    return predict(documents, learn(documents.filter(learn_from), lang_col, text_col), id_col, text_col)
