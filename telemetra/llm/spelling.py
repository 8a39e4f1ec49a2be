"""Spelling variants: words one edit apart, found in k-d trees over letter counts.

Words are maximal runs of the Latin letters, A-Z lower-cased. One inserted, deleted or replaced letter
moves a word's vector of letter counts by an L1 distance of at most two: an insertion raises one count, a
replacement raises one and lowers another. So per pair of lengths (equal, or one apart) a word's near words
lie in a small box of the longer length's tree; boxes further off are pruned, and the letter order of what is left is
verified. Nothing is lost and nothing is found twice: an insertion is found from the shorter word, a
replacement from the word that gives up the smaller letter.

1. Spark counts the words of all texts (partial sums in tasks).
2. The words of a length are dealt to leaves of that length's tree. Where it needs more than one leaf, its splits are fitted on a bounded
   sample (about SAMPLE words by hash); every word is indexed. A word goes to its own leaf as a point, and as a query
   to the leaves of its own and the next length whose box it can reach.
3. A task holds the points of one leaf in a tree of their own with tight boxes and searches it for all its queries.
4. Sums per word give its number of near words and the most frequent one; its form is that word if it occurs ``ratio`` times as
   often. Following forms doubles the distance each round; counts grow by ``ratio`` a step, which bounds the rounds.

Null and empty texts have no words; repeated rows count again; a null id has no planted typing errors;
an empty table gives an empty result. Very long words are letters like others: leaves shrink with the length.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.llm.common import stored

#: Distinct words a task counts before it hands them on; letters of the points of a leaf; words in a box of a task's tree.
TASK_WORDS, LEAF_LETTERS, BOX = 200_000, 100_000, 16
#: Words, about, that fit the splits.
SAMPLE = 50_000
#: The letters, in code point order.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))


def _counter(least: int, typo: int | None):
    runs = re.compile(f"[a-zÀ-ÿ]{{{least},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for lo in range(0, len(batch), 64):
                part = batch.slice(lo, 64)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if not text:
                        continue
                    own = Counter(runs.findall(text.encode().lower().decode()))  # bytes.lower: A-Z only
                    if typo and doc_id is not None:
                        head = zlib.crc32(f"{doc_id}:".encode())
                        for word in list(own):
                            h = zlib.crc32(word.encode(), head)
                            if h % typo == 0:
                                at, n = h % len(word), own.pop(word)
                                if len(word) > least:
                                    counts[word[:at] + word[at + 1:]] += n
                    counts.update(own)
                if len(counts) > TASK_WORDS:
                    yield pa.record_batch([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
                    counts = Counter()
        if counts:
            yield pa.record_batch([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
    return run


def vocabulary(documents: DataFrame, id_col: str, text_col: str, least_letters: int, least: int, typo: int | None) -> DataFrame:
    """word, n of the words with enough letters that occur often enough."""
    docs = documents.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    return (docs.mapInArrow(_counter(least_letters, typo), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= least))


def codes(words: list[str], length: int) -> np.ndarray:
    """(words x length) letters, numbered in code point order."""
    flat = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)
    return np.where(flat < 0xC0, flat - np.uint8(97), flat - np.uint8(0xC0 - 26))


def vectors(letters: np.ndarray) -> np.ndarray:
    """(words x letters) counts."""
    m, length = letters.shape
    at = np.arange(m)[:, None] * len(LETTERS) + letters
    kind = np.int16 if length < 30_000 else np.int32
    return np.bincount(at.ravel(), minlength=m * len(LETTERS)).reshape(m, len(LETTERS)).astype(kind)


def dense(v: np.ndarray, used: np.ndarray) -> np.ndarray:
    """The columns of some letters, and one for all others."""
    return np.column_stack([v[:, used], v.sum(1) - v[:, used].sum(1)]).astype(v.dtype)


def best_split(v: np.ndarray) -> tuple[int, int] | None:
    """(letter, threshold): counts up to the threshold go left; the most even split (ties: the smallest letter)."""
    middle = np.sort(v, 0)[(len(v) - 1) // 2]
    best, out = 0, None
    for low in (middle, middle - 1):
        left = (v <= low).sum(0)
        even = np.minimum(left, len(v) - left)
        at = int(np.argmax(even))
        if even[at] > best:
            best, out = int(even[at]), (at, int(low[at]))
    return out


def grow(v: np.ndarray, most: float):
    """Nested (letter, threshold, left, right); None is a leaf."""
    cut = best_split(v) if len(v) > most else None
    if cut is None:
        return None
    left = v[:, cut[0]] <= cut[1]
    return (*cut, grow(v[left], most), grow(v[~left], most))


def route(tree, v: np.ndarray, raised: int, lowered: int) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, rows of ``v`` that reach its box by raising and lowering so many counts), leaves numbered as in a heap."""
    def walk(node, number: int, rows: np.ndarray, up: np.ndarray, down: np.ndarray, low: dict, high: dict):
        if not len(rows):
            return
        if node is None:
            yield number, rows
            return
        letter, t, left, right = node
        have = v[rows, letter].astype(np.int64)
        more = down + np.maximum(0, have - t) - np.maximum(0, have - high.get(letter, 1 << 40))
        ok = more <= lowered
        yield from walk(left, 2 * number, rows[ok], up[ok], more[ok], low, {**high, letter: min(t, high.get(letter, 1 << 40))})
        more = up + np.maximum(0, t + 1 - have) - np.maximum(0, low.get(letter, 0) - have)
        ok = more <= raised
        yield from walk(right, 2 * number + 1, rows[ok], more[ok], down[ok], {**low, letter: max(t + 1, low.get(letter, 0))}, high)
    none = np.zeros(len(v), np.int64)
    yield from walk(tree, 1, np.arange(len(v)), none, none, {}, {})


def _deal(trees: dict):
    """Words to leaves: kind 0 is a point, 1 a query of equal length, 2 of one letter less."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = np.array(batch.column(0).to_pylist(), object), np.asarray(batch.column(1))
            sizes = np.array([len(w) for w in words])
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                step = max(1, 2_000_000 // size)
                for lo in range(0, len(at), step):
                    own = at[lo:lo + step]
                    v = vectors(codes(words[own].tolist(), size))
                    for kind, length, raised, lowered in ((0, size, 0, 0), (1, size, 1, 1), (2, size + 1, 1, 0)):
                        for leaf, rows in route(trees.get(length), v, raised, lowered):
                            yield pa.record_batch([pa.array(np.full(len(rows), length, np.int32)), pa.array(np.full(len(rows), leaf, np.int64)),
                                                   pa.array(np.full(len(rows), kind, np.int8)), pa.array(words[own[rows]].tolist()),
                                                   pa.array(counts[own[rows]])], names=["length", "leaf", "kind", "word", "n"])
    return run


class Tree:
    """A k-d tree over the points of a leaf, with the tight box of every node."""

    def __init__(self, v: np.ndarray):
        self.v = v
        self.root = self.node(np.arange(len(v)))

    def node(self, rows: np.ndarray):
        own = self.v[rows]
        box = own.min(0), own.max(0)
        cut = best_split(own) if len(rows) > BOX else None
        if cut is None:
            return box, rows, None, None
        left = own[:, cut[0]] <= cut[1]
        return box, None, self.node(rows[left]), self.node(rows[~left])

    def search(self, q: np.ndarray, raised: int, lowered: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(queries, points) in reach of each other, box by box."""
        todo = [(self.root, np.arange(len(q)))]
        while todo:
            ((low, high), points, left, right), rows = todo.pop()
            own = q[rows]
            ok = (np.maximum(low - own, 0).sum(1) <= raised) & (np.maximum(own - high, 0).sum(1) <= lowered)
            rows = rows[ok]
            if not len(rows):
                continue
            if points is None:
                todo += [(left, rows), (right, rows)]
                continue
            step = max(1, 4_000_000 // (len(points) * q.shape[1]))
            for lo in range(0, len(rows), step):
                some = rows[lo:lo + step]
                change = self.v[points][None] - q[some][:, None]
                i, j = np.nonzero((np.maximum(change, 0).sum(2) <= raised) & (np.maximum(-change, 0).sum(2) <= lowered))
                yield some[i], points[j]


def replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether two words of a length differ in one place, where the first has the smaller letter."""
    other = a != b
    at = other.argmax(1)
    row = np.arange(len(a))
    return (other.sum(1) == 1) & (a[row, at] < b[row, at])


def inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the second word is the first and one letter more."""
    head = np.cumprod(a == b[:, :-1], 1).sum(1)
    tail = np.cumprod((a == b[:, 1:])[:, ::-1], 1).sum(1)
    return head + tail >= a.shape[1]


_NEAR = pa.schema([("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def near_in_leaf(table: pa.Table) -> pa.Table:
    """Of the points and queries of one leaf that have near words there: how many, and the most frequent; every point once at least."""
    kind = np.asarray(table["kind"].combine_chunks())
    words, counts = np.array(table["word"].to_pylist(), object), np.asarray(table["n"].combine_chunks())
    points = np.flatnonzero(kind == 0)
    if not len(points):
        return _NEAR.empty_table()
    length = len(words[points[0]])
    own = codes(words[points].tolist(), length)
    full = vectors(own)
    used = np.flatnonzero(full.any(0))
    tree = Tree(dense(full, used))
    pairs = [(points, points)]  # a word with itself: dropped below
    for which, size, lowered, near in ((1, length, 1, replaced), (2, length - 1, 0, inserted)):
        at = np.flatnonzero(kind == which)
        if not len(at):
            continue
        asked = codes(words[at].tolist(), size)
        for q, p in tree.search(dense(vectors(asked), used), 1, lowered):
            ok = near(asked[q], own[p])
            pairs.append((at[q[ok]], points[p[ok]]))
    a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
    # each pair counts for both words; a word is named by its point or, if that lies elsewhere, its query row
    _, name = np.unique(words.astype(str), return_inverse=True)
    named = np.empty(name.max() + 1, np.int64)
    named[name] = np.arange(len(name))
    a, b = named[name[a]], named[name[b]]
    a, b = np.concatenate([a, b[a != b]]), np.concatenate([b, a[a != b]])
    other = a != b
    order = np.lexsort((name[b], np.where(other, -counts[b], 1), a))
    a, b, other = a[order], b[order], other[order]
    new = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
    best, some = b[new], other[new]
    return pa.table({"word": pa.array(words[a[new]].tolist()), "n": pa.array(counts[a[new]]), "n_near": pa.array(np.add.reduceat(other.astype(np.int64), new)),
                     "best_n": pa.array(counts[best], mask=~some), "best": pa.array([w if s else None for w, s in zip(words[best], some, strict=True)], pa.string())},
                    schema=_NEAR)


def fitted(words: DataFrame) -> dict:
    """Splits of the lengths that need more than one leaf, from a sample of their words."""
    length = F.length("word").alias("length")
    sizes = {r[0]: r[1] for r in words.groupBy(length).count().filter(F.col("count") * F.col("length") > LEAF_LETTERS).collect()}
    total = sum(sizes.values())
    if not total:
        return {}
    one_in = -(-total // SAMPLE)
    sample = words.filter(length.isin(list(sizes)) & (F.pmod(F.xxhash64("word"), F.lit(one_in)) == 0)).select("word").collect()
    by_size: dict[int, list[str]] = {}
    for r in sample:
        by_size.setdefault(len(r[0]), []).append(r[0])
    return {n: grow(vectors(codes(w, n)), LEAF_LETTERS / n * len(w) / sizes[n]) for n, w in by_size.items()}


def near_words(words: DataFrame) -> DataFrame:
    """word, n, n_near, best_n, best (the near word that occurs most often; ties: smallest) of every row of ``words`` (word, n)."""
    dealt = words.mapInArrow(_deal(fitted(words)), "length int, leaf long, kind byte, word string, n long")
    found = dealt.groupBy("length", "leaf").applyInArrow(near_in_leaf, "word string, n long, n_near long, best_n long, best string")
    return found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.max("best_n").alias("best_n"),
                                     F.min_by("best", F.when(F.col("best_n").isNotNull(), F.struct(-F.col("best_n"), "best"))).alias("best"))


def variants(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = 6, least: int = 5, ratio: int = 5,
             typo: int | None = None) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word with ``least_letters`` letters that occurs ``least`` times.
    ``typo`` plants errors: where it divides the crc32 of "<id>:<word>", the word loses a letter."""
    words = stored(vocabulary(documents, id_col, text_col, least_letters, least, typo), "words")
    near = near_words(words)
    far = F.col("best_n") >= ratio * F.col("n")
    near = stored(near.select("word", "n", "n_near", F.when(far, F.col("best")).alias("form"), F.when(far, F.col("best_n")).alias("form_n")), "near")
    steps = near.filter("form is not null").select("word", F.col("form").alias("root"))
    most = words.agg(F.max("n")).first()[0] or 1
    for _ in range(math.ceil(math.log2(1 + math.log(most, ratio)))):
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        steps = stored(steps.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root")), "steps")
    return near.join(steps, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
