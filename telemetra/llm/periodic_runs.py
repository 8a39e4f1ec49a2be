"""Runs of repeated words by a dictionary of basic factors.

A run is a stretch of consecutive words whose words ``period`` apart are identical, with the smallest
such period, that no neighbouring word extends; it counts if it has LEAST_LENGTH words and
LEAST_POWER periods at least.

The dictionary names the factors (stretches) of 1, 2, 4, ... words: two factors of a text have one name
if they are equal, and a factor's name is the pair of its halves' names. For every factor the next occurrence
of its name within twice its length is a step; occurrences a step apart form an arithmetic progression, which
proposes the step as a period. Neighbouring factors with one step lie in one progression of stretches, so
the proposal extends from the first of them to the last one's next occurrence.

Steps longer than the factor can be broken by shorter ones inside the root; the next length proposes
them again. A step of at most the factor's length is complete: if a run of period q has 4 q words, a factor
of q to 2 q - 1 words that starts in it (and whose next occurrence ends in it) occurs next exactly q words on, since two
occurrences closer by would give the stretch a period that divides q. So each run is proposed by all of
its factors of that length and no other, and lengths above duplicate it (they are dropped).

Only factors that occur twice in their text stay in the dictionary, so ordinary text ends after a few
lengths. Texts are worked on in whole, a slice of about a megabyte (or one longer text) at a time; memory is
a few arrays of the slice's words. No shuffle.

Null and empty texts have no words and no runs. Equal rows have equal results; every row gets its own,
null ids included; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.llm import flat

LEAST_LENGTH, LEAST_POWER = 6, 4


def steps(pos: np.ndarray, name: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts and steps, by start, of the factors whose next occurrence is at most ``most`` on; whether each factor's name occurs twice)."""
    order = np.argsort(name, kind="stable")
    p, same = pos[order], np.diff(name[order]) == 0
    twice = np.empty(len(pos), bool)
    twice[order] = np.append(same, False) | np.append(False, same)
    d = np.diff(p)
    near = np.flatnonzero(same & (d <= most))
    near = near[np.argsort(p[near], kind="stable")]
    return p[near], d[near], twice


def find(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start and period. ``words``: hash of every word; ``first``: index of
    each text's first word, then the total."""
    n = len(words)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    end = first[1:][text]
    # names of single words: equal words of different texts differ
    _, name = np.unique(flat.mix(words + flat.mix(text.astype(flat.U64))), return_inverse=True)
    pos, length, found = np.arange(n), 1, []
    while len(pos):
        at, step, twice = steps(pos, name, 2 * length)
        whole = (step <= length) & (2 * step > length)  # the steps that are complete and new at this length
        at, step = at[whole], step[whole]
        if len(at):
            new = np.flatnonzero(np.append(True, (np.diff(at) != 1) | (np.diff(step) != 0)))
            a, d = at[new], step[new]
            b = at[np.append(new[1:], len(at)) - 1]
            size = b - a + length + d
            ok = size >= np.maximum(LEAST_LENGTH, LEAST_POWER * d)
            found.append((a[ok], size[ok], d[ok]))
        pos, name = pos[twice], name[twice]
        named = np.full(n, -1)
        named[pos] = name
        double = pos + 2 * length <= end[pos]
        pos = pos[double]
        left, right = named[pos], named[pos + length]
        both = right >= 0
        pos, key = pos[both], left[both] * n + right[both]
        _, name = np.unique(key, return_inverse=True)
        length *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    a, size, d = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((d, a))
    return a[order], size[order], d[order]


def echoed(first: np.ndarray, echo: list[int | None]) -> np.ndarray:
    """Index of the word that stands at every place: with an echo g, the text of n words repeats
    1 + (n - a) // (3 + g % 8) words from place a = g % n to its end."""
    out = np.arange(int(first[-1]))
    for x, y, g in zip(first[:-1].tolist(), first[1:].tolist(), echo, strict=True):
        if g is not None and y > x:
            a = g % (y - x)
            p = 1 + (y - x - a) // (3 + g % 8)
            out[x + a:y] = x + a + np.arange(y - x - a) % p
    return out


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = flat.texts(batch.column(1))
        echo = batch.column(2).to_pylist()
        for i, j, own, off in flat.slices(data, offsets):
            starts, ends, first = flat.words(own, off)
            hashes = flat.span_hashes(flat.prefix_sums(own), starts, ends)
            place = echoed(first, echo[i:j])
            start, size, period = find(hashes[place], first)
            change = np.zeros(len(place) + 1, np.int64)
            np.add.at(change, start + period, 1)
            np.add.at(change, start + size, -1)
            kept = np.cumsum(change[:-1]) == 0
            number = np.concatenate([[0], np.cumsum(kept)])
            place = place[kept]
            text = np.searchsorted(first, start, "right") - 1
            values = pa.StructArray.from_arrays([pa.array(start - first[text]), pa.array(size), pa.array(period)], ["start", "length", "period"])
            bounds = np.searchsorted(text, np.arange(j - i + 1)).astype(np.int32)
            yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(np.diff(first).astype(np.int64)), pa.ListArray.from_arrays(pa.array(bounds), values),
                                   flat.joined(own, starts[place], ends[place], number[first]).cast(pa.string())],
                                  names=["id", "n_words", "runs", "collapsed"])


def runs(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", echo: Column | None = None) -> DataFrame:
    """id, n_words, runs (start, length and period in words, by start and period) and collapsed: the text
    with the first period of every run only, one space between words. ``echo`` plants repeats (see ``echoed``; null: none)."""
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                            (F.lit(None) if echo is None else echo).cast("long").alias("echo"))
    return docs.mapInArrow(_runs, f"id {docs.schema['id'].dataType.simpleString()}, n_words long, "
                                  "runs array<struct<start:long,length:long,period:long>>, collapsed string").withColumnRenamed("id", id_col)
