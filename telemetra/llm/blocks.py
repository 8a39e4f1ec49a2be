"""Removal of repeated word sequences by fixed-block anchors.

A word goes if a window of ``length`` consecutive words that covers it also starts earlier: in a document with a smaller
id, or in the same document before. Windows are judged on the input; they lie within one document.

1. Index and probes. Every document is cut into reference blocks of ``length`` / 2 words that do not overlap; these are the index.
   Every rolling window of a block's size is a probe. A window of ``length`` words holds a whole reference block of whatever
   document it lies in, so wherever it occurs elsewhere a probe there hits that block.
   Documents form packs (by a hash of the id). A pack sends its distinct probes once, as sorted numbers dealt by their leading
   bits, with marks for those that are reference blocks and those that occur in it twice. Probes are numbers of just enough bits
   that chance hits are rare; they only pick out what is looked at below.
2. Hits. A probe is a hit if its number is a reference block's anywhere and occurs twice; each pack is told which of its own are (a bit each).
3. Extension. Hits are extended by words on both sides to all windows of ``length`` words around them. A pack sends each distinct
   window once, by a 96-bit hash, with the smallest id; it is told whether a smaller one has it too. Windows that repeat and overlap
   make up the maximal repeats, whose words go.

Nothing is paired: a passage in a third of all documents is one number a pack. A bucket of numbers holds what falls into
a share of the hash range, whatever the corpus repeats. The texts are shuffled once.

Null and empty texts have no words. Rows that repeat an id are not earlier than one another (each is judged against smaller ids
and itself); a null id counts as larger than all others. Very long texts are held whole by one task. An empty table
gives an empty result. Words keep their case.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.llm import flat
from telemetra.llm.common import parts

#: Bytes of text in a pack, and bytes of text whose numbers fall into one bucket, at most; there are no fewer of either than shuffle partitions.
PACK_BYTES, BUCKET_BYTES = 8 << 20, 256 << 20
#: Bits of a probe beyond those that number all words.
SPARE_BITS = 8
_LAST = (1 << 63) - 1


def planes(values: np.ndarray) -> bytes:
    """Numbers as their first bytes, then their second bytes, and so on: leading zeros then cost nothing once compressed."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unplanes(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unbits(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)


def rolled(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each place on; places too near the end are left out."""
    n = len(words) - size + 1
    if n <= 0:
        return words[:0]
    mixed = flat.mix(words)
    powers = flat._powers(len(words) + 1, flat._BASE)
    sums = np.zeros(len(words) + 1, flat.U64)
    np.cumsum(mixed * powers[:-1], out=sums[1:])
    return flat.mix((sums[size:] - sums[:-size]) * flat._powers(n, flat._BACK))


class Pack:
    """The documents of a pack: words, probes and the places where a whole block or window fits."""

    def __init__(self, table: pa.Table, length: int, width: int):
        table = table.take(pa.array(np.argsort(np.asarray(table["key"].combine_chunks()), kind="stable")))
        self.ids = np.asarray(table["key"].combine_chunks())
        self.rows = table["id"].combine_chunks()
        self.data, self.offsets = flat.texts(table["text"])
        self.length, self.block = length, max(1, length // 2)
        found = []
        for i, _, own, off in flat.slices(self.data, self.offsets):
            starts, ends, first = flat.words(own, off)
            base = int(self.offsets[i])
            kind = np.int64 if self.offsets[-1] >= 1 << 31 else np.int32
            found.append(((starts + base).astype(kind), (ends + base).astype(kind), flat.span_hashes(flat.prefix_sums(own), starts, ends), np.diff(first)))
        self.starts, self.ends, self.words, number = (np.concatenate(c) for c in zip(*found, strict=True))
        del found
        self.first = np.concatenate([[0], np.cumsum(number)]).astype(np.int64)
        self.text = np.repeat(np.arange(len(number), dtype=np.int32), number)
        left = self.first[1:][self.text] - np.arange(len(self.words))
        self.fits = left >= length
        self.at = np.flatnonzero(left >= self.block).astype(np.int32)      # places of probes
        del left
        probe = rolled(self.words, self.block)[self.at] >> flat.U64(64 - width)
        self.values, self.number = np.unique(probe, return_inverse=True)
        del probe
        self.number = self.number.astype(np.int32)

    def marks(self) -> tuple[np.ndarray, np.ndarray]:
        """Whether each distinct probe is a reference block, and whether it occurs twice."""
        reference = np.zeros(len(self.values), bool)
        place = self.at - self.first[:-1][self.text[self.at]]
        reference[self.number[place % self.block == 0]] = True
        return reference, np.bincount(self.number, minlength=len(self.values)) > 1

    def windows(self, hit: np.ndarray) -> None:
        """The windows that hold a hit, and their distinct hashes in order. ``hit``: for every distinct probe."""
        n = len(self.words)
        here = np.zeros(n + 1, bool)
        here[self.at + 1] = hit[self.number]
        self.number = self.values = None                                   # not needed from here on
        total = np.cumsum(here, dtype=np.int32)
        reach = self.length - self.block + 1                               # probes inside a window
        at = np.flatnonzero(self.fits)
        at = at[total[at + reach] > total[at]]
        one, two = rolled(self.words, self.length)[at], rolled(self.words ^ flat.U64(0x5DEECE66D), self.length)[at] >> flat.U64(32)
        order = np.lexsort((at, two, one))
        at, one, two = at[order], one[order], two[order]
        new = np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])) if len(at) else np.zeros(0, bool)
        self.window, self.group = at, np.cumsum(new) - 1
        self.one, self.two = one[new], two[new]
        self.least = self.ids[self.text[at[new]]]                          # rows are in order of id, so the first has the smallest
        text = self.text[at]
        self.again = np.append(False, (text[1:] == text[:-1]) & ~new[1:]) if len(at) else new  # the same text has it before

    def gone(self, smaller: np.ndarray) -> np.ndarray:
        """Whether each word goes. ``smaller``: for every distinct window, whether a smaller id elsewhere has it."""
        own = self.ids[self.text[self.window]]
        repeat = self.window[smaller[self.group] | (self.least[self.group] < own) | self.again]
        change = np.zeros(len(self.words) + 1, np.int32)
        np.add.at(change, repeat, 1)
        np.add.at(change, repeat + self.length, -1)
        return np.cumsum(change[:-1], dtype=np.int32) > 0


def buckets_of(values: np.ndarray, buckets: int, width: int) -> np.ndarray:
    """Bounds of the buckets in sorted numbers of ``width`` bits."""
    edges = np.array([-(-(b << width) // buckets) for b in range(1, buckets)], flat.U64)
    return np.concatenate([[0], np.searchsorted(values, edges), [len(values)]])


def _steps(values: np.ndarray) -> bytes:
    return planes(np.diff(values, prepend=flat.U64(0)))


_PROBES = "bucket int, pack int, n int, numbers binary, reference binary, twice binary"
_WINDOWS = "bucket int, pack int, n int, one binary, two binary, least binary"
_TOLD = "pack int, bucket int, step int, n int, told binary"


def _dealt(pack: int, bounds: np.ndarray, names: list[str], of) -> pa.Table:
    """A row for every bucket that gets something."""
    rows = [(b, x, y) for b, (x, y) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)) if y > x]
    cols = list(zip(*(of(x, y) for _, x, y in rows), strict=True)) or [()] * 3
    return pa.table([pa.array([b for b, _, _ in rows], pa.int32()), pa.array([pack] * len(rows), pa.int32()),
                     pa.array([y - x for _, x, y in rows], pa.int32()), *(pa.array(c, pa.binary()) for c in cols)], names=["bucket", "pack", "n", *names])


def _answers(table: pa.Table, step: int, told: np.ndarray) -> pa.Table:
    n = np.concatenate([[0], np.cumsum(np.asarray(table["n"].combine_chunks()))])
    out = [bits(told[x:y]) for x, y in zip(n[:-1], n[1:], strict=True)]
    return pa.table({"pack": table["pack"], "bucket": table["bucket"], "step": pa.array([step] * len(table), pa.int32()),
                     "n": table["n"], "told": pa.array(out, pa.binary())})


def _column(table: pa.Table, name: str, of=unplanes) -> np.ndarray:
    return np.concatenate([of(b) for b in table[name].to_pylist()])


def find_hits(table: pa.Table) -> pa.Table:
    """Of a bucket's probes those that are a reference block somewhere and occur twice."""
    sizes = table["n"].to_pylist()
    values = _column(table, "numbers", lambda b: np.cumsum(unplanes(b)))
    flags = [np.concatenate([unbits(b, n) for b, n in zip(table[c].to_pylist(), sizes, strict=True)]) for c in ("reference", "twice")]
    order = np.argsort(values, kind="stable")
    sorted_values = values[order]
    new = np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1]))
    size = np.diff(np.append(new, len(values)))
    reference, twice = (np.logical_or.reduceat(f[order], new) for f in flags)
    told = np.empty(len(values), bool)
    told[order] = np.repeat(reference & (twice | (size > 1)), size)
    return _answers(table, 0, told)


def find_smaller(table: pa.Table) -> pa.Table:
    """Whether a pack with a smaller id has a bucket's windows too."""
    one = _column(table, "one", lambda b: np.cumsum(unplanes(b)))
    two, least = _column(table, "two"), _column(table, "least").view(np.int64)
    order = np.lexsort((least, two, one))
    new = np.append(True, (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0))
    first = least[order][new]
    told = np.empty(len(one), bool)
    told[order] = first[np.cumsum(new) - 1] < least[order]
    return _answers(table, 1, told)


def _told(table: pa.Table, step: int, n: int) -> np.ndarray:
    """One bit for each of the pack's ``n`` numbers, from the answers of all buckets."""
    own = table.filter(pc.equal(table["step"], step)).sort_by("bucket")
    if not len(own):
        return np.zeros(n, bool)
    return np.concatenate([unbits(b, k) for b, k in zip(own["told"].to_pylist(), own["n"].to_pylist(), strict=True)])


def repeats(documents: DataFrame, length: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_removed and kept: the words that stay, one space between them."""
    spark = documents.sparkSession
    docs = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("key"),
                            F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = parts(spark)
    packs, buckets = max(2 * count, -(-total // PACK_BYTES)), max(count, -(-total // BUCKET_BYTES))
    width = min(63, int(total).bit_length() + SPARE_BITS)
    docs = docs.withColumn("pack", F.pmod(F.xxhash64("key"), F.lit(packs)).cast("int")).repartition(count, "pack")

    def probes(table: pa.Table) -> pa.Table:
        p = Pack(table, length, width)
        reference, twice = p.marks()
        return _dealt(table["pack"][0].as_py(), buckets_of(p.values, buckets, width), ["numbers", "reference", "twice"],
                      lambda x, y: (_steps(p.values[x:y]), bits(reference[x:y]), bits(twice[x:y])))

    def windows(left: pa.Table, right: pa.Table) -> pa.Table:
        p = Pack(left, length, width)
        p.windows(_told(right, 0, len(p.values)))
        pack = left["pack"][0].as_py() if len(left) else 0
        return _dealt(pack, buckets_of(p.one >> flat.U64(1), buckets, 63), ["one", "two", "least"],
                      lambda x, y: (_steps(p.one[x:y]), planes(p.two[x:y]), planes(p.least[x:y].view(flat.U64))))

    def removed(left: pa.Table, right: pa.Table) -> pa.Table:
        p = Pack(left, length, width)
        p.windows(_told(right, 0, len(p.values)))
        gone = p.gone(_told(right, 1, len(p.one)))
        cut = np.concatenate([[0], np.cumsum(gone)])[p.first]
        stay = np.flatnonzero(~gone)
        kept = flat.joined(p.data, p.starts[stay], p.ends[stay], p.first - cut)
        return pa.table({"id": p.rows, "n_words": pa.array(np.diff(p.first)), "n_removed": pa.array(np.diff(cut)), "kept": kept.cast(pa.string())})

    hits = (docs.groupBy("pack").applyInArrow(probes, _PROBES).repartition(count, "bucket").groupBy("bucket").applyInArrow(find_hits, _TOLD))
    sent = docs.groupBy("pack").cogroup(hits.groupBy("pack")).applyInArrow(windows, _WINDOWS)
    smaller = sent.repartition(count, "bucket").groupBy("bucket").applyInArrow(find_smaller, _TOLD)
    kind = docs.schema["id"].dataType.simpleString()
    return (docs.groupBy("pack").cogroup(hits.unionByName(smaller).groupBy("pack"))
            .applyInArrow(removed, f"id {kind}, n_words long, n_removed long, kept string").withColumnRenamed("id", id_col))
