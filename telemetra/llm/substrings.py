"""Exact substring deduplication over suffix arrays of shards.

A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller
id. Texts are UTF-8 bytes; strings lie within one document and overlaps count.

A suffix array of all texts would be sorted from bytes that mostly occur once, so strings that
can repeat are found first, and each shard gets all occurrences of its strings:

1. Anchors. Of each string of ``length`` bytes the least hash of its short grams is its anchor;
   equal strings have equal anchors. A pack of documents sends its distinct anchors once, as sorted numbers dealt
   to buckets, and is told by a bit for each whether another document has it, too; strings at other anchors cannot repeat.
   An anchor in every document is one number a pack.
2. Shards. A pack sends each distinct run of strings around a shared anchor once, with its smallest
   document. Runs are dealt out and sorted by anchor, so all occurrences of a string meet in one
   shard, a bounded part of that stream.
3. In a shard the suffix array of the runs is built by induced sorting, of those suffixes that start a string and
   what induces them; permuted common prefixes of at least ``length`` bytes delimit equal strings, whose smallest
   document follows.
4. The answers of many shards go back to the packs in one row each, and the packs mark the bytes of every occurrence.

Null texts are empty. Documents with equal ids do not count as smaller than each other; a null id
counts as larger than all others. Kept text is the remaining bytes; where a cut splits a
character, its bytes that stay are dropped from the text form (not from the hash).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.llm import flat
from telemetra.llm.blocks import _answers, _column, _dealt, _steps, _told, bits, buckets_of, unbits, unplanes
from telemetra.llm.common import parts, stored
from telemetra.llm.induced import common_prefixes, suffix_array

#: Bytes of text in a pack and of runs in a shard.
PACK_BYTES, SHARD_BYTES = 6 << 20, 2 << 20
#: Bytes of text whose anchors fall into one bucket, at most; there are no fewer buckets than shuffle partitions.
BUCKET_BYTES = 128 << 20
#: Bits of an anchor beyond those that number all bytes: two anchors that share a number by chance (one in 2^SPARE_BITS) only send
#: a few runs in vain, the shards decide on the runs' bytes.
SPARE_BITS = 8
#: Bytes of text whose anchors are looked for at once, so that they stay in a core's cache; and numbers in answers that a task holds back to put
#: those of more shards into one row a pack.
SLICE_BYTES, ANSWERS = 1 << 17, 1 << 20
_LAST = (1 << 63) - 1
_LOW = np.uint64(0xFFFFFFFF)


def gram_of(length: int) -> int:
    return max(1, min(24, length // 3))


def string_anchors(data: np.ndarray, length: int):
    """(for every place where a string fits, a number that tells its anchor's position in the lower half, prefix sums): the rightmost least gram hash."""
    gram = gram_of(length)
    span = length - gram + 1
    sums = flat.prefix_sums(data)
    if len(data) < length:
        return np.zeros(0, np.uint64), sums
    key = sums[gram:] - sums[:-gram]
    key *= flat._powers(len(key), flat._BACK)
    key ^= key >> np.uint64(31)
    key *= np.uint64(0x9E3779B97F4A7C15)
    key &= ~_LOW
    key |= _LOW - np.arange(len(key), dtype=np.uint64)
    width = 1
    while 2 * width <= span:  # minima over spans of doubled width, then two that overlap
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < span:
        key = np.minimum(key[:len(key) - (span - width)], key[span - width:])
    return key, sums


def runs_of(data: np.ndarray, offsets: np.ndarray, length: int, width: int = 64):
    """Runs of neighbouring strings with one anchor: (first start, last start, document, anchor hash of ``width`` bits, sums)."""
    key, sums = string_anchors(data, length)
    new = np.append(True, key[1:] != key[:-1])[:len(key)]
    size = np.diff(offsets)
    new[offsets[:-1][size >= length]] = True
    short = np.minimum(size, length - 1)  # where no string of the document fits
    across = np.repeat(offsets[1:] - np.cumsum(short), short) + np.arange(short.sum())
    new[across[across < len(new)]] = False
    first = np.flatnonzero(new)
    doc = np.searchsorted(offsets, first, "right") - 1
    last = np.minimum(np.append(first[1:], len(data)) - 1, offsets[doc + 1] - length)
    at = (_LOW - (key[first] & _LOW)).astype(np.int64)
    return first, last, doc, flat.span_hashes(sums, at, at + gram_of(length)) >> flat.U64(64 - width), sums


def _anchors(length: int, width: int, buckets: int):
    """A pack's distinct anchors as sorted numbers, dealt to buckets by their leading bits, each with a mark if more than one
    document of the pack has it."""
    def run(table: pa.Table) -> pa.Table:
        p = Pack(table, length, width)
        order = np.argsort(p.number, kind="stable")  # runs are in order of id, so a number's first and last tell whether it has two
        bounds = np.searchsorted(p.number[order], np.arange(len(p.values) + 1))
        own = p.ids[p.doc[order]]
        many = own[bounds[:-1]] != own[bounds[1:] - 1] if len(own) else np.zeros(0, bool)
        return _dealt(table["pack"][0].as_py(), buckets_of(p.values, buckets, width), ["numbers", "many", "none"],
                      lambda x, y: (_steps(p.values[x:y]), bits(many[x:y]), b""))
    return run


def find_shared(table: pa.Table) -> pa.Table:
    """Of a bucket's anchors those that more than one document has: two of a pack, or two packs."""
    sizes = table["n"].to_pylist()
    values = _column(table, "numbers", lambda b: np.cumsum(unplanes(b)))
    many = np.concatenate([unbits(b, n) for b, n in zip(table["many"].to_pylist(), sizes, strict=True)])
    order = np.argsort(values, kind="stable")
    values = values[order]
    new = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    size = np.diff(np.append(new, len(values)))
    told = np.empty(len(values), bool)
    told[order] = np.repeat((size > 1) | many[order[new]], size)
    return _answers(table, 0, told)


class Pack:
    """The documents of a pack and their runs; ``values`` are the distinct anchors, ``number`` each run's place there."""

    def __init__(self, table: pa.Table, length: int, width: int):
        order = np.argsort(np.asarray(table["key"].combine_chunks()), kind="stable")
        table = table.take(pa.array(order))
        self.ids = np.asarray(table["key"].combine_chunks())
        self.rows = table["id"].combine_chunks()
        self.data, self.offsets = flat.texts(table["text"])
        found = []
        for i, _, data, off in flat.slices(self.data, self.offsets, SLICE_BYTES):
            first, last, doc, anchor, sums = runs_of(data, off, length, width)
            base = self.offsets[i]
            found.append((first + base, last + base, doc + i, anchor, flat.span_hashes(sums, first, last + length) ^ flat.mix(anchor)))
        cols = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2
        self.first, self.last, self.doc, self.anchor, self.run = cols
        self.values, self.number = np.unique(self.anchor, return_inverse=True)

    def keep(self, shared: np.ndarray) -> "Pack":
        """Keeps the runs whose anchor is ``shared`` (told for every value) and numbers the distinct ones, alike on every call."""
        hit = np.flatnonzero(shared[self.number])
        self.first, self.last, self.doc, self.anchor = self.first[hit], self.last[hit], self.doc[hit], self.anchor[hit]
        _, self.one, self.number = np.unique(self.run[hit], return_index=True, return_inverse=True)  # the first has the smallest id
        self.run = self.values = None
        return self


def _send(length: int):
    """Distinct runs of a pack: anchor, run bytes, pack, number, smallest document, whether it has more."""
    def run(pack: int, p: Pack) -> pa.Table:
        many = np.zeros(len(p.one), bool)
        many[p.number[p.ids[p.doc] != p.ids[p.doc[p.one]][p.number]]] = True
        first = p.first[p.one]
        to = np.concatenate([[0], np.cumsum(p.last[p.one] - first + length)])
        kind = np.int32 if max(len(p.data), int(to[-1])) < 1 << 31 else np.int64
        at = np.repeat((first - to[:-1]).astype(kind), np.diff(to))
        at += np.arange(len(at), dtype=kind)
        texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(to), pa.py_buffer(p.data[at])])
        return pa.table({"anchor": pa.array(p.anchor[p.one].view(np.int64)), "run": texts.cast(pa.binary()),
                         "pack": pa.array(np.full(len(texts), pack, np.int32)), "number": pa.array(np.arange(len(texts), dtype=np.int32)),
                         "doc": pa.array(p.ids[p.doc[p.one]]), "many": pa.array(many)})
    return run


def answer(data: np.ndarray, size: np.ndarray, docs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For every string of each run (``size`` bytes one after another in ``data``) the smallest of the runs'
    documents that holds the string; and the bounds of the runs in that answer."""
    number = size - length + 1
    bounds = np.concatenate([[0], np.cumsum(number)])
    starts = np.repeat(np.tile([True, False], len(size)), np.column_stack([number, np.full(len(size), length - 1)]).ravel())
    sa = suffix_array(data, length, starts)  # of the strings only, about a quarter of all
    at = (np.cumsum(starts, dtype=sa.dtype) - 1)[sa]
    group = np.flatnonzero(common_prefixes(data, sa, length)[sa] < length)
    group = group if len(group) and group[0] == 0 else np.append(0, group)
    least = np.minimum.reduceat(np.repeat(docs, number)[at], group)
    out = np.empty(len(sa), np.int64)
    out[at] = np.repeat(least, np.diff(np.append(group, len(sa))))
    return out, bounds


class Shard:
    """Rows of one shard in anchor and run order; equal runs are kept once."""

    def __init__(self):
        self.cols: list[list[np.ndarray]] = [[], [], [], []]  # pack, number, doc, many
        self.run: list[np.ndarray] = []                       # place of each row's run
        self.data: list[np.ndarray] = []
        self.size: list[np.ndarray] = []
        self.bytes = self.runs = 0
        self.last = None                                      # (anchor, hash) of the last row

    def add(self, anchor: np.ndarray, runs: pa.Array, *cols: np.ndarray) -> None:
        data, off = flat.texts(runs)
        data, off = data[off[0]:off[-1]], off - off[0]
        hashes = flat.span_hashes(flat.prefix_sums(data), off[:-1], off[1:])
        new = np.append(self.last != (int(anchor[0]), int(hashes[0])), (hashes[1:] != hashes[:-1]) | (anchor[1:] != anchor[:-1]))
        self.last = int(anchor[-1]), int(hashes[-1])
        self.run.append(self.runs - 1 + np.cumsum(new))
        size = np.diff(off)
        self.data.append(data[np.repeat(new, size)])
        self.size.append(size[new])
        self.runs += int(new.sum())
        self.bytes += len(self.data[-1])
        for held, c in zip(self.cols, cols, strict=True):
            held.append(c)

    def answers(self, length: int) -> list[np.ndarray]:
        """Pack, number of a run there, first and end of its strings that share an answer, the answer."""
        pack, number, doc, many = (np.concatenate(c) for c in self.cols)
        run, size = np.concatenate(self.run), np.concatenate(self.size)
        got, bounds = answer(np.concatenate(self.data), size, np.minimum.reduceat(doc, np.searchsorted(run, np.arange(self.runs))), length)
        edge = np.append(True, got[1:] != got[:-1])
        edge[bounds[:-1]] = True
        cut = np.flatnonzero(edge)
        of = np.searchsorted(bounds, cut, "right") - 1
        lo, hi = cut - bounds[of], np.append(cut[1:], len(got)) - bounds[of]
        first = np.searchsorted(of, np.arange(self.runs + 1))
        tell = np.flatnonzero(many | (np.minimum.reduceat(got[cut], first[:-1])[run] < doc))
        n = (first[1:] - first[:-1])[run[tell]]
        at = np.repeat(first[run[tell]] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return [np.repeat(pack[tell], n), np.repeat(number[tell], n), lo[at].astype(np.int32), hi[at].astype(np.int32), got[cut][at]]


def _by_pack(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """A row for each pack that some shards have answers for."""
    cols = [np.concatenate(c) for c in zip(*held, strict=True)]
    order = np.argsort(cols[0], kind="stable")
    pack, *cols = (c[order] for c in cols)
    cuts = np.flatnonzero(np.append(True, pack[1:] != pack[:-1]))[:len(pack)]
    yield pa.record_batch([pa.array(pack[cuts], pa.int32()), *(pa.array([c[a:b].tobytes() for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(pack)], strict=False)],
                                                                      pa.binary()) for c in cols)], names=["pack", *_ANSWER])


def _shards(length: int):
    """Cuts the stream, sorted by anchor and run, into shards of whole anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, last, held = Shard(), None, []
        for batch in batches:
            for lo in range(0, len(batch), 2000):
                part = batch.slice(lo, 2000)
                anchor = np.asarray(part.column(0))
                cols = [np.asarray(part.column(k)) for k in (2, 3, 4)] + [np.asarray(part.column(5).cast(pa.uint8())).astype(bool)]
                cut = 0
                if shard.bytes >= SHARD_BYTES:  # goes up to the next change of anchor
                    change = np.flatnonzero(np.append(anchor[0] != last, anchor[1:] != anchor[:-1]))
                    cut = int(change[0]) if len(change) else len(anchor)
                    if cut:
                        shard.add(anchor[:cut], part.column(1).slice(0, cut), *(c[:cut] for c in cols))
                    if len(change):
                        held.append(shard.answers(length))
                        shard = Shard()
                        if sum(len(c[0]) for c in held) >= ANSWERS:
                            yield from _by_pack(held)
                            held = []
                if cut < len(anchor):
                    shard.add(anchor[cut:], part.column(1).slice(cut), *(c[cut:] for c in cols))
                last = anchor[-1]
        if shard.runs:
            held.append(shard.answers(length))
        if held:
            yield from _by_pack(held)
    return run


def _mark(length: int, keep_text: bool):
    """The pack's documents with what goes."""
    def run(p: Pack, answers: list[list[bytes]]) -> pa.Table:
        change = np.zeros(len(p.data) + 1, np.int32)
        by_number = np.argsort(p.number, kind="stable")
        bounds = np.searchsorted(p.number[by_number], np.arange(len(p.one) + 1))
        number, lo, hi, least = (np.frombuffer(b"".join(a[k] for a in answers), np.int64 if k == 3 else np.int32) for k in range(4))
        n = bounds[number + 1] - bounds[number]
        which = np.repeat(np.arange(len(number)), n)
        at = by_number[np.repeat(bounds[number] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        gone = least[which] < p.ids[p.doc[at]]
        which, at = which[gone], at[gone]
        np.add.at(change, p.first[at] + lo[which], 1)
        np.add.at(change, p.first[at] + hi[which] - 1 + length, -1)
        gone = np.cumsum(change[:-1], dtype=np.int32) > 0
        size, bounds = np.diff(p.offsets), p.offsets.tolist()
        opens = gone & ~np.append(False, gone[:-1])
        opens[p.offsets[:-1][size > 0]] |= gone[p.offsets[:-1][size > 0]]
        spans, total = (np.searchsorted(np.flatnonzero(marks), p.offsets) for marks in (opens, gone))
        removed = np.diff(total)
        kept = [(p.data[a:b][~gone[a:b]] if r else p.data[a:b]).tobytes() for a, b, r in zip(bounds[:-1], bounds[1:], removed, strict=True)]
        out = {"id": p.rows, "n_bytes": pa.array(size.astype(np.int64)), "n_removed": pa.array(removed.astype(np.int64)),
               "n_spans": pa.array(np.diff(spans).astype(np.int64)),
               "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept])}
        if keep_text:
            out["kept"] = pa.array([k.decode("utf-8", "ignore") for k in kept])
        return pa.table(out)
    return run


_ANSWER = ["number", "lo", "hi", "least"]
_SENT = pa.schema([("anchor", pa.int64()), ("run", pa.binary()), ("pack", pa.int32()), ("number", pa.int32()), ("doc", pa.int64()), ("many", pa.bool_())])


_NUMBERS = "bucket int, pack int, n int, numbers binary, many binary, none binary"
_TOLD = ["bucket", "step", "n", "told"]


def repeats(documents: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (text)."""
    spark = documents.sparkSession
    docs = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("key"),
                            F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    packs = max(1, -(-total // PACK_BYTES))
    width = min(64, int(total).bit_length() + SPARE_BITS)
    docs = docs.withColumn("pack", F.pmod(F.xxhash64("key"), F.lit(packs)).cast("int")).repartition(parts(spark), "pack")

    buckets = max(parts(spark), -(-total // BUCKET_BYTES))

    # 1. anchors of more than one document: a bit for each anchor of every pack
    shared = (docs.groupBy("pack").applyInArrow(_anchors(length, width, buckets), _NUMBERS).repartition(parts(spark), "bucket")
              .groupBy("bucket").applyInArrow(find_shared, "pack int, bucket int, step int, n int, told binary"))
    shared = stored(shared, "shared")

    # 2. and 3. distinct runs to shards, sorted by anchor; answers per pack
    def grouped(right: DataFrame, of, kind: str) -> DataFrame:
        return docs.groupBy("pack").cogroup(right.groupBy("pack")).applyInArrow(of, kind)

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return _SENT.empty_table()
        p = Pack(left, length, width)
        return _send(length)(left["pack"][0].as_py(), p.keep(_told(right, 0, len(p.values))))

    runs = grouped(shared, send, "anchor long, run binary, pack int, number int, doc long, many boolean")
    answers = (runs.repartition(parts(spark), "anchor").sortWithinPartitions("anchor", "run")
               .mapInArrow(_shards(length), "pack int, number binary, lo binary, hi binary, least binary"))

    # 4. the answers mark the bytes of every occurrence
    kind = docs.schema["id"].dataType.simpleString()
    nothing = {"number": "binary", "lo": "binary", "hi": "binary", "least": "binary"}
    both = (shared.select("pack", *_TOLD, *(F.lit(None).cast(k).alias(c) for c, k in nothing.items()))
            .unionByName(answers.select("pack", *(F.lit(None).cast(shared.schema[c].dataType).alias(c) for c in _TOLD), *_ANSWER)))

    def mark(left: pa.Table, right: pa.Table) -> pa.Table:
        p = Pack(left, length, width)
        answered = pc.is_valid(right["number"])
        told = right.filter(answered)
        p.keep(_told(right.filter(pc.invert(answered)), 0, len(p.values)))
        return _mark(length, keep_text)(p, list(zip(*(told[c].to_pylist() for c in _ANSWER), strict=True)))

    return (grouped(both, mark, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept string" * keep_text)
            .withColumnRenamed("id", id_col))


def without_repeats(documents: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with the kept text in place of their text. Other columns stay as they are; rows that repeat
    an id get the kept text of one of them, rows with a null id go."""
    kept = (repeats(documents, length, id_col, text_col, keep_text=True).select(id_col, F.col("kept").alias("_kept"))
            .dropDuplicates([id_col]))
    return (documents.join(kept, id_col).withColumn(text_col, F.col("_kept")).select(*documents.columns))
