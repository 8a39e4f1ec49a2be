"""Near-duplicates by an LSH forest over minhash signatures, confirmed on full shingle sets.

1. Every text's set of distinct word shingles gets a set key and a signature. Texts with equal sets
   form one class, stood for by its smallest id.
2. Forest: each of TREES orders sorts the classes by its own sequence of signature values. A class is
   compared with its next NEIGHBOURS in the order with which it shares at least DEPTH leading values;
   dense regions thereby meet at greater depth, sparse ones at the least. Pairs whose signatures
   agree well enough join candidate groups (a spanning forest of them is kept, not all pairs).
3. All texts of a candidate group are brought together once and their full sets compared; a group
   larger than a block is cut into blocks, and every pair of blocks is compared. Links that a chain
   of found links already implies are not tested again, so no pair list of a group is ever built.
4. Links give components.

Null, empty and wordless texts have no set and link with nothing. Ids must be whole numbers; rows
that repeat an id count as copies if their texts are equal; if not, all its texts are linked with each other (but for
empty ones), however the rows are partitioned. Null ids are left out of the result; without documents there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.llm import flat
from telemetra.llm.common import parts, stored
from telemetra.llm.components import components

SIGNATURE = 64
TREES, DEPTH, KEY_VALUES, NEIGHBOURS = 12, 3, 6, 16
#: Share of agreeing signature values from which a pair is a candidate, below the similarity asked
#: for: 4.4 standard errors of the estimate at a similarity of 0.8.
SLACK = 0.22
#: Weight of the texts that form a block: their shingles, and a fixed weight for each text.
BLOCK_WEIGHT, TEXT_WEIGHT = 1_500_000, 600
_MULTIPLIERS = np.random.default_rng(7).integers(1, 1 << 63, SIGNATURE, dtype=np.uint64) | np.uint64(1)


def signatures(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(texts x SIGNATURE) minima of multiplied hashes; texts without shingles get the largest value."""
    full = np.flatnonzero(np.diff(at))
    out = np.full((len(at) - 1, SIGNATURE), 0xFFFFFFFF, np.uint32)
    if len(full):
        starts = at[:-1][full]
        for j, m in enumerate(_MULTIPLIERS):
            out[full, j] = np.minimum.reduceat(((values * m) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def _profile(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat.texts(batch.column(1))
            for i, j, own, off in flat.slices(data, offsets):
                values, at = flat.distinct(*flat.shingles(*flat.word_hashes(own, off), size))
                sig = signatures(values, at)
                one = np.add.reduceat(np.append(flat.mix(values), flat.U64(0)), at[:-1]) if j > i else values[:0]
                two = np.bitwise_xor.reduceat(np.append(flat.mix(values + flat.U64(77)), flat.U64(0)), at[:-1]) if j > i else values[:0]
                n = np.diff(at)
                one[n == 0] = two[n == 0] = 0  # reduceat gives an empty group the next group's first value
                keys = np.stack([one, two], 1).astype(flat.U64).tobytes()
                yield pa.record_batch([
                    batch.column(0).slice(i, j - i), pa.array(n, pa.int64()),
                    pa.array([keys[16 * k:16 * k + 16] for k in range(j - i)], pa.binary()),
                    pa.array([row.tobytes() for row in sig], pa.binary())], names=["id", "n", "set_key", "signature"])
    return run


def profile(documents: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """id, n (distinct shingles), set_key, signature of every text."""
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("id is not null")
    return docs.mapInArrow(_profile(size), "id long, n long, set_key binary, signature binary")


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per tree: its leading signature values as bytes that sort like numbers, and one byte of each value."""
    for batch in batches:
        ids = batch.column(0)
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(len(batch), SIGNATURE)
        small = [row.tobytes() for row in (sig & 0xFF).astype(np.uint8)]
        for t in range(TREES):
            at = (np.arange(KEY_VALUES) + t * DEPTH) % SIGNATURE
            keys = [row.tobytes() for row in sig[:, at].astype(">u4")]
            yield pa.record_batch([pa.array(np.full(len(batch), t, np.int32)), pa.array(keys, pa.binary()), ids,
                                   pa.array(small, pa.binary())], names=["tree", "key", "id", "small"])


class Forest:
    """Disjoint sets over 0..n-1 whose roots are the smallest members."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def tie(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _neighbours(agree: float):
    least = int(np.ceil(agree * SIGNATURE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for batch in batches:
            for lo in range(0, len(batch), 20_000):
                part = batch.slice(lo, 20_000)
                tree = np.asarray(part.column(0))
                key = np.frombuffer(b"".join(part.column(1).to_pylist()), ">u4").reshape(len(part), KEY_VALUES)
                small = np.frombuffer(b"".join(part.column(3).to_pylist()), np.uint8).reshape(len(part), SIGNATURE)
                now = [tree, key, np.asarray(part.column(2)), small]
                if tail is not None:
                    now = [np.concatenate(x) for x in zip(tail, now, strict=True)]
                tree, key, ids, small = now
                sets, out = Forest(len(ids)), []
                for step in range(1, min(NEIGHBOURS, len(ids) - 1) + 1):
                    near = (tree[step:] == tree[:-step]) & (key[step:, :DEPTH] == key[:-step, :DEPTH]).all(1)
                    at = np.flatnonzero(near)
                    at = at[(small[at] == small[at + step]).sum(1) >= least]
                    out += [(k, k + step) for k in at.tolist() if sets.tie(k, k + step)]
                if out:
                    a, b = np.array(out).T
                    yield pa.record_batch([pa.array(ids[a]), pa.array(ids[b])], names=["a", "b"])
                tail = [x[-NEIGHBOURS:] for x in now]
    return run


def candidates(classes: DataFrame, similarity: float) -> DataFrame:
    """(id, group) of the classes that may link, from the forest. ``classes``: id, signature."""
    rows = classes.select("id", "signature").mapInArrow(_orders, "tree int, key binary, id long, small binary")
    orders = rows.repartitionByRange(parts(classes.sparkSession), "tree", "key", "id").sortWithinPartitions("tree", "key", "id")
    pairs = orders.mapInArrow(_neighbours(similarity - SLACK), "a long, b long")
    pairs = stored(pairs, "pairs")  # else its tasks would have two Python workers each, here and in the components' first step
    return components(pairs).select("id", F.col("component").alias("group"))


def _links(size: int, percent: int):
    """Links of one block pair: sides 0 and 1, or a single block whose own pairs are compared too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        if not len(table):
            return
        side = np.asarray(table["side"].combine_chunks())
        own = np.asarray(table["alone"].combine_chunks())[0]
        ids = np.asarray(table["id"].combine_chunks())
        sets: list[np.ndarray] = []
        for _, _, data, off in flat.slices(*flat.texts(table["text"])):
            values, at = flat.distinct(*flat.shingles(*flat.word_hashes(data, off), size))
            sets += [values[x:y] for x, y in zip(at[:-1], at[1:], strict=True)]
        n = np.array([len(s) for s in sets])
        every = np.concatenate(sets)
        sig = signatures(every, np.concatenate([[0], np.cumsum(n)]))
        low = int(np.ceil((percent / 100 - SLACK) * SIGNATURE))
        ties, out, todo = Forest(len(ids)), [], [[] for _ in range(SIGNATURE + 1)]
        for k in range(len(ids) - 1):
            rest = np.arange(k + 1, len(ids)) if own else k + 1 + np.flatnonzero(side[k + 1:] != side[k])
            rest = rest[(n[rest] > 0) & (100 * np.minimum(n[rest], n[k]) >= percent * np.maximum(n[rest], n[k]))]
            same = (sig[rest] == sig[k]).sum(1)
            for s in np.unique(same[same >= low]).tolist():
                todo[s].append((k, rest[same == s]))
        for s in range(SIGNATURE, low - 1, -1):  # likeliest pairs first: they spare most of the others
            for k, rest in todo[s]:
                for j in rest.tolist():
                    if ties.root(k) != ties.root(j):
                        both = len(np.intersect1d(sets[k], sets[j], assume_unique=True))
                        if 100 * both >= percent * (n[k] + n[j] - both):
                            ties.tie(k, j)
                            out.append((k, j))
        if out:
            a, b = np.array(out).T
            yield pa.record_batch([pa.array(ids[a]), pa.array(ids[b])], names=["a", "b"])
    return run


def confirmed(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Exact links (a, b), enough to connect whatever is linked. ``texts``: id, text, n, group."""
    blocks = (texts.groupBy("group").agg(F.sum(F.col("n") + TEXT_WEIGHT).alias("all"))
              .withColumn("blocks", F.ceil(F.col("all") / BLOCK_WEIGHT).cast("int")))
    placed = (texts.join(blocks.select("group", "blocks"), "group")
              .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tasks = (placed.select("id", "text", "group", "block", other)
             .select("id", "text", "group", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                     F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"),
                     (F.col("block") == F.col("other")).alias("alone")))
    links = tasks.groupBy("group", "lo", "hi").applyInArrow(
        lambda table: pa.Table.from_batches(list(_links(size, percent)(table.to_batches())),
                                            pa.schema([("a", pa.int64()), ("b", pa.int64())])), "a long, b long")
    return links


def _repeated(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) from an id that repeats with different texts to the id of each of its texts' classes."""
    several = (sets.filter("n > 0").groupBy("id").agg(F.min("set_key").alias("lo"), F.max("set_key").alias("hi"))
               .filter("lo <> hi").select("id"))
    rows = sets.filter("n > 0").join(several, "id").select("set_key", F.col("id").alias("a"))
    return rows.join(classes.select("set_key", F.col("id").alias("b")), "set_key").select("a", "b").distinct()


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                    percent: int = 80) -> DataFrame:
    """id, n_shingles, component_id (smallest id reachable over links), kept."""
    sets = stored(profile(documents, id_col, text_col, size), "sets")
    classes = stored(sets.filter("n > 0").groupBy("set_key")
                     .agg(F.min(F.struct("id", "n", "signature")).alias("r")).select("set_key", "r.*"), "classes")
    sizes = classes.groupBy("id").agg(F.max("n").alias("n"))  # an id with several texts may stand for several classes
    groups = stored(candidates(classes, percent / 100).join(sizes, "id"), "groups")
    # Merged whatever the size of the groups: they grow with the documents, so that a copy for every executor would not scale.
    texts = (documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
             .join(groups.hint("merge"), "id").withColumn("_same", F.sha2("text", 256)).dropDuplicates(["id", "_same"]).drop("_same"))
    links = confirmed(texts, size, percent)
    found = components(stored(links.select("a", "b").union(_repeated(sets, classes)), "links"))
    of_class = classes.join(found, "id", "left").select("set_key", F.coalesce("component", "id").alias("component"))
    return (sets.withColumn("set_key", F.when(F.col("n") > 0, F.col("set_key"))).join(of_class, "set_key", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.coalesce("component", "id").alias("component_id"),
                    (F.coalesce("component", "id") == F.col("id")).alias("kept")))


def without_near_duplicates(documents: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that stand for their component, with all their columns; of rows that repeat an id one stays."""
    kept = near_duplicates(documents, id_col, **options).filter("kept").select(id_col).distinct()
    return documents.join(kept, id_col, "left_semi").dropDuplicates([id_col])
