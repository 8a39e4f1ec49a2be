"""Threshold-scaled document fingerprints.

Of all five-word shingles of a text (words: runs without white space, A-Z lower-cased; a shorter
text is one shingle) every shingle hash below a fixed fraction of the hash range is kept.
Sketches merge by set union, and because the threshold does not depend on the text, the kept part
of a small document is comparable with that of a very large one.

A fingerprint is the hash of the whole word sequence followed by the kept hashes, ascending, so
equal texts have equal fingerprints and short texts without a kept hash still tell apart. Null
and empty texts have no shingles. Likeness is 1 for equal word sequences, else the overlap of
the kept hashes over their union (0 if both are empty).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetra.llm.common import let, parts, run_hashes, split_words

SHINGLE = 5
#: What stands between words.
BETWEEN = r"[\x20\x09-\x0D]+"
#: One hash in SCALE is kept; one in two leaves texts of 20 shingles without any with a chance of 1e-6.
SCALE = 2
_LEAST = -(1 << 63)


def sketch(text: Column, scale: int = SCALE) -> Column:
    """struct(whole: hash of the word sequence, kept: ascending kept shingle hashes)."""
    hashes = F.transform(split_words(text, BETWEEN), lambda w: F.xxhash64(w))
    below = F.lit(_LEAST + (1 << 64) // scale)

    def body(h: Column) -> Column:
        shingles = F.when(F.size(h) >= SHINGLE, run_hashes(h, SHINGLE)).when(F.size(h) > 0, F.array(F.xxhash64(h))) \
            .otherwise(F.array().cast("array<bigint>"))
        return F.struct(F.xxhash64(h).alias("whole"), F.array_sort(F.array_distinct(F.filter(
            shingles, lambda x: x < below))).alias("kept"))
    return let(hashes, body)


def fingerprint(whole: Column, kept: Column) -> Column:
    return F.concat_ws(":", F.lower(F.hex(whole)), F.array_join(F.transform(kept, lambda h: F.lower(F.hex(h))), ","))


def likeness(whole_a: Column, kept_a: Column, whole_b: Column, kept_b: Column) -> Column:
    union = F.size(F.array_union(kept_a, kept_b))
    return (F.when(whole_a == whole_b, 1.0)
            .when(union > 0, F.size(F.array_intersect(kept_a, kept_b)) / union).otherwise(0.0))


def containment(kept_a: Column, kept_b: Column) -> Column:
    """Estimated share of a's shingles that b holds (null where a's sketch is empty)."""
    return F.when(F.size(kept_a) > 0, F.size(F.array_intersect(kept_a, kept_b)) / F.size(kept_a))


def with_next(df: DataFrame, order: str, carried: list[str], most_blocks: int = 8192) -> DataFrame:
    """Adds ``next_<c>`` of the following row by ``order`` (nulls first, ties by the first carried
    column), the first row following the last.

    Rows are cut into blocks by approximate quantiles of ``order`` (four a shuffle partition, so
    the sort of one block stays small at any size); the first rows of every block are also put at
    the end of the block before it, so no window reaches over a block."""
    df = df.withColumn("_o", F.coalesce(F.col(order).cast("long"), F.lit(_LEAST)))
    blocks = min(most_blocks, 4 * parts(df.sparkSession))
    cuts = df.agg(F.percentile_approx("_o", [i / blocks for i in range(1, blocks)], 10_000)).first()[0]
    if cuts is None:  # no rows
        return df.drop("_o").withColumns({f"next_{c}": F.col(c) for c in carried})
    cuts = F.lit(sorted(set(cuts))).cast("array<bigint>")
    rows = df.withColumn("_block", F.size(F.filter(cuts, lambda c: c <= F.col("_o"))))
    heads = sorted((r[0], r[1]) for r in rows.groupBy("_block").agg(F.min("_o")).collect())
    before = {head: heads[i - 1][0] for i, (_, head) in enumerate(heads)}
    block_before = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), F.col("_o"))
    guards = rows.filter(F.col("_o").isin(list(before))).withColumn("_block", block_before)
    both = rows.withColumn("_guard", F.lit(0)).unionByName(guards.withColumn("_guard", F.lit(1)))
    w = Window.partitionBy("_block").orderBy("_guard", "_o", carried[0])
    return (both.withColumns({f"next_{c}": F.lead(c).over(w) for c in carried})
            .filter("_guard = 0").drop("_block", "_guard", "_o"))


def edited(text: Column, following: Column) -> Column:
    """The last floor(n/2) code points replaced by the first as many of ``following``."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_chars, fingerprint, whole, kept of every document."""
    docs = documents.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return (docs.withColumn("_s", sketch(F.col("_text"))).select(id_col, "_text", "_s.*")
            .select(id_col, F.length("_text").cast("long").alias("n_chars"),
                    fingerprint(F.col("whole"), F.col("kept")).alias("fingerprint"), "whole", "kept"))


def against_edits(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints every text and its edited text (its end exchanged for the next document's start)."""
    docs = documents.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    both = with_next(docs.withColumn("s", sketch(F.col("text"))), id_col, ["text", "s"])
    both = both.withColumn("edit", edited(F.col("text"), F.col("next_text"))).withColumn("e", sketch(F.col("edit")))
    here, there, after = [(F.col(f"{x}.whole"), F.col(f"{x}.kept")) for x in ("s", "e", "next_s")]
    return both.select(
        id_col, F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edit").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(*here).alias("fingerprint"),
        fingerprint(*there).alias("edited_fingerprint"),
        likeness(*here, *there).alias("near_edited"),
        likeness(*here, *after).alias("near_next"))
