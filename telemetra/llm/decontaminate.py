"""Benchmark decontamination by winnowing.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. Every text keeps
the minimum hash of its ``gram``-word grams in each run of ``window - gram + 1`` grams, so two
texts that share ``window`` words share a kept hash. Documents whose kept hashes meet a benchmark
item's are compared exactly, and overlapping shared windows are extended to whole spans.

An item of fewer words than a window, but not none, is one window of its own length; it has no
sliding window to winnow, so all document grams of that length are joined with it (only when
such items exist). Null or wordless texts have no windows. Documents are told apart by id and
text: rows that repeat both get the same result. Null ids are compared as equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetra.llm.common import let, run_hashes, split_words, stored

#: What stands between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return split_words(text, BETWEEN)


def winnow(words_col: Column, window: int, gram: int) -> Column:
    """The distinct minimum gram hashes of all sliding windows of ``window`` words."""
    span = window - gram + 1
    grams = run_hashes(F.transform(words_col, lambda w: F.xxhash64(w)), gram)
    least = let(grams, lambda g: F.when(F.size(g) >= span, F.transform(
        F.sequence(F.lit(0), F.size(g) - span),
        lambda i: F.least(*[F.get(g, i + j) for j in range(span)]))).otherwise(F.array().cast("array<bigint>")))
    return F.array_distinct(least)


def _windows(df: DataFrame, words_col: str, size: int, *keep: str) -> DataFrame:
    """One row per run of ``size`` words: start and its text (words have no spaces)."""
    starts = F.when(F.size(words_col) >= size, F.sequence(F.lit(0), F.size(words_col) - size))
    return (df.select(*keep, words_col, F.explode(starts).alias("start"))
            .select(*keep, "start", F.lit(size).alias("size"),
                    F.array_join(F.slice(words_col, F.col("start") + 1, size), " ").alias("run")))


def hits(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", window: int = 10, gram: int = 5) -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items (sorted as strings, comma-joined), spans."""
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    docs = docs.withColumn("key", F.xxhash64("id", F.sha2(F.coalesce("text", F.lit("")), 256)))
    items = stored(benchmark.select(F.col(item_col).cast("string").alias("item"), words(F.col(item_text_col)).alias("iw"))
                   .filter(F.size("iw") > 0).distinct(), "items")
    short = sorted(r[0] for r in items.filter(F.size("iw") < window).select(F.size("iw")).distinct().collect())
    profile = stored(docs.select("id", "key", let(words(F.col("text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), winnow(w, window, gram).alias("kept"))).alias("p"))
        .select("id", "key", "p.*"), "winnowed")
    marks = stored(items.select(winnow(F.col("iw"), window, gram).alias("kept")), "marks")
    marks = marks.select(F.explode("kept").alias("mark")).distinct()
    touched = profile.select("key", F.explode("kept").alias("mark")).join(marks, "mark", "left_semi").select("key").distinct()
    near = stored(docs.join(touched, "key", "left_semi").select("key", words(F.col("text")).alias("dw")).distinct(), "near")
    runs = _windows(items.filter(F.size("iw") >= window), "iw", window, "item")
    found = _windows(near, "dw", window, "key").join(runs.select("run", "item").distinct(), "run")
    for size in short:
        own = _windows(items.filter(F.size("iw") == size), "iw", size, "item").select("run", "item").distinct()
        every = docs.select("key", words(F.col("text")).alias("dw")).filter(F.size("dw") >= size)
        found = found.unionByName(_windows(every, "dw", size, "key").join(own, "run"))
    found = stored(found.select("key", "start", "size", "item"), "hits")
    before = Window.partitionBy("key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    places = found.select("key", "start", (F.col("start") + F.col("size")).alias("end")).distinct()
    reach = F.coalesce(F.max("end").over(before), F.lit(0))
    spans = (places.withColumn("reach", reach)
             .withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest("reach", "start")))
             .groupBy("key").agg(F.sum("new").cast("long").alias("n_hit"),
                                 F.count_if((F.col("start") > F.col("reach")) | (F.col("reach") == 0)).alias("n_spans")))
    named = (found.select("key", "item").distinct().groupBy("key")
             .agg(F.array_sort(F.collect_list("item")).alias("items")))
    return (profile.join(spans.join(named, "key"), "key", "left")
            .select(F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce(F.array_join("items", ","), F.lit("")).alias("items"),
                    F.coalesce("n_spans", F.lit(0)).alias("n_spans")))


def clean(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents without any hit word; a document with a null id is kept."""
    bad = hits(documents, benchmark, id_col, **options).filter("n_hit > 0").select(id_col)
    return documents.join(bad, id_col, "left_anti")
