"""The registered queries of the training-data operators: thin wrappers with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.llm import (blocks, bpe, decontaminate, fingerprints, language, language_model, minhash_forest, oracle_sql, periodic_runs,
                           quality, spelling, substrings, toxicity, url_filters)
from telemetra.llm.common import held_out, table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weakly supervised toxicity of every text; learns where crc32(doc_id) mod 3 is not 1."""
    docs, out = table(spark, sf_dir, "documents"), held_out("doc_id", 3, 1)
    return toxicity.classify(docs, table(spark, sf_dir, "labels"), ~out).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text; learns where crc32(doc_id) mod 4 is not 2."""
    out = held_out("doc_id", 4, 2)
    return language.identify(table(spark, sf_dir, "documents"), ~out).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recurrent language model scores of every text; learns where crc32(doc_id) mod 7 is not 2."""
    out = held_out("doc_id", 7, 2)
    return language_model.scores(table(spark, sf_dir, "documents"), ~out).select(
        "doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules, then empirical-Bayes host reputation, over every page."""
    return url_filters.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold-scaled fingerprints of every text and its edited text."""
    return fingerprints.against_edits(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes and decodes every text with a public vocabulary of the box."""
    return bpe.encoded(table(spark, sf_dir, "documents"), tokenizer_path(), keep_ids=False)


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by 50-byte strings that also start in a document with a smaller id."""
    return substrings.repeats(table(spark, sf_dir, "documents"), length=50)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Additive quality model over every text; learns where crc32(doc_id) mod 4 is not 2."""
    docs, out = table(spark, sf_dir, "documents"), held_out("doc_id", 4, 2)
    return quality.classify(docs, table(spark, sf_dir, "labels"), ~out).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components on four-word shingles at 80 percent."""
    return minhash_forest.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word windows of the benchmark in every document, found by winnowing."""
    found = decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.col("items").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words of every text (with the contract's planted repeats), and the text with one period of each."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = periodic_runs.runs(table(spark, sf_dir, "documents"), echo=F.when(h % 10 == 0, F.floor(h / 10)))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    told = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))))
    return (found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(told.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of six letters and five occurrences, their near words, forms and roots."""
    return spelling.variants(table(spark, sf_dir, "documents"), typo=199).select("word", "form", "root", "n", "n_near", "form_n")


def op13_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words covered by 20-word windows that also start earlier."""
    found = blocks.repeats(table(spark, sf_dir, "documents"), length=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_language, op3_language_model, op4_url_filters, op5_fingerprints,
                                 op6_bpe, op7_suffix_array, op8_quality, op9_minhash_forest, op10_decontamination, op11_periodic_runs, op12_spelling, op13_blocks)}

#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {"op4_url_filters": oracle_sql.URL_FILTERS, "op7_suffix_array": oracle_sql.SUBSTRINGS,
                              "op9_minhash_forest": oracle_sql.NEAR_DUPLICATES, "op10_decontamination": oracle_sql.DECONTAMINATION,
                              "op11_periodic_runs": oracle_sql.PERIODIC_RUNS, "op12_spelling": oracle_sql.SPELLING, "op13_blocks": oracle_sql.BLOCKS}
