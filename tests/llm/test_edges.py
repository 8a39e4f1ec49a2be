"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing extra columns, for every operator."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from telemetra.llm import (blocks, bpe, decontaminate, fingerprints, language, language_model, minhash_forest, periodic_runs, quality, spelling,
                           substrings, toxicity, url_filters)
from telemetra.llm.queries import tokenizer_path

from .conftest import ODD

LABELS = "doc_id long, quality int, toxic int"
BENCHMARK = "item_id long, text string"


def labels(spark, rows):
    return spark.createDataFrame(rows, LABELS)


def benchmark(spark, rows=((1, "one two three four five six seven eight nine ten eleven"), (2, None), (3, ""), (4, "日本語"))):
    return spark.createDataFrame(list(rows), BENCHMARK)


OPERATORS = {
    "toxicity": lambda s, d: toxicity.classify(d, labels(s, [(1, 1, 1), (2, None, None), (6, 0, 0), (None, 1, 1)]), F.lit(True)),
    "language": lambda s, d: language.identify(d, F.lit(True)),
    "language_model": lambda s, d: language_model.scores(d, F.lit(True)),
    "fingerprints": lambda s, d: fingerprints.against_edits(d),
    "bpe": lambda s, d: bpe.encoded(d, tokenizer_path()),
    "substrings": lambda s, d: substrings.repeats(d, keep_text=True),
    "quality": lambda s, d: quality.classify(d, labels(s, [(1, 1, 1), (6, 0, 0), (7, 1, None), (None, 1, 1)]), F.lit(True)),
    "minhash_forest": lambda s, d: minhash_forest.near_duplicates(d),
    "decontaminate": lambda s, d: decontaminate.hits(d, benchmark(s)),
    "periodic_runs": lambda s, d: periodic_runs.runs(d, echo=F.col("doc_id")),
    "blocks": lambda s, d: blocks.repeats(d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, documents, name):
    assert OPERATORS[name](spark, documents([])).count() == 0


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_and_repeated_rows(spark, documents, name):
    rows = [*ODD, (4, "one"), (12, None, "en"), (13, "the one and the other", "en"), (14, "le un et la une", "fr")]
    got = OPERATORS[name](spark, documents(rows)).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
    by_id = {}
    for r in got:  # a repeated row gets the result of its first copy
        assert by_id.setdefault(r["doc_id"], r.asDict()) == r.asDict()


@pytest.mark.parametrize("name", sorted(set(OPERATORS) - {"minhash_forest"}))
def test_null_id(spark, documents, name):
    got = OPERATORS[name](spark, documents([(None, "one two"), (1, "one two"), (2, None)])).collect()
    assert len(got) == 3


def test_near_duplicates_leave_null_ids_out(spark, documents):
    got = minhash_forest.near_duplicates(documents([(None, "one two"), (2, "one two"), (1, "one two")])).collect()
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got} == {(1, 1, True), (2, 1, False)}


def test_spelling(spark, documents):
    assert spelling.variants(documents([])).count() == 0
    assert spelling.variants(documents([(1, None), (2, ""), (3, "12 !"), (None, "abcdef " * 4)])).count() == 0
    long = "q" * 20_000
    got = spelling.variants(documents([(1, "Kitten kitten kITTEN"), (1, "kitten kitten"), (None, "kitten " * 30), (2, "mitten-mitten mitten mitten mitten"),
                                       (3, "kittens " * 5), (4, f"{long} " * 5 + f"{long}q " * 25), (5, None), (6, "ÀÀÀÀÀÀ " * 5)]), typo=1 << 40).collect()
    by = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in got}
    assert by == {"kitten": (35, 2, None, None, "kitten"), "mitten": (5, 1, "kitten", 35, "kitten"), "kittens": (5, 1, "kitten", 35, "kitten"),
                  long: (5, 1, long + "q", 25, long + "q"), long + "q": (25, 1, None, None, long + "q"), "ÀÀÀÀÀÀ": (5, 0, None, None, "ÀÀÀÀÀÀ")}


def test_blocks_rows_with_one_id(spark, documents):
    """Rows that repeat an id are judged against smaller ids and themselves only; a null id is the largest."""
    a = " ".join(f"w{i}" for i in range(25))
    got = [(r["doc_id"], r["n_removed"]) for r in blocks.repeats(documents([(2, a), (2, a), (1, "x"), (None, a), (3, f"{a} y {a}")])).collect()]
    assert sorted(got, key=str) == [(1, 0), (2, 0), (2, 0), (3, 50), (None, 25)]


def test_urls(spark):
    pages = spark.createDataFrame([(1, "http://a.ORG/x?y#z", "h", 1), (2, None, "h", 1), (3, "no scheme", "h", 1), (4, "://", None, 1),
                                   (5, "s://org", "h", 1), (5, "s://org", "h", 1), (6, "http://x.example.org/es/1", "", 2),
                                   (7, "http://notexample.org/es/", "", 2), (8, "http://a.com/de/" + "x" * 50_000, "", 2),
                                   (9, "http://a.net/x://y", "", 2), (None, "http://u.com#f", "", 2)], "page_id long, url string, html string, n int")
    got = url_filters.judge(pages).collect()
    assert len(got) == 11
    by = {r["page_id"]: (r["host"], r["path"][:20], r["rule"]) for r in got}
    assert by == {1: ("a.org", "/x", "org/"), 2: ("", "", None), 3: ("", "", None), 4: ("", "", None), 5: ("org", "", None),
                  6: ("x.example.org", "/es/1", "example.org/es/"), 7: ("notexample.org", "/es/", "org/"),
                  8: ("a.com", "/de/" + "x" * 16, "com/de/"), 9: ("a.net", "/x://y", None), None: ("u.com", "", None)}
    assert {r["verdict"] for r in got} <= {"allow", "block"}
    assert url_filters.judge(pages.limit(0)).count() == 0


@pytest.mark.parametrize("stage", range(5))
def test_stage_on_odd_rows(spark, documents, sf_dir, stage):
    name, f = corpus_pipeline.STAGES[stage]
    rows = [*ODD, (13, "the one and the other", "en"), (14, "le un et la une", "fr"), (None, "the two and the others", "en"),
            (13, "the one and the other", "en")]
    docs = documents(rows)
    got = f(spark, docs, sf_dir)
    if stage < 4:
        assert got.columns == docs.columns
    ids = [r["doc_id"] for r in got.collect()]
    kept = set(ids)
    assert ids.count(13) == (1 if name == "near-duplicates" else 2)
    assert kept <= {r[0] for r in rows}
    if name != "language":
        assert 6 in kept
    assert f(spark, docs.limit(0), sf_dir).count() == 0
