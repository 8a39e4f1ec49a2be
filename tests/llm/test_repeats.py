"""Periodic runs, spelling variants and repeated windows against brute force on small and skewed inputs."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from telemetra.llm import blocks, flat, periodic_runs, spelling
from telemetra.llm.common import table


def naive_runs(w):
    out, n = [], len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if size >= max(6, 4 * q) and not any(s <= i and s + k >= i + size and q % p == 0 for s, k, p in out):
                out.append((i, size, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def found_runs(texts):
    words = np.array([zlib.crc32(str(x).encode()) for w in texts for x in w], flat.U64)
    first = np.concatenate([[0], np.cumsum([len(w) for w in texts])]).astype(int)
    out = [[] for _ in texts]
    for s, k, q in zip(*map(np.ndarray.tolist, periodic_runs.find(words, first)), strict=True):
        at = int(np.searchsorted(first, s, "right")) - 1
        out[at].append((s - int(first[at]), k, q))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1), max_size=60), min_size=1, max_size=4))
def test_runs_of_two_words(texts):
    assert found_runs(texts) == [naive_runs(w) for w in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=13), st.integers(1, 9)), max_size=8))
def test_runs_of_planted_periods(parts):
    w = [x for root, k in parts for x in root * k]
    assert found_runs([w]) == [naive_runs(w)]


def test_nested_and_touching_runs():
    w = [1] * 6 + [2] + ([1] * 6 + [2]) * 5 + [3, 4] * 3 + [5] * 7
    assert found_runs([w]) == [naive_runs(w)]
    assert any(q == 7 for _, _, q in naive_runs(w)) and any(q == 1 for _, _, q in naive_runs(w))


def test_runs_on_the_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    got = {r["doc_id"]: r for r in periodic_runs.runs(docs, echo=F.when(h % 10 == 0, F.floor(h / 10))).collect()}
    planted = 0
    for r in docs.select("doc_id", "text").collect():
        w = (r["text"] or "").encode().split()
        h = zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        want = naive_runs(w) if len(w) < 1500 else None
        row = got[r["doc_id"]]
        runs = [tuple(x) for x in row["runs"]]
        if want is not None:
            assert runs == want
            planted += bool(want)
        gone = {i for s, k, q in runs for i in range(s + q, s + k)}
        assert row["n_words"] == len(w) and row["collapsed"].encode() == b" ".join(x for i, x in enumerate(w) if i not in gone)
    assert planted > 5


def naive_variants(counts):
    words, near = {w: n for w, n in counts.items() if n >= 5}, defaultdict(set)
    for a in words:
        cuts = [a[:i] + a[i + 1:] for i in range(len(a))]
        for c in cuts:
            if c in words:
                near[a].add(c)
                near[c].add(a)
    shapes = defaultdict(set)
    for a in words:
        for i in range(len(a)):
            shapes[a[:i], a[i + 1:]].add(a)
    for group in shapes.values():
        for a in group:
            near[a] |= group - {a}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n, len(near[w]), form[w], words.get(form[w]), root)
    return out


def test_spelling_over_many_leaves(spark, documents, monkeypatch):
    """A small alphabet, where most words are near others, with leaves of a few words."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcà"), rng.integers(6, 9))) for _ in range(1500)]
    counts = Counter({w: int(5 * 3 ** rng.integers(0, 6)) for w in words})
    rows = [(i, " ".join(w for w in part for _ in range(counts[w]))) for i, part in enumerate(np.array_split(sorted(counts), 20))]
    monkeypatch.setattr(spelling, "LEAF_LETTERS", 200)
    got = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in spelling.variants(documents(rows)).collect()}
    want = naive_variants(counts)
    assert got == want
    assert sum(v[4] not in (v[2], k) for k, v in want.items()) > 10 and max(v[1] for v in want.values()) > 5


def test_spelling_typing_errors(spark, documents):
    rows = [(i, "spelling variants grouping " * 3) for i in range(200)]
    got = {r["word"]: r["n"] for r in spelling.variants(documents(rows), typo=7).collect()}
    want = Counter()
    for i, _ in rows:
        for w in ("spelling", "variants", "grouping"):
            h = zlib.crc32(f"{i}:{w}".encode())
            want[w if h % 7 else w[:h % len(w)] + w[h % len(w) + 1:]] += 3
    assert got == {w: n for w, n in want.items() if n >= 5}


def naive_removed(rows, length):
    seen, out = {}, {}
    for i, text in sorted(rows):
        w = (text or "").encode().split()
        gone = set()
        for s in range(len(w) - length + 1):
            v = tuple(w[s:s + length])
            if v in seen:
                gone |= set(range(s, s + length))
            seen.setdefault(v, i)
        out[i] = (len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode())
    return out


def test_blocks_against_brute_force(spark, documents):
    rng = np.random.default_rng(5)
    passage = [f"p{i}" for i in range(120)]
    rows = [(0, " ".join(passage))]
    for i in range(1, 150):
        w = [f"w{x}" for x in rng.integers(0, 6 if i % 10 == 0 else 400, rng.integers(0, 200))]
        if i % 3 == 0:  # a third of the documents hold a stretch of one passage, at any offset
            a = int(rng.integers(0, 90))
            at = int(rng.integers(0, len(w) + 1))
            w[at:at] = passage[a:a + int(rng.integers(15, 60))]
        rows.append((i, " ".join(w)))
    rows += [(150, rows[7][1]), (151, None), (152, "a b " * 40), (153, "A B " * 40)]
    for length in (20, 7, 1):
        got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in blocks.repeats(documents(rows), length).collect()}
        assert got == naive_removed(rows, length)


def test_numbers_survive_their_bytes():
    x = np.array([0, 1, 255, 256, 1 << 40, (1 << 64) - 1], flat.U64)
    assert (blocks.unplanes(blocks.planes(x)) == x).all()
    f = np.array([1, 0, 1, 1, 0, 0, 0, 1, 1], bool)
    assert (blocks.unbits(blocks.bits(f), 9) == f).all()
