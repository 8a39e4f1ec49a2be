"""Operators against brute force and the tokenizer library on small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from array import array
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from telemetra.llm import components, decontaminate, fingerprints, flat, induced, language, language_model, minhash_forest, quality, substrings, toxicity
from telemetra.llm import queries as Q
from telemetra.llm.bpe import Vocabulary
from telemetra.llm.common import table
from telemetra.llm.language_model import Network


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return {r[0]: r[1] for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()}


def result(spark, sf_dir, name):
    return {r["doc_id"]: r for r in Q.QUERIES[name](spark, sf_dir).collect()}


def rest(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_op1_and_op8_hold_out_and_learn(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")  # enough labels to learn from
    truth = {r["doc_id"]: r for r in table(spark, sf_dir, "labels").collect()}
    for name, label, n, k, least in (("op1_toxicity", "toxic", 3, 1, 0.9), ("op8_quality", "quality", 4, 2, 0.9)):
        got = result(spark, sf_dir, name)
        assert all(r["held_out"] == (rest(i, n) == k) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for i, r in got.items())
        known = [(got[i]["predicted"], t[label]) for i, t in truth.items() if i in got and got[i]["held_out"] and t[label] is not None]
        assert sum(a == b for a, b in known) >= least * len(known)


def test_op2(spark, sf_dir):
    truth = {r[0]: r[1] for r in table(spark, sf_dir, "documents").select("doc_id", "lang").collect()}
    got = result(spark, sf_dir, "op2_language")
    assert all(r["held_out"] == (rest(i, 4) == 2) for i, r in got.items())
    out = [i for i, r in got.items() if r["held_out"]]
    assert sum(got[i]["lang_pred"] == truth[i] for i in out) >= 0.97 * len(out)


def test_language_counts_and_backoff(spark, documents):
    d = documents([(1, "the cat the dog", "en"), (2, "le chat le chien", "fr"), (3, "zzz", None), (4, "the", "en")])
    learned = language.learn(d)
    words = {(x[1], x[2]): x[3] for x in learned if x[0] == 0}
    assert words["en", "the"] == pytest.approx(math.log(3 / 5)) and words["fr", "chat"] == pytest.approx(math.log(1 / 4))
    model = language.Model(learned)
    assert model.predict("chats")[0] == "fr" and model.predict("12 !")[0] == "und" and model.predict(None) == ("und", 0.0)


def test_op3(spark, sf_dir, docs):
    def tokens(t):
        return [*(t or "").encode().lower().split(), None]
    count = Counter()
    for i, t in docs.items():
        if rest(i, 7) != 2:
            count.update(tokens(t))
    n, v = sum(count.values()), len(count)
    got = result(spark, sf_dir, "op3_language_model")
    for i, t in docs.items():
        own, r = tokens(t), got[i]
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(own), sum(w in count for w in own), n, rest(i, 7) == 2)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    assert sum(r["score"] for r in got.values()) > sum(r["base_score"] for r in got.values())


def test_network_gradients_and_normalisation():
    net, rng = Network([3, 5], tails=2), np.random.default_rng(0)
    net.p = {k: x.astype(np.float64) for k, x in net.p.items()}
    ids, h0, before = rng.integers(0, 10, (4, 3)), rng.normal(0, 1, (3, 16)), rng.integers(0, 10, 3)
    grads, _, loss = net.window_gradients(ids, h0, before)
    for key in ("E", "W", "U", "b", "C", "O"):
        at = np.unravel_index(int(np.argmax(np.abs(grads[key]))), grads[key].shape)
        net.p[key][at] += 1e-5
        assert (net.window_gradients(ids, h0, before)[2] - loss) / 1e-5 == pytest.approx(grads[key][at], rel=1e-2)
        net.p[key][at] -= 1e-5
    assert np.exp([net.log_probs(h0[:1], np.array([k]))[0] for k in range(10)]).sum() == pytest.approx(1)


def test_state_runs_through_windows():
    net = Network([4], tails=1)
    ids = np.random.default_rng(0).integers(0, 5, 300)
    got = net.score(ids, np.array([0, 200, 200, 300]), 0)
    h, total = np.zeros((1, 16), np.float32), 0.0
    for before, x in zip([0, *ids[:199]], ids[:200], strict=True):
        h = net.step(net.inputs()[[before]], h)[0]
        total += net.log_probs(h, np.array([x]))[0]
    assert got[0] == pytest.approx(total, rel=1e-4) and got[1] == 0


def test_scoring_steps_are_small_and_texts_score_alike(monkeypatch):
    """However many texts are scored, a step works on some hundreds of them, and each scores as on its own."""
    net, rng, lanes = Network([1, 4, 6], tails=2), np.random.default_rng(0), []
    n = rng.integers(1, 40, 2000)
    n[[3, 700]] = 900, 0
    bounds, step = np.concatenate([[0], np.cumsum(n)]), net.step
    ids = rng.integers(0, 13, bounds[-1])
    monkeypatch.setattr(net, "step", lambda x, h: lanes.append(len(h)) or step(x, h))
    got = net.score(ids, bounds, 0)
    assert max(lanes) <= 512 and sum(lanes) == len(ids) and got[700] == 0
    for k in (0, 3, 1200, 1999):
        assert net.score(ids[bounds[k]:bounds[k + 1]], np.array([0, n[k]]), 0)[0] == pytest.approx(got[k], rel=1e-4)
    assert len(net.score(ids[:0], np.array([0]), 0)) == 0


@pytest.mark.parametrize("where", ["late ids", "late words"])
def test_network_learns_from_all_learning_tokens(spark, documents, where):
    """What stands only in texts of the largest ids, or only beyond word 800, trains the network too."""
    rng = np.random.default_rng(0)
    noise = lambda n: " ".join(f"w{k}" for k in rng.integers(0, 200, n))
    rows = ([(i, noise(800)) for i in range(520)] + [(i, "ping pong " * 400) for i in range(520, 620)] if where == "late ids" else
            [(i, noise(800) + " ping pong" * 400) for i in range(100)])
    got = language_model.scores(documents([*rows, (1000, "ping pong " * 100)]), F.col("doc_id") < 1000).filter("doc_id = 1000").first()
    assert got["score"] > 0.4 * got["base_score"]


def test_training_lanes():
    """Every token trains once, and a step's gradients are those of each text on its own."""
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 10, n) for n in (5, 40, 1, 17, 33, 16)]
    net = Network([3, 5], tails=2)
    assert net.train(iter(texts), 0, batch=2) == sum(map(len, texts)) and net.train(iter([]), 0) == 0
    net.p = {k: x.astype(np.float64) for k, x in net.p.items()}
    a, b, pad = texts[0], texts[3][:6], np.zeros(5, int)
    zero, fresh = np.zeros((1, 16)), np.zeros((16, 1), bool)
    fresh[[0, 5]] = True
    live = np.arange(16)[:, None] < 11
    together = net.window_gradients(np.concatenate([a, b, pad])[:, None], zero, np.array([0]), fresh, live)[0]
    apart = [net.window_gradients(x[:, None], zero, np.array([y]))[0] for x, y in ((a, 0), (b, a[-1]))]
    assert all(np.allclose(together[k], apart[0][k] + apart[1][k]) for k in together)


def test_op5(spark, sf_dir, docs):
    got, ids = result(spark, sf_dir, "op5_fingerprints"), sorted(docs)
    for i, after in zip(ids, [*ids[1:], ids[0]], strict=True):
        a, b, r = docs[i] or "", docs[after] or "", got[i]
        half = len(a) // 2
        assert r["n_chars"] == len(a)
        assert r["edited_sha256"] == hashlib.sha256((a[:len(a) - half] + b[:half]).encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (r["fingerprint"] == got[after]["fingerprint"]) == (r["near_next"] == 1.0)
    assert sum(r["near_edited"] > r["near_next"] for r in got.values()) > 0.85 * len(got)


def test_likeness_against_exact_overlap(spark, documents):
    """Estimates are near the overlap of the full shingle sets, short texts (from 24 words) included."""
    rng = np.random.default_rng(5)
    texts = {i: " ".join(f"w{k}" for k in rng.integers(0, 10**6, n)) for i, n in enumerate([24, 30, 40, 56, 80, 150, 240, 500] * 25)}

    def exact(a, b):
        x, y = ({tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for t in (a, b))
        return len(x & y) / len(x | y), len(x | y)
    got = {r["doc_id"]: r for r in fingerprints.against_edits(documents(list(texts.items()))).collect()}
    for i, a in texts.items():
        b, r = texts[(i + 1) % len(texts)], got[i]
        half = len(a) // 2
        for value, (true, n) in ((r["near_edited"], exact(a, a[:len(a) - half] + b[:half])), (r["near_next"], exact(a, b))):
            assert (value > 0) == (true > 0) and abs(value - true) < 5 * (true * (1 - true) * 2 / n) ** 0.5 + 1e-9


def test_sketch_estimates_containment(spark, documents):
    rng = np.random.default_rng(0)
    long = [f"w{k}" for k in rng.integers(0, 5000, 40_000)]
    d = fingerprints.fingerprints(documents([(1, " ".join(long)), (2, " ".join(long[5000:9000]))])).collect()
    a, b = (set(r["kept"]) for r in sorted(d, key=lambda r: r["doc_id"]))
    assert len(b & a) / len(b) == 1 and len(b) == pytest.approx(4000 / fingerprints.SCALE, rel=0.25)


def test_op6(spark, sf_dir, docs):
    from tokenizers import Tokenizer
    reference = Tokenizer.from_file(Q.tokenizer_path())
    got = result(spark, sf_dir, "op6_bpe")
    for i, t in docs.items():
        ids = reference.encode(t or "", add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids_sha256"] == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(reference.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_on_odd_texts():
    from tokenizers import Tokenizer
    reference, own = Tokenizer.from_file(Q.tokenizer_path()), Vocabulary(open(Q.tokenizer_path(), encoding="utf-8").read())

    @settings(max_examples=300, deadline=None)
    @given(st.text(st.sampled_from("aàbcdeAÉ '’slm<|endoftxsar>12Ⅳ½\t\n\x1c\x85  é́Σσςİǅßẞﬁ日本😀‍-_.!?")))
    def same(text):
        ids = reference.encode(text, add_special_tokens=False).ids
        assert array("I", own.encode(text)).tolist() == ids
        assert own.decode(own.encode(text)) == reference.decode(ids, skip_special_tokens=False)
    same()
    for text in ("<|endoftext|>a<|startoftext|>", "x" * 3000, "don't we'll", ""):
        assert array("I", own.encode(text)).tolist() == reference.encode(text, add_special_tokens=False).ids


def cut(rows, length):
    first, out = {}, {}
    for i, data in sorted(rows):
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            if first.setdefault(data[s:s + length], i) < i:
                gone[s:s + length] = b"\1" * length
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_op7(spark, sf_dir, docs):
    want = cut([(i, (t or "").encode()) for i, t in docs.items()], 50)
    got = result(spark, sf_dir, "op7_suffix_array")
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == want


@pytest.mark.parametrize("length", [1, 3, 8])
def test_substrings_of_a_small_alphabet(spark, documents, length):
    rng = np.random.default_rng(length)
    rows = [(int(i), "".join(rng.choice(list("abé"), int(rng.integers(0, 40))))) for i in range(60)] + [(99, "ab" * 50), (100, "ab" * 49)]
    want = cut([(i, t.encode()) for i, t in rows], length)
    got = substrings.repeats(documents(rows), length).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=80), st.booleans())
def test_suffix_array_and_prefixes(items, twice):
    s = np.array(items * (2 if twice else 1), np.uint8)
    sa, data = induced.suffix_array(s), s.tobytes()
    assert list(sa) == sorted(range(len(s)), key=lambda i: data[i:])
    if len(s) > 1:
        plcp = induced.common_prefixes(s, sa, 7)
        for a, b in zip(sa[:-1], sa[1:], strict=True):
            x, y = data[a:a + 7], data[b:b + 7]
            assert plcp[b] == next((k for k, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))


def brute_components(docs, size, percent):
    sets = {}
    for i, t in docs.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    up = {i: i for i in docs}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = sorted(i for i in docs if sets[i])
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if min(len(sets[i]), len(sets[j])) * 100 >= percent * max(len(sets[i]), len(sets[j])):
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    a, b = root(i), root(j)
                    up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in docs}


def test_op9(spark, sf_dir, docs):
    got = result(spark, sf_dir, "op9_minhash_forest")
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == brute_components(docs, 4, 80)
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_texts_without_words_before_short_texts(spark, documents):
    rows = [(20, ""), (1, "one two"), (21, None), (2, "a a a a a a a"), (22, " \n"), (11, "one two"), (23, None), (24, ""), (3, "three")]
    got = minhash_forest.near_duplicates(documents(rows).coalesce(1)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(dict(rows), 5, 80)
    assert {r["doc_id"] for r in got if not r["kept"]} == {11}


@pytest.mark.parametrize("parts", [1, 4])
def test_an_id_with_several_texts_unites_them(spark, documents, parts):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(1, a), (2, b), (2, a + " z"), (3, b + " z"), (5, c), (6, ""), (6, c), (6, None), (7, ""), (8, "d e f"), (9, None), (9, None)]
    got = minhash_forest.near_duplicates(documents(rows).repartition(parts)).collect()
    assert len(got) == len(rows)
    found = {}
    for r in got:
        if r["n_shingles"]:
            assert found.setdefault(r["doc_id"], r["component_id"]) == r["component_id"]
        else:
            assert r["component_id"] == r["doc_id"]
    assert found == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5, 8: 8}


def test_groups_larger_than_a_block(spark, documents, monkeypatch):
    monkeypatch.setattr(minhash_forest, "BLOCK_WEIGHT", 9000)
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(90):
        w = list(base)
        for k in rng.integers(0, 120, int(rng.integers(0, 5))):
            w[k] = f"x{rng.integers(0, 10**6)}"
        rows.append((i, " ".join(w)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash_forest.near_duplicates(documents(rows)).collect()}
    assert got == brute_components(dict(rows), 5, 80)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(300, k) for k in range(301, 340)] + [(500, 500), (601, 600), (600, 601)]
    got = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {k: 300 for k in range(300, 340)} | {600: 600, 601: 600}


def windows(words, size=10):
    return [tuple(words)] if 0 < len(words) < size else [tuple(words[k:k + size]) for k in range(len(words) - size + 1)]


def brute_hits(docs, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: word.findall((t or "").translate(lower))
    index = {}
    for i, t in items:
        for w in windows(split(t)):
            index.setdefault(w, set()).add(str(i))
    sizes, out = sorted({len(w) for w in index}), {}
    for i, t in docs.items():
        words, hit, named = split(t), set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                if (got := index.get(tuple(words[k:k + n]))) is not None:
                    hit.update(range(k, k + n))
                    named |= got
        out[i] = (len(words), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit))
    return out


def test_op10(spark, sf_dir, docs):
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").collect()]
    got = result(spark, sf_dir, "op10_decontamination")
    assert {i: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for i, r in got.items()} == brute_hits(docs, items)


def test_short_items_and_common_grams(spark, documents):
    rng = np.random.default_rng(1)
    text = lambda n: " ".join(rng.choice(["a", "b", "Ç", "d"], n))
    rows = [(i, text(int(rng.integers(0, 60)))) for i in range(80)]
    items = [(k, text(n)) for k, n in enumerate([3, 4, 9, 10, 11, 25, 0])] + [(50, None), (51, "A b"), (52, rows[3][1])]
    got = decontaminate.hits(documents(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute_hits(dict(rows), items)
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], hashlib.sha256(r["items"].encode()).hexdigest(), r["n_hit"] > 0)
            for r in got} == want


def test_toxic_lexicon_and_label_model(spark, documents):
    rng = np.random.default_rng(0)
    clean = lambda: " ".join(f"w{k}" for k in rng.integers(0, 300, 60))
    rows, labels = [], []
    for i in range(240):
        bad = i % 6 == 0
        rows.append((i, clean() + (" badword! vileness badword" if bad else "")))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, 1, int(bad)))
    from pyspark.sql import functions as F
    got = toxicity.classify(documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), F.lit(True)).collect()
    assert all((r["score"] >= 0.7) == (r["doc_id"] % 6 == 0) for r in got)


def test_rare_labels_are_all_learned_from(spark, documents, monkeypatch):
    """Labels few against the documents, and a sample far smaller than these, still teach the model."""
    monkeypatch.setattr(toxicity, "SAMPLE", 40)
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(3000):
        bad = i % 10 == 0
        rows.append((i, " ".join(f"w{k}" for k in rng.integers(0, 300, 40)) + (" vileness badword vileness" if bad else "")))
        if i % 20 == 0 or i % 60 == 1:
            labels.append((i, 1, int(bad)))
    got = toxicity.classify(documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), F.lit(True)).collect()
    assert all((r["score"] >= 0.7) == (r["doc_id"] % 10 == 0) for r in got)


def test_many_rare_toxic_words(spark, documents):
    """Each toxic text has one of 130 words; none is in three percent of them."""
    rng = np.random.default_rng(2)
    name = lambda k: "".join(chr(97 + int(d)) for d in f"{k:05d}")
    rows, labels = [], []
    for i in range(9000):
        bad = i % 3 == 0
        w = ["w" + name(k) for k in rng.integers(0, 300, 40)]
        if bad:
            w[int(rng.integers(0, 40))] = name(7000 + 89 * int(rng.integers(0, 130)))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    got = toxicity.classify(documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), F.lit(True)).collect()
    assert sum(r["score"] >= 0.7 for r in got if r["doc_id"] % 3 == 0) >= 2700
    assert not sum(r["score"] >= 0.7 for r in got if r["doc_id"] % 3)


def test_additive_model_finds_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.Additive().fit(x[:2000], y[:2000])
    assert ((model.predict(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9


def test_flat_words_match_bytes_split():
    import pyarrow as pa
    rows = ["", None, " a  B\tc\x0b", "é É x", "one", "x" * 10]
    data, off = flat.texts(pa.array(rows))
    hashes, first = flat.word_hashes(data, off)
    got = [len(hashes[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    assert got == [len((t or "").encode().split()) for t in rows]


def test_pipeline_against_brute_force(spark, sf_dir, docs):
    """Every stage on its own input, then the rows of run()."""
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").collect()]
    stages = dict(corpus_pipeline.STAGES)
    every = table(spark, sf_dir, "documents")
    first = stages["language"](spark, every, sf_dir)
    assert first.count() == sum(bool(re.search(r"[^\W\d_]", t or "")) for t in docs.values())
    second = {r["doc_id"]: r["text"] for r in stages["near-duplicates"](spark, first, sf_dir).collect()}
    own = {r["doc_id"]: r["text"] for r in first.collect()}
    assert set(second) == {i for i, (_, c) in brute_components(own, 5, 80).items() if c == i}
    third = {r["doc_id"]: r["text"] for r in stages["repeats"](spark, first.filter(first.doc_id.isin(list(second))), sf_dir).collect()}
    sha = {i: v[3] for i, v in cut([(i, t.encode()) for i, t in second.items()], corpus_pipeline.REPEAT_BYTES).items()}
    whole = [i for i, t in third.items() if hashlib.sha256(t.encode()).hexdigest() == sha[i]]
    assert len(whole) > 0.95 * len(third)  # the rest was cut within a character
    fourth = {i for i, v in brute_hits(third, items).items() if not v[4]}
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).collect()} == fourth


def test_numbers_are_not_letters():
    assert language.letters("½ Ⅳ ² 12a3 été_x 日本 ①b") == ["a", "été", "x", "日本", "b"]


def test_large_outputs_do_not_overflow():
    """Outputs far beyond exp's range still give probabilities that add up, with and without gradients."""
    net = Network([3, 5], tails=2)
    net.p = {k: (x * 4000).astype(np.float32) if k in ("C", "O") else x for k, x in net.p.items()}
    h = np.tanh(np.random.default_rng(0).normal(0, 3, (1, 16))).astype(np.float32)
    assert np.exp([net.log_probs(h, np.array([k]))[0] for k in range(10)]).sum() == pytest.approx(1, rel=1e-4)
    grads = {k: np.zeros_like(x) for k, x in net.p.items()}
    assert np.isfinite(net.log_probs(h, np.array([7]), grads)).all() and all(np.isfinite(x).all() for x in grads.values())


def test_tokens_whose_counts_the_tasks_hold(spark, documents, monkeypatch):
    """Counts give the same scores held by the tasks or joined; those held take no part in the join."""
    rows = [(i, " ".join(f"w{i * 7 % k}" for k in range(1, 60))) for i in range(40)]
    monkeypatch.setattr(language_model, "SHORT", 5)
    found, joined = [], []
    keep = language_model.stored
    monkeypatch.setattr(language_model, "stored", lambda df, name: joined.append((name, got := keep(df, name))) or got)
    for held in (0, 10, 1000):
        monkeypatch.setattr(language_model, "NEXT", held)
        got = language_model.scores(documents(rows).coalesce(1), F.col("doc_id") % 3 > 0).collect()
        found.append({r["doc_id"]: (r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got})
    for other in found[1:]:
        assert all(other[i] == pytest.approx(found[0][i], rel=1e-5) for i in found[0])
    rare = [df.agg(F.sum(F.size("rare"))).first()[0] for name, df in joined if name == "scored"]
    assert rare[0] > rare[1] > rare[2]


def test_forest_steps_have_one_python_worker_and_merge_texts(spark, documents, monkeypatch):
    """No task runs two Python steps at once, and texts meet their groups by a merge however few the groups are."""
    plans, keep = [], (minhash_forest.components, minhash_forest.confirmed)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(minhash_forest, "components", lambda edges: plans.append(("edges", plan(edges))) or keep[0](edges))
    monkeypatch.setattr(minhash_forest, "confirmed", lambda texts, *a: plans.append(("texts", plan(texts))) or keep[1](texts, *a))
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, text), (2, text + " x"), (3, "a b c d e f")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash_forest.near_duplicates(documents(rows)).collect()}
    assert got == brute_components(dict(rows), 5, 80)
    assert [n for n, _ in plans] == ["edges", "texts", "edges"]
    assert not any("InArrow" in p for n, p in plans if n == "edges")
    assert "BroadcastHashJoin" not in plans[1][1] and "SortMergeJoin" in plans[1][1]
