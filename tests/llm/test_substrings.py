"""Suffix arrays of wanted starts, and how much work and how many messages substring deduplication needs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from telemetra.llm import flat, induced, substrings


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(1, 12), st.booleans()), max_size=40), st.integers(1, 20),
       st.sampled_from([0, 1, 251, 252, 1000]), st.sampled_from([2, 1024]))
def test_wanted_suffixes_come_in_order(items, depth, low, buckets):
    s = np.array([low * (v > 0) + v for v, n, _ in items for _ in range(n)], np.int64)
    wanted = np.array([w for _, n, w in items for _ in range(n)], bool)
    had, induced.MOST_BUCKETS = induced.MOST_BUCKETS, buckets
    try:
        whole, some, all_ = induced.suffix_array(s, None, wanted), induced.suffix_array(s, depth, wanted), induced.suffix_array(s)
    finally:
        induced.MOST_BUCKETS = had
    chars = s.tolist()
    assert all_.tolist() == sorted(range(len(chars)), key=lambda i: chars[i:])
    assert whole.tolist() == [i for i in all_.tolist() if wanted[i]]
    assert sorted(some.tolist()) == np.flatnonzero(wanted).tolist()
    heads = [chars[i:i + depth] for i in some.tolist()]
    assert heads == sorted(heads)


def runs(rng, n, length):
    """Runs of 1 to 34 strings, one of three a copy of a part of another."""
    out = [rng.choice(list(b"abcdefgh   "), length - 1 + int(rng.integers(1, 35))).astype(np.uint8) for _ in range(n)]
    for i in range(2, n, 3):
        out[i][:length] = out[i - 1][:length]
    return out


def test_suffixes_that_start_no_string_are_not_sorted(monkeypatch):
    rng, placed = np.random.default_rng(0), []
    induce = induced.induce
    monkeypatch.setattr(induced, "induce", lambda *a: placed.append(len(out := induce(*a))) or out)
    found, docs, length = runs(rng, 600, 50), rng.integers(0, 50, 600), 50
    data = np.concatenate(found)
    got, bounds = substrings.answer(data, np.array([len(r) for r in found]), docs, length)
    least: dict[bytes, int] = {}
    strings = [(r[k:k + length].tobytes(), int(d)) for r, d in zip(found, docs, strict=True) for k in range(len(r) - length + 1)]
    for s, d in strings:
        least[s] = min(d, least.get(s, d))
    assert got.tolist() == [least[s] for s, _ in strings] and bounds[-1] == len(strings)
    assert 0 < sum(placed) < len(data) / 2


@pytest.mark.parametrize("held", [1 << 20, 1])
def test_shards_of_a_task_answer_in_one_row_a_pack(monkeypatch, held):
    rng, length, packs = np.random.default_rng(1), 20, 5
    found = runs(rng, 400, length)
    rows = sorted((i, r.tobytes(), int(rng.integers(0, packs)), i, d) for i, r in enumerate(found) for d in rng.choice(50, 2, replace=False).tolist())
    table = pa.table([pa.array(c, k) for c, k in zip([*zip(*rows, strict=True), [True] * len(rows)], [f.type for f in substrings._SENT], strict=True)], schema=substrings._SENT)

    def told():
        out = list(substrings._shards(length)(iter(table.to_batches(max_chunksize=100))))
        seen = sorted((row["pack"], *x) for b in out for row in b.to_pylist()
                      for x in zip(*(np.frombuffer(row[c], np.int64 if c == "least" else np.int32).tolist() for c in substrings._ANSWER), strict=True))
        return sum(len(b) for b in out), seen

    whole = told()
    monkeypatch.setattr(substrings, "SHARD_BYTES", 1000)
    monkeypatch.setattr(substrings, "ANSWERS", held)
    number, seen = told()
    assert {x[:2] for x in seen} == {(r[2], r[3]) for r in rows}
    assert whole[0] == packs and (number == packs if held > 1 else number > packs)
    if held == 1:
        monkeypatch.setattr(substrings, "ANSWERS", 1 << 20)
        assert seen == told()[1]


def test_runs_against_brute_force():
    rng = np.random.default_rng(2)
    for length in (1, 2, 7, 20):
        texts = [rng.choice(list(b"ab "), int(n)).astype(np.uint8) for n in rng.choice([0, 0, 1, 5, length - 1, length, 60], 40)]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
        first, last, doc, anchor, _ = substrings.runs_of(np.concatenate(texts), offsets, length)
        starts = [int(p) for a, b in zip(first, last, strict=True) for p in range(a, b + 1)]
        assert starts == [int(o) + k for o, t in zip(offsets[:-1], texts, strict=True) for k in range(len(t) - length + 1)]
        assert all(offsets[d] <= a and b + length <= offsets[d + 1] for a, b, d in zip(first, last, doc, strict=True))
        of: dict[bytes, set[int]] = {}  # equal strings have equal anchors
        data = np.concatenate(texts).tobytes()
        for a, b, h in zip(first, last, anchor.tolist(), strict=True):
            for p in range(a, b + 1):
                of.setdefault(data[p:p + length], set()).add(h)
        assert all(len(h) == 1 for h in of.values())


def test_short_slices_give_the_same_runs():
    rng = np.random.default_rng(3)
    texts = [None, "", *("".join(rng.choice(list("abé "), int(n))) for n in rng.integers(0, 300, 200))]
    data, offsets = flat.texts(pa.array(texts))
    whole = substrings.runs_of(data, offsets, 20)[3]
    parts = [substrings.runs_of(d, o, 20)[3] for _, _, d, o in flat.slices(data, offsets, 500)]
    assert len(parts) > 20 and np.concatenate(parts).tolist() == whole.tolist()
