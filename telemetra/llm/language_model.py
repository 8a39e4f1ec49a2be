"""Gated recurrent language model with a class-factored softmax.

Tokens are the words of a text, A-Z lower-cased, then one end. Token counts cover all learning
texts (Spark sums them); they give the base score and the model's vocabulary. Its SHORT most frequent
tokens are split into classes by frequency and have their own outputs:

    P(token | state) = P(class | state) * P(token | class, state)

All other tokens fall into a few tail classes by form, in which a token has its share of the
class's count (plus one for each known token and one for the unknown). The network (one GRU layer) is
trained over every token of every learning text, in ROUNDS rounds over disjoint shares of the texts (by the
id's crc32). In a round every partition starts from the same parameters and runs back-propagation, cut
off after WINDOW steps, through its whole texts (BATCH of them side by side, the state handed on from window
to window; a text of more than PIECE tokens trains as several, so that a very long one does not run alone
at the end); Spark then averages the parameters, weighted by tokens. They thus depend a little on
how the rows are dealt to partitions. Scoring runs over whole texts in windows and hands the state
from each window to the next, however long the text.

Only the short list and the counts of the NEXT most frequent tokens are sent to the tasks; counts of all other tokens stay
distributed and meet the texts in a join on token hashes (64 bits), each text and token pre-aggregated.
Null texts are empty: one end token. Rows that repeat an id are scored, and learnt from, each by itself; a null id is
scored like any other. An empty table gives an empty result. A text is held whole by one task.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.llm import flat
from telemetra.llm.common import stored

SHORT, CLASSES, TAILS = 2048, 32, 4
#: Tokens after the short list whose counts the tasks hold, so that they take no part in the join.
NEXT = 1 << 16
HIDDEN, EMBED, WINDOW = 16, 12, 16
ROUNDS, BATCH, STEP = 3, 256, 0.04
#: Tokens of a text that run through training one after another; a longer text goes in several such pieces, side by side.
PIECE = 1024
#: Parameters in a row of the table that Spark averages.
ROW_VALUES = 32
#: Bytes of texts that are split into tokens at once, so that the steps' arrays stay in a processor's cache.
TEXT_BYTES = 1 << 17
#: Texts that are scored side by side are as many as reach one of these: the network takes as many steps for a few as for many.
GROUP_TEXTS, GROUP_TOKENS = 1 << 14, 1 << 22
#: Texts whose steps are worked out at once, and tokens in a window of scoring: the fewer texts are left, the more steps.
LANES, OUTPUTS = 512, 1 << 12
#: Outputs up to this size go to exp as they are: their exponentials, and sums of them, are far from a float's ends.
SAFE = 40.0
#: Hash of the end token.
END = np.uint64(0x5BD1E9955BD1E995)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token hashes with ends, tail class of each, bounds of the texts). A token's tail class is
    told by its last two bits: whether it has non-ASCII bytes and whether it ends in a letter."""
    low = flat._LOWER[data]
    starts, ends, first = flat.words(low, offsets)
    hashes = flat.span_hashes(flat.prefix_sums(low), starts, ends)
    high = np.concatenate([[0], np.cumsum(low >= 128)])
    last = low[ends - 1] if len(ends) else low[:0]
    tail = ((high[ends] > high[starts]) * 1 + ((last < 97) | ((last > 122) & (last < 128))) * 2).astype(np.int8)
    hashes = (hashes & ~np.uint64(3)) | tail.astype(np.uint64)
    at = first[1:]
    return np.insert(hashes, at, END), np.insert(tail, at, np.int8(END & np.uint64(3))), first + np.arange(len(first))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0

    def rows():
        values, counts = held[0]
        return pa.record_batch([pa.array(values.view(np.int64)), pa.array(counts)], names=["token", "n"])

    for batch in batches:
        for _, _, data, off in flat.slices(*flat.texts(batch.column(0))):
            hashes = np.concatenate([tokens(d, o)[0] for _, _, d, o in flat.slices(data, off, TEXT_BYTES)])
            values, counts = np.unique(hashes, return_counts=True)
            held.append((values, counts.astype(np.int64)))
            n += len(values)
            if n > 400_000:
                values, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
                held = [(values, np.bincount(at, np.concatenate([h[1] for h in held])).astype(np.int64))]
                n = len(values)
                if n > 300_000:
                    yield rows()
                    held, n = [], 0
    if held:
        values, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        held = [(values, np.bincount(at, np.concatenate([h[1] for h in held])).astype(np.int64))]
        yield rows()


def token_counts(texts: DataFrame) -> DataFrame:
    """token (hash), n over a column of texts."""
    return texts.mapInArrow(_count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def sigmoid(x: np.ndarray) -> np.ndarray:
    x = np.negative(x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Network:
    """GRU layer, class outputs and outputs within classes; plain numpy, one parameter array each."""

    def __init__(self, sizes: list[int], tails: int = TAILS, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.sizes, self.tails = sizes, tails
        self.start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        n = int(self.start[-1]) + tails
        self.class_of = np.concatenate([np.repeat(np.arange(len(sizes)), sizes), len(sizes) + np.arange(tails)])
        init = lambda *s: rng.normal(0, 0.15, s).astype(np.float32)
        self.p = {"E": init(n, EMBED), "W": init(EMBED, 3 * HIDDEN), "U": init(HIDDEN, 3 * HIDDEN),
                  "b": np.zeros(3 * HIDDEN, np.float32), "C": init(HIDDEN, len(sizes) + tails),
                  "c": np.zeros(len(sizes) + tails, np.float32), "O": init(n, HIDDEN), "o": np.zeros(n, np.float32)}

    def step(self, x: np.ndarray, h: np.ndarray):
        """One step from inputs x (already times W) and state h. Results lie in memory column by column, so that work
        on some of the columns runs through all texts at once; so should x."""
        u = (self.p["U"].T @ h.T).T
        zr = sigmoid(x[:, :2 * HIDDEN] + u[:, :2 * HIDDEN])
        z, r, u = zr[:, :HIDDEN], zr[:, HIDDEN:], u[:, 2 * HIDDEN:]
        cand = r * u
        cand += x[:, 2 * HIDDEN:]
        np.tanh(cand, out=cand)
        new = h - cand
        new *= z
        new += cand
        return new, z, r, cand, u

    def inputs(self) -> np.ndarray:
        return self.p["E"] @ self.p["W"] + self.p["b"]

    @staticmethod
    def exponentials(h: np.ndarray, weights: np.ndarray, pick: np.ndarray, safe: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(exp of the outputs, their sums, log softmax of those picked), a column for each state. ``h`` ends in a row of ones,
        ``weights`` in the outputs' constants. ``pick`` counts through all outputs. Unless ``safe``,
        they are lowered by each column's largest first."""
        e = weights @ h
        own = e.ravel().take(pick)
        if not safe:
            most = e.max(0)
            e -= most
            own = own - most
        np.exp(e, out=e)
        total = np.ones(len(e), e.dtype) @ e
        return e, total, own - np.log(total)

    @staticmethod
    def output_gradients(h: np.ndarray, weights: np.ndarray, pick: np.ndarray, e: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(d(-sum)/d weights, d(-sum)/dh without the ones) of ``exponentials``; ``e`` is overwritten."""
        e.ravel()[pick] -= total
        dh = weights[:, :-1].T @ e
        dh /= total
        return e @ (h / total).T, dh

    def log_probs(self, h: np.ndarray, target: np.ndarray, grads: dict | None = None) -> np.ndarray:
        """log P(class) + log P(token | class) (0 for tail classes); with ``grads``, d(-sum)/dh goes to grads["h"]. ``h``
        (states x HIDDEN) had best lie in memory column by column, as the gradients do."""
        order = np.argsort(self.class_of[target].astype(np.int16), kind="stable")  # states of one class lie together
        target = target[order]
        cls = self.class_of[target]
        sorted_h = np.empty((HIDDEN + 1, len(h)), h.dtype)
        h.T.take(order, 1, sorted_h[:-1], "clip")
        sorted_h[-1] = 1
        h = sorted_h
        weights = np.concatenate([self.p["C"].T, self.p["c"][:, None]], 1)
        every = np.concatenate([self.p["O"], self.p["o"][:, None]], 1)
        ones = np.ones(HIDDEN + 1, h.dtype)  # |h| <= 1, so that no output is beyond the sum of its weights
        safe = np.maximum.reduceat(np.abs(every) @ ones, self.start[:-1]) < SAFE if self.sizes else []
        pick = cls * len(cls) + np.arange(len(cls))
        e, total, got = self.exponentials(h, weights, pick, (np.abs(weights) @ ones).max() < SAFE)
        if grads is not None:
            dw, dh = self.output_gradients(h, weights, pick, e, total)
            grads["C"] += dw[:, :-1].T
            grads["c"] += dw[:, -1]
        cuts = np.searchsorted(cls, np.arange(len(self.sizes) + 1))
        for k, size in enumerate(self.sizes):
            at = slice(cuts[k], cuts[k + 1])
            if size == 1 or at.start == at.stop:  # the only token of a class is certain
                continue
            lo, hi = self.start[k], self.start[k + 1]
            here, weights, n = h[:, at], every[lo:hi], at.stop - at.start
            pick = (target[at] - lo) * n + np.arange(n)
            e, total, own = self.exponentials(here, weights, pick, safe[k])
            got[at] += own
            if grads is not None:
                dw, d = self.output_gradients(here, weights, pick, e, total)
                grads["O"][lo:hi] += dw[:, :-1]
                grads["o"][lo:hi] += dw[:, -1]
                dh[:, at] += d
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        if grads is not None:
            grads["h"] = dh.take(back, 1).T
        return got[back]

    def window_gradients(self, ids: np.ndarray, h0: np.ndarray, before: np.ndarray, fresh: np.ndarray | None = None,
                         live: np.ndarray | None = None) -> tuple[dict, np.ndarray, float]:
        """Gradients over a window of steps (steps x texts), cut off at its start. Where ``fresh``, a text
        begins and the state starts anew; where not ``live``, there is no token any more."""
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        x = np.concatenate([before, ids[:-1].ravel()])
        any_fresh = np.zeros(len(ids), bool) if fresh is None else fresh.any(1)
        # step by step, then column by column, as the steps work; sums over all steps take their columns together
        inputs = np.ascontiguousarray(self.inputs().take(x, 0).reshape(*ids.shape, -1).transpose(0, 2, 1))
        old, new = np.empty((2, len(ids), HIDDEN, len(h0)), h0.dtype)
        together = lambda v: v.transpose(1, 0, 2).reshape(v.shape[1], -1)
        h, kept = h0, []
        for t in range(len(ids)):
            old[t] = h.T
            if any_fresh[t]:
                old[t][:, fresh[t]] = 0
            h, *rest = self.step(inputs[t].T, old[t].T)
            new[t] = h.T
            kept.append([v.T for v in rest])
        there = slice(None) if live is None or live.all() else np.flatnonzero(live.ravel())
        loss = -self.log_probs(together(new)[:, there].T, ids.ravel()[there], g).sum()
        dhs = np.zeros((HIDDEN, len(x)), h0.dtype)
        dhs[:, there] = g.pop("h").T
        dhs = dhs.reshape(HIDDEN, *ids.shape)
        by = np.empty((len(ids), 4 * HIDDEN, len(h0)), h0.dtype)  # of the state's part of the candidate, z, r, the candidate
        u, carry = np.roll(self.p["U"], HIDDEN, 1), 0
        for t in range(len(ids) - 1, -1, -1):
            z, r, cand, part = kept[t]
            by_part, by_z, by_r, by_cand = by[t].reshape(4, HIDDEN, -1)
            d = dhs[:, t] + carry
            carry = d * z
            np.multiply(carry, (old[t] - cand) * (1 - z), out=by_z)
            d -= carry
            np.multiply(d, 1 - cand * cand, out=by_cand)
            np.multiply(by_cand, r, out=by_part)
            np.multiply(by_part, part * (1 - r), out=by_r)
            carry += u @ by[t, :3 * HIDDEN]
            if any_fresh[t]:
                carry[:, fresh[t]] = 0
        by = together(by)
        dx = by[HIDDEN:]
        g["U"] += np.roll(together(old) @ by[:3 * HIDDEN].T, -HIDDEN, 1)
        g["W"] += self.p["E"].take(x, 0).T @ dx.T
        g["b"] += dx.sum(1)
        order = np.argsort(x.astype(np.min_scalar_type(len(self.class_of))), kind="stable")
        fed = x[order]
        first = np.flatnonzero(np.append(True, fed[1:] != fed[:-1]))
        g["E"][fed[first]] = np.add.reduceat((self.p["W"] @ dx).take(order, 1), first, 1).T
        return g, h, loss

    def train(self, texts: Iterator[np.ndarray], end: int, step: float = STEP, batch: int = BATCH) -> int:
        """Adam over all tokens of the texts, ``batch`` texts side by side; as soon as one ends, the next takes
        its lane. Steps are taken each batch * WINDOW tokens, however few lanes are left. Returns the tokens."""
        texts = iter(texts)
        own = [next(texts, None) for _ in range(batch)]
        own = [x for x in own if x is not None]
        at = [0] * len(own)
        h, before = np.zeros((len(own), HIDDEN), np.float32), np.full(len(own), end)
        m = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.p.items()}
        held, n, seen, total = None, 0, 0, 0

        def update():
            norm = np.sqrt(sum(float(np.vdot(v, v)) for v in held.values())) / n
            rate, lift = step / (1 - 0.9 ** seen), (1 - 0.99 ** seen) ** -0.5
            for k, v in held.items():
                v *= 1 / (n * max(1.0, float(norm)))
                a, b = m[k]
                a *= 0.9
                a += 0.1 * v
                b *= 0.99
                v *= v
                v *= 0.01
                b += v
                np.sqrt(b, out=v)
                v *= lift
                v += 1e-8
                np.divide(a, v, out=v)
                v *= rate
                self.p[k] -= v

        while own:
            parts, fresh, live = [], np.zeros((len(own), WINDOW), bool), np.ones((len(own), WINDOW), bool)
            for k, (x, a) in enumerate(zip(own, at, strict=True)):
                if 0 < a <= len(x) - WINDOW:  # most lanes are inside a text
                    parts.append(x[a:a + WINDOW])
                    at[k] = a + WINDOW
                    continue
                t, row = 0, np.full(WINDOW, end, x.dtype)
                while t < WINDOW:
                    if at[k] == len(own[k]):
                        more = next(texts, None)
                        if more is None:
                            live[k, t:] = False
                            break
                        own[k], at[k] = more, 0
                    size = min(WINDOW - t, len(own[k]) - at[k])
                    row[t:t + size] = own[k][at[k]:at[k] + size]
                    fresh[k, t] = not at[k]
                    t, at[k] = t + size, at[k] + size
                parts.append(row)
            ids = np.concatenate(parts).astype(np.int64, copy=False).reshape(-1, WINDOW)
            g, h, _ = self.window_gradients(ids.T, h, before, fresh.T, live.T)
            held = g if held is None else {k: held[k] + v for k, v in g.items()}
            here = int(live.sum())
            n, total, before = n + here, total + here, ids[:, -1]
            if n >= batch * WINDOW:
                seen += 1
                update()
                held, n = None, 0
            left = [k for k in range(len(own)) if at[k] < len(own[k]) or live[k, -1]]  # the others have run out of texts
            if len(left) < len(own):
                own, at, h, before = [own[k] for k in left], [at[k] for k in left], h[left], before[left]
        if n:
            seen += 1
            update()
        return total

    def values(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def take(self, values: np.ndarray) -> None:
        """Sets all parameters from ``values()``."""
        at = 0
        for k, v in self.p.items():
            self.p[k] = values[at:at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size

    def score(self, ids: np.ndarray, bounds: np.ndarray, end: int) -> np.ndarray:
        """Natural log probability of each text (its class and short-list parts); the state starts anew at
        each text and runs through all of its windows."""
        n = np.diff(bounds)
        order = np.argsort(-n, kind="stable")
        out = np.zeros(len(n))
        table = np.ascontiguousarray(self.inputs().T)
        for texts in np.split(order, range(LANES, len(n), LANES)):  # of about one length
            h = np.zeros((len(texts), HIDDEN), np.float32)
            shorter, first = -n[texts], bounds[:-1][texts]
            lo, most = 0, int(n[texts].max(initial=0))
            while lo < most:
                steps = np.arange(lo, min(most, lo + max(1, OUTPUTS // int(np.searchsorted(shorter, -lo, "left")))))
                live = np.searchsorted(shorter, -steps, "left")  # texts with more than t tokens come first
                at = np.concatenate([[0], np.cumsum(live)])
                text = np.arange(at[-1]) - np.repeat(at[:-1], live)
                where = first[text] + np.repeat(steps, live)
                fed = ids[np.maximum(where - 1, 0)]
                if not lo:
                    fed[:live[0]] = end
                x, states = table.take(fed, 1, mode="clip"), np.empty((HIDDEN, at[-1]), np.float32)
                for own, a, b in zip(live.tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                    h = self.step(x[:, a:b].T, h[:own])[0]
                    states[:, a:b] = h.T
                out[texts] += np.bincount(text, self.log_probs(states.T, ids[where]), len(texts))
                lo += len(steps)
        return out


class Model:
    """The short list, the network and the totals that scoring needs."""

    def __init__(self, short: list[tuple[int, int]], n: int, v: int, tails: dict[int, tuple[int, int]],
                 following: Sequence[tuple[int, int]] = ()):
        """``short``: (token, count), most frequent first; ``tails``: class -> (count, tokens) beyond it; ``following``:
        (token, count) of the tokens that come next."""
        self.n, self.v, self.tails = n, v, tails
        values = np.array([s[0] for s in short], np.int64).view(np.uint64)
        shares = np.cumsum([s[1] for s in short]) / max(1, sum(s[1] for s in short))
        cls = np.minimum((np.sqrt(shares) * CLASSES).astype(int), CLASSES - 1) if len(short) else np.zeros(0, int)
        sizes = [int(x) for x in np.bincount(cls, minlength=CLASSES) if x]
        self.sorted, self.place = np.sort(values), np.argsort(values)
        self.counts = np.array([s[1] for s in short], np.int64)
        self.room = np.array([float(sum(tails.get(k, (0, 0))) + 1) for k in range(TAILS)])
        rest = np.array(sorted(following), np.int64).reshape(-1, 2)
        order = np.argsort(rest[:, 0].view(np.uint64))
        self.next, count = rest[order, 0].view(np.uint64), rest[order, 1] + 1
        self.base = np.log10((self.counts + 1) / (n + v + 1))
        self.next_base = np.log10(count / (n + v + 1))
        self.next_tail = np.log10(count / self.room[(self.next & np.uint64(3)).astype(np.int64)])
        self.net = Network(sizes)
        self.end = int(np.flatnonzero(values == END)[0]) if (values == END).any() else len(values)

    def ids(self, hashes: np.ndarray, tail: np.ndarray) -> np.ndarray:
        """Place on the short list, or the tail class after it."""
        if not len(self.sorted):
            return tail.astype(np.int32)
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.place[at], len(self.sorted) + tail.astype(np.int32)).astype(np.int32)


def fit(texts: DataFrame, counts: DataFrame) -> Model:
    """``texts``: text of the learning rows and share, the round (from 0) that trains on it; ``counts``: token, n over them."""
    total = counts.agg(F.sum("n"), F.count("*")).first()
    first = [(r[0], r[1]) for r in counts.orderBy(F.desc("n"), "token").limit(SHORT + NEXT).collect()]
    short, following = first[:SHORT], first[SHORT:]
    by_class = counts.groupBy(F.col("token").bitwiseAND(3).alias("tail")).agg(F.sum("n"), F.count("*")).collect()
    tails = {r[0]: [r[1], r[2]] for r in by_class}
    for token, n in short:
        tails[token & 3][0] -= n
        tails[token & 3][1] -= 1
    model = Model(short, total[0] or 0, total[1], {k: tuple(v) for k, v in tails.items()}, following)

    for k in range(ROUNDS):
        _round(texts.filter(F.col("share") == k), model, STEP / (1 + k))
    return model


def _round(texts: DataFrame, model: Model, step: float) -> None:
    """Trains a copy of the network on each partition's whole texts, then takes their average."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = copy.deepcopy(shared.value)  # workers are used again, and with them the value

        def own():
            for batch in batches:
                for _, _, data, off in flat.slices(*flat.texts(batch.column(0)), TEXT_BYTES):
                    hashes, tail, bounds = tokens(data, off)
                    ids = model.ids(hashes, tail)
                    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                        yield from (ids[lo:min(lo + PIECE, b)] for lo in range(a, b, PIECE))

        n = model.net.train(own(), model.end, step)
        if n:
            values = model.net.values().astype(np.float64)
            values = np.pad(values, (0, -len(values) % ROW_VALUES)).reshape(-1, ROW_VALUES)
            yield pa.record_batch([pa.array(np.arange(len(values))), pa.array(np.full(len(values), n)), *map(pa.array, values.T.copy())],
                                  names=["row", "n", *(f"v{k}" for k in range(ROW_VALUES))])

    kind = ", ".join(["row long", "n long", *(f"v{k} double" for k in range(ROW_VALUES))])
    got = (texts.select("text").mapInArrow(run, kind).groupBy("row")
           .agg(*[(F.sum(F.col(f"v{k}") * F.col("n")) / F.sum("n")).alias(f"v{k}") for k in range(ROW_VALUES)]).collect())
    shared.unpersist()
    if got:
        model.net.take(np.array([r[1:] for r in sorted(got)]).ravel())


def _looked_up(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of some texts: (ids of all tokens), then by text (tokens, those with counts in the task, their base score, the tail part
    of their score, other distinct tokens), then of these, by text, (hash, times)."""
    hashes, tail, bounds = tokens(data, offsets)
    ids, n = model.ids(hashes, tail), np.diff(bounds)
    texts = len(n)
    row = np.repeat(np.arange(texts), n)
    known = ids < len(model.sorted)
    base = np.bincount(row[known], model.base[ids[known]], texts)
    n_known = np.bincount(row[known], minlength=texts)
    in_tail = np.zeros(texts)
    row, rest = row[~known], hashes[~known]
    if len(model.next):
        at = np.minimum(np.searchsorted(model.next, rest), len(model.next) - 1)
        there = model.next[at] == rest
        own, at = row[there], at[there]
        n_known += np.bincount(own, minlength=texts)
        base += np.bincount(own, model.next_base[at], texts)
        in_tail += np.bincount(own, model.next_tail[at], texts)
        row, rest = row[~there], rest[~there]
    order = np.lexsort((rest, row))
    row, rest = row[order], rest[order]
    new = np.ones(len(rest), bool)
    new[1:] = (rest[1:] != rest[:-1]) | (row[1:] != row[:-1])
    times = np.diff(np.append(np.flatnonzero(new), len(rest)))
    return ids, n, n_known, base, in_tail, np.bincount(row[new], minlength=texts), rest[new], times.astype(np.int32)


def _run(model_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, keys = model_of(), np.random.default_rng()  # row keys; they are stored with the rows
        held, own, texts, size = [], [], 0, 0

        def rows():
            ids, n, n_known, base, in_tail, n_rare, rare, times = (np.concatenate(x) for x in zip(*held, strict=True))
            score = model.net.score(ids, np.concatenate([[0], np.cumsum(n)]), model.end) / np.log(10) + in_tail
            cuts = pa.array(np.concatenate([[0], np.cumsum(n_rare)]).astype(np.int32))
            return pa.record_batch([
                pa.array(keys.integers(0, 1 << 62, len(n))), pa.concat_arrays(own), pa.array(n.astype(np.int64)),
                pa.array(n_known.astype(np.int64)), pa.array(base), pa.array(score),
                pa.ListArray.from_arrays(cuts, pa.array(rare.view(np.int64))), pa.ListArray.from_arrays(cuts, pa.array(times))],
                names=["key", "id", "n_tokens", "n_short", "short_base", "net", "rare", "times"])

        for batch in batches:
            for lo, hi, data, off in flat.slices(*flat.texts(batch.column(1)), TEXT_BYTES):
                held.append(_looked_up(model, data, off))
                own.append(batch.column(0).take(pa.array(np.arange(lo, hi))))  # a copy: a slice would keep the batch's texts
                texts, size = texts + hi - lo, size + len(held[-1][0])
                if texts >= GROUP_TEXTS or size >= GROUP_TOKENS:
                    yield rows()
                    held, own, texts, size = [], [], 0, 0
        if held:
            yield rows()
    return run


def scores(documents: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score, score of every text."""
    spark = documents.sparkSession
    docs = documents.withColumn("_learn", learn_from).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), "_learn")
    share = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % ROUNDS, F.lit(0))
    learning = docs.filter("_learn").select("text", share.alias("share"))
    counts = stored(token_counts(learning.select("text")), "counts")
    model = fit(learning, counts)
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema["id"].dataType.simpleString()
    rows = stored(docs.select("id", "text").mapInArrow(_run(lambda: shared.value), f"key long, id {kind}, n_tokens long, n_short long, short_base double, net double, "
                                                       "rare array<long>, times array<int>"), "scored")
    rare = (rows.filter(F.size("rare") > 0).select("key", F.explode(F.arrays_zip("rare", "times")).alias("x"))
            .select("key", F.col("x.rare").alias("token"), F.col("x.times").alias("times")).join(counts, "token", "left"))
    c = F.coalesce("n", F.lit(0))
    room = F.element_at(F.array(*[F.lit(float(x)) for x in model.room]), F.col("token").bitwiseAND(3).cast("int") + 1)
    sums = rare.groupBy("key").agg(F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("known"),
                                   F.sum(F.col("times") * F.log10((c + 1) / F.lit(float(model.n + model.v + 1)))).alias("base"),
                                   F.sum(F.col("times") * F.log10((c + 1) / room)).alias("tail"))
    return (rows.drop("rare", "times").join(sums, "key", "left")
            .select(F.col("id").alias(id_col), "n_tokens", (F.col("n_short") + F.coalesce("known", F.lit(0))).alias("n_known"),
                    F.lit(model.n).cast("long").alias("train_tokens"),
                    (F.col("short_base") + F.coalesce("base", F.lit(0.0))).alias("base_score"),
                    (F.col("net") + F.coalesce("tail", F.lit(0.0))).alias("score")))
