"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word's input is its own vector, if the training sample has it often enough,
plus the mean of the vectors of its hashed character n-grams, so that unseen
words with a familiar stem are read too. Two gated recurrent layers run over a
window of words from either end, attention pools their states, and a logistic
unit scores the window. Windows overlap and cover the whole text; a text scores
as its worst window.

Trained with numpy and Adam on a bounded sample of labelled documents
(``sample_docs`` toxic ones and three times as many others). Windows drawn from
anywhere in a document carry its label, then only the worst window of each document
does, as a toxic text need not be toxic all over. All of the network starts at random.

Scale: labels join documents by id once, for the sample alone. Scoring is one
pass over whole texts, without a shuffle; the network is a few hundred KB.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimfold.llm.common import TASK_CACHE, id_part, in_one_task, pick, read, steps

LETTERS = re.compile(r"[^\W\d_]+")
SAMPLE_DOCS = 1500
WINDOW, STRIDE = 16, 10
WIDTH, HIDDEN = 16, 8
BUCKETS = 1 << 13
GRAMS = (3, 4, 5)


class Network:
    """Parameters, forward and backward pass. All arrays are float32."""

    def __init__(self, vocabulary: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.place = {w: i + 1 for i, w in enumerate(vocabulary)}
        self.p = {"word": np.zeros((len(vocabulary) + 1, WIDTH), np.float32), "gram": draw(BUCKETS, WIDTH, scale=0.02)}
        for side in "fb":
            self.p[f"{side}x"] = draw(WIDTH, 3 * HIDDEN, scale=0.4)
            self.p[f"{side}c"] = np.zeros(3 * HIDDEN, np.float32)
            self.p[f"{side}h"] = draw(HIDDEN, 3 * HIDDEN, scale=0.3)
        self.p |= {"look": draw(2 * HIDDEN, scale=0.1), "out": draw(2 * HIDDEN, scale=0.3), "bias": np.zeros(1, np.float32)}

    def grams(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(word number, bucket) of every character n-gram of the words, edges marked."""
        if len(words) > 10_000:  # bounds the working arrays
            parts = [self.grams(words[i:i + 10_000]) for i in range(0, len(words), 10_000)]
            return np.concatenate([at + 10_000 * i for i, (at, _) in enumerate(parts)]), np.concatenate([b for _, b in parts])
        code = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
        size = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
        owner = np.repeat(np.arange(len(words)), size)
        at, bucket = [], []
        for n in GRAMS:
            if len(code) >= n:
                whole = np.flatnonzero(owner[: len(code) - n + 1] == owner[n - 1:])
                h = np.full(len(whole), n, np.uint64)
                for j in range(n):
                    h = (h ^ code[whole + j]) * np.uint64(0x9E3779B97F4A7C15)
                    h ^= h >> np.uint64(29)
                at.append(owner[whole])
                bucket.append((h % np.uint64(BUCKETS)).astype(np.int64))
        return (np.concatenate(at), np.concatenate(bucket)) if at else (np.empty(0, np.int64), np.empty(0, np.int64))

    def embed(self, words: list[str]) -> np.ndarray:
        """Input vectors of the words."""
        if len(words) > 10_000:
            return np.concatenate([self.embed(words[i:i + 10_000]) for i in range(0, len(words), 10_000)])
        out = self.p["word"][[self.place.get(w, 0) for w in words]]
        if words:
            at, bucket = self.grams(words)
            order = np.argsort(at, kind="stable")
            at, bucket = at[order], bucket[order]
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            number = np.diff(np.append(first, len(at)))
            out[at[first]] += np.add.reduceat(self.p["gram"][bucket], first, axis=0) / number[:, None]
        return out

    def project(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What each word adds to the gates of either direction."""
        return tuple(vectors @ self.p[f"{s}x"] + self.p[f"{s}c"] for s in "fb")

    def run(self, ids: np.ndarray, inputs: tuple[np.ndarray, np.ndarray], keep: list | None = None) -> np.ndarray:
        """Logits of windows of word numbers; ``keep`` collects what the backward pass needs."""
        n, length = ids.shape
        states = np.empty((length, n, 2 * HIDDEN), np.float32)
        for d, side in enumerate("fb"):
            u, h = self.p[f"{side}h"], np.zeros((n, HIDDEN), np.float32)
            for t in range(length) if d == 0 else range(length - 1, -1, -1):
                x, g = inputs[d][ids[:, t]], h @ u
                gates = np.tanh(0.5 * (x[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])) * 0.5 + 0.5
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                new = np.tanh(x[:, 2 * HIDDEN:] + r * g[:, 2 * HIDDEN:])
                if keep is not None:
                    keep.append((d, t, h, z, r, new, g[:, 2 * HIDDEN:]))
                h = new + z * (h - new)
                states[t, :, d * HIDDEN:(d + 1) * HIDDEN] = h
        weight = np.exp(states @ self.p["look"])
        weight /= weight.sum(0)
        pooled = (weight[:, :, None] * states).sum(0)
        if keep is not None:
            keep.append((states, weight, pooled))
        return pooled @ self.p["out"] + self.p["bias"][0]

    def backward(self, ids: np.ndarray, keep: list, d_logit: np.ndarray, rows: int) -> tuple[dict, tuple[np.ndarray, np.ndarray]]:
        """Gradients of the parameters above the inputs, and of the inputs of either
        direction, a row for each of the ``rows`` numbers in ``ids`` (all occur)."""
        states, weight, pooled = keep[-1]
        g = {"out": pooled.T @ d_logit, "bias": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * self.p["out"]
        along = (states * d_pooled).sum(2)
        d_look = weight * (along - (weight * along).sum(0))
        g["look"] = np.einsum("tn,tnk->k", d_look, states)
        d_states = weight[:, :, None] * d_pooled + d_look[:, :, None] * self.p["look"]
        d_gates = [np.empty((*states.shape[:2], 3 * HIDDEN), np.float32) for _ in "fb"]
        d_h = [np.zeros((len(ids), HIDDEN), np.float32) for _ in "fb"]
        for side in "fb":
            g[f"{side}h"] = np.zeros_like(self.p[f"{side}h"])
        for d, t, h, z, r, new, gn in reversed(keep[:-1]):
            u = self.p[f"{'fb'[d]}h"]
            up = d_h[d] + d_states[t, :, d * HIDDEN:(d + 1) * HIDDEN]
            d_new = up * (1 - z) * (1 - new * new)
            d_gate = np.concatenate([up * (h - new) * z * (1 - z), d_new * gn * r * (1 - r), d_new], 1)
            through = np.concatenate([d_gate[:, : 2 * HIDDEN], d_new * r], 1)
            g[f"{'fb'[d]}h"] += h.T @ through
            d_h[d] = up * z + through @ u.T
            d_gates[d][t] = d_gate
        order = np.argsort(ids.T.ravel(), kind="stable")
        sums = [np.add.reduceat(x.reshape(-1, 3 * HIDDEN)[order], np.searchsorted(ids.T.ravel()[order], np.arange(rows)), axis=0) for x in d_gates]
        return g, tuple(sums)


def cut(texts: list[np.ndarray], pad: int, window: int = WINDOW, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """Windows over each text's word numbers, and the first window of each text. Every text has one at least."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    number = np.maximum(1, -(-(size - window) // stride) + 1)
    room = (number - 1) * stride + window
    base = np.cumsum(room) - room
    line = np.full(int(room.sum()), pad, np.int64)
    if size.any():
        line[np.repeat(base - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))] = np.concatenate(texts)
    first = np.cumsum(number) - number
    start = np.repeat(base - first * stride, number) + np.arange(int(number.sum())) * stride
    return line[start[:, None] + np.arange(window)], first


def tokens(text: str | None) -> list[str]:
    return LETTERS.findall((text or "").lower())


class Adam:
    def __init__(self, rate: float):
        self.rate, self.step, self.m, self.v = rate, 0, {}, {}

    def apply(self, p: dict, grads: dict) -> None:
        self.step += 1
        for name, g in grads.items():
            m = self.m.setdefault(name, np.zeros_like(g))
            v = self.v.setdefault(name, np.zeros_like(g))
            m += 0.1 * (g - m)
            v += 0.005 * (g * g - v)
            p[name] -= self.rate * (m / (1 - 0.9 ** self.step)) / (np.sqrt(v / (1 - 0.995 ** self.step)) + 1e-7)


class RowSteps:
    """Adagrad by rows: a row of vectors that moves rarely moves far."""

    def __init__(self, rate: float):
        self.rate, self.sum = rate, {}

    def apply(self, p: dict, name: str, rows: np.ndarray, grads: np.ndarray) -> None:
        seen = self.sum.setdefault(name, np.full(len(p[name]), 1e-8, np.float32))
        used, to = np.unique(rows, return_inverse=True)
        g = np.zeros((len(used), grads.shape[1]), np.float32)
        np.add.at(g, to, grads)
        seen[used] += (g * g).mean(1)
        p[name][used] -= self.rate * g / np.sqrt(seen[used])[:, None]


def train(sample: list[tuple[str, int]], rounds: int = 1, batch: int = 256, rate: float = 0.01, row_rate: float = 0.05,
          each: int = 12, passes: tuple[int, int] = (3, 25), enough: int = 40_000, set_aside: int = 10, seed: int = 7) -> Network:
    """A network for (text, label) pairs, learned from a random start.

    As many passes as show ``enough`` windows, at least and at most ``passes``, draw up to ``each``
    windows anew from anywhere in every document; they carry its label, classes weigh alike and a
    document of n windows as the root of n. Then ``rounds`` rounds learn from each document's worst
    window. Every ``set_aside``-th document of a class is kept out of all this and moves the bias
    until the scores of these documents add up to their labels, near enough (few documents move it little).
    """
    if not sample or len({y for _, y in sample}) == 1:
        net = Network([], seed)
        net.p["bias"][0] = 4.0 if sample and sample[0][1] else -4.0
        net.p["out"][:] = 0
        return net
    turn = np.zeros(len(sample), int)
    for y in (0, 1):
        of = [i for i, (_, label) in enumerate(sample) if label == y]
        turn[of] = np.arange(1, len(of) + 1)
    checked = [s for s, n in zip(sample, turn) if n % set_aside == 0]
    sample = [s for s, n in zip(sample, turn) if n % set_aside]
    labels = np.array([y for _, y in sample], np.float32)
    number: dict[str, int] = {}
    numbered = [np.fromiter((number.setdefault(w, len(number)) for w in tokens(t)), np.int64) for t, _ in sample]
    types, pad = list(number), len(number)
    often = np.zeros(pad, np.int64)
    for t in numbered:
        often[np.unique(t)] += 1
    net = Network(sorted(types[i] for i in np.flatnonzero(often >= 3)), seed)
    ids, first = cut(numbered, pad)
    windows = np.diff(np.append(first, len(ids)))
    owner = np.repeat(np.arange(len(numbered)), windows)
    known = np.array([net.place.get(w, 0) for w in types])
    at, bucket = net.grams(types)
    order = np.argsort(at, kind="stable")
    at, bucket = at[order], bucket[order]
    bounds = np.searchsorted(at, np.arange(len(types) + 1))
    share = (1.0 / np.diff(bounds))[at].astype(np.float32)
    rng, adam, row_steps = np.random.default_rng(seed), Adam(rate), RowSteps(row_rate)

    def learn(rows: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        used, local = np.unique(ids[rows], return_inverse=True)
        local = local.reshape(len(rows), -1)
        real = used[used < pad]
        lengths = bounds[real + 1] - bounds[real]
        to = np.repeat(np.arange(len(real)), lengths)
        grams = np.repeat(bounds[real] - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(to))
        vectors = np.zeros((len(used), WIDTH), np.float32)
        own = rng.random((len(real), 1)) < 0.5  # half of the words pass for unseen ones
        vectors[: len(real)] = net.p["word"][known[real]] * own
        if len(real):
            vectors[: len(real)] += np.add.reduceat(net.p["gram"][bucket[grams]] * share[grams, None], np.cumsum(lengths) - lengths, axis=0)
        mask = rng.random((len(used), 1)) < 0.9  # now and then a word is missing
        vectors *= mask
        keep: list = []
        logit = net.run(local, net.project(vectors), keep)
        d_logit = ((1 / (1 + np.exp(-logit)) - y) * weight / weight.sum()).astype(np.float32)
        g, d_inputs = net.backward(local, keep, d_logit, len(used))
        d_vectors = np.zeros_like(vectors)
        for side, d_in in zip("fb", d_inputs):
            g[f"{side}x"], g[f"{side}c"] = vectors.T @ d_in, d_in.sum(0)
            d_vectors += d_in @ net.p[f"{side}x"].T
        adam.apply(net.p, g)
        if len(real):
            d_vectors *= mask
            row_steps.apply(net.p, "gram", bucket[grams], d_vectors[to] * share[grams, None])
            row_steps.apply(net.p, "word", known[real], d_vectors[: len(real)] * own)
        net.p["word"][0] = 0

    drawn = np.minimum(windows, each)
    for _ in range(min(max(-(-enough // int(drawn.sum())), passes[0]), passes[1])):
        some = np.lexsort((rng.random(len(ids)), owner))
        some = rng.permutation(some[np.arange(len(ids)) - first[owner] < each])
        y = labels[owner[some]]
        weight = np.where(y == 1, (y == 0).sum() / (y == 1).sum(), 1.0) / np.sqrt(drawn[owner[some]])
        for i in range(0, len(some), batch):
            learn(some[i:i + batch], y[i:i + batch], weight[i:i + batch])
    for _ in range(rounds):
        logit = logits(net, types, ids)
        top = np.lexsort((-logit, owner))[first]  # the worst window of each text
        for _ in range(max(3, 4000 // len(top))):
            turn = rng.permutation(len(top))
            for i in range(0, len(turn), batch):
                learn(top[turn[i:i + batch]], labels[turn[i:i + batch]], np.ones(len(turn[i:i + batch])))
    net.p["bias"] += np.float32(shift(net, checked))
    return net


def shift(net: Network, checked: list[tuple[str, int]], prior: float = 1.0) -> float:
    """What to add to the logits so that scores of ``checked`` (text, label) pairs add up to
    their labels; ``prior`` labels a unit hold it back."""
    if not checked:
        return 0.0
    score = Scorer(net).score([t for t, _ in checked])
    logit = np.log(np.maximum(score, 1e-12) / np.maximum(1 - score, 1e-12))
    low, high = -20.0, 20.0
    for _ in range(50):
        middle = (low + high) / 2
        short = (1 / (1 + np.exp(-(logit + middle)))).sum() + prior * middle < sum(y for _, y in checked)
        low, high = (middle, high) if short else (low, middle)
    return low


def logits(net: Network, types: list[str], ids: np.ndarray, vectors: np.ndarray | None = None) -> np.ndarray:
    """Logits of windows of numbers in ``types``; len(types) is the padding."""
    vectors = net.embed(types) if vectors is None else vectors
    inputs = net.project(np.concatenate([vectors, np.zeros((1, WIDTH), np.float32)]))
    return np.concatenate([net.run(ids[i:i + 8192], inputs) for i in range(0, len(ids), 8192)])


class Scorer:
    """Scores texts; keeps the vectors of the words it has seen, ``most`` at a time."""

    def __init__(self, net: Network, most: int = 600_000):
        self.net, self.most = net, most
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.vectors = np.empty((0, WIDTH), np.float32)

    def score(self, texts: list[str | None]) -> np.ndarray:
        if len(self.place) > self.most:
            self._clear()
        split = [tokens(t) for t in texts]
        if new := list(dict.fromkeys(w for t in split for w in t if w not in self.place)):
            self.vectors = np.concatenate([self.vectors, self.net.embed(new)])
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        line = np.fromiter((self.place[w] for t in split for w in t), np.int64, sum(map(len, split)))
        used, local = np.unique(line, return_inverse=True)
        ends = np.cumsum([len(t) for t in split])
        ids, first = cut(np.split(local, ends[:-1]), len(used))
        worst = np.maximum.reduceat(logits(self.net, [], ids, self.vectors[used]), first)
        return 1 / (1 + np.exp(-worst.astype(float)))


def training_sample(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, text, toxic) of about ``sample_docs`` toxic and three times as many
    other labelled documents at most, outside the held-out part.

    Drawn by a hash of the id below the class's share; whole texts are learned from, one row an
    id (of rows repeated in doc_id that of the smallest text hash), so the bound is of rows. Labels that are
    null or neither 0 nor 1 are left out; an id with both is toxic.
    """
    marks = pick(labels, doc_id="long", toxic="int").where(F.col("toxic").isin(0, 1) & (id_part(F.col("doc_id"), 5) != 0))
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    number = {r.toxic: r.n for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = [min(1.0, most / number.get(y, 1)) for y, most in enumerate((3 * sample_docs, sample_docs))]
    drawn = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]) * (1 << 20))
    # the share bounds the drawn ids, whatever the table's size, and an id has one row
    rows = pick(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit(""))).join(F.broadcast(drawn), "doc_id")
    return rows.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.first("toxic").alias("toxic"))


def rate(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, **training) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Learns from ``labels`` (doc_id, toxic) whose crc32(doc_id) mod 5 is not 0;
    ``held_out`` says that it is 0. Null and empty texts, and texts without a
    letter, score as one window without words. Null doc_id: never learned
    from, not held out. Without labels of both classes every text has one and
    the same score. Repeated rows score alike. Whole texts count. Extra
    columns are ignored; an empty table gives an empty result.
    """
    net = in_one_task(training_sample(docs, labels, sample_docs), lambda rows: train([(t, y) for _, t, y in sorted(rows)], **training))
    shared, key = docs.sparkSession.sparkContext.broadcast(net), uuid.uuid4().hex

    @F.pandas_udf("double")
    def worst(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = TASK_CACHE.get(key, lambda: Scorer(shared.value))
        for batch in batches:
            texts = batch.tolist()
            yield pd.Series(np.concatenate([scorer.score(texts[part]) for part in steps(texts)]) if texts else [], dtype=float)

    plain = pick(docs, doc_id="long", text="string").withColumn("score", worst.asNondeterministic()("text"))
    return plain.select("doc_id", F.coalesce(id_part(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def query(spark, sf_dir: str) -> DataFrame:
    return rate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
