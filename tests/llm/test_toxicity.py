import random
import zlib

import numpy as np
import pytest

from dimfold.llm import toxicity as T

SCHEMA = "doc_id long, text string"


def make(rng, n, bad):
    words = ["".join(rng.choice(["ba", "ke", "lo", "ni", "tu", "sha"]) for _ in range(rng.randint(1, 3))) for _ in range(n)]
    if bad:
        for _ in range(3):
            words[rng.randrange(n)] = rng.choice(["grumpkin", "vilestod" + rng.choice(["a", "en", "ix", "orum", "ul"])])
    return " ".join(words)


@pytest.fixture(scope="module")
def net():
    rng = random.Random(1)
    return T.train([(make(rng, rng.randint(5, 120), y), y) for y in [0, 0, 1] * 120])


def slow_logit(net, words):
    """One window, word by word, in double precision."""
    p = {k: v.astype(float) for k, v in net.p.items()}
    vectors = [net.embed([w])[0].astype(float) if w else np.zeros(T.WIDTH) for w in words]
    sides = []
    for side, order in (("f", range(len(words))), ("b", range(len(words) - 1, -1, -1))):
        h, out = np.zeros(T.HIDDEN), {}
        for t in order:
            x, g = vectors[t] @ p[f"{side}x"] + p[f"{side}c"], h @ p[f"{side}h"]
            z, r = (1 / (1 + np.exp(-(x + g)[i * T.HIDDEN:(i + 1) * T.HIDDEN])) for i in (0, 1))
            new = np.tanh(x[2 * T.HIDDEN:] + r * g[2 * T.HIDDEN:])
            h = out[t] = (1 - z) * new + z * h
        sides.append(out)
    states = [np.concatenate([sides[0][t], sides[1][t]]) for t in range(len(words))]
    weight = np.exp([s @ p["look"] for s in states])
    return sum(w * s for w, s in zip(weight / weight.sum(), states)) @ p["out"] + p["bias"][0]


def test_scores_equal_brute_force_over_windows(net):
    rng = random.Random(5)
    texts = ["", None, "?! 12", "one", make(rng, 16, 0), make(rng, 17, 1), make(rng, 26, 0), make(rng, 27, 1), make(rng, 300, 1)]
    for most in (3, 600_000):
        scorer = T.Scorer(net, most)
        got = np.concatenate([scorer.score(texts[:4]), scorer.score(texts[4:])])
        for t, p in zip(texts, got):
            w, best = T.tokens(t), -np.inf
            at = 0
            while at == 0 or at < len(w) - (T.WINDOW - T.STRIDE):
                part = w[at:at + T.WINDOW]
                best = max(best, slow_logit(net, part + [None] * (T.WINDOW - len(part))))
                at += T.STRIDE
            assert abs(p - 1 / (1 + np.exp(-best))) < 1e-4


def test_windows_cover_every_word():
    for n in range(0, 80):
        ids, first = T.cut([np.arange(n), np.arange(n)], -1)
        assert set(range(n)) <= set(ids[: first[1]].ravel().tolist()) and len(ids) == 2 * first[1]


def test_gradients_equal_differences():
    net = T.Network(["a"], 3)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    rng = np.random.default_rng(0)
    vectors = rng.standard_normal((5, T.WIDTH))
    ids = np.array([[0, 1, 2], [3, 4, 0], [1, 1, 3]])
    weight = np.array([1.0, -2.0, 0.5])
    keep = []
    net.run(ids, net.project(vectors), keep)
    g, d_inputs = net.backward(ids, keep, weight, 5)
    for side, d_in in zip("fb", d_inputs):
        g[f"{side}x"], g[f"{side}c"] = vectors.T @ d_in, d_in.sum(0)
    for name, grad in g.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in net.p[name].shape)
            old, diff = net.p[name][at], []
            for step in (1e-2, -1e-2):
                net.p[name][at] = old + step
                diff.append(net.run(ids, net.project(vectors)) @ weight)
            net.p[name][at] = old
            assert abs((diff[0] - diff[1]) / 2e-2 - grad[at]) < 2e-3 * max(1, abs(grad[at]))


def test_unseen_words_with_a_known_stem(net):
    rng = random.Random(8)
    scorer = T.Scorer(net)
    clean = scorer.score([make(rng, 60, 0) for _ in range(80)])
    bad = scorer.score([make(rng, 50, 0) + " vilestod" + s + " " + make(rng, 20, 0) for s in ("eta", "ung", "ikus", "ars") for _ in range(10)])
    assert (clean < 0.5).mean() > 0.95 and (bad >= 0.5).mean() > 0.9


def test_edges(spark):
    rng = random.Random(2)
    rows = [(i, make(rng, 40, i % 3 == 0), "x", 1) for i in range(150)] + [(500, None, "x", 1), (501, "", "x", 1), (None, make(rng, 9, 1), "x", 1), (3, rows3 := make(rng, 30, 1), "x", 1), (3, rows3, "x", 1)]
    docs = spark.createDataFrame(rows, SCHEMA + ", score string, Toxic int")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 1) for i in range(150)] + [(500, None, 1), (501, 7, 1), (None, 1, 1), (9999, 1, 1), (3, 0, 0)],
                                   "doc_id long, toxic int, text int")
    got = T.rate(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    right = [r.predicted == int(r.doc_id % 3 == 0) for r in got if r.doc_id is not None and r.doc_id < 150 and r.doc_id != 3 and r.held_out]
    assert np.mean(right) > 0.85
    none = T.rate(docs, labels.where("toxic = 0")).collect()
    assert len({r.score for r in none}) == 1 and {r.predicted for r in none} == {0}
    assert T.rate(docs.where("false"), labels).count() == 0 and T.rate(docs, labels.where("false")).count() == len(rows)


def test_held_out_labels_do_not_matter(spark):
    d = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    a, b = (sorted((r.doc_id, r.score) for r in T.rate(docs, x).collect()) for x in (labels, flipped))
    assert a == b


def test_late_passages_are_learned(spark):
    rng = random.Random(6)
    text = lambda bad: make(rng, 900, 0) + " " + make(rng, 16, bad)
    docs = [(i, text(i % 3 == 0)) for i in range(200)]
    assert min(len(t) for _, t in docs) > 4000
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in docs], "doc_id long, toxic int")
    got = T.rate(spark.createDataFrame(docs, "doc_id long, text string"), labels).where("held_out").collect()
    assert np.mean([r.predicted == int(r.doc_id % 3 == 0) for r in got]) > 0.85


def test_held_out_labels_of_the_given_table(spark):
    """The network learns from a random start; nothing of the sample is written into it beforehand."""
    d = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "toxic").collect()}
    got = {r.doc_id: (r.predicted, r.score) for r in T.query(spark, d).where("held_out").collect() if r.doc_id in labels}
    toxic = [i for i in got if labels[i] == 1]
    clean = [i for i in got if labels[i] == 0]
    assert np.mean([got[i][0] for i in toxic]) > 0.8
    assert np.mean([got[i][0] for i in clean]) < 0.03
    assert np.mean([[got[i][1] > got[j][1] for j in clean] for i in toxic]) > 0.93


def test_bias_moves_until_scores_add_up_to_labels():
    net = T.Network([], 3)
    net.p["out"][:] = 0
    checked = [("a b", 1), ("c", 0), ("d e", 0), ("f", 0)] * 100
    assert T.shift(net, []) == 0
    assert abs(1 / (1 + np.exp(-T.shift(net, checked))) - 0.25) < 0.01
    assert T.train([]).p["bias"][0] == -4 and T.train([("x", 1)]).p["bias"][0] == 4
