import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from dimfold.llm import ppm_scoring as S


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute_counts(texts, order):
    """Followers of every context of up to ``order`` bytes."""
    out = {}
    for t in texts:
        b = bytes([255]) * order + lower(t).encode() + b"\xff"
        for i in range(order, len(b)):
            for k in range(order + 1):
                out.setdefault(b[i - k:i], Counter())[b[i]] += 1
    return out


def brute_log10(counts, text, order):
    """Method C with exclusion, symbol by symbol, in the longest known context."""
    b, total = bytes([255]) * order + lower(text).encode() + b"\xff", 0.0
    for i in range(order, len(b)):
        k = next((k for k in range(order, -1, -1) if b[i - k:i] in counts), None)
        out, p = set(), 1.0
        while True:
            if k is None or k < 0:
                p /= 256 - len(out)
                break
            left = {s: c for s, c in counts[b[i - k:i]].items() if s not in out}
            size, kinds = sum(left.values()), len(left)
            if kinds:
                if b[i] in left:
                    p *= left[b[i]] / (size + kinds)
                    break
                p *= kinds / (size + kinds)
            out |= left.keys()
            k -= 1
        total += math.log10(p)
    return total


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    words = "the then thén Other zebra a ü x1".split()
    return [None, "", "  "] + [" ".join(rng.choice(words) for _ in range(n)) for n in (1, 2, 30, 300, 900)] + ["q~unseen\x01 bytes"]


def test_whole_trie_equals_brute_force(spark, texts):
    order = 3
    df = spark.createDataFrame([(t,) for t in texts[:-1]], "text string")
    model = S.Predictor(S.train(df, order))
    counts = brute_counts(texts[:-1], order)
    assert len(model.table) == len(counts)
    got = model.log10([S.lowered(t) for t in texts])
    want = [brute_log10(counts, t, order) for t in texts]
    assert np.allclose(got, want, rtol=1e-4, atol=1e-4)
    p = 10.0 ** model.table
    shared = 256 - (model.width - 1)
    assert np.allclose(p[:, :-1].sum(1) + shared * p[:, -1], 1, atol=1e-4)


def test_small_trie_keeps_the_most_frequent_contexts(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts[:-1]], "text string")
    counts = brute_counts(texts[:-1], 3)
    classes = {}
    for c, after in counts.items():
        classes.setdefault(math.floor(64 * math.log2(sum(after.values()))), []).append(c)
    kept = []
    for k in sorted(classes, reverse=True):
        if len(kept) + len(classes[k]) > 20:
            break
        kept += classes[k]
    model = S.Predictor(S.train(df, 3, 20))
    assert 5 < len(model.table) == len(kept)
    some = {c: counts[c] for c in kept}
    assert np.allclose(model.log10([S.lowered(t) for t in texts]), [brute_log10(some, t, 3) for t in texts], rtol=1e-4, atol=1e-4)


def test_score_against_brute_force(spark, texts):
    rows = [(i, t, "x") for i, t in enumerate(texts * 2)] + [(None, "the odd zebra", "y"), (3, texts[3], "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, Word string")
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    learn = [t for i, t, _ in rows if not held(i)]
    c = Counter(w for t in learn for w in lower(t).split())
    n, v = sum(c.values()) + len(learn), len(c) + 1
    log = lambda x: math.log10((x + 0.5) / (n + 0.5 * (v + 1)))
    counts = brute_counts(learn, 5)
    want = sorted(((i, held(i), len(lower(t).split()) + 1, 1 + sum(w in c for w in lower(t).split()), n,
                    round(log(len(learn)) + sum(log(c[w]) for w in lower(t).split()), 6), round(brute_log10(counts, t, 5), 2)) for i, t, _ in rows), key=repr)
    for head in (2, 65_536):
        got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 2)) for r in S.score(df, head=head).collect()), key=repr)
        assert [g[:6] for g in got] == [w[:6] for w in want]
        assert np.allclose([g[6] for g in got], [w[6] for w in want], atol=0.02)


def test_contexts_outside_the_broadcast_trie_count(spark, texts):
    rows = list(enumerate(texts * 2))
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    counts = brute_counts([t for i, t in rows if not held(i)], 5)
    want = [brute_log10(counts, t, 5) for _, t in rows]
    for most in (0, 20, 200):
        got = S.score(spark.createDataFrame(rows, "doc_id long, text string"), max_nodes=most).orderBy("doc_id").collect()
        assert np.allclose([r.score for r in got], want, rtol=1e-4, atol=1e-4)


def test_empty_table(spark):
    assert S.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0
