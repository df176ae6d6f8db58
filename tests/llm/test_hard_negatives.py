import random

from hypothesis import given, settings, strategies as st
import numpy as np

from dimfold.llm import hard_negatives as H


def brute(rows, every, positives, negatives, low, high):
    """``rows``: (vec_id, integer vector, label)."""
    out = []
    for a, q, mine in rows:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, label) for i, v, label in rows if i != a)
        for minus, p, _ in [r for r in scored if r[2] == mine][:positives]:
            inside = [(i, -s) for s, i, label in scored if label != mine and low * -minus <= 100 * -s <= high * -minus]
            out += [(a, p, rank + 1, i, -minus, s) for rank, (i, s) in enumerate(inside[:negatives])]
    return sorted(out)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(*[st.integers(-3, 3)] * 3), min_size=1, max_size=80), st.tuples(*[st.integers(-3, 3)] * 3),
       st.lists(st.tuples(st.integers(-20, 30), st.integers(-20, 30)), min_size=1, max_size=4), st.integers(1, 4), st.integers(1, 5))
def test_threshold_reading_is_exact(rows, q, windows, k, step):
    x, q = np.array(rows, np.int64), np.array(q, np.int64)
    seen = []
    for some, scores, threshold in H.read_lists(q, x, H.sorted_lists(x), step):
        seen += some.tolist()
        unseen = np.setdiff1d(np.arange(len(x)), seen)
        assert (scores == x[some] @ q).all()
        assert threshold is None and not len(unseen) or (x[unseen] @ q <= threshold).all()
    assert sorted(seen) == list(range(len(x)))
    ids = np.arange(len(x))[::-1].copy()
    allowed = np.arange(len(x)) % 3 > 0
    got = H.first_in_windows(q, windows, k, ids, allowed, x, H.sorted_lists(x))
    for (low, high), (a, b) in zip(windows, got):
        want = sorted((-int(s), int(i)) for s, i, ok in zip(x @ q, ids, allowed) if ok and low <= s <= high)[:k]
        assert list(zip((-b).tolist(), a.tolist())) == want


def test_reading_stops_early():
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(4000, 4)) * 50).astype(np.int64)
    q = np.array([90, -80, 0, 0])
    x[7] = 5 * q  # far above all others, so its score ends the reading
    read = []
    for rows, scores, threshold in H.read_lists(q, x, H.sorted_lists(x)):
        read += rows.tolist()
        if threshold is not None and threshold < x[7] @ q:
            break
    assert 7 in read and len(read) < 400


def test_edges_blocks_and_hot_label(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.5, -0.25, 0.126, 0.0, 0.9]) for _ in range(4)], rng.choice([1, 1, 1, 2, 3])) for i in range(70)]
    odd = [(None, [1.0] * 4, 1), (100, None, 1), (105, [1.0, None, 1.0, 1.0], 1), (110, [float("nan")] * 4, 2), (115, [float("inf")] * 4, 2),
           (120, [0.5] * 4, None), (125, [], 1), (3, rows[3][1], rows[3][2]), (10, rows[10][1], 9)]
    df = spark.createDataFrame([r + (1, "x") for r in rows + odd], "vec_id long, embedding array<double>, label int, anchor_id int, V string")
    want = brute([(i, [int(np.floor(256 * c)) for c in v], label) for i, v, label in rows] + [(125, [], 1)], 5, 3, 4, 80, 100)
    assert want and any(r[2] == 4 for r in want)
    for block_rows in (9, 1000):
        got = H.mine(df, every=5, positives=3, negatives=4, block_rows=block_rows)
        assert sorted(tuple(r) for r in got.collect()) == want
    wide = brute([(i, [int(np.floor(256 * c)) for c in v], label) for i, v, label in rows] + [(125, [], 1)], 5, 2, 2, 0, 150)
    assert sorted(tuple(r) for r in H.mine(df, every=5, positives=2, negatives=2, low=0, high=150).collect()) == wide
    assert H.mine(df.where("false")).count() == 0
    assert H.mine(df.where("label = 1"), every=1).count() == 0  # no other label


def test_all_vectors_equal_and_zero(spark):
    df = spark.createDataFrame([(i, [0.0] * 3, i % 2) for i in range(30)], "vec_id long, embedding array<double>, label int")
    want = brute([(i, [0] * 3, i % 2) for i in range(30)], 10, 2, 2, 80, 100)
    assert sorted(tuple(r) for r in H.mine(df, every=10, positives=2, negatives=2).collect()) == want
