import random

from hypothesis import given, settings, strategies as st
import numpy as np

from dimfold.llm import pivot_search as P


def brute(vectors, k, every):
    out = []
    for q, v in vectors:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), x) for x, w in vectors if x != q)
            out += [(q, i + 1, x, -s) for i, (s, x) in enumerate(scores[:k])]
    return sorted(out)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(*[st.integers(-300, 300)] * 3), min_size=1, max_size=60), st.integers(1, 4))
def test_bounds_hold_and_search_is_exact(rows, n_pivots):
    x = np.array(rows, np.int64)
    ids = np.arange(len(x))
    pivots = x[:n_pivots]
    d = P._distances(x, pivots)
    ub = P.upper_bounds(x, d, (x.astype(float) ** 2).sum(1), d)
    assert (ub >= x @ x.T).all()
    got = P.search(ids, x, d, ids, x, d, 3, step=4)
    want = [(q, v, s) for q, _, v, s in brute(list(zip(ids.tolist(), rows)), 3, 1)]
    assert sorted(got, key=lambda r: (r[0], -r[2], r[1])) == sorted(want, key=lambda r: (r[0], -r[2], r[1]))


def test_edges_and_blocks(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.5, -0.25, 0.126, 0.0]) for _ in range(4)]) for i in range(40)]
    odd = [(None, [1.0] * 4), (100, None), (105, [1.0, None, 1.0, 1.0]), (110, [float("nan")] * 4), (115, [float("inf")] * 4), (120, []), (3, rows[3][1])]
    df = spark.createDataFrame([r + (1, "x") for r in rows + odd], "vec_id long, embedding array<double>, v int, DIST string")
    want = brute([(i, [int(np.floor(256 * c)) for c in v]) for i, v in rows] + [(120, [])], 5, 5)
    for block_rows in (7, 1000):
        got = sorted(tuple(r) for r in P.top_k(df, every=5, block_rows=block_rows, pivots=3).collect())
        assert got == want
    few = P.top_k(df.where("vec_id < 3"), every=1).collect()
    assert len(few) == 6
    assert P.top_k(df.where("false")).count() == 0
