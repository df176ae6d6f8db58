import hashlib
import random
from collections import defaultdict

from hypothesis import given, settings, strategies as st
import numpy as np

from dimfold.llm import ball_kmeans as B


def brute(rows, parts, entries, rounds, width):
    """``rows``: (vec_id, integer vector, label), in the order of the seeds."""
    cut = [[(v + [0] * parts * width)[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in rows]
    books = [[row[p] for row in cut[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def nearest():
        return [[min(range(len(books[p])), key=lambda e: (far(row[p], books[p][e]), e)) for p in range(parts)] for row in cut]

    for _ in range(rounds):
        code = nearest()
        for p in range(parts):
            for e in range(len(books[p])):
                held = [row[p] for row, c in zip(cut, code) if c[p] == e]
                if held:
                    books[p][e] = [sum(x) // len(held) for x in zip(*held)]
    code = nearest()
    error = [sum(far(row[p], books[p][c[p]]) for p in range(parts)) for row, c in zip(cut, code)]
    of_label = defaultdict(int)
    for (_, _, label), e in zip(rows, error):
        of_label[label] += e
    known = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{x:02x}" for x in c), e, of_label[label], known) for (i, _, label), c, e in zip(rows, code, error)), key=repr)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(-6, 6), st.integers(-6, 6)), min_size=1, max_size=50),
       st.lists(st.tuples(st.integers(-6, 6), st.integers(-6, 6)), min_size=1, max_size=9), st.randoms())
def test_balls_and_rings_give_the_nearest_entry(rows, entries, rng):
    x, e = np.array(rows, np.int64), np.array(entries, np.int64)
    code, dist, _ = B.assign(x, np.array([rng.randrange(len(e)) for _ in rows]), e)
    d = ((x[:, None] - e[None]) ** 2).sum(2)
    assert (code == d.argmin(1)).all() and (dist == d.min(1)).all()


def test_stable_cores_and_rings_skip_work():
    rng = np.random.default_rng(3)
    e = np.array([[0, 0], [1000, 0], [0, 1000], [1000, 1000]])
    x = e[rng.integers(0, 4, 2000)] + rng.integers(-50, 50, (2000, 2))
    code, _, _ = B.assign(x, np.zeros(2000, np.int64), e)
    again, _, compared = B.assign(x, code, e)
    assert compared == 0 and (again == code).all()
    x[0] = [500, 100]  # one part between two balls
    _, _, compared = B.assign(x, code, e)
    assert 0 < compared <= 3


def test_edges_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.5, -0.25, 0.126, 0.0, 0.9, -0.7]) for _ in range(7)], rng.choice([1, 1, 2, None])) for i in range(60)]
    rows += [(7, rows[7][1], 1), (7, rows[7][1], 1), (61, [], 2), (62, [0.3] * 9, 2), (None, [0.1] * 7, None)]
    odd = [(100, None, 1), (105, [1.0, None], 1), (110, [float("nan")] * 4, 2), (115, [float("-inf")] * 4, 2)]
    df = spark.createDataFrame([r + (b"x", 1) for r in rows + odd], "vec_id long, embedding array<double>, label int, code binary, ERROR int")
    kept = sorted(((i, [int(np.floor(256 * c)) for c in v], label) for i, v, label in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    for parts, entries, rounds, width in ((4, 5, 2, 3), (3, 100, 1, 3), (16, 64, 0, 1)):
        got = B.codes(df.repartition(5), parts, entries, rounds)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(kept, parts, entries, rounds, width)
    assert B.codes(df.where("false")).count() == 0
    one = B.codes(df.where("vec_id = 1")).collect()
    assert len(one) == 1 and one[0].error == 0 and one[0].code == "00" * 16
