import random

from hypothesis import given, settings, strategies as st
import numpy as np

from dimfold.llm import source_mixing as M

SCHEMA = "doc_id long, text string, source string"


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 9)), min_size=1, max_size=8), st.integers(0, 60))
def test_seats_go_by_highest_quotient(parties, seats):
    weights, caps = zip(*parties)
    queue = sorted(((-w / (2 * k + 1), i) for i, (w, c) in enumerate(parties) if w for k in range(c)))[:seats]
    want = [sum(i == j for _, i in queue) for j in range(len(parties))]
    assert M.sainte_lague(np.array(weights), seats, np.array(caps)).tolist() == want


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1000), st.sampled_from([1, 2, 5])), min_size=1, max_size=9))
def test_targets_reshare_the_excess(sources):
    sizes, weights = map(list, zip(*sources))
    got, stopped = M.targets(sizes, weights), set()
    while True:  # round by round, as the rule is told
        left = sum(sizes) - sum(3 * sizes[i] for i in stopped)
        share = sum(w for i, w in enumerate(weights) if i not in stopped)
        now = [3 * s if i in stopped else left * w / share for i, (s, w) in enumerate(zip(sizes, weights))]
        over = {i for i, t in enumerate(now) if i not in stopped and t > 3 * sizes[i] + 1e-9}
        if not over:
            break
        stopped |= over
    assert np.allclose(got, now) and all(t <= 3 * s + 1e-6 for t, s in zip(got, sizes))


def table(seed=1, n=400):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 200))), rng.choice(["b"] * 8 + ["a", "c", "é", None])) for i in range(n)]
    return rows + [(1000, None, "b"), (1001, "", "a"), (1002, " ", None), (None, "x y z " * 30, "c"), (2007, "p q " * 40, "z"), (2007, "p q " * 40, "z")]


def test_taken_comes_near_the_target(spark):
    rows = table()
    df = spark.createDataFrame([r + ("s", 1) for r in rows], SCHEMA + ", size string, Target int")
    got = M.mix(df, shard_blocks=16).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        t = by.setdefault(r.source, [0, 0, r.target, r.source_size])
        t[0], t[1] = t[0] + r.taken, t[1] + r.size
    names = sorted(by, key=lambda s: (s is None, s or ""))
    weights = [(5, 2, 1)[i % 3] for i in range(len(names))]
    assert np.allclose([by[s][2] for s in names], M.targets([by[s][1] for s in names], weights))
    for taken, size, target, told in by.values():
        assert told == size and abs(taken - target) <= max(16, 0.02 * target)
    again = M.mix(df.repartition(3), shard_blocks=16).collect()
    key = lambda rs: sorted(((r.doc_id, r.size, r.taken, r.target) for r in rs), key=repr)
    assert key(got) == key(again)


def test_documents_of_the_mix(spark):
    rows = [(i, t, "en", s, len(t or "")) for i, t, s in table(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    taken = {}
    for r in M.mix(df).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    texts = {i: t for i, t, *_ in rows}
    out = M.mixed_documents(df)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = {}
    for r in out.collect():
        n = len(r.text.split())
        got[r.doc_id] = got.get(r.doc_id, 0) + n
        assert r.n_chars == len(r.text)
        if r.text != texts[r.doc_id]:
            whole = iter(texts[r.doc_id].split())
            assert 0 < n < len(texts[r.doc_id].split()) and all(w in whole for w in r.text.split())
    assert got == {k: v for k, v in taken.items() if v}


def test_empty_tables(spark):
    assert M.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    assert [(r.taken, r.target) for r in M.mix(spark.createDataFrame([(1, None, "a")], SCHEMA)).collect()] == [(0, 0.0)]
