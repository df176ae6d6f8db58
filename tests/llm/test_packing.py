import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from dimfold.llm import best_fit_packing as P

PATH = public_tokenizers.path(P.TOKENIZER)


def brute_best_fit(lengths, capacity):
    bins = []
    for x in sorted(lengths, reverse=True):
        fit = [i for i, free in enumerate(bins) if free >= x]
        if fit:
            i = min(fit, key=lambda i: bins[i])
            bins[i] -= x
        else:
            bins.append(capacity - x)
    return len(bins), sorted(bins)


def taken(rows, capacity):
    """Per sequence its sorted (offset, length); checks that ranks are used once."""
    seqs, ranks = {}, {}
    for length, first, number, sequence, per, offset in rows:
        for r in range(number):
            seqs.setdefault(sequence + r // per, []).append((offset + r % per * length, length))
            assert ranks.setdefault(length, set()).isdisjoint({first + r})
            ranks[length].add(first + r)
    for items in seqs.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return seqs, {k: len(v) for k, v in ranks.items()}


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=25))
def test_plan_is_best_fit_decreasing(counts):
    rows, n = P.plan(counts, 40)
    seqs, placed = taken(rows, 40)
    want, free = brute_best_fit([x for x, c in counts.items() for _ in range(c)], 40)
    assert n == len(seqs) == want and placed == counts
    assert sorted(40 - sum(x for _, x in s) for s in seqs.values()) == free


def test_word_cache_equals_the_tokenizer():
    rng = random.Random(5)
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    bits = ["The", "it's,", "a|b", "||", "|", "x.", "..", "ü.", "É", "é", "́x", " ", "a b", "\x1c", "12,5", "won't", "'s", "日本", "ſ", "İ", "ΑΣ", "a.b,c"]
    texts = ["", None, " \n\t"] + [" ".join(rng.choice(bits) for _ in range(n)) for n in (1, 3, 50, 400)] + [" ".join(bits), "́ ".join(bits)]
    for most in (10, 1_000_000):
        cache = P.WordCache(PATH, most)
        for _ in range(2):
            assert [x.tolist() for x in cache.encode(texts)] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_whole_table(spark):
    from dimfold.llm.queries import QUERIES

    d = "/root/testdata/sf0.001"
    rows = QUERIES["op5_best_fit_packing"](spark, d).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    plain, by_doc, by_seq = Tokenizer.from_file(PATH), {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert by_doc.keys() == texts.keys()
    for doc, text in texts.items():
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        got = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [(r.piece, r.start) for r in got] == [(i, i * 2048) for i in range(-(-len(ids) // 2048))]
        for r in got:
            part = ids[r.start:r.start + 2048]
            assert (r.length, r.ids_crc32) == (len(part), zlib.crc32(part.tobytes()))
    for items in by_seq.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by_seq) == brute_best_fit([r.length for r in rows], 2048)[0]


def test_edges(spark):
    rows = [(1, None, "x"), (1, None, "x"), (None, "", "y"), (2 ** 62 + 1, "a " * 5000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, LENGTH string")
    out = P.pack(df, with_ids=True).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length) for r in out), key=repr) == sorted(
        [(1, 0, 0, 1), (1, 0, 0, 1), (None, 0, 0, 1), *((2 ** 62 + 1, i, 2048 * i, n) for i, n in enumerate((2048, 2048, 905)))], key=repr)
    assert len({(r.sequence_id, r.offset) for r in out}) == 6 and len({r.sequence_id for r in out}) == 3
    assert all(len(r.ids) == r.length for r in out)
    assert P.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0
