import zlib

import numpy as np

from dimfold.llm import language_id as L

SCHEMA = "doc_id long, text string, lang string"
FULL = SCHEMA + ", source string, n_chars long"
EN = "the cat and the dog of this house with the other"
FR = "le chat et les chiens de la maison avec une autre"


def brute_score(model, text, weight=20):
    """Word by word, without caches or arrays."""
    words, total = L.LETTERS.findall((text or "").lower()), {lang: 0.0 for lang in model["langs"]}
    if not total or not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    for w in words:
        parts = []
        if w in model["words"][0]:
            parts = [model["words"][1][model["words"][0][w]]]
        else:
            rest = f"{L.EDGE}{w}{L.EDGE}"
            while rest:
                known = [n for n in range(1, model["max_gram"] + 1) if len(rest) >= n and rest[:n] in model["grams"][n - 1][0]]
                if known:
                    place, rows = model["grams"][known[-1] - 1]
                    parts.append(rows[place[rest[:known[-1]]]])
                rest = rest[known[-1] if known else 1:]
        for p in parts:
            for lang, x in zip(model["langs"], p):
                total[lang] += x
    best = max(total, key=lambda k: (total[k], -model["langs"].index(k)))
    scale = min(1.0, weight / len(words))
    return best, 1 / sum(np.exp((v - total[best]) * scale) for v in total.values())


def test_scores_equal_brute_force():
    model = L.fit([(EN, "en"), (EN + " zebra", "en"), (FR, "fr"), (FR + " zèbre", "fr")], max_words=8, max_grams=60)
    texts = [EN, FR, "the chats of la dogs", "unseen cathouse maisonette", "ß 漢字 x", "", None, "12 !?", "½ ² Ⅷ", "the " * 500 + "le " * 3]
    for most in (9, 1000):
        scorer = L.Scorer(model, most=most)
        for _ in range(2):
            for t, (lang, score) in zip(texts, scorer.score(texts)):
                want = brute_score(model, t)
                assert lang == want[0] and abs(score - want[1]) < 1e-9


def test_edges(spark):
    train = [(i, EN if i % 2 else FR, "en" if i % 2 else "fr") for i in range(40)]
    odd = [(100, None, "en"), (101, "", None), (102, "123 ++", "fr"), (103, EN * 3, None), (103, EN * 3, None), (None, FR, "xx")]
    df = spark.createDataFrame([r + ("q", 1) for r in train + odd], SCHEMA + ", found string, Lang_Pred int")
    got = L.identify(df).collect()
    assert len(got) == len(train + odd)
    for r in got:
        held = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        assert r.held_out == held and 0 <= r.score <= 1
        want = {100: "und", 101: "und", 102: "und", 103: "en", None: "fr"}.get(r.doc_id, "en" if (r.doc_id or 0) % 2 else "fr")
        assert r.lang_pred == want
    assert [(r.lang_pred, r.score) for r in L.identify(spark.createDataFrame([(1, EN, None)], SCHEMA)).collect()] == [("und", 0.0)]
    assert L.identify(spark.createDataFrame([], SCHEMA)).count() == 0


def test_held_out_accuracy_and_no_leak(spark):
    from dimfold.llm.queries import QUERIES

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = QUERIES["op6_language_id"](spark, d).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and held
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95
    flipped = docs.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0, 'zz', lang) AS lang")
    assert sorted((r.doc_id, r.lang_pred, r.score) for r in L.identify(flipped).collect()) == sorted((r.doc_id, r.lang_pred, r.score) for r in got)


def test_kept_documents(spark):
    rows = [(i, (EN if i % 2 else FR) + f" {i}", "en" if i % 2 else "fr", "s", 9) for i in range(30)] + [(50, "12", "en", "s", 2), (51, None, "en", "s", 2)]
    out = L.keep_known(spark.createDataFrame(rows, FULL))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"] and sorted(r.doc_id for r in out.collect()) == list(range(30))


def test_late_parts_of_long_texts_are_learned(spark):
    kept = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, (EN if i % 2 else FR) + " " + "1 " * 4000 + ("qwerty " if i % 2 else "azerty ") * 3, "en" if i % 2 else "fr") for i in kept]
    got = L.identify(spark.createDataFrame(rows + [(1000, "qwerty", None), (1001, "azerty", None)], SCHEMA)).where("doc_id >= 1000").collect()
    assert {r.doc_id: r.lang_pred for r in got} == {1000: "en", 1001: "fr"}
    assert all(r.score > 0.9 for r in got)
