import random
import re
from collections import Counter, defaultdict

from dimfold.llm import quality_rules as Q

SCHEMA = "doc_id long, text string, source string"


def fold(line):
    out = "".join(c.lower() if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else c for c in line)
    return re.sub(r"[\x20\x09-\x0D]", "", out)


def brute(rows, max_docs=10, share=0.25):
    """Lines, families and verdicts with strings in place of hashes; a family is told by all other lines."""
    word = re.compile(r"[^\x20\x09-\x0D]+")
    figures, by_line = [], defaultdict(list)
    for n, (doc, text, source) in enumerate(rows):
        t = text or ""
        w = word.findall(t)
        lines = [x for x in t.split("\n") if word.search(x)]
        grams = Counter(zip(w, w[1:], w[2:]))
        inside = {p for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
        figures.append([doc, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(inside)])
        for k in {fold(x) for x in lines}:
            by_line[source, k].append(n)
    return figures, by_line


def test_figures_equal_brute_force(spark):
    rng = random.Random(4)
    bits = ["a", "bb", "C#", "é", "|", "x1", "\n", "\n", "\t", "\x0b", "  ", "\x1c"]
    rows = [(i, " ".join(rng.choice(bits) for _ in range(rng.randint(0, 90))), "s") for i in range(60)]
    rows += [(100, None, None), (101, "", "s"), (102, "one", "s"), (102, "one", "s"), (None, "a b c a b c a", "s"), (103, "w " * 30_000, "s"), (104, "a b c d", "s")]
    df = spark.createDataFrame([r + ("k", "W") for r in rows], SCHEMA + ", kept string, Carried string")
    got = Q.line_rules(df).collect()
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    want, _ = brute(rows)
    assert sorted(([r[n] for n in names] for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert Q.line_rules(spark.createDataFrame([], SCHEMA)).count() == 0


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))


def corpus():
    """20 texts with a common line, 15 of little else, 30 copies, 30 near copies, and clean ones."""
    rng = random.Random(9)
    common = "All Rights  Reserved 2024, see our terms of use for more of this"
    long_line = "Subscribe " + prose(rng, 60)
    rows = [(i, f"{prose(rng, 60)}\n{common.upper() if i % 2 else common}\n{prose(rng, 30)}", "h") for i in range(20)]
    rows += [(100 + i, f"{prose(rng, 20)}\n{long_line}", "h") for i in range(15)]
    copied = "\n".join(prose(rng, 12) for _ in range(8))
    rows += [(200 + i, copied, "h") for i in range(30)]
    near = [prose(rng, 12) for _ in range(8)]
    for i in range(30):
        some = list(near)
        some[i % 8] = some[i % 8].replace(some[i % 8].split()[3], prose(rng, 1))
        rows.append((300 + i, "\n".join(some), "h"))
    rows += [(400 + i, prose(rng, 80), "h") for i in range(20)]
    rows += [(500 + i, f"{prose(rng, 60)}\n{common}", f"other{i}") for i in range(5)]
    return rows, common


def test_common_lines_go_and_copies_stay(spark):
    rows, common = corpus()
    got = {r.doc_id: r for r in Q.line_rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    texts = {i: t for i, t, _ in rows}
    for i in range(20):
        first, _, last = texts[i].split("\n")
        assert got[i].kept and got[i].clean_text == f"{first}\n{last}" and got[i].removed_words == 13
    for i in range(100, 115):
        assert not got[i].base_failed and not got[i].kept and got[i].removed_lines == 1
    for i in [*range(200, 230), *range(300, 330), *range(400, 420), *range(500, 505)]:
        assert got[i].kept and got[i].clean_text == texts[i]


def test_brute_force_families(spark):
    """Without copies every document is a family of its own, so plain counts decide."""
    rng = random.Random(2)
    pool = [prose(rng, 5) for _ in range(12)]
    rows = [(i, "\n".join([prose(rng, 55)] + [pool[int(len(pool) * rng.random() ** 3)] for _ in range(rng.randint(0, 6))] + [prose(rng, 4)]),
             rng.choice(["a", "b", None])) for i in range(150)]
    _, by_line = brute(rows)
    boiler = {k for k, docs in by_line.items() if len(docs) > 10}
    assert 2 < len(boiler) < len(by_line)
    got = {r.doc_id: (r.removed_lines, r.clean_text) for r in Q.line_rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, t, s in rows:
        stay = [x for x in t.split("\n") if (s, fold(x)) not in boiler]
        assert got[i] == (len(t.split("\n")) - len(stay), "\n".join(stay))


def test_copies_do_not_hide_a_common_line(spark):
    """A thousand copies of one document count once, and many template lines do not make copies of documents."""
    rng = random.Random(11)
    common = "terms of use apply to all of this " + prose(rng, 4)
    rows = [(i, f"{prose(rng, 55)}\n{common}", "a") for i in range(300)]
    one = f"{prose(rng, 70)}\n{common}\n{prose(rng, 8)}"
    rows += [(1000 + i, one, "a") for i in range(1000)]
    near = [prose(rng, 12) for _ in range(9)] + [common]
    for i in range(600):  # near copies of one document with the line in it
        some = list(near)
        some[i % 9] = some[i % 9].replace(some[i % 9].split()[i % 12], prose(rng, 1))
        rows.append((3000 + i, "\n".join(some), "a"))
    template = [prose(rng, 4) for _ in range(20)]
    rows += [(5000 + i, "\n".join(template[:10] + [prose(rng, 55)] + template[10:]), "b") for i in range(300)]
    got = {r.doc_id: r for r in Q.line_rules(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    texts = {i: t for i, t, _ in rows}
    for i in [*range(300), *range(1000, 2000), *range(3000, 3600)]:
        assert got[i].kept and got[i].clean_text == "\n".join(x for x in texts[i].split("\n") if x != common)
    for i in range(5000, 5300):
        assert got[i].clean_text == texts[i].split("\n")[10] and got[i].removed_lines == 20 and not got[i].kept


def test_kept_documents_keep_their_rows(spark):
    rows, _ = corpus()
    full = [(i, t, "en", s, len(t)) for i, t, s in rows] + [(400, rows[-25][1], "en", "h", 1), (None, rows[90][1] + " tail", "de", "h", None)]
    out = Q.keep_clean(spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long"))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = out.collect()
    assert len([r for r in got if r.doc_id == 400]) == 2 and len([r for r in got if r.doc_id is None]) == 1
    assert not [r for r in got if r.doc_id is not None and 100 <= r.doc_id < 115] and all(r.n_chars == len(r.text) for r in got)


def test_main_path_is_native(spark):
    df = Q.line_rules(spark.createDataFrame([(1, "a", "s")], SCHEMA))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
