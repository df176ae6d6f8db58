"""Language identification by words first, then shorter and shorter n-grams.

Every language has the log frequencies of its words and of the character
n-grams inside its words (edges marked). A known word scores by its frequency
in each language. An unseen word backs off: it is covered from the left by the
longest n-grams known to any language, from ``max_gram`` characters down to one.
A text's score is the sum over its words; its confidence is the posterior of the
best language with the evidence of a text counted per word, up to ``weight``
words.

Scale: the model is fitted on a sample bounded by ``sample_docs`` documents a
language, drawn by hash; their whole texts are counted in tasks, merged by word. It keeps at most ``max_words`` words and
``max_grams`` n-grams a language, which bounds the broadcast. Prediction is one
pass over whole texts without a shuffle.
"""

from __future__ import annotations

import heapq
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimfold.llm.common import TASK_CACHE, give_back, id_part, in_one_task, pick, read, steps

UNDETERMINED = "und"
LETTERS = re.compile(r"[^\W\d_]+")
SAMPLE_DOCS, SAMPLE_CHARS = 1000, None  # the whole texts of the drawn rows
MAX_WORDS, MAX_GRAMS, MAX_GRAM = 30_000, 30_000, 5
EDGE = "\x02"


def grams(word: str, n: int) -> list[str]:
    marked = f"{EDGE}{word}{EDGE}"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def fit(sample: list[tuple[str, str]], max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS, max_gram: int = MAX_GRAM) -> dict:
    """The model of (text, lang) pairs."""
    counts: dict[str, Counter] = {}
    for text, lang in sample:
        counts.setdefault(lang, Counter()).update(LETTERS.findall(text.lower()))
    return fit_counts([(lang, w, n) for lang, c in counts.items() for w, n in c.items()], sorted(counts), max_words, max_grams, max_gram)


def fit_counts(counted: list[tuple[str, str, int]], langs: list[str], max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS, max_gram: int = MAX_GRAM) -> dict:
    """The model of (lang, word, count) rows: log frequencies by word and n-gram, a row of languages each.

    Words seen once in all are left to the n-grams: a single sighting says
    little of the word's language.
    """
    words, number = [Counter() for _ in langs], {lang: k for k, lang in enumerate(langs)}
    for lang, word, n in counted:
        words[number[lang]][word] += n

    def table(per_lang: list[Counter], most: int, least: int = 1) -> tuple[dict[str, int], np.ndarray]:
        """Row numbers and log frequencies, a column a language, of the ``most`` frequent of each language."""
        size = np.array([sum(c.values()) for c in per_lang], float)
        kinds = len(set().union(*per_lang)) if per_lang else 0
        often = {x for c in per_lang for x in heapq.nsmallest(most, c, key=lambda x: (-c[x], x))}
        keep = sorted(x for x in often if sum(c[x] for c in per_lang) >= least)
        counts = np.array([[c[x] for c in per_lang] for x in keep], float).reshape(len(keep), len(per_lang))
        return {x: i for i, x in enumerate(keep)}, np.log((counts + 0.5) / (size + 0.5 * kinds))

    model = {"langs": langs, "max_gram": max_gram, "words": table(words, max_words, least=2), "grams": []}
    for n in range(1, max_gram + 1):
        seen = [Counter() for _ in langs]
        for k, counter in enumerate(words):
            for word, c in counter.items():
                for g in grams(word, n):
                    seen[k][g] += c
        model["grams"].append(table(seen, max_grams))
    return model


class Scorer:
    """Scores texts; keeps the vectors of the words it has seen, ``most`` at a time."""

    def __init__(self, model: dict, weight: int = 20, most: int = 200_000):
        self.model, self.weight, self.most = model, weight, most
        self._clear()

    def _clear(self) -> None:
        place, self.rows = self.model["words"]
        self.place = dict(place)

    def backoff(self, word: str) -> np.ndarray:
        """Log scores of an unseen word from the longest known n-grams, left to right."""
        marked, at, score = f"{EDGE}{word}{EDGE}", 0, np.zeros(len(self.model["langs"]))
        while at < len(marked):
            for n in range(min(self.model["max_gram"], len(marked) - at), 0, -1):
                place, rows = self.model["grams"][n - 1]
                known = place.get(marked[at:at + n])
                if known is not None:
                    score, at = score + rows[known], at + n
                    break
            else:
                at += 1  # a character of no language says nothing
        return score

    def score(self, texts: list[str | None]) -> list[tuple[str, float]]:
        langs = self.model["langs"]
        split = [LETTERS.findall((t or "").lower()) for t in texts]
        if len(self.place) > self.most:
            self._clear()
        if new := list(dict.fromkeys(w for t in split for w in t if w not in self.place)):
            self.rows = np.concatenate([self.rows, [self.backoff(w) for w in new]])
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        out = []
        for t in split:
            if not langs or not any(c.isalpha() for w in t for c in w):  # signs like a half pass for word characters
                out.append((UNDETERMINED, 0.0))
                continue
            sums = self.rows[np.fromiter(map(self.place.__getitem__, t), np.int64, len(t))].sum(0)
            scaled = (sums - sums.max()) * min(1.0, self.weight / len(t))
            best = int(np.argmax(sums))
            out.append((langs[best], float(1 / np.exp(scaled).sum())))
        return out


def training_sample(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(lang, text) of about ``sample_docs`` documents a language at most, outside the held-out part.

    Documents are counted by language, then drawn by a hash of id and text
    below the language's share, so any may be drawn. Whole texts are fitted on.
    """
    able = pick(docs, doc_id="long", text="string", lang="string").where(
        (id_part(F.col("doc_id"), 5) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    share = [(r.lang, min(1.0, sample_docs / r.n)) for r in able.groupBy("lang").agg(F.count("*").alias("n")).collect()]
    limits = docs.sparkSession.createDataFrame(share, "name string, share double")
    return (
        able.withColumn("draw", F.xxhash64("doc_id", "text"))
        .join(F.broadcast(limits), F.col("lang") == F.col("name"))
        .where(F.pmod("draw", F.lit(1 << 20)) < F.col("share") * (1 << 20))
        .select("lang", "text"))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each language and how often they came in a step; a null word says that the language is there."""
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1)
        for step in steps(texts):
            seen: dict[str, Counter] = {}
            for lang, text in zip(langs[step], texts[step].to_pylist()):
                seen.setdefault(lang, Counter({None: 1})).update(LETTERS.findall(text.lower()))
            rows = [(lang, w, n) for lang, c in seen.items() for w, n in c.items()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64()))], ["lang", "word", "n"])


def word_counts(sample: DataFrame) -> DataFrame:
    """(lang, word, n) of ``training_sample``; each language has a row with a null word too."""
    return sample.mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _fit_rows(rows: list[tuple], **limits) -> dict:
    return fit_counts([(lang, w, n) for lang, w, n in rows if w is not None], sorted({r[0] for r in rows}), **limits)


def predictor(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, weight: int = 20, **limits):
    """Fits a model on ``docs``; returns a function from a text column to struct(lang, score)."""
    model = in_one_task(word_counts(training_sample(docs, sample_docs)), lambda rows: _fit_rows(rows, **limits))
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = TASK_CACHE.get(key, lambda: Scorer(shared.value, weight))
        for batch in batches:
            texts = batch.tolist()
            got = [x for part in steps(texts) for x in scorer.score(texts[part])]
            yield pd.DataFrame(got, columns=["lang", "score"])
            give_back()

    return predict.asNondeterministic()  # else Catalyst runs it again for a filter on its result


def identify(docs: DataFrame, **params) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score.

    Fitted on documents whose crc32(doc_id) mod 5 is not 0; ``held_out`` says
    that it is 0. Null text or text without a letter: ``und``, score 0. Null
    doc_id: never fitted on, not held out. Without any labelled document every
    text is ``und``. Repeated rows get equal results; equal scores go to the
    first language by name. Whole texts count, of any length. Extra columns
    are ignored; an empty table gives an empty result.
    """
    plain = pick(docs, doc_id="long", text="string")
    return plain.withColumn("found", predictor(docs, **params)("text")).select(
        "doc_id", F.coalesce(id_part(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def keep_known(docs: DataFrame, min_score: float = 0.5, **params) -> DataFrame:
    """The documents whose language is known with ``min_score`` or more, with
    the columns of ``documents``; ``lang`` becomes the predicted language."""
    plain = pick(docs, doc_id="long", text="string", lang="string", source="string", n_chars="long")
    found = plain.withColumn("found", predictor(plain, **params)("text"))
    return found.where((F.col("found.lang") != UNDETERMINED) & (F.col("found.score") >= min_score)).select(
        "doc_id", "text", F.col("found.lang").alias("lang"), "source", "n_chars")


def query(spark, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents"))
