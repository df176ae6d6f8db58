"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``order`` bytes long with the counts of
the byte that follows, gathered from all training texts. A byte is predicted in
the longest known context; escape is estimated by the number of distinct
followers (method C), and a shorter context leaves out the symbols that the
longer one has seen. A text's score is the log10 probability of its bytes and
of its end, from the context of a start.

Beside it stands the base: a unigram model over words, smoothed by a half.

Scale: windows of ``order`` + 1 bytes are counted over the whole corpus, merged
before the shuffle; every context counts. The ``max_nodes`` most frequent contexts
at most are broadcast as a trie, which scores by two table look-ups a byte, many
places of the texts side by side. It is exact where the whole context of ``order``
bytes is in it. All other windows get their probabilities in groups of the two
bytes before the predicted one, and meet their texts in one join. Of the word
counts at most ``head``, the most frequent, are broadcast too; all other words meet
their counts in that same join, by a 62-bit hash. All rows of the join are four numbers.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimfold.llm.common import TASK_CACHE, ascii_lower, durable, id_part, pick, read, steps, words

ORDER = 5
MAX_NODES, HEAD = 100_000, 65_536
EDGE = 0xFF  # never a byte of UTF-8: before the start and after the end
LANE = 128


def lowered(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace").lower()


def _stream(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in a row, each after ``order`` edges and before one; the places
    of the predicted bytes (a text's and its end), and where each text's begin."""
    pad = bytes([EDGE]) * order
    joined = np.frombuffer(b"".join(x for t in texts for x in (pad, t, pad[:1])), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    first = np.cumsum(size) - size
    return joined, np.arange(int(size.sum())) + np.repeat((np.arange(len(texts)) + 1) * order, size), first


def _gram(joined: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """The bytes at the places ``at``, each with the ``order`` bytes before it as one number."""
    one = joined.astype(np.int64)
    gram = one.copy()
    for back in range(1, order + 1):
        gram[back:] |= one[:-back] << 8 * back
    return gram[at]


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin."""
    return np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]][:len(ordered)])


def _count_grams(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each predicted byte with its context as one number, and how often it came in a step's texts that are learned from."""
        for part in batches:
            learn = np.array(part.column(1).to_pylist(), np.int64)
            for step in steps(part.column(0)):
                texts = [lowered(t) for t in part.column(0)[step].to_pylist()]
                joined, at, _ = _stream(texts, order)
                learned = np.repeat(learn[step], [len(t) + 1 for t in texts])
                both = np.sort(_gram(joined, at, order) << 1 | learned)  # a sort of plain numbers, no places carried along
                gram, learned = both >> 1, both & 1
                new = _starts(gram)
                yield pa.RecordBatch.from_arrays([pa.array(gram[new]), pa.array(np.add.reduceat(learned, new))], ["gram", "n"])

    return run


def gram_counts(texts: DataFrame, order: int) -> DataFrame:
    """(gram, n) of ``texts`` (text, learn): every window of the texts, and its count in those with ``learn``."""
    counted = texts.mapInArrow(_count_grams(order), "gram long, n long")
    return durable(counted.groupBy("gram").agg(F.sum("n").alias("n")))


def floor_of(counted: DataFrame, count: str, most: int) -> int:
    """The smallest count such that at most ``most`` rows of ``counted`` reach it.

    Found in a histogram of at most 64 classes per doubling of the count.
    """
    classes = counted.groupBy(F.floor(64 * F.log2(count)).alias("class")).agg(F.count("*").alias("rows"), F.min(count).alias("least")).collect()
    held, least = 0, 1 << 62
    for r in sorted(classes, key=lambda r: -r["class"]):
        held += r.rows
        if held > most:
            break
        least = r.least
    return least


def train(texts: DataFrame, order: int = ORDER, max_nodes: int = MAX_NODES) -> dict:
    """The trie of ``texts`` (one text column)."""
    return trie_of(gram_counts(texts.select("*", F.lit(True)), order), order, max_nodes)


def trie_of(grams: DataFrame, order: int, max_nodes: int) -> dict:
    """The trie of ``gram_counts``: length k, context, symbol and count of its edges.

    It holds the contexts that reach a count, the smallest one that leaves at
    most ``max_nodes`` of them, and all their followers.
    """
    lengths = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.expr(f"(gram >> 8) & {(1 << 8 * k) - 1}L").alias("ctx")) for k in range(order + 1)]))
    edges = durable(grams.where(F.col("n") > 0).select(lengths.alias("c"), F.expr("gram & 255").alias("symbol"), "n").groupBy("c.k", "c.ctx", "symbol").agg(F.sum("n").alias("n")))
    nodes = durable(edges.groupBy("k", "ctx").agg(F.sum("n").alias("all")))
    kept = nodes.where(F.col("all") >= floor_of(nodes, "all", max_nodes)).select("k", "ctx")
    table = edges.join(F.broadcast(kept), ["k", "ctx"]).select("k", "ctx", "symbol", "n").toArrow()
    return {"order": order, **{c: table[c].to_numpy().astype(np.int64) for c in ("k", "ctx", "symbol", "n")}}


def _levels(grams: np.ndarray, n: np.ndarray, lengths: range, below: dict | None) -> dict:
    """The distinct (context, symbol) pairs of the last of ``lengths``, sorted, with count and probability.

    ``grams`` hold all windows of the contexts concerned; ``below`` is the
    result for contexts one byte shorter. ``rest`` is the probability of a
    symbol that did not follow the context, after the escape from it.
    """
    for k in lengths:
        pair, place = np.unique(grams & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
        count = np.bincount(place, n, len(pair))
        _, node = np.unique(pair >> 8, return_inverse=True)
        met = count > 0
        total, kinds = np.bincount(node, count)[node], np.bincount(node, met)[node]
        if below is None:
            rest = np.full(len(pair), 1 / max(1, 256 - np.count_nonzero(met)))
            older = np.full(len(pair), 1 / 256)
        else:
            up = np.searchsorted(below["pair"], pair & ((1 << 8 * k) - 1))
            left = below["total"][up] - np.bincount(node, below["count"][up] * met)[node]
            new = below["kinds"][up] - kinds
            size = np.maximum(left + new, 1)
            rest = np.where(below["count"][up] > 0, below["count"][up] / size, np.where(new > 0, new / size, 1) * below["rest"][up])
            older = below["p"][up]
        p = np.where(total > 0, np.where(met, count, kinds * rest) / np.maximum(total + kinds, 1), older)
        below = {"pair": pair, "count": count, "total": total, "kinds": kinds, "rest": rest, "p": p}
    return below


def gram_scores(grams: DataFrame, trie: dict) -> DataFrame:
    """(known, log): window and log10 probability of the windows whose context is not in ``trie``.

    Windows with the same last two bytes of context are a group: all shorter
    contexts but those of no and one byte, at most 65,536 pairs, are of one group.
    """
    order, split = trie["order"], min(2, trie["order"])
    short = grams.groupBy((F.col("gram").bitwiseAND((1 << 8 * split) - 1)).alias("pair")).agg(F.sum("n").alias("n")).toArrow()
    below = _levels(short["pair"].to_numpy(), short["n"].to_numpy(), range(split), None)
    shared = grams.sparkSession.sparkContext.broadcast((below, np.unique(trie["ctx"][trie["k"] == order])))

    def run(group: pa.Table) -> pa.Table:
        below, known = shared.value
        got = _levels(group["gram"].to_numpy(), group["n"].to_numpy(), range(split, order + 1), below)
        tail = ~np.isin(got["pair"] >> 8, known)
        return pa.table({"known": got["pair"][tail], "log": np.log10(np.maximum(got["p"][tail], 1e-30))})

    last = F.expr(f"(gram >> 8) & {(1 << 8 * split) - 1}L")
    return grams.select("gram", "n", last.alias("last")).groupBy("last").applyInArrow(run, "known long, log double")


class Predictor:
    """The trie as a state machine: a state is the longest known context, a
    byte has a log10 probability in it and leads to the next state.

    Bytes that the corpus lacks share one symbol. Contexts are closed under
    suffixes and prefixes, as those count no less.
    """

    def __init__(self, trie: dict):
        self.order = trie["order"]
        seen_bytes = np.unique(trie["symbol"])
        width = len(seen_bytes) + 1
        self.symbol = np.full(256, width - 1)
        self.symbol[seen_bytes] = np.arange(width - 1)
        keys = trie["k"] << 56 | trie["ctx"]
        nodes, place = np.unique(keys, return_inverse=True)
        if not len(nodes):
            nodes = np.zeros(1, np.int64)
        k, ctx = nodes >> 56, nodes & ((1 << 56) - 1)
        sort = np.argsort(place, kind="stable")
        edge_node, edge_symbol, edge_n = place[sort], self.symbol[trie["symbol"][sort]], trie["n"][sort]
        self.table = np.empty((len(nodes), width), np.float32)
        self.next = np.zeros((len(nodes), width), np.int32)
        self.whole = np.searchsorted(k, self.order)  # the first context of ``order`` bytes
        base, below = 0, np.searchsorted(k, 1)
        seen = novel = None  # of the contexts one byte shorter
        for length in range(self.order + 1):
            some = np.arange(base, below)
            lo, hi = np.searchsorted(edge_node, [base, below])
            count = np.zeros((len(some), width), np.float32)
            count[edge_node[lo:hi] - base, edge_symbol[lo:hi]] = edge_n[lo:hi]
            new, rest = count == 0, np.empty_like(count)
            for at in range(0, len(some), 8192):
                part = slice(at, at + 8192)
                if length == 0:
                    rest[part] = new[part] / np.maximum(new[part].sum(1, keepdims=True), 1)
                else:
                    up = np.searchsorted(nodes, (length - 1) << 56 | ctx[some[part]] & ((1 << 8 * (length - 1)) - 1))
                    left, older = seen[up - shorter] * new[part], novel[up - shorter]
                    kinds = np.count_nonzero(left, axis=1)[:, None]
                    rest[part] = np.where(kinds > 0, (left + kinds * older) / np.maximum(left.sum(1, keepdims=True) + kinds, 1), older)
                    self.next[some[part]] = self.next[up]
                total, kinds = count[part].sum(1, keepdims=True), np.count_nonzero(count[part], axis=1)[:, None]
                escape = np.where(kinds < width, kinds, 0)
                p = np.where(total > 0, (count[part] + escape * rest[part]) / np.maximum(total + escape, 1), rest[part])
                self.table[some[part]] = np.log10(np.maximum(p, 1e-30))
            seen, novel, shorter = count, rest, base
            base, below = below, np.searchsorted(k, length + 2)
            longer = np.arange(base, below)
            if len(longer):
                prefix = np.searchsorted(nodes, length << 56 | ctx[longer] >> 8)
                self.next[prefix, self.symbol[ctx[longer] & 255]] = longer
        self.table[:, -1] -= np.log10(max(1, 256 - len(seen_bytes)))
        self.width = width
        self.flat_table, self.flat_next = self.table.ravel(), self.next.ravel()

    def _places(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The stream of ``texts``, its places and texts' first places; log10
        probability by place and if its whole context is known. The stream is cut into lanes that
        run side by side; a lane starts ``order`` bytes early, which is all that a state knows."""
        joined, at, first = _stream(texts, self.order)
        lanes = -(-len(joined) // LANE)
        padded = np.full(self.order + lanes * LANE, EDGE, np.uint8)
        padded[self.order:self.order + len(joined)] = joined
        symbols, begin = self.symbol[padded], np.arange(lanes) * LANE
        state, out, whole = np.zeros(lanes, np.int64), np.empty((LANE, lanes), np.float32), np.empty((LANE, lanes), bool)
        for i in range(LANE + self.order):
            cell = state * self.width + symbols[begin + i]
            if i >= self.order:
                self.flat_table.take(cell, out=out[i - self.order], mode="clip")
                whole[i - self.order] = state >= self.whole
            state = self.flat_next.take(cell, mode="clip").astype(np.int64)
        return joined, at, first, out.T.ravel()[at], whole.T.ravel()[at]

    def log10(self, texts: list[bytes]) -> np.ndarray:
        """Log10 probability of each text by the contexts of this trie."""
        if not texts:
            return np.zeros(0)
        _, _, first, out, _ = self._places(texts)
        return np.add.reduceat(out, first, dtype=np.float64)

    def known(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Log10 probability of each text's places whose whole context is
        known; number of the text, window and count of all others."""
        joined, at, first, out, whole = self._places(texts)
        other = np.flatnonzero(~whole)
        gram = sum(joined[at[other] - back].astype(np.int64) << 8 * back for back in range(self.order + 1))
        owner = np.searchsorted(first, other, "right") - 1
        # Windows are in their texts' order, so each text's are sorted by themselves.
        for lo, hi in zip(*(np.searchsorted(owner, np.arange(len(texts)), side).tolist() for side in ("left", "right"))):
            gram[lo:hi].sort()
        new = np.flatnonzero(np.r_[True, (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])][:len(gram)])
        n = np.diff(np.r_[new, len(gram)])
        return np.add.reduceat(np.where(whole, out, 0), first, dtype=np.float64), owner[new], gram[new], n


#: Rows that meet in the join, all of one narrow shape. ``key`` is a window, or a word's hash from 2^62 on; below
#: zero it is -4 * (uid + 1) plus a kind, and the row is a fact of the text ``uid`` itself.
FLAT = "uid long, key long, tf long, log double"
DOC_BASE, TOKENS_SCORE, KNOWN_HELD = 0, 1, 2
WORD, WORD_BITS = 1 << 62, (1 << 62) - 1


def _rows(uid, key, tf, log=None) -> pa.RecordBatch:
    column = lambda x: pa.array(x, pa.int64())
    return pa.RecordBatch.from_arrays([column(uid), column(key), column(tf), pa.nulls(len(uid), pa.float64()) if log is None else pa.array(log, pa.float64())],
                                      ["uid", "key", "tf", "log"])


def _score(shared, key: str, end: float, end_known: int):
    import xxhash  # here, so that the queries of all other operators do without it

    def load():
        trie, head, head_log = shared.value
        return Predictor(trie), {w: i for i, w in enumerate(head)}, head_log

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ppm, head, head_log = TASK_CACHE.get(key, load)
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, held = (batch.column(i).to_pylist() for i in range(2))
            for step in steps(batch.column(2)):
                texts = [lowered(t) for t in batch.column(2)[step].to_pylist()]
                scores, owner, gram, times = ppm.known(texts)
                if len(gram):
                    yield _rows(owner + uid, gram, times)
                facts, rare_of, rare_key, rare_n = [], [], [], []
                for t, doc_id, held_out, score in zip(texts, ids[step], held[step], scores.tolist()):
                    w = t.split()
                    at = np.fromiter(map(head.get, w, repeat(-1)), np.int64, len(w))
                    known = at[at >= 0]
                    mark = -4 * (uid + 1)
                    facts += [(uid, mark + DOC_BASE, doc_id, float(head_log[known].sum()) + end), (uid, mark + TOKENS_SCORE, len(w) + 1, score),
                              (uid, mark + KNOWN_HELD, 2 * (len(known) + end_known) + held_out, 0.0)]
                    if len(known) < len(w):
                        rare = Counter(w[i] for i in np.flatnonzero(at < 0))
                        rare_of.extend(repeat(uid, len(rare)))
                        rare_key.extend(xxhash.xxh64_intdigest(x, 42) & WORD_BITS | WORD for x in rare)
                        rare_n.extend(rare.values())
                    uid += 1
                yield _rows(*map(list, zip(*facts)))
                if rare_of:
                    yield _rows(rare_of, rare_key, rare_n)

    return run


def score(docs: DataFrame, order: int = ORDER, max_nodes: int = MAX_NODES, head: int = HEAD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): base figures and the PPM score.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score. Learns from documents whose crc32(doc_id) mod 5 is not 1;
    ``held_out`` says that it is 1. Null and empty texts have their end alone.
    Null doc_id: learned from, not held out. Repeated rows count each, in
    learning and in the result. Without training texts every byte is as likely
    as any other. Texts are scored whole. Extra columns are ignored; an empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    plain = pick(docs, doc_id="long", text="string").withColumn("held_out", F.coalesce(id_part(F.col("doc_id"), 5) == 1, F.lit(False)))
    train_docs = plain.where(~F.col("held_out"))
    counts = durable(train_docs.select(F.explode(words(ascii_lower(F.col("text")))).alias("word")).groupBy("word").agg(F.count("*").alias("c")))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"), F.count("*").alias("kinds")).first()
    ends = train_docs.count()
    n, kinds = total.tokens + ends, total.kinds + (ends > 0)
    below = n + 0.5 * (kinds + 1)
    often = counts.where(F.col("c") >= floor_of(counts, "c", head)).orderBy("word").collect()
    grams = gram_counts(plain.select("text", ~F.col("held_out")), order)
    trie = trie_of(grams, order, max_nodes)
    shared = spark.sparkContext.broadcast((
        trie, [r.word.encode("utf-8", "replace") for r in often], np.log10((np.array([r.c for r in often], float) + 0.5) / below)))
    flat = plain.select("doc_id", "held_out", "text").mapInArrow(
        _score(shared, uuid.uuid4().hex, float(np.log10((ends + 0.5) / below)), int(ends > 0)), FLAT)
    word_key = F.xxhash64(F.col("word").cast("binary")).bitwiseAND(F.lit(WORD_BITS)).bitwiseOR(F.lit(WORD))
    known = counts.select(word_key.alias("known"), "c", F.lit(None).cast("double").alias("known_log")).unionByName(
        gram_scores(grams, trie).withColumnRenamed("log", "known_log"), allowMissingColumns=True)
    met = flat.join(known, F.col("key") == F.col("known"), "left")
    fact = lambda kind: F.col("key").bitwiseAND(3) == kind
    of = lambda kind, what: F.max(F.when((F.col("key") < 0) & fact(kind), F.col(what))).alias(f"{what}{kind}")
    rare, c = F.col("key") >= WORD, F.coalesce("c", F.lit(0))
    by_row = met.groupBy("uid").agg(
        *[of(kind, what) for kind in (DOC_BASE, TOKENS_SCORE, KNOWN_HELD) for what in ("tf", "log")],
        F.sum(F.when(rare & (c > 0), F.col("tf")).otherwise(0)).alias("tail_known"),
        F.coalesce(F.sum(F.when(rare, F.col("tf") * F.log10((c + 0.5) / F.lit(below)))), F.lit(0.0)).alias("tail_score"),
        F.coalesce(F.sum(F.col("tf") * F.col("known_log")), F.lit(0.0)).alias("rest"))
    return by_row.select(
        F.col("tf0").alias("doc_id"), (F.col("tf2") % 2 == 1).alias("held_out"), F.col("tf1").alias("n_tokens"),
        (F.shiftright("tf2", 1) + F.col("tail_known")).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("log0") + F.col("tail_score")).alias("base_score"), (F.col("log1") + F.col("rest")).alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents"))
