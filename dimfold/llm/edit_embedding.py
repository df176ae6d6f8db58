"""Document fingerprints by randomised edit embedding.

A text is embedded by a random walk over its characters that all texts share: at
step t the walk writes the character that it stands on and moves to the next
one if the coin of (step, character) says so. Two texts walk alike until they
differ, and fall into step again soon after an edit, so few edits leave few
steps where the embeddings differ: edit distance becomes Hamming distance. k
characters more or less take about the square of k steps to fall into step again, now
and then many more; so likeness is a lower estimate for texts shifted by edits.

A fingerprint samples the embedding at positions that all texts share: the
steps are cut into level 0, [0, 64), and levels j > 0, [64 * 2^(j-1), 64 * 2^j);
each level has 64 sampled steps, a symbol each. So a text of any length has
64 symbols for each doubling of its length. The likeness of two fingerprints is the
share of equal steps up to the longer one's end, estimated from the samples,
each weighed by the steps of its level that it stands for.

``near_copies`` bands sampled symbols, joins on the bands and verifies by
likeness. ``edited_fingerprints`` compares every document with its edited text
and its neighbour.

Scale: fingerprints are made text by text in tasks, many texts in step. The
neighbour by descending id is met in one shuffle of the texts: ids are dealt
into buckets at approximate quantiles, a bucket is read in order, and the few
rows that stand before a bucket's first (two a bucket at most) are sent to it
beside its own rows. Rows of a hot id are dealt to several buckets.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimfold.llm.common import dealt_anew, durable, pick, read, steps
from dimfold.llm.components import connected_components

SEED = 13
CLASSES, PERIOD, SAMPLES = 61, 1024, 64
#: A symbol for each class of characters, and the mark of steps after a text's end.
SYMBOLS = np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"[:CLASSES], np.uint8)
END = ord(".")
#: Characters of the texts (edited ones beside) that are fingerprinted together.
STEP_CHARS = 8_000_000
BLOCK = 512


@functools.cache
def _walk() -> np.ndarray:
    """The step (modulo ``PERIOD``) after the one that leaves a character of a class, for each class and step of arrival."""
    coins = np.random.default_rng(SEED).integers(0, 2, (CLASSES, PERIOD)).astype(bool)
    coins[:, 0] = True  # at least one in each class
    leave = np.where(np.tile(coins, 2), np.arange(2 * PERIOD), 2 * PERIOD)
    leave = np.minimum.accumulate(leave[:, ::-1], axis=1)[:, ::-1][:, :PERIOD]
    return ((leave + 1) % PERIOD).astype(np.int64).reshape(-1)


@functools.cache
def _level(j: int) -> tuple[np.ndarray, int]:
    """(the sampled steps of level j in order, how many steps each stands for)."""
    if j == 0:
        return np.arange(SAMPLES), 1
    low = SAMPLES << (j - 1)
    share = low // SAMPLES  # one step from each of 64 equal stretches
    return low + np.arange(SAMPLES) * share + np.random.default_rng([SEED, j]).integers(0, share, SAMPLES), share


def _levels(walked: np.ndarray) -> np.ndarray:
    """How many levels embeddings of these lengths reach."""
    return np.where(walked > 0, np.ceil(np.log2(np.maximum(walked, 1) / SAMPLES)).clip(0) + 1, 0).astype(np.int64)


def fingerprints(texts: list[str]) -> list[str]:
    """The fingerprint of each text; that of the empty text is empty. Texts are walked in step, longest first."""
    length = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-length, kind="stable")
    length = length[order]
    flat = np.empty(int(length.sum()), np.uint8)
    first = np.cumsum(length) - length
    for i, at, n in zip(order, first, length):
        flat[at:at + n] = np.frombuffer(texts[i].encode("utf-32-le", "surrogatepass"), np.uint32) % CLASSES
    deepest = int(_levels(np.array([4 * length[0] + 4 * PERIOD]))[0]) if len(texts) else 0
    wanted = np.concatenate([_level(j)[0] for j in range(deepest)]) if deepest else np.empty(0, np.int64)
    out = np.full((len(texts), len(wanted)), END, np.uint8)
    walk, step, walked, have = _walk(), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for at in range(0, int(length[0]) if len(texts) else 0, BLOCK):
        lanes = int(np.searchsorted(-length, -at, "left"))  # texts longer than ``at``
        left = np.minimum(length[:lanes] - at, BLOCK)
        deep = int(left[0])
        place = first[:lanes] + at + np.arange(deep)[:, None]
        here = flat[np.minimum(place, len(flat) - 1)].astype(np.int64) * PERIOD
        track = np.empty((deep + 1, lanes), np.int64)
        track[0] = step[:lanes]
        running = np.searchsorted(-left, -np.arange(deep), "left").tolist()
        for i, n in enumerate(running):
            one = here[i, :n]
            np.add(one, track[i, :n], one)
            walk.take(one, None, track[i + 1, :n], "clip")
        stay = (track[1:] - track[:-1] - 1) % PERIOD + 1  # steps on each character
        stay[np.arange(deep)[:, None] >= left] = 0
        ends = np.cumsum(stay, axis=0) + walked[:lanes]
        step[:lanes] = track[left, np.arange(lanes)]
        walked[:lanes] = ends[-1]
        # a sampled step belongs to the first character whose end lies beyond it
        upto = np.searchsorted(wanted, walked[:lanes], "left")
        count = upto - have[:lanes]
        lane = np.repeat(np.arange(lanes), count)
        sample = np.arange(len(lane)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(have[:lanes], count)
        apart = int(walked[:lanes].max()) + 1
        keyed = (ends + np.arange(lanes) * apart).T.reshape(-1)
        char = np.searchsorted(keyed, wanted[sample] + lane * apart, "right") - lane * deep
        out[lane, sample] = SYMBOLS[flat[first[lane] + at + char]]
        have[:lanes] = upto
    made: list[str] = [""] * len(texts)
    for row, i, n in zip(out, order, _levels(walked) * SAMPLES):
        made[i] = row[:n].tobytes().decode("ascii")
    return made


def _weights(n: int) -> np.ndarray:
    """Steps that each of the first ``n`` symbols stands for."""
    return np.repeat([float(_level(j)[1]) for j in range(-(-n // SAMPLES))], SAMPLES)[:n]


def _symbols(prints: list[str]) -> np.ndarray:
    """Fingerprints as rows of equal width, ended by ``END``."""
    width = max((len(p) for p in prints), default=0)
    return np.frombuffer("".join(p.ljust(width, ".") for p in prints).encode("ascii"), np.uint8).reshape(len(prints), width)


def likeness_of_rows(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness of rows of symbols, pairwise (one of them may be a single row)."""
    weight = _weights(a.shape[-1])
    within = (a != END) | (b != END)
    whole = (within * weight).sum(-1)
    return np.where(whole > 0, ((within & (a == b)) * weight).sum(-1) / np.maximum(whole, 1), 1.0)


def likeness(a: str, b: str) -> float:
    """Estimated share of equal steps of two embeddings, 0 to 1; two empty ones are alike."""
    if a == b:
        return 1.0
    x, y = _symbols([a, b])
    return float(likeness_of_rows(x, y))


# --- every document with its edited text and its neighbour ---


def edited_text(text: str, following: str) -> str:
    """``text`` whose last floor(n/3) characters are replaced by the first as many (or all) of ``following``."""
    part = len(text) // 3
    return text[:len(text) - part] + following[:part]


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads buckets, their ids ascending: a document's following text is that of the greatest smaller id.

    ``kind`` is 0 for the first such text, sent along, 1 for a text of the
    bucket's first id that is in another bucket, 2 for the bucket's own rows.
    """
    before, now, now_key = ("", ""), ("", ""), None
    for batch in batches:
        texts = ["" if t is None else t for t in batch["text"].to_pylist()]
        for some in steps(texts, STEP_CHARS):
            part = texts[some]
            rows = list(zip(batch["kind"][some.start:some.stop].to_pylist(), batch["key"][some.start:some.stop].to_pylist()))
            prior, edited = [], []
            for i, ((kind, key), text) in enumerate(zip(rows, part)):
                if kind == 0:
                    now, now_key = (text, i), None
                elif key != now_key:
                    before, now, now_key = now, (text, i), key
                elif text < now[0]:
                    now = (text, i)
                prior.append(before)
                edited.append(edited_text(text, before[0]) if kind == 2 else "")
            made = fingerprints(part + edited)
            own, changed = made[:len(part)], made[len(part):]
            name = lambda p: own[p] if isinstance(p, int) else p  # noqa: E731, B023 - a place in this step, or a fingerprint
            keep = [i for i, (kind, _) in enumerate(rows) if kind == 2]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"].slice(some.start, len(part)).take(pa.array(keep, pa.int64())),
                "n_chars": pa.array([len(part[i]) for i in keep], pa.int64()),
                "edited_sha256": pa.array([hashlib.sha256(edited[i].encode("utf-8")).hexdigest() for i in keep], pa.string()),
                "fingerprint": pa.array([own[i] for i in keep], pa.string()),
                "edited_fingerprint": pa.array([changed[i] for i in keep], pa.string()),
                "near_edited": pa.array([likeness(own[i], changed[i]) for i in keep], pa.float64()),
                "near_next": pa.array([likeness(own[i], name(prior[i][1])) for i in keep], pa.float64()),
            })
            before, now = (before[0], name(before[1])), (now[0], name(now[1]))


def edited_fingerprints(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one of the next smaller doc_id; after the smallest
    the greatest. The edited text has its last floor(n_chars/3) characters replaced by
    as many first ones of the next document, or all that it has. A null
    text is empty; empty texts have empty fingerprints, which are alike and
    unlike all others. A null doc_id counts as the smallest long. Where rows
    repeat a doc_id, each has a row, and the smallest text is that id's
    document for its neighbour. A single document is its own next. Texts are
    read whole, and one text must fit a task. Extra columns are ignored; an
    empty table gives an empty result.

    ``buckets`` (default: four a shuffle partition) sets how finely ids are dealt.
    """
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = pick(docs, doc_id="long", text="string").withColumn("key", F.coalesce("doc_id", F.lit(-(2 ** 63))))
    cuts = plain.agg(F.percentile_approx("key", [i / buckets for i in range(1, buckets)] or [0.5], 20 * buckets)).first()[0] or []
    starts, copies = np.unique(np.array(cuts, np.int64), return_counts=True)
    copies = np.concatenate([[1], copies])  # a hot id is several cuts, and has as many buckets
    last = np.cumsum(copies) - 1

    @F.pandas_udf("int")
    def bucket(key: pd.Series, turn: pd.Series) -> pd.Series:
        k = key.to_numpy(np.int64)
        r = np.searchsorted(starts, k, "right")
        at_start = (r > 0) & (starts[np.maximum(r - 1, 0)] == k) if len(starts) else np.zeros(len(k), bool)
        return pd.Series(np.where(at_start, last[r] - turn.to_numpy(np.int64) % copies[r], last[r]).astype(np.int32))

    dealt = plain.withColumn("bucket", bucket("key", F.monotonically_increasing_id()))
    met = {r.bucket: (r.low, r.high) for r in dealt.groupBy("bucket").agg(F.min("key").alias("low"), F.max("key").alias("high")).collect()}
    sent, prior = [], max((high for _, high in met.values()), default=None)  # before the smallest id stands the greatest
    for r in range(len(copies)):
        mine = range(int(last[r] - copies[r] + 1), int(last[r]) + 1)
        here = [met[b] for b in mine if b in met]
        if here:
            low = min(x for x, _ in here)
            for b in mine:
                sent += [(prior, b, 0)] + ([(low, b, 1)] if len(mine) > 1 else [])
            prior = max(x for _, x in here)
    ahead = spark.createDataFrame(sent, "key long, bucket int, kind int")  # at most two rows a bucket
    texts = plain.join(F.broadcast(ahead.select("key").distinct()), "key", "left_semi").groupBy("key").agg(
        F.min(F.coalesce("text", F.lit(""))).alias("text"))
    rows = dealt.select("doc_id", "text", "key", "bucket", F.lit(2).alias("kind")).unionByName(
        texts.join(F.broadcast(ahead), "key").withColumn("doc_id", F.lit(None).cast("long")))
    return rows.repartition("bucket").sortWithinPartitions("bucket", "kind", "key").mapInArrow(
        _in_order, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


# --- near copies by bands of sampled symbols ---

#: Bands a scale, and symbols a band: 0.8 alike share a band of 8 with probability 0.17, one of 24 such bands with 0.99.
BANDS, WIDTH, SIMILARITY, SPLIT_ROWS = 24, 8, 0.8, 4_000


@functools.cache
def _band_columns(scale: int) -> np.ndarray:
    """The sampled symbols of each band: steps drawn evenly from the first ``scale`` levels."""
    span = np.array([float(_level(j)[1]) for j in range(scale)])
    rng = np.random.default_rng([SEED, 1, scale])
    level = rng.choice(scale, (BANDS, WIDTH), p=span / span.sum())
    return level * SAMPLES + rng.integers(0, SAMPLES, (BANDS, WIDTH))


def band_keys(prints: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the fingerprint, key) of every band, at the scale of its own levels and the next: lengths differ by a level at most."""
    symbols, levels = _symbols([p + "." * SAMPLES for p in prints]).astype(np.uint64), np.array([len(p) // SAMPLES for p in prints], np.int64)
    which, keys = [], []
    for scale in np.unique(np.concatenate([levels, levels + 1])):
        at = np.flatnonzero((levels == scale) | (levels + 1 == scale))
        if scale == 0:
            continue
        mix = np.random.default_rng([SEED, 2, scale]).integers(1, 2 ** 63, (BANDS, WIDTH), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        key = (symbols[at][:, _band_columns(int(scale))] * mix).sum(-1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        which.append(np.repeat(at, BANDS))
        keys.append(key.reshape(-1).view(np.int64))
    return (np.concatenate(which), np.concatenate(keys)) if which else (np.empty(0, np.int64), np.empty(0, np.int64))


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 1_000):
            batch = whole.slice(at, 1_000)
            which, keys = band_keys(batch["fingerprint"].to_pylist())
            yield pa.RecordBatch.from_pydict({"band": pa.array(keys), "print": batch["print"].take(pa.array(which))})


def forest(symbols: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links (row, row) that connect what is alike among the rows: breadth first over what is not yet reached."""
    left, links = np.arange(len(symbols)), []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            hit = likeness_of_rows(symbols[left], symbols[at]) >= similarity
            found, left = left[hit].tolist(), left[~hit]
            links += [(at, x) for x in found]
            queue += found
    return links


def _verified(similarity: float):
    """Reads rows sorted by group; yields the links of each group's forest."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            rows = pd.concat([kept, batch]) if kept is not None else batch
            group = rows["group"].to_numpy()
            done = int(np.searchsorted(group, group[-1])) if len(group) else 0
            yield links(rows.iloc[:done])
            kept = rows.iloc[done:]
        if kept is not None:
            yield links(kept)

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        group, ids, prints, out = rows["group"].to_numpy(), rows["print"].to_numpy(np.int64), rows["fingerprint"].tolist(), []
        cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]])) if len(group) else [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            out += [(ids[a + x], ids[a + y]) for x, y in forest(_symbols(prints[a:b]), similarity)]
        return pd.DataFrame(out, columns=["a", "b"]).astype(np.int64)

    return run


def near_copies(prints: DataFrame, similarity: float = SIMILARITY, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """doc_id and class_id of every row of ``prints`` (doc_id, fingerprint).

    Fingerprints that share a band and are at least ``similarity`` alike are linked;
    a class is what links reach, named by its smallest doc_id (null if it has
    none). Equal fingerprints are one class; null ones count as empty, and
    empty ones are linked to each other only. Distinct fingerprints are told apart by a
    64-bit hash. Repeated rows each have a row. Extra columns are ignored; an
    empty table gives an empty result.

    Buckets with the same members are verified once. A bucket becomes a spanning
    forest, never its pairs; one above ``split_rows`` is cut into blocks, and every
    two blocks are a group, so no link is lost and no task holds a hot bucket.
    """
    plain = pick(prints, doc_id="long", fingerprint="string").withColumn("fingerprint", F.coalesce("fingerprint", F.lit("")))
    plain = plain.withColumn("print", F.xxhash64("fingerprint"))
    classes = durable(plain.groupBy("print", "fingerprint").agg(F.min("doc_id").alias("least")))
    banded = durable(classes.select("print", "fingerprint").mapInArrow(_bands, "band long, print long").distinct())
    buckets = banded.groupBy("band").agg(F.count("*").alias("n"), F.bit_xor("print").alias("x"), F.sum(F.shiftright("print", 20)).alias("s")).where("n > 1")
    buckets = buckets.groupBy("n", "x", "s").agg(F.min("band").alias("band")).select("band", F.ceil(F.col("n") / split_rows).cast("int").alias("blocks"), "n")
    members = banded.join(dealt_anew(buckets, "n", "band").drop("n"), "band").withColumn("block", F.pmod(F.xxhash64("print", F.lit(SEED)), "blocks").cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("blocks < 3 OR block <> other")
    grouped = members.select(F.xxhash64("band", F.least("block", "other"), F.greatest("block", "other")).alias("group"), "print").distinct()
    found = grouped.join(classes.select("print", "fingerprint"), "print").repartition("group").sortWithinPartitions("group").mapInPandas(
        _verified(similarity), "a long, b long").distinct()
    reached = connected_components(found)
    placed = classes.join(reached, classes["print"] == reached["node"], "left").select("print", "least", F.coalesce("component", "print").alias("of"))
    named = placed.groupBy("of").agg(F.min("least").alias("class_id"), F.count("*").alias("n"))
    by_print = placed.join(dealt_anew(named, "n", "of"), "of").select("print", "class_id")
    return plain.join(by_print, "print").select("doc_id", "class_id")


def query(spark, sf_dir: str) -> DataFrame:
    return edited_fingerprints(read(spark, sf_dir, "documents"))
