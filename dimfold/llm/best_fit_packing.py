"""Best-fit packing planned over a histogram of lengths.

A document becomes its token ids and an end id; only what is longer than a
sequence is cut. The plan packs counts, not documents: at most ``capacity``
lengths with their numbers go through best-fit decreasing, where bins of equal
content are one entry with a count. Pieces then take the planned slots by their
rank within their length.

Scale: texts are tokenised once, inside tasks; only (id, piece, start, length,
checksum) is kept. The driver sees the histogram, at most ``capacity`` rows. The
plan has a few rows for each length and bin content, so its size is bounded by
``capacity`` too and it is broadcast. A length that a third of all pieces share
is ranked in ``salts`` parts whose counts are summed up first.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dimfold.llm.common import TASK_CACHE, durable, pick, read, steps

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 2048
END_ID = 0
SALTS = 256


class WordCache:
    """Token ids by word; the tokenizer neither joins across blanks nor minds the case of A-Z.

    A full stop or comma after a letter starts a token of its own, so a word
    that ends so is its stem and the mark. Beyond ``most`` words those met only
    once are forgotten, which costs time only.
    """

    def __init__(self, path: str, most: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.most = most
        self.mark = int(self._encode("|")[0])
        self.place: dict[bytes, int] = {}
        self.start, self.size, self.uses, self.ids = (np.zeros(0, t) for t in (np.int64, np.int32, np.int32, np.uint32))

    def _forget(self) -> None:
        keep = self.uses > 1
        if keep.mean() > 0.5:  # too little would be gained
            keep[:] = False
        words = [w for w, k in zip(self.place, keep.tolist()) if k]
        size, flat = self._gather(np.flatnonzero(keep))
        self.place, self.start, self.size, self.uses, self.ids = {}, self.start[:0], self.size[:0], self.uses[:0], self.ids[:0]
        self._add(words, size, flat)

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _learn(self, new: list[bytes]) -> None:
        stems = [w for w in new if len(w) > 1 and w[-1] in b".," and 97 <= w[-2] <= 122]
        need = dict.fromkeys(new)
        for w in stems:
            del need[w]
        need.update((x, None) for w in stems for x in (w[:-1], w[-1:]))
        need = [w for w in need if w not in self.place]
        plain = [w for w in need if b"|" not in w]
        sizes, flats = [], []
        for i in range(0, len(plain), 1000):  # many at once, a bar between them
            ids = np.append(self._encode(b" | ".join(plain[i:i + 1000]).decode("utf-8", "replace")), np.uint32(self.mark))
            bars = ids == self.mark
            sizes.append(np.diff(np.flatnonzero(bars), prepend=-1) - 1)
            flats.append(ids[~bars])
        odd = [w for w in need if b"|" in w]
        for w in odd:
            flats.append(self._encode(w.decode("utf-8", "replace")))
            sizes.append(np.array([len(flats[-1])]))
        if need:
            self._add(plain + odd, np.concatenate(sizes), np.concatenate(flats))
        if stems:
            pair = np.fromiter((self.place[x] for w in stems for x in (w[:-1], w[-1:])), np.int64, 2 * len(stems))
            size, flat = self._gather(pair)
            self._add(stems, size.reshape(-1, 2).sum(1), flat)

    def _add(self, words: list[bytes], size: np.ndarray, flat: np.ndarray) -> None:
        self.place.update(zip(words, range(len(self.size), len(self.size) + len(words))))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size, dtype=np.int64) - size])
        self.size, self.ids = np.concatenate([self.size, size.astype(np.int32)]), np.concatenate([self.ids, flat])
        self.uses = np.concatenate([self.uses, np.zeros(len(words), np.int32)])

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids, one after another, of the words of these numbers."""
        size = self.size[at].astype(np.int64)
        return size, self.ids[np.repeat(self.start[at] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each whole text."""
        if len(self.place) > self.most:
            self._forget()
        split = [(t or "").encode("utf-8", "replace").lower().split() for t in texts]
        places = [np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words)) for words in split]
        unknown = [np.flatnonzero(at < 0) for at in places]
        if new := list(dict.fromkeys(words[i] for words, gaps in zip(split, unknown) for i in gaps)):
            self._learn(new)
        for words, at, gaps in zip(split, places, unknown):
            at[gaps] = [self.place[words[i]] for i in gaps]
        if places:
            self.uses += np.bincount(np.concatenate(places), minlength=len(self.uses)).astype(np.int32)
        for at in places:
            yield self._gather(at)[1]


def token_ids(texts: list[str | None], path: str) -> Iterator[np.ndarray]:
    """Token ids of each whole text; a worker keeps the words it has seen."""
    return TASK_CACHE.get(f"words of {path}", lambda: WordCache(path)).encode(texts)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Best-fit decreasing over ``counts`` (length: number).

    Returns rows (length, first rank, number, sequence, per, offset) and the
    number of sequences: the piece of rank r (``first`` <= r < first + number)
    goes to sequence + (r - first) // per, at offset + (r - first) % per * length.
    """
    room: dict[int, list[list]] = {}  # free tokens: entries [number of bins, contents (length, per, offset), ...]
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            best = next((r for r in range(length, capacity) if room.get(r)), None)
            number, contents = room[best].pop() if best is not None else [left, ()]
            free = capacity if best is None else best
            per = free // length
            use = min(number, left // per)
            if use == 0:  # the last pieces fill one bin in part
                use, per = 1, left
            if best is not None and number > use:
                room[best].append([number - use, contents])
            room.setdefault(free - per * length, []).append([use, (*contents, (length, per, capacity - free))])
            left -= use * per
    rows, rank, sequence = [], {}, 0
    for free in sorted(room):
        for number, contents in room[free]:
            for length, per, offset in contents:
                first = rank.get(length, 0)
                rows.append((length, first, number * per, sequence, per, offset))
                rank[length] = first + number * per
            sequence += number
    return rows, sequence


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str, capacity: int, with_ids: bool):
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
    schema = pa.schema(list(zip([x.split()[0] for x in PIECE.split(", ")] + ["ids"], types))[: 6 if with_ids else 5])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch.column(1), 2_000_000):
                rows, some = [], batch.slice(part.start, part.stop - part.start)
                for doc, ids in zip(some.column(0).to_pylist(), token_ids(some.column(1).to_pylist(), path)):
                    ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                    for n, start in enumerate(range(0, len(ids), capacity)):
                        piece = ids[start:start + capacity]
                        rows.append((doc, n, start, len(piece), zlib.crc32(piece.tobytes()), piece.astype(np.int32) if with_ids else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): its tokens and its place.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset and,
    if asked for, ids. ``tokenizer`` is the path of a tokenizer file.

    Null, empty and blank texts are the end id alone. Null and repeated
    doc_ids: every row is a document and is packed. Pieces of one length are
    interchangeable; ties go by doc_id and piece. An empty table gives an
    empty result; extra columns are ignored.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)
    schema = PIECE + (", ids array<int>" if with_ids else "")
    plain = pick(docs, doc_id="long", text="string")
    pieces = durable(plain.mapInArrow(_pieces(tokenizer, capacity, with_ids), schema).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS))))
    tally = durable(pieces.groupBy("length", "salt").agg(F.count("*").alias("number")))
    slots, _ = plan({r.length: r.number for r in tally.groupBy("length").agg(F.sum("number").alias("number")).collect()}, capacity)
    spark = docs.sparkSession
    slot = spark.createDataFrame(slots, "slot_length long, first long, number long, sequence long, per long, at long")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = tally.select("length", "salt", F.coalesce(F.sum("number").over(before), F.lit(0)).alias("base"))
    rank = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = pieces.withColumn("nth", rank).join(base, ["length", "salt"]).withColumn("rank", F.col("base") + F.col("nth") - 1)
    placed = ranked.join(F.broadcast(slot), F.expr("length = slot_length AND rank >= first AND rank < first + number"))
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.expr("sequence + (rank - first) div per").alias("sequence_id"),
        F.expr("at + (rank - first) % per * length").alias("offset"), *(["ids"] if with_ids else []))


def query(spark, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
