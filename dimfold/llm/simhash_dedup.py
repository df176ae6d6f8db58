"""SimHash near-duplicates, found by fuzzy hashing with the binary Golay code.

A fingerprint's 64 bits are cut into segments of 23, 23 and 18. The Golay code
of length 23 has one codeword within 3 bits of every word, so a segment is
decoded to the index of its nearest codeword; a segment 3 bits off also takes
the five codewords 4 bits away. Two segments that differ in at most two bits
then share an index. With at most four differing bits in all (g1, g2, r):

* none over 2: all three segments share an index;
* r >= 3: then g1 + g2 <= 1, one long segment is equal and the other shares an index;
* g1 >= 3: then g2 + r <= 1, one of the two is equal and the other shares an index;
* g2 >= 3: the same with the long segments exchanged.

Each case is a family of join keys, seven in all (about 180 keys a fingerprint, of
30 to 36 bits), and every candidate pair is verified by its bit distance. Of two
random fingerprints fewer than one pair in two million share a key.

Scale: documents of one fingerprint are one class before any key is made. A
bucket is turned into a spanning forest where it is found, not into its pairs,
and a bucket above ``split_rows`` is cut into blocks whose pairs of blocks go to
different tasks. Components are joined over the links by rounds of stars.
"""

from __future__ import annotations

from functools import lru_cache
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dimfold.llm.common import dealt_anew, durable, give_back, pick, read
from dimfold.llm.components import connected_components

MAX_DISTANCE = 4
HASH_SEED = 42
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, the generator of the Golay code.
GOLAY_GENERATOR = 0b110001110101
LONG_BITS, SHORT_BITS = 23, 18

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LANES = (np.arange(8) * 256)[None, :]


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of one text; 0 if it has no words."""
    import xxhash  # here, so that the queries of all other operators do without it

    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    joined = b" ".join(w)
    if len(w) <= shingle:
        return xxhash.xxh64_intdigest(joined, HASH_SEED)
    size = np.fromiter(map(len, w), np.int64, len(w))
    end = np.cumsum(size + 1) - 1
    start = (end - size)[: len(w) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], HASH_SEED) for a, b in zip(start, end[shingle - 1:].tolist())], np.uint64)
    seen = np.bincount((h.astype("<u8").view(np.uint8).reshape(-1, 8) + _LANES).ravel(), minlength=2048)
    ones = (seen.reshape(8, 256) @ _BITS).ravel()
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


@lru_cache(1)
def _nearest_codeword() -> np.ndarray:
    """For each of the 2^23 words the index of the codeword within 3 bits."""
    index = np.arange(4096, dtype=np.uint32)
    words = np.zeros(4096, np.uint32)
    for bit in range(12):
        words ^= np.where(index >> bit & 1, np.uint32(GOLAY_GENERATOR << bit), np.uint32(0))
    one = np.uint32(1) << np.arange(LONG_BITS, dtype=np.uint32)
    near = {0, *one.tolist()}
    for _ in range(2):
        near |= {x ^ y for x in near for y in one.tolist()}
    near = np.array(sorted(x for x in near if x.bit_count() <= 3), np.uint32)
    table = np.empty(1 << LONG_BITS, np.int16)
    for i in range(0, 4096, 256):
        table[words[i:i + 256, None] ^ near] = index[i:i + 256, None]
    return table


def segment_keys(segment: np.ndarray) -> np.ndarray:
    """The distinct codeword indices of each segment, six columns, -1 where none.

    The codewords 4 bits from a word are the nearest ones of its neighbours.
    """
    flips = np.concatenate([[0], 1 << np.arange(LONG_BITS)]).astype(np.uint32)
    near = np.sort(_nearest_codeword()[segment.astype(np.uint32)[:, None] ^ flips], axis=1).astype(np.int64)
    near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
    return -np.sort(-near, axis=1)[:, :6]


def _keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for whole in batches:
        for at in range(0, len(whole), 4_000):
            signed = whole["fp"].to_numpy(np.int64)[at:at + 4_000]
            fp = signed.view(np.uint64)
            low = (1 << LONG_BITS) - 1
            one, two, short = (fp & low).astype(np.int64), (fp >> 23 & low).astype(np.int64), (fp >> 46).astype(np.int64)
            k1, k2, k3 = segment_keys(one), segment_keys(two), segment_keys(short)
            a, b, c = k1[:, :, None, None], k2[:, None, :, None], k3[:, None, None, :]
            all_three = (a << 24 | b << 12 | c).reshape(len(fp), -1), ((a >= 0) & (b >= 0) & (c >= 0)).reshape(len(fp), -1)
            equal_and_near = ((one, k2), (two, k1), (short, k2), (two, k3), (short, k1), (one, k3))
            families = [all_three, *((equal[:, None] << 12 | near, near >= 0) for equal, near in equal_and_near)]
            for n, (key, real) in enumerate(families):
                yield pd.DataFrame({"key": (key | n << 40)[real], "fp": np.broadcast_to(signed[:, None], key.shape)[real]})


def _forest(fp: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Links that join each component of one bucket to its smallest member.

    Breadth first over what is not yet reached, so a dense bucket costs about
    one look per member.
    """
    left, links = np.sort(fp), []
    while len(left) > 1:
        root, queue, left = left[0], [left[0]], left[1:]
        while queue and len(left):
            hit = np.bitwise_count((left ^ queue.pop()).view(np.uint64)) <= limit
            if hit.any():
                found = left[hit].tolist()
                queue += found
                links += [(root, x) for x in found]
                left = left[~hit]
    return links


def bucket_links(key: np.ndarray, fp: np.ndarray, limit: int) -> np.ndarray:
    """Links (smaller, larger) that connect what lies within ``limit`` bits in the buckets of sorted ``key``."""
    bounds = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    size = np.diff(bounds)
    bucket = np.repeat(np.arange(len(size)), size)
    out, count = [], np.zeros(len(size), np.int64)
    at, lag = np.flatnonzero(size[bucket] <= 64), 1
    while len(at):
        at = at[at + lag < len(key)]
        at = at[bucket[at] == bucket[at + lag]]
        near = at[np.bitwise_count((fp[at] ^ fp[at + lag]).view(np.uint64)) <= limit]
        near = near[fp[near] != fp[near + lag]]
        out.append(np.stack([bucket[near], fp[near], fp[near + lag]], 1))
        count += np.bincount(bucket[near], minlength=len(size))
        lag += 1
    pairs = np.concatenate(out) if out else np.empty((0, 3), np.int64)
    links = [pairs[count[pairs[:, 0]] < size[pairs[:, 0]]][:, 1:]]  # a denser one becomes a forest
    for b in np.flatnonzero((size > 64) | (count >= size)):
        if found := _forest(np.unique(fp[bounds[b]:bounds[b + 1]]), limit):
            links.append(np.array(found, np.int64))
    both = np.concatenate(links)
    return np.unique(np.sort(both, axis=1), axis=0) if len(both) else both


def _links(limit: int, split: int | None):
    """Reads rows sorted by key; yields links, and rows of larger buckets with a block number to be dealt anew."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def shape(a, b, key, block):
            return pd.DataFrame({"a": a, "b": b, "key": key, "block": block})

        def linked(key, fp):
            found = bucket_links(key, fp, limit)
            return shape(found[:, 0], found[:, 1], np.int64(-1), np.int64(-1))

        keys, fps, deferred, block = np.empty(0, np.int64), np.empty(0, np.int64), None, 0
        for batch in batches:
            keys = np.concatenate([keys, batch["key"].to_numpy(np.int64)])
            fps = np.concatenate([fps, batch["fp"].to_numpy(np.int64)])
            last = np.searchsorted(keys, keys[-1]) if len(keys) else 0
            if last:
                done = np.searchsorted(keys, deferred, "right") if deferred is not None else 0
                if done:
                    yield shape(fps[:done], fps[:done], keys[:done], np.int64(block))
                    deferred, block = None, 0
                if last > done:
                    yield linked(keys[done:last], fps[done:last])
                keys, fps = keys[last:], fps[last:]
            if split and len(keys) > split:
                yield shape(fps, fps, keys, np.int64(block))
                deferred, block = keys[0], block + 1
                keys, fps = keys[:0], fps[:0]
        if len(keys):
            if deferred is not None and deferred == keys[0]:
                yield shape(fps, fps, keys, np.int64(block))
            else:
                yield linked(keys, fps)

    return run


def fingerprint_links(classes: DataFrame, max_distance: int = MAX_DISTANCE, split_rows: int = 50_000) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints ``classes(fp)`` within ``max_distance`` bits."""
    if not 0 <= max_distance <= MAX_DISTANCE:
        raise ValueError(f"the keys cover distances up to {MAX_DISTANCE}")
    schema = "a long, b long, key long, block long"
    keyed = classes.select("fp").mapInPandas(_keys, "key long, fp long")
    first = durable(keyed.repartition("key").sortWithinPartitions("key").mapInPandas(_links(max_distance, split_rows), schema))
    large = first.where("block >= 0").select("key", "block", F.col("a").alias("fp"))
    blocks = large.groupBy("key").agg(F.max("block").alias("top"))
    dealt = (
        large.join(blocks, "key").withColumn("other", F.explode(F.sequence(F.lit(0), "top")))
        .select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("key"), "fp"))
    second = dealt.repartition("key").sortWithinPartitions("key").mapInPandas(_links(max_distance, None), schema)
    return first.where("block < 0").unionByName(second).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 4, max_distance: int = MAX_DISTANCE, split_rows: int = 50_000) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fingerprint, component_id, group, row_hash.

    ``component_id`` is the smallest doc_id among all documents reachable over
    links of at most ``max_distance`` bits; ``group`` the smallest fingerprint
    there, signed. Null, empty and blank texts have fingerprint zero and are
    linked like any other. A null doc_id is never the smallest; the component
    is null if it has no other. Repeated rows get equal results. Very long
    texts are hashed whole. Extra columns are ignored; an empty table gives
    an empty result.
    """
    @F.pandas_udf("long")
    def simhash(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in batch], np.uint64).view(np.int64))
            give_back()

    marked = durable(pick(docs, doc_id="long", text="string").select(
        "doc_id", F.xxhash64("text").alias("row_hash"), simhash("text").alias("fp")))
    classes = durable(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    comps = connected_components(fingerprint_links(classes, max_distance, split_rows))
    placed = classes.join(comps, classes["fp"] == comps["node"], "left").select(
        "fp", "least_id", F.coalesce("component", "fp").alias("group"))
    ids = placed.groupBy("group").agg(F.min("least_id").alias("component_id"), F.count("*").alias("n"))
    by_fp = placed.join(dealt_anew(ids, "n", "group"), "group").select("fp", "group", "component_id")
    return marked.join(by_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "group", "row_hash")


def keep_one(docs: DataFrame, **params) -> DataFrame:
    """The documents that stay, one of each group (its smallest doc_id), with the columns of ``documents``."""
    plain = pick(docs, doc_id="long", text="string", lang="string", source="string", n_chars="long")
    found = near_duplicates(plain, **params)
    stays = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_hash")).alias("x")).select(
        F.col("x.doc_id").alias("id"), F.col("x.row_hash").alias("hash"))
    mine = plain.withColumn("row_hash", F.xxhash64("text"))
    same = Window.partitionBy("doc_id", "row_hash").orderBy(F.lit(0))
    return (
        mine.join(stays, mine["doc_id"].eqNullSafe(stays["id"]) & (mine["row_hash"] == stays["hash"]))
        .withColumn("copy", F.row_number().over(same)).where("copy = 1")
        .select("doc_id", "text", "lang", "source", "n_chars"))


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
