"""Hard negatives by Fagin's threshold algorithm.

Scores are inner products, monotone in every component once its sign in the
anchor is known. So a block of candidates keeps one list per dimension, sorted
by that component; an anchor reads each list from its large end where its own
component is positive and from its small end where it is negative (sorted
access). Every row met for the first time is scored from its whole integer
vector (random access). The sum of the anchor's components times the values
last read is the threshold: no row still unseen scores more. Reading stops once
the threshold is strictly below the k-th score of every window (so that ties
are all seen), or below the window's own lower limit.

Two passes: the best rows of the anchor's label are its positives, whose
scores are the windows of the second pass, over rows of other labels.

Scale: the stated anchors meet all rows in blocks. Anchors and rows are dealt
into blocks by hash of the id, so a hot label is spread over all of them; a pair of
blocks is one group of at most about ``block_rows`` + ``block_rows`` rows and returns k
rows an anchor or window, which a ranked window (group limit before the
shuffle) merges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dimfold.llm.common import matrix, read, stage_table, whole_vectors

ANCHORS_EVERY, POSITIVES, NEGATIVES, SCALE = 100, 5, 5, 256
LOW, HIGH = 80, 100
BLOCK_ROWS = 32_768


def sorted_lists(x: np.ndarray) -> np.ndarray:
    """Row numbers of ``x`` ordered by each component, ascending, a column a dimension."""
    return np.argsort(x, axis=0, kind="stable").astype(np.int32)


def read_lists(q: np.ndarray, x: np.ndarray, lists: np.ndarray, step: int = 32) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
    """(rows first seen, their scores, threshold) as the lists are read deeper; the last threshold is None.

    Each turn reads half as deep again as all before, ``step`` rows of each list at least.
    """
    dims = np.flatnonzero(q) if q.any() else np.arange(1)  # a zero component adds nothing to any score
    ordered = lists[:, dims]
    ordered[:, q[dims] > 0] = ordered[::-1, q[dims] > 0]
    seen, depth = np.zeros(len(x), bool), 0
    while depth < len(x):
        to = min(len(x), depth + max(step, depth // 2))
        before = seen.copy()
        seen[ordered[depth:to]] = True
        rows = np.flatnonzero(seen != before)
        depth = to
        threshold = None if depth == len(x) else int((q[dims] * x[ordered[depth - 1], dims]).sum())
        yield rows, (x[rows] @ q).astype(np.int64), threshold


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(ids) > k:  # nothing below the k-th score can be among the first k
        some = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        ids, scores = ids[some], scores[some]
    first = np.lexsort((ids, -scores))[:k]
    return ids[first], scores[first]


def first_in_windows(q: np.ndarray, windows: list[tuple[int, int]], k: int, ids: np.ndarray, allowed: np.ndarray,
                     x: np.ndarray, lists: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The first k (ids, scores) among the ``allowed`` rows for each window of scores (lowest, highest).

    Higher scores come first, ties by smaller id.
    """
    best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in windows]
    open_ = [w for w, (low, high) in enumerate(windows) if low <= high]
    for rows, scores, threshold in read_lists(q, x, lists) if open_ else ():
        fit = allowed[rows]
        new_ids, new = ids[rows[fit]], scores[fit]
        for w in open_:
            low, high = windows[w]
            inside = (new >= low) & (new <= high)
            if inside.any():
                best[w] = _first(np.concatenate([best[w][0], new_ids[inside]]), np.concatenate([best[w][1], new[inside]]), k)
        if threshold is None:
            break
        open_ = [w for w in open_ if threshold >= windows[w][0] and not (len(best[w][0]) == k and threshold < best[w][1][-1])]
        if not open_:
            break
    return best


def _window(positive: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores s with low * positive <= 100 * s <= high * positive."""
    return -(-low * positive // 100), high * positive // 100


EVERY_SCORE = (-(2 ** 63), 2 ** 63 - 1)


def _group(width: int, k: int, limits: tuple[int, int] | None):
    """The search of one block of anchors in one block of rows: positives without ``limits``, else negatives."""
    def run(a: pa.Table, x: pa.Table) -> pa.Table:
        out = []
        if a.num_rows and x.num_rows:
            vectors, ids, labels = matrix(x["v"], width), x["vec_id"].to_numpy(), np.array(x["label"].to_pylist(), object)
            lists, asked = sorted_lists(vectors), matrix(a["v"], width)
            if float(np.abs(vectors).max()) * float(np.abs(asked).max()) * width < 2 ** 53:
                vectors, asked = vectors.astype(float), asked.astype(float)  # whole numbers still, and faster products
            positives = a["positives"].to_pylist() if limits else [None] * a.num_rows
            for anchor, label, q, found in zip(a["vec_id"].to_pylist(), a["label"].to_pylist(), asked, positives):
                same = labels == label
                if limits:
                    windows = [_window(p["positive_score"], *limits) for p in found]
                    best = first_in_windows(q, windows, k, ids, ~same, vectors, lists)
                    out += [(anchor, p["positive_id"], p["positive_score"], i, s) for p, b in zip(found, best) for i, s in zip(*map(np.ndarray.tolist, b))]
                else:
                    (b,) = first_in_windows(q, [EVERY_SCORE], k, ids, same & (ids != anchor), vectors, lists)
                    out += [(anchor, i, s) for i, s in zip(*map(np.ndarray.tolist, b))]
        names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"][:5 if limits else 3]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * len(names))], names)

    return run


def mine(vectors: DataFrame, every: int = ANCHORS_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, scale: int = SCALE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score from ``vectors`` (vec_id, embedding, label).

    Anchors are the rows whose vec_id is divisible by ``every``; an anchor's
    positives are its ``positives`` best other rows of its label. For each, the
    ``negatives`` best rows of other labels with low * positive_score <=
    100 * negative_score <= high * positive_score are returned, fewer if there
    are no more; ties go to the smaller vec_id. A component x counts as
    floor(scale * x); a score is the inner product, exact while it fits a long.

    Rows with a null vec_id or label, a null vector, or a null or non-finite
    component take no part. Of rows repeated in vec_id the smallest by label and
    vector counts. Vectors of unequal length are continued with zeros. A
    negative positive_score leaves an empty window if low < high. Extra columns
    are ignored; an empty table gives an empty result.
    """
    rows = whole_vectors(vectors, scale, vec_id="long", label="string").where("vec_id IS NOT NULL AND label IS NOT NULL")
    rows = stage_table(rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v"))
    size = rows.agg(F.count("*").alias("n"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("a"), F.max(F.size("v")).alias("width")).first()
    width = max(size.width or 1, 1)
    blocks = max(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size.n // block_rows))
    anchor_blocks = max(1, -(-size.a // block_rows))
    block = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    every_block = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    key = ["a_block", "x_block"]
    candidates = rows.withColumn("x_block", block(blocks, 1)).withColumn("a_block", every_block(anchor_blocks)).groupBy(*key)
    anchors = rows.where(F.col("vec_id") % every == 0)

    def searched(some: DataFrame, run, schema: str) -> DataFrame:
        dealt = some.withColumn("a_block", block(anchor_blocks, 2)).withColumn("x_block", every_block(blocks))
        return dealt.groupBy(*key).cogroup(candidates).applyInArrow(run, schema)

    def ranked(found: DataFrame, of: list[str], score: str, tie: str, k: int) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*of).orderBy(F.desc(score), tie))
        return found.withColumn("rank", rank).where(F.col("rank") <= k)

    near = searched(anchors, _group(width, positives, None), "anchor_id long, positive_id long, positive_score long")
    near = ranked(near, ["anchor_id"], "positive_score", "positive_id", positives)
    windows = near.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    windows = stage_table(anchors.join(windows, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id"))
    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = searched(windows, _group(width, negatives, (low, high)), schema)
    return ranked(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


#: DuckDB form of the op11 query.
ORACLE = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, x.vec_id, x.label = a.label AS same, CAST(list_dot_product(a.v, x.v) AS BIGINT) AS score
  FROM e a JOIN e x ON a.vec_id <> x.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
QUALIFY rank <= 5
"""


def relabelled(vectors: DataFrame) -> DataFrame:
    """``label`` becomes (label + 1) % 10 where vec_id is divisible by 7."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.withColumn("label", moved)


def query(spark, sf_dir: str) -> DataFrame:
    return mine(relabelled(read(spark, sf_dir, "embeddings")))
