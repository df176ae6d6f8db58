"""Exact top-k by inner product with a pivot table.

Every vector's distances to a set of pivots are computed once and kept with
it. By the triangle inequality |d(q, p) - d(x, p)| bounds d(q, x) from below for
every pivot p; the largest of these bounds the inner product from above,
<q, x> = (|q|^2 + |x|^2 - d(q, x)^2) / 2. A query takes its candidates in the
order of their bounds and stops when its k-th score beats the next bound.

Scale: the stated query set meets all rows in blocks. Queries and candidates
are dealt into blocks by hash, every pair of blocks is one group of at most
``block_rows`` + ``block_rows`` vectors, and a group returns k rows a query. The
pivots are ``pivots`` vectors, whatever the table's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dimfold.llm.common import durable, pick, read

K, EVERY, SCALE = 5, 50, 256
PIVOTS, BLOCK_ROWS = 32, 32_768


def _matrix(vectors: list, width: int) -> np.ndarray:
    """Rows of equal width; shorter vectors end in zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances, a row for each of ``v``."""
    a, b = v.astype(float), pivots.astype(float)
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0))


def upper_bounds(q: np.ndarray, q_dist: np.ndarray, x_norm: np.ndarray, x_dist: np.ndarray) -> np.ndarray:
    """Upper bounds of the inner products of each query with each candidate."""
    low = np.zeros((len(q), len(x_dist)))
    for p in range(x_dist.shape[1]):
        np.maximum(low, np.abs(q_dist[:, p, None] - x_dist[None, :, p]), out=low)
    # sums of squares of integers are exact, roots are not: give way by more than their error
    q_norm = (q.astype(float) ** 2).sum(1)
    slack = 1e-6 * (1 + np.sqrt(q_norm)[:, None] + np.sqrt(x_norm)[None, :])
    low = np.maximum(low - slack, 0)
    return (q_norm[:, None] + x_norm[None, :] - low * low) / 2


def search(q_ids, q, q_dist, x_ids, x, x_dist, k: int, step: int = 128) -> list[tuple[int, int, int]]:
    """(query, vector, score): the k best of ``x`` for each query but itself; ties go to the smaller id."""
    out, x_norm = [], (x.astype(float) ** 2).sum(1)
    for at in range(0, len(q), 64):
        bounds = upper_bounds(q[at:at + 64], q_dist[at:at + 64], x_norm, x_dist)
        order = np.argsort(-bounds, axis=1, kind="stable")
        for i, (bound, turn) in enumerate(zip(bounds, order), at):
            best_ids, best = np.empty(0, np.int64), np.empty(0, np.int64)
            for j in range(0, len(turn), step):
                if len(best) == k and best[-1] > bound[turn[j]]:
                    break
                some = turn[j:j + step]
                some = some[x_ids[some] != q_ids[i]]
                best_ids, best = np.concatenate([best_ids, x_ids[some]]), np.concatenate([best, x[some] @ q[i]])
                first = np.lexsort((best_ids, -best))[:k]
                best_ids, best = best_ids[first], best[first]
            out += [(int(q_ids[i]), a, b) for a, b in zip(best_ids.tolist(), best.tolist())]
    return out


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The k best (query_id, rank, vec_id, score) of each row whose vec_id is divisible by ``every``.

    ``vectors`` has vec_id and embedding; a component x counts as
    floor(scale * x). Fewer than k candidates are all returned. Rows with a
    null id, a null vector or a null or non-finite component take no part.
    Rows repeated in id and vector count once; a query's own id is no
    candidate. Vectors of unequal length are continued with zeros. Scores are
    exact while they fit a long. Extra columns are ignored; an empty table
    gives an empty result.
    """
    plain = pick(vectors, vec_id="long", embedding="array<double>").where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
        & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    whole = plain.select("vec_id", F.transform("embedding", lambda x: F.floor(x * scale)).alias("v")).distinct()
    whole = durable(whole)
    size = whole.agg(F.count("*").alias("n"), F.sum(F.when(F.col("vec_id") % every == 0, 1)).alias("q"), F.max(F.size("v")).alias("width")).first()
    spark, width = vectors.sparkSession, size.width or 0
    drawn = whole.orderBy(F.xxhash64("vec_id"), "vec_id").limit(4 * pivots).collect()
    chosen = _matrix(list(dict.fromkeys(tuple(r.v) for r in drawn))[:pivots], width)

    def distances(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(list(_distances(_matrix(batch.tolist(), width), chosen)))

    table = durable(whole.withColumn("dist", F.pandas_udf(distances, "array<double>")("v")))  # the pivot table
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size.n // block_rows))
    query_blocks = max(1, -(-(size.q or 0) // block_rows))
    block = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    every_block = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = table.withColumn("x_block", block(blocks, 1)).withColumn("q_block", every_block(query_blocks))
    queries = table.where(F.col("vec_id") % every == 0).withColumn("q_block", block(query_blocks, 2)).withColumn("x_block", every_block(blocks))

    def group(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        rows = [] if q.empty or x.empty else search(
            q["vec_id"].to_numpy(np.int64), _matrix(q["v"].tolist(), width), np.stack(q["dist"].tolist()),
            x["vec_id"].to_numpy(np.int64), _matrix(x["v"].tolist(), width), np.stack(x["dist"].tolist()), k)
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    key = ["q_block", "x_block"]
    found = queries.groupBy(*key).cogroup(candidates.groupBy(*key)).applyInPandas(group, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: DuckDB form of the op2 query.
ORACLE = """
WITH e AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_dot_product(q.v, x.v) AS BIGINT) AS score
  FROM e q JOIN e x ON q.vec_id <> x.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


def query(spark, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"))
