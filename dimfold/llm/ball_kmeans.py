"""Vector codes: product quantization with codebooks trained by ball k-means.

Vectors are cut into equal consecutive parts; each part position has a
codebook, trained by a fixed number of exact k-means rounds. An entry with the
parts that it holds is a ball; its radius is the largest distance of such a
part. With i the entry that holds part x (of the round before) and d distances:

* only entries j with d(i, j) <= 2 * radius(i) are neighbours of i: no other
  entry can be nearest to any part of the ball;
* a part with 2 * d(x, i) < d(i, nearest neighbour) is in the stable core: it
  stays, and no distance is computed;
* the neighbours, ordered by d(i, j), cut the rest into rings: a part is
  compared with exactly the neighbours within 2 * d(x, i).

Distances are squares of integers (4 * d(x, i)^2 against d(i, j)^2), so every
decision is exact, ties included. A ball is taken over one block of rows, which
makes its radius only smaller.

Scale: a round is one scan of a Parquet table in the shared folder, holding
the vectors and the codes of the round before, and one aggregate of a sum per
(part, entry, position), combined in the tasks. The driver and the tasks hold
the codebooks, whose size is a parameter. No vector is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimfold.llm.common import dealt_anew, matrix, read, stage_table, whole_vectors

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components of the (part, entry) pairs that one step may hold.
STEP = 4_000_000


def assign(x: np.ndarray, code: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest entry, its squared distance, pairs compared) of each row of ``x``, held by ``code`` so far.

    Ties go to the lower index. ``entries`` has a row an entry; all are integers.
    """
    gap = ((entries[:, None] - entries[None]) ** 2).sum(2)
    np.fill_diagonal(gap, -1)
    order = np.argsort(gap, axis=1, kind="stable")[:, 1:]
    gap = np.take_along_axis(gap, order, 1)
    code, dist = code.copy(), ((x - entries[code]) ** 2).sum(1)
    held = np.argsort(code, kind="stable")
    bounds = np.searchsorted(code[held], np.arange(len(entries) + 1))
    ring = np.zeros(len(x), np.int64)
    for i in range(len(entries)):
        ball = held[bounds[i]:bounds[i + 1]]
        if len(ball):
            neighbours = gap[i, :np.searchsorted(gap[i], 4 * dist[ball].max(), "right")]
            ring[ball] = np.searchsorted(neighbours, 4 * dist[ball], "right")
    moving = np.flatnonzero(ring)  # the others are in stable cores
    if not len(moving):
        return code, dist, 0
    count = ring[moving]
    first = np.cumsum(count) - count
    part = np.repeat(moving, count)
    other = order[code[part], np.arange(len(part)) - np.repeat(first, count)]
    ranked = ((x[part] - entries[other]) ** 2).sum(1) * len(entries) + other
    best = np.minimum(np.minimum.reduceat(ranked, first), dist[moving] * len(entries) + code[moving])
    code[moving], dist[moving] = best % len(entries), best // len(entries)
    return code, dist, len(part)


def _pass(entries: np.ndarray):
    """Reads v and code, yields every row with its new code and error. ``entries``: part x entry x position."""
    parts, k, width = entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            size = max(1, STEP // (k * width))
            for at in range(0, whole.num_rows, size):
                batch = whole.slice(at, size)
                x = matrix(batch["v"], parts * width).reshape(-1, parts, width)
                old = np.array([list(c) for c in batch["code"].to_pylist()], np.int64)
                code, error = np.empty_like(old), np.zeros(len(x), np.int64)
                for p in range(parts):
                    code[:, p], dist, _ = assign(x[:, p], old[:, p], entries[p])
                    error += dist
                new = {"code": pa.array([bytes(c) for c in code.astype(np.uint8).tolist()], pa.binary()), "error": pa.array(error)}
                yield pa.RecordBatch.from_pydict({n: new.get(n, batch[n] if n in batch.schema.names else None) for n in ("vec_id", "label", "v", "code", "error")})

    return run


def _sums(shape: tuple[int, int, int]):
    """Reads v and code, yields one row per (part, entry, position) that the task met: its parts and their sum."""
    parts, k, width = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(shape, np.int64), np.zeros((parts, k), np.int64)
        for batch in batches:
            x = matrix(batch["v"], parts * width).reshape(-1, parts, width)
            code = np.array([list(c) for c in batch["code"].to_pylist()], np.int64)
            for p in range(parts if len(x) else 0):
                np.add.at(total[p], code[:, p], x[:, p])
                count[p] += np.bincount(code[:, p], minlength=k)
        part, entry = np.nonzero(count)
        row = lambda a: np.repeat(a, width)
        yield pa.RecordBatch.from_pydict({
            "part": row(part), "entry": row(entry), "position": np.tile(np.arange(width), len(part)),
            "n": row(count[part, entry]), "total": total[part, entry].reshape(-1)})

    return run


def codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row of ``vectors`` (vec_id, embedding, label).

    A component x counts as floor(scale * x). Codebooks start as the parts of
    the ``entries`` (at most 256) smallest vec_ids, ascending; a round assigns every
    part and replaces each entry by the floored mean of its parts, unused
    entries stay; then parts are assigned a last time. ``code`` has two hex
    digits a part, ``error`` the summed squared distances, ``label_error`` their
    sum over the rows of the label.

    Rows with a null vector or a null or non-finite component are left out. A
    null vec_id sorts after all others, ties of vec_id by vector, so repeated
    rows are rows of their own with equal results. Null labels are one label.
    Fewer rows than entries give as many entries. Vectors of unequal length,
    or one that ``parts`` does not divide, are continued with zeros. Exact
    while sums of squares times entries fit a long. Extra columns are
    ignored; an empty table gives an empty result.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    kept = stage_table(whole_vectors(vectors, scale, vec_id="long", label="string").withColumn("code", F.lit(bytes(parts))))
    width = -(-max(kept.agg(F.max(F.size("v"))).first()[0] or 1, 1) // parts)
    start = kept.select("vec_id", "v").orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
    book = matrix(pa.array([r.v for r in start], pa.list_(pa.int64())), parts * width).reshape(-1, parts, width).transpose(1, 0, 2)
    schema = "vec_id long, label string, v array<long>, code binary, error long"
    for _ in range(rounds):
        kept = stage_table(kept.mapInArrow(_pass(book), schema))
        sums = kept.select("v", "code").mapInArrow(_sums(book.shape), "part long, entry long, position long, n long, total long")
        book = book.copy()
        for r in sums.groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            book[r.part, r.entry, r.position] = r.total // r.n
    coded = stage_table(kept.mapInArrow(_pass(book), schema).drop("v"))
    known = hashlib.sha256(",".join(map(str, book.reshape(-1).tolist())).encode()).hexdigest()
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    by_label = dealt_anew(by_label, "n", "label").select(F.col("label").alias("of"), "label_error")
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(known).alias("codebooks_sha256"))


def _oracle() -> str:
    """DuckDB form of the op12 query: every part meets every entry, twice for the codebooks and once for the codes."""
    def nearest(n: int) -> str:
        return f"""a{n} AS MATERIALIZED (
  SELECT r, p, arg_min(e, d * 1000 + e) AS e, min(d) AS d FROM (
    SELECT x.r, x.p, b.e, list_sum(list_transform(list_zip(x.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM x JOIN b{n} b USING (p)
  ) GROUP BY r, p
)"""

    def moved(n: int) -> str:
        return f"""b{n + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{n} b LEFT JOIN (
    SELECT p, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS x FROM (
      SELECT x.p, a.e, g.i, sum(x.x[g.i]) AS s, count(*) AS n
      FROM x JOIN a{n} a USING (r, p), range(1, {1 + 4}) g(i) GROUP BY ALL
    ) GROUP BY p, e
  ) m USING (p, e)
)"""

    rounds = ",\n".join(f"{nearest(n)},\n{moved(n)}" for n in range(ROUNDS))
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, * FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
), x AS MATERIALIZED (
  SELECT r, p, v[4 * p + 1:4 * p + 4] AS x FROM k, range({PARTS}) t(p)
), b0 AS MATERIALIZED (SELECT p, r - 1 AS e, x FROM x WHERE r <= {ENTRIES}),
{rounds},
{nearest(ROUNDS)},
c AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY r
), h AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{ROUNDS}
)
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, h.codebooks_sha256
FROM k JOIN c USING (r), h
"""


#: For vectors of 64 components, as the given table has them.
ORACLE = _oracle()


def query(spark, sf_dir: str) -> DataFrame:
    return codes(read(spark, sf_dir, "embeddings"))
