"""Mixing sources to target weights by Sainte-Laguë apportionment of token blocks.

All words are counted into blocks of equal length. Sources get whole blocks by
highest quotients (target / 1, 3, 5, ...), the shards of a source share its
blocks the same way, and inside a shard the blocks beyond full repeats are
drawn in seeded order. A shard's documents lie on one line of words in seeded
order, so a document's share follows from where its words fall.

Scale: documents are reduced to (id, source, size) in one scan. A source of any
size is spread over shards of about ``shard_blocks`` blocks, and the number of
blocks is bounded by ``blocks``; what is apportioned in one task is one row per
source, or one row per shard of a source, never documents. Positions are a
window per shard.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dimfold.llm.common import durable, let, pick, read, words

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = "mix-1"


def sainte_lague(weights: np.ndarray, seats: int, caps: np.ndarray) -> np.ndarray:
    """Seats by highest quotients weight / (2k + 1), at most ``caps`` each; ties go to the earlier one.

    A common divisor is bracketed first, so that only the last few seats are
    dealt one by one.
    """
    weights, caps = np.asarray(weights, float), np.where(np.asarray(weights, float) > 0, np.asarray(caps, np.int64), 0)
    seats = int(min(seats, caps.sum()))
    if seats <= 0:
        return np.zeros(len(weights), np.int64)
    got = lambda x: np.minimum(caps, np.floor(np.minimum(weights * x, 4e18) + 0.5).astype(np.int64))
    low, high = 0.0, (seats + 1) / weights[caps > 0].min()
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if got(mid).sum() <= seats else (low, mid)
    have = np.maximum(got(low) - 1, 0)
    queue = [(-weights[i] / (2 * have[i] + 1), i) for i in np.flatnonzero(have < caps).tolist()]
    heapq.heapify(queue)
    for _ in range(seats - int(have.sum())):
        _, i = heapq.heappop(queue)
        have[i] += 1
        if have[i] < caps[i]:
            heapq.heappush(queue, (-weights[i] / (2 * have[i] + 1), i))
    return have


def targets(sizes: list[int], weights: list[int], max_repeats: int = MAX_REPEATS) -> list[float]:
    """Each source's words: the weight's share of all, stopped at ``max_repeats`` times its size, the excess reshared."""
    left, share = sum(sizes), sum(weights)
    out = [0.0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: (max_repeats * sizes[i] / weights[i], i))
    while order and max_repeats * sizes[order[0]] / weights[order[0]] <= left / share:
        i = order.pop(0)
        out[i] = float(max_repeats * sizes[i])
        left, share = left - max_repeats * sizes[i], share - weights[i]
    for i in order:
        out[i] = float(left) * weights[i] / share
    return out


def _blocks(size, block: int):
    """Blocks of a shard or source: its size over ``block``, rounded, at least one."""
    size = np.asarray(size, np.int64)
    return np.where(size > 0, np.maximum(1, (2 * size + block) // (2 * block)), 0)


def _plan_sources(weights, max_repeats, blocks, min_block, shard_blocks):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        names = pdf["source"].tolist()
        order = sorted(range(len(names)), key=lambda i: (names[i] is None, (names[i] or "").encode()))
        pdf = pdf.iloc[order].reset_index(drop=True)
        sizes = [int(x) for x in pdf["source_size"]]
        target = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], max_repeats)
        total = sum(sizes)
        block = max(min_block, -(-total // blocks))
        quota = sainte_lague(np.array(target), (2 * total + block) // (2 * block), max_repeats * _blocks(sizes, block))
        shards = [max(1, -(-s // (block * shard_blocks))) for s in sizes]
        return pd.DataFrame({
            "source": pdf["source"], "rank": range(len(sizes)), "source_size": sizes, "target": target,
            "quota": quota, "block": block, "shards": shards})

    return run


def _plan_shards(max_repeats, seed):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard", kind="stable")
        size, n = pdf["shard_size"].to_numpy(np.int64), _blocks(pdf["shard_size"], int(pdf["block"].iloc[0]))
        quota = sainte_lague(n, int(pdf["quota"].iloc[0]), max_repeats * n)
        rows = []
        for rank, shard, s, k, q in zip(pdf["rank"], pdf["shard"], size.tolist(), n.tolist(), quota.tolist()):
            full, extra = divmod(q, k) if k else (0, 0)
            drawn = sorted(range(k), key=lambda j: hashlib.md5(f"{seed}:{rank}:{shard}:{j}".encode()).hexdigest())[:extra]
            edge = np.arange(k + 1) * s // max(k, 1)
            taken = np.zeros(k, np.int64)
            taken[drawn] = np.diff(edge)[drawn] if drawn else 0
            rows.append((rank, shard, s, k, full, [0, *np.cumsum(taken).tolist()]))
        return pd.DataFrame(rows, columns=["rank", "shard", "shard_size", "n", "full", "before"])

    return run


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = SEED,
        blocks: int = 1 << 20, min_block: int = 16, shard_blocks: int = 256) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): what the mix takes of it.

    Columns: doc_id, source, size (words), source_size, target, taken (words, repeats
    counted), full (whole copies), row_hash, and the place of the partly taken
    words: begin, shard_size, n, before (words taken before each block).

    Sources in code point order, null last, weigh ``weights``, repeating. Null
    and empty texts have size 0 and are never taken. Null doc_id: ordered as
    an empty id. Repeated rows each count and lie side by side. A source
    without words has target 0. An empty table gives an empty result; extra
    columns are ignored. The seeded order depends on ids alone, so reruns agree.
    """
    sizes = durable(pick(docs, doc_id="long", text="string", source="string").select(
        "doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"), F.xxhash64("text").alias("row_hash"),
        F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")), 1, 16).alias("ord")))
    plan = durable(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size")).groupBy().applyInPandas(
            _plan_sources(weights, max_repeats, blocks, min_block, shard_blocks),
            "source string, rank long, source_size long, target double, quota long, block long, shards long"))
    placed = sizes.join(plan.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))).withColumn(
        "shard", F.conv(F.substring("ord", 9, 8), 16, 10).cast("long") % F.col("shards"))
    shards = placed.groupBy("rank", "shard", "quota", "block").agg(F.sum("size").alias("shard_size")).groupBy("rank").applyInPandas(
        _plan_shards(max_repeats, seed), "rank long, shard long, shard_size long, n long, full long, before array<long>")
    line = Window.partitionBy("rank", "shard").orderBy("ord", "doc_id", "row_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lined = placed.withColumn("end", F.sum("size").over(line)).withColumn("begin", F.col("end") - F.col("size"))
    joined = lined.join(shards, ["rank", "shard"])

    def before(x: str) -> str:
        """Words taken before place ``x`` of the shard's line."""
        j = f"(({x} + 1) * n - 1) div shard_size"
        return f"(get(before, cast({j} AS int)) + if(coalesce(get(before, cast({j} AS int) + 1), 0) > get(before, cast({j} AS int)), {x} - (({j}) * shard_size) div n, 0))"

    return joined.select(
        "doc_id", "source", "size", "source_size", "target",
        F.expr(f"if(size = 0, 0, full * size + {before('end')} - {before('begin')})").cast("long").alias("taken"),
        "full", "row_hash", "begin", "shard_size", "n", "before")


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """The mix as documents with the columns of ``documents``: a row per full
    copy, and one with the partly taken words, joined by spaces.

    Rows equal in doc_id, text and source are told apart by their number, so
    each meets one place on the line, and n of them make n pairs. Nulls in any
    column, empty texts and extra columns are as ``mix`` has them; an empty table
    gives an empty result.
    """
    key = ["doc_id", "row_hash", "source"]
    plain = pick(docs, doc_id="long", text="string", lang="string", source="string")
    mine = plain.withColumn("row_hash", F.xxhash64("text")).withColumn(
        "copy", F.row_number().over(Window.partitionBy(*key).orderBy("lang")))
    # the document's own pieces leave the shard's whole line of blocks behind
    pieces = F.expr("""transform(filter(sequence(((begin + 1) * n - 1) div shard_size, ((begin + size) * n - 1) div shard_size),
                j -> get(before, cast(j + 1 AS int)) > get(before, cast(j AS int))),
            j -> struct(greatest((j * shard_size) div n, begin) - begin AS a, least(((j + 1) * shard_size) div n, begin + size) - begin AS z))""")
    part = mix(plain, **params).withColumn("extra", F.expr("taken - full * size")).select(
        *key, "begin", F.expr("if(taken = 0, 0, full + if(extra = size, 1, 0))").alias("full"),
        F.when(F.expr("extra > 0 AND extra < size"), pieces).alias("pieces"))
    taken = part.withColumn("nth", F.row_number().over(Window.partitionBy(*key).orderBy("begin"))).where("full > 0 OR pieces IS NOT NULL").select(
        F.col("doc_id").alias("id"), F.col("row_hash").alias("hash"), F.col("source").alias("name"), "nth", "full", "pieces")
    both = mine.join(taken, F.col("doc_id").eqNullSafe(F.col("id")) & F.col("source").eqNullSafe(F.col("name"))
                     & (F.col("row_hash") == F.col("hash")) & (F.col("copy") == F.col("nth")))
    each = both.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.expr("full + if(pieces IS NULL, 0, 1)"))))
    some = let(words(F.col("text")), lambda w: F.array_join(F.flatten(F.transform(
        F.col("pieces"), lambda p: F.slice(w, (p["a"] + 1).cast("int"), (p["z"] - p["a"]).cast("int")))), " "))
    return (
        each.withColumn("text", F.when(F.expr("i > full"), some).otherwise(F.col("text")))
        .select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars")))


#: DuckDB form of the op9 query.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16) AS ord
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rnk FROM d GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][CAST(rnk % 3 AS INTEGER) + 1] AS w FROM s
), t AS (
  SELECT sum(source_size) AS total, sum(w) AS share, greatest(16, CAST(ceil(sum(source_size) / 1048576.0) AS BIGINT)) AS block FROM w
), fill AS (
  SELECT w.*, block, total, share,
    total - coalesce(sum(3 * source_size) OVER before, 0) AS left_, share - coalesce(sum(w) OVER before, 0) AS share_
  FROM w, t WINDOW before AS (ORDER BY 3 * source_size / w, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), capped AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) / w <= CAST(left_ AS DOUBLE) / share_ AS is_capped FROM fill
), rest AS (
  SELECT max(total) - coalesce(sum(3 * source_size) FILTER (is_capped), 0) AS left_, max(share) - coalesce(sum(w) FILTER (is_capped), 0) AS share_ FROM capped
), target AS (
  SELECT source, rnk, source_size, block, total, CASE WHEN is_capped THEN CAST(3 * source_size AS DOUBLE) ELSE CAST(rest.left_ AS DOUBLE) * w / rest.share_ END AS target,
    CASE WHEN source_size = 0 THEN 0 ELSE 3 * greatest(1, (2 * source_size + block) // (2 * block)) END AS cap,
    greatest(1, (source_size + 256 * block - 1) // (256 * block)) AS shards
  FROM capped, rest
), seat AS (
  SELECT rnk, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, rnk) AS place, (2 * total + block) // (2 * block) AS seats
  FROM (SELECT rnk, target, total, block, unnest(range(CAST(cap AS BIGINT))) AS k FROM target WHERE target > 0)
), quota AS (
  SELECT rnk, count(*) AS quota FROM seat WHERE place <= seats GROUP BY rnk
), placed AS (
  SELECT d.*, t.rnk, source_size, target, block, coalesce(quota, 0) AS quota, CAST('0x' || substr(ord, 9, 8) AS BIGINT) % shards AS shard
  FROM d JOIN target t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN quota q ON q.rnk = t.rnk
), lined AS (
  SELECT *, sum(size) OVER (PARTITION BY rnk, shard ORDER BY ord, doc_id) AS stop FROM placed
), shard AS (
  SELECT rnk, shard, quota, CAST(sum(size) AS BIGINT) AS size,
    CASE WHEN sum(size) = 0 THEN 0 ELSE greatest(1, CAST(2 * sum(size) + block AS BIGINT) // (2 * block)) END AS n
  FROM placed GROUP BY rnk, shard, quota, block
), shard_seat AS (
  SELECT rnk, shard, quota, row_number() OVER (PARTITION BY rnk ORDER BY n / (2 * k + 1) DESC, shard) AS place
  FROM (SELECT *, unnest(range(CAST(3 * n AS BIGINT))) AS k FROM shard)
), shard_quota AS (
  SELECT rnk, shard, count(*) AS q FROM shard_seat WHERE place <= quota GROUP BY rnk, shard
), drawn AS (
  SELECT *, row_number() OVER (PARTITION BY rnk, shard ORDER BY md5('mix-1:' || rnk || ':' || shard || ':' || j)) AS place
  FROM (SELECT s.rnk, s.shard, size, n, q, unnest(range(CAST(n AS BIGINT))) AS j FROM shard s JOIN shard_quota USING (rnk, shard))
), picked AS (
  SELECT rnk, shard, j * size // n AS a, (j + 1) * size // n AS z FROM drawn WHERE place <= q % n
), extra AS (
  SELECT l.doc_id, sum(greatest(0, least(stop, z) - greatest(stop - size, a))) AS extra
  FROM lined l JOIN picked p ON l.rnk = p.rnk AND l.shard = p.shard AND a < stop AND z > stop - size GROUP BY l.doc_id
)
SELECT l.doc_id, l.size, source_size, target,
  CAST(l.size * coalesce(CASE WHEN s.n > 0 THEN q // s.n END, 0) + coalesce(extra, 0) AS BIGINT) AS taken
FROM lined l JOIN shard s ON l.rnk = s.rnk AND l.shard = s.shard
LEFT JOIN shard_quota sq ON l.rnk = sq.rnk AND l.shard = sq.shard LEFT JOIN extra e ON l.doc_id = e.doc_id
"""


def query(spark, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
