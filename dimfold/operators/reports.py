"""Lookups and ordered reports over modelled tables (F-4, O-1 .. O-6).

PostgreSQL sorts NULLs last ascending and first descending; Spark does the
opposite, so the helpers name the NULL placement explicitly. A limit is only
used where the top-k is the report itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimfold.operators.quality import total_order
from dimfold.session import cut_lineage


def pg_order(col: str | Column, descending: bool = False) -> Column:
    """Sort key with PostgreSQL's NULL placement (``ORDER BY x [DESC]``)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.desc_nulls_first() if descending else c.asc_nulls_last()


def ordered(df: DataFrame, keys: Sequence[str | Column], descending: Sequence[bool] | None = None) -> DataFrame:
    """``ORDER BY k1 [DESC], k2 ..`` with PostgreSQL NULL placement (a global range-partitioned sort)."""
    descending = descending or [False] * len(keys)
    return df.orderBy(*[pg_order(k, d) for k, d in zip(keys, descending)])


def ranked(df: DataFrame, keys: Sequence[str], descending: Sequence[bool] | None = None, name: str = "place") -> DataFrame:
    """``row_number() OVER (ORDER BY k1 [DESC], k2 ..)`` of every row as ``name``, 1 to n, with PostgreSQL NULL placement.

    A window without a partition would sort all rows in one task. Here the
    rows are range-partitioned by the order and numbered within their
    partition; the partitions' sizes, added up in partition order, are the
    offsets. Only the sizes (a row per partition) reach the driver.

    Ties are broken by every other column, ascending, NULLs first (maps have
    no order and break none); rows equal in all columns are numbered in any order,
    and may be in different partitions, so a value that very many rows share is
    no hot task. The numbered rows are cut from their lineage once, in the shared
    checkpoint folder, so sizes and numbers are of the same partitions even
    if executors are lost. An empty input gives an empty result.
    """
    descending = descending or [False] * len(keys)
    sortable = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    order = [pg_order(k, d) for k, d in zip(keys, descending)] + total_order(df.select(*sortable), exclude=keys) + [F.col("_turn")]
    lined = df.withColumn("_turn", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()  # the partition above bit 33, the row within it below
    rows = cut_lineage(lined.drop("_turn").select("*", F.shiftright(at, 33).alias("_part"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("_at")))
    before, starts = 0, []
    for part, n in sorted(tuple(r) for r in rows.groupBy("_part").agg(F.count(F.lit(1))).collect()):
        starts.append((part, before))
        before += n
    offsets = df.sparkSession.createDataFrame(starts, "_part long, _before long")
    return rows.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_at") + 1).drop("_part", "_at", "_before")


def top_k(df: DataFrame, keys: Sequence[str | Column], k: int, descending: Sequence[bool] | None = None) -> DataFrame:
    """``ORDER BY .. LIMIT k``: planned as TakeOrderedAndProject (a per-task heap, k rows each)."""
    return ordered(df, keys, descending).limit(k)


def lookup(df: DataFrame, name_col: str, pattern: str, period_col: str | None = None, at=None) -> DataFrame:
    """``WHERE period = at AND name LIKE pattern``: both predicates reach the scan of a stored table."""
    out = df.where(F.col(name_col).like(pattern))
    if period_col is not None and at is not None:
        out = out.where(F.col(period_col) == F.lit(at))
    return out
