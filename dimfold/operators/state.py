"""Table-state operators without MERGE (M-1 .. M-6).

Parquet tables have no UPDATE / MERGE, so every state change is computed as
the next state in one DataFrame and written once: a period table is written
with dynamic partition overwrite, so re-running a period replaces exactly
that period's partition (rerun-safe) and reading period t-1 while writing
period t is allowed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def upsert(target: DataFrame, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """M-1: ``INSERT .. ON CONFLICT (keys) DO UPDATE SET every column = excluded``.

    One full join, each side read once. Keys are unique in either side (a
    source that names a key twice is an error in the source statement); a
    NULL key conflicts with none.
    """
    return _full(target, src, keys, "s", "t")


def _full(target: DataFrame, src: DataFrame, keys: Sequence[str], *first: str) -> DataFrame:
    """Full join on the keys; a key of both sides has the row of the side named first, NULLs included."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(k).alias(f"{name}_{k}") for k in keys], F.struct(*target.columns).alias(name))

    same = F.lit(True)
    for k in keys:
        same = same & (F.col(f"t_{k}") == F.col(f"s_{k}"))
    both = side(target, "t").join(side(src, "s"), same, "full").select(F.coalesce(*first).alias("r"))
    return both.select(*[F.col("r").getField(c).alias(c) for c in target.columns])


def merge_concat(target: DataFrame, src: DataFrame, keys: Sequence[str], array_col: str,
                 distinct: bool = False) -> DataFrame:
    """M-2: upsert that concatenates ``array_col`` of old and new rows.

    ``distinct=False`` appends (a rerun doubles the entries, as the scripts
    do); ``distinct=True`` takes the union, so a rerun changes nothing.
    """
    t = target.alias("t")
    s = src.alias("s")
    j = t.join(s, list(keys), "full")
    old = F.col(f"t.{array_col}")
    new = F.col(f"s.{array_col}")
    both = F.array_union(old, new) if distinct else F.concat(old, new)
    merged = F.when(old.isNull(), new).when(new.isNull(), old).otherwise(both)
    others = [c for c in target.columns if c not in keys and c != array_col]
    return j.select(*keys, *[F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")).alias(c) for c in others],
                    merged.alias(array_col)).select(*target.columns)


def insert_if_absent(target: DataFrame, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """M-4: ``INSERT .. ON CONFLICT (keys) DO NOTHING``; one full join, as ``upsert``."""
    return _full(target, src, keys, "t", "s")


def update_from(target: DataFrame, src: DataFrame, keys: Sequence[str],
                assignments: dict[str, Column]) -> DataFrame:
    """M-3: ``UPDATE target SET col = expr FROM src WHERE keys match``.

    ``assignments`` may use the target's columns and the source's columns
    (source columns must not clash with target names). Rows without a match
    keep their values. Several source rows per key must be reduced by the
    caller first (an UPDATE with several matches picks any).
    """
    j = target.join(src.withColumn("_matched", F.lit(True)), list(keys), "left")
    matched = F.col("_matched").isNotNull()
    return j.select(*[
        F.when(matched, assignments[c]).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c)
        for c in target.columns])


def write_period(df: DataFrame, path: str, period_cols: Sequence[str], fmt: str = "parquet",
                 rewritten: Sequence[Sequence] = ()) -> None:
    """M-6 / S-4: write by name, replacing only the periods present in ``df``.

    ``rewritten`` names periods (values of ``period_cols``) that this run
    recomputed: one of them without a row in ``df`` is emptied, so a re-run
    leaves no stale partition. Which of them have rows is observed on the
    written rows, so ``df`` runs once. The overwrite mode is an option of this write
    alone, so concurrent writers do not see each other's setting.
    """
    seen = Observation()
    if rewritten:
        df = df.observe(seen, *[F.count_if(_is_period(df, period_cols, values)).alias(f"period_{i}") for i, values in enumerate(rewritten)])
    (df.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic")
     .partitionBy(*period_cols).save(path))
    for i, values in enumerate(rewritten):
        if not seen.get[f"period_{i}"]:
            empty_period(df, path, period_cols, values, fmt)


def _is_period(df: DataFrame, period_cols: Sequence[str], values: Sequence) -> Column:
    same = F.lit(True)
    for c, v in zip(period_cols, values):
        same = same & F.col(c).eqNullSafe(F.lit(v).cast(df.schema[c].dataType))
    return same


def empty_period(df: DataFrame, path: str, period_cols: Sequence[str], values: Sequence, fmt: str = "parquet") -> None:
    """A period of the table at ``path`` replaced by nothing: ``INSERT OVERWRITE .. PARTITION (c = v)`` of no rows.

    A static partition overwrite empties its partition whatever it writes, and
    Spark itself turns values into folder names, special characters and NULL
    included. The table is known to the catalog for this statement only; its
    files are its own. ``df`` gives the schema.
    """
    spark = df.sparkSession
    name = f"period_{uuid.uuid4().hex}"
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    columns = ", ".join(f"`{c}` {t}" for c, t in types.items())
    periods = ", ".join(f"`{c}`" for c in period_cols)
    spec = ", ".join(f"`{c}` = {_sql_literal(v)}" for c, v in zip(period_cols, values))
    rest = ", ".join(f"CAST(NULL AS {t})" for c, t in types.items() if c not in period_cols)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt} OPTIONS (path {_sql_literal(path)}) PARTITIONED BY ({periods})")
    try:
        spark.sql(f"INSERT OVERWRITE {name} PARTITION ({spec}) SELECT {rest} WHERE false")
    finally:
        spark.sql(f"DROP TABLE {name}")


def _sql_literal(value) -> str:
    """A value as a SQL literal: text is quoted and escaped, other values are taken by their text."""
    if value is None:
        return "NULL"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def read_period(spark: SparkSession, path: str, where: Column | None = None, fmt: str = "parquet") -> DataFrame:
    """S-3: one period of a period table; the filter prunes partitions."""
    df = spark.read.format(fmt).load(path)
    return df if where is None else df.where(where)


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int,
                   period_cols: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write a keyed table bucketed (and sorted) by its entity key.

    Two tables bucketed the same way on the key (the snapshot and its SCD
    history) are joined on that key without a shuffle of either side, so the
    yearly SCD step reads both co-located. ``period_cols`` partitions the
    table by period as well, so one period is still a pruned read.
    """
    w = df.write.mode(mode).format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if period_cols:
        w = w.partitionBy(*period_cols)
    w.saveAsTable(table)
