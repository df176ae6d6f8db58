"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimfold.session import cut_lineage, ensure_checkpoint_dir

#: Word separators of every contract here: space and the controls 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def pick(df: DataFrame, **types: str) -> DataFrame:
    """The named columns of ``df``, cast, and nothing else.

    Columns are taken by position of their exact name, so extra columns may
    clash with these (other case, the same name again, dots) or with names
    that an operator uses inside. A missing column raises ``ValueError``.
    """
    missing = [name for name in types if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_{df.columns.index(n)}").cast(t).alias(n) for n, t in types.items()])


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of ``text``; null has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, UPPER, LOWER)


def id_part(doc_id: Column, parts: int) -> Column:
    """crc32(doc_id as text) modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def durable(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back from there.

    The frame is computed once, and a lost executor takes nothing with it.
    """
    return cut_lineage(df)


def read(spark, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row.

    A column expression used inside a lambda is computed again for every
    element; a lambda's own variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def dealt_anew(grouped: DataFrame, count: str, *keys: str) -> DataFrame:
    """``grouped`` with its key columns computed from themselves and a positive ``count``.

    An aggregate is dealt by its keys already, so a join on them takes it in
    place, and AQE splits hot keys only between two exchanges. Computed keys
    get an exchange of their own.
    """
    return grouped.withColumns({k: F.when(F.col(count) > 0, F.col(k)) for k in keys})


def stage_table(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet into the shared checkpoint folder and reread."""
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.parquet(folder)


def give_back() -> None:
    """Returns freed memory to the system: an idle worker else keeps its peak."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def steps(texts: pa.Array | list[str | None], size: int = 1_000_000) -> Iterator[slice]:
    """Slices of ``texts`` with about ``size`` bytes (characters of a list), at least one text each.

    Bounds what a task holds of a batch in a step's working form.
    """
    give_back()  # what the batch before held
    lengths = [len(t or "") for t in texts] if isinstance(texts, list) else pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    at, held = 0, 0
    for i, length in enumerate(lengths):
        if held and held + length > size:
            yield slice(at, i)
            at, held = i, 0
        held += length
    if at < len(lengths):
        yield slice(at, len(lengths))


def whole_vectors(vectors: DataFrame, scale: int, **types: str) -> DataFrame:
    """The ``types`` columns and v, floor(scale * x) of every component x of ``embedding``.

    Rows with a null vector or a null or non-finite component are left out.
    """
    plain = pick(vectors, embedding="array<double>", **types).where(
        F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return plain.select(*types, F.transform("embedding", lambda x: F.floor(x * scale)).alias("v"))


def matrix(vectors, width: int) -> np.ndarray:
    """An Arrow list column as rows of equal width; shorter vectors end in zeros."""
    column = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), pc.list_value_length(column).to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes.reshape(-1, 1)] = flat
    return out


class TaskCache:
    """One value that a Python worker keeps across tasks, made anew for another key.

    The operators share ``TASK_CACHE``, so a worker holds the model of one of
    them at a time.
    """

    def __init__(self):
        self.key, self.value = None, None

    def get(self, key: str, make):
        if key != self.key:
            self.key, self.value = key, None
            gc.collect()
            self.value = make()
        return self.value


TASK_CACHE = TaskCache()


def in_one_task(sample: DataFrame, make):
    """``make(rows)`` of a bounded ``sample``, run in one task so that the driver holds neither rows nor work."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.astype(object).where(pdf.notna(), None)
        return pd.DataFrame({"made": [pickle.dumps(make(list(rows.itertuples(index=False, name=None))))]})

    got = sample.groupBy().applyInPandas(run, "made binary").collect()
    return pickle.loads(got[0].made) if got else make([])
