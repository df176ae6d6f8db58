"""Column helpers: small, built-in-only expressions shared by the operators.

Everything here returns a ``Column`` made of JVM-side functions, so it stays
inside whole-stage code generation. No Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed value: all 32 bits of a bit(32) datelist.
MASK32 = 0xFFFFFFFF


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def threshold_class(value: ColumnOrName, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """Bucket by strictly-greater thresholds in descending order.

    ``labels`` has one more entry than ``cuts``; a NULL value, or one not above
    any cut, falls to the last label (as a CASE with ELSE does).
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError("labels must have one more entry than cuts")
    v = col(value)
    out = F.when(v > F.lit(cuts[0]), F.lit(labels[0]))
    for cut, label in zip(cuts[1:], labels[1:-1]):
        out = out.when(v > F.lit(cut), F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def first_item(arr: ColumnOrName) -> Column:
    """1-based ``arr[1]``: NULL on an empty or NULL array (no ANSI error)."""
    return F.try_element_at(col(arr), F.lit(1))


def last_item(arr: ColumnOrName) -> Column:
    """``arr[cardinality(arr)]``: NULL on an empty or NULL array."""
    return F.try_element_at(col(arr), F.lit(-1))


def ratio_nullif(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / COALESCE(NULLIF(den, 0), 1)``: a zero or NULL divisor counts as 1."""
    return col(num).cast("double") / F.coalesce(F.nullif(col(den), F.lit(0)), F.lit(1)).cast("double")


def ratio_case(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / CASE WHEN den = 0 THEN 1 ELSE den END``: a NULL divisor gives NULL."""
    d = col(den)
    return col(num).cast("double") / F.when(d == 0, F.lit(1)).otherwise(d).cast("double")


def json_object(*pairs: tuple[str, ColumnOrName]) -> Column:
    """``json_build_object(k1, v1, ...)`` as compact JSON text, keeping NULL values."""
    return F.to_json(F.struct(*[col(v).alias(k) for k, v in pairs]), {"ignoreNullFields": "false"})


def json_value(text: ColumnOrName) -> Column:
    """JSON text parsed once into a VARIANT; text that is no JSON (or repeats a key) gives NULL."""
    return F.try_parse_json(col(text))


def json_type(value: Column) -> Column:
    """``jsonb_typeof`` of a parsed value: object, array, string, number, boolean or null; NULL if nothing was parsed."""
    kind = F.schema_of_variant(value)
    return (F.when(kind.startswith("OBJECT"), F.lit("object")).when(kind.startswith("ARRAY"), F.lit("array"))
            .when(kind == "STRING", F.lit("string")).when(kind == "BOOLEAN", F.lit("boolean")).when(kind == "VOID", F.lit("null"))
            .when(kind.isNotNull(), F.lit("number")))


def json_get(value: Column, key: str) -> Column:
    """``value -> key``, a VARIANT: NULL if the key is missing, a JSON null if that is its value."""
    quote = "'" if '"' in key else '"'
    if not key or quote in key:
        raise ValueError(f"no path can name the key {key!r}")
    return F.try_variant_get(value, f"$[{quote}{key}{quote}]", "variant")


def json_text(value: Column, key: str) -> Column:
    """``value ->> key``: the key's value as text; NULL if it is missing or a JSON null."""
    return F.try_variant_get(json_get(value, key), "$", "string")


def json_has_key(value: Column, key: str) -> Column:
    """``value ? key``: a JSON-null value counts as there; NULL if nothing was parsed."""
    return F.when(value.isNotNull(), json_get(value, key).isNotNull())


def bits32_text(bits: ColumnOrName) -> Column:
    """A 32-bit value as its 32-character binary text (``bit(32)``)."""
    return F.lpad(F.bin(col(bits).bitwiseAND(F.lit(MASK32))), 32, "0")


def month_start(d: ColumnOrName) -> Column:
    return F.trunc(col(d), "month")


def days_in_month(d: ColumnOrName) -> Column:
    return F.dayofmonth(F.last_day(col(d)))


def yyyymmdd(d: ColumnOrName) -> Column:
    return F.date_format(col(d), "yyyyMMdd").cast("int")


def set_slot(arr: ColumnOrName, index1: ColumnOrName, value: ColumnOrName) -> Column:
    """``arr[index1] = value`` (1-based) without leaving Spark's codegen."""
    idx = col(index1)
    v = col(value)
    return F.transform(col(arr), lambda x, i: F.when(i + 1 == idx, v.cast("int")).otherwise(x))


def zeros(n: ColumnOrName) -> Column:
    """``array_fill(0, ARRAY[n])``; n <= 0 gives an empty array."""
    return F.array_repeat(F.lit(0), F.greatest(col(n), F.lit(0)))


def array_text(arr: ColumnOrName, sep: str = ",") -> Column:
    """Array as delimited text, for reports and cross-engine comparison."""
    return F.array_join(F.transform(col(arr), lambda x: x.cast("string")), sep)


def null_safe_changed(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``a IS DISTINCT FROM b``."""
    return ~col(a).eqNullSafe(col(b))
