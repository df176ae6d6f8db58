"""Grain checks, de-duplication and table contracts (X-11, X-12, X-24).

All three are aggregations with map-side partial combine, so a key that holds
a large share of the rows is reduced on every map task before the shuffle:

* ``duplicate_keys`` is a plain grouped count;
* ``duplicate_rows`` semi-joins the rows to the set of duplicated keys; AQE
  broadcasts that set or splits a hot key, by measured sizes;
* ``dedupe_first`` is ``row_number() = 1``, which Spark plans as a partial
  ``WindowGroupLimit`` before the exchange: each map task forwards at most
  one row per key, so a hot key never reaches one task whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from dimfold.functions.columns import json_has_key, json_type, json_value


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_name: str = "n") -> DataFrame:
    """X-11: key groups with more than one row (``GROUP BY .. HAVING count(1) > 1``)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
            .where(F.col(count_name) > 1))


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """X-12 (reference homework): every copy of every duplicated key.

    ``(k1, k2, ..) IN (SELECT ..)`` semantics: a key with a NULL part never
    matches, so such rows are not returned.

    A plain left semi join, so nothing runs while the plan is built. At
    runtime AQE broadcasts the duplicated keys if their measured size allows
    it, and otherwise splits the rows of a hot key over several tasks (the
    left side of a semi join may be split, exact copies included).
    """
    keys = list(keys)
    dup = duplicate_keys(df, keys, "_n")
    # The grouped keys are dealt by the join's own keys and would be joined in place, where AQE cannot
    # split; as computed columns they get an exchange of their own, a small one.
    dup = dup.select(*[F.when(F.col("_n") > 1, F.col(k)).alias(k) for k in keys])
    return df.join(dup, keys, "left_semi")


def total_order(df: DataFrame, first: Sequence[str | Column] = (), exclude: Sequence[str] = ()) -> list[Column]:
    """``first`` then every other column ascending (NULLs first): a total tie-break."""
    named = {c for c in first if isinstance(c, str)}
    rest = [c for c in df.columns if c not in named and c not in exclude]
    return [F.col(c) if isinstance(c, str) else c for c in first] + [F.col(c).asc_nulls_first() for c in rest]


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """X-12: keep the first row of each key by ``order``.

    Without ``order`` the order is every non-key column, so the survivor is
    deterministic (the scripts' unordered ``row_number()`` picks any row).
    """
    order_cols = total_order(df, order or (), exclude=keys)
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def contract_rules(not_null: Sequence[str] = (), allowed: dict[str, Sequence] | None = None,
                   json_objects: Sequence[str] = (), json_required: dict[str, str] | None = None) -> dict[str, Column]:
    """The row rules of a declared contract by name; a rule is broken where its condition is FALSE.

    ``null_<col>`` (NOT NULL), ``not_allowed_<col>`` (an enum or IN check: NULL
    passes, as any CHECK of a NULL does), ``not_object_<col>`` (``jsonb_typeof = 'object'``,
    NULL passes; text that is no JSON is no object) and ``missing_<key>_<col>`` (the trigger:
    a JSON null counts as there; no JSON at all has no key).
    JSON columns are parsed once by ``with_json``.
    """
    rules = {f"null_{c}": F.col(c).isNotNull() for c in not_null}
    for c, values in (allowed or {}).items():
        rules[f"not_allowed_{c}"] = F.col(c).isin(list(values))
    for c in json_objects:
        rules[f"not_object_{c}"] = F.when(F.col(c).isNotNull(), F.coalesce(json_type(F.col(f"_json_{c}")) == "object", F.lit(False)))
    for c, k in (json_required or {}).items():
        rules[f"missing_{k}_{c}"] = F.coalesce(json_has_key(F.col(f"_json_{c}"), k), F.lit(False))
    return rules


def with_json(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with each JSON column parsed into a VARIANT ``_json_<col>``, once for all rules."""
    return df.withColumns({f"_json_{c}": json_value(c) for c in dict.fromkeys(columns)})


def broken_rules(df: DataFrame, rules: dict[str, Column], keys: Sequence[str] = (), name: str = "broken_rules") -> DataFrame:
    """K-4 / X-24 row by row: ``df`` with the sorted names of the rules that each row breaks (empty: accepted).

    The trigger stops a whole load at its first bad row; here every row says what
    it breaks. A rule whose condition is NULL is not broken. With ``keys``, every row of a
    key that occurs more than once breaks ``duplicate_key``; a key with a NULL part is no
    key and never does. Rows are only marked, so all stay, duplicates included.
    """
    marks = [F.when(~ok, F.lit(rule)) for rule, ok in rules.items()]
    if keys:
        dup = duplicate_keys(df, keys, "_n")
        dup = dup.select(*[F.when(F.col("_n") > 1, F.col(k)).alias(k) for k in keys], F.lit(True).alias("_dup"))
        df = df.join(dup, list(keys), "left").select(*df.columns, "_dup")
        marks.append(F.when(F.col("_dup"), F.lit("duplicate_key")))
    found = F.array_sort(F.array_compact(F.array(*marks))) if marks else F.array().cast("array<string>")
    return df.withColumn(name, found).drop("_dup")


def split_rows(df: DataFrame, rules: dict[str, Column], keys: Sequence[str] = (),
               name: str = "broken_rules") -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)``: the rows that break no rule, and the others with what they break."""
    marked = broken_rules(df, rules, keys, name)
    return marked.where(F.size(name) == 0).drop(name), marked.where(F.size(name) > 0)


def load_accepted(df: DataFrame, path: str, rules: dict[str, Column], keys: Sequence[str] = (),
                  name: str = "broken_rules") -> dict[str, int]:
    """Writes accepted and rejected rows in one pass and returns the counts seen on the way.

    ``path`` gets the partitions ``accepted=true`` (rows that break no rule) and
    ``accepted=false`` (the others with their ``broken_rules``), replacing what was there; helper columns
    (``_json_..``) are not written. Returns ``accepted``, ``rejected`` and the rows that break each rule.
    """
    seen = Observation()
    marked = broken_rules(df, rules, keys, name)
    every = [*rules, *(["duplicate_key"] if keys else [])]
    out = marked.observe(seen, F.count_if(F.size(name) == 0).alias("accepted"), F.count_if(F.size(name) > 0).alias("rejected"),
                         *[F.count_if(F.array_contains(name, r)).alias(r) for r in every])
    out = out.withColumn("accepted", F.size(name) == 0).drop(*[c for c in df.columns if c.startswith("_json_")])
    out.write.mode("overwrite").partitionBy("accepted").parquet(path)
    return dict(seen.get)


def check_contract(df: DataFrame, keys: Sequence[str] = (), not_null: Sequence[str] = (),
                   allowed: dict[str, Sequence] | None = None, json_objects: Sequence[str] = (),
                   json_required: dict[str, str] | None = None, raise_on_violation: bool = False) -> DataFrame:
    """X-24: one pass of violation counts for a table's declared contract.

    Replaces the PRIMARY KEY / NOT NULL / enum / ``CHECK (jsonb_typeof(..) =
    'object')`` constraints and the row trigger that requires a JSON key.
    Returns one row: ``rows``, the rows that break each rule of
    ``contract_rules``, and with ``keys`` ``duplicate_keys`` (key groups with more than
    one row). The table is read once: with ``keys`` the counts are taken per key first (combined in
    the map tasks, so a hot key is one row a task) and then added up. With
    ``raise_on_violation`` a non-zero count raises (this triggers one small job).
    """
    rules = contract_rules(not_null, allowed, json_objects, json_required)
    src = with_json(df, [*json_objects, *(json_required or {})])
    aggs = [F.count(F.lit(1)).alias("rows"), *[F.count_if(~ok).alias(rule) for rule, ok in rules.items()]]
    if keys:
        per_key = src.groupBy(*keys).agg(*aggs)
        out = per_key.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ["rows", *rules]],
                          F.count_if(F.col("rows") > 1).alias("duplicate_keys"))
    else:
        out = src.agg(*aggs)
    if raise_on_violation:
        row = out.first().asDict()
        bad = {k: v for k, v in row.items() if k != "rows" and v}
        if bad:
            raise ValueError(f"contract violated: {bad}")
    return out
