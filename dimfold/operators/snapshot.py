"""Cumulative per-entity snapshots (X-1 .. X-6).

A cumulative snapshot has one row per entity and period, from the entity's
first period to the last one asked for, carrying everything known so far.

Plan shape. Instead of a spine joined to the facts with a range join and a
running ``array_agg`` window, every entity is grouped once: its per-period
facts are collected into one array (at most one element per period, so the
array is bounded by the number of periods, not by the data volume), and the
spine is generated next to it with ``explode(sequence(first, end))``. Each
spine row then reads its history with higher-order functions. The whole
snapshot costs one hash exchange on the entity key; ``explode`` keeps that
partitioning, so a following window or aggregate on the key adds no shuffle.

Large per-period groups (many items per entity and period) are first reduced
by a partial/final hash aggregate on (entity, period) to a few scalars, so a
hot entity is spread over many tasks before its small per-period summary is
collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimfold.functions.columns import first_item, last_item, ratio_case, ratio_nullif, threshold_class

Keys = str | Sequence[str]


def _keys(key: Keys) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def _non_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond)


def entity_spine(df: DataFrame, key: Keys, period: str, end, start=None,
                 out_period: str | None = None) -> DataFrame:
    """X-1: one row per key and period, from the key's first period to ``end``.

    ``start`` clips the spine from below (a fixed series start). A key whose
    first period is after ``end`` gets no rows (an empty series, not a
    descending one).
    """
    keys = _keys(key)
    out_period = out_period or period
    first = df.groupBy(*keys).agg(F.min(period).alias("_first"))
    lo = F.col("_first") if start is None else F.greatest(F.col("_first"), _lit(start))
    return first.where(lo <= _lit(end)).select(
        *keys, F.explode(F.sequence(lo, _lit(end))).alias(out_period))


def cumulative_snapshot(df: DataFrame, key: Keys, period: str, stats: Sequence[str], end,
                        static: Sequence[str] = (), start=None, *,
                        history: str = "season_stats", out_period: str = "current_season",
                        class_on: str | None = None, cuts: Sequence[float] = (), labels: Sequence[str] = (),
                        class_name: str = "scoring_class", recency_name: str = "years_since_last_season",
                        active_name: str = "is_active", only_end: bool = False) -> DataFrame:
    """X-2: spine x facts with the running history array of structs.

    For each key and period p in [first, end]: ``history`` holds the structs
    ``(period, *stats)`` of all periods <= p in period order (gaps simply have
    no element); static attributes are the key's MAX over all rows; the class
    comes from ``class_on`` of the last element; recency is p minus the last
    element's period; active is "the last element is from p".

    The input must be unique per (key, period), as the primary key of the
    snapshot table requires; ``duplicate_keys`` checks it. ``only_end=True``
    emits just the rows of period ``end`` (one partition of the snapshot
    table) without generating the other periods. A NULL key matches no fact
    and no static row in the scripts' joins, so it yields no rows.
    """
    keys = _keys(key)
    df = _non_null_keys(df, keys)
    per_key = df.groupBy(*keys).agg(
        F.min(period).alias("_first"),
        F.sort_array(F.collect_list(F.struct(period, *stats))).alias("_facts"),
        *[F.max(c).alias(c) for c in static],
    )
    lo = F.col("_first") if start is None else F.greatest(F.col("_first"), _lit(start))
    periods = F.array(_lit(end)) if only_end else F.sequence(lo, _lit(end))
    spine = per_key.where(lo <= _lit(end)).select(
        *keys, *static, "_facts", F.explode(periods).alias(out_period))
    cur = F.col(out_period)
    if start is None:
        hist = F.filter("_facts", lambda s: s[period] <= cur)
    else:
        hist = F.filter("_facts", lambda s: (s[period] <= cur) & (s[period] >= _lit(start)))
    out = spine.select(*keys, *static, hist.alias(history), cur)
    last = last_item(history)
    cols = [*keys, *static, F.col(history)]
    if class_on is not None:
        cols.append(threshold_class(last[class_on], cuts, labels).alias(class_name))
    cols += [
        (cur - last[period]).alias(recency_name),
        cur,
        (last[period] == cur).alias(active_name),
    ]
    return out.select(*cols)


def explode_snapshot(df: DataFrame, keys: Sequence[str], history: str) -> DataFrame:
    """X-4: back to one row per key and stored element (``(unnest(arr)).*``)."""
    return df.select(*keys, F.inline(history))


def improvement(df: DataFrame, keys: Sequence[str], history: str, field: str,
                guard: str = "nullif", name: str = "improvement") -> DataFrame:
    """X-5: last element's ``field`` over the first element's.

    ``guard="nullif"``: a zero or NULL first value counts as 1.
    ``guard="case"``: a zero first value counts as 1, a NULL one gives NULL.
    Sort with ``desc_nulls_first`` to reproduce ``ORDER BY 2 DESC``.
    """
    f = ratio_nullif if guard == "nullif" else ratio_case
    return df.select(*keys, f(last_item(history)[field], first_item(history)[field]).alias(name))


def cumulative_snapshot_multi(df: DataFrame, key: Keys, period: str, item_cols: Sequence[str], end,
                              static_aggs: Sequence[Column] = (), start=None, *,
                              out_period: str = "current_year", with_items: bool = False,
                              items_name: str = "films", count_name: str = "n_films",
                              last_name: str = "last_film",
                              class_on: str | None = None, cuts: Sequence[float] = (), labels: Sequence[str] = (),
                              class_name: str = "quality_class", recency_name: str = "years_since_last_film",
                              active_name: str = "is_active") -> DataFrame:
    """X-3: cumulative snapshot with many items per key and period.

    Items are de-duplicated on ``(period, *item_cols)`` and ordered by that
    tuple (so ``item_cols`` should start with the order columns after the
    period). For each key and period p in [first, end]:

    * ``count_name``: distinct items with period <= p,
    * ``last_name``: the last item in that order (a struct),
    * class from ``class_on`` of the last item, recency from its period,
    * active: some item has period p,
    * static aggregates over all of the key's rows (not only up to p),
    * ``items_name`` (only with ``with_items=True``): the full ordered array.

    Without ``with_items`` every group is reduced to scalars before it is
    collected, so the work is linear in the input and skew on one key is
    absorbed by the partial aggregates. ``with_items=True`` materialises the
    quadratic history arrays of the reference table and keeps all of one
    key's items in one row (use it for bounded histories).
    """
    keys = _keys(key)
    df = _non_null_keys(df, keys)
    item = F.struct(F.col(period), *[F.col(c) for c in item_cols])
    distinct_items = df.select(*keys, period, *item_cols).distinct()
    per_period_aggs = [
        F.count(F.lit(1)).alias("n"),
        F.max(item).alias("last"),
    ]
    if with_items:
        per_period_aggs.append(F.sort_array(F.collect_list(item)).alias("items"))
    per_period = distinct_items.groupBy(*keys, period).agg(*per_period_aggs)
    per_key = per_period.groupBy(*keys).agg(
        F.min(period).alias("_first"),
        F.sort_array(F.collect_list(F.struct(period, *[c for c in ("n", "last", "items") if c != "items" or with_items]))).alias("_periods"),
    )
    lo = F.col("_first") if start is None else F.greatest(F.col("_first"), _lit(start))
    spine = per_key.where(lo <= _lit(end)).select(
        *keys, "_periods", F.explode(F.sequence(lo, _lit(end))).alias(out_period))
    cur = F.col(out_period)
    prior = F.filter("_periods", lambda p: p[period] <= cur)
    snap = spine.select(*keys, cur, prior.alias("_prior"))
    p = F.col("_prior")
    last = last_item(p)["last"]
    cols = [*keys, cur,
            F.aggregate(p, F.lit(0).cast("long"), lambda acc, x: acc + x["n"]).alias(count_name),
            last.alias(last_name)]
    if with_items:
        cols.append(F.flatten(F.transform(p, lambda x: x["items"])).alias(items_name))
    if class_on is not None:
        cols.append(threshold_class(last[class_on], cuts, labels).alias(class_name))
    cols += [
        (last[period] == cur).alias(active_name),
        (cur - last[period]).alias(recency_name),
    ]
    out = snap.select(*cols)
    if static_aggs:
        static = df.groupBy(*keys).agg(*static_aggs)
        out = out.join(static, keys)
    return out


def entity_history(df: DataFrame, key: Keys, period: str, item_cols: Sequence[str], snapshot: DataFrame,
                   *, out_period: str = "current_year", count_name: str = "n_films",
                   active_name: str = "is_active", list_of: str = "film", list_name: str = "films_this_year",
                   name_col: str | None = None, name=None, at=None, as_list: bool = False) -> DataFrame:
    """X-6: each key at each active period with that period's items.

    ``verify_actor_history(name, year)`` is the same with ``name`` and ``at``
    given: the filters then reach the Parquet scan.

    Default (long form): one row per key, period and distinct item of that
    period, with the count of items to date and the active flag. No group
    is collected, so a key with a huge period is spread over many tasks (the
    join to the per-period snapshot rows is split by AQE if skewed).
    ``as_list=True`` returns the scripts' shape, one row per key and period
    with the ``list_of`` values in item order; that collects each (key,
    period) group into one row, so use it only for bounded periods.
    """
    keys = _keys(key)
    src = df
    snap = snapshot
    if name is not None:
        src = src.where(F.col(name_col) == name)
        snap = snap.where(F.col(name_col) == name)
    if at is not None:
        src = src.where(F.col(period) == at)
        snap = snap.where(F.col(out_period) == at)
    items = src.select(*keys, F.col(period).alias(out_period), *item_cols).distinct()
    state = snap.select(*keys, out_period, count_name, active_name)
    if not as_list:
        return state.join(items, [*keys, out_period])
    this_period = items.groupBy(*keys, out_period).agg(
        F.transform(F.sort_array(F.collect_list(F.struct(*item_cols))), lambda s: s[list_of]).alias(list_name))
    return state.join(this_period, [*keys, out_period])
