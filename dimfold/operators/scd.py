"""Slowly changing dimension, type 2 (X-7 .. X-10).

Every operator has two forms:

* ``reference=True`` reproduces the modelling scripts row for row, defects
  included (NULL-unsafe compares, LEAD before the change filter, the
  all-NULL branch of the four-way union, ``>=`` re-reading the boundary);
* ``reference=False`` (default) is the corrected form: null-safe compares,
  ends computed over change rows only, one full join per step, and the
  property "incremental step == full rebuild".

Windows are partitioned by the entity key only. Rows of one entity are its
periods (bounded by the calendar, not by the data volume), so a window
partition never grows with the table; when the input comes from a
snapshot grouped by the same key the windows reuse its hash partitioning
and add no exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from dimfold.functions.columns import null_safe_changed

Keys = str | Sequence[str]


def _keys(key: Keys) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def _changed_ref(cur: Sequence[Column], prev: Sequence[Column]) -> Column:
    """CASE WHEN a <> prev_a THEN 1 WHEN b <> prev_b THEN 1 ELSE 0 (NULL is no change)."""
    out = None
    for c, p in zip(cur, prev):
        out = F.when(c != p, F.lit(1)) if out is None else out.when(c != p, F.lit(1))
    return out.otherwise(F.lit(0))


def _changed_fixed(cur: Sequence[Column], prev: Sequence[Column]) -> Column:
    out = None
    for c, p in zip(cur, prev):
        d = null_safe_changed(c, p)
        out = d if out is None else (out | d)
    return out


# --- X-7 ---------------------------------------------------------------------

def scd2_streaks(df: DataFrame, key: Keys, period: str, tracked: Sequence[str], cutoff,
                 reference: bool = False, start_name: str = "start_season", end_name: str = "end_season",
                 cutoff_name: str = "current_season") -> DataFrame:
    """Full rebuild by streaks: lag, change flag, running sum, min/max per streak.

    Rows up to ``cutoff`` only; the cutoff is stored as ``cutoff_name`` so a
    yearly reload lands in its own partition.
    """
    keys = _keys(key)
    w = Window.partitionBy(*keys).orderBy(period)
    src = df.where(F.col(period) <= _lit(cutoff)).select(*keys, period, *tracked)
    prev = [F.lag(c, 1).over(w) for c in tracked]
    cur = [F.col(c) for c in tracked]
    if reference:
        flag = _changed_ref(cur, prev)
    else:
        flag = _changed_fixed(cur, prev).cast("int")
    with_flag = src.withColumn("_chg", flag)
    streaks = with_flag.withColumn("_streak", F.sum("_chg").over(w))
    return (
        streaks.groupBy(*keys, "_streak", *tracked)
        .agg(F.min(period).alias(start_name), F.max(period).alias(end_name))
        .select(*keys, *tracked, start_name, end_name, _lit(cutoff).alias(cutoff_name))
    )


# --- X-8 ---------------------------------------------------------------------

def scd2_increment(scd: DataFrame, snapshot: DataFrame, key: Keys, period: str, tracked: Sequence[str],
                   cutoff, new_period, reference: bool = False,
                   start_name: str = "start_season", end_name: str = "end_season",
                   cutoff_name: str = "current_season") -> DataFrame:
    """One period forward: SCD2 table at ``cutoff`` + snapshot rows of ``new_period``.

    Fixed form: each key's latest record (the open one, end = cutoff, or
    the last one of a key absent lately) is full-joined with the new period
    on the key: unchanged -> end extended; changed -> old kept closed plus a
    new record; new key -> new record; key absent from the new period ->
    kept as is; older records pass through. Equals ``scd2_streaks`` at
    ``new_period`` (property-tested on random histories with gaps and NULLs).

    Reference form: the four-way union of the scripts, NULL-unsafe; a new key
    also yields one all-NULL row plus a duplicate of its new record.
    """
    keys = _keys(key)
    scd_cols = [*keys, *tracked, start_name, end_name]
    this = snapshot.where(F.col(period) == _lit(new_period)).select(*keys, *tracked)
    current = scd.where(F.col(cutoff_name) == _lit(cutoff)).select(*scd_cols)

    def record(side: str, start: Column, end: Column) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in tracked], start.alias(start_name), end.alias(end_name))

    l_start, l_end = F.col(f"l.{start_name}"), F.col(f"l.{end_name}")
    old, new = record("l", l_start, l_end), record("t", _lit(new_period), _lit(new_period))
    extended = record("l", l_start, _lit(new_period))
    key_cols = [F.coalesce(F.col(f"l.{k}"), F.col(f"t.{k}")).alias(k) for k in keys]
    on = [F.col(f"l.{k}") == F.col(f"t.{k}") for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c

    if reference:
        # The scripts' branches in one full join of the records at the cutoff
        # with the new season, NULL-unsafe. Closed records come through; open
        # records without a row in the new season are dropped; a key without
        # an open record yields an all-NULL "old" record, the new record from
        # the changed branch and the same again from the new-records branch;
        # equal on every column extends the record; some column different
        # yields old and new; comparisons that are NULL yield no row at all.
        open_now = l_end == _lit(cutoff)
        j = current.alias("l").join(this.withColumn("_in_this", F.lit(True)).alias("t"), cond & open_now, "full")
        equal = differ = None
        for c in tracked:
            e, d = F.col(f"t.{c}") == F.col(f"l.{c}"), F.col(f"t.{c}") != F.col(f"l.{c}")
            equal = e if equal is None else equal & e
            differ = d if differ is None else differ | d
        none = F.slice(F.array(new), 1, 0)
        rows = (F.when(l_start.isNull(), F.array(old, new, new))
                .when(l_end < _lit(cutoff), F.array(old))
                .when(F.col("t._in_this").isNull(), none)
                .when(equal, F.array(extended))
                .when(differ, F.array(old, new))
                .otherwise(none))
        return j.select(*key_cols, F.inline(rows))

    # One full outer join reads the SCD table once (a yearly fold keeps a
    # linear plan): only the key's latest record can match the new period
    # (usually the open one, end = cutoff; for a key absent from some recent
    # periods its last record, so a gap continues a streak exactly as the
    # rebuild does); older records and latest records of absent keys come
    # through unchanged. The window on the key shares the join's partitioning.
    current = current.withColumn("_latest", F.max(end_name).over(Window.partitionBy(*keys)))
    cond = cond & (l_end == F.col("l._latest"))
    j = current.alias("l").join(this.withColumn("_in_this", F.lit(True)).alias("t"), cond, "full")
    same = None
    for c in tracked:
        p = F.col(f"l.{c}").eqNullSafe(F.col(f"t.{c}"))
        same = p if same is None else same & p
    rows = (F.when(l_start.isNull(), F.array(new))
            .when(F.col("t._in_this").isNull(), F.array(old))
            .when(same, F.array(extended))
            .otherwise(F.array(old, new)))
    return j.select(*key_cols, F.inline(rows)).withColumn(cutoff_name, _lit(new_period))


# --- X-9 ---------------------------------------------------------------------

def scd2_change_points(df: DataFrame, key: Keys, period: str, tracked: Sequence[str],
                       defaults: dict | None = None, reference: bool = False, fill: str | None = None,
                       start_name: str = "start_year", end_name: str = "end_year",
                       current_name: str = "is_current", lo=None, hi=None) -> DataFrame:
    """Full rebuild by change points over a dense key x period grid.

    The grid is every key x every period between the global first and last
    period; a key's missing periods take ``defaults`` (e.g. inactive, no
    films). ``fill`` names a tracked column back-filled from earlier rows:
    reference form takes the partition's FIRST value (a defect), fixed form
    the last non-NULL value. A change is any null-safe difference from the
    previous period. Fixed form: ends are the next change minus one, the
    last record runs to the last period and is current. Reference form: the
    LEAD runs before the change filter, so each record ends in its start
    year unless it starts in the last period.

    ``lo`` / ``hi`` are the grid's first and last period; when not given
    they are the input's MIN / MAX period (scalar subqueries).
    """
    keys = _keys(key)
    defaults = defaults or {}
    if lo is None or hi is None:
        bounds = df.agg(F.min(period).alias("lo"), F.max(period).alias("hi"))
        lo = bounds.select("lo").scalar() if lo is None else lo
        hi = bounds.select("hi").scalar() if hi is None else hi
    lo, hi = _lit(lo), _lit(hi)
    per_key = df.groupBy(*keys).agg(
        F.collect_list(F.struct(F.col(period).alias("_p"), *tracked)).alias("_states"))
    grid = per_key.select(*keys, "_states", F.explode(F.sequence(lo, hi)).alias(period))
    state = F.try_element_at(F.filter("_states", lambda s: s["_p"] == F.col(period)), F.lit(1))
    base = grid.select(*keys, period, *[
        (F.coalesce(state[c], F.lit(defaults[c])) if c in defaults else state[c]).alias(c) for c in tracked])
    w = Window.partitionBy(*keys).orderBy(period)
    if fill is not None:
        running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        filler = F.first(fill).over(running) if reference else F.last(fill, ignorenulls=True).over(running)
        base = base.withColumn(fill, F.coalesce(F.col(fill), filler))
    change = _changed_fixed([F.col(c) for c in tracked], [F.lag(c).over(w) for c in tracked])
    flagged = base.withColumn("_chg", change)
    if reference:
        ends = flagged.withColumn(end_name, F.lead(F.col(period) - 1, 1).over(w))
        ends = ends.withColumn(end_name, F.coalesce(F.col(end_name), hi))
        kept = ends.where(F.col("_chg") | (F.col(period) == lo))
    else:
        kept = flagged.where(F.col("_chg") | (F.col(period) == lo))
        kept = kept.withColumn(end_name, F.coalesce(F.lead(F.col(period) - 1, 1).over(w), hi))
    return kept.select(*keys, F.col(period).alias(start_name), F.col(end_name), *tracked,
                       (F.col(end_name) == hi).alias(current_name))


# --- X-10 --------------------------------------------------------------------

def scd2_merge(history: DataFrame, snapshot: DataFrame, key: Keys, period: str, tracked: Sequence[str],
               reference: bool = False, start_name: str = "start_year", end_name: str = "end_year",
               current_name: str = "is_current", last_processed=None,
               fill: str | None = None) -> tuple[DataFrame, DataFrame]:
    """X-10 merge as two DataFrames: ``(new_history, counts)``, the rows of ``_merged`` and their counts.

    ``counts`` has ``records_updated`` and ``records_inserted``. Each of the two
    runs the merge; ``scd2_merge_observed`` gives both from one run.
    """
    done, history_cols = _merged(history, snapshot, key, period, tracked, reference, start_name, end_name, current_name, last_processed, fill)
    return done.select(*history_cols), done.agg(*_merge_counts())


def scd2_merge_observed(history: DataFrame, snapshot: DataFrame, key: Keys, period: str, tracked: Sequence[str],
                        reference: bool = False, start_name: str = "start_year", end_name: str = "end_year",
                        current_name: str = "is_current", last_processed=None,
                        fill: str | None = None) -> tuple[DataFrame, Observation]:
    """X-10 / M-5: the merge and its counts from one run, as the data-modifying statement gives them.

    Returns ``(new_history, observation)``. The counts are observed on the rows
    as they are written: after the one action that writes ``new_history``,
    ``observation.get`` holds ``records_updated``, ``records_inserted`` and
    ``records`` (rows of the new history). Nothing is shuffled between the
    observed rows and the writing task, so a task that is run again on a lost
    executor counts once.
    """
    done, history_cols = _merged(history, snapshot, key, period, tracked, reference, start_name, end_name, current_name, last_processed, fill)
    seen = Observation()
    return done.observe(seen, *_merge_counts(), F.count(F.lit(1)).alias("records")).select(*history_cols), seen


def _merge_counts() -> list[Column]:
    return [F.count_if("_touched").alias("records_updated"), F.count_if("_new").alias("records_inserted")]


def _merged(history: DataFrame, snapshot: DataFrame, key: Keys, period: str, tracked: Sequence[str], reference: bool,
            start_name: str, end_name: str, current_name: str, last_processed, fill: str | None) -> tuple[DataFrame, list[Column]]:
    """Close-and-insert merge of new snapshot periods into an SCD2 table.

    Returns the merged rows with the flags ``_touched`` and ``_new``, and the
    columns that make them the new history. The history and the batch are laid in one frame
    and shuffled once by key: windows over a key's rows (its periods, bounded
    by the calendar) give what is kept, closed, extended and inserted, and the
    counts come from flags of the same rows. Written once by the caller (no
    in-place UPDATE).

    Reference form: rows from the last processed period on (``>=``), each
    compared with the open record using NULL-unsafe ``!=``; new records end at
    the next such row minus one; the open record closes at (any matching row's
    period) - 1, here the smallest for determinism.

    Fixed form: only periods after the last processed one; each row is
    compared null-safely with the previous row of the batch (the first with
    the open record); records start at change rows; the open record is closed
    before the first change or, without change, extended to the key's last
    batch period. For keys that the history knows the result equals the
    change-point rebuild; a new key starts at its first batch period, while
    the rebuild also writes the record of the periods before its debut.

    ``last_processed`` is the history's last period (``MAX(end_year)``); a
    scheduled job passes it, otherwise it is read from ``history``.
    ``fill`` (fixed form) back-fills a NULL in that tracked column with the
    last known value (earlier batch rows, then the open record), as the
    change-point rebuild does.
    """
    keys = _keys(key)
    hist_cols = [*keys, start_name, end_name, *tracked, current_name]
    last = history.agg(F.max(end_name)).scalar() if last_processed is None else _lit(last_processed)
    old = history.select(
        *hist_cols, F.coalesce(F.col(current_name), F.lit(False)).alias("_open"), F.lit(False).alias("_new"))
    fresh = F.col(period) >= last if reference else F.col(period) > last
    batch = snapshot.where(fresh).select(
        *keys, F.col(period).alias(start_name), F.lit(None).cast("int").alias(end_name), *tracked,
        F.lit(None).cast("boolean").alias(current_name), F.lit(True).alias("_open"), F.lit(True).alias("_new"))
    # _open: the key's open record and its batch rows; closed records are a partition of their own and pass through.
    both = old.unionByName(batch)
    part = Window.partitionBy(*keys, "_open")
    line = part.orderBy("_new", start_name)
    new, start, end = F.col("_new"), F.col(start_name), F.col(end_name)

    if reference:
        opened = F.max(F.when(~new & F.col("_open"), F.struct(F.lit(True).alias("_h"), *tracked))).over(part)
        both = both.withColumn("_h", opened)
        req = F.when(F.col("_h").isNull(), F.lit(True))
        for t in tracked:
            req = req.when(F.col(f"_h.{t}") != F.col(t), F.lit(True))
        both = both.withColumn("_keep", ~new | req.otherwise(F.lit(False)))
    else:
        if fill is not None:
            known = F.last(fill, ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))
            both = both.withColumn(fill, F.when(new, known).otherwise(F.col(fill)))
        changed = _changed_fixed([F.col(t) for t in tracked], [F.lag(t).over(line) for t in tracked])
        both = both.withColumn("_keep", ~new | F.lag(F.lit(True)).over(line).isNull() | changed)
        both = both.withColumn("_kmax", F.max(F.when(new, start)).over(part))

    kept = both.where("_keep")
    follow = F.lead(start).over(line)
    kept = kept.withColumn("_next", F.when(F.col("_open"), follow))
    if reference:
        closes = ~new & F.col("_open") & F.col("_next").isNotNull()
        ends = F.when(new, F.coalesce(F.col("_next") - 1, start)).when(closes, F.col("_next") - 1).otherwise(end)
        touched = closes
        now = F.when(new, F.col("_next").isNull()).when(closes, F.lit(False)).otherwise(F.col(current_name))
    else:
        touched = ~new & F.col("_open") & F.col("_kmax").isNotNull()
        moves = F.col("_open") & F.col("_kmax").isNotNull()
        ends = F.when(moves, F.coalesce(F.col("_next") - 1, F.col("_kmax"))).otherwise(end)
        now = F.when(moves, F.col("_next").isNull()).otherwise(F.col(current_name))
    done = kept.withColumn("_touched", touched).withColumn("_end", ends).withColumn("_now", now)
    return done, [*map(F.col, keys), start, F.col("_end").alias(end_name), *map(F.col, tracked), F.col("_now").alias(current_name)]
