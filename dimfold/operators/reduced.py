"""Reduced facts: one array of daily metrics per entity and month (X-18 .. X-22).

Per (entity, month) at most ``days in month`` values exist, so every array
is built from a bounded, pre-aggregated group: events are first reduced to
(entity, day) counts with a partial/final hash aggregate (exact distinct
counts go through Spark's two-level distinct plan on (entity, day, user)),
and only those per-day scalars are collected per entity and month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimfold.functions.columns import days_in_month, month_start, set_slot, zeros


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def _day(v) -> Column:
    return F.to_date(_lit(v))


def daily_counts(events: DataFrame, key: str, lo, hi, ts: str = "event_time",
                 distinct_of: str | None = None, drop_null_key: bool = True) -> DataFrame:
    """(key, day) -> hits [and distinct ``distinct_of``] for days in [lo, hi]."""
    d = F.to_date(F.col(ts))
    src = events.where(d.between(_day(lo), _day(hi)))
    if drop_null_key:
        src = src.where(F.col(key).isNotNull())
    aggs = [F.count(F.lit(1)).alias("hits")]
    if distinct_of is not None:
        aggs.append(F.count_distinct(distinct_of).alias("uniques"))
    return src.groupBy(F.col(key), d.alias("day")).agg(*aggs)


def dense_month_array(per_day: Column, length: Column, field: str) -> Column:
    """Array of ``length`` slots: slot i holds ``field`` of the day-of-month i entry, else 0."""
    return F.transform(
        F.sequence(F.lit(1), length),
        lambda i: F.coalesce(
            F.try_element_at(F.filter(per_day, lambda x: x["dom"] == i), F.lit(1))[field].cast("int"),
            F.lit(0)))


# --- X-18 --------------------------------------------------------------------

def metric_array_step(prev: DataFrame, events: DataFrame, day, metric: str = "site_hits",
                      key: str = "user_id", ts: str = "event_time", reference: bool = False) -> DataFrame:
    """One day of the ``array_metrics`` table: (key, month_start, metric_name, metric_array).

    Only the month's rows of ``prev`` are read (the filter prunes a table
    partitioned by ``month_start``) and only they are returned, for the
    month's partition to be replaced. The arrays of ``metric`` full-join
    today's counts: a known key gets today's count (0 if silent); a new key
    gets zeros for the days before today; other metrics of the month pass
    through. This is the upsert of the scripts, with the state read once, so
    a day-by-day fold keeps a linear plan.

    Reference form appends (a rerun appends again). Fixed form writes slot
    ``day of month`` (a rerun overwrites it). (The scripts also read the
    month's rows of every metric, which with a second metric makes the
    upsert touch one row twice, an error in the source; both forms read
    only ``metric``.)
    """
    today = _day(day)
    ms = month_start(today)
    keys = [key, "month_start", "metric_name"]
    counts = daily_counts(events, key, day, day, ts).select(
        key, ms.alias("month_start"), F.lit(metric).alias("metric_name"), F.col("hits"), F.lit(True).alias("_today"))
    j = prev.where(F.col("month_start") == ms).join(counts, keys, "full").select(
        *keys, F.col("metric_array").alias("_arr"), F.col("hits"),
        ((F.col("month_start") == ms) & (F.col("metric_name") == metric)).alias("_this"),
        (F.datediff(today, ms) + 1).alias("_idx"))
    v = F.coalesce(F.col("hits"), F.lit(0)).cast("float")
    arr, idx = F.col("_arr"), F.col("_idx")
    empty = F.array().cast("array<float>")
    if reference:
        lead_zeros = F.transform(zeros(idx - 1), lambda z: z.cast("float"))
        new_arr = F.when(arr.isNotNull(), F.concat(arr, F.array(v))).otherwise(F.concat(lead_zeros, F.array(v)))
    else:
        have = F.coalesce(arr, empty)
        padded = F.concat(have, F.transform(zeros(idx - 1 - F.size(have)), lambda z: z.cast("float")), F.array(v))
        new_arr = F.when(F.size(have) >= idx,
                         F.transform(arr, lambda x, i: F.when(i + 1 == idx, v).otherwise(x))).otherwise(padded)
    return j.select(*keys, F.when(F.col("_this"), new_arr).otherwise(arr).alias("metric_array"))


def metric_array_rebuild(events: DataFrame, day, metric: str = "site_hits", key: str = "user_id",
                         ts: str = "event_time") -> DataFrame:
    """X-18 full rebuild of the month of ``day`` up to ``day``: dense daily counts per key.

    Equals folding ``metric_array_step`` (fixed) from the month start to ``day``.
    """
    today = _day(day)
    ms = month_start(today)
    c = daily_counts(events, key, ms, today, ts)
    per = c.groupBy(key).agg(F.collect_list(F.struct(F.dayofmonth("day").alias("dom"), "hits")).alias("_days"))
    per = per.select(key, "_days", ms.alias("month_start"), F.dayofmonth(today).alias("_n"))
    arr = F.transform(dense_month_array(F.col("_days"), F.col("_n"), "hits"), lambda x: x.cast("float"))
    return per.select(key, "month_start", F.lit(metric).alias("metric_name"), arr.alias("metric_array"))


# --- X-21, X-22 --------------------------------------------------------------

def array_length_histogram(df: DataFrame, arr: str, name: str = "n") -> DataFrame:
    return df.groupBy(F.size(arr).alias("array_length")).agg(F.count(F.lit(1)).alias(name))


def explode_metric_array(df: DataFrame, arr: str = "metric_array", by: Sequence[str] = ("metric_name", "month_start"),
                         start: str = "month_start", slots: int | None = None) -> DataFrame:
    """X-22: sum arrays slot by slot per (metric, month) and unpivot to dates.

    ``posexplode`` + a grouped sum on (metric, month, slot): the sum has a
    map-side partial combine, so a month with very many keys is reduced on
    every task; any array length is handled. ``slots=n`` is the scripts'
    literal form, ``ARRAY[sum(a[1]), .., sum(a[n])]``: exactly n dates, a slot
    no array reaches sums to NULL.
    """
    if slots is not None:
        sums = df.groupBy(*by).agg(*[F.sum(F.try_element_at(F.col(arr), F.lit(i))).alias(f"_s{i}")
                                     for i in range(1, slots + 1)])
        summed = sums.select(*by, F.posexplode(F.array(*[F.col(f"_s{i}") for i in range(1, slots + 1)]))
                             .alias("pos", "value"))
        return summed.select(by[0], F.date_add(F.col(start), F.col("pos")).alias("date"), "value")
    slots = df.select(*by, F.posexplode(arr).alias("pos", "elem"))
    summed = slots.groupBy(*by, "pos").agg(F.sum("elem").alias("value"))
    return summed.select(by[0], F.date_add(F.col(start), F.col("pos")).alias("date"), "value")


# --- X-19, X-20 --------------------------------------------------------------

def monthly_arrays(events: DataFrame, lo, hi, key: str = "host", visitor: str = "user_id",
                   ts: str = "event_time") -> DataFrame:
    """X-19: per (month, key) full-month arrays of daily hits and distinct visitors.

    Every key active in a month gets ``days in month`` slots, zero where it
    had no events. The key is NOT NULL in the target table, so events
    without a key are left out; visitors count distinct non-NULL ids.
    """
    c = daily_counts(events, key, lo, hi, ts, distinct_of=visitor)
    per = c.groupBy(month_start("day").alias("month"), key).agg(
        F.collect_list(F.struct(F.dayofmonth("day").alias("dom"), "hits", "uniques")).alias("_days"))
    n = days_in_month(F.col("month"))
    return per.select("month", key,
                      dense_month_array(F.col("_days"), n, "hits").alias("hit_array"),
                      dense_month_array(F.col("_days"), n, "uniques").alias("unique_visitors_array"))


def monthly_arrays_step(state: DataFrame, events: DataFrame, day, key: str = "host", visitor: str = "user_id",
                        ts: str = "event_time") -> DataFrame:
    """X-20: apply one day to the monthly arrays (idempotent per day).

    Keys active that day get a zero row for the month if absent (insert if
    absent), then slot ``day of month`` of both arrays is set from that day's
    counts (update from a join). Keys silent that day keep their arrays. Only
    the day's month is read from the state and returned, for that month's
    partition to be replaced. One full outer join on (month, key) does both
    steps and reads the state once, so a day-by-day fold keeps a linear plan.
    """
    today = _day(day)
    m = month_start(today)
    c = daily_counts(events, key, day, day, ts, distinct_of=visitor).select(
        m.alias("month"), key, "hits", "uniques")
    j = state.where(F.col("month") == m).join(c, ["month", key], "full").withColumn("_idx", F.dayofmonth(today)).withColumn(
        "_n", days_in_month(today))
    hit = F.col("hits").isNotNull()
    slot = F.col("_idx")

    def column(arr: str, value: str) -> Column:
        base = F.coalesce(F.col(arr), zeros(F.col("_n")))
        return F.when(hit, set_slot(base, slot, F.col(value))).otherwise(F.col(arr)).alias(arr)

    return j.select("month", key, column("hit_array", "hits"), column("unique_visitors_array", "uniques"))


# --- distinct visitors that merge (A-2 in X-19, X-20) --------------------------

def visitor_bitmaps(events: DataFrame, lo, hi, key: str = "host", visitor: str = "user_id",
                    ts: str = "event_time") -> DataFrame:
    """(key, day, bucket, visitors): each day's distinct visitors as bitmaps, exact and mergeable.

    A visitor id (a whole number; number other ids first) has a bucket of
    32,768 ids and a bit in it. So a day's visitors are stored once, 4 KB a bucket
    at most, and days add up by OR where distinct counts do not. NULL keys and
    NULL visitors are left out. The bitmaps are built in the map tasks; a hot key is
    spread by its visitors' buckets.
    """
    d = F.to_date(F.col(ts))
    src = events.where(d.between(_day(lo), _day(hi)) & F.col(key).isNotNull() & F.col(visitor).isNotNull())
    return src.groupBy(F.col(key), d.alias("day"), F.bitmap_bucket_number(visitor).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(visitor)).alias("visitors"))


def merge_visitors(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bitmaps of the same ``by`` and bucket as one: a state of days, months or keys that merges further."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("visitors").alias("visitors"))


def distinct_visitors(bitmaps: DataFrame, by: Sequence[str], name: str = "unique_visitors") -> DataFrame:
    """The exact number of distinct visitors for each ``by``, from stored bitmaps of any days."""
    merged = merge_visitors(bitmaps, by)
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("visitors")).alias(name))


def rolling_visitors(bitmaps: DataFrame, days: int, key: str = "host", name: str = "unique_visitors") -> DataFrame:
    """(key, day): distinct visitors of the ``days`` days that end with each day on which the key has events.

    Each day's bitmap is handed to the days whose window holds it; a window
    after the key's last day is left out.
    """
    spread = bitmaps.select(key, F.explode(F.sequence(F.col("day"), F.date_add("day", days - 1))).alias("at"), "bucket", "visitors")
    known = bitmaps.select(F.col(key), F.col("day").alias("at")).distinct()
    return distinct_visitors(spread.join(known, [key, "at"], "left_semi"), [key, "at"], name).withColumnRenamed("at", "day")
