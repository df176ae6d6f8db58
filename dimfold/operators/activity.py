"""Activity datelists (X-13 .. X-17).

A datelist row holds, per user and snapshot day, the days the user was
active. The daily job is a full join of yesterday's snapshot with today's
distinct active users; the full rebuild is one grouped aggregate. Per-user
date sets are bounded by the days in the window (map-side ``collect_set``
already de-duplicates), so no group grows with the event volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimfold.functions.columns import MASK32, bits32_text, json_object, yyyymmdd


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def _day(v) -> Column:
    return F.to_date(_lit(v))


def active_days(events: DataFrame, key: str, ts: str, lo, hi) -> DataFrame:
    """Distinct (key, day) with a non-NULL key between two days (inclusive).

    ``to_date(ts)`` between constant days is rewritten by Spark into a range
    on ``ts`` and pushed into the Parquet scan.
    """
    d = F.to_date(F.col(ts))
    return (events.where(F.col(key).isNotNull() & d.between(_day(lo), _day(hi)))
            .select(F.col(key), d.alias("date_active")).distinct())


def datelist_step(prev: DataFrame, events: DataFrame, day, key: str = "user_id", ts: str = "event_time",
                  out_key: str = "user_id") -> DataFrame:
    """X-13 daily step: yesterday's snapshot full-joined with today's active users.

    Today's date is prepended to the list of an active user; an inactive
    user's list is carried forward; the snapshot day is today for everyone.
    ``prev`` has (out_key, dates_active, date); only its ``date = day - 1``
    rows are read.
    """
    today = (active_days(events, key, ts, day, day)
             .select(F.col(key).cast("string").alias(out_key), "date_active"))
    y = prev.where(F.col("date") == F.date_sub(_day(day), 1)).select(out_key, "dates_active", "date")
    j = today.alias("t").join(y.alias("y"), out_key, "full")
    t_date = F.col("t.date_active")
    y_dates = F.col("y.dates_active")
    dates = (F.when(y_dates.isNull(), F.array(t_date))
             .when(t_date.isNull(), y_dates)
             .otherwise(F.concat(F.array(t_date), y_dates)))
    return j.select(out_key, dates.alias("dates_active"),
                    F.coalesce(t_date, F.date_add(F.col("y.date"), 1)).alias("date"))


def datelist_rebuild(events: DataFrame, start, day, key: str = "user_id", ts: str = "event_time",
                     out_key: str = "user_id") -> DataFrame:
    """X-13 full rebuild: equals folding ``datelist_step`` from ``start`` to ``day``."""
    d = active_days(events, key, ts, start, day)
    return d.groupBy(F.col(key).cast("string").alias(out_key)).agg(
        F.sort_array(F.collect_list("date_active"), asc=False).alias("dates_active")
    ).withColumn("date", _day(day))


def datelist_bits(df: DataFrame, day, series_start, key: str = "user_id", dates: str = "dates_active",
                  reference: bool = False, week_days: int = 7) -> DataFrame:
    """X-14: active days as a 32-bit map back from the snapshot day.

    For each active day d in [series_start, day], n = day - d days back:
    fixed form sets bit 31 - n (today is the top bit, 32 days fit); the
    reference form adds 2^(32 - n) for each day of the series (a repeated
    date counts once) and keeps the low 32 bits, which loses today and shifts
    the week mask to days 1..7 back. Counts come from
    ``bit_count``; weekly activity masks the top ``week_days`` bits.
    No users x days cross join: one higher-order ``aggregate`` per row.
    """
    # Day bounds may be scalar subqueries, which Spark does not allow inside
    # lambdas: carry them as columns.
    src = df.select(key, dates, _day(series_start).alias("_lo"), _day(day).alias("_hi"))
    lo, hi = F.col("_lo"), F.col("_hi")
    one = F.lit(1).cast("long")
    inside = F.filter(F.col(dates), lambda x: (x >= lo) & (x <= hi))
    if reference:
        bits = F.aggregate(F.array_distinct(inside), F.lit(0).cast("long"),
                           lambda acc, x: acc + F.call_function("shiftleft", one, 32 - F.datediff(hi, x)))
        bits = bits.bitwiseAND(F.lit(MASK32))
    else:
        bits = F.aggregate(F.filter(inside, lambda x: F.datediff(hi, x) <= 31), F.lit(0).cast("long"),
                           lambda acc, x: acc.bitwiseOR(F.call_function("shiftleft", one, 31 - F.datediff(hi, x))))
    return bits_activity(src.select(key, bits.alias("datelist_int")), key, week_days=week_days)


def json_datelist(events: DataFrame, key: str, start, end, ts: str = "event_time",
                  list_name: str = "device_activity_datelist", key_type: str | None = None) -> DataFrame:
    """X-15: per key and day ``{"active_dates": [day]}``; NULL keys dropped.

    Keyed (key, date). Reloads go through ``state.merge_concat`` on
    ``active_dates`` (append as the scripts do, or union to be rerun-safe).
    """
    d = active_days(events, key, ts, start, end)
    k = F.col(key) if key_type is None else F.col(key).cast(key_type)
    return d.select(k.alias(key), F.col("date_active").alias("date"),
                    F.array(F.col("date_active")).alias("active_dates"))


def datelist_json_text(df: DataFrame, list_col: str = "active_dates", name: str = "device_activity_datelist") -> Column:
    return json_object(("active_dates", list_col)).alias(name)


def subkey_datelist(events: DataFrame, key: str, subkey: str, start, end, ts: str = "event_time",
                    name: str = "device_activity_datelist") -> DataFrame:
    """X-16: per key a map sub-key -> sorted active days (``MAP<STRING, ARRAY<DATE>>``).

    Events without a key or without a sub-key are left out: a map has no NULL
    key. One row per (key, sub-key) is built first; the map is assembled from at
    most one entry per sub-key, so no map is ever de-duplicated.
    """
    d = F.to_date(F.col(ts))
    per_sub = (events.where(F.col(key).isNotNull() & F.col(subkey).isNotNull() & d.between(_day(start), _day(end)))
               .groupBy(key, subkey).agg(F.sort_array(F.collect_set(d)).alias("dates")))
    return per_sub.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(subkey), F.col("dates")))).alias(name))


def subkey_datelist_step(prev: DataFrame, events: DataFrame, day, key: str, subkey: str, ts: str = "event_time",
                         name: str = "device_activity_datelist") -> DataFrame:
    """X-16 with M-2: one day merged into the maps, sub-key by sub-key.

    ``prev`` has (key, ``name``), the maps up to the day before. One full join of
    the state with the day's maps; ``map_zip_with`` unites the days of a sub-key
    that both know, keeps the others, and adds new ones. Days stay sorted and
    unique, so a rerun of a day changes nothing and a late day falls into its
    place. Keys silent that day keep their map; a NULL list of a sub-key counts as
    none. Equals ``subkey_datelist`` over all days so far.
    """
    today = subkey_datelist(events, key, subkey, day, day, ts, name)
    both = prev.select(key, name).alias("y").join(today.alias("t"), key, "full")
    old, new = F.col(f"y.{name}"), F.col(f"t.{name}")
    none = F.array().cast("array<date>")
    united = F.map_zip_with(old, new, lambda _, a, b: F.sort_array(F.array_union(F.coalesce(a, none), F.coalesce(b, none))))
    return both.select(key, F.coalesce(united, old, new).alias(name))


def datelist_bits_step(prev: DataFrame, events: DataFrame, day, key: str = "user_id", ts: str = "event_time",
                       out_key: str = "user_id") -> DataFrame:
    """X-14 as state: (out_key, datelist_int, date), 32 bits a user, rolled forward by a day.

    ``prev`` has the users at ``day - 1`` (other days are not read). Each day moves
    every user's bits one place down, today's activity is the top bit, and what is
    more than 31 days back falls out. No list of dates is kept, so the state stays 8
    bytes a user. A new user enters with the top bit; a silent one stays, with
    no bit after 32 days. Equals ``datelist_bits`` (fixed form) of the days that were
    stepped through.
    """
    today = active_days(events, key, ts, day, day).select(F.col(key).cast("string").alias(out_key), F.lit(True).alias("_active"))
    y = prev.where(F.col("date") == F.date_sub(_day(day), 1)).select(out_key, "datelist_int")
    moved = F.shiftrightunsigned(F.coalesce(F.col("datelist_int"), F.lit(0).cast("long")).bitwiseAND(F.lit(MASK32)), 1)
    top = F.when(F.col("_active"), F.lit(1 << 31)).otherwise(F.lit(0)).cast("long")
    return y.join(today, out_key, "full").select(out_key, moved.bitwiseOR(top).alias("datelist_int"), _day(day).alias("date"))


def bits_activity(df: DataFrame, key: str = "user_id", bits: str = "datelist_int", week_days: int = 7) -> DataFrame:
    """The report columns of a 32-bit state, as ``datelist_bits`` gives them: text, active days, monthly and weekly activity."""
    b = F.col(bits)
    week = b.bitwiseAND(F.lit(((1 << week_days) - 1) << (32 - week_days)))
    return df.select(
        key, b.alias("datelist_int"), bits32_text(b).alias("datelist_bits"), F.bit_count(b).cast("int").alias("active_days"),
        (F.bit_count(b) > 0).alias("dim_is_monthly_active"), (F.bit_count(week) > 0).alias("dim_is_weekly_active"))


def activity_report(df: DataFrame, start, end, key: str = "user_id", list_col: str = "active_dates",
                    date_col: str = "date", reference: bool = False) -> DataFrame:
    """X-17 ``get_user_activity(start, end)``.

    Reference form groups by (key, list): with one date per list this gives
    one row per key and day with ``active_days`` = 1. Fixed form: one row per
    key over the range, counting distinct active days; an empty or NULL list
    counts none, its key stays.
    """
    src = df.where(F.col(date_col).between(_day(start), _day(end)))
    if reference:
        return src.groupBy(key, list_col).agg(
            F.size(list_col).alias("active_days"),
            F.min(date_col).alias("first_seen"), F.max(date_col).alias("last_seen")).drop(list_col)
    days = src.select(key, date_col, F.explode_outer(list_col).alias("_d"))
    return days.groupBy(key).agg(
        F.count_distinct("_d").cast("int").alias("active_days"),
        F.min(date_col).alias("first_seen"), F.max(date_col).alias("last_seen"))


def datelist_int(df: DataFrame, list_col: str = "active_dates", name: str = "datelist_int") -> DataFrame:
    """X-17 / S-8: the list as ``YYYYMMDD`` integers (a new column, default empty)."""
    ints = F.transform(F.col(list_col), lambda d: yyyymmdd(d))
    return df.withColumn(name, F.coalesce(ints, F.array().cast("array<int>")))


def parse_datelist(json_col: str) -> Column:
    """``j->'active_dates'`` of a JSON datelist as ``array<date>``."""
    return F.from_json(F.col(json_col), "active_dates array<date>")["active_dates"]
