import datetime as dt
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from dimfold.operators import activity
from dimfold.sources.tables import read_table
from dimfold.streaming.daily import DailyStateLoader


def _prepare(df):
    return df.select("user_id", F.col("ts").alias("event_time"), F.col("event_type").alias("host"))


def test_stream_of_event_files_rebuilds_datelists_with_late_file(spark):
    raw = read_table(spark, SF_SMALL, "events")
    root = tempfile.mkdtemp(prefix="dimfold-stream-")
    src, state, ckpt = f"{root}/events", f"{root}/state", f"{root}/ckpt"
    d = F.to_date("ts")
    first = raw.where(d <= F.lit(dt.date(2024, 1, 3)))
    second = raw.where((d >= F.lit(dt.date(2024, 1, 4))) & (d <= F.lit(dt.date(2024, 1, 6))))
    empty = spark.createDataFrame([], "user_id string, dates_active array<date>, date date")
    loader = DailyStateLoader(spark, src, raw.schema, state, activity.datelist_step, empty, prepare=_prepare)

    first.where(F.col("event_id") % 2 == 0).write.mode("append").parquet(src)
    q = loader.start(ckpt)
    q.awaitTermination(300)
    second.write.mode("append").parquet(src)
    # A late file: the rest of the first days' events arrives after days 4..6 were loaded.
    first.where(F.col("event_id") % 2 == 1).write.mode("append").parquet(src)
    q = loader.start(ckpt)
    q.awaitTermination(300)

    got = spark.read.parquet(state).where(F.col("date") == F.lit(dt.date(2024, 1, 6)))
    events = _prepare(raw)
    want = activity.datelist_rebuild(events, dt.date(2024, 1, 1), dt.date(2024, 1, 6))
    assert rows(got.select("user_id", "dates_active", F.col("date").cast("date"))) == rows(want)


def test_stream_rebuilds_monthly_arrays_in_one_month_partition(spark):
    from dimfold.operators import reduced

    raw = read_table(spark, SF_SMALL, "events")
    root = tempfile.mkdtemp(prefix="dimfold-stream-")
    src, state, ckpt = f"{root}/events", f"{root}/state", f"{root}/ckpt"
    d = F.to_date("ts")
    raw.where(d <= F.lit(dt.date(2024, 1, 4))).write.mode("append").parquet(src)
    empty = spark.createDataFrame([], "month date, host string, hit_array array<int>, unique_visitors_array array<int>")

    def step(prev, events, day):
        return reduced.monthly_arrays_step(prev, events, F.lit(day))

    loader = DailyStateLoader(spark, src, raw.schema, state, step, empty, partition_col="month",
                              partition_of=lambda day: day.replace(day=1), prepare=_prepare)
    loader.start(ckpt).awaitTermination(300)
    raw.where(d.between(F.lit(dt.date(2024, 1, 5)), F.lit(dt.date(2024, 1, 7)))).write.mode("append").parquet(src)
    loader.start(ckpt).awaitTermination(300)
    got = spark.read.parquet(state).select("month", "host", "hit_array", "unique_visitors_array")
    want = reduced.monthly_arrays(_prepare(raw), F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 1, 7)))
    assert rows(got.select(F.col("month").cast("date"), "host", "hit_array", "unique_visitors_array")) == rows(want)


def _loader(spark, root, monthly=False):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("user_id long, event_time timestamp, host string")
    if not monthly:
        empty = spark.createDataFrame([], "user_id string, dates_active array<date>, date date")
        return DailyStateLoader(spark, f"{root}/events", schema, f"{root}/state", activity.datelist_step, empty)
    from dimfold.operators import reduced

    empty = spark.createDataFrame([], "month date, host string, hit_array array<int>, unique_visitors_array array<int>")
    return DailyStateLoader(spark, f"{root}/events", schema, f"{root}/state",
                            lambda prev, ev, day: reduced.monthly_arrays_step(prev, ev, F.lit(day)), empty,
                            partition_col="month", partition_of=lambda d: d.replace(day=1))


def _land(spark, root, days):
    rows = [(u, dt.datetime(2024, m, d, 5), "h") for u, m, d in days]
    df = spark.createDataFrame(rows, "user_id long, event_time timestamp, host string")
    df.write.mode("append").parquet(f"{root}/events")
    return df


def test_late_first_day_of_a_month_keeps_the_month(spark, tmp_path):
    from dimfold.operators import reduced

    root = str(tmp_path)
    loader = _loader(spark, root, monthly=True)
    for days in ([(1, 1, 30)], [(1, 2, d) for d in (1, 2, 3, 5)], [(2, 2, 1)]):
        loader.on_batch(_land(spark, root, days), 0)
    got = spark.read.parquet(loader.state_path).select(F.col("month").cast("date"), "host", "hit_array", "unique_visitors_array")
    want = reduced.monthly_arrays(loader.events(), F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 2, 5)))
    assert rows(got) == rows(want)
    assert [2, 1, 1, 0, 1] in [r.hit_array[:5] for r in got.collect()]


def test_skipped_days_are_made_up_for(spark, tmp_path):
    root = str(tmp_path)
    loader = _loader(spark, root)
    loader.on_batch(_land(spark, root, [(1, 1, 2), (2, 1, 3)]), 0)
    loader.on_batch(_land(spark, root, [(3, 1, 6)]), 1)
    for day in range(2, 7):
        got = spark.read.parquet(loader.state_path).where(F.col("date") == F.lit(dt.date(2024, 1, day)))
        want = activity.datelist_rebuild(loader.events(), dt.date(2024, 1, 2), dt.date(2024, 1, day))
        assert rows(got.select("user_id", "dates_active", F.col("date").cast("date"))) == rows(want)


def test_a_state_that_cannot_be_read_is_not_overwritten(spark, tmp_path):
    import pathlib

    import pytest

    root = str(tmp_path)
    loader = _loader(spark, root)
    loader.on_batch(_land(spark, root, [(1, 1, 2)]), 0)
    part = next(pathlib.Path(loader.state_path).glob("date=*/part-*.parquet"))
    whole = part.read_bytes()
    part.write_bytes(whole[:40])
    with pytest.raises(Exception):  # noqa: B017 - whatever the reader says, it must be heard
        loader.on_batch(_land(spark, root, [(2, 1, 2)]), 1)
    assert part.read_bytes() == whole[:40]
