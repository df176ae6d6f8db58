"""Randomised properties: incremental SCD2 == full rebuild; intervals tile each key's periods."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from dimfold.operators import scd

CLASSES = st.sampled_from(["star", "good", "bad", None])
SEASON = st.tuples(CLASSES, st.booleans(), st.booleans())  # (class, active, present this season)
HISTORY = st.lists(st.lists(SEASON, min_size=1, max_size=6), min_size=1, max_size=5)
TRACKED = ["scoring_class", "is_active"]


def _frame(spark, history):
    data = []
    for k, seasons in enumerate(history):
        for i, (cls, active, present) in enumerate(seasons):
            if present or i == 0:
                data.append((f"p{k}", 2000 + i, cls, active))
    return spark.createDataFrame(data, "player_name string, current_season int, scoring_class string, is_active boolean")


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(history=HISTORY)
def test_increment_equals_rebuild_random(spark, history):
    df = _frame(spark, history)
    last = max(r.current_season for r in df.select("current_season").collect())
    if last == 2000:
        return
    prev = scd.scd2_streaks(df, "player_name", "current_season", TRACKED, last - 1)
    inc = scd.scd2_increment(prev, df, "player_name", "current_season", TRACKED, last - 1, last)
    full = scd.scd2_streaks(df, "player_name", "current_season", TRACKED, last)
    assert rows(inc.select(full.columns)) == rows(full)
    # The streak table covers exactly each key's seasons, without overlap.
    seasons = {}
    for r in df.collect():
        seasons.setdefault(r.player_name, set()).add(r.current_season)
    spans = {}
    for r in full.collect():
        spans.setdefault(r.player_name, []).append((r.start_season, r.end_season))
    for k, ss in spans.items():
        ss.sort()
        assert all(a[1] < b[0] for a, b in zip(ss, ss[1:]))
        covered = {y for a, b in ss for y in range(a, b + 1) if y in seasons[k]}
        assert covered == seasons[k]


EVENT = st.tuples(st.sampled_from([1, 2, 3, None]), st.integers(min_value=1, max_value=5),
                  st.integers(min_value=0, max_value=23), st.sampled_from(["h1", "h2"]))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events=st.lists(EVENT, min_size=1, max_size=25))
def test_daily_folds_equal_rebuilds_random(spark, events):
    import datetime as dt

    from pyspark.sql import functions as F

    from dimfold.operators import activity, reduced

    ev = spark.createDataFrame([(u, dt.datetime(2024, 1, d, h), host) for u, d, h, host in events],
                               "user_id long, event_time timestamp, host string")
    days = [dt.date(2024, 1, d) for d in range(1, 6)]
    dl = spark.createDataFrame([], "user_id string, dates_active array<date>, date date")
    ma = spark.createDataFrame([], "user_id long, month_start date, metric_name string, metric_array array<float>")
    mo = spark.createDataFrame([], "month date, host string, hit_array array<int>, unique_visitors_array array<int>")
    for day in days:
        dl = activity.datelist_step(dl, ev, day)
        ma = reduced.metric_array_step(ma, ev, F.lit(day))
        mo = reduced.monthly_arrays_step(mo, ev, F.lit(day))
    assert rows(dl) == rows(activity.datelist_rebuild(ev, days[0], days[-1]))
    assert rows(ma) == rows(reduced.metric_array_rebuild(ev, F.lit(days[-1])))
    full = reduced.monthly_arrays(ev, F.lit(days[0]), F.lit(days[-1]))
    assert rows(mo) == rows(full)
    # Re-running any day changes nothing.
    assert rows(reduced.monthly_arrays_step(mo, ev, F.lit(days[2]))) == rows(full)


ACTOR = st.tuples(st.integers(min_value=0, max_value=4),                      # debut offset
                  st.lists(st.tuples(st.sampled_from(["star", "good", None]), st.booleans(), st.integers(0, 2)),
                           min_size=5, max_size=5))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(actors=st.lists(ACTOR, min_size=1, max_size=4))
def test_merge_equals_change_point_rebuild_random(spark, actors):
    from pyspark.sql import functions as F

    data = []
    for i, (debut, years) in enumerate(actors):
        films = 0
        for off in range(debut, 5):
            cls, active, new = years[off]
            films += new
            data.append((str(i), f"a{i}", 2000 + off, cls, active, films))
    df = spark.createDataFrame(data, "actorid string, actor string, current_year int, quality_class string,"
                                     " is_active boolean, n_films long")
    tracked = ["quality_class", "is_active", "n_films"]
    keys = ["actorid", "actor"]
    d = {"is_active": False, "n_films": 0}
    hist = scd.scd2_change_points(df.where(F.col("current_year") < 2004), keys, "current_year", tracked, d,
                                  fill="quality_class", lo=2000, hi=2003)
    merged, _ = scd.scd2_merge(hist, df, keys, "current_year", tracked, last_processed=2003, fill="quality_class")
    full = scd.scd2_change_points(df, keys, "current_year", tracked, d, fill="quality_class", lo=2000, hi=2004)
    known = hist.select("actorid").distinct()
    assert rows(merged.join(known, "actorid", "left_semi")) == rows(full.select(merged.columns).join(known, "actorid", "left_semi"))
