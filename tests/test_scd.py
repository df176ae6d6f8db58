from pyspark.sql import functions as F

from conftest import SF_SMALL, rows


def srt(x):
    return sorted(x, key=repr)
from dimfold.operators import scd
from dimfold.plans import catalog

STATE = "player_name string, current_season int, scoring_class string, is_active boolean"
TRACKED = ["scoring_class", "is_active"]


def _state(spark):
    return spark.createDataFrame([
        ("a", 2000, "good", True), ("a", 2001, "good", False), ("a", 2002, "good", False),
        ("a", 2003, "star", True),
        ("n", 2000, "bad", True), ("n", 2001, None, True), ("n", 2002, "bad", True), ("n", 2003, "bad", True),
        ("c", 2003, "bad", True),                       # new in the last season
        ("v", 2000, "bad", True), ("v", 2001, "bad", True), ("v", 2002, "bad", True),  # absent in 2003
    ], STATE)


def test_streaks_fixed_and_reference_null_handling(spark):
    s = _state(spark)
    fixed = rows(scd.scd2_streaks(s, "player_name", "current_season", TRACKED, 2002).where("player_name = 'n'"))
    assert fixed == srt([("n", None, True, 2001, 2001, 2002), ("n", "bad", True, 2000, 2000, 2002),
                     ("n", "bad", True, 2002, 2002, 2002)])
    ref = rows(scd.scd2_streaks(s, "player_name", "current_season", TRACKED, 2002, reference=True)
               .where("player_name = 'n'"))
    # NULL <> x is not a change: one streak, split only by the GROUP BY on the class.
    assert ref == srt([("n", None, True, 2001, 2001, 2002), ("n", "bad", True, 2000, 2002, 2002)])


def test_intervals_do_not_overlap_and_cover(spark):
    s = _state(spark)
    out = scd.scd2_streaks(s, "player_name", "current_season", TRACKED, 2003).collect()
    by_key = {}
    for r in out:
        by_key.setdefault(r.player_name, []).append((r.start_season, r.end_season))
    seasons = {}
    for r in s.where("current_season <= 2003").collect():
        seasons.setdefault(r.player_name, set()).add(r.current_season)
    for k, spans in by_key.items():
        spans.sort()
        covered = set()
        for (a, b), nxt in zip(spans, spans[1:] + [None]):
            assert a <= b
            if nxt:
                assert b < nxt[0]
            covered |= set(range(a, b + 1))
        assert covered == seasons[k]


def test_increment_equals_rebuild(spark):
    s = _state(spark)
    prev = scd.scd2_streaks(s, "player_name", "current_season", TRACKED, 2002)
    inc = scd.scd2_increment(prev, s, "player_name", "current_season", TRACKED, 2002, 2003)
    full = scd.scd2_streaks(s, "player_name", "current_season", TRACKED, 2003)
    assert rows(inc.select(full.columns)) == rows(full)


def test_increment_equals_rebuild_on_test_data(spark):
    c = catalog.Ctx(spark, SF_SMALL)
    state = catalog._player_state(c)
    end = catalog.last_season(c)
    prev = scd.scd2_streaks(state, "player_name", "current_season", TRACKED, end - 1)
    inc = scd.scd2_increment(prev, state, "player_name", "current_season", TRACKED, end - 1, end)
    full = scd.scd2_streaks(state, "player_name", "current_season", TRACKED, end)
    assert rows(inc.select(full.columns)) == rows(full)


def test_reference_increment_defects(spark):
    s = _state(spark)
    prev = scd.scd2_streaks(s, "player_name", "current_season", TRACKED, 2002)
    ref = rows(scd.scd2_increment(prev, s, "player_name", "current_season", TRACKED, 2002, 2003, reference=True)
               .where("player_name = 'c'"))
    # A new key: one all-NULL row plus its new record twice.
    assert ref == srt([("c", None, None, None, None), ("c", "bad", True, 2003, 2003), ("c", "bad", True, 2003, 2003)])
    # A key absent from the new season vanishes from the reference result.
    ref_all = scd.scd2_increment(prev, s, "player_name", "current_season", TRACKED, 2002, 2003, reference=True)
    assert ref_all.where("player_name = 'v' and end_season = 2002").count() == 0


CP = "actorid string, actor string, current_year int, quality_class string, is_active boolean, n_films long"


def _actors(spark):
    return spark.createDataFrame([
        ("1", "A", 2000, "good", True, 1), ("1", "A", 2001, "good", False, 1), ("1", "A", 2002, "star", True, 2),
        ("2", "B", 2001, "bad", True, 1), ("2", "B", 2002, "bad", False, 1),
    ], CP)


def test_change_points_fixed_and_reference(spark):
    a = _actors(spark)
    tr = ["quality_class", "is_active", "n_films"]
    d = {"is_active": False, "n_films": 0}
    fixed = rows(scd.scd2_change_points(a, ["actorid", "actor"], "current_year", tr, d, fill="quality_class"),
                 "actorid", "start_year", "end_year", "quality_class", "is_current")
    assert fixed == srt([("1", 2000, 2000, "good", False), ("1", 2001, 2001, "good", False),
                     ("1", 2002, 2002, "star", True),
                     ("2", 2000, 2000, None, False), ("2", 2001, 2001, "bad", False), ("2", 2002, 2002, "bad", True)])
    a2 = a.where("actorid = '2'").unionByName(
        spark.createDataFrame([("2", "B", 2003, "bad", False, 1)], CP))
    f2 = rows(scd.scd2_change_points(a2, ["actorid", "actor"], "current_year", tr, d, fill="quality_class"),
              "start_year", "end_year", "is_current")
    r2 = rows(scd.scd2_change_points(a2, ["actorid", "actor"], "current_year", tr, d, reference=True,
                                     fill="quality_class"), "start_year", "end_year", "is_current")
    assert f2 == [(2001, 2001, False), (2002, 2003, True)]
    # Reference: LEAD before the filter, so the unchanged tail has no current record.
    assert r2 == [(2001, 2001, False), (2002, 2002, False)]


def test_merge_fixed_equals_rebuild_for_known_keys(spark):
    c = catalog.Ctx(spark, SF_SMALL)
    lo, hi = catalog.film_years(c)
    states = catalog.actor_states(c, hi)
    history = catalog._change_points(states.where(F.col("current_year") < hi), False, lo, hi - 1)
    merged, counts = scd.scd2_merge(history, states, catalog.ACTOR_KEYS, "current_year", catalog.ACTOR_TRACKED,
                                    last_processed=hi - 1)
    full = catalog._change_points(states, False, lo, hi)
    known = history.select("actorid").distinct()
    a = rows(merged.join(known, "actorid", "left_semi"))
    b = rows(full.select(merged.columns).join(known, "actorid", "left_semi"))
    assert a == b
    cnt = counts.first()
    assert cnt.records_inserted >= 0 and cnt.records_updated >= 0


def test_merge_reference_closes_before_start(spark):
    hist = spark.createDataFrame([("1", "A", 2000, 2001, "good", True, 1, True)],
                                 "actorid string, actor string, start_year int, end_year int, quality_class string,"
                                 " is_active boolean, n_films long, is_current boolean")
    snapshot = spark.createDataFrame([("1", "A", 2001, "star", True, 2), ("1", "A", 2002, "star", True, 2)], CP)
    tr = ["quality_class", "is_active", "n_films"]
    m_ref, c_ref = scd.scd2_merge(hist, snapshot, ["actorid", "actor"], "current_year", tr, reference=True)
    # The boundary year is re-read (>=): the open record closes at 2000 and two records are inserted.
    assert rows(c_ref) == [(1, 2)]
    m_fix, c_fix = scd.scd2_merge(hist, snapshot, ["actorid", "actor"], "current_year", tr)
    assert rows(c_fix) == [(1, 1)]
    assert rows(m_fix, "start_year", "end_year", "quality_class", "is_current") == srt([
        (2000, 2001, "good", False), (2002, 2002, "star", True)])


def test_merge_equals_rebuild_where_classes_are_null(spark):
    """With the same fill, classes that come and go give the same records by either way."""
    c = catalog.Ctx(spark, SF_SMALL)
    lo, hi = catalog.film_years(c)
    states = catalog.classed_states(c, hi)
    assert states.where(F.col("quality_class").isNull() & (F.col("current_year") == hi)).count() > 0
    history = catalog._change_points(states.where(F.col("current_year") < hi), False, lo, hi - 1)
    merged, _ = scd.scd2_merge(history, states, catalog.ACTOR_KEYS, "current_year", catalog.ACTOR_TRACKED,
                               last_processed=hi - 1, fill="quality_class")
    full = catalog._change_points(states, False, lo, hi)
    known = history.select("actorid").distinct()
    assert rows(merged.join(known, "actorid", "left_semi")) == rows(full.select(merged.columns).join(known, "actorid", "left_semi"))
