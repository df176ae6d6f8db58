from pyspark.sql import functions as F

from conftest import rows
from dimfold.operators import snapshot as snap

SEASONS = "player_name string, season int, gp int, pts float, reb float, ast float, height string"


def test_cumulative_snapshot_gaps_nulls_and_late_debut(spark):
    df = spark.createDataFrame([
        ("a", 2000, 10, 25.0, 1.0, 1.0, "6-1"),
        ("a", 2002, 10, None, 1.0, 1.0, "6-2"),   # gap year 2001, NULL points in 2002
        ("b", 2003, 5, 12.0, 1.0, 1.0, "6-0"),     # debut in the last season
    ], SEASONS)
    s = snap.cumulative_snapshot(df, "player_name", "season", ["gp", "pts"], 2003, static=["height"],
                                 class_on="pts", cuts=(20, 15, 10), labels=("star", "good", "average", "bad"))
    got = {(r.player_name, r.current_season): r for r in s.collect()}
    assert sorted(got) == [("a", 2000), ("a", 2001), ("a", 2002), ("a", 2003), ("b", 2003)]
    a01 = got[("a", 2001)]
    assert [x.season for x in a01.season_stats] == [2000]
    assert a01.is_active is False and a01.years_since_last_season == 1 and a01.scoring_class == "star"
    a02 = got[("a", 2002)]
    assert a02.is_active is True and a02.scoring_class == "bad"  # NULL points fall to the last class
    assert got[("a", 2003)].height == "6-2"  # static attributes are the MAX over all rows
    assert got[("b", 2003)].scoring_class == "average" and got[("b", 2003)].is_active is True


def test_start_clips_history_and_only_end(spark):
    df = spark.createDataFrame([("a", 1990, 1, 30.0, 0.0, 0.0, "x"), ("a", 1997, 1, 5.0, 0.0, 0.0, "x")], SEASONS)
    s = snap.cumulative_snapshot(df, "player_name", "season", ["pts"], 1998, start=1996)
    assert [r.current_season for r in s.orderBy("current_season").collect()] == [1996, 1997, 1998]
    first = s.where("current_season = 1996").first()
    assert first.season_stats == [] and first.is_active is None  # no element yet: NULL flag
    end = snap.cumulative_snapshot(df, "player_name", "season", ["pts"], 1998, only_end=True)
    assert [r.current_season for r in end.collect()] == [1998]


def test_explode_and_improvement_guards(spark):
    df = spark.createDataFrame([
        ("z", 2000, 1, 0.0, 0.0, 0.0, "x"), ("z", 2001, 1, 8.0, 0.0, 0.0, "x"),
        ("n", 2000, 1, None, 0.0, 0.0, "x"), ("n", 2001, 1, 6.0, 0.0, 0.0, "x"),
        ("p", 2000, 1, 4.0, 0.0, 0.0, "x"), ("p", 2001, 1, 6.0, 0.0, 0.0, "x"),
    ], SEASONS)
    s = snap.cumulative_snapshot(df, "player_name", "season", ["pts"], 2001, only_end=True)
    assert rows(snap.explode_snapshot(s, ["player_name"], "season_stats"), "player_name", "season") == [
        ("n", 2000), ("n", 2001), ("p", 2000), ("p", 2001), ("z", 2000), ("z", 2001)]
    nullif = dict(rows(snap.improvement(s, ["player_name"], "season_stats", "pts", "nullif")))
    case = dict(rows(snap.improvement(s, ["player_name"], "season_stats", "pts", "case")))
    assert nullif == {"n": 6.0, "p": 1.5, "z": 8.0}
    assert case == {"n": None, "p": 1.5, "z": 8.0}


FILMS = "actor string, actorid string, film string, year int, votes int, rating decimal(10,2), filmid string"


def _films(spark):
    from decimal import Decimal

    raw = [
        ("A", "1", "f9", 2000, 10, 8.5, "f9"),
        ("A", "1", "f10", 2000, 10, 6.5, "f10"),  # '10' < '9' as text: f9 is the last film of 2000
        ("A", "1", "f10", 2000, 10, 6.5, "f10"),  # exact copy
        ("A", "1", "g", 2002, 3, 7.5, "g"),
        ("A", "2", "h", 2001, 3, 9.0, "h"),       # a namesake with another id
    ]
    return spark.createDataFrame([r[:5] + (Decimal(str(r[5])),) + r[6:] for r in raw], FILMS)


def test_snapshot_multi_summary_equals_item_arrays(spark):
    df = _films(spark)
    kw = dict(class_on="rating", cuts=(8, 7, 6), labels=("star", "good", "average", "bad"))
    summ = snap.cumulative_snapshot_multi(df, ["actorid", "actor"], "year", ["film", "votes", "rating", "filmid"],
                                          2002, **kw)
    full = snap.cumulative_snapshot_multi(df, ["actorid", "actor"], "year", ["film", "votes", "rating", "filmid"],
                                          2002, with_items=True, **kw)
    got = {(r.actorid, r.current_year): r for r in full.collect()}
    assert [f.film for f in got[("1", 2000)].films] == ["f10", "f9"]
    assert got[("1", 2000)].quality_class == "star" and got[("1", 2001)].is_active is False
    assert got[("1", 2002)].quality_class == "good" and got[("1", 2002)].n_films == 3
    assert got[("2", 2002)].years_since_last_film == 1
    for r in full.collect():
        assert r.n_films == len(r.films) and r.last_film == r.films[-1]
    cols = ["actorid", "current_year", "n_films", "quality_class", "is_active", "years_since_last_film"]
    assert rows(summ, *cols) == rows(full, *cols)


def test_entity_history_point_lookup(spark):
    df = _films(spark)
    s = snap.cumulative_snapshot_multi(df, ["actorid", "actor"], "year", ["film", "votes", "rating", "filmid"], 2002)
    h = snap.entity_history(df, ["actorid", "actor"], "year", ["film", "votes", "rating", "filmid"], s,
                            name_col="actor", name="A", at=2000, as_list=True)
    assert rows(h, "actorid", "current_year", "n_films", "films_this_year") == [("1", 2000, 2, ["f10", "f9"])]
    long = snap.entity_history(df, ["actorid", "actor"], "year", ["film", "votes", "rating", "filmid"], s,
                               name_col="actor", name="A", at=2000)
    assert rows(long, "actorid", "current_year", "n_films", "film") == [("1", 2000, 2, "f10"), ("1", 2000, 2, "f9")]


def test_entity_spine_empty_series_for_late_first(spark):
    df = spark.createDataFrame([("a", 2005), ("b", 2001)], "k string, p int")
    sp = snap.entity_spine(df, "k", "p", 2003)
    assert rows(sp) == [("b", 2001), ("b", 2002), ("b", 2003)]
    assert rows(snap.entity_spine(df, "k", "p", 2003, start=2002)) == [("b", 2002), ("b", 2003)]
    assert F is not None


def test_null_keys_yield_no_snapshot_rows(spark):
    df = spark.createDataFrame([(None, 2000, 1, 25.0, 0.0, 0.0, "x"), ("a", 2000, 1, 5.0, 0.0, 0.0, "x")], SEASONS)
    s = snap.cumulative_snapshot(df, "player_name", "season", ["pts"], 2001)
    assert rows(s, "player_name", "current_season") == [("a", 2000), ("a", 2001)]
