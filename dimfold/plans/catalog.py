"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the whole base tables (through the stand-in views) and
keeps its output scalar and comparable across engines: arrays become
delimited text, dates ISO text, JSON is extracted or compact text, and REAL
values are widened to DOUBLE. Period bounds (last season, snapshot day) are
the load period of the base fact table: scalar subqueries for the MIN/MAX of
its date column, inside the plan, so no job runs while a query is built.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimfold.functions.columns import array_text, last_item
from dimfold.operators import activity, facts, graph, quality, reduced, reports, scd, sql_functions, state
from dimfold.operators import snapshot as snap
from dimfold.session import ensure_checkpoint_dir
from dimfold.sources import fixtures as fx
from dimfold.sources.tables import Tables


class _Ctx:
    """Lazy stand-in views over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = Tables(spark, sf_dir)
        self._views: dict[str, DataFrame] = {}

    def view(self, name: str) -> DataFrame:
        if name not in self._views:
            self._views[name] = getattr(fx, name)(self.t)
        return self._views[name]

    @property
    def player_seasons(self):
        return self.view("player_seasons")

    @property
    def actor_films(self):
        return self.view("actor_films")

    @property
    def games(self):
        return self.view("games")

    @property
    def game_details(self):
        return self.view("game_details")

    @property
    def teams(self):
        return self.view("teams")

    @property
    def events(self):
        return self.view("events")


def Ctx(spark: SparkSession, sf_dir: str) -> _Ctx:
    """The views of one data folder for one query; nothing outlives the query,
    so files that land in the folder are seen by the next one."""
    return _Ctx(spark, sf_dir)


def iso(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd")


# --- dimension snapshots ---------------------------------------------------

PLAYER_STATIC = ("height", "college", "country", "draft_year", "draft_round", "draft_number")
PLAYER_STATS = ("gp", "pts", "reb", "ast")


def _bounds(c: _Ctx, table: str, column: str) -> tuple[F.Column, F.Column]:
    """MIN and MAX of one base-table column, as scalar subqueries: the load period of this run.

    A scheduler passes the period to its daily job and the operators take it
    as an argument; the registered queries have only the folder, so the plan
    reads one column for it (once: Spark merges the two subqueries).
    """
    r = getattr(c.t, table).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return r.select("lo").scalar(), r.select("hi").scalar()


def order_years(c: _Ctx) -> tuple[F.Column, F.Column]:
    """The load period of the order facts: first and last order year."""
    lo, hi = _bounds(c, "orders", "o_orderdate")
    return F.year(lo), F.year(hi)


def last_season(c: _Ctx) -> F.Column:
    return order_years(c)[1]


def players_snapshot(c: _Ctx) -> DataFrame:
    ps = c.player_seasons
    end = last_season(c)
    return snap.cumulative_snapshot(
        ps, "player_name", "season", PLAYER_STATS, end, static=PLAYER_STATIC,
        class_on="pts", cuts=fx.PLAYER_POINT_CUTS, labels=fx.CLASS_LABELS)


def q01_cumulative_snapshot(spark, sf_dir):
    s = players_snapshot(Ctx(spark, sf_dir))
    last = last_item("season_stats")
    return s.select(
        "player_name", "current_season", "height", "country", "draft_year",
        F.size("season_stats").alias("n_seasons"),
        array_text(F.transform("season_stats", lambda x: x["season"])).alias("season_list"),
        last["pts"].cast("double").alias("last_pts"),
        "scoring_class", "years_since_last_season", "is_active",
    )


def players_at_end(c: _Ctx) -> DataFrame:
    """The snapshot at the last season only (what ``WHERE current_season = y`` reads)."""
    ps = c.player_seasons
    end = last_season(c)
    return snap.cumulative_snapshot(
        ps, "player_name", "season", PLAYER_STATS, end, static=PLAYER_STATIC, start=None,
        class_on="pts", cuts=fx.PLAYER_POINT_CUTS, labels=fx.CLASS_LABELS, only_end=True)


def q02_snapshot_exploded(spark, sf_dir):
    s = players_at_end(Ctx(spark, sf_dir))
    e = snap.explode_snapshot(s, ["player_name"], "season_stats")
    return e.select("player_name", "season", "gp", *[F.col(x).cast("double").alias(x) for x in ("pts", "reb", "ast")])


def q03_improvement_nullif(spark, sf_dir):
    s = players_at_end(Ctx(spark, sf_dir))
    r = snap.improvement(s, ["player_name"], "season_stats", "pts", guard="nullif")
    return r.select("player_name", F.round("improvement", 6).alias("improvement"))


def q03b_improvement_case(spark, sf_dir):
    s = players_at_end(Ctx(spark, sf_dir)).where(F.col("scoring_class") == "star")
    r = snap.improvement(s, ["player_name"], "season_stats", "pts", guard="case")
    return r.select("player_name", F.round("improvement", 6).alias("improvement"))


ACTOR_KEYS = ["actorid", "actor"]
FILM_ITEM = ["film", "votes", "rating", "filmid"]


def film_years(c: _Ctx) -> tuple[F.Column, F.Column]:
    return order_years(c)


def actors_snapshot(c: _Ctx, end: F.Column | None = None, with_static: bool = False, with_items: bool = False) -> DataFrame:
    af = c.actor_films
    end = film_years(c)[1] if end is None else end
    static = [] if not with_static else [F.count_distinct("film").alias("total_films"),
              (F.sum("rating").cast("double") / F.count("rating")).alias("average_rating")]
    return snap.cumulative_snapshot_multi(
        af, ACTOR_KEYS, "year", FILM_ITEM, end, static_aggs=static, with_items=with_items,
        class_on="rating", cuts=fx.ACTOR_RATING_CUTS, labels=fx.CLASS_LABELS)


def q04_snapshot_multi(spark, sf_dir):
    a = actors_snapshot(Ctx(spark, sf_dir), with_static=True)
    return a.select(
        "actor", "actorid", "current_year", "n_films",
        F.col("last_film")["film"].alias("last_film"),
        F.col("last_film")["rating"].cast("double").alias("last_rating"),
        "quality_class", "is_active", "years_since_last_film", "total_films", "average_rating")


def q05_entity_history(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    a = actors_snapshot(c)
    h = snap.entity_history(c.actor_films, ACTOR_KEYS, "year", FILM_ITEM, a)
    return h.select(F.col("actor").alias("actor_name"), "actorid", "current_year",
                    F.col("n_films").cast("int").alias("num_films"), "is_active",
                    "film", "votes", F.col("rating").cast("double").alias("rating"), "filmid")


# --- SCD2 ------------------------------------------------------------------

PLAYER_TRACKED = ["scoring_class", "is_active"]


def _classed(df: DataFrame, column: str, idle: str) -> DataFrame:
    """A tracked class is NULL in the first, third, .. year of an absence, so that NULLs come and go in the histories."""
    return df.withColumn(column, F.when(F.col(idle) % 2 == 0, F.col(column)))


def _player_state(c: _Ctx) -> DataFrame:
    s = _classed(players_snapshot(c), "scoring_class", "years_since_last_season")
    return s.select("player_name", "current_season", *PLAYER_TRACKED)


def q06_scd2_streaks(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    state = _player_state(c)
    cutoff = last_season(c) - 1
    return scd.scd2_streaks(state, "player_name", "current_season", PLAYER_TRACKED, cutoff)


def _increment(spark, sf_dir, reference):
    c = Ctx(spark, sf_dir)
    state = _player_state(c)
    end = last_season(c)
    cutoff = end - 1
    prev = scd.scd2_streaks(state, "player_name", "current_season", PLAYER_TRACKED, cutoff)
    return scd.scd2_increment(prev, state, "player_name", "current_season", PLAYER_TRACKED,
                              cutoff, end, reference=reference)


def q07_scd2_increment(spark, sf_dir):
    return _increment(spark, sf_dir, False)


def q07b_scd2_increment_ref(spark, sf_dir):
    return _increment(spark, sf_dir, True)


ACTOR_TRACKED = ["quality_class", "is_active", "n_films"]
ACTOR_DEFAULTS = {"is_active": False, "n_films": 0}


def actor_states(c: _Ctx, end: F.Column) -> DataFrame:
    return actors_snapshot(c, end=end).select(*ACTOR_KEYS, "current_year", *ACTOR_TRACKED)


def classed_states(c: _Ctx, end: F.Column) -> DataFrame:
    """The actor states of the SCD queries: some classes are NULL."""
    s = _classed(actors_snapshot(c, end=end), "quality_class", "years_since_last_film")
    return s.select(*ACTOR_KEYS, "current_year", *ACTOR_TRACKED)


def _change_points(states, reference, lo, hi):
    return scd.scd2_change_points(states, ACTOR_KEYS, "current_year", ACTOR_TRACKED,
                                  defaults=ACTOR_DEFAULTS, reference=reference, fill="quality_class",
                                  lo=lo, hi=hi)


def _cp_query(spark, sf_dir, reference):
    c = Ctx(spark, sf_dir)
    lo, hi = film_years(c)
    # The snapshot spine starts at each actor's first year, so its first period is the films' first year.
    return _change_points(classed_states(c, hi), reference, lo, hi)


def q08_scd2_change_points(spark, sf_dir):
    return _cp_query(spark, sf_dir, False)


def q08b_scd2_change_points_ref(spark, sf_dir):
    return _cp_query(spark, sf_dir, True)


def _merge(spark, sf_dir, reference):
    """Merge the last year into the history built up to the year before.

    In production the snapshot and the SCD history are stored tables; here
    both are derived from the base tables in the same plan.
    """
    c = Ctx(spark, sf_dir)
    lo, hi = film_years(c)
    states = classed_states(c, hi)
    history = _change_points(states.where(F.col("current_year") < hi), reference, lo, hi - 1)
    return scd.scd2_merge(history, states, ACTOR_KEYS, "current_year", ACTOR_TRACKED, reference=reference,
                          last_processed=hi - 1, fill=None if reference else "quality_class")


def q09_scd2_merge(spark, sf_dir):
    return _merge(spark, sf_dir, False)[0]


def q09b_scd2_merge_ref(spark, sf_dir):
    return _merge(spark, sf_dir, True)[0]


def q10_scd2_merge_counts(spark, sf_dir):
    return _merge(spark, sf_dir, False)[1]


def q10b_scd2_merge_counts_ref(spark, sf_dir):
    return _merge(spark, sf_dir, True)[1]


# --- grain, dedupe, facts ----------------------------------------------------

DETAIL_KEYS = ["game_id", "team_id", "player_id"]


def q11_duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(Ctx(spark, sf_dir).game_details, DETAIL_KEYS)


def q12_duplicate_rows(spark, sf_dir):
    return quality.duplicate_rows(Ctx(spark, sf_dir).game_details, DETAIL_KEYS)


def q13_dedupe_first(spark, sf_dir):
    return quality.dedupe_first(Ctx(spark, sf_dir).game_details, DETAIL_KEYS)


def fact_game_details(c: _Ctx) -> DataFrame:
    return facts.build_fact(c.game_details, c.games)


def _iso_dates(df: DataFrame) -> DataFrame:
    return df.select(*[iso(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "date" else F.col(f.name)
                       for f in df.schema.fields])


def _fact_out(df: DataFrame) -> DataFrame:
    out = _iso_dates(df)
    return out.withColumn("m_minutes", F.round(F.col("m_minutes").cast("double"), 4))


def q14_fact_build(spark, sf_dir):
    return _fact_out(fact_game_details(Ctx(spark, sf_dir)))


def q15_fact_team_join(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return _fact_out(facts.fact_with_dimension(fact_game_details(c), c.teams, "dim_team_id", "team_id", dedupe=True))


def q15b_fact_team_join_ref(spark, sf_dir):
    """The scripts' join: the dimension as it is, so its duplicate rows multiply the facts (formatted once each, before)."""
    c = Ctx(spark, sf_dir)
    out = facts.fact_with_dimension(_fact_out(fact_game_details(c)), c.teams, "dim_team_id", "team_id",
                                    spread=["dim_player_id", "dim_game_date"])
    return out.select("team_id", "arena", "dim_game_date", "dim_player_id", "m_minutes", "m_pts")


def q16_rate_report(spark, sf_dir):
    f = fact_game_details(Ctx(spark, sf_dir))
    r = facts.rate_report(f, ["dim_player_name", "dim_is_playing_at_home"], "dim_not_with_team",
                          where=F.col("dim_is_playing_at_home") == True)  # noqa: E712
    return r.withColumn("bail_pct", F.round("bail_pct", 6))


# --- graph -------------------------------------------------------------------

def graph_vertices(c: _Ctx) -> DataFrame:
    return graph.all_vertices(c.games, c.game_details, c.teams)


def q17_vertices(spark, sf_dir):
    return graph_vertices(Ctx(spark, sf_dir))


def q18_vertex_counts(spark, sf_dir):
    return graph.vertex_counts(graph_vertices(Ctx(spark, sf_dir)))


def q19_player_edges(spark, sf_dir):
    return graph.co_occurrence_edges(Ctx(spark, sf_dir).game_details)


def q20_plays_in_edges(spark, sf_dir):
    return graph.membership_edges(Ctx(spark, sf_dir).game_details)


def q21_points_per_game(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    starts = graph.edge_starts(c.game_details)
    return graph.points_per_game(graph_vertices(c), starts).withColumn("ppg", F.round("ppg", 6))


# --- activity ----------------------------------------------------------------

def event_days(c: _Ctx):
    """First and last event day of the data."""
    lo, hi = _bounds(c, "events", "ts")
    return F.to_date(lo), F.to_date(hi)


def _datelist_out(df: DataFrame) -> DataFrame:
    return df.select("user_id", array_text("dates_active").alias("dates_active"), iso(F.col("date")).alias("date"))


def q22_datelist(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    lo, hi = event_days(c)
    return _datelist_out(activity.datelist_rebuild(c.events, lo, hi))


def q22b_datelist_step(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    lo, hi = event_days(c)
    prev = activity.datelist_rebuild(c.events, lo, F.date_sub(hi, 1))
    return _datelist_out(activity.datelist_step(prev, c.events, hi))


def _bits(spark, sf_dir, reference):
    c = Ctx(spark, sf_dir)
    lo, hi = event_days(c)
    users = activity.datelist_rebuild(c.events, lo, hi)
    return activity.datelist_bits(users, hi, F.trunc(hi, "month"), reference=reference)


def q23_datelist_bits(spark, sf_dir):
    return _bits(spark, sf_dir, False)


def q23b_datelist_bits_ref(spark, sf_dir):
    return _bits(spark, sf_dir, True)


def user_json_datelist(c: _Ctx) -> DataFrame:
    lo, hi = event_days(c)
    return activity.json_datelist(c.events, "user_id", lo, hi)


def _json_out(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.select(key, iso(F.col("date")).alias("date"),
                     activity.datelist_json_text(df, "active_dates", name))


def q24_user_json_datelist(spark, sf_dir):
    return _json_out(user_json_datelist(Ctx(spark, sf_dir)), "user_id", "device_activity_datelist")


def q25_host_json_datelist(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    lo, hi = event_days(c)
    return _json_out(activity.json_datelist(c.events, "host", lo, hi), "host", "host_activity_datelist")


def q26_subkey_datelist(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    lo, hi = event_days(c)
    m = activity.subkey_datelist(c.events, "user_id", "browser_type", lo, hi)
    e = m.select("user_id", F.explode("device_activity_datelist").alias("browser_type", "dates"))
    return e.select("user_id", "browser_type", array_text("dates").alias("dates"))


def user_json_table(c: _Ctx) -> DataFrame:
    """The stored form of the user datelist table: the list as JSON text."""
    j = user_json_datelist(c)
    return j.select("user_id", "date", activity.datelist_json_text(j, "active_dates", "device_activity_datelist"))


def _report(spark, sf_dir, reference):
    c = Ctx(spark, sf_dir)
    lo, hi = event_days(c)
    t = user_json_table(c).withColumn("active_dates", activity.parse_datelist("device_activity_datelist"))
    r = activity.activity_report(t, lo, hi, reference=reference)
    return r.select("user_id", F.col("active_days").cast("int").alias("active_days"),
                    iso(F.col("first_seen")).alias("first_seen"), iso(F.col("last_seen")).alias("last_seen"))


def q27_activity_report(spark, sf_dir):
    return _report(spark, sf_dir, False)


def q27b_activity_report_ref(spark, sf_dir):
    return _report(spark, sf_dir, True)


def q28_datelist_int(spark, sf_dir):
    t = user_json_table(Ctx(spark, sf_dir)).withColumn(
        "active_dates", activity.parse_datelist("device_activity_datelist"))
    d = activity.datelist_int(t)
    return d.select("user_id", iso(F.col("date")).alias("date"), array_text("datelist_int").alias("integer_dates"))


# --- reduced facts -------------------------------------------------------------

def metric_arrays(c: _Ctx) -> DataFrame:
    """The daily job of the month's last loaded day over the rebuilt state of the day before."""
    lo, hi = event_days(c)
    prev = reduced.metric_array_rebuild(c.events, F.date_sub(hi, 1))
    return reduced.metric_array_step(prev, c.events, hi)


def q29_metric_array(spark, sf_dir):
    m = metric_arrays(Ctx(spark, sf_dir))
    return m.select("user_id", iso(F.col("month_start")).alias("month_start"), "metric_name",
                    array_text(F.transform("metric_array", lambda x: x.cast("int"))).alias("metric_array"))


def q30_array_length_histogram(spark, sf_dir):
    return reduced.array_length_histogram(metric_arrays(Ctx(spark, sf_dir)), "metric_array")


def q31_metric_daily_series(spark, sf_dir):
    s = reduced.explode_metric_array(metric_arrays(Ctx(spark, sf_dir)))
    return s.select("metric_name", iso(F.col("date")).alias("date"), F.col("value").cast("double").alias("value"))


def q31b_metric_daily_series_ref(spark, sf_dir):
    s = reduced.explode_metric_array(metric_arrays(Ctx(spark, sf_dir)), slots=4)
    return s.select("metric_name", iso(F.col("date")).alias("date"), F.col("value").cast("double").alias("value"))


def _monthly_out(df: DataFrame) -> DataFrame:
    return df.select(iso(F.col("month")).alias("month"), "host",
                     F.size("hit_array").alias("days_in_month"),
                     array_text("hit_array").alias("hit_array"),
                     array_text("unique_visitors_array").alias("unique_visitors_array"))


def q32_monthly_arrays(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    lo, hi = event_days(c)
    return _monthly_out(reduced.monthly_arrays(c.events, lo, hi))


def q33_monthly_arrays_step(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    lo, hi = event_days(c)
    state = reduced.monthly_arrays(c.events, lo, F.date_sub(hi, 1))
    return _monthly_out(reduced.monthly_arrays_step(state, c.events, hi))


def q34_contract_checks(spark, sf_dir):
    """The contract of the raw details, which they break: duplicate keys, missing comments, other positions."""
    return quality.check_contract(
        Ctx(spark, sf_dir).game_details, keys=DETAIL_KEYS, not_null=["comment", "player_name"],
        allowed={"start_position": ["O"], "team_abbreviation": ["A", "N"]})


def q34b_contract_checks_json(spark, sf_dir):
    """JSON contracts of the raw events: a valid object, a plain text, keys present and missing."""
    return quality.check_contract(
        Ctx(spark, sf_dir).t.events, keys=["user_id"], not_null=["user_id", "props"],
        json_objects=["props", "event_type"], json_required={"props": "k", "event_type": "k"})


def _reload(spark, sf_dir, distinct):
    """The JSON datelist table loaded, then the same load applied again (a rerun)."""
    t = user_json_datelist(Ctx(spark, sf_dir))
    again = state.merge_concat(t, t, ["user_id", "date"], "active_dates", distinct=distinct)
    return _json_out(again, "user_id", "device_activity_datelist")


def q24b_json_datelist_rerun_ref(spark, sf_dir):
    return _reload(spark, sf_dir, False)


def q24c_json_datelist_rerun(spark, sf_dir):
    return _reload(spark, sf_dir, True)


def q35_monthly_first_five(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    lo, hi = event_days(c)
    m = reduced.monthly_arrays(c.events, lo, hi)
    return m.select(iso(F.col("month")).alias("month"), "host",
                    F.size("hit_array").alias("days_in_month"),
                    array_text(F.slice("hit_array", 1, 5)).alias("first_5_days_hits"),
                    array_text(F.slice("unique_visitors_array", 1, 5)).alias("first_5_days_visitors"))


def q36_first_five_devices(spark, sf_dir):
    """Top-k report: the first five rows of the user datelist table by (date, user)."""
    t = user_json_table(Ctx(spark, sf_dir))
    top = reports.top_k(t, ["date", "user_id"], 5)
    return top.select("user_id", iso(F.col("date")).alias("date"), "device_activity_datelist")


def q37_first_five_monthly(spark, sf_dir):
    """Top-k report: the first five monthly rows by (month, host), with their first five slots."""
    c = Ctx(spark, sf_dir)
    lo, hi = event_days(c)
    m = reports.top_k(reduced.monthly_arrays(c.events, lo, hi), ["month", "host"], 5)
    return m.select(iso(F.col("month")).alias("month"), "host",
                    F.size("hit_array").alias("days_in_month"),
                    array_text(F.slice("hit_array", 1, 5)).alias("first_5_days_hits"),
                    array_text(F.slice("unique_visitors_array", 1, 5)).alias("first_5_days_visitors"))


# --- state operators, literal shapes and reports --------------------------------

def _two_seasons(c: _Ctx) -> tuple[DataFrame, DataFrame]:
    """Players of the season before the last (the stored table) and of the last (the load)."""
    end = last_season(c)
    one = lambda y: c.player_seasons.where(F.col("season") == y).select(
        "player_name", "season", F.col("pts").cast("double").alias("pts"))
    return one(end - 1), one(end)


def q38_upsert(spark, sf_dir):
    target, load = _two_seasons(Ctx(spark, sf_dir))
    return state.upsert(target, load, ["player_name"])


def q39_update_from(spark, sf_dir):
    target, load = _two_seasons(Ctx(spark, sf_dir))
    src = load.select("player_name", F.col("season").alias("new_season"), F.col("pts").alias("new_pts"))
    return state.update_from(target, src, ["player_name"], {"season": F.col("new_season"), "pts": F.col("pts") + F.col("new_pts")})


def q40_insert_if_absent(spark, sf_dir):
    target, load = _two_seasons(Ctx(spark, sf_dir))
    return state.insert_if_absent(target, load, ["player_name"])


def q41_period_table(spark, sf_dir):
    """A snapshot table written by season, its last season written again, and that season read back."""
    c = Ctx(spark, sf_dir)
    end = last_season(c)
    table = f"{ensure_checkpoint_dir(spark).rstrip('/')}/period-{uuid.uuid4().hex}"
    full = players_snapshot(c).select("player_name", "scoring_class", "is_active", "current_season")
    state.write_period(full, table, ["current_season"])
    state.write_period(full.where(F.col("current_season") == end).where("is_active"), table, ["current_season"])
    last = state.read_period(spark, table, F.col("current_season") >= end - 1)
    return last.select("player_name", "scoring_class", "is_active", F.col("current_season").cast("int").alias("current_season"))


def _films_text(films, fields) -> F.Column:
    return F.array_join(F.transform(films, lambda x: F.concat_ws(":", *[x[f].cast("string") for f in fields])), ",")


def q42_films_array(spark, sf_dir):
    """X-3 with its films array, as text; the change flag compares whole arrays."""
    a = actors_snapshot(Ctx(spark, sf_dir), with_items=True)
    before = F.lag("films").over(Window.partitionBy(*ACTOR_KEYS).orderBy("current_year"))
    return a.select("actor", "actorid", "current_year", _films_text(F.col("films"), ("year", "film", "votes")).alias("films"),
                    (~F.col("films").eqNullSafe(before)).alias("films_changed"))


def q43_actor_history_array(spark, sf_dir):
    """``verify_actor_history`` for every actor and year: one row with the year's films as an array."""
    c = Ctx(spark, sf_dir)
    h = snap.entity_history(c.actor_films, ACTOR_KEYS, "year", FILM_ITEM, actors_snapshot(c), as_list=True)
    return h.select("actor", "actorid", "current_year", F.col("n_films").cast("int").alias("num_films"), "is_active",
                    F.array_join("films_this_year", ",").alias("films_this_year"))


def q44_scd2_streaks_ref(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return scd.scd2_streaks(_player_state(c), "player_name", "current_season", PLAYER_TRACKED, last_season(c) - 1, reference=True)


def q45_metric_array_ref(spark, sf_dir):
    """The appending form of the daily job, run again for the last day: its count is there twice."""
    c = Ctx(spark, sf_dir)
    lo, hi = event_days(c)
    m = reduced.metric_array_step(reduced.metric_array_rebuild(c.events, hi), c.events, hi, reference=True)
    return m.select("user_id", iso(F.col("month_start")).alias("month_start"), "metric_name",
                    array_text(F.transform("metric_array", lambda x: x.cast("int"))).alias("metric_array"))


def q46_ranked_improvement(spark, sf_dir):
    """The improvement report in its order (descending, NULL first), every row with its place."""
    s = players_at_end(Ctx(spark, sf_dir))
    r = snap.improvement(s, ["player_name", "country"], "season_stats", "pts", guard="case")
    r = r.withColumn("improvement", F.when(F.col("improvement") > 1, F.round("improvement", 6)))
    return reports.ranked(r, ["improvement", "player_name"], [True, False])


def q47_lookup(spark, sf_dir):
    """Name lookup by LIKE within one season."""
    c = Ctx(spark, sf_dir)
    found = reports.lookup(c.player_seasons, "player_name", "%00%7", "season", last_season(c))
    return found.select("player_name", "season", "gp", F.col("pts").cast("double").alias("pts"))


# --- reports in their order ---------------------------------------------------------

def q48_rate_report_ranked(spark, sf_dir):
    return reports.ranked(q16_rate_report(spark, sf_dir), ["bailed_num"], [True])


def q49_points_per_game_ranked(spark, sf_dir):
    return reports.ranked(q21_points_per_game(spark, sf_dir), ["number_of_games"], [True])


def q50_activity_report_ranked(spark, sf_dir):
    return reports.ranked(q27_activity_report(spark, sf_dir), ["active_days"], [True])


# --- state that merges, acceptance, table functions ------------------------------------

def _shared(spark, kind: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def q51_merge_counts_observed(spark, sf_dir):
    """The merge of q09 written once by start year, the counts of q10 seen on the way, and the table read back."""
    c = Ctx(spark, sf_dir)
    lo, hi = film_years(c)
    states = classed_states(c, hi)
    before = _change_points(states.where(F.col("current_year") < hi), False, lo, hi - 1)
    history, seen = scd.scd2_merge_observed(before, states, ACTOR_KEYS, "current_year", ACTOR_TRACKED, last_processed=hi - 1, fill="quality_class")
    table = _shared(spark, "history")
    state.write_period(history, table, ["start_year"])
    counts = seen.get
    return state.read_period(spark, table).agg(F.count("*").alias("stored"), F.count_if("is_current").alias("stored_current")).select(
        *[F.lit(counts[k]).cast("long").alias(k) for k in ("records_updated", "records_inserted", "records")], "stored", "stored_current")


def stored_visitors(c: _Ctx) -> DataFrame:
    """Each day's visitor bitmaps as a table partitioned by day, written and read back."""
    lo, hi = event_days(c)
    table = _shared(c.spark, "visitors")
    state.write_period(reduced.visitor_bitmaps(c.events, lo, hi), table, ["day"])
    return state.read_period(c.spark, table).withColumn("day", F.col("day").cast("date"))


def q52_month_visitors(spark, sf_dir):
    """Distinct visitors of a month, from its days' stored bitmaps."""
    days = stored_visitors(Ctx(spark, sf_dir)).withColumn("month", F.trunc("day", "month"))
    return reduced.distinct_visitors(days, ["month", "host"]).withColumn("month", iso(F.col("month")))


def q53_rolling_visitors(spark, sf_dir):
    """Distinct visitors of the seven days up to each day."""
    return reduced.rolling_visitors(stored_visitors(Ctx(spark, sf_dir)), 7).withColumn("day", iso(F.col("day")))


def q54_rejected_details(spark, sf_dir):
    """The raw details that break the contract of q34, each with the rules that it breaks."""
    rules = quality.contract_rules(not_null=["comment", "player_name"], allowed={"start_position": ["O"], "team_abbreviation": ["A", "N"]})
    _, rejected = quality.split_rows(Ctx(spark, sf_dir).game_details, rules, DETAIL_KEYS)
    return rejected.withColumn("broken_rules", F.array_join("broken_rules", ","))


def spoiled_datelists(c: _Ctx) -> DataFrame:
    """The user datelist table with lists that the trigger refuses on some days: another key, an array, a JSON null, no JSON."""
    list_, turn = F.col("device_activity_datelist"), F.dayofmonth("date") % 5
    return user_json_table(c).withColumn("device_activity_datelist", F.when(turn == 1, F.replace(list_, F.lit("active_dates"), F.lit("dates")))
        .when(turn == 2, F.concat(F.lit("["), list_, F.lit("]"))).when(turn == 3, F.lit('{"active_dates":null}'))
        .when(turn == 4, F.lit("active_dates")).otherwise(list_))


def q55_rejected_datelists(spark, sf_dir):
    """Rows that the JSON checks of the datelist table refuse, by one parse, with reasons."""
    col = "device_activity_datelist"
    rules = quality.contract_rules(json_objects=[col], json_required={col: "active_dates"})
    _, rejected = quality.split_rows(quality.with_json(spoiled_datelists(Ctx(spark, sf_dir)), [col]), rules)
    return rejected.select("user_id", iso(F.col("date")).alias("date"), col, F.array_join("broken_rules", ",").alias("broken_rules"))


def q56_activity_function(spark, sf_dir):
    """``get_user_activity`` called from SQL over the whole period."""
    c = Ctx(spark, sf_dir)
    user_json_table(c).createOrReplaceTempView("user_devices_cumulated")
    sql_functions.create_activity_function(spark, "user_devices_cumulated")
    return spark.sql("""
        SELECT user_id, active_days, date_format(first_seen, 'yyyy-MM-dd') AS first_seen, date_format(last_seen, 'yyyy-MM-dd') AS last_seen
        FROM get_user_activity((SELECT min(date) FROM user_devices_cumulated), (SELECT max(date) FROM user_devices_cumulated))""")


def q57_actor_function(spark, sf_dir):
    """``verify_actor_history`` called from SQL for every actor and year."""
    c = Ctx(spark, sf_dir)
    snap.entity_history(c.actor_films, ACTOR_KEYS, "year", FILM_ITEM, actors_snapshot(c), as_list=True).createOrReplaceTempView("actor_history")
    c.actor_films.select("actor", "year").distinct().createOrReplaceTempView("actor_years")
    sql_functions.create_actor_function(spark, "actor_history")
    return spark.sql("""
        SELECT h.actor_name AS actor, h.actor_id AS actorid, h.current_year, h.num_films, h.is_active, array_join(h.films_this_year, ',') AS films_this_year
        FROM actor_years a, LATERAL verify_actor_history(a.actor, a.year) h""")


def q58_subkey_datelist_step(spark, sf_dir):
    """The maps of q26 up to the day before the last, and the last day merged into them."""
    c = Ctx(spark, sf_dir)
    lo, hi = event_days(c)
    prev = activity.subkey_datelist(c.events, "user_id", "browser_type", lo, F.date_sub(hi, 1))
    m = activity.subkey_datelist_step(prev, c.events, hi, "user_id", "browser_type")
    e = m.select("user_id", F.explode("device_activity_datelist").alias("browser_type", "dates"))
    return e.select("user_id", "browser_type", array_text("dates").alias("dates"))


def q59_datelist_bits_step(spark, sf_dir):
    """The bitmaps of q23 at the day before the last, rolled forward by the last day."""
    c = Ctx(spark, sf_dir)
    lo, hi = event_days(c)
    before = F.date_sub(hi, 1)
    prev = activity.datelist_bits(activity.datelist_rebuild(c.events, lo, before), before, F.trunc(before, "month"))
    rolled = activity.datelist_bits_step(prev.withColumn("date", before), c.events, hi)
    return activity.bits_activity(rolled)
