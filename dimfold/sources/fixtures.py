"""Stand-in input views of the modelling jobs, derived from the base tables.

The modelling jobs expect player seasons, actor films, games, game details,
teams and web events. The test data is a TPC-H-like star schema plus an event
stream, so each view below is a fixed mapping of those tables (see
``FIXTURES.md`` section 3). Every view is a lazy DataFrame whose size grows
with the base tables. The same mappings are written in SQL in
``dimfold.plans.oracle`` for the DuckDB cross-check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimfold.sources.tables import Tables

# Fixed values of the stand-in mapping (shared with the SQL oracle).
# Points are floor(max order price / 10000); classes cut at 40 / 30 / 20.
PLAYER_POINT_CUTS = (40, 30, 20)
# Ratings are floor(order price / 500) / 100 (0.02 .. 10.00); classes cut at 8 / 7 / 6.
ACTOR_RATING_CUTS = (8, 7, 6)
CLASS_LABELS = ("star", "good", "average", "bad")
# Team ids of a game: customer key modulo 25, and (customer key + 7) modulo 25.
TEAM_COUNT = 25
VISITOR_SHIFT = 7
# Comment codes by line number: 5 -> did not play, 6 -> did not dress, 7 -> not with team.
COMMENT_BY_LINE = {5: "DNP - coach decision", 6: "Coach: DND injury", 7: "NWT (rest)"}


def player_seasons(t: Tables) -> DataFrame:
    """player x season: one row per customer and order year (unique grain)."""
    o = t.orders.select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    per_year = o.groupBy("o_custkey", F.year("o_orderdate").alias("season")).agg(
        F.count(F.lit(1)).cast("int").alias("gp"),
        F.max("o_totalprice").alias("_max_price"),
        F.count_if(F.col("o_orderstatus") == "F").cast("float").alias("reb"),
        F.count_if(F.col("o_orderstatus") == "O").cast("float").alias("ast"),
    )
    c = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = t.nation.select("n_nationkey", "n_name")
    return (
        per_year.join(c, per_year.o_custkey == c.c_custkey)
        .join(n, c.c_nationkey == n.n_nationkey, "left")
        .select(
            F.col("c_name").alias("player_name"),
            F.col("season"),
            F.col("gp"),
            F.floor(F.col("_max_price") / 10000).cast("float").alias("pts"),
            F.col("reb"),
            F.col("ast"),
            F.col("c_mktsegment").alias("height"),
            F.lit("none").alias("college"),
            F.col("n_name").alias("country"),
            F.col("season").cast("string").alias("draft_year"),
            F.lit("1").alias("draft_round"),
            F.col("c_nationkey").cast("string").alias("draft_number"),
        )
    )


def actor_films(t: Tables) -> DataFrame:
    """actor x film: one row per order; the film is the order."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = t.customer.select("c_custkey", "c_name")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_name").alias("actor"),
        F.col("o_custkey").cast("string").alias("actorid"),
        F.col("o_orderkey").cast("string").alias("film"),
        F.year("o_orderdate").alias("year"),
        F.floor("o_totalprice").cast("int").alias("votes"),
        (F.floor(F.col("o_totalprice") / 500).cast("decimal(12,0)") / 100).cast("decimal(10,2)").alias("rating"),
        F.col("o_orderkey").cast("string").alias("filmid"),
    )


def games(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    price = F.floor("o_totalprice")
    return o.select(
        F.col("o_orderkey").alias("game_id"),
        F.to_date("o_orderdate").alias("game_date_est"),
        F.year("o_orderdate").alias("season"),
        (F.col("o_custkey") % TEAM_COUNT).cast("int").alias("home_team_id"),
        ((F.col("o_custkey") + VISITOR_SHIFT) % TEAM_COUNT).cast("int").alias("visitor_team_id"),
        (price % 100).cast("int").alias("pts_home"),
        (price % 97).cast("int").alias("pts_away"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("home_team_wins"),
    )


def _comment(line: Column) -> Column:
    out = None
    for k, v in COMMENT_BY_LINE.items():
        out = F.when(line == k, F.lit(v)) if out is None else out.when(line == k, F.lit(v))
    return out


def game_details(t: Tables) -> DataFrame:
    """game x team x player, with duplicates (a supplier on several lines of one order)."""
    li = t.lineitem.select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity",
                           "l_returnflag", "l_linestatus")
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    ln = F.col("l_linenumber")
    qty = F.col("l_quantity").cast("int")
    return li.join(s, li.l_suppkey == s.s_suppkey).select(
        F.col("l_orderkey").alias("game_id"),
        F.col("s_nationkey").alias("team_id"),
        F.col("l_returnflag").alias("team_abbreviation"),
        F.col("l_suppkey").alias("player_id"),
        F.col("s_name").alias("player_name"),
        F.col("l_linestatus").alias("start_position"),
        _comment(ln).alias("comment"),
        F.concat(ln.cast("string"), F.lit(":"), F.lpad(qty.cast("string"), 2, "0")).alias("min"),
        ln.alias("fgm"),
        (ln + 2).alias("fga"),
        (ln % 3).alias("fg3m"),
        (ln % 3 + 1).alias("fg3a"),
        (ln % 2).alias("ftm"),
        (ln % 2 + 1).alias("fta"),
        (ln % 4).alias("oreb"),
        (ln % 5).alias("dreb"),
        (ln % 4 + ln % 5).alias("reb"),
        (ln % 6).alias("ast"),
        (ln % 2).alias("stl"),
        (ln % 3).alias("blk"),
        (ln % 4).alias("TO"),
        (ln % 5).alias("pf"),
        qty.alias("pts"),
        (qty - 25).alias("plus_minus"),
    )


def teams(t: Tables) -> DataFrame:
    """team rows with duplicates: one row per team and supplier of that nation."""
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    s = t.supplier.select("s_nationkey", "s_name")
    return n.join(s, n.n_nationkey == s.s_nationkey).select(
        F.col("n_nationkey").alias("team_id"),
        F.col("n_name").alias("abbreviation"),
        F.lower("n_name").alias("nickname"),
        F.col("n_regionkey").cast("string").alias("city"),
        F.col("s_name").alias("arena"),
        (F.col("n_nationkey") + 1900).alias("yearfounded"),
    )


def events(t: Tables) -> DataFrame:
    """web hits: user, time, host (the event type) and a browser sub-key."""
    e = t.events.select("user_id", "ts", "event_type", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.col("user_id"),
        F.col("ts").alias("event_time"),
        F.col("event_type").alias("host"),
        F.concat(F.lit("b"), (k % 3).cast("string")).alias("browser_type"),
    )
