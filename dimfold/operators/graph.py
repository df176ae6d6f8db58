"""Property graph from relational facts (X-23a .. X-23d).

Vertices and edges are two DataFrames with typed ends and JSON properties:
``vertices(identifier, type, properties)`` and ``edges(subject_identifier,
subject_type, object_identifier, object_type, edge_type, properties)``.
There is no traversal, so no graph library is needed.

Co-occurrence edges are pairs of members of one group (players of one game).
The pairs are the output itself, so they are produced by an equi self-join on
the group key, one direction only (``a > b``); the pair aggregate then has a
map-side partial combine. A group with very many members is a skewed join
partition: AQE's skew-join handling splits it across tasks, and the
pre-deduplication (one row per member and group) keeps each side minimal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimfold.functions.columns import json_object
from dimfold.operators.quality import dedupe_first

# Vertex and edge types.
VERTEX_TYPES = ("player", "team", "game")
EDGE_TYPES = ("plays_against", "shares_team", "plays_in", "plays_on")


def vertices(df: DataFrame, identifier: str | Column, vtype: str, props: Sequence[tuple[str, str | Column]]) -> DataFrame:
    """Typed vertices: identifier as text, a literal type, properties as JSON."""
    ident = F.col(identifier) if isinstance(identifier, str) else identifier
    return df.select(ident.cast("string").alias("identifier"), F.lit(vtype).alias("type"),
                     json_object(*props).alias("properties"))


def game_vertices(games: DataFrame) -> DataFrame:
    winner = F.when(F.col("home_team_wins") == 1, F.col("home_team_id")).otherwise(F.col("visitor_team_id"))
    return vertices(games, "game_id", "game",
                    [("pts_home", "pts_home"), ("pts_away", "pts_away"), ("winning_team", winner)])


def player_vertices(details: DataFrame) -> DataFrame:
    """One vertex per player over all detail rows (duplicates included, as the scripts count them)."""
    agg = details.groupBy("player_id").agg(
        F.max("player_name").alias("player_name"),
        F.count(F.lit(1)).alias("number_of_games"),
        F.sum("pts").alias("total_points"),
        F.sort_array(F.collect_set("team_id")).alias("_teams"),
        F.max(F.col("team_id").isNull()).alias("_null_team"),
    )
    # array_agg(DISTINCT x) keeps one NULL (sorted last); collect_set drops it.
    agg = agg.withColumn("teams", F.when(F.col("_null_team"), F.concat(
        "_teams", F.array(F.lit(None).cast(details.schema["team_id"].dataType)))).otherwise(F.col("_teams")))
    return vertices(agg, "player_id", "player",
                    [("player_name", "player_name"), ("number_of_games", "number_of_games"),
                     ("total_points", "total_points"), ("teams", "teams")])


def team_vertices(teams: DataFrame) -> DataFrame:
    first = dedupe_first(teams, ["team_id"])
    return vertices(first, "team_id", "team",
                    [("abbreviation", "abbreviation"), ("nickname", "nickname"), ("city", "city"),
                     ("arena", "arena"), ("year_founded", "yearfounded")])


def all_vertices(games: DataFrame, details: DataFrame, teams: DataFrame) -> DataFrame:
    return game_vertices(games).unionByName(player_vertices(details)).unionByName(team_vertices(teams))


def vertex_counts(v: DataFrame) -> DataFrame:
    return v.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def co_occurrence_edges(details: DataFrame, group: str = "game_id", node: str = "player_id",
                        name: str = "player_name", side: str = "team_abbreviation",
                        measure: str = "pts") -> DataFrame:
    """X-23b: player-player edges per game pair, one direction.

    Members are de-duplicated per (node, group); pairs need different names
    and ``a.node > b.node``; the edge type is ``shares_team`` when both sides
    are equal, else ``plays_against``. Per (a, b, type): max names, number of
    shared groups and both measure sums.

    The pairs are the result itself: their number is quadratic in the members
    of a game, which a game's rules bound; there is no cap.
    """
    # Only five columns are needed: narrow the rows before the de-duplication
    # shuffle; the survivor is the first by (name, side, measure).
    members = dedupe_first(details.select(group, node, name, side, measure), [node, group])
    a = members.alias("a")
    b = members.alias("b")
    pairs = a.join(b, (F.col(f"a.{group}") == F.col(f"b.{group}"))
                   & (F.col(f"a.{name}") != F.col(f"b.{name}"))
                   & (F.col(f"a.{node}") > F.col(f"b.{node}")))
    etype = F.when(F.col(f"a.{side}") == F.col(f"b.{side}"), F.lit("shares_team")).otherwise(F.lit("plays_against"))
    agg = pairs.groupBy(F.col(f"a.{node}").alias("subject_player_id"), F.col(f"b.{node}").alias("object_player_id"),
                        etype.alias("edge_type")).agg(
        F.max(f"a.{name}").alias("subject_player_name"),
        F.max(f"b.{name}").alias("object_player_name"),
        F.count(F.lit(1)).alias("num_games"),
        F.sum(f"a.{measure}").alias("subject_points"),
        F.sum(f"b.{measure}").alias("object_points"),
    )
    return agg.select(
        F.col("subject_player_id").cast("string").alias("subject_identifier"),
        F.lit("player").alias("subject_type"),
        F.col("object_player_id").cast("string").alias("object_identifier"),
        F.lit("player").alias("object_type"),
        "edge_type",
        "subject_player_name", "object_player_name", "num_games", "subject_points", "object_points",
        json_object(("num_games", "num_games"), ("subject_points", "subject_points"),
                    ("object_points", "object_points")).alias("properties"),
    )


def edge_starts(details: DataFrame, group: str = "game_id", node: str = "player_id",
                name: str = "player_name", side: str = "team_abbreviation", measure: str = "pts") -> DataFrame:
    """The vertices that start an edge of ``co_occurrence_edges``, without building any pair.

    A member starts an edge if a member of the same group with a smaller node
    has another name. So two values a group tell it: the smallest node with
    its name, and the smallest node of any other name. A member of another name than
    the first starts an edge; one of the same name does if it comes after
    the second value. Both are grouped minima, combined in the map tasks, and joined
    back to the members, so a hot group is never in one task. Columns as
    ``points_per_game`` reads them.
    """
    members = dedupe_first(details.select(group, node, name, side, measure), [node, group])
    members = members.where(F.col(group).isNotNull() & F.col(node).isNotNull() & F.col(name).isNotNull()).select(group, node, name)
    named = members.groupBy(group, name).agg(F.min(node).alias("_least"))

    def own_exchange(grouped: DataFrame, count: str) -> DataFrame:
        # as a computed column the key is dealt anew, and AQE can split the hot side of the join
        return grouped.withColumn(group, F.when(F.col(count) > 0, F.col(group))).drop(count)

    first = own_exchange(named.groupBy(group).agg(F.min(F.struct("_least", name)).alias("_first"), F.count("*").alias("_n")), "_n")
    other = named.join(first, group).where(F.col(name) != F.col(f"_first.{name}"))
    other = own_exchange(other.groupBy(group).agg(F.min("_least").alias("_other"), F.count("*").alias("_n")), "_n")
    known = members.join(first, group).join(other, group)  # a group of one name starts no edge
    starts = known.where((F.col(name) != F.col(f"_first.{name}")) | (F.col(node) > F.col("_other"))).select(node).distinct()
    return starts.select(F.col(node).cast("string").alias("subject_identifier"),
                         F.lit("player").alias("subject_type"), F.lit("player").alias("object_type"))


def membership_edges(details: DataFrame) -> DataFrame:
    """X-23c: ``plays_in`` edges, one per (player, game) after de-duplication.

    The survivor of a (player, game) is the first by its property values.
    """
    cols = ["player_id", "game_id", "start_position", "pts", "team_id", "team_abbreviation"]
    first = dedupe_first(details.select(*cols), ["player_id", "game_id"])
    return first.select(
        F.col("player_id").cast("string").alias("subject_identifier"),
        F.lit("player").alias("subject_type"),
        F.col("game_id").cast("string").alias("object_identifier"),
        F.lit("game").alias("object_type"),
        F.lit("plays_in").alias("edge_type"),
        json_object(("start_position", "start_position"), ("pts", "pts"), ("team_id", "team_id"),
                    ("team_abbreviation", "team_abbreviation")).alias("properties"),
    )


PLAYER_PROPS = "player_name string, number_of_games string, total_points string"


def points_per_game(v: DataFrame, e: DataFrame) -> DataFrame:
    """X-23d: players' points per game over vertices that start a player-player edge.

    The scripts join vertices to edges and GROUP BY the three output columns;
    the same result is a semi join (vertex has such an edge) plus DISTINCT,
    which never multiplies a vertex by its edge count.
    """
    starts = e.where(F.col("object_type") == "player").select(
        F.col("subject_identifier").alias("identifier"), F.col("subject_type").alias("type"))
    hit = v.join(starts, ["identifier", "type"], "left_semi")
    p = F.from_json("properties", PLAYER_PROPS)
    games = p["number_of_games"].cast("float")
    points = p["total_points"].cast("float")
    ppg = points.cast("double") / F.when(games == 0, F.lit(1.0)).otherwise(games.cast("double"))
    return hit.select(p["player_name"].alias("player_name"), games.cast("double").alias("number_of_games"),
                      points.cast("double").alias("total_points"), ppg.alias("ppg")).distinct()
