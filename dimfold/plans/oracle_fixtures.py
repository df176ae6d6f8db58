"""The stand-in views of ``dimfold.sources.fixtures`` written as DuckDB CTEs.

Only the base tables are registered in the oracle; every oracle query starts
with the CTEs it needs from here.
"""

from __future__ import annotations

FIXTURE_SQL = {
    "player_seasons": """
player_seasons AS (
  SELECT c.c_name AS player_name,
         py.season::INTEGER AS season,
         py.gp::INTEGER AS gp,
         floor(py.max_price / 10000)::FLOAT AS pts,
         py.reb::FLOAT AS reb,
         py.ast::FLOAT AS ast,
         c.c_mktsegment AS height,
         'none' AS college,
         n.n_name AS country,
         py.season::VARCHAR AS draft_year,
         '1' AS draft_round,
         c.c_nationkey::VARCHAR AS draft_number
  FROM (SELECT o_custkey, year(o_orderdate) AS season, count(*) AS gp,
               max(o_totalprice) AS max_price,
               count(*) FILTER (WHERE o_orderstatus = 'F') AS reb,
               count(*) FILTER (WHERE o_orderstatus = 'O') AS ast
        FROM orders GROUP BY 1, 2) py
  JOIN customer c ON py.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)""",
    "actor_films": """
actor_films AS (
  SELECT c.c_name AS actor,
         o.o_custkey::VARCHAR AS actorid,
         o.o_orderkey::VARCHAR AS film,
         year(o.o_orderdate)::INTEGER AS year,
         floor(o.o_totalprice)::INTEGER AS votes,
         (floor(o.o_totalprice / 500) / 100)::DECIMAL(10,2) AS rating,
         o.o_orderkey::VARCHAR AS filmid
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)""",
    "games": """
games AS (
  SELECT o_orderkey AS game_id,
         o_orderdate::DATE AS game_date_est,
         year(o_orderdate)::INTEGER AS season,
         (o_custkey % 25)::INTEGER AS home_team_id,
         ((o_custkey + 7) % 25)::INTEGER AS visitor_team_id,
         (floor(o_totalprice)::BIGINT % 100)::INTEGER AS pts_home,
         (floor(o_totalprice)::BIGINT % 97)::INTEGER AS pts_away,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END::INTEGER AS home_team_wins
  FROM orders
)""",
    "game_details": """
game_details AS (
  SELECT l.l_orderkey AS game_id,
         s.s_nationkey AS team_id,
         l.l_returnflag AS team_abbreviation,
         l.l_suppkey AS player_id,
         s.s_name AS player_name,
         l.l_linestatus AS start_position,
         CASE l.l_linenumber WHEN 5 THEN 'DNP - coach decision' WHEN 6 THEN 'Coach: DND injury'
              WHEN 7 THEN 'NWT (rest)' END AS comment,
         l.l_linenumber::VARCHAR || ':' || lpad(l.l_quantity::INTEGER::VARCHAR, 2, '0') AS "min",
         l.l_linenumber AS fgm,
         l.l_linenumber + 2 AS fga,
         l.l_linenumber % 3 AS fg3m,
         l.l_linenumber % 3 + 1 AS fg3a,
         l.l_linenumber % 2 AS ftm,
         l.l_linenumber % 2 + 1 AS fta,
         l.l_linenumber % 4 AS oreb,
         l.l_linenumber % 5 AS dreb,
         l.l_linenumber % 4 + l.l_linenumber % 5 AS reb,
         l.l_linenumber % 6 AS ast,
         l.l_linenumber % 2 AS stl,
         l.l_linenumber % 3 AS blk,
         l.l_linenumber % 4 AS "TO",
         l.l_linenumber % 5 AS pf,
         l.l_quantity::INTEGER AS pts,
         l.l_quantity::INTEGER - 25 AS plus_minus
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
)""",
    "teams": """
teams AS (
  SELECT n.n_nationkey AS team_id,
         n.n_name AS abbreviation,
         lower(n.n_name) AS nickname,
         n.n_regionkey::VARCHAR AS city,
         s.s_name AS arena,
         n.n_nationkey + 1900 AS yearfounded
  FROM nation n JOIN supplier s ON n.n_nationkey = s.s_nationkey
)""",
    "ev": """
ev AS (
  SELECT user_id, ts AS event_time, event_type AS host,
         'b' || (json_extract_string(props, '$.k')::INTEGER % 3)::VARCHAR AS browser_type
  FROM events
)""",
}


def with_fixtures(names: list[str], body: str, extra_ctes: str = "") -> str:
    """``WITH <fixtures>, <extra> <body>``."""
    parts = [FIXTURE_SQL[n].strip() for n in names]
    if extra_ctes.strip():
        parts.append(extra_ctes.strip().rstrip(","))
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
