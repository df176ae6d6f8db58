"""Table functions for SQL callers (K-1, K-2).

``CREATE TEMPORARY FUNCTION .. RETURNS TABLE`` over a view that the caller
names. Spark inlines a SQL function into the calling query, so its arguments
become filters of the view (constants reach the scan), and a call for many
rows (``LATERAL f(..)``) becomes a join. The functions live as long as the
session.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def create_activity_function(spark: SparkSession, table: str, name: str = "get_user_activity",
                             key_type: str = "BIGINT", reference: bool = False) -> None:
    """K-2: ``name(start_date, end_date)`` returns (user_id, active_days, first_seen, last_seen).

    ``table`` has user_id, date and device_activity_datelist (JSON text with
    ``active_dates``). One row per user with a load day in the range, counting
    its distinct active days; an empty, missing or invalid list counts none. The reference
    form has a row per user and list, its length, as the source's GROUP BY does.
    """
    days = "from_json(device_activity_datelist, 'active_dates ARRAY<DATE>').active_dates"
    if reference:
        body = f"""
        SELECT user_id, CAST(size(days) AS INT), min(date), max(date)
        FROM (SELECT user_id, date, {days} AS days FROM {table} WHERE date BETWEEN start_date AND end_date)
        GROUP BY user_id, days"""
    else:
        body = f"""
        SELECT user_id, CAST(count(DISTINCT day) AS INT), min(date), max(date)
        FROM (SELECT user_id, date, explode_outer({days}) AS day FROM {table} WHERE date BETWEEN start_date AND end_date)
        GROUP BY user_id"""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(start_date DATE, end_date DATE)
        RETURNS TABLE (user_id {key_type}, active_days INT, first_seen DATE, last_seen DATE)
        RETURN {body}""")


def create_actor_function(spark: SparkSession, table: str, name: str = "verify_actor_history") -> None:
    """K-1: ``name(p_actor_name, p_year)`` returns (actor_name, actor_id, current_year, num_films, is_active, films_this_year).

    ``table`` is an entity history with a row per actor and active year
    (``snapshot.entity_history(as_list=True)``). Two actors of one name are two
    rows, told apart by their id, which the source's function leaves out.
    """
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(p_actor_name STRING, p_year INT)
        RETURNS TABLE (actor_name STRING, actor_id STRING, current_year INT, num_films INT, is_active BOOLEAN, films_this_year ARRAY<STRING>)
        RETURN SELECT actor, actorid, current_year, CAST(n_films AS INT), is_active, films_this_year
               FROM {table} WHERE actor = p_actor_name AND current_year = p_year""")
