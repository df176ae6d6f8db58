from pyspark.sql import functions as F

from conftest import rows
from dimfold.operators import facts, graph, quality

D = "game_id long, team_id int, player_id long, player_name string, pts int"


def test_duplicate_keys_rows_and_null_keys(spark):
    df = spark.createDataFrame([
        (1, 1, 10, "x", 5), (1, 1, 10, "x", 5), (1, 1, 10, "y", 7),   # a key three times
        (2, 1, 10, "x", 1),
        (None, 1, 11, "z", 1), (None, 1, 11, "z", 1),                 # NULL key part
    ], D)
    keys = ["game_id", "team_id", "player_id"]
    assert rows(quality.duplicate_keys(df, keys)) == sorted([(1, 1, 10, 3), (None, 1, 11, 2)], key=repr)
    dup = quality.duplicate_rows(df, keys)
    assert dup.count() == 3 and dup.where(F.col("game_id").isNull()).count() == 0


def test_dedupe_first_is_deterministic(spark):
    df = spark.createDataFrame([(1, 1, 10, "y", 7), (1, 1, 10, "x", 9), (1, 1, 10, "x", 5)], D)
    keys = ["game_id", "team_id", "player_id"]
    assert rows(quality.dedupe_first(df, keys)) == [(1, 1, 10, "x", 5)]
    assert rows(quality.dedupe_first(df, keys, order=[F.col("pts").desc()])) == [(1, 1, 10, "x", 9)]
    # Same input in another order, another partitioning: same survivor.
    again = df.orderBy(F.rand(7)).repartition(3)
    assert rows(quality.dedupe_first(again, keys)) == [(1, 1, 10, "x", 5)]


def test_contract_counts_violations(spark):
    df = spark.createDataFrame([
        (1, "2024-01-01", '{"active_dates":["2024-01-01"]}', "a"),
        (1, "2024-01-01", '{"other":1}', "b"),          # duplicate key, missing required JSON key
        (2, None, '["2024-01-01"]', "zz"),              # NULL date, not an object, not an allowed value
    ], "user_id long, date string, j string, kind string")
    c = quality.check_contract(df, keys=["user_id", "date"], not_null=["date"], allowed={"kind": ["a", "b"]},
                               json_objects=["j"], json_required={"j": "active_dates"}).first().asDict()
    assert c == {"rows": 3, "null_date": 1, "not_allowed_kind": 1, "not_object_j": 1,
                 "missing_active_dates_j": 2, "duplicate_keys": 1}


def test_clock_minutes_and_codes(spark):
    df = spark.createDataFrame([(None, None), ("", "DNP"), ("12", "coach: DND"), ("12:30", "x NWT y"),
                                ("ab:cd", "dnp")], "m string, c string")
    out = df.select(facts.clock_minutes(F.col("m")).alias("mins"),
                    facts.has_code(F.col("c"), "DNP").alias("dnp"),
                    facts.has_code(F.col("c"), "DND").alias("dnd"),
                    facts.has_code(F.col("c"), "NWT").alias("nwt")).collect()
    assert [r.mins for r in out] == [None, None, None, 12.5, None]
    assert [(r.dnp, r.dnd, r.nwt) for r in out] == [
        (False, False, False), (True, False, False), (False, True, False), (False, False, True),
        (False, False, False)]


def test_rate_report(spark):
    f = spark.createDataFrame([("a", True, True), ("a", True, False), ("a", False, True), ("b", True, False)],
                              "dim_player_name string, home boolean, nwt boolean")
    r = rows(facts.rate_report(f, ["dim_player_name"], "nwt", where=F.col("home")))
    assert r == [("a", 2, 1, 50.0), ("b", 1, 0, 0.0)]


G = "game_id long, player_id long, player_name string, team_abbreviation string, pts int"


def test_co_occurrence_edges(spark):
    det = spark.createDataFrame([
        (1, 10, "p", "A", 5), (1, 11, "q", "A", 7), (1, 12, "r", "B", 1),
        (1, 13, "p", "B", 2),                    # namesake of 10: never paired with it
        (2, 10, "p", "A", 3), (2, 11, "q", "A", 4), (2, 11, "q", "A", 4),  # duplicate member row
    ], G)
    e = graph.co_occurrence_edges(det)
    got = {(r.subject_identifier, r.object_identifier, r.edge_type): (r.num_games, r.subject_points, r.object_points)
           for r in e.collect()}
    assert got[("11", "10", "shares_team")] == (2, 11, 8)
    assert got[("12", "10", "plays_against")] == (1, 1, 5)
    assert ("13", "10", "plays_against") not in got and ("13", "10", "shares_team") not in got
    assert all(int(s) > int(o) for s, o, _ in got)
    import json
    props = json.loads(e.where("subject_identifier = '11'").first().properties)
    assert props == {"num_games": 2, "subject_points": 11, "object_points": 8}


def test_vertices_and_points_per_game(spark):
    games = spark.createDataFrame([(1, 3, 4, 1, 0, 9)], "game_id long, pts_home int, pts_away int, home_team_id int,"
                                                        " home_team_wins int, visitor_team_id int")
    det = spark.createDataFrame([(1, 10, "p", "A", 5, 3), (1, 11, "q", "B", 7, 4), (2, 10, "p", "A", 1, 3)],
                                G + ", team_id int")
    teams = spark.createDataFrame([(3, "X", "x", "1", "ar2", 1903), (3, "X", "x", "1", "ar1", 1903)],
                                  "team_id int, abbreviation string, nickname string, city string, arena string,"
                                  " yearfounded int")
    v = graph.all_vertices(games, det, teams)
    assert rows(graph.vertex_counts(v)) == [("game", 1), ("player", 2), ("team", 1)]
    assert v.where("type = 'team'").first().properties.find('"arena":"ar1"') > 0
    assert v.where("type = 'game'").first().properties == '{"pts_home":3,"pts_away":4,"winning_team":9}'
    e = graph.co_occurrence_edges(det)
    ppg = rows(graph.points_per_game(v, e))
    assert ppg == [("q", 1.0, 7.0, 7.0)]


def test_reports_order_nulls_like_postgres_and_lookup(spark):
    from dimfold.operators import reports

    df = spark.createDataFrame([("Ann Jordan", 2001, 3.0), ("Bo Jordan", 2001, None), ("Cy", 2001, 9.0),
                                ("Dee Jordan", 2000, 1.0)], "name string, season int, ratio double")
    desc = [r.name for r in reports.ordered(df, ["ratio"], [True]).collect()]
    assert desc[0] == "Bo Jordan" and desc[1] == "Cy"           # NULL first when descending
    asc = [r.name for r in reports.ordered(df, ["ratio"]).collect()]
    assert asc[-1] == "Bo Jordan"                                # NULL last when ascending
    assert [r.name for r in reports.top_k(df, ["ratio"], 2, [True]).collect()] == ["Bo Jordan", "Cy"]
    found = reports.lookup(df, "name", "%Jordan", "season", 2001)
    assert sorted(r.name for r in found.collect()) == ["Ann Jordan", "Bo Jordan"]


def test_player_vertex_keeps_one_null_team_last(spark):
    det = spark.createDataFrame([(1, 10, "p", "A", 5, 3), (2, 10, "p", "A", 1, None), (3, 10, "p", "A", 1, 1),
                                 (4, 10, "p", "A", 1, None)], G + ", team_id int")
    props = graph.player_vertices(det).first().properties
    assert '"teams":[1,3,null]' in props


def test_hot_game_is_split_by_aqe_skew_join(spark):
    """One game holding most member rows: its pairs are spread over several tasks, results exact."""
    hot = [(0, p, f"n{p}", "A" if p % 2 else "B", 1) for p in range(300)]
    cold = [(g, p, f"n{p}", "A", 1) for g in range(1, 200) for p in (g, g + 1000)]
    det = spark.createDataFrame(hot + cold, G)
    keys = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        e = graph.co_occurrence_edges(det)
        n = len(e.collect())
        plan = e._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert n == 300 * 299 // 2 + 199
    assert "skew" in plan.lower()


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return fn()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


SKEW = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16"}


def test_hot_duplicate_key_semi_join_is_split(spark):
    hot = [(1, 1, 10, f"x{i}", i) for i in range(3000)]
    cold = [(g, 1, 10, "y", 1) for g in range(2, 400)] + [(2, 1, 10, "z", 2)]
    df = spark.createDataFrame(hot + cold, D)

    def run():
        d = quality.duplicate_rows(df, ["game_id", "team_id", "player_id"])
        n = len(d.collect())
        return n, d._jdf.queryExecution().executedPlan().toString()

    # Above the broadcast threshold the semi join is sort-merge, and AQE splits the hot key.
    n, plan = _with_conf(spark, SKEW, run)
    assert n == 3002 and "SortMergeJoin(skew=true)" in plan
    # By default AQE broadcasts the measured key set; same rows.
    n, plan = run()
    assert n == 3002 and "BroadcastHashJoin" in plan


def test_dedupe_limits_rows_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, 10, "x", i) for i in range(100)], D)
    plan = quality.dedupe_first(df, ["game_id", "team_id", "player_id"])._jdf.queryExecution().executedPlan().toString()
    # WindowGroupLimit runs once before the exchange (partial) and once after (final).
    before, _, after = plan.partition("Exchange")
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


def test_duplicate_rows_split_a_hot_key_of_exact_copies(spark):
    """2,000 exact copies of one key come out of several tasks, and nothing runs while the plan is built."""
    from pyspark.sql import functions as F

    from dimfold.operators import quality

    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        hot = spark.range(2000, numPartitions=8).select(F.lit(1).alias("k"), F.lit("x" * 40).alias("v"))
        df = hot.unionByName(spark.range(100, 400, numPartitions=8).select(F.col("id").cast("int").alias("k"), F.lit("y").alias("v")))
        tracker = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup("dup", "dup")
        out = quality.duplicate_rows(df, ["k"])
        assert not tracker.getJobIdsForGroup("dup")
        spread = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in spread) == 2000 and len(spread) > 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_new_files_are_seen_by_the_next_query(spark, tmp_path):
    """The load period is read by each query, so a folder that grew answers for its new last day."""
    import datetime as dt

    from dimfold.plans import catalog

    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    one = lambda day: spark.createDataFrame([(day, dt.datetime(2024, 1, day, 3), 7, "view", 1.0, '{"k": 1}')], schema)
    one(10).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    assert [r.date for r in catalog.q22_datelist(spark, str(tmp_path)).collect()] == ["2024-01-10"]
    one(30).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    got = catalog.q22_datelist(spark, str(tmp_path)).collect()
    assert [(r.date, r.dates_active) for r in got] == [("2024-01-30", "2024-01-30,2024-01-10")]


def test_edge_starts_equal_the_subjects_of_the_pairs(spark):
    import random

    from dimfold.operators import graph

    rng = random.Random(6)
    rows_ = [(g, p, rng.choice(["a", "b", None, f"n{p}"]), rng.choice("AN"), 1) for g in range(30) for p in rng.sample(range(20), rng.randint(1, 6))]
    df = spark.createDataFrame(rows_ + rows_[:20], "game_id int, player_id int, player_name string, team_abbreviation string, pts int")
    want = {r.subject_identifier for r in graph.co_occurrence_edges(df).collect()}
    assert {r.subject_identifier for r in graph.edge_starts(df).collect()} == want and want


def test_declared_schemas_are_those_of_the_files(spark):
    from conftest import SF_SMALL

    from dimfold.sources.tables import SCHEMAS, read_table

    for name in SCHEMAS:
        found = spark.read.parquet(f"{SF_SMALL}/{name}.parquet").schema
        assert [(f.name, f.dataType) for f in read_table(spark, SF_SMALL, name).schema] == [(f.name, f.dataType) for f in found]
