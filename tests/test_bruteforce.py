"""Random small inputs against plain-Python brute force."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from dimfold.operators import graph, quality
from dimfold.operators import snapshot as snap

SETTINGS = dict(deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

PLAYER = st.tuples(st.sets(st.integers(2000, 2005), min_size=1, max_size=4),
                   st.lists(st.one_of(st.none(), st.integers(0, 30)), min_size=6, max_size=6))


@settings(max_examples=8, **SETTINGS)
@given(players=st.lists(PLAYER, min_size=1, max_size=4))
def test_cumulative_snapshot_bruteforce(spark, players):
    data = []
    for i, (seasons, pts) in enumerate(players):
        for s in seasons:
            p = pts[s - 2000]
            data.append((f"p{i}", s, 1, None if p is None else float(p)))
    df = spark.createDataFrame(data, "player_name string, season int, gp int, pts float")
    end = 2005
    got = {(r.player_name, r.current_season): r for r in snap.cumulative_snapshot(
        df, "player_name", "season", ["gp", "pts"], end, class_on="pts", cuts=(20, 10),
        labels=("a", "b", "c")).collect()}
    want = {}
    for name in {d[0] for d in data}:
        mine = sorted((s, p) for n, s, _, p in data if n == name)
        for cur in range(mine[0][0], end + 1):
            hist = [x for x in mine if x[0] <= cur]
            last_s, last_p = hist[-1]
            cls = "a" if last_p is not None and last_p > 20 else "b" if last_p is not None and last_p > 10 else "c"
            want[(name, cur)] = ([x[0] for x in hist], cls, cur - last_s, last_s == cur)
    assert set(got) == set(want)
    for k, (seasons, cls, rec, active) in want.items():
        r = got[k]
        assert [x.season for x in r.season_stats] == seasons
        assert (r.scoring_class, r.years_since_last_season, r.is_active) == (cls, rec, active)


ROW = st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.sampled_from("xyz")))


@settings(max_examples=8, **SETTINGS)
@given(data=st.lists(ROW, min_size=1, max_size=15))
def test_dedupe_first_bruteforce(spark, data):
    df = spark.createDataFrame(data, "k int, a int, b string")

    def sort_key(r):  # ascending, NULLs first
        return tuple((v is not None, v if v is not None else 0 if i == 1 else "") for i, v in enumerate(r) if i > 0)

    want = {}
    for r in data:
        if r[0] not in want or sort_key(r) < sort_key(want[r[0]]):
            want[r[0]] = r
    assert rows(quality.dedupe_first(df, ["k"])) == sorted(want.values(), key=repr)


MEMBER = st.tuples(st.integers(0, 3), st.integers(0, 5), st.sampled_from(["n0", "n1", "n2", None]),
                   st.sampled_from(["A", "B"]), st.integers(0, 9))


@settings(max_examples=8, **SETTINGS)
@given(data=st.lists(MEMBER, min_size=1, max_size=20))
def test_co_occurrence_edges_bruteforce(spark, data):
    df = spark.createDataFrame(data, "game_id long, player_id long, player_name string, team_abbreviation string, pts int")

    def key(r):  # survivor of a (player, game): first by (name, side, pts), NULLs first
        return tuple((v is not None, v if v is not None else "") for v in (r[2], r[3])) + ((True, r[4]),)

    members = {}
    for r in data:
        k = (r[1], r[0])
        if k not in members or key(r) < key(members[k]):
            members[k] = r
    agg = {}
    ms = list(members.values())
    for a in ms:
        for b in ms:
            if a[0] == b[0] and a[2] is not None and b[2] is not None and a[2] != b[2] and a[1] > b[1]:
                t = "shares_team" if a[3] == b[3] else "plays_against"
                k = (str(a[1]), str(b[1]), t)
                n, sa, sb, na, nb = agg.get(k, (0, 0, 0, None, None))
                agg[k] = (n + 1, sa + a[4], sb + b[4], max(filter(None, [na, a[2]])), max(filter(None, [nb, b[2]])))
    got = {(r.subject_identifier, r.object_identifier, r.edge_type):
           (r.num_games, r.subject_points, r.object_points, r.subject_player_name, r.object_player_name)
           for r in graph.co_occurrence_edges(df).collect()}
    assert got == agg


@settings(max_examples=8, **SETTINGS)
@given(days=st.lists(st.sets(st.integers(0, 40), max_size=8), min_size=1, max_size=4))
def test_datelist_bits_bruteforce(spark, days):
    import datetime as dt

    from pyspark.sql import functions as F

    from dimfold.operators import activity

    snap_day = dt.date(2024, 3, 31)
    start = dt.date(2024, 3, 1)
    data = [(f"u{i}", [snap_day - dt.timedelta(days=n) for n in sorted(ns)]) for i, ns in enumerate(days)]
    df = spark.createDataFrame(data, "user_id string, dates_active array<date>")
    got = {r.user_id: (r.datelist_int, r.active_days, r.dim_is_weekly_active)
           for r in activity.datelist_bits(df, F.lit(snap_day), F.lit(start)).collect()}
    for uid, ds in data:
        ns = [(snap_day - d).days for d in ds if start <= d <= snap_day]
        bits = sum(1 << (31 - n) for n in set(ns))
        assert got[uid] == (bits, len(set(ns)), any(n < 7 for n in ns))


FILM = st.tuples(st.integers(0, 2), st.integers(2000, 2003), st.sampled_from(["f1", "f10", "f2", "g"]),
                 st.integers(1, 9))


@settings(max_examples=8, **SETTINGS)
@given(films=st.lists(FILM, min_size=1, max_size=12))
def test_snapshot_multi_bruteforce(spark, films):
    from decimal import Decimal

    data = [(f"a{a}", str(a), f, y, 1, Decimal(r), f) for a, y, f, r in films]
    df = spark.createDataFrame(data, "actor string, actorid string, film string, year int, votes int,"
                                     " rating decimal(10,2), filmid string")
    got = {(r.actorid, r.current_year): r for r in snap.cumulative_snapshot_multi(
        df, ["actorid", "actor"], "year", ["film", "votes", "rating", "filmid"], 2003,
        class_on="rating", cuts=(8, 7, 6), labels=("star", "good", "average", "bad")).collect()}
    for aid in {d[1] for d in data}:
        items = sorted({(d[3], d[2], d[4], d[5], d[6]) for d in data if d[1] == aid})
        for cur in range(items[0][0], 2004):
            upto = [i for i in items if i[0] <= cur]
            last = upto[-1]
            r = got[(aid, cur)]
            assert r.n_films == len(upto)
            assert (r.last_film.year, r.last_film.film) == (last[0], last[1])
            assert r.is_active == (last[0] == cur) and r.years_since_last_film == cur - last[0]
            cls = "star" if last[3] > 8 else "good" if last[3] > 7 else "average" if last[3] > 6 else "bad"
            assert r.quality_class == cls


@settings(max_examples=8, **SETTINGS)
@given(seqs=st.lists(st.lists(st.tuples(st.sampled_from(["s", "g", None]), st.booleans()), min_size=1, max_size=6),
                     min_size=1, max_size=3))
def test_streaks_bruteforce(spark, seqs):
    from dimfold.operators import scd

    data = [(f"p{i}", 2000 + j, c, a) for i, seq in enumerate(seqs) for j, (c, a) in enumerate(seq)]
    df = spark.createDataFrame(data, "player_name string, current_season int, scoring_class string, is_active boolean")
    got = rows(scd.scd2_streaks(df, "player_name", "current_season", ["scoring_class", "is_active"], 2010))
    want = []
    for i, seq in enumerate(seqs):
        start = 0
        for j in range(1, len(seq) + 1):
            if j == len(seq) or seq[j] != seq[j - 1]:
                want.append((f"p{i}", seq[start][0], seq[start][1], 2000 + start, 1999 + j, 2010))
                start = j
    assert got == sorted(want, key=repr)


EVENT = st.tuples(st.sampled_from([1, 2, 3, None]), st.integers(1, 29), st.sampled_from(["h1", "h2", None]))


@settings(max_examples=8, **SETTINGS)
@given(events=st.lists(EVENT, min_size=1, max_size=25))
def test_monthly_and_metric_arrays_bruteforce(spark, events):
    import datetime as dt

    from pyspark.sql import functions as F

    from dimfold.operators import reduced

    df = spark.createDataFrame([(u, dt.datetime(2024, 2, d, 12), h) for u, d, h in events],
                               "user_id long, event_time timestamp, host string")
    got = {r.host: (r.hit_array, r.unique_visitors_array)
           for r in reduced.monthly_arrays(df, F.lit(dt.date(2024, 2, 1)), F.lit(dt.date(2024, 2, 29))).collect()}
    want = {}
    for h in {e[2] for e in events if e[2] is not None}:
        hits = [sum(1 for u, d, hh in events if hh == h and d == day) for day in range(1, 30)]
        uv = [len({u for u, d, hh in events if hh == h and d == day and u is not None}) for day in range(1, 30)]
        want[h] = (hits, uv)
    assert got == want
    day = dt.date(2024, 2, 20)
    m = {r.user_id: r.metric_array for r in reduced.metric_array_rebuild(df, F.lit(day)).collect()}
    users = {u for u, d, _ in events if u is not None and d <= 20}
    assert set(m) == users
    for u in users:
        assert m[u] == [float(sum(1 for uu, d, _ in events if uu == u and d == k)) for k in range(1, 21)]


@settings(max_examples=8, **SETTINGS)
@given(rows_=st.lists(st.tuples(st.integers(0, 3), st.integers(1, 9), st.integers(1, 3)), min_size=1, max_size=15))
def test_activity_report_bruteforce(spark, rows_):
    import datetime as dt

    from dimfold.operators import activity

    data = [(u, dt.date(2024, 1, d), [dt.date(2024, 1, d)] * n) for u, d, n in rows_]
    df = spark.createDataFrame(data, "user_id long, date date, active_dates array<date>")
    lo, hi = dt.date(2024, 1, 2), dt.date(2024, 1, 8)
    got = {r.user_id: (r.active_days, r.first_seen, r.last_seen) for r in activity.activity_report(df, lo, hi).collect()}
    want = {}
    for u in {r[0] for r in data}:
        ds = sorted({d for uu, d, _ in data if uu == u and lo <= d <= hi})
        if ds:
            want[u] = (len(ds), ds[0], ds[-1])
    assert got == want


STATE = st.tuples(st.sampled_from(["s", "g", None]), st.booleans(), st.integers(0, 1))


@settings(max_examples=8, **SETTINGS)
@given(actors=st.lists(st.tuples(st.integers(0, 3), st.lists(STATE, min_size=5, max_size=5)), min_size=1, max_size=3))
def test_change_points_bruteforce(spark, actors):
    from dimfold.operators import scd

    data = []
    for i, (debut, states) in enumerate(actors):
        n = 0
        for off in range(debut, 5):
            c, a, add = states[off]
            n += add
            data.append((str(i), f"a{i}", 2000 + off, c, a, n))
    df = spark.createDataFrame(data, "actorid string, actor string, current_year int, quality_class string,"
                                     " is_active boolean, n_films long")
    got = rows(scd.scd2_change_points(df, ["actorid", "actor"], "current_year", ["quality_class", "is_active", "n_films"],
                                      {"is_active": False, "n_films": 0}, fill="quality_class", lo=2000, hi=2004))
    want = []
    for i, (debut, states) in enumerate(actors):
        by_year = {d[2]: d for d in data if d[0] == str(i)}
        grid = []
        last_cls = None
        for y in range(2000, 2005):
            d = by_year.get(y)
            cls, act, nf = (d[3], d[4], d[5]) if d else (None, False, 0)
            cls = cls if cls is not None else last_cls
            last_cls = cls if cls is not None else last_cls
            grid.append((y, cls, act, nf))
        starts = [k for k in range(5) if k == 0 or grid[k][1:] != grid[k - 1][1:]]
        for j, k in enumerate(starts):
            end = 2000 + starts[j + 1] - 1 if j + 1 < len(starts) else 2004
            y, cls, act, nf = grid[k]
            want.append((str(i), f"a{i}", y, end, cls, act, nf, end == 2004))
    assert got == sorted(want, key=repr)


@settings(max_examples=8, **SETTINGS)
@given(data=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4), st.sampled_from(["n0", "n1", "n2", None]),
                               st.sampled_from(["A", "B"]), st.integers(0, 9), st.integers(0, 2)),
                     min_size=1, max_size=15))
def test_points_per_game_bruteforce(spark, data):
    df = spark.createDataFrame(data, "game_id long, player_id long, player_name string, team_abbreviation string,"
                                     " pts int, team_id int")
    games = spark.createDataFrame([(g, 1, 1, 0, 1, 2) for g in {d[0] for d in data}],
                                  "game_id long, pts_home int, pts_away int, home_team_id int, home_team_wins int,"
                                  " visitor_team_id int")
    teams = spark.createDataFrame([(0, "X", "x", "c", "ar", 1900)],
                                  "team_id int, abbreviation string, nickname string, city string, arena string,"
                                  " yearfounded int")
    v = graph.all_vertices(games, df, teams)
    got = rows(graph.points_per_game(v, graph.co_occurrence_edges(df)))

    def key(r):
        return tuple((x is not None, x if x is not None else "") for x in (r[2], r[3])) + ((True, r[4]),)

    members = {}
    for r in data:
        k = (r[1], r[0])
        if k not in members or key(r) < key(members[k]):
            members[k] = r
    ms = list(members.values())
    starts = {a[1] for a in ms for b in ms
              if a[0] == b[0] and a[2] is not None and b[2] is not None and a[2] != b[2] and a[1] > b[1]}
    want = set()
    for p in starts:
        mine = [r for r in data if r[1] == p]
        names = [r[2] for r in mine if r[2] is not None]
        games_n, pts = float(len(mine)), float(sum(r[4] for r in mine))
        want.add((max(names) if names else None, games_n, pts, pts / (games_n if games_n != 0 else 1.0)))
    assert got == sorted(want, key=repr)


@settings(max_examples=8, **SETTINGS)
@given(actors=st.lists(st.tuples(st.integers(0, 3), st.lists(STATE, min_size=5, max_size=5)), min_size=1, max_size=3))
def test_change_points_reference_bruteforce(spark, actors):
    from dimfold.operators import scd

    data = []
    for i, (debut, states) in enumerate(actors):
        n = 0
        for off in range(debut, 5):
            c, a, add = states[off]
            n += add
            data.append((str(i), f"a{i}", 2000 + off, c, a, n))
    df = spark.createDataFrame(data, "actorid string, actor string, current_year int, quality_class string,"
                                     " is_active boolean, n_films long")
    got = rows(scd.scd2_change_points(df, ["actorid", "actor"], "current_year", ["quality_class", "is_active", "n_films"],
                                      {"is_active": False, "n_films": 0}, reference=True, fill="quality_class",
                                      lo=2000, hi=2004))
    want = []
    for i, _ in enumerate(actors):
        by_year = {d[2]: d for d in data if d[0] == str(i)}
        raw = [(by_year[y][3], by_year[y][4], by_year[y][5]) if y in by_year else (None, False, 0)
               for y in range(2000, 2005)]
        first_cls = raw[0][0]  # FIRST_VALUE over the running frame is the partition's first value
        grid = [(c if c is not None else first_cls, a, n) for c, a, n in raw]
        for k in range(5):
            change = k == 0 or grid[k] != grid[k - 1]
            end = 2000 + k if k < 4 else 2004  # LEAD(year - 1) over all rows: the next row's year minus one
            if change:
                c, a, n = grid[k]
                want.append((str(i), f"a{i}", 2000 + k, end, c, a, n, end == 2004))
    assert got == sorted(want, key=repr)


JSONS = ['{"active_dates":["2024-01-01"]}', '{"other":1}', '["2024-01-01"]', 'junk', '{}', None]


@settings(max_examples=8, **SETTINGS)
@given(data=st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["d1", "d2", None]), st.sampled_from(JSONS)),
                     min_size=1, max_size=12))
def test_check_contract_bruteforce(spark, data):
    import json as js

    df = spark.createDataFrame(data, "user_id long, date string, j string")
    got = quality.check_contract(df, keys=["user_id", "date"], not_null=["date"], json_objects=["j"],
                                 json_required={"j": "active_dates"}).first().asDict()

    def parsed(t):
        try:
            return js.loads(t)
        except (TypeError, ValueError):
            return None

    counts = {}
    for u, d, _ in data:
        counts[(u, d)] = counts.get((u, d), 0) + 1
    want = {
        "rows": len(data),
        "null_date": sum(1 for _, d, _ in data if d is None),
        "not_object_j": sum(1 for _, _, j in data if j is not None and not isinstance(parsed(j), dict)),
        "missing_active_dates_j": sum(1 for _, _, j in data if not (isinstance(parsed(j), dict) and "active_dates" in parsed(j))),
        "duplicate_keys": sum(1 for n in counts.values() if n > 1),
    }
    assert got == want
