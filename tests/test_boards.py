"""Movement alerts, market boards, form boards, name maps, picked stats, articles and live control on small cases."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from matchlake.operators import identity as I
from matchlake.operators import links as L
from matchlake.plans import movement as M
from matchlake.sources import feeds as X
from matchlake.sources import listings as N

NOW = datetime(2026, 1, 2, 12)


def prices(p):
    """Odds whose no-vig probabilities are p."""
    return [1 / x for x in p]


def board(spark, histories, models=()):
    """histories: event -> list of (minutes back, probabilities, confidence)."""
    rows = [(e, n, NOW - timedelta(minutes=m), *prices(p), c) for e, points in histories.items() for n, (m, p, c) in enumerate(points)]
    h = spark.createDataFrame(rows, "event_id int, snapshot_id int, captured_at timestamp, home double, draw double, away double, match_confidence double")
    targets = spark.createDataFrame([(e, NOW + timedelta(hours=2)) for e in [*histories, 999]], "event_id int, kickoff timestamp")
    return {r["event_id"]: r for r in M.movement_board(h, targets, spark.createDataFrame(list(models), "event_id int, model_side string"), F.lit(NOW)).collect()}


def test_signals_alerts_and_alignment(spark):
    flat = (0.5, 0.3, 0.2)
    up = (0.53, 0.28, 0.19)
    got = board(spark, {
        1: [(1440, flat, 1.0), (120, flat, 1.0), (60, flat, 1.0), (1, up, 1.0)],  # 3 points in an hour
        2: [(120, (0.55, 0.27, 0.18), 1.0), (60, (0.48, 0.31, 0.21), 1.0), (1, (0.51, 0.29, 0.20), 1.0)],  # down in two hours, up in one
        3: [(1, flat, 1.0)],
        4: [(1440, flat, 0.5), (120, flat, 0.5), (60, flat, 0.5), (1, up, 0.5)],
        5: [(1440, flat, 1.0), (120, flat, 1.0), (60, flat, 1.0), (1, flat, 1.0)],
        6: [(1440, up, 1.0), (120, up, 1.0), (60, up, 1.0), (1, flat, 1.0)],
    }, [(1, "H"), (2, "A"), (5, "D"), (6, "H")])
    assert 999 not in got
    assert (got[1]["signal"], got[1]["side"], got[1]["alignment"]) == ("1H STEAM", "H", "YES") and got[1]["alert_score"] == pytest.approx(1.5)
    assert (got[2]["signal"], got[2]["alignment"]) == ("REVERSAL", "NO")
    assert (got[3]["signal"], got[3]["alert_score"], got[3]["alignment"], got[3]["move_1h"]) == ("COLLECTING", 0.0, "NO MODEL", None)
    assert (got[4]["signal"], got[4]["alert_score"]) == ("MATCH CHECK", 0.0)
    assert (got[5]["signal"], got[5]["alert_score"], got[5]["alignment"], got[5]["side"]) == ("STABLE", 0.0, "NEUTRAL", "H")
    assert (got[6]["signal"], got[6]["alignment"]) == ("1H DRIFT", "CONFLICT")


def test_market_board(spark):
    columns = "event_id int, kickoff timestamp, status string, in_play boolean, home double, draw double, away double, source_h double, source_d double, source_a double, source_pick string, modeled boolean, " + ", ".join(f"{k}_{c} double" for k in ("dc", "pi") for c in "hda")
    hour = timedelta(hours=1)
    rows = [
        (1, NOW + hour, "", None, 2.0, 3.0, 4.0, 60.0, 25.0, 15.0, "1", True, 0.5, 0.3, 0.2, 0.6, 0.2, 0.2), (2, NOW - hour, "", True, 2.0, 3.0, 4.0, None, 25.0, 30.0, "2", True, 0.5, 0.3, 0.2, 0.2, 0.2, 0.6),
        (3, NOW - hour, "", None, 1.1, None, 1.1, 10.0, 10.0, 10.0, None, None, *[None] * 6), (4, NOW - 3 * hour, "", True, 2.0, 3.0, 4.0, 10.0, 20.0, 20.0, "X", True, 0.2, 0.2, 0.6, 0.1, 0.1, 0.8), (5, NOW + hour, "match ENDED", None, 2.0, 3.0, 4.0, 10.0, 20.0, 20.0, None, True, 0.4, 0.4, 0.2, 0.4, 0.4, 0.2),
    ]
    got = {r["event_id"]: r for r in M.market_board(spark.createDataFrame(rows, columns), F.lit(NOW)).collect()}
    assert [got[n]["phase"] for n in range(1, 6)] == ["PRE", "LIVE", "CLOSED", "ENDED", "ENDED"]
    assert (got[1]["best_side"], got[1]["best_odds"], got[1]["edge_status"], got[1]["source_dc"], got[1]["consensus"]) == ("H", 2.0, "POSITIVE EDGE", "AGREE", "ALL AGREE") and got[1]["best_edge"] == pytest.approx(0.2)
    assert (got[2]["best_side"], got[2]["edge_status"], got[2]["source_dc"], got[2]["consensus"]) == ("A", "NO SOURCE MODEL", "CONFLICT", "DC/PI CONFLICT")
    assert (got[3]["edge_status"], got[3]["source_dc"], got[3]["consensus"], got[3]["best_side"]) == ("NO EDGE", "MODEL_UNAVAILABLE", "LOCAL MODEL UNAVAILABLE", "H")
    assert (got[4]["consensus"], got[5]["source_dc"], got[5]["dc_pick"]) == ("MODEL CONFLICT", "NO_SOURCE", "H")


def test_form_board(spark):
    day = lambda n: NOW - timedelta(days=n)
    past = spark.createDataFrame([(n, 1, 2, n % 3, 1, day(n)) for n in range(1, 9)] + [(100, 2, 1, 0, 5, day(20))], "event_id long, home_id long, away_id long, home_goals int, away_goals int, kickoff timestamp").withColumn("tournament", F.lit("t"))
    fixtures = spark.createDataFrame([(1000, 1, 2, NOW), (1001, 1, 2, NOW), (1002, 8, 9, NOW)], "event_id long, home_id long, away_id long, kickoff timestamp").withColumn("tournament", F.lit("t"))
    override = spark.createDataFrame([(1001, "OK", "WLW", 2, 0, 1, 1.5, None, None, 1, None, 0, None, 0.25), (1000, "BAD", "XXX", 9, 9, 9, 9.0, 9.0, "X", 9, 9, 9, 9.0, 9.0)], "event_id long, status string, " + ", ".join(f"{s}_{f}" for s in ("home", "away") for f in ("form6 string", "last6_w int", "last6_d int", "last6_l int", "gf_avg double", "ga_avg double")))
    got = {r["event_id"]: r for r in M.form_board(fixtures, past, override).collect()}
    own = got[1000]
    assert (own["home_form"], own["home_games"], own["home_w"], own["home_d"], own["home_l"], own["home_gf_avg"], own["home_ga_avg"]) == ("DWLDWL", 6, 2, 2, 2, 1.0, 1.0)
    assert own["away_venue_form"] == "DLWDLW" and own["home_venue_form"] == "DWLDWL" and own["source"] == "RESULTS" and own["quality"] == "RECENT:6/6" and own["home_text"] == "DWLDWL | 2-2-2 | GF 1.00 / GA 1.00"
    over = got[1001]
    assert (over["home_form"], over["home_games"], over["home_w"], over["home_gf_avg"], over["home_ga_avg"], over["quality"]) == ("WLW", 3, 2, 1.5, 1.0, "OVERRIDE_OK")
    assert (over["away_form"], over["away_w"], over["away_ga_avg"]) == (own["away_form"], own["away_w"], 0.25)
    none = got[1002]
    assert (none["home_form"], none["home_games"], none["home_gf_avg"], none["home_text"], none["quality"]) == ("", 0, None, "NO RECENT GAMES", "RECENT:0/0")
    assert M.form_board(fixtures, past).count() == 3


def test_name_maps_drop_what_is_ambiguous(spark):
    rows = "source_name string, canonical string, confidence double, event_count int, last_seen timestamp"
    own = spark.createDataFrame([("Man Utd", "Manchester United", 0.9, 3, NOW), ("MAN-UTD", "Man U Women", 0.8, 9, NOW), ("Manchester Utd", "Manchester United", 0.95, 1, NOW), ("", "X", 1.0, 1, NOW), ("Y", " ", 1.0, 1, NOW)], rows)
    everywhere = spark.createDataFrame([("Man Utd", "Other"), ("Inter", "Internazionale"), ("inter", "Inter Miami"), ("Ajax", "AFC Ajax"), ("Bad", "Bad FC")], "source_name string, canonical string")
    blocked = spark.createDataFrame([("bad",), (None,)], "name string")
    assert sorted(map(tuple, I.forward_map(own, everywhere, blocked).collect())) == [("ajax", "AFC Ajax", "GLOBAL"), ("manchesterutd", "Manchester United", "SOURCE"), ("manutd", "Manchester United", "SOURCE")]
    assert dict(map(tuple, I.reverse_map(own).collect())) == {"manchesterunited": "Manchester Utd", "manuwomen": "MAN-UTD"}
    c = spark.createDataFrame([("EPL", "Premier League"), ("epl ", "Premier League"), ("Cup", "A"), ("cup", "B"), (None, "C")], "source_competition string, tournament string")
    assert [tuple(r) for r in I.competition_map(c).collect()] == [("epl", "Premier League")]
    x = spark.createDataFrame([("EPL", "City", "Manchester City", "PL"), ("L1", "City", "Other City", None), (None, "City", "Any City", "Z"), ("EPL", "Rovers", "A", "PL"), ("epl", "rovers", "A", "Other")], "source_competition string, source_name string, canonical string, tournament string")
    assert sorted(map(tuple, I.context_map(x).collect())) == [("", "city", "Any City", "Z"), ("epl", "city", "Manchester City", "PL"), ("l1", "city", "Other City", "")]


def test_picked_stats(spark):
    stats = spark.createDataFrame([(1, "a.percentile.shotsOnTarget", "9"), (1, "stats.shots_on_target", "4"), (1, "x.y.z.myShotsOnTarget", "5"), (2, "b.shots-on-target-extra", "1"), (2, "...", "7")], "event_id int, path string, value string")
    aliases = spark.createDataFrame([("shotsOnTarget", "sot"), ("Shots on target", "sot"), ("", "none")], "alias string, target string")
    assert [tuple(r) for r in X.pick_stat(stats, aliases).collect()] == [(1, "sot", "stats.shots_on_target", "4")]
    items = spark.createDataFrame([(1, 0, "Expected goals", "a"), (1, 1, "Goals", "b"), (1, 2, "Goals", "c"), (2, 5, "Total shots", "d"), (2, 4, "Shots per game", "e"), (3, 0, "", "f")], "player_id int, pos int, title string, value string").withColumns({"per90": F.lit(0.0), "percentile": F.lit(0.0)})
    aliases = spark.createDataFrame([("goals", "goals"), ("shots", "shots")], "alias string, target string")
    assert sorted((r["player_id"], r["target"], r["score"], r["value"]) for r in X.pick_titled(items, aliases).collect()) == [(1, "goals", 3, "b"), (2, "shots", 2, "e")]


def test_articles(spark):
    page = lambda h1, body, event="": f'<h1>{h1}</h1>{event}<p>Date 2026-03-04 18:30</p>{body}'
    winner = lambda h, d, a: f"<h4>Winner</h4>Home {h}% Draw {d} % Away {a}%<h4>Total Goals 2.5</h4>Over 55% Under 45%<h4>Both Teams to Score</h4>Yes 60% No 40%<h4>Correct Score</h4><h5>2 - 1 12% Others 88%</h5>"
    event = lambda at, name="Two": f'<script type="application/ld+json">[{{"@type":"SportsEvent","url":"u1","startDate":"{at}","homeTeam":{{"name":"One FC"}},"awayTeam":{{"name":"{name}"}}}}]</script>'
    rows = [(1, "u1", page("One FC vs Two Prediction", winner(50, 30, 20), event("2026-03-04T18:30:00+02:00"))), (2, "u1", page("One FC v Two H2H", winner(50, 30, 30), event("2026-03-04T18:30:00"))), (3, "u1", page("One FC vs Two Prediction", "Winner Home 40% none", event("2026-03-04T18:30:00Z", "Three")))]
    rows += [(4, "u1", "<h1>No sides</h1>"), (5, "u1", None), (6, "u1", "<h1>A vs B Prediction</h1> no clock")]
    got = {r["page_id"]: r for r in N.article_rows(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert set(got) == {1, 2, 3}
    one = got[1]
    assert (one["home"], one["away"], one["h"], one["d"], one["a"], one["over25"], one["under25"], one["both_yes"], one["both_no"], one["score"], one["status"]) == ("One FC", "Two", 0.5, 0.3, 0.2, 0.55, 0.45, 0.6, 0.4, "2 - 1", "VERIFIED")
    assert one["kickoff"] == datetime(2026, 3, 4, 16, 30)
    assert (got[2]["h"], got[2]["over25"], got[2]["status"], got[2]["kickoff"]) == (None, 0.55, "WALL_TIME", None)
    assert (got[3]["h"], got[3]["status"], got[3]["score"]) == (None, "WALL_TIME", None)


def test_live_control_says_why_it_waits(spark):
    pairs = [f"{m}_{s} double" for m, _, _ in M.CONTROL for s in ("home", "away")]
    none = [None, None]
    rows = [(1, 50, 1.0, 0.5, 9.0, 2.0, 4.0, 1.0, *none * 4), (2, 50, 0.1, 0.6, 2.0, 9.0, 1.0, 1.0, *none * 4), (3, 5, 1.0, 0.5, 9.0, 2.0, 4.0, 1.0, *none * 4), (4, 50, 1.0, 0.5, 9.0, 2.0, *none * 5), (5, 50, 1.0, 0.9, 2.0, 2.0, 1.0, 1.0, *none * 4), (6, 50, 1.0, 0.5, 9.0, 2.0, 4.0, 1.0, *none * 4), (7, None, 1.0, 0.5, 9.0, 2.0, 4.0, 1.0, *none * 4)]
    live = spark.createDataFrame(rows, "event_id int, minute int, " + ", ".join(pairs))
    scenario = spark.createDataFrame([(e, s, "UNKNOWN" if e == 6 else "H") for e in range(1, 8) for s in ("0-15", "46-60")], "event_id int, segment string, expected string")
    got = {r["event_id"]: (r["score"], r["status"], r["reason"]) for r in M.live_control(live, scenario).collect()}
    assert got[1] == (4, "CONFIRM", "LIVE_CONTROL_ALIGNS") and got[2] == (-3, "CONTRADICT", "LIVE_CONTROL_OPPOSES")
    assert [got[n][2] for n in (3, 4, 5, 6, 7)] == ["EARLY_MATCH", "INSUFFICIENT_LIVE_METRICS", "LIVE_CONTROL_BALANCED", "NO_EXPECTED_CONTROL", "NO_EXPECTED_CONTROL"]


def test_checked_sizes(spark, monkeypatch):
    df = spark.range(2)
    with pytest.raises(ValueError):
        L.with_config(df, spark.range(2).toDF("a"))
    with pytest.raises(ValueError):
        L.with_config(df, spark.range(0).toDF("a"))
    assert [tuple(r) for r in L.with_config(df, spark.createDataFrame([(0.5, None)], "a double, b string")).collect()] == [(0, 0.5, None), (1, 0.5, None)]
    monkeypatch.setattr(L, "MOST_SOURCES", 1)
    empty = spark.createDataFrame([], "source string, name_key string, status string")
    with pytest.raises(ValueError):
        L.anchor_coverage(spark.createDataFrame([("k",)], "name_key string"), spark.createDataFrame([("a",), ("b",)], "source string"), empty, empty)


def test_h2h_board_takes_the_first_consistent_override(spark):
    past = spark.createDataFrame([(n, 1, 2, 2, n % 2, NOW - timedelta(days=n), "t") for n in range(1, 8)] + [(50, 2, 1, 3, 0, NOW - timedelta(hours=1), "t")], "event_id long, home_id long, away_id long, home_goals int, away_goals int, kickoff timestamp, tournament string")
    fixtures = spark.createDataFrame([(100, 1, 2, NOW), (101, 3, 4, NOW), (102, 3, 5, NOW), (103, 2, 1, NOW)], "event_id long, home_id long, away_id long, kickoff timestamp")
    coverage = spark.createDataFrame([(3, "BOOTSTRAPPED"), (4, "BOOTSTRAPPED"), (5, "PARTIAL")], "team long, status string")
    columns = "event_id long, verified boolean, games int, wins int, draws int, losses int, gf int, ga int, last string"
    a = spark.createDataFrame([(103, True, 3, 1, 0, 0, 9, 9, "bad"), (100, False, 1, 1, 0, 0, 9, 9, "W")], columns)
    b = spark.createDataFrame([(103, True, 2, 1, 1, 0, 3, 1, "WD")], columns)
    got = {r["event_id"]: r for r in M.h2h_board(fixtures, past, coverage, [("A", a), ("B", b)]).collect()}
    assert tuple(got[100])[1:] == (5, 4, 0, 1, 8, 5, 2.6, "LWWWW", "RESULTS", "H2H_OK")
    assert (got[101]["quality"], got[102]["quality"], got[101]["games"], got[101]["avg_total"]) == ("NO_PREVIOUS_H2H", "HISTORY_PARTIAL", 0, None)
    assert (got[103]["source"], got[103]["games"], got[103]["last"], got[103]["quality"], got[103]["avg_total"]) == ("B", 2, "WD", "H2H_VERIFIED", 2.0)


def test_player_profiles(spark):
    full = '{"id":" 7 ","name":"A","isCaptain":true,"positionDescription":{"primaryPosition":{"key":"gk"}},"statSeasons":[{"seasonName":"new","tournaments":[]},{"seasonName":"old","tournaments":[{"tournamentId":"1","name":"x","categories":[{"title":"t"}]}]}],"recentMatches":[{"minutesPlayed":90,"goals":1,"rating":7.0},{"minutesPlayed":10},{"minutesPlayed":0,"goals":5}]}'
    rows = spark.createDataFrame([("k1", "n1", "t1", "T1", "P1", full), ("k2", "n2", "t2", "T2", "P2", None), ("k3", "n3", None, "", None, "{bad"), ("k4", "n4", None, None, None, '{"recentMatches":[{"minutesPlayed":5}]}')], "player_id string, player_name string, team_id string, team_name string, position string, payload string")
    got = {r["player_id"]: r for r in X.player_profiles(rows).collect()}
    one = got["7"]
    assert (one["player_name"], one["team_id"], one["position"], one["is_captain"], one["season"], one["tournament"], one["recent_matches"], one["recent_minutes"], one["recent_goals"], one["recent_rating"], one["quality"]) == ("A", "t1", "gk", True, "old", "x", 2, 100, 1, 7.0, "OK_CURRENT_STATS")
    assert (got["k2"]["quality"], got["k2"]["position"], got["k3"]["quality"], got["k3"]["team_name"], got["k4"]["quality"]) == ("IDENTITY_ONLY", "P2", "IDENTITY_ONLY", None, "OK_RECENT_FORM")
