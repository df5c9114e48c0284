"""Listings by specification, stat trees, the target audit and archives behind team form."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from matchlake.plans import intersection as A
from matchlake.plans import models as M
from matchlake.sources import listings as X

T0 = datetime(2026, 1, 1, 12)


def listing(spark, html, requested="2026-02-02"):
    return [r.asDict() for r in X.listing_rows(spark.createDataFrame([(1, requested, html)], "page_id int, requested_date string, html string"), base_url="https://x").collect()]


def test_a_listing_block_gives_its_own_fields_only(spark):
    whole = """<div class="tr_1 rcnt a"><span class='q'></span><span class="homeTeam"> <span itemprop="name">FC  <i>One</i></span></span><span class="homeTeam"><span class="z" itemprop="name">FC One</span></span>
      <span class="awayTeam"><span itemprop="name">Two &amp; Co</span></span><time itemprop="d" datetime="2026-03-04 15:00"></time><span class="date_bah">4/03 15:00</span><span class="shortTag">EsP</span>
      <div class="fprc"><span>45</span><span class="fpr">30 %</span><span>25</span></div><span class="forepr"><span>1</span></span><div class="ex_sc tabonly">2 - 1</div><div class="avg_sc tabonly">2.75</div>
      <div class="haodd"><span>1.85</span><span>7/2</span><span>x</span></div><a href="/en/other">n</a><a class="m" href="/en/football/matches/one-two-1?a=b#c">m</a></div>"""
    empty = '<div class="rcnt"><meta itemprop="name" content="Three vs Four"><div class="fprc"><span>101</span></div></div>'
    rows = listing(spark, "<body>" + whole + empty + '<div class="rcnt"><span class="homeTeam"><span itemprop="name">Alone</span></span></div><div class="rcntx">no</div></body>')
    assert [(r["home"], r["away"]) for r in rows] == [("FC One", "Two &amp; Co"), ("Three", "Four")]
    one, two = rows
    assert str(one["match_date"]) == "2026-03-04" and str(two["match_date"]) == "2026-02-02"
    assert [one[c] for c in ("kickoff_text", "league", "prob_home", "prob_draw", "prob_away", "pick", "score", "avg_goals", "odds_home", "odds_draw", "odds_away", "url")] == ["4/03 15:00", "EsP", 45.0, 30.0, 25.0, "1", "2 - 1", 2.75, 1.85, 4.5, None, "https://x/en/football/matches/one-two-1"]
    assert all(two[c] is None for c in ("kickoff_text", "league", "prob_home", "prob_draw", "pick", "score", "avg_goals", "odds_home", "url"))
    assert listing(spark, None) == [] and listing(spark, "<p>none</p>") == []


def test_another_specification(spark):
    fields = (X.Field("price", "odds", (X.element("p", "b", 2),)), X.Field("name", "text", (X.element("n"),)))
    df = spark.createDataFrame([(1, None, '<div class="row"><i class="n">a</i><i class="p"><b>1.5</b> <b>2.5</b></i></div><div class="row"><i class="p"><b>9</b></i></div>')], "page_id int, requested_date string, html string")
    assert [(r["name"], r["price"]) for r in X.listing_rows(df, fields, "row", ()).collect()] == [("a", 2.5), (None, None)]


def brute_stats(detail):
    """All two-sided stats of a tree, by a plain walk."""
    out = set()

    def walk(node, period, group):
        if isinstance(node, dict):
            title, values = node.get("title"), node.get("stats")
            pair = isinstance(values, list) and len(values) >= 2 and not isinstance(values[0], (dict, list))
            if pair:
                name = node.get("key") or title
                out.add((period, group, name.lower().replace(" ", "_"), title or node.get("key"), *[None if v is None else str(v) for v in values[:2]]))
            for k, v in node.items():
                if not (pair and k == "stats"):
                    walk(v, period, title or group)
        elif isinstance(node, list):
            for v in node:
                walk(v, period, group)

    for period, tree in detail["content"]["stats"]["Periods"].items():
        walk(tree, period, "")
    return out


def test_stats_at_any_depth(spark):
    stat = lambda title, *values, **more: {"title": title, "stats": list(values)} | more
    tree = {"content": {"stats": {"Periods": {
        "All": {"stats": [stat("G1", stat("Shots", 3, "4", key="shots"), stat("Corner kicks", None, 2)), {"x": [{"y": [stat("Deep", "1 (5%)", "2", 3)]}]}, stat("Single", 1), stat("Empty")]},
        "2H": [stat("Top", 5, None, inner=stat("Nested", "7", "8")), {"title": " ", "stats": ["a", "b"], "key": "only key"}],
    }}}}
    rows = spark.createDataFrame([(1, json.dumps(tree)), (2, "no json"), (3, None), (4, "{}"), (5, json.dumps({"content": {"stats": {"Periods": None}}}))], "event_id int, detail string")
    got = {(r["period"], r["group"], r["key"], r["title"], r["home"], r["away"]) for r in X.team_stats(rows).collect()}
    want = brute_stats(tree)
    assert {r for r in got if r[2] != "only_key"} == {r for r in want if r[2] != "only_key"} and len(got) == len(want) == 6
    assert ("2H", "", "only_key", "only key", "a", "b") in got


def test_repeated_stats_count_once_and_deep_trees_are_an_error(spark):
    stat = {"title": "Shots", "stats": [1, 2]}
    many = {"content": {"stats": {"Periods": {"All": [stat, {"title": "Again", "stats": [stat, {"title": "Shots", "stats": [1, 3]}]}]}}}}
    df = spark.createDataFrame([(1, json.dumps(many))], "event_id int, detail string")
    assert sorted((r["key"], r["group"], r["home"], r["away"]) for r in X.team_stats(df).collect()) == [("shots", "", "1", "2"), ("shots", "Again", "1", "3")]
    deep = stat
    for _ in range(9):
        deep = [deep]
    df = spark.createDataFrame([(1, json.dumps({"content": {"stats": {"Periods": {"All": deep}}}}))], "event_id int, detail string")
    with pytest.raises(Exception, match="deeper than 8"):
        X.team_stats(df).collect()
    assert X.team_stats(df, depth=12).count() == 1


def test_each_target_has_one_reason(spark):
    targets = [(n, f"L{n % 2}", f"h{n}", f"a{n}", T0 + timedelta(hours=n)) for n in range(1, 11)] + [(50, None, "h50", "a50", T0 + timedelta(hours=20)), (60, "L", "x", "y", T0 - timedelta(hours=1)), (61, "L", "x", "y", T0 + timedelta(hours=49)), (62, "L", "x", "y", T0)]
    at = lambda n, **more: T0 + timedelta(hours=n, **more)
    rows = [(1, "h1", "a1", at(1), True, "E"), (2, "h2", "a2", at(2, seconds=60), True, "E"), (3, "h2", "a2", at(2), True, "E"), (4, "h3", "a3", at(3), True, "E"), (5, "h4", "a4", at(4, seconds=61), True, "E"), (6, "h4", "a4", at(9), True, "E"), (7, "h5", "a5", at(5), False, "E")]
    rows += [(8, "h6", "zz", at(6), True, "E"), (9, "yy", "a6", at(6), True, "E"), (10, "yy", "zz", at(7), True, "E"), (11, "h8", "a8", None, True, "E"), (12, "h9", "a9", at(9), True, "Q")]
    t = spark.createDataFrame(targets, "event_id int, league string, home_key string, away_key string, kickoff timestamp")
    o = spark.createDataFrame(rows, "row_id int, home_key string, away_key string, clock timestamp, fields_ok boolean, league_code string")
    c = A.classify_targets(t, o, t.where("event_id = 1"), F.lit(T0), known={"E": ("l1",), "Q": ("zz",)}).cache()
    got = {r["event_id"]: (r["reason"], r["row_id"]) for r in c.collect()}
    none = ("NO_SOURCE_OBSERVATION_AT_KICKOFF", None)
    assert got == {
        1: ("VERIFIED_PUBLISHED", None), 2: ("MULTIPLE_SOURCE_PAIRS_AT_KICKOFF", 2), 3: ("PAIR_AND_TIME_UNPUBLISHED", 4), 4: ("VERIFIED_PAIR_DIFFERENT_KICKOFF", 5), 5: ("PAIR_WITH_INVALID_SOURCE_MODEL_OR_CLOCK", None),
        6: ("ONE_VERIFIED_TEAM_AT_SAME_KICKOFF", 8), 7: ("OTHER_SOURCE_MATCHES_AT_SAME_KICKOFF", None), 8: none, 9: ("KNOWN_LEAGUE_CONFLICT", 12), 10: none, 50: none,
    }
    report = A.audit_report(c, samples=2, leagues=2).collect()
    by = {(r["level"], r["league"], r["reason"]): r for r in report}
    assert by["TOTAL", None, None]["n"] == 11 and sum(r["n"] for r in report if r["level"] == "REASON") == 11
    assert by["REASON", None, none[0]]["samples"] == [8, 10] and by["REASON", None, "VERIFIED_PUBLISHED"]["samples"] == []
    assert {r["league"] for r in report if r["level"] == "LEAGUE"} == {"L0", "L1"}
    assert by["LEAGUE_REASON", "L0", none[0]]["share"] == pytest.approx(2 / 5)
    assert A.audit_report(c.limit(0)).collect() == []


def test_archive_games_count_once_and_neutral_ones_for_no_venue(spark):
    games = "event_id long, home_id long, away_id long, home_goals int, away_goals int, kickoff timestamp, tournament string"
    day = lambda n: T0 - timedelta(days=n)
    own = spark.createDataFrame([(n, 1, 2, 1, 0, day(n), "A") for n in range(1, 40)] + [(100 + n, 3, 1, 0, 0, day(n), "A") for n in range(1, 40)], games)
    archive = spark.createDataFrame([("Óne", "Two", day(n), 2, 0, n % 2 == 0) for n in range(21, 60)] + [("One", "Stranger", day(800), 9, 9, False)], "home string, away string, kickoff timestamp, home_goals int, away_goals int, neutral boolean")
    names = spark.createDataFrame([("one", 1), ("two", 2), ("three", 3)], "name string, team long")
    fixtures = spark.createDataFrame([(1000, 1, 2, T0, "CUP"), (1001, 1, 3, T0, "CUP"), (1002, 1, 2, T0, "A")], "event_id long, home_id long, away_id long, kickoff timestamp, tournament string")
    got = {r["event_id"]: r for r in M.team_form_with_archive(fixtures, own, archive, names, F.col("tournament") == "CUP").collect()}
    assert {k: (r["source"], r["external_home_games"], r["external_away_games"]) for k, r in got.items()} == {1000: ("ARCHIVE_AND_RECENT", 39, 39), 1001: ("OWN", 0, 0), 1002: ("OWN", 0, 0)}
    assert str(got[1000]["external_latest"]) == str(day(21).date()) and got[1001]["external_latest"] is None
    plain = {r["event_id"]: r for r in M.team_form_model(fixtures, own).collect()}
    assert got[1002]["h"] == pytest.approx(plain[1002]["h"]) and got[1000]["h"] > plain[1000]["h"]
    empty = {r["event_id"]: r for r in M.team_form_with_archive(fixtures, own, archive.limit(0), names, F.lit(True)).collect()}
    assert all(empty[k]["h"] == pytest.approx(plain[k]["h"]) and empty[k]["source"] == "OWN" for k in plain)
