"""The goal model by league, and ratings that go on from a stored state."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlake.plans import goals, models

T0 = datetime(2026, 1, 1, 12)
GAMES = "event_id long, home_id long, away_id long, home_goals int, away_goals int, kickoff timestamp, tournament string"


def league(name, n, teams, seed, first=0):
    r = random.Random(seed)
    strength = {t: r.uniform(-0.4, 0.5) for t in teams}
    draw = lambda rate: sum(r.random() < rate / 12 for _ in range(12))
    out = []
    for i in range(n):
        h, a = r.sample(teams, 2)
        out.append((first + i, h, a, draw(math.exp(0.3 + strength[h] - strength[a])), draw(math.exp(strength[a] - strength[h])), T0 + timedelta(days=i % 200, minutes=i), name))
    return out


def log_likelihood(games, fit, rho, now, xi=0.001, ridge=1e-3):
    """Game by game, as the model is defined."""
    total = 0.0
    for _, h, a, hg, ag, at, _ in games:
        w = math.exp(-xi * (now - at).total_seconds() / 86_400)
        lam, mu = math.exp(fit["level"] + fit["home"] + fit["attack"][h] - fit["defence"][a]), math.exp(fit["level"] + fit["attack"][a] - fit["defence"][h])
        tau = {(0, 0): 1 - lam * mu * rho, (0, 1): 1 + lam * rho, (1, 0): 1 + mu * rho, (1, 1): 1 - rho}.get((hg, ag), 1.0)
        if tau <= 0:
            return -math.inf
        total += w * (hg * math.log(lam) - lam + ag * math.log(mu) - mu + math.log(tau))
    return total - ridge / 2 * (sum(v * v for k in ("attack", "defence") for v in fit[k].values()) + fit["level"] ** 2 + fit["home"] ** 2)


def fitted(spark, games, now, **options):
    df = spark.createDataFrame(games, GAMES).repartition(4)
    w = F.exp(F.lit(-0.001) * (F.unix_seconds(F.lit(now)) - F.unix_seconds("kickoff")) / 86_400.0)
    out = {}
    for r in goals.fit_goals(df.select(F.col("tournament").alias("scope"), "home_id", "away_id", "home_goals", "away_goals", w.alias("weight")), **options).collect():
        f = out.setdefault(r["scope"], {"attack": {}, "defence": {}, "level": r["level"], "home": r["home"], "rho": r["rho"], "steps": r["steps"]})
        f["attack"][r["team"]], f["defence"][r["team"]] = r["attack"], r["defence"]
    return out


def test_each_league_is_at_the_top_of_its_own_likelihood(spark):
    now = T0 + timedelta(days=300)
    one, two = league("a", 300, list(range(8)), 1), league("b", 400, list(range(5, 12)), 2, 1000)
    fits = fitted(spark, one + two, now)
    for name, games in (("a", one), ("b", two)):
        f = fits[name]
        top = log_likelihood(games, f, f["rho"], now)
        assert f["steps"] < 60
        r = random.Random(7)
        for _ in range(60):
            near = {k: {t: v + r.gauss(0, 0.01) for t, v in f[k].items()} for k in ("attack", "defence")} | {k: f[k] + r.gauss(0, 0.01) for k in ("level", "home")}
            assert log_likelihood(games, near, f["rho"] + r.gauss(0, 0.01), now) <= top
        for d in (-1e-4, 1e-4):
            assert log_likelihood(games, f, f["rho"] + d, now) <= top
        alone = fitted(spark, games, now)[name]
        assert all(abs(alone[k][t] - f[k][t]) < 1e-6 for k in ("attack", "defence") for t in f[k]) and abs(alone["rho"] - f["rho"]) < 1e-6


def test_teams_that_never_score_and_few_games(spark):
    now = T0 + timedelta(days=300)
    fits = fitted(spark, [(1, 1, 2, 0, 0, T0, "a"), (2, 2, 1, 3, 0, T0, "a"), (3, 4, 5, 0, 0, T0, "b")], now)
    assert set(fits) == {"a", "b"} and all(np.isfinite(np.array(list(f[k].values()), float)).all() for f in fits.values() for k in ("attack", "defence"))


def test_gates_and_tiers(spark):
    now = T0 + timedelta(days=300)
    big, small, tiny = league("big", 200, list(range(6)), 3), league("small", 60, list(range(20, 26)), 4, 1000), league("tiny", 30, list(range(40, 44)), 5, 2000)
    res = spark.createDataFrame([*big, (900, 7, 1, 1, 0, T0, "big"), *small, *tiny, (5000, 0, 1, 9, 9, now + timedelta(days=1), "big"), (5001, 0, 1, None, 1, T0, "big")], GAMES)
    fixtures = spark.createDataFrame([(1, "big", 0, 1), (2, "big", 7, 1), (3, "small", 20, 21), (4, "tiny", 40, 41), (5, "big", 0, 99), (6, None, 0, 1)], "event_id long, tournament string, home_id long, away_id long")
    got = {r["event_id"]: r for r in goals.goal_model(fixtures, F.lit(now), res).collect()}
    assert {k: (r["tier"], r["training_matches"]) for k, r in got.items()} == {1: ("LEAGUE", 201), 3: ("OWN", 60)}
    assert all(abs(r["h"] + r["d"] + r["a"] - 1) < 1e-9 and 0 < r["over25"] < 1 for r in got.values())
    own = spark.createDataFrame(league("tiny", 50, [40, 41, 42], 6), GAMES)
    assert {r["event_id"]: r["tier"] for r in goals.goal_model(fixtures, F.lit(now), res, own).collect()} == {1: "LEAGUE", 4: "OWN"}


def rows(df, kind):
    keep = ("tournament", "event_id", "home_rating", "away_rating", "expected_gap") if kind == "game" else ("tournament", "home_id", "home_rating", "away_rating", "games", "last_at", "last_event")
    return sorted((tuple(r[c] for c in keep) for r in df.where(f"kind = '{kind}'").collect()), key=repr)


def test_ratings_in_parts_equal_one_replay(spark, tmp_path):
    games = [(*g[:6], g[6]) for name, seed in (("a", 1), ("b", 2)) for g in league(name, 150, list(range(7)), seed, 1000 * seed)] + [(g[0], *g[1:6], None) for g in league("x", 40, [1, 2, 3], 9, 9000)]
    df = spark.createDataFrame(games, GAMES).repartition(5)
    whole = goals.fold_ratings(df)
    folder = str(tmp_path / "ratings")
    assert goals.read_ratings(spark, folder) is None
    cuts = [T0, T0 + timedelta(days=50), T0 + timedelta(days=51), T0 + timedelta(days=500)]
    parts = [goals.advance_ratings(df.where((F.col("kickoff") >= F.lit(a)) & (F.col("kickoff") < F.lit(b))), folder) for a, b in zip(cuts, cuts[1:])]
    assert sorted((r for p in parts for r in rows(p, "game")), key=repr) == rows(whole, "game")
    assert rows(parts[-1], "state") == rows(whole, "state") and len(rows(whole, "state")) == 17
    old = {g["event_id"]: g for g in models.pi_ratings(df).collect()}
    for _, event, h, a, gap in rows(whole, "game"):
        assert (h, a, gap) == pytest.approx((old[event]["home_rating"], old[event]["away_rating"], old[event]["expected_gap"]))


def test_games_of_the_past_are_late_and_change_nothing(spark, tmp_path):
    df = spark.createDataFrame(league("a", 60, list(range(5)), 3), GAMES)
    folder = str(tmp_path / "ratings")
    first = goals.advance_ratings(df, folder)
    again = goals.advance_ratings(df.limit(20), folder)
    assert again.where("kind = 'late'").count() == 20 and again.where("kind = 'game'").count() == 0
    assert rows(again, "state") == rows(first, "state")
    assert goals.fold_ratings(df.limit(0)).collect() == []
