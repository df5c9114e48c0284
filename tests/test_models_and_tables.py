"""Goal model, rating probabilities, odds tables and market fields against plain versions and planted cases."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from matchlake.functions import exprs as E
from matchlake.plans import context, models
from matchlake.sources import feeds

T0 = datetime(2026, 1, 1, 12)
GAMES = "event_id long, home_id long, away_id long, home_goals int, away_goals int, kickoff timestamp, tournament string"


def grid(lh, la, rho, n=10):
    pmf = lambda lam, k: math.exp(-lam) * lam**k / math.factorial(k)
    rho = max(min(rho, 1.0, 1 / (lh * la)), -1 / lh, -1 / la)
    tau = {(0, 0): 1 - lh * la * rho, (0, 1): 1 + lh * rho, (1, 0): 1 + la * rho, (1, 1): 1 - rho}
    return {(i, j): pmf(lh, i) * pmf(la, j) * tau.get((i, j), 1.0) for i in range(n + 1) for j in range(n + 1)}


@pytest.mark.parametrize("rho", [-0.2, -0.06, 0.0, 0.15, 0.9])
def test_low_scores_are_corrected_as_on_the_grid(spark, rho):
    means = [(1.4, 1.1), (0.3, 2.9), (3.2, 0.4), (2.5, 2.5)]
    x = spark.createDataFrame(means, "lh double, la double").select("lh", "la", E.poisson_hda(F.col("lh"), F.col("la"), rho=rho).alias("p"), E.poisson_over(F.col("lh"), F.col("la")).alias("over"))
    for r in x.collect():
        p = grid(r["lh"], r["la"], rho)
        assert min(p.values()) >= -1e-12
        total = sum(p.values())
        want = [sum(v for (i, j), v in p.items() if f(i, j)) / total for f in (lambda i, j: i > j, lambda i, j: i == j, lambda i, j: i < j)]
        assert [r["p"][k] for k in "hda"] == pytest.approx(want, abs=1e-9)
        assert r["over"] == pytest.approx(sum(v for (i, j), v in grid(r["lh"], r["la"], 0.0, 40).items() if i + j > 2), abs=1e-9)


def test_rho_is_the_likeliest_of_the_grid(spark):
    r = random.Random(5)
    rows = [(r.randint(0, 2), r.randint(0, 2), r.uniform(0.8, 1.8), r.uniform(0.6, 1.6), r.uniform(0.2, 1)) for _ in range(500)]
    df = spark.createDataFrame(rows, "home_goals int, away_goals int, lh double, la double, weight double")

    def likelihood(rho):
        out = 0.0
        for h, a, lh, la, w in rows:
            if h < 2 and a < 2:
                out += w * math.log(max({(0, 0): 1 - lh * la * rho, (0, 1): 1 + lh * rho, (1, 0): 1 + la * rho, (1, 1): 1 - rho}[h, a], 1e-9))
        return out

    assert context.low_score_rho(df) == max(context.RHO, key=likelihood)
    assert context.low_score_rho(df.where("1 = 0")) == 0.0


def league(n, seed=1):
    r = random.Random(seed)
    games = []
    for i in range(n):
        home, away = r.sample(range(6), 2)
        games.append((i, home, away, r.randint(0, 2) + (home == 0), r.randint(0, 2), T0 + timedelta(days=i), "a"))
    return games


def test_goal_model_gates_and_probabilities(spark):
    games = league(200) + [(900, 7, 1, 1, 0, T0, "a")]
    res = spark.createDataFrame(games, GAMES)
    fixtures = spark.createDataFrame([(1000, 0, 1, T0), (1001, 1, 0, T0), (1002, 7, 1, T0), (1003, 99, 1, T0)], "event_id long, home_id long, away_id long, kickoff timestamp").withColumn("tournament", F.lit("a"))
    now = F.lit(T0 + timedelta(days=300))
    got = {r["event_id"]: r for r in context.goal_glm(res, fixtures, now).collect()}
    assert set(got) == {1000, 1001}  # team 7 has one game, team 99 none
    assert all(abs(r["h"] + r["d"] + r["a"] - 1) < 1e-9 and 0 < r["over25"] < 1 for r in got.values())
    assert got[1000]["h"] > got[1001]["h"] and got[1000]["lh"] > got[1001]["lh"]
    few = context.goal_glm(res, fixtures, F.lit(T0 + timedelta(days=100)))
    assert few.collect() == [] and few.columns == ["event_id", "lh", "la", "h", "d", "a", "over25"]


def test_gap_probabilities_count_what_was_before(spark):
    games = league(300, 2)
    res = spark.createDataFrame(games, GAMES)
    ratings = models.pi_ratings(res).cache()
    gap = {r["event_id"]: r["expected_gap"] for r in ratings.collect()}
    at = lambda e: math.floor(max(-3.0, min(3.0, gap[e])) / 0.25)
    cut = T0 + timedelta(days=200)
    count = {}
    for e, _, _, hg, ag, k, _ in games:
        if k < cut:
            count.setdefault(at(e), [0, 0, 0])[0 if hg > ag else 1 if hg == ag else 2] += 1
    got = models.gap_probabilities(ratings, res, F.lit(cut)).collect()
    assert {r["event_id"] for r in got} == {g[0] for g in games if g[5] >= cut}
    for r in got:
        n = count.get(at(r["event_id"]), [0, 0, 0])
        assert [r["h"], r["d"], r["a"]] == pytest.approx([(c + 1) / (sum(n) + 3) for c in n])


def test_odds_table_carries_the_league_and_leaves_out_what_is_not_open(spark):
    row = lambda *c: "<tr>" + "".join(f"<td>{x}</td>" for x in c) + "</tr>"
    html = "<table>" + "".join([
        row("12:00", "early", "-", "bird", "", "b", "2.0", "3.0", "4.0", "5%"), row("<b>Cup</b> of", "Ice"), row("BN", "1", "X", "2", "Margin"),
        row("13:30", " a ", "-", "<i>b</i>", "", "x", "1.5", "4.1", "6", "5%"), row("13:31", "c", "-", "d", "In-play", "x", "1.5", "4.1", "6", "5%"), row("13:32", "e", "-", "f", "Finished", "x", "1.5", "4.1", "6", "5%"),
        row("13:33", "g", "-", "h", "", "x", "1.5", "n/a", "6", "5%"), row("13:34", "", "-", "j", "", "x", "1.5", "4", "6", "5%"), row("13:35", "k", "-", "l"), row("13:36", "k", "-", "l", "", "x", "0", "4", "6", "5%"),
    ]) + "</table>"
    pages = spark.createDataFrame([(1, html), (2, None), (3, ""), (4, row("9:05", "p", "-", "q", "", "y", "2", "3", "4", "1%"))], "page_id long, html string")
    got = sorted((r["page_id"], r["league"], r["clock"], r["home"], r["away"], r["book"], r["odds_home"], r["odds_draw"], r["odds_away"]) for r in feeds.odds_table(pages).collect() if r["league"])
    assert got == [(1, "Cup of Ice", "13:30", "a", "b", "x", 1.5, 4.1, 6.0)]
    assert {(r["page_id"], r["home"]) for r in feeds.odds_table(pages).where("league IS NULL").collect()} == {(1, "early"), (4, "p")}


@pytest.mark.parametrize("text, want", [
    ("43 57Over5 - 510.5959°F-", (43, 57, "Over", 5, 5, 10.59)),
    ("60% 40% under 1 - 0 2.10", (60, 40, "Under", 1, 0, 2.10)),
    ("60% 41% under 1 - 0 2.10", (None,) * 6),  # no pair of 100
    ("7 12 30% 70% soon", (30, 70, None, None, None, None)),
    ("none here", (None,) * 6), ("", (None,) * 6), (None, (None,) * 6), ("55", (None,) * 6),
])
def test_market_fields(spark, text, want):
    r = feeds.market_fields(spark.createDataFrame([(text,)], "after string")).first()
    assert tuple(r[c] for c in ("under", "over", "prediction", "home_score", "away_score", "average")) == want
