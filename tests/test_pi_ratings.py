"""Pi ratings against a plain fold, over batches smaller than a league, and without a frame of a whole league."""

import math
from datetime import datetime, timedelta
import random

from matchlake.plans import models

T0 = datetime(2026, 1, 1, 12)


def brute(games):
    rating, out = {}, {}
    expected = lambda r: math.copysign(10 ** (abs(r) / 3) - 1, r)
    for e, home, away, hg, ag, k, league in sorted(games, key=lambda g: (g[5], g[0])):
        at = lambda team, side: rating.get((league, team, side), 0.0)  # noqa: E731, B023
        hh, ha, ah, aa = at(home, "H"), at(home, "A"), at(away, "H"), at(away, "A")
        gap = expected(hh) - expected(aa)
        out[e] = (hh, aa, gap)
        error = hg - ag - gap
        step = math.copysign(3 * math.log10(1 + abs(error)), error)
        rating |= {(league, home, "H"): hh + step * 0.035, (league, away, "A"): aa - step * 0.035, (league, home, "A"): ha + step * 0.035 * 0.7, (league, away, "H"): ah - step * 0.035 * 0.7}
    return out


def test_batches_of_a_sorted_stream(spark):
    r = random.Random(3)
    games = []
    for i in range(300):
        home, away = r.sample(range(9), 2)
        games.append((i, home, away, r.randint(0, 4), r.randint(0, 4), T0 + timedelta(days=r.randint(0, 60)), r.choice([None, "a", "b", "c"])))
    df = spark.createDataFrame(games, "event_id long, home_id long, away_id long, home_goals int, away_goals int, kickoff timestamp, tournament string").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        x = models.pi_ratings(df)
        got = {g["event_id"]: (g["home_rating"], g["away_rating"], g["expected_gap"]) for g in x.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute(games)
    assert got.keys() == want.keys() and all(math.isclose(a, b, abs_tol=1e-9) for e in want for a, b in zip(got[e], want[e], strict=True))
    assert "FlatMapGroupsInPandas" not in x._jdf.queryExecution().toString()
