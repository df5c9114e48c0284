"""Operators that stand for a join of pairs, against that join, and without its pairs in their plans."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from matchlake.operators import links
from matchlake.plans import boards

T0 = datetime(2026, 1, 1, 12)


def _events(seed, n, first="row_id", leagues=("x", "y", None), blank=0.05):
    r = random.Random(seed)
    some = lambda v: None if r.random() < blank else v
    rows = [(i, some(f"h{r.randint(0, 4)}"), some(f"a{r.randint(0, 4)}"), r.choice(leagues), some(T0 + timedelta(milliseconds=500 * r.randint(0, 2400)))) for i in range(n)]
    return rows, f"{first} long, home_key string, away_key string, league string, kickoff timestamp"


@pytest.mark.parametrize("seed", [1, 2])
def test_overlap_reasons_against_all_pairs(spark, seed):
    rows, schema = _events(seed, 300)
    targets, target_schema = _events(seed + 10, 40, "event_id")
    targets = [t for t in targets if t[1] != "h4" and t[2] != "a4"]
    homes, aways = {t[1] for t in targets}, {t[2] for t in targets}
    want = Counter()
    for _, h, a, league, at in rows:
        found = [t for t in targets if h is not None and a is not None and (t[1], t[2]) == (h, a) and t[4] is not None]
        why = ["1_NO_HOME" if h is None or h not in homes else "2_NO_AWAY" if a is None or a not in aways else "3_NO_PAIR"]
        if why == ["3_NO_PAIR"]:
            for t in found:
                agrees = league is None or t[3] is None or league == t[3]
                why.append("4_LEAGUE" if not agrees else "5_CLOCK" if at is not None and abs(at - t[4]) > timedelta(seconds=60) else "6_LINK")
        want[max(why)] += 1
    assert len(want) == 6
    got = boards.overlap_diagnostics(spark.createDataFrame(rows, schema), spark.createDataFrame(targets, target_schema))
    assert {r["reason"]: r["n"] for r in got.collect()} == want


def test_overlap_of_one_pair_is_counted_without_its_pairs(spark):
    same = lambda n, c: spark.range(n).select(F.col("id").alias(c), F.lit("h").alias("home_key"), F.lit("a").alias("away_key"), F.lit("x").alias("league"), F.timestamp_seconds(F.col("id") * 2).alias("kickoff"))
    got = boards.overlap_diagnostics(same(200_000, "row_id"), same(200_000, "event_id"), 100_000).collect()  # 2 * 10^10 pairs
    assert [(r["reason"], r["n"]) for r in got] == [("6_LINK", 200_000)]


@pytest.mark.parametrize("seed", [3, 4])
def test_map_exact_against_all_pairs(spark, seed):
    r = random.Random(seed)
    at = lambda: T0 + timedelta(milliseconds=400 * r.randint(0, 9000))
    fixtures = [(i, f"h{r.randint(0, 3)}", f"a{r.randint(0, 3)}", None if i == 7 else at()) for i in range(250)]
    board = [(f"h{r.randint(0, 2)}", f"a{r.randint(0, 3)}", at(), f"s{i}") for i in range(60)]
    board += [(h, a, k + timedelta(milliseconds=d), f"t{i}") for i, ((h, a, k, _), d) in enumerate(zip(board[:30], [0, 400, 1200] * 10))]
    want = {}
    for e, h, a, k in fixtures:
        c = sorted((abs(k - b[2]), b[3]) for b in board if (b[0], b[1]) == (h, a) and abs(k - b[2]) <= timedelta(minutes=4)) if k else []
        tie = len([1 for g, _ in c if g - c[0][0] < timedelta(seconds=1)]) > 1
        want[e] = (None, "UNMAPPED") if not c else (None, "AMBIGUOUS") if tie else (c[0][1], "VERIFIED")
    assert {w[1] for w in want.values()} == {"UNMAPPED", "AMBIGUOUS", "VERIFIED"}
    got = links.map_exact(spark.createDataFrame(fixtures, "event_id long, home string, away string, kickoff timestamp"), spark.createDataFrame(board, "home string, away string, kickoff timestamp, source_id string"), 240)
    assert {x["event_id"]: (x["source_id"], x["status"]) for x in got.collect()} == want


@pytest.mark.parametrize("seed", [5, 6])
def test_static_links_against_all_pairs(spark, seed):
    rows, schema = _events(seed, 600)
    targets, target_schema = _events(seed + 10, 60, "event_id")
    targets = [t for t in targets if t[1] != "h4"]
    rows = [(*x, f"u{x[0] // 2}" if x[0] % 9 else f"v{x[0]}") for x in rows]
    ok = lambda x, t: (x[3] is None or t[3] is None or x[3] == t[3]) and None not in (x[4], t[4]) and abs(x[4] - t[4]) <= timedelta(seconds=60)
    pair = lambda x, t: None not in x[1:3] and x[1:3] == t[1:3]
    c = [(x, t) for x in rows for t in targets if pair(x, t) and ok(x, t)]
    n_row, n_event, n_url = Counter(x[0] for x, _ in c), Counter(t[0] for _, t in c), Counter(x[5] for x, _ in c)
    good = {(x[0], t[0]) for x, t in c if n_row[x[0]] == n_event[t[0]] == n_url[x[5]] == 1}
    why = {x[0]: "NO_NAME_PAIR" if not any(pair(x, t) for t in targets) else "LEAGUE_OR_CLOCK" if n_row[x[0]] == 0 else "AMBIGUOUS" if n_row[x[0]] > 1 else "REPEATED" for x in rows if x[0] not in dict(good)}
    assert good and len(set(why.values())) == 4
    yes, no = links.link_static(spark.createDataFrame(rows, schema + ", url string"), spark.createDataFrame(targets, target_schema), 60)
    assert {tuple(r) for r in yes.collect()} == good and {r["row_id"]: r["reason"] for r in no.collect()} == why


def test_static_links_of_one_pair_make_no_pairs(spark):
    same = lambda n, c: spark.range(n).select(F.col("id").alias(c), F.lit("h").alias("home_key"), F.lit("a").alias("away_key"), F.lit("x").alias("league"), F.timestamp_seconds(F.col("id") * 2).alias("kickoff"))
    yes, no = links.link_static(same(100_000, "row_id").withColumn("url", F.col("row_id")), same(100_000, "event_id"), 400_000)  # 10^10 pairs
    assert yes.count() == 0 and [tuple(r) for r in no.groupBy("reason").count().collect()] == [("AMBIGUOUS", 100_000)]


def test_exact_map_of_one_pair_makes_no_pairs(spark):
    x = spark.range(100_000).select(F.col("id").alias("event_id"), F.lit("h").alias("home"), F.lit("a").alias("away"), F.timestamp_seconds(F.col("id") * 2).alias("kickoff"))
    got = links.map_exact(x, x.select("home", "away", "kickoff", F.col("event_id").alias("source_id")), 400_000)  # 10^10 pairs
    assert [tuple(r) for r in got.where("source_id = event_id").groupBy("status").count().collect()] == [("VERIFIED", 100_000)]


def _games(seed, n):
    r = random.Random(seed)
    return [(i, r.randint(0, 3), r.randint(0, 3), T0 + timedelta(hours=r.randint(0, 60)), "t", 1, 2) for i in range(n)]


GAMES = "event_id long, home_id long, away_id long, kickoff timestamp, tournament string, home_goals long, away_goals long"


@pytest.mark.parametrize("same_side", [True, False])
def test_history_counts_against_the_join(spark, same_side):
    res = spark.createDataFrame(_games(8, 150), GAMES)
    rows = links.to_team_rows(res)
    want = links.team_history(res, rows, same_side=same_side).groupBy("event_id", "side").agg(F.count("*").alias("n"), F.min("past_id").alias("first_id"))
    got = links.history_counts(res, rows, same_side)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 200


def test_history_counts_of_one_team_make_no_pairs(spark):
    x = spark.range(200_000).select(F.col("id").alias("event_id"), F.lit(1).alias("home_id"), F.lit(2).alias("away_id"), F.timestamp_seconds("id").alias("kickoff"), F.lit("t").alias("tournament"), F.lit(0).alias("home_goals"), F.lit(0).alias("away_goals"))
    got = links.history_counts(x, links.to_team_rows(x), same_side=True)  # 4 * 10^10 pairs
    assert got.where("n = event_id AND first_id = 0").count() == 2 * 199_999


def test_last_meetings_against_the_join(spark):
    res = spark.createDataFrame(_games(9, 200), GAMES)
    pairs = sorted(map(tuple, links.h2h_pairs(res, res).select("event_id", "past_at", "past_id").collect()), key=lambda p: (p[0], -p[1].timestamp(), p[2]))
    want, n = [], Counter()
    for e, at, past in pairs:
        n[e] += 1
        want += [(e, past, at, n[e])] if n[e] <= 5 else []
    assert sorted(map(tuple, links.last_meetings(res, res, 5).collect())) == sorted(want) and max(n.values()) > 5


def test_last_meetings_of_one_pair_make_no_pairs(spark):
    x = spark.range(200_000).select(F.col("id").alias("event_id"), F.lit(1).alias("home_id"), F.lit(2).alias("away_id"), F.timestamp_seconds("id").alias("kickoff"))
    assert links.last_meetings(x, x, 2).where("past_id = event_id - r").count() == 199_999 + 199_998


def test_more_proven_rows_than_the_cap_share_it_by_priority(spark):
    rows = spark.range(9).select(F.col("id").alias("event_id"), (F.col("id") / 10).alias("home_similarity"), F.lit(0.9).alias("away_similarity"))
    got = boards.cap_by_priority(rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1"), 3, strict=False).collect()
    assert [r["event_id"] for r in got] == [8, 6, 4]
