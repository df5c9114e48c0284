"""Registered queries and their operators do the whole job: all rows in, held against brute force."""

from collections import defaultdict
from datetime import datetime, timedelta
import random

import pytest
from pyspark.sql import functions as F

from matchlake import queries as Q
from matchlake import queries_boards, queries_links, queries_more  # noqa: F401  they register their queries
from matchlake import testdata as T
from matchlake.plans import context

SF = "/root/testdata/sf0.001"
T0 = datetime(2026, 1, 1, 12)


def connected(games, targets, hops, stop, cap):
    out = set()
    for e, home, away in targets:
        reach = {home, away}
        for _ in range(hops):
            found = [g for g in games if reach & {g[1], g[2]}]
            if len(found) < stop:
                reach |= {k for g in found for k in g[1:3]}
        found = sorted((g for g in games if reach & {g[1], g[2]}), key=lambda g: (-g[3].timestamp(), g[0]))
        out |= {(e, g[0]) for g in found[:cap]}
    return out


@pytest.mark.parametrize("hops, stop, cap", [(3, 12, 15), (1, 30, 9), (2, 40, 500), (3, 450, 500)])
def test_connected_history(spark, hops, stop, cap):
    r = random.Random(hops)
    games = []
    for i in range(70):  # a chain of teams, with clubs that play each other often
        a = r.randint(0, 25)
        games.append((i, a, a + r.choice([1, 1, 2]), T0 + timedelta(days=r.randint(0, 20))))
    res = spark.createDataFrame(games, "event_id long, home_id long, away_id long, kickoff timestamp")
    targets = [(100 + i, r.randint(0, 27), r.randint(0, 27)) for i in range(30)] + [(200, 3, 4), (201, 4, 3), (202, 90, 91)]
    got = context.connected_history(res, spark.createDataFrame(targets, "event_id long, home_id long, away_id long"), hops, stop, cap).collect()
    assert {(x["event_id"], x["past_id"]) for x in got} == connected(games, targets, hops, stop, cap)
    assert len(got) == len({(x["event_id"], x["past_id"]) for x in got})


def test_connected_history_query_has_all_fixtures(spark):
    games = [tuple(x) for x in T.results(spark, SF).select("event_id", "home_id", "away_id", "kickoff").collect()]
    got = Q.QUERIES["j13_connected_history"](spark, SF)
    n = {x["event_id"]: x["n"] for x in got.groupBy("event_id").agg(F.count("*").alias("n")).collect()}
    assert n == {g[0]: 500 for g in games}
    some = [g[:3] for g in games[::300]]
    assert {(x["event_id"], x["past_id"]) for x in got.where(F.col("event_id").isin([s[0] for s in some])).collect()} == connected(games, some, 3, 450, 500)
