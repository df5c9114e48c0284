"""Links whose rows meet few others where many could be met, against the links of all pairs."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from matchlake.operators import likeness, links
from matchlake.plans import boards

T0 = datetime(2026, 1, 1, 12)


def _row_joins(df, column: str) -> int:
    """Joins of the plan that move rows with a column of this name."""
    found, todo = 0, [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        found += node.nodeName() == "Join" and f"{column}#" in node.output().mkString(",")
    return found


def test_overlap_rows_move_in_three_joins(spark):
    rows = spark.createDataFrame([(1, "h", None, "x", T0), (2, None, "a", "x", T0), (3, "h", "a", "x", T0), (4, "h", "a", "z", T0), (5, "h", "b", "x", T0)], "row_id long, home_key string, away_key string, league string, kickoff timestamp")
    targets = spark.createDataFrame([(1, "h", "a", "x", T0), (2, "g", "b", None, T0)], "event_id long, home_key string, away_key string, league string, kickoff timestamp")
    got = boards.overlap_diagnostics(rows, targets)
    assert {r["reason"]: r["n"] for r in got.collect()} == {"1_NO_HOME": 1, "2_NO_AWAY": 1, "6_LINK": 1, "4_LEAGUE": 1, "3_NO_PAIR": 1}
    assert _row_joins(got, "row_id") == 3


NAMES = ["red star", "red stars", "blue sky", "blue skye", "lone wolf", "north end", "northend", "", None]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("profile", ["live", "odds"])
def test_links_told_by_names_against_all_candidates(spark, seed, profile):
    r = random.Random(seed)
    some = lambda n, k: [(i, r.choice(NAMES), r.choice(NAMES), None if r.random() < 0.05 else T0 + timedelta(seconds=30 * r.randint(0, 2000))) for i in range(n)]
    schema = "{} long, home string, away string, kickoff timestamp"
    rows, targets = spark.createDataFrame(some(200, 0), schema.format("row_id")), spark.createDataFrame(some(150, 0), schema.format("event_id"))
    p = links.PROFILES[profile]
    key = lambda df: Counter((x["row_id"], x["event_id"], round(x["score"], 9), x["linked"]) for x in df.collect())
    want = key(links.link_fuzzy(rows, targets, p))
    assert len(want) > 60
    assert key(links.link_fuzzy(rows, targets, p, runner_up=False)) == want
    assert links._told_by_names(rows, targets, p).count() > 5


def test_rows_told_by_names_do_not_meet_all_of_their_clock(spark):
    t = spark.range(60_000).select("id", F.concat(F.lit("club of "), F.md5((F.col("id") % 50).cast("string").cast("binary"))).alias("home"), F.concat(F.lit("town of "), F.md5((F.col("id") % 1201).cast("string").cast("binary"))).alias("away"), F.timestamp_seconds(F.lit(1_800_000_000) + F.col("id") % 60).alias("kickoff"))
    got = links.link_fuzzy(t.withColumnRenamed("id", "row_id"), t.withColumnRenamed("id", "event_id"), links.PROFILES["live"], runner_up=False)  # 3.6 * 10^9 pairs
    assert got.where("linked AND row_id = event_id").count() == 60_000


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_provisional_links_against_all_pairs(spark, seed):
    r = random.Random(seed)
    names = ["alpha", "alphas", "beta", "betas", "gamma town", "gamma city", "delta", "omega", "zeta"]
    some = lambda v: None if r.random() < 0.05 else v
    make = lambda n: [(i, some(r.choice(names)), some(r.choice(names)), some(r.choice("xyz")), T0 + timedelta(hours=r.randint(0, 6))) for i in range(n)]
    rows, targets = make(120), make(100)
    verified = [("alpha", "alpha"), ("alpha", "alphas"), ("beta", "betas"), ("beta", "betas"), ("delta", "delta"), (None, "omega")]
    sim = lambda a, b: 0.0 if not a or not b else 1.0 if a == b else max(0.94, min(len(a), len(b)) / max(len(a), len(b))) if min(len(a), len(b)) >= 4 and (a in b or b in a) else 1 - _edits(a, b) / max(len(a), len(b))
    pairs = []
    for i, h, a, league, at in rows:
        for e, th, ta, its, clock in targets:
            if league is not None and (league, at) == (its, clock):
                vh, va = h is not None and (h, th) in verified, a is not None and (a, ta) in verified
                s = sorted((sim(h, th), sim(a, ta)))
                kind = "ONE_SIDE" if vh != va else "SIMILARITY" if not vh and s[0] >= 0.3 and s[1] >= 0.7 else None
                pairs += [(kind, i, e)] if kind else []
    n_row, n_event = Counter((k, i) for k, i, _ in pairs), Counter((k, e) for k, _, e in pairs)
    alone = sorted(p for p in pairs if n_row[p[0], p[1]] == 1 and n_event[p[0], p[2]] == 1)
    first = lambda at: {min(p for p in alone if p[at] == k) for k in {p[at] for p in alone}}
    want = {(i, e, k) for k, i, e in first(1) & first(2)}
    assert {k for *_, k in want} == {"ONE_SIDE", "SIMILARITY"}
    df = lambda x, c: spark.createDataFrame(x, f"{c} long, home string, away string, league string, kickoff timestamp")
    got = boards.provisional_links(df(rows, "row_id"), df(targets, "event_id"), spark.createDataFrame(verified, "name string, target_name string"))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def _edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_rows_of_one_clock_do_not_meet_all_its_targets(spark):
    t = spark.range(100_000).select("id", F.concat(F.lit("club of town "), F.col("id") % 30).alias("home"), F.concat(F.lit("club of city "), F.col("id") % 29).alias("away"), F.lit("x").alias("league"), F.timestamp_seconds(F.lit(0)).alias("kickoff"))
    names = spark.range(30).select(F.concat(F.lit("club of town "), "id").alias("name"), F.concat(F.lit("club of town "), "id").alias("target_name"))
    got = boards.provisional_links(t.withColumnRenamed("id", "row_id"), t.withColumnRenamed("id", "event_id"), names)  # 10^10 pairs
    assert got.count() == 0


@pytest.mark.parametrize("profile,seed", [("live", 1), ("player", 3)])
def test_anchored_links_told_by_names_against_all_candidates(spark, profile, seed, monkeypatch):
    r = random.Random(seed)
    homes, aways = ["red star belgrade", "red stars belgrade", "rad stor belgrade", "lone wolf", "lone wolves", "lone wolf united", "northern end", "nothern end", "", None], ["blue sky", "blue skye", "blau sky", "old town", ""]
    at = lambda: None if r.random() < 0.2 else T0 + timedelta(seconds=30 * r.randint(0, 2500))
    some = lambda n: [(i, r.choice(homes), r.choice(aways), at()) for i in range(n)]
    schema = "{} long, home string, away string, kickoff timestamp"
    turn = lambda x: [(i, a, h, k) for i, h, a, k in x] if seed == 3 else x
    games = turn(some(25))
    near = [(200 + i, h, a, k and k + timedelta(minutes=1)) for i, h, a, k in games]
    rows, targets = spark.createDataFrame(turn(some(150)) + near, schema.format("row_id")), spark.createDataFrame(games, schema.format("event_id"))
    p, told, real = likeness.ANCHORED[profile], [], likeness._Anchored.told
    monkeypatch.setattr(likeness._Anchored, "told", lambda self, c, floor: told.append(real(self, c, floor)) or told[-1])
    key = lambda df: Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in x) for x in df.drop("runner_up").collect())
    want = key(likeness.link_anchored(rows, targets, p))
    assert not told and sum(want.values()) == 175 and len({x[-1] for x in want}) > 2
    assert key(likeness.link_anchored(rows, targets, p, runner_up=False)) == want
    assert 5 < sum(x.count() for x in told) < 175 and len(told) == (2 if profile == "live" else 1)


def test_rows_without_a_clock_do_not_meet_all_targets_of_a_name(spark):
    club = lambda n: F.substring(F.md5((F.col("id") % n).cast("string").cast("binary")), 1, 14)
    t = spark.range(60_000).select("id", club(20_000).alias("home"), club(3).alias("away"), F.timestamp_seconds(F.lit(1_800_000_000) + 60 * F.col("id")).alias("kickoff"))
    rows = t.withColumnRenamed("id", "row_id").withColumn("kickoff", F.lit(None).cast("timestamp"))
    got = likeness.link_anchored(rows, t.withColumnRenamed("id", "event_id"), likeness.ANCHORED["live"], runner_up=False)  # 1.2 * 10^9 pairs of one away name
    assert [tuple(x) for x in got.groupBy("status", "hs", "as_").count().collect()] == [("LINKED", 1.0, 1.0, 60_000)]


@pytest.mark.parametrize("told", [True, False])
def test_book_bests_against_all_candidates(spark, told, monkeypatch):
    r = random.Random(4)
    homes, aways = ["abcdefghij", "abcdefghxy", "abcdefgxyz", "abcdexghij", "mnopqrstuv", "mnopqrsxyz", "zzzz", "", None], ["klmnopqrst", "klmnopqrsx", "klmnopqxyz", "fedcbahgji"]
    some = lambda n: [(i, r.choice(homes), r.choice(aways)) for i in range(n)]
    rows, targets = (some(60), some(40)) if not told else ([(i, "abcdefghij"[i:] + "mnopqrstuv"[:i] + "w", "klmnopqrst") for i in range(0, 10, 3)], [(i, "abcdefghij"[i:] + "mnopqrstuv"[:i], "klmnopqrst") for i in range(0, 10, 3)])
    rows, targets = spark.createDataFrame(rows, "row_id int, home string, away string"), spark.createDataFrame(targets, "event_id int, home string, away string")
    p, floors, real = likeness.PROFILES["book"], [], likeness.similar_names
    every = [(x["row_id"], x["event_id"], round(x["score"], 9)) for x in likeness.pair_candidates(rows, targets, p.floor).where(F.col("score") >= p.accept).collect()]
    monkeypatch.setattr(likeness, "similar_names", lambda a, b, floor, *x, **y: floors.append(floor) or real(a, b, floor, *x, **y))
    got = [(x["row_id"], x["event_id"], round(x["score"], 9)) for x in likeness._best_candidates(rows, targets, p).collect()]
    assert floors == ([p.accept] * 2 if told else [p.accept] * 2 + [p.floor] * 2) and len(got) == len(set(got)) and set(got) <= set(every) and every
    best = lambda c, k: {x[k]: min((-y[2], y[1 - k]) for y in c if y[k] == x[k]) for x in c}
    assert best(got, 0) == best(every, 0) and best(got, 1) == best(every, 1)
