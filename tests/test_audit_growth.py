"""The audit of targets against all pairs of targets and rows, and without them."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from matchlake.plans import intersection as A

T0 = datetime(2026, 1, 1, 12)


def _why(t, obs, published, tolerance):
    e, league, h, a, at = t
    off = lambda o: abs(o[3] - at)
    clocked = [o for o in obs if o[3] is not None]
    pair = [o for o in clocked if None not in (h, a) and (o[1], o[2]) == (h, a)]
    near = sorted(o for o in pair if o[4] and off(o) <= tolerance)
    apart = sorted((off(o), o[0]) for o in pair if o[4])
    one = [o[0] for o in clocked if ((h is not None and o[1] == h) or (a is not None and o[2] == a)) and (o[1], o[2]) != (h, a) and off(o) <= tolerance]
    if e in published:
        return "VERIFIED_PUBLISHED", None
    if len(near) > 1:
        return "MULTIPLE_SOURCE_PAIRS_AT_KICKOFF", near[0][0]
    if near:
        return "KNOWN_LEAGUE_CONFLICT" if near[0][5] == "E" and league != "l1" else "PAIR_AND_TIME_UNPUBLISHED", near[0][0]
    if apart:
        return "VERIFIED_PAIR_DIFFERENT_KICKOFF", apart[0][1]
    if pair:
        return "PAIR_WITH_INVALID_SOURCE_MODEL_OR_CLOCK", None
    if one:
        return "ONE_VERIFIED_TEAM_AT_SAME_KICKOFF", min(one)
    return ("OTHER_SOURCE_MATCHES_AT_SAME_KICKOFF" if any(off(o) <= tolerance for o in clocked) else "NO_SOURCE_OBSERVATION_AT_KICKOFF"), None


TARGETS = "event_id long, league string, home_key string, away_key string, kickoff timestamp"
OBSERVED = "row_id long, home_key string, away_key string, clock timestamp, fields_ok boolean, league_code string"


def test_reasons_against_all_pairs(spark):
    r, seen = random.Random(5), set()
    for _ in range(3):
        key = lambda k, n: None if r.random() < 0.05 else f"{k}{r.randint(0, n)}"
        at = lambda: T0 + timedelta(seconds=30 * r.randint(1, 2000))
        targets = [(i, r.choice(["l1", "l2"]), key("h", 9), key("a", 9), at()) for i in range(250)]
        again = [(h, a, k + timedelta(milliseconds=r.choice([0, 0, 59_900, 60_400]))) for _, _, h, a, k in targets[::4]]
        rows = again + again[::5] + [(h, "other", k) for h, _, k in again[::3]] + [(key("h", 6), key("a", 9), None if r.random() < 0.1 else at()) for _ in range(60)]
        obs = [(i, *x, r.random() < 0.7, r.choice(["E", "q"])) for i, x in enumerate(rows)]
        published = {t[0] for t in targets if t[0] % 9 == 0}
        want = {t[0]: _why(t, obs, published, timedelta(seconds=60)) for t in targets}
        p = spark.createDataFrame([(e,) for e in published], "event_id long")
        got = A.classify_targets(spark.createDataFrame(targets, TARGETS), spark.createDataFrame(obs, OBSERVED), p, F.lit(T0), known={"E": ("l1",)}).collect()
        assert {x["event_id"]: (x["reason"], x["row_id"]) for x in got} == want and len(got) == 250
        seen |= {w[0] for w in want.values()}
    assert len(seen) == 9


def test_one_pair_makes_no_pairs(spark):
    n = 150_000
    t = spark.range(n).select(F.col("id").alias("event_id"), F.lit("l1").alias("league"), F.lit("h").alias("home_key"), F.lit("a").alias("away_key"), F.timestamp_seconds(F.col("id") + 1).alias("kickoff"))
    o = t.select((F.col("event_id")).alias("row_id"), "home_key", "away_key", (F.col("kickoff") - F.expr("INTERVAL 100 DAYS")).alias("clock"), F.lit(True).alias("fields_ok"), F.lit("E").alias("league_code"))
    got = A.classify_targets(t, o, t.where("false"), F.timestamp_seconds(F.lit(0)), 24 * 365)  # 2 * 10^10 pairs
    assert [tuple(r) for r in got.groupBy("reason").agg(F.count("*"), F.min("row_id")).collect()] == [("VERIFIED_PAIR_DIFFERENT_KICKOFF", n, n - 1)]
