"""Registered queries over gates, boards, registries, guards and audits that the other modules leave."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchlake import testdata as T
from matchlake.functions import exprs as E
from matchlake.operators import gates as G
from matchlake.operators import identity as I
from matchlake.operators import links as L
from matchlake.operators import rollups as R
from matchlake.operators import state as S
from matchlake.plans import audits as A
from matchlake.plans import boards as B
from matchlake.plans import context as C
from matchlake.queries import NOW, OUTCOME, ROLLUP, _rollup, query, r6
from matchlake.queries_boards import JUNE
from matchlake.streaming import live as V

#: A registry of names with a status, as SQL and as a table.
MASTER = ROLLUP + """, master AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY source, name_key) > 1 THEN 'AMBIGUOUS' WHEN n_events >= 2 OR name_key = entity OR confidence >= 0.93 THEN 'VERIFIED' ELSE 'CANDIDATE' END AS status FROM rollup_)"""


def _master(spark, sf):
    return R.classify_alias(_rollup(spark, sf))


def _mins(n):
    return F.make_interval(mins=F.lit(0) + n)


# Gates

@query(f"""+ p AS (SELECT r.event_id, kickoff FROM results r JOIN odds USING (event_id)), w AS (SELECT * FROM p WHERE epoch(kickoff) - epoch({JUNE}) BETWEEN -900 AND 30 * 3600)
       SELECT event_id, 'target' AS kind, NULL AS name FROM w JOIN results USING (event_id, kickoff) WHERE home_id % 5 > 0 AND away_id % 5 > 0
       UNION ALL SELECT event_id, 'unresolved', 'T' || home_id FROM w JOIN results USING (event_id, kickoff) WHERE home_id % 5 = 0 UNION ALL SELECT event_id, 'unresolved', 'T' || away_id FROM w JOIN results USING (event_id, kickoff) WHERE away_id % 5 = 0""", ("results", "odds"))
def p1_target_gate(spark, sf):
    r = T.results(spark, sf)
    o = T.odds(spark, sf).select("event_id", *[F.col(c).alias(f"{c}_odds") for c in ("home", "draw", "away")])
    snap = r.join(o, "event_id").withColumn("home", F.concat(F.lit("T"), "home_id")).withColumn("away", F.concat(F.lit("T"), "away_id"))
    snap = snap.withColumn("fetched_at", F.col("kickoff")).unionByName(snap.withColumn("fetched_at", F.col("kickoff") - F.expr("INTERVAL 1 DAY")).withColumn("home_odds", F.lit(None).cast("double")))
    ids = r.select(F.explode(F.array("home_id", "away_id")).alias("i")).distinct().where("i % 5 > 0")
    targets, unresolved = G.target_gate(snap, ids.select(F.concat(F.lit("T"), "i").alias("name"), F.concat(F.lit("t"), "i").alias("target_name")), F.expr(JUNE))
    return targets.select("event_id", F.lit("target").alias("kind"), F.lit(None).cast("string").alias("name")).unionByName(unresolved.select("event_id", F.lit("unresolved").alias("kind"), "name"))


@query("""+ l AS (SELECT event_id, max(captured_at) AS t FROM live_stats GROUP BY 1), n AS (SELECT max(captured_at) AS now FROM live_stats)
       SELECT event_id FROM l, n WHERE epoch(now) - epoch(t) BETWEEN 0 AND 86400 AND epoch(now) - epoch(t) + 60 * (event_id % 20) BETWEEN 0 AND 86400 AND event_id % 10 >= 4 AND event_id % 3 > 0""", ("live_stats",))
def p5_live_eligible(spark, sf):
    """A day in place of ten minutes: the test table is sparse."""
    s = T.live_stats(spark, sf)
    last = s.groupBy("event_id").agg(F.max("captured_at").alias("captured_at"))
    now = s.agg(F.max("captured_at"))
    e = F.col("event_id")
    odds = last.select("event_id", "captured_at", F.lit(2.0).alias("home"), F.lit(3.0).alias("draw"), F.lit(4.0).alias("away"))
    stats = last.select("event_id", (F.col("captured_at") - F.make_interval(mins=(e % 20).cast("int"))).alias("captured_at"), ((e % 10).cast("double") * 0.09 + 0.40).alias("match_confidence"), F.when(e % 3 == 0, "FT").otherwise("LIVE").alias("status"))
    return G.live_eligible(odds, stats, F.lit(now.first()[0]), minutes=1440).select("event_id")


@query(f"""+ x AS (SELECT *, event_id // 2 AS source_id FROM results WHERE event_id % 7 > 0 AND event_id % 11 > 0 AND (event_id % 13 = 0 OR epoch({JUNE}) - epoch(kickoff) BETWEEN 0 AND 140 * 60)),
       y AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY kickoff DESC, event_id DESC) AS n FROM x) SELECT event_id, source_id FROM y WHERE n = 1""", ("results",))
def p6_provider_targets(spark, sf):
    e = F.col("event_id")
    x = T.results(spark, sf).select("kickoff", "event_id", F.floor(e / 2).alias("source_id"), F.when(e % 7 > 0, F.col("home_id")).alias("home"), F.col("away_id").alias("away"), (e % 11 == 0).alias("cancelled"), F.lit(None).cast("boolean").alias("finished"), (e % 13 == 0).alias("live"))
    return G.provider_targets(x, F.expr(JUNE)).select("event_id", "source_id")


@query(f"SELECT event_id FROM results WHERE kickoff > {NOW}", ("results",))
def p10_prematch_targets(spark, sf):
    return G.prematch_targets(T.results(spark, sf), F.expr(NOW)).select("event_id")


# Links

@query("""+ x AS (SELECT event_id, home_id, away_id, kickoff, tournament, event_id // 5 AS url FROM results),
       c AS (SELECT r.event_id AS row_id, r.url, t.event_id, t.event_id IS NOT NULL AND CASE WHEN r.event_id % 4 = 0 THEN TRUE ELSE r.tournament = t.tournament END AND abs(epoch(r.kickoff) - epoch(t.kickoff)) <= 864000 AS ok FROM (SELECT * FROM x WHERE event_id % 2 = 0) r LEFT JOIN (SELECT * FROM x WHERE event_id % 2 = 1) t ON r.home_id = t.home_id AND r.away_id = t.away_id),
       n AS (SELECT *, count(*) FILTER (ok) OVER (PARTITION BY row_id) AS a, count(*) FILTER (ok) OVER (PARTITION BY event_id) AS b, count(*) FILTER (ok) OVER (PARTITION BY url) AS u FROM c), good AS (SELECT row_id, event_id FROM n WHERE ok AND a = 1 AND b = 1 AND u = 1)
       SELECT row_id, event_id, NULL AS reason FROM good UNION ALL SELECT row_id, NULL, CASE WHEN max(event_id) IS NULL THEN 'NO_NAME_PAIR' WHEN max(a) = 0 THEN 'LEAGUE_OR_CLOCK' WHEN max(a) > 1 THEN 'AMBIGUOUS' ELSE 'REPEATED' END FROM n WHERE row_id NOT IN (SELECT row_id FROM good) GROUP BY row_id""", ("results",))
def j5_link_static(spark, sf):
    x = T.results(spark, sf).select("event_id", F.col("home_id").alias("home_key"), F.col("away_id").alias("away_key"), F.col("tournament").alias("league"), "kickoff", F.floor(F.col("event_id") / 5).alias("url"))
    rows = x.where("event_id % 2 = 0").withColumn("league", F.when(F.col("event_id") % 4 > 0, F.col("league"))).withColumnRenamed("event_id", "row_id")
    links, rejected = L.link_static(rows, x.where("event_id % 2 = 1").drop("url"), 864_000)
    return links.withColumn("reason", F.lit(None).cast("string")).unionByName(rejected.select("row_id", F.lit(None).cast("bigint").alias("event_id"), "reason"))


@query("""+ c AS (SELECT event_id // 4 AS g, event_id, (event_id * 7919) % 1009 AS s FROM results), r AS (SELECT g, event_id AS a, s, row_number() OVER (PARTITION BY g ORDER BY s DESC, event_id) AS n, lead(s) OVER (PARTITION BY g ORDER BY s DESC, event_id) AS nxt FROM c)
       SELECT g AS k, a AS best, s - nxt AS margin FROM r WHERE n = 1""", ("results",))
def w5_runner_up_margin(spark, sf):
    x = T.results(spark, sf).select(F.floor(F.col("event_id") / 4).alias("k"), "event_id", ((F.col("event_id") * 7919) % 1009).alias("s"))
    return R.runner_up_margin(x, "k", "s", "event_id").select("k", F.col("event_id").alias("best"), "margin")


@query()
def j24_assign_greedy(spark, sf):
    """Each row may take any target of its own or the next group of four; held against one pass down the sorted list in the tests."""
    x = T.results(spark, sf).select("event_id", F.floor(F.col("event_id") / 4).alias("g"))
    t = x.select(F.col("event_id").alias("target"), "g")
    c = x.select("event_id", F.explode(F.array("g", F.col("g") + 1)).alias("g")).join(t, "g").withColumn("score", (F.col("event_id") * 31 + F.col("target") * 17) % 101)
    return L.assign_greedy(c.drop("g"), "event_id", "target", "score")


@query("""SELECT event_id, count(*) AS n, max(captured_at) AS captured_at FROM live_stats GROUP BY 1""", ("live_stats",))
def j17_latest_row(spark, sf):
    x = T.live_stats(spark, sf)
    n = x.groupBy("event_id").agg(F.count("*").alias("n"))
    return S.latest_per_key(x.select("event_id", "captured_at", "row_id"), ["event_id"], "captured_at").join(n, "event_id").select("event_id", "n", "captured_at")


# Order and budgets

@query("""SELECT event_id FROM results WHERE CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 12) AS BIGINT) % 5 = 2""", ("results",))
def w8_fair_rotation(spark, sf):
    return R.fair_rotation(T.results(spark, sf), "event_id", 5, 2).select("event_id")


SIMS = "SELECT event_id, CAST((event_id * 13) % 101 AS DOUBLE) / 100 AS home_similarity, CAST((event_id * 29) % 103 AS DOUBLE) / 100 AS away_similarity FROM results"


@query(f"""+ x AS ({SIMS}) SELECT event_id FROM x WHERE event_id % 400 = 0 OR event_id % 2 = 1 ORDER BY event_id % 2, least(home_similarity, away_similarity) DESC, home_similarity + away_similarity DESC, event_id LIMIT 300""", ("results",))
def t1_cap_by_priority(spark, sf):
    e = F.col("event_id")
    x = T.results(spark, sf).select("event_id", ((e * 13) % 101).cast("double").alias("h"), ((e * 29) % 103).cast("double").alias("a")).select("event_id", (F.col("h") / 100).alias("home_similarity"), (F.col("a") / 100).alias("away_similarity"))
    return B.cap_by_priority(x.where("event_id % 400 = 0"), x.where("event_id % 2 = 1"), 300, strict=False).select("event_id")


@query(f"""SELECT event_id AS id, tournament AS league FROM results ORDER BY CAST(kickoff AS DATE) <> CAST({JUNE} AS DATE), CASE tournament WHEN '2-HIGH' THEN 1 WHEN '1-URGENT' THEN 2 ELSE 1000000 END, CASE event_id % 3 WHEN 1 THEN 1 ELSE 1000000 END, id LIMIT 200""", ("results",))
def t3_order_evidence(spark, sf):
    x = T.results(spark, sf).select(F.col("event_id").alias("id"), F.col("kickoff").alias("captured_at"), F.col("tournament").alias("league"), F.concat(F.lit("m"), F.col("event_id") % 3).alias("model"))
    return B.order_evidence(x, F.to_date(F.expr(JUNE)), ["2-HIGH", "1-URGENT"], ["m1"]).limit(200).select("id", "league")


@query("""SELECT event_id, kickoff FROM results ORDER BY event_id % 7 = 0 DESC, kickoff, event_id LIMIT 150""", ("results",))
def t4_movement_board(spark, sf):
    return B.movement_board(T.results(spark, sf).select("event_id", "kickoff", (F.col("event_id") % 7 == 0).alias("alert"))).limit(150).select("event_id", "kickoff")


@query(MASTER + """, o AS (SELECT source, name_key, observed_at FROM k), c AS (SELECT o.source, o.name_key, count(*) AS n, max(observed_at) AS last_seen FROM o WHERE NOT EXISTS (SELECT 1 FROM master m WHERE m.status = 'VERIFIED' AND m.source = o.source AND m.name_key = o.name_key) GROUP BY 1, 2)
       SELECT source, name_key, n FROM c ORDER BY n DESC, last_seen DESC, source, name_key LIMIT 100""", ("alias_obs",))
def t5_unseen_priority(spark, sf):
    o = T.alias_obs(spark, sf).withColumn("name_key", E.name_key(F.col("alias")))
    return B.unseen_priority(I.unseen_census(o, _master(spark, sf).where("status = 'VERIFIED'"))).limit(100).select("source", "name_key", "n")


@query(f"""+ g AS (SELECT player, team, max(played_at) AS refreshed_at FROM players GROUP BY 1, 2), c AS (SELECT s_suppkey AS team, TIMESTAMP '1998-12-01' + to_hours(CAST(s_suppkey % 50 AS INTEGER)) AS kickoff, s_suppkey % 3 AS rank FROM supplier)
       SELECT player, team FROM g JOIN c USING (team) WHERE (epoch(TIMESTAMP '1998-12-01') - epoch(refreshed_at)) / 60 > 60 * 24 * 30 ORDER BY kickoff, rank, player, team LIMIT 200""", ("players",))
def t6_refresh_due(spark, sf):
    now = F.expr("TIMESTAMP '1998-12-01 00:00:00'")
    g = T.players(spark, sf).groupBy("player", "team").agg(F.max("played_at").cast("timestamp").alias("refreshed_at"))
    s = F.col("s_suppkey")
    c = T.table(spark, sf, "supplier").select(s.alias("team"), (now + F.make_interval(hours=(s % 50).cast("int"))).alias("kickoff"), (s % 3).alias("rank"))
    return B.refresh_due(g, c, now, 200, 24 * 30).select("player", "team")


# Tables of current rows

@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'new' ELSE 'old' END AS v FROM results WHERE event_id % 2 = 0 OR event_id % 3 = 0""", ("results",))
def m3_guard_regression(spark, sf):
    """Newer rows for every third event, and for every fifth a row without a time, which changes nothing."""
    x = T.results(spark, sf)
    base = x.where("event_id % 2 = 0").select("event_id", F.col("kickoff").alias("t"), F.lit("old").alias("v"))
    new = x.where("event_id % 3 = 0").select("event_id", (F.col("kickoff") + F.expr("INTERVAL 1 DAY")).alias("t"), F.lit("new").alias("v"))
    blank = x.where("event_id % 5 = 0").select("event_id", F.lit(None).cast("timestamp").alias("t"), F.lit("blank").alias("v"))
    late = x.where("event_id % 2 = 0").select("event_id", (F.col("kickoff") - F.expr("INTERVAL 1 DAY")).alias("t"), F.lit("late").alias("v"))
    return S.guard_regression(base, new.unionByName(blank).unionByName(late), ["event_id"], "t").select("event_id", "v")


@query("""+ x AS (SELECT 'T' || home_id AS h, 'T' || away_id AS a, home_id, away_id, event_id FROM results WHERE event_id % 40 = 0), u AS (SELECT lower(h) AS hk, lower(a) AS ak, event_id, home_id, away_id FROM x), s AS (SELECT 't-' || home_id AS h, 't-' || away_id AS a, event_id AS sid, home_id, away_id FROM results WHERE event_id % 9 = 0)
       SELECT u.event_id, 'H' AS side, s.h AS alias, 'k' || u.home_id AS entity FROM s JOIN u ON s.home_id = u.home_id AND s.away_id = u.away_id UNION ALL SELECT u.event_id, 'A', s.a, 'k' || u.away_id FROM s JOIN u ON s.home_id = u.home_id AND s.away_id = u.away_id""", ("results",))
def m22_learn_exact_shadow(spark, sf):
    x = T.results(spark, sf)
    named = lambda df, p: df.withColumns({"home": F.concat(F.lit(p), "home_id"), "away": F.concat(F.lit(p), "away_id")})
    shadow = named(x.where("event_id % 9 = 0"), "t-").select(F.lit("shadow").alias("source"), F.col("kickoff").alias("observed_at"), "home", "away")
    up = named(x.where("event_id % 40 = 0"), "T").select("event_id", "home", "away", F.concat(F.lit("k"), "home_id").alias("home_key"), F.concat(F.lit("k"), "away_id").alias("away_key"))
    return B.learn_exact_shadow(shadow, up).select("event_id", "side", "alias", "entity")


@query("""+ o AS (SELECT event_id, 's' || (event_id % 3) AS source, 'i' || (event_id % 1000) AS source_id, 1 + event_id % 5 AS n, CASE WHEN event_id % 4 = 0 THEN 0.90 ELSE 0.97 END AS low, CASE WHEN event_id % 11 = 0 THEN 'REJECTED' END AS s FROM results)
       SELECT event_id, source, source_id, CASE WHEN s IS NOT NULL THEN s WHEN n >= 3 AND low >= 0.95 AND event_id % 13 > 0 THEN 'VERIFIED' ELSE 'CANDIDATE' END AS status FROM o""", ("results",))
def m23_promote_candidates(spark, sf):
    """Ids of every thirteenth event are mapped to another event."""
    e = F.col("event_id")
    x = T.results(spark, sf).select("event_id", F.concat(F.lit("s"), e % 3).alias("source"), F.concat(F.lit("i"), e % 1000).alias("source_id"))
    obs = x.withColumn("confidence", F.when(e % 4 == 0, 0.90).otherwise(0.97)).withColumn("r", F.explode(F.sequence(F.lit(0), e % 5))).drop("r")
    old = x.where(e % 11 == 0).select("event_id", "source", "source_id", F.lit(0).cast("bigint").alias("n"), F.lit(1.0).alias("low"), F.lit("REJECTED").alias("status"))
    mapped = x.where(e % 13 == 0).withColumn("event_id", -e)
    # An id is one event's own here, so the mapping meets only its event.
    own = lambda df: df.withColumn("source_id", F.concat("source_id", F.lit("-"), F.abs("event_id")))
    got = I.promote_candidates(own(obs), own(old), own(mapped))[0]
    return got.select("event_id", "source", F.substring_index("source_id", "-", 1).alias("source_id"), "status")


@query("""SELECT event_id, concat_ws(',', CASE WHEN event_id % 5 = 0 THEN 'DUPLICATE' END, CASE WHEN event_id % 7 = 0 THEN 'UNKNOWN_EVENT' END, CASE WHEN event_id % 3 = 0 THEN 'STALE' END, CASE WHEN event_id % 2 = 0 THEN 'PROBABILITY' END, CASE WHEN event_id % 11 = 0 AND event_id % 7 > 0 THEN 'IDENTITY' END, CASE WHEN event_id % 13 = 0 THEN 'MATCH_SCORE' END) AS violations, 0 AS published
       FROM results JOIN (SELECT unnest([1, 2]) AS c) ON c = 1 OR event_id % 5 = 0 WHERE event_id % 5 = 0 OR event_id % 7 = 0 OR event_id % 3 = 0 OR event_id % 2 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0""", ("results",))
def m24_x21_publish_contract(spark, sf):
    """Every row's violations; with any the stored table stays empty, which `published` counts."""
    e, now = F.col("event_id"), F.expr(NOW)
    x = T.results(spark, sf).select("event_id", F.when(e % 3 == 0, now - F.expr("INTERVAL 4 DAYS")).otherwise(now).alias("captured_at"), F.lit("h").alias("home_name"), F.when(e % 11 == 0, "x").otherwise("a").alias("away_name"), F.lit(0.4).alias("home"), F.lit(0.3).alias("draw"), F.when(e % 2 == 0, 0.4).otherwise(0.3).alias("away"), F.when(e % 13 == 0, 0.9).otherwise(0.99).alias("match_score"))
    batch = x.unionByName(x.where("event_id % 5 = 0"))
    canon = x.where("event_id % 7 > 0").select("event_id", "home_name", F.lit("a").alias("away_name"))
    table, bad = S.publish_batch(batch, canon, batch.limit(0), now)
    n = F.broadcast(table.agg(F.count("*").cast("int").alias("published")))
    return bad.select("event_id", F.array_join("violations", ",").alias("violations")).crossJoin(n)


@query(f"""+ x AS (SELECT event_id, kickoff, event_id // 2 AS url, CASE event_id % 6 WHEN 0 THEN 'EXPIRED' ELSE 'PROVISIONAL' END AS state FROM results WHERE event_id % 3 = 0),
       n AS (SELECT *, count(*) FILTER (state = 'PROVISIONAL') OVER (PARTITION BY url) AS n FROM x)
       SELECT event_id, CASE WHEN state <> 'PROVISIONAL' THEN state WHEN event_id % 5 = 0 THEN 'PROMOTED' WHEN event_id % 7 = 0 THEN 'DISCONNECTED' WHEN kickoff + CASE WHEN event_id % 11 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END <= {NOW} THEN 'EXPIRED' WHEN event_id % 11 = 0 OR n > 1 THEN 'DISCONNECTED' ELSE 'PROVISIONAL' END AS state FROM n""", ("results",))
def m26_x19_transition_links(spark, sf):
    e = F.col("event_id")
    x = T.results(spark, sf)
    old = x.where("event_id % 3 = 0").select("event_id", F.floor(e / 2).alias("url"), "kickoff", F.when(e % 6 == 0, "EXPIRED").otherwise("PROVISIONAL").alias("state"))
    fixtures = x.where("event_id % 7 > 0").select("event_id", (F.col("kickoff") + F.when(e % 11 == 0, F.expr("INTERVAL 1 DAY")).otherwise(F.expr("INTERVAL 0 DAY"))).alias("kickoff"))
    return S.transition_links(old, old.limit(0).drop("state"), x.where("event_id % 5 = 0"), fixtures, F.expr(NOW))[0].select("event_id", "state")


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN home_goals WHEN event_id % 3 = 0 THEN 99 END AS home_goals, tournament FROM results""", ("results",))
def m28_preserve(spark, sf):
    x = T.results(spark, sf).select("event_id", "home_goals", "tournament")
    base = x.withColumn("home_goals", F.when(F.col("event_id") % 2 == 0, F.col("home_goals")))
    return S.preserve(base, x.where("event_id % 3 = 0").withColumn("home_goals", F.lit(99).cast("bigint")).withColumn("tournament", F.lit("old")), ["event_id"], ["home_goals"])


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'new' ELSE 'old' END AS league, CAST(CASE WHEN event_id % 3 = 0 THEN 2.5 ELSE 1.5 END AS DOUBLE) AS home FROM results WHERE event_id % 2 = 0 OR event_id % 3 = 0""", ("results",))
def m31_promote_authority(spark, sf):
    x = T.results(spark, sf)
    up = x.where("event_id % 3 = 0").select("event_id", (F.col("kickoff") + F.expr("INTERVAL 1 DAY")).alias("fetched_at"), F.lit("new").alias("league"), F.lit(2.5).alias("home"))
    old = x.where("event_id % 2 = 0")
    f, o = B.promote_authority(up, old.select("event_id", F.col("kickoff").alias("fetched_at"), F.lit("old").alias("league")), old.select("event_id", F.col("kickoff").alias("fetched_at"), F.lit(1.5).alias("home")))
    return f.select("event_id", "league").join(o.select("event_id", "home"), "event_id")


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_id % 4 = 0 WHEN event_id % 3 = 0 THEN TRUE ELSE FALSE END AS keeps FROM results""", ("results",))
def x7_keep_verified(spark, sf):
    x = T.results(spark, sf).select("event_id")
    old = x.withColumn("status", F.when(F.col("event_id") % 3 == 0, "VERIFIED").otherwise("CANDIDATE")).where("event_id % 2 = 1")
    new = x.withColumn("status", F.when(F.col("event_id") % 4 == 0, "VERIFIED").otherwise("CANDIDATE"))
    return S.keep_verified(old, new, ["event_id"]).select("event_id", (F.col("status") == "VERIFIED").alias("keeps"))


@query("""SELECT event_id, kickoff FROM results WHERE event_id % 6 = 0 UNION ALL SELECT event_id, NULL FROM results WHERE event_id % 2 = 1 AND event_id % 3 = 0 UNION ALL SELECT event_id, kickoff FROM results WHERE event_id % 6 IN (2, 4)""", ("results",))
def x4_backfill_history(spark, sf):
    """Fixtures after a history: the stored ones keep their kickoff, stubs have none."""
    x = T.results(spark, sf)
    fixture = x.where("event_id % 2 = 0").select("event_id", "kickoff")
    payload = x.where("event_id % 3 = 0").select("event_id", F.col("kickoff").alias("captured_at"), "home_goals")
    return B.backfill_history(payload, fixture, payload.limit(0))[0]


@query("""SELECT event_id FROM results WHERE event_id % 3 > 0 AND event_id % 4 = 0""", ("results",))
def u5_missing_targets(spark, sf):
    x = T.results(spark, sf).select("event_id")
    return L.missing_from(x.where("event_id % 4 = 0"), x.where("event_id % 3 = 0"), ["event_id"])


# Live

@query("""+ n AS (SELECT max(captured_at) AS m FROM live_stats), l AS (SELECT event_id, captured_at >= m - INTERVAL 3 DAY AS kept FROM live_stats, n) SELECT event_id, count(*) FILTER (kept) AS n_kept, count(*) FILTER (NOT kept) AS n_late FROM l GROUP BY 1""", ("live_stats",))
def l10_late_rows(spark, sf):
    x = T.live_stats(spark, sf)
    last = x.agg(F.max("captured_at").alias("last"))
    return V.late_counts(x.crossJoin(F.broadcast(last)), ["event_id"], F.col("captured_at") >= F.col("last") - F.expr("INTERVAL 3 DAYS"))


@query("""+ d AS (SELECT event_id, max(captured_at) AS t FROM live_stats GROUP BY 1), n AS (SELECT max(t) AS m FROM d) SELECT event_id, CASE WHEN epoch(m) - epoch(t) > 7200 THEN 'STALE' WHEN event_id % 3 = 0 THEN 'CAPTURED_NO_METRICS' ELSE 'FRESH' END AS state FROM d, n""", ("live_stats",))
def x14_detail_state(spark, sf):
    x = T.live_stats(spark, sf).select("event_id", "captured_at", F.when(F.col("event_id") % 3 > 0, F.array(F.lit("a"))).otherwise(F.array().cast("array<string>")).alias("team_stats"))
    now = x.agg(F.max("captured_at")).first()[0]
    return B.detail_state(x, F.lit(now), 120).select("event_id", "state")


LIVE = """+ d AS (SELECT event_id, max(captured_at) AS t, max(minute) AS m FROM live_stats GROUP BY 1), n AS (SELECT max(t) AS now FROM d)"""


@query(LIVE + """, l AS (SELECT event_id, m, CASE event_id % 5 WHEN 0 THEN 'NOT_APPLICABLE' WHEN 1 THEN 'CAPTURED_NO_METRICS' END AS det, event_id % 3 = 0 AS sb, event_id % 4 = 0 AS tb, event_id % 6 = 0 AS hb FROM d, n),
       g AS (SELECT count(*) AS n_live, count(*) FILTER (sb) AS n_score_bad, count(*) FILTER (tb AND det IS NULL) AS n_stats_bad, count(*) FILTER (hb AND det IS NULL AND coalesce(CASE WHEN sb THEN NULL ELSE m END, 0) >= 10) AS n_shadow_bad, count(*) FILTER (det = 'NOT_APPLICABLE') AS n_score_only, count(*) FILTER (det = 'CAPTURED_NO_METRICS') AS n_no_metrics FROM l)
       SELECT *, CASE WHEN n_score_bad > 0 THEN 'FAIL' WHEN n_stats_bad + n_shadow_bad + n_score_only + n_no_metrics > 0 THEN 'WARN' ELSE 'OK' END AS state FROM g""", ("live_stats",))
def x15_live_guard(spark, sf):
    """All events at the table's last time; some lack a score, stats or a shadow row."""
    x = T.live_stats(spark, sf)
    now = x.agg(F.max("captured_at")).first()[0]
    d = x.groupBy("event_id").agg(F.max("minute").alias("minute")).withColumn("captured_at", F.lit(now))
    e = F.col("event_id")
    detail = d.select("event_id", F.when(e % 5 == 0, "NOT_APPLICABLE").when(e % 5 == 1, "CAPTURED_NO_METRICS").otherwise("FRESH").alias("state"))
    return A.live_guard(d, d.where(e % 3 > 0), d.where(e % 4 > 0), d.where(e % 6 > 0), detail, F.lit(now))


# Models

@query("""SELECT event_id, CASE WHEN event_id % 20 >= 10 THEN round(home / 100, 6) END AS h, round(draw / 100, 6) AS d FROM predictions""", ("predictions",))
def md7_sparse_gate(spark, sf):
    p = T.predictions(spark, sf).select("event_id", r6(F.col("home") / 100).alias("h"), r6(F.col("draw") / 100).alias("d"), (F.col("event_id") % 20).alias("games"))
    return C.sparse_gate(p, ["h"]).select("event_id", "h", "d")


@query("""+ x AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'H' WHEN 1 THEN 'D' WHEN 2 THEN NULL ELSE 'A' END AS pick, CASE WHEN event_id % 3 > 0 THEN CAST(home_goals AS DOUBLE) END AS h, CAST(away_goals AS DOUBLE) AS a FROM results)
       SELECT event_id, CASE WHEN pick IN ('H', 'A') THEN pick WHEN h - a >= 1 THEN 'H' WHEN a - h >= 1 THEN 'A' END AS side, CASE WHEN pick IN ('H', 'A') THEN 'CONSENSUS' WHEN abs(h - a) >= 1 THEN 'FORM' ELSE 'NONE' END AS basis, (pick IS NOT NULL)::INT * 40 + (h IS NOT NULL)::INT * 30 + 30 AS points FROM x""", ("results",))
def md10_macro_control(spark, sf):
    e = F.col("event_id")
    pick = F.when(e % 4 == 0, "H").when(e % 4 == 1, "D").when(e % 4 == 3, "A")
    x = T.results(spark, sf).select("event_id", pick.alias("pick"), F.when(e % 3 > 0, F.col("home_goals").cast("double")).alias("h"), F.col("away_goals").cast("double").alias("a"))
    m = C.macro_control(F.col("pick"), F.col("h"), F.col("a"))
    return x.select("event_id", m["side"].alias("side"), m["basis"].alias("basis"), C.coverage_points([(F.col("pick").isNotNull(), 40), (F.col("h").isNotNull(), 30), (F.col("a").isNotNull(), 30)]).alias("points"))


# Registry

@query(MASTER + """ SELECT source, count(*) FILTER (status = 'VERIFIED') AS n_verified, count(*) FILTER (status = 'CANDIDATE') AS n_candidate, count(*) FILTER (status = 'AMBIGUOUS') AS n_ambiguous, count(DISTINCT entity) FILTER (status = 'VERIFIED') AS n_entities, count(*) FILTER (status <> 'VERIFIED') AS n_blocks, max(last_seen) AS last_seen FROM master GROUP BY 1""", ("alias_obs",))
def q9_master_coverage(spark, sf):
    return A.master_coverage(_master(spark, sf))


@query(MASTER + """ SELECT source, name_key, entity, status, CASE status WHEN 'AMBIGUOUS' THEN 'COLLISION_REVIEW' ELSE 'EVIDENCE_PROMOTION_REVIEW' END AS next_action FROM master WHERE status <> 'VERIFIED' AND length(name_key) % 3 > 0""", ("alias_obs",))
def q9_unresolved_actions(spark, sf):
    m = _master(spark, sf)
    return A.unresolved_actions(m, m.where("length(name_key) % 3 = 0"))


CONTEXT = MASTER + """, context AS (SELECT source, name_key, entity, 'c' || (n_seen % 3) AS competition, CASE WHEN length(name_key) % 2 = 0 THEN 'VERIFIED' ELSE 'CANDIDATE' END AS status FROM master)"""


def _context(spark, sf):
    return _master(spark, sf).select("source", "name_key", "entity", F.concat(F.lit("c"), F.col("n_seen") % 3).alias("competition"), F.when(F.length("name_key") % 2 == 0, "VERIFIED").otherwise("CANDIDATE").alias("status"))


@query(CONTEXT + """ SELECT source, count(*) FILTER (status = 'VERIFIED') AS n_context, count(DISTINCT name_key) FILTER (status = 'VERIFIED') AS n_names, count(DISTINCT entity) FILTER (status = 'VERIFIED') AS n_entities, count(*) FILTER (status <> 'VERIFIED') AS n_unresolved FROM context GROUP BY 1""", ("alias_obs",))
def q10_context_telemetry(spark, sf):
    return A.context_telemetry(_context(spark, sf))


@query(CONTEXT + """ SELECT m.source, m.name_key, m.entity, m.status, count(c.source) AS n_hits, string_agg(DISTINCT c.competition, ',' ORDER BY c.competition) AS competitions, CASE WHEN count(c.source) > 0 THEN 'DIRECT_CONTEXT_MASTER' ELSE 'DISCOVERY_REQUIRED' END AS path
       FROM master m LEFT JOIN (SELECT * FROM context WHERE status = 'VERIFIED') c ON c.source = m.source AND c.name_key = m.name_key AND c.entity = m.entity WHERE m.status <> 'VERIFIED' GROUP BY 1, 2, 3, 4""", ("alias_obs",))
def q10_generic_alias_paths(spark, sf):
    return A.generic_alias_paths(_master(spark, sf), _context(spark, sf))


@query("""+ p AS (SELECT event_id, 'k' || home_id AS h, 'k' || away_id AS a FROM results WHERE event_id % 3 > 0) SELECT r.event_id, CASE WHEN p.h IS NOT NULL AND home_id % 7 > 0 THEN 'e' || home_id END AS home_entity, CASE WHEN p.h IS NOT NULL AND away_id % 7 > 0 THEN 'e' || away_id END AS away_entity,
       CASE WHEN p.h IS NOT NULL AND home_id % 7 > 0 AND away_id % 7 > 0 THEN 'DIRECT_MASTER' WHEN p.h IS NOT NULL THEN 'NAME_GAP' WHEN r.event_id % 2 = 0 THEN 'ARCHIVE_OR_SUPPLEMENT_ONLY' ELSE 'NOT_FETCHED' END AS class FROM results r LEFT JOIN p USING (event_id)""", ("results",))
def q11_anchor_replay(spark, sf):
    return _replay(spark, sf)


def _replay(spark, sf, part=3):
    x = T.results(spark, sf)
    p = x.where(f"event_id % {part} > 0").select("event_id", F.concat(F.lit("k"), "home_id").alias("home_key"), F.concat(F.lit("k"), "away_id").alias("away_key"), F.col("kickoff").alias("fetched_at"))
    ids = x.select(F.explode(F.array("home_id", "away_id")).alias("i")).distinct()
    m = ids.select(F.concat(F.lit("k"), "i").alias("name_key"), F.concat(F.lit("e"), "i").alias("entity"), F.when(F.col("i") % 7 > 0, "VERIFIED").otherwise("CANDIDATE").alias("status"))
    return A.anchor_replay(x, p, x.where("event_id % 4 = 0"), x.where("event_id % 2 = 0"), m)


@query("""+ f AS (SELECT 'three' AS feed, 3 AS k UNION ALL SELECT 'five', 5), c AS (SELECT feed, CASE WHEN event_id % k > 0 AND home_id % 7 > 0 AND away_id % 7 > 0 THEN 'DIRECT_MASTER' WHEN event_id % k > 0 THEN 'NAME_GAP' WHEN event_id % 2 = 0 THEN 'ARCHIVE_OR_SUPPLEMENT_ONLY' ELSE 'NOT_FETCHED' END AS class FROM results, f) SELECT feed, class, count(*) AS n FROM c GROUP BY 1, 2""", ("results",))
def q11_source_coverage(spark, sf):
    return A.source_coverage({"three": _replay(spark, sf), "five": _replay(spark, sf, 5)})


@query("""+ r AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'A' ELSE 'B' END AS source, CASE event_id % 5 WHEN 0 THEN 'SOURCE' WHEN 1 THEN 'GLOBAL' WHEN 2 THEN 'BLOCKED' ELSE 'NONE' END AS path FROM results)
       SELECT source, count(*) AS n, count(*) FILTER (path = 'SOURCE') AS n_source, count(*) FILTER (path = 'GLOBAL') AS n_global, count(*) FILTER (path = 'BLOCKED') AS n_blocked, count(*) FILTER (path = 'NONE') AS n_none, round(count(*) FILTER (path IN ('SOURCE', 'GLOBAL')) / count(*), 6) AS share FROM r GROUP BY 1""", ("results",))
def q12_identity_report(spark, sf):
    return B.identity_health_report(_resolved(spark, sf)).withColumn("share", r6("share"))


def _resolved(spark, sf):
    e = F.col("event_id")
    return T.results(spark, sf).select("event_id", F.when(e % 3 == 0, "A").otherwise("B").alias("source"), F.when(e % 5 == 0, "SOURCE").when(e % 5 == 1, "GLOBAL").when(e % 5 == 2, "BLOCKED").otherwise("NONE").alias("path"))


@query("""+ h AS (SELECT source, CASE WHEN n_rows % 2 = 0 THEN 'OK' ELSE 'FAIL' END AS status FROM source_health UNION ALL SELECT 'A', 'OK' UNION ALL SELECT 'B', 'FAIL') SELECT source, CASE WHEN source = 'A' THEN 'WARN' ELSE status END AS status FROM h""", ("source_health",))
def x12_runtime_health(spark, sf):
    h = T.source_health(spark, sf).select("source", F.when(F.col("n_rows") % 2 == 0, "OK").otherwise("FAIL").alias("status"))
    more = _resolved(spark, sf).select("source").distinct().withColumn("status", F.when(F.col("source") == "A", "OK").otherwise("FAIL"))
    return B.runtime_health(h.unionByName(more), B.identity_health_report(_resolved(spark, sf)))


@query(MASTER + """ SELECT k.source, k.name_key, k.event_id, CASE WHEN k.event_id % 5 = 0 THEN 'RESOLVED_NOW' WHEN EXISTS (SELECT 1 FROM master m WHERE m.source = k.source AND m.name_key = k.name_key AND m.status = 'VERIFIED') THEN 'IDENTITY_KNOWN' ELSE 'PROVIDER_ABSENT' END AS class FROM k""", ("alias_obs",))
def q8_gap_classes(spark, sf):
    k = T.alias_obs(spark, sf).select("source", E.name_key(F.col("alias")).alias("name_key"), "event_id")
    return I.gap_classes(k, k.where("event_id % 5 = 0"), _master(spark, sf))


@query("""+ x AS (SELECT event_id, event_id % 6 AS r FROM results) SELECT event_id AS last_event, CASE r WHEN 0 THEN CASE WHEN event_id % 5 = 0 THEN 'RESOLVED_CURRENT_MODEL_PRESENT' WHEN event_id % 7 > 0 THEN 'RECONCILE_OR_MODEL_GAP' ELSE 'IDENTITY_OR_RECONCILE_GAP' END
       WHEN 1 THEN CASE WHEN event_id % 4 = 1 THEN 'SOURCE_OR_MODEL_ABSENCE' ELSE 'IDENTITY_OR_RECONCILE_GAP' END WHEN 2 THEN 'SOURCE_OR_MODEL_ABSENCE' ELSE 'REVIEW_REQUIRED' END AS class, event_id % 7 > 0 AS has_identity FROM x""", ("results",))
def x10_gap_class(spark, sf):
    e = F.col("event_id")
    x = T.results(spark, sf).select("event_id")
    reason = F.when(e % 6 == 0, A.MODEL_MISSING).when(e % 6 == 1, A.REVIEW[0]).when(e % 6 == 2, A.ABSENT[1]).otherwise("other")
    gaps = x.select(F.lit("s").alias("source"), F.concat(F.lit("e"), e % 7).alias("entity"), e.alias("last_event"), reason.alias("reason"))
    m = x.select(F.concat(F.lit("e"), e % 7).alias("entity"), F.when(e % 7 > 0, "VERIFIED").otherwise("CANDIDATE").alias("status"))
    got = A.gap_class(gaps, x.where("event_id % 5 = 0").withColumn("status", F.lit("CURRENT")), x.where("event_id % 4 = 1").withColumn("queue_reason", F.lit("SOURCE_FIXTURE_NOT_OBSERVED")), m)
    return got.select("last_event", "class", "has_identity")


@query(MASTER + """ SELECT source, name_key, entity, upper(entity) AS name, status, n_events FROM master WHERE status <> 'VERIFIED' AND length(entity) % 2 = 0""", ("alias_obs",))
def x5_candidate_queue(spark, sf):
    m = _master(spark, sf)
    return A.candidate_queue(m, m.where("length(entity) % 2 = 0").select("entity", F.upper("entity").alias("name")).distinct())


@query(CONTEXT + """, t AS (SELECT source, count(*) FILTER (status = 'VERIFIED') AS n_context, count(*) FILTER (status <> 'VERIFIED') AS n_unresolved FROM context WHERE length(source) % 2 = 0 GROUP BY 1)
       SELECT m.source, count(*) FILTER (status = 'VERIFIED') AS n_verified, count(*) FILTER (status = 'CANDIDATE') AS n_candidate, count(*) FILTER (status = 'AMBIGUOUS') AS n_ambiguous, coalesce(any_value(n_context), 0) AS n_context, coalesce(any_value(n_unresolved), 0) AS n_unresolved FROM master m LEFT JOIN t USING (source) WHERE m.source IN (SELECT DISTINCT source FROM alias_obs ORDER BY 1 LIMIT 20) GROUP BY 1""", ("alias_obs",))
def x17_core_scope(spark, sf):
    """The first twenty sources are in scope."""
    m = _master(spark, sf)
    core = [r[0] for r in m.select("source").distinct().orderBy("source").limit(20).collect()]
    return A.core_scope(A.unresolved_actions(m, m.limit(0)), m, A.context_telemetry(_context(spark, sf)).where("length(source) % 2 = 0"), core)[1]


@query("""+ x AS (SELECT event_id, event_id % 2 AS o, CASE event_id % 3 WHEN 0 THEN 'absent' WHEN 1 THEN 'FIXTURE_ONLY' ELSE 'UNRESOLVED' END AS s, event_id % 5 AS h FROM results WHERE epoch(kickoff) - epoch(""" + JUNE + """) BETWEEN 0 AND 172800)
       SELECT count(*) AS n_events, count(*) FILTER (s = 'absent') AS n_unchecked, count(*) FILTER (o = 0) AS n_predicted, count(*) FILTER (s = 'FIXTURE_ONLY') AS n_fixture_only, count(*) FILTER (o = 0 AND event_id % 4 = 0) AS n_stale, count(*) FILTER (h = 0) AS n_no_evidence, count(*) FILTER (h = 0 AND s = 'FIXTURE_ONLY') AS n_absent_at_source,
         count(*) FILTER (h = 0 AND s <> 'FIXTURE_ONLY') AS n_unexplained, CASE WHEN count(*) FILTER (s = 'absent') > 0 THEN 'FAIL' WHEN count(*) FILTER (o = 0 AND event_id % 4 = 0) > 0 OR count(*) FILTER (h = 0 AND s <> 'FIXTURE_ONLY') > 0 THEN 'WARN' ELSE 'PASS' END AS state FROM x""", ("results",))
def x16_coverage_guard(spark, sf):
    e, now = F.col("event_id"), F.expr(JUNE)
    x = T.results(spark, sf)
    seen = x.where("event_id % 3 > 0").select("event_id", F.when(e % 3 == 1, "FIXTURE_ONLY").otherwise("UNRESOLVED").alias("status"))
    p = x.where("event_id % 2 = 0").select("event_id", F.when(e % 4 == 0, now - F.expr("INTERVAL 4 DAYS")).otherwise(now).alias("captured_at"))
    return A.coverage_guard(x, seen, p, x.select("event_id", F.when(e % 5 > 0, 2).otherwise(0).alias("channels")), now)


@query(f"""+ x AS (SELECT event_id FROM results WHERE kickoff > {NOW} AND event_id % 9 > 0)
       SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'NO_AUTHORITY_TIMESTAMP' WHEN event_id % 4 = 0 THEN 'STALE_AUTHORITY' WHEN event_id % 2 = 1 AND event_id % 3 = 0 THEN 'HAD_CAPTURE_GAP' ELSE 'OK' END AS health,
         CASE WHEN event_id % 2 = 0 THEN 'NOT_OFFERED' WHEN event_id % 3 = 0 THEN 'CAPTURE_GAP' ELSE 'OK' END AS had_state, 'NOT_OFFERED' AS goals_state, CASE WHEN event_id % 5 = 0 THEN event_id % 3 = 0 OR event_id % 7 = 0 END AS had_differs, CASE WHEN event_id % 5 = 0 THEN FALSE END AS goals_differs FROM x""", ("results",))
def x18_market_authority(spark, sf):
    e, now = F.col("event_id"), F.expr(NOW)
    at = F.when(e % 10 == 0, F.lit(None).cast("timestamp")).when(e % 4 == 0, now - F.expr("INTERVAL 1 HOUR")).otherwise(now)
    x = T.results(spark, sf).select("event_id", "kickoff", (e % 9 > 0).alias("selling"), F.when(e % 2 == 1, F.array(F.lit("had"))).otherwise(F.array().cast("array<string>")).alias("offered"), at.alias("fetched_at"), F.when(e % 3 > 0, 2.0).alias("had_home"), F.lit(3.0).alias("had_away"), F.lit(2.5).alias("line"))
    legacy = x.where("event_id % 5 = 0").select("event_id", F.when(e % 7 == 0, 9.0).otherwise(2.0).alias("had_home"), "had_away", "line")
    return A.market_authority_health(x, legacy, now, {"had": ("had_home", "had_away"), "goals": ("line",)})


@query("""+ n AS (SELECT event_id, h, d, a, 's0,s1' AS sources FROM (SELECT event_id, home / (home + draw + away) AS h, draw / (home + draw + away) AS d, away / (home + draw + away) AS a FROM predictions) WHERE event_id % 2 = 0)
       SELECT event_id, sources, round(h, 6) AS h FROM n UNION ALL SELECT event_id, 'old', 0.5 FROM predictions WHERE event_id % 2 = 1 AND event_id % 3 = 0""", ("predictions",))
def x3_upsert_consensus(spark, sf):
    p = T.predictions(spark, sf)
    row = F.struct("event_id", "home", "draw", "away", F.array(F.lit("s1"), F.lit("s0"), F.lit("s1")).alias("sources"), F.date_format("captured_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured_at"))
    base = p.where("event_id % 3 = 0").select("event_id", (F.col("captured_at") - F.expr("INTERVAL 1 DAY")).alias("captured_at"), F.lit("old").alias("sources"), F.lit(0.5).alias("h"), F.lit(0.25).alias("d"), F.lit(0.25).alias("a"))
    stored, narrow = A.upsert_consensus(p.where("event_id % 2 = 0").select(F.to_json(F.array(row)).alias("payload")), base)
    return stored.join(narrow.where("side = 'H'").select("event_id", "p"), "event_id").select("event_id", "sources", r6("p").alias("h"))


@query(f"""+ w AS (SELECT r.event_id, kickoff, tournament, p.home AS ph, q.home AS qh FROM results r LEFT JOIN (SELECT event_id, home / 100 AS home FROM predictions WHERE event_id % 3 > 0 AND event_id % 4 > 0) p USING (event_id) LEFT JOIN (SELECT event_id, home FROM odds WHERE event_id % 5 > 0) q USING (event_id) WHERE epoch(kickoff) - epoch({JUNE}) BETWEEN -21600 AND 86399)
       SELECT event_id, kickoff, round(ph, 6) AS p_home, round(qh, 6) AS quote, CASE WHEN event_id % 2 = 0 THEN 'd' END AS detail FROM w""", ("results", "predictions", "odds"))
def x40_summary_feed(spark, sf):
    e, now = F.col("event_id"), F.expr(JUNE)
    r = T.results(spark, sf).select("event_id", "kickoff", F.col("tournament").alias("league"))
    detail = r.select("event_id", F.when(e % 2 == 0, now).otherwise(now - F.expr("INTERVAL 2 DAYS")).alias("captured_at"), F.lit("d").alias("detail"))
    p = T.predictions(spark, sf).select("event_id", F.when(e % 3 > 0, now).otherwise(now - F.expr("INTERVAL 5 DAYS")).alias("captured_at"), F.when(e % 4 > 0, 0.95).otherwise(0.5).alias("match_score"), F.col("home").alias("h"), F.col("draw").alias("d"), F.col("away").alias("a"))
    q = T.odds(spark, sf).join(r.select("event_id", "league"), "event_id").select("event_id", "home", F.when(e % 5 > 0, F.col("league")).otherwise("other").alias("league"), now.alias("captured_at"))
    feed = A.summary_feed(r, T.odds(spark, sf), detail, p, q, now)
    d = F.from_json("doc", "p_home double, quote_home double, detail string")
    return feed.select("event_id", "kickoff", r6(d["p_home"]).alias("p_home"), r6(d["quote_home"]).alias("quote"), d["detail"].alias("detail"))


@query("""SELECT s_name AS name, CAST(s_suppkey AS DOUBLE) AS rating, FALSE AS from_snapshot FROM supplier WHERE s_suppkey % 2 = 0""")
def x48_ratings_fresh(spark, sf):
    s = T.table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_suppkey").cast("double")).alias("rating"))
    return A.ratings_or_snapshot(s, s.where("rating IS NOT NULL").withColumn("rating", F.lit(0.0)), 2)


@query("""SELECT s_name AS name, CAST(0 AS DOUBLE) AS rating, TRUE AS from_snapshot FROM supplier""")
def x48_ratings_snapshot(spark, sf):
    """Fewer fresh ratings than asked for: the stored ones."""
    s = T.table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.when(F.col("s_suppkey") == 1, 1.0).alias("rating"))
    return A.ratings_or_snapshot(s, s.withColumn("rating", F.lit(0.0)), 2)


@query("""+ x AS (SELECT tournament, kickoff, CASE home_id % 4 WHEN 0 THEN 'Land' || home_id || ' U21' WHEN 1 THEN 'Land' || home_id || ' women' WHEN 2 THEN 'Old' || home_id ELSE 'Land' || home_id END AS name, home_id AS i FROM results UNION ALL SELECT tournament, kickoff, 'Away' || away_id, away_id FROM results),
       y AS (SELECT tournament, kickoff, CASE WHEN name LIKE 'Old%' THEN 'New' || i WHEN name LIKE 'Land%' THEN 'Land' || i ELSE name END AS name FROM x WHERE name NOT LIKE '% U21')
       SELECT tournament, lower(name) AS name_key, min(name) AS name, min(kickoff) AS first_seen, max(kickoff) AS last_seen FROM y GROUP BY 1, 2""", ("results",))
def x6_competition_names(spark, sf):
    i = F.col("home_id")
    home = F.when(i % 4 == 0, F.concat(F.lit("Land"), i, F.lit(" U21"))).when(i % 4 == 1, F.concat(F.lit("Land"), i, F.lit(" women"))).when(i % 4 == 2, F.concat(F.lit("Old"), i)).otherwise(F.concat(F.lit("Land"), i))
    x = T.results(spark, sf).select("tournament", "kickoff", home.alias("home"), F.concat(F.lit("Away"), "away_id").alias("away"))
    renames = T.results(spark, sf).where("home_id % 4 = 2").select(F.concat(F.lit("Old"), i).alias("name"), F.concat(F.lit("New"), i).alias("new_name")).distinct()
    return I.competition_names(x, renames)


@query("""+ h AS (SELECT event_id, string_agg(DISTINCT source, ',' ORDER BY source) AS note FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'A' ELSE 'B' END AS source FROM results WHERE event_id % 5 < 2) GROUP BY 1) SELECT r.event_id, coalesce(note, '') AS note FROM results r LEFT JOIN h USING (event_id) WHERE coalesce(note, '') <> 'B'""", ("results",))
def x11_annotate(spark, sf):
    """Only what changed: all notes were B."""
    hits = _resolved(spark, sf).withColumn("name_key", F.lit("n"))
    consensus = T.results(spark, sf).select("event_id", F.lit("B").alias("note"))
    return I.annotate(consensus, I.evidence_hits(hits))[1]


@query(MASTER + """, a AS (SELECT source, 'alias' AS "column", alias AS value, count(DISTINCT name_key) AS n FROM k GROUP BY 1, 3 HAVING count(DISTINCT name_key) > 1), b AS (SELECT source, 'name_key', name_key, count(DISTINCT entity) FROM k GROUP BY 1, 3 HAVING count(DISTINCT entity) > 1) SELECT * FROM a UNION ALL SELECT * FROM b""", ("alias_obs",))
def x25_validate_catalog(spark, sf):
    return I.validate_catalog(T.alias_obs(spark, sf).withColumn("name_key", E.name_key(F.col("alias"))))


@query(MASTER + """ SELECT name_key, min(entity) AS entity, max(struct_pack(c := confidence, e := n_events, l := last_seen, a := alias)).a AS alias FROM master WHERE name_key NOT LIKE 'a%' GROUP BY 1 HAVING count(DISTINCT entity) = 1""", ("alias_obs",))
def x26_name_map(spark, sf):
    return I.name_map(_master(spark, sf).where("name_key NOT LIKE 'a%'"), ["unused"])


@query("""SELECT CAST(kickoff + to_hours(CAST(event_id % 24 AS INTEGER)) AS DATE) AS day FROM results UNION SELECT CAST(kickoff + to_hours(CAST(event_id % 24 AS INTEGER)) + INTERVAL 8 HOUR AS DATE) FROM results""", ("results",))
def x28_expected_days(spark, sf):
    return C.expected_ids(T.results(spark, sf).withColumn("kickoff", F.col("kickoff") + F.make_interval(hours=(F.col("event_id") % 24).cast("int"))))


@query("""+ t AS (SELECT event_id, 'club' || event_id AS h, 'town' || event_id AS a FROM results), u AS (SELECT 'http://x/club' || event_id || '-town' || (event_id + event_id % 2) AS url, event_id AS i FROM results)
       SELECT event_id, url, CAST(CASE WHEN event_id % 2 = 0 THEN 1.0 ELSE 0.5 END AS DOUBLE) AS score FROM t JOIN u ON i = event_id""", ("results",))
def x29_choose_link(spark, sf):
    x = T.results(spark, sf)
    e = F.col("event_id")
    urls = x.select(F.concat(F.lit("http://x/club"), e, F.lit("-town"), e + e % 2).alias("url"))
    return B.choose_link(x.select("event_id", F.concat(F.lit("Club"), e).alias("home"), F.concat(F.lit("Town"), e).alias("away")), urls)


@query("""SELECT event_id, CASE WHEN event_id % 3 > 0 THEN CAST(home_goals AS DOUBLE) END AS home, CASE WHEN event_id % 3 > 0 THEN CAST(home_goals + away_goals AS DOUBLE) END AS total FROM results""", ("results",))
def x31_corners(spark, sf):
    e = F.col("event_id")
    key = F.when(e % 3 > 0, "corner_kicks").otherwise("shots")
    c = B.corners(F.array(F.struct(key.alias("key"), F.col("home_goals").cast("string").alias("home"), F.concat("away_goals", F.lit(" (x)")).alias("away"))))
    return T.results(spark, sf).select("event_id", c["home"].alias("home"), c["total"].alias("total"))


@query("""+ n AS (SELECT c_custkey AS id, c_name AS name, '隊' || (c_custkey % 50) AS l FROM customer) SELECT l AS local, min(struct_pack(i := id, n := name)).n AS name FROM n GROUP BY 1""")
def x33_alias_names(spark, sf):
    k = F.col("c_custkey")
    return B.alias_names(T.table(spark, sf, "customer").select(k.alias("id"), F.col("c_name").alias("name"), F.concat(F.lit("plain|（隊"), k % 50, F.lit("）")).alias("local_names")))


@query("""+ s AS (SELECT player, year(played_at) AS season, team AS tournament, count(*) AS games, sum(goals) AS goals FROM players GROUP BY 1, 2, 3), b AS (SELECT player, max(struct_pack(s := season, g := games, t := tournament, o := goals)) AS b FROM s GROUP BY 1)
       SELECT player, b.s AS season, b.t AS tournament, b.g AS games, CASE WHEN b.g >= 10 THEN 'OK' WHEN b.g > 0 THEN 'THIN' ELSE 'NONE' END AS quality FROM b""", ("players",))
def x37_season_profile(spark, sf):
    s = T.players(spark, sf).groupBy("player", F.year("played_at").alias("season"), F.col("team").alias("tournament")).agg(F.count("*").alias("games"), F.sum("goals").alias("goals"))
    return B.season_profile(s, F.expr(NOW)).drop("goals")


@query("""SELECT s_suppkey AS team, CASE WHEN s_suppkey % 3 = 0 THEN CAST(11.0 AS DOUBLE) WHEN s_suppkey % 100 BETWEEN 20 AND 80 THEN CAST(s_suppkey % 100 AS DOUBLE) END AS possession, CAST(CASE WHEN s_suppkey % 3 = 0 THEN 22.0 ELSE 7.0 END AS DOUBLE) AS shots, s_suppkey % 3 = 0 AS kept FROM supplier""")
def x38_team_profile(spark, sf):
    """Every third team was profiled today; the others are picked from their stats anew."""
    k, now = F.col("s_suppkey"), F.expr(NOW)
    t = T.table(spark, sf, "supplier")
    rows = F.array(F.struct(F.lit("ball.possession").alias("path"), (k % 100).cast("double").alias("value")), F.struct(F.lit("total.shots").alias("path"), F.lit(7.0).alias("value")), F.struct(F.lit("x.total.shots").alias("path"), F.lit(9.0).alias("value")))
    stats = t.select(k.alias("team"), F.inline(rows))
    aliases = spark.createDataFrame([("possession", "possession"), ("total.shots", "shots")], "alias string, target string")
    old = t.where("s_suppkey % 2 = 0 OR s_suppkey % 3 = 0").select(k.alias("team"), F.lit(11.0).alias("possession"), F.lit(22.0).alias("shots"), F.when(k % 3 == 0, now).otherwise(now - F.expr("INTERVAL 30 DAYS")).alias("refreshed_at"))
    return C.team_profile(stats, aliases, old, now)


@query("""SELECT 'a' AS feed, event_id AS id, home_id AS home FROM results WHERE event_id % 2 = 0 UNION ALL SELECT 'b', event_id, away_id FROM results WHERE event_id % 2 = 1""", ("results",))
def x43_archive_shape(spark, sf):
    x = T.results(spark, sf)
    return B.to_archive_shape(x.where("event_id % 2 = 0"), {"id": "event_id", "home": "home_id"}, x.where("event_id % 2 = 1").withColumnRenamed("event_id", "match"), {"id": "match", "home": "away_id"})


@query("""+ t AS (SELECT event_id, home_id AS team, 'H' AS side, kickoff FROM results UNION ALL SELECT event_id, away_id, 'A', kickoff FROM results) SELECT team, count(*) FILTER (side = 'H' AND event_id % 3 > 0) AS home_games, count(*) FILTER (side = 'A' AND event_id % 3 > 0) AS away_games, count(*) AS games, max(kickoff) AS latest FROM t GROUP BY 1""", ("results",))
def x44_international(spark, sf):
    teams, latest = C.international_results(T.results(spark, sf).withColumn("neutral", F.when(F.col("event_id") % 3 == 0, True)))
    n = teams.groupBy("team").agg(F.count_if(F.col("venue_side") == "H").alias("home_games"), F.count_if(F.col("venue_side") == "A").alias("away_games"), F.count("*").alias("games"))
    return n.join(latest, "team")


@query("""SELECT 'Land' || event_id || ' U23' AS source, CASE WHEN event_id % 2 = 0 THEN 'land' || event_id || ' (AM)' ELSE 'land' || (event_id + 1) || ' am' END AS canonical, event_id % 2 = 0 AS same FROM results""", ("results",))
def x46_cohort_equivalent(spark, sf):
    e = F.col("event_id")
    pairs = T.results(spark, sf).select(F.concat(F.lit("Land"), e, F.lit(" U23")).alias("source"), F.when(e % 2 == 0, F.concat(F.lit("land"), e, F.lit(" (AM)"))).otherwise(F.concat(F.lit("land"), e + 1, F.lit(" am"))).alias("canonical"), F.col("tournament").alias("competition"))
    return I.cohort_equivalent(pairs, spark.createDataFrame([("nowhere", "elsewhere")], "name string, same_as string")).select("source", "canonical", "same")


@query("""SELECT event_id FROM results WHERE event_id % 3 = 0 AND event_id % 5 > 0 AND event_id % 7 > 0""", ("results",))
def x20_provisional_feed(spark, sf):
    e = F.col("event_id")
    x = T.results(spark, sf).select("event_id", "kickoff", F.col("home_id").alias("home"), F.col("away_id").alias("away"))
    stored = x.withColumn("state", F.when(e % 3 == 0, "PROVISIONAL").otherwise("EXPIRED")).withColumn("home", F.when(e % 5 == 0, -1).otherwise(F.col("home")))
    return B.provisional_feed(stored, x, x.where("event_id % 7 = 0")).select("event_id")


@query("""SELECT event_id AS row_id, event_id FROM results WHERE event_id % 10 > 0 OR event_id > 60""", ("results",))
def x22_clock_cohort_link(spark, sf):
    """Displayed clocks differ by two hours, but for a few that differ by three."""
    e = F.col("event_id")
    x = T.results(spark, sf).select("event_id", F.concat(F.lit("h"), e).alias("home"), F.concat(F.lit("a"), e).alias("away"), F.col("tournament").alias("league"), "kickoff")
    rows = x.select(e.alias("row_id"), "home", "away", (F.col("kickoff") + F.make_interval(hours=F.when((e % 10 == 0) & (e <= 60), 3).otherwise(2))).alias("source_clock"))
    return B.link_clock_cohort(rows, x)


@query("""SELECT match_id FROM (SELECT 'm' || event_id AS match_id, event_id FROM results) WHERE event_id % 3 > 0 AND event_id % 5 > 0 AND event_id % 4 > 0""", ("results",))
def x23_provenance_filter(spark, sf):
    e, now = F.col("event_id"), F.expr(NOW)
    x = T.results(spark, sf).select(F.when(e % 5 > 0, F.concat(F.lit("m"), e)).otherwise("no id!").alias("match_id"), F.when(e % 3 > 0, "VERIFIED").otherwise("CANDIDATE").alias("identity_status"), F.when(e % 4 > 0, now).otherwise(now - F.expr("INTERVAL 4 HOURS")).alias("captured_at"))
    return B.provenance_filter(x, now).select("match_id")


@query(MASTER + """, s AS (SELECT count(*) AS n_rows, count(*) FILTER (status = 'VERIFIED') AS n_verified, count(*) FILTER (status = 'AMBIGUOUS') AS n_ambiguous, count(DISTINCT source) AS n_sources FROM master), g AS (SELECT count(*) AS n_global FROM (SELECT name_key FROM master WHERE status = 'VERIFIED' GROUP BY 1 HAVING count(DISTINCT entity) = 1))
       SELECT *, CASE WHEN n_verified = 0 THEN 'FAIL' WHEN n_ambiguous > n_verified THEN 'WARN' ELSE 'OK' END AS state FROM s, g""", ("alias_obs",))
def x41_maintain(spark, sf):
    """One maintenance run with nothing stored and nothing in quarantine: its health row."""
    e = T.alias_obs(spark, sf).withColumn("name_key", E.name_key(F.col("alias")))
    none = _master(spark, sf).limit(0)
    return I.maintain(e, none, none, none)[2]
