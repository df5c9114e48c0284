"""Registered queries over feeds, guards, audits and provisional links."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchlake import testdata as T
from matchlake.functions import exprs as E
from matchlake.operators import links as L
from matchlake.operators import state as S
from matchlake.plans import boards as B
from matchlake.plans import models as M
from matchlake.queries import name_sim_sql, query, r6

JUNE = "TIMESTAMP '1997-06-01 00:00:00'"


def _keys(spark, sf):
    """Results with text keys of both teams."""
    return T.results(spark, sf).select("event_id", F.concat(F.lit("k"), "home_id").alias("home_key"), F.concat(F.lit("k"), "away_id").alias("away_key"), F.col("tournament").alias("league"), "kickoff")


@query(
    f"""+ w AS (SELECT event_id, kickoff, FALSE AS live FROM results WHERE epoch(kickoff) - epoch({JUNE}) BETWEEN 0 AND 30 * 86400 AND event_id % 4 > 0 UNION ALL SELECT event_id, kickoff, TRUE FROM results WHERE event_id % 400 = 0)
        SELECT w.event_id, w.kickoff, round(CASE WHEN p.source = 's1' THEN p.home ELSE o.home END, 6) AS home, live AS is_live FROM w JOIN odds o ON o.event_id = w.event_id LEFT JOIN predictions p ON p.event_id = w.event_id""",
    ("results", "odds", "predictions"),
)
def x2_app_feed(spark, sf):
    base = T.results(spark, sf).select("event_id", "kickoff").join(T.odds(spark, sf).select("event_id", "home"), "event_id")
    p = T.predictions(spark, sf).where("source = 's1'").select("event_id", "home")
    feed = B.app_feed(base.where("event_id % 4 > 0"), base.where("event_id % 400 = 0"), {"score": p}, F.expr(JUNE), 720)
    d = F.from_json("doc", "home double, is_live boolean")
    return feed.select("event_id", "kickoff", r6(d["home"]).alias("home"), d["is_live"].alias("is_live"))


@query(
    f"""+ u AS (SELECT event_id FROM results WHERE epoch(kickoff) - epoch({JUNE}) BETWEEN 0 AND 172800), x AS (SELECT u.event_id, a.event_id AS a, p.event_id AS p FROM u LEFT JOIN (SELECT event_id FROM odds WHERE event_id % 3 = 0) a ON a.event_id = u.event_id LEFT JOIN (SELECT event_id FROM predictions WHERE source <> 's2') p ON p.event_id = u.event_id)
        SELECT count(*) AS n_events, count(a) AS n_available, count(p) AS n_predicted, count(*) FILTER (a IS NULL AND p IS NULL) AS n_missing, CASE WHEN count(*) FILTER (a IS NULL AND p IS NULL) > 0 THEN 'FAIL' WHEN count(p) < count(a) THEN 'WARN' ELSE 'PASS' END AS state FROM x""",
    ("results", "odds", "predictions"),
)
def q3_coverage_guard(spark, sf):
    return B.coverage_guard(T.results(spark, sf), T.odds(spark, sf).where("event_id % 3 = 0"), T.predictions(spark, sf).where("source <> 's2'"), F.expr(JUNE))


@query(
    """+ p AS (SELECT * FROM live_stats), f AS (SELECT event_id, max(source) AS i, max(home) AS s, max(minute) AS m FROM p WHERE row_id % 2 = 0 GROUP BY 1), g AS (SELECT event_id, max(source) AS i, max(home) AS s, max(minute) AS m FROM p WHERE row_id % 3 = 0 GROUP BY 1),
       c AS (SELECT l.event_id, f.i IS NOT NULL AND g.i IS NOT NULL AS both_, f.i = g.i AS i, f.s = g.s AS s, abs(f.m - g.m) AS d FROM (SELECT DISTINCT event_id FROM p) l LEFT JOIN f USING (event_id) LEFT JOIN g USING (event_id))
       SELECT count(*) AS n, count(*) FILTER (both_) AS n_both, count(*) FILTER (i) AS n_id, count(*) FILTER (s) AS n_score, count(*) FILTER (d > 3) AS n_drift, CASE WHEN count(*) FILTER (both_) = 0 THEN 'NO_OVERLAP' WHEN count(*) FILTER (s) < count(*) FILTER (both_) THEN 'WARN' ELSE 'OK' END AS state FROM c""",
    ("live_stats",),
)
def q5_shadow_guard(spark, sf):
    p = T.live_stats(spark, sf)
    feed = lambda k: p.where(F.col("row_id") % k == 0).groupBy("event_id").agg(F.max("source").alias("source_id"), F.max("home").alias("score"), F.max("minute").alias("minute"))
    return B.shadow_guard(L.compare_feeds(p.select("event_id").distinct(), feed(2), feed(3)))


@query(
    """SELECT event_id, 'home' AS market, CASE WHEN event_id % 2 = 0 THEN 'OK' WHEN event_id % 3 = 0 THEN 'CAPTURE_GAP' ELSE 'NOT_OFFERED' END AS state FROM results UNION ALL SELECT event_id, 'draw', CASE WHEN event_id % 2 = 0 THEN 'OK' WHEN event_id % 5 = 0 THEN 'CAPTURE_GAP' ELSE 'NOT_OFFERED' END FROM results""",
    ("results",),
)
def q6_offer_gaps(spark, sf):
    k = F.col("event_id")
    e = T.results(spark, sf).select("event_id", F.array_compact(F.array(F.when(k % 3 == 0, "HAD"), F.when(k % 5 == 0, "DRW"))).alias("offered"))
    x = B.offer_gaps(e, T.odds(spark, sf).where("event_id % 2 = 0"), {"HAD": "home", "DRW": "draw"})
    return x.select("event_id", F.when(F.col("market") == "HAD", "home").otherwise("draw").alias("market"), "state")


@query(
    """+ x AS (SELECT event_id, max(captured_at) AS p FROM predictions WHERE source IN ('s0', 's1') GROUP BY 1) SELECT r.event_id, CASE WHEN p IS NOT NULL AND epoch(TIMESTAMP '1997-06-01') - epoch(p) <= 365 * 86400 THEN 'MODEL' WHEN p IS NOT NULL THEN 'STALE_MODEL' WHEN r.event_id % 7 = 0 THEN 'NOT_AVAILABLE' ELSE 'UNCHECKED' END AS coverage FROM results r LEFT JOIN x ON x.event_id = r.event_id""",
    ("results", "predictions"),
)
def q14_prediction_coverage(spark, sf):
    res = T.results(spark, sf)
    return B.prediction_coverage(res, T.predictions(spark, sf).where("source IN ('s0', 's1')"), res.where("event_id % 7 = 0").select("event_id", F.lit("NOT_AVAILABLE").alias("status")), F.expr(JUNE), 365 * 24)


@query("SELECT count(*) AS n, count(*) FILTER (event_id % 3 = 0) AS n_verified, count(*) FILTER (event_id % 3 > 0) AS n_unmapped, round(count(*) FILTER (event_id % 3 = 0) / count(*), 6) AS ratio FROM (SELECT DISTINCT event_id FROM live_stats)", ("live_stats",))
def q13_live_identity_coverage(spark, sf):
    x = T.live_stats(spark, sf)
    return B.live_identity_coverage(x, x.where("event_id % 3 = 0")).withColumn("ratio", r6("ratio"))


@query(
    """+ t AS (SELECT event_id, home_id AS h, away_id AS a, tournament AS l, kickoff AS k FROM results WHERE event_id % 3 > 0 AND away_id >= 5), s AS (SELECT event_id AS row_id, home_id AS h, away_id AS a, tournament AS l, kickoff AS k FROM results),
       x AS (SELECT s.row_id, max(CASE WHEN s.h NOT IN (SELECT h FROM t) THEN '1_NO_HOME' WHEN s.a NOT IN (SELECT a FROM t) THEN '2_NO_AWAY' WHEN t.k IS NULL THEN '3_NO_PAIR' WHEN s.l <> t.l THEN '4_LEAGUE' WHEN abs(epoch(s.k) - epoch(t.k)) > 8640000 THEN '5_CLOCK' ELSE '6_LINK' END) AS reason FROM s LEFT JOIN t ON s.h = t.h AND s.a = t.a GROUP BY 1)
       SELECT reason, count(*) AS n FROM x GROUP BY 1""",
    ("results",),
)
def a23_overlap_diagnostics(spark, sf):
    k = _keys(spark, sf)
    targets = k.where((F.col("event_id") % 3 > 0) & (F.substring("away_key", 2, 9).cast("int") >= 5))
    return B.overlap_diagnostics(k.withColumnRenamed("event_id", "row_id"), targets, 8_640_000)


@query(
    """+ t AS (SELECT event_id, home_id AS h, away_id AS a, tournament AS l, kickoff AS k FROM results WHERE event_id % 2 = 1 AND home_id < 30), s AS (SELECT event_id AS row_id, home_id AS h, away_id AS a, tournament AS l, kickoff AS k FROM results),
       x AS (SELECT s.row_id, max(CASE WHEN s.h NOT IN (SELECT h FROM t) THEN '1_NO_HOME' WHEN s.a NOT IN (SELECT a FROM t) THEN '2_NO_AWAY' WHEN t.k IS NULL THEN '3_NO_PAIR' WHEN s.l <> t.l THEN '4_LEAGUE' WHEN abs(epoch(s.k) - epoch(t.k)) > 8640000 THEN '5_CLOCK' ELSE '6_LINK' END) AS reason FROM s LEFT JOIN t ON s.h = t.h AND s.a = t.a GROUP BY 1)
       SELECT reason, count(*) AS n FROM x GROUP BY 1""",
    ("results",),
)
def a23_overlap_diagnostics_all(spark, sf):
    k = _keys(spark, sf)
    targets = k.where((F.col("event_id") % 2 == 1) & (F.substring("home_key", 2, 9).cast("int") < 30))
    return B.overlap_diagnostics(k.withColumnRenamed("event_id", "row_id"), targets, 8_640_000)


@query(
    """SELECT tournament, CASE WHEN event_id % 3 = 0 THEN 'IDENTITY_KNOWN' ELSE 'PROVIDER_ABSENT' END AS class, count(*) AS n, CASE WHEN event_id % 3 = 0 THEN 1 WHEN count(*) >= 10 THEN 2 ELSE 3 END AS priority FROM results GROUP BY 1, event_id % 3 = 0, 2, CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END""",
    ("results",),
)
def a27_gap_priority(spark, sf):
    return B.gap_priority(T.results(spark, sf).select("tournament", F.when(F.col("event_id") % 3 == 0, "IDENTITY_KNOWN").otherwise("PROVIDER_ABSENT").alias("class")))


@query(
    """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN draw WHEN event_id % 3 = 0 THEN home ELSE home END AS home, event_id % 6 > 0 AS restored FROM odds WHERE event_id % 2 = 0 OR event_id % 6 = 0""",
    ("odds",),
)
def m7_restore_active(spark, sf):
    o = T.odds(spark, sf)
    cur = o.where("event_id % 6 = 0").select("event_id", F.when(F.col("event_id") % 4 == 0, F.col("draw")).alias("home"))
    return B.restore_active(cur, o.where("event_id % 2 = 0").select("event_id", F.when((F.col("event_id") % 4 == 0), F.col("draw")).otherwise(F.col("home")).alias("home")), o.where("event_id % 2 = 0"), ["home"])


@query(
    """SELECT event_id, 'HOME' AS selection, CASE WHEN event_id % 3 = 0 THEN draw ELSE home END AS odds FROM odds UNION ALL SELECT event_id, 'DRAW', draw FROM odds UNION ALL SELECT event_id, 'AWAY', CASE WHEN event_id % 3 = 0 THEN draw ELSE away END FROM odds""",
    ("odds",),
)
def m32_refresh_core(spark, sf):
    o = T.odds(spark, sf)
    held = o.where("event_id % 3 < 2").select(
        "event_id", F.expr(f"{JUNE} + make_dt_interval(CASE WHEN event_id % 3 = 0 THEN 1 ELSE -1 END)").alias("captured_at"), F.lit("book").alias("source"),
        F.explode(F.array(*map(F.lit, ("HOME", "DRAW", "AWAY")))).alias("selection"), F.col("draw").alias("odds"),
    )
    return _refresh_core(spark, sf, o, held)


@query("SELECT event_id, 'HOME' AS selection, home AS odds FROM odds UNION ALL SELECT event_id, 'DRAW', draw FROM odds UNION ALL SELECT event_id, 'AWAY', away FROM odds", ("odds",))
def m32_refresh_core_all(spark, sf):
    return _refresh_core(spark, sf, T.odds(spark, sf))


def _refresh_core(spark, sf, odds, market=None):
    o = odds.withColumn("captured_at", F.expr(JUNE))
    p = T.predictions(spark, sf).select("event_id", "captured_at", *[F.col(c).alias(k) for c, k in (("home", "h"), ("draw", "d"), ("away", "a"))])
    if market is None:
        market = spark.createDataFrame([], "event_id bigint, captured_at timestamp, source string, selection string, odds double")
    evidence = spark.createDataFrame([], "event_id bigint, captured_at timestamp, source string, h double, d double, a double")
    return B.refresh_core(o, {"x": p}, market, evidence)[0].select("event_id", "selection", "odds")


@query(
    """+ k AS (SELECT DISTINCT lower(p_name) AS name, replace(lower(p_name), ' ', '') AS c FROM part), p AS (SELECT name AS s, c AS t FROM k UNION ALL SELECT name, 'other' FROM k)
       SELECT s AS source_name, t AS target_name, CASE WHEN length(s) % 3 < 2 THEN replace(s, ' ', '') = t END AS verified FROM p""",
)
def x24_verified_pair(spark, sf):
    k = T.table(spark, sf, "part").select(F.lower("p_name").alias("name")).distinct().withColumn("canonical", F.replace("name", F.lit(" "), F.lit("")))
    pairs = k.select(F.col("name").alias("source_name"), F.col("canonical").alias("target_name")).union(k.select("name", F.lit("other")))
    return B.verified_pair(pairs, [k.where("length(name) % 3 = 0"), k.where("length(name) % 3 < 2")])


@query(
    f"""+ n AS (SELECT c_custkey AS k, lower(c_name) AS name FROM customer), x AS (SELECT event_id, h.name AS home, a.name AS away, tournament, kickoff FROM results JOIN n h ON h.k = home_id JOIN n a ON a.k = away_id),
       c AS (SELECT r.event_id AS row_id, t.event_id, r.home AS rh, replace(r.away, 'customer', 'cust') AS ra, t.home, t.away FROM x r JOIN x t ON r.tournament = t.tournament AND r.kickoff = t.kickoff),
       v AS (SELECT row_id, event_id, rh = home AS vh, EXISTS (SELECT 1 FROM n WHERE name = ra) AND ra = away AS va, {name_sim_sql("rh", "home")} AS hs, {name_sim_sql("ra", "away")} AS aws FROM c),
       k AS (SELECT row_id, event_id, CASE WHEN vh <> va THEN 'ONE_SIDE' WHEN NOT vh AND NOT va AND least(hs, aws) >= 0.30 AND greatest(hs, aws) >= 0.70 THEN 'SIMILARITY' END AS kind FROM v),
       u AS (SELECT *, count(*) OVER (PARTITION BY row_id, kind) AS a, count(*) OVER (PARTITION BY event_id, kind) AS b FROM k WHERE kind IS NOT NULL),
       f AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY kind, row_id, event_id) AS i, row_number() OVER (PARTITION BY event_id ORDER BY kind, row_id, event_id) AS j FROM u WHERE a = 1 AND b = 1)
       SELECT row_id, event_id, kind FROM f WHERE i = 1 AND j = 1""",
    ("results",),
)
def j23_provisional_links(spark, sf):
    names = T.table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.lower("c_name").alias("name"))
    x = T.results(spark, sf).join(names.withColumnRenamed("name", "home"), F.col("home_id") == F.col("k")).drop("k").join(names.withColumnRenamed("name", "away"), F.col("away_id") == F.col("k")).drop("k")
    t = x.select("event_id", "home", "away", F.col("tournament").alias("league"), "kickoff")
    rows = t.withColumnRenamed("event_id", "row_id").withColumn("away", F.replace("away", F.lit("customer"), F.lit("cust")))
    return B.provisional_links(rows, t, names.select("name", F.col("name").alias("target_name")))


@query(
    """+ h AS (SELECT event_id, kickoff, CASE WHEN event_id % 4 = 0 THEN 5 END AS p, event_id % 3 > 0 AS m FROM results), d AS (SELECT event_id AS e FROM h WHERE p IS NULL AND m ORDER BY kickoff, event_id LIMIT 100)
       SELECT event_id, CASE WHEN p IS NOT NULL THEN p WHEN e IS NOT NULL THEN 3 END AS games, CASE WHEN p IS NOT NULL THEN 'REUSED' WHEN NOT m THEN 'UNMAPPED' WHEN e IS NOT NULL THEN 'FETCHED' ELSE 'DEFERRED' END AS status FROM h LEFT JOIN d ON e = event_id""",
    ("results",),
)
def x27_h2h_worker(spark, sf):
    r = T.results(spark, sf)
    return B.h2h_worker(r, r.where("event_id % 3 > 0").select("event_id", F.lit("VERIFIED").alias("status")), r.where("event_id % 4 = 0").select("event_id", F.lit("OK").alias("quality"), F.lit(5).alias("games")), r.select("event_id", F.lit(3).alias("games")), 100)


@query(
    """+ t AS (SELECT p_type AS source, lower(regexp_replace(p_name, '[^A-Za-z0-9]', '', 'g')) AS name_key, p_partkey AS event_id, p_size % 30 / 100.0 + 0.7 AS c, TIMESTAMP '2024-01-01' + to_days(p_size) AS o FROM part), g AS (SELECT source, name_key, min(o) AS first_seen, max(o) AS last_seen, max(c) AS c FROM t GROUP BY 1, 2)
       SELECT source, name_key, first_seen, last_seen FROM g WHERE c < 0.9""",
)
def m19_touch_identities(spark, sf):
    o = T.alias_obs(spark, sf).withColumn("name_key", E.name_key(F.col("alias")))
    empty = spark.createDataFrame([], "source string, name_key string, first_seen timestamp, last_seen timestamp, confidence double, evidence_event bigint")
    return B.touch_identities(o, empty)[1].select("source", "name_key", "first_seen", "last_seen")


@query("SELECT event_id, 's' AS source, 'k' || home_id AS name_key FROM results WHERE home_id % 7 = 0", ("results",))
def m33_guard_violations(spark, sf):
    k = _keys(spark, sf)
    rows = k.select("event_id", F.lit("H").alias("side"), F.lit("s").alias("source"), F.col("home_key").alias("name_key"))
    resolved = k.select(F.lit("s").alias("source"), F.col("home_key").alias("name_key"), F.when(F.substring("home_key", 2, 9).cast("int") % 7 == 0, "other").otherwise(F.col("home_key")).alias("entity")).distinct()
    return B.guard_event_context(rows, k, resolved)[1].select("event_id", "source", "name_key")


@query(
    """SELECT event_id, source, CASE WHEN side = 'H' THEN home_id ELSE away_id END AS team, side FROM (SELECT *, 'x' AS source FROM results WHERE event_id % 10 = 0), (VALUES ('H'), ('A')) s(side) WHERE event_id % 20 = 0""",
    ("results",),
)
def m21_learn_availability(spark, sf):
    x = T.results(spark, sf).select("event_id", F.lit("x").alias("source"), F.col("tournament").alias("competition"), F.when(F.col("event_id") % 20 == 0, 0.95).otherwise(0.5).alias("match_score"), F.col("kickoff").alias("observed_at"), F.col("home_id").alias("source_home"), F.col("away_id").alias("source_away"), F.lit("h").alias("home_key"), F.lit("a").alias("away_key"))
    return B.learn_availability(x).select("event_id", "source", F.col("alias").alias("team"), "side")


@query("SELECT event_id, home FROM odds WHERE event_id % 3 = 0 UNION ALL SELECT event_id, draw FROM odds WHERE event_id % 5 = 0 AND event_id % 3 > 0", ("odds",))
def m8_merge_archive(spark, sf):
    o = T.odds(spark, sf).withColumn("captured_at", F.expr(JUNE))
    weak, strong = o.where("event_id % 5 = 0").select("event_id", "captured_at", F.col("draw").alias("home")), o.where("event_id % 3 = 0").select("event_id", "captured_at", "home")
    return S.merge_fields([weak, strong], ["event_id"], "captured_at").select("event_id", "home")


@query(
    """+ e AS (SELECT p.event_id, CASE WHEN p.home >= p.draw AND p.home >= p.away THEN 'H' WHEN p.draw >= p.away THEN 'D' ELSE 'A' END AS a, CASE WHEN o.home <= o.draw AND o.home <= o.away THEN 'H' ELSE 'A' END AS b, kickoff FROM predictions p JOIN odds o ON o.event_id = p.event_id JOIN results r ON r.event_id = p.event_id)
       SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'ENDED' WHEN event_id % 10 = 1 THEN 'LIVE' WHEN kickoff <= TIMESTAMP '1997-06-01' THEN 'CLOSED' ELSE 'PRE' END AS phase, CASE WHEN a = b THEN 'AGREE' ELSE 'CONFLICT' END AS agreement FROM e""",
    ("predictions", "odds", "results"),
)
def md13_edge_board(spark, sf):
    p = T.predictions(spark, sf).select("event_id", E.argmax_hda(F.col("home"), F.col("draw"), F.col("away")).alias("pick_a"))
    o = T.odds(spark, sf).select("event_id", F.when((F.col("home") <= F.col("draw")) & (F.col("home") <= F.col("away")), "H").otherwise("A").alias("pick_b"))
    k = F.col("event_id") % 10
    return M.edge_board(T.results(spark, sf).join(p, "event_id").join(o, "event_id").withColumn("ended", k == 0).withColumn("in_play", k == 1), F.expr(JUNE))
