"""More registered queries: gates, identity, context and extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake import testdata as T
from matchlake.functions import exprs as E
from matchlake.operators import gates as G
from matchlake.operators import identity as I
from matchlake.operators import rollups as R
from matchlake.operators import state as S
from matchlake.plans import context as C
from matchlake.plans import models as M
from matchlake.queries import FORM_POINTS, NOW, ROLLUP, _rollup, query, r6
from matchlake.sources import feeds as X
from matchlake.streaming import live as V

AT = "TIMESTAMP '2024-01-15 12:00:00'"
STATUS = ", c AS (SELECT source, name_key, count(DISTINCT entity) AS n_targets FROM rollup_ GROUP BY 1, 2), master AS (SELECT r.*, CASE WHEN n_targets > 1 THEN 'AMBIGUOUS' WHEN n_events >= 2 OR name_key = entity OR confidence >= 0.93 THEN 'VERIFIED' ELSE 'CANDIDATE' END AS status FROM rollup_ r JOIN c USING (source, name_key))"


def _now() -> F.Column:
    return F.expr(AT)


def _master(spark: SparkSession, sf: str) -> DataFrame:
    return R.classify_alias(_rollup(spark, sf))


def _observed(spark: SparkSession, sf: str) -> DataFrame:
    return T.alias_obs(spark, sf).withColumn("name_key", E.name_key(F.col("alias")))


# Gates

@query(
    """+ f AS (SELECT event_id, home, draw, away, minute % 2 = 0 AS selling, o.snapshot_id FROM odds_history o JOIN (SELECT row_id, minute FROM live_stats) s ON s.row_id = o.snapshot_id) SELECT event_id, snapshot_id FROM f WHERE selling""",
    ("odds_history", "live_stats"),
)
def p2_bettable(spark, sf):
    f = T.odds_history(spark, sf).join(T.live_stats(spark, sf).select(F.col("row_id").alias("snapshot_id"), "minute"), "snapshot_id")
    f = f.select("event_id", "snapshot_id", F.when(F.col("minute") % 2 == 0, "yes").otherwise("0").alias("selling"), F.col("home").alias("home_odds"), F.col("draw").alias("draw_odds"), F.col("away").alias("away_odds"))
    return G.bettable(f).select("event_id", "snapshot_id")


@query(
    f"SELECT event_id, row_id FROM live_stats WHERE source = 'click' AND (SELECT max(captured_at) FROM live_stats WHERE source = 'click') >= {AT} - INTERVAL 120 MINUTES AND (SELECT max(captured_at) FROM live_stats WHERE source = 'click') <= {AT} + INTERVAL 10 MINUTES UNION ALL SELECT event_id, row_id FROM live_stats WHERE source = 'view' AND (SELECT max(captured_at) FROM live_stats WHERE source = 'click') > {AT} + INTERVAL 10 MINUTES",
    ("live_stats",),
)
def p3_snapshot_gate(spark, sf):
    x = T.live_stats(spark, sf).select("event_id", "row_id", "source", F.col("captured_at").alias("fetched_at"))
    return G.snapshot_gate(x.where("source = 'click'"), x.where("source = 'view'"), _now()).select("event_id", "row_id")


@query(
    "SELECT event_id, row_id, CASE WHEN minute % 2 = 1 THEN 'NOT_SELLING' WHEN minute % 3 > 0 THEN 'NOT_LIVE' ELSE 'ELIGIBLE' END AS authority_state FROM live_stats WHERE captured_at = (SELECT max(captured_at) FROM live_stats)",
    ("live_stats",),
)
def p4_latest_authority(spark, sf):
    x = T.live_stats(spark, sf).select("event_id", "row_id", F.col("captured_at").alias("fetched_at"), (F.col("minute") % 2 == 0).alias("selling"), (F.col("minute") % 3 == 0).alias("in_play"))
    return G.latest_authority(x, F.expr("TIMESTAMP '1990-01-01 00:00:00'")).select("event_id", "row_id", "authority_state")


@query(
    "SELECT event_id FROM results WHERE epoch(kickoff) - epoch(TIMESTAMP '1997-06-01 00:00:00') BETWEEN -14400 AND 129600 AND event_id % 3 > 0",
    ("results",),
)
def p7_scenario_universe(spark, sf):
    x = T.results(spark, sf).select("event_id", "kickoff", F.when(F.col("event_id") % 3 == 0, "ENDED").otherwise("NS").alias("status"), F.lit(False).alias("in_play"))
    return G.scenario_universe(x, F.expr("TIMESTAMP '1997-06-01 00:00:00'")).select("event_id")


@query("SELECT event_id, tournament FROM results WHERE tournament IN ('1-URGENT', '2-HIGH')", ("results",))
def p8_senior_filter(spark, sf):
    return G.senior_filter(T.results(spark, sf), ["1-URGENT", "2-HIGH"]).select("event_id", "tournament")


@query(
    """+ f AS (SELECT CASE WHEN event_id % 9 = 0 THEN '?' ELSE 'm' || event_id END AS match_id, kickoff, event_id % 7 = 0 AS same FROM results)
       SELECT match_id, CASE WHEN match_id = '?' THEN 'ID' WHEN NOT epoch(kickoff) - epoch(TIMESTAMP '1997-06-01 00:00:00') BETWEEN -7200 AND 172800 THEN 'WINDOW' WHEN same THEN 'NAMES' END AS reason FROM f
       WHERE match_id = '?' OR NOT epoch(kickoff) - epoch(TIMESTAMP '1997-06-01 00:00:00') BETWEEN -7200 AND 172800 OR same""",
    ("results",),
)
def p9_rejected_targets(spark, sf):
    k = F.col("event_id")
    f = T.results(spark, sf).select(F.when(k % 9 == 0, "?").otherwise(F.concat(F.lit("m"), k)).alias("match_id"), "kickoff", F.lit("Team É").alias("home"), F.when(k % 7 == 0, "team e").otherwise("other").alias("away"))
    return G.canonical_targets(f, F.expr("TIMESTAMP '1997-06-01 00:00:00'"))[1]


@query(
    """+ p AS (SELECT * FROM predictions WHERE source IN ('s0', 's1', 's2', 's3')) SELECT (SELECT count(*) FROM p) AS n_rows, (SELECT count(DISTINCT event_id) FROM p) AS n_ids, CAST(0 AS BIGINT) AS n_no_clock, count(*) AS n_eligible, count(p.event_id) AS n_covered,
         (SELECT count(*) FROM p) >= 50 AND count(p.event_id) >= 0.65 * count(*) AS accepted FROM results r LEFT JOIN p ON r.event_id = p.event_id""",
    ("predictions", "results"),
)
def m25_publish_snapshot(spark, sf):
    return G.publish_snapshot(T.predictions(spark, sf).where("source IN ('s0', 's1', 's2', 's3')"), T.results(spark, sf))


# Identity

@query(ROLLUP + STATUS + " SELECT source, count(*) AS n_rows, count(DISTINCT name_key) AS n_names, count(DISTINCT entity) AS n_entities, count(*) FILTER (status = 'VERIFIED') AS n_verified, count(*) FILTER (status = 'CANDIDATE') AS n_candidate, count(*) FILTER (status = 'AMBIGUOUS') AS n_ambiguous FROM master GROUP BY 1", ("alias_obs",))
def a24_source_census(spark, sf):
    return I.source_census(_master(spark, sf))


@query(ROLLUP + STATUS + " SELECT k.source, k.name_key, count(*) AS n, max(observed_at) AS last_seen FROM k WHERE NOT EXISTS (SELECT 1 FROM master m WHERE m.source = k.source AND m.name_key = k.name_key AND m.status <> 'AMBIGUOUS') GROUP BY 1, 2", ("alias_obs",))
def a25_unseen_census(spark, sf):
    return I.unseen_census(_observed(spark, sf), _master(spark, sf).where("status <> 'AMBIGUOUS'"))


@query(ROLLUP + STATUS + " SELECT source, name_key, entity FROM (SELECT *, count(*) FILTER (status = 'VERIFIED') OVER (PARTITION BY source, name_key) AS n FROM master) WHERE n = 1 AND status = 'VERIFIED'", ("alias_obs",))
def w2_unique_targets(spark, sf):
    return I.unique_targets(_master(spark, sf)).select("source", "name_key", "entity")


@query(ROLLUP + STATUS + ", v AS (SELECT name_key, entity, count(DISTINCT source) AS v FROM master WHERE status = 'VERIFIED' GROUP BY 1, 2), t AS (SELECT name_key, count(DISTINCT entity) AS t FROM master GROUP BY 1) SELECT source, name_key, entity, CASE WHEN status = 'CANDIDATE' AND v >= 2 AND t <= 1 THEN 'VERIFIED' ELSE status END AS status FROM master LEFT JOIN v USING (name_key, entity) JOIN t USING (name_key)", ("alias_obs",))
def a6_promote_consensus(spark, sf):
    return R.promote_consensus(_master(spark, sf), 2).select("source", "name_key", "entity", "status")


@query(ROLLUP + STATUS + ", q AS (SELECT source, name_key, max(entity) AS entity FROM master WHERE status = 'AMBIGUOUS' GROUP BY 1, 2), l AS (SELECT m.* FROM master m ANTI JOIN q USING (source, name_key, entity)), n AS (SELECT source, name_key, count(DISTINCT entity) AS n FROM l GROUP BY 1, 2) SELECT source, name_key, entity, CASE WHEN status = 'AMBIGUOUS' AND n = 1 THEN 'VERIFIED' ELSE status END AS status FROM l JOIN n USING (source, name_key)", ("alias_obs",))
def x8_m17_quarantine_survivors(spark, sf):
    m = _master(spark, sf)
    q = m.where("status = 'AMBIGUOUS'").groupBy("source", "name_key").agg(F.max("entity").alias("entity"))
    return R.promote_survivors(m, q).select("source", "name_key", "entity", "status")


@query(ROLLUP + STATUS + ", g AS (SELECT name_key FROM master WHERE status = 'VERIFIED' GROUP BY 1 HAVING count(DISTINCT entity) = 1) SELECT count(*) AS n_rows, count(*) FILTER (status = 'VERIFIED') AS n_verified, count(*) FILTER (status = 'AMBIGUOUS') AS n_ambiguous, count(DISTINCT source) AS n_sources, (SELECT count(*) FROM g) AS n_global, CASE WHEN count(*) FILTER (status = 'VERIFIED') = 0 THEN 'FAIL' WHEN count(*) FILTER (status = 'AMBIGUOUS') > count(*) FILTER (status = 'VERIFIED') THEN 'WARN' ELSE 'OK' END AS state FROM master", ("alias_obs",))
def x13_master_health(spark, sf):
    return I.master_health(_master(spark, sf))


@query(
    "SELECT event_id, source, home AS source_id_value, n, low FROM (SELECT event_id, source, count(*) AS n, round(min(away), 6) AS low, count(DISTINCT minute * 0) AS ids, 0 AS home FROM live_stats WHERE epoch(TIMESTAMP '2024-01-30 00:00:00') - epoch(captured_at) BETWEEN 0 AND 864000 GROUP BY 1, 2) WHERE ids = 1 AND n >= 3 AND low >= 5",
    ("live_stats",),
)
def a10_stable_live_ids(spark, sf):
    x = T.live_stats(spark, sf).select("event_id", "source", "captured_at", F.lit(0).alias("source_id"), F.col("away").alias("confidence"))
    return I.stable_live_ids(x, F.expr("TIMESTAMP '2024-01-30 00:00:00'"), 240, 3, 5.0).select("event_id", "source", F.col("source_id").alias("source_id_value"), "n", "low")


@query(
    """+ g AS (SELECT event_id, 'PREDICTION' AS gap FROM results WHERE event_id NOT IN (SELECT event_id FROM predictions WHERE source <> 's5') UNION ALL SELECT event_id, 'ODDS' FROM results WHERE event_id % 3 = 0),
       q AS (SELECT event_id, 'PREDICTION' AS gap FROM results WHERE event_id % 7 = 0)
       SELECT coalesce(g.event_id, q.event_id) AS event_id, coalesce(g.gap, q.gap) AS gap, CASE WHEN q.event_id IS NOT NULL THEN 3 WHEN epoch(r.kickoff) - epoch(TIMESTAMP '1998-01-01 00:00:00') <= 6 * 3600 THEN 2 ELSE 1 END AS priority, CASE WHEN g.event_id IS NOT NULL THEN 'OPEN' ELSE 'RESOLVED' END AS status FROM g FULL JOIN q ON g.event_id = q.event_id AND g.gap = q.gap LEFT JOIN results r ON r.event_id = g.event_id""",
    ("results", "predictions"),
)
def m14_opportunity_queue(spark, sf):
    res = T.results(spark, sf)
    old = res.where("event_id % 7 = 0").select("event_id", F.lit("PREDICTION").alias("gap"), F.lit(3).alias("priority"), F.lit("OPEN").alias("status"))
    feeds = {"PREDICTION": T.predictions(spark, sf).where("source <> 's5'"), "ODDS": T.odds(spark, sf).where("event_id % 3 > 0")}
    return I.opportunity_queue(res.select("event_id", "kickoff"), feeds, old, F.expr(NOW)).select("event_id", "gap", "priority", "status")


@query(
    """+ g AS (SELECT event_id, 'PREDICTION' AS gap FROM results WHERE event_id NOT IN (SELECT event_id FROM predictions WHERE source <> 's5') UNION ALL SELECT event_id, 'ODDS' FROM results WHERE event_id % 2 = 0),
       q AS (SELECT event_id, 'ODDS' AS gap FROM results WHERE event_id % 35 = 0)
       SELECT coalesce(g.event_id, q.event_id) AS event_id, coalesce(g.gap, q.gap) AS gap, CASE WHEN g.event_id IS NOT NULL THEN 'OPEN' ELSE 'RESOLVED' END AS status FROM g FULL JOIN q ON g.event_id = q.event_id AND g.gap = q.gap""",
    ("results", "predictions"),
)
def m14_opportunity_queue_all(spark, sf):
    res = T.results(spark, sf)
    old = res.where("event_id % 35 = 0").select("event_id", F.lit("ODDS").alias("gap"), F.lit(1).alias("priority"), F.lit("OPEN").alias("status"))
    feeds = {"PREDICTION": T.predictions(spark, sf).where("source <> 's5'"), "ODDS": T.odds(spark, sf).where("event_id % 2 = 1")}
    return I.opportunity_queue(res.select("event_id", "kickoff"), feeds, old, _now()).select("event_id", "gap", "status")


@query(
    """+ t AS (SELECT event_id, tournament AS league, 'k' || home_id AS h, 'k' || away_id AS a FROM results), s AS (SELECT DISTINCT h, a FROM t WHERE event_id % 50 = 0), n AS (SELECT h AS k FROM s UNION SELECT a FROM s)
       SELECT event_id, league, CASE WHEN event_id % 3 = 0 THEN 'PUBLISHED' WHEN (h, a) IN (SELECT h, a FROM s) THEN 'PAIR_NOT_LINKED' WHEN h IN (SELECT k FROM n) AND a IN (SELECT k FROM n) THEN 'BOTH_NAMES_APART' WHEN h IN (SELECT k FROM n) OR a IN (SELECT k FROM n) THEN 'ONE_SIDE' ELSE 'ABSENT' END AS reason FROM t""",
    ("results",),
)
def a22_intersection_audit(spark, sf):
    t = T.results(spark, sf).select("event_id", F.col("tournament").alias("league"), F.concat(F.lit("k"), "home_id").alias("home_key"), F.concat(F.lit("k"), "away_id").alias("away_key"))
    return I.intersection_audit(t, t.where("event_id % 50 = 0"), t.where("event_id % 3 = 0"))


@query(
    "SELECT event_id, source, date_trunc('second', min(captured_at)) AS first_at FROM live_stats GROUP BY 1, 2",
    ("live_stats",),
)
def x9_rate_limited_first(spark, sf):
    x = T.live_stats(spark, sf).select("event_id", "source", F.col("captured_at").alias("observed_at"))
    every = I.rate_limited(x, 10**9)  # so far apart that only the first of each counts
    return every.select("event_id", "source", F.col("last_accepted").alias("first_at"))


@query(
    """+ g AS (SELECT event_id, source, list_sort(list(DISTINCT CAST(floor(epoch(captured_at)) AS BIGINT))) AS ts FROM live_stats GROUP BY 1, 2), f AS (SELECT event_id, source, list_reduce(list_prepend({l: CAST(NULL AS BIGINT), n: 0, t: CAST(0 AS BIGINT)}, list_transform(ts, lambda t: {l: CAST(NULL AS BIGINT), n: 0, t: t})), lambda s, y: CASE WHEN s.l IS NULL OR y.t - s.l >= 60 THEN {l: y.t, n: s.n + 1, t: y.t} ELSE {l: s.l, n: s.n, t: y.t} END) AS f FROM g)
       SELECT event_id, source, f.n AS n_accepted, make_timestamp(f.l * 1000000) AS last_accepted FROM f""",
    ("live_stats",),
)
def x9_rate_limited_60s(spark, sf):
    return I.rate_limited(T.live_stats(spark, sf).select("event_id", "source", F.col("captured_at").alias("observed_at")))


@query(
    """+ k AS (SELECT source, event_id, CASE WHEN confidence >= 0.93 THEN 'SOURCE' WHEN confidence >= 0.80 THEN 'GLOBAL' ELSE 'NONE' END AS path, lower(regexp_replace(alias, '[^\\p{L}\\p{N}]', '', 'g')) AS name_key, event_id % 200 AS e FROM alias_obs)
       SELECT e AS event_id, source, bool_or(path = 'SOURCE') AS direct, bool_or(path = 'GLOBAL') AS global, array_to_string(list_sort(list(DISTINCT name_key)), ',') AS names FROM k GROUP BY 1, 2""",
    ("alias_obs",),
)
def a26_evidence_hits(spark, sf):
    k = _observed(spark, sf).select("source", (F.col("event_id") % 200).alias("event_id"), "name_key", F.when(F.col("confidence") >= 0.93, "SOURCE").when(F.col("confidence") >= 0.80, "GLOBAL").otherwise("NONE").alias("path"))
    return I.evidence_hits(k)


# Context

@query(
    """+ d AS (SELECT r.event_id, r.kickoff, o.home AS odds_home, p.source AS model_source, greatest(r.kickoff, p.captured_at) AS data_updated_at FROM results r LEFT JOIN odds o ON r.event_id = o.event_id LEFT JOIN (SELECT * FROM predictions WHERE source <> 's4') p ON r.event_id = p.event_id)
       SELECT event_id, odds_home, model_source, data_updated_at FROM d""",
    ("results", "odds", "predictions"),
)
def j1_enrich(spark, sf):
    p = T.predictions(spark, sf).where("source <> 's4'").select("event_id", "source", F.col("captured_at").alias("updated_at"))
    x = C.enrich(T.results(spark, sf).select("event_id", F.col("kickoff").alias("updated_at")), {"odds": T.odds(spark, sf).select("event_id", "home"), "model": p})
    return x.select("event_id", "odds_home", "model_source", "data_updated_at")


@query("SELECT event_id, max(home) FILTER (source = 'click' AND minute % 2 = 0) AS click_even, max(home) FILTER (source = 'view' AND minute % 2 = 1) AS view_odd FROM live_stats GROUP BY 1", ("live_stats",))
def a12_pivot_latest(spark, sf):
    x = T.live_stats(spark, sf).select("event_id", "source", F.when(F.col("minute") % 2 == 0, "even").otherwise("odd").alias("market"), F.col("home").alias("value"))
    return C.pivot_latest(x, {"click_even": ("click", "even"), "view_odd": ("view", "odd")})


@query("SELECT event_id, 'a' AS source, home FROM odds UNION ALL SELECT event_id, 'b', draw FROM odds WHERE event_id % 2 = 0", ("odds",))
def u3_expand_archive(spark, sf):
    o = T.odds(spark, sf)
    w = o.select("event_id", F.lit(None).cast("timestamp").alias("captured_at"), *[F.col(c).alias(f"a_{c}") for c in ("home", "draw", "away")], F.when(F.col("event_id") % 2 == 0, F.col("draw")).alias("b_home"), F.col("draw").alias("b_draw"), F.col("away").alias("b_away"))
    return C.expand_archive(w, ["a", "b"]).select("event_id", "source", "home")


@query("SELECT 'orders' AS source, event_id, 'H' AS side, 'k' || home_id AS name FROM results UNION ALL SELECT 'orders', event_id, 'A', 'k' || away_id FROM results", ("results",))
def u1_observations(spark, sf):
    f = T.results(spark, sf).select("event_id", F.col("kickoff").alias("observed_at"), F.concat(F.lit("k"), "home_id").alias("home"), F.concat(F.lit("k"), "away_id").alias("away"))
    return C.observations({"orders": f}).drop("observed_at")


@query("SELECT event_id, kickoff FROM results WHERE event_id % 2 = 0 UNION SELECT event_id, kickoff FROM results WHERE event_id % 3 = 0", ("results",))
def u2_canonical_events(spark, sf):
    r = T.results(spark, sf)
    return C.canonical_events(r.where("event_id % 2 = 0"), r.where("event_id % 3 = 0"))


@query(
    """SELECT event_id, captured_at, snapshot_id FROM (SELECT h.*, row_number() OVER (PARTITION BY event_id ORDER BY captured_at DESC, snapshot_id DESC) AS n FROM odds_history h WHERE captured_at <= kickoff AND kickoff >= TIMESTAMP '2024-01-29 12:00:00') WHERE n = 1""",
    ("odds_history",),
)
def m4_capture_prematch(spark, sf):
    h = T.odds_history(spark, sf)
    e = h.select("event_id", F.lit("feed").alias("source"), F.lit("1X2").alias("market"), "captured_at", "snapshot_id")
    out = C.capture_prematch(e, h.select("event_id", "kickoff").distinct(), e.limit(0), F.expr("TIMESTAMP '2024-01-29 12:00:00'"))
    return out.select("event_id", "captured_at", "snapshot_id")


@query("SELECT r.event_id, CASE WHEN p.source = 's1' THEN 'MODEL' ELSE 'PENDING' END AS status FROM results r JOIN predictions p ON r.event_id = p.event_id", ("results", "predictions"))
def m11_materialize_pending(spark, sf):
    a = T.predictions(spark, sf).where("source = 's1'").select("event_id", F.lit("MODEL").alias("status"), F.col("captured_at").alias("checked_at"))
    return C.materialize_pending(T.results(spark, sf), a).select("event_id", "status")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN draw WHEN event_id % 5 = 0 THEN away ELSE home END AS home, CASE WHEN event_id % 3 = 0 THEN 1 WHEN event_id % 5 = 0 THEN 2 END AS overridden_by FROM odds", ("odds",))
def m29_override(spark, sf):
    o = T.odds(spark, sf)
    return C.override(o.select("event_id", "home"), [o.where("event_id % 3 = 0").select("event_id", F.col("draw").alias("home")), o.where("event_id % 5 = 0").select("event_id", F.col("away").alias("home"))], "event_id", "home > 0")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN draw ELSE home END AS home, away FROM odds", ("odds",))
def m30_override_fields(spark, sf):
    o = T.odds(spark, sf)
    p = o.select("event_id", F.when(F.col("event_id") % 3 == 0, F.col("draw")).alias("home"), F.lit(None).cast("double").alias("away"))
    return C.override_fields(o.select("event_id", "home", "away"), p, "event_id")


@query("SELECT team, count(DISTINCT player) AS players, sum(minutes) AS minutes, CAST(sum(goals) AS BIGINT) AS goals FROM players GROUP BY 1", ("players",))
def a16_player_aggregate(spark, sf):
    return C.player_aggregate(T.players(spark, sf))


@query(
    "SELECT event_id, count(*) FILTER (line % 2 = 0 AND minutes > 0) AS n_h, count(*) FILTER (line % 2 = 1 AND minutes > 0) AS n_a, CASE WHEN count(*) FILTER (line % 2 = 0 AND minutes > 0) >= 2 AND count(*) FILTER (line % 2 = 1 AND minutes > 0) >= 2 THEN 'OK' WHEN count(*) FILTER (minutes > 0) > 0 THEN 'PARTIAL' ELSE 'SOURCE' END AS status FROM players GROUP BY 1",
    ("players",),
)
def a18_match_stat_quality(spark, sf):
    return C.match_stat_quality(T.players(spark, sf).withColumn("side", F.when(F.col("line") % 2 == 0, "H").otherwise("A")), 2)


@query(
    """+ s AS (SELECT event_id, line % 2 AS side, player, max(minutes) AS minutes FROM players WHERE line < 5 GROUP BY 1, 2, 3), l AS (SELECT event_id, line % 2 AS side, player, max(goals = 1) AS starter FROM players WHERE line > 2 GROUP BY 1, 2, 3)
       SELECT coalesce(s.event_id, l.event_id) AS event_id, coalesce(s.side, l.side) AS side, coalesce(s.player, l.player) AS player, minutes, starter, minutes IS NOT NULL AS from_stats FROM s FULL JOIN l ON s.event_id = l.event_id AND s.side = l.side AND s.player = l.player""",
    ("players",),
)
def src15_player_rows(spark, sf):
    p = T.players(spark, sf).withColumn("side", F.col("line") % 2)
    return C.player_rows(p.where("line < 5").withColumn("rating", F.lit(None).cast("double")), p.where("line > 2").withColumn("starter", F.col("goals") == 1)).drop("rating")


@query(
    f"""+ c AS (SELECT event_id, CASE WHEN home >= draw AND home >= away THEN 'H' WHEN draw >= away THEN 'D' ELSE 'A' END AS pick FROM predictions WHERE source <> 's2') , s(segment) AS (VALUES ('0-15'), ('16-30'), ('31-45'), ('46-60'), ('61-75'), ('76-FT'))
        SELECT r.event_id, segment, pick, CASE WHEN pick IN ('H', 'A') THEN pick END AS expected, CASE WHEN pick IN ('H', 'A') THEN 'CONSENSUS' ELSE 'NONE' END AS basis, CASE WHEN pick IS NULL THEN 0 ELSE 40 END AS coverage FROM results r LEFT JOIN c ON r.event_id = c.event_id, s""",
    ("predictions", "results"),
)
def md9_scenarios(spark, sf):
    p = T.predictions(spark, sf).where("source <> 's2'").select("event_id", E.argmax_hda(F.col("home"), F.col("draw"), F.col("away")).alias("pick"))
    none = T.results(spark, sf).select("event_id", F.lit("H").alias("side"), F.lit("").alias("form")).where("1 = 0")
    return C.scenarios(T.results(spark, sf), p, none)


@query(
    f"""+ {FORM_POINTS}, c AS (SELECT event_id, CASE WHEN home >= draw AND home >= away THEN 'H' WHEN draw >= away THEN 'D' ELSE 'A' END AS pick FROM predictions WHERE source <> 's2'), s(segment) AS (VALUES ('0-15'), ('16-30'), ('31-45'), ('46-60'), ('61-75'), ('76-FT')),
        x AS (SELECT r.event_id, pick, h, a, CASE WHEN h - a >= 1 THEN 'H' WHEN a - h >= 1 THEN 'A' END AS ahead FROM results r LEFT JOIN c ON r.event_id = c.event_id LEFT JOIN p ON r.event_id = p.event_id)
        SELECT event_id, segment, pick, CASE WHEN pick IN ('H', 'A') THEN pick ELSE ahead END AS expected, CASE WHEN pick IN ('H', 'A') THEN 'CONSENSUS' WHEN ahead IS NOT NULL THEN 'FORM' ELSE 'NONE' END AS basis,
          CASE WHEN pick IS NULL THEN 0 ELSE 40 END + CASE WHEN h IS NULL THEN 0 ELSE 30 END + CASE WHEN a IS NULL THEN 0 ELSE 30 END AS coverage FROM x, s""",
    ("predictions", "results"),
)
def md9_scenarios_form(spark, sf):
    res = T.results(spark, sf)
    p = T.predictions(spark, sf).where("source <> 's2'").select("event_id", E.argmax_hda(F.col("home"), F.col("draw"), F.col("away")).alias("pick"))
    return C.scenarios(res, p, M.team_form_summary(res, res))


@query(
    f"""+ x AS (SELECT *, row_number() OVER (PARTITION BY CAST(kickoff AS DATE), home_id, away_id ORDER BY event_id DESC) AS n FROM results), y AS (SELECT *, epoch({NOW}) - epoch(kickoff) <= 540 * 86400 AS i FROM x WHERE n = 1)
        SELECT event_id FROM (SELECT *, row_number() OVER (PARTITION BY tournament ORDER BY kickoff DESC, event_id DESC) AS r FROM y WHERE i) WHERE r <= 700""",
    ("results",),
)
def md4_clean_history(spark, sf):
    return C.clean_history([T.results(spark, sf)], F.expr(NOW)).select("event_id")


@query(
    """+ r AS (SELECT event_id, 'k' || home_id AS h, 'k' || away_id AS a, CAST(kickoff AS DATE) + CAST(event_id % 5 - 2 AS INTEGER) AS d FROM results), t AS (SELECT event_id, 'k' || home_id AS h, 'k' || away_id AS a, CAST(kickoff AS DATE) AS d FROM results)
       SELECT r.event_id AS row_id, min(t.event_id) AS event_id FROM r JOIN t ON r.h = t.h AND r.a = t.a AND abs(date_diff('day', r.d, t.d)) <= 1 GROUP BY 1 HAVING count(DISTINCT t.event_id) = 1""",
    ("results",),
)
def j8_attach_rollover(spark, sf):
    t = T.results(spark, sf).select("event_id", F.concat(F.lit("k"), "home_id").alias("home_key"), F.concat(F.lit("k"), "away_id").alias("away_key"), "kickoff")
    r = t.withColumn("source_date", F.date_add(F.to_date("kickoff"), (F.col("event_id") % 5 - 2).cast("int"))).withColumnRenamed("event_id", "row_id").drop("kickoff")
    return C.attach_rollover(r, t)


@query(
    """+ t AS (SELECT event_id, 'k' || home_id AS h, 'k' || away_id AS a, CAST(kickoff AS DATE) AS d FROM results), r AS (SELECT event_id, h, a, d + CAST(event_id % 3 - 1 AS INTEGER) AS d FROM t)
       SELECT r.event_id AS row_id, min(t.event_id) AS event_id FROM r JOIN t ON r.h = t.h AND r.a = t.a AND abs(date_diff('day', r.d, t.d)) <= 1 GROUP BY 1 HAVING count(DISTINCT t.event_id) = 1""",
    ("results",),
)
def j8_attach_rollover_all(spark, sf):
    t = T.results(spark, sf).select("event_id", F.concat(F.lit("k"), "home_id").alias("home_key"), F.concat(F.lit("k"), "away_id").alias("away_key"), "kickoff")
    r = t.select(F.col("event_id").alias("row_id"), "home_key", "away_key", F.date_add(F.to_date("kickoff"), (F.col("event_id") % 3 - 1).cast("int")).alias("source_date"))
    return C.attach_rollover(r, t)


@query(
    """+ t AS (SELECT event_id, home_id AS h, away_id AS a, CAST(kickoff AS DATE) AS d FROM results), s AS (SELECT event_id AS row_id, h, a, d FROM t),
       n AS (SELECT h AS name, CASE WHEN h % 3 = 0 THEN (h + 1) % 40 ELSE h END AS key, 0 AS rank, 'CONTEXT' AS tier FROM (SELECT DISTINCT h FROM t) UNION ALL SELECT i, i, 1, 'MASTER' FROM range(40) x(i)),
       c AS (SELECT s.row_id, x.rank, x.tier, count(DISTINCT t.event_id) AS n, min(t.event_id) AS event_id FROM s JOIN n x ON x.name = s.h JOIN n y ON y.name = s.a AND y.rank = x.rank JOIN t ON t.h = x.key AND t.a = y.key AND t.d = s.d GROUP BY 1, 2, 3)
       SELECT row_id, event_id, tier FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY rank) AS r FROM c WHERE n = 1) WHERE r = 1""",
    ("results",),
)
def j7_attach_tiered(spark, sf):
    t = T.results(spark, sf).select("event_id", F.col("home_id").alias("home_key"), F.col("away_id").alias("away_key"), "kickoff")
    r = t.select(F.col("event_id").alias("row_id"), F.col("home_key").alias("home"), F.col("away_key").alias("away"), F.to_date("kickoff").alias("source_date"))
    names = t.select(F.col("home_key").alias("name"), F.col("home_key").alias("target_key")).distinct()
    context = names.withColumn("target_key", F.expr("CASE WHEN name % 3 = 0 THEN (name + 1) % 40 ELSE name END"))
    return C.attach_tiered(r, t, [("CONTEXT", context), ("MASTER", names)])


@query(
    """+ t AS (SELECT event_id, home_id AS h, away_id AS a, CAST(kickoff AS DATE) AS d FROM results), s AS (SELECT event_id AS row_id, h, a, d FROM t),
       n AS (SELECT i AS name, i AS key, 0 AS rank, 'CONTEXT' AS tier FROM range(20) x(i) UNION ALL SELECT i, i, 1, 'MASTER' FROM range(40) x(i)),
       c AS (SELECT s.row_id, x.rank, x.tier, count(DISTINCT t.event_id) AS n, min(t.event_id) AS event_id FROM s JOIN n x ON x.name = s.h JOIN n y ON y.name = s.a AND y.rank = x.rank JOIN t ON t.h = x.key AND t.a = y.key AND t.d = s.d GROUP BY 1, 2, 3)
       SELECT row_id, event_id, tier FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY rank) AS r FROM c WHERE n = 1) WHERE r = 1""",
    ("results",),
)
def j7_attach_tiered_all(spark, sf):
    t = T.results(spark, sf).select("event_id", F.col("home_id").alias("home_key"), F.col("away_id").alias("away_key"), "kickoff")
    r = t.select(F.col("event_id").alias("row_id"), F.col("home_key").alias("home"), F.col("away_key").alias("away"), F.to_date("kickoff").alias("source_date"))
    names = t.select(F.col("home_key").alias("name"), F.col("home_key").alias("target_key")).distinct()
    return C.attach_tiered(r, t, [("CONTEXT", names.where("name < 20")), ("MASTER", names)])


@query(
    """SELECT r.event_id, o.home, o.draw, o.away, round(1/o.home/(1/o.home+1/o.draw+1/o.away), 6) AS fair_home, CAST(1 AS BIGINT) AS channels, round(o.home * (p.home / 100) - 1, 6) AS home_edge, CASE WHEN greatest(o.home * (p.home / 100), o.draw * (p.draw / 100), o.away * (p.away / 100)) - 1 > 0 THEN 'CANDIDATE_POSITIVE_EV' ELSE 'NO_POSITIVE_EV' END AS state FROM results r JOIN odds o ON r.event_id = o.event_id JOIN predictions p ON p.event_id = r.event_id WHERE confirmed""",
    ("results", "odds", "predictions"),
)
def x1_match_board(spark, sf):
    r = T.results(spark, sf).withColumn("selling", F.col("confirmed"))
    e = T.predictions(spark, sf).select("event_id", "source", *[(F.col(c) / 100).alias(k) for c, k in (("home", "h"), ("draw", "d"), ("away", "a"))])
    d = M.decide(e, T.odds(spark, sf), [f"s{n}" for n in range(6)])
    return C.match_board(r, T.odds(spark, sf), e, d).select("event_id", "home", "draw", "away", r6("fair_home").alias("fair_home"), "channels", r6("home_edge").alias("home_edge"), "state")


@query()
def md3_goal_glm(spark, sf):
    res = T.results(spark, sf)
    return C.goal_glm(res, res.where(f"kickoff >= {NOW}").drop("home_goals", "away_goals"), F.expr(NOW)).select("event_id", *[F.round(c, 4).alias(c) for c in ("lh", "la", "h", "d", "a", "over25")])


@query()
def md2_gap_probabilities(spark, sf):
    res = T.results(spark, sf)
    return M.gap_probabilities(M.pi_ratings(res), res, F.expr(NOW))


@query()
def j13_connected_history(spark, sf):
    res = T.results(spark, sf)
    return C.connected_history(res, res)


@query(
    """+ b AS (SELECT event_id, row_id, minute, home, home + 10 - minute % 7 * 4 AS xg_away, minute % 11 AS s FROM live_stats), c AS (SELECT row_id, CASE WHEN home - xg_away >= 0.25 THEN 2 WHEN home - xg_away <= -0.25 THEN -2 ELSE 0 END + CASE WHEN s - 5 >= 3 THEN 1 WHEN s - 5 <= -3 THEN -1 ELSE 0 END AS control FROM b)
       , d AS (SELECT row_id AS event_id, control, CASE WHEN control >= 2 THEN 'H' WHEN control <= -2 THEN 'A' END AS actual, CASE row_id % 3 WHEN 0 THEN 'H' WHEN 1 THEN 'A' ELSE CASE WHEN row_id % 2 = 0 THEN 'H' END END AS expected FROM c)
       SELECT *, CASE WHEN actual IS NULL OR expected IS NULL THEN 'WAIT' WHEN actual = expected THEN 'CONFIRM' ELSE 'CONTRADICT' END AS status FROM d""",
    ("live_stats",),
)
def md8_expected_actual(spark, sf):
    x = T.live_stats(spark, sf).where("home IS NOT NULL").select(F.col("row_id").alias("event_id"), "minute", F.col("home").alias("xg_home"), (F.col("home") + 10 - F.col("minute") % 7 * 4).alias("xg_away"), (F.col("minute") % 11).cast("double").alias("shots_home"), F.lit(5.0).alias("shots_away"))
    # The side expected comes from the scenario table: a consensus for two of three rows, else form.
    e = F.col("event_id")
    pick = F.when(e % 3 == 0, "H").when(e % 3 == 1, "A").otherwise("D")
    form = x.where(e % 2 == 0).select("event_id", F.inline(F.array(*[F.struct(F.lit(s).alias("side"), F.lit(f).alias("form")) for s, f in (("H", "WWW"), ("A", "LLL"))])))
    return M.expected_actual(x, C.scenarios(x, x.select("event_id", pick.alias("pick")), form)).select("event_id", "control", "actual", "expected", "status")


@query(
    """SELECT event_id, 'CAPTURE_ODDS' AS action, 2 AS priority FROM results WHERE event_id % 3 = 0 UNION ALL SELECT event_id, 'LINK_SOURCE', 3 FROM results WHERE event_id % 3 > 0 AND event_id % 5 = 0""",
    ("results",),
)
def q2_repair_queue(spark, sf):
    r = T.results(spark, sf)
    health = M.data_health(r.select("event_id", "kickoff"), r.where("event_id % 3 > 0"), r.where("event_id % 5 > 0"), r, F.expr("TIMESTAMP '1970-01-01 00:00:00'"))
    return M.repair_queue(health).select("event_id", "action", "priority")


@query(
    """+ l AS (SELECT DISTINCT event_id FROM live_stats), a AS (SELECT event_id, max(captured_at) AS t FROM live_stats WHERE source = 'click' GROUP BY 1), b AS (SELECT event_id, max(captured_at) AS t FROM live_stats WHERE source = 'view' GROUP BY 1)
       SELECT event_id, concat_ws(',', CASE WHEN a.t IS NULL OR epoch(TIMESTAMP '2024-01-30 00:00:00') - epoch(a.t) > 86400 THEN 'score' END, CASE WHEN b.t IS NULL OR epoch(TIMESTAMP '2024-01-30 00:00:00') - epoch(b.t) > 86400 THEN 'stats' END) AS stale_layers FROM l LEFT JOIN a USING (event_id) LEFT JOIN b USING (event_id)""",
    ("live_stats",),
)
def q4_l8_live_guard(spark, sf):
    x = T.live_stats(spark, sf)
    return V.guard_stale(x.select("event_id").distinct(), {"score": x.where("source = 'click'"), "stats": x.where("source = 'view'")}, F.expr("TIMESTAMP '2024-01-30 00:00:00'"), 1440)


@query("SELECT r.event_id, coalesce(p.source, 'SOURCE_GAP') AS coverage FROM results r LEFT JOIN (SELECT * FROM predictions WHERE source IN ('s1', 's2')) p ON r.event_id = p.event_id", ("results", "predictions"))
def l9_source_gap(spark, sf):
    p = T.predictions(spark, sf).where("source IN ('s1', 's2')").select("event_id", F.col("source").alias("provider"))
    return V.source_gap(T.results(spark, sf).select("event_id"), p).select("event_id", "coverage")


@query(
    """+ w AS (SELECT event_id, captured_at, k AS shift, time_bucket(INTERVAL 30 MINUTES, captured_at) + (k * 30) * INTERVAL 1 MINUTE AS until, home FROM odds_history, range(1, 5) r(k)) SELECT event_id, until, round(max(home) - min(home), 6) AS spread, count(*) AS n FROM w GROUP BY 1, 2""",
    ("odds_history",),
)
def l4_sliding_range(spark, sf):
    return V.sliding_range(T.odds_history(spark, sf)).withColumn("spread", r6("spread"))


@query("SELECT user_id AS event_id, max(ts) AS captured_at FROM events GROUP BY 1")
def m12_append_history(spark, sf):
    e = T.table(spark, sf, "events").groupBy(F.col("user_id").alias("event_id")).agg(F.max("ts").alias("captured_at"))
    return S.append_absent(e.where("event_id % 2 = 0"), e, ["event_id", "captured_at"])


@query("""SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, length(l[i]) AS n_chars, length(array_to_string(l[i + 1:i + 2], ' ')) AS n_after FROM (SELECT doc_id, string_split(text, chr(10)) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents) WHERE regexp_matches(l[i], '[0-9]')""")
def src8_line_windows(spark, sf):
    x = X.line_windows(T.table(spark, sf, "documents"), "[0-9]", 2)
    return x.select("doc_id", "pos", F.length("line").cast("long").alias("n_chars"), F.length("after").cast("long").alias("n_after"))


@query("""+ l AS (SELECT doc_id, i, l[i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)) SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, length(last_value(CASE WHEN regexp_matches(line, '^[A-M]') THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING)) AS n_header FROM l""")
def src7_fill_down(spark, sf):
    x = X.fill_down(X.text_lines(T.table(spark, sf, "documents")), "^[A-M]")
    return x.select("doc_id", "pos", F.length("header").cast("long").alias("n_header"))


@query(
    """SELECT datediff('day', DATE '1970-01-01', CAST(kickoff AS DATE)) * 10 + CAST(tournament[1] AS INTEGER) AS page_id, tournament AS league, '1' || event_id % 10 || ':3' || event_id % 7 AS clock, 'k' || home_id AS home, 'k' || away_id AS away, 'b' || event_id % 5 AS book,
         round(o.home, 2) AS odds_home, round(o.draw, 2) AS odds_draw, round(o.away, 2) AS odds_away, round(1 / round(o.home, 2) / (1 / round(o.home, 2) + 1 / round(o.draw, 2) + 1 / round(o.away, 2)), 6) AS fair_home
       FROM results r JOIN odds o USING (event_id) WHERE event_id % 4 > 1""",
    ("results", "odds"),
)
def src7_odds_table(spark, sf):
    """Day pages of a league, made from results and odds: a heading, the columns' names, a row per game; some games are in play or finished."""
    x = T.results(spark, sf).join(T.odds(spark, sf), "event_id")
    row = F.expr("""concat('<tr><td>', array_join(array(concat('1', event_id % 10, ':3', event_id % 7), concat('<b>k', home_id, '</b>'), '-', concat('k', away_id),
      CASE event_id % 4 WHEN 0 THEN 'In-Play' WHEN 1 THEN 'finished' ELSE '' END, concat('b', event_id % 5), string(round(home, 2)), string(round(draw, 2)), string(round(away, 2)), '5%'), '</td><td>'), '</td></tr>')""")
    x = x.select(F.expr("datediff(to_date(kickoff), DATE '1970-01-01') * 10 + int(substring(tournament, 1, 1))").cast("bigint").alias("page_id"), "tournament", row.alias("row"))
    rows = F.array_join(F.collect_list("row"), "\n")
    pages = x.groupBy("page_id", "tournament").agg(F.concat(F.lit("<table><tr><td>"), "tournament", F.lit("</td></tr><tr><th>BN</th><th>Margin</th></tr>"), rows, F.lit("</table>")).alias("html"))
    p = E.devig(F.col("odds_home"), F.col("odds_draw"), F.col("odds_away"))
    return X.odds_table(pages).drop("pos").withColumn("fair_home", r6(p["h"]))


@query(
    """+ x AS (SELECT r.event_id, home_goals, away_goals, r.event_id * 7 % 101 AS u, 100 - r.event_id * 7 % 101 + CASE WHEN r.event_id % 5 = 0 THEN 1 ELSE 0 END AS o, floor(10 + r.event_id % 990 / 11.0 * 0.5) + r.event_id % 100 / 100.0 AS average FROM results r)
       SELECT event_id, CASE WHEN u + o = 100 THEN u END AS under, CASE WHEN u + o = 100 THEN o END AS over, CASE WHEN u + o = 100 AND event_id % 3 < 2 THEN CASE WHEN o > u THEN 'Over' ELSE 'Under' END END AS prediction,
         CASE WHEN u + o = 100 AND event_id % 3 < 2 THEN home_goals END AS home_score, CASE WHEN u + o = 100 AND event_id % 3 < 2 THEN away_goals END AS away_score, CASE WHEN u + o = 100 AND event_id % 3 < 2 THEN round(average, 2) END AS average FROM x""",
    ("results",),
)
def src8_market_fields(spark, sf):
    """Texts of a day, made from results: a line per game, then its market on one line, on four, or as a pair alone."""
    x = T.results(spark, sf).selectExpr(
        "event_id", "to_date(kickoff) AS day", "home_goals AS h", "away_goals AS a", "event_id * 7 % 101 AS u", "100 - event_id * 7 % 101 + IF(event_id % 5 = 0, 1, 0) AS o",
        "concat(bigint(floor(10 + event_id % 990 / 11.0D * 0.5D)), '.', lpad(string(event_id % 100), 2, '0')) AS average",
    )
    market = F.expr("""CASE event_id % 3 WHEN 0 THEN concat(u, ' ', o, IF(o > u, 'Over', 'Under'), h, ' - ', a, average, '59°F-\n\n\n')
      WHEN 1 THEN concat(u, '% ', o, '%\n', IF(o > u, 'OVER', 'under'), '\n', h, ' - ', a, '\n', average) ELSE concat(u, '% ', o, '%\n\n\n') END""")
    docs = x.groupBy("day").agg(F.array_join(F.collect_list(F.concat(F.lit("event "), "event_id", F.lit("\n"), market)), "\n").alias("text")).withColumnRenamed("day", "doc_id")
    y = X.market_fields(X.line_windows(docs, "^event [0-9]+$", 4))
    return y.select(F.expr("bigint(substring(line, 7))").alias("event_id"), "under", "over", "prediction", "home_score", "away_score", "average")


@query(
    """+ t AS (SELECT page_id, trim(regexp_replace(regexp_replace(html, '(?s)<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS t FROM pages), s AS (SELECT page_id, regexp_extract(t, '(?is)(the.*?)(zzz|$)', 1) AS s FROM t)
       SELECT page_id, length(s) AS n_chars, len(regexp_extract_all(s, '(\\d{1,3}(\\.\\d+)?)\\s*%')) AS n_percents FROM s WHERE length(s) > 0"""
)
def src6_sections(spark, sf):
    x = X.sections(T.table(spark, sf, "pages"), "the", "zzz")
    return x.select("page_id", F.length("section").alias("n_chars"), F.size("percents").alias("n_percents"))


@query("SELECT page_id, sha256(html) AS digest FROM pages WHERE page_id % 2 = 0")
def x30_replay(spark, sf):
    p = T.table(spark, sf, "pages")
    records = p.select("page_id", F.when(F.col("page_id") % 2 == 0, F.sha2(F.col("html"), 256)).otherwise("gone").alias("digest"))
    return X.replay(records, p)[0]


@query(
    """+ b AS (SELECT CAST(row_id AS VARCHAR) AS number, home, away, minute FROM live_stats), q AS (SELECT number, 'i' || number AS id, CAST(1.0 AS DOUBLE) + minute / 10.0 AS home FROM b) SELECT number, id, home FROM q WHERE home BETWEEN 1.01 AND 100 AND CAST(number AS BIGINT) % 4 > 0""",
    ("live_stats",),
)
def src19_reconcile_quotes(spark, sf):
    b = T.live_stats(spark, sf).select(F.col("row_id").cast("string").alias("number"), "row_id", "minute")
    q = b.select("number", F.concat(F.lit("i"), "number").alias("id"), (F.lit(1.0) + F.col("minute") / F.lit(10.0)).alias("home"), F.lit(2.0).alias("draw"), F.lit(2.0).alias("away"))
    index = b.select("number", F.when(F.col("row_id") % 4 == 0, "other").otherwise(F.concat(F.lit("i"), "number")).alias("id"))
    return X.reconcile_quotes(q, index).select("number", "id", "home")


@query(
    """SELECT CAST(event_id // 100 AS BIGINT) AS capture_id, 'i' || event_id AS source_id, 'n' || event_id AS number, tournament AS league, TIMESTAMP '1998-01-01 12:00:00' + to_minutes(event_id % 60) AS kickoff,
         (200 + event_id * 13 % 400) / 100.0::DOUBLE AS home, CAST(3 AS DOUBLE) AS draw, (110 + event_id * 29 % 500) / 100.0::DOUBLE AS away
       FROM results WHERE event_id % 5 > 0 AND event_id % 7 > 0 AND event_id % 11 > 0 AND event_id % 13 > 0 AND event_id % 17 > 0 AND event_id % 23 > 0""",
    ("results",),
)
def src19_quotes_from_xml(spark, sf):
    """Captures of a hundred events: some quotes have no price row, prices or clocks out of bounds or come twice, some index rows another id or come twice."""
    every = lambda k, yes, no: f"CASE WHEN event_id % {k} = 0 THEN {yes} ELSE {no} END"
    money = lambda low, k, m: f"format_string('%.2f', ({low} + event_id * {k} % {m}) / 100.0D)"
    price = f"""concat('<row updatetime="', {every(23, "'1998-01-01 09:00:00'", "'1997-12-31 22:00:00'")}, '" win="', {every(5, "'0.50'", money(200, 13, 400))}, '" draw="3" lost="', {money(110, 29, 500)}, '"/>')"""
    head = """concat('<m matchnum="n', event_id, '" id="i', event_id, '" home="h', home_id, '" away="a', away_id, '" league="', tournament, '">')"""
    again = every(19, f"""concat({head}, '<row updatetime="1997-12-31 22:00:00" win="9" draw="9" lost="9"/></m>')""", "''")
    quote = f"concat({head}, {every(17, chr(39) * 2, price)}, '</m>', {again})"
    day = every(13, "'1998-01-06'", "'1998-01-01'")
    row = f"""concat('<tr class="x" data-processname="n', event_id, '" data-id="', {every(7, "'other'", "concat('i', event_id)")}, '" data-matchdate="', {day}, '" data-matchtime="20:', lpad(event_id % 60, 2, '0'), '"><td>x</td></tr>')"""
    rows = f"concat({row}, {every(11, row, chr(39) * 2)})"
    joined = lambda e: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", F.expr(e).alias("e")))), lambda x: x["e"]), "")
    captures = T.results(spark, sf).groupBy(F.expr("event_id DIV 100").alias("capture_id")).agg(F.concat(F.lit("<xml>"), joined(quote), F.lit("</xml>")).alias("xml"), F.concat(F.lit("<table>"), joined(rows), F.lit("</table>")).alias("html"))
    return X.quotes_from_xml(captures, F.expr("TIMESTAMP '1998-01-01 00:00:00'")).select("capture_id", "source_id", "number", "league", "kickoff", "home", "draw", "away")


@query(
    """+ e AS (SELECT DISTINCT event_id AS row_id, CASE event_id % 5 WHEN 0 THEN NULL ELSE 0.5 + event_id % 6 / 10.0 END AS hs, 0.6 + event_id % 4 / 10.0 AS as_ FROM results)
       SELECT row_id, CASE WHEN hs IS NULL THEN 'NO_CANDIDATE' WHEN least(hs, as_) >= 0.9 THEN 'CLOCK' WHEN greatest(hs, as_) >= 0.9 AND least(hs, as_) < 0.66 THEN 'ONE_SIDE' WHEN least(hs, as_) >= 0.66 THEN 'BELOW_SCORE' ELSE 'DIFFERENT' END AS reason FROM e""",
    ("results",),
)
def md19_near_miss(spark, sf):
    k = F.col("event_id")
    b = T.results(spark, sf).select(k.alias("row_id"), F.when(k % 5 > 0, F.lit(0.5) + (k % 6) / F.lit(10.0)).alias("hs"), (F.lit(0.6) + (k % 4) / F.lit(10.0)).alias("as_"), F.lit(700).alias("gap_seconds"))
    return C.near_miss(b.withColumn("score", F.col("hs")))


@query(
    """+ x AS (SELECT event_id, CAST(floor(event_id % 8) AS INTEGER) AS o, tournament FROM results), y AS (SELECT CASE WHEN o < 7 THEN 4 ELSE 5 END AS "offset", event_id, tournament FROM x), g AS (SELECT "offset", count(*) AS n, count(DISTINCT tournament) AS n_leagues FROM y GROUP BY 1)
       SELECT "offset", n, n_leagues, n >= 8 AND n_leagues >= 3 AS valid, FALSE AS accepted FROM g""",
    ("results",),
)
def a19_clock_cohort(spark, sf):
    shift = F.when(F.col("event_id") % 8 < 7, 60).otherwise(75)
    c = T.results(spark, sf).select("event_id", F.col("tournament").alias("league"), "kickoff", F.timestamp_seconds(F.unix_seconds("kickoff") + shift * 60).alias("source_clock"))
    return R.clock_cohort(c)


@query(
    """SELECT o_orderpriority AS code, o_orderpriority AS league, count(*) AS fixtures, count(*) >= 3 AS accepted FROM orders GROUP BY 1"""
)
def a20_competition_cohort(spark, sf):
    x = T.results(spark, sf).select("event_id", F.col("tournament").alias("code"), F.col("tournament").alias("league"), "home_id", "away_id")
    return R.competition_cohort(x).drop("teams")


@query(
    """SELECT event_id, row_id FROM (SELECT *, row_number() OVER (PARTITION BY CAST(captured_at AS DATE) ORDER BY captured_at DESC, row_id) AS n, dense_rank() OVER (ORDER BY CAST(captured_at AS DATE) DESC) AS d FROM live_stats) WHERE d <= 3 AND n <= 20""",
    ("live_stats",),
)
def t2_due_under_budget(spark, sf):
    return R.due_under_budget(T.live_stats(spark, sf), "captured_at", 3, 20, "row_id").select("event_id", "row_id")
