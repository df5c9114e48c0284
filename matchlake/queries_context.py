"""Registered queries of movement alerts, market boards, form boards, name maps and titled stats."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchlake import testdata as T
from matchlake.operators import identity as I
from matchlake.plans import movement as M
from matchlake.queries import NOW, query, r6
from matchlake.sources import feeds as X

_NEAR = ", ".join(f"min(struct_pack(g := abs(age - {s}), c := captured_at, i := snapshot_id, h := h, d := d, a := a)) FILTER (abs(age - {s}) <= {t}) AS b{n}" for n, (s, t, _) in M.BACK.items())
_SPREAD = ", ".join(f"CASE WHEN count(*) FILTER (age <= 86400) >= 2 THEN max({c}) FILTER (age <= 86400) - min({c}) FILTER (age <= 86400) END AS v{c}" for c in "hda")
_EACH = " UNION ALL ".join(f"SELECT event_id, {n} AS ord, '{c.upper()}' AS side, l.o{c} AS odds, l.c AS captured_at, l.m AS conf, v{c} AS vol, l.{c} - b24.{c} AS d24, l.{c} - b2.{c} AS d2, l.{c} - b1.{c} AS d1, b24 IS NOT NULL AND b2 IS NOT NULL AND b1 IS NOT NULL AS whole FROM g" for n, c in enumerate("hda"))


@query(
    f"""+ f AS (SELECT event_id, snapshot_id, captured_at, home, draw, away, 0.80 + (snapshot_id % 20) / 100 AS conf, floor(epoch(TIMESTAMP '2024-01-30')) - floor(epoch(captured_at)) AS age, 1/home/(1/home+1/draw+1/away) AS h, 1/draw/(1/home+1/draw+1/away) AS d, 1/away/(1/home+1/draw+1/away) AS a FROM odds_history WHERE captured_at <= TIMESTAMP '2024-01-30'),
        g AS (SELECT event_id, max(struct_pack(c := captured_at, i := snapshot_id, h := h, d := d, a := a, oh := home, od := draw, oa := away, m := conf)) AS l, {_NEAR}, {_SPREAD} FROM f GROUP BY 1), s AS ({_EACH}),
        t AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY greatest(coalesce(abs(d24), 0), coalesce(abs(d2), 0), coalesce(abs(d1), 0), coalesce(vol, 0)) DESC, ord) AS r FROM s),
        n AS (SELECT *, CASE WHEN (d2 * d1 < 0 AND abs(d2) >= 0.03 AND abs(d1) >= 0.02) OR (d24 * d2 < 0 AND abs(d24) >= 0.03 AND abs(d2) >= 0.03) THEN 'REVERSAL' WHEN d1 >= 0.02 THEN '1H STEAM' WHEN d1 <= -0.02 THEN '1H DRIFT' WHEN d2 >= 0.03 THEN '2H STEAM' WHEN d2 <= -0.03 THEN '2H DRIFT' WHEN d24 >= 0.05 THEN '24H STEAM' WHEN d24 <= -0.05 THEN '24H DRIFT'
          WHEN vol >= 0.08 THEN 'HIGH VOLATILITY' WHEN NOT whole THEN 'COLLECTING' ELSE 'STABLE' END AS sig, greatest(coalesce(abs(d24) / 0.05, 0), coalesce(abs(d2) / 0.03, 0), coalesce(abs(d1) / 0.02, 0), coalesce(vol / 0.08, 0)) AS high, coalesce(d1, d2, d24) AS way, CASE event_id % 3 WHEN 0 THEN 'H' WHEN 1 THEN 'A' END AS model_side FROM t WHERE r = 1)
        SELECT event_id, side, round(odds, 6) AS odds, round(d24, 6) AS move_24h, round(d2, 6) AS move_2h, round(d1, 6) AS move_1h, round(vol, 6) AS volatility, CASE WHEN conf < 0.88 THEN 'MATCH CHECK' ELSE sig END AS signal, round(CASE WHEN conf < 0.88 OR sig IN ('STABLE', 'COLLECTING') THEN 0 ELSE high END, 6) AS alert_score, model_side,
          CASE WHEN model_side IS NULL THEN 'NO MODEL' WHEN way IS NULL THEN 'COLLECTING' WHEN way > 0 THEN CASE WHEN model_side = side THEN 'YES' ELSE 'NO' END WHEN model_side = side THEN 'CONFLICT' ELSE 'NEUTRAL' END AS alignment FROM n""",
    ("odds_history",),
)
def md6_movement_board(spark, sf):
    h = T.odds_history(spark, sf).withColumn("match_confidence", F.lit(0.80) + (F.col("snapshot_id") % 20) / 100)
    targets = h.groupBy("event_id").agg(F.max("kickoff").alias("kickoff"))
    models = targets.select("event_id", F.when(F.col("event_id") % 3 == 0, "H").when(F.col("event_id") % 3 == 1, "A").alias("model_side")).where("model_side IS NOT NULL")
    m = M.movement_board(h, targets, models, F.expr("TIMESTAMP '2024-01-30 00:00:00'"))
    return m.select("event_id", "side", *[r6(c).alias(c) for c in ("odds", "move_24h", "move_2h", "move_1h", "volatility")], "signal", r6("alert_score").alias("alert_score"), "model_side", "alignment")


@query(
    """+ w AS (SELECT r.event_id, kickoff, CASE WHEN r.event_id % 31 = 0 THEN 'Event ended' WHEN r.event_id % 31 = 1 THEN 'InPlay' ELSE '' END AS status, r.event_id % 13 = 0 AS in_play, o.home, o.draw, o.away, CASE WHEN r.event_id % 7 > 0 THEN p.home END AS sh, p.draw AS sd, CASE WHEN r.event_id % 9 > 0 THEN p.away END AS sa, CASE r.event_id % 4 WHEN 0 THEN '1' WHEN 1 THEN 'X' WHEN 2 THEN '2' END AS sp,
        r.event_id % 5 > 0 AS modeled, r.event_id % 17 AS dh, r.event_id % 11 AS dd, r.event_id % 19 AS da, r.event_id % 17 AS ph, r.event_id % 6 AS pd, r.event_id % 23 AS pa FROM results r JOIN odds o ON o.event_id = r.event_id JOIN predictions p ON p.event_id = r.event_id),
      e AS (SELECT *, home * sh / 100 - 1 AS eh, draw * sd / 100 - 1 AS ed, away * sa / 100 - 1 AS ea, CASE WHEN modeled THEN CASE WHEN dh >= dd AND dh >= da THEN 'H' WHEN dd >= da THEN 'D' ELSE 'A' END END AS dc, CASE WHEN modeled THEN CASE WHEN ph >= pd AND ph >= pa THEN 'H' WHEN pd >= pa THEN 'D' ELSE 'A' END END AS pi, CASE sp WHEN '1' THEN 'H' WHEN 'X' THEN 'D' WHEN '2' THEN 'A' END AS ss FROM w), b AS (SELECT *, greatest(eh, ed, ea) AS best FROM e)
      SELECT event_id, CASE WHEN upper(status) LIKE '%ENDED%' OR TIMESTAMP '1997-06-01' >= kickoff + INTERVAL 150 MINUTES THEN 'ENDED' WHEN TIMESTAMP '1997-06-01' < kickoff THEN 'PRE' WHEN in_play OR upper(status) LIKE '%INPLAY%' THEN 'LIVE' ELSE 'CLOSED' END AS phase, round(eh, 6) + 0 AS edge_h, round(ed, 6) + 0 AS edge_d, round(ea, 6) + 0 AS edge_a, round(best, 6) + 0 AS best_edge,
        CASE WHEN eh = best THEN 'H' WHEN ed = best THEN 'D' ELSE 'A' END AS best_side, CASE WHEN eh = best THEN home WHEN ed = best THEN draw ELSE away END AS best_odds, CASE WHEN sh IS NULL OR sa IS NULL THEN 'NO SOURCE MODEL' WHEN best > 0 THEN 'POSITIVE EDGE' ELSE 'NO EDGE' END AS edge_status, dc AS dc_pick, pi AS pi_pick,
        CASE WHEN NOT modeled THEN 'MODEL_UNAVAILABLE' WHEN ss IS NULL THEN 'NO_SOURCE' WHEN ss = dc THEN 'AGREE' ELSE 'CONFLICT' END AS source_dc, CASE WHEN NOT modeled THEN 'LOCAL MODEL UNAVAILABLE' WHEN dc <> pi THEN 'DC/PI CONFLICT' WHEN ss = dc THEN 'ALL AGREE' ELSE 'MODEL CONFLICT' END AS consensus FROM b""",
    ("results", "odds", "predictions"),
)
def md13_market_board(spark, sf):
    k = F.col("event_id")
    p = T.predictions(spark, sf).select("event_id", F.when(k % 7 > 0, F.col("home")).alias("source_h"), F.col("draw").alias("source_d"), F.when(k % 9 > 0, F.col("away")).alias("source_a"))
    model = {"dc_h": 17, "dc_d": 11, "dc_a": 19, "pi_h": 17, "pi_d": 6, "pi_a": 23}
    w = T.results(spark, sf).select("event_id", "kickoff").join(T.odds(spark, sf), "event_id").join(p, "event_id").withColumns({c: k % m for c, m in model.items()})
    w = w.withColumns({
        "status": F.when(k % 31 == 0, "Event ended").when(k % 31 == 1, "InPlay").otherwise(""), "in_play": k % 13 == 0, "modeled": k % 5 > 0,
        "source_pick": F.when(k % 4 == 0, "1").when(k % 4 == 1, "X").when(k % 4 == 2, "2"),
    })
    b = M.market_board(w, F.expr("TIMESTAMP '1997-06-01 00:00:00'"))
    return b.withColumns({c: r6(c) for c in ("edge_h", "edge_d", "edge_a", "best_edge")})


_GAMES = "SELECT event_id, kickoff, 'H' AS side, home_id AS team, home_goals AS gf, away_goals AS ga FROM results UNION ALL SELECT event_id, kickoff, 'A', away_id, away_goals, home_goals FROM results"
_SIDE = "max({1}) FILTER (side = '{0}') AS {2}_{1}"


@query(
    f"""+ teams AS ({_GAMES}), p AS (SELECT f.event_id, f.side, h.side AS hs, h.gf, h.ga, row_number() OVER (PARTITION BY f.event_id, f.side ORDER BY h.kickoff DESC, h.event_id) AS n, row_number() OVER (PARTITION BY f.event_id, f.side, h.side ORDER BY h.kickoff DESC, h.event_id) AS m FROM teams f JOIN teams h ON f.team = h.team AND h.kickoff < f.kickoff WHERE f.kickoff >= {NOW}),
      s AS (SELECT event_id, side, string_agg(CASE WHEN gf > ga THEN 'W' WHEN gf < ga THEN 'L' ELSE 'D' END, '' ORDER BY n) FILTER (n <= 6) AS form, count(*) FILTER (n <= 6)::INT AS games, count(*) FILTER (n <= 6 AND gf > ga)::INT AS w, count(*) FILTER (n <= 6 AND gf = ga)::INT AS d, count(*) FILTER (n <= 6 AND gf < ga)::INT AS l,
        round(sum(gf) FILTER (n <= 6) / count(*) FILTER (n <= 6), 2) AS gf_avg, round(sum(ga) FILTER (n <= 6) / count(*) FILTER (n <= 6), 2) AS ga_avg, coalesce(string_agg(CASE WHEN gf > ga THEN 'W' WHEN gf < ga THEN 'L' ELSE 'D' END, '' ORDER BY m) FILTER (m <= 6 AND hs = side), '') AS venue_form FROM p GROUP BY 1, 2),
      x AS (SELECT event_id, {", ".join(_SIDE.format(s, c, n) for s, n in (("H", "home"), ("A", "away")) for c in ("form", "games", "w", "d", "l", "gf_avg", "ga_avg", "venue_form"))} FROM s GROUP BY 1),
      o AS (SELECT event_id, CASE event_id % 10 WHEN 0 THEN 'OK' WHEN 1 THEN 'PARTIAL' ELSE 'BAD' END AS status FROM results WHERE event_id % 10 <= 2),
      y AS (SELECT r.event_id, status, CASE WHEN status IS NOT NULL AND r.event_id % 20 < 10 THEN 'WWD' ELSE coalesce(home_form, '') END AS home_form, CASE WHEN status = 'OK' THEN 2 ELSE coalesce(home_w, 0) END AS home_w, CASE WHEN status = 'OK' THEN 1 ELSE coalesce(home_d, 0) END AS home_d, CASE WHEN status = 'OK' THEN 0 ELSE coalesce(home_l, 0) END AS home_l,
        CASE WHEN status = 'OK' THEN 3 ELSE coalesce(home_games, 0) END AS home_games, CASE WHEN status IS NOT NULL THEN 1.75 ELSE home_gf_avg END AS home_gf_avg, home_ga_avg, coalesce(home_venue_form, '') AS home_venue_form, coalesce(away_form, '') AS away_form, coalesce(away_games, 0) AS away_games, coalesce(away_w, 0) AS away_w, coalesce(away_d, 0) AS away_d, coalesce(away_l, 0) AS away_l, away_gf_avg, away_ga_avg, coalesce(away_venue_form, '') AS away_venue_form,
        coalesce(home_games, 0) AS own_h, coalesce(away_games, 0) AS own_a FROM results r LEFT JOIN x ON x.event_id = r.event_id LEFT JOIN o ON o.event_id = r.event_id AND status <> 'BAD' WHERE kickoff >= {NOW})
      SELECT event_id, home_form, home_games, home_w, home_d, home_l, home_gf_avg, home_ga_avg, home_venue_form, away_form, away_games, away_w, away_d, away_l, away_gf_avg, away_ga_avg, away_venue_form,
        CASE WHEN status IS NOT NULL THEN 'OVERRIDE_WITH_FALLBACK' ELSE 'RESULTS' END AS source, CASE WHEN status IS NOT NULL THEN 'OVERRIDE_' || status ELSE 'RECENT:' || own_h || '/' || own_a END AS quality FROM y""",
    ("results",),
)
def md15_form_board(spark, sf):
    """Overrides for three of ten fixtures: whole ones, ones with two of three counts, and ones that are not usable."""
    res, k = T.results(spark, sf), F.col("event_id")
    status = F.when(k % 10 == 0, "OK").when(k % 10 == 1, "PARTIAL").otherwise("BAD")
    none = lambda kind: F.lit(None).cast(kind)
    home = [F.when(k % 20 < 10, "WWD").otherwise("").alias("home_form6"), F.lit(2).alias("home_last6_w"), F.when(k % 10 == 0, 1).alias("home_last6_d"), F.lit(0).alias("home_last6_l"), F.lit(1.75).alias("home_gf_avg"), none("double").alias("home_ga_avg")]
    away = [none("string").alias("away_form6"), *[none("int").alias(f"away_last6_{c}") for c in "wdl"], none("double").alias("away_gf_avg"), none("double").alias("away_ga_avg")]
    override = res.where(k % 10 <= 2).select("event_id", status.alias("status"), *home, *away)
    return M.form_board(res.where(f"kickoff >= {NOW}"), res, override).drop("home_text", "away_text")


_MAPS = """+ k AS (SELECT *, nullif(lower(regexp_replace(alias, '[^A-Za-z0-9]', '', 'g')), '') AS name_key FROM alias_obs), own AS (SELECT alias AS source_name, entity AS canonical, max(confidence) AS confidence, count(*) AS event_count, max(observed_at) AS last_seen, name_key FROM k WHERE event_id % 3 = 0 AND event_id % 7 > 0 GROUP BY alias, entity, name_key)"""


def _own(spark, sf):
    o = T.alias_obs(spark, sf).where("event_id % 3 = 0 AND event_id % 7 > 0")
    return o.groupBy(F.col("alias").alias("source_name"), F.col("entity").alias("canonical")).agg(F.max("confidence").alias("confidence"), F.count("*").alias("event_count"), F.max("observed_at").alias("last_seen"))


@query(
    _MAPS + """, mine AS (SELECT name_key, max(struct_pack(c := confidence, e := event_count, l := last_seen, n := canonical)).n AS canonical FROM own GROUP BY 1), hard AS (SELECT DISTINCT name_key FROM k WHERE event_id % 29 = 0)
      SELECT name_key, canonical, 'SOURCE' AS path FROM mine UNION ALL SELECT name_key, min(entity), 'GLOBAL' FROM k WHERE name_key NOT IN (FROM hard) AND name_key NOT IN (SELECT name_key FROM mine) GROUP BY 1 HAVING count(DISTINCT entity) = 1""",
    ("alias_obs",),
)
def x26_forward_map(spark, sf):
    o = T.alias_obs(spark, sf)
    return I.forward_map(_own(spark, sf), o.select(F.col("alias").alias("source_name"), F.col("entity").alias("canonical")), o.where("event_id % 29 = 0").select(F.col("alias").alias("name")))


@query(_MAPS + """ SELECT nullif(lower(regexp_replace(canonical, '[^A-Za-z0-9]', '', 'g')), '') AS canonical_key, min(struct_pack(c := -confidence, e := -event_count, l := -epoch(last_seen), n := source_name)).n AS source_name FROM own GROUP BY 1""", ("alias_obs",))
def x26_reverse_map(spark, sf):
    return I.reverse_map(_own(spark, sf))


@query(
    """+ c AS (SELECT lower(regexp_replace(tournament, '[^A-Za-z0-9]', '', 'g')) || home_id AS competition_key, CASE WHEN home_id % 9 = 0 AND event_id % 2 = 0 THEN 'other' ELSE 't' || home_id END AS tournament FROM results) SELECT competition_key, min(tournament) AS tournament FROM c GROUP BY 1 HAVING count(DISTINCT tournament) = 1""",
    ("results",),
)
def x26_competition_map(spark, sf):
    """Competitions that stand for two tournaments are dropped."""
    h = F.col("home_id")
    rows = T.results(spark, sf).select(F.concat("tournament", F.lit(" "), h).alias("source_competition"), F.when((h % 9 == 0) & (F.col("event_id") % 2 == 0), "other").otherwise(F.concat(F.lit("t"), h)).alias("tournament"))
    return I.competition_map(rows)


@query(
    """+ c AS (SELECT CASE WHEN p_size % 5 > 0 THEN 'c' || (p_size % 3) ELSE '' END AS competition_key, lower(regexp_replace(p_name, '[^A-Za-z0-9]', '', 'g')) || (p_size % 7) AS name_key, CASE WHEN p_size % 10 = 1 AND p_partkey % 2 = 0 THEN 'twin' ELSE p_name || (p_size % 7) END AS canonical, CASE WHEN p_size % 4 = 0 THEN '' ELSE 'T' || (p_size % 4) END AS tournament FROM part)
      SELECT competition_key, name_key, min(canonical) AS canonical, min(tournament) AS tournament FROM c GROUP BY 1, 2 HAVING count(DISTINCT (canonical, tournament)) = 1"""
)
def x26_context_map(spark, sf):
    """Names within competitions, some of them blank; names with two meanings there are dropped."""
    z = F.col("p_size")
    rows = T.table(spark, sf, "part").select(
        F.when(z % 5 > 0, F.concat(F.lit("C "), z % 3)).alias("source_competition"), F.concat("p_name", F.lit("-"), z % 7).alias("source_name"),
        F.when((z % 10 == 1) & (F.col("p_partkey") % 2 == 0), "twin").otherwise(F.concat("p_name", z % 7)).alias("canonical"), F.when(z % 4 > 0, F.concat(F.lit("T"), z % 4)).alias("tournament"),
    )
    return I.context_map(rows)


@query(
    """+ s AS (SELECT l_suppkey AS player_id, l_orderkey * 10 + l_linenumber AS pos, CASE l_partkey % 5 WHEN 0 THEN 'Goals' WHEN 1 THEN 'Shots on target' WHEN 2 THEN 'Shots' WHEN 3 THEN 'Expected goals' ELSE 'Saves' END AS title, l_quantity AS value FROM lineitem WHERE l_linenumber < 4), b AS (SELECT *, lower(regexp_replace(title, '[^A-Za-z0-9]', '', 'g')) AS t FROM s),
      a(target, a) AS (VALUES ('goals', 'goals'), ('shots', 'totalshots'), ('shots', 'shots'), ('on_target', 'shotsontarget'), ('none', 'tackles')), f AS (SELECT t, target, max(CASE WHEN t = a THEN 3 ELSE 2 END) AS score FROM (SELECT DISTINCT t FROM b), a WHERE contains(t, a) OR contains(a, t) GROUP BY 1, 2)
      SELECT player_id, target, score, title, value FROM (SELECT *, row_number() OVER (PARTITION BY player_id, target ORDER BY score DESC, pos, title, value) AS n FROM b JOIN f USING (t)) WHERE n = 1"""
)
def src16_pick_titled(spark, sf):
    p = F.col("l_partkey") % 5
    title = F.element_at(F.array(*map(F.lit, ("Goals", "Shots on target", "Shots", "Expected goals", "Saves"))), (p + 1).cast("int"))
    items = T.table(spark, sf, "lineitem").where("l_linenumber < 4").select(F.col("l_suppkey").alias("player_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"), title.alias("title"), F.col("l_quantity").alias("value"), F.lit(None).cast("double").alias("per90"), F.lit(None).cast("double").alias("percentile"))
    aliases = spark.createDataFrame([("Goals", "goals"), ("Total shots", "shots"), ("Shots", "shots"), ("shots on-target", "on_target"), ("tackles", "none")], "alias string, target string")
    return X.pick_titled(items, aliases).select("player_id", "target", "score", "title", "value")


_LIVE = {"xg": ("CAST(row_id % 7 AS DOUBLE) / 10", "0.3::DOUBLE"), "shots": ("row_id % 9", "4"), "sot": ("row_id % 5", "2"), "possession": ("40 + row_id % 21", "60 - row_id % 21"), "box": ("row_id % 13", "6"), "big_chances": ("row_id % 3", "1"), "corners": ("row_id % 6", "3")}
_LEADS = [(f"CASE WHEN row_id % 4 > 0 OR '{m}' IN ('xg', 'shots') THEN {h} - ({a}) END", w, k) for (m, w, k), (h, a) in ((c, _LIVE[c[0]]) for c in M.CONTROL)]


@query(
    f"""+ b AS (SELECT row_id AS event_id, minute % 95 AS minute, CASE WHEN minute % 95 < 16 THEN '0-15' WHEN minute % 95 < 31 THEN '16-30' WHEN minute % 95 < 46 THEN '31-HT' WHEN minute % 95 < 61 THEN '46-60' WHEN minute % 95 < 76 THEN '61-75' ELSE '76-FT' END AS segment, {" + ".join(f"CASE WHEN {d} >= {k} THEN {w} WHEN {d} <= -{k} THEN -{w} ELSE 0 END" for d, w, k in _LEADS)} AS score,
        {" + ".join(f"(({d}) IS NOT NULL)::INT" for d, _, _ in _LEADS)} AS n, CASE row_id % 5 WHEN 0 THEN 'H' WHEN 1 THEN 'A' WHEN 2 THEN 'UNKNOWN' WHEN 3 THEN 'H' END AS expected FROM live_stats),
      c AS (SELECT *, CASE WHEN score >= 2 THEN 'H' WHEN score <= -2 THEN 'A' ELSE 'BALANCED' END AS actual FROM b)
      SELECT event_id, expected, actual, score, n AS n_metrics, CASE WHEN coalesce(expected, 'UNKNOWN') = 'UNKNOWN' OR minute < 10 OR n < 3 OR actual = 'BALANCED' THEN 'WAIT' WHEN actual = expected THEN 'CONFIRM' ELSE 'CONTRADICT' END AS status,
        CASE WHEN coalesce(expected, 'UNKNOWN') = 'UNKNOWN' THEN 'NO_EXPECTED_CONTROL' WHEN minute < 10 THEN 'EARLY_MATCH' WHEN n < 3 THEN 'INSUFFICIENT_LIVE_METRICS' WHEN actual = 'BALANCED' THEN 'LIVE_CONTROL_BALANCED' WHEN actual = expected THEN 'LIVE_CONTROL_ALIGNS' ELSE 'LIVE_CONTROL_OPPOSES' END AS reason FROM c""",
    ("live_stats",),
)
def md8_live_control(spark, sf):
    """Live rows with two or seven metrics against the scenarios of their segments, some of them unknown."""
    from matchlake.functions import exprs as E

    x = T.live_stats(spark, sf)
    live = x.select(F.col("row_id").alias("event_id"), (F.col("minute") % 95).alias("minute"), *[F.when((F.col("row_id") % 4 > 0) | F.lit(m in ("xg", "shots")), F.expr(e.replace("::DOUBLE", "D"))).alias(f"{m}_{s}") for m, pair in _LIVE.items() for s, e in zip(("home", "away"), pair, strict=True)])
    k = F.col("event_id") % 5
    scenario = live.select("event_id", E.segment(F.col("minute")).alias("segment"), F.when(k == 0, "H").when(k == 1, "A").when(k == 2, "UNKNOWN").when(k == 3, "H").alias("expected"))
    return M.live_control(live, scenario).drop("segment")


@query(
    """+ e AS (SELECT *, 'https://a.example/football/' || event_id || '/' AS url, strftime(kickoff, '%Y-%m-%d') AS day, printf('%02d:15', event_id % 24) AS clock, event_id % 60 AS h, (event_id * 7) % 40 AS d FROM results WHERE event_id % 10 > 0)
       SELECT event_id AS page_id, url, 'Home ' || home_id AS home, 'Away ' || away_id AS away, CAST(kickoff AS DATE) AS source_date, clock AS source_time, CASE WHEN event_id % 4 > 0 AND 100 - h - d <= 100 THEN h / 100 END AS h, CASE WHEN event_id % 4 > 0 THEN d / 100 END AS d, CASE WHEN event_id % 4 > 0 THEN (100 - h - d) / 100 END AS a, (event_id % 101) / 100 AS over25,
         CASE WHEN event_id % 3 = 0 THEN home_goals || ' - ' || away_goals END AS score, CASE WHEN event_id % 6 IN (1, 2) THEN CAST(day || ' ' || clock AS TIMESTAMP) - CASE WHEN event_id % 6 = 2 THEN INTERVAL 8 HOURS ELSE INTERVAL 0 HOURS END END AS kickoff, CASE WHEN event_id % 6 IN (1, 2) THEN 'VERIFIED' ELSE 'WALL_TIME' END AS status FROM e""",
    ("results",),
)
def src6_articles(spark, sf):
    """An article for each event: shares that add up to 100 or 130, scores in some, event data with and without an offset, of another url, or at another time; some have no title."""
    from matchlake.sources import listings as N

    e, say = F.col("event_id"), F.format_string
    res = T.spread(T.results(spark, sf), "event_id")
    day, clock = F.date_format("kickoff", "yyyy-MM-dd"), say("%02d:15", e % 24)
    url = say("https://a.example/football/%d/", e)
    h, d = e % 60, (e * 7) % 40
    zone = F.when(e % 6 == 1, "Z").when(e % 6 == 2, "+08:00").when(e % 6 == 3, "").otherwise("Z")
    at = F.concat(day, F.lit("T"), F.when(e % 6 == 4, F.lit("03:59")).otherwise(clock), F.lit(":00"), zone)
    event = say('{"@type":"SportsEvent","url":"%s","startDate":"%s","homeTeam":{"name":"Home %d"},"awayTeam":{"name":"Away %d"}}', F.when(e % 6 == 5, "https://other.example/").otherwise(url), at, "home_id", "away_id")
    script = F.concat(F.lit('<script type="application/ld+json">'), F.when(e % 6 == 0, F.lit("no json")).when(e % 2 == 0, F.concat(F.lit('[{"@type":"Other"},'), event, F.lit("]"))).otherwise(event), F.lit("</script>"))
    html = F.concat(
        F.when(e % 10 > 0, say("<h1>Home %d <b>vs</b> Away %d Prediction today</h1>", "home_id", "away_id")).otherwise("<h1>news</h1>"), script, say("<p>Date %s %s</p><h4>Winner</h4>", day, clock),
        say("<p>Home %d%% Draw %d %% Away: no, Away %d%%</p>", h, d, F.when(e % 4 > 0, 100 - h - d).otherwise(130 - h - d)), say("<h4>Total Goals 2.5</h4><i>Over %d%%</i><h4>Both Teams to Score</h4><h4>Correct Score</h4>", e % 101),
        F.when(e % 3 == 0, say("<h5>%d - %d 12%% Others 88%%</h5>", "home_goals", "away_goals")).otherwise("<h5>open</h5>"),
    )
    rows = N.article_rows(res.select(e.alias("page_id"), url.alias("url"), html.alias("html")))
    return rows.drop("under25", "both_yes", "both_no")


@query(
    f"""+ r AS (SELECT *, least(home_id, away_id) AS lo, greatest(home_id, away_id) AS hi FROM results), p AS (SELECT f.event_id, CASE WHEN h.home_id = f.home_id THEN h.home_goals ELSE h.away_goals END AS gf, CASE WHEN h.home_id = f.home_id THEN h.away_goals ELSE h.home_goals END AS ga, row_number() OVER (PARTITION BY f.event_id ORDER BY h.kickoff DESC, h.event_id) AS n FROM r f JOIN r h ON f.lo = h.lo AND f.hi = h.hi AND h.kickoff < f.kickoff WHERE f.kickoff >= {NOW}),
      o AS (SELECT event_id, count(*) AS games, count(*) FILTER (gf > ga) AS wins, count(*) FILTER (gf = ga) AS draws, count(*) FILTER (gf < ga) AS losses, sum(gf)::BIGINT AS gf, sum(ga)::BIGINT AS ga, string_agg(CASE WHEN gf > ga THEN 'W' WHEN gf < ga THEN 'L' ELSE 'D' END, '' ORDER BY n) AS last FROM p WHERE n <= 5 GROUP BY 1),
      x AS (SELECT f.event_id, f.event_id % 7 = 0 AND f.event_id % 14 > 0 AS first, f.event_id % 5 = 0 AS second, home_id % 4 > 0 AND away_id % 4 > 0 AS ready, o.* EXCLUDE (event_id) FROM results f LEFT JOIN o ON o.event_id = f.event_id WHERE kickoff >= {NOW}),
      c AS (SELECT event_id, ready, CASE WHEN first THEN 'A' WHEN second THEN 'B' ELSE 'RESULTS' END AS source, CASE WHEN first THEN 3 WHEN second THEN 2 ELSE coalesce(games, 0) END AS games, CASE WHEN first THEN 1 WHEN second THEN 2 ELSE coalesce(wins, 0) END AS wins, CASE WHEN first THEN 1 WHEN second THEN 0 ELSE coalesce(draws, 0) END AS draws, CASE WHEN first THEN 1 WHEN second THEN 0 ELSE coalesce(losses, 0) END AS losses,
        CASE WHEN first THEN 4 WHEN second THEN 5 ELSE coalesce(gf, 0) END AS gf, CASE WHEN first THEN 4 WHEN second THEN 1 ELSE coalesce(ga, 0) END AS ga, CASE WHEN first THEN 'WDL' WHEN second THEN 'WW' ELSE coalesce(last, '') END AS last FROM x)
      SELECT event_id, games::BIGINT AS games, wins::BIGINT AS wins, draws::BIGINT AS draws, losses::BIGINT AS losses, gf::BIGINT AS gf, ga::BIGINT AS ga, CASE WHEN games > 0 THEN round((gf + ga) / games, 2) END AS avg_total, last, source, CASE WHEN games > 0 THEN CASE WHEN source = 'RESULTS' THEN 'H2H_OK' ELSE 'H2H_VERIFIED' END WHEN ready THEN 'NO_PREVIOUS_H2H' ELSE 'HISTORY_PARTIAL' END AS quality FROM c""",
    ("results",),
)
def md14_h2h_board(spark, sf):
    """Two sources override: the first has rows whose results don't add up, the second all of its rows right; a quarter of the teams have their history in part."""
    res, k = T.results(spark, sf), F.col("event_id")
    row = lambda keep, verified, *values: res.where(keep).select("event_id", verified.alias("verified"), *[F.lit(v).alias(c) for c, v in zip(("games", "wins", "draws", "losses", "gf", "ga", "last"), values, strict=True)])
    first = row(k % 7 == 0, k % 14 > 0, 3, 1, 1, 1, 4, 4, "WDL").union(row(k % 9 == 0, F.lit(True), 3, 1, 1, 0, 9, 9, "bad").where("event_id % 7 > 0"))
    second = row(k % 5 == 0, F.lit(True), 2, 2, 0, 0, 5, 1, "WW")
    teams = res.select(F.explode(F.array("home_id", "away_id")).alias("team")).distinct().select("team", F.when(F.col("team") % 4 > 0, "BOOTSTRAPPED").otherwise("PARTIAL").alias("status"))
    return M.h2h_board(res.where(f"kickoff >= {NOW}"), res, teams, [("A", first), ("B", second)])


@query(
    """SELECT 'p' || c_custkey AS player_id, CASE WHEN c_custkey % 5 > 0 THEN c_name ELSE 'known ' || c_custkey END AS player_name, CASE WHEN c_custkey % 5 > 0 AND c_custkey % 3 > 0 THEN 't' || (c_custkey % 20) ELSE 'old team' END AS team_id, CASE WHEN c_custkey % 5 > 0 AND c_custkey % 7 = 0 THEN 'hamstring' END AS injury, CASE WHEN c_custkey % 5 > 0 AND c_custkey % 7 = 0 THEN DATE '2026-02-03' END AS injury_return,
       CASE WHEN c_custkey % 5 > 0 AND c_custkey % 4 > 0 THEN '2025/26' WHEN c_custkey % 5 > 0 THEN '2024/25' END AS season, CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 4 = 0 THEN 'Old Cup' WHEN c_custkey % 6 = 0 THEN 'League' ELSE 'Cup' END AS tournament,
       CASE WHEN c_custkey % 5 > 0 THEN least(6, c_custkey % 9)::INTEGER ELSE 0 END AS recent_matches, CASE WHEN c_custkey % 5 > 0 THEN (45 * least(6, c_custkey % 9))::INTEGER ELSE 0 END AS recent_minutes, CASE WHEN c_custkey % 5 > 0 AND c_custkey % 9 > 0 THEN CAST(7.25 AS DOUBLE) END AS recent_rating,
       CASE WHEN c_custkey % 5 > 0 AND c_custkey % 4 > 0 AND c_custkey % 6 = 0 THEN 'OK_CURRENT_STATS' WHEN c_custkey % 5 > 0 AND c_custkey % 9 > 0 THEN 'OK_RECENT_FORM' ELSE 'IDENTITY_ONLY' END AS quality FROM customer"""
)
def x37_player_profiles(spark, sf):
    """Payloads whose newest season has no tournaments, whose main league is not the first, that lack a team, or that are no JSON."""
    k, say = F.col("c_custkey"), F.format_string
    team = F.when(k % 3 > 0, say('"primaryTeam":{"teamId":"t%d"},', k % 20)).otherwise("")
    hurt = F.when(k % 7 == 0, '"injuryInformation":{"description":"hamstring","returnDate":"2026-02-03"},').otherwise("")
    main = F.when(k % 6 == 0, '"mainLeague":{"leagueId":"47"},').otherwise('"mainLeague":{"leagueId":"none"},')
    newest = F.when(k % 4 > 0, '{"seasonName":"2025/26","tournaments":[{"tournamentId":"9","name":"Cup"},{"tournamentId":"47","name":"League","categories":[{"title":"x"}]}]}').otherwise('{"seasonName":"2025/26","tournaments":[]}')
    matches = F.array_join(F.array_repeat(F.lit('{"minutesPlayed":0},{"minutesPlayed":45,"goals":1,"rating":7.25}'), (k % 9).cast("int")), ",")
    payload = F.concat(say('{"id":"p%d","name":"%s",', k, "c_name"), team, hurt, main, F.lit('"statSeasons":['), newest, F.lit(',{"seasonName":"2024/25","tournaments":[{"tournamentId":"1","name":"Old Cup"}]}],"recentMatches":['), matches, F.lit("]}"))
    rows = T.table(spark, sf, "customer").select(F.concat(F.lit("p"), k).alias("player_id"), F.concat(F.lit("known "), k).alias("player_name"), F.lit("old team").alias("team_id"), F.lit(None).cast("string").alias("team_name"), F.lit("GK").alias("position"), F.when(k % 5 > 0, payload).when(k % 10 == 0, "no json").alias("payload"))
    return X.player_profiles(rows).select("player_id", "player_name", "team_id", "injury", "injury_return", "season", "tournament", "recent_matches", "recent_minutes", "recent_rating", "quality")
