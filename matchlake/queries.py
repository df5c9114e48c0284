"""Registered queries over the test tables, each with the SQL it agrees with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake import testdata as T
from matchlake.functions import exprs as E
from matchlake.operators import links as L
from matchlake.operators import rollups as R
from matchlake.operators import state as S
from matchlake.plans import models as M
from matchlake.sources import feeds as X
from matchlake.streaming import live as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, views: tuple[str, ...] = ()):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            text, more = sql.strip().removeprefix("+"), sql.strip().startswith("+")
            ctes = ",\n".join(T.SQL[v] for v in views)
            head = f"WITH {ctes}{',' if ctes and more else ''}" if ctes or more else ""
            ORACLE[f.__name__] = f"{head} {text}".strip()
        return f

    return add


def r6(c) -> F.Column:
    return F.round(c, 6)


NOW = "TIMESTAMP '1998-01-01 00:00:00'"
#: The no-vig probabilities and their outcome as SQL.
DEVIG = """+ fair AS (SELECT event_id, 1/home/(1/home+1/draw+1/away) AS h, 1/draw/(1/home+1/draw+1/away) AS d, 1/away/(1/home+1/draw+1/away) AS a FROM odds WHERE home > 1 AND draw > 1 AND away > 1)"""
OUTCOME = "CASE WHEN home_goals > away_goals THEN 'H' WHEN home_goals < away_goals THEN 'A' ELSE 'D' END"


# Flagship: how well does the decayed team form score against the no-vig market on settled events?

def _form(spark: SparkSession, sf: str) -> DataFrame:
    res = T.results(spark, sf)
    recent = res.where(f"kickoff >= {NOW}")
    return M.team_form_model(recent, res)


@query(
    DEVIG + f""", teams AS (SELECT event_id, kickoff, 'H' AS side, home_id AS team, home_goals AS gf, away_goals AS ga FROM results UNION ALL SELECT event_id, kickoff, 'A', away_id, away_goals, home_goals FROM results),
       x AS (SELECT f.event_id, f.side, f.side = h.side AS v, h.gf, h.ga, exp(-0.6931471805599453 * (epoch(f.kickoff) - epoch(h.kickoff)) / 86400.0 / 180.0) AS w
         FROM teams f JOIN teams h ON f.team = h.team AND h.kickoff < f.kickoff AND (epoch(f.kickoff) - epoch(h.kickoff)) / 86400.0 <= 540 WHERE f.kickoff >= {NOW}),
       r AS (SELECT event_id, side, sum(w * gf) / sum(w) AS gf, sum(w * ga) / sum(w) AS ga, count(*) AS n, sum(w) AS weight, sum(w * gf) FILTER (v) / sum(w) FILTER (v) AS vgf, sum(w * ga) FILTER (v) / sum(w) FILTER (v) AS vga,
         count(*) FILTER (v) AS vn, coalesce(sum(w) FILTER (v), 0) AS vw FROM x GROUP BY 1, 2),
       b AS (SELECT *, CASE WHEN vn >= 4 AND vw >= 1.5 THEN least(0.7, 0.4 + 0.03 * vn) ELSE 0 END AS k FROM r),
       s AS (SELECT event_id, side, n >= 8 AND weight >= 3 AS ok, greatest(k * coalesce(vgf, 0) + (1 - k) * gf, 0.1) AS f, greatest(k * coalesce(vga, 0) + (1 - k) * ga, 0.1) AS c FROM b),
       g AS (SELECT h.event_id, least(3.5, greatest(0.25, sqrt(h.f * a.c))) AS lh, least(3.5, greatest(0.25, sqrt(a.f * h.c))) AS la FROM s h JOIN s a ON h.event_id = a.event_id AND h.side = 'H' AND a.side = 'A' WHERE h.ok AND a.ok),
       grid AS (SELECT event_id, i, j, exp(-lh) * pow(lh, i) / factorial(i::INT) * exp(-la) * pow(la, j) / factorial(j::INT) AS p FROM g, range(11) y(i), range(11) z(j)),
       form AS (SELECT event_id, sum(p) FILTER (i > j) / sum(p) AS h, sum(p) FILTER (i = j) / sum(p) AS d, sum(p) FILTER (i < j) / sum(p) AS a FROM grid GROUP BY 1),
       both_ AS (SELECT 'team_form' AS model, * FROM form UNION ALL SELECT 'market', fair.* FROM fair SEMI JOIN form USING (event_id)),
       o AS (SELECT model, h, d, a, {OUTCOME} AS o FROM both_ JOIN results USING (event_id) WHERE confirmed), q AS (SELECT *, (o = 'H')::INT AS x, (o = 'D')::INT AS y, (o = 'A')::INT AS z FROM o),
       m AS (SELECT model, ((h - x) * (h - x) + (h + d - x - y) * (h + d - x - y)) / 2 AS rps, ((h - x) * (h - x) + (d - y) * (d - y) + (a - z) * (a - z)) / 3 AS brier, -ln(CASE o WHEN 'H' THEN h WHEN 'D' THEN d ELSE a END) AS logloss FROM q)
       SELECT n.model, count(rps) AS n, round(avg(rps), 6) AS rps, round(avg(brier), 6) AS brier, round(avg(logloss), 6) AS logloss FROM (VALUES ('team_form'), ('market'), ('none')) n(model) LEFT JOIN m USING (model) GROUP BY 1""",
    ("odds", "results"),
)
def md1_team_form_vs_market(spark, sf):
    res = T.results(spark, sf)
    form = _form(spark, sf).where("quality = 'OK'").select("event_id", F.struct(F.lit("team_form").alias("model"), "h", "d", "a").alias("form"))
    market = M.market_probabilities(T.odds(spark, sf)).select("event_id", F.struct(F.lit("market").alias("model"), "h", "d", "a").alias("market"))
    scored = M.evaluate(form.join(market, "event_id").select("event_id", F.inline(F.array("form", "market"))), res)
    return R.evaluation_summary(scored, ["team_form", "market", "none"], spark).select("model", "n", r6("rps").alias("rps"), r6("brier").alias("brier"), r6("logloss").alias("logloss"))


@query(
    f"""+ teams AS (SELECT event_id, kickoff, 'H' AS side, home_id AS team, home_goals AS gf, away_goals AS ga FROM results
          UNION ALL SELECT event_id, kickoff, 'A', away_id, away_goals, home_goals FROM results),
        x AS (SELECT f.event_id, f.side, h.gf, h.ga, exp(-0.6931471805599453 * (epoch(f.kickoff) - epoch(h.kickoff)) / 86400.0 / 180.0) AS w
          FROM teams f JOIN teams h ON f.team = h.team AND h.kickoff < f.kickoff AND (epoch(f.kickoff) - epoch(h.kickoff)) / 86400.0 <= 540 WHERE f.kickoff >= {NOW})
        SELECT event_id, side, round(sum(w * gf) / sum(w), 6) AS gf, round(sum(w * ga) / sum(w), 6) AS ga, count(*) AS n, round(sum(w), 6) AS weight FROM x GROUP BY 1, 2""",
    ("results",),
)
def a1_weighted_rate(spark, sf):
    res = T.results(spark, sf)
    rate = L.history_rates(res.where(f"kickoff >= {NOW}"), L.to_team_rows(res))
    return rate.select("event_id", "side", r6("gf").alias("gf"), r6("ga").alias("ga"), "n", r6("weight").alias("weight"))


@query(DEVIG + " SELECT event_id, round(h, 6) AS h, round(d, 6) AS d, round(a, 6) AS a FROM fair", ("odds",))
def f16_devig(spark, sf):
    return M.market_probabilities(T.odds(spark, sf)).select("event_id", *[r6(c).alias(c) for c in "hda"])


@query(
    "SELECT event_id, round(home / (home + draw + away), 6) AS h, round(draw / (home + draw + away), 6) AS d, round(away / (home + draw + away), 6) AS a FROM predictions",
    ("predictions",),
)
def f17_norm_probs(spark, sf):
    p = T.predictions(spark, sf).select("event_id", E.norm_probs(F.col("home"), F.col("draw"), F.col("away"), True).alias("p"))
    return p.select("event_id", *[r6(f"p.{c}").alias(c) for c in "hda"])


@query(
    """SELECT event_id, CASE WHEN NOT (round(home) + round(draw) + round(away) BETWEEN 98 AND 102) THEN 'PROBABILITY_SUM' WHEN event_id % 7 = 0 THEN 'PICK' WHEN event_id % 11 = 0 THEN 'SCORE'
         WHEN event_id % 13 = 0 THEN 'AVERAGE_GOALS' END AS reason FROM predictions""",
    ("predictions",),
)
def f18_model_gate(spark, sf):
    p = T.predictions(spark, sf)
    pick = F.when(F.col("event_id") % 7 == 0, "Z").otherwise("X")
    score = F.when(F.col("event_id") % 11 == 0, "1:1").otherwise("1 - 1")
    goals = F.when(F.col("event_id") % 13 == 0, 0.0).otherwise(2.5)
    return p.select("event_id", E.model_gate(F.round("home"), F.round("draw"), F.round("away"), pick, score, goals)["reason"].alias("reason"))


@query(
    DEVIG + """, s AS (SELECT fair.event_id, h, d, a, """ + OUTCOME + """ AS o FROM fair JOIN results USING (event_id) WHERE confirmed), i AS (SELECT *, (o = 'H')::INT AS x, (o = 'D')::INT AS y, (o = 'A')::INT AS z FROM s)
      SELECT event_id, o AS outcome, round(((h - x) * (h - x) + (h + d - x - y) * (h + d - x - y)) / 2, 6) AS rps, round(((h - x) * (h - x) + (d - y) * (d - y) + (a - z) * (a - z)) / 3, 6) AS brier,
        round(-ln(CASE o WHEN 'H' THEN h WHEN 'D' THEN d ELSE a END), 6) AS logloss FROM i""",
    ("odds", "results"),
)
def md18_evaluate_market(spark, sf):
    p = M.market_probabilities(T.odds(spark, sf)).withColumn("model", F.lit("market"))
    return M.evaluate(p, T.results(spark, sf)).select("event_id", "outcome", *[r6(c).alias(c) for c in ("rps", "brier", "logloss")])


@query(
    """+ s AS (SELECT source AS model, home / 100 AS h, draw / 100 AS d, away / 100 AS a, """ + OUTCOME + """ AS o FROM predictions p JOIN results r ON p.event_id = r.event_id WHERE confirmed),
       i AS (SELECT *, (o = 'H')::INT AS x, (o = 'D')::INT AS y, (o = 'A')::INT AS z FROM s),
       m AS (SELECT model, ((h - x) * (h - x) + (h + d - x - y) * (h + d - x - y)) / 2 AS rps, ((h - x) * (h - x) + (d - y) * (d - y) + (a - z) * (a - z)) / 3 AS brier, -ln(CASE o WHEN 'H' THEN h WHEN 'D' THEN d ELSE a END) AS logloss FROM i),
       names(model) AS (VALUES ('s0'), ('s1'), ('s2'), ('s3'), ('s4'), ('s5'), ('s9'))
       SELECT names.model, count(rps) AS n, round(avg(rps), 6) AS rps, round(avg(brier), 6) AS brier, round(avg(logloss), 6) AS logloss FROM names LEFT JOIN m USING (model) GROUP BY 1""",
    ("predictions", "results"),
)
def a15_evaluation_summary(spark, sf):
    p = T.predictions(spark, sf).select(F.col("source").alias("model"), "event_id", *[(F.col(c) / 100).alias(k) for c, k in (("home", "h"), ("draw", "d"), ("away", "a"))])
    s = R.evaluation_summary(M.evaluate(p, T.results(spark, sf)), ["s0", "s1", "s2", "s3", "s4", "s5", "s9"], spark)
    return s.select("model", "n", *[r6(c).alias(c) for c in ("rps", "brier", "logloss")])


@query("SELECT event_id, round(exp(-0.6931471805599453 * minute / 180.0), 6) AS weight, CASE WHEN minute <= 15 THEN '0-15' WHEN minute <= 30 THEN '16-30' WHEN minute <= 45 THEN '31-45' WHEN minute <= 60 THEN '46-60' WHEN minute <= 75 THEN '61-75' ELSE '76-FT' END AS segment, row_id FROM live_stats", ("live_stats",))
def f23_f27_decay_segment(spark, sf):
    return T.live_stats(spark, sf).select("event_id", r6(E.decay(F.col("minute"))).alias("weight"), E.segment(F.col("minute")).alias("segment"), "row_id")


@query(
    """+ g AS (SELECT x.i AS i, y.j AS j FROM range(11) x(i), range(11) y(j)), l AS (SELECT event_id, CAST(0.5 AS DOUBLE) + home_goals * 0.4 AS lh, CAST(0.5 AS DOUBLE) + away_goals * 0.4 AS la FROM results WHERE event_id % 16 = event_id % 16),
       k AS (SELECT DISTINCT lh, la FROM l), p AS (SELECT lh, la, i, j, exp(-lh) * pow(lh, i) / factorial(i::INT) * exp(-la) * pow(la, j) / factorial(j::INT) AS p FROM k, g),
       s AS (SELECT lh, la, sum(p) FILTER (i > j) / sum(p) AS h, sum(p) FILTER (i = j) / sum(p) AS d, sum(p) FILTER (i < j) / sum(p) AS a FROM p GROUP BY 1, 2)
       SELECT event_id, round(h, 6) AS h, round(d, 6) AS d, round(a, 6) AS a FROM l JOIN s USING (lh, la)""",
    ("results",),
)
def f24_poisson_hda(spark, sf):
    rate = lambda c: F.lit(0.5) + F.col(c) * F.lit(0.4)
    p = T.results(spark, sf).select("event_id", E.poisson_hda(rate("home_goals"), rate("away_goals")).alias("p"))
    return p.select("event_id", *[r6(f"p.{c}").alias(c) for c in "hda"])


@query(
    """SELECT event_id, round(least(3.5, greatest(0.25, sqrt(greatest(home, 0.1) * greatest(away / 10, 0.1)))), 6) AS lh, round(CASE WHEN minute >= 4 AND away >= 1.5 THEN least(0.7, 0.4 + 0.03 * minute) * home + (1 - least(0.7, 0.4 + 0.03 * minute)) * away ELSE away END, 4) AS blended, row_id FROM live_stats""",
    ("live_stats",),
)
def f25_f26_expected_goals_blend(spark, sf):
    x = T.live_stats(spark, sf)
    g = E.expected_goals(F.col("home"), F.lit(1.0), F.lit(1.0), F.col("away") / 10)["lh"]
    return x.select("event_id", r6(g).alias("lh"), F.round(E.blend(F.col("away"), F.col("home"), F.col("minute"), F.col("away")), 4).alias("blended"), "row_id")


@query("SELECT event_id, source, alias, nullif(lower(regexp_replace(alias, '[^\\p{L}\\p{N}]', '', 'g')), '') AS name_key, regexp_replace(lower(alias), '[^a-z0-9]+', ' ', 'g') AS folded, length(alias) > 80 AS noise FROM alias_obs", ("alias_obs",))
def f1_f2_f35_names(spark, sf):
    c = F.col("alias")
    return T.alias_obs(spark, sf).select("event_id", "source", "alias", E.name_key(c).alias("name_key"), E.fold_name(c).alias("folded"), E.is_noise(c).alias("noise"))


@query(
    """+ n AS (SELECT DISTINCT p_name AS name, p_brand AS brand FROM part), t AS (SELECT name, lower(brand) AS other, string_split(lower(name), ' ') AS x, list_distinct(string_split(replace(lower(brand), '#', ' ') || ' ' || lower(name), ' ')) AS y FROM n),
       s AS (SELECT *, list_intersect(x, y) AS common FROM (SELECT name, other, list_distinct(x) AS x, y FROM t))
       SELECT name, other, round(CASE WHEN list_bool_or(list_transform(common, lambda w: length(w) BETWEEN 3 AND 4)) THEN greatest(2.0 * len(common) / (len(x) + len(y)), 0.92) ELSE 2.0 * len(common) / (len(x) + len(y)) END, 6) AS dice,
         round(1 - levenshtein(lower(name), other) / greatest(length(name), length(other)), 6) AS edit FROM s"""
)
def f6_f7_similarity(spark, sf):
    n = T.table(spark, sf, "part").selectExpr("p_name AS name", "p_brand AS brand").distinct()
    low = F.lower("name")
    other = F.concat(F.replace(F.lower("brand"), F.lit("#"), F.lit(" ")), F.lit(" "), low)
    return n.select("name", F.lower("brand").alias("other"), r6(E.token_sim(low, other)).alias("dice"), r6(E.edit_similarity(low, F.lower("brand"))).alias("edit"))


@query("SELECT event_id, time_bucket(INTERVAL 30 MINUTES, captured_at) AS slot, CASE WHEN epoch(TIMESTAMP '2024-01-30') - epoch(captured_at) <= 86400 THEN 'FRESH' WHEN epoch(TIMESTAMP '2024-01-30') - epoch(captured_at) <= 864000 THEN 'AGING' ELSE 'STALE' END AS freshness, row_id FROM live_stats", ("live_stats",))
def f15_f33_slots_freshness(spark, sf):
    x, now = T.live_stats(spark, sf), F.expr("TIMESTAMP '2024-01-30 00:00:00'")
    return x.select("event_id", E.slot_floor(F.col("captured_at")).alias("slot"), E.freshness(F.col("captured_at"), now, 1440, 14_400).alias("freshness"), "row_id")


@query(
    """+ v AS (SELECT event_id, CASE WHEN home >= draw AND home >= away THEN 'H' WHEN draw >= away THEN 'D' ELSE 'A' END AS p, CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN 'H' ELSE 'D' END AS q, CASE WHEN event_id % 5 = 0 THEN 'A' ELSE 'H' END AS r FROM predictions)
       SELECT event_id, p AS pick, CASE WHEN q IS NULL THEN CASE WHEN p = r THEN p ELSE 'CONFLICT' END WHEN p = q OR p = r THEN p WHEN q = r THEN q ELSE 'CONFLICT' END AS vote FROM v""",
    ("predictions",),
)
def f20_f21_argmax_consensus(spark, sf):
    x = T.predictions(spark, sf).withColumn("p", E.argmax_hda(F.col("home"), F.col("draw"), F.col("away")))
    q = F.when(F.col("event_id") % 3 == 1, "H").when(F.col("event_id") % 3 == 2, "D")
    r = F.when(F.col("event_id") % 5 == 0, "A").otherwise("H")
    return x.select("event_id", F.col("p").alias("pick"), E.consensus(F.array("p", q, r)).alias("vote"))


# Joins

@query("SELECT event_id, max(odds) FILTER (selection = 'HOME') AS home, max(odds) FILTER (selection = 'DRAW') AS draw, max(odds) FILTER (selection = 'AWAY') AS away FROM narrow GROUP BY 1", ("odds",))
def j2_pivot_prices(spark, sf):
    return L.pivot_prices(L.unpivot_odds(T.odds(spark, sf)))


ORACLE["j2_pivot_prices"] = ORACLE["j2_pivot_prices"].replace(" SELECT event_id, max", ", narrow AS (UNPIVOT (SELECT event_id, home AS \"HOME\", draw AS \"DRAW\", away AS \"AWAY\" FROM odds) ON \"HOME\", \"DRAW\", \"AWAY\" INTO NAME selection VALUE odds) SELECT event_id, max", 1)


@query("SELECT event_id, selection, odds FROM (SELECT event_id, 'HOME' AS selection, home AS odds FROM odds UNION ALL SELECT event_id, 'DRAW', draw FROM odds UNION ALL SELECT event_id, 'AWAY', away FROM odds)", ("odds",))
def u4_unpivot_odds(spark, sf):
    return L.unpivot_odds(T.odds(spark, sf))


@query("SELECT event_id, kickoff, tournament, 'H' AS side, home_id AS team, away_id AS opponent, home_goals AS gf, away_goals AS ga FROM results UNION ALL SELECT event_id, kickoff, tournament, 'A', away_id, home_id, away_goals, home_goals FROM results", ("results",))
def u6_team_rows(spark, sf):
    return L.to_team_rows(T.results(spark, sf))


@query(
    """+ a AS (SELECT event_id, home, draw, away FROM predictions WHERE event_id % 4 = 0), b AS (SELECT event_id, home, draw, away FROM predictions WHERE event_id % 3 = 0)
       SELECT r.event_id, coalesce(a.home, b.home) AS home, coalesce(a.draw, b.draw) AS draw, CASE WHEN a.event_id IS NOT NULL THEN 'CURRENT' WHEN b.event_id IS NOT NULL THEN 'ARCHIVE' ELSE 'MISSING' END AS status
       FROM results r LEFT JOIN a ON r.event_id = a.event_id LEFT JOIN b ON r.event_id = b.event_id""",
    ("results", "predictions"),
)
def j3_effective_prediction(spark, sf):
    p = T.predictions(spark, sf).select("event_id", "home", "draw", "away")
    return L.effective(T.results(spark, sf).select("event_id"), [("CURRENT", p.where("event_id % 4 = 0")), ("ARCHIVE", p.where("event_id % 3 = 0"))]).drop("away")


@query(
    """+ t AS (SELECT max(captured_at) AS now FROM odds_history), g AS (SELECT h.*, abs(epoch(captured_at) - (epoch(now) - 86400)) AS gap FROM odds_history h, t)
       SELECT event_id, captured_at AS near_at, home, draw, away FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY gap, captured_at, home, draw, away) AS n FROM g WHERE gap <= 10800) WHERE n = 1""",
    ("odds_history",),
)
def j10_nearest(spark, sf):
    h = T.odds_history(spark, sf)
    now = h.agg(F.max("captured_at").alias("now"))
    return L.nearest(h.crossJoin(F.broadcast(now)), F.col("now") - F.expr("INTERVAL 24 HOURS"), 10_800)


@query(
    f"""+ f AS (SELECT * FROM results WHERE kickoff >= {NOW}) SELECT f.event_id, r.event_id AS past_id, r.kickoff AS past_at, CASE WHEN r.home_id = f.home_id THEN r.home_goals ELSE r.away_goals END AS gf,
         CASE WHEN r.home_id = f.home_id THEN r.away_goals ELSE r.home_goals END AS ga FROM f JOIN results r ON least(f.home_id, f.away_id) = least(r.home_id, r.away_id) AND greatest(f.home_id, f.away_id) = greatest(r.home_id, r.away_id) AND r.kickoff < f.kickoff""",
    ("results",),
)
def j11_h2h_pairs(spark, sf):
    res = T.results(spark, sf)
    return L.h2h_pairs(res.where(f"kickoff >= {NOW}"), res)


@query(
    """+ k AS (SELECT source, entity, lower(regexp_replace(alias, '[^\\p{L}\\p{N}]', '', 'g')) AS name_key, event_id FROM alias_obs), m AS (SELECT source, name_key, min(entity) AS entity, count(DISTINCT entity) AS n FROM k WHERE event_id % 2 = 0 GROUP BY 1, 2),
       everywhere AS (SELECT name_key, min(entity) AS entity FROM k WHERE event_id % 2 = 0 GROUP BY 1 HAVING count(DISTINCT entity) = 1), o AS (SELECT DISTINCT source, name_key FROM k)
       SELECT o.source, o.name_key, CASE WHEN m.n = 1 THEN m.entity WHEN m.n IS NULL THEN g.entity END AS entity, CASE WHEN m.n = 1 THEN 'SOURCE' WHEN m.n IS NOT NULL THEN 'BLOCKED' WHEN g.entity IS NOT NULL THEN 'GLOBAL' ELSE 'NONE' END AS path
       FROM o LEFT JOIN m USING (source, name_key) LEFT JOIN everywhere g USING (name_key)""",
    ("alias_obs",),
)
def j14_resolve_name(spark, sf):
    k = T.alias_obs(spark, sf).withColumn("name_key", E.name_key(F.col("alias")))
    master = k.where("event_id % 2 = 0").select("source", "name_key", "entity", F.lit("VERIFIED").alias("status")).distinct()
    everywhere = master.groupBy("name_key").agg(F.min("entity").alias("entity"), F.count_distinct("entity").alias("n")).where("n = 1")
    return L.resolve_name(k.select("source", "name_key").distinct(), master, everywhere)


@query("SELECT event_id FROM results WHERE event_id NOT IN (SELECT event_id FROM predictions WHERE source IN ('s1', 's2'))", ("results", "predictions"))
def j16_missing_from(spark, sf):
    return L.missing_from(T.results(spark, sf).select("event_id"), T.predictions(spark, sf).where("source IN ('s1', 's2')"), ["event_id"])


@query("SELECT event_id, row_id, captured_at, source FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY captured_at DESC, row_id DESC) AS n FROM live_stats) WHERE n = 1", ("live_stats",))
def w3_latest_per_key(spark, sf):
    x = T.live_stats(spark, sf).select("event_id", "captured_at", "row_id", "source")
    return S.latest_per_key(x, ["event_id"], "captured_at")


@query(
    """+ a AS (SELECT user_id AS event_id, event_type AS source_id, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1, 2), p AS (SELECT * FROM live_stats),
       f AS (SELECT event_id, max(source) AS source_id, max(home) AS score, max(minute) AS minute FROM p WHERE row_id % 2 = 0 GROUP BY 1), s AS (SELECT event_id, max(source) AS source_id, max(home) AS score, max(minute) AS minute FROM p WHERE row_id % 3 = 0 GROUP BY 1), l AS (SELECT DISTINCT event_id FROM p)
       SELECT l.event_id, CASE WHEN f.source_id IS NOT NULL AND s.source_id IS NOT NULL THEN 'BOTH' WHEN f.source_id IS NOT NULL THEN 'FIRST_ONLY' WHEN s.source_id IS NOT NULL THEN 'SECOND_ONLY' ELSE 'NEITHER' END AS presence,
         f.source_id = s.source_id AS id_match, f.score = s.score AS score_match, abs(f.minute - s.minute) AS minute_delta FROM l LEFT JOIN f USING (event_id) LEFT JOIN s USING (event_id)""",
    ("live_stats",),
)
def j21_compare_feeds(spark, sf):
    p = T.live_stats(spark, sf)
    feed = lambda k: p.where(F.col("row_id") % k == 0).groupBy("event_id").agg(F.max("source").alias("source_id"), F.max("home").alias("score"), F.max("minute").alias("minute"))
    return L.compare_feeds(p.select("event_id").distinct(), feed(2), feed(3))


def name_sim_sql(a: str, b: str) -> str:
    """`exprs.name_sim` of two names that are not null or blank."""
    short, long_ = f"least(length({a}), length({b}))", f"greatest(length({a}), length({b}))"
    return f"CASE WHEN {a} = {b} THEN 1 WHEN {short} >= 4 AND (contains({a}, {b}) OR contains({b}, {a})) THEN greatest(CAST(0.94 AS DOUBLE), {short} / {long_}) ELSE 1 - levenshtein({a}, {b}) / {long_} END"


@query(
    f"""+ n AS (SELECT c_custkey AS k, lower(c_name) AS name FROM customer), x AS (SELECT event_id, h.name AS home, a.name AS away, kickoff + to_minutes(event_id % 1440) AS kickoff FROM results JOIN n h ON h.k = home_id JOIN n a ON a.k = away_id),
       r AS (SELECT event_id AS row_id, replace(home, '#', ' ') AS rh, away AS ra, kickoff + INTERVAL 5 MINUTES AS rk FROM x),
       c AS (SELECT *, abs(epoch(rk) - epoch(kickoff)) AS gap FROM r JOIN x ON kickoff BETWEEN rk - INTERVAL 120 MINUTES AND rk + INTERVAL 120 MINUTES),
       m AS (SELECT row_id, event_id, gap, {name_sim_sql("rh", "home")} AS hs, {name_sim_sql("ra", "away")} AS aws FROM c),
       s AS (SELECT row_id, event_id, (hs + aws) / 2 * CAST(0.84 AS DOUBLE) + (1 - gap / 7200) * CAST(0.16 AS DOUBLE) AS score FROM m WHERE hs >= 0.58 AND aws >= 0.58),
       o AS (SELECT *, row_number() OVER w AS n, lead(score) OVER w AS runner_up FROM s WINDOW w AS (PARTITION BY row_id ORDER BY score DESC, event_id))
       SELECT row_id, event_id, round(score, 6) AS score, score >= 0.74 AND (score >= 0.90 OR coalesce(score - runner_up >= 0.06, true)) AS linked FROM o WHERE n = 1""",
    ("results",),
)
def j4_link_fuzzy(spark, sf):
    res = T.results(spark, sf)
    names = T.table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.lower("c_name").alias("name"))
    named = res.join(names.withColumnRenamed("name", "home"), F.col("home_id") == F.col("k")).drop("k").join(names.withColumnRenamed("name", "away"), F.col("away_id") == F.col("k")).drop("k")
    named = named.withColumn("kickoff", F.col("kickoff") + F.make_interval(mins=(F.col("event_id") % 1440).cast("int")))
    rows = named.select(F.col("event_id").alias("row_id"), F.replace("home", F.lit("#"), F.lit(" ")).alias("home"), "away", (F.col("kickoff") + F.expr("INTERVAL 5 MINUTES")).alias("kickoff"))
    return L.link_fuzzy(rows, named.select("event_id", "home", "away", "kickoff"), L.PROFILES["live"], runner_up=False).select("row_id", "event_id", r6("score").alias("score"), "linked")


@query(
    """+ x AS (SELECT event_id, home_id, away_id, kickoff FROM results), c AS (SELECT r.event_id AS row_id, t.event_id, count(*) OVER (PARTITION BY r.event_id) AS a, count(*) OVER (PARTITION BY t.event_id) AS b FROM x r JOIN x t ON r.home_id = t.home_id AND r.away_id = t.away_id AND r.event_id % 2 = 0
       AND t.event_id % 2 = 1 AND abs(epoch(r.kickoff) - epoch(t.kickoff)) <= 864000) SELECT row_id, event_id FROM c WHERE a = 1 AND b = 1""",
    ("results",),
)
def j6_link_exact_clock(spark, sf):
    x = T.results(spark, sf).selectExpr("event_id", "home_id AS home", "away_id AS away", "kickoff")
    return L.link_exact_clock(x.where("event_id % 2 = 0").withColumnRenamed("event_id", "row_id"), x.where("event_id % 2 = 1"), 864_000)


@query(
    """+ a AS (SELECT DISTINCT entity AS name_key FROM alias_obs), s AS (SELECT DISTINCT source FROM alias_obs), k AS (SELECT source, lower(regexp_replace(alias, '[^\\p{L}\\p{N}]', '', 'g')) AS name_key, confidence FROM alias_obs)
       SELECT a.name_key, s.source, CASE WHEN EXISTS (SELECT 1 FROM k WHERE k.source = s.source AND k.name_key = a.name_key AND confidence >= 0.93) THEN 'DIRECT_MASTER' WHEN EXISTS (SELECT 1 FROM k WHERE k.source = s.source AND k.name_key = a.name_key) THEN 'GAP' ELSE 'ABSENT' END AS coverage FROM a, s""",
    ("alias_obs",),
)
def j20_anchor_coverage(spark, sf):
    o = T.alias_obs(spark, sf)
    k = o.withColumn("name_key", E.name_key(F.col("alias"))).withColumn("status", F.when(F.col("confidence") >= 0.93, "VERIFIED").otherwise("CANDIDATE"))
    return L.anchor_coverage(o.select(F.col("entity").alias("name_key")).distinct(), o.select("source").distinct(), k, k)


# Registry

ROLLUP = """+ k AS (SELECT *, lower(regexp_replace(alias, '[^\\p{L}\\p{N}]', '', 'g')) AS name_key FROM alias_obs),
  rollup_ AS (SELECT source, name_key, entity, max(struct_pack(o := observed_at, a := alias)).a AS alias, count(*) AS n_seen, count(DISTINCT event_id) AS n_events, max(confidence) AS confidence, min(observed_at) AS first_seen, max(observed_at) AS last_seen FROM k GROUP BY 1, 2, 3)"""


def _rollup(spark: SparkSession, sf: str) -> DataFrame:
    return R.alias_rollup(T.alias_obs(spark, sf).withColumn("name_key", E.name_key(F.col("alias"))))


@query(ROLLUP + " SELECT source, name_key, entity, alias, n_seen, n_events, round(confidence, 6) AS confidence, first_seen, last_seen FROM rollup_", ("alias_obs",))
def a3_alias_rollup(spark, sf):
    return _rollup(spark, sf).withColumn("confidence", r6("confidence"))


@query(
    ROLLUP + """, c AS (SELECT source, name_key, count(DISTINCT entity) AS n_targets FROM rollup_ GROUP BY 1, 2)
      SELECT source, name_key, entity, n_targets, CASE WHEN n_targets > 1 THEN 'AMBIGUOUS' WHEN n_events >= 2 OR name_key = entity OR confidence >= 0.93 THEN 'VERIFIED' ELSE 'CANDIDATE' END AS status FROM rollup_ JOIN c USING (source, name_key)""",
    ("alias_obs",),
)
def a4_a5_classify_alias(spark, sf):
    return R.classify_alias(_rollup(spark, sf)).select("source", "name_key", "entity", "n_targets", "status")


@query(ROLLUP + " SELECT name_key, min(entity) AS entity FROM rollup_ GROUP BY 1 HAVING count(DISTINCT entity) = 1", ("alias_obs",))
def w7_global_lookup(spark, sf):
    return R.global_lookup(_rollup(spark, sf).withColumn("status", F.lit("VERIFIED"))).select("name_key", "entity")


@query("SELECT entity, alias, first_seen, last_seen FROM (SELECT entity, alias, min(observed_at) OVER w AS first_seen, max(observed_at) OVER w AS last_seen, row_number() OVER (PARTITION BY entity ORDER BY observed_at DESC, length(alias) DESC, alias, event_id) AS n FROM alias_obs WINDOW w AS (PARTITION BY entity)) WHERE n = 1", ("alias_obs",))
def w1_preferred_name(spark, sf):
    return R.preferred_name(T.alias_obs(spark, sf))


@query(ROLLUP + " SELECT source, name_key, list_sort(list(DISTINCT entity))[1] AS first_entity, count(DISTINCT entity) AS n FROM rollup_ GROUP BY 1, 2 HAVING count(DISTINCT entity) > 1", ("alias_obs",))
def a9_context_collisions(spark, sf):
    c = R.context_collisions(_rollup(spark, sf).withColumn("competition", F.lit("all")))
    return c.select("source", "name_key", F.get("entities", F.lit(0)).alias("first_entity"), F.size("entities").cast("long").alias("n"))


# Windows and aggregates

@query(
    """+ t AS (SELECT max(captured_at) AS now FROM odds_history) SELECT event_id, CASE WHEN count(home) >= 2 THEN max(home) - min(home) END AS volatility, count(home) AS points FROM odds_history, t WHERE epoch(now) - epoch(captured_at) BETWEEN 0 AND 86400 GROUP BY 1""",
    ("odds_history",),
)
def w6_range_volatility(spark, sf):
    h = T.odds_history(spark, sf)
    return R.range_volatility(h.crossJoin(F.broadcast(h.agg(F.max("captured_at").alias("now")))), "home", F.col("now"))


@query(
    """SELECT event_id, snapshot_id, captured_at, round(home - first_value(home) OVER w, 6) AS change, round(max(home) OVER w - min(home) OVER w, 6) AS spread FROM odds_history
       WINDOW w AS (PARTITION BY event_id ORDER BY captured_at RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW)""",
    ("odds_history",),
)
def w10_movement_series(spark, sf):
    return R.movement_series(T.odds_history(spark, sf), "home").select("event_id", "snapshot_id", "captured_at", r6("change").alias("change"), r6("spread").alias("spread"))


@query(
    f"""+ p AS (SELECT f.event_id, r.event_id AS past_id, r.kickoff AS past_at FROM results f JOIN results r ON least(f.home_id, f.away_id) = least(r.home_id, r.away_id) AND greatest(f.home_id, f.away_id) = greatest(r.home_id, r.away_id) AND r.kickoff < f.kickoff WHERE f.kickoff >= {NOW})
        SELECT event_id, past_id, r FROM (SELECT event_id, past_id, CAST(row_number() OVER (PARTITION BY event_id ORDER BY past_at DESC, past_id) AS INTEGER) AS r FROM p) WHERE r <= 5""",
    ("results",),
)
def w4_top_recent(spark, sf):
    res = T.results(spark, sf)
    return L.last_meetings(res.where(f"kickoff >= {NOW}"), res, 5).select("event_id", "past_id", "r")


@query(
    """SELECT player, count(*) AS games, sum(minutes) AS minutes, CAST(sum(goals) AS BIGINT) AS goals FROM (SELECT *, row_number() OVER (PARTITION BY player ORDER BY played_at DESC, event_id, line) AS n FROM players WHERE minutes > 0) WHERE n <= 6 GROUP BY 1""",
    ("players",),
)
def a17_recent_form(spark, sf):
    return R.recent_form(T.players(spark, sf))


@query("SELECT tournament, count(*) AS total, count(p.event_id) AS matched FROM results r LEFT JOIN (SELECT DISTINCT event_id FROM predictions WHERE source = 's1') p ON r.event_id = p.event_id GROUP BY 1", ("results", "predictions"))
def a21_league_coverage(spark, sf):
    return R.coverage(T.results(spark, sf), T.predictions(spark, sf).where("source = 's1'"), "tournament")


@query("SELECT source, count(*) AS n, round(least(0.79, 0.25 + least(0.30, count(*) / 1000.0) + max(CASE WHEN minute > 98 THEN 0.15 ELSE 0 END)), 6) AS trust FROM live_stats GROUP BY 1", ("live_stats",))
def a28_trust_score(spark, sf):
    return R.trust_score(T.live_stats(spark, sf).withColumn("matched", F.col("minute") > 98)).withColumn("trust", r6("trust"))


@query("""+ i AS (SELECT (SELECT array_to_string(list(event_id ORDER BY event_id), ',') FROM (SELECT DISTINCT event_id FROM live_stats WHERE home > 50 ORDER BY 1 LIMIT 50)) AS ids_high, (SELECT array_to_string(list(event_id ORDER BY event_id), ',') FROM (SELECT DISTINCT event_id FROM live_stats WHERE minute >= 90 ORDER BY 1 LIMIT 50)) AS ids_late)
          SELECT count(*) AS n_rows, count(*) FILTER (home > 50) AS n_high, count(*) FILTER (minute >= 90) AS n_late, coalesce(any_value(ids_high), '') AS ids_high, coalesce(any_value(ids_late), '') AS ids_late FROM live_stats, i""", ("live_stats",))
def a11_guard_counts(spark, sf):
    g = R.guard_counts(T.live_stats(spark, sf), {"high": F.col("home") > 50, "late": F.col("minute") >= 90}, "event_id")
    return g.withColumns({c: F.array_join(c, ",") for c in ("ids_high", "ids_late")})


@query(
    """+ e AS (SELECT o_custkey AS event_id, p.source, home / 100 AS h, draw / 100 AS d, away / 100 AS a FROM predictions p JOIN orders ON o_orderkey = p.event_id WHERE p.source IN ('s0', 's1', 's3'))
       SELECT event_id, round(avg(h), 6) AS h, count(*) AS n, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources FROM e GROUP BY 1""",
    ("predictions",),
)
def a13_ensemble(spark, sf):
    p = T.predictions(spark, sf).join(T.table(spark, sf, "orders").selectExpr("o_orderkey AS event_id", "o_custkey"), "event_id")
    e = p.select(F.col("o_custkey").alias("event_id"), "source", (F.col("home") / 100).alias("h"), (F.col("draw") / 100).alias("d"), (F.col("away") / 100).alias("a"))
    return R.ensemble(e, ["s0", "s1", "s3"]).select("event_id", r6("h").alias("h"), "n", "sources")


@query("SELECT event_id, row_id, home FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY home DESC, row_id DESC) AS n FROM live_stats) WHERE n = 1", ("live_stats",))
def a29_best_per_event(spark, sf):
    return R.best_per_event(T.live_stats(spark, sf).select("row_id", "event_id", "home"), "home").select("event_id", "row_id", "home")


# State

@query("SELECT event_id, captured_at, row_id, home FROM (SELECT *, row_number() OVER (PARTITION BY event_id, source ORDER BY captured_at DESC, row_id % 2 DESC, row_id DESC) AS n FROM live_stats) WHERE n = 1", ("live_stats",))
def m1_merge_newest(spark, sf):
    x = T.live_stats(spark, sf).select("event_id", "source", "captured_at", "row_id", "home")
    return S.merge_newest(x.where("row_id % 2 = 0"), x.where("row_id % 2 = 1"), ["event_id", "source"], "captured_at").drop("source")


@query("SELECT event_id, max(captured_at) AS captured_at, min(home) AS home, sum(away) AS away FROM live_stats GROUP BY 1", ("live_stats",))
def m2_merge_monotone(spark, sf):
    x = T.live_stats(spark, sf).select("event_id", "captured_at", "home", "away")
    return S.merge_monotone(x.where("home < 50"), x.where("home >= 50 OR home IS NULL"), ["event_id"], {"captured_at": "greatest", "home": "least", "away": "sum"})


@query("SELECT event_id, home, draw FROM predictions WHERE source IN ('s0', 's1') UNION ALL SELECT event_id, home, draw FROM predictions WHERE source = 's2'", ("predictions",))
def m9_append_absent(spark, sf):
    p = T.predictions(spark, sf)
    return S.append_absent(p.where("source IN ('s0', 's1')").select("event_id", "home", "draw"), p.where("source IN ('s1', 's2')").select("event_id", "home", "draw"), ["event_id"])


@query(
    """SELECT r.event_id, CASE WHEN p.source IN ('s0', 's1') THEN 'MODEL' WHEN p.source = 's2' THEN 'ABSENT' WHEN p.source = 's3' THEN 'NOT_AVAILABLE' ELSE 'PENDING' END AS status FROM results r JOIN predictions p ON r.event_id = p.event_id WHERE r.confirmed""",
    ("results", "predictions"),
)
def m10_reconcile_availability(spark, sf):
    p = T.predictions(spark, sf)
    old = p.where("source IN ('s2', 's3')").select("event_id", F.when(F.col("source") == "s2", "MODEL").otherwise("NOT_AVAILABLE").alias("status"))
    return S.reconcile_availability(p.where("source IN ('s0', 's1')"), old, T.results(spark, sf).where("confirmed"))


@query(
    """+ s AS (SELECT *, CASE WHEN epoch(kickoff) - epoch(captured_at) > 14400 THEN 60 ELSE 30 END AS m FROM odds_history), b AS (SELECT *, make_timestamp(CAST(floor(epoch(captured_at) / (60 * m)) * (60 * m) * 1000000 AS BIGINT)) AS slot FROM s)
       SELECT event_id, slot, captured_at, snapshot_id FROM (SELECT *, row_number() OVER (PARTITION BY event_id, slot ORDER BY captured_at DESC, snapshot_id DESC) AS n FROM b) WHERE n = 1""",
    ("odds_history",),
)
def m13_sample_slots(spark, sf):
    h = T.odds_history(spark, sf).select("event_id", "snapshot_id", "captured_at", "kickoff")
    return S.sample_slots(h, F.expr("TIMESTAMP '2024-02-01 00:00:00'")).select("event_id", "slot", "captured_at", "snapshot_id")


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN home WHEN event_id % 2 = 0 THEN draw END AS home, event_id % 2 = 0 AND event_id % 4 <> 0 AS carried FROM predictions", ("predictions",))
def m6_carry_forward(spark, sf):
    p = T.predictions(spark, sf)
    new = p.where("event_id % 4 = 0").select("event_id", "home")
    old = p.where("event_id % 2 = 0").select("event_id", F.col("draw").alias("home"))
    return S.carry_forward(new, old, p.select("event_id"), ["event_id"], ["home"], "home IS NOT NULL")


# Models and reports

@query(
    f"""+ p AS (SELECT f.event_id, r.event_id AS past_id, r.kickoff AS past_at, CASE WHEN r.home_id = f.home_id THEN r.home_goals ELSE r.away_goals END AS gf, CASE WHEN r.home_id = f.home_id THEN r.away_goals ELSE r.home_goals END AS ga
          FROM results f JOIN results r ON least(f.home_id, f.away_id) = least(r.home_id, r.away_id) AND greatest(f.home_id, f.away_id) = greatest(r.home_id, r.away_id) AND r.kickoff < f.kickoff WHERE f.kickoff >= {NOW}),
        t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY past_at DESC, past_id) AS n FROM p) WHERE n <= 5),
        g AS (SELECT event_id, count(*) AS games, count(*) FILTER (gf > ga) AS wins, count(*) FILTER (gf = ga) AS draws, CAST(sum(gf) AS BIGINT) AS gf, string_agg(CASE WHEN gf > ga THEN 'W' WHEN gf < ga THEN 'L' ELSE 'D' END, '' ORDER BY n) AS last FROM t GROUP BY 1)
        SELECT r.event_id, games, wins, draws, gf, last, CASE WHEN games IS NULL THEN 'NO_PREVIOUS' WHEN games < 5 THEN 'PARTIAL' ELSE 'OK' END AS quality FROM results r LEFT JOIN g USING (event_id) WHERE kickoff >= {NOW}""",
    ("results",),
)
def md14_h2h_summary(spark, sf):
    res = T.results(spark, sf)
    return M.h2h_summary(res.where(f"kickoff >= {NOW}"), res).select("event_id", "games", "wins", "draws", "gf", "last", "quality")


@query(
    f"""+ teams AS (SELECT event_id, kickoff, 'H' AS side, home_id AS team, home_goals AS gf, away_goals AS ga FROM results UNION ALL SELECT event_id, kickoff, 'A', away_id, away_goals, home_goals FROM results),
        p AS (SELECT f.event_id, f.side, h.gf, h.ga, row_number() OVER (PARTITION BY f.event_id, f.side ORDER BY h.kickoff DESC, h.event_id) AS n FROM teams f JOIN teams h ON f.team = h.team AND h.kickoff < f.kickoff WHERE f.kickoff >= {NOW})
        SELECT event_id, side, count(*) AS games, string_agg(CASE WHEN gf > ga THEN 'W' WHEN gf < ga THEN 'L' ELSE 'D' END, '' ORDER BY n) AS form, CAST(sum(gf) AS BIGINT) AS gf FROM p WHERE n <= 6 GROUP BY 1, 2""",
    ("results",),
)
def md15_team_form_summary(spark, sf):
    res = T.results(spark, sf)
    return M.team_form_summary(res.where(f"kickoff >= {NOW}"), res).select("event_id", "side", "games", "form", "gf")


_BACK = ", ".join(f"min(struct_pack(g := abs(age - {s}), c := captured_at, i := snapshot_id, h := h, d := d, a := a)) FILTER (abs(age - {s}) <= {t}) AS {n}" for n, s, t in (("d24", 86_400, 10_800), ("d2", 7_200, 4_500), ("d1", 3_600, 2_400)))
_RANGE = ", ".join(f"CASE WHEN count(*) FILTER (age <= 86400) >= 2 THEN max({c}) FILTER (age <= 86400) - min({c}) FILTER (age <= 86400) END AS v{c}" for c in "hda")
_SIDES = " UNION ALL ".join(f"SELECT event_id, points, greatest(vh, vd, va) AS volatility, '{c.upper()}' AS side, l.{c} - d24.{c} AS d24, l.{c} - d2.{c} AS d2, l.{c} - d1.{c} AS d1 FROM g" for c in "hda")


@query(
    f"""+ f AS (SELECT event_id, snapshot_id, captured_at, floor(epoch(TIMESTAMP '2024-01-30')) - floor(epoch(captured_at)) AS age, 1/home/(1/home+1/draw+1/away) AS h, 1/draw/(1/home+1/draw+1/away) AS d, 1/away/(1/home+1/draw+1/away) AS a FROM odds_history WHERE home > 1 AND draw > 1 AND away > 1 AND captured_at <= TIMESTAMP '2024-01-30'),
        g AS (SELECT event_id, max(struct_pack(c := captured_at, i := snapshot_id, h := h, d := d, a := a)) AS l, {_BACK}, count(*) FILTER (age <= 86400) AS points, {_RANGE} FROM f GROUP BY 1), s AS ({_SIDES}),
        t AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY greatest(coalesce(abs(d24), 0), coalesce(abs(d2), 0), coalesce(abs(d1), 0)) DESC, side DESC) AS r FROM s)
        SELECT event_id, points, side, round(d24, 6) AS d24, round(d2, 6) AS d2, round(d1, 6) AS d1, round(volatility, 6) AS volatility, CASE WHEN sign(d24) * sign(d1) < 0 AND abs(d24) >= 0.02 AND abs(d1) >= 0.02 THEN 'REVERSAL' WHEN d1 >= 0.02 THEN '1H STEAM' WHEN d1 <= -0.02 THEN '1H DRIFT' WHEN d2 >= 0.03 THEN '2H STEAM' WHEN d2 <= -0.03 THEN '2H DRIFT'
          WHEN d24 >= 0.05 THEN '24H STEAM' WHEN d24 <= -0.05 THEN '24H DRIFT' WHEN volatility >= 0.08 THEN 'HIGH VOLATILITY' WHEN points < 2 THEN 'COLLECTING' ELSE 'STABLE' END AS signal FROM t WHERE r = 1""",
    ("odds_history",),
)
def md6_odds_movement(spark, sf):
    m = M.odds_movement(T.odds_history(spark, sf), F.expr("TIMESTAMP '2024-01-30 00:00:00'"))
    return m.withColumns({c: r6(c) for c in ("d24", "d2", "d1", "volatility")})


@query(
    """+ e AS (SELECT p.event_id, o.home * (p.home / 100) - 1 AS x, o.draw * (p.draw / 100) - 1 AS y, o.away * (p.away / 100) - 1 AS z, p.source FROM predictions p JOIN odds o ON p.event_id = o.event_id WHERE p.source IN ('s0', 's1', 's2'))
       SELECT event_id, round(greatest(x, y, z), 6) AS edge, CASE WHEN x = greatest(x, y, z) THEN 'H' WHEN y = greatest(x, y, z) THEN 'D' ELSE 'A' END AS side, CASE WHEN greatest(x, y, z) > 0 THEN 'CANDIDATE_POSITIVE_EV' ELSE 'NO_POSITIVE_EV' END AS state, source AS sources FROM e""",
    ("predictions", "odds"),
)
def md11_decide(spark, sf):
    p = T.predictions(spark, sf).select("event_id", "source", *[(F.col(c) / 100).alias(k) for c, k in (("home", "h"), ("draw", "d"), ("away", "a"))])
    return M.decide(p, T.odds(spark, sf), ["s0", "s1", "s2"]).select("event_id", r6("edge").alias("edge"), "side", "state", "sources")


@query(
    """+ e AS (SELECT p.event_id, p.source AS model, p.home AS h, p.draw AS d, p.away AS a, o.home * (p.home / 100) - 1 AS x, o.draw * (p.draw / 100) - 1 AS y, o.away * (p.away / 100) - 1 AS z, o.home, o.draw, o.away, """ + OUTCOME + """ AS out
         FROM predictions p JOIN odds o ON p.event_id = o.event_id JOIN results r ON r.event_id = p.event_id WHERE r.confirmed),
       b AS (SELECT *, greatest(x, y, z) AS best, CASE WHEN x = greatest(x, y, z) THEN 'H' WHEN y = greatest(x, y, z) THEN 'D' ELSE 'A' END AS side, CASE WHEN h >= d AND h >= a THEN 'H' WHEN d >= a THEN 'D' ELSE 'A' END AS pick FROM e)
       SELECT model, count(*) AS n, round(avg((pick = out)::INT), 6) AS accuracy, count(*) FILTER (best > 0) AS bets, round(avg(CASE WHEN side <> out THEN -1.0 WHEN side = 'H' THEN home - 1 WHEN side = 'D' THEN draw - 1 ELSE away - 1 END) FILTER (best > 0), 6) AS roi FROM b GROUP BY 1""",
    ("predictions", "odds", "results"),
)
def md12_a14_validation(spark, sf):
    p = T.predictions(spark, sf).select("event_id", F.col("source").alias("model"), *[(F.col(c) / 100).alias(k) for c, k in (("home", "h"), ("draw", "d"), ("away", "a"))])
    scores = M.validation_score(p, T.odds(spark, sf), T.results(spark, sf))
    return M.validation_summary(scores, p.select("model").distinct()).select("model", "n", r6("accuracy").alias("accuracy"), "bets", r6("roi").alias("roi"))


@query(
    """+ o AS (SELECT event_id FROM odds WHERE event_id % 3 > 0), p AS (SELECT event_id FROM predictions WHERE source <> 's5'), m AS (SELECT event_id FROM results WHERE confirmed),
       h AS (SELECT r.event_id, (o.event_id IS NOT NULL)::INT + (p.event_id IS NOT NULL)::INT + (m.event_id IS NOT NULL)::INT AS channels, o.event_id IS NULL AS a, p.event_id IS NULL AS b, m.event_id IS NULL AS c FROM results r LEFT JOIN o USING (event_id) LEFT JOIN p USING (event_id) LEFT JOIN m USING (event_id))
       SELECT event_id, channels, concat_ws(',', CASE WHEN a THEN 'NO_ODDS' END, CASE WHEN b THEN 'NO_PREDICTION' END, CASE WHEN c THEN 'NO_MODEL' END) AS codes, CASE WHEN a THEN 'NO_ODDS' WHEN b THEN 'NO_PREDICTION' WHEN c THEN 'NO_MODEL' END AS primary_reason,
         CASE channels WHEN 3 THEN 'OK' WHEN 0 THEN 'FAIL' ELSE 'WARN' END AS status FROM h""",
    ("results", "odds", "predictions"),
)
def q1_data_health(spark, sf):
    res = T.results(spark, sf)
    return M.data_health(res.select("event_id", "kickoff"), T.odds(spark, sf).where("event_id % 3 > 0"), T.predictions(spark, sf).where("source <> 's5'"), res.where("confirmed"), F.expr("TIMESTAMP '1970-01-01 00:00:00'"))


@query(
    """SELECT h.source, CASE WHEN date_diff('second', observed_at, TIMESTAMP '2024-01-30 23:00:00') / 60.0 > 25 THEN 'STALE' ELSE 'OK' END AS state, CAST(floor((epoch(TIMESTAMP '2024-01-30 23:00:00') - epoch(observed_at)) / 60) AS BIGINT) AS age_minutes FROM source_health h UNION ALL SELECT 'absent', 'MISSING', NULL""",
    ("source_health",),
)
def q7_system_health(spark, sf):
    h = T.source_health(spark, sf)
    expected = h.select("source").union(spark.createDataFrame([("absent",)], "source string")).withColumn("max_age_minutes", F.lit(25))
    return M.system_health(expected, h, F.expr("TIMESTAMP '2024-01-30 23:00:00'"))


@query()
def md2_pi_ratings(spark, sf):
    return M.pi_ratings(T.results(spark, sf))


@query(
    """+ e AS (SELECT event_id, CASE WHEN home >= draw AND home >= away THEN 'H' WHEN draw >= away THEN 'D' ELSE 'A' END AS direction FROM predictions)
       SELECT event_id, count(*) FILTER (direction = 'H') AS home_support, count(*) FILTER (direction = 'A') AS away_support, count(*) AS n FROM e GROUP BY 1""",
    ("predictions",),
)
def md16_evidence_graph(spark, sf):
    res = T.results(spark, sf)
    form = res.select("event_id", F.lit("H").alias("side"), F.lit("W").alias("form")).where("1 = 0")
    return M.evidence_graph(res.select("event_id"), form, T.predictions(spark, sf))[2].select("event_id", "home_support", "away_support", "n")


#: The mean points of each side's last six games before kickoff, as SQL; p (event_id, h, a) has null where a side has no game.
FORM_POINTS = """teams AS (SELECT event_id, kickoff, 'H' AS side, home_id AS team, home_goals AS gf, away_goals AS ga FROM results UNION ALL SELECT event_id, kickoff, 'A', away_id, away_goals, home_goals FROM results),
       past AS (SELECT f.event_id, f.side, h.gf, h.ga, row_number() OVER (PARTITION BY f.event_id, f.side ORDER BY h.kickoff DESC, h.event_id) AS r FROM teams f JOIN teams h ON f.team = h.team AND h.kickoff < f.kickoff),
       p AS (SELECT event_id, avg(CASE WHEN gf > ga THEN 3.0 WHEN gf = ga THEN 1.0 ELSE 0.0 END) FILTER (side = 'H') AS h, avg(CASE WHEN gf > ga THEN 3.0 WHEN gf = ga THEN 1.0 ELSE 0.0 END) FILTER (side = 'A') AS a FROM past WHERE r <= 6 GROUP BY 1)"""


@query(
    f"""+ {FORM_POINTS}, e AS (SELECT event_id, CASE WHEN home >= draw AND home >= away THEN 'H' WHEN draw >= away THEN 'D' ELSE 'A' END AS direction FROM predictions UNION ALL SELECT event_id, CASE WHEN h > a THEN 'H' ELSE 'A' END FROM p WHERE h <> a),
       w AS (SELECT event_id, count(*) FILTER (direction = 'H') AS home_support, count(*) FILTER (direction = 'A') AS away_support, count(*) AS n FROM e GROUP BY 1)
       SELECT *, least(home_support, away_support) > 0 AS conflict, round(abs(home_support - away_support) / n, 6) AS confidence FROM w""",
    ("results", "predictions"),
)
def md16_evidence_graph_form(spark, sf):
    res = T.results(spark, sf)
    why = M.evidence_graph(res.select("event_id"), M.team_form_summary(res, res), T.predictions(spark, sf))[2]
    return why.select("event_id", "home_support", "away_support", "n", "conflict", r6("confidence").alias("confidence"))


# Extraction

@query("""SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, length(line) AS n_chars FROM (SELECT doc_id, string_split(text, chr(10)) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i, unnest(string_split(text, chr(10))) AS line FROM documents)""")
def src8_text_lines(spark, sf):
    return X.text_lines(T.table(spark, sf, "documents")).select("doc_id", "pos", F.length("line").cast("long").alias("n_chars"))


@query(
    """+ b AS (SELECT page_id, regexp_extract_all(coalesce(html, ''), '(?is)<p\\b[^>]*>(.*?)</p>', 1) AS b FROM pages), p AS (SELECT page_id, unnest(range(0, len(b))) AS i, unnest(b) AS block FROM b),
       c AS (SELECT page_id, CAST(i AS INTEGER) AS pos, trim(regexp_replace(regexp_replace(block, '(?s)<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS t FROM p), n AS (SELECT *, try_cast(nullif(regexp_extract(t, '(\\d{1,3}(\\.\\d+)?)\\s*%', 1), '') AS DOUBLE) AS pct FROM c)
       SELECT page_id, pos, CAST(length(t) AS INTEGER) AS n_chars, CASE WHEN pct BETWEEN 0 AND 100 THEN pct END AS percent, try_cast(nullif(regexp_extract(t, '\\b(\\d{1,2})\\s*-\\s*\\d{1,2}\\b', 1), '') AS INTEGER) AS home_goals FROM n"""
)
def src5_listing(spark, sf):
    return X.extract_listing(T.table(spark, sf, "pages"))


@query("""+ ok AS (SELECT page_id, html FROM pages WHERE strlen(html) >= 500 AND len(regexp_extract_all(html, '(?i)<p\\b')) >= 2) SELECT sha256(html) AS digest, min(page_id) AS page_id, count(*) AS copies FROM ok GROUP BY html""")
def src17_healthy_pages(spark, sf):
    return X.healthy_pages(T.table(spark, sf, "pages"))


@query("SELECT event_id, 'k' AS key, json_extract_string(props, '$.k') AS value FROM events")
def src12_flatten_props(spark, sf):
    return X.flatten_props(T.table(spark, sf, "events"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def src18_dedupe_observations(spark, sf):
    return X.dedupe_observations(T.table(spark, sf, "events"), ["user_id", "event_type"])


# Streaming logic on stored rows

@query("SELECT event_id, time_bucket(INTERVAL 30 MINUTES, captured_at) AS slot, max(struct_pack(c := captured_at, s := snapshot_id, h := home)).h AS home FROM odds_history GROUP BY 1, 2", ("odds_history",))
def l3_slots(spark, sf):
    return V.slots(T.odds_history(spark, sf)).select("event_id", "slot", "home")


@query(
    """+ g AS (SELECT event_id, captured_at, CASE WHEN epoch(captured_at) - epoch(lag(captured_at) OVER (PARTITION BY event_id ORDER BY captured_at)) < 86400 THEN 0 ELSE 1 END AS fresh FROM live_stats), s AS (SELECT *, sum(fresh) OVER (PARTITION BY event_id ORDER BY captured_at ROWS UNBOUNDED PRECEDING) AS k FROM g)
       SELECT event_id, min(captured_at) AS began, max(captured_at) + INTERVAL 24 HOURS AS ended, count(*) AS n FROM s GROUP BY event_id, k""",
    ("live_stats",),
)
def l11_sessions(spark, sf):
    return V.sessions(T.live_stats(spark, sf), "24 hours")


@query(
    """SELECT o.event_id, o.snapshot_id, s.row_id AS s_row FROM odds_history o LEFT JOIN live_stats s ON o.event_id = s.event_id AND s.captured_at BETWEEN o.captured_at - INTERVAL 600 MINUTES AND o.captured_at + INTERVAL 600 MINUTES""",
    ("odds_history", "live_stats"),
)
def l7_join_within(spark, sf):
    return V.join_within(T.odds_history(spark, sf), T.live_stats(spark, sf), 600).select("event_id", "snapshot_id", "s_row")


@query("SELECT event_id, row_id, source FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY CASE source WHEN 'click' THEN 0 WHEN 'view' THEN 1 ELSE 2 END, captured_at DESC, row_id DESC) AS n FROM live_stats WHERE source IN ('click', 'view')) WHERE n = 1", ("live_stats",))
def l12_precedence_union(spark, sf):
    x = T.live_stats(spark, sf).select("event_id", "captured_at", "row_id", "source")
    return V.precedence_union([x.where(F.col("source") == s) for s in ("click", "view")]).select("event_id", "row_id", "source")
