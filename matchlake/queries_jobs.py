"""Registered queries of models with a stored state or several histories, of listings and stat trees, and of the target audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchlake import testdata as T
from matchlake.plans import goals as G
from matchlake.plans import intersection as A
from matchlake.plans import models as M
from matchlake.queries import NOW, query, r6
from matchlake.sources import listings as X

GAP = "sign({0}) * (pow(CAST(10 AS DOUBLE), abs({0}) / 3) - 1)"
GAME = "{{r: {r}, o: {o}, e: {e}, hi: {hi}, ai: {ai}, d: {d}}}"


@query(
    f"""+ g AS (SELECT tournament, list({GAME.format(r="CAST(NULL AS DOUBLE[])", o="CAST(NULL AS STRUCT(e BIGINT, h DOUBLE, a DOUBLE, g DOUBLE)[])", e="event_id", hi="CAST(home_id AS BIGINT)", ai="CAST(away_id AS BIGINT)", d="CAST(home_goals - away_goals AS DOUBLE)")} ORDER BY kickoff, event_id) AS l FROM results GROUP BY 1),
      f AS (SELECT list_reduce(list_prepend({GAME.format(r="CAST(list_transform(range(80), lambda i: 0) AS DOUBLE[])", o="CAST([] AS STRUCT(e BIGINT, h DOUBLE, a DOUBLE, g DOUBLE)[])", e="CAST(0 AS BIGINT)", hi="CAST(0 AS BIGINT)", ai="CAST(0 AS BIGINT)", d="CAST(0 AS DOUBLE)")}, l), lambda s, y:
        list_transform([{{h: s.r[2 * y.hi + 1], a: s.r[2 * y.ai + 2]}}], lambda v: list_transform([{GAP.format("v.h")} - ({GAP.format("v.a")})], lambda w: list_transform([CAST(0.035 AS DOUBLE) * sign(y.d - w) * 3 * log10(1 + abs(y.d - w))], lambda p:
          {GAME.format(r="list_transform(s.r, lambda x, i: x + CASE i WHEN 2 * y.hi + 1 THEN p WHEN 2 * y.hi + 2 THEN p * CAST(0.7 AS DOUBLE) WHEN 2 * y.ai + 1 THEN -p * CAST(0.7 AS DOUBLE) WHEN 2 * y.ai + 2 THEN -p ELSE 0 END)", o="list_append(s.o, {e: y.e, h: v.h, a: v.a, g: w})", e="y.e", hi="y.hi", ai="y.ai", d="y.d")})[1])[1])[1]).o AS o FROM g)
      SELECT u.e AS event_id, round(u.h, 6) AS home_rating, round(u.a, 6) AS away_rating, round(u.g, 6) AS expected_gap FROM (SELECT unnest(o) AS u FROM f)""",
    ("results",),
)
def md2_ratings_resumed(spark, sf):
    """The ratings before every game, folded up to a date and then on from the state; the SQL folds all games at once."""
    res = T.results(spark, sf)
    cut = F.expr("TIMESTAMP '1996-06-01 00:00:00'")
    first = G.fold_ratings(res.where(F.col("kickoff") < cut))
    state = first.where("kind = 'state'").select("tournament", F.col("home_id").alias("team"), "home_rating", "away_rating", "games", "last_at", "last_event")
    both = first.where("kind = 'game'").unionByName(G.fold_ratings(res.where(F.col("kickoff") >= cut), state).where("kind = 'game'"))
    return both.select("event_id", *[r6(c).alias(c) for c in ("home_rating", "away_rating", "expected_gap")])


@query()
def md3_goal_model(spark, sf):
    """Forecasts by the joint low-score likelihood of each league; no SQL, since each is a fit."""
    res = T.results(spark, sf)
    f = G.goal_model(res.where(f"kickoff >= {NOW}").select("event_id", "tournament", "home_id", "away_id"), F.expr(NOW), res)
    return f.select("event_id", "tier", "training_matches", *[F.round(c, 4).alias(c) for c in ("lh", "la", "rho", "h", "d", "a", "over25")])


ARCHIVE = "kickoff < TIMESTAMP '1997-10-01 00:00:00' AND event_id % 2 = 0"


@query(
    f"""+ arch AS (SELECT kickoff, home_id AS h, away_id AS w, (home_goals + 1) % 5 AS hg, away_goals AS ag, event_id % 5 = 0 AS neutral FROM results WHERE {ARCHIVE}), latest AS (SELECT max(kickoff) AS t FROM arch), known AS (SELECT DISTINCT h AS k FROM arch WHERE h < 35 UNION SELECT DISTINCT w FROM arch WHERE w < 35),
      f AS (SELECT *, tournament IN ('1-URGENT', '2-HIGH') AND home_id IN (FROM known) AND away_id IN (FROM known) AS inside FROM results WHERE kickoff >= {NOW}),
      ft AS (SELECT event_id, kickoff, inside, 'H' AS side, home_id AS team FROM f UNION ALL SELECT event_id, kickoff, inside, 'A', away_id FROM f),
      past AS (SELECT true AS ext, kickoff, CASE WHEN neutral THEN 'N' ELSE 'H' END AS side, h AS team, hg AS gf, ag AS ga FROM arch WHERE h < 35 UNION ALL SELECT true, kickoff, CASE WHEN neutral THEN 'N' ELSE 'A' END, w, ag, hg FROM arch WHERE w < 35
        UNION ALL SELECT false, kickoff, 'H', home_id, home_goals, away_goals FROM results UNION ALL SELECT false, kickoff, 'A', away_id, away_goals, home_goals FROM results),
      x AS (SELECT f.event_id, f.side, f.inside, p.ext, f.side = p.side AS v, gf, ga, exp(-0.6931471805599453 * (epoch(f.kickoff) - epoch(p.kickoff)) / 86400.0 / 180.0) AS w FROM ft f JOIN past p ON p.team = f.team AND p.kickoff < f.kickoff, latest
        WHERE (epoch(f.kickoff) - epoch(p.kickoff)) / 86400.0 <= CASE WHEN p.ext THEN 730 ELSE 540 END AND CASE WHEN f.inside THEN p.ext OR p.kickoff > latest.t ELSE NOT p.ext END),
      r AS (SELECT event_id, side, sum(w * gf) / sum(w) AS gf, sum(w * ga) / sum(w) AS ga, count(*) AS n, sum(w) AS weight, sum(w * gf) FILTER (v) / sum(w) FILTER (v) AS vgf, sum(w * ga) FILTER (v) / sum(w) FILTER (v) AS vga, count(*) FILTER (v) AS vn, coalesce(sum(w) FILTER (v), 0) AS vw, count(*) FILTER (ext) AS ne FROM x GROUP BY 1, 2),
      b AS (SELECT *, CASE WHEN vn >= 4 AND vw >= 1.5 THEN least(0.7, 0.4 + 0.03 * vn) ELSE 0 END AS k FROM r),
      s AS (SELECT event_id, side, n >= 8 AND weight >= 3 AS ok, greatest(k * coalesce(vgf, 0) + (1 - k) * gf, 0.1) AS f, greatest(k * coalesce(vga, 0) + (1 - k) * ga, 0.1) AS c FROM b),
      g AS (SELECT h.event_id, least(3.5, greatest(0.25, sqrt(h.f * a.c))) AS lh, least(3.5, greatest(0.25, sqrt(a.f * h.c))) AS la FROM s h JOIN s a ON h.event_id = a.event_id AND h.side = 'H' AND a.side = 'A' WHERE h.ok AND a.ok),
      grid AS (SELECT event_id, i, j, exp(-lh) * pow(lh, i) / factorial(i::INT) * exp(-la) * pow(la, j) / factorial(j::INT) AS p FROM g, range(11) y(i), range(11) z(j)),
      form AS (SELECT event_id, sum(p) FILTER (i > j) / sum(p) AS h, sum(p) FILTER (i = j) / sum(p) AS d, sum(p) FILTER (i < j) / sum(p) AS a FROM grid GROUP BY 1),
      ext AS (SELECT event_id, coalesce(sum(ne) FILTER (side = 'H'), 0)::BIGINT AS eh, coalesce(sum(ne) FILTER (side = 'A'), 0)::BIGINT AS ea FROM r GROUP BY 1)
      SELECT f.event_id, round(form.h, 6) AS h, round(form.d, 6) AS d, round(form.a, 6) AS a, CASE WHEN inside THEN 'ARCHIVE_AND_RECENT' ELSE 'OWN' END AS source, CASE WHEN inside THEN coalesce(eh, 0) ELSE 0 END AS external_home_games, CASE WHEN inside THEN coalesce(ea, 0) ELSE 0 END AS external_away_games
      FROM f LEFT JOIN form ON form.event_id = f.event_id LEFT JOIN ext ON ext.event_id = f.event_id""",
    ("results",),
)
def md1_form_with_archive(spark, sf):
    """Team form of the last months with an archive that ends before them, knows 35 of 40 teams and has other goals."""
    res = T.results(spark, sf)
    name = lambda s: F.concat(F.lit("Team "), f"{s}_id").alias(s)
    archive = res.where(ARCHIVE).select(name("home"), name("away"), "kickoff", ((F.col("home_goals") + 1) % 5).alias("home_goals"), "away_goals", (F.col("event_id") % 5 == 0).alias("neutral"))
    names = res.select(F.explode(F.array("home_id", "away_id")).alias("team")).distinct().where("team < 35").select(F.concat(F.lit("team  "), "team").alias("name"), "team")
    f = M.team_form_with_archive(res.where(f"kickoff >= {NOW}"), res, archive, names, F.col("tournament").isin("1-URGENT", "2-HIGH"))
    return f.select("event_id", *[r6(c).alias(c) for c in "hda"], "source", "external_home_games", "external_away_games")


def _listing_pages(spark, sf):
    """Twenty events on each page: some name their sides in a meta element only, lack a date, a price or a third share, or have no sides."""
    e = F.col("event_id")
    some = lambda c, text: F.when(c, text).otherwise("")
    say = lambda text, *columns: F.format_string(text, *columns)
    res = T.results(spark, sf)
    sides = F.when(e % 11 == 0, "<p>no sides</p>").when(e % 4 == 0, say('<meta itemprop="name" content="Home %d vs Away %d"/>', "home_id", "away_id")).otherwise(
        say('<span class="homeTeam"><span itemprop="name">Home %d</span></span><span class="x awayTeam"><span itemprop="name">Away %d</span></span>', "home_id", "away_id")
    )
    block = F.concat(
        F.lit('<div class="rcnt tr_1">'), sides, some(e % 3 > 0, say('<time datetime="%s 12:00"></time>', F.date_format("kickoff", "yyyy-MM-dd"))), say('<span class="date_bah">%02d:30</span><span class="shortTag"> L%d </span>', e % 24, e % 5),
        say('<div class="fprc"><span>%d</span><span class="b"><i>%d%%</i></span>', e % 100, e % 50), some(e % 7 > 0, say("<span>%d</span>", e % 120)), F.lit("</div>"),
        say('<div class="forepr"><span>%s</span></div><div class="ex_sc tabonly">%d - %d</div><div class="avg_sc tabonly">%d.%d</div>', F.element_at(F.array(F.lit("1"), F.lit("X"), F.lit("2")), (e % 3 + 1).cast("int")), "home_goals", "away_goals", e % 6, e % 10),
        say('<div class="haodd"><span>%d.50</span><span>-</span><span>%d/2</span></div>', e % 9 + 1, e % 6 + 1), say('<a href="/en/football/matches/m-%d?x=1#top">go</a></div>', "event_id"),
    )
    pages = res.select(F.floor(e / 20).alias("page_id"), e, block.alias("block")).groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "block"))), lambda b: b["block"]), "\n").alias("html"))
    return pages.select("page_id", F.lit("1999-01-01").alias("requested_date"), F.concat(F.lit("<html><body>"), "html", F.lit("</body></html>")).alias("html"))


@query(
    """SELECT event_id // 20 AS page_id, 'Home ' || home_id AS home, 'Away ' || away_id AS away, CASE WHEN event_id % 3 > 0 THEN CAST(kickoff AS DATE) ELSE DATE '1999-01-01' END AS match_date, printf('%02d:30', event_id % 24) AS kickoff_text, 'L' || event_id % 5 AS league,
       CAST(event_id % 100 AS DOUBLE) AS prob_home, CAST(event_id % 50 AS DOUBLE) AS prob_draw, CASE WHEN event_id % 7 > 0 AND event_id % 120 <= 100 THEN CAST(event_id % 120 AS DOUBLE) END AS prob_away, CASE event_id % 3 WHEN 0 THEN '1' WHEN 1 THEN 'X' ELSE '2' END AS pick, home_goals || ' - ' || away_goals AS score,
       CAST((event_id % 6) || '.' || (event_id % 10) AS DOUBLE) AS avg_goals, event_id % 9 + 1.5::DOUBLE AS odds_home, CAST(NULL AS DOUBLE) AS odds_draw, (event_id % 6 + 1) / 2 + 1 AS odds_away, 'https://listing.example/en/football/matches/m-' || event_id AS url FROM results WHERE event_id % 11 > 0""",
    ("results",),
)
def src5_listing_fields(spark, sf):
    return X.listing_rows(_listing_pages(spark, sf), base_url="https://listing.example").drop("pos")


@query(
    """+ p(period) AS (VALUES ('All'), ('FirstHalf')), r AS (SELECT event_id, period, home_goals, away_goals FROM results, p WHERE event_id % 13 > 0)
       SELECT event_id, period, 'Top stats' AS "group", 'expected_goals' AS key, 'Expected goals (xG)' AS title, home_goals || '.5' AS home, away_goals || '.25' AS away FROM r
       UNION ALL SELECT event_id, period, 'Passes', 'long_balls', 'Long balls', CAST(event_id % 90 AS VARCHAR), (event_id % 80) || ' (50%)' FROM r UNION ALL SELECT event_id, period, 'Deep', 'tackles_won', 'Tackles won', '3', CASE WHEN event_id % 2 = 0 THEN '4' END FROM r WHERE period = 'All'""",
    ("results",),
)
def src12_team_stats(spark, sf):
    """A stat tree for each event: repeated stats, groups at several depths, a key that only the title gives; some details are no JSON."""
    say = F.format_string
    e = F.col("event_id")
    xg = say('{"title":"Expected goals (xG)","key":"expected_goals","stats":["%d.5","%d.25"]}', "home_goals", "away_goals")
    balls = say('{"title":"Long balls","stats":[%d,"%d (50%%)"],"type":"text"}', e % 90, e % 80)
    deep = say('{"title":"Tackles won","key":"tackles won","stats":[3,%s]}', F.when(e % 2 == 0, "4").otherwise("null"))
    groups = lambda more: F.concat(F.lit('{"stats":[{"title":"Top stats","key":"top","stats":['), xg, F.lit(","), xg, F.lit(']},{"title":"Passes","stats":['), balls, F.lit(",{}]}"), more, F.lit("]}"))
    more = F.concat(F.lit(',{"title":"Outer","x":{"title":"Deep","list":[[{"a":'), deep, F.lit("}]]}}"))
    tree = F.concat(F.lit('{"content":{"stats":{"Periods":{"All":'), groups(more), F.lit(',"FirstHalf":'), groups(F.lit("")), F.lit("}}}}"))
    details = T.spread(T.results(spark, sf), "event_id").select("event_id", F.when(e % 13 > 0, tree).when(e % 2 == 0, "no json").alias("detail"))
    return X.team_stats(details)


AUDIT = """+ t AS (SELECT event_id, CASE WHEN event_id % 17 > 0 THEN 'League ' || (event_id % 30) END AS league, 'k' || home_id AS h, 'k' || away_id AS w, kickoff + to_minutes(CAST(event_id % 1440 AS BIGINT)) AS kickoff FROM results),
  o AS (SELECT event_id AS row_id, h, CASE WHEN event_id % 8 = 3 THEN 'other' ELSE w END AS w, CASE event_id % 8 WHEN 0 THEN kickoff WHEN 1 THEN kickoff + INTERVAL 30 SECONDS WHEN 2 THEN kickoff + INTERVAL 2 HOURS WHEN 3 THEN kickoff WHEN 4 THEN kickoff + INTERVAL 1 DAY WHEN 5 THEN NULL ELSE kickoff END AS clock,
    event_id % 8 <> 6 AS ok, CASE WHEN event_id % 3 = 0 THEN 'X1' ELSE 'zz' END AS code FROM t WHERE event_id % 8 < 7 UNION ALL SELECT event_id + 10000000, h, w, kickoff, true, 'zz' FROM t WHERE event_id % 40 = 8),
  u AS (SELECT *, coalesce(league, '(unknown)') AS lg FROM t WHERE kickoff > TIMESTAMP '1997-06-01 00:00:00' AND kickoff <= TIMESTAMP '1997-06-01 00:00:00' + INTERVAL 2400 HOURS),
  p AS (SELECT u.event_id, count(*) FILTER (abs(epoch(clock) - epoch(kickoff)) <= 60 AND ok) AS n_near, min(struct_pack(r := row_id, c := code = 'X1' AND NOT starts_with(league, 'League 1'))) FILTER (abs(epoch(clock) - epoch(kickoff)) <= 60 AND ok) AS near,
    min(struct_pack(d := abs(epoch(clock) - epoch(kickoff)), r := row_id)) FILTER (ok) AS apart, count(*) FILTER (NOT ok) AS n_broken FROM u JOIN o ON o.h = u.h AND o.w = u.w AND clock IS NOT NULL GROUP BY 1),
  s AS (SELECT u.event_id, min(row_id) AS one FROM u JOIN o ON (o.h = u.h) <> (o.w = u.w) AND abs(epoch(clock) - epoch(kickoff)) <= 60 GROUP BY 1), y AS (SELECT DISTINCT u.event_id FROM u JOIN (SELECT DISTINCT clock FROM o) ON abs(epoch(clock) - epoch(kickoff)) <= 60),
  c AS (SELECT u.event_id, lg AS league, CASE WHEN u.event_id % 9 = 0 THEN 'VERIFIED_PUBLISHED' WHEN n_near > 1 THEN 'MULTIPLE_SOURCE_PAIRS_AT_KICKOFF' WHEN n_near = 1 AND coalesce(near.c, false) THEN 'KNOWN_LEAGUE_CONFLICT' WHEN n_near = 1 THEN 'PAIR_AND_TIME_UNPUBLISHED' WHEN apart IS NOT NULL THEN 'VERIFIED_PAIR_DIFFERENT_KICKOFF'
      WHEN n_broken > 0 THEN 'PAIR_WITH_INVALID_SOURCE_MODEL_OR_CLOCK' WHEN one IS NOT NULL THEN 'ONE_VERIFIED_TEAM_AT_SAME_KICKOFF' WHEN y.event_id IS NOT NULL THEN 'OTHER_SOURCE_MATCHES_AT_SAME_KICKOFF' ELSE 'NO_SOURCE_OBSERVATION_AT_KICKOFF' END AS reason,
    CASE WHEN u.event_id % 9 = 0 THEN NULL WHEN n_near >= 1 THEN near.r WHEN apart IS NOT NULL THEN apart.r WHEN n_broken > 0 THEN NULL ELSE one END AS row_id FROM u LEFT JOIN p ON p.event_id = u.event_id LEFT JOIN s ON s.event_id = u.event_id LEFT JOIN y ON y.event_id = u.event_id)"""


def _classified(spark, sf):
    e = F.col("event_id")
    t = T.results(spark, sf).select("event_id", F.when(e % 17 > 0, F.concat(F.lit("League "), e % 30)).alias("league"), F.concat(F.lit("k"), "home_id").alias("home_key"), F.concat(F.lit("k"), "away_id").alias("away_key"), (F.col("kickoff") + F.make_interval(mins=(e % 1440).cast("int"))).alias("kickoff"))
    k, later = e % 8, lambda text: F.col("kickoff") + F.expr(f"INTERVAL {text}")
    clock = F.when(k == 1, later("30 SECONDS")).when(k == 2, later("2 HOURS")).when(k == 4, later("1 DAY")).when(k == 5, F.lit(None)).otherwise(F.col("kickoff"))
    o = t.where("event_id % 8 < 7").select(e.alias("row_id"), "home_key", F.when(k == 3, "other").otherwise(F.col("away_key")).alias("away_key"), clock.alias("clock"), (k != 6).alias("fields_ok"), F.when(e % 3 == 0, "X1").otherwise("zz").alias("league_code"))
    o = o.unionByName(t.where("event_id % 40 = 8").select((e + 10_000_000).alias("row_id"), "home_key", "away_key", F.col("kickoff").alias("clock"), F.lit(True).alias("fields_ok"), F.lit("zz").alias("league_code")))
    return A.classify_targets(t, o, t.where("event_id % 9 = 0"), F.expr("TIMESTAMP '1997-06-01 00:00:00'"), 2400, known={"X1": ("league 1",)})


@query(AUDIT + " SELECT event_id, league, reason, row_id FROM c", ("results",))
def a22_target_funnel(spark, sf):
    """Sources with rows at other times, of one side, with bad fields, without a clock, twice, or with another league."""
    return _classified(spark, sf).select("event_id", "league", "reason", "row_id")


@query(
    AUDIT + """, g AS (SELECT league, reason, count(*) AS n, grouping(league) AS gl, grouping(reason) AS gr FROM c GROUP BY GROUPING SETS ((league, reason), (league), (reason), ())), total AS (SELECT n AS total FROM g WHERE gl = 1 AND gr = 1), top AS (SELECT league AS l, n AS leagues_n, row_number() OVER (ORDER BY n DESC, league) AS k FROM g WHERE gl = 0 AND gr = 1),
      m AS (SELECT reason AS r, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS ids FROM (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY event_id) AS i FROM c WHERE reason <> 'VERIFIED_PUBLISHED') WHERE i <= 4 GROUP BY 1)
      SELECT CASE WHEN gl = 1 AND gr = 1 THEN 'TOTAL' WHEN gl = 1 THEN 'REASON' WHEN gr = 1 THEN 'LEAGUE' ELSE 'LEAGUE_REASON' END AS level, league, reason, n, round(n / CASE WHEN gl = 0 AND gr = 0 THEN leagues_n ELSE total END, 6) AS share, CASE WHEN gl = 1 AND gr = 0 THEN coalesce(ids, '') ELSE '' END AS samples
      FROM g CROSS JOIN total LEFT JOIN top ON l = league LEFT JOIN m ON r = reason WHERE k IS NULL OR k <= 25""",
    ("results",),
)
def a22_audit_report(spark, sf):
    return A.audit_report(_classified(spark, sf)).select("level", "league", "reason", "n", r6("share").alias("share"), F.array_join(F.col("samples").cast("array<string>"), ",").alias("samples"))
