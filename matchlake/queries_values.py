"""Registered queries over names, texts, clocks, payloads and feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchlake import testdata as T
from matchlake.functions import exprs as E
from matchlake.operators import links as L
from matchlake.queries import query, r6
from matchlake.sources import feeds as X

KEY = "lower(regexp_replace({0}, '[^\\p{{L}}\\p{{N}}]', '', 'g'))"
#: fold_name as SQL, for plain ASCII.
FOLD = "trim(regexp_replace(replace(lower({0}), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"
WORDS = "list_filter(list_distinct(string_split({0}, ' ')), lambda w: w <> '')"


def _pairs(spark, sf):
    """Two names for each part: the second is the first, a shorter form of it, or another text."""
    return T.table(spark, sf, "part").selectExpr("p_partkey AS id", "lower(p_name) AS a", "CASE p_partkey % 3 WHEN 0 THEN lower(p_name) WHEN 1 THEN concat(substring_index(lower(p_name), ' ', 2), ' fc') ELSE lower(p_type) END AS b")


PAIRS = "pairs AS (SELECT p_partkey AS id, lower(p_name) AS a, CASE p_partkey % 3 WHEN 0 THEN lower(p_name) WHEN 1 THEN array_to_string(string_split(lower(p_name), ' ')[1:2], ' ') || ' fc' ELSE lower(p_type) END AS b FROM part)"


@query(f"""+ {PAIRS}, w AS (SELECT id, list_filter({WORDS.format('a')}, lambda v: v NOT IN ('fc', 'cf', 'club', 'de', 'the')) AS x, list_filter({WORDS.format('b')}, lambda v: v NOT IN ('fc', 'cf', 'club', 'de', 'the')) AS y FROM pairs),
       n AS (SELECT id, len(list_intersect(x, y)) AS both_, len(list_distinct(list_concat(x, y))) AS all_, least(len(x), len(y)) AS low FROM w)
       SELECT id, round(CASE WHEN all_ > 0 THEN CAST(0.82 AS DOUBLE) * both_ / all_ + CASE WHEN both_ = low AND both_ > 0 THEN CAST(0.18 AS DOUBLE) ELSE 0 END ELSE 0 END, 6) AS score FROM n""")
def f8_core_similarity(spark, sf):
    return _pairs(spark, sf).select("id", r6(E.core_sim(F.col("a"), F.col("b"))).alias("score"))


@query(f"""+ {PAIRS}, u AS (SELECT id, 'http://x/' || replace(b, ' ', '-') || '/' || id AS url, a FROM pairs), w AS (SELECT id, {WORDS.format('a')} AS h, list_filter(regexp_split_to_array(lower(url), '[^a-z0-9]+'), lambda v: TRUE) AS s FROM u)
       SELECT id, round(len(list_intersect(h, s)) / len(h), 6) AS hs, round((len(list_intersect(h, s)) / len(h) + list_contains(s, 'fc')::INT) / 2, 6) AS mean FROM w""")
def f9_slug_similarity(spark, sf):
    url = F.concat(F.lit("http://x/"), F.replace("b", F.lit(" "), F.lit("-")), F.lit("/"), "id")
    s = E.slug_sim(F.col("a"), F.lit("fc"), url)
    return _pairs(spark, sf).select("id", r6(s["hs"]).alias("hs"), r6(s["mean"]).alias("mean"))


PROFILE = "list_filter(string_split(regexp_replace({0}, '^st ', 'saint '), ' '), lambda v: v NOT IN {1})"


@query(f"""+ f AS (SELECT p_partkey AS id, {FOLD.format("CASE p_partkey % 4 WHEN 0 THEN 'FC ' || p_name WHEN 1 THEN 'St ' || p_name || ' U21' WHEN 2 THEN 'FC & CF' ELSE p_name || ' W' END")} AS n FROM part),
       k AS (SELECT id, n, list_filter(string_split(n, ' '), lambda v: v NOT IN ('fc', 'cf', 'afc', 'sc', 'ac')) AS feed, {PROFILE.format('n', "('fc', 'cf', 'afc', 'sc', 'ac', 'u19', 'u20', 'u21', 'u23')")} AS live, {PROFILE.format("regexp_replace(n, ' w$', ' women')", "('fc', 'cf', 'afc')")} AS strict FROM f)
       SELECT id, array_to_string(feed, ' ') AS feed, array_to_string(live, ' ') AS live, array_to_string(strict, ' ') AS strict, replace(n, ' ', '') AS exact, n AS folded, replace(n, ' ', '_') AS slug FROM k""")
def f3_f5_f29_name_forms(spark, sf):
    p = T.table(spark, sf, "part")
    name = F.expr("CASE p_partkey % 4 WHEN 0 THEN concat('FC ', p_name) WHEN 1 THEN concat('St ', p_name, ' U21') WHEN 2 THEN 'FC & CF' ELSE concat(p_name, ' W') END")
    return p.select(F.col("p_partkey").alias("id"), *[E.normalize_name(name, k).alias(k) for k in ("feed", "live", "strict")], E.exact_name(name).alias("exact"), E.fold_name(name).alias("folded"), E.stat_slug(name).alias("slug"))


@query("""SELECT p_partkey AS id, upper(replace(replace(p_brand, '#', ''), ' ', '')) || (p_partkey % 10) AS local FROM part""")
def f4_cjk_forms(spark, sf):
    """Full-width letters and digits, separators and brackets, as plain text."""
    p = T.table(spark, sf, "part")
    wide = F.translate(F.upper(F.replace("p_brand", F.lit("#"), F.lit(""))), "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺ０１２３４５６７８９")
    return p.select(F.col("p_partkey").alias("id"), E.normalize_cjk(F.concat(F.lit("【"), wide, F.lit("】・（"), (F.col("p_partkey") % 10).cast("string"), F.lit("） "))).alias("local"))


@query("""+ x AS (SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN (p_partkey % 9 + 1) || '/' || (p_partkey % 4) WHEN 1 THEN (p_partkey % 130) || '.5%' WHEN 2 THEN '1.' || (p_partkey % 1000) WHEN 3 THEN 'even' ELSE CAST(p_partkey % 1200 AS VARCHAR) END AS t FROM part),
       y AS (SELECT id, t, try_cast(nullif(regexp_extract(t, '^\\s*([0-9]{1,3}(\\.[0-9]+)?)\\s*%?\\s*$', 1), '') AS DOUBLE) AS p, CASE WHEN regexp_matches(t, '^[0-9]+/[0-9]+$') THEN CASE WHEN CAST(split_part(t, '/', 2) AS DOUBLE) > 0 THEN CAST(split_part(t, '/', 1) AS DOUBLE) / CAST(split_part(t, '/', 2) AS DOUBLE) + 1 END
         ELSE try_cast(nullif(regexp_extract(t, '^\\s*([0-9]+(\\.[0-9]+)?)\\s*$', 1), '') AS DOUBLE) END AS o, try_cast(nullif(regexp_extract(t, '([0-9]+(\\.[0-9]+)?)', 1), '') AS DOUBLE) AS n FROM x)
       SELECT id, CASE WHEN p BETWEEN 0 AND 100 THEN p END AS percent, CASE WHEN o BETWEEN 1 AND 1000 THEN round(o, 3) END AS odds, n AS number FROM y""")
def f10_f29_numbers_in_text(spark, sf):
    t = F.expr("CASE p_partkey % 5 WHEN 0 THEN concat(p_partkey % 9 + 1, '/', p_partkey % 4) WHEN 1 THEN concat(p_partkey % 130, '.5%') WHEN 2 THEN concat('1.', p_partkey % 1000) WHEN 3 THEN 'even' ELSE CAST(p_partkey % 1200 AS STRING) END")
    return T.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), E.parse_pct(t).alias("percent"), E.parse_odds(t).alias("odds"), E.nonneg(t).alias("number"))


@query("""+ x AS (SELECT event_id, home_goals AS h, away_goals AS a, CASE event_id % 4 WHEN 0 THEN NULL ELSE 1 END AS ok FROM results) SELECT event_id, CASE WHEN ok IS NULL THEN NULL ELSE CAST(h AS INTEGER) END AS h, CASE WHEN ok IS NULL THEN '' ELSE h || ' - ' || a END AS score FROM x""", ("results",))
def f11_scores(spark, sf):
    t = F.expr("CASE event_id % 4 WHEN 0 THEN concat(home_goals, ' goals') WHEN 1 THEN concat(home_goals, '-', away_goals) WHEN 2 THEN concat(' ', home_goals, ' : ', away_goals) ELSE concat(home_goals, 'x', away_goals, ' ') END")
    return T.results(spark, sf).select("event_id", E.parse_score(t)["h"].alias("h"), E.fmt_score(t).alias("score"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL WHEN 0 THEN kickoff + INTERVAL 90 MINUTE ELSE kickoff + INTERVAL 90 MINUTE - INTERVAL 8 HOUR END AS at, CAST(kickoff + INTERVAL 90 MINUTE - INTERVAL 8 HOUR AS DATE) AS source_date FROM results""", ("results",))
def f12_f13_clocks(spark, sf):
    """Times with an offset as they are, naive ones as local; and the date on which sources list a local kickoff."""
    k = F.col("kickoff") + F.expr("INTERVAL 90 MINUTES")
    form = lambda p: F.date_format(k, p)
    t = F.when(F.col("event_id") % 4 == 0, F.concat(form("yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))).when(F.col("event_id") % 4 == 1, form("yyyy-MM-dd HH:mm")).when(F.col("event_id") % 4 == 2, form("yyyy-MM-dd'T'HH:mm:ss")).otherwise("soon")
    return T.results(spark, sf).select("event_id", E.parse_ts(t).alias("at"), E.source_date(k).alias("source_date"))


@query("""SELECT event_id, CASE event_id % 3 WHEN 2 THEN NULL ELSE kickoff + INTERVAL 90 MINUTE END AS at, lpad(CAST((year(kickoff) - (month(kickoff) < 7)::INT) % 100 AS VARCHAR), 2, '0') || lpad(CAST((year(kickoff) - (month(kickoff) < 7)::INT + 1) % 100 AS VARCHAR), 2, '0') AS season FROM results""", ("results",))
def f14_f34_display_clock_season(spark, sf):
    """Displayed clocks are accepted within a day of the page's date; the newest season's code."""
    k = F.col("kickoff") + F.expr("INTERVAL 90 MINUTES")
    text = F.when(F.col("event_id") % 3 == 0, F.date_format(k, "dd/MM/yyyy HH:mm")).when(F.col("event_id") % 3 == 1, F.date_format(k, "HH:mm")).otherwise(F.date_format(k + F.expr("INTERVAL 3 DAYS"), "dd.MM.yyyy HH:mm"))
    return T.results(spark, sf).select("event_id", E.display_clock(text, F.col("kickoff")).alias("at"), E.season_codes(F.col("kickoff"))[0].alias("season"))


@query("""SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'HT' WHEN 1 THEN '45+2' WHEN 2 THEN CAST(event_id % 50 + 1 AS VARCHAR) WHEN 3 THEN CAST(event_id % 50 + 46 AS VARCHAR) ELSE CAST(least(event_id % 50 + 106, 130) AS VARCHAR) END AS minute FROM results""", ("results",))
def f28_match_minute(spark, sf):
    status = F.expr("CASE event_id % 5 WHEN 0 THEN 'ht' WHEN 1 THEN '45+2' WHEN 2 THEN '1st half' WHEN 3 THEN '2nd half' ELSE 'Extra time 2' END")
    return T.results(spark, sf).select("event_id", E.match_minute(status, F.col("kickoff"), F.col("kickoff") + F.make_interval(mins=(F.col("event_id") % 50).cast("int"))).alias("minute"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'a,b' ELSE 'a,b,c' END AS evidence, CASE WHEN event_id % 2 = 0 THEN 'new' ELSE tournament END AS league, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'x' END IS DISTINCT FROM CASE WHEN event_id % 2 = 0 THEN NULL ELSE 'x' END AS differs,
       concat_ws(',', CASE WHEN event_id % 2 = 0 THEN 'EVEN' END, CASE WHEN event_id % 3 = 0 THEN 'THIRD' END) AS codes FROM results""", ("results",))
def f30_f31_f32_f38_documents(spark, sf):
    e = F.col("event_id")
    merged = E.doc_merge(F.create_map(F.lit("league"), "tournament", F.lit("k"), F.lit("v")), F.when(e % 2 == 0, F.create_map(F.lit("league"), F.lit("new"))).otherwise(F.create_map().cast("map<string, string>")))
    union = E.evidence_union(F.array(F.lit("a"), F.lit("b")), F.when(e % 3 > 0, F.array(F.lit("b"), F.lit("c"))))
    differs = E.differs(F.when(e % 3 > 0, F.lit("x")), F.when(e % 2 > 0, F.lit("x")))
    return T.results(spark, sf).select("event_id", F.array_join(union, ",").alias("evidence"), merged["league"].alias("league"), differs.alias("differs"), F.array_join(E.codes({"EVEN": e % 2 == 0, "THIRD": e % 3 == 0}), ",").alias("codes"))


@query("""+ x AS (SELECT event_id, ['', 'W', 'WD', 'WDL', 'LLL', 'DDDD'][event_id % 6 + 1] AS t FROM results) SELECT event_id, CASE WHEN t <> '' THEN round((3.0 * len(replace(replace(t, 'D', ''), 'L', '')) + len(replace(replace(t, 'W', ''), 'L', ''))) / len(t), 6) END AS points,
       CASE WHEN t = '' THEN NULL WHEN (3.0 * len(replace(replace(t, 'D', ''), 'L', '')) + len(replace(replace(t, 'W', ''), 'L', ''))) / len(t) >= 2 THEN 'UP' WHEN (3.0 * len(replace(replace(t, 'D', ''), 'L', '')) + len(replace(replace(t, 'W', ''), 'L', ''))) / len(t) <= 1 THEN 'DOWN' ELSE 'FLAT' END AS direction,
       CASE WHEN event_id % 120 BETWEEN 20 AND 80 THEN CAST(event_id % 120 AS DOUBLE) END AS possession FROM x""", ("results",))
def f36_x39_form_direction(spark, sf):
    x = T.results(spark, sf).withColumn("p", E.form_points(F.expr("array('', 'W', 'WD', 'WDL', 'LLL', 'DDDD')[CAST(event_id % 6 AS INT)]")))
    return x.select("event_id", r6("p").alias("points"), E.source_direction(F.col("p")).alias("direction"), E.valid_possession((F.col("event_id") % 120).cast("double")).alias("possession"))


@query("""SELECT event_id, CASE WHEN tournament = '1-URGENT' THEN event_id % 2 = 0 WHEN tournament = '2-HIGH' THEN event_id % 2 = 1 END AS ok FROM results""", ("results",))
def f37_competition_ok(spark, sf):
    known = {"1-URGENT": ("premier", "first"), "2-HIGH": ("second",)}
    return T.results(spark, sf).select("event_id", E.competition_ok(F.col("tournament"), F.when(F.col("event_id") % 2 == 0, "First Division").otherwise("Second Division"), known).alias("ok"))


@query("""+ q AS (SELECT p.event_id, p.home / 100 AS h, p.draw / 100 AS d, p.away / 100 AS a, CASE WHEN home_goals > away_goals THEN 'H' WHEN home_goals < away_goals THEN 'A' ELSE 'D' END AS o, k.home AS odds FROM predictions p JOIN results r ON r.event_id = p.event_id JOIN odds k ON k.event_id = p.event_id),
       x AS (SELECT *, (o = 'H')::INT AS x, (o = 'D')::INT AS y, (o = 'A')::INT AS z FROM q)
       SELECT event_id, round(odds * h - 1, 6) AS edge, round(((h - x) * (h - x) + (h + d - x - y) * (h + d - x - y)) / 2, 6) AS rps, round(((h - x) * (h - x) + (d - y) * (d - y) + (a - z) * (a - z)) / 3, 6) AS brier, round(-ln(CASE o WHEN 'H' THEN h WHEN 'D' THEN d ELSE a END), 6) AS logloss FROM x""", ("predictions", "odds", "results"))
def f19_f22_edge_and_scores(spark, sf):
    from matchlake.plans.models import outcome

    p = T.predictions(spark, sf).select("event_id", *[(F.col(c) / 100).alias(k) for c, k in (("home", "h"), ("draw", "d"), ("away", "a"))])
    x = p.join(T.odds(spark, sf).select("event_id", F.col("home").alias("odds")), "event_id").join(T.results(spark, sf), "event_id").withColumn("o", outcome(F.col("home_goals"), F.col("away_goals")))
    v = [F.col(c) for c in ("h", "d", "a", "o")]
    return x.select("event_id", r6(E.edge(F.col("odds"), F.col("h"))).alias("edge"), r6(E.rps(*v)).alias("rps"), r6(E.brier(*v)).alias("brier"), r6(E.logloss(*v)).alias("logloss"))


# Feeds and payloads

@query("""SELECT 'T' || home_id AS home, 'T' || away_id AS away, CAST(home_goals AS INTEGER) AS home_goals, CAST(away_goals AS INTEGER) AS away_goals, strftime(kickoff, '%d/%m/%Y') AS date FROM results WHERE event_id % 50 <> 0""", ("results",))
def src3_standardize_results(spark, sf):
    r = T.results(spark, sf)
    cols = lambda h, a, x, y: [f"concat('T', home_id) AS {h}", f"concat('T', away_id) AS {a}", f"CASE WHEN event_id % 50 = 0 THEN 'x' ELSE CAST(home_goals AS STRING) END AS {x}", f"CAST(away_goals AS STRING) AS {y}", "date_format(kickoff, 'dd/MM/yyyy') AS Date"]
    return X.standardize_results(r.where("event_id % 2 = 0").selectExpr(*cols("HomeTeam", "AwayTeam", "FTHG", "FTAG"))).unionByName(X.standardize_results(r.where("event_id % 2 = 1").selectExpr(*cols("Home", "Away", "HG", "AG"))))


@query("""SELECT CAST(kickoff AS DATE) AS date, 'T' || home_id AS home, 'T' || away_id AS away, CAST(home_goals AS INTEGER) AS home_goals, CAST(away_goals AS INTEGER) AS away_goals FROM results WHERE event_id % 7 <> 0""", ("results",))
def src2_results_from_json(spark, sf):
    """Arrays of records and maps of records, some without a score; footnotes and states go from names."""
    x = T.results(spark, sf)
    bad = F.col("event_id") % 7 == 0
    array = F.to_json(F.array(F.struct(F.date_format("kickoff", "dd.MM.yyyy HH:mm").alias("match_date"), F.concat(F.lit("T"), "home_id", F.lit("\n2")).alias("home"), F.concat(F.lit("T"), "away_id").alias("away"), F.when(bad, F.lit(-1)).otherwise(F.col("home_goals")).cast("string").alias("goals_home"), F.col("away_goals").cast("string").alias("goals_away"))))
    result = F.when(bad, F.lit("postponed")).otherwise(F.concat("home_goals", F.lit(" x "), "away_goals"))
    named = F.to_json(F.create_map(F.concat(F.lit("m"), "event_id"), F.struct(F.date_format("kickoff", "dd/MM/yyyy").alias("Date"), F.concat(F.lit("T"), "home_id", F.lit(" / SC")).alias("Home"), F.concat(F.lit("T"), "away_id").alias("Away"), result.alias("Result"))))
    return X.results_from_json(x.select(F.when(F.col("event_id") % 2 == 0, array).otherwise(named).alias("payload")))


@query("""SELECT event_id, side FROM results, (VALUES ('H'), ('A')) v(side) WHERE event_id % 3 <> 0""", ("results",))
def src4_recordset(spark, sf):
    x = T.results(spark, sf)
    rows = F.to_json(F.array(*[F.struct("event_id", F.lit(s).alias("side")) for s in "HA"]))
    return X.from_recordset(x.select(F.when(F.col("event_id") % 3 == 0, F.to_json(F.struct("event_id"))).otherwise(rows).alias("payload")), "payload", "event_id: bigint, side: string")


@query("""SELECT doc_id, doc_id AS id, 'n' || (length(coalesce(text, '')) % 7) AS name FROM documents UNION ALL SELECT doc_id, doc_id + 1, 'n' || (length(coalesce(text, '')) % 3) FROM documents WHERE length(coalesce(text, '')) % 7 <> length(coalesce(text, '')) % 3""")
def src9_embedded_json(spark, sf):
    n = F.length(F.coalesce("text", F.lit("")))
    row = lambda i, k: F.format_string(f'{{"id":%d,"name":"n%d"}}', F.col("doc_id") + i, n % k)
    text = F.concat(F.lit('<script>var z=[{"id":1}]; var rows=['), row(0, 7), F.lit(","), row(1, 3), F.lit("];</script>"))
    return X.embedded_json(T.table(spark, sf, "documents").select("doc_id", text.alias("text")), "text", "id: bigint, name: string", ["id", "name"], unique="name", least=2)


@query("""SELECT CAST(event_id AS VARCHAR) AS source_id, tournament AS league, 'T' || home_id AS home, CAST(home_goals + (event_id % 5 = 0)::INT AS INTEGER) AS home_goals, event_id % 2 = 0 AND event_id % 4 <> 0 AND event_id % 7 <> 0 AS live, kickoff FROM results""", ("results",))
def src10_flatten_board(spark, sf):
    """Two payloads of some matches: the later one counts."""
    x = T.results(spark, sf)
    e = F.col("event_id")
    side = lambda i, g: F.struct(F.col(i).cast("string").alias("id"), F.concat(F.lit("T"), i).alias("name"), g.cast("string").alias("score"))
    status = F.struct(F.date_format("kickoff", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("utcTime"), (e % 2 == 0).alias("started"), (e % 4 == 0).alias("finished"), (e % 7 == 0).alias("cancelled"))
    board = lambda more: F.to_json(F.struct(F.array(F.struct(F.col("tournament").alias("name"), F.array(F.struct(e.cast("string").alias("id"), side("home_id", F.col("home_goals") + more).alias("home"), side("away_id", F.col("away_goals")).alias("away"), status.alias("status"))).alias("matches"))).alias("leagues")))
    first = x.select(F.col("kickoff").alias("captured_at"), board(0).alias("payload"))
    second = x.where("event_id % 5 = 0").select((F.col("kickoff") + F.expr("INTERVAL 1 HOUR")).alias("captured_at"), board(1).alias("payload"))
    return X.flatten_board(first.unionByName(second)).select("source_id", "league", "home", "home_goals", "live", "kickoff")


@query("""SELECT event_id AS source_id, CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 2 = 0 THEN 1 ELSE 2 END AS board FROM results""", ("results",))
def src11_combine_boards(spark, sf):
    x = T.results(spark, sf).withColumnRenamed("event_id", "source_id")
    return X.combine_boards([x.where(c).select("source_id", F.lit(n).alias("board")) for n, c in enumerate(("source_id % 3 = 0", "source_id % 2 = 0", "TRUE"))])


@query("""SELECT event_id, CAST(player AS VARCHAR) AS player, 'goals' AS name, CAST(min(goals + 1) AS DOUBLE) AS value FROM players GROUP BY ALL UNION ALL SELECT event_id, CAST(player AS VARCHAR), 'minutes', CAST(min(minutes) AS DOUBLE) FROM players GROUP BY ALL""", ("players",))
def src13_player_stats(spark, sf):
    p = T.players(spark, sf)
    stats = F.create_map(F.lit("goals"), F.col("goals").cast("double"), F.lit("goals_total"), (F.col("goals") + 1).cast("double"), F.lit("minutes_played"), F.col("minutes").cast("double"), F.lit("unknown"), F.lit(1.0))
    payload = F.to_json(F.array(F.struct(F.col("player").cast("string").alias("id"), stats.alias("stats"))))
    keys = spark.createDataFrame([("goals", "goals", 1), ("goals_total", "goals", 0), ("minutes_played", "minutes", 0)], "key string, name string, rank int")
    return X.player_stats(p.select("event_id", payload.alias("payload")), keys)


@query("""SELECT event_id, 'H' AS side, 'p' || home_id AS id, TRUE AS starter FROM results UNION ALL SELECT event_id, 'H', 'q' || home_id, FALSE FROM results WHERE event_id % 2 = 0 UNION ALL SELECT event_id, 'A', 'p' || away_id, event_id % 3 = 0 FROM results""", ("results",))
def src14_lineups(spark, sf):
    """Even events have lists of starters and substitutes, odd ones one list of players with a flag."""
    e = F.col("event_id")
    man = lambda k, c, flag=None: F.struct(F.concat(F.lit(k), c).alias("id"), F.concat(F.lit("n"), c).alias("name"), *([flag.alias("isStarter")] if flag is not None else []))
    away = F.struct(F.array(man("p", "away_id", e % 3 == 0)).alias("players"))
    new = F.to_json(F.struct(F.struct(F.array(man("p", "home_id")).alias("starters"), F.array(man("q", "home_id")).alias("subs")).alias("home"), away.alias("away")))
    old = F.to_json(F.struct(F.struct(F.array(man("p", "home_id", F.lit(True))).alias("players")).alias("home"), away.alias("away")))
    return X.lineups(T.results(spark, sf).select("event_id", F.when(e % 2 == 0, new).otherwise(old).alias("payload"))).select("event_id", "side", "id", "starter")


@query("""SELECT kickoff, event_id, CASE WHEN event_id % 2 = 0 THEN 'override' ELSE tournament END AS league, home_id FROM results""", ("results",))
def snk3_json_feed(spark, sf):
    from matchlake.plans.context import override_fields

    x = T.results(spark, sf).select("event_id", "kickoff", F.col("tournament").alias("league"), "home_id")
    over = x.where("event_id % 2 = 0").select("event_id", F.lit(None).cast("timestamp").alias("kickoff"), F.lit("override").alias("league"), F.lit(None).cast("bigint").alias("home_id"))
    doc = F.from_json("doc", "league string, home_id bigint")
    return X.to_json_rows(override_fields(x, over, "event_id"), ["kickoff", "event_id"]).select("kickoff", "event_id", doc["league"].alias("league"), doc["home_id"].alias("home_id"))


@query("""SELECT CAST(event_id AS VARCHAR) AS source_id, 'T' || home_id AS home, CASE WHEN event_id % 2 = 0 THEN 'T' || away_id ELSE 'A' || away_id END AS away, CAST(home_goals AS VARCHAR) AS home_goals, 'live' AS status FROM results WHERE event_id % 3 = 0""", ("results",))
def x32_backup_board(spark, sf):
    e = F.col("event_id")
    event = F.struct(e.alias("id"), F.struct(F.concat(F.lit("T"), "home_id").alias("name")).alias("homeTeam"), F.struct(F.when(e % 2 == 0, F.concat(F.lit("T"), "away_id")).alias("name"), F.concat(F.lit("A"), "away_id").alias("shortName")).alias("awayTeam"), F.struct(F.col("home_goals").alias("current")).alias("homeScore"), F.struct(F.when(e % 3 == 0, "live").otherwise("notstarted").alias("type")).alias("status"))
    paths = {"source_id": ("$.id",), "home": ("$.homeTeam.name", "$.homeTeam.shortName"), "away": ("$.awayTeam.name", "$.awayTeam.shortName"), "home_goals": ("$.homeScore.current", "$.homeScore.display"), "status": ("$.status.type",)}
    return X.normalize_board(T.results(spark, sf).select(F.col("kickoff").alias("captured_at"), F.to_json(F.struct(F.array(event).alias("events"))).alias("payload")), paths).drop("captured_at")


@query("""+ p AS (SELECT page_id, CASE page_id % 2 WHEN 0 THEN 'one' ELSE 'two' END AS provider, regexp_extract_all(coalesce(html, ''), '(?is)<p\\b[^>]*>(.*?)</p>', 1) AS a, regexp_extract_all(coalesce(html, ''), '(?is)<li\\b[^>]*>(.*?)</li>', 1) AS b FROM pages),
       n AS (SELECT provider, len(list_filter(CASE WHEN provider = 'one' THEN a ELSE b END, lambda x: trim(regexp_replace(regexp_replace(x, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) <> '')) AS n FROM p)
       SELECT provider, count(*) AS attempted, count(*) FILTER (n > 0) AS successful, CAST(coalesce(sum(n), 0) AS BIGINT) AS parsed FROM n GROUP BY 1""")
def x49_provider_stats(spark, sf):
    p = T.table(spark, sf, "pages").select("page_id", F.when(F.col("page_id") % 2 == 0, "one").otherwise("two").alias("provider"), F.lit("2024-01-01").alias("day"), F.coalesce("html", F.lit("")).alias("html"))
    return X.collect_evidence(p, {"one": "p", "two": "li"})[1]


@query("""SELECT event_id, CAST(55 AS DOUBLE) AS home, CAST(CASE WHEN event_id % 2 = 0 THEN 45 END AS DOUBLE) AS away, CAST(0.94 AS DOUBLE) AS floor FROM results""", ("results",))
def j18_j19_pick_pair_with_config(spark, sf):
    e = F.col("event_id")
    item = lambda p, k, h, a: F.struct(F.lit(p).alias("period"), F.lit(k).alias("key"), F.lit(h).alias("home"), a.alias("away"))
    stats = F.array(item("ALL", "shots", 9.0, F.lit(8.0)), item("1ST", "possession", 1.0, F.lit(2.0)), item("ALL", "possession", 55.0, F.when(e % 2 == 0, 45.0)))
    pair = L.pick_pair(stats, "possession", "ALL")
    return L.with_config(T.results(spark, sf).select("event_id", pair["home"].alias("home"), pair["away"].alias("away")), spark.createDataFrame([(0.94,)], "floor double"))


@query(f"""+ {PAIRS} SELECT id, {FOLD.format('a')} AS a, replace({FOLD.format('b')}, ' ', '') AS b FROM pairs""")
def f2_f5_fold_exact(spark, sf):
    from matchlake.functions import names as N

    return _pairs(spark, sf).select("id", N.fold_exact("a").alias("a"), N.exact_forms(F.col("b")).alias("b"))


@query()
def f6_sequence_likeness(spark, sf):
    """The likeness of each part's two names by sequence ratio, each distinct pair once; held against the standard library in the tests."""
    from matchlake.functions import names as N

    return N.with_likeness(_pairs(spark, sf), "a", "b", "likeness").select("id", r6("likeness").alias("likeness"))
