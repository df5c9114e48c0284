"""Registered queries of links by names, over clubs with misspelt names, each with SQL that compares all pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake import testdata as T
from matchlake.functions import exprs as E
from matchlake.operators import likeness as K
from matchlake.plans import boards as B
from matchlake.plans import context as C
from matchlake.queries import name_sim_sql, query, r6
from matchlake.sources import feeds as X

LETTERS = ("0123456789", "ghijklmnop")


def clubs(spark, sf) -> DataFrame:
    """club, name, spelling: a made-up name for each customer, and how another source spells it: equal, a letter less, a word more, or two letters changed."""
    h = F.md5(F.col("c_custkey").cast("string").cast("binary"))
    word = lambda at, n: F.translate(F.substring(h, at, n), *LETTERS)
    d = T.table(spark, sf, "customer").select(F.col("c_custkey").alias("club"), F.concat(word(1, 7), F.lit(" "), word(8, 6)).alias("name"))
    part = lambda at, n=99: F.substring("name", at, n)
    k = F.col("club") % 4
    changed = F.concat(part(1, 4), F.lit("x"), part(6, 3), F.lit("z"), part(10))
    return d.withColumn("spelling", F.when(k == 0, F.col("name")).when(k == 1, F.concat(part(1, 2), part(4))).when(k == 2, F.concat("name", F.lit(" united"))).otherwise(changed))


def meetings(spark, sf) -> DataFrame:
    """event_id, h, a, kickoff: the clubs of each order's event."""
    return T.table(spark, sf, "orders").selectExpr("o_orderkey AS event_id", "o_custkey AS h", "o_orderkey % 100 + 1 AS a", "o_orderdate + make_interval(0, 0, 0, 0, 0, CAST(o_orderkey % 1440 AS INT)) AS kickoff").where("h <> a")


def named(games: DataFrame, c: DataFrame, column: str) -> DataFrame:
    side = lambda k, s: c.select(F.col("club").alias(k), F.col(column).alias(s))
    return games.join(side("h", "home"), "h").join(side("a", "away"), "a")


WORDS = "translate(substr(md5(CAST(c_custkey AS VARCHAR)), {0}, {1}), '0123456789', 'ghijklmnop')"
CLUBS = f"""+ names AS (SELECT c_custkey AS club, {WORDS.format(1, 7)} || ' ' || {WORDS.format(8, 6)} AS name FROM customer),
   clubs AS (SELECT club, name, CASE club % 4 WHEN 0 THEN name WHEN 1 THEN substr(name, 1, 2) || substr(name, 4) WHEN 2 THEN name || ' united' ELSE substr(name, 1, 4) || 'x' || substr(name, 6, 3) || 'z' || substr(name, 10) END AS spelling FROM names),
   meetings AS (SELECT o_orderkey AS event_id, o_custkey AS h, o_orderkey % 100 + 1 AS a, o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)) AS kickoff FROM orders WHERE o_custkey <> o_orderkey % 100 + 1),
   likeness AS (SELECT x.club AS own, y.club AS its, {name_sim_sql("x.spelling", "y.name")} AS s FROM clubs x, clubs y)"""


@query(
    CLUBS + """, ranked AS (SELECT own, its, s, row_number() OVER w AS r, lead(s) OVER w AS runner_up FROM (SELECT l.*, name FROM likeness l JOIN clubs c ON c.club = its WHERE s >= CAST(0.73 AS DOUBLE) - 1e-9) WINDOW w AS (PARTITION BY own ORDER BY s DESC, name DESC))
      SELECT own AS club, its AS like_club, round(s, 6) AS score, s >= 0.78 AND (s >= 0.94 OR runner_up IS NULL OR s - runner_up >= CAST(0.05 AS DOUBLE)) AS accepted FROM ranked WHERE r = 1""",
)
def j4_link_history(spark, sf):
    """The best club for each spelling, with a lead over the runner-up."""
    c = clubs(spark, sf)
    p = K.PROFILES["history"]
    pairs = K.similar_names(c.select(F.col("spelling").alias("name")), c.select("name"), p.floor - p.margin)
    best = K.best_names(pairs, p).join(c.select(F.col("spelling").alias("left"), "club"), "left").join(c.select(F.col("name").alias("right"), F.col("club").alias("like_club")), "right")
    return best.select("club", "like_club", r6("score").alias("score"), "accepted")


@query(
    CLUBS + """, pairs AS (SELECT DISTINCT h, a FROM meetings), c AS (SELECT p.h, p.a, t.h AS th, t.a AS ta, (x.s + y.s) / 2 AS s FROM pairs p JOIN likeness x ON x.own = p.h AND x.s >= 0.70 JOIN likeness y ON y.own = p.a AND y.s >= 0.70 JOIN pairs t ON t.h = x.its AND t.a = y.its),
      o AS (SELECT *, row_number() OVER (PARTITION BY h, a ORDER BY s DESC, th, ta) AS r, row_number() OVER (PARTITION BY th, ta ORDER BY s DESC, h, a) AS q FROM c WHERE s >= 0.80)
      SELECT 100000 * th + ta AS event_id, 100000 * h + a AS fixture, round(s, 6) AS score, CAST(1 + h % 7 AS DOUBLE) / 2 AS h, CAST(3 AS DOUBLE) AS d, CAST(2 + a % 5 AS DOUBLE) AS a FROM o WHERE r = 1 AND q = 1 AND h % 10 > 0""",
)
def j4_link_book(spark, sf):
    """Prices of a bookmaker's misspelt pairs; where the home club is a multiple of 10 the draw has no price."""
    c, games = clubs(spark, sf), meetings(spark, sf).select("h", "a").distinct()
    key = (F.col("h") * 100_000 + F.col("a")).cast("string")
    rows = named(games, c, "spelling")
    row = lambda s, p: F.struct(s.alias("selection"), p.cast("string").alias("price"))
    three = F.array(row(F.col("home"), (1 + F.col("h") % 7) / 2), row(F.lit("Draw"), F.when(F.col("h") % 10 > 0, F.lit(3.0))), row(F.col("away"), 2.0 + F.col("a") % 5))
    raw = rows.select(F.lpad(key, 12, "0").alias("fixture_id"), F.lit("40").alias("market_id"), "home", "away", F.inline(three))
    targets = named(games, c, "name").select(F.lpad(key, 12, "0").alias("event_id"), "home", "away")
    quotes, _ = K.book_quotes(raw, targets)
    return quotes.select(F.col("event_id").cast("long").alias("event_id"), F.col("row_id").cast("long").alias("fixture"), r6("score").alias("score"), "h", "d", "a")


def _anchored(minutes: int, decay: int, floor: float, accept: float, sure: float, no_clock: float | None) -> str:
    clockless = f"UNION ALL SELECT r.event_id, t.event_id, NULL, NULL, x.s, y.s FROM rs r JOIN likeness x ON x.own = r.h AND x.s >= {floor} JOIN likeness y ON y.own = r.a AND y.s >= {floor} JOIN meetings t ON t.h = x.its AND t.a = y.its WHERE r.kickoff IS NULL" if no_clock else ""
    return CLUBS + f""", rs AS (SELECT event_id, h, a, CASE WHEN event_id % 50 > 0 THEN kickoff + to_minutes(CAST(event_id % 9 AS BIGINT)) END AS kickoff FROM meetings),
      c(row_id, event_id, gap, rk, hs, aws) AS (SELECT r.event_id, t.event_id, abs(epoch(r.kickoff) - epoch(t.kickoff)), r.kickoff, x.s, y.s FROM rs r JOIN meetings t ON t.kickoff BETWEEN r.kickoff - INTERVAL {minutes} MINUTES AND r.kickoff + INTERVAL {minutes} MINUTES
        JOIN likeness x ON x.own = r.h AND x.its = t.h JOIN likeness y ON y.own = r.a AND y.its = t.a {clockless}),
      n AS (SELECT *, coalesce(greatest(0, 1 - gap / ({decay} * 60)), {no_clock or 'NULL'}) AS near, coalesce(gap <= 600, false) AND greatest(hs, aws) >= 0.85 AND least(hs, aws) >= 0.35 AS anchored FROM c),
      s AS (SELECT *, greatest(CAST(0.42 AS DOUBLE) * hs + CAST(0.42 AS DOUBLE) * aws + CAST(0.16 AS DOUBLE) * near, CASE WHEN anchored THEN CAST(0.55 AS DOUBLE) * greatest(hs, aws) + CAST(0.25 AS DOUBLE) * least(hs, aws) + CAST(0.20 AS DOUBLE) * near ELSE 0 END) AS score FROM n WHERE least(hs, aws) >= {floor} OR anchored),
      o AS (SELECT *, row_number() OVER w AS n, lead(score) OVER w AS runner_up FROM s WINDOW w AS (PARTITION BY row_id ORDER BY round(score, 9) DESC, gap, event_id))
      SELECT r.event_id AS row_id, o.event_id, round(score, 6) AS score, CASE WHEN score IS NULL THEN 'NO_CANDIDATE' WHEN score < {accept} THEN 'BELOW' WHEN score >= {sure} OR coalesce(score - runner_up >= 0.06, true) THEN 'LINKED' ELSE 'AMBIGUOUS' END AS status
      FROM rs r LEFT JOIN o ON o.row_id = r.event_id AND o.n = 1"""


def _link_anchored(spark, sf, profile):
    c, games = clubs(spark, sf), meetings(spark, sf)
    at = F.when(F.col("event_id") % 50 > 0, F.col("kickoff") + F.make_interval(mins=(F.col("event_id") % 9).cast("int")))
    rows = named(games, c, "spelling").select(F.col("event_id").alias("row_id"), "home", "away", at.alias("kickoff"))
    found = K.link_anchored(rows, named(games, c, "name").select("event_id", "home", "away", "kickoff"), K.ANCHORED[profile], runner_up=False)
    return found.select("row_id", "event_id", r6("score").alias("score"), "status")


@query(_anchored(120, 180, 0.58, 0.74, 0.90, 0.75))
def j4_link_live(spark, sf):
    """Misspelt rows some minutes off, some without a clock; every row has a status."""
    return _link_anchored(spark, sf, "live")


@query(_anchored(150, 150, 0.60, 0.78, 0.92, None))
def j4_link_player(spark, sf):
    return _link_anchored(spark, sf, "player")


@query(
    CLUBS + """, pairs AS (SELECT h, a, min(event_id) AS event_id, CAST(min(kickoff) AS DATE) AS day FROM meetings GROUP BY 1, 2), u AS (SELECT event_id, day, split(x.name, ' ') AS hw, split(y.name, ' ') AS aw, 'https://odds.example/' || replace(x.name, ' ', '-') || '-' || split_part(y.name, ' ', CASE WHEN event_id % 3 = 0 THEN 1 ELSE 2 END)
        || CASE WHEN event_id % 5 = 0 THEN '-' || strftime(day + CAST(event_id % 4 AS INTEGER), '%d-%m-%Y') ELSE '' END AS url FROM pairs JOIN clubs x ON x.club = h JOIN clubs y ON y.club = a),
      bag AS (SELECT DISTINCT url, split(regexp_replace(regexp_replace(url, '^https://[^/]*/', ''), '[^a-z0-9]+', ' ', 'g'), ' ') AS ws, regexp_extract(url, '[0-9]{2}-[0-9]{2}-[0-9]{4}') AS dated FROM u),
      hits AS (SELECT DISTINCT t.event_id, b.url FROM (SELECT event_id, unnest(hw) AS w FROM u) t JOIN (SELECT url, unnest(ws) AS w FROM bag) b ON t.w = b.w),
      c AS (SELECT t.event_id, b.url, len(list_intersect(hw, ws)) / len(hw) AS hs, len(list_intersect(aw, ws)) / len(aw) AS s2 FROM hits m JOIN u t ON t.event_id = m.event_id JOIN bag b ON b.url = m.url
        WHERE dated = '' OR contains(b.url, strftime(day - 1, '%d-%m-%Y')) OR contains(b.url, strftime(day, '%d-%m-%Y')) OR contains(b.url, strftime(day + 1, '%d-%m-%Y'))),
      o AS (SELECT *, (hs + s2) / 2 AS score, row_number() OVER w AS n, lead((hs + s2) / 2) OVER w AS runner_up FROM c WHERE least(hs, s2) >= 0.5 AND (hs + s2) / 2 >= 0.70 WINDOW w AS (PARTITION BY event_id ORDER BY (hs + s2) / 2 DESC, least(hs, s2) DESC, url DESC))
      SELECT u.event_id, o.url, round(score, 6) AS score, CASE WHEN score IS NULL THEN 'NO_CANDIDATE' WHEN score >= 0.85 OR coalesce(score - runner_up >= 0.15, true) THEN 'LINKED' ELSE 'AMBIGUOUS' END AS status FROM u LEFT JOIN o ON o.event_id = u.event_id AND n = 1""",
)
def j4_link_slug(spark, sf):
    """Pages named by one word of the away side, some with a date that is up to three days off."""
    games = meetings(spark, sf).groupBy("h", "a").agg(F.min("event_id").alias("event_id"), F.min("kickoff").alias("kickoff"))
    t = named(games, clubs(spark, sf), "name")
    e, dash = F.col("event_id"), F.lit("-")
    day = F.date_format(F.date_add(F.to_date("kickoff"), (e % 4).cast("int")), "dd-MM-yyyy")
    url = F.concat(F.lit("https://odds.example/"), F.replace("home", F.lit(" "), dash), dash, F.split_part("away", F.lit(" "), F.when(e % 3 == 0, 1).otherwise(2)), F.when(e % 5 == 0, F.concat(dash, day)).otherwise(""))
    return K.link_slugs(t.select("event_id", "home", "away", "kickoff"), t.select(url.alias("url"))).select("event_id", "url", r6("score").alias("score"), "status")


@query(
    CLUBS + """, sets AS (SELECT DISTINCT club % 5 AS dataset, CASE WHEN club % 5 = 4 THEN 'CUP' END AS scope, club FROM clubs), f AS (SELECT event_id, h, a, CASE WHEN event_id % 11 = 0 THEN 'CUP' ELSE 'L' END AS comp FROM meetings), sim AS (SELECT l.own, l.its, s, dataset, scope, name FROM likeness l JOIN sets ON club = its JOIN clubs c ON c.club = its WHERE s >= CAST(0.73 AS DOUBLE) - 1e-9),
      r AS (SELECT *, row_number() OVER w AS n, lead(s) OVER w AS nx FROM sim WINDOW w AS (PARTITION BY dataset, own ORDER BY s DESC, name DESC)),
      b AS (SELECT * FROM r WHERE n = 1 AND s >= 0.78 AND (s >= 0.94 OR nx IS NULL OR s - nx >= CAST(0.05 AS DOUBLE)) AND its % 13 > 0 AND (its % 17 > 0 OR own = its + 1) AND (its % 3 > 0 OR its % 17 <= 1 OR own = its)),
      v AS (SELECT club AS own, club AS its FROM clubs WHERE club % 3 = 0 AND club % 17 > 1 UNION ALL SELECT club, club - 1 FROM clubs WHERE club % 17 = 1 AND club - 1 IN (SELECT club FROM clubs)),
      ver AS (SELECT event_id, min(x.dataset) AS dataset FROM f JOIN v p ON p.own = h JOIN v q ON q.own = a AND q.its <> p.its JOIN sets x ON x.club = p.its JOIN sets y ON y.club = q.its AND x.dataset = y.dataset WHERE x.scope IS NOT DISTINCT FROM CASE WHEN comp = 'CUP' THEN 'CUP' END GROUP BY 1),
      c AS (SELECT event_id, x.dataset, (x.s + y.s) / 2 AS score FROM f JOIN b x ON x.own = h JOIN b y ON y.own = a AND y.dataset = x.dataset WHERE x.scope IS NOT DISTINCT FROM CASE WHEN comp = 'CUP' THEN 'CUP' END AND x.its <> y.its AND (x.s + y.s) / 2 >= 0.82),
      d AS (SELECT event_id, min(struct_pack(s := -score, d := dataset)) AS d FROM c GROUP BY 1)
      SELECT f.event_id, coalesce(ver.dataset, d.d.d) AS dataset, CASE WHEN ver.dataset IS NOT NULL THEN 1 ELSE round(-d.d.s, 6) END AS score, CASE WHEN ver.dataset IS NOT NULL THEN 'VERIFIED' WHEN d.d IS NOT NULL THEN 'DISCOVERED' ELSE 'NONE' END AS path
      FROM f LEFT JOIN ver ON ver.event_id = f.event_id LEFT JOIN d ON d.event_id = f.event_id""",
)
def md5_discover_dataset(spark, sf):
    """Datasets hold a fifth of the clubs each, one of them only for the cup. A third of the spellings are verified, some names are blocked and some verified for another club."""
    c = clubs(spark, sf)
    f = named(meetings(spark, sf), c, "spelling").select("event_id", "home", "away", F.when(F.col("event_id") % 11 == 0, "CUP").otherwise("L").alias("competition"))
    sets = c.select((F.col("club") % 5).alias("dataset"), "name", F.when(F.col("club") % 5 == 4, "CUP").alias("competition"))
    other = c.where("club % 17 = 0").select((F.col("club") + 1).alias("club"), F.col("name").alias("source_name")).join(c.select("club", F.col("spelling").alias("canonical")), "club", "left")
    own = c.where("club % 3 = 0 AND club % 17 > 1").select(F.col("name").alias("source_name"), F.col("spelling").alias("canonical"))
    master = own.union(other.select("source_name", F.coalesce("canonical", F.lit("nobody"))))
    return B.discover_dataset(f, sets, master, c.where("club % 13 = 0").select("name")).select("event_id", "dataset", r6("score").alias("score"), "path")


@query(
    CLUBS + """, pairs AS (SELECT DISTINCT h, a FROM meetings), l AS (SELECT h, a FROM pairs WHERE (h + a) % 2 = 0), c AS (SELECT t.h, t.a, 'u' || l.h || '-' || l.a AS url, (x.s + y.s) / 2 AS score FROM l JOIN likeness x ON x.own = l.h AND x.s >= 0.68 JOIN likeness y ON y.own = l.a AND y.s >= 0.68 JOIN pairs t ON t.h = x.its AND t.a = y.its WHERE (x.s + y.s) / 2 >= 0.76),
      b AS (SELECT h, a, min(struct_pack(s := -score, u := url)) AS b FROM c GROUP BY 1, 2) SELECT h, a, b.u AS url, round(-b.s, 6) AS score FROM b""",
)
def x45_discover_urls(spark, sf):
    """The listing has half of the pairs, misspelt."""
    c, games = clubs(spark, sf), meetings(spark, sf).select("h", "a").distinct()
    listing = named(games.where("(h + a) % 2 = 0"), c, "spelling").select(F.concat(F.lit("u"), "h", F.lit("-"), "a").alias("url"), "home", "away")
    found = X.discover_urls(listing, named(games, c, "name").select(F.struct("h", "a").alias("event_id"), "home", "away"))
    return found.select("event_id.h", "event_id.a", "url", r6("score").alias("score"))


@query(
    CLUBS + """, ratings AS (SELECT club, c_acctbal AS rating FROM clubs JOIN customer ON c_custkey = club WHERE club % 5 > 0), core AS (SELECT club, list_distinct(split(name, ' ')) AS nw, list_distinct(split(spelling, ' ')) AS sw FROM clubs),
      f AS (SELECT x.club AS own, y.club AS its, x.spelling AS a, y.name AS b, x.club % 6 = 0 AND y.club = x.club AS verified, len(list_intersect(xc.sw, yc.nw)) AS k, len(list_distinct(list_concat(xc.sw, yc.nw))) AS u, least(len(xc.sw), len(yc.nw)) AS m FROM clubs x JOIN core xc ON xc.club = x.club, clubs y JOIN core yc ON yc.club = y.club WHERE y.club % 5 > 0),
      s AS (SELECT own, its, b, CASE WHEN verified OR a = b THEN 1 WHEN replace(a, ' ', '') = replace(b, ' ', '') THEN 0.99 END AS known, greatest(CAST(1 AS DOUBLE) - levenshtein(a, b) / greatest(length(a), length(b)), CAST(0.82 AS DOUBLE) * k / u + CASE WHEN k = m AND k > 0 THEN CAST(0.18 AS DOUBLE) ELSE 0 END) AS s FROM f),
      known AS (SELECT own, its, known FROM s WHERE known IS NOT NULL), o AS (SELECT own, its, s, row_number() OVER w AS n, lead(s) OVER w AS nx FROM s WHERE s >= CAST(0.875 AS DOUBLE) - 1e-9 WINDOW w AS (PARTITION BY own ORDER BY s DESC, b DESC)),
      best AS (SELECT own, its, known AS m FROM known UNION ALL SELECT own, its, s FROM o WHERE n = 1 AND s >= 0.90 AND (nx IS NULL OR s - nx >= CAST(0.025 AS DOUBLE)) AND own NOT IN (SELECT own FROM known))
      SELECT event_id, x.its AS home_club, x.rating AS home_rating, round(x.m, 6) AS home_match, y.its AS away_club, y.rating AS away_rating, round(y.m, 6) AS away_match, CASE WHEN x.its IS NOT NULL AND y.its IS NOT NULL THEN 'BOTH' WHEN x.its IS NOT NULL THEN 'HOME_ONLY' WHEN y.its IS NOT NULL THEN 'AWAY_ONLY' ELSE 'NONE' END AS coverage
      FROM meetings LEFT JOIN (SELECT best.*, rating FROM best JOIN ratings ON club = its) x ON x.own = h LEFT JOIN (SELECT best.*, rating FROM best JOIN ratings ON club = its) y ON y.own = a""",
)
def md17_power_feed(spark, sf):
    """Ratings of four fifths of the clubs for misspelt fixtures; a sixth of the spellings are verified."""
    c = clubs(spark, sf)
    ratings = T.table(spark, sf, "customer").select(F.col("c_custkey").alias("club"), F.col("c_acctbal").alias("rating")).join(c, "club").where("club % 5 > 0")
    master = c.where("club % 6 = 0").select(F.col("spelling").alias("canonical"), F.col("name").alias("source_name"))
    feed = C.power_feed(named(meetings(spark, sf), c, "spelling").select("event_id", "home", "away"), ratings.select("name", "rating"), master)
    id_of = lambda s: c.select(F.col("name").alias(f"{s}_club"), F.col("club").alias(f"{s}_id"))
    x = feed.join(id_of("home"), "home_club", "left").join(id_of("away"), "away_club", "left")
    return x.select("event_id", *[c for s in ("home", "away") for c in (F.col(f"{s}_id").alias(f"{s}_club"), F.col(f"{s}_rating"), r6(f"{s}_match").alias(f"{s}_match"))], "coverage")


@query(
    CLUBS + """, hit AS (SELECT club, CASE club % 3 WHEN 0 THEN 'CONTEXT' WHEN 1 THEN 'GLOBAL' ELSE 'DISCOVERY' END AS p, s FROM clubs JOIN likeness ON own = club AND its = club), x AS (SELECT a.club, a.p, CASE a.p WHEN 'CONTEXT' THEN 1 WHEN 'GLOBAL' THEN 0.995 ELSE a.s END AS hs, CASE a.p WHEN 'CONTEXT' THEN 1 WHEN 'GLOBAL' THEN 0.995 ELSE b.s END AS s2, c.spelling AS source_home, d.spelling AS source_away
        FROM hit a JOIN hit b ON b.club = a.club + 3 JOIN clubs c ON c.club = a.club JOIN clubs d ON d.club = b.club)
      SELECT club AS event_id, source_home, source_away, CASE WHEN p = 'CONTEXT' THEN 1 ELSE round((hs + s2) / 2, 6) END AS score, CASE WHEN p = 'CONTEXT' THEN 'CONTEXT_VERIFIED' WHEN p = 'GLOBAL' OR ((hs + s2) / 2 >= 0.94 AND least(hs, s2) >= 0.90) THEN 'VERIFIED' ELSE 'CANDIDATE' END AS status, p AS path FROM x WHERE least(hs, s2) >= 0.68 AND (hs + s2) / 2 >= 0.76""",
)
def x34_fixture_evidence(spark, sf):
    """A page for each pair of clubs three apart with their spellings some lines apart: a third known in their competition, a third everywhere, the rest by likeness."""
    c = clubs(spark, sf)
    pair = c.select("club", "name", "spelling").join(c.select((F.col("club") - 3).alias("club"), F.col("name").alias("name2"), F.col("spelling").alias("spelling2")), "club")
    lines = pair.select(F.col("club").alias("doc_id"), F.posexplode(F.array(F.lit("League"), F.col("spelling"), F.lit("21:00"), F.col("spelling2"))).alias("pos", "line"), F.lit("comp").alias("competition"))
    keys = lambda k: c.where(f"club % 3 = {k}").select(F.lit("comp").alias("competition"), E.name_key(F.col("spelling")).alias("name_key"), F.concat(F.lit("k"), "club").alias("entity"))
    key = lambda x: F.concat(F.lit("k"), x)
    targets = pair.select(F.col("club").alias("event_id"), F.col("name").alias("home"), F.col("name2").alias("away"), key(F.col("club")).alias("home_key"), key(F.col("club") + 3).alias("away_key"))
    return X.fixture_evidence(lines, targets, keys(0), keys(1).drop("competition")).withColumn("score", r6("score"))
