"""Feeds for readers, guards and audits over them, and the core tables they come from."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.functions import exprs as E
from matchlake.operators import likeness as K
from matchlake.operators import rollups, state
from matchlake.operators.lineage import settled


def age_minutes(ts: str, now: Column) -> Column:
    return (E.epoch(now) - E.epoch(ts)) / 60


# Feeds

def app_feed(upcoming: DataFrame, live: DataFrame, layers: dict[str, DataFrame], now: Column, hours: int = 48) -> DataFrame:
    """Upcoming events of the next hours and live ones, each once (live first), as JSON documents that the layers' fields complete and override."""
    u = upcoming.where((F.unix_seconds("kickoff") - F.unix_seconds(now)).between(0, 3600 * hours)).withColumn("_n", F.lit(0))
    both = u.unionByName(live.withColumn("_n", F.lit(1)), allowMissingColumns=True)
    cols = upcoming.columns
    x = both.groupBy("event_id").agg(F.max(F.struct("_n", F.struct(*cols).alias("row"))).alias("r")).select("r.row.*", (F.col("r._n") == 1).alias("is_live"))
    fields = [c for c in x.columns if c != "event_id"]
    for name, df in layers.items():
        new = [c for c in df.columns if c != "event_id"]
        x = x.join(df.select("event_id", *[F.col(c).alias(f"_{name}_{c}") for c in new]), "event_id", "left")
        x = x.select("event_id", *[F.coalesce(f"_{name}_{c}", c).alias(c) if c in new else F.col(c) for c in fields], *[F.col(f"_{name}_{c}").alias(c) for c in new if c not in fields])
        fields += [c for c in new if c not in fields]
    return x.select("event_id", "kickoff", F.to_json(F.struct("event_id", *fields), {"ignoreNullFields": "false"}).alias("doc"))


def to_archive_shape(a: DataFrame, a_columns: dict[str, str], b: DataFrame, b_columns: dict[str, str]) -> DataFrame:
    """Two feeds with their own column names as one archive shape."""
    pick = lambda df, names, s: df.select(F.lit(s).alias("feed"), *[F.col(c).alias(k) for k, c in names.items()])
    return pick(a, a_columns, "a").unionByName(pick(b, b_columns, "b"))


def order_evidence(rows: DataFrame, day: Column, leagues: Sequence[str], models: Sequence[str]) -> DataFrame:
    """Rows of the day first, then by rank of league and model, then by id."""
    rank = lambda c, names: F.coalesce(F.array_position(F.array(*[F.lit(n) for n in names]), F.col(c)), F.lit(0))
    last = lambda r: F.when(r == 0, 10**6).otherwise(r)
    return rows.orderBy(F.when(F.to_date("captured_at") == day, 0).otherwise(1), last(rank("league", leagues)), last(rank("model", models)), "id")


def movement_board(movement: DataFrame) -> DataFrame:
    return movement.orderBy(F.desc("alert"), "kickoff", "event_id")


def unseen_priority(census: DataFrame) -> DataFrame:
    return census.orderBy(F.desc("n"), F.desc("last_seen"), "source", "name_key")


def cap_by_priority(proven: DataFrame, fuzzy: DataFrame, cap: int, strict: bool = True) -> DataFrame:
    """Proven rows, then fuzzy ones by their lower and summed similarity, up to the cap, which is the feature here: what may be published at once.

    More proven rows than that are an error if `strict`; else the cap goes to the first of them in the same order.
    """
    both = proven.withColumn("_p", F.lit(0)).unionByName(fuzzy.withColumn("_p", F.lit(1)))
    if strict:
        fits = proven.agg(F.when(F.count("*") > cap, F.raise_error(F.lit(f"more than {cap} proven rows"))).alias("_x"))
        both = both.crossJoin(F.broadcast(fits)).where("_x IS NULL").drop("_x")
    return both.orderBy("_p", F.desc(F.least("home_similarity", "away_similarity")), F.desc(F.col("home_similarity") + F.col("away_similarity")), "event_id").limit(cap).drop("_p")


def refresh_due(registry: DataFrame, context: DataFrame, now: Column, budget: int, stale_hours: int = 24) -> DataFrame:
    """Stale players of teams that play soonest, a budget of them."""
    x = registry.where(F.coalesce(age_minutes("refreshed_at", now) > 60 * stale_hours, F.lit(True))).join(context, "team")
    return x.orderBy("kickoff", "rank", "player").limit(budget)


# Core tables

def refresh_core(odds: DataFrame, predictions: dict[str, DataFrame], market: DataFrame, evidence: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Narrow market and evidence tables after wide odds and every source's predictions (event_id, h, d, a, captured_at), newest per key, as fractions."""
    m = odds.select("event_id", "captured_at", F.lit("book").alias("source"), F.inline(F.array(*[F.struct(F.lit(c.upper()).alias("selection"), F.col(c).alias("odds")) for c in ("home", "draw", "away")])))
    e = None
    for source, df in predictions.items():
        p = df.select("event_id", "captured_at", F.lit(source).alias("source"), E.norm_probs(F.col("h"), F.col("d"), F.col("a")).alias("p")).select("event_id", "captured_at", "source", "p.h", "p.d", "p.a")
        e = p if e is None else e.unionByName(p)
    return state.merge_newest(market, m.select(*market.columns), ["event_id", "source", "selection"], "captured_at"), state.merge_newest(evidence, e.select(*evidence.columns), ["event_id", "source"], "captured_at")


def promote_authority(upcoming: DataFrame, fixture: DataFrame, odds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """An authority feed into fixtures and odds, newest wins in both."""
    part = lambda df: upcoming.select(*df.columns)
    return state.merge_newest(fixture, part(fixture), ["event_id"], "fetched_at"), state.merge_newest(odds, part(odds), ["event_id"], "fetched_at")


def backfill_history(payload: DataFrame, fixture: DataFrame, history: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stub fixtures where they are absent, then history rows whose key is absent."""
    return state.append_absent(fixture, payload.select("event_id").distinct().select(*[F.col("event_id") if c == "event_id" else F.lit(None).cast(fixture.schema[c].dataType).alias(c) for c in fixture.columns]), ["event_id"]), state.append_absent(history, payload.select(*history.columns), ["event_id", "captured_at"])


def restore_active(current: DataFrame, archive: DataFrame, targets: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows of active targets: the current one with its blank fields filled from the archive, or the archive's."""
    c = current.select("event_id", *[F.col(f).alias(f"_c{f}") for f in fields], F.lit(1).alias("_c"))
    a = archive.select("event_id", *[F.col(f).alias(f"_a{f}") for f in fields], F.lit(1).alias("_a"))
    x = targets.select("event_id").distinct().join(c, "event_id", "left").join(a, "event_id", "left").where("_c = 1 OR _a = 1")
    filled = lambda f: F.when(F.coalesce(F.col(f"_c{f}").cast("string"), F.lit("")) != "", F.col(f"_c{f}")).otherwise(F.col(f"_a{f}"))
    return x.select("event_id", *[filled(f).alias(f) for f in fields], F.col("_c").isNull().alias("restored"))


def guard_event_context(rows: DataFrame, upcoming: DataFrame, resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Verified rows (event_id, side, source, name_key) whose resolved entity is the event's own; and violations."""
    own = upcoming.select("event_id", F.inline(F.array(*[F.struct(F.lit(s).alias("side"), F.col(c).alias("_own")) for s, c in (("H", "home_key"), ("A", "away_key"))])))
    x = rows.join(own, ["event_id", "side"], "left").join(resolved.select("source", "name_key", F.col("entity").alias("_to")), ["source", "name_key"], "left")
    ok = F.col("_own").isNull() | (F.col("_own") == F.col("_to"))
    return x.where(F.coalesce(ok, F.lit(False))).select(*rows.columns), x.where(~F.coalesce(ok, F.lit(False))).select(*rows.columns)


def touch_identities(teams: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Names seen now into the registry (first and last seen, best confidence, its event); and those below .90."""
    new = teams.groupBy("source", "name_key").agg(F.min("observed_at").alias("first_seen"), F.max("observed_at").alias("last_seen"), F.max("confidence").alias("confidence"), F.max(F.struct("confidence", "event_id"))["event_id"].alias("evidence_event"))
    x = state.merge_monotone(registry, new, ["source", "name_key"], {"first_seen": "least", "last_seen": "greatest", "confidence": "greatest", "evidence_event": "new"})
    return x, x.where("confidence < 0.90")


def learn_exact_shadow(shadow: DataFrame, upcoming: DataFrame) -> DataFrame:
    """Evidence rows of shadow fixtures whose two names are exactly a coming fixture's; sides H and A."""
    key = lambda df: df.withColumn("_h", E.name_key(F.col("home"))).withColumn("_a", E.name_key(F.col("away")))
    x = key(shadow).join(key(upcoming).select("_h", "_a", "event_id", "home_key", "away_key"), ["_h", "_a"])
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(c).alias("alias"), F.col(k).alias("entity")) for s, c, k in (("H", "home", "home_key"), ("A", "away", "away_key"))])
    return x.select("source", "event_id", "observed_at", F.inline(sides))


def learn_availability(availability: DataFrame, floor: float = 0.94) -> DataFrame:
    """Alias evidence of verified availability rows: both sides, with their competition."""
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(c).alias("alias"), F.col(k).alias("entity")) for s, c, k in (("H", "source_home", "home_key"), ("A", "source_away", "away_key"))])
    return availability.where(F.col("match_score") >= floor).select("source", "event_id", "competition", "match_score", "observed_at", F.inline(sides)).where("alias IS NOT NULL")


# Provisional links

#: Targets of each key that a row is held against first: of a row that is like two of them the rest does not matter.
PROBES = 4


def provisional_links(rows: DataFrame, targets: DataFrame, verified: DataFrame, floor: float = 0.30, strong: float = 0.70) -> DataFrame:
    """Links for unverified rows of a competition and clock: exactly one verified side, else both names similar enough; unique at both ends, verified sides first.

    rows: row_id, home, away, league, kickoff; targets: event_id, home, away, league, kickoff; verified: name, target_name. Verified sides meet by name, similar ones by
    competition and clock. Only a row with one target of a kind can have a link of it, so rows with two among the first few are out before all pairs are made; then the targets of
    those left are held against all rows.
    """
    at = ["league", "kickoff"]
    used = rows.select(F.explode(F.array("home", "away")).alias("name")).distinct()
    known = verified.join(used, "name").groupBy("name").agg(F.collect_set("target_name").alias("known"))
    of = lambda side: known.select(F.col("name").alias(side), F.col("known").alias(f"v_{side}"))
    r = rows.select("row_id", "home", "away", *at).join(of("home"), "home", "left").join(of("away"), "away", "left")
    t = targets.select("event_id", F.col("home").alias("th"), F.col("away").alias("ta"), *at)
    has = lambda side, name: F.coalesce(F.array_contains(f"v_{side}", F.col(name)), F.lit(False))
    hs, as_ = E.name_sim(F.col("home"), F.col("th")), E.name_sim(F.col("away"), F.col("ta"))
    similar = ~has("home", "th") & ~has("away", "ta") & (F.least(hs, as_) >= floor) & (F.greatest(hs, as_) >= strong)
    by_name = lambda side, own, its: (r.select("*", F.explode(f"v_{side}").alias("key")), t.withColumn("key", F.col(own)), [*at, "key"], ~its)
    ways = {"ONE_SIDE": [by_name("home", "th", has("away", "ta")), by_name("away", "ta", has("home", "th"))], "SIMILARITY": [(r, t, at, similar)]}

    def only(meetings: list[DataFrame], k: str, other: str) -> DataFrame:
        return reduce(DataFrame.union, meetings).groupBy(k).agg(F.count("*").alias("n"), F.min(other).alias(other))

    links_ = []
    for kind, ways_ in ways.items():
        meet = lambda a, b, keys, fits: a.join(b, keys).where(fits).select("row_id", "event_id")
        first = lambda b, keys: b.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("event_id"))).where(F.col("_n") <= PROBES).drop("_n")
        crowded = only([meet(a, first(b, keys), keys, fits) for a, b, keys, fits in ways_], "row_id", "event_id").where("n > 1").select("row_id")
        mine = settled(only([meet(a.join(crowded, "row_id", "left_anti"), b, keys, fits) for a, b, keys, fits in ways_], "row_id", "event_id").where("n = 1").drop("n"))
        asked = mine.select("event_id").distinct()
        its = only([meet(a, b.join(asked, "event_id"), keys, fits) for a, b, keys, fits in ways_], "event_id", "row_id").where("n = 1").drop("n")
        links_.append(mine.join(its, ["row_id", "event_id"]).withColumn("kind", F.lit(kind)))
    c = reduce(DataFrame.union, links_).select("row_id", "event_id", "kind")
    nth = lambda k: F.row_number().over(Window.partitionBy(k).orderBy("kind", "row_id", "event_id"))
    return c.withColumn("_a", nth("row_id")).withColumn("_b", nth("event_id")).where("_a = 1 AND _b = 1").select("row_id", "event_id", "kind")


def provisional_feed(stored: DataFrame, fixtures: DataFrame, predictions: DataFrame) -> DataFrame:
    """Links still provisional, of an unchanged fixture, without a verified prediction."""
    same = fixtures.select("event_id", "kickoff", "home", "away")
    return stored.where("state = 'PROVISIONAL'").join(same, ["event_id", "kickoff", "home", "away"], "left_semi").join(predictions.select("event_id"), "event_id", "left_anti")


def verified_pair(pairs: DataFrame, catalogs: Sequence[DataFrame]) -> DataFrame:
    """pairs (source_name, target_name) with `verified`: what the first catalogue (name, canonical) that knows the name says; null if none does."""
    x = pairs
    for n, c in enumerate(catalogs):
        one = c.groupBy(F.col("name").alias("source_name")).agg(F.min("canonical").alias(f"_c{n}"), F.count_distinct("canonical").alias(f"_n{n}"))
        x = x.join(one, "source_name", "left")
    says = F.coalesce(*[F.when(F.col(f"_n{n}") == 1, F.col(f"_c{n}") == F.col("target_name")) for n in range(len(catalogs))])
    return x.select("source_name", "target_name", says.alias("verified"))


def link_clock_cohort(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Name pairs whose displayed clocks all differ from the targets' by the one accepted offset."""
    c = rows.join(targets.select("event_id", "home", "away", "league", "kickoff"), ["home", "away"])
    c = c.withColumn("offset", F.round((F.unix_seconds("source_clock") - F.unix_seconds("kickoff")) / 900).cast("int"))
    ok = rollups.clock_cohort(c.select("event_id", "league", "kickoff", "source_clock")).where("accepted").select("offset")
    return c.join(F.broadcast(ok), "offset", "left_semi").select("row_id", "event_id")


def provenance_filter(feed: DataFrame, now: Column, least: int = 8, max_minutes: int = 180) -> DataFrame:
    """Rows with proper ids, verified identity and fresh capture, if they are enough."""
    ok = feed.where(F.col("match_id").rlike("^[A-Za-z0-9:_-]{2,80}$") & (F.col("identity_status") == "VERIFIED") & age_minutes("captured_at", now).between(-10, max_minutes))
    n = F.broadcast(ok.agg((F.count("*") >= least).alias("_ok")))
    return ok.crossJoin(n).where("_ok").drop("_ok")


def choose_link(targets: DataFrame, urls: DataFrame, accept: float = 0.48, sure: float = 0.90, margin: float = 0.12) -> DataFrame:
    """The url whose words fit both names best, with a margin below `sure`; candidates share a word with the home name."""
    words = urls.select("url", F.explode(F.array_distinct(F.split(F.lower("url"), "[^a-z0-9]+"))).alias("w")).where("w <> ''")
    t = targets.select("event_id", "home", "away", F.explode(E.tokens(F.lower("home"))).alias("w"))
    c = t.join(words, "w").select("event_id", "home", "away", "url").distinct()
    c = c.withColumn("score", E.slug_sim(F.lower("home"), F.lower("away"), F.col("url"))["mean"])
    best = Window.partitionBy("event_id").orderBy(F.desc("score"), "url")
    c = c.withColumn("n", F.row_number().over(best)).withColumn("_next", F.lead("score").over(best)).where("n = 1")
    ok = (F.col("score") >= accept) & ((F.col("score") >= sure) | F.coalesce(F.col("score") - F.col("_next") >= margin, F.lit(True)))
    return c.where(ok).select("event_id", "url", "score")


# Guards and audits

def coverage_guard(upcoming: DataFrame, availability: DataFrame, predictions: DataFrame, now: Column, hours: int = 48) -> DataFrame:
    """One row for the next hours: events, with availability, with a prediction, missing both; and PASS, WARN or FAIL."""
    u = upcoming.where((F.unix_seconds("kickoff") - F.unix_seconds(now)).between(0, 3600 * hours)).select("event_id").distinct()
    mark = lambda df, c: df.select("event_id", F.lit(1).alias(c)).distinct()
    x = u.join(mark(availability, "a"), "event_id", "left").join(mark(predictions, "p"), "event_id", "left")
    g = x.agg(F.count("*").alias("n_events"), F.count("a").alias("n_available"), F.count("p").alias("n_predicted"), F.count_if(F.col("a").isNull() & F.col("p").isNull()).alias("n_missing"))
    return g.withColumn("state", F.when(F.col("n_missing") > 0, "FAIL").when(F.col("n_predicted") < F.col("n_available"), "WARN").otherwise("PASS"))


def shadow_guard(compared: DataFrame, drift: int = 3) -> DataFrame:
    """One row over compare_feeds: coverage, agreement of ids and scores where comparable, minutes that drift."""
    g = compared.agg(F.count("*").alias("n"), F.count_if(F.col("presence") == "BOTH").alias("n_both"), F.count_if("id_match").alias("n_id"), F.count_if("score_match").alias("n_score"), F.count_if(F.col("minute_delta") > drift).alias("n_drift"))
    return g.withColumn("state", F.when(F.col("n_both") == 0, "NO_OVERLAP").when(F.col("n_score") < F.col("n_both"), "WARN").otherwise("OK"))


def offer_gaps(events: DataFrame, odds: DataFrame, pools: dict[str, str]) -> DataFrame:
    """Per event and market OK, NOT_OFFERED, or CAPTURE_GAP (offered, but no price). events: event_id, offered (array of pools)."""
    x = events.join(odds, "event_id", "left")
    state_of = lambda pool, price: F.when(F.col(price).isNotNull(), "OK").when(F.array_contains("offered", pool), "CAPTURE_GAP").otherwise("NOT_OFFERED")
    return x.select("event_id", F.inline(F.array(*[F.struct(F.lit(m).alias("market"), state_of(m, c).alias("state")) for m, c in pools.items()])))


def detail_state(history: DataFrame, now: Column, max_minutes: int = 10) -> DataFrame:
    """Per event the newest detail's size and FRESH, STALE or CAPTURED_NO_METRICS."""
    last = state.latest_per_key(history.select("event_id", "captured_at", F.size("team_stats").alias("n_stats")), ["event_id"], "captured_at")
    s = F.when(age_minutes("captured_at", now) > max_minutes, "STALE").when(F.col("n_stats") <= 0, "CAPTURED_NO_METRICS").otherwise("FRESH")
    return last.withColumn("state", s)


def identity_health_report(resolved: DataFrame) -> DataFrame:
    """Per source over resolve_name: pairs, direct, global, blocked, unresolved, and the share resolved."""
    n = lambda p: F.count_if(F.col("path") == p).alias(f"n_{p.lower()}")
    return resolved.groupBy("source").agg(F.count("*").alias("n"), *[n(p) for p in ("SOURCE", "GLOBAL", "BLOCKED", "NONE")]).withColumn("share", (F.col("n_source") + F.col("n_global")) / F.col("n"))


def live_identity_coverage(authority: DataFrame, mapped: DataFrame) -> DataFrame:
    g = authority.select("event_id").distinct().join(mapped.select("event_id", F.lit(1).alias("m")).distinct(), "event_id", "left").agg(F.count("*").alias("n"), F.count("m").alias("n_verified"))
    return g.withColumn("n_unmapped", F.col("n") - F.col("n_verified")).withColumn("ratio", F.when(F.col("n") > 0, F.col("n_verified") / F.col("n")))


def prediction_coverage(upcoming: DataFrame, predictions: DataFrame, availability: DataFrame, now: Column, stale_hours: int = 72) -> DataFrame:
    """Per event MODEL, STALE_MODEL, its availability's status, or UNCHECKED."""
    p = predictions.groupBy("event_id").agg(F.max("captured_at").alias("_p"))
    x = upcoming.select("event_id").join(p, "event_id", "left").join(availability.select("event_id", F.col("status").alias("_s")), "event_id", "left")
    s = F.when(F.col("_p").isNotNull() & (age_minutes("_p", now) <= 60 * stale_hours), "MODEL").when(F.col("_p").isNotNull(), "STALE_MODEL").otherwise(F.coalesce("_s", F.lit("UNCHECKED")))
    return x.select("event_id", s.alias("coverage"))


def runtime_health(health: DataFrame, report: DataFrame, floor: float = 0.8) -> DataFrame:
    """Health rows with the identity report's verdict where it is worse."""
    r = report.select("source", (F.col("share") < floor).alias("_low"))
    return health.join(r, "source", "left").withColumn("status", F.when(F.col("_low") & (F.col("status") == "OK"), "WARN").otherwise(F.col("status"))).drop("_low")


def overlap_diagnostics(rows: DataFrame, targets: DataFrame, seconds: int = 60) -> DataFrame:
    """How many rows fail to link for each first reason: no home, no away, no pair, league, clock; or link.

    A row does not meet its pair's targets but what they amount to: those of its league, those without one, or all if it has none, as the earliest and latest
    clock in buckets as wide as the bound. The work grows with the rows and the targets, not with their pairs.
    """
    bound = seconds * 1_000_000
    bucket = F.floor(F.col("_t") / (bound + 1))
    scope = F.concat(F.lit("="), F.col("league").cast("string"))
    t = targets.select("home_key", "away_key", "league", F.unix_micros("kickoff").alias("_t"))
    homes, aways = (t.select(k, F.lit(1).alias(f"_{k}")).distinct() for k in ("home_key", "away_key"))
    keys = ["home_key", "away_key"]
    timed = t.where("_t IS NOT NULL").select(*keys, "_t", bucket.alias("bucket"), F.explode(F.array(F.lit("*"), F.coalesce(scope, F.lit("?")))).alias("scope"))
    spans = timed.groupBy(*keys, "scope", "bucket").agg(F.min("_t").alias("lo"), F.max("_t").alias("hi"))
    none = F.lit(None).cast("bigint")
    entry = lambda n, before, after: F.struct((F.col("bucket") + n).alias("at"), before.alias("before"), after.alias("after"), F.lit(n == 0).alias("same"))
    around = spans.select(*keys, "scope", F.inline(F.array(entry(1, F.col("hi"), none), entry(0, none, none), entry(-1, none, F.col("lo")))))
    around = around.groupBy(*keys, "scope", F.col("at").alias("bucket")).agg(F.max("before").alias("before"), F.min("after").alias("after"), F.max("same").alias("same"))
    pairs, scopes = spans.select(*keys, F.lit(1).alias("_pair")).distinct(), spans.select(*keys, "scope", F.lit(1).alias("_scope")).distinct()
    free = F.max(F.col("scope") == "?").alias("_free")  # the pair has targets without a league, which rows of any league may meet
    # What a pair of names amounts to is found once and not for each of its rows, which meet it in one join: they are the many, and each join moves them.
    both = rows.select(*keys).distinct().join(homes, "home_key", "left").join(aways, "away_key", "left").join(pairs, keys, "left").join(spans.groupBy(*keys).agg(free), keys, "left")
    asked = F.when(F.col("league").isNull(), F.array(F.lit("*"))).when(F.col("_free"), F.array(scope, F.lit("?"))).otherwise(F.array(scope))
    x = rows.select("row_id", *keys, "league", F.unix_micros("kickoff").alias("_t")).alias("r").join(both.alias("b"), F.col("r.home_key").eqNullSafe(F.col("b.home_key")) & F.col("r.away_key").eqNullSafe(F.col("b.away_key")))
    x = x.select("row_id", *[F.col(f"r.{k}").alias(k) for k in keys], "_t", "_home_key", "_away_key", "_pair", F.explode(asked).alias("scope")).withColumn("bucket", bucket)
    x = x.join(scopes, [*keys, "scope"], "left").join(around, [*keys, "scope", "bucket"], "left")
    close = F.col("_t").isNull() | F.coalesce("same", F.lit(False)) | F.coalesce(F.col("_t") - F.col("before") <= bound, F.lit(False)) | F.coalesce(F.col("after") - F.col("_t") <= bound, F.lit(False))
    reason = (
        F.when(F.col("_home_key").isNull(), "1_NO_HOME").when(F.col("_away_key").isNull(), "2_NO_AWAY").when(F.col("_pair").isNull(), "3_NO_PAIR").when(F.col("_scope").isNull(), "4_LEAGUE")
        .when(~close, "5_CLOCK").otherwise("6_LINK")
    )
    best = x.groupBy("row_id").agg(F.max(reason).alias("reason"))
    return best.groupBy("reason").agg(F.count("*").alias("n"))


def gap_priority(gaps: DataFrame) -> DataFrame:
    g = gaps.groupBy("tournament", "class").agg(F.count("*").alias("n"))
    return g.withColumn("priority", F.when(F.col("class") == "IDENTITY_KNOWN", 1).when(F.col("n") >= 10, 2).otherwise(3))


def discover_dataset(fixtures: DataFrame, datasets: DataFrame, master: DataFrame | None = None, blocked: DataFrame | None = None, measure: str = "edit") -> DataFrame:
    """event_id, dataset, home_name, away_name, score, path: the dataset that holds both of a fixture's names; one row per fixture.

    fixtures: event_id, home, away, competition; datasets: dataset, name, competition (null: for all competitions that have no dataset of their own, which alone serve theirs).
    master (source_name, canonical) holds verified names: a dataset that has both sides' is VERIFIED with score 1, the smallest of several. Otherwise each side's best name in a
    dataset counts by the profile `history` (DISCOVERED from a mean of .82, the best of several datasets, then the smallest), but not if it is blocked (name),
    verified for another club, or the same for both sides. NONE otherwise. Candidates come out of the name index, so no name above the floor is missed.
    """
    profile = K.PROFILES["history"]
    key = E.fold_name
    sets = datasets.select("dataset", "name", key(F.col("name")).alias("k"), F.col("competition").alias("scope")).distinct()
    own = sets.where("scope IS NOT NULL").select(F.col("scope").alias("competition"), F.lit(True).alias("special")).distinct()
    f = settled(fixtures.join(own, "competition", "left").select("event_id", key(F.col("home")).alias("hk"), key(F.col("away")).alias("ak"), F.when(F.col("special"), F.col("competition")).alias("scope")))
    known = (master if master is not None else fixtures.sparkSession.createDataFrame([], "source_name string, canonical string")).select(key(F.col("source_name")).alias("source"), key(F.col("canonical")).alias("canonical"))
    reverse = known.groupBy("canonical").agg(F.min("source").alias("source"))
    forward = known.groupBy("source").agg(F.min("canonical").alias("canonical"))
    # The dataset's spelling of each key, one of several.
    spelt = sets.groupBy("dataset", "scope", "k").agg(F.min("name").alias("name"))
    direct = lambda c: f.join(reverse, F.col(c) == F.col("canonical")).join(spelt.withColumnRenamed("scope", "_s"), (F.col("source") == F.col("k")) & F.col("scope").eqNullSafe(F.col("_s"))).select("event_id", "dataset", F.col("name").alias(f"{c}_name"))
    verified = direct("hk").join(direct("ak"), ["event_id", "dataset"]).where("hk_name <> ak_name").groupBy("event_id").agg(F.min(F.struct("dataset", "hk_name", "ak_name")).alias("v"))

    names = f.select(F.col("hk").alias("name")).union(f.select("ak"))
    like = K.similar_names(names, spelt.select(F.col("k").alias("name")), profile.floor - profile.margin, measure)
    best = K.best_names(like.join(spelt, F.col("right") == F.col("k")).select("dataset", "scope", "left", "right", "score", "name"), profile, ["dataset"]).where("accepted")
    bad = (blocked if blocked is not None else fixtures.sparkSession.createDataFrame([], "name string")).select(key(F.col("name")).alias("right")).distinct()
    best = best.join(bad, "right", "left_anti").join(forward.withColumnRenamed("source", "right"), "right", "left").where(F.col("canonical").isNull() | (F.col("canonical") == F.col("left")))
    side = lambda c: best.select("dataset", F.col("scope").alias("_s"), F.col("left").alias(c), F.col("name").alias(f"{c}_name"), F.col("score").alias(f"{c}_score"))
    c = f.join(side("hk"), "hk").where(F.col("scope").eqNullSafe(F.col("_s"))).drop("_s").join(side("ak").drop("_s"), ["dataset", "ak"]).where("hk_name <> ak_name")
    c = c.withColumn("score", (F.col("hk_score") + F.col("ak_score")) / 2).where(F.col("score") >= profile.accept)
    found = c.groupBy("event_id").agg(F.min(F.struct((-F.col("score")).alias("s"), "dataset", "hk_name", "ak_name")).alias("d"))
    x = f.select("event_id").join(verified, "event_id", "left").join(found, "event_id", "left")
    pick = lambda c: F.coalesce(F.col(f"v.{c}"), F.col(f"d.{c}"))
    path = F.when(F.col("v").isNotNull(), "VERIFIED").when(F.col("d").isNotNull(), "DISCOVERED").otherwise("NONE")
    return x.select("event_id", pick("dataset").alias("dataset"), pick("hk_name").alias("home_name"), pick("ak_name").alias("away_name"), F.when(F.col("v").isNotNull(), 1.0).otherwise(-F.col("d.s")).alias("score"), path.alias("path"))


def alias_names(bilingual: DataFrame) -> DataFrame:
    """Source names of bilingual pairs whose local names are split on pipes: the first of each local name by id."""
    x = bilingual.select("id", F.col("name"), F.explode(F.split("local_names", r"\|")).alias("local")).where(F.col("local").rlike(r"\p{IsHan}"))
    x = x.withColumn("local", E.normalize_cjk(F.col("local")))
    return x.groupBy("local").agg(F.min(F.struct("id", "name"))["name"].alias("name"))


def market_lookup(rows: DataFrame, pages: DataFrame, value: str) -> DataFrame:
    """Per row the value of the first candidate date that has one: the day itself, the day before, the day after."""
    days = F.array(*[F.struct(F.lit(r).alias("rank"), F.date_add("source_date", n).alias("day")) for r, n in enumerate((0, -1, 1))])
    c = rows.select("row_id", "home", "away", F.inline(days)).join(pages.select("home", "away", "day", value), ["home", "away", "day"])
    return c.where(F.col(value).isNotNull()).groupBy("row_id").agg(F.min(F.struct("rank", value))[value].alias(value))


def supported_competitions(targets: DataFrame, patterns: dict[str, str]) -> DataFrame:
    label = F.coalesce(*[F.when(F.lower("competition").rlike(p), F.lit(k)) for k, p in patterns.items()])
    return targets.select(label.alias("label")).where("label IS NOT NULL").distinct()


def corners(stats: Column) -> Column:
    """Home, away and total corners of an array of (key, home, away)."""
    s = F.get(F.filter(stats, lambda x: x["key"].contains("corner")), F.lit(0))
    h, a = E.nonneg(s["home"]), E.nonneg(s["away"])
    return F.when(s.isNotNull(), F.struct(h.alias("home"), a.alias("away"), (h + a).alias("total")))


def h2h_worker(fixtures: DataFrame, mapping: DataFrame, prior: DataFrame, details: DataFrame, budget: int) -> DataFrame:
    """Per fixture its verified prior H2H, else a fetched detail within the budget by kickoff, else why not."""
    x = fixtures.select("event_id", "kickoff").join(mapping.select("event_id", F.col("status").alias("_m")), "event_id", "left")
    x = x.join(prior.where("quality = 'OK'").select("event_id", F.col("games").alias("_p")), "event_id", "left").join(details.select("event_id", F.col("games").alias("_d")), "event_id", "left")
    need = F.col("_p").isNull() & (F.col("_m") == "VERIFIED")
    due = x.where(need).orderBy("kickoff", "event_id").limit(budget).select("event_id", F.lit(True).alias("_due"))
    x = x.join(due, "event_id", "left")
    status = F.when(F.col("_p").isNotNull(), "REUSED").when(F.coalesce(F.col("_m"), F.lit("UNMAPPED")) != "VERIFIED", F.coalesce("_m", F.lit("UNMAPPED"))).when(F.col("_due").isNull(), "DEFERRED").when(F.col("_d").isNull(), "SOURCE_UNAVAILABLE").otherwise("FETCHED")
    return x.select("event_id", F.coalesce("_p", F.when(F.col("_due"), F.col("_d"))).alias("games"), status.alias("status"))


def season_profile(stats: DataFrame, now: Column) -> DataFrame:
    """Per player the stats of the newest season, its tournament with most games, and a quality label."""
    x = stats.groupBy("player").agg(F.max(F.struct("season", "games", "tournament", "goals")).alias("b"))
    return x.select("player", "b.season", "b.tournament", "b.games", "b.goals", F.when(F.col("b.games") >= 10, "OK").when(F.col("b.games") > 0, "THIN").otherwise("NONE").alias("quality"))
