"""Coverage of the registry of names, current guards of whole layers, consensus rows, and summaries with a validity of their own per source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.functions import exprs as E
from matchlake.operators import state
from matchlake.plans import boards
from matchlake.sources import feeds

#: States of a registry row.
VERIFIED, CANDIDATE, AMBIGUOUS = "VERIFIED", "CANDIDATE", "AMBIGUOUS"


def _count(status: str, name: str) -> Column:
    return F.count_if(F.col("status") == status).alias(name)


def master_coverage(master: DataFrame) -> DataFrame:
    """Per source: rows by status, entities verified, keys that block a fallback, newest sighting."""
    blocks = F.count_if(F.col("status").isin(CANDIDATE, AMBIGUOUS)).alias("n_blocks")
    keys = F.count_distinct(F.when(F.col("status") == VERIFIED, F.col("entity"))).alias("n_entities")
    return master.groupBy("source").agg(_count(VERIFIED, "n_verified"), _count(CANDIDATE, "n_candidate"), _count(AMBIGUOUS, "n_ambiguous"), keys, blocks, F.max("last_seen").alias("last_seen"))


def unresolved_actions(master: DataFrame, deferred: DataFrame) -> DataFrame:
    """Rows that are not verified and not deferred, with what to do about them."""
    action = F.when(F.col("status") == AMBIGUOUS, "COLLISION_REVIEW").when(F.col("status") == CANDIDATE, "EVIDENCE_PROMOTION_REVIEW").otherwise("OTHER_NON_VERIFIED")
    left = master.where(F.col("status") != VERIFIED).join(deferred.select("source", "name_key").distinct(), ["source", "name_key"], "left_anti")
    return left.select("source", "name_key", "entity", "status", action.alias("next_action"))


def core_scope(actions: DataFrame, master: DataFrame, telemetry: DataFrame, sources: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The actions and the coverage of the sources in scope; sources without context rows count 0 of them."""
    n = master.where(F.col("source").isin(*sources)).groupBy("source").agg(_count(VERIFIED, "n_verified"), _count(CANDIDATE, "n_candidate"), _count(AMBIGUOUS, "n_ambiguous"))
    n = n.join(telemetry.select("source", "n_context", "n_unresolved"), "source", "left").na.fill(0, ["n_context", "n_unresolved"])
    return actions.where(F.col("source").isin(*sources)), n


def context_telemetry(context: DataFrame) -> DataFrame:
    """Per source of a context table (source, name_key, entity, competition, status): verified rows, names and entities, and the rest."""
    ok = lambda c: F.count_distinct(F.when(F.col("status") == VERIFIED, F.col(c)))
    return context.groupBy("source").agg(_count(VERIFIED, "n_context"), ok("name_key").alias("n_names"), ok("entity").alias("n_entities"), F.count_if(F.col("status") != VERIFIED).alias("n_unresolved"))


def generic_alias_paths(master: DataFrame, context: DataFrame) -> DataFrame:
    """Each unverified master row with its verified contexts: resolved by those at run time, or still to be discovered."""
    keys = ["source", "name_key", "entity"]
    c = context.where(F.col("status") == VERIFIED).groupBy(*keys).agg(F.count("*").alias("n_hits"), F.array_join(F.array_sort(F.collect_set("competition")), ",").alias("competitions"))
    x = master.where(F.col("status").isin(CANDIDATE, AMBIGUOUS)).select(*keys, "status").join(c, keys, "left").na.fill(0, ["n_hits"])
    return x.withColumn("path", F.when(F.col("n_hits") > 0, "DIRECT_CONTEXT_MASTER").otherwise("DISCOVERY_REQUIRED"))


def anchor_replay(anchors: DataFrame, predictions: DataFrame, archive: DataFrame, supplement: DataFrame, master: DataFrame) -> DataFrame:
    """Per anchor event: both names of its newest prediction mastered, a prediction with a gap, only archived or supplemented, or not seen at all.

    predictions: event_id, home_key, away_key, fetched_at; master: name_key, entity, status. Absence from what was fetched proves no absence at the source.
    """
    p = state.latest_per_key(predictions.select("event_id", "home_key", "away_key", "fetched_at"), ["event_id"], "fetched_at").withColumn("_p", F.lit(True))
    known = master.where(F.col("status") == VERIFIED).groupBy("name_key").agg(F.min("entity").alias("entity"))
    x = anchors.select("event_id").distinct().join(p, "event_id", "left")
    for s in ("home", "away"):
        x = x.join(known.select(F.col("name_key").alias(f"{s}_key"), F.col("entity").alias(f"{s}_entity")), f"{s}_key", "left")
    seen = archive.select("event_id").union(supplement.select("event_id")).distinct().withColumn("_s", F.lit(True))
    x = x.join(seen, "event_id", "left")
    both = F.col("home_entity").isNotNull() & F.col("away_entity").isNotNull()
    kind = F.when(F.col("_p") & both, "DIRECT_MASTER").when(F.col("_p"), "NAME_GAP").when(F.col("_s"), "ARCHIVE_OR_SUPPLEMENT_ONLY").otherwise("NOT_FETCHED")
    return x.select("event_id", "home_entity", "away_entity", kind.alias("class"))


def source_coverage(replays: dict[str, DataFrame]) -> DataFrame:
    """Per feed how many anchors each class of its replay has."""
    both = None
    for feed, x in replays.items():
        x = x.groupBy("class").agg(F.count("*").alias("n")).select(F.lit(feed).alias("feed"), "class", "n")
        both = x if both is None else both.unionByName(x)
    return both


def candidate_queue(registry: DataFrame, entities: DataFrame) -> DataFrame:
    """Aliases that wait for a decision, of entities that exist, with the entity's name."""
    return registry.where(F.col("status").isin(CANDIDATE, AMBIGUOUS)).join(entities.select("entity", "name"), "entity").select("source", "name_key", "entity", "name", "status", "n_events")


#: Reasons of a gap by family.
REVIEW = ("alias_near_miss_review", "match_policy_review")
MODEL_MISSING = "current_model_missing_after_reconcile"
ABSENT = ("source_surface_unavailable", "fixture_absent_from_fetched_surfaces", "previously_observed_fixture_without_model", "fixture_without_usable_model")


def gap_class(gaps: DataFrame, effective: DataFrame, candidates: DataFrame, master: DataFrame) -> DataFrame:
    """gaps (source, entity, last_event, reason) with a class: resolved meanwhile, absent at the source, a reconcile gap of a known entity, an identity gap, or review."""
    now = effective.where("status = 'CURRENT'").select(F.col("event_id").alias("last_event"), F.lit(True).alias("_now")).distinct()
    c = candidates.groupBy(F.col("event_id").alias("last_event")).agg(F.max("queue_reason").alias("_why"))
    m = master.where(F.col("status") == VERIFIED).select("entity", F.lit(True).alias("_known")).distinct()
    x = gaps.join(now, "last_event", "left").join(c, "last_event", "left").join(m, "entity", "left")
    missing, review = F.col("reason") == MODEL_MISSING, F.col("reason").isin(*REVIEW)
    kind = (
        F.when(missing & F.col("_now"), "RESOLVED_CURRENT_MODEL_PRESENT").when(review & (F.col("_why") == "SOURCE_FIXTURE_NOT_OBSERVED"), "SOURCE_OR_MODEL_ABSENCE").when(missing & F.col("_known"), "RECONCILE_OR_MODEL_GAP")
        .when(missing | review, "IDENTITY_OR_RECONCILE_GAP").when(F.col("reason").isin(*ABSENT), "SOURCE_OR_MODEL_ABSENCE").otherwise("REVIEW_REQUIRED")
    )
    return x.select("source", "entity", "last_event", "reason", kind.alias("class"), F.coalesce("_known", F.lit(False)).alias("has_identity"))


def upsert_consensus(payload: DataFrame, base: DataFrame, col: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Consensus rows (event_id, home, draw, away, sources, captured_at) of JSON arrays into the base, newest per event, probabilities as fractions; and the narrow rows of what is now stored."""
    rows = feeds.from_recordset(payload, col, "event_id: bigint, home: double, draw: double, away: double, sources: array<string>, captured_at: timestamp")
    p = E.norm_probs(F.col("home"), F.col("draw"), F.col("away"))
    rows = rows.select("event_id", "captured_at", F.array_join(F.array_sort(F.array_distinct("sources")), ",").alias("sources"), p.alias("p")).select("event_id", "captured_at", "sources", "p.h", "p.d", "p.a")
    stored = state.guard_regression(base, rows.where("event_id IS NOT NULL AND h IS NOT NULL").select(*base.columns), ["event_id"], "captured_at")
    sides = F.array(*[F.struct(F.lit(c.upper()).alias("side"), F.col(c).alias("p")) for c in "hda"])
    return stored, stored.select("event_id", "captured_at", F.inline(sides))


# Guards of today

def live_guard(live: DataFrame, score: DataFrame, stats: DataFrame, shadow: DataFrame, detail: DataFrame, now: Column) -> DataFrame:
    """One row over events whose prices are at most three minutes old.

    Scores may be three minutes old, stats and shadow rows ten; events whose detail has no metrics or is not offered are limits of the source and no lag,
    and shadow rows are not expected before the tenth minute.
    """
    age = lambda c: boards.age_minutes(c, now)
    old = lambda c, m: F.col(c).isNull() | (age(c) > m)
    last = lambda df, name: df.groupBy("event_id").agg(F.max("captured_at").alias(name))
    x = live.where(age("captured_at") <= 3).select("event_id").distinct().join(score.groupBy("event_id").agg(F.max("captured_at").alias("score_at"), F.max("minute").alias("minute")), "event_id", "left")
    x = x.join(last(stats, "stats_at"), "event_id", "left").join(last(shadow, "shadow_at"), "event_id", "left").join(detail.select("event_id", F.col("state").alias("detail")), "event_id", "left")
    limit = F.coalesce(F.col("detail").isin("NOT_APPLICABLE", "CAPTURED_NO_METRICS"), F.lit(False))
    n = lambda c: F.count_if(c)
    g = x.agg(
        F.count("*").alias("n_live"), n(old("score_at", 3)).alias("n_score_bad"), n(~limit & old("stats_at", 10)).alias("n_stats_bad"),
        n(~limit & (F.coalesce("minute", F.lit(0)) >= 10) & old("shadow_at", 10)).alias("n_shadow_bad"), n(F.col("detail") == "NOT_APPLICABLE").alias("n_score_only"), n(F.col("detail") == "CAPTURED_NO_METRICS").alias("n_no_metrics"),
    )
    state_ = F.when(F.col("n_score_bad") > 0, "FAIL").when(F.col("n_stats_bad") + F.col("n_shadow_bad") + F.col("n_score_only") + F.col("n_no_metrics") > 0, "WARN").otherwise("OK")
    return g.withColumn("state", state_)


def coverage_guard(upcoming: DataFrame, availability: DataFrame, predictions: DataFrame, health: DataFrame, now: Column, hours: int = 48, stale_hours: int = 72) -> DataFrame:
    """One row for the next hours: events without any availability row fail it; stale predictions, or events without evidence that the source does not explain, warn.

    availability: event_id, status (FIXTURE_ONLY, UNRESOLVED, SOURCE_ABSENT, MODEL); health: event_id, channels.
    """
    u = upcoming.where((F.unix_seconds("kickoff") - F.unix_seconds(now)).between(0, 3600 * hours)).select("event_id").distinct()
    p = predictions.groupBy("event_id").agg(F.max("captured_at").alias("_p"))
    x = u.join(availability.select("event_id", F.col("status").alias("_s")), "event_id", "left").join(p, "event_id", "left").join(health.select("event_id", "channels"), "event_id", "left")
    none = F.coalesce("channels", F.lit(0)) == 0
    absent = none & F.coalesce(F.col("_s").isin("FIXTURE_ONLY", "SOURCE_ABSENT"), F.lit(False))
    n = lambda c: F.count_if(c)
    g = x.agg(
        F.count("*").alias("n_events"), n(F.col("_s").isNull()).alias("n_unchecked"), n(F.col("_p").isNotNull()).alias("n_predicted"), n(F.col("_s") == "FIXTURE_ONLY").alias("n_fixture_only"),
        n(boards.age_minutes("_p", now) > 60 * stale_hours).alias("n_stale"), n(none).alias("n_no_evidence"), n(absent).alias("n_absent_at_source"), n(none & ~absent).alias("n_unexplained"),
    )
    return g.withColumn("state", F.when(F.col("n_unchecked") > 0, "FAIL").when((F.col("n_stale") > 0) | (F.col("n_unexplained") > 0), "WARN").otherwise("PASS"))


def market_authority_health(upcoming: DataFrame, legacy: DataFrame, now: Column, pools: dict[str, Sequence[str]], max_minutes: int = 30) -> DataFrame:
    """Per event that sells and has not begun: the first thing wrong with its markets, each market's state, and whether the legacy row has other prices.

    upcoming: event_id, kickoff, selling, offered (array of pools), fetched_at and the price columns of all pools.
    """
    x = upcoming.where(F.col("selling") & (F.col("kickoff") > now))
    whole = lambda cols: F.forall(F.array(*[F.col(c).isNotNull() for c in cols]), lambda b: b)
    offered = {p: F.coalesce(F.array_contains("offered", p), F.lit(False)) for p in pools}
    gap = {p: offered[p] & ~whole(cols) for p, cols in pools.items()}
    health = F.when(F.col("fetched_at").isNull(), "NO_AUTHORITY_TIMESTAMP").when(boards.age_minutes("fetched_at", now) > max_minutes, "STALE_AUTHORITY")
    for p in pools:
        health = health.when(gap[p], f"{p.upper()}_CAPTURE_GAP")
    states = [F.when(gap[p], "CAPTURE_GAP").when(~offered[p], "NOT_OFFERED").otherwise("OK").alias(f"{p}_state") for p in pools]
    x = x.select("event_id", health.otherwise("OK").alias("health"), *states, *[c for cols in pools.values() for c in cols])
    old = legacy.select("event_id", F.lit(True).alias("_l"), *[F.col(c).alias(f"_{c}") for cols in pools.values() for c in cols])
    x = x.join(old, "event_id", "left")
    differ = [F.when(F.col("_l"), F.exists(F.array(*[E.differs(F.col(c), F.col(f"_{c}")) for c in cols]), lambda b: b)).alias(f"{p}_differs") for p, cols in pools.items()]
    return x.select("event_id", "health", *[f"{p}_state" for p in pools], *differ)


def summary_feed(fixtures: DataFrame, odds: DataFrame, detail: DataFrame, predictions: DataFrame, quotes: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """Ordered JSON documents of fixtures near in time; each source's columns are there only while its own row is valid.

    Details last 24 hours; predictions 72 hours, from .94 match score with a proper triplet; quotes 75 minutes, and only of the fixture's league.
    """
    age = lambda c: boards.age_minutes(c, now)
    f = fixtures.where((F.unix_seconds("kickoff") - F.unix_seconds(now)).between(-6 * 3600, 3600 * max(1, min(48, hours)) - 1))
    d = state.latest_per_key(detail.where(age("captured_at") < 24 * 60).select("event_id", "captured_at", "detail"), ["event_id"], "captured_at").drop("captured_at")
    sound = F.col("h").between(0, 100) & F.col("d").between(0, 100) & F.col("a").between(0, 100) & (F.col("h") + F.col("d") + F.col("a")).between(98, 102)
    p = predictions.where(age("captured_at").between(-10, 72 * 60) & (F.col("match_score") >= 0.94) & sound).select("event_id", (F.col("h") / 100).alias("p_home"), (F.col("d") / 100).alias("p_draw"), (F.col("a") / 100).alias("p_away"))
    q = quotes.where(age("captured_at").between(0, 75)).select("event_id", "league", F.col("home").alias("quote_home"))
    x = f.join(odds.select("event_id", "home", "draw", "away"), "event_id", "left").join(d, "event_id", "left").join(p, "event_id", "left").join(q, ["event_id", "league"], "left")
    return feeds.to_json_rows(x, ["kickoff", "event_id"])


def ratings_or_snapshot(fresh: DataFrame, snapshot: DataFrame, least: int) -> DataFrame:
    """The fresh ratings if they are enough rows with a rating, else the stored ones; `from_snapshot` tells which."""
    good = fresh.where(F.col("rating").isNotNull() & F.col("name").isNotNull())
    n = F.broadcast(good.agg((F.count("*") >= least).alias("_ok")))
    cols = [*snapshot.columns]
    new = good.crossJoin(n).where("_ok").select(*cols, F.lit(False).alias("from_snapshot"))
    return new.unionByName(snapshot.crossJoin(n).where("NOT _ok").select(*cols, F.lit(True).alias("from_snapshot")))
