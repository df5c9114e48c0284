"""The registry of names: learning, promotion, quarantine, queues and their audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.functions import exprs as E
from matchlake.operators import rollups, state

TRIPLE = ["source", "name_key", "entity"]


def unique_targets(registry: DataFrame) -> DataFrame:
    """Verified rows of keys with exactly one verified target."""
    n = F.count_if(F.col("status") == "VERIFIED").over(Window.partitionBy("source", "name_key"))
    return registry.withColumn("_n", n).where("_n = 1 AND status = 'VERIFIED'").drop("_n")


def harden(registry: DataFrame, master: DataFrame) -> DataFrame:
    """A candidate becomes verified if the master verifies the same triple and nobody else claims the key."""
    ok = master.where("status = 'VERIFIED'").select(*TRIPLE, F.lit(True).alias("_ok")).distinct()
    claims = registry.groupBy("source", "name_key").agg(F.count_distinct("entity").alias("_n"))
    x = registry.join(ok, TRIPLE, "left").join(claims, ["source", "name_key"])
    up = (F.col("status") == "CANDIDATE") & F.coalesce(F.col("_ok"), F.lit(False)) & (F.col("_n") == 1)
    return x.withColumn("status", F.when(up, "VERIFIED").otherwise(F.col("status"))).drop("_ok", "_n")


def context_master(evidence: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Competition master (source, competition) and context master (source, competition, name_key, entity) of verified evidence."""
    v = evidence.join(registry.where("status = 'VERIFIED'").select(*TRIPLE).distinct(), TRIPLE, "left_semi")
    seen = [F.count("*").alias("n_seen"), F.count_distinct("event_id").alias("n_events"), F.min("observed_at").alias("first_seen"), F.max("observed_at").alias("last_seen")]
    return v.groupBy("source", "competition").agg(*seen), v.groupBy("source", "competition", "name_key", "entity").agg(*seen)


def stable_live_ids(history: DataFrame, now: Column, hours: int = 4, least: int = 3, confidence: float = 0.85) -> DataFrame:
    """Events whose source reported one id only in the window, often and confidently enough."""
    x = history.where((F.unix_seconds(now) - F.unix_seconds("captured_at")).between(0, hours * 3600))
    per = x.groupBy("event_id", "source", "source_id").agg(F.count("*").alias("n"), F.min("confidence").alias("low"))
    one = per.groupBy("event_id", "source").agg(F.count("*").alias("ids"), F.min("source_id").alias("source_id"), F.sum("n").alias("n"), F.min("low").alias("low"))
    return one.where((F.col("ids") == 1) & (F.col("n") >= least) & (F.col("low") >= confidence)).drop("ids")


def apply_quarantine(master: DataFrame, quarantine: DataFrame, blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The master without quarantined triples, and blocked triples that are still in it."""
    left = master.join(quarantine.select(*TRIPLE), TRIPLE, "left_anti")
    return left, blocks.select(*TRIPLE).join(left.select(*TRIPLE), TRIPLE, "left_semi")


def promote_verified(resolved: DataFrame, legacy: DataFrame) -> DataFrame:
    """The legacy table (name_key, entity) with verified pairs whose key it lacks and that do not contradict each other."""
    one = resolved.where("status = 'VERIFIED'").groupBy("name_key").agg(F.min("entity").alias("entity"), F.count_distinct("entity").alias("n")).where("n = 1").drop("n")
    return legacy.unionByName(one.join(legacy.select("name_key"), "name_key", "left_anti"))


def gap_queue(unresolved: DataFrame, queue: DataFrame) -> DataFrame:
    """One row per entity and source that is missing a name: occurrences, last event, first and last seen; stored rows only grow."""
    new = unresolved.groupBy("source", "entity").agg(F.count("*").alias("n"), F.max(F.struct("observed_at", "event_id"))["event_id"].alias("last_event"), F.min("observed_at").alias("first_seen"), F.max("observed_at").alias("last_seen"))
    return state.merge_monotone(queue, new, ["source", "entity"], {"n": "greatest", "last_event": "greatest", "first_seen": "least", "last_seen": "greatest"})


def deferred_queue(unseen: DataFrame, entities: DataFrame, queue: DataFrame) -> DataFrame:
    """Names without a canonical entity wait as DEFERRED and become REACTIVATED once one appears."""
    known = entities.select("name_key", F.lit(True).alias("_k")).distinct()
    x = queue.select("source", "name_key", "status").unionByName(unseen.select("source", "name_key").distinct().join(queue, ["source", "name_key"], "left_anti").withColumn("status", F.lit("DEFERRED")))
    x = x.join(known, "name_key", "left")
    return x.withColumn("status", F.when((F.col("status") == "DEFERRED") & F.col("_k"), "REACTIVATED").otherwise(F.col("status"))).drop("_k")


def opportunity_queue(upcoming: DataFrame, feeds: dict[str, DataFrame], queue: DataFrame, now: Column) -> DataFrame:
    """A gap per event and feed that lacks it: OPEN with a priority that rises before kickoff, RESOLVED once the data is there."""
    soon = F.when(F.unix_seconds("kickoff") - F.unix_seconds(now) <= 6 * 3600, 2).otherwise(1)
    gaps = None
    for name, df in feeds.items():
        g = upcoming.join(df.select("event_id"), "event_id", "left_anti").select("event_id", F.lit(name).alias("gap"), soon.alias("priority"))
        gaps = g if gaps is None else gaps.unionByName(g)
    x = queue.withColumnsRenamed({"priority": "_p", "status": "_s"}).join(gaps, ["event_id", "gap"], "outer")
    status = F.when(F.col("priority").isNotNull(), "OPEN").otherwise("RESOLVED")
    return x.select("event_id", "gap", F.greatest("priority", "_p").alias("priority"), status.alias("status"))


def merge_alias_registry(registry: DataFrame, manual: DataFrame, evidence: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Aliases with one canonical name, manual ones authoritative, noise dropped, counts and best confidence; and the conflicts."""
    e = evidence.where(~E.is_noise(F.col("alias"))).withColumn("alias_key", E.name_key(F.col("alias")))
    old = registry.select("alias_key", "canonical", "n", "confidence")
    new = e.groupBy("alias_key", "canonical").agg(F.count("*").alias("n"), F.max("confidence").alias("confidence"))
    both = old.unionByName(new).groupBy("alias_key", "canonical").agg(F.sum("n").alias("n"), F.max("confidence").alias("confidence"))
    both = both.join(manual.select("alias_key"), "alias_key", "left_anti")
    g = both.groupBy("alias_key").agg(F.count("*").alias("_c"), F.max(F.struct("n", "confidence", "canonical")).alias("b"))
    ok = g.where("_c = 1").select("alias_key", "b.canonical", "b.n", "b.confidence")
    fixed = manual.select("alias_key", "canonical", F.lit(1).cast("long").alias("n"), F.lit(1.0).alias("confidence"))
    return ok.unionByName(fixed), both.join(g.where("_c > 1").select("alias_key"), "alias_key", "left_semi")


def promote_candidates(observations: DataFrame, candidates: DataFrame, mapped: DataFrame, least: int = 3, confidence: float = 0.95) -> tuple[DataFrame, DataFrame]:
    """Evidence adds up and the lowest confidence counts; enough of both promotes, unless the id is mapped elsewhere; REJECTED stays."""
    keys = ["event_id", "source", "source_id"]
    new = observations.groupBy(*keys).agg(F.count("*").alias("n"), F.min("confidence").alias("low")).withColumn("status", F.lit("CANDIDATE"))
    x = candidates.unionByName(new).groupBy(*keys).agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max(F.when(F.col("status") != "CANDIDATE", F.col("status"))).alias("_s"))
    taken = mapped.select("source", "source_id", F.col("event_id").alias("_e")).distinct()
    x = x.join(taken, ["source", "source_id"], "left")
    up = (F.col("n") >= least) & (F.col("low") >= confidence) & F.coalesce(F.col("_e") == F.col("event_id"), F.lit(True)) & F.col("_s").isNull()
    x = x.withColumn("status", F.coalesce("_s", F.when(up, F.lit("VERIFIED")), F.lit("CANDIDATE"))).drop("_s", "_e")
    fresh = x.where("status = 'VERIFIED'").select(*keys).join(mapped.select(*keys), keys, "left_anti")
    return x, mapped.select(*keys).unionByName(fresh)


def rate_limited(observations: DataFrame, seconds: int = 60) -> DataFrame:
    """Observations of a key that follow the last accepted one by at least `seconds`.

    Acceptance depends on the one before, so a key's times are folded in order: the fold is a built-in aggregate over the sorted array of one key.
    Only the last accepted time and a count are carried, and equal times of a key count once before they meet.
    """
    start = F.struct(F.lit(None).cast("bigint").alias("last"), F.lit(0).alias("n"))
    take = lambda s, t: F.struct(t.alias("last"), (s["n"] + 1).alias("n"))
    fold = F.aggregate("at", start, lambda s, t: F.when(s["last"].isNull() | (t - s["last"] >= seconds), take(s, t)).otherwise(s))
    g = observations.groupBy("event_id", "source").agg(F.array_sort(F.collect_set(F.unix_seconds("observed_at"))).alias("at")).select("event_id", "source", fold.alias("f"))
    return g.select("event_id", "source", F.col("f.n").alias("n_accepted"), F.timestamp_seconds("f.last").alias("last_accepted"))


def intersection_audit(targets: DataFrame, sources: DataFrame, published: DataFrame) -> DataFrame:
    """One exclusive reason per target, so reasons add up to the targets: published, name pair there, one side there, or absent."""
    pair = sources.select("home_key", "away_key", F.lit(1).alias("_p")).distinct()
    names = sources.select(F.explode(F.array("home_key", "away_key")).alias("k")).distinct()
    x = targets.join(published.select("event_id", F.lit(1).alias("_d")).distinct(), "event_id", "left").join(pair, ["home_key", "away_key"], "left")
    x = x.join(names.select(F.col("k").alias("home_key"), F.lit(1).alias("_h")), "home_key", "left").join(names.select(F.col("k").alias("away_key"), F.lit(1).alias("_a")), "away_key", "left")
    reason = F.when(F.col("_d").isNotNull(), "PUBLISHED").when(F.col("_p").isNotNull(), "PAIR_NOT_LINKED").when(F.col("_h").isNotNull() & F.col("_a").isNotNull(), "BOTH_NAMES_APART").when(F.col("_h").isNotNull() | F.col("_a").isNotNull(), "ONE_SIDE").otherwise("ABSENT")
    return x.select("event_id", "league", reason.alias("reason"))


def source_census(master: DataFrame) -> DataFrame:
    """Per source: rows, names, entities, and rows by status."""
    by = [F.count_if(F.col("status") == s).alias(f"n_{s.lower()}") for s in ("VERIFIED", "CANDIDATE", "AMBIGUOUS")]
    return master.groupBy("source").agg(F.count("*").alias("n_rows"), F.count_distinct("name_key").alias("n_names"), F.count_distinct("entity").alias("n_entities"), *by)


def unseen_census(observed: DataFrame, master: DataFrame) -> DataFrame:
    """Names that the master lacks for their source, with how often and until when they were seen."""
    x = observed.join(master.select("source", "name_key"), ["source", "name_key"], "left_anti")
    return x.groupBy("source", "name_key").agg(F.count("*").alias("n"), F.max("observed_at").alias("last_seen"))


def evidence_hits(resolved: DataFrame) -> DataFrame:
    """Per event and source whether anything resolved directly or globally, and the names in order."""
    return resolved.groupBy("event_id", "source").agg(F.bool_or(F.col("path") == "SOURCE").alias("direct"), F.bool_or(F.col("path") == "GLOBAL").alias("global"), F.array_join(F.array_sort(F.collect_set("name_key")), ",").alias("names"))


def gap_classes(gaps: DataFrame, effective: DataFrame, master: DataFrame) -> DataFrame:
    """RESOLVED_NOW if a prediction is effective, IDENTITY_KNOWN if the master verifies the key, else PROVIDER_ABSENT."""
    e = effective.select("event_id", F.lit(1).alias("_e")).distinct()
    m = master.where("status = 'VERIFIED'").select("source", "name_key", F.lit(1).alias("_m")).distinct()
    x = gaps.join(e, "event_id", "left").join(m, ["source", "name_key"], "left")
    return x.select(*gaps.columns, F.when(F.col("_e") == 1, "RESOLVED_NOW").when(F.col("_m") == 1, "IDENTITY_KNOWN").otherwise("PROVIDER_ABSENT").alias("class"))


def master_health(master: DataFrame) -> DataFrame:
    """One row over the master: totals by status, ambiguous keys, globally unique names."""
    g = rollups.global_lookup(master).agg(F.count("*").alias("n_global"))
    n = master.agg(F.count("*").alias("n_rows"), F.count_if(F.col("status") == "VERIFIED").alias("n_verified"), F.count_if(F.col("status") == "AMBIGUOUS").alias("n_ambiguous"), F.count_distinct("source").alias("n_sources"))
    return n.crossJoin(F.broadcast(g)).withColumn("state", F.when(F.col("n_verified") == 0, "FAIL").when(F.col("n_ambiguous") > F.col("n_verified"), "WARN").otherwise("OK"))


def maintain(evidence: DataFrame, master: DataFrame, quarantine: DataFrame, blocks: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One maintenance run as a chain of pure steps: evidence to master, verified stays, consensus, quarantine after each promotion, survivors, health."""
    fresh = rollups.classify_alias(rollups.alias_rollup(evidence))
    m = state.keep_verified(master.select(*TRIPLE, "status"), fresh, TRIPLE)
    m, _ = apply_quarantine(m, quarantine, blocks)
    m = rollups.promote_consensus(m)
    m = rollups.promote_survivors(m, quarantine)
    m, violations = apply_quarantine(m, quarantine, blocks)
    return m, violations, master_health(m)


def validate_catalog(catalog: DataFrame) -> DataFrame:
    """Names with several keys and keys with several names, by source."""
    side = lambda a, b: catalog.groupBy("source", a).agg(F.count_distinct(b).alias("n")).where("n > 1").select("source", F.lit(a).alias("column"), F.col(a).alias("value"), "n")
    return side("alias", "name_key").unionByName(side("name_key", "entity"))


def name_map(rows: DataFrame, blocked: Sequence[str] = ()) -> DataFrame:
    """name_key to the one entity it has, with the spelling of the most confident, then most frequent, then latest row."""
    x = rows.where(~F.col("name_key").isin(*blocked)) if blocked else rows
    g = x.groupBy("name_key").agg(F.count_distinct("entity").alias("n"), F.min("entity").alias("entity"), F.max(F.struct("confidence", "n_events", "last_seen", "alias"))["alias"].alias("alias"))
    return g.where("n = 1").drop("n")


def _one_value(rows: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """keys and `value` where a key has one value only; a collision is dropped rather than guessed."""
    g = rows.withColumn("_v", value).groupBy(*keys).agg(F.count_distinct("_v").alias("_n"), F.min("_v").alias("value"))
    return g.where("_n = 1").drop("_n")


def forward_map(own: DataFrame, everywhere: DataFrame, blocked: DataFrame, key=E.name_key) -> DataFrame:
    """name_key, canonical, path: from a source's names to canonical ones.

    own, everywhere: source_name, canonical, and own also confidence, event_count, last_seen; blocked: name. The source's verified rows win (SOURCE; of several for a key the most confident, most frequent, latest);
    a name that it has never classified may take the one canonical name that all sources give it (GLOBAL), a blocked one may not.
    """
    clean = lambda df: df.withColumn("name_key", key(F.col("source_name"))).where(F.col("name_key").isNotNull() & (F.coalesce(F.trim("canonical"), F.lit("")) != ""))
    mine = clean(own).groupBy("name_key").agg(F.max(F.struct(F.coalesce("confidence", F.lit(0.0)), F.coalesce("event_count", F.lit(0)), "last_seen", "canonical"))["canonical"].alias("canonical"))
    hard = blocked.select(key(F.col("name")).alias("name_key")).where("name_key IS NOT NULL").distinct()
    rest = _one_value(clean(everywhere), ["name_key"], F.col("canonical")).withColumnRenamed("value", "canonical").join(hard, "name_key", "left_anti").join(mine.select("name_key"), "name_key", "left_anti")
    return mine.select("name_key", "canonical", F.lit("SOURCE").alias("path")).union(rest.select("name_key", "canonical", F.lit("GLOBAL")))


def reverse_map(own: DataFrame, key=E.name_key) -> DataFrame:
    """canonical_key, source_name: from canonical names to the source's preferred spelling: the most confident, most frequent, latest, then smallest."""
    x = own.withColumn("canonical_key", key(F.col("canonical"))).where(F.col("canonical_key").isNotNull() & (F.coalesce(F.trim("source_name"), F.lit("")) != ""))
    rank = F.struct(-F.coalesce("confidence", F.lit(0.0)), -F.coalesce("event_count", F.lit(0)), -F.coalesce(F.unix_micros("last_seen"), F.lit(0)), "source_name")
    return x.groupBy("canonical_key").agg(F.min(rank)["source_name"].alias("source_name"))


def competition_map(rows: DataFrame, key=E.name_key) -> DataFrame:
    """competition_key, tournament: the one canonical tournament of each source competition (rows: source_competition, tournament)."""
    x = rows.withColumn("competition_key", key(F.col("source_competition"))).where(F.col("competition_key").isNotNull() & (F.coalesce(F.trim("tournament"), F.lit("")) != ""))
    return _one_value(x, ["competition_key"], F.col("tournament")).withColumnRenamed("value", "tournament")


def context_map(rows: DataFrame, key=E.name_key) -> DataFrame:
    """competition_key, name_key, canonical, tournament: what a source's name stands for in a competition (rows: source_competition, source_name, canonical, tournament).

    A row without a competition counts for the blank one. A key with two meanings is dropped.
    """
    x = rows.withColumn("competition_key", F.coalesce(key(F.col("source_competition")), F.lit(""))).withColumn("name_key", key(F.col("source_name")))
    x = x.where(F.col("name_key").isNotNull() & (F.coalesce(F.trim("canonical"), F.lit("")) != ""))
    value = F.struct("canonical", F.coalesce(F.trim("tournament"), F.lit("")).alias("tournament"))
    return _one_value(x, ["competition_key", "name_key"], value).select("competition_key", "name_key", "value.canonical", "value.tournament")


def competition_names(fixtures: DataFrame, renames: DataFrame) -> DataFrame:
    """Names of both sides for national teams: cohort teams left out, suffixes removed, renames (name, new_name) applied; one row per competition and name."""
    x = fixtures.select("tournament", "kickoff", F.explode(F.array("home", "away")).alias("name")).where(~F.lower("name").rlike(r"\bu-?(17|18|19|20|21|23)\b"))
    x = x.withColumn("name", F.trim(F.regexp_replace("name", r"(?i)\s+(women|w|national team)$", ""))).join(renames, "name", "left").withColumn("name", F.coalesce("new_name", "name"))
    return x.groupBy("tournament", E.name_key(F.col("name")).alias("name_key")).agg(F.min("name").alias("name"), F.min("kickoff").alias("first_seen"), F.max("kickoff").alias("last_seen"))


def annotate(consensus: DataFrame, hits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Consensus rows (event_id, note) with the sources that resolved their names; and only those whose note changed."""
    note = hits.where("direct OR global").groupBy("event_id").agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("_n"))
    x = consensus.join(note, "event_id", "left").withColumn("_n", F.coalesce("_n", F.lit("")))
    changed = x.where(E.differs(F.col("note"), F.col("_n"))).select("event_id", F.col("_n").alias("note"))
    return x.select("event_id", F.col("_n").alias("note")), changed


def cohort_equivalent(pairs: DataFrame, synonyms: DataFrame) -> DataFrame:
    """pairs (source, canonical, competition) with `same`: a U23 source and an AM canonical name of one country in a competition that mixes them."""
    bare = lambda c, p: F.trim(F.regexp_replace(F.lower(c), p, ""))
    x = pairs.withColumn("_s", bare("source", r"\s+u-?23$")).withColumn("_c", bare("canonical", r"\s+\(?am\)?$"))
    x = x.join(synonyms.select(F.col("name").alias("_s"), F.col("same_as").alias("_t")), "_s", "left")
    kinds = F.lower("source").rlike(r"u-?23$") & F.lower("canonical").rlike(r"\(?am\)?$")
    return x.select("source", "canonical", "competition", (kinds & (F.coalesce("_t", "_s") == F.col("_c"))).alias("same"))


def match_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumn("n_matches", F.count("*").over(Window.partitionBy(*keys)))
