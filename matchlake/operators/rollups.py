"""Aggregates and windows: rates, registries, collisions, summaries, top-n."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.functions import exprs as E


def weighted_rate(history: DataFrame, keys: Sequence[str] = ("event_id", "side"), half_life: float = 180.0) -> DataFrame:
    """Decayed goals for and against, games and total weight."""
    w = E.decay(F.col("age_days"), half_life)
    return history.withColumn("w", w).groupBy(*keys).agg(
        (F.sum(F.col("w") * F.col("gf")) / F.sum("w")).alias("gf"), (F.sum(F.col("w") * F.col("ga")) / F.sum("w")).alias("ga"), F.count("*").alias("n"), F.sum("w").alias("weight")
    )


def combine_rates(rates: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    both = rates[0]
    for r in rates[1:]:
        both = both.unionByName(r)
    part = lambda c: (F.sum(F.col(c) * F.col("weight")) / F.sum("weight")).alias(c)
    return both.groupBy(*keys).agg(part("gf"), part("ga"), F.sum("n").alias("n"), F.sum("weight").alias("weight"))


def alias_rollup(evidence: DataFrame) -> DataFrame:
    """Per source, name_key and entity: latest spelling, observations, distinct events, best confidence, first and last seen."""
    return evidence.groupBy("source", "name_key", "entity").agg(
        F.max(F.struct("observed_at", "alias"))["alias"].alias("alias"), F.count("*").alias("n_seen"), F.count_distinct("event_id").alias("n_events"),
        F.max("confidence").alias("confidence"), F.min("observed_at").alias("first_seen"), F.max("observed_at").alias("last_seen"),
    )


def collision_count(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("source", "name_key").agg(F.count_distinct("entity").alias("n_targets"))


def classify_alias(rollup: DataFrame) -> DataFrame:
    """AMBIGUOUS with several entities; VERIFIED with two events, an exact key, or confidence of .93; else CANDIDATE."""
    x = rollup.join(collision_count(rollup), ["source", "name_key"])
    enough = (F.col("n_events") >= 2) | (F.col("name_key") == F.col("entity")) | (F.col("confidence") >= 0.93)
    status = F.when(F.col("n_targets") > 1, "AMBIGUOUS").when(enough, "VERIFIED").otherwise("CANDIDATE")
    method = F.when(F.col("n_targets") > 1, "COLLISION").when(F.col("n_events") >= 2, "EVENTS").when(F.col("name_key") == F.col("entity"), "EXACT").when(F.col("confidence") >= 0.93, "CONFIDENCE").otherwise("NONE")
    return x.withColumn("status", status).withColumn("method", method)


def promote_consensus(master: DataFrame, sources: int = 5) -> DataFrame:
    """CANDIDATE becomes VERIFIED if that many other sources verify the pair and the key has one target everywhere."""
    votes = master.where("status = 'VERIFIED'").groupBy("name_key", "entity").agg(F.count_distinct("source").alias("_v"))
    one = master.groupBy("name_key").agg(F.count_distinct("entity").alias("_t"))
    x = master.join(votes, ["name_key", "entity"], "left").join(one, "name_key")
    up = (F.col("status") == "CANDIDATE") & (F.col("_v") >= sources) & (F.col("_t") <= 1)
    return x.withColumn("status", F.when(up, "VERIFIED").otherwise(F.col("status"))).drop("_v", "_t")


def global_lookup(master: DataFrame) -> DataFrame:
    """Keys with one verified entity over all sources, with the best row's confidence."""
    v = master.where("status = 'VERIFIED'")
    best = F.max(F.struct("confidence", "n_events", "last_seen", "source", "alias"))
    x = v.groupBy("name_key").agg(F.min("entity").alias("entity"), F.count_distinct("entity").alias("n"), best.alias("b"))
    return x.where("n = 1").select("name_key", "entity", F.col("b.confidence").alias("confidence"), F.col("b.source").alias("source"), F.col("b.alias").alias("alias"))


def promote_survivors(master: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Quarantined triples go; a key left with one ambiguous claimant makes it VERIFIED."""
    x = master.join(quarantine.select("source", "name_key", "entity"), ["source", "name_key", "entity"], "left_anti")
    left = x.groupBy("source", "name_key").agg(F.count_distinct("entity").alias("_n"))
    x = x.join(left, ["source", "name_key"])
    return x.withColumn("status", F.when((F.col("status") == "AMBIGUOUS") & (F.col("_n") == 1), "VERIFIED").otherwise(F.col("status"))).drop("_n")


def context_collisions(context: DataFrame) -> DataFrame:
    return context.groupBy("source", "name_key", "competition").agg(F.array_sort(F.collect_set("entity")).alias("entities")).where(F.size("entities") > 1)


def preferred_name(observed: DataFrame) -> DataFrame:
    """One spelling per entity: latest, then longest, then first by letter, with first and last seen."""
    w = Window.partitionBy("entity")
    n = F.row_number().over(w.orderBy(F.desc("observed_at"), F.desc(F.length("alias")), "alias", "event_id"))
    return observed.select("entity", "alias", F.min("observed_at").over(w).alias("first_seen"), F.max("observed_at").over(w).alias("last_seen"), n.alias("n")).where("n = 1").drop("n")


def top_recent(df: DataFrame, key: str | list[str], ts: str, n: int, tie: str) -> DataFrame:
    return df.withColumn("r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(ts), tie))).where(F.col("r") <= n)


def runner_up_margin(df: DataFrame, key: str, score: str, tie: str) -> DataFrame:
    """The best row per key with `margin`, its lead over the next; null without one."""
    w = Window.partitionBy(key).orderBy(F.desc(score), tie)
    return df.withColumn("_n", F.row_number().over(w)).withColumn("margin", F.col(score) - F.lead(score).over(w)).where("_n = 1").drop("_n")


def range_volatility(history: DataFrame, value: str, now: Column, hours: int = 24) -> DataFrame:
    """Highest less lowest value in the hours before now, with two points or more."""
    x = history.where((E.epoch(now) - E.epoch("captured_at")).between(0, hours * 3600))
    return x.groupBy("event_id").agg(F.when(F.count(value) >= 2, F.max(value) - F.min(value)).alias("volatility"), F.count(value).alias("points"))


def movement_series(history: DataFrame, value: str, hours: int = 24) -> DataFrame:
    """For every snapshot the change since the earliest in the hours before it, and the range there."""
    w = Window.partitionBy("event_id").orderBy(F.unix_micros("captured_at")).rangeBetween(-hours * 3_600_000_000, 0)
    first = F.min(F.struct("captured_at", "snapshot_id", value)).over(w)
    return history.select("event_id", "snapshot_id", "captured_at", (F.col(value) - first[value]).alias("change"), (F.max(value).over(w) - F.min(value).over(w)).alias("spread"))


def fair_rotation(candidates: DataFrame, key: str, groups: int, turn: int) -> DataFrame:
    """The candidates whose turn it is: a hash of the key deals them into groups, so every one comes up once in `groups` turns and none needs a global order."""
    hashed = F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 12), 16, 10).cast("long") % groups
    return candidates.where(hashed == turn)


def guard_counts(df: DataFrame, rules: Mapping[str, Column], key: str, first: int = 50) -> DataFrame:
    """One row: for each rule how many rows it holds for, and (ids_*) the smallest distinct keys among them, `first` at most.

    Keys are cut to the smallest per rule and slice of a hash before they meet, so no task sees more than a slice's list.
    """
    cols = [F.count("*").alias("n_rows")]
    for name, rule in rules.items():
        cols += [F.count_if(rule).alias(f"n_{name}")]
    hits = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    hit = df.select(F.col(key).alias("k"), F.explode(hits).alias("rule")).where("k IS NOT NULL").distinct()
    low = lambda *by: F.row_number().over(Window.partitionBy("rule", *by).orderBy("k")) <= first
    hit = hit.withColumn("slice", F.pmod(F.hash("k"), F.lit(256))).withColumn("low", low("slice")).where("low").withColumn("low", low()).where("low")
    lists = hit.groupBy().agg(*[F.coalesce(F.array_sort(F.collect_list(F.when(F.col("rule") == name, F.col("k")))), F.array()).alias(f"ids_{name}") for name in rules])
    return df.agg(*cols).crossJoin(lists)


def ensemble(evidence: DataFrame, enabled: Sequence[str]) -> DataFrame:
    """Mean probabilities over the enabled sources of each event, how many, and their names in order."""
    e = evidence.where(F.col("source").isin(*enabled))
    return e.groupBy("event_id").agg(*[F.avg(c).alias(c) for c in ("h", "d", "a")], F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))


def evaluation_summary(scored: DataFrame, models: Sequence[str], spark) -> DataFrame:
    """Per model the means of its metrics over rows that have them all; models without a sample stay, with nulls."""
    names = spark.createDataFrame([(m,) for m in models], "model string")
    per = scored.where("rps IS NOT NULL AND brier IS NOT NULL AND logloss IS NOT NULL").groupBy("model").agg(F.count("*").alias("n"), *[F.avg(c).alias(c) for c in ("rps", "brier", "logloss")])
    return names.join(per, "model", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def clock_cohort(candidates: DataFrame, least: int = 8, leagues: int = 3, share: float = 0.8) -> DataFrame:
    """Offsets in quarter-hours between source and target clocks; accepted is the only valid one if it holds the share of all rows."""
    x = candidates.withColumn("offset", F.round((F.unix_seconds("source_clock") - F.unix_seconds("kickoff")) / 900).cast("int"))
    g = x.groupBy("offset").agg(F.count("*").alias("n"), F.count_distinct("league").alias("n_leagues"), F.count_distinct("event_id").alias("n_events"))
    g = g.withColumn("valid", (F.col("n") >= least) & (F.col("n_leagues") >= leagues) & (F.col("n_events") == F.col("n")))
    total = g.agg(F.sum("n").alias("_all"), F.count_if("valid").alias("_valid"))
    g = g.crossJoin(F.broadcast(total))
    return g.select("offset", "n", "n_leagues", "valid", (F.col("valid") & (F.col("_valid") == 1) & (F.col("n") >= share * F.col("_all"))).alias("accepted"))


def competition_cohort(strict: DataFrame) -> DataFrame:
    """Codes of strictly linked fixtures: accepted with three fixtures, one league and five teams."""
    teams = F.array_distinct(F.flatten(F.collect_set(F.array("home_id", "away_id"))))
    g = strict.groupBy("code").agg(F.count_distinct("event_id").alias("fixtures"), F.count_distinct("league").alias("leagues"), F.size(teams).alias("teams"), F.min("league").alias("league"))
    return g.select("code", "league", "fixtures", "teams", ((F.col("fixtures") >= 3) & (F.col("leagues") == 1) & (F.col("teams") >= 5)).alias("accepted"))


def coverage(targets: DataFrame, matched: DataFrame, by: str) -> DataFrame:
    m = matched.select("event_id", F.lit(1).alias("_m")).distinct()
    return targets.join(m, "event_id", "left").groupBy(by).agg(F.count("*").alias("total"), F.count("_m").alias("matched"))


def trust_score(shadow: DataFrame) -> DataFrame:
    """.25, up to .30 for rows, .15 if any matched; at most .79."""
    g = shadow.groupBy("source").agg(F.count("*").alias("n"), F.max(F.col("matched").cast("int")).alias("m"))
    score = F.least(F.lit(0.79), F.lit(0.25) + F.least(F.lit(0.30), F.col("n") / F.lit(1000.0)) + F.when(F.col("m") == 1, 0.15).otherwise(0.0))
    return g.select("source", "n", score.alias("trust"))


def best_per_event(rows: DataFrame, score: str) -> DataFrame:
    return rows.groupBy("event_id").agg(F.max(F.struct(score, F.struct(*rows.columns).alias("row"))).alias("r")).select("r.row.*")


def recent_form(played: DataFrame, games: int = 6) -> DataFrame:
    """Per player the last games with minutes: games, minutes, goals."""
    last = top_recent(played.where("minutes > 0").withColumn("_t", F.struct("event_id", "line")), "player", "played_at", games, "_t")
    return last.groupBy("player").agg(F.count("*").alias("games"), F.sum("minutes").alias("minutes"), F.sum("goals").alias("goals"))


def due_under_budget(targets: DataFrame, ts: str, dates: int, per_date: int, tie: str) -> DataFrame:
    """Rows of the newest dates, at most per_date of each."""
    d = targets.withColumn("_d", F.to_date(ts))
    newest = d.select("_d").distinct().orderBy(F.desc("_d")).limit(dates)
    x = d.join(F.broadcast(newest), "_d")
    return x.withColumn("_n", F.row_number().over(Window.partitionBy("_d").orderBy(F.desc(ts), tie))).where(F.col("_n") <= per_date).drop("_n", "_d")
