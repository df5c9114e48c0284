"""Gates: which rows go on, and why the others don't. A gate on a whole input is a one-row aggregate joined back, never a row count on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.functions import exprs as E
from matchlake.operators.state import latest_per_key


def seconds_after(a: Column | str, b: Column | str) -> Column:
    return F.unix_seconds(a) - F.unix_seconds(b)


def target_gate(snapshot: DataFrame, names: DataFrame, now: Column, before_minutes: int = 15, ahead_hours: int = 30) -> tuple[DataFrame, DataFrame]:
    """Targets: last row per event, kickoff near enough, all prices there, both names known (name, target_name); and the unresolved names."""
    last = latest_per_key(snapshot, ["event_id"], "fetched_at")
    ahead = seconds_after("kickoff", now)
    x = last.where(ahead.between(-60 * before_minutes, 3600 * ahead_hours) & F.col("home_odds").isNotNull() & F.col("draw_odds").isNotNull() & F.col("away_odds").isNotNull())
    side = lambda s: names.select(F.col("name").alias(s), F.col("target_name").alias(f"{s}_target"))
    x = x.join(side("home"), "home", "left").join(side("away"), "away", "left")
    known = F.col("home_target").isNotNull() & F.col("away_target").isNotNull()
    missing = F.array_compact(F.array(F.when(F.col("home_target").isNull(), F.col("home")), F.when(F.col("away_target").isNull(), F.col("away"))))
    return x.where(known), x.where(~known).select("event_id", F.explode(missing).alias("name"))


def bettable(fixtures: DataFrame) -> DataFrame:
    yes = F.lower(F.col("selling").cast("string")).isin("1", "true", "yes")
    return fixtures.where(yes & F.col("home_odds").isNotNull() & F.col("draw_odds").isNotNull() & F.col("away_odds").isNotNull())


def snapshot_gate(df: DataFrame, fallback: DataFrame, now: Column, ts: str = "fetched_at", max_minutes: int = 120) -> DataFrame:
    """df if its newest row is at most max_minutes old and at most ten minutes ahead, else fallback."""
    fresh = df.agg(F.coalesce(seconds_after(now, F.max(ts)).between(-600, 60 * max_minutes), F.lit(False)).alias("_ok"))
    fresh = F.broadcast(fresh)
    return df.crossJoin(fresh).where("_ok").drop("_ok").unionByName(fallback.crossJoin(fresh).where("NOT _ok").drop("_ok"))


def latest_authority(live: DataFrame, now: Column, max_minutes: int = 10) -> DataFrame:
    """Rows of the newest snapshot with their state."""
    top = F.broadcast(live.agg(F.max("fetched_at").alias("_top")))
    x = live.crossJoin(top).where(F.col("fetched_at") == F.col("_top"))
    state = F.when(F.col("_top").isNull(), "NO_SNAPSHOT").when(seconds_after(now, "_top") > 60 * max_minutes, "STALE_AUTHORITY").when(~F.col("selling"), "NOT_SELLING").when(~F.col("in_play"), "NOT_LIVE").otherwise("ELIGIBLE")
    return x.withColumn("authority_state", state).drop("_top")


def live_eligible(odds: DataFrame, stats: DataFrame, now: Column, minutes: int = 10, confidence: float = 0.74) -> DataFrame:
    """Both feeds fresh before they are joined, confidence enough, not ended."""
    fresh = lambda df: df.where(seconds_after(now, "captured_at").between(0, 60 * minutes))
    s = fresh(stats).where((F.col("match_confidence") >= confidence) & ~F.upper("status").isin("FT", "ENDED", "AET"))
    return fresh(odds).select("event_id", "home", "draw", "away").join(s, "event_id")


def provider_targets(board: DataFrame, now: Column, after_minutes: int = 140) -> DataFrame:
    """Matches with ids, names and a kickoff, neither cancelled nor finished, that are live or began within the time; one per source id."""
    passed = seconds_after(now, "kickoff")
    ok = F.col("source_id").isNotNull() & F.col("home").isNotNull() & F.col("away").isNotNull() & F.col("kickoff").isNotNull() & ~F.coalesce(F.col("cancelled"), F.lit(False)) & ~F.coalesce(F.col("finished"), F.lit(False))
    x = board.where(ok & (F.coalesce(F.col("live"), F.lit(False)) | passed.between(0, 60 * after_minutes)))
    return latest_per_key(x, ["source_id"], "kickoff")


def scenario_universe(fixtures: DataFrame, now: Column) -> DataFrame:
    ahead = seconds_after("kickoff", now)
    ended = F.upper(F.coalesce("status", F.lit(""))).rlike("END|FT|RESULT|ABANDON|CANCEL")
    return fixtures.where(ahead.between(-4 * 3600, 36 * 3600) & (F.coalesce(F.col("in_play"), F.lit(False)) | ~ended))


def senior_filter(fixtures: DataFrame, codes: Sequence[str], column: str = "tournament") -> DataFrame:
    """Known codes without youth or women's markers."""
    return fixtures.where(F.col(column).isin(*codes) & ~F.lower(column).rlike(r"u-?(17|18|19|20|21|23)\b|women|youth|reserve"))


def canonical_targets(feed: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """Targets with a proper id, a kickoff from two hours ago to two days ahead, and two different names; and the rest with a reason."""
    ahead = seconds_after("kickoff", now)
    reason = (
        F.when(~F.coalesce(F.col("match_id").rlike("^[A-Za-z0-9:_-]{2,80}$"), F.lit(False)), "ID").when(~F.coalesce(ahead.between(-7200, 172_800), F.lit(False)), "WINDOW")
        .when(F.coalesce(E.exact_name(F.col("home")) == E.exact_name(F.col("away")), F.lit(True)), "NAMES")
    )
    x = feed.withColumn("reason", reason)
    return x.where("reason IS NULL").drop("reason"), x.where("reason IS NOT NULL").select("match_id", "reason")


def prematch_targets(fixtures: DataFrame, now: Column) -> DataFrame:
    return fixtures.where(seconds_after("kickoff", now) > 0)


def enough_rows(df: DataFrame, fallback: DataFrame, least: int) -> DataFrame:
    """df if it has enough rows, else the fallback."""
    n = F.broadcast(df.agg((F.count("*") >= least).alias("_ok")))
    return df.crossJoin(n).where("_ok").drop("_ok").unionByName(fallback.crossJoin(n).where("NOT _ok").drop("_ok"))


def publish_snapshot(payload: DataFrame, eligible: DataFrame, least: int = 50, share: float = 0.65) -> DataFrame:
    """One row: rows, distinct ids, eligible events covered, and whether the snapshot may be published."""
    n = payload.agg(F.count("*").alias("n_rows"), F.count_distinct("event_id").alias("n_ids"), F.count_if(F.col("captured_at").isNull()).alias("n_no_clock"))
    c = eligible.join(payload.select("event_id", F.lit(1).alias("_p")).distinct(), "event_id", "left").agg(F.count("*").alias("n_eligible"), F.count("_p").alias("n_covered"))
    ok = (F.col("n_rows") >= least) & (F.col("n_rows") == F.col("n_ids")) & (F.col("n_no_clock") == 0) & (F.col("n_covered") >= share * F.col("n_eligible"))
    return n.crossJoin(F.broadcast(c)).withColumn("accepted", ok)
