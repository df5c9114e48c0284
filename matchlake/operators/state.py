"""Tables of current rows: merges, guards, carry-forward and queues, as pure functions of snapshots.

Every function takes the stored table and what came in, and returns the table to store; ties
are broken by stated columns, so the order of rows never matters and a repeated batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.functions import exprs as E


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """The newest row per key, whole rows compared for equal times. An aggregate, so rows are combined before the shuffle."""
    named = F.struct(F.col(ts).alias("t"), F.struct(*df.columns).alias("row"))
    return df.groupBy(*keys).agg(F.max(named).alias("r")).select("r.row.*")


def merge_newest(base: DataFrame, incoming: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Newest row per key; of equal times the incoming one; a null time is older than any."""
    both = base.withColumn("_in", F.lit(0)).unionByName(incoming.withColumn("_in", F.lit(1)))
    named = F.struct(F.col(ts).alias("t"), "_in", F.struct(*base.columns).alias("row"))
    return both.groupBy(*keys).agg(F.max(named).alias("r")).select("r.row.*")


def guard_regression(base: DataFrame, incoming: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """merge_newest for which an incoming row without a time never replaces or adds anything."""
    return merge_newest(base, incoming.where(F.col(ts).isNotNull()), keys, ts)


def merge_monotone(base: DataFrame, incoming: DataFrame, keys: Sequence[str], policy: Mapping[str, str]) -> DataFrame:
    """Per column the greatest, least, sum, or (keep) the stored value if there is one."""
    both = base.withColumn("_in", F.lit(0)).unionByName(incoming.withColumn("_in", F.lit(1)))
    pick = {"greatest": F.max, "least": F.min, "sum": F.sum, "keep": lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct("_in", c)))[c], "new": lambda c: F.max(F.when(F.col(c).isNotNull(), F.struct("_in", c)))[c]}
    return both.groupBy(*keys).agg(*[pick[how](c).alias(c) for c, how in policy.items()])


def merge_if_changed(base: DataFrame, incoming: DataFrame, keys: Sequence[str], stable: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The table with incoming rows whose stable columns differ from the stored ones, and those rows."""
    mark = lambda df: df.withColumn("_h", F.xxhash64(*stable))
    changed = mark(incoming).join(mark(base).select(*keys, "_h"), [*keys, "_h"], "left_anti").select(*incoming.columns)
    return base.join(changed.select(*keys), list(keys), "left_anti").unionByName(changed), changed


def append_absent(base: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows, and incoming ones whose key is not stored; the first of those by all columns if a key repeats."""
    fresh = incoming.join(base.select(*keys), list(keys), "left_anti")
    first = fresh.groupBy(*keys).agg(F.min(F.struct(*base.columns)).alias("row")).select("row.*")
    return base.unionByName(first)


def keep_verified(base: DataFrame, recomputed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """recomputed, but VERIFIED stays where it was stored."""
    old = base.where("status = 'VERIFIED'").select(*keys, F.lit(True).alias("_was"))
    return recomputed.join(old, list(keys), "left").withColumn("status", F.when(F.col("_was"), F.lit("VERIFIED")).otherwise(F.col("status"))).drop("_was")


def carry_forward(new: DataFrame, previous: DataFrame, active: DataFrame, keys: Sequence[str], model: Sequence[str], usable: str) -> DataFrame:
    """For active keys the new row's model columns if it is usable, else the last usable previous ones; `carried` tells which."""
    n = new.where(usable).select(*keys, F.struct(*model).alias("n"))
    p = previous.where(usable).select(*keys, F.struct(*model).alias("p"))
    got = active.join(n, list(keys), "left").join(p, list(keys), "left")
    return got.select(*active.columns, *[F.coalesce("n", "p")[m].alias(m) for m in model], (F.col("n").isNull() & F.col("p").isNotNull()).alias("carried"))


def merge_fields(captures: Sequence[DataFrame], keys: Sequence[str], ts: str) -> DataFrame:
    """Captures in order of precedence, the last strongest: per column the strongest value that is not blank."""
    values = [c for c in captures[0].columns if c not in (*keys, ts)]
    both = None
    for n, c in enumerate(captures):
        c = c.withColumn("_n", F.lit(n))
        both = c if both is None else both.unionByName(c)
    strongest = lambda c: F.max(F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.struct("_n", ts, c)))[c].alias(c)
    return both.groupBy(*keys).agg(F.max(ts).alias(ts), *[strongest(c) for c in values])


def preserve(base: DataFrame, previous: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """base with nulls of the named columns filled from the previous table."""
    old = previous.select(*keys, *[F.col(c).alias(f"_{c}") for c in columns])
    return base.join(old, list(keys), "left").select(*[F.coalesce(c, f"_{c}").alias(c) if c in columns else c for c in base.columns])


def reconcile_availability(feed: DataFrame, availability: DataFrame, targets: DataFrame) -> DataFrame:
    """event_id, status: MODEL for targets with a feed row, PENDING for new ones, ABSENT for those checked before without one; others go."""
    f, a = feed.select("event_id", F.lit(True).alias("_f")).distinct(), availability.select("event_id", F.col("status").alias("_s"))
    status = F.when(F.col("_f"), "MODEL").when(F.col("_s").isNull(), "PENDING").when(F.col("_s") == "MODEL", "ABSENT").otherwise(F.col("_s"))
    return targets.select("event_id").distinct().join(f, "event_id", "left").join(a, "event_id", "left").select("event_id", status.alias("status"))


def sample_slots(history: DataFrame, now: Column, keep_days: int = 180) -> DataFrame:
    """The last snapshot in each slot: hours until four hours before kickoff, half-hours after; older than keep_days goes."""
    minutes = F.when(E.epoch("kickoff") - E.epoch("captured_at") > 4 * 3600, 60).otherwise(30)
    slot = F.timestamp_seconds(F.floor(F.unix_seconds("captured_at") / (60 * minutes)) * (60 * minutes))
    h = history.where((E.epoch(now) - E.epoch("captured_at")) <= keep_days * 86_400).withColumn("slot", slot)
    return latest_per_key(h, ["event_id", "slot"], "captured_at")


def archive_retired(rows: DataFrame, ledger: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose content the ledger does not have, and the ledger with a content hash for each row."""
    marked = rows.select(*keys, F.xxhash64(*sorted(rows.columns)).alias("content"))
    return rows.join(ledger, list(keys), "left_anti"), ledger.unionByName(marked.join(ledger, [*keys, "content"], "left_anti"))


def transition_links(links: DataFrame, proposals: DataFrame, verified: DataFrame, fixtures: DataFrame, now: Column, drift_seconds: int = 60) -> tuple[DataFrame, DataFrame]:
    """Provisional links after a run, and an audit row for each change.

    PROVISIONAL becomes PROMOTED if its event is verified, EXPIRED after kickoff, DISCONNECTED if its
    fixture is gone, drifted, or its url is shared; other states never change. New proposals
    start PROVISIONAL. links, proposals: event_id, url, kickoff (links: state).
    """
    url = Window.partitionBy("url")
    p = proposals.withColumn("_shared", F.count("*").over(url) > 1).where("NOT _shared").drop("_shared")
    fresh = p.join(links.select("event_id"), "event_id", "left_anti").withColumn("state", F.lit("NEW"))
    x = links.unionByName(fresh.select(*links.columns))
    x = x.join(verified.select("event_id", F.lit(True).alias("_v")).distinct(), "event_id", "left")
    x = x.join(fixtures.select("event_id", F.col("kickoff").alias("_k")), "event_id", "left")
    x = x.withColumn("_n", F.sum(F.when(F.col("state").isin("PROVISIONAL", "NEW"), 1).otherwise(0)).over(url))
    drifted = F.abs(F.unix_seconds("kickoff") - F.unix_seconds("_k")) > drift_seconds
    to = (
        F.when(~F.col("state").isin("PROVISIONAL", "NEW"), F.col("state")).when(F.col("_v"), "PROMOTED").when(F.col("_k").isNull(), "DISCONNECTED")
        .when(F.col("_k") <= now, "EXPIRED").when(drifted | (F.col("_n") > 1), "DISCONNECTED").otherwise("PROVISIONAL")
    )
    x = x.withColumn("_to", to)
    audit = x.where("state <> _to").select("event_id", F.col("state").alias("was"), F.col("_to").alias("became"))
    return x.withColumn("state", F.col("_to")).select(*links.columns), audit


def publish_batch(batch: DataFrame, canonical: DataFrame, base: DataFrame, now: Column, max_age_hours: int = 72) -> tuple[DataFrame, DataFrame]:
    """Every row is checked before any is written: with violations the stored table stays as it was.

    batch: event_id, captured_at, home_name, away_name, home, draw, away, match_score; canonical: event_id, home_name, away_name.
    """
    c = canonical.select("event_id", F.col("home_name").alias("_h"), F.col("away_name").alias("_a"))
    x = batch.join(c, "event_id", "left").withColumn("_n", F.count("*").over(Window.partitionBy("event_id")))
    age = F.unix_seconds(now) - F.unix_seconds("captured_at")
    total = F.col("home") + F.col("draw") + F.col("away")
    rules = {
        "ID": ~F.coalesce(F.col("event_id").cast("string").rlike("^[A-Za-z0-9:_-]{1,80}$"), F.lit(False)), "DUPLICATE": F.col("_n") > 1, "UNKNOWN_EVENT": F.col("_h").isNull(),
        "STALE": F.coalesce(age > max_age_hours * 3600, F.lit(True)), "FUTURE": F.coalesce(age < -600, F.lit(False)), "PROBABILITY": ~F.coalesce(total.between(0.975, 1.025), F.lit(False)),
        "IDENTITY": (F.col("_h") != F.col("home_name")) | (F.col("_a") != F.col("away_name")), "MATCH_SCORE": F.coalesce(F.col("match_score") < 0.94, F.lit(True)),
    }
    x = x.withColumn("violations", F.array_compact(F.array(*[F.when(r, F.lit(k)) for k, r in rules.items()])))
    violations = x.where(F.size("violations") > 0).select("event_id", "violations")
    ok = violations.agg((F.count("*") == 0).alias("_ok"))
    fresh = batch.crossJoin(F.broadcast(ok)).where("_ok").drop("_ok")
    return merge_newest(base, fresh, ["event_id"], "captured_at"), violations
