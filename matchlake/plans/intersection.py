"""Why verified targets are not in a source: one exclusive reason each, and the counts, leagues and samples of all in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.functions import exprs as E

PUBLISHED = "VERIFIED_PUBLISHED"


def classify_targets(targets: DataFrame, observations: DataFrame, published: DataFrame, now: Column, hours: int = 48, tolerance: int = 60, known: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """event_id, league, home_key, away_key, kickoff, reason, row_id: each target that starts after now and within the hours, with one reason and the source row that shows it.

    targets: event_id, league, home_key, away_key, kickoff; observations: row_id, home_key, away_key, clock, fields_ok, league_code (rows without a clock show nothing).
    In this order: published; the pair at the kickoff (several rows, a league that contradicts a known code, or not published); the pair at another time, the nearest; the pair with invalid fields;
    one side at the kickoff; any row at the kickoff; none. Targets meet the clocks of their pair within the tolerance and the one nearest on either side, the first rows of a side at those clocks, and the distinct clocks; never all rows of a pair.
    """
    second, keys = 1_000_000, ["home_key", "away_key"]
    t = targets.where((F.col("kickoff") > now) & (E.epoch("kickoff") <= E.epoch(now) + 3600 * hours)).withColumn("at", F.unix_micros("kickoff")).withColumn("_k", F.struct(*keys, "at"))
    t = t.join(published.select("event_id", F.lit(True).alias("is_published")).distinct(), "event_id", "left")
    o = observations.where("clock IS NOT NULL").withColumn("its", F.unix_micros("clock"))
    width = (2 * tolerance + 1) * second
    bucket = lambda c: F.floor(F.col(c) / width)
    asked = t.select("_k", *keys, "at").distinct()
    around = asked.withColumn("bucket", F.explode(F.array(*[bucket("at") + n for n in (-1, 0, 1)])))
    close = F.abs(F.col("its") - F.col("at")) <= tolerance * second
    # Rows of one pair and clock are one entry, so targets meet clocks and not rows.
    ok = o.where("fields_ok").groupBy(*keys, "its").agg(F.count("*").alias("n"), F.min(F.struct("row_id", "league_code")).alias("first"))
    near = around.join(ok.withColumn("bucket", bucket("its")), [*keys, "bucket"]).where(close).groupBy("_k").agg(F.sum("n").alias("n_near"), F.min("first").alias("near"))
    entry = F.struct(F.col("its").alias("at"), F.col("first.row_id").alias("row_id"))
    clocks = ok.dropna(subset=keys).select(*keys, F.col("its").alias("_t"), entry.alias("_o"))
    clocks = clocks.unionByName(asked.dropna(subset=keys).select("_k", *keys, F.col("at").alias("_t")), allowMissingColumns=True)
    upto = lambda order: F.last("_o", ignorenulls=True).over(Window.partitionBy(*keys).orderBy(order).rangeBetween(Window.unboundedPreceding, 0))
    off = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col("_t") - F.col(f"{c}.at")).alias("off"), F.col(f"{c}.row_id").alias("row_id")))
    apart = clocks.select("_k", "_t", upto(F.col("_t")).alias("p"), upto(F.desc("_t")).alias("q")).where("_k IS NOT NULL").select("_k", F.array_min(F.array_compact(F.array(off("p"), off("q"))))["row_id"].alias("apart"))
    broken = o.where("NOT fields_ok").select(*keys, F.lit(1).alias("n_broken")).distinct()

    def side(mine: str, other: str) -> DataFrame:
        """The first row of one side only: of each key and clock the first rows of two different others are enough."""
        first = o.groupBy(*keys, "its").agg(F.min("row_id").alias("row_id")).groupBy(mine, "its").agg(F.slice(F.sort_array(F.collect_list(F.struct("row_id", F.col(other).alias("other")))), F.lit(1), F.lit(2)).alias("two"))
        x = around.join(first.withColumn("bucket", bucket("its")), [mine, "bucket"]).where(close)
        return x.select("_k", F.array_min(F.transform(F.filter("two", lambda s: ~s["other"].eqNullSafe(F.col(other))), lambda s: s["row_id"])).alias("one"))

    sides = side("home_key", "away_key").union(side("away_key", "home_key")).groupBy("_k").agg(F.min("one").alias("one"))
    times = o.select("its", bucket("its").alias("bucket")).distinct()
    any_row = around.select("at", "bucket").distinct().join(times, "bucket").where(close).select("at", F.lit(True).alias("any_row")).distinct()
    facts = asked.select("_k").join(near, "_k", "left").join(apart, "_k", "left").join(sides, "_k", "left")
    x = t.join(facts, "_k", "left").join(broken, keys, "left").join(any_row, "at", "left")
    conflict = F.coalesce(~E.competition_ok(F.col("near.league_code"), F.col("league"), known or {}), F.lit(False))
    n = F.coalesce("n_near", F.lit(0))
    rules = [
        (F.coalesce("is_published", F.lit(False)), PUBLISHED, F.lit(None)), (n > 1, "MULTIPLE_SOURCE_PAIRS_AT_KICKOFF", F.col("near.row_id")), ((n == 1) & conflict, "KNOWN_LEAGUE_CONFLICT", F.col("near.row_id")),
        (n == 1, "PAIR_AND_TIME_UNPUBLISHED", F.col("near.row_id")), (F.col("apart").isNotNull(), "VERIFIED_PAIR_DIFFERENT_KICKOFF", F.col("apart")), (F.coalesce("n_broken", F.lit(0)) > 0, "PAIR_WITH_INVALID_SOURCE_MODEL_OR_CLOCK", F.lit(None)),
        (F.col("one").isNotNull(), "ONE_VERIFIED_TEAM_AT_SAME_KICKOFF", F.col("one")), (F.coalesce("any_row", F.lit(False)), "OTHER_SOURCE_MATCHES_AT_SAME_KICKOFF", F.lit(None)),
    ]
    reason, row = F.lit("NO_SOURCE_OBSERVATION_AT_KICKOFF"), F.lit(None).cast(observations.schema["row_id"].dataType)
    for condition, name, evidence in reversed(rules):
        reason, row = F.when(condition, name).otherwise(reason), F.when(condition, evidence).otherwise(row)
    return x.select("event_id", F.coalesce("league", F.lit("(unknown)")).alias("league"), "home_key", "away_key", "kickoff", reason.alias("reason"), row.alias("row_id"))


def audit_report(classified: DataFrame, samples: int = 4, leagues: int = 25) -> DataFrame:
    """level, league, reason, n, share, samples: one row for the total, for each reason, and for each league and reason of the largest leagues.

    All counts come from one pass (grouping sets). `share` is of the level above: the total, or the league. Reasons but for published ones have their first
    event_ids as samples. The reasons have to add up to the targets, and the query fails if they do not. No targets give no rows.
    """
    first = Window.partitionBy("reason").orderBy("event_id")
    x = classified.withColumn("_shown", (F.row_number().over(first) <= samples) & (F.col("reason") != PUBLISHED))
    g = x.groupingSets([["league", "reason"], ["league"], ["reason"], []], "league", "reason").agg(
        F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(F.col("_shown"), F.col("event_id")))).alias("samples"), F.grouping("league").alias("_l"), F.grouping("reason").alias("_r")
    )
    # As many rows as leagues times reasons: what follows is small.
    level = F.when((F.col("_l") == 1) & (F.col("_r") == 1), "TOTAL").when(F.col("_l") == 1, "REASON").when(F.col("_r") == 1, "LEAGUE").otherwise("LEAGUE_REASON")
    g = g.withColumn("level", level)
    total = g.where("level = 'TOTAL'").select(F.col("n").alias("_total"))
    by_league = g.where("level = 'LEAGUE'").select("league", F.col("n").alias("_of"), F.row_number().over(Window.orderBy(F.desc("n"), "league")).alias("_rank"))
    sums = g.where("level = 'REASON'").agg(F.sum("n").alias("_sum"))
    g = g.join(by_league, "league", "left").join(F.broadcast(total)).join(F.broadcast(sums))  # one row each
    g = g.where(F.col("_rank").isNull() | (F.col("_rank") <= leagues))
    checked = F.when(F.coalesce("_sum", F.lit(0)) == F.col("_total"), F.col("n")).otherwise(F.raise_error(F.lit("reasons don't add up to the targets")))
    below = F.when(F.col("level") == "LEAGUE_REASON", F.col("_of")).otherwise(F.col("_total"))
    shown = F.when(F.col("level") == "REASON", F.col("samples")).otherwise(F.array().cast(g.schema["samples"].dataType))
    return g.select("level", "league", "reason", checked.alias("n"), F.when(below > 0, F.col("n") / below).alias("share"), shown.alias("samples"))
