"""Live feeds as Structured Streaming jobs. Each has the same meaning as its batch counterpart on the same rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.operators import state

LATE = "10 minutes"


def read_snapshots(spark: SparkSession, path: str, schema: str, ts: str = "captured_at", late: str = LATE) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path).withWatermark(ts, late)


def run_to_end(query) -> None:
    """Wait until a query started with availableNow has read all there is."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def read_current(spark: SparkSession, table: str, schema: str, keys: Sequence[str], ts: str = "captured_at") -> DataFrame:
    """Newest row per key of a table of `start_current`: its newest base and the changes since. Superseded folders are not read."""
    rows = spark.read.schema(f"{schema}, kind string, batch bigint").parquet(table)
    base = F.broadcast(rows.where("kind = 'base'").agg(F.coalesce(F.max("batch"), F.lit(-1)).alias("_base")))
    live = rows.crossJoin(base).where("(kind = 'base' AND batch = _base) OR (kind = 'change' AND batch > _base)")
    return state.latest_per_key(live.drop("kind", "batch", "_base"), keys, ts)


def start_current(stream: DataFrame, table: str, checkpoint: str, keys: Sequence[str], ts: str = "captured_at", every: int = 20):
    """Newest row per key, as a base and the changes of each batch, for `read_current`.

    A batch writes its own newest rows only; every so many batches they become a new base, and what it replaces is emptied. A late, older
    row never replaces a newer one, and a repeated batch writes its folder again.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark, schema = batch.sparkSession, batch.schema.toDDL()
        state.latest_per_key(batch.where(F.col(ts).isNotNull()), keys, ts).write.mode("overwrite").parquet(f"{table}/kind=change/batch={number}")
        if (number + 1) % every == 0:
            read_current(spark, table, schema, keys, ts).write.mode("overwrite").parquet(f"{table}/kind=base/batch={number}")
            old = [f"kind=change/batch={n}" for n in range(number + 1 - every, number + 1)] + [f"kind=base/batch={number - every}"] * (number >= 2 * every - 1)
            for folder in old:
                spark.createDataFrame([], batch.schema).write.mode("overwrite").parquet(f"{table}/{folder}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def start_expected(stream: DataFrame, scenario: DataFrame, table: str, checkpoint: str):
    """Live rows against the stored scenario of their event and segment (a stream-static join): control score, expected side and status, appended."""
    from matchlake.plans.models import expected_actual

    return expected_actual(stream, scenario).writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def start_history(stream: DataFrame, table: str, checkpoint: str, keys: Sequence[str] = ("event_id", "captured_at")):
    """One row for each key within the watermark, appended."""
    return stream.dropDuplicatesWithinWatermark(list(keys)).writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def slots(odds: DataFrame, minutes: int = 30, values: Sequence[str] = ("home", "draw", "away")) -> DataFrame:
    """The last prices of each event in each slot; batch and stream alike."""
    last = F.max(F.struct("captured_at", "snapshot_id", *values)).alias("l")
    g = odds.groupBy("event_id", F.window("captured_at", f"{minutes} minutes").alias("w")).agg(last)
    return g.select("event_id", F.col("w.start").alias("slot"), *[F.col(f"l.{v}").alias(v) for v in values])


def sliding_range(odds: DataFrame, value: str = "home", hours: int = 2, step_minutes: int = 30) -> DataFrame:
    """Highest less lowest value in sliding windows; batch and stream alike."""
    g = odds.groupBy("event_id", F.window("captured_at", f"{hours} hours", f"{step_minutes} minutes").alias("w")).agg(F.max(value).alias("hi"), F.min(value).alias("lo"), F.count("*").alias("n"))
    return g.select("event_id", F.col("w.end").alias("until"), (F.col("hi") - F.col("lo")).alias("spread"), "n")


def identity_promotions(observations: DataFrame, hours: int = 4, least: int = 3, confidence: float = 0.85) -> DataFrame:
    """Sliding counts of (event, source, source_id) observations: promoted with enough of them, all confident."""
    g = observations.groupBy("event_id", "source", "source_id", F.window("captured_at", f"{hours} hours", "1 hour").alias("w")).agg(F.count("*").alias("n"), F.min("confidence").alias("low"))
    return g.where((F.col("n") >= least) & (F.col("low") >= confidence)).select("event_id", "source", "source_id", F.col("w.end").alias("until"), "n")


def sessions(stream: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """In-play sessions: rows of an event with gaps no longer than `gap`; batch and stream alike."""
    g = stream.groupBy("event_id", F.session_window("captured_at", gap).alias("w")).agg(F.count("*").alias("n"))
    return g.select("event_id", F.col("w.start").alias("began"), F.col("w.end").alias("ended"), "n")


def join_within(odds: DataFrame, stats: DataFrame, minutes: int = 10) -> DataFrame:
    """Price rows with the stats of their event at most `minutes` away, left outer; both sides carry watermarks in a stream."""
    s = stats.select(F.col("event_id").alias("s_event"), F.col("captured_at").alias("s_at"), F.col("row_id").alias("s_row"))
    wide = f"INTERVAL {minutes} MINUTES"
    on = (F.col("event_id") == F.col("s_event")) & F.col("s_at").between(F.col("captured_at") - F.expr(wide), F.col("captured_at") + F.expr(wide))
    return odds.join(s, on, "leftOuter")


def source_gap(targets: DataFrame, linked: DataFrame) -> DataFrame:
    """Every target, labelled SOURCE_GAP where no provider covers it; its score stays null."""
    x = targets.join(linked, "event_id", "left")
    return x.withColumn("coverage", F.when(F.col("provider").isNull(), "SOURCE_GAP").otherwise(F.col("provider")))


def precedence_union(providers: Sequence[DataFrame]) -> DataFrame:
    """One row per event, of the first provider that has it; its newest, then by all columns."""
    both = None
    for n, p in enumerate(providers):
        p = p.withColumn("_n", F.lit(-n))
        both = p if both is None else both.unionByName(p)
    cols = providers[0].columns
    return both.groupBy("event_id").agg(F.max(F.struct("_n", "captured_at", F.struct(*cols).alias("row"))).alias("r")).select("r.row.*")


def guard_stale(live: DataFrame, layers: dict[str, DataFrame], now: Column, minutes: int = 3) -> DataFrame:
    """Per live event the layers whose newest row is missing or older than `minutes`."""
    x = live.select("event_id")
    for name, df in layers.items():
        x = x.join(df.groupBy("event_id").agg(F.max("captured_at").alias(name)), "event_id", "left")
    old = lambda n: F.coalesce(F.unix_seconds(now) - F.unix_seconds(n) > 60 * minutes, F.lit(True))
    stale = F.array_compact(F.array(*[F.when(old(n), F.lit(n)) for n in layers]))
    return x.select("event_id", F.array_join(stale, ",").alias("stale_layers"))


def count_late(stream: DataFrame, ts: str, late: Callable[[], Column] | Column, name: str = "late") -> DataFrame:
    """stream with an observation that counts rows older than a bound."""
    bound = late() if callable(late) else late
    return stream.observe(name, F.count_if(F.col(ts) < bound).alias("n_late"), F.count("*").alias("n"))


def late_counts(rows: DataFrame, keys: Sequence[str], in_time: Column) -> DataFrame:
    """Per key how many rows are in time and how many came late and are dropped; batch and stream alike."""
    return rows.groupBy(*keys).agg(F.count_if(in_time).alias("n_kept"), F.count_if(~in_time).alias("n_late"))


def movement(odds: DataFrame, hours: int = 27) -> DataFrame:
    """Changes of the home price since 1, 2 and 24 hours before, per snapshot, from keyed state that keeps `hours` of snapshots.

    applyInPandasWithState: rows of a batch are folded in time order; older rows than the newest kept are put in place. An event without
    rows for that long, by the watermark, is let go.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def fold(key: tuple, frames: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
        if kept.hasTimedOut:
            kept.remove()
            return
        times, prices = (list(x) for x in kept.get) if kept.exists else ([], [])
        out = []
        rows = pd.concat(list(frames)).sort_values(["captured_at", "snapshot_id"])
        for r in rows.itertuples():
            at = int(r.captured_at.timestamp())
            change = []
            for back, tolerance in ((3600, 2400), (7200, 4500), (86_400, 10_800)):
                near = [(abs(at - back - t), t, p) for t, p in zip(times, prices, strict=True) if abs(at - back - t) <= tolerance]
                change.append(r.home - min(near)[2] if near else None)
            out.append((key[0], r.snapshot_id, r.captured_at, *change))
            times.append(at)
            prices.append(float(r.home))
        last = max(times)
        fresh = [(t, p) for t, p in zip(times, prices, strict=True) if t >= last - hours * 3600]
        kept.update(([t for t, _ in fresh], [p for _, p in fresh]))
        kept.setTimeoutTimestamp(max((last + hours * 3600) * 1000, kept.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["event_id", "snapshot_id", "captured_at", "change_1h", "change_2h", "change_24h"])

    return odds.groupBy("event_id").applyInPandasWithState(fold, "event_id bigint, snapshot_id bigint, captured_at timestamp, change_1h double, change_2h double, change_24h double", "times array<bigint>, prices array<double>", "append", GroupStateTimeout.EventTimeTimeout)
