"""Limits in time hold to the fraction of a second."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from matchlake.operators import links, rollups, state
from matchlake.plans import boards

T0 = datetime(2026, 1, 1, 12)
SCHEMA = "event_id long, snapshot_id long, captured_at timestamp, home double"


def at(**gap):
    return T0 + timedelta(**gap)


def test_nearest_by_fractions(spark):
    h = spark.createDataFrame([(1, 1, at(milliseconds=-900), 1.5), (1, 2, at(milliseconds=500), 2.5), (2, 3, at(seconds=60, milliseconds=400), 3.5)], SCHEMA)
    got = links.nearest(h, F.lit(T0), 60, values=["home"]).collect()
    assert [(r["event_id"], r["home"]) for r in got] == [(1, 2.5)]


def test_slots_by_fractions(spark):
    h = spark.createDataFrame([(1, 1, at(minutes=10), 1.0), (1, 2, at(minutes=30, milliseconds=300), 1.0)], SCHEMA).withColumn("kickoff", F.lit(at(hours=4, minutes=30, milliseconds=500)))
    h = h.union(spark.createDataFrame([(2, 3, at(minutes=30, milliseconds=500), 1.0, at(hours=4, minutes=30, milliseconds=900))], h.schema))
    got = {r["snapshot_id"]: r["slot"] for r in state.sample_slots(h, F.lit(T0)).collect()}
    assert got == {2: T0, 3: T0}


def test_detail_goes_stale_by_fractions(spark):
    h = spark.createDataFrame([(1, T0, ["a"]), (2, at(milliseconds=600), ["a"])], "event_id long, captured_at timestamp, team_stats array<string>")
    got = {r["event_id"]: r["state"] for r in boards.detail_state(h, F.lit(at(minutes=10, milliseconds=500))).collect()}
    assert got == {1: "STALE", 2: "FRESH"}


def test_movement_frame_by_fractions(spark):
    h = spark.createDataFrame([(1, 1, T0, 1.0), (1, 2, at(hours=24, milliseconds=200), 3.0), (1, 3, at(hours=24, milliseconds=700), 7.0)], SCHEMA)
    got = {r["snapshot_id"]: (r["change"], r["spread"]) for r in rollups.movement_series(h, "home").collect()}
    assert got == {1: (0.0, 0.0), 2: (0.0, 0.0), 3: (4.0, 4.0)}


def test_volatility_frame_by_fractions(spark):
    h = spark.createDataFrame([(1, 1, T0, 1.0), (1, 2, at(hours=1), 3.0), (1, 3, at(hours=2), 4.0)], SCHEMA)
    got = rollups.range_volatility(h, "home", F.lit(at(hours=24, milliseconds=500))).collect()
    assert [(r["volatility"], r["points"]) for r in got] == [(1.0, 2)]
