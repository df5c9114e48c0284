"""Operators against brute force, and streams against their batch counterparts after two batches with late rows."""

import random
from datetime import datetime, timedelta
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from matchlake.functions import names
from matchlake.operators import links, rollups
from matchlake.plans import audits, boards
from matchlake.plans import models as M
from matchlake.sources import feeds
from matchlake.streaming import live

T0 = datetime(2026, 1, 1, 12)


@pytest.mark.parametrize("seed", range(3))
def test_greedy_assignment_equals_one_pass_down_the_list(spark, seed):
    r = random.Random(seed)
    rows = [(a, b, r.randint(0, 9)) for a in range(30) for b in r.sample(range(30), 6)]
    used, want = set(), set()
    for a, b, s in sorted(rows, key=lambda x: (-x[2], x[0], x[1])):
        if ("a", a) not in used and ("b", b) not in used:
            used |= {("a", a), ("b", b)}
            want.add((a, b, s))
    got = links.assign_greedy(spark.createDataFrame(rows, "a int, b int, s int"), "a", "b", "s")
    assert {tuple(x) for x in got.collect()} == want


def test_guard_lists_are_the_smallest_keys(spark):
    g = rollups.guard_counts(spark.range(1000).select((F.col("id") % 300).alias("k"), "id"), {"odd": F.col("k") % 2 == 1, "none": F.col("k") < 0}, "k", 5).first()
    assert (g["n_rows"], g["n_odd"], g["n_none"], g["ids_odd"], g["ids_none"]) == (1000, 500, 0, [1, 3, 5, 7, 9], [])


def test_history_rates_equal_the_join(spark):
    r = random.Random(3)
    games = [(i, r.randint(0, 3), r.randint(4, 7), T0 - timedelta(days=r.randint(0, 900)), r.randint(0, 4), r.randint(0, 4), "t") for i in range(120)]
    df = spark.createDataFrame(games, "event_id long, home_id long, away_id long, kickoff timestamp, home_goals long, away_goals long, tournament string")
    rows = links.to_team_rows(df)
    want = {(x["event_id"], x["side"]): x for x in rollups.weighted_rate(links.team_history(df, rows, 540)).collect()}
    got = {(x["event_id"], x["side"]): x for x in links.history_rates(df, rows).collect()}
    assert got.keys() == want.keys()
    for k, x in want.items():
        assert got[k]["n"] == x["n"] and all(got[k][c] == pytest.approx(x[c], rel=1e-9) for c in ("gf", "ga", "weight"))
    venue = {(x["event_id"], x["side"]): x for x in rollups.weighted_rate(links.team_history(df, rows, 540, same_side=True)).collect()}
    assert all(got[k]["vgf"] == pytest.approx(x["gf"], rel=1e-9) and got[k]["vn"] == x["n"] for k, x in venue.items())


def test_likeness_and_folding(spark):
    pairs = [("real madrid", "atletico madrid"), ("psg", "paris"), ("a", "a"), (None, "x"), ("", ""), ("manchester", "manchester united")]
    got = {(x["a"], x["b"]): x["s"] for x in names.with_likeness(spark.createDataFrame(pairs * 2, "a string, b string"), "a", "b", "s").collect()}
    assert got[pairs[0]] == SequenceMatcher(None, *pairs[0]).ratio() and got[pairs[2]] == 1.0 and got[pairs[3]] == got[pairs[4]] == 0.0 and got[pairs[5]] == 0.94
    assert [names.folded(t) for t in ("Şanlıurfa", "ﬁ Ⅳ", "Ｆ．Ｃ．", "Ελλάς & Ko", None)] == ["sanliurfa", "fi iv", "f c", "and ko", None]


def test_feed_versions(spark, tmp_path):
    """A reader sees the last complete version; one that is not listed yet does not count."""
    df = spark.createDataFrame([("1", "x")], "id string, name string")
    path = str(tmp_path / "f")
    feeds.write_feed(df, path, ["id", "name"])
    feeds.write_feed(df.withColumn("name", F.lit("y")), path, ["id", "name"])
    assert feeds.read_feed(spark, path, ["id", "name"]).collect()[0]["name"] == "y"
    df.withColumn("name", F.lit("z")).write.csv(f"{path}/{'9' * 20}-half", header=True)
    assert feeds.read_feed(spark, path, ["id", "name"]).collect()[0]["name"] == "y"
    feeds.export_live(spark.createDataFrame([(1, "LIVE", 2.5)], "event_id long, status string, home double"), str(tmp_path / "live"))
    assert feeds.read_feed(spark, str(tmp_path / "live"), ["event_id", "minute", "home"]).collect()[0].asDict() == {"event_id": "1", "minute": None, "home": "2.5"}


def test_more_proven_rows_than_the_cap_are_an_error(spark):
    rows = spark.range(5).select(F.col("id").alias("event_id"), F.lit(0.9).alias("home_similarity"), F.lit(0.8).alias("away_similarity"))
    assert boards.cap_by_priority(rows.limit(2), rows, 4).count() == 4
    with pytest.raises(Exception, match="more than 4 proven rows"):
        boards.cap_by_priority(rows, rows, 4).collect()


def test_anchor_without_anything(spark):
    none = spark.createDataFrame([], "event_id long, home_key string, away_key string, fetched_at timestamp")
    got = audits.anchor_replay(spark.range(2).withColumnRenamed("id", "event_id"), none, none, none, spark.createDataFrame([], "name_key string, entity string, status string"))
    assert {r["class"] for r in got.collect()} == {"NOT_FETCHED"}


# Streams: two batches, the second with late rows

SNAP = "event_id long, snapshot_id long, captured_at timestamp, home double"


def write(spark, folder, rows, schema=SNAP):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_current_rows_over_batches_and_a_new_base(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "t")
    rows = [[(e, b, T0 + timedelta(minutes=m), float(b)) for e, m in ((1, b), (2, -b), (3 + b, 0))] for b in range(5)]
    for part in rows:
        write(spark, source, part)
        live.run_to_end(live.start_current(live.read_snapshots(spark, source, SNAP), table, str(tmp_path / "c"), ["event_id"], every=2))
    got = {r["event_id"]: r["home"] for r in live.read_current(spark, table, SNAP, ["event_id"]).collect()}
    assert got == {1: 4.0, 2: 0.0, 3: 0.0, 4: 1.0, 5: 2.0, 6: 3.0, 7: 4.0}
    assert spark.read.schema(SNAP + ", kind string, batch bigint").parquet(table).count() <= 12  # two bases' worth at most, not all changes


def test_expected_stream_equals_batch(spark, tmp_path):
    schema = "event_id long, captured_at timestamp, minute int, xg_home double, xg_away double, shots_home double, shots_away double"
    scenario = spark.createDataFrame([(1, "0-15", "H"), (2, "16-30", "A")], "event_id long, segment string, expected string")
    parts = [[(1, T0, 5, 1.0, 0.2, 9.0, 2.0), (2, T0, 20, 1.0, 0.2, 9.0, 2.0)], [(1, T0 - timedelta(minutes=5), 10, 0.1, 0.9, 1.0, 6.0), (9, T0, 1, 1.0, 1.0, 1.0, 1.0)]]
    source = str(tmp_path / "in")
    for part in parts:
        write(spark, source, part, schema)
        live.run_to_end(live.start_expected(live.read_snapshots(spark, source, schema), scenario, str(tmp_path / "o"), str(tmp_path / "c")))
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "o")).collect())
    assert got == sorted(tuple(r) for r in M.expected_actual(spark.read.schema(schema).parquet(source), scenario).collect()) and {g[-1] for g in got} == {"CONFIRM", "CONTRADICT", "WAIT"}


def test_late_rows_are_counted(spark, tmp_path):
    source = str(tmp_path / "in")
    write(spark, source, [(1, k, T0 - timedelta(hours=k), 1.0) for k in range(6)])
    q = live.count_late(live.read_snapshots(spark, source, SNAP), "captured_at", F.lit(T0 - timedelta(hours=2))).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    live.run_to_end(q)
    seen = [p.observedMetrics["late"] for p in q.recentProgress if "late" in p.observedMetrics]
    assert (sum(s["n"] for s in seen), sum(s["n_late"] for s in seen)) == (6, 3)
    batch = live.late_counts(spark.read.schema(SNAP).parquet(source), ["event_id"], F.col("captured_at") >= F.lit(T0 - timedelta(hours=2))).first()
    assert (batch["n_kept"], batch["n_late"]) == (3, 3)


def test_movement_over_two_batches(spark, tmp_path):
    """State holds over batches: the second one's rows find their hours in the first."""
    source, out = str(tmp_path / "in"), str(tmp_path / "o")
    rows = [(1, k, T0 + timedelta(hours=k), 2.0 + k) for k in range(26)]
    for part in (rows[:3], rows[3:]):
        write(spark, source, part)
        live.run_to_end(live.movement(live.read_snapshots(spark, source, SNAP)).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    got = {r["snapshot_id"]: (r["change_1h"], r["change_2h"], r["change_24h"]) for r in spark.read.parquet(out).collect()}
    assert got[0] == (None, None, None) and got[3] == (1.0, 2.0, None) and got[25] == (1.0, 2.0, 24.0)
