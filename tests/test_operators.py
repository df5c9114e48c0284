"""Operators on small literal tables: ambiguity, contradictions, duplicates, late rows, idempotence."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from matchlake.functions import exprs as E
from matchlake.operators import links, rollups, state
from matchlake.sources import feeds
from matchlake.streaming import live

T0 = datetime(2026, 1, 1, 12)


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_names(spark):
    lit = F.lit
    assert one(spark, E.name_key(lit(" São-Paulo 2 ")), E.name_key(lit("--")), E.fold_name(lit("Łódź & Brøndby")), E.normalize_name(lit("FC St Pauli W"), "strict"), E.exact_name(lit("É x"))) == ("sãopaulo2", None, "lodz and brondby", "st pauli women", "ex")
    assert one(spark, E.name_sim(lit("ab"), lit("ab")), E.name_sim(lit("real madrid"), lit("madrid")), E.name_sim(lit(""), lit("x"))) == (1.0, 0.94, 0.0)
    assert one(spark, E.token_sim(lit("ac milan psg"), lit("psg paris"))) == (0.92,)


@pytest.mark.parametrize("text, want", [("5/2", 3.5), ("1.80", 1.8), ("0.5", None), ("1001", None), ("x", None)])
def test_odds(spark, text, want):
    assert one(spark, E.parse_odds(F.lit(text))) == (want,)


def test_probabilities(spark):
    p = one(spark, E.devig(F.lit(2.0), F.lit(3.0), F.lit(4.0)))[0]
    assert sum(p) == pytest.approx(1) and one(spark, E.devig(F.lit(1.0), F.lit(3.0), F.lit(4.0))) == (None,)
    q = one(spark, E.poisson_hda(F.lit(1.4), F.lit(1.1)))[0]
    assert sum(q) == pytest.approx(1) and q["h"] > q["a"]
    assert one(spark, E.argmax_hda(F.lit(0.4), F.lit(0.4), F.lit(0.2)), E.argmax_hda(F.lit(0.4), F.lit(0.4), F.lit(0.2), "TIE")) == ("H", "TIE")
    assert one(spark, E.consensus(F.array(F.lit("H"), F.lit("H"), F.lit("A"))), E.consensus(F.array(F.lit("H"), F.lit("A"))), E.consensus(F.array(F.lit(None).cast("string")))) == ("H", "CONFLICT", None)
    gate = lambda h, d, a: one(spark, E.model_gate(F.lit(h), F.lit(d), F.lit(a), F.lit("1"), F.lit("2 - 1"), F.lit(2.5)))[0]["reason"]
    assert [gate(40.0, 30.0, x) for x in (27.0, 28.0, 32.0, 33.0)] == ["PROBABILITY_SUM", None, None, "PROBABILITY_SUM"]


def test_clocks(spark):
    parsed = one(spark, E.parse_ts(F.lit("2026-01-01 20:00")), E.parse_ts(F.lit("2026-01-01T12:00:00Z")), E.parse_ts(F.lit("soon")))
    assert parsed == (T0, T0, None)
    assert one(spark, E.display_clock(F.lit("01/01/2026 12:00"), F.lit(T0)), E.display_clock(F.lit("12:00"), F.lit(T0)), E.display_clock(F.lit("05/01/2026 12:00"), F.lit(T0))) == (T0, T0, None)
    assert one(spark, E.season_codes(F.lit(datetime(2026, 6, 30))))[0] == ["2526", "2425", "2324"]


def test_scores_and_texts(spark):
    assert one(spark, E.fmt_score(F.lit("2:1")), E.parse_score(F.lit("x")), E.form_points(F.lit("WDL")), E.form_points(F.lit(""))) == ("2 - 1", None, pytest.approx(4 / 3), None)


def batch(spark, *xs):
    return spark.createDataFrame([(i, T0 + timedelta(minutes=m) if m is not None else None, v) for i, m, v in xs], "event_id long, captured_at timestamp, v int")


def test_newest_wins_is_idempotent_and_order_free(spark):
    base, new = batch(spark, (1, 0, 10), (2, 5, 20)), batch(spark, (1, 5, 11), (2, 0, 21), (3, None, 30))
    once = state.merge_newest(base, new, ["event_id"], "captured_at")
    assert {(r["event_id"], r["v"]) for r in once.collect()} == {(1, 11), (2, 20), (3, 30)}
    assert rows(state.merge_newest(once, new, ["event_id"], "captured_at").drop("captured_at")) == rows(once.drop("captured_at"))
    assert state.guard_regression(base, new, ["event_id"], "captured_at").count() == 2


def test_changed_rows_only(spark):
    base = batch(spark, (1, 0, 10), (2, 0, 20))
    merged, changed = state.merge_if_changed(base, batch(spark, (1, 9, 10), (2, 9, 22), (3, 9, 30)), ["event_id"], ["v"])
    assert {r["event_id"] for r in changed.collect()} == {2, 3} and {(r["event_id"], r["v"]) for r in merged.collect()} == {(1, 10), (2, 22), (3, 30)}


def test_static_links_reject_every_repeat(spark):
    cols = "row_id long, url string, home_key string, away_key string, league string, kickoff timestamp"
    r = [(1, "u1", "a", "b", "L", T0), (2, "u2", "c", "d", None, T0 + timedelta(seconds=60)), (3, "u3", "c2", "d2", "X", T0), (4, "u4", "e", "f", "L", T0), (5, "u5", "e", "f", "L", T0), (6, "u6", "e", "f", "L", T0), (7, "u7", "zz", "b", "L", T0), (8, "u8", "g", "h", "L", T0 + timedelta(seconds=61))]
    t = [(10, "a", "b", "L", T0), (20, "c", "d", "L", T0), (30, "c2", "d2", "L", T0), (40, "e", "f", "L", T0), (50, "g", "h", "L", T0)]
    ok, no = links.link_static(spark.createDataFrame(r, cols), spark.createDataFrame(t, "event_id long, home_key string, away_key string, league string, kickoff timestamp"))
    assert rows(ok) == [(1, 10), (2, 20)]
    assert rows(no) == [(3, "LEAGUE_OR_CLOCK"), (4, "REPEATED"), (5, "REPEATED"), (6, "REPEATED"), (7, "NO_NAME_PAIR"), (8, "LEAGUE_OR_CLOCK")]


def test_fuzzy_link_needs_a_margin(spark):
    r = spark.createDataFrame([(1, "real madrid", "fc porto", T0), (2, "inter", "milan", T0)], "row_id long, home string, away string, kickoff timestamp")
    t = spark.createDataFrame([(10, "madrid", "porto", T0), (20, "inter x", "milan y", T0), (21, "inter z", "milan w", T0), (30, "real madrid", "fc porto", T0 + timedelta(hours=9))], "event_id long, home string, away string, kickoff timestamp")
    got = {x["row_id"]: (x["event_id"], x["linked"]) for x in links.link_fuzzy(r, t, links.PROFILES["odds"]).collect()}
    assert got[1] == (10, True) and got[2] == (20, True)
    strict = links.Profile(90, 0.66, 0.78, 0.99, 0.04)
    assert {x["row_id"]: x["linked"] for x in links.link_fuzzy(r, t, strict).collect()}[2] is False


def test_publish_is_all_or_nothing(spark):
    cols = "event_id long, captured_at timestamp, home_name string, away_name string, home double, draw double, away double, match_score double"
    canonical = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "event_id long, home_name string, away_name string")
    good = (1, T0, "a", "b", 0.4, 0.3, 0.3, 0.95)
    now = F.lit(T0 + timedelta(hours=1))
    base = spark.createDataFrame([], cols)
    table, bad = state.publish_batch(spark.createDataFrame([good], cols), canonical, base, now)
    assert table.count() == 1 and bad.count() == 0
    for wrong in [(2, T0, "c", "d", 0.4, 0.3, 0.2, 0.95), (2, T0 - timedelta(hours=80), "c", "d", 0.4, 0.3, 0.3, 0.95), (2, T0, "c", "x", 0.4, 0.3, 0.3, 0.95), (2, T0, "c", "d", 0.4, 0.3, 0.3, 0.93), good]:
        table, bad = state.publish_batch(spark.createDataFrame([good, wrong], cols), canonical, base, now)
        assert table.count() == 0 and bad.count() >= 1


def test_provisional_transitions(spark):
    link = "event_id long, url string, kickoff timestamp, state string"
    later = T0 + timedelta(hours=5)
    stored = spark.createDataFrame([(1, "u1", later, "PROVISIONAL"), (2, "u2", later, "PROVISIONAL"), (3, "u3", later, "PROVISIONAL"), (4, "u4", later, "DISCONNECTED")], link)
    proposals = spark.createDataFrame([(4, "u4", later), (5, "u5", later), (6, "u6", later), (7, "u6", later)], "event_id long, url string, kickoff timestamp")
    fixtures = spark.createDataFrame([(1, later), (2, later + timedelta(seconds=61)), (5, later), (6, later), (4, later)], "event_id long, kickoff timestamp")
    after, audit = state.transition_links(stored, proposals, spark.createDataFrame([(1,)], "event_id long"), fixtures, F.lit(T0))
    assert {r["event_id"]: r["state"] for r in after.collect()} == {1: "PROMOTED", 2: "DISCONNECTED", 3: "DISCONNECTED", 4: "DISCONNECTED", 5: "PROVISIONAL"}
    assert audit.count() == 4


def test_registry(spark):
    e = [("s", "K", "x", 1, 0.8, T0), ("s", "k", "x", 2, 0.8, T0), ("s", "amb", "x", 3, 0.9, T0), ("s", "amb", "y", 4, 0.9, T0), ("s", "weak", "z", 5, 0.92, T0), ("s", "sure", "z", 6, 0.93, T0)]
    df = spark.createDataFrame(e, "source string, alias string, entity string, event_id long, confidence double, observed_at timestamp").withColumn("name_key", E.name_key(F.col("alias")))
    got = {(r["name_key"], r["entity"]): r["status"] for r in rollups.classify_alias(rollups.alias_rollup(df)).collect()}
    assert got == {("k", "x"): "VERIFIED", ("amb", "x"): "AMBIGUOUS", ("amb", "y"): "AMBIGUOUS", ("weak", "z"): "CANDIDATE", ("sure", "z"): "VERIFIED"}
    master = rollups.classify_alias(rollups.alias_rollup(df))
    left = rollups.promote_survivors(master, spark.createDataFrame([("s", "amb", "y")], "source string, name_key string, entity string"))
    assert {r["status"] for r in left.where("name_key = 'amb'").collect()} == {"VERIFIED"}


def test_feeds_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", None), ("2", "x")], "id string, name string")
    feeds.write_feed(df, str(tmp_path / "f"), ["id", "name"])
    assert rows(feeds.read_feed(spark, str(tmp_path / "f"), ["id", "name", "more"])) == sorted([("1", None, None), ("2", "x", None)], key=str)
    assert feeds.read_feed(spark, str(tmp_path / "none"), ["id"]).count() == 0


def test_month_merge(spark, tmp_path):
    path = str(tmp_path / "m")
    feeds.merge_month(batch(spark, (1, 0, 1), (2, -60 * 24 * 40, 2)), path, ["event_id"], "captured_at")
    feeds.merge_month(batch(spark, (1, 5, 9), (3, 6, 3)), path, ["event_id"], "captured_at")
    assert sorted((r["event_id"], r["v"]) for r in spark.read.parquet(path).collect()) == [(1, 9), (2, 2), (3, 3)]


def test_stream_equals_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    data = [(1, 0, 10), (1, 8, 12), (2, 3, 20), (1, 8, 12), (2, 1, 19)]
    df = batch(spark, *data)
    df.repartition(3).write.parquet(source)
    stream = lambda: live.read_snapshots(spark, source, "event_id long, captured_at timestamp, v int")
    live.run_to_end(live.start_current(stream(), str(tmp_path / "cur"), str(tmp_path / "c1"), ["event_id"]))
    got = live.read_current(spark, str(tmp_path / "cur"), "event_id long, captured_at timestamp, v int", ["event_id"])
    assert {(r["event_id"], r["v"]) for r in got.collect()} == {(1, 12), (2, 20)}
    live.run_to_end(live.start_history(stream(), str(tmp_path / "hist"), str(tmp_path / "c2")))
    assert spark.read.parquet(str(tmp_path / "hist")).count() == 4


def test_stream_movement(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, k, T0 + timedelta(minutes=30 * k), 2.0 + k) for k in range(5)], "event_id long, snapshot_id long, captured_at timestamp, home double").coalesce(1).write.parquet(source)
    out = live.movement(live.read_snapshots(spark, source, "event_id long, snapshot_id long, captured_at timestamp, home double"))
    live.run_to_end(out.writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    assert {r["snapshot_id"]: r["change_1h"] for r in spark.read.parquet(str(tmp_path / "o")).collect()} == {0: None, 1: 1.0, 2: 2.0, 3: 2.0, 4: 2.0}


def test_gates(spark):
    from matchlake.operators import gates

    now = F.lit(T0)
    snap = spark.createDataFrame([(1, T0, T0 + timedelta(hours=1), "A", "B", 2.0, 3.0, 4.0), (2, T0, T0 + timedelta(hours=1), "A", "?", 2.0, 3.0, 4.0), (3, T0, T0 + timedelta(hours=31), "A", "B", 2.0, 3.0, 4.0), (4, T0, T0, "A", "B", None, 3.0, 4.0)], "event_id long, fetched_at timestamp, kickoff timestamp, home string, away string, home_odds double, draw_odds double, away_odds double")
    ok, missing = gates.target_gate(snap, spark.createDataFrame([("A", "a"), ("B", "b")], "name string, target_name string"), now)
    assert [r["event_id"] for r in ok.collect()] == [1] and rows(missing) == [(2, "?")]
    old = snap.withColumn("fetched_at", F.lit(T0 - timedelta(minutes=121)))
    assert gates.snapshot_gate(old, snap.where("event_id = 1"), now).count() == 1 and gates.snapshot_gate(snap, snap.limit(0), now).count() == 4
    board = spark.createDataFrame([("s1", "a", "b", T0 - timedelta(minutes=140), False, False, None), ("s2", "a", "b", T0 - timedelta(minutes=141), False, False, None), ("s3", "a", "b", T0 + timedelta(hours=1), False, False, True), ("s4", "a", "b", T0, True, False, None), (None, "a", "b", T0, False, False, True)], "source_id string, home string, away string, kickoff timestamp, cancelled boolean, finished boolean, live boolean")
    assert {r["source_id"] for r in gates.provider_targets(board, now).collect()} == {"s1", "s3"}


def test_rate_limited_evidence(spark):
    from matchlake.operators import identity

    obs = spark.createDataFrame([(1, "s", T0 + timedelta(seconds=s)) for s in (0, 59, 60, 118, 121)], "event_id long, source string, observed_at timestamp")
    assert [(r["n_accepted"], r["last_accepted"]) for r in identity.rate_limited(obs).collect()] == [(3, T0 + timedelta(seconds=121))]


def test_candidates_promote_unless_claimed(spark):
    from matchlake.operators import identity

    cols = "event_id long, source string, source_id string"
    obs = spark.createDataFrame([(1, "s", "a", 0.96)] * 3 + [(2, "s", "b", 0.96)] * 3 + [(3, "s", "c", 0.94)] * 3, cols + ", confidence double")
    old = spark.createDataFrame([(4, "s", "d", 9, 0.99, "REJECTED")], cols + ", n long, low double, status string")
    mapped = spark.createDataFrame([(9, "s", "b")], cols)
    got, after = identity.promote_candidates(obs, old, mapped)
    assert {r["event_id"]: r["status"] for r in got.collect()} == {1: "VERIFIED", 2: "CANDIDATE", 3: "CANDIDATE", 4: "REJECTED"}
    assert rows(after) == [(1, "s", "a"), (9, "s", "b")]


def test_maintenance_order(spark):
    from matchlake.operators import identity

    e = [("s", "k", "x", 1, 0.95), ("s", "k", "y", 2, 0.95), ("t", "m", "z", 3, 0.80)]
    ev = spark.createDataFrame([(*r, T0, r[1]) for r in e], "source string, name_key string, entity string, event_id long, confidence double, observed_at timestamp, alias string")
    stored = spark.createDataFrame([("t", "m", "z", "VERIFIED")], "source string, name_key string, entity string, status string")
    quarantine = spark.createDataFrame([("s", "k", "y")], "source string, name_key string, entity string")
    master, violations, health = identity.maintain(ev, stored, quarantine, quarantine)
    assert {(r["name_key"], r["entity"]): r["status"] for r in master.collect()} == {("k", "x"): "VERIFIED", ("m", "z"): "VERIFIED"}
    assert violations.count() == 0 and health.first()["state"] == "OK"


def test_payloads(spark):
    board = '{"leagues":[{"name":"L","matches":[{"id":"7","home":{"name":"a","score":"1"},"away":{"name":"b","score":""},"status":{"utcTime":"2026-01-01T12:00:00Z","started":true,"finished":false}}]}]}'
    got = feeds.flatten_board(spark.createDataFrame([(T0, board), (T0 - timedelta(hours=1), board.replace('"a"', '"old"')), (T0, "no json")], "captured_at timestamp, payload string")).collect()
    assert [(r["source_id"], r["home"], r["home_goals"], r["away_goals"], r["live"], r["kickoff"]) for r in got] == [("7", "a", 1, None, True, T0)]
    stats = '[{"period":"ALL","groups":[{"name":"g","items":[{"title":"Ball possession","home":"60%","away":"40%"},{"title":"Ball  Possession","home":"60%","away":"40%"}]}]}]'
    assert [r["key"] for r in feeds.flatten_team_stats(spark.createDataFrame([(1, stats)], "event_id long, payload string")).collect()] == ["ball_possession"]
    new = '{"home":{"starters":[{"id":"1","name":"x"}],"subs":[{"id":"2","name":"y"}]},"away":{"players":[{"id":"3","name":"z","isStarter":true}]}}'
    assert rows(feeds.lineups(spark.createDataFrame([(1, new)], "event_id long, payload string")).select("side", "id", "starter")) == [("A", "3", True), ("H", "1", True), ("H", "2", False)]
    page = spark.createDataFrame([(1, "<p>noise 12%</p><h2>Model</h2> home 45% draw 30% away 25% end 9%")], "page_id long, html string")
    assert feeds.sections(page, "Model", "end").first()["triplet"] == [45.0, 30.0, 25.0]
    listing = spark.createDataFrame([(1, "<p>A 55% 2-1</p><p>B</p>")], "page_id long, html string")
    assert rows(feeds.extract_listing(listing).select("pos", "percent", "home_goals")) == [(0, 55.0, 2), (1, None, None)]


def test_results_from_text(spark):
    lines = spark.createDataFrame([("2024-01-05 Team A 2x1 Team B [aet]",), ("2024-01-05 Team A ? Team B",), (None,)], "text string")
    assert [tuple(r)[1:] for r in feeds.results_from_text(lines).collect()] == [("Team A", 2, 1, "Team B")]
