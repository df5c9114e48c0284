"""Boards over prices and models: movement alerts with their alignment, edges by market phase, and form summaries with venues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.functions import exprs as E
from matchlake.operators import links
from matchlake.plans import models

#: Seconds back, tolerance, and the change that counts as a move.
BACK = {"24": (86_400, 10_800, 0.05), "2": (7_200, 4_500, 0.03), "1": (3_600, 2_400, 0.02)}


def movement_board(history: DataFrame, targets: DataFrame, models: DataFrame, now: Column) -> DataFrame:
    """event_id, kickoff, captured_at, side, odds and move_24h, move_2h, move_1h, volatility, signal, alert_score, model_side, alignment: one row per target with prices.

    history: event_id, snapshot_id, captured_at, home, draw, away, match_confidence; targets: event_id, kickoff; models: event_id, model_side. The side is the one that moved or ranged most, home before draw before
    away; moves are of its no-vig probability since the snapshot nearest to that long ago. A latest snapshot whose match is less than .88 sure is a MATCH CHECK
    without an alert. The alignment says whether the latest move goes the model's way. Nearest points and ranges come from one aggregate over the history.
    """
    h = history.withColumn("p", E.devig(F.col("home"), F.col("draw"), F.col("away"))).where(F.col("captured_at") <= now)
    age = F.unix_seconds(now) - F.unix_seconds("captured_at")
    row = lambda: F.struct(*[F.col(f"p.{c}").alias(f"p{c}") for c in "hda"], *[F.col(o).alias(f"o{c}") for c, o in (("h", "home"), ("d", "draw"), ("a", "away"))])
    near = lambda s, t: F.min(F.when(F.abs(age - s) <= t, F.struct(F.abs(age - s).alias("g"), "captured_at", "snapshot_id", row().alias("r"))))["r"]
    day = age <= 86_400
    last = F.max(F.struct("captured_at", "snapshot_id", row().alias("r"), "match_confidence"))
    spread = lambda c: F.when(F.count(F.when(day, F.col(f"p.{c}"))) >= 2, F.max(F.when(day, F.col(f"p.{c}"))) - F.min(F.when(day, F.col(f"p.{c}"))))
    g = h.groupBy("event_id").agg(last.alias("last"), *[near(s, t).alias(f"b{n}") for n, (s, t, _) in BACK.items()], *[spread(c).alias(f"v{c}") for c in "hda"])
    move = lambda c, n: F.col(f"last.r.p{c}") - F.col(f"b{n}.p{c}")
    sides = []
    for order, c in enumerate("hda"):
        most = F.greatest(*[F.coalesce(F.abs(move(c, n)), F.lit(0.0)) for n in BACK], F.coalesce(F.col(f"v{c}"), F.lit(0.0)))
        sides.append(F.struct(most.alias("most"), F.lit(-order).alias("first"), F.lit(c.upper()).alias("side"), F.col(f"v{c}").alias("volatility"), F.col(f"last.r.o{c}").alias("odds"), *[move(c, n).alias(f"d{n}") for n in BACK]))
    x = g.select("event_id", "last.captured_at", "last.match_confidence", *[F.col(f"b{n}").isNotNull().alias(f"has{n}") for n in BACK], F.array_max(F.array(*sides)).alias("s")).select("*", "s.*").drop("s")
    d24, d2, d1, vol = F.col("d24"), F.col("d2"), F.col("d1"), F.col("volatility")
    turned = ((d2 * d1 < 0) & (F.abs(d2) >= 0.03) & (F.abs(d1) >= 0.02)) | ((d24 * d2 < 0) & (F.abs(d24) >= 0.03) & (F.abs(d2) >= 0.03))
    rules = [(turned, "REVERSAL")]
    for n in ("1", "2", "24"):
        rules += [(F.col(f"d{n}") >= BACK[n][2], f"{n}H STEAM"), (F.col(f"d{n}") <= -BACK[n][2], f"{n}H DRIFT")]
    rules += [(vol >= 0.08, "HIGH VOLATILITY"), (~(F.col("has24") & F.col("has2") & F.col("has1")), "COLLECTING")]
    signal = F.lit("STABLE")
    for condition, name in reversed(rules):
        signal = F.when(condition, name).otherwise(signal)
    height = F.greatest(*[F.coalesce(F.abs(F.col(f"d{n}")) / BACK[n][2], F.lit(0.0)) for n in BACK], F.coalesce(vol / 0.08, F.lit(0.0)))
    unsure = F.coalesce("match_confidence", F.lit(0.0)) < 0.88
    x = x.withColumn("signal", signal).withColumn("alert_score", F.when(unsure | F.col("signal").isin("STABLE", "COLLECTING"), 0.0).otherwise(height)).withColumn("signal", F.when(unsure, "MATCH CHECK").otherwise(F.col("signal")))
    x = targets.select("event_id", "kickoff").join(x, "event_id").join(models.select("event_id", "model_side"), "event_id", "left")
    way, same = F.coalesce(d1, d2, d24), F.col("model_side") == F.col("side")
    alignment = F.when(F.col("model_side").isNull(), "NO MODEL").when(way.isNull(), "COLLECTING").when(way > 0, F.when(same, "YES").otherwise("NO")).when(same, "CONFLICT").otherwise("NEUTRAL")
    moves = [F.col(f"d{n}").alias(f"move_{n}h") for n in BACK]
    return x.select("event_id", "kickoff", "captured_at", "side", "odds", *moves, "volatility", "signal", "alert_score", "model_side", alignment.alias("alignment"))


def market_board(wide: DataFrame, now: Column) -> DataFrame:
    """Phase, edges, best bet and consensus of each event.

    wide: event_id, kickoff, status, in_play, home, draw, away (prices), source_h, source_d, source_a (percent), source_pick (1, X, 2), modeled, dc_h, dc_d, dc_a, pi_h, pi_d, pi_a. The best edge is of the prices
    that have one. Without a modeled event there is no consensus, and without the source's three shares no edge status.
    """
    status = F.upper(F.coalesce("status", F.lit("")))
    phase = F.when(status.contains("ENDED") | (F.unix_seconds(now) >= F.unix_seconds("kickoff") + 9000), "ENDED").when(now < F.col("kickoff"), "PRE").when(F.coalesce("in_play", F.lit(False)) | status.contains("INPLAY"), "LIVE").otherwise("CLOSED")
    edges = [F.col(o) * F.col(f"source_{c}") / 100.0 - 1 for c, o in (("h", "home"), ("d", "draw"), ("a", "away"))]
    best = F.greatest(*edges)
    pick = lambda k: F.when(F.col("modeled"), E.argmax_hda(F.col(f"{k}_h"), F.col(f"{k}_d"), F.col(f"{k}_a")))
    x = wide.withColumns({"phase": phase, "best_edge": best, "dc_pick": pick("dc"), "pi_pick": pick("pi"), "source_side": F.when(F.col("source_pick") == "1", "H").when(F.col("source_pick") == "X", "D").when(F.col("source_pick") == "2", "A")})
    side = F.when(edges[0] == F.col("best_edge"), "H").when(edges[1] == F.col("best_edge"), "D").when(F.col("best_edge").isNotNull(), "A")
    x = x.withColumn("best_side", side)
    odds = F.when(F.col("best_side") == "H", F.col("home")).when(F.col("best_side") == "D", F.col("draw")).when(F.col("best_side") == "A", F.col("away"))
    whole = F.col("source_h").isNotNull() & F.col("source_d").isNotNull() & F.col("source_a").isNotNull()
    edge = F.when(~whole, "NO SOURCE MODEL").when(F.col("best_edge") > 0, "POSITIVE EDGE").otherwise("NO EDGE")
    none = ~F.coalesce("modeled", F.lit(False))
    source_dc = F.when(none, "MODEL_UNAVAILABLE").when(F.col("source_side").isNull(), "NO_SOURCE").when(F.col("source_side") == F.col("dc_pick"), "AGREE").otherwise("CONFLICT")
    consensus = F.when(none, "LOCAL MODEL UNAVAILABLE").when(F.col("dc_pick") != F.col("pi_pick"), "DC/PI CONFLICT").when(F.col("source_side") == F.col("dc_pick"), "ALL AGREE").otherwise("MODEL CONFLICT")
    return x.select("event_id", "phase", *[e.alias(f"edge_{c}") for c, e in zip("hda", edges, strict=True)], "best_edge", "best_side", odds.alias("best_odds"), edge.alias("edge_status"), "dc_pick", "pi_pick", source_dc.alias("source_dc"), consensus.alias("consensus"))


def _summary(last: Column) -> Column:
    """form, games, w, d, l and goals a game of an array of games (gf, ga), newest first; no games for null."""
    results = F.transform(last, lambda g: F.when(g["gf"] > g["ga"], "W").when(g["gf"] < g["ga"], "L").otherwise("D"))
    n = lambda r: F.coalesce(F.size(F.filter(results, lambda x: x == r)), F.lit(0))
    total = lambda c: F.aggregate(last, F.lit(0).cast("double"), lambda t, g: t + g[c])
    games = F.when(last.isNotNull(), F.size(last)).otherwise(0)
    mean = lambda c: F.when(games > 0, F.round(total(c) / games, 2))
    return F.struct(F.coalesce(F.array_join(results, ""), F.lit("")).alias("form"), games.alias("games"), n("W").alias("w"), n("D").alias("d"), n("L").alias("l"), mean("gf").alias("gf_avg"), mean("ga").alias("ga_avg"))


def form_board(fixtures: DataFrame, results: DataFrame, override: DataFrame | None = None, n: int = 6) -> DataFrame:
    """One row per fixture: form, games, w, d, l, gf_avg, ga_avg of both sides' last n games before it, their form at their own venue, texts, source and quality.

    override (event_id, status OK or PARTIAL, and for either side form6, last6_w, last6_d, last6_l, gf_avg, ga_avg) wins field by field where it has one; its three counts count together only.
    """
    sides = links.to_team_rows(fixtures.withColumns({c: F.lit(None).cast("bigint") for c in ("home_goals", "away_goals") if c not in fixtures.columns})).select("event_id", "side", "team", "kickoff")
    past = links.to_team_rows(results).select("team", "side", "kickoff", F.col("event_id").alias("past_id"), "gf", "ga")
    every = links.last_before(sides, past.drop("side"), ["team"], "kickoff", "past_id", n, ["gf", "ga"]).withColumnRenamed("last", "every")
    venue = links.last_before(every.select("event_id", "side", "team", "kickoff", "every"), past, ["team", "side"], "kickoff", "past_id", n, ["gf", "ga"])
    x = venue.select("event_id", "side", _summary(F.col("every")).alias("s"), _summary(F.col("last"))["form"].alias("venue_form"))
    of = lambda s, c: F.max(F.when(F.col("side") == s, F.col(c)))
    x = x.groupBy("event_id").agg(*[of(s, c).alias(f"{name}_{c}") for s, name in (("H", "home"), ("A", "away")) for c in ("s", "venue_form")])
    x = fixtures.select("event_id").join(x, "event_id", "left")
    fields = ("form6", "last6_w", "last6_d", "last6_l", "gf_avg", "ga_avg")
    columns = [f"{s}_{f}" for s in ("home", "away") for f in fields]
    if override is not None:
        o = override.where(F.col("status").isin("OK", "PARTIAL")).groupBy("event_id").agg(F.max(F.struct("status", *columns)).alias("o"))
        x = x.join(o, "event_id", "left")
    else:
        kinds = {"form6": "string", "last6_w": "int", "last6_d": "int", "last6_l": "int", "gf_avg": "double", "ga_avg": "double"}
        x = x.withColumn("o", F.lit(None).cast("struct<status: string, " + ", ".join(f"{c}: {kinds[c.split('_', 1)[1]]}" for c in columns) + ">"))
    out = []
    for s in ("home", "away"):
        own, over = lambda c, s=s: F.col(f"{s}_s.{c}"), lambda c, s=s: F.col(f"o.{s}_{c}")
        counted = over("last6_w").isNotNull() & over("last6_d").isNotNull() & over("last6_l").isNotNull()
        three = {c: F.when(counted, over(f"last6_{c}")).otherwise(own(c)) for c in "wdl"}
        form, gf, ga = F.coalesce(F.nullif(over("form6"), F.lit("")), own("form")), F.coalesce(over("gf_avg"), own("gf_avg")), F.coalesce(over("ga_avg"), own("ga_avg"))
        games = F.when(counted, three["w"] + three["d"] + three["l"]).otherwise(own("games"))
        text = F.when(F.length(form) > 0, F.format_string("%s | %d-%d-%d | GF %.2f / GA %.2f", form, three["w"], three["d"], three["l"], gf, ga)).otherwise("NO RECENT GAMES")
        out += [form.alias(f"{s}_form"), games.alias(f"{s}_games"), *[c.alias(f"{s}_{k}") for k, c in three.items()], gf.alias(f"{s}_gf_avg"), ga.alias(f"{s}_ga_avg"), F.col(f"{s}_venue_form"), text.alias(f"{s}_text")]
    source = F.when(F.col("o").isNotNull(), "OVERRIDE_WITH_FALLBACK").otherwise("RESULTS")
    quality = F.when(F.col("o").isNotNull(), F.concat(F.lit("OVERRIDE_"), "o.status")).otherwise(F.concat_ws("/", F.concat(F.lit("RECENT:"), F.col("home_s.games")), F.col("away_s.games")))
    return x.select("event_id", *out, source.alias("source"), quality.alias("quality"))


#: Live metric, weight and the lead that counts.
CONTROL = (("xg", 2, 0.25), ("shots", 1, 3), ("sot", 1, 2), ("possession", 1, 8), ("box", 1, 5), ("big_chances", 1, 1), ("corners", 1, 2))


def live_control(live: DataFrame, scenario: DataFrame) -> DataFrame:
    """event_id, segment, expected, actual, score, n_metrics, status, reason: the side in control of a live event against the side expected in its segment.

    live: event_id, minute and pairs <metric>_home, <metric>_away of CONTROL (a missing pair counts for nothing); scenario: event_id, segment, expected (H, A, UNKNOWN or null), one row each.
    A score of 2 or more is control. CONFIRM or CONTRADICT only from minute 10 on, with three metrics and a side in control; else WAIT, and the reason says for what.
    """
    lead = {m: F.col(f"{m}_home") - F.col(f"{m}_away") for m, _, _ in CONTROL}
    score = sum((F.when(lead[m] >= k, w).when(lead[m] <= -k, -w).otherwise(0) for m, w, k in CONTROL), F.lit(0))
    n = sum((lead[m].isNotNull().cast("int") for m, _, _ in CONTROL), F.lit(0))
    x = live.select("event_id", "minute", E.segment(F.col("minute")).alias("segment"), score.alias("score"), n.alias("n_metrics")).join(scenario, ["event_id", "segment"], "left")
    x = x.withColumn("actual", F.when(F.col("score") >= 2, "H").when(F.col("score") <= -2, "A").otherwise("BALANCED"))
    steps = [(F.coalesce("expected", F.lit("UNKNOWN")) == "UNKNOWN", "WAIT", "NO_EXPECTED_CONTROL"), (F.coalesce("minute", F.lit(0)) < 10, "WAIT", "EARLY_MATCH"), (F.col("n_metrics") < 3, "WAIT", "INSUFFICIENT_LIVE_METRICS"),
             (F.col("actual") == "BALANCED", "WAIT", "LIVE_CONTROL_BALANCED"), (F.col("actual") == F.col("expected"), "CONFIRM", "LIVE_CONTROL_ALIGNS")]
    status, reason = F.lit("CONTRADICT"), F.lit("LIVE_CONTROL_OPPOSES")
    for condition, s, r in reversed(steps):
        status, reason = F.when(condition, s).otherwise(status), F.when(condition, r).otherwise(reason)
    return x.select("event_id", "segment", "expected", "actual", "score", "n_metrics", status.alias("status"), reason.alias("reason"))


def h2h_board(fixtures: DataFrame, results: DataFrame, coverage: DataFrame, overrides: Sequence[tuple[str, DataFrame]] = (), n: int = 5) -> DataFrame:
    """event_id, games, wins, draws, losses, gf, ga, avg_total, last, source, quality: the last n meetings of each fixture from its home side's view.

    Without meetings the quality says whether there are none in a whole history (coverage: team, status; both BOOTSTRAPPED) or the history is in part. Of the overrides (source, table of event_id,
    verified, games, wins, draws, losses, gf, ga, last), in their order, the first that is verified, has games, and whose results add up to them wins as a whole.
    """
    own = models.h2h_summary(fixtures, results, n).drop("quality")
    fields = ["games", "wins", "draws", "losses", "gf", "ga", "last"]
    x = fixtures.select("event_id", "home_id", "away_id").join(own.select("event_id", F.struct(*fields).alias("own")), "event_id", "left")
    ready = coverage.groupBy("team").agg(F.max(F.col("status") == "BOOTSTRAPPED").alias("ready"))
    for s in ("home", "away"):
        x = x.join(ready.withColumnsRenamed({"team": f"{s}_id", "ready": f"{s}_ready"}), f"{s}_id", "left")
    chosen, source = F.col("own"), F.lit("RESULTS")
    for name, df in reversed(list(overrides)):
        good = df.where(F.col("verified") & (F.col("games") > 0) & (F.col("wins") + F.col("draws") + F.col("losses") == F.col("games")))
        good = good.groupBy("event_id").agg(F.max(F.struct(*[F.col(f).cast(own.schema[f].dataType).alias(f) for f in fields])).alias(f"_{name}"))
        x = x.join(good, "event_id", "left")
        chosen, source = F.coalesce(F.col(f"_{name}"), chosen), F.when(F.col(f"_{name}").isNotNull(), name).otherwise(source)
    x = x.select("event_id", "home_ready", "away_ready", F.inline(F.array(F.struct(chosen.alias("c"), source.alias("source")))))
    games = F.coalesce("c.games", F.lit(0))
    quality = F.when(games > 0, F.when(F.col("source") == "RESULTS", "H2H_OK").otherwise("H2H_VERIFIED")).when(F.coalesce(F.col("home_ready") & F.col("away_ready"), F.lit(False)), "NO_PREVIOUS_H2H").otherwise("HISTORY_PARTIAL")
    count = [F.coalesce(F.col(f"c.{f}"), F.lit(0)).cast("long").alias(f) for f in fields[:-1]]
    return x.select("event_id", *count, F.when(games > 0, F.round((F.col("c.gf") + F.col("c.ga")) / games, 2)).alias("avg_total"), F.coalesce("c.last", F.lit("")).alias("last"), "source", quality.alias("quality"))
