"""Forecasts and their evaluation: decayed team form, market movement, decisions, scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.functions import exprs as E
from matchlake.operators import links, rollups


def _combined(rates: Sequence[DataFrame]) -> DataFrame:
    """The rates of several histories of the same teams as those of all their games: weighted means, and sums of games and weights."""
    x = rates[0]
    for r in rates[1:]:
        x = x.unionByName(r)
    mean = lambda c, w: F.sum(F.col(c) * F.col(w)) / F.sum(F.when(F.col(c).isNotNull() & (F.col(w) > 0), F.col(w)))
    return x.groupBy("event_id", "side").agg(mean("gf", "weight").alias("gf"), mean("ga", "weight").alias("ga"), F.sum("n").alias("n"), F.sum("weight").alias("weight"), mean("vgf", "vw").alias("vgf"), mean("vga", "vw").alias("vga"), F.sum("vn").alias("vn"), F.sum("vw").alias("vw"))


def _form_forecast(fixtures: DataFrame, x: DataFrame, min_games: int, min_weight: float) -> DataFrame:
    """event_id, quality, h, d, a from both sides' rates."""
    x = x.withColumn("f", E.blend(F.col("gf"), F.col("vgf"), F.col("vn"), F.col("vw"))).withColumn("c", E.blend(F.col("ga"), F.col("vga"), F.col("vn"), F.col("vw")))
    enough = (F.col("n") >= min_games) & (F.col("weight") >= min_weight)
    of = lambda s, c: F.max(F.when(F.col("side") == s, F.col(c)))
    m = x.withColumn("ok", enough).groupBy("event_id").agg(of("H", "f").alias("hf"), of("H", "c").alias("hc"), of("A", "f").alias("af"), of("A", "c").alias("ac"), (F.count_if("ok") == 2).alias("ok"))
    m = fixtures.select("event_id").join(m, "event_id", "left").withColumn("g", E.expected_goals(F.col("hf"), F.col("hc"), F.col("af"), F.col("ac")))
    p = m.withColumn("p", F.when(F.col("ok"), E.poisson_hda(F.col("g.lh"), F.col("g.la"))))
    quality = F.when(F.col("ok"), "OK").when(F.col("ok").isNull(), "NO_HISTORY").otherwise("THIN_HISTORY")
    # Through inline, so that a filter on a probability does not compute the score grid once more.
    p = p.select(F.inline(F.array(F.struct("event_id", quality.alias("quality"), "p"))))
    return p.select("event_id", "quality", *[F.col(f"p.{c}").alias(c) for c in "hda"])


def team_form_model(fixtures: DataFrame, results: DataFrame, lookback_days: int = 540, min_games: int = 8, min_weight: float = 3.0) -> DataFrame:
    """event_id, quality, h, d, a: independent Poisson scores from decayed, venue-blended goal rates; null probabilities below the gates.

    Both sides' rates and those of their venue come from running sums of the teams' games, so history is shuffled once and never joined.
    """
    return _form_forecast(fixtures, links.history_rates(fixtures, links.to_team_rows(results), lookback_days), min_games, min_weight)


def team_form_with_archive(
    fixtures: DataFrame, results: DataFrame, archive: DataFrame, names: DataFrame, in_scope: Column, lookback_days: int = 540, archive_days: int = 730, min_games: int = 8, min_weight: float = 3.0
) -> DataFrame:
    """event_id, quality, h, d, a, source, external_home_games, external_away_games, external_latest: team form with a denser outside archive behind it.

    Fixtures in scope whose teams the archive knows both take its games (archive: home, away, kickoff, home_goals, away_goals, neutral; names: name, team) of archive_days, and own results only from
    after the archive's last game, so nothing counts twice; games on neutral ground count for no venue. Other fixtures take own results alone (source OWN). Both histories are running sums
    per team, combined by weight.
    """
    known = names.groupBy(E.fold_name(F.col("name")).alias("k")).agg(F.min("team").alias("team"))
    id_of = lambda s: known.select(F.col("k").alias(f"_{s}"), F.col("team").alias(f"{s}_id"))
    games = archive.where("kickoff IS NOT NULL AND home_goals IS NOT NULL AND away_goals IS NOT NULL").withColumn("_home", E.fold_name(F.col("home"))).withColumn("_away", E.fold_name(F.col("away")))
    latest = games.agg(F.max("kickoff").alias("latest"))  # one row
    played = games.select(F.col("_home").alias("k")).union(games.select("_away")).distinct()
    teams = known.join(played, "k", "left_semi").select("team", F.lit(True).alias("_known")).distinct()
    side = lambda s: teams.withColumnsRenamed({"team": f"{s}_id", "_known": f"_{s}"})
    f = fixtures.withColumn("_in", F.coalesce(in_scope, F.lit(False))).join(side("home"), "home_id", "left").join(side("away"), "away_id", "left")
    f = f.withColumn("_in", F.col("_in") & F.coalesce(F.col("_home") & F.col("_away"), F.lit(False))).drop("_home", "_away")
    inside, outside = f.where("_in"), f.where("NOT _in")
    games = games.join(id_of("home"), "_home", "left").join(id_of("away"), "_away", "left").withColumn("event_id", F.lit(None).cast("bigint")).withColumn("tournament", F.lit(None).cast("string"))
    neutral = F.coalesce(F.col("neutral"), F.lit(False))
    out_of = lambda d, s, team, mine, its: d.select("event_id", "kickoff", "tournament", F.when(neutral, "N").otherwise(s).alias("side"), F.col(team).alias("team"), F.col(mine).alias("gf"), F.col(its).alias("ga")).where("team IS NOT NULL")
    outer = out_of(games, "H", "home_id", "home_goals", "away_goals").union(out_of(games, "A", "away_id", "away_goals", "home_goals"))
    recent = results.join(F.broadcast(latest)).where(F.col("latest").isNull() | (F.col("kickoff") > F.col("latest"))).drop("latest")
    external = links.history_rates(inside, outer, archive_days)
    rates = _combined([external, links.history_rates(inside, links.to_team_rows(recent), lookback_days), links.history_rates(outside, links.to_team_rows(results), lookback_days)])
    count = lambda s: F.coalesce(F.max(F.when(F.col("side") == s, F.col("n"))), F.lit(0))
    counts = external.groupBy("event_id").agg(count("H").alias("_h"), count("A").alias("_a"))
    p = _form_forecast(fixtures, rates, min_games, min_weight).join(f.select("event_id", "_in"), "event_id").join(counts, "event_id", "left").join(F.broadcast(latest))
    n = lambda c: F.when(F.col("_in"), F.coalesce(c, F.lit(0))).otherwise(0)
    return p.select("event_id", "quality", "h", "d", "a", F.when(F.col("_in"), "ARCHIVE_AND_RECENT").otherwise("OWN").alias("source"), n("_h").alias("external_home_games"), n("_a").alias("external_away_games"), F.when(F.col("_in"), F.to_date("latest")).alias("external_latest"))


def outcome(home_goals: Column, away_goals: Column) -> Column:
    return F.when(home_goals > away_goals, "H").when(home_goals < away_goals, "A").otherwise("D")


def evaluate(predictions: DataFrame, results: DataFrame, confirmed_only: bool = True) -> DataFrame:
    """model, event_id and metrics for predictions (model, event_id, h, d, a) of settled events."""
    r = results.where("confirmed") if confirmed_only else results
    x = predictions.join(r.select("event_id", outcome(F.col("home_goals"), F.col("away_goals")).alias("outcome")), "event_id")
    cols = [F.col(c) for c in ("h", "d", "a", "outcome")]
    return x.select("model", "event_id", "outcome", E.rps(*cols).alias("rps"), E.brier(*cols).alias("brier"), E.logloss(*cols).alias("logloss"))


def market_probabilities(odds: DataFrame) -> DataFrame:
    return odds.withColumn("p", E.devig(F.col("home"), F.col("draw"), F.col("away"))).select("event_id", "p.h", "p.d", "p.a")


def odds_movement(history: DataFrame, now: Column) -> DataFrame:
    """Per event: changes of the no-vig probabilities since a day, two hours and an hour ago, strongest side, range of a day, and the signal.

    Nearest points in time come from conditional aggregates over one pass of the history.
    """
    h = history.withColumn("p", E.devig(F.col("home"), F.col("draw"), F.col("away"))).where("p IS NOT NULL")
    h = h.where(F.col("captured_at") <= now)
    back = {"d24": (86_400, 10_800), "d2": (7_200, 4_500), "d1": (3_600, 2_400)}
    age = F.unix_seconds(now) - F.unix_seconds("captured_at")

    def near(seconds: int, tolerance: int) -> Column:
        gap = F.abs(age - seconds)
        return F.min(F.when(gap <= tolerance, F.struct(gap.alias("g"), F.col("captured_at"), F.col("snapshot_id"), F.col("p"))))["p"]

    day = age <= 86_400
    last = F.max(F.struct("captured_at", "snapshot_id", "p"))["p"]
    g = h.groupBy("event_id").agg(
        last.alias("p"), *[near(*b).alias(n) for n, b in back.items()], F.count_if(day).alias("points"), *[F.when(F.count_if(day) >= 2, F.max(F.when(day, F.col(f"p.{c}"))) - F.min(F.when(day, F.col(f"p.{c}")))).alias(f"v{c}") for c in "hda"]
    )
    sides = F.array(*[F.struct(F.lit(c.upper()).alias("side"), *[(F.col(f"p.{c}") - F.col(f"{n}.{c}")).alias(n) for n in back], F.col(f"v{c}").alias("v")) for c in "hda"])
    move = lambda s: F.greatest(*[F.coalesce(F.abs(s[n]), F.lit(0.0)) for n in back])
    top = F.array_max(F.transform(sides, lambda s: F.struct(move(s).alias("m"), s["side"].alias("side"), s.alias("s"))))
    g = g.withColumn("top", top).select("event_id", "points", F.col("top.side").alias("side"), *[F.col(f"top.s.{n}").alias(n) for n in back], F.greatest("vh", "vd", "va").alias("volatility"))
    steam = lambda n, k, label: [(F.col(n) >= k, f"{label} STEAM"), (F.col(n) <= -k, f"{label} DRIFT")]
    rules = [((F.signum("d24") * F.signum("d1") < 0) & (F.abs("d24") >= 0.02) & (F.abs("d1") >= 0.02), "REVERSAL"), *steam("d1", 0.02, "1H"), *steam("d2", 0.03, "2H"), *steam("d24", 0.05, "24H"), (F.col("volatility") >= 0.08, "HIGH VOLATILITY"), (F.col("points") < 2, "COLLECTING")]
    signal = F.coalesce(*[F.when(c, F.lit(s)) for c, s in rules], F.lit("STABLE"))
    return g.withColumn("signal", signal)


def decide(evidence: DataFrame, odds: DataFrame, enabled: Sequence[str], calibrated: bool = True, threshold: float = 0.0) -> DataFrame:
    """Ensemble of the enabled sources against the prices: best edge, its side and a state."""
    e = rollups.ensemble(evidence, enabled).join(odds, "event_id")
    edges = [E.edge(F.col(o), F.col(p)) for o, p in (("home", "h"), ("draw", "d"), ("away", "a"))]
    best = F.greatest(*edges)
    side = F.when(edges[0] == best, "H").when(edges[1] == best, "D").when(edges[2] == best, "A")
    state = F.when(~F.lit(calibrated), "CALIBRATION_PENDING").when(best > threshold, "CANDIDATE_POSITIVE_EV").otherwise("NO_POSITIVE_EV")
    return e.select("event_id", "n", "sources", best.alias("edge"), side.alias("side"), state.alias("state"))


def validation_score(predictions: DataFrame, odds: DataFrame, results: DataFrame) -> DataFrame:
    """Confirmed events only: pick, whether it was right, best edge (-999 if unknown), bet flag and what the bet returned."""
    x = evaluate(predictions, results).drop("outcome").join(predictions, ["model", "event_id"])
    x = x.join(results.select("event_id", outcome(F.col("home_goals"), F.col("away_goals")).alias("outcome")), "event_id").join(odds, "event_id", "left")
    edges = [F.coalesce(E.edge(F.col(o), F.col(p)), F.lit(-999.0)) for o, p in (("home", "h"), ("draw", "d"), ("away", "a"))]
    best = F.greatest(*edges)
    side = F.when(edges[0] == best, "H").when(edges[1] == best, "D").otherwise("A")
    price = F.when(side == "H", F.col("home")).when(side == "D", F.col("draw")).otherwise(F.col("away"))
    x = x.withColumn("pick", E.argmax_hda(F.col("h"), F.col("d"), F.col("a"))).withColumn("best_edge", best).withColumn("bet_side", side).withColumn("bet", best > 0)
    profit = F.when(F.col("bet"), F.when(F.col("bet_side") == F.col("outcome"), price - 1).otherwise(-1.0))
    return x.select("model", "event_id", "rps", "brier", "logloss", "pick", (F.col("pick") == F.col("outcome")).alias("correct"), "best_edge", "bet", profit.alias("profit"))


def validation_summary(scores: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source (model) of the list: sample, means, accuracy, bets, return on stakes; sources without a sample stay."""
    g = scores.groupBy("model").agg(F.count("*").alias("n"), *[F.avg(c).alias(c) for c in ("rps", "brier", "logloss")], F.avg(F.col("correct").cast("double")).alias("accuracy"), F.count_if("bet").alias("bets"), F.avg("profit").alias("roi"))
    return sources.join(g, "model", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def edge_board(wide: DataFrame, now: Column) -> DataFrame:
    """Phase of each event and whether two sources agree. wide: event_id, kickoff, ended, in_play, pick_a, pick_b."""
    phase = F.when(F.col("ended"), "ENDED").when(F.col("in_play"), "LIVE").when(F.col("kickoff") <= now, "CLOSED").otherwise("PRE")
    agree = F.when(F.col("pick_a").isNull() | F.col("pick_b").isNull(), F.lit(None)).when(F.col("pick_a") == F.col("pick_b"), "AGREE").otherwise("CONFLICT")
    return wide.select("event_id", phase.alias("phase"), agree.alias("agreement"))


def form_of(last: Column) -> list[Column]:
    """games, wins, draws, losses, gf, ga and text of an array of games (gf, ga), newest first; nulls for a null one."""
    results = F.transform(last, lambda g: F.when(g["gf"] > g["ga"], "W").when(g["gf"] < g["ga"], "L").otherwise("D"))
    n = lambda r: F.when(last.isNotNull(), F.size(F.filter(results, lambda x: x == r)).cast("long"))
    total = lambda c: F.aggregate(last, F.lit(0).cast("long"), lambda t, g: t + g[c])
    return [F.when(last.isNotNull(), F.size(last).cast("long")).alias("games"), n("W").alias("wins"), n("D").alias("draws"), n("L").alias("losses"), total("gf").alias("gf"), total("ga").alias("ga"), F.array_join(results, "").alias("text")]


def h2h_summary(fixtures: DataFrame, results: DataFrame, n: int = 5) -> DataFrame:
    """The last n earlier meetings from the home side's view; NO_PREVIOUS, PARTIAL below n, or OK."""
    pair = [F.least("home_id", "away_id").alias("lo"), F.greatest("home_id", "away_id").alias("hi")]
    past = results.select(*pair, "kickoff", F.col("event_id").alias("past_id"), F.col("home_id").alias("past_home"), "home_goals", "away_goals")
    x = links.last_before(fixtures.select("event_id", "home_id", "kickoff", *pair), past, ["lo", "hi"], "kickoff", "past_id", n, ["past_home", "home_goals", "away_goals"])
    same = lambda g: g["past_home"] == F.col("home_id")
    goals = lambda mine, g: F.when(same(g) == F.lit(mine), g["home_goals"]).otherwise(g["away_goals"]).cast("long")
    x = x.withColumn("last", F.transform("last", lambda g: F.struct(goals(True, g).alias("gf"), goals(False, g).alias("ga"))))
    quality = F.when(F.col("games").isNull(), "NO_PREVIOUS").when(F.col("games") < n, "PARTIAL").otherwise("OK")
    return x.select("event_id", *form_of(F.col("last"))).withColumnRenamed("text", "last").withColumn("quality", quality)


def team_form_summary(fixtures: DataFrame, results: DataFrame, n: int = 6) -> DataFrame:
    """Each side's last n games before kickoff: text, counts, goals."""
    asked = links.to_team_rows(fixtures.withColumns({c: F.lit(None).cast("bigint") for c in ("home_goals", "away_goals") if c not in fixtures.columns})).select("event_id", "side", "team", "kickoff")
    past = links.to_team_rows(results).select("team", "kickoff", F.col("event_id").alias("past_id"), F.col("gf").cast("long").alias("gf"), F.col("ga").cast("long").alias("ga"))
    x = links.last_before(asked, past, ["team"], "kickoff", "past_id", n, ["gf", "ga"]).where("last IS NOT NULL")
    return x.select("event_id", "side", *form_of(F.col("last"))).withColumnRenamed("text", "form").drop("wins", "draws", "losses")


def expected_actual(live: DataFrame, scenario: DataFrame) -> DataFrame:
    """Signed thresholds on live metrics give a control score; against the expected side it confirms or contradicts, from two metrics on.

    live: event_id, minute and pairs <metric>_home, <metric>_away; scenario: event_id, segment, expected (H, A or null).
    """
    #: Metric, weight, threshold.
    rules = (("xg", 2, 0.25), ("shots", 1, 3.0), ("on_target", 1, 2.0), ("possession", 1, 8.0), ("box", 1, 5.0), ("chances", 1, 1.0), ("corners", 1, 2.0))
    used = [r for r in rules if f"{r[0]}_home" in live.columns]
    gap = lambda m: F.col(f"{m}_home") - F.col(f"{m}_away")
    score = sum((F.when(gap(m) >= k, w).when(gap(m) <= -k, -w).otherwise(0) for m, w, k in used), F.lit(0))
    n = sum((F.when(gap(m).isNotNull(), 1).otherwise(0) for m, _, _ in used), F.lit(0))
    x = live.withColumn("segment", E.segment(F.col("minute"))).join(scenario, ["event_id", "segment"], "left").withColumn("control", score).withColumn("metrics", n)
    actual = F.when(F.col("control") >= 2, "H").when(F.col("control") <= -2, "A")
    status = F.when(F.col("metrics") < 2, "WAIT").when(F.col("expected").isNull() | actual.isNull(), "WAIT").when(actual == F.col("expected"), "CONFIRM").otherwise("CONTRADICT")
    return x.select("event_id", "segment", "control", "metrics", actual.alias("actual"), "expected", status.alias("status"))


def data_health(board: DataFrame, odds: DataFrame, predictions: DataFrame, models: DataFrame, now: Column) -> DataFrame:
    """Per event the evidence channels it has, codes of what is missing, the first of them, and a status."""
    has = lambda df, c: df.select("event_id", F.lit(True).alias(c)).distinct()
    x = board.join(has(odds, "o"), "event_id", "left").join(has(predictions, "p"), "event_id", "left").join(has(models, "m"), "event_id", "left")
    x = x.withColumn("codes", E.codes({"NO_ODDS": F.col("o").isNull(), "NO_PREDICTION": F.col("p").isNull(), "NO_MODEL": F.col("m").isNull(), "PAST_KICKOFF": F.col("kickoff") <= now}))
    channels = sum((F.when(F.col(c), 1).otherwise(0) for c in "opm"), F.lit(0))
    status = F.when(channels == 3, "OK").when(channels == 0, "FAIL").otherwise("WARN")
    return x.select("event_id", channels.alias("channels"), F.array_join("codes", ",").alias("codes"), F.get("codes", F.lit(0)).alias("primary_reason"), status.alias("status"))


def repair_queue(health: DataFrame) -> DataFrame:
    """Priority and action for events that are not OK."""
    action = F.when(F.col("primary_reason") == "NO_ODDS", "CAPTURE_ODDS").when(F.col("primary_reason") == "NO_PREDICTION", "LINK_SOURCE").when(F.col("primary_reason") == "NO_MODEL", "FIT_MODEL").otherwise("NONE")
    priority = F.when(F.col("status") == "FAIL", 1).when(F.col("primary_reason") == "NO_ODDS", 2).otherwise(3)
    return health.where("status <> 'OK'").select("event_id", priority.alias("priority"), action.alias("action"))


def system_health(expected: DataFrame, health: DataFrame, now: Column) -> DataFrame:
    """expected (source, max_age_minutes) against the newest observation: MISSING, STALE or OK."""
    x = expected.join(health.groupBy("source").agg(F.max("observed_at").alias("observed_at")), "source", "left")
    age = (F.unix_seconds(now) - F.unix_seconds("observed_at")) / 60
    return x.select("source", F.when(age.isNull(), "MISSING").when(age > F.col("max_age_minutes"), "STALE").otherwise("OK").alias("state"), F.floor(age).alias("age_minutes"))


def pi_ratings(results: DataFrame, rate: float = 0.035, cross: float = 0.7, base: float = 10.0, scale: float = 3.0) -> DataFrame:
    """Sequential home and away ratings per tournament, folded in time order (published pi-rating form).

    A task reads its tournaments' games as a sorted stream of batches and holds the ratings of the current tournament's teams only.
    """
    import math

    import pandas as pd

    def fold(batches):
        rating: dict[tuple[int, str], float] = {}
        league = None
        expected = lambda r: math.copysign(base ** (abs(r) / scale) - 1, r)
        for games in batches:
            out = []
            for g in games.itertuples():
                if g.tournament != league:
                    rating, league = {}, g.tournament
                hh, ha, ah, aa = (rating.get(k, 0.0) for k in ((g.home_id, "H"), (g.home_id, "A"), (g.away_id, "H"), (g.away_id, "A")))
                gap = expected(hh) - expected(aa)
                out.append((g.event_id, hh, aa, gap))
                error = (g.home_goals - g.away_goals) - gap
                step = math.copysign(scale * math.log10(1 + abs(error)), error)
                rating[g.home_id, "H"], rating[g.away_id, "A"] = hh + step * rate, aa - step * rate
                rating[g.home_id, "A"], rating[g.away_id, "H"] = ha + step * rate * cross, ah - step * rate * cross
            yield pd.DataFrame(out, columns=["event_id", "home_rating", "away_rating", "expected_gap"])

    games = results.select("tournament", "kickoff", "event_id", "home_id", "away_id", "home_goals", "away_goals").repartition("tournament")
    games = games.sortWithinPartitions("tournament", F.asc_nulls_last("kickoff"), F.asc_nulls_last("event_id"))
    return games.mapInPandas(fold, "event_id bigint, home_rating double, away_rating double, expected_gap double")


def gap_probabilities(ratings: DataFrame, results: DataFrame, now: Column, width: float = 0.25, most: float = 3.0) -> DataFrame:
    """Home, draw and away probabilities of the games from now on: how games of a like expected gap ended before.

    Gaps are held within +-most and counted in bins of width; each outcome has one game more than it had, so a bin without games gives a third to each.
    """
    edge = F.greatest(F.lit(-most), F.least(F.lit(most), F.col("expected_gap")))
    x = ratings.select("event_id", "expected_gap", F.floor(edge / width).alias("bin")).join(results.select("event_id", "kickoff", "home_goals", "away_goals"), "event_id")
    gap = F.col("home_goals") - F.col("away_goals")
    seen = x.where(F.col("kickoff") < now).groupBy("bin").agg(F.count_if(gap > 0).alias("nh"), F.count_if(gap == 0).alias("nd"), F.count_if(gap < 0).alias("na"))
    share = lambda c: (F.coalesce(F.col(c), F.lit(0)) + 1) / (sum((F.coalesce(F.col(k), F.lit(0)) for k in ("nh", "nd", "na")), F.lit(0)) + 3)
    return x.where(F.col("kickoff") >= now).join(seen, "bin", "left").select("event_id", "expected_gap", share("nh").alias("h"), share("nd").alias("d"), share("na").alias("a"))


def evidence_graph(fixtures: DataFrame, form: DataFrame, predictions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """nodes, edges, and per event the support for either side: form points and picks as directional evidence."""
    side = lambda s: form.where(F.col("side") == s).select("event_id", E.form_points(F.col("form")).alias(s))
    f = side("H").join(side("A"), "event_id", "outer").select("event_id", F.lit("FORM").alias("kind"), F.when(F.col("H") > F.col("A"), "H").when(F.col("A") > F.col("H"), "A").alias("direction"))
    p = predictions.select("event_id", F.col("source").alias("kind"), E.argmax_hda(F.col("home"), F.col("draw"), F.col("away")).alias("direction"))
    edges = f.unionByName(p).where("direction IS NOT NULL")
    nodes = fixtures.select(F.concat(F.lit("event:"), "event_id").alias("node"), F.lit("event").alias("type")).union(edges.select(F.concat(F.lit("source:"), "kind"), F.lit("source")).distinct())
    n = lambda d: F.count_if(F.col("direction") == d)
    why = edges.groupBy("event_id").agg(n("H").alias("home_support"), n("A").alias("away_support"), F.count("*").alias("n"))
    top, low = F.greatest("home_support", "away_support"), F.least("home_support", "away_support")
    why = why.withColumn("conflict", low > 0).withColumn("confidence", F.when(F.col("n") > 0, (top - low) / F.col("n")))
    return nodes, edges, why
