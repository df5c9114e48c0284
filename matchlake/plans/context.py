"""Context around events: enrichment, scenarios, players, ratings, overrides, archives, boards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.functions import exprs as E
from matchlake.operators import likeness as K
from matchlake.operators import links, rollups, state
from matchlake.operators.lineage import settled


def enrich(fixture: DataFrame, sources: dict[str, DataFrame], key: str = "event_id", ts: str = "updated_at") -> DataFrame:
    """Fixtures with every source's columns (one row per key each) and the newest of all their times."""
    x, times = fixture, [F.col(ts)] if ts in fixture.columns else []
    for name, df in sources.items():
        x = x.join(df.select(key, *[F.col(c).alias(f"{name}_{c}") for c in df.columns if c != key]), key, "left")
        if ts in df.columns:
            times.append(F.col(f"{name}_{ts}"))
    return x.withColumn("data_updated_at", F.greatest(*times) if len(times) > 1 else (times or [F.lit(None).cast("timestamp")])[0])


def pivot_latest(narrow: DataFrame, specs: dict[str, tuple[str, str]], key: str = "event_id") -> DataFrame:
    """One wide row per key: for each column the value of (source, market), the greatest if several."""
    return narrow.groupBy(key).agg(*[F.max(F.when((F.col("source") == s) & (F.col("market") == m), F.col("value"))).alias(c) for c, (s, m) in specs.items()])


def expand_archive(wide: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Columns <source>_home, _draw and _away as rows, without those that miss any."""
    part = lambda s: F.struct(F.lit(s).alias("source"), *[F.col(f"{s}_{c}").alias(c) for c in ("home", "draw", "away")])
    return wide.select("event_id", "captured_at", F.inline(F.array(*[part(s) for s in sources]))).where("home IS NOT NULL AND draw IS NOT NULL AND away IS NOT NULL")


def observations(feeds: dict[str, DataFrame]) -> DataFrame:
    """Branches of feeds as one evidence shape: source, event_id, side, name, observed_at."""
    both = None
    for source, df in feeds.items():
        rows = df.select(F.lit(source).alias("source"), "event_id", "observed_at", F.inline(F.array(*[F.struct(F.lit(s).alias("side"), F.col(c).alias("name")) for s, c in (("H", "home"), ("A", "away"))])))
        both = rows if both is None else both.unionByName(rows)
    return both.where("name IS NOT NULL")


def canonical_events(fixtures: DataFrame, upcoming: DataFrame) -> DataFrame:
    return fixtures.select("event_id", "kickoff").union(upcoming.select("event_id", "kickoff")).distinct()


def capture_prematch(evidence: DataFrame, fixtures: DataFrame, base: DataFrame, now: Column) -> DataFrame:
    """Snapshots before kickoff only, newest per event, source and market; nothing changes after kickoff."""
    x = evidence.join(fixtures.select("event_id", "kickoff"), "event_id").where((F.col("captured_at") <= F.col("kickoff")) & (now <= F.col("kickoff"))).drop("kickoff")
    return state.merge_newest(base, x.select(*base.columns), ["event_id", "source", "market"], "captured_at")


def materialize_pending(upcoming: DataFrame, availability: DataFrame) -> DataFrame:
    """Availability with a PENDING row, never checked, for each new target."""
    new = upcoming.select("event_id").distinct().join(availability.select("event_id"), "event_id", "left_anti")
    return availability.unionByName(new.select("event_id", F.lit("PENDING").alias("status"), F.lit(None).cast("timestamp").alias("checked_at")))


def override(fallback: DataFrame, providers: Sequence[DataFrame], key: str, valid: str) -> DataFrame:
    """The first provider's whole row that is valid, else the fallback's; `overridden_by` numbers the provider from 1."""
    values = [c for c in fallback.columns if c != key]
    x = fallback
    for n, p in enumerate(providers):
        x = x.join(p.where(valid).select(key, F.struct(*values).alias(f"_{n}")), key, "left")
    chosen = F.coalesce(*[F.col(f"_{n}") for n in range(len(providers))], F.struct(*values))
    by = F.coalesce(*[F.when(F.col(f"_{n}").isNotNull(), F.lit(n + 1)) for n in range(len(providers))])
    return x.select(key, *[chosen[v].alias(v) for v in values], by.alias("overridden_by"))


def override_fields(fallback: DataFrame, provider: DataFrame, key: str) -> DataFrame:
    """Field by field the provider's value unless it is null or blank."""
    values = [c for c in fallback.columns if c != key]
    p = provider.select(key, *[F.col(v).alias(f"_{v}") for v in values])
    filled = lambda v: F.when(F.coalesce(F.col(f"_{v}").cast("string"), F.lit("")) != "", F.col(f"_{v}"))
    return fallback.join(p, key, "left").select(key, *[F.coalesce(filled(v), F.col(v)).alias(v) for v in values])


def clean_history(parts: Sequence[DataFrame], now: Column, days: int = 540, cap: int = 700) -> DataFrame:
    """Results with all fields, one per date and pair (the last part's), of the lookback if it has any for the tournament, the newest `cap` of each."""
    both = None
    for n, p in enumerate(parts):
        p = p.withColumn("_n", F.lit(n))
        both = p if both is None else both.unionByName(p)
    x = both.where("kickoff IS NOT NULL AND home_id IS NOT NULL AND away_id IS NOT NULL AND home_goals IS NOT NULL AND away_goals IS NOT NULL")
    cols = [c for c in x.columns if c != "_n"]
    x = x.groupBy(F.to_date("kickoff").alias("_d"), "home_id", "away_id").agg(F.max(F.struct("_n", F.struct(*cols).alias("row"))).alias("r")).select("r.row.*")
    x = x.withColumn("_in", F.unix_seconds(now) - F.unix_seconds("kickoff") <= 86_400 * days)
    # An aggregate of its own, so that the window has its limit pushed below the shuffle: each task sends `cap` rows of a tournament at most.
    any_ = x.groupBy(F.col("tournament").alias("_t")).agg(F.max("_in").alias("_any"))
    x = x.join(any_, F.col("tournament").eqNullSafe(F.col("_t"))).where("_in OR NOT _any").drop("_in", "_any", "_t")
    newest = Window.partitionBy("tournament").orderBy(F.desc("kickoff"), F.desc("event_id"))
    return x.withColumn("_r", F.row_number().over(newest)).where(F.col("_r") <= cap).drop("_r")


def sparse_gate(predictions: DataFrame, columns: Sequence[str], games: str = "games", least: int = 10) -> DataFrame:
    """Model columns blanked for thin sources."""
    return predictions.withColumns({c: F.when(F.col(games) >= least, F.col(c)) for c in columns})


def player_aggregate(players: DataFrame) -> DataFrame:
    """Per team; missing numbers count as 0 in sums."""
    total = lambda c: F.sum(F.coalesce(c, F.lit(0))).alias(c)
    return players.groupBy("team").agg(F.count_distinct("player").alias("players"), total("minutes"), total("goals"))


def match_stat_quality(rows: DataFrame, least: int = 14) -> DataFrame:
    """Per event how many rows have minutes on either side, and OK, PARTIAL or SOURCE."""
    n = lambda s: F.count_if((F.col("side") == s) & (F.col("minutes") > 0)).alias(f"n_{s.lower()}")
    g = rows.groupBy("event_id").agg(n("H"), n("A"))
    return g.withColumn("status", F.when((F.col("n_h") >= least) & (F.col("n_a") >= least), "OK").when(F.col("n_h") + F.col("n_a") > 0, "PARTIAL").otherwise("SOURCE"))


def player_rows(stats: DataFrame, lineups: DataFrame) -> DataFrame:
    """Players of either input, one per event, side and player; stats win, line-ups tell who started."""
    s = stats.groupBy("event_id", "side", "player").agg(F.max("minutes").alias("minutes"), F.max("rating").alias("rating"))
    x = lineups.groupBy("event_id", "side", "player").agg(F.max("starter").alias("starter"))
    return s.join(x, ["event_id", "side", "player"], "outer").withColumn("from_stats", F.col("minutes").isNotNull())


#: The segments of a match.
SEGMENTS = ("0-15", "16-30", "31-45", "46-60", "61-75", "76-FT")


def macro_control(pick: Column, home_points: Column, away_points: Column) -> Column:
    """The side expected in control and on what basis: the consensus pick, else form a point ahead."""
    ahead = F.when(home_points - away_points >= 1, "H").when(away_points - home_points >= 1, "A")
    by_pick = F.when(pick.isin("H", "A"), pick)
    return F.struct(F.coalesce(by_pick, ahead).alias("side"), F.when(by_pick.isNotNull(), "CONSENSUS").when(ahead.isNotNull(), "FORM").otherwise("NONE").alias("basis"))


def coverage_points(present: Sequence[tuple[Column, int]]) -> Column:
    return sum((F.when(c, n).otherwise(0) for c, n in present), F.lit(0))


def scenarios(fixtures: DataFrame, consensus: DataFrame, form: DataFrame) -> DataFrame:
    """Each event in six segments with its consensus, expected side, basis and coverage."""
    points = lambda s: form.where(F.col("side") == s).select("event_id", E.form_points(F.col("form")).alias(f"p{s}"))
    x = fixtures.select("event_id").join(consensus.select("event_id", "pick"), "event_id", "left").join(points("H"), "event_id", "left").join(points("A"), "event_id", "left")
    x = x.withColumn("m", macro_control(F.col("pick"), F.col("pH"), F.col("pA")))
    cover = coverage_points([(F.col("pick").isNotNull(), 40), (F.col("pH").isNotNull(), 30), (F.col("pA").isNotNull(), 30)])
    return x.select("event_id", F.explode(F.array(*[F.lit(s) for s in SEGMENTS])).alias("segment"), "pick", F.col("m.side").alias("expected"), F.col("m.basis").alias("basis"), cover.alias("coverage"))


def match_ratings(names: DataFrame, ratings: DataFrame, master: DataFrame | None = None, measure: str = "edit") -> DataFrame:
    """name, club, rating, match: the rating of each distinct name that has one, and how well it fits.

    A name verified for a club (master: canonical, source_name) scores 1 by its folded form and .995 without spaces; the name itself 1 and .99. The rest go through the
    name index by the profile `rating`: the measure or the likeness of their words, whichever is higher, from .90 on if it leads the next club by .025.
    ratings: name, rating; of one club the highest.
    """
    profile = K.PROFILES["rating"]
    squeeze = lambda c: F.regexp_replace(c, " ", "")
    # Names are made distinct before they are folded, as a filter by the folded form would go down to each fixture.
    r = ratings.select(E.fold_name(F.col("name")).alias("k"), F.struct("rating", "name").alias("r")).where("k <> ''").groupBy("k").agg(F.max("r").alias("r")).select("k", "r.rating", F.col("r.name").alias("club"))
    small = r.groupBy(squeeze(F.col("k")).alias("small")).agg(F.max(F.struct("rating", "club")).alias("s"))
    n = settled(names.select("name").distinct()).withColumn("k", E.fold_name(F.col("name"))).where("k <> ''")
    known = (master if master is not None else names.sparkSession.createDataFrame([], "canonical string, source_name string")).groupBy(E.fold_name(F.col("canonical")).alias("k")).agg(F.min(E.fold_name(F.col("source_name"))).alias("v"))
    x = n.join(known, "k", "left")
    tiers = None
    for form, exact, squeezed in (("v", 1.0, 0.995), ("k", 1.0, 0.99)):
        x = x.join(r.select(F.col("k").alias(form), F.struct("rating", "club").alias("_r")), form, "left").withColumn("_small", squeeze(F.col(form))).join(small.select(F.col("small").alias("_small"), F.col("s").alias("_s")), "_small", "left")
        here = [F.when(F.col("_r").isNotNull(), F.struct(F.col("_r.rating"), F.col("_r.club"), F.lit(exact).alias("match"))), F.when(F.col("_s").isNotNull(), F.struct(F.col("_s.rating"), F.col("_s.club"), F.lit(squeezed).alias("match")))]
        x = x.withColumn(f"t_{form}", F.coalesce(*here)).drop("_r", "_s", "_small")
        tiers = F.col(f"t_{form}") if tiers is None else F.coalesce(tiers, F.col(f"t_{form}"))
    x = settled(x.select("name", "k", tiers.alias("t")))
    unseen, clubs = x.where("t IS NULL").select(F.col("k").alias("name")), r.select(F.col("k").alias("name"))
    floor = profile.floor - profile.margin
    pairs = K.similar_names(unseen, clubs, floor, measure, contained=None).union(K.core_pairs(unseen, clubs, floor)).groupBy("left", "right").agg(F.max("score").alias("score"))
    best = K.best_names(pairs, profile).where("accepted").join(r, F.col("right") == F.col("k")).select(F.col("left").alias("k"), F.struct("rating", "club", F.col("score").alias("match")).alias("f"))
    t = F.coalesce("t", "f")
    return x.join(best, "k", "left").where(t.isNotNull()).select("name", t["club"].alias("club"), t["rating"].alias("rating"), t["match"].alias("match"))


def power_feed(fixtures: DataFrame, ratings: DataFrame, master: DataFrame | None = None, measure: str = "edit") -> DataFrame:
    """Each fixture with the rating, club and match of both sides, and which are there (BOTH, HOME_ONLY, AWAY_ONLY, NONE). Each distinct name is looked up once."""
    names = fixtures.select(F.col("home").alias("name")).union(fixtures.select("away"))
    found = match_ratings(names, ratings, master, measure)
    side = lambda s: found.select(F.col("name").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("rating", "club", "match")])
    x = fixtures.join(side("home"), "home", "left").join(side("away"), "away", "left")
    h, a = F.col("home_match").isNotNull(), F.col("away_match").isNotNull()
    columns = [f"{s}_{c}" for s in ("home", "away") for c in ("rating", "club", "match")]
    return x.select("event_id", *columns, F.when(h & a, "BOTH").when(h, "HOME_ONLY").when(a, "AWAY_ONLY").otherwise("NONE").alias("coverage"))


def near_miss(best: DataFrame) -> DataFrame:
    """Why the best candidate (hs, as_, gap_seconds, score) was no link."""
    low, high = F.least("hs", "as_"), F.greatest("hs", "as_")
    reason = F.when(F.col("score").isNull(), "NO_CANDIDATE").when((low >= 0.9) & (F.col("gap_seconds") > 600), "CLOCK").when((high >= 0.9) & (low < 0.66), "ONE_SIDE").when(low >= 0.66, "BELOW_SCORE").otherwise("DIFFERENT")
    return best.select("row_id", reason.alias("reason"))


#: Days of a span, within which two names' rows and targets of a rollover meet.
DAYS = 60


def attach_rollover(unlinked: DataFrame, targets: DataFrame) -> DataFrame:
    """Links a day apart: both names equal, exactly one target within a day of the source date.

    The days of two names are dealt out in spans, which have the targets of the days next to them too, and rows see their targets in a window of a span.
    So rows move once to meet them, and so do targets other than those at the ends of spans.
    """
    names, span = ["home_key", "away_key"], lambda d: F.floor(d / DAYS)
    side = lambda df, day, row, event: df.select(*names, F.unix_date(F.to_date(day)).alias("d"), row.alias("row_id"), event.alias("event_id"), F.lit(event is none).alias("asked")).dropna(subset=[*names, "d"])
    none = F.lit(None)
    r = side(unlinked, "source_date", F.col("row_id"), none).withColumn("span", span(F.col("d")))
    t = side(targets, "kickoff", none, F.col("event_id")).withColumn("span", F.explode(F.array_distinct(F.array(span(F.col("d") - 1), span(F.col("d") + 1)))))
    near = Window.partitionBy(*names, "span").orderBy("d").rangeBetween(-1, 1)
    x = r.unionByName(t).select("row_id", "asked", F.min("event_id").over(near).alias("low"), F.max("event_id").over(near).alias("high")).where("asked AND low IS NOT NULL")
    return x.groupBy("row_id").agg(F.min("low").alias("event_id"), F.max("high").alias("high")).where("event_id = high").drop("high")


def attach_tiered(rows: DataFrame, targets: DataFrame, tiers: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Name tables (name, target_key) in order of trust, applied to both sides: a row is linked by the first tier that gives exactly one target of its date."""
    t = targets.select("event_id", F.col("home_key").alias("hk"), F.col("away_key").alias("ak"), F.to_date("kickoff").alias("day"))
    both = None
    for n, (tier, names) in enumerate(tiers):
        side = lambda s, k, names=names: names.select(F.col("name").alias(s), F.col("target_key").alias(k))
        c = rows.join(side("home", "hk"), "home").join(side("away", "ak"), "away").withColumn("day", F.col("source_date")).join(t, ["hk", "ak", "day"])
        c = c.groupBy("row_id").agg(F.count_distinct("event_id").alias("n"), F.min("event_id").alias("event_id")).where("n = 1").select("row_id", "event_id", F.lit(n).alias("rank"), F.lit(tier).alias("tier"))
        both = c if both is None else both.unionByName(c)
    return both.groupBy("row_id").agg(F.min(F.struct("rank", "event_id", "tier")).alias("b")).select("row_id", "b.event_id", "b.tier")


def attach_markets(verified: DataFrame, market: DataFrame) -> DataFrame:
    """Verified rows with the market of the same url, names and clock; conflicting duplicates leave it unknown."""
    keys = ["url", "home", "away", "kickoff"]
    g = market.groupBy(*keys).agg(F.count_distinct(F.struct("over", "under")).alias("_n"), F.max("over").alias("over"), F.max("under").alias("under"))
    one = F.col("_n") == 1
    return verified.join(g, keys, "left").withColumn("over", F.when(one, F.col("over"))).withColumn("under", F.when(one, F.col("under"))).drop("_n")


def map_with_redirects(rows: DataFrame, redirects: DataFrame, shadow: DataFrame, fixtures: DataFrame, seconds: int = 1200) -> DataFrame:
    """Provider ids to events by redirect, else shadow, else as they are, if the kickoff is close to the fixture's."""
    x = rows.join(redirects.select("provider_id", F.col("event_id").alias("_r")), "provider_id", "left").join(shadow.select("provider_id", F.col("event_id").alias("_s")), "provider_id", "left")
    x = x.withColumn("event_id", F.coalesce("_r", "_s", F.col("provider_id").try_cast("bigint"))).drop("_r", "_s")
    return x.join(fixtures.select("event_id", F.col("kickoff").alias("_k")), "event_id").where(F.abs(F.unix_seconds("kickoff") - F.unix_seconds("_k")) <= seconds).drop("_k")


def identity_health(upcoming: DataFrame, predictions: DataFrame, aliases: DataFrame) -> DataFrame:
    """Per prediction whether its names are the fixture's, known aliases of them, or wrong on a side."""
    f = upcoming.select("event_id", F.col("home").alias("fh"), F.col("away").alias("fa"))
    x = predictions.select("event_id", "home", "away").join(f, "event_id", "left")
    for s, c in (("h", "home"), ("a", "away")):
        x = x.join(aliases.select(F.col("alias").alias(c), F.col("canonical").alias(f"f{s}"), F.lit(True).alias(f"_{s}")).distinct(), [c, f"f{s}"], "left")
    ok = lambda s, c: (F.col(c) == F.col(f"f{s}")) | F.coalesce(F.col(f"_{s}"), F.lit(False))
    exact = (F.col("home") == F.col("fh")) & (F.col("away") == F.col("fa"))
    st = F.when(F.col("fh").isNull(), "NO_FIXTURE").when(exact, "EXACT").when(ok("h", "home") & ok("a", "away"), "ALIAS_OK").when(ok("h", "home"), "FAIL_AWAY").when(ok("a", "away"), "FAIL_HOME").otherwise("FAIL_BOTH")
    return x.select("event_id", st.alias("state"))


def connected_history(results: DataFrame, targets: DataFrame, hops: int = 3, stop: int = 450, cap: int = 500) -> DataFrame:
    """Per target the newest `cap` results among teams reached from its two in `hops` steps, growing while fewer than `stop` are found.

    Targets of the same two teams have the same history, so a frontier is of distinct (pair, team) rows. It grows over the
    graph of played pairs with their numbers of games, and meets only each team's newest `cap` games. Results have one row per event.
    """
    low, high = F.least("home_id", "away_id"), F.greatest("home_id", "away_id")
    both = lambda a, b: F.explode(F.array_distinct(F.array(a, b))).alias("team")
    graph = results.groupBy(low.alias("a"), high.alias("b")).agg(F.count("*").alias("n")).select("a", "b", "n", both("a", "b"))
    graph = graph.withColumn("opponent", F.when(F.col("team") == F.col("a"), F.col("b")).otherwise(F.col("a")))
    newest = rollups.top_recent(results.select(both("home_id", "away_id"), F.col("event_id").alias("past_id"), "kickoff"), "team", "kickoff", cap, "past_id").drop("r")
    t = targets.select("event_id", low.alias("low"), high.alias("high")).distinct()
    reach = t.select("low", "high").distinct().select("low", "high", both("low", "high"))
    for _ in range(hops):
        # Games between two reached teams are met from both; teams without games have nothing to add.
        met = reach.join(graph, "team").withColumn("n", F.col("n") / F.count("*").over(Window.partitionBy("low", "high", "a", "b")))
        met = met.withColumn("found", F.sum("n").over(Window.partitionBy("low", "high")))
        reach = met.select("low", "high", F.explode(F.array("team", F.when(F.col("found") < stop, F.col("opponent")).otherwise(F.col("team")))).alias("team")).distinct()
    x = reach.join(newest, "team").select("low", "high", "past_id", "kickoff").distinct()
    x = rollups.top_recent(x, ["low", "high"], "kickoff", cap, "past_id").drop("r")
    return t.join(x, ["low", "high"]).select("event_id", "past_id", "kickoff")


def match_board(fixtures: DataFrame, odds: DataFrame, evidence: DataFrame, decision: DataFrame) -> DataFrame:
    """Selling fixtures with prices, no-vig probabilities, each source's home edge and the decision."""
    e = evidence.groupBy("event_id").agg(F.count_distinct("source").alias("channels"), F.avg("h").alias("mean_h"))
    x = fixtures.where("selling").select("event_id").join(odds, "event_id", "left").join(e, "event_id", "left").join(decision.select("event_id", "state"), "event_id", "left")
    p = E.devig(F.col("home"), F.col("draw"), F.col("away"))
    return x.select("event_id", "home", "draw", "away", p["h"].alias("fair_home"), F.coalesce("channels", F.lit(0)).alias("channels"), E.edge(F.col("home"), F.col("mean_h")).alias("home_edge"), "state")


def expected_ids(fixtures: DataFrame) -> DataFrame:
    """Dates of boards to look at: each kickoff's calendar day in UTC and in local time."""
    days = F.array_distinct(F.array(F.to_date("kickoff"), F.to_date(F.from_utc_timestamp("kickoff", E.LOCAL))))
    return fixtures.select(F.explode(days).alias("day")).distinct()


# Grid of the low-score correction
RHO = [n / 50 for n in range(-10, 11)]


def low_score_rho(games: DataFrame) -> float:
    """The correction of RHO that makes the low scores of games (home_goals, away_goals, lh, la, weight) likeliest; of equal ones the one nearest 0. One row reaches the driver."""
    lh, la = F.col("lh"), F.col("la")
    at = lambda h, a: (F.col("home_goals") == h) & (F.col("away_goals") == a)
    tau = lambda r: F.when(at(0, 0), 1 - lh * la * r).when(at(0, 1), 1 + lh * r).when(at(1, 0), 1 + la * r).otherwise(1 - r)
    low = games.where("home_goals IN (0, 1) AND away_goals IN (0, 1)")
    x = low.agg(*[F.sum(F.col("weight") * F.log(F.greatest(tau(F.lit(r)), F.lit(1e-9)))).alias(f"r{n}") for n, r in enumerate(RHO)]).first()
    return max(zip(x, RHO, strict=True), key=lambda t: (round(t[0], 9), -abs(t[1])))[1] if x[0] is not None else 0.0


def goal_glm(results: DataFrame, fixtures: DataFrame, now: Column, xi: float = 0.001, min_matches: int = 120, min_games: int = 20) -> DataFrame:
    """Expected goals by a Poisson regression on attack, defence and home, weighted by exp(-xi days), with a low-score correction: an approximation of the time-weighted goal model.

    Only results before now count. Fixtures whose teams have fewer than min_games of them, and all of them if there are fewer than min_matches, have no forecast.
    One distributed fit over one-hot teams; teams of a tournament should number below 2,000 for the solver's limit of features.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    past = results.where((F.col("kickoff") < now) & F.col("home_goals").isNotNull() & F.col("away_goals").isNotNull())
    w = F.exp(F.lit(-xi) * (F.unix_seconds(now) - F.unix_seconds("kickoff")) / F.lit(86_400.0))

    def sides(df: DataFrame) -> DataFrame:
        x = links.to_team_rows(df).withColumn("at_home", F.when(F.col("side") == "H", 1.0).otherwise(0.0))
        return x.withColumn("team", F.col("team").cast("string")).withColumn("opponent", F.col("opponent").cast("string"))

    t = sides(past).withColumn("weight", w)
    if past.limit(min_matches).count() < min_matches:
        return fixtures.where("1 = 0").select("event_id", *[F.lit(None).cast("double").alias(c) for c in ("lh", "la", "h", "d", "a", "over25")])
    steps = [StringIndexer(inputCol=c, outputCol=f"{c}_i", handleInvalid="keep") for c in ("team", "opponent")] + [OneHotEncoder(inputCols=["team_i", "opponent_i"], outputCols=["team_v", "opponent_v"]), VectorAssembler(inputCols=["team_v", "opponent_v", "at_home"], outputCol="features")]
    glm = GeneralizedLinearRegression(family="poisson", link="log", labelCol="gf", weightCol="weight", regParam=0.01, maxIter=15)
    model = Pipeline(stages=[*steps, glm]).fit(t)
    goals = lambda side: F.max(F.when(F.col("side") == side, F.col("prediction")))
    fitted = model.transform(t).groupBy("event_id").agg(
        goals("H").alias("lh"), goals("A").alias("la"), F.max("weight").alias("weight"), *[F.max(F.when(F.col("side") == "H", F.col(g))).alias(c) for g, c in (("gf", "home_goals"), ("ga", "away_goals"))]
    )
    rho = low_score_rho(fitted)
    enough = t.groupBy("team").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_games).select("team")
    f = sides(fixtures.withColumns({c: F.lit(0) for c in ("home_goals", "away_goals")})).join(enough, "team", "left_semi")
    p = model.transform(f).groupBy("event_id").agg(goals("H").alias("lh"), goals("A").alias("la")).where("lh IS NOT NULL AND la IS NOT NULL")
    p = p.withColumn("p", E.poisson_hda(F.col("lh"), F.col("la"), rho=rho)).withColumn("over25", E.poisson_over(F.col("lh"), F.col("la")))
    return p.select("event_id", "lh", "la", *[F.col(f"p.{c}").alias(c) for c in "hda"], "over25")


def international_results(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Results with a neutral flag, and per team the latest date; neutral games count for no venue rate (venue_side is null)."""
    x = docs.withColumn("neutral", F.coalesce(F.col("neutral"), F.lit(False)))
    teams = links.to_team_rows(x).join(x.select("event_id", "neutral"), "event_id").withColumn("venue_side", F.when(~F.col("neutral"), F.col("side")))
    return teams, teams.groupBy("team").agg(F.max("kickoff").alias("latest"))


def coverage_counts(layers: dict[str, DataFrame], targets: DataFrame) -> DataFrame:
    """One row: targets, and for each layer how many targets it has and how many of its events are no target; denominators are never mixed."""
    t = targets.select("event_id").distinct()
    out = t.agg(F.count("*").alias("n_targets"))
    for name, df in layers.items():
        e = df.select("event_id").distinct().join(t.withColumn("_t", F.lit(1)), "event_id", "left")
        out = out.crossJoin(F.broadcast(e.agg(F.count("_t").alias(f"n_{name}"), F.count_if(F.col("_t").isNull()).alias(f"n_{name}_outside"))))
    return out


def team_profile(stats: DataFrame, aliases: DataFrame, previous: DataFrame, now: Column, stale_days: int = 7) -> DataFrame:
    """Per team the picked stats; a team whose previous profile is fresh keeps it."""
    from matchlake.sources.feeds import pick_stat

    new = pick_stat(stats.withColumnRenamed("team", "event_id"), aliases).groupBy(F.col("event_id").alias("team")).agg(F.max(F.when(F.col("target") == "possession", F.col("value"))).alias("possession"), F.max(F.when(F.col("target") == "shots", F.col("value"))).alias("shots"))
    p = previous.select("team", F.struct("possession", "shots").alias("_p"), (F.unix_seconds(now) - F.unix_seconds("refreshed_at") <= 86_400 * stale_days).alias("_fresh"))
    x = new.join(p, "team", "outer")
    keep = F.coalesce(F.col("_fresh"), F.lit(False)) | F.col("possession").isNull() & F.col("shots").isNull()
    return x.select("team", F.when(keep, F.col("_p.possession")).otherwise(E.valid_possession(F.col("possession"))).alias("possession"), F.when(keep, F.col("_p.shots")).otherwise(F.col("shots")).alias("shots"), keep.alias("kept"))
