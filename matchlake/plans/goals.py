"""The time-weighted goal model of each league, and sequential ratings that go on from a stored state."""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.functions import exprs as E
from matchlake.sources.feeds import newest_version

FIT = "scope string, team bigint, attack double, defence double, level double, home double, rho double, steps int"


def _rates(x: np.ndarray, n: int, h: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected goals of either side of each pair. x: attack and defence of n teams, level, home."""
    return np.exp(x[2 * n] + x[2 * n + 1] + x[h] - x[n + a]), np.exp(x[2 * n] + x[a] - x[n + h])


def _gain(lam: np.ndarray, mu: np.ndarray, rho: float, s: dict[str, np.ndarray]) -> float:
    """The log-likelihood of grouped games, without what does not depend on the parameters; -inf where a score has no probability."""
    low = (1 - lam * mu * rho, 1 + lam * rho, 1 + mu * rho, np.full_like(lam, 1 - rho))
    if any((t <= 0).any() for t in low):
        return -math.inf
    plain = (s["gh"] * np.log(lam) - s["w"] * lam + s["ga"] * np.log(mu) - s["w"] * mu).sum()
    return float(plain + sum((s[k] * np.log(t)).sum() for k, t in zip(("w00", "w01", "w10", "w11"), low, strict=True)))


def _best_rho(lam: np.ndarray, mu: np.ndarray, s: dict[str, np.ndarray]) -> float:
    """Where the slope of the concave log-likelihood in rho is 0, by halving; its bounds leave every score a probability."""
    low, high = -0.999 / max(lam.max(), mu.max()), 0.999 * min(1.0, 1 / (lam * mu).max())
    if not s["w00"].any() and not s["w01"].any() and not s["w10"].any() and not s["w11"].any():
        return 0.0
    for _ in range(60):
        rho = (low + high) / 2
        slope = (s["w01"] * lam / (1 + lam * rho) + s["w10"] * mu / (1 + mu * rho) - s["w00"] * lam * mu / (1 - lam * mu * rho) - s["w11"] / (1 - rho)).sum()
        low, high = (rho, high) if slope > 0 else (low, rho)
    return (low + high) / 2


def solve(h: np.ndarray, a: np.ndarray, n: int, s: dict[str, np.ndarray], ridge: float = 1e-3, with_rho: bool = True, most: int = 100) -> tuple[np.ndarray, float, int]:
    """Parameters, rho and steps of the joint likelihood of one league: reweighted least squares on grouped pairs of teams, rho in turn.

    The slopes hold the low-score terms, so the steps end at the optimum of the whole likelihood; the ridge only settles what games leave open: teams that never score, and the level of all attacks and defences.
    """
    size, both = 2 * n + 2, s["w"].sum()
    x, rho = np.zeros(size), 0.0
    x[2 * n] = math.log(max(1e-6, (s["gh"].sum() + s["ga"].sum()) / max(1e-12, 2 * both)))
    held = np.full(size, ridge)
    home = [(h, 1.0), (n + a, -1.0), (np.full_like(h, 2 * n), 1.0), (np.full_like(h, 2 * n + 1), 1.0)]
    away = [(a, 1.0), (n + h, -1.0), (np.full_like(h, 2 * n), 1.0)]
    for step in range(1, most + 1):
        lam, mu = _rates(x, n, h, a)
        now = _gain(lam, mu, rho, s) - (held * x * x).sum() / 2
        draw = -s["w00"] * lam * mu * rho / (1 - lam * mu * rho)
        slopes = s["gh"] - s["w"] * lam + draw + s["w01"] * lam * rho / (1 + lam * rho), s["ga"] - s["w"] * mu + draw + s["w10"] * mu * rho / (1 + mu * rho)
        g, m = -held * x, np.diag(held)
        for terms, slope, weight in ((home, slopes[0], s["w"] * lam), (away, slopes[1], s["w"] * mu)):
            for i, p in terms:
                np.add.at(g, i, p * slope)
                for j, q in terms:
                    np.add.at(m, (i, j), p * q * weight)
        move, shrink = np.clip(np.linalg.solve(m, g), -2, 2), 1.0
        while shrink > 1e-6:
            lam, mu = _rates(x + shrink * move, n, h, a)
            if _gain(lam, mu, rho, s) - (held * (x + shrink * move) ** 2).sum() / 2 >= now - 1e-12:
                break
            shrink /= 2
        else:
            shrink = 0.0
        x = x + shrink * move
        last, rho = rho, _best_rho(*_rates(x, n, h, a), s) if with_rho else 0.0
        if np.abs(shrink * move).max() < 1e-9 and abs(rho - last) < 1e-9:
            break
    return x, rho, step


def fit_goals(games: DataFrame, ridge: float = 1e-3, with_rho: bool = True) -> DataFrame:
    """scope, team, attack, defence, level, home, rho, steps: the goal model of each scope (a league) of games (scope, home_id, away_id, home_goals, away_goals, weight).

    Games are summed by pair of teams before anything is fitted: the likelihood needs no more. A scope's pairs, which its teams bound and not its games, are one small solve.
    """
    w, low = F.col("weight"), lambda h, a: F.sum(F.when((F.col("home_goals") == h) & (F.col("away_goals") == a), F.col("weight")).otherwise(0.0)).alias(f"w{h}{a}")
    pairs = games.groupBy("scope", "home_id", "away_id").agg(F.sum(w).alias("w"), F.sum(w * F.col("home_goals")).alias("gh"), F.sum(w * F.col("away_goals")).alias("ga"), *[low(h, a) for h in (0, 1) for a in (0, 1)])

    def one(t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values(["home_id", "away_id"])
        teams, at = np.unique(np.concatenate([t["home_id"], t["away_id"]]), return_inverse=True)
        h, a, n = at[: len(t)], at[len(t) :], len(teams)
        x, rho, steps = solve(h, a, n, {c: t[c].to_numpy(float) for c in ("w", "gh", "ga", "w00", "w01", "w10", "w11")}, ridge, with_rho)
        return pd.DataFrame({"scope": t["scope"].iloc[0], "team": teams, "attack": x[:n], "defence": x[n : 2 * n], "level": x[2 * n], "home": x[2 * n + 1], "rho": rho, "steps": steps})

    return pairs.groupBy("scope").applyInPandas(one, FIT)


def goal_model(fixtures: DataFrame, now: Column, leagues: DataFrame, own: DataFrame | None = None, xi: float = 0.001, gates: tuple[int, int] = (120, 20), own_gates: tuple[int, int] = (45, 10)) -> DataFrame:
    """event_id, tier, training_matches, lh, la, rho, h, d, a, over25: forecasts of fixtures (event_id, tournament, home_id, away_id).

    leagues, own: results (tournament, kickoff, home_id, away_id, home_goals, away_goals); only complete ones before now count, weighted by exp(-xi days). A fixture whose league has gates[0]
    matches and whose teams have gates[1] games each in it is forecast by that league's fit (tier LEAGUE); else by the fit on the same tournament of `own` by own_gates
    (tier OWN; the same results if None); else not at all.
    """
    forecasts = None
    for tier, results, (min_matches, min_games) in (("LEAGUE", leagues, gates), ("OWN", own if own is not None else leagues, own_gates)):
        past = results.where((F.col("kickoff") < now) & F.col("home_goals").isNotNull() & F.col("away_goals").isNotNull() & F.col("tournament").isNotNull())
        past = past.select(F.col("tournament").alias("scope"), "home_id", "away_id", "home_goals", "away_goals", F.exp(F.lit(-xi) * (F.unix_seconds(now) - F.unix_seconds("kickoff")) / F.lit(86_400.0)).alias("weight"))
        enough = past.groupBy("scope").agg(F.count("*").alias("training_matches")).where(F.col("training_matches") >= min_matches)
        fits = fit_goals(past.join(enough.select("scope"), "scope", "left_semi"))
        played = past.select("scope", F.explode(F.array("home_id", "away_id")).alias("team")).groupBy("scope", "team").agg(F.count("*").alias("games")).where(F.col("games") >= min_games)
        team = lambda s: fits.join(played, ["scope", "team"]).select("scope", F.col("team").alias(f"{s}_id"), F.struct("attack", "defence", "level", "home", "rho").alias(s))  # noqa: E731,B023
        x = fixtures.select("event_id", F.col("tournament").alias("scope"), "home_id", "away_id").join(team("home"), ["scope", "home_id"]).join(team("away"), ["scope", "away_id"]).join(enough, "scope")
        lh, la = F.exp(F.col("home.level") + F.col("home.home") + F.col("home.attack") - F.col("away.defence")), F.exp(F.col("home.level") + F.col("away.attack") - F.col("home.defence"))
        x = x.select("event_id", F.lit(tier).alias("tier"), "training_matches", lh.alias("lh"), la.alias("la"), F.col("home.rho").alias("rho"))
        forecasts = x if forecasts is None else forecasts.unionByName(x.join(forecasts.select("event_id"), "event_id", "left_anti"))
    p = forecasts.withColumn("p", E.poisson_hda(F.col("lh"), F.col("la"), rho=F.col("rho")))
    return p.select("event_id", "tier", "training_matches", "lh", "la", "rho", *[F.col(f"p.{c}").alias(c) for c in "hda"], E.poisson_over(F.col("lh"), F.col("la")).alias("over25"))


FOLD = "kind string, tournament string, event_id bigint, home_id bigint, away_id bigint, home_rating double, away_rating double, expected_gap double, games bigint, last_at timestamp, last_event bigint"


def fold_ratings(games: DataFrame, state: DataFrame | None = None, rate: float = 0.035, cross: float = 0.7, base: float = 10.0, scale: float = 3.0) -> DataFrame:
    """One pass of the sequential ratings over games, from a state (tournament, team, home_rating, away_rating, games, last_at, last_event) on.

    Rows of kind `game` have both sides' ratings before the game and the gap they expect, rows of kind `state` each team's ratings after the last one (team in home_id), rows of kind
    `late` are games that are not after the last one of their tournament's state, which change nothing. A task reads its tournaments as sorted streams and
    holds the ratings of one tournament's teams. Folding games in parts, each from the state of the one before, gives the rows of one fold over all of them.
    """
    none = lambda kind: F.lit(None).cast(kind)
    g = games.where("kickoff IS NOT NULL AND home_goals IS NOT NULL AND away_goals IS NOT NULL").select(
        F.col("tournament").cast("string").alias("tournament"), F.lit(1).alias("turn"), "kickoff", F.col("event_id").cast("bigint").alias("event_id"), F.col("home_id").cast("bigint").alias("home_id"), F.col("away_id").cast("bigint").alias("away_id"),
        (F.col("home_goals") - F.col("away_goals")).cast("double").alias("gap"), none("double").alias("home_rating"), none("double").alias("away_rating"), none("bigint").alias("games"),
    )
    if state is not None:
        s = state.select("tournament", F.lit(0).alias("turn"), F.col("last_at").alias("kickoff"), F.col("last_event").alias("event_id"), F.col("team").alias("home_id"), none("bigint").alias("away_id"), none("double").alias("gap"), "home_rating", "away_rating", "games")
        g = g.unionByName(s)

    def after(league, teams: dict) -> pd.DataFrame:
        rows = [("state", league, None, team, None, r[0], r[1], None, r[2], r[3], r[4]) for team, r in sorted(teams.items())]
        return _frame(rows)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        teams: dict[int, list] = {}
        league, began, last = None, False, None
        expected = lambda r: math.copysign(base ** (abs(r) / scale) - 1, r)
        for batch in batches:
            out = []
            columns = (batch[c].tolist() for c in ("tournament", "turn", "kickoff", "event_id", "home_id", "away_id", "gap", "home_rating", "away_rating", "games"))
            for name, turn, at, event, h, a, gap, hr, ar, n in zip(*columns, strict=True):
                name = name if isinstance(name, str) else None
                if not began or name != league:
                    if began:
                        yield _frame(out)
                        yield after(league, teams)
                        out = []
                    teams, league, began, last = {}, name, True, None
                key = (at, event)
                if turn == 0:
                    teams[int(h)] = [hr, ar, int(n), at, int(event)]
                    last = key if last is None or key > last else last
                    continue
                h, a, event = int(h), int(a), int(event)
                if last is not None and key <= last:
                    out.append(("late", league, event, h, a, None, None, None, None, None, None))
                    continue
                mine, its = teams.setdefault(h, [0.0, 0.0, 0, None, 0]), teams.setdefault(a, [0.0, 0.0, 0, None, 0])
                wanted = expected(mine[0]) - expected(its[1])
                out.append(("game", league, event, h, a, mine[0], its[1], wanted, None, None, None))
                error = gap - wanted
                step = rate * math.copysign(scale * math.log10(1 + abs(error)), error)
                mine[0], mine[1], its[0], its[1] = mine[0] + step, mine[1] + step * cross, its[0] - step * cross, its[1] - step
                for r in (mine, its):
                    r[2], r[3], r[4] = r[2] + 1, at, event
            yield _frame(out)
        if began:
            yield after(league, teams)

    order = ["tournament", "turn", "kickoff", "event_id"]
    return g.repartition("tournament").sortWithinPartitions(*order).mapInPandas(run, FOLD)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in FOLD.split(", ")]
    return pd.DataFrame(rows, columns=names).astype({c: "Int64" for c in ("event_id", "home_id", "away_id", "games", "last_event")} | {c: float for c in ("home_rating", "away_rating", "expected_gap")} | {"last_at": "datetime64[ns]"})


def _team_state(folded: DataFrame) -> DataFrame:
    return folded.where("kind = 'state'").select("tournament", F.col("home_id").alias("team"), "home_rating", "away_rating", "games", "last_at", "last_event")


def read_ratings(spark: SparkSession, folder: str) -> DataFrame | None:
    """The newest complete state of a folder of `advance_ratings`; None before the first."""
    at = newest_version(spark, folder)
    return _team_state(spark.read.schema(FOLD).parquet(at)) if at else None


def advance_ratings(games: DataFrame, folder: str) -> DataFrame:
    """The rows of `fold_ratings` over games after the stored state; the state moves on.

    A run writes its rows and all states to a folder of its own and counts once that is listed, so a run that fails changes nothing. Teams that had no game keep their
    state, as do tournaments. Games that a run has had before are late in the next.
    """
    spark = games.sparkSession
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    fold_ratings(games, read_ratings(spark, folder)).write.parquet(f"{folder}/{version}")
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode("append").parquet(f"{folder}/versions")
    return spark.read.schema(FOLD).parquet(f"{folder}/{version}")
