"""Scalar expressions on columns: names, odds, probabilities, scores, clocks. All are built-in functions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

LN2 = math.log(2.0)


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def epoch(c: Column | str) -> Column:
    """Seconds since 1970 with their fraction; `unix_seconds` drops it, which moves rows across limits."""
    return F.unix_micros(c) / F.lit(1e6)


# Names

#: Latin letters without a decomposition, and what replaces them.
SPECIAL = {"æ": "ae", "ø": "o", "ł": "l", "ß": "ss", "đ": "d", "ð": "d", "þ": "th", "œ": "oe", "ı": "i"}
#: Accented Latin letters and their base letters.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿāăąćĉċčďēĕėęěĝğġģĥīĭįĵķĺļľńņňōŏőŕŗřśŝşšţťũūŭůűųŵŷźżž"
BASE = "aaaaaaceeeeiiiinooooouuuuyyaaaccccdeeeeegggghiiijklllnnnooorrrssssttuuuuuuwyzzz"


def name_key(c: Column) -> Column:
    """Lower-cased letters and digits of any script; nothing left gives null."""
    return F.nullif(F.regexp_replace(F.lower(F.trim(c)), r"[^\p{L}\p{N}]", ""), F.lit(""))


def fold_name(c: Column) -> Column:
    """Lower case without accents, & as and, other characters as single spaces. Most names are in that form, which one look tells."""
    x = F.translate(F.lower(c), ACCENTED, BASE)
    for a, b in SPECIAL.items():
        x = F.replace(x, F.lit(a), F.lit(b))
    x = F.regexp_replace(F.replace(x, F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " ")
    return F.when(c.rlike(r"[^a-z0-9 ]|^ | \z|  "), F.trim(x)).otherwise(c.cast("string"))


#: What each profile of normalize_name drops and rewrites.
PROFILES = {
    "feed": {"drop": ("fc", "cf", "afc", "sc", "ac"), "rewrite": ()},
    "live": {"drop": ("fc", "cf", "afc", "sc", "ac", "u19", "u20", "u21", "u23"), "rewrite": (("^st ", "saint "),)},
    "strict": {"drop": ("fc", "cf", "afc"), "rewrite": ((" w$", " women"), ("^st ", "saint "))},
}


def normalize_name(c: Column, profile: str) -> Column:
    """fold_name, then a profile's rewrites and dropped words; a name of dropped words only stays as it is."""
    x = fold_name(c)
    for a, b in PROFILES[profile]["rewrite"]:
        x = F.regexp_replace(x, a, b)
    kept = F.array_join(F.filter(F.split(x, " "), lambda w: ~w.isin(*PROFILES[profile]["drop"])), " ")
    return F.when(F.length(kept) > 0, kept).otherwise(x)


def normalize_cjk(c: Column) -> Column:
    """Full-width letters and digits as plain ones, without separators and brackets."""
    wide = "".join(chr(0xFEE0 + x) for x in range(0x21, 0x7F))
    plain = "".join(map(chr, range(0x21, 0x7F)))
    return F.regexp_replace(F.translate(c, wide, plain), r"[\s　·・.,()\[\]（）【】-]", "")


def exact_name(c: Column) -> Column:
    return F.regexp_replace(fold_name(c), " ", "")


def edit_similarity(a: Column, b: Column) -> Column:
    """1 - edit distance over the longer length."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest > 0, F.lit(1.0) - F.levenshtein(a, b) / longest).otherwise(F.lit(0.0))


def name_sim(a: Column, b: Column, least: int = 4, contained: float = 0.94) -> Column:
    """1 for equal names, at least `contained` if one of `least` letters lies in the other, else edit similarity; nulls and blanks 0."""
    short, long_ = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    inside = (short >= least) & (F.contains(a, b) | F.contains(b, a))
    known = (F.coalesce(F.length(a), F.lit(0)) > 0) & (F.coalesce(F.length(b), F.lit(0)) > 0)
    return F.when(~known, 0.0).when(a == b, 1.0).when(inside, F.greatest(F.lit(contained), short / long_)).otherwise(edit_similarity(a, b))


def tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.coalesce(c, F.lit("")), " "), lambda w: F.length(w) > 0))


def token_sim(a: Column, b: Column) -> Column:
    """Dice coefficient of the words, at least .92 if they share one of three or four letters."""
    x, y = tokens(a), tokens(b)
    both = F.array_intersect(x, y)
    dice = F.when(F.size(x) + F.size(y) > 0, F.lit(2.0) * F.size(both) / (F.size(x) + F.size(y))).otherwise(0.0)
    return F.when(F.exists(both, lambda w: F.length(w).between(3, 4)), F.greatest(dice, F.lit(0.92))).otherwise(dice)


#: Words of clubs' names that tell nothing. Fixed values.
STOP = ("fc", "cf", "club", "de", "the")


def core_tokens(c: Column, stop: Sequence[str] = STOP) -> Column:
    return F.array_except(tokens(c), F.array(*[F.lit(s) for s in stop]))


def core_sim(a: Column, b: Column, stop: Sequence[str] = STOP) -> Column:
    """.82 of the Jaccard coefficient of the words without stop words, and .18 if one set holds the other."""
    x, y = core_tokens(a, stop), core_tokens(b, stop)
    both, all_ = F.size(F.array_intersect(x, y)), F.size(F.array_union(x, y))
    subset = (both == F.least(F.size(x), F.size(y))) & (both > 0)
    return F.when(all_ > 0, F.lit(0.82) * both / all_ + F.when(subset, 0.18).otherwise(0.0)).otherwise(0.0)


def slug_sim(home: Column, away: Column, url: Column) -> Column:
    """The share of each side's words found in a url's, and their mean."""
    words = F.split(F.lower(F.coalesce(url, F.lit(""))), "[^a-z0-9]+")
    side = lambda c: F.when(F.size(tokens(c)) > 0, F.size(F.array_intersect(tokens(c), words)) / F.size(tokens(c))).otherwise(0.0)
    return F.struct(side(home).alias("hs"), side(away).alias("as"), ((side(home) + side(away)) / 2).alias("mean"))


def is_noise(alias: Column) -> Column:
    """Page titles and other text that is no name."""
    return F.coalesce((F.length(alias) > 80) | F.lower(alias).rlike("prediction|statistics|betting|tips| vs | v |https?:"), F.lit(True))


def confidence(c: Column) -> Column:
    """Clamped to 0-1; values over 1 are percentages."""
    x = F.expr("try_cast(x AS double)") if isinstance(c, str) else c.cast("double")
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(x > 1, x / 100).otherwise(x)))


# Texts

def parse_pct(c: Column) -> Column:
    """A percentage from 0 to 100."""
    x = F.regexp_extract(c, r"^\s*([0-9]{1,3}(?:\.[0-9]+)?)\s*%?\s*$", 1).try_cast("double")
    return F.when(x.between(0, 100), x)


def parse_odds(c: Column) -> Column:
    """Decimal odds, or a/b as a/b + 1, from 1 to 1000, three decimals."""
    a = F.regexp_extract(c, r"^\s*([0-9]+)\s*/\s*([0-9]+)\s*$", 1).try_cast("double")
    b = F.regexp_extract(c, r"^\s*([0-9]+)\s*/\s*([0-9]+)\s*$", 2).try_cast("double")
    x = F.coalesce(F.when(b > 0, a / b + 1), F.regexp_extract(c, r"^\s*([0-9]+(?:\.[0-9]+)?)\s*$", 1).try_cast("double"))
    return F.when(x.between(1, 1000), F.round(x, 3))


def parse_score(c: Column) -> Column:
    """home and away goals of a text like 2-1, 2 : 1 or 2x1."""
    part = lambda n: F.regexp_extract(c, r"^\s*(\d{1,2})\s*[-:x]\s*(\d{1,2})\s*$", n).try_cast("int")
    return F.when(part(1).isNotNull(), F.struct(part(1).alias("h"), part(2).alias("a")))


def fmt_score(c: Column) -> Column:
    s = parse_score(c)
    return F.concat_ws(" - ", s["h"].cast("string"), s["a"].cast("string"))


def nonneg(c: Column) -> Column:
    """The first number of a text."""
    return F.regexp_extract(c, r"([0-9]+(?:\.[0-9]+)?)", 1).try_cast("double")


def stat_slug(c: Column) -> Column:
    return F.replace(fold_name(c), F.lit(" "), F.lit("_"))


# Clocks

LOCAL = "Asia/Hong_Kong"


def parse_ts(c: Column, zone: str = LOCAL) -> Column:
    """ISO times with an offset as they are, naive ones as local to `zone`; else null."""
    naive = [F.to_utc_timestamp(F.try_to_timestamp(c, F.lit(p)), zone) for p in ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm")]
    return F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")), *naive)


def source_date(kickoff_local: Column) -> Column:
    """The calendar date on which sources list a local kickoff: eight hours earlier."""
    return F.to_date(kickoff_local - F.expr("INTERVAL 8 HOURS"))


def display_clock(text: Column, page_date: Column) -> Column:
    """A displayed clock in one of four formats, if it is within a day of the page's date."""
    tries = [F.try_to_timestamp(text, F.lit(p)) for p in ("dd/MM/yyyy HH:mm", "yyyy-MM-dd HH:mm", "dd.MM.yyyy HH:mm")]
    at = F.coalesce(*tries, F.try_to_timestamp(F.concat(F.date_format(page_date, "yyyy-MM-dd "), text), F.lit("yyyy-MM-dd HH:mm")))
    return F.when(F.abs(F.datediff(at, page_date)) <= 1, at)


def slot_floor(ts: Column, minutes: int = 30) -> Column:
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts) / (60 * minutes)) * (60 * minutes))


def freshness(ts: Column, now: Column, warn_minutes: int, stale_minutes: int) -> Column:
    age = F.unix_seconds(now) - F.unix_seconds(ts)
    return F.when(ts.isNull(), "MISSING").when(age <= 60 * warn_minutes, "FRESH").when(age <= 60 * stale_minutes, "AGING").otherwise("STALE")


def season_codes(now: Column, n: int = 3) -> Column:
    """Codes such as 2526 of the latest seasons, newest first; a season starts in July."""
    first = F.year(now) - F.when(F.month(now) < 7, 1).otherwise(0)
    two = lambda y: F.lpad((y % 100).cast("string"), 2, "0")
    return F.array(*[F.concat(two(first - i), two(first - i + 1)) for i in range(n)])


def segment(minute: Column) -> Column:
    """The quarter-hour of a match."""
    return (
        F.when(minute.isNull(), _null("string")).when(minute <= 15, "0-15").when(minute <= 30, "16-30").when(minute <= 45, "31-45")
        .when(minute <= 60, "46-60").when(minute <= 75, "61-75").otherwise("76-FT")
    )


def match_minute(status: Column, period_start: Column, now: Column) -> Column:
    """HT, FT, or the minute that a status text is (45+2 included), else the running minute since the period began: from 45 in a second half, 90 and 105 in extra time, at most 130."""
    s = F.upper(F.trim(status))
    given = F.nullif(F.regexp_extract(s, r"^(\d{1,3}(?:\+\d+)?)\s*'?$", 1), F.lit(""))
    before = F.when(s.rlike("PERIOD2|SECOND|2ND"), 45).when(s.rlike("EXTRA ?(TIME )?1"), 90).when(s.rlike("EXTRA ?(TIME )?2"), 105).otherwise(0)
    passed = F.greatest(F.floor((F.unix_seconds(now) - F.unix_seconds(period_start)) / 60), F.lit(0)) + 1 + before
    return F.when(s.isin("HT", "FT", "AET"), s).otherwise(F.coalesce(given, F.least(passed, F.lit(130)).cast("string")))


# Odds and probabilities

def _triple(h: Column, d: Column, a: Column) -> Column:
    return F.struct(h.alias("h"), d.alias("d"), a.alias("a"))


def devig(h: Column, d: Column, a: Column) -> Column:
    """Inverse odds normalised to sum to 1; null unless all are over 1."""
    total = 1 / h + 1 / d + 1 / a
    return F.when((h > 1) & (d > 1) & (a > 1), _triple(1 / h / total, 1 / d / total, 1 / a / total))


def norm_probs(h: Column, d: Column, a: Column, percent_by_sum: bool = False) -> Column:
    """Fractions that sum to 1. A value over 1 is a percentage; with percent_by_sum all are if their sum is over 2."""
    part = (lambda p: p / 100) if percent_by_sum else (lambda p: F.when(p > 1, p / 100).otherwise(p))
    x = [F.when(h + d + a > 2, part(p)).otherwise(p) if percent_by_sum else part(p) for p in (h, d, a)]
    total = x[0] + x[1] + x[2]
    return F.when(total > 0, _triple(*[p / total for p in x]))


def norm_pair(p: Column, q: Column) -> Column:
    x, y = F.when(p > 1, p / 100).otherwise(p), F.when(q > 1, q / 100).otherwise(q)
    return F.when(x + y > 0, F.struct((x / (x + y)).alias("p"), (y / (x + y)).alias("q")))


def model_gate(h: Column, d: Column, a: Column, pick: Column, score: Column, avg_goals: Column) -> Column:
    """ok, and the first reason against a published row."""
    reason = (
        F.when(h.isNull() | d.isNull() | a.isNull(), "MISSING_PROBABILITY").when(~(h.between(0, 100) & d.between(0, 100) & a.between(0, 100)), "PROBABILITY_RANGE")
        .when(~(h + d + a).between(98, 102), "PROBABILITY_SUM").when(~F.coalesce(pick.isin("1", "X", "2"), F.lit(False)), "PICK")
        .when(~F.coalesce(score.rlike(r"^\d{1,2} - \d{1,2}$"), F.lit(False)), "SCORE").when(~F.coalesce((avg_goals > 0) & (avg_goals <= 12), F.lit(False)), "AVERAGE_GOALS")
    )
    return F.struct(reason.isNull().alias("ok"), reason.alias("reason"))


def edge(odds: Column, p: Column) -> Column:
    return odds * p - 1


def argmax_hda(h: Column, d: Column, a: Column, tie: str = "first") -> Column:
    """H, D or A. Ties go to the first of them, or with tie="TIE" are named so."""
    if tie == "TIE":
        top = F.greatest(h, d, a)
        n = sum((F.when(p == top, 1).otherwise(0) for p in (h, d, a)), F.lit(0))
        return F.when(h.isNull() | d.isNull() | a.isNull(), _null("string")).when(n > 1, "TIE").when(h == top, "H").when(d == top, "D").otherwise("A")
    return F.when((h >= d) & (h >= a), "H").when(d >= a, "D").when(a.isNotNull(), "A")


def consensus(votes: Column) -> Column:
    """The vote of most non-null opinions, or of a single one; else CONFLICT."""
    given = F.filter(votes, lambda v: v.isNotNull())
    n = lambda v: F.size(F.filter(given, lambda w: w == v))
    major = F.get(F.filter(F.array_distinct(given), lambda v: n(v) * 2 > F.size(given)), F.lit(0))
    return F.when(F.size(given) == 0, _null("string")).otherwise(F.coalesce(major, F.lit("CONFLICT")))


def _indicators(outcome: Column) -> tuple[Column, Column, Column]:
    return tuple(F.when(outcome == k, 1.0).otherwise(0.0) for k in ("H", "D", "A"))


def rps(h: Column, d: Column, a: Column, outcome: Column) -> Column:
    x, y, _ = _indicators(outcome)
    return ((h - x) * (h - x) + (h + d - x - y) * (h + d - x - y)) / 2


def brier(h: Column, d: Column, a: Column, outcome: Column) -> Column:
    return sum(((p - i) * (p - i) for p, i in zip((h, d, a), _indicators(outcome), strict=True)), F.lit(0.0)) / 3


def logloss(h: Column, d: Column, a: Column, outcome: Column, clamp: float = 1e-12) -> Column:
    p = F.when(outcome == "H", h).when(outcome == "D", d).when(outcome == "A", a)
    return -F.log(F.greatest(p, F.lit(clamp)))


# Goals

def decay(age_days: Column, half_life: float = 180.0) -> Column:
    return F.exp(F.lit(-LN2) * age_days / F.lit(half_life))


def poisson_hda(lh: Column, la: Column, max_goals: int = 10, rho: float | Column = 0.0) -> Column:
    """Home, draw and away probabilities of two Poisson scores up to max_goals, renormalised.

    rho moves weight between the draws 0-0 and 1-1 and the scores 1-0 and 0-1 (low-score correction); it is held within the bounds that leave every score a probability.
    """
    held = F.greatest(F.least(F.lit(rho), F.lit(1.0), 1 / (lh * la)), -1 / lh, -1 / la) if isinstance(rho, Column) or rho else F.lit(0.0)
    moved = held * lh * la * F.exp(-lh - la)  # what each of the four scores gains or gives
    pmf = lambda lam: F.transform(F.sequence(F.lit(0), F.lit(max_goals)), lambda k: F.exp(-lam) * F.pow(lam, k) / F.factorial(k))
    sums = F.struct(F.lit(0.0).alias("win"), F.lit(0.0).alias("draw"), F.lit(0.0).alias("below"), F.lit(0.0).alias("all"))

    def step(t: Column, pair: Column) -> Column:
        """win: sum of p over the other side's scores below; below: that side's sum so far."""
        p, q = pair["p"], pair["q"]
        return F.struct((t["win"] + p * t["below"]).alias("win"), (t["draw"] + p * q).alias("draw"), (t["below"] + q).alias("below"), (t["all"] + p).alias("all"))

    pairs = lambda x, y: F.zip_with(x, y, lambda p, q: F.struct(p.alias("p"), q.alias("q")))

    def finish(t: Column) -> Column:
        total = t["below"] * t["all"]
        return _triple((t["win"] + moved) / total, (t["draw"] - 2 * moved) / total, (total - t["win"] - t["draw"] + moved) / total)

    return F.aggregate(pairs(pmf(lh), pmf(la)), sums, step, finish)


def poisson_over(lh: Column, la: Column, line: float = 2.5) -> Column:
    """Probability of more goals than line; the sum of two Poisson scores is one of both means, and the low-score correction leaves it."""
    s = lh + la
    under = sum((F.pow(s, F.lit(k)) / F.factorial(F.lit(k)) for k in range(int(line) + 1)), F.lit(0.0))
    return 1 - F.exp(-s) * under


def expected_goals(home_for: Column, home_against: Column, away_for: Column, away_against: Column) -> Column:
    """Geometric means of attack and the other side's concession, each at least .10, clipped to .25-3.5."""
    low = lambda c: F.greatest(c, F.lit(0.10))
    clip = lambda c: F.greatest(F.lit(0.25), F.least(F.lit(3.5), c))
    return F.struct(clip(F.sqrt(low(home_for) * low(away_against))).alias("lh"), clip(F.sqrt(low(away_for) * low(home_against))).alias("la"))


def blend(all_rate: Column, venue_rate: Column, venue_n: Column, venue_weight: Column) -> Column:
    """The venue's rate counts .40 + .03 n, at most .70, from four games and a weight of 1.5 on."""
    w = F.least(F.lit(0.70), F.lit(0.40) + F.lit(0.03) * venue_n)
    return F.when((venue_n >= 4) & (venue_weight >= 1.5) & venue_rate.isNotNull(), w * venue_rate + (1 - w) * all_rate).otherwise(all_rate)


def form_points(form: Column) -> Column:
    """Mean points of a text of W, D and L (3, 1, 0)."""
    games = F.filter(F.split(F.upper(F.coalesce(form, F.lit(""))), ""), lambda g: g.isin("W", "D", "L"))
    points = F.aggregate(games, F.lit(0.0), lambda t, g: t + F.when(g == "W", 3.0).when(g == "D", 1.0).otherwise(0.0))
    return F.when(F.size(games) > 0, points / F.size(games))


def ppg(w: Column, d: Column, losses: Column) -> Column:
    return F.when(w + d + losses > 0, (3 * w + d) / (w + d + losses))


# Arrays and flags

def codes(conditions: dict[str, Column]) -> Column:
    """The codes whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in conditions.items()]))


def evidence_union(a: Column, b: Column) -> Column:
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(a, none), F.coalesce(b, none)))


def doc_merge(a: Column, b: Column) -> Column:
    """Two maps as one; b wins."""
    return F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k)), b)


def differs(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def competition_ok(code: Column, league: Column, known: dict[str, Sequence[str]]) -> Column:
    """Whether a league's name starts with one of the prefixes that belong to a code; null for an unknown code."""
    ok = _null("boolean")
    for k, prefixes in known.items():
        starts = F.lit(False)
        for p in prefixes:
            starts = starts | F.lower(league).startswith(p)
        ok = F.when(code == k, starts).otherwise(ok)
    return ok


def source_direction(points: Column) -> Column:
    """UP, FLAT or DOWN for mean points of recent form."""
    return F.when(points >= 2.0, "UP").when(points <= 1.0, "DOWN").when(points.isNotNull(), "FLAT")


def valid_possession(x: Column) -> Column:
    return F.when(x.between(20, 80), x)
