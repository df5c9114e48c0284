"""Similarity joins of names: all pairs above a floor, without a time bound or a shared word, and links built on them.

Names are compared once for each distinct pair that can reach the floor. A pair's lengths bound its edits: of one more parts of a name than that, one
is whole in the other name, and of two more, two are; so both meet at a whole part, or at two where one would be few letters, and only where the edits left can have moved it.
For the sequence measure the lengths bound how many letters both share, so both hold one of their few rarest
ones, and meet there. Names of which one lies within the other meet at a run of letters of the shorter. Nothing above the floor is lost, and nothing
is collected: the work is an equi-join on (both lengths, letters). Distinct names and the pairs found are each settled
in the checkpoint folder, since plans use them several times.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.functions import exprs as E
from matchlake.functions.names import plain_ratio, sequence_sim
from matchlake.operators.lineage import settled

#: Against rounding in bounds, always towards more candidates.
EPS = 1e-9


@dataclass(frozen=True)
class NameProfile:
    """Floor for either side, least mean score, and the margin asked of scores below `sure`. Fixed values by use below."""

    floor: float
    accept: float
    sure: float = 0.0
    margin: float = 0.0


PROFILES = {
    "book": NameProfile(0.70, 0.80),
    "listing": NameProfile(0.68, 0.76),
    "slug": NameProfile(0.50, 0.70, 0.85, 0.15),
    "history": NameProfile(0.78, 0.82, 0.94, 0.05),
    "rating": NameProfile(0.90, 0.90, 2.0, 0.025),
}


def _grams(name: Column, q: int) -> Column:
    """The runs of q letters of a name, each with the number of equal ones before it, so that they are a set."""
    at = F.sequence(F.lit(1), F.length(name) - (q - 1))
    run = lambda i: F.substring(name, i, F.lit(q))
    numbered = F.transform(at, lambda i: F.struct(run(i).alias("gram"), F.size(F.filter(F.sequence(F.lit(1), i), lambda j: run(j) == run(i))).alias("nth")))
    return F.when(F.length(name) >= q, numbered).otherwise(F.array().cast("array<struct<gram:string,nth:int>>"))


def _needed(own: Column, other: Column, floor: float) -> Column:
    """How many of a name's rarest letters there are, of which two names of these lengths whose sequence ratio reaches the floor share one of both's."""
    return (own - F.ceil((own + other) * (floor / 2) - EPS) + 1).cast("int")


def _meeting(rare: DataFrame, floor: float, left: bool) -> DataFrame:
    """name, l, r, g: the lengths of both names of a pair and the letter at which a name meets those it can be like."""
    shortest = floor / (2 - floor)
    size = F.length("name")
    lengths = F.sequence(F.greatest(F.lit(1), F.ceil(size * shortest - EPS)).cast("int"), F.floor(size / shortest + EPS).cast("int"))
    x = rare.where("in_left" if left else "in_right").select("name", "g1", size.alias("own"), F.explode(lengths).alias("other"))
    few = F.slice("g1", F.lit(1), F.greatest(_needed(F.col("own"), F.col("other"), floor), F.lit(0)))
    return x.select("name", (F.col("own") if left else F.col("other")).alias("l"), (F.col("other") if left else F.col("own")).alias("r"), F.explode(few).alias("g"))


def _sharing_letters(both: DataFrame, floor: float) -> DataFrame:
    """left, right: pairs of names that share a letter rare enough for the sequence ratio."""
    runs = both.select("name", "in_left", "in_right", F.explode(_grams(F.col("name"), 1)).alias("g"))
    counted = runs.join(runs.groupBy("g").agg(F.count("*").alias("n")), "g")
    rare = settled(counted.groupBy("name", "in_left", "in_right").agg(F.sort_array(F.collect_list(F.struct("n", "g")))["g"].alias("g1")))
    x = _meeting(rare, floor, True).withColumnRenamed("name", "left")
    y = _meeting(rare, floor, False).withColumnRenamed("name", "right")
    return x.join(y, ["l", "r", "g"]).select("left", "right")


#: Right names of one length from which on names of low floors meet at three parts: more keys for each, fewer names at one.
MANY = 200_000


def _parts(both: DataFrame, floor: float) -> DataFrame:
    """l, r, k, p1, n1, i1.. to p3, n3, i3: for each two lengths within the floor the k edits allowed, and the parts of the right name that names meet at: places, lengths and numbers, null for a second or third not asked."""
    of_length = lambda side, as_: both.where(side).groupBy(F.length("name").alias(as_)).agg(F.count("*").alias(f"n_{as_}"))
    x = of_length("in_left", "l").crossJoin(of_length("in_right", "r")).withColumn("k", F.floor(F.greatest("l", "r") * (1 - floor) + EPS).cast("int")).where(F.abs(F.col("l") - F.col("r")) <= F.col("k"))
    three = (F.col("k") == 4) & (F.col("r") >= 2 * (F.col("k") + 3)) & (F.col("n_r") >= MANY)
    two = F.col("k").between(2, 5) & (F.col("r") >= 2 * (F.col("k") + 2))
    x = x.withColumn("many", F.when(F.col("r") >= 5 * (F.col("k") + 1), 1).when(three, 3).when(two, 2).otherwise(1)).withColumn("m", F.col("k") + F.col("many"))
    x = x.withColumn("base", F.floor(F.col("r") / F.col("m")).cast("int")).withColumn("longer", F.col("r") - F.col("base") * F.col("m")).withColumn("i0", F.lit(0))
    for j in (1, 2, 3):
        before = F.col(f"i{j - 1}")
        later = F.filter(F.sequence(F.lit(1), "m"), lambda i: i > before)  # noqa: B023  it is called at once
        x = x.select("*", F.explode(F.when(F.col("many") >= j, later).otherwise(F.array(F.lit(None).cast("int")))).alias(f"i{j}"))
        place = 1 + (F.col(f"i{j}") - 1) * F.col("base") + F.greatest(F.lit(0), F.col(f"i{j}") - 1 - F.col("m") + F.col("longer"))
        x = x.withColumn(f"p{j}", F.when(F.col(f"i{j}").isNotNull(), place)).withColumn(f"n{j}", F.col("base") + (F.col(f"i{j}") > F.col("m") - F.col("longer")).cast("int"))
    return x.select("l", "r", "k", *[f"{c}{j}" for j in (1, 2, 3) for c in "pni"])


def _moved(parts: DataFrame) -> DataFrame:
    """The places of the left name where such parts can lie, if they are the first whole ones: each part before and between has an edit at least, and so has each letter by which they moved."""
    x, edits, last = parts.withColumn("s0", F.lit(0)).withColumn("i0", F.lit(0)), F.lit(0), F.lit(0)
    for j in (1, 2, 3):
        moves = F.when(F.col(f"i{j}").isNotNull(), F.sequence(-F.col("k"), F.col("k"))).otherwise(F.array(F.lit(None).cast("int")))
        edits = edits + F.coalesce(F.greatest(F.abs(F.col(f"s{j}") - F.col(f"s{j - 1}")), F.col(f"i{j}") - F.col(f"i{j - 1}") - 1), F.lit(0))
        last = F.coalesce(f"s{j}", last)
        x = x.select("*", F.explode(moves).alias(f"s{j}")).where(edits <= F.col("k"))
        x = x.withColumn(f"p{j}", F.col(f"p{j}") + F.col(f"s{j}")).where(F.coalesce((F.col(f"p{j}") >= (F.col(f"p{j - 1}") + F.col(f"n{j - 1}") if j > 1 else 1)) & (F.col(f"p{j}") + F.col(f"n{j}") - 1 <= F.col("l")), F.lit(True)))
    return x.where(edits + F.abs(F.col("l") - F.col("r") - last) <= F.col("k")).select(*parts.columns)


def _sharing_parts(both: DataFrame, floor: float) -> DataFrame:
    """left, right: pairs of names that may be within the edits that the floor allows, each once or more."""
    parts = settled(_parts(both, floor))
    key = F.xxhash64("l", "r", *[c for j in (1, 2, 3) for c in (f"x.i{j}", F.substring(F.col("name"), F.col(f"x.p{j}"), F.col(f"x.n{j}")))]).alias("key")

    def keyed(places: DataFrame, own: str, other: str, as_: str) -> DataFrame:
        by_length = places.groupBy(own).agg(F.collect_set(F.struct(*[c for c in parts.columns if c != own])).alias("places"))
        x = both.where(f"in_{as_}").select("name", F.length("name").alias(own)).join(F.broadcast(by_length), own)  # a row for each length
        return x.select("name", own, F.explode("places").alias("x")).select("name", own, f"x.{other}", "x").select(F.col("name").alias(as_), key)

    return keyed(_moved(parts), "l", "r", "left").hint("merge").join(keyed(parts, "r", "l", "right"), "key").select("left", "right")


def _within_edits(pairs: DataFrame, floor: float) -> DataFrame:
    """Pairs by a banded distance, before those that meet more than once are made one."""
    return pairs.where(F.expr(f"levenshtein(left, right, CAST(floor(greatest(length(left), length(right)) * {1 - floor!r}D + {EPS!r}D) AS INT)) >= 0"))


#: Letters of the runs at which names meet of which one lies within the other, if the shorter has as many.
LONG_RUN = 8


def _within(both: DataFrame, least: int) -> DataFrame:
    """left, right: pairs of different names of which one, of `least` letters or more, lies in the other. They meet at the rarest run of letters of the shorter."""
    size, long_ = F.length("name"), max(least, LONG_RUN)
    runs_of = lambda q: F.array_distinct(F.transform(F.sequence(F.lit(1), size - (q - 1)), lambda i: F.substring(F.col("name"), i, F.lit(q))))
    own = F.when(size >= long_, runs_of(long_)).otherwise(runs_of(least))
    inner = both.where(size >= least).select("name", "in_left", "in_right", F.explode(own).alias("run"))
    shorter = both.select(F.length("name").alias("n")).where(f"n >= {least} AND n < {long_}").limit(1).count() > 0
    every = F.when(size >= long_, F.concat(runs_of(long_), runs_of(least)) if shorter and long_ > least else runs_of(long_)).otherwise(runs_of(least))
    outer = both.where(size > least).select(F.col("name").alias("long"), F.col("in_left").alias("ll"), F.col("in_right").alias("lr"), F.explode(F.array_distinct(every)).alias("run"))
    often = outer.groupBy("run").agg(F.count("*").alias("n"))
    rarest = inner.join(often.hint("merge"), "run").groupBy("name", "in_left", "in_right").agg(F.min(F.struct("n", "run"))["run"].alias("run"))
    rarest = rarest.select(F.col("name").alias("short"), F.col("in_left").alias("sl"), F.col("in_right").alias("sr"), "run")
    held = rarest.hint("merge").join(outer, "run").where((F.length("short") < F.length("long")) & F.contains("long", "short"))
    sides = F.array(F.when(F.col("sl") & F.col("lr"), F.struct(F.col("short").alias("left"), F.col("long").alias("right"))), F.when(F.col("sr") & F.col("ll"), F.struct(F.col("long").alias("left"), F.col("short").alias("right"))))
    return held.select(F.inline(F.array_compact(sides)))


def similar_names(left: DataFrame, right: DataFrame, floor: float, measure: str = "edit", least: int = 4, contained: float | None = 0.94) -> DataFrame:
    """left, right, score: every pair of distinct names (column name of both tables) whose score is at least `floor`, which is over .5.

    The score is `exprs.name_sim` (measure edit) or the sequence ratio with the same rules (measure sequence): 1 for equal names, at least `contained` if one of
    `least` letters or more lies in the other, else the measure. `contained` None leaves that rule out. Null and blank names are in no pair.
    """
    if not 0.5 < floor <= 1:
        raise ValueError("names of which half may differ share nothing that they could meet at")
    if measure not in ("edit", "sequence"):
        raise ValueError(f"unknown measure {measure}")
    sequence = measure == "sequence"
    marked = lambda df, l, r: df.where(F.length("name") > 0).select("name", F.lit(l).alias("in_left"), F.lit(r).alias("in_right"))
    both = settled(marked(left, True, False).union(marked(right, False, True)).groupBy("name").agg(F.max("in_left").alias("in_left"), F.max("in_right").alias("in_right")))
    pairs = _sharing_letters(both, floor) if sequence else _within_edits(_sharing_parts(both, floor), floor)
    if contained is not None and floor <= contained:
        pairs = pairs.union(_within(both, least))
    return settled(_scored(pairs.distinct(), sequence, least, contained).where(F.col("score") >= floor))


def _scored(pairs: DataFrame, sequence: bool, least: int, contained: float | None) -> DataFrame:
    a, b = F.col("left"), F.col("right")
    if sequence and contained is None:
        return pairs.withColumn("score", plain_ratio(a, b))
    if sequence:
        return pairs.withColumn("score", sequence_sim(a, b))
    return pairs.withColumn("score", E.edit_similarity(a, b) if contained is None else E.name_sim(a, b, least, contained))


def core_pairs(left: DataFrame, right: DataFrame, floor: float) -> DataFrame:
    """left, right, score: every pair of distinct names whose `exprs.core_sim` is at least `floor`, which is over .82.

    Such a pair has one set of words within the other, so it meets at the rarest word of the smaller.
    """
    if floor <= 0.82:
        raise ValueError("below .82 names may share any of their words")
    core = lambda df, as_: df.where(F.length("name") > 0).select("name").distinct().select(F.col("name").alias(as_), F.explode(E.core_tokens(F.col("name"))).alias("w"))
    a, b = core(left, "left"), core(right, "right")
    often = a.select("w").union(b.select("w")).groupBy("w").agg(F.count("*").alias("n"))
    rarest = lambda df, as_: df.join(often, "w").groupBy(as_).agg(F.min(F.struct("n", "w"))["w"].alias("w"))
    pairs = rarest(a, "left").join(b, "w").select("left", "right").union(rarest(b, "right").join(a, "w").select("left", "right")).distinct()
    return pairs.withColumn("score", E.core_sim(F.col("left"), F.col("right"))).where(F.col("score") >= floor)


def best_names(pairs: DataFrame, profile: NameProfile, scope: list[str] | None = None) -> DataFrame:
    """scope.., left, right, score, runner_up, accepted: for each name the candidate of the highest score (of equals the last by name) in each scope.

    It is accepted from the profile's floor on if it is `sure` or leads the runner-up by the margin. Pairs have to go down to floor - margin.
    """
    w = Window.partitionBy(*(scope or []), "left").orderBy(F.desc("score"), F.desc("right"))
    x = pairs.withColumn("_n", F.row_number().over(w)).withColumn("runner_up", F.lead("score").over(w)).where("_n = 1").drop("_n")
    clear = (F.col("score") >= profile.sure) | F.col("runner_up").isNull() | (F.col("score") - F.col("runner_up") >= profile.margin)
    return x.withColumn("accepted", (F.col("score") >= profile.floor) & clear)


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column that is computed once for each row: filters on it stay behind the explode and don't repeat it in a join's condition."""
    return df.withColumn(name, F.explode(F.array(value)))


def _both_sides(df: DataFrame) -> DataFrame:
    return df.select(F.explode(F.array("home", "away")).alias("name"))


def pair_candidates(rows: DataFrame, targets: DataFrame, floor: float, measure: str = "edit") -> DataFrame:
    """row_id, event_id, hs, as_, score: all rows (row_id, home, away) and targets (event_id, home, away) whose names are both at least `floor` alike; score is the mean."""
    edit = measure == "edit"
    sides = (lambda df: df.select(F.col("home").alias("name"))) if edit else _both_sides  # letters are cheap to compare where pairs meet; sequences are found once for each pair of names
    index = similar_names(sides(rows), sides(targets), floor, measure)
    like = lambda c, s: index.withColumnsRenamed({"left": f"r_{c}", "right": f"t_{c}", "score": s})
    r = rows.select("row_id", F.col("home").alias("r_home"), F.col("away").alias("r_away"))
    t = targets.select("event_id", F.col("home").alias("t_home"), F.col("away").alias("t_away"))
    c = r.join(like("home", "hs"), "r_home").join(t, "t_home")
    c = c.withColumn("as_", E.name_sim(F.col("r_away"), F.col("t_away"))).where(F.col("as_") >= floor) if edit else c.join(like("away", "as_"), ["r_away", "t_away"])
    return c.select("row_id", "event_id", "hs", "as_", ((F.col("hs") + F.col("as_")) / 2).alias("score"))


def link_names(rows: DataFrame, targets: DataFrame, profile: NameProfile, measure: str = "edit") -> DataFrame:
    """row_id, event_id, score, runner_up, status: one row for each of rows, by names alone.

    LINKED; AMBIGUOUS where the best does not lead; BELOW where its mean is too low; NO_CANDIDATE where no target has both sides above the floor. Of
    equal scores the smaller event_id.
    """
    c = pair_candidates(rows, targets, profile.floor, measure)
    w = Window.partitionBy("row_id").orderBy(F.desc("score"), "event_id")
    c = c.withColumn("_n", F.row_number().over(w)).withColumn("runner_up", F.lead("score").over(w)).where("_n = 1")
    clear = (F.col("score") >= profile.sure) | F.col("runner_up").isNull() | (F.col("score") - F.col("runner_up") >= profile.margin)
    status = F.when(F.col("score").isNull(), "NO_CANDIDATE").when(F.col("score") < profile.accept, "BELOW").when(clear, "LINKED").otherwise("AMBIGUOUS")
    return rows.select("row_id").join(c, "row_id", "left").select("row_id", "event_id", "score", "runner_up", status.alias("status"))


def _best_candidates(rows: DataFrame, targets: DataFrame, profile: NameProfile, measure: str = "edit", fold: Callable[[Column], Column] = lambda c: c, named: DataFrame | None = None) -> DataFrame:
    """row_id, event_id, score: of the candidates that the profile accepts, those of which any can be the best of its row or of its target.

    An accepted pair has a side of `accept` at least. The far side has more names, so rows and targets meet there from `accept` on. Others have a far name below and a near one of `most` at best:
    only rows and targets whose best known candidate scores no more than that could still have such a one as their best, and meet from the floor on. Names are folded by `fold` once each and not in rows;
    `named` has all names of rows where that is cheaper to read.
    """
    p, names = profile, _names(rows if named is None else named, targets, fold)
    near, far = _fewer_names(names)
    of = lambda side, left: names.where((F.col("side") == side) & (F.col("in_left") == left))
    known_as = lambda side, left, as_: of(side, left).select(F.col("raw").alias(f"{as_}_{'near' if side == near else 'far'}"), F.col("name").alias(as_))
    nearby = similar_names(of(near, True).select("name"), of(near, False).select("name"), p.accept, measure)

    def side(df: DataFrame, key: str, left: bool, as_: str) -> DataFrame:
        most = nearby.groupBy(F.col("left" if left else "right").alias(as_)).agg(F.max("score").alias(f"{as_}_most"))
        x = df.select(key, F.col(near).alias(f"{as_}_near"), F.col(far).alias(f"{as_}_far"))
        return x.join(settled(known_as(near, left, as_).join(most, as_, "left")), f"{as_}_near")

    r, t = side(rows, "row_id", True, "r"), side(targets, "event_id", False, "t")

    def like(floor: float, rs: DataFrame | None = None, ts: DataFrame | None = None) -> DataFrame:
        """r_far, t_far, known: the far names that are `floor` alike, as rows and targets have them."""
        of_far = lambda left, df, as_: known_as(far, left, as_) if df is None else known_as(far, left, as_).join(df.select(f"{as_}_far").distinct(), f"{as_}_far", "left_semi")
        a, b = of_far(True, rs, "r"), of_far(False, ts, "t")
        pairs = similar_names(a.select(F.col("r").alias("name")), b.select(F.col("t").alias("name")), floor, measure)
        return pairs.select(F.col("left").alias("r"), F.col("right").alias("t"), F.col("score").alias("known")).join(a, "r").join(b, "t").drop("r", "t")

    def meet(r: DataFrame, t: DataFrame, like: DataFrame) -> DataFrame:
        a, b = F.col("r"), F.col("t")
        c = _once(r.join(like, "r_far").join(t, "t_far"), "other", E.name_sim(a, b) if measure == "edit" else sequence_sim(a, b)).where(F.col("other") >= p.floor)
        return c.withColumn("score", (F.col("known") + F.col("other")) / 2).where(F.col("score") >= p.accept).select("row_id", "event_id", "score", "r_most", "t_most")

    known = settled(meet(r, t, like(p.accept)))

    def rest(df: DataFrame, key: str, most: str) -> DataFrame:
        told = known.groupBy(key).agg(F.max("score").alias("s"), F.max(most).alias("m")).where((F.col("m").isNull()) | (F.col("s") > (p.accept + F.col("m")) / 2 + EPS))
        return settled(df.where(F.col(most).isNotNull()).join(told, key, "left_anti"))

    c, found = known, ["row_id", "event_id", "score"]
    for less, rs, ts in ((x := rest(r, "row_id", "r_most"), x, t), (x := rest(t, "event_id", "t_most"), r, x)):
        if not less.isEmpty():
            c = c.union(meet(rs, ts, like(p.floor, rs if less is rs else None, ts if less is ts else None)))
    return c.select(*found).repartition("row_id").distinct()


#: Words of a draw, as book rows have them. Fixed values.
DRAW = ("draw", "empate")


def book_quotes(raw: DataFrame, targets: DataFrame, market: str = "40", measure: str = "edit") -> tuple[DataFrame, DataFrame]:
    """Three prices for each target from a bookmaker's long rows, and what was rejected with a reason.

    raw: fixture_id, market_id, home, away, selection, price (text); targets: event_id, home, away. Only rows of `market` count. A fixture links by the profile
    `book`; a target that several fixtures link to goes to the one that is its best, if the target is also that one's best. A selection is a
    side if it is .80 like its name, home first. Of several prices of a side the last by (selection, price) counts. Quotes without all three prices are rejected.
    """
    p = PROFILES["book"]
    rows = raw.where((F.col("market_id") == market) & (F.coalesce(F.trim("fixture_id"), F.lit("")) != ""))
    fold = lambda c: E.fold_name(F.col(c)).alias(c)
    fixtures = rows.groupBy("fixture_id").agg(F.min(F.struct("home", "away")).alias("s")).select(F.col("fixture_id").alias("row_id"), F.col("s.home").alias("home"), F.col("s.away").alias("away"))
    c = _best_candidates(fixtures, targets.select("event_id", "home", "away"), p, measure, E.fold_name, rows)
    rank = lambda k, o: F.row_number().over(Window.partitionBy(k).orderBy(F.desc("score"), o))
    best = c.withColumn("_r", rank("row_id", "event_id")).withColumn("_t", rank("event_id", "row_id"))
    linked = best.where("_r = 1 AND _t = 1").select("row_id", "event_id", "score")

    s = rows.select(F.col("fixture_id").alias("row_id"), fold("selection"), F.expr("try_cast(price AS double)").alias("price"), F.col("home").alias("h"), F.col("away").alias("a")).where("price IS NOT NULL")
    s = s.select("row_id", "selection", "price", E.fold_name(F.col("h")).alias("h"), E.fold_name(F.col("a")).alias("a"))
    like = lambda c: E.name_sim(F.col("selection"), F.col(c)) if measure == "edit" else sequence_sim(F.col("selection"), F.col(c))
    s = _once(s, "side", F.when(like("h") >= 0.80, "H").when(F.col("selection").isin(*DRAW), "D").when(like("a") >= 0.80, "A"))
    price = lambda x: F.max(F.when(F.col("side") == x, F.struct("selection", "price")))["price"].alias(x.lower())
    prices = s.groupBy("row_id").agg(price("H"), price("D"), price("A"))
    whole = F.col("h").isNotNull() & F.col("d").isNotNull() & F.col("a").isNotNull()
    quotes = linked.join(prices, "row_id").where(whole).select("event_id", "row_id", "score", "h", "d", "a")  # by links alone: fixtures without one are told only where they are asked for
    x = fixtures.select("row_id").join(best.groupBy("row_id").agg(F.max("score").alias("top")), "row_id", "left").join(linked, "row_id", "left").join(prices, "row_id", "left")
    x = x.withColumn("reason", F.when(F.col("top").isNull(), "NO_NAME_PAIR").when(F.col("event_id").isNull(), "TARGET_TAKEN").when(~whole, "PRICES_INCOMPLETE"))
    return quotes, x.where("reason IS NOT NULL").select("row_id", "reason")


#: Words that no slug is told by. Fixed values.
SLUG_NOISE = ("women", "womens", "woman", "femenino", "femenina", "fem", "res", "reserve", "fc", "cf", "sc", "club")


def slug_words(c: Column) -> Column:
    return F.filter(F.array_except(E.tokens(E.fold_name(c)), F.array(*[F.lit(w) for w in SLUG_NOISE])), lambda w: F.length(w) >= 3)


def link_slugs(targets: DataFrame, links: DataFrame, profile: NameProfile = PROFILES["slug"]) -> DataFrame:
    """event_id, url, score, runner_up, status (LINKED, AMBIGUOUS, NO_CANDIDATE): the detail page of each target by the words of its path.

    targets: event_id, home, away, kickoff; links: url. A side's score is the share of its words found in the path; a date in the url has to be the
    kickoff's, the day before or the day after. Of equal scores the better worse side, then the last url. Candidates share a word of the home side, as any side above the floor does.
    """
    path = F.regexp_replace(F.regexp_replace("url", r"^[A-Za-z]+://[^/]*", ""), r"[?#].*$", "")
    u = links.select("url").distinct().select("url", slug_words(path).alias("words"), (F.regexp_extract("url", r"\d{2}-\d{2}-\d{4}", 0) != "").alias("dated"))
    t = targets.select("event_id", "kickoff", slug_words(F.col("home")).alias("h"), slug_words(F.col("away")).alias("a")).where(F.size("a") > 0)
    # A pair counts at the first word that it shares only, and is scored there: neither pairs nor what they are scored by move again.
    share = lambda c: F.size(F.array_intersect(c, "words")) / F.size(c)
    c = u.select("*", F.explode("words").alias("w")).join(t.select("*", F.explode("h").alias("w")), "w").where(F.get(F.array_intersect("h", "words"), F.lit(0)) == F.col("w"))
    c = c.withColumn("hs", share("h")).withColumn("as_", share("a")).withColumn("worse", F.least("hs", "as_"))
    on_day = lambda n: F.contains("url", F.date_format(F.date_add(F.to_date("kickoff"), n), "dd-MM-yyyy"))
    c = c.where(~F.col("dated") | on_day(-1) | on_day(0) | on_day(1)).withColumn("score", (F.col("hs") + F.col("as_")) / 2)
    c = c.where((F.col("score") >= profile.accept) & (F.col("worse") >= profile.floor)).select("event_id", "url", "score", "worse")
    w = Window.partitionBy("event_id").orderBy(F.desc("score"), F.desc("worse"), F.desc("url"))
    c = c.withColumn("_n", F.row_number().over(w)).withColumn("runner_up", F.lead("score").over(w)).where("_n = 1")
    clear = (F.col("score") >= profile.sure) | F.col("runner_up").isNull() | (F.col("score") - F.col("runner_up") >= profile.margin)
    status = F.when(F.col("score").isNull(), "NO_CANDIDATE").when(clear, "LINKED").otherwise("AMBIGUOUS")
    return targets.select("event_id").join(c, "event_id", "left").select("event_id", "url", "score", "runner_up", status.alias("status"))


@dataclass(frozen=True)
class AnchorProfile:
    """A link by both names and clock, or by one strong name at almost the same time. Fixed values by use below."""

    minutes: int
    decay: int
    floor: float
    accept: float
    sure: float
    margin: float
    anchor_minutes: int = 10
    anchor: float = 0.85
    other: float = 0.35
    no_clock: float | None = None


ANCHORED = {"live": AnchorProfile(120, 180, 0.58, 0.74, 0.90, 0.06, no_clock=0.75), "player": AnchorProfile(150, 150, 0.60, 0.78, 0.92, 0.06)}


def _names(rows: DataFrame, targets: DataFrame, fold: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """side, in_left, raw, name: the different names of rows and of targets, found in one pass over both, and folded once each."""
    sides = F.inline(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("raw")) for s in ("home", "away")]))
    of = lambda df, left: df.select(sides).select("side", F.lit(left).alias("in_left"), "raw")
    return settled(_once(of(rows, True).union(of(targets, False)).distinct(), "name", fold(F.col("raw"))).where(F.length("name") > 0))


def _fewer_names(names: DataFrame) -> tuple[str, str]:
    """The side with fewer different names, and the other one: an index of few names is cheap at low floors, where most names of a long one meet."""
    n = names.select("side", "name").distinct().groupBy("side").count().collect()
    n = {x["side"]: x["count"] for x in n}
    return ("away", "home") if n.get("away", 0) < n.get("home", 0) else ("home", "away")


#: Floors of the names that a row is told by where the runner-up is not asked for: first of all rows, then of those without a clock. Fixed values.
TOLD, TOLD_LOW = 0.80, 0.70


class _Anchored:
    """Rows (row_id, home, away, kickoff) and targets that meet by names of the profile and are scored as they meet."""

    def __init__(self, rows: DataFrame, targets: DataFrame, profile: AnchorProfile, measure: str):
        self.p, self.measure, self.width = profile, measure, profile.minutes * 60
        self.names = _names(rows, targets)
        self.near, self.far = _fewer_names(self.names)
        self.rows = rows.select("row_id", F.col("home").alias("rh"), F.col("away").alias("ra"), F.col("kickoff").alias("rk"))
        self.targets = targets.select("event_id", F.col("home").alias("th"), F.col("away").alias("ta"), F.col("kickoff").alias("tk"))

    def index(self, side: str, floor: float, names: DataFrame | None = None) -> DataFrame:
        """own, its, known: the names of rows, or of these, and of targets that are `floor` alike on a side."""
        of = lambda left: self.names.where((F.col("side") == side) & (F.col("in_left") == left)).select("name")
        return similar_names(of(True) if names is None else names, of(False), floor, self.measure).select(F.col("left").alias("own"), F.col("right").alias("its"), F.col("score").alias("known"))

    def _scored(self, c: DataFrame, s: str, keep: list[str]) -> DataFrame:
        p, sim = self.p, (lambda a, b: E.name_sim(F.col(a), F.col(b))) if self.measure == "edit" else (lambda a, b: sequence_sim(F.col(a), F.col(b)))
        c = c.withColumn("gap", F.abs(F.unix_seconds("rk") - F.unix_seconds("tk"))).where(F.col("gap").isNull() | (F.col("gap") <= self.width))
        home = s == "home"
        c = _once(c, "other", sim("ra", "ta") if home else sim("rh", "th")).withColumns({"hs": F.col("known" if home else "other"), "as_": F.col("other" if home else "known")}).withColumn("low", F.least("hs", "as_")).withColumn("high", F.greatest("hs", "as_"))
        anchored = F.coalesce(F.col("gap") <= p.anchor_minutes * 60, F.lit(False)) & (F.col("high") >= p.anchor) & (F.col("low") >= p.other)
        return c.withColumn("anchored", anchored).where((F.col("low") >= p.floor) | F.col("anchored")).select("row_id", "event_id", "rh", "ra", "th", "ta", "rk", "tk", "gap", "hs", "as_", "low", "high", "anchored", *keep)

    def clocked(self, rows: DataFrame, index: DataFrame, s: str, widths: int, keep: list[str] | None = None) -> DataFrame:
        """Candidates of rows with a clock by a side's index; they meet in spans of `widths` times the time bound. A row goes to its spans once its names are known."""
        span = widths * self.width
        at = lambda k, by=0: F.floor((F.unix_seconds(k) + by) / span)
        x = rows.where("rk IS NOT NULL").join(index, F.col(f"r{s[0]}") == F.col("own")).drop("own").withColumn("span", F.explode(F.sequence(at("rk", -self.width), at("rk", self.width))))
        t = self.targets.withColumn("t_span", at("tk"))
        return self._scored(x.join(t, (F.col("its") == F.col(f"t{s[0]}")) & (F.col("span") == F.col("t_span"))), s, keep or [])

    def clockless(self, rows: DataFrame, index: DataFrame, s: str, keep: list[str] | None = None) -> DataFrame:
        """Candidates of rows without a clock by a side's index. Targets of the same two names score the same, so only the first two of them are met."""
        w = Window.partitionBy("th", "ta").orderBy("event_id")
        t = self.targets.repartition("th", "ta").distinct().withColumn("_n", F.row_number().over(w)).where("_n <= 2").drop("_n")
        return self._scored(rows.where("rk IS NULL").join(index, F.col(f"r{s[0]}") == F.col("own")).join(t, F.col("its") == F.col(f"t{s[0]}")), s, keep or [])

    def best(self, c: DataFrame) -> DataFrame:
        """The candidate of each row that scores most, with the score of the next, and its status."""
        p = self.p
        drop = ["rh", "ra", "th", "ta", "rk", "tk"]
        c = c.withColumn("names", F.xxhash64(*drop)).drop(*drop).repartition("row_id").distinct()  # a candidate may be met on either side
        c = c.withColumn("near", F.coalesce(F.greatest(F.lit(0.0), 1 - F.col("gap") / (p.decay * 60)), F.lit(p.no_clock)))
        both = F.col("hs") * 0.42 + F.col("as_") * 0.42 + F.col("near") * 0.16
        strong = F.when(F.col("anchored"), F.col("high") * 0.55 + F.col("low") * 0.25 + F.col("near") * 0.20).otherwise(0.0)
        c = c.withColumn("score", F.greatest(both, strong)).withColumn("path", F.when(strong > both, "ANCHOR").otherwise("BOTH"))
        w = Window.partitionBy("row_id").orderBy(F.desc("score"), "gap", "event_id")
        c = c.withColumn("_n", F.row_number().over(w)).withColumn("runner_up", F.lead("score").over(w)).where("_n = 1")
        clear = (F.col("score") >= p.sure) | F.col("runner_up").isNull() | (F.col("score") - F.col("runner_up") >= p.margin)
        return c.withColumn("status", F.when(F.col("score") < p.accept, "BELOW").when(clear, "LINKED").otherwise("AMBIGUOUS"))

    def told(self, c: DataFrame, floor: float) -> DataFrame:
        """The bests among candidates whose far names are `floor` alike, that are bests of all and have their status whatever else there is.

        Any other candidate has a far name below the floor, a near one of `most` at best, and the row's clock, or no clock as any; it scores less than `others`.
        """
        p = self.p
        near = F.when(F.col("gap").isNull(), F.col("near")).otherwise(1.0)
        both = F.when(F.col("most") >= p.floor, 0.42 * floor + F.col("most") * 0.42 + near * 0.16).otherwise(0.0)
        anchored = F.when(F.col("gap").isNotNull() & (F.col("most") >= p.anchor), F.col("most") * 0.55 + 0.25 * floor + 0.20).otherwise(0.0)
        x = self.best(c).withColumn("others", F.greatest(both, anchored) + EPS)
        status = (F.col("score") >= p.sure) | (F.col("score") < p.accept) | (F.col("score") - F.col("others") >= p.margin) | (F.col("score") - F.col("runner_up") < p.margin)
        return settled(x.where((F.col("score") > F.col("others")) & F.coalesce(status, F.lit(False))).select(*FOUND))


FOUND = ("row_id", "event_id", "score", "hs", "as_", "gap", "path", "status")


def link_anchored(rows: DataFrame, targets: DataFrame, profile: AnchorProfile, measure: str = "edit", runner_up: bool = True) -> DataFrame:
    """row_id, event_id, score, runner_up, hs, as_, gap_seconds, path, status: one row for each of rows (row_id, home, away, kickoff).

    A candidate (targets: event_id, home, away, kickoff) within the time bound has both sides above the floor (path BOTH), or starts within anchor_minutes and has one side of `anchor` and the other
    of `other` at least (path ANCHOR, which counts if it scores more). Scores: .42 and .42 of the sides and .16 of the time's; or .55 of the stronger, .25 of the weaker and .20.
    Rows without a clock have a time score of `no_clock`, or no candidates. LINKED; AMBIGUOUS below `sure` without the margin; BELOW; NO_CANDIDATE.
    Of equal scores the nearer in time, then the smaller event_id. Candidates come out of the name indexes: of the side with fewer names (`_fewer_names`) from the floor on and of the other from the anchor on,
    which leaves none out, since both sides are above the floor or one is an anchor. They are scored as they meet.

    Without `runner_up` that column is left out, and rows that are told by the candidates whose names on the side with more names are most like theirs (`_Anchored.told`) meet no others; a row_id is one row then.
    """
    p, m = profile, _Anchored(rows, targets, profile, measure)
    near, r = m.index(m.near, p.floor), m.rows
    if runner_up:
        far, told = m.index(m.far, p.anchor), None
    else:
        far = m.index(m.far, min(TOLD, p.anchor))
        most = near.groupBy(F.col("own").alias(f"r{m.near[0]}")).agg(F.max("known").alias("most"))
        like = r.join(most, f"r{m.near[0]}", "left").withColumn("most", F.coalesce("most", F.lit(0.0)))
        c = m.clocked(like, far, m.far, 4, ["most"])
        told = m.told(c if p.no_clock is None else c.union(m.clockless(like, far, m.far, ["most"])), min(TOLD, p.anchor))
        rest = lambda x: x.join(told.select("row_id"), "row_id", "left_anti")
        if p.no_clock is not None and p.floor < TOLD_LOW:
            less = settled(rest(like.where("rk IS NULL")))
            if not less.isEmpty():
                low = m.index(m.far, TOLD_LOW, less.select(F.col(f"r{m.far[0]}").alias("name")))
                told = told.union(m.told(m.clockless(less, low, m.far, ["most"]), TOLD_LOW))
        r = settled(rest(r))
    c = m.clocked(r, near, m.near, 1).union(m.clocked(r, far, m.far, 4))
    if p.no_clock is not None and (runner_up or not r.where("rk IS NULL").isEmpty()):
        c = c.union(m.clockless(r, near, m.near))
    found = m.best(c)
    if not runner_up:
        found = told.union(found.select(*FOUND))
    second = ["runner_up"] if runner_up else []
    return rows.select("row_id").join(found, "row_id", "left").select("row_id", "event_id", "score", *second, "hs", "as_", F.col("gap").alias("gap_seconds"), "path", F.coalesce("status", F.lit("NO_CANDIDATE")).alias("status"))
