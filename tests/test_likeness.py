"""Similarity joins against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from matchlake.functions import exprs as E
from matchlake.functions.names import likeness, ratio
from matchlake.operators import likeness as K


def misspelt(seed, n):
    rng = random.Random(seed)
    parts = ["inter", "nazionale", "nacional", "real", "sporting", "united", "city", "st", "ajax", "psv", "bayern", "munich", "paris", "b", "o"]
    out = []
    for _ in range(n):
        name = "".join(rng.choice([" ", ""]) + rng.choice(parts) for _ in range(rng.randint(1, 3))).strip()
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(name) + 1)
            name = rng.choice([name[:at] + rng.choice("abcxyz ") + name[at:], name[:at] + name[at + 1 :], name[:at] + rng.choice("aeiou") + name[at + 1 :]])
        out.append(name)
    return out


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def score(a, b, measure, contained=0.94):
    if measure == "sequence":
        return likeness(a, b) if contained else ratio(a, b)
    if a == b:
        return 1.0
    short, long_ = sorted((len(a), len(b)))
    if contained and short >= 4 and (a in b or b in a):
        return max(contained, short / long_)
    return 1 - distance(a, b) / long_


LEFT, RIGHT = misspelt(1, 150) + ["", "a", "ab", "internazionale"], misspelt(2, 150) + ["", "b", "ab", "internacional", "internazionale milano"]


def frame(spark, names):
    return spark.createDataFrame([(n,) for n in [*names, None, *names[:5]]], "name string").repartition(3)


@pytest.mark.parametrize("measure,floor,contained", [("edit", 0.55, 0.94), ("edit", 0.73, 0.94), ("edit", 0.78, None), ("edit", 0.9, 0.94), ("edit", 0.97, 0.94), ("sequence", 0.6, 0.94), ("sequence", 0.78, 0.94), ("sequence", 0.875, None)])
def test_no_pair_is_lost(spark, measure, floor, contained):
    got = {(r["left"], r["right"]): r["score"] for r in K.similar_names(frame(spark, LEFT), frame(spark, RIGHT), floor, measure, contained=contained).collect()}
    want = {(a, b): s for a in set(LEFT) if a for b in set(RIGHT) if b if (s := score(a, b, measure, contained)) >= floor - 1e-12}
    assert set(got) == set(want) and len(want) >= 4
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_true_link_without_a_common_word(spark):
    got = K.similar_names(frame(spark, ["internazionale"]), frame(spark, ["internacional"]), 0.78).collect()
    assert [(r["left"], r["right"]) for r in got] == [("internazionale", "internacional")]


def test_few_pairs_are_compared(spark, monkeypatch):
    """Of unlike names only few meet: far below all pairs."""
    rng = random.Random(5)
    names = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(14)) for _ in range(600)]
    seen = []
    scored = K._scored
    monkeypatch.setattr(K, "_scored", lambda pairs, *a: seen.append(pairs.count()) or scored(pairs, *a))
    K.similar_names(frame(spark, names), frame(spark, names), 0.78).collect()
    assert seen[0] < 0.05 * 600 * 600


def test_no_pair_is_lost_at_three_parts(spark, monkeypatch):
    monkeypatch.setattr(K, "MANY", 1)
    left, right = [n[:14].ljust(14, "o") for n in misspelt(3, 120)], [n[:14].ljust(14, "o") for n in misspelt(4, 120)]
    left += [n[:3] + n[4:] for n in right[:40]] + [n[1:6] + "q" + n[6:9] + "z" + n[10:] for n in right[40:80]]
    got = {(r["left"], r["right"]) for r in K.similar_names(frame(spark, left), frame(spark, right), 0.70).collect()}
    assert got == {(a, b) for a in set(left) for b in set(right) if score(a, b, "edit") >= 0.70 - 1e-12} and len(got) > 80


def test_unlike_names_do_not_meet(spark):
    """Few letters and equal lengths, as many names have them: of a million pairs less than a thousandth meet, and none that is like another is lost."""
    rng = random.Random(7)
    names = sorted({"".join(rng.choice("abcdefghijklmnop") for _ in range(7)) + " " + "".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(1000)})
    own = [n[:4] + "xyz"[i % 3] + n[5:9] + n[10:] for i, n in enumerate(names)]
    both = frame(spark, own).selectExpr("name", "true AS in_left", "false AS in_right").union(frame(spark, names).selectExpr("name", "false", "true")).where("name IS NOT NULL").distinct()
    met = K._sharing_parts(both, 0.73)
    assert met.count() < 20_000
    assert {(a, b) for a, b in zip(own, names, strict=True)} <= set(map(tuple, met.distinct().collect()))
    assert met.distinct().count() < 2_000


def test_low_floors_are_refused(spark):
    with pytest.raises(ValueError):
        K.similar_names(frame(spark, ["a"]), frame(spark, ["a"]), 0.5)


def test_core_pairs(spark):
    rng = random.Random(3)
    words = ["real", "madrid", "fc", "club", "de", "city", "united", "town", "york", "new"]
    names = sorted({" ".join(rng.sample(words, rng.randint(1, 8))) for _ in range(150)})
    df = frame(spark, names)
    a, b = df.select(F.col("name").alias("left")).distinct(), df.select(F.col("name").alias("right")).distinct()
    want = a.crossJoin(b).where("left IS NOT NULL AND right IS NOT NULL").withColumn("score", E.core_sim(F.col("left"), F.col("right"))).where("score >= 0.875")
    got = sorted(map(tuple, K.core_pairs(df, df, 0.875).collect()))
    assert got == sorted(map(tuple, want.select("left", "right", "score").collect())) and len(got) > 150


def test_best_names_asks_for_a_lead(spark):
    pairs = spark.createDataFrame([("a", "x", 0.80), ("a", "y", 0.77), ("b", "x", 0.95), ("b", "y", 0.949), ("c", "x", 0.9), ("d", "x", 0.77), ("e", "p", 0.9), ("e", "q", 0.9)], "left string, right string, score double")
    got = {r["left"]: (r["right"], r["accepted"]) for r in K.best_names(pairs, K.PROFILES["history"]).collect()}
    assert got == {"a": ("x", False), "b": ("x", True), "c": ("x", True), "d": ("x", False), "e": ("q", False)}


def test_link_names_gives_every_row_a_status(spark):
    rows = spark.createDataFrame([(1, "internazionale", "juventus"), (2, "internazionale", "torino"), (3, "nobody here", "juventus"), (4, "aaaaaaaa", "bbbbbbbb"), (5, None, "juventus")], "row_id int, home string, away string")
    targets = spark.createDataFrame([(10, "internacional", "juventus"), (11, "aaaaaaxx", "bbbbbbxx")], "event_id int, home string, away string")
    got = {r["row_id"]: (r["event_id"], r["status"]) for r in K.link_names(rows, targets, K.PROFILES["book"]).collect()}
    assert got == {1: (10, "LINKED"), 2: (None, "NO_CANDIDATE"), 3: (None, "NO_CANDIDATE"), 4: (11, "BELOW"), 5: (None, "NO_CANDIDATE")}


def test_book_quotes(spark):
    raw = [("f1", "40", "Real Madryd", "Barcelona", s, p) for s, p in (("Real Madryd", "1.5"), ("Empate", "3.9"), ("Barcelona", "6"), ("Other", "9"))]
    raw += [("f1", "41", "Real Madryd", "Barcelona", "Barcelona", "99"), ("f2", "40", "Real Madrid X", "Barcelon", "Draw", "4"), ("f3", "40", "Sevilla", "Betis", "Sevilla", "2"), ("f3", "40", "Sevilla", "Betis", "Draw", "x"), ("", "40", "a", "b", "a", "1"), ("f4", "40", "Nobody", "None", "Draw", "1")]
    df = spark.createDataFrame(raw, "fixture_id string, market_id string, home string, away string, selection string, price string")
    targets = spark.createDataFrame([("e1", "Real Madrid", "Barcelona"), ("e2", "Sevilla", "Betis")], "event_id string, home string, away string")
    quotes, rejected = K.book_quotes(df, targets)
    assert [tuple(r)[:2] + tuple(r)[3:] for r in quotes.collect()] == [("e1", "f1", 1.5, 3.9, 6.0)]
    assert {r["row_id"]: r["reason"] for r in rejected.collect()} == {"f2": "TARGET_TAKEN", "f3": "PRICES_INCOMPLETE", "f4": "NO_NAME_PAIR"}


def test_anchored_links_search_the_side_of_fewer_names_at_the_low_floor(spark, monkeypatch):
    homes = misspelt(9, 40)
    games = [(i, h, ["ajax", "porto"][i % 2], 600 * i) for i, h in enumerate(homes)]
    df = lambda key, g: spark.createDataFrame(g, f"{key} long, home string, away string, at long").selectExpr(key, "home", "away", "timestamp_seconds(at) AS kickoff")
    floors, index = {}, K.similar_names
    monkeypatch.setattr(K, "similar_names", lambda left, right, floor, measure: floors.update({floor: right.distinct().count()}) or index(left, right, floor, measure))
    turned = [(i, a, h, t) for i, h, a, t in games]
    for rows in (games, turned):
        got = {r["row_id"]: (r["event_id"], r["status"]) for r in K.link_anchored(df("row_id", rows), df("event_id", rows), K.ANCHORED["live"]).collect()}
        assert floors == {0.58: 2, 0.85: len(set(homes))}
        assert all(got[i] == (i, "LINKED") for i, h, *_ in games if homes.count(h) == 1 and got[i][1] != "AMBIGUOUS") and len(got) == 40
