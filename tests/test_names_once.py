"""Names that are folded and looked up once, and evidence that one strong side leads to."""

from pyspark.sql import functions as F

from matchlake.functions import exprs as E
from matchlake.operators import likeness as K
from matchlake.plans import boards, context
from matchlake.sources import feeds


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_folded_names_are_told_by_one_look(spark):
    want = {"red star": "red star", "": "", " red": "red", "red ": "red", "red  star": "red star", "red\n": "red", "red star\n": "red star", "Red": "red", "a&b": "a and b", "Łódź": "lodz", "4 x": "4 x", "-": "", "red\tstar": "red star", None: None}
    df = spark.createDataFrame([(n,) for n in want], "name string")
    got = df.select("name", E.fold_name(F.col("name")).alias("k"))
    assert {r["name"]: r["k"] for r in got.collect()} == want
    assert "RLIKE" in _plan(got).upper()


def test_ratings_and_datasets_read_fixtures_once(spark):
    f = spark.range(6).select(F.col("id").alias("event_id"), F.concat(F.lit("red star "), F.col("id") % 2).alias("home"), F.lit("blue sky").alias("away"), F.lit("L").alias("competition"))
    ratings = spark.createDataFrame([("red star 0", 1.5), ("blue  sky", 2.5)], "name string, rating double")
    got = context.match_ratings(f.select(F.col("home").alias("name")).union(f.select("away")), ratings)
    assert {r["name"]: (r["rating"], r["match"]) for r in got.where("match >= 0.99").collect()} == {"red star 0": (1.5, 1.0), "blue sky": (2.5, 1.0)}
    assert "Range" not in _plan(got)
    sets = spark.createDataFrame([(1, "red star 0", None), (1, "blue sky", None)], "dataset int, name string, competition string")
    found = boards.discover_dataset(f, sets)
    assert {r["event_id"]: r["path"] for r in found.collect() if r["event_id"] % 2 == 0} == {0: "DISCOVERED", 2: "DISCOVERED", 4: "DISCOVERED"}
    assert "Range" not in _plan(found)


def test_evidence_is_led_by_the_stronger_side(spark, monkeypatch):
    floors, real = [], K.similar_names
    monkeypatch.setattr(K, "similar_names", lambda a, b, floor, *x, **y: floors.append(floor) or real(a, b, floor, *x, **y))
    # ten letters of which three differ are .70 alike: enough beside a side that is equal, too little beside one of .80
    lines = [(1, 0, "abcdefghij"), (1, 3, "klmnopqxyz"), (2, 0, "abcdefgxyz"), (2, 1, "klmnopqrst"), (3, 0, "abcdefghxy"), (3, 1, "klmnopqxyz"), (4, 0, "abcdefghij"), (4, 6, "klmnopqrst"), (5, 2, "abcdefghij"), (5, 1, "klmnopqrst")]
    df = spark.createDataFrame([(*x, "c") for x in lines], "doc_id int, pos int, line string, competition string")
    targets = spark.createDataFrame([(7, "abcdefghij", "klmnopqrst", "h", "a")], "event_id int, home string, away string, home_key string, away_key string")
    none = spark.createDataFrame([], "competition string, name_key string, entity string")
    got = feeds.fixture_evidence(df, targets, none, none.drop("competition")).collect()
    assert [(r["event_id"], r["source_home"], r["source_away"], round(r["score"], 6), r["status"], r["path"]) for r in got] == [(7, "abcdefghij", "klmnopqxyz", 0.85, "CANDIDATE", "DISCOVERY")]
    assert floors == [0.76]
    assert feeds.fixture_evidence(df.where("doc_id >= 3"), targets, none, none.drop("competition")).count() == 0
    assert feeds.fixture_evidence(df.where("doc_id = 2"), targets, none, none.drop("competition")).count() == 1


def test_quotes_do_not_ask_for_what_was_rejected(spark):
    rows = [("1", "40", "red star", "blue sky", s, p) for s, p in (("red star", "1.5"), ("draw", "3"), ("blue sky", "4"))] + [("2", "40", "nobody", "here", "draw", "3"), ("3", "40", "red star", "blue sky", "draw", "3")]
    raw = spark.createDataFrame(rows, "fixture_id string, market_id string, home string, away string, selection string, price string")
    quotes, rejected = K.book_quotes(raw, spark.createDataFrame([("9", "red star", "blue sky")], "event_id string, home string, away string"))
    assert [tuple(r) for r in quotes.collect()] == [("9", "1", 1.0, 1.5, 3.0, 4.0)]
    assert {r["row_id"]: r["reason"] for r in rejected.collect()} == {"2": "NO_NAME_PAIR", "3": "TARGET_TAKEN"}
    assert "LeftOuter" not in _plan(quotes)
