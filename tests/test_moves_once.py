"""Links whose rows move once to meet, against all pairs."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from matchlake.operators import likeness
from matchlake.plans import context


def _joins(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")


@pytest.mark.parametrize("seed", [1, 2])
def test_rollover_against_all_pairs(spark, seed):
    r = random.Random(seed)
    day, some = lambda: date(1969, 9, 1) + timedelta(days=r.randint(0, 260)), lambda v: None if r.random() < 0.05 else v
    rows = [(i // 2 if i < 20 else i, some(f"h{r.randint(0, 2)}"), some("a"), some(day())) for i in range(300)]
    targets = [(some(i // 2 if i < 30 else i), some(f"h{r.randint(0, 2)}"), "a", some(datetime.combine(day(), datetime.min.time()) + timedelta(hours=r.randint(0, 23)))) for i in range(200)]
    found = {}
    for i, h, a, d in rows:
        for e, th, ta, at in targets:
            if None not in (h, a, d, e, th, at) and (h, a) == (th, ta) and abs((at.date() - d).days) <= 1:
                found.setdefault(i, set()).add(e)
    want = {i: min(e) for i, e in found.items() if len(e) == 1}
    assert 20 < len(want) < len(found)
    got = context.attach_rollover(spark.createDataFrame(rows, "row_id long, home_key string, away_key string, source_date date"), spark.createDataFrame(targets, "event_id long, home_key string, away_key string, kickoff timestamp"))
    assert {x["row_id"]: x["event_id"] for x in got.collect()} == want
    assert got.columns == ["row_id", "event_id"]
    assert _joins(got) == 0


def test_slugs_are_scored_where_they_meet(spark):
    t = spark.createDataFrame([(1, "Red Star", "Blue Sky", datetime(2026, 1, 2)), (2, "Red Moon", "Blue Sky", datetime(2026, 1, 2)), (3, "Lone", "", datetime(2026, 1, 2))], "event_id long, home string, away string, kickoff timestamp")
    u = spark.createDataFrame([("https://x.example/red-star-blue-sky/red",), ("https://x.example/red-moon-sky-03-01-2026",), ("https://x.example/lone",)], "url string")
    got = likeness.link_slugs(t, u)
    assert {x["event_id"]: (x["url"], x["score"], x["runner_up"], x["status"]) for x in got.collect()} == {
        1: ("https://x.example/red-star-blue-sky/red", 1.0, None, "LINKED"), 2: ("https://x.example/red-star-blue-sky/red", 0.75, 0.75, "AMBIGUOUS"), 3: (None, None, None, "NO_CANDIDATE"),
    }
    assert _joins(got) == 2
