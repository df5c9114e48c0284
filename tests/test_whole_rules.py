"""The rate limit of 60 seconds and form as evidence, on the tables and on small ones."""

from collections import defaultdict
from datetime import datetime, timedelta

from matchlake import queries as Q
from matchlake import queries_boards, queries_links, queries_more  # noqa: F401  they register their queries
from matchlake import testdata as T
from matchlake.operators import identity

SF = "/root/testdata/sf0.001"
T0 = datetime(2026, 1, 1, 12)


def limited(rows, seconds=60):
    at, out = defaultdict(list), {}
    for e, s, t in rows:
        at[e, s].append(int(t.timestamp()))
    for k, times in at.items():
        last, n = None, 0
        for t in sorted(times):
            if last is None or t - last >= seconds:
                last, n = t, n + 1
        out[k] = (n, last)
    return out


def accepted(df):
    return {(r["event_id"], r["source"]): (r["n_accepted"], int(r["last_accepted"].timestamp())) for r in df.collect()}


def test_rate_limited_on_close_times(spark):
    rows = [(i % 3, "ab"[i % 2], T0 + timedelta(seconds=i * i * 7 % 400)) for i in range(80)]
    assert accepted(identity.rate_limited(spark.createDataFrame(rows, "event_id int, source string, observed_at timestamp"))) == limited(rows)


def test_rate_limited_query_runs_the_rule_of_60_seconds(spark):
    rows = [tuple(r) for r in T.live_stats(spark, SF).select("event_id", "source", "captured_at").collect()]
    got = accepted(Q.QUERIES["x9_rate_limited_60s"](spark, SF))
    assert got == limited(rows) and max(n for n, _ in got.values()) > 1


def test_form_is_evidence_and_a_basis(spark):
    why = Q.QUERIES["md16_evidence_graph_form"](spark, SF).collect()
    assert {r["n"] for r in why} == {1, 2} and {r["conflict"] for r in why} == {True, False}
    assert {r["basis"] for r in Q.QUERIES["md9_scenarios_form"](spark, SF).select("basis").distinct().collect()} == {"CONSENSUS", "FORM", "NONE"}
