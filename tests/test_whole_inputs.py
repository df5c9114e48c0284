"""Queries whose operators once saw a subset of the ids are given every row."""

import pytest

from matchlake import queries as Q
from matchlake import queries_boards, queries_links, queries_more  # noqa: F401  they register their queries
from matchlake import testdata as T
from matchlake.operators import identity, links
from matchlake.plans import boards, context

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, module, operator", [
    ("j4_link_fuzzy", links, "link_fuzzy"), ("j23_provisional_links", boards, "provisional_links"), ("m21_learn_availability", boards, "learn_availability"),
    ("j7_attach_tiered_all", context, "attach_tiered"), ("j8_attach_rollover_all", context, "attach_rollover"), ("a23_overlap_diagnostics_all", boards, "overlap_diagnostics"),
    ("m14_opportunity_queue_all", identity, "opportunity_queue"), ("m32_refresh_core_all", boards, "refresh_core"),
    ("j7_attach_tiered", context, "attach_tiered"), ("j8_attach_rollover", context, "attach_rollover"), ("a23_overlap_diagnostics", boards, "overlap_diagnostics"),
    ("m14_opportunity_queue", identity, "opportunity_queue"), ("m32_refresh_core", boards, "refresh_core"),
])
def test_operator_sees_all_rows(spark, monkeypatch, name, module, operator):
    seen, real = [], getattr(module, operator)
    monkeypatch.setattr(module, operator, lambda rows, *a, **b: seen.append(rows) or real(rows, *a, **b))
    Q.QUERIES[name](spark, SF)
    ids = lambda df, c: {r[0] for r in df.select(c).collect()}
    assert ids(seen[0], "row_id" if "row_id" in seen[0].columns else "event_id") == ids(T.results(spark, SF), "event_id")


def test_every_row_is_linked_by_name_and_clock(spark):
    got = {r["row_id"] for r in Q.QUERIES["j4_link_fuzzy"](spark, SF).collect()}
    assert got == {r["event_id"] for r in T.results(spark, SF).collect()}
