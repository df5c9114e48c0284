"""Every registered query against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from matchlake import queries as Q
from matchlake import queries_boards, queries_context, queries_jobs, queries_links, queries_more, queries_names, queries_rest, queries_values  # noqa: F401  they register their queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    return str(v)[:19] if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", list(Q.QUERIES))
def test_query(spark, sql, name):
    df = Q.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    if name in Q.ORACLE:
        want = sql.sql(Q.ORACLE[name])
        assert sorted(want.columns) == columns
        at = [want.columns.index(c) for c in columns]
        assert got == sorted(repr([plain(r[i]) for i in at]) for r in want.fetchall())
