"""Work that is done once, and in as many tasks as the session asks for, however few bytes the input has."""

from matchlake import queries_jobs  # noqa: F401  it registers its queries
from matchlake import testdata as T
from matchlake.sources import listings as X


def _scans(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD")


def test_a_stat_tree_is_read_once_for_all_its_levels(spark):
    tree = '{"content":{"stats":{"Periods":{"All":{"title":"G","x":[{"key":"a","stats":[1,2],"more":{"key":"b","stats":["3",null]}}]},"Half":7}}}}'
    df = spark.createDataFrame([(1, tree), (2, "no json"), (3, None)], "event_id long, detail string")
    got = X.team_stats(df)
    assert sorted((r["period"], r["group"], r["key"], r["home"], r["away"]) for r in got.collect()) == [("All", "G", "a", "1", "2"), ("All", "G", "b", "3", None)]
    assert _scans(got) == 1


def test_small_files_come_in_as_many_tasks_as_asked(spark):
    assert T.spread(T.results(spark, "/root/testdata/sf0.001"), "event_id").rdd.getNumPartitions() == 4


def test_articles_are_read_in_as_many_tasks_as_asked(spark):
    from matchlake import queries_context as Q

    plan = Q.src6_articles(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [event_id" in plan
