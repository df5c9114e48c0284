"""Event tables derived from the star-schema test tables, and the same views in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, its times as UTC instants: the files have them without a zone."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumns({c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"})


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One settled event for each order."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS event_id", "o_custkey % 40 AS home_id", "(o_custkey % 40 + 1 + o_orderkey % 39) % 40 AS away_id", "o_orderdate AS kickoff",
        "(o_orderkey * 7) % 5 AS home_goals", "(o_orderkey * 11) % 4 AS away_goals", "o_orderpriority AS tournament", "o_orderstatus <> 'P' AS confirmed",
    )


def spread(df: DataFrame, key: str) -> DataFrame:
    """df in spark.sql.shuffle.partitions parts by key, which stay as many: its few bytes become much work, and files of few bytes come in few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey AS event_id", *[f"{e} AS {n}" for n, e in _ODDS("o_orderkey").items()])


def _ODDS(key: str) -> dict[str, str]:
    f = lambda low, k, m: f"CAST({low} AS DOUBLE) + CAST(({key} * {k}) % {m} AS DOUBLE) / 100"
    return {"home": f("1.2", 13, 400), "draw": f("2.5", 7, 200), "away": f("1.3", 29, 500)}


def odds_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price snapshots of the events that are users in `events`; kickoff is an hour after the last."""
    e = table(spark, sf_dir, "events").selectExpr("user_id AS event_id", "event_id AS snapshot_id", "ts AS captured_at", *[f"{e} AS {n}" for n, e in _ODDS("event_id").items()])
    last = e.groupBy("event_id").agg((F.max("captured_at") + F.expr("INTERVAL 1 HOUR")).alias("kickoff"))
    return e.join(last, "event_id")


def live_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("event_id"), F.col("event_id").alias("row_id"), F.col("ts").alias("captured_at"), F.col("event_type").alias("source"), F.col("value").alias("home"), k.cast("double").alias("away"), k.alias("minute"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentages of one of six sources for each event."""
    w = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS event_id", "concat('s', o_orderkey % 6) AS source", "o_orderdate AS captured_at", *[f"CAST(1 + (o_orderkey * {k}) % 97 AS DOUBLE) AS w{i}" for i, k in enumerate((3, 5, 7))])
    return w.selectExpr("event_id", "source", "captured_at", *[f"100 * w{i} / (w0 + w1 + w2) AS {n}" for i, n in enumerate(("home", "draw", "away"))])


def alias_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed spellings of entities, some of them colliding."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_type AS source", "CASE p_size % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN replace(p_name, ' ', '-') ELSE p_name END AS alias",
        "CASE WHEN p_partkey % 97 = 0 THEN lower(p_brand) ELSE replace(lower(p_name), ' ', '') END AS entity", "p_partkey AS event_id",
        "CAST(0.70 AS DOUBLE) + CAST(p_size % 30 AS DOUBLE) / 100 AS confidence", "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, p_size) AS observed_at",
    )


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS team", "l_partkey AS player", "l_orderkey AS event_id", "l_linenumber AS line", "l_quantity AS minutes", "l_shipdate AS played_at", "l_linenumber % 2 AS goals")


def source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("source")).agg(F.max("ts").alias("observed_at"), F.count("*").alias("n_rows"))


def _odds_sql(key: str) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in _ODDS(key).items())


#: The same views for SQL, each a common table expression.
SQL = {
    "results": """results AS (SELECT o_orderkey AS event_id, o_custkey % 40 AS home_id, (o_custkey % 40 + 1 + o_orderkey % 39) % 40 AS away_id,
      o_orderdate AS kickoff, (o_orderkey * 7) % 5 AS home_goals, (o_orderkey * 11) % 4 AS away_goals, o_orderpriority AS tournament, o_orderstatus <> 'P' AS confirmed FROM orders)""",
    "odds": f"odds AS (SELECT o_orderkey AS event_id, {_odds_sql('o_orderkey')} FROM orders)",
    "odds_history": f"""snaps AS (SELECT user_id AS event_id, event_id AS snapshot_id, ts AS captured_at, {_odds_sql('event_id')} FROM events),
      odds_history AS (SELECT s.*, k.kickoff FROM snaps s JOIN (SELECT event_id, max(captured_at) + INTERVAL 1 HOUR AS kickoff FROM snaps GROUP BY event_id) k USING (event_id))""",
    "live_stats": """live_stats AS (SELECT user_id AS event_id, event_id AS row_id, ts AS captured_at, event_type AS source, value AS home,
      CAST(json_extract_string(props, '$.k') AS DOUBLE) AS away, CAST(json_extract_string(props, '$.k') AS INTEGER) AS minute FROM events)""",
    "predictions": f"""weights AS (SELECT o_orderkey AS event_id, concat('s', o_orderkey % 6) AS source, o_orderdate AS captured_at,
      {', '.join(f'CAST(1 + (o_orderkey * {k}) % 97 AS DOUBLE) AS w{i}' for i, k in enumerate((3, 5, 7)))} FROM orders),
      predictions AS (SELECT event_id, source, captured_at, {', '.join(f'100 * w{i} / (w0 + w1 + w2) AS {n}' for i, n in enumerate(('home', 'draw', 'away')))} FROM weights)""",
    "alias_obs": """alias_obs AS (SELECT p_type AS source, CASE p_size % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN replace(p_name, ' ', '-') ELSE p_name END AS alias,
      CASE WHEN p_partkey % 97 = 0 THEN lower(p_brand) ELSE replace(lower(p_name), ' ', '') END AS entity, p_partkey AS event_id,
      CAST(0.70 AS DOUBLE) + CAST(p_size % 30 AS DOUBLE) / 100 AS confidence, TIMESTAMP '2024-01-01' + to_days(p_size) AS observed_at FROM part)""",
    "players": "players AS (SELECT l_suppkey AS team, l_partkey AS player, l_orderkey AS event_id, l_linenumber AS line, l_quantity AS minutes, l_shipdate AS played_at, l_linenumber % 2 AS goals FROM lineitem)",
    "source_health": "source_health AS (SELECT event_type AS source, max(ts) AS observed_at, count(*) AS n_rows FROM events GROUP BY event_type)",
}
