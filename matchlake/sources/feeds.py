"""Feeds in and out, and rows out of pages, texts and payloads, as jobs over whole tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType
from pyspark.sql.utils import AnalysisException

from matchlake.functions import exprs as E
from matchlake.functions.names import sequence_sim
from matchlake.operators import likeness as K


def read_feed(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A CSV table of strings with a header; blanks are null; a missing path is an empty table; a byte order mark is dropped."""
    schema = StructType()
    for c in columns:
        schema = schema.add(c, StringType())
    try:
        df = spark.read.csv(newest_version(spark, path) or path, header=True, enforceSchema=False)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)
    df = df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])
    return df.select(*[F.nullif(F.trim(F.col(c)), F.lit("")).alias(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def write_feed(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """CSV with these columns in this order, blanks for nulls, in a new version folder beside the older ones; `read_feed` takes the newest that is complete.

    A reader thus has the old feed or the new one and never half of either: a version counts once its name is appended to the list of versions, as one file.
    """
    import time
    import uuid

    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]).write.csv(f"{path}/{version}", header=True)
    df.sparkSession.createDataFrame([(version,)], "version string").coalesce(1).write.mode("append").parquet(f"{path}/versions")


def newest_version(spark: SparkSession, path: str) -> str | None:
    """The newest complete version folder of a feed; None if it has none (a feed of other origin)."""
    try:
        last = spark.read.schema("version string").parquet(f"{path}/versions").agg(F.max("version")).first()[0]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    return last and f"{path}/{last}"


def export_live(live: DataFrame, path: str) -> None:
    """The live payload's own columns, in their order, as a CSV feed."""
    #: The columns of the export.
    columns = ("event_id", "captured_at", "status", "minute", "home_goals", "away_goals", "home", "draw", "away")
    write_feed(live.select(*[F.col(c) if c in live.columns else F.lit(None).cast("string").alias(c) for c in columns]), path, columns)


def merge_month(fresh: DataFrame, path: str, keys: Sequence[str], ts: str) -> None:
    """Replaces the months that fresh touches by their merge, newest per key; other months stay as they are."""
    from matchlake.operators.state import merge_newest

    spark = fresh.sparkSession
    f = fresh.withColumn("month", F.date_format(ts, "yyyy-MM"))
    try:
        base = spark.read.schema(f.schema).parquet(path).join(F.broadcast(f.select("month").distinct()), "month", "left_semi").select(*f.columns)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        base = spark.createDataFrame([], f.schema)
    staged = merge_newest(base, f, keys, ts).select(*f.columns)
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)


def to_json_rows(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Each row as a JSON document with the columns it is ordered by."""
    return df.select(*order, F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("doc"))


def standardize_results(df: DataFrame) -> DataFrame:
    """Two dialects of result columns as one; no rows without a required column."""
    names = {"home": ("HomeTeam", "Home"), "away": ("AwayTeam", "Away"), "home_goals": ("FTHG", "HG"), "away_goals": ("FTAG", "AG"), "date": ("Date",)}
    cols = []
    for to, froms in names.items():
        have = [F.col(c) for c in froms if c in df.columns]
        if not have:
            return df.sparkSession.createDataFrame([], "home string, away string, home_goals int, away_goals int, date string")
        c = F.coalesce(*have)
        cols.append((c.try_cast("int") if to.endswith("goals") else c.cast("string")).alias(to))
    out = df.select(*cols)
    return out.where(" AND ".join(f"{c} IS NOT NULL" for c in names))


def from_recordset(df: DataFrame, col: str, schema: str) -> DataFrame:
    """Typed rows of JSON arrays; other payloads give none."""
    is_array = F.ltrim(F.col(col)).startswith("[")
    return df.where(is_array).select(F.inline(F.from_json(col, f"array<struct<{schema}>>")))


def results_from_text(lines: DataFrame, col: str = "text") -> DataFrame:
    """Date, names and score of result lines such as 2024-01-05 Team A 2x1 Team B; others give none."""
    pattern = r"^(\d{4}-\d{2}-\d{2})\s+(.+?)\s+(\d{1,2})x(\d{1,2})\s+(.+?)(?:\s*\[.*\]|\s*\(.*\))?\s*$"
    part = lambda n: F.regexp_extract(col, pattern, n)
    x = lines.where(F.col(col).rlike(pattern))
    return x.select(F.try_to_date(part(1)).alias("date"), part(2).alias("home"), part(3).try_cast("int").alias("home_goals"), part(4).try_cast("int").alias("away_goals"), part(5).alias("away"))


def results_from_json(payloads: DataFrame, col: str = "payload") -> DataFrame:
    """date, home, away, home_goals, away_goals of JSON results: an array of records with goals, or a map of records with a result such as 2x1.

    A footnote number on a line of its own and a state behind a slash are no part of a name. Records without a date, names or a score, or with negative goals, give none.
    """
    array = "array<struct<match_date: string, home: string, away: string, goals_home: string, goals_away: string>>"
    named = "map<string, struct<`Date`: string, `Home`: string, `Away`: string, `Result`: string>>"
    is_array = F.ltrim(F.col(col)).startswith("[")
    a = payloads.where(is_array).select(F.inline(F.from_json(col, array)))
    tidy = lambda c, p: F.trim(F.regexp_replace(F.trim(c), p, ""))
    a = a.select(
        F.try_to_timestamp(F.trim("match_date"), F.lit("dd.MM.yyyy HH:mm")).cast("date").alias("date"), tidy(F.col("home"), r"\s*\n\s*\d+\s*$").alias("home"), tidy(F.col("away"), r"\s*\n\s*\d+\s*$").alias("away"),
        F.trim("goals_home").try_cast("int").alias("home_goals"), F.trim("goals_away").try_cast("int").alias("away_goals"),
    )
    b = payloads.where(~is_array).select(F.explode(F.from_json(col, named)).alias("key", "r")).select("r.*")
    goals = lambda n: F.regexp_extract("Result", r"(\d+)\s*[xX]\s*(\d+)", n).try_cast("int")
    b = b.select(
        F.try_to_timestamp(F.trim("Date"), F.lit("dd/MM/yyyy")).cast("date").alias("date"), tidy(F.col("Home"), r"\s*/\s*[A-Z]{2}\s*$").alias("home"), tidy(F.col("Away"), r"\s*/\s*[A-Z]{2}\s*$").alias("away"),
        goals(1).alias("home_goals"), goals(2).alias("away_goals"),
    )
    return a.unionByName(b).where("date IS NOT NULL AND home <> '' AND away <> '' AND home_goals >= 0 AND away_goals >= 0")


def normalize_board(payloads: DataFrame, candidates: dict[str, Sequence[str]], col: str = "payload", live: Sequence[str] = ("inprogress", "live")) -> DataFrame:
    """A second provider's board: for each column the first of its JSON paths that has a value; live rows only, one per id (the latest payload's)."""
    x = payloads.select("captured_at", F.explode(F.from_json(col, "struct<events: array<string>>")["events"]).alias("e"))
    path = lambda paths: F.coalesce(*[F.nullif(F.trim(F.get_json_object("e", p)), F.lit("")) for p in paths])
    x = x.select("captured_at", *[path(paths).alias(c) for c, paths in candidates.items()])
    x = x.where(F.lower("status").isin(*live) & F.col("source_id").isNotNull())
    return x.groupBy("source_id").agg(F.max(F.struct("captured_at", F.struct(*x.columns).alias("row"))).alias("r")).select("r.row.*")


def collect_evidence(pages: DataFrame, providers: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Records (provider, page_id, day, pos, content, percent) of the listing pages of several providers, and per provider its attempted and successful pages and its records.

    pages: page_id, provider, day, html; providers: the element that holds a record, by provider.
    """
    both = None
    for name, tag in providers.items():
        own = pages.where(F.col("provider") == name)
        r = blocks(own, tag).join(own.select("page_id", "provider", "day"), "page_id").withColumn("content", plain(F.col("block")))
        r = r.select("provider", "page_id", "day", "pos", "content", F.regexp_extract("content", r"(\d{1,3}(?:\.\d+)?)\s*%", 1).try_cast("double").alias("percent")).where(F.length("content") > 0)
        both = r if both is None else both.unionByName(r)
    parsed = both.groupBy("provider", "page_id").agg(F.count("*").alias("n"))
    stats = pages.where(F.col("provider").isin(*providers)).select("provider", "page_id").join(parsed, ["provider", "page_id"], "left")
    return both, stats.groupBy("provider").agg(F.count("*").alias("attempted"), F.count("n").alias("successful"), F.coalesce(F.sum("n"), F.lit(0)).alias("parsed"))


def discover_urls(rows: DataFrame, targets: DataFrame, measure: str = "edit") -> DataFrame:
    """event_id, url, score: the detail page whose listed names fit a target's best, by the profile `listing`, out of the name index.

    rows: url, home, away; targets: event_id, home, away. Of equal scores the smallest url. Targets without a page are left out.
    """
    p = K.PROFILES["listing"]
    fold = lambda c: E.fold_name(F.col(c)).alias(c)
    r = rows.where("url IS NOT NULL AND home IS NOT NULL AND away IS NOT NULL").select(F.col("url").alias("row_id"), fold("home"), fold("away")).distinct()
    c = K.pair_candidates(r, targets.select("event_id", fold("home"), fold("away")), p.floor, measure).where(F.col("score") >= p.accept)
    best = c.groupBy("event_id").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("row_id").alias("url"))).alias("b"))
    return best.select("event_id", "b.url", (-F.col("b.s")).alias("score"))


def fixture_evidence(lines: DataFrame, targets: DataFrame, context: DataFrame, master: DataFrame, measure: str = "edit", following: int = 5) -> DataFrame:
    """event_id, source_home, source_away, score, status, path: which two lines of a page, at most `following` apart, name a target's sides.

    A name known in the line's competition (context: competition, name_key, entity) scores 1, one known everywhere (master: name_key, entity) .995, any other its likeness, out of
    the name index; both need .68 and their mean .76. Pairs of known names are verified; others from .94 with .90 on either side, if they lead the runner-up by .05 or that is below .88.
    lines: doc_id, pos, line, competition; targets: event_id, home, away, home_key, away_key.
    """
    x = lines.select("doc_id", "pos", "line", "competition", E.name_key(F.col("line")).alias("name_key")).where("name_key IS NOT NULL")
    x = x.join(context.select("competition", "name_key", F.col("entity").alias("_c")), ["competition", "name_key"], "left").join(master.select("name_key", F.col("entity").alias("_m")), "name_key", "left")
    x = x.withColumn("folded", E.fold_name(F.col("line")))
    sim = E.name_sim if measure == "edit" else sequence_sim
    names = targets.select(F.explode(F.array("home", "away")).alias("name")).select(E.fold_name(F.col("name")).alias("name"))
    # Both need .68 and their mean .76, so one is .76: it comes out of the index, and the other is looked for in the lines about it.
    like = K.similar_names(x.select(F.col("folded").alias("name")), names, 0.76, measure).select(F.col("left").alias("folded"), F.col("right").alias("name"))  # one index for both sides
    t = targets.select("event_id", *[c for s in ("home", "away") for c in (E.fold_name(F.col(s)).alias(f"t_{s}"), F.col(f"{s}_key").alias(f"k_{s}"))])
    line = lambda s: x.select("doc_id", F.col("pos").alias(f"{s}_pos"), F.col("line").alias(f"source_{s}"), F.col("folded").alias(f"f_{s}"), F.col("_c").alias(f"c_{s}"), F.col("_m").alias(f"m_{s}"))
    scored = lambda c, s: c.withColumn(f"{s}_score", F.when(F.col(f"c_{s}") == F.col(f"k_{s}"), 1.0).when(F.col(f"m_{s}") == F.col(f"k_{s}"), 0.995).otherwise(sim(F.col(f"f_{s}"), F.col(f"t_{s}"))))

    def led(s: str, other: str) -> DataFrame:
        a = line(s)
        by_name = a.join(like.select(F.col("folded").alias(f"f_{s}"), F.col("name").alias(f"t_{s}")), f"f_{s}").join(t, f"t_{s}")
        meet = [a.join(t, F.col(f"c_{s}") == F.col(f"k_{s}")), a.join(t, F.col(f"m_{s}") == F.col(f"k_{s}")), by_name]
        a = scored(reduce(DataFrame.unionByName, meet).distinct(), s).where(F.col(f"{s}_score") >= 0.76)
        step = F.explode(F.sequence(F.lit(1), F.lit(following)))
        b = a.withColumn("_by", step).withColumn(f"{other}_pos", F.col(f"{s}_pos") + (F.col("_by") if s == "home" else -F.col("_by"))).drop("_by")
        b = b.join(line(other), ["doc_id", f"{other}_pos"])
        return scored(b, other).where(F.col(f"{other}_score") >= 0.68)

    c = led("home", "away").unionByName(led("away", "home")).distinct()
    for s in ("home", "away"):
        c = c.withColumn(f"{s}_path", F.when(F.col(f"c_{s}") == F.col(f"k_{s}"), "CONTEXT").when(F.col(f"m_{s}") == F.col(f"k_{s}"), "GLOBAL").otherwise("DISCOVERY"))
    c = c.withColumn("score", (F.col("home_score") + F.col("away_score")) / 2).where("score >= 0.76")
    ranked = Window.partitionBy("event_id").orderBy(F.desc("score"), "doc_id", "home_pos", "away_pos")
    c = c.withColumn("_n", F.row_number().over(ranked)).withColumn("_next", F.coalesce(F.lead("score").over(ranked), F.lit(0.0))).where("_n = 1")
    known = (F.col("home_path") != "DISCOVERY") & (F.col("away_path") != "DISCOVERY")
    in_context = (F.col("home_path") == "CONTEXT") & (F.col("away_path") == "CONTEXT")
    found = (F.col("score") >= 0.94) & (F.least("home_score", "away_score") >= 0.90) & ((F.col("_next") < 0.88) | (F.col("score") - F.col("_next") >= 0.05))
    status = F.when(in_context, "CONTEXT_VERIFIED").when(known | found, "VERIFIED").otherwise("CANDIDATE")
    path = F.when(in_context, "CONTEXT").when(known, "GLOBAL").otherwise("DISCOVERY")
    return c.select("event_id", "source_home", "source_away", F.when(in_context, 1.0).otherwise(F.col("score")).alias("score"), status.alias("status"), path.alias("path"))


def blocks(pages: DataFrame, tag: str, html: str = "html") -> DataFrame:
    """page_id, pos, block: the content of each element of a tag, so what is read from one never comes from its neighbour."""
    found = F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))
    return pages.select("page_id", F.posexplode(found).alias("pos", "block"))


def plain(c: Column) -> Column:
    """Markup as plain text."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"(?s)<[^>]*>", " "), r"\s+", " "))


def extract_listing(pages: DataFrame, tag: str = "p") -> DataFrame:
    """Per block its text, words, first percentage and first score; null where the block itself has none."""
    b = blocks(pages, tag).withColumn("content", plain(F.col("block")))
    pct = F.regexp_extract("content", r"(\d{1,3}(?:\.\d+)?)\s*%", 1)
    score = F.regexp_extract("content", r"\b(\d{1,2}\s*-\s*\d{1,2})\b", 1)
    return b.select("page_id", "pos", F.length("content").alias("n_chars"), E.parse_pct(pct).alias("percent"), E.parse_score(score)["h"].alias("home_goals"))


def healthy_pages(pages: DataFrame, tag: str = "p", least_bytes: int = 500, least_blocks: int = 2) -> DataFrame:
    """Pages with enough bytes and blocks; of equal contents the smallest page_id. Rows with equal hashes meet by aggregation."""
    n = F.regexp_count("html", F.lit(rf"(?i)<{tag}\b"))
    ok = pages.where((F.octet_length("html") >= least_bytes) & (n >= least_blocks))
    return ok.groupBy(F.sha2(F.col("html"), 256).alias("digest")).agg(F.min("page_id").alias("page_id"), F.count("*").alias("copies"))


def fill_down(lines: DataFrame, header: str) -> DataFrame:
    """doc_id, pos, line with the last line at or before it that matches header, within the document."""
    w = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("header", F.last(F.when(F.col("line").rlike(header), F.col("line")), ignorenulls=True).over(w))


def text_lines(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


def line_windows(docs: DataFrame, anchor: str, following: int = 3) -> DataFrame:
    """Lines that match anchor with the next lines of the same text, from one array per text: no self-join."""
    x = docs.select("doc_id", F.split("text", "\n").alias("lines"))
    x = x.select("doc_id", "lines", F.posexplode("lines").alias("pos", "line")).where(F.col("line").rlike(anchor))
    return x.select("doc_id", "pos", "line", F.array_join(F.slice("lines", F.col("pos") + 2, following), " ").alias("after"))


def odds_table(pages: DataFrame) -> DataFrame:
    """page_id, pos, league, clock, home, away, book and prices of the rows of an odds table (page_id, html) that begin with a time.

    Such a row has time, home, a sign, away, status, ..., book, three prices, margin. The league is the last row before it that begins otherwise and is no heading of columns.
    Rows in play or finished, with fewer than nine cells, without a name or a price, give none.
    """
    cells = F.transform(F.regexp_extract_all("block", F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), F.lit(1)), plain)
    x = blocks(pages, "tr").select("page_id", "pos", cells.alias("c")).where(F.size("c") > 0)
    timed = F.col("c")[0].rlike(r"^\d{1,2}:\d{2}$")
    head = F.trim(F.array_join("c", " "))
    league = F.when(~timed & (head != "") & ~head.rlike("BN|Margin"), F.substring(head, 1, 160))
    w = Window.partitionBy("page_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("league", F.last(league, ignorenulls=True).over(w)).where(timed & (F.size("c") >= 9))
    price = lambda back: F.try_element_at("c", F.lit(-back)).try_cast("double")
    x = x.where(~F.col("c")[4].rlike(r"(?i)in-?play|finished") & (F.col("c")[1] != "") & (F.col("c")[3] != ""))
    x = x.select("page_id", "pos", "league", F.col("c")[0].alias("clock"), F.col("c")[1].alias("home"), F.col("c")[3].alias("away"), F.try_element_at("c", F.lit(-5)).alias("book"), *[price(n).alias(k) for k, n in (("odds_home", 4), ("odds_draw", 3), ("odds_away", 2))])
    return x.where("odds_home > 0 AND odds_draw > 0 AND odds_away > 0")


def market_fields(rows: DataFrame, col: str = "after") -> DataFrame:
    """The rows with under, over, prediction, home_score, away_score and average read from col, such as 43 57Over5 - 510.59.

    A pair that does not add up to 100 gives none of them. Where only a pair is there, the first two neighbouring numbers that add up to 100, the others are null.
    """
    pattern = r"(?i)(?<!\d)(\d{1,3})%?\s+(\d{1,3})%?\s*(over|under)\s*(\d{1,2})\s*-\s*(\d{1,2}?)\s*(\d{1,2}\.\d{2})"
    part = lambda n: F.regexp_extract(col, pattern, n)
    numbers = F.transform(F.regexp_extract_all(col, F.lit(r"(?<!\d)(\d{1,3})%?(?!\d)"), F.lit(1)), lambda n: n.cast("int"))
    pairs = F.filter(F.arrays_zip(numbers.alias("u"), F.slice(numbers, F.lit(2), F.greatest(F.size(numbers) - 1, F.lit(0))).alias("o")), lambda p: p["u"] + p["o"] == 100)
    x = rows.withColumns({"_full": F.col(col).rlike(pattern), "_pair": F.try_element_at(pairs, F.lit(1))})
    sums = part(1).try_cast("int") + part(2).try_cast("int") == 100
    full = F.col("_full") & sums
    pick = lambda n, k: F.when(full, part(n).try_cast("int")).when(~F.col("_full"), F.col("_pair")[k])
    return x.withColumns({
        "under": pick(1, "u"), "over": pick(2, "o"), "prediction": F.when(full, F.initcap(part(3))), "home_score": F.when(full, part(4).try_cast("int")),
        "away_score": F.when(full, part(5).try_cast("int")), "average": F.when(full, part(6).try_cast("double")),
    }).drop("_full", "_pair")


def dedupe_observations(df: DataFrame, signature: Sequence[str]) -> DataFrame:
    """Identical repeated rows once; rows that differ in anything of the signature all stay."""
    return df.select(*signature).distinct()


def flatten_props(events: DataFrame) -> DataFrame:
    """event_id, key, value for each entry of a JSON object of any keys."""
    maps = F.from_json("props", "map<string, string>")
    return events.select("event_id", F.explode(maps).alias("key", "value"))


def reconcile_quotes(quotes: DataFrame, index: DataFrame) -> DataFrame:
    """Quotes (id, number, prices) whose number the index has once and with the same id, with prices from 1.01 to 100."""
    once = index.groupBy("number").agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n = 1").drop("n")
    ok = F.lit(True)
    for c in ("home", "draw", "away"):
        ok = ok & F.col(c).between(1.01, 100)
    return quotes.where(ok).join(once, ["number", "id"])


#: Fields of a quote in a capture's XML, and attributes of a row in its HTML.
QUOTE_XML = "m array<struct<_matchnum string, _id string, _home string, _away string, _league string, row array<struct<_updatetime string, _win string, _draw string, _lost string>>>>"
INDEX_HTML = {"number": "data-processname", "index_id": "data-id", "day": "data-matchdate", "clock": "data-matchtime"}


def quotes_from_xml(captures: DataFrame, now: Column, key: str = "capture_id", xml: str = "xml", html: str = "html") -> DataFrame:
    """Per capture the quotes of its XML that the rows of its HTML confirm: key, source_id, number, home_name, away_name, league, kickoff, updated_at, home, draw, away.

    The first quote of a number counts; its id must be that of the one row of that number. Kickoff is from 2 h before to 48 h after `now`, the quote at most
    5 minutes after it, and prices from 1.01 to 100; clocks without a zone are local. What cannot be read, a null document too, gives no quote.
    """
    q = captures.select(key, F.posexplode(F.from_xml(F.col(xml), F.lit(QUOTE_XML))["m"]).alias("pos", "m")).where("m._matchnum <> ''")
    first = q.groupBy(key, F.col("m._matchnum").alias("number")).agg(F.min_by("m", "pos").alias("m")).withColumn("q", F.get("m.row", F.lit(0)))
    tags = captures.select(key, F.explode(F.regexp_extract_all(html, F.lit(r"(?is)(<tr\b[^>]*>)"), F.lit(1))).alias("tag"))
    rows = tags.select(key, *[F.regexp_extract("tag", rf"(?is)\s{a}\s*=\s*[\"']([^\"']*)[\"']", 1).alias(c) for c, a in INDEX_HTML.items()]).where("number <> '' AND day <> '' AND clock <> ''")
    once = rows.groupBy(key, "number").agg(F.count("*").alias("n"), F.min("index_id").alias("index_id"), F.min(F.concat_ws(" ", "day", "clock")).alias("at")).where("n = 1")
    x = first.join(once, [key, "number"]).where("m._id <> '' AND m._id = index_id").select(
        key, F.col("m._id").alias("source_id"), "number", F.col("m._home").alias("home_name"), F.col("m._away").alias("away_name"), F.col("m._league").alias("league"),
        E.parse_ts(F.col("at")).alias("kickoff"), E.parse_ts(F.col("q._updatetime")).alias("updated_at"), *[F.col(f"q._{c}").try_cast("double").alias(n) for c, n in (("win", "home"), ("draw", "draw"), ("lost", "away"))],
    )
    age = F.unix_seconds("kickoff") - F.unix_seconds(now)
    ok = age.between(-7200, 172_800) & (F.unix_seconds("updated_at") <= F.unix_seconds(now) + 300)
    for c in ("home", "draw", "away"):
        ok = ok & F.col(c).between(1.01, 100)
    return x.where(ok)


def pick_stat(stats: DataFrame, aliases: DataFrame) -> DataFrame:
    """Per event and target the value of the best path (stats: event_id, path, value; aliases: alias, target): its last part equal to an alias before the whole ending in one, then the shorter path.

    Paths and aliases are compared without case and separators. A path meets aliases at its endings, so stats and aliases are joined by equal keys.
    """
    bare = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")
    x = stats.withColumn("_last", bare(F.substring_index("path", ".", -1))).withColumn("_full", bare(F.col("path"))).where(F.length("_full") > 0)
    x = x.withColumn("_end", F.explode(F.transform(F.sequence(F.lit(1), F.length("_full")), lambda i: F.substring("_full", i, F.length("_full")))))
    x = x.join(aliases.select(bare(F.col("alias")).alias("_end"), "target").where("_end <> ''").distinct(), "_end")
    rank = F.struct(F.when(F.col("_last") == F.col("_end"), 0).otherwise(1), F.length("path"), "path", "value")
    return x.groupBy("event_id", "target").agg(F.min(rank).alias("r")).select("event_id", "target", F.col("r.path").alias("path"), F.col("r.value").alias("value"))


#: The parts of a player's payload.
PLAYER = """struct<id: string, name: string, isCaptain: boolean, primaryTeam: struct<teamId: string, teamName: string>, positionDescription: struct<primaryPosition: struct<label: string, key: string>>,
  injuryInformation: struct<status: string, description: string, returnDate: string>, mainLeague: struct<leagueId: string, leagueName: string>,
  statSeasons: array<struct<seasonName: string, tournaments: array<struct<tournamentId: string, name: string, categories: array<struct<title: string>>>>>>,
  recentMatches: array<struct<minutesPlayed: int, goals: int, assists: int, rating: double>>>"""


def player_profiles(payloads: DataFrame, games: int = 6) -> DataFrame:
    """One profile per row of payloads (player_id, player_name, team_id, team_name, position: what is known already; payload: JSON): identity, injury, league, season, tournament, recent form and a quality label.

    What the payload lacks comes from the row. The season is the first that has tournaments, the tournament in it that of the main league, else the first. Recent form is of the first `games`
    matches with minutes. The quality is OK_CURRENT_STATS with stats in the tournament, else OK_RECENT_FORM with recent matches, else IDENTITY_ONLY. Text that is no JSON, and null, is a payload that lacks all.
    """
    d = payloads.withColumn("p", F.from_json("payload", PLAYER))
    text = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    season = F.get(F.filter("p.statSeasons", lambda s: F.size(s["tournaments"]) > 0), F.lit(0))
    main = text("p.mainLeague.leagueId")
    d = d.select("*", F.inline(F.array(F.struct(season.alias("season")))))
    picked = F.coalesce(F.get(F.filter("season.tournaments", lambda t: F.trim(t["tournamentId"]) == main), F.lit(0)), F.get("season.tournaments", F.lit(0)))
    played = F.slice(F.filter("p.recentMatches", lambda m: m["minutesPlayed"] > 0), 1, games)
    d = d.withColumn("picked", picked).withColumn("played", F.coalesce(played, F.array().cast("array<struct<minutesPlayed: int, goals: int, assists: int, rating: double>>")))
    total = lambda c: F.aggregate("played", F.lit(0), lambda t, m: t + F.coalesce(m[c], F.lit(0)))
    rated = F.filter(F.transform("played", lambda m: m["rating"]), lambda r: r.isNotNull())
    mean = F.when(F.size(rated) > 0, F.round(F.aggregate(rated, F.lit(0.0), lambda t, r: t + r) / F.size(rated), 2))
    stats = F.coalesce(F.size("picked.categories") > 0, F.lit(False))
    quality = F.when(stats, "OK_CURRENT_STATS").when(F.size("played") > 0, "OK_RECENT_FORM").otherwise("IDENTITY_ONLY")
    return d.select(
        F.coalesce(text("p.id"), text("player_id")).alias("player_id"), F.coalesce(text("p.name"), text("player_name")).alias("player_name"), F.coalesce(text("p.primaryTeam.teamId"), text("team_id")).alias("team_id"), F.coalesce(text("p.primaryTeam.teamName"), text("team_name")).alias("team_name"),
        F.coalesce(text("p.positionDescription.primaryPosition.label"), text("p.positionDescription.primaryPosition.key"), text("position")).alias("position"), F.coalesce("p.isCaptain", F.lit(False)).alias("is_captain"),
        text("p.injuryInformation.status").alias("injury_status"), text("p.injuryInformation.description").alias("injury"), F.col("p.injuryInformation.returnDate").try_cast("date").alias("injury_return"), text("p.mainLeague.leagueName").alias("main_league"),
        text("season.seasonName").alias("season"), text("picked.name").alias("tournament"), F.size("played").alias("recent_matches"), total("minutesPlayed").alias("recent_minutes"), total("goals").alias("recent_goals"), total("assists").alias("recent_assists"), mean.alias("recent_rating"), quality.alias("quality"),
    )


def pick_titled(items: DataFrame, aliases: DataFrame) -> DataFrame:
    """Per player and target the item (title, value, per90, percentile) whose title fits an alias best: equal (3) before one within the other (2), of equals the first by pos.

    items: player_id, pos, title, value, per90, percentile; aliases: alias, target. Titles repeat over players, so each distinct title is held against the aliases once:
    a title meets the aliases that it contains, or that contain it, at the runs of letters of the longer.
    """
    bare = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")
    runs = lambda c: F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.transform(F.sequence(F.lit(1), F.length(c) - i + 1), lambda n: F.substring(c, i, n)))))
    t = items.select(bare(F.col("title")).alias("t")).where("t <> ''").distinct()
    a = aliases.select(bare(F.col("alias")).alias("a"), "target").where("a <> ''").distinct()
    held = t.select("t", F.explode(runs(F.col("t"))).alias("a")).join(a, "a").select("t", "target", "a")
    holding = a.select("a", "target", F.explode(runs(F.col("a"))).alias("t")).join(t, "t").select("t", "target", "a")
    fit = held.union(holding).groupBy("t", "target").agg(F.max(F.when(F.col("t") == F.col("a"), 3).otherwise(2)).alias("score"))
    x = items.withColumn("t", bare(F.col("title"))).join(fit, "t")
    best = F.min(F.struct((-F.col("score")).alias("s"), "pos", "title", "value", "per90", "percentile")).alias("b")
    return x.groupBy("player_id", "target").agg(best).select("player_id", "target", (-F.col("b.s")).alias("score"), *[F.col(f"b.{c}").alias(c) for c in ("title", "value", "per90", "percentile")])


def embedded_json(docs: DataFrame, text: str, schema: str, required: Sequence[str], unique: str | None = None, least: int = 1) -> DataFrame:
    """Per document the longest JSON array in its text whose records have all required fields, from `least` records on; of records with one value of `unique` the first."""
    arrays = F.explode(F.regexp_extract_all(text, F.lit(r"(?s)(\[\s*\{.*?\}\s*\])"), F.lit(1)))
    x = docs.select("doc_id", arrays.alias("j")).select("doc_id", F.from_json("j", f"array<struct<{schema}>>").alias("rows"))
    has_all = F.forall("rows", lambda r: F.array_size(F.array_compact(F.array(*[r[c].cast("string") for c in required]))) == len(required))
    best = x.where(has_all & (F.size("rows") >= max(1, least))).groupBy("doc_id").agg(F.max(F.struct(F.size("rows").alias("n"), "rows")).alias("b"))
    if unique is None:
        return best.select("doc_id", F.inline("b.rows"))
    first = F.filter("b.rows", lambda r, i: F.size(F.filter(F.slice(F.col("b.rows"), F.lit(1), i), lambda q: q[unique] == r[unique])) == 0)
    return best.select("doc_id", F.inline(first))


def flatten_board(payloads: DataFrame, col: str = "payload") -> DataFrame:
    """Matches of nested boards, one per id (the latest payload's), with a live flag."""
    schema = "struct<leagues: array<struct<name: string, matches: array<struct<id: string, home: struct<id: string, name: string, score: string>, away: struct<id: string, name: string, score: string>, status: struct<utcTime: string, started: boolean, finished: boolean, cancelled: boolean, ongoing: boolean>>>>>>"
    x = payloads.select("captured_at", F.explode(F.from_json(col, schema)["leagues"]).alias("l")).select("captured_at", F.col("l.name").alias("league"), F.explode("l.matches").alias("m"))
    live = F.coalesce(F.col("m.status.ongoing"), F.col("m.status.started") & ~F.coalesce(F.col("m.status.finished"), F.lit(False)), F.lit(False)) & ~F.coalesce(F.col("m.status.cancelled"), F.lit(False))
    rows = x.select(
        "captured_at", "league", F.col("m.id").alias("source_id"), F.col("m.home.name").alias("home"), F.col("m.away.name").alias("away"), F.try_to_timestamp(F.col("m.status.utcTime")).alias("kickoff"),
        F.col("m.home.score").try_cast("int").alias("home_goals"), F.col("m.away.score").try_cast("int").alias("away_goals"), live.alias("live"), F.col("m.status.finished").alias("finished"), F.col("m.status.cancelled").alias("cancelled"),
    )
    named = F.max(F.struct("captured_at", F.struct(*rows.columns).alias("row"))).alias("r")
    return rows.where("source_id IS NOT NULL").groupBy("source_id").agg(named).select("r.row.*")


def flatten_team_stats(payloads: DataFrame, col: str = "payload") -> DataFrame:
    """period, group, key, home, away of two-sided stats; equal (period, key, home, away) once."""
    schema = "array<struct<period: string, groups: array<struct<name: string, items: array<struct<title: string, home: string, away: string>>>>>>"
    x = payloads.select("event_id", F.inline(F.from_json(col, schema))).select("event_id", "period", F.inline("groups")).select("event_id", "period", F.col("name").alias("group"), F.inline("items"))
    x = x.withColumn("key", E.stat_slug(F.col("title")))
    return x.groupBy("event_id", "period", "key", "home", "away").agg(F.min("group").alias("group"), F.min("title").alias("title"))


def lineups(payloads: DataFrame, col: str = "payload") -> DataFrame:
    """Players of both sides from either generation of the schema: lists of starters and subs, or one list with a flag."""
    person = "array<struct<id: string, name: string, isStarter: boolean>>"
    schema = f"struct<home: struct<starters: {person}, subs: {person}, players: {person}>, away: struct<starters: {person}, subs: {person}, players: {person}>>"
    x = payloads.select("event_id", F.from_json(col, schema).alias("p"))
    none = F.array().cast("array<struct<id: string, name: string, starter: boolean>>")

    def of(side: str) -> Column:
        as_rows = lambda c, flag: F.transform(F.col(f"p.{side}.{c}"), lambda m: F.struct(m["id"].alias("id"), m["name"].alias("name"), (F.coalesce(m["isStarter"], F.lit(False)) if flag is None else F.lit(flag)).alias("starter")))
        new = F.when(F.col(f"p.{side}.starters").isNotNull(), F.concat(as_rows("starters", True), F.coalesce(as_rows("subs", False), none)))
        return F.coalesce(new, as_rows("players", None), none)

    sides = F.array(*[F.struct(F.lit(s).alias("side"), of(c).alias("players")) for s, c in (("H", "home"), ("A", "away"))])
    return x.select("event_id", F.inline(sides)).select("event_id", "side", F.inline("players"))


def player_stats(payloads: DataFrame, keys: DataFrame, col: str = "payload") -> DataFrame:
    """Open-ended player stats to the stable names of a small key table (key, name, rank): the first known key of a name wins."""
    schema = "array<struct<id: string, stats: map<string, double>>>"
    x = payloads.select("event_id", F.inline(F.from_json(col, schema))).select("event_id", F.col("id").alias("player"), F.explode("stats").alias("key", "value"))
    x = x.join(keys, "key")
    return x.groupBy("event_id", "player", "name").agg(F.min(F.struct("rank", "value"))["value"].alias("value"))


def sections(pages: DataFrame, start: str, end: str, html: str = "html") -> DataFrame:
    """The text between two patterns of each page, its percentages, and the first three of them that sum to 98-102."""
    body = F.regexp_extract(plain(F.col(html)), rf"(?is)({start}.*?)(?:{end}|$)", 1)
    x = pages.select("page_id", body.alias("section")).where(F.length("section") > 0)
    pct = F.transform(F.regexp_extract_all("section", F.lit(r"(\d{1,3}(?:\.\d+)?)\s*%"), F.lit(1)), lambda p: p.try_cast("double"))
    x = x.withColumn("percents", pct)
    at = F.get(F.filter(F.transform("percents", lambda _, i: i), lambda i: (F.get("percents", i) + F.get("percents", i + 1) + F.get("percents", i + 2)).between(98, 102)), F.lit(0))
    return x.withColumn("triplet", F.when(at.isNotNull(), F.slice("percents", at + 1, 3)))


def combine_boards(boards: Sequence[DataFrame], key: str = "source_id") -> DataFrame:
    """Boards of several dates as one, each id once, an earlier board's row first."""
    both = None
    for n, b in enumerate(boards):
        b = b.withColumn("_n", F.lit(n))
        both = b if both is None else both.unionByName(b)
    return both.groupBy(key).agg(F.min(F.struct("_n", F.struct(*boards[0].columns).alias("row"))).alias("r")).select("r.row.*")


def replay(records: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records whose stored page still has the content they were taken from, and the others."""
    p = pages.select("page_id", F.sha2(F.col("html"), 256).alias("_h"))
    x = records.join(p, "page_id", "left").withColumn("_ok", F.coalesce(F.col("digest") == F.col("_h"), F.lit(False)))
    return x.where("_ok").drop("_h", "_ok"), x.where("NOT _ok").drop("_h", "_ok")
