"""Rows out of listing pages by a specification of fields, and out of stat trees of any depth."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.functions import exprs as E
from matchlake.sources.feeds import plain


@dataclass(frozen=True)
class Field:
    """A field of a block: the first of `patterns` (group 1) that gives a text counts, read as `kind`: text, percent, odds, number, score, date or link."""

    name: str
    kind: str
    patterns: tuple[str, ...]


def element(css: str, child: str = "", nth: int = 1) -> str:
    """What an element of a class holds, or its nth child of a tag; children before it are passed over within the element."""
    start = rf'(?is)<(\w+)\b[^>]*\bclass="(?:[^"]*\s)?{css}(?:\s[^"]*)?"[^>]*>'
    if not child:
        return start + r"(.*?)</\1>"
    skipped = rf"(?:(?:(?!</\1>|<{child}\b).)*<{child}\b[^>]*>(?:(?!</{child}>).)*</{child}>){{{nth - 1}}}"
    return start + skipped + rf"(?:(?!</\1>|<{child}\b).)*<{child}\b[^>]*>(.*?)</{child}>"


def _group(pattern: str) -> int:
    return 2 if r"</\1>" in pattern else 1


def _meta(part: int) -> str:
    return r'(?is)<meta\b[^>]*itemprop="name"[^>]*content="\s*' + (r'([^"]*?)\s+vs\s+[^"]*"' if part == 1 else r'[^"]*?\s+vs\s+([^"]*?)\s*"')


def _side(css: str) -> str:
    return rf'(?is)<span\b[^>]*\bclass="(?:[^"]*\s)?{css}(?:\s[^"]*)?"[^>]*>(?:(?!</span>).)*?<span\b[^>]*itemprop="name"[^>]*>(.*?)</span>'


#: Where a listing block has its fields.
LISTING = (
    Field("home", "text", (_side("homeTeam"), _meta(1))),
    Field("away", "text", (_side("awayTeam"), _meta(2))),
    Field("match_date", "date", (r'(?is)<time\b[^>]*datetime="([^"]*)"',)),
    Field("kickoff_text", "text", (element("date_bah"),)),
    Field("league", "text", (element("shortTag"),)),
    *[Field(f"prob_{s}", "percent", (element("fprc", "span", n),)) for n, s in ((1, "home"), (2, "draw"), (3, "away"))],
    Field("pick", "text", (element("forepr", "span"), element("forepr"))),
    Field("score", "score", (element("ex_sc"), element("predict_score"))),
    Field("avg_goals", "number", (element("avg_sc"),)),
    *[Field(f"odds_{s}", "odds", (element("haodd", "span", n),)) for n, s in ((1, "home"), (2, "draw"), (3, "away"))],
    Field("url", "link", (r'(?is)<a\b[^>]*href="([^"]*/(?:en/)?football/matches/[^"]*)"',)),
)


def find_field(block: Column, field: Field) -> Column:
    """The text of a field: the first of its patterns that gives one."""
    return F.coalesce(*[F.nullif(plain(F.regexp_extract(block, p, _group(p))), F.lit("")) for p in field.patterns])


def read_field(found: Column, field: Field, base_url: str = "") -> Column:
    """A field's text as its kind; null if it does not read so."""
    if field.kind == "percent":
        return E.parse_pct(found)
    if field.kind == "odds":
        return E.parse_odds(found)
    if field.kind == "number":
        return F.regexp_extract(found, r"^([0-9]+(?:\.[0-9]+)?)$", 1).try_cast("double")
    if field.kind == "score":
        return F.nullif(E.fmt_score(found), F.lit(""))
    if field.kind == "date":
        return F.regexp_extract(found, r"^(\d{4}-\d{2}-\d{2})", 1).try_cast("date")
    if field.kind == "link":
        path = F.regexp_replace(found, r"[?#].*$", "")
        return F.when(path.startswith("/"), F.concat(F.lit(base_url), path)).otherwise(path)
    return found


def listing_rows(pages: DataFrame, fields: Sequence[Field] = LISTING, css: str = "rcnt", needed: Sequence[str] = ("home", "away"), base_url: str = "") -> DataFrame:
    """page_id, pos and the specified fields of each block of pages (page_id, requested_date, html), in one pass over each block.

    A block starts at a div of the class and ends where the next starts, so nothing is read from a neighbour; blocks without the needed fields are left out. A field that the block lacks or
    that does not read as its kind is null; a block without a date of its own has the page's requested one.
    """
    start = rf'(?is)<div\b[^>]*\bclass="(?:[^"]*\s)?{css}(?:\s[^"]*)?"[^>]*>'
    parts = F.split(F.coalesce("html", F.lit("")), start)
    b = pages.select("page_id", "requested_date", F.posexplode(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))).alias("pos", "block"))
    # Texts first, through inline, so that each is found once however often its reading refers to it.
    x = b.select("page_id", "pos", "requested_date", F.inline(F.array(F.struct(*[find_field(F.col("block"), f).alias(f.name) for f in fields]))))
    x = x.select("page_id", "pos", "requested_date", *[read_field(F.col(f.name), f, base_url).alias(f.name) for f in fields])
    if any(f.name == "match_date" for f in fields):
        x = x.withColumn("match_date", F.coalesce("match_date", F.col("requested_date").cast("date")))
    for c in needed:
        x = x.where(F.col(c).isNotNull())
    return x.drop("requested_date")


STAT = "struct<group: string, key: string, title: string, home: string, away: string, path: string>"


def team_stats(details: DataFrame, depth: int = 8) -> DataFrame:
    """event_id, period, group, key, title, home, away: every two-sided stat of a stat tree, whatever its nesting and names.

    details: event_id, detail (JSON text; its periods under $.content.stats.Periods). A stat is an object whose `stats` begins with a plain value and has two at least; its
    group is the title of the nearest titled object around it, its key the slug of its key or else title. Equal (period, key, home, away) of an event
    count once, the first by path. Text that is no JSON, and null, has no rows. A tree deeper than `depth` levels is an error, so nothing is lost in silence.
    Each tree is walked once, level by level, in one pass without a shuffle.
    """
    text = lambda at: F.nullif(F.trim(F.try_variant_get("node", at, "string")), F.lit(""))
    top = details.select("event_id", F.try_variant_get(F.try_parse_json("detail"), "$.content.stats.Periods", "variant").alias("node")).where("node IS NOT NULL")
    spark = details.sparkSession

    def children(df: DataFrame, columns: str, node: str) -> DataFrame:
        return spark.sql(f"SELECT {columns}, t.pos, t.key AS name, t.value AS child FROM {{df}} x, LATERAL variant_explode_outer({node}) t", df=df)

    x = children(top, "x.event_id", "x.node").where("pos IS NOT NULL")
    x = x.select("event_id", F.trim("name").alias("period"), F.lit("").alias("group"), F.format_string("%s", "name").alias("path"), F.col("child").alias("node"), F.lit(None).cast(STAT).alias("found"))
    for _ in range(depth):
        values = F.try_variant_get("node", "$.stats", "array<variant>")
        first = F.get(values, F.lit(0))
        plain_first = F.try_variant_get(first, "$", "array<variant>").isNull() & F.try_variant_get(first, "$", "map<string,variant>").isNull()
        side = lambda k: F.try_variant_get("node", f"$.stats[{k}]", "string")
        stat = F.struct("group", F.coalesce(text("$.key"), text("$.title")).alias("key"), F.coalesce(text("$.title"), text("$.key")).alias("title"), side(0).alias("home"), side(1).alias("away"), "path")
        x = x.select("event_id", "period", F.coalesce(text("$.title"), "group").alias("group"), "path", "node", "found", F.when((F.size(values) >= 2) & plain_first, stat).alias("own"))
        # A stat goes on in the row of its `stats`, which is not walked; its other children are. Rows found stay one row each.
        x = children(x, "x.event_id, x.period, x.`group`, x.path, x.found, x.own", "CASE WHEN x.found IS NULL THEN x.node END").where("found IS NOT NULL OR pos IS NOT NULL")
        found = F.coalesce("found", F.when(F.col("name") == "stats", F.col("own")))
        x = x.select("event_id", "period", "group", F.format_string("%s/%04d", "path", "pos").alias("path"), F.col("child").alias("node"), found.alias("found"))
    deeper = F.schema_of_variant("node").rlike("^(OBJECT|ARRAY)")
    out = x.where(F.when(F.col("found").isNotNull(), True).when(deeper, F.raise_error(F.lit(f"a stat tree is deeper than {depth} levels")).cast("boolean")).otherwise(False))
    out = out.select("event_id", "period", "found.*").withColumn("key", E.stat_slug(F.col("key")))
    out = out.withColumn("_n", F.row_number().over(Window.partitionBy("event_id", "period", "key", F.trim("home"), F.trim("away")).orderBy("path")))
    return out.where("_n = 1").select("event_id", "period", "group", "key", "title", "home", "away")


@dataclass(frozen=True)
class Article:
    """Where an article's first heading names its sides (two groups), its text its date and clock (two groups), its sections as (start, end), and the words that stand before a section's percentages."""

    title: str
    clock: str
    sections: dict[str, tuple[str, str]]
    shares: dict[str, tuple[str, str]]
    score: str


#: The layout of an article page.
ARTICLE = Article(
    title=r"(?i)^(.+?)\s+vs?\s+(.+?)\s+(?:Prediction|H2H)\b",
    clock=r"\bDate\s+(\d{4}-\d{2}-\d{2})\s+(\d{2}:\d{2})",
    sections={"winner": (r"\bWinner\b", r"\bTotal Goals\s*2\.5\b"), "goals": (r"\bTotal Goals\s*2\.5\b", r"\bBoth Teams to Score\b"), "both": (r"\bBoth Teams to Score\b", r"\bCorrect Score\b")},
    shares={"h": ("winner", "Home"), "d": ("winner", "Draw"), "a": ("winner", "Away"), "over25": ("goals", "Over"), "under25": ("goals", "Under"), "both_yes": ("both", "Yes"), "both_no": ("both", "No")},
    score=r"(?is)<h4\b[^>]*>\s*Correct Score\s*</h4>\s*<(?:h5|p)\b[^>]*>\s*(\d{1,2}\s*-\s*\d{1,2})(?:\s+\d{1,3}%\s+Others\s+\d{1,3}%)?\s*</",
)
EVENT = "struct<`@type`: string, url: string, startDate: string, homeTeam: struct<name: string>, awayTeam: struct<name: string>>"


def article_rows(pages: DataFrame, spec: Article = ARTICLE) -> DataFrame:
    """page_id, url, home, away, source_date, source_time, h, d, a, over25, under25, both_yes, both_no, score, kickoff, status: one row for each page that names its sides and its clock.

    pages: page_id, url, html. A section starts behind its first heading and ends at the next, or after 1500 characters. The three shares of a winner count together: each from 0 to 1 and their sum within .025 of 1, else none does. The kickoff
    counts if the page's event data (JSON-LD) has the same url and names and, at its own offset, the same date and clock; it is then VERIFIED, else WALL_TIME.
    """
    text = plain(F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<script\b.*?</script>", " "))
    x = pages.select("page_id", "url", "html", F.inline(F.array(F.struct(text.alias("text"), plain(F.regexp_extract("html", r"(?is)<h1\b[^>]*>(.*?)</h1>", 1)).alias("heading")))))
    x = x.withColumns({"home": F.regexp_extract("heading", spec.title, 1), "away": F.regexp_extract("heading", spec.title, 2), "source_date": F.regexp_extract("text", spec.clock, 1), "source_time": F.regexp_extract("text", spec.clock, 2)})
    x = x.where("home <> '' AND away <> '' AND source_date <> ''")

    def section(start: str, end: str) -> Column:
        after = F.regexp_extract("text", rf"(?is){start}(.*)", 1)
        return F.when(after.rlike(rf"(?is){end}"), F.regexp_extract(after, rf"(?is)^(.*?){end}", 1)).otherwise(F.substring(after, 1, 1500))

    x = x.select("page_id", "url", "html", "home", "away", "source_date", "source_time", F.inline(F.array(F.struct(*[section(*s).alias(n) for n, s in spec.sections.items()]))))

    def share(name: str, word: str) -> Column:
        n = F.regexp_extract(name, rf"(?i)\b{word}\s*(\d{{1,3}}(?:\.\d+)?)\s*%", 1).try_cast("double")
        return F.when(n.between(0, 100), F.round(n / 100, 6))

    scripts = F.regexp_extract_all("html", F.lit(r'(?is)<script\b[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'), F.lit(1))
    events = F.flatten(F.transform(scripts, lambda j: F.when(F.trim(j).startswith("["), F.from_json(j, f"array<{EVENT}>")).otherwise(F.array(F.from_json(j, EVENT)))))
    same = lambda e: (e["@type"] == "SportsEvent") & (e["url"] == F.col("url")) & (e["homeTeam"]["name"] == F.col("home")) & (e["awayTeam"]["name"] == F.col("away"))
    x = x.select("page_id", "url", "home", "away", "source_date", "source_time", F.inline(F.array(F.struct(*[share(*s).alias(n) for n, s in spec.shares.items()], F.nullif(E.fmt_score(F.regexp_extract("html", spec.score, 1)), F.lit("")).alias("score"), F.try_element_at(F.filter(events, same), F.lit(-1))["startDate"].alias("start")))))
    whole = F.abs(F.col("h") + F.col("d") + F.col("a") - 1) <= 0.025 + 1e-9
    zoned = F.col("start").rlike(r"(?:Z|[+-]\d{2}:\d{2})$") & (F.substring("start", 1, 10) == F.col("source_date")) & (F.substring("start", 12, 5) == F.col("source_time"))
    kickoff = F.when(zoned, F.try_to_timestamp("start"))
    rest = [c for c in spec.shares if c not in "hda"]
    return x.select("page_id", "url", "home", "away", F.col("source_date").try_cast("date").alias("source_date"), "source_time", *[F.when(whole, F.col(c)).alias(c) for c in "hda"], *rest, "score", kickoff.alias("kickoff"), F.when(kickoff.isNotNull(), "VERIFIED").otherwise("WALL_TIME").alias("status"))
