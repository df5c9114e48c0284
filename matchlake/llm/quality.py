"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one
failure bit per rule; policies (named sets of rules) and ablations are bit operations on it.
All of it is built-in column functions: no Python runs on the executors and nothing is shuffled,
but for the small count per distinct bitmask in `ablations`.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
WINDOW = 8

#: Frequent words of English, German, French and Spanish prose.
STOP_WORDS = ("the", "of", "and", "to", "in", "is", "that", "with", "der", "die", "das", "und", "ist", "nicht", "mit", "von", "le", "la", "les", "et", "des", "est", "que", "de", "el", "los", "las", "y", "en", "un", "una", "por")

#: Rules by bit: name, and when a measured document fails.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "many_symbols": "10 * n_symbols > 3 * n_words",
    "repeated_lines": "n_lines >= 4 AND 10 * n_dup_lines > 6 * n_lines",
    "short_words": "n_words > 0 AND word_chars < 2 * n_words",
    "long_words": "n_words > 0 AND word_chars > 20 * n_words",
    "many_digits": "10 * n_digits > 3 * word_chars",
    "bullet_lines": "n_lines >= 4 AND 10 * n_bullet_lines > 9 * n_lines",
    "cut_off_lines": "n_lines >= 4 AND 10 * n_cut_off_lines > 3 * n_lines",
    "few_stop_words": "n_words >= 50 AND n_stop_words < 2",
    "many_lines": "n_lines >= 10 AND 2 * n_lines > n_words",
    "all_lines_repeat": "n_lines >= 4 AND 4 * n_dup_lines >= 3 * n_lines",
}
BASE = ("few_words", "repeated_windows")
#: Policies by version.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    "v1": (*BASE, "many_symbols", "repeated_lines", "short_words", "long_words"),
    "v2": (*BASE, "many_symbols", "repeated_lines", "short_words", "long_words", "many_digits", "bullet_lines", "cut_off_lines", "few_stop_words", "many_lines", "all_lines_repeat"),
}
#: Measurements that only some rules ask for.
EXTRA = ("n_digits", "n_bullet_lines", "n_cut_off_lines", "n_stop_words")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", extra: Iterable[str] = ()) -> DataFrame:
    """The id and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of every whole text, and the extra counts asked for.

    Lines are cut off if they end in three dots, and bullet lines begin with -, * or a bullet. Stop words are counted as written in STOP_WORDS. A null or empty text has no words, symbols or lines: all counts are 0. Repeated rows are
    measured one by one. Other columns of docs are ignored, whatever their names.
    Windows are compared by 64-bit hashes of eight 64-bit word hashes, within one text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), text.alias("t"))
    d = d.select("id", "t", F.btrim("t", F.lit(SPACE)).alias("b"))
    d = d.select(
        "id",
        "t",
        F.when(F.length("b") > 0, F.transform(F.split("b", SPACES), lambda w: F.xxhash64(w))).otherwise(F.array().cast("array<bigint>")).alias("hashes"),
        F.filter(F.split("t", "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0).alias("lines"),
    )
    lines = lambda pattern: F.size(F.filter("lines", lambda x: x.rlike(pattern)))
    more = {
        "n_digits": lambda: F.regexp_count("t", F.lit("[0-9]")), "n_bullet_lines": lambda: lines(r"^[\x20\x09]*[-*\u2022]"), "n_cut_off_lines": lambda: lines(r"(\.\.\.|\u2026)[\x20\x09-\x0D]*$"),
        "n_stop_words": lambda: F.size(F.filter("hashes", lambda h: h.isin(*[F.xxhash64(F.lit(w)) for w in STOP_WORDS]))),
    }
    more = {name: c() for name, c in more.items() if name in set(extra)}
    d = d.select(
        "id",
        *[c.cast("long").alias(name) for name, c in more.items()],
        F.size("hashes").cast("long").alias("n_words"),
        (F.length("t") - F.regexp_count("t", F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("hashes") > WINDOW,
            F.transform(F.sequence(F.lit(1), F.greatest(F.size("hashes") - (WINDOW - 1), F.lit(1))), lambda i: F.xxhash64(F.slice("hashes", i, WINDOW))),
        ).alias("windows"),
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", *more]
    # Positions are sorted and compared only where some window occurs twice.
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    d = d.select("id", *counts, F.when(twice, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("s"))
    here = lambda i: F.get("s", i)["h"]
    d = d.select(
        "id",
        *counts,
        F.sort_array(F.transform(F.filter("s", lambda x, i: F.coalesce(here(i - 1) == x["h"], F.lit(False)) | F.coalesce(here(i + 1) == x["h"], F.lit(False))), lambda x: x["i"])).alias("p"),
    )
    # Each repeated window adds the words up to the next repeated window, at most all of its own.
    added = F.transform("p", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get("p", i + 1) - x, F.lit(WINDOW))).cast("long"))
    repeat = F.coalesce(F.aggregate(added, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0)).cast("long")
    # Through inline, so that a filter on the counts is not moved below them, where each mention would compute them again.
    return d.select(F.inline(F.array(F.struct(F.col("id").alias(id_col), *counts, repeat.alias("n_repeat_words")))))


def bit(rule: str, rules: Mapping[str, str] = RULES) -> int:
    return 1 << list(rules).index(rule)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Mapping[str, str] = RULES) -> DataFrame:
    """Measurements and `failures`, a bigint with one bit for each rule that the document fails."""
    if len(rules) > 62:
        raise ValueError("a ledger has at most 62 rules")
    measured = measure(docs, id_col, text_col, [name for name in EXTRA if any(name in fails for fails in rules.values())])
    failures = F.lit(0).cast("long")
    for name, fails in rules.items():
        failures = failures.bitwiseOR(F.when(F.expr(fails), F.lit(bit(name, rules)).cast("long")).otherwise(F.lit(0).cast("long")))
    return measured.withColumn("failures", failures)


def mask(policy: Iterable[str], rules: Mapping[str, str] = RULES) -> int:
    return sum(bit(name, rules) for name in set(policy))


def passes(policy: Iterable[str], rules: Mapping[str, str] = RULES) -> Column:
    """Whether a ledger row passes a policy."""
    return F.col("failures").bitwiseAND(F.lit(mask(policy, rules)).cast("long")) == 0


def ablations(book: DataFrame, policy: Iterable[str], rules: Mapping[str, str] = RULES) -> DataFrame:
    """For each rule of a policy: how many documents fail it, fail it alone, and how many the policy keeps with and without it.

    Documents are first counted by bitmask, so the rest works on one row per distinct mask. An empty ledger gives no rows.
    """
    policy = [r for r in rules if r in set(policy)]
    whole = mask(policy, rules)
    by_mask = book.groupBy(F.col("failures").bitwiseAND(F.lit(whole).cast("long")).alias("m")).agg(F.count("*").alias("n"))
    each = by_mask.select("m", "n", F.inline(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(bit(r, rules)).cast("long").alias("b")) for r in policy])))
    some = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0)).alias
    return each.groupBy("rule").agg(
        some(F.col("m").bitwiseAND(F.col("b")) != 0)("n_failed"),
        some(F.col("m") == F.col("b"))("n_failed_alone"),
        some(F.col("m") == 0)("n_kept"),
        some((F.col("m") == 0) | (F.col("m") == F.col("b")))("n_kept_without"),
    )
