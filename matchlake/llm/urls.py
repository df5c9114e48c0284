"""URL filters: rules for hosts and paths, looked up in a Bloom filter cascade.

A rule's key is its host and path in one string. The keys that a url could match are the ends of its host
and the starts of its path that have the lengths of some rule: a few for each url. All such keys of
the corpus are the universe. The first filter of the cascade encodes the listed keys, the second
the universe's false positives in the first, the third the listed keys that the second holds, and
so on until a level has no false positive left: then membership is exact for the whole universe,
and urls are judged in one pass without a join.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.scratch import cut

#: Action, host, path of each rule.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
BITS_PER_KEY = 12
PROBES = 8
#: A level has at most this many bits, so the filters that each task gets have a fixed bound of 128 MB a level.
MOST_BITS = 1 << 30
MOST_LEVELS = 24


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty for a null or a url without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def candidate_keys(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The keys that a url could match, longest first; of equal ones that with the longer host."""
    lengths = sorted({(len(h), len(p)) for _, h, p in rules}, key=lambda x: (-x[0] - x[1], -x[0]))
    whole = lambda n: F.lit(n == 0) | (F.length(host) == n) | ((F.length(host) > n) & (F.substr(host, F.length(host) - n, F.lit(1)) == "."))
    keys = [F.when(whole(h) & (F.length(path) >= p), F.concat(F.right(host, F.lit(h)), F.left(path, F.lit(p)))) for h, p in lengths]
    return F.array_compact(F.array(*keys)) if keys else F.array().cast("array<string>")


def positions(h: np.ndarray, g: np.ndarray, level: int, n_bits: int) -> np.ndarray:
    """The PROBES bits of each key at a level: h and g are its two 64-bit hashes."""
    h, g = h.view(np.uint64), g.view(np.uint64) | np.uint64(1)
    start = h ^ np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    start = (start ^ (start >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((start[:, None] + np.arange(PROBES, dtype=np.uint64) * g[:, None]) >> np.uint64(20)) & np.uint64(n_bits - 1)


def holds(words: np.ndarray, h: np.ndarray, g: np.ndarray, level: int) -> np.ndarray:
    """Whether a level's filter, 64 bits a word, has each key."""
    at = positions(h, g, level, len(words) * 64)
    return ((words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


class Cascade:
    """Exact membership of listed keys within a universe; levels are arrays of 64-bit words."""

    def __init__(self, spark: SparkSession, listed: DataFrame, universe: DataFrame):
        """listed, universe: DataFrames with a column key; nulls and repeated keys don't matter."""
        hashed = lambda df: df.where("key IS NOT NULL").select("key").distinct().select("key", F.xxhash64("key", F.lit(1)).alias("h"), F.xxhash64("key", F.lit(2)).alias("g"))
        inside, outside = cut(hashed(listed), "listed-keys"), hashed(universe)
        self.spark, self.levels, self.shared = spark, [], None
        # A row of `outside` is dropped as soon as a level for listed keys does not hold it, so only false positives are joined.
        holding, other = inside, outside
        for level in range(MOST_LEVELS):
            n = holding.count()
            if not n:
                break
            self.levels.append(self.build(holding, n, level))
            false = self.held(other, level)
            if level == 0:
                false = false.join(inside.select("key"), "key", "left_anti")
            holding, other = cut(false, "false-positives"), holding
        else:
            raise ValueError(f"{MOST_LEVELS} levels don't tell all keys apart: two keys share both 64-bit hashes, or a level needs over {MOST_BITS} bits")
        self.shared = spark.sparkContext.broadcast(self.levels)

    def build(self, keys: DataFrame, n: int, level: int) -> np.ndarray:
        n_bits = 64
        while n_bits < min(n * BITS_PER_KEY, MOST_BITS):
            n_bits *= 2

        def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                at = np.unique(positions(b.column(0).to_numpy(), b.column(1).to_numpy(), level, n_bits))
                word, first = np.unique(at >> np.uint64(6), return_index=True)
                bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(at) else at
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(bits.view(np.int64))], ["word", "bits"])

        out = np.zeros(n_bits // 64, np.int64)
        # Words come in runs of up to 64 K, so the driver copies runs and not single words.
        merged = keys.select("h", "g").mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
        runs = merged.groupBy(F.shiftright("word", 16).alias("run")).agg(F.collect_list("word").alias("word"), F.collect_list("bits").alias("bits"))
        for row in runs.toLocalIterator():
            out[row["word"]] = row["bits"]
        return out.view(np.uint64)

    def held(self, keys: DataFrame, level: int) -> DataFrame:
        shared = self.spark.sparkContext.broadcast(self.levels[level])

        def only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array(holds(shared.value, b.column(1).to_numpy(), b.column(2).to_numpy(), level)))

        return keys.mapInArrow(only, keys.schema)

    @staticmethod
    def contains(levels: list[np.ndarray], h: np.ndarray, g: np.ndarray) -> np.ndarray:
        """Listed: the first level that does not hold a key has an odd number, or all hold it and their number is odd."""
        answer, open_ = np.zeros(len(h), bool), np.arange(len(h))
        for level, words in enumerate(levels):
            held = holds(words, h[open_], g[open_], level)
            answer[open_[~held]] = level % 2 == 1
            open_ = open_[held]
        answer[open_] = len(levels) % 2 == 1
        return answer


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """id, host, path, rule (host and path of the longest that fits, else null), verdict: one row per input row.

    Urls that no rule fits get `default`; a rule with an empty host or path fits any. A rule whose path does not begin
    with / fits none. Null urls have an empty host and path. Repeated urls are judged alike. Other columns are ignored, whatever
    their names. An empty table gives an empty one.
    """
    spark = pages.sparkSession
    rules = [r for r in rules if r[2][:1] in ("", "/")]  # so host and path are told apart within a key
    host, path = split_url(F.col("url"))
    d = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url")).select("id", host.alias("host"), path.alias("path"))
    d = d.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), rules))
    universe = cut(d.select(F.explode("keys").alias("key")).distinct(), "candidate-keys")  # the pages are read once for it, not for each filter
    named = spark.createDataFrame([(h + p, a) for a, h, p in rules], "key string, action string")
    listed = Cascade(spark, named, universe).shared
    allowed = Cascade(spark, named.where("action = 'allow'"), universe).shared
    d = d.withColumn("h", F.transform("keys", lambda k: F.xxhash64(k, F.lit(1)))).withColumn("g", F.transform("keys", lambda k: F.xxhash64(k, F.lit(2))))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(3)
            h, g = b.column(4).flatten().to_numpy(), b.column(5).flatten().to_numpy()
            is_listed = np.flatnonzero(Cascade.contains(listed.value, h, g))
            rows = np.repeat(np.arange(len(b)), keys.value_lengths().fill_null(0).to_numpy())
            row, first = np.unique(rows[is_listed], return_index=True)
            best = is_listed[first]
            allow = Cascade.contains(allowed.value, h[best], g[best])
            rule, verdict = [None] * len(b), [default] * len(b)
            for i, key, ok in zip(row, keys.flatten().take(pa.array(best)).to_pylist(), allow, strict=True):
                rule[i], verdict[i] = key, "allow" if ok else "block"
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(rule, pa.string()), pa.array(verdict, pa.string())], ["id", "host", "path", "rule", "verdict"])

    out = d.mapInArrow(look_up, f"id {d.schema['id'].dataType.simpleString()}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("id", id_col)
