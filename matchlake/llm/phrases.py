"""Collocations by stripes: each prefix keys an associative counter of the words that follow it.

A task counts what follows each prefix of its texts and sends stripes (prefix, next words, counts); stripes of one prefix are
merged elementwise. A merged stripe holds the prefix's total, as an entry for no next word, and the counts of its extensions, whose largest
tells what they subsume. First the prefixes are single words. Then they are pairs:
a phrase of three words that occurs LEAST times begins and ends with pairs that do, so only such pairs make stripes. A bit array
of bounded size tells them; a pair that it takes for another's only makes a stripe whose counts stay below LEAST.

A stripe is dealt out in SLICES by the next word, so the most frequent prefix is no task's alone; no counter is held whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm.scratch import cut
from matchlake.llm.secrets import segments

#: Occurrences of a candidate; share of them, in hundredths, that a longer candidate takes over; phrases of each language.
LEAST, SUBSUMED, TOP = 10, 50, 2000
#: Parts of a stripe, by the next word's hash.
SLICES = 32
#: Words that a task counts before it sends stripes, and bytes of a text that are cut into words at once.
HELD, CUT = 6_000_000, 4 << 20
#: The array of frequent pairs: bits for each, and at most.
BITS_PER_PAIR, MOST_BITS = 16, 1 << 30
#: Ends of pieces become line feeds, tabs spaces.
PLAIN = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d\x09", b"\n" * 10 + b" ")
STRIPE = "lang string, prefix string, slice int, next array<string>, n array<bigint>"


class Ids(dict):
    """Numbers of words from 1 on; an end of a piece is 0, nothing between two spaces -1."""

    def __init__(self):
        super().__init__({b"": -1, b"\n": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = out = len(self) - 1
        return out

    def words(self) -> list[bytes]:
        """By number."""
        return [b"", *list(self)[2:]]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def pair_hash(lang: str, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Of pairs of words, from the hashes of the words."""
    import xxhash

    seed = np.uint64(xxhash.xxh64_intdigest(lang.encode()))
    return mixed(mixed(first ^ seed) + second)


def hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def cut_up(text: bytes) -> Iterator[bytes]:
    """Parts of about CUT bytes that end where a word does."""
    at = 0
    while len(text) - at > CUT:
        end = max(text.rfind(b" ", at, at + CUT), text.rfind(b"\n", at, at + CUT)) + 1
        if end <= at:  # one long word
            ends = [e for e in (text.find(b" ", at), text.find(b"\n", at)) if e >= 0]
            end = min(ends) + 1 if ends else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


class Stream:
    """The words of one language in a task, in order; at most about HELD are held."""

    def __init__(self, lang: str, frequent: np.ndarray | None):
        self.lang, self.frequent = lang, frequent
        self.ids, self.parts, self.held = Ids(), [], 0

    def add(self, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        for part in cut_up(b"\n".join(texts).lower().translate(PLAIN)):
            words = part.replace(b"\n", b" \n ").split(b" ")
            ids = np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words))
            self.parts.append(ids[ids >= 0])
            self.held += len(self.parts[-1])
            if self.held >= HELD:
                yield from self.stripes(last=False)
        self.parts.append(np.zeros(1, np.int32))

    def stripes(self, last: bool = True) -> Iterator[pa.RecordBatch]:
        """What the words held give; but for the last time, the last two words stay, since what follows them is not known."""
        ids, words = np.concatenate([*self.parts, np.zeros(2, np.int32)] if last else self.parts), self.ids.words()
        self.ids = Ids()
        self.parts = [np.array([self.ids[words[i]] if i else 0 for i in ids[-2:]], np.int32)]
        self.held = 2
        a, b, c = ids[:-2].astype(np.int64), ids[1:-1].astype(np.int64), ids[2:]
        h = hashes(words)
        strings = pa.array(words, pa.binary()).cast(pa.string())
        if self.frequent is None:
            key, n = np.unique((a << 32 | b)[(a > 0) & (b > 0)], return_counts=True)
            total = np.bincount(a, minlength=len(words))
            total[0] = total[1:].sum()  # of the language, under no prefix
            every = np.flatnonzero(total)
            prefix, follows, n = np.append(every, key >> 32), np.append(np.zeros_like(every), key & 0xFFFFFFFF), np.append(total[every], n)
            names = pa.array([None, *words[1:]], pa.binary()).cast(pa.string())
        else:
            whole = np.flatnonzero((a > 0) & (b > 0) & (c > 0))
            whole = whole[holds(self.frequent, pair_hash(self.lang, h[a[whole]], h[b[whole]]))]
            whole = whole[holds(self.frequent, pair_hash(self.lang, h[b[whole]], h[c[whole]]))]
            pairs, at = np.unique(a[whole] << 32 | b[whole], return_inverse=True)
            key, n = np.unique(at.astype(np.int64) << 32 | c[whole], return_counts=True)
            prefix, follows = key >> 32, key & 0xFFFFFFFF
            names = pc.binary_join_element_wise(strings.take(pa.array(pairs >> 32)), strings.take(pa.array(pairs & 0xFFFFFFFF)), " ")
        part = (h[follows] % np.uint64(SLICES)).astype(np.int32) * (follows > 0)
        order = np.lexsort((part, prefix))
        prefix, part, follows, n = prefix[order], part[order], follows[order], n[order]
        first = np.flatnonzero(np.diff(prefix, prepend=-1) | np.diff(part, prepend=-1)) if len(n) else np.zeros(0, np.int64)
        ends = np.append(first, len(n))
        for i in range(0, len(first), 50_000):
            mine = first[i : i + 50_000]
            offsets, rows = ends[i : i + len(mine) + 1], slice(mine[0], ends[i + len(mine)])
            offsets = pa.array((offsets - offsets[0]).astype(np.int32))
            nexts = strings.take(pa.array(follows[rows], mask=follows[rows] == 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array([self.lang] * len(mine), pa.string()), names.take(pa.array(prefix[mine])), pa.array(part[mine]), pa.ListArray.from_arrays(offsets, nexts), pa.ListArray.from_arrays(offsets, pa.array(n[rows]))],
                ["lang", "prefix", "slice", "next", "n"],
            )


def holds(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64(len(bits) * 64 - 1)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def merged(docs: DataFrame, frequent: np.ndarray | None, least: int) -> DataFrame:
    """lang, prefix, next, n: the entries of the merged stripes of docs (lang, text) that have `least` occurrences.

    Without `frequent` prefixes are words, and a stripe's entry for no next word is its prefix's total (that for no prefix the language's). With
    it they are pairs of words that it holds, before a word with which the second is such a pair.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        streams: dict[str, Stream] = {}
        for b in batches:
            at = 0
            for part in segments(b.column(1), CUT):
                by_lang: dict[str, list[bytes]] = {}
                for lang, text in zip(b.column(0).slice(at, len(part)).to_pylist(), part.cast(pa.binary()).to_pylist(), strict=True):
                    by_lang.setdefault(lang, []).append(text)
                at += len(part)
                for lang, texts in by_lang.items():
                    if lang not in streams:
                        streams[lang] = Stream(lang, shared.value)
                    yield from streams[lang].add(texts)
                    if sum(s.held for s in streams.values()) >= HELD:
                        for s in streams.values():
                            yield from s.stripes()
                        streams.clear()
        for s in streams.values():
            yield from s.stripes()

    stripes = docs.mapInArrow(count, STRIPE).repartition("lang", "prefix", "slice")
    entries = stripes.select("lang", "prefix", "slice", F.inline(F.arrays_zip("next", "n")))
    # Stripes are dealt out by prefix and slice already: this aggregation does not shuffle.
    summed = entries.groupBy("lang", "prefix", "slice", "next").agg(F.sum("n").alias("n"))
    return cut(summed.where(F.col("n") >= least).select("lang", "prefix", "next", "n"), "stripes")


def pair_bits(pairs: DataFrame) -> np.ndarray:
    """The bit array of pairs (lang, first, second); the driver gets words of bits, MOST_BITS at most."""
    n_bits, n = 1 << 12, pairs.count()
    while n_bits < min(n * BITS_PER_PAIR, MOST_BITS):
        n_bits *= 2

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang = np.array(b.column(0).to_pylist(), object)
            first, second = (hashes(b.column(k).cast(pa.binary()).to_pylist()) for k in (1, 2))
            at = np.zeros(len(b), np.uint64)
            for x in set(lang):
                here = lang == x
                at[here] = pair_hash(x, first[here], second[here]) & np.uint64(n_bits - 1)
            at = np.unique(at)
            word, start = np.unique(at >> np.uint64(6), return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), start) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(bits.view(np.int64))], ["word", "bits"])

    out = np.zeros(n_bits // 64, np.int64)
    each = pairs.select("lang", "first", "second").mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    runs = each.groupBy(F.shiftright("word", 16).alias("run")).agg(F.collect_list("word").alias("word"), F.collect_list("bits").alias("bits"))
    for row in runs.toLocalIterator():
        out[row["word"]] = row["bits"]
    return out.view(np.uint64)


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (left right)) of columns, exact up to 10^15 occurrences."""
    whole = lambda c: f"CAST({c} AS DECIMAL(15,0))"
    return F.expr(f"(1000000 * {whole(a)} * {whole(a)}) div ({whole(left)} * {whole(right)})")


def ranked(phrases: DataFrame, top: int) -> DataFrame:
    """The first `top` of each language with their rank: sorted over ranges, so no language is one task's alone."""
    order = ["lang", F.desc("score"), F.desc("a"), "phrase"]
    placed = cut(phrases.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "ranked")
    before, shift = {}, []
    for r in sorted(placed.groupBy("part", "lang").agg(F.min("at").alias("first"), F.count("*").alias("size")).collect()):  # a row for each range and language
        shift.append((r["part"], r["lang"], before.get(r["lang"], 0) - r["first"] + 1))
        before[r["lang"]] = before.get(r["lang"], 0) + r["size"]
    shift = F.broadcast(placed.sparkSession.createDataFrame(shift, "part int, lang string, shift bigint"))
    return placed.join(shift, ["part", "lang"]).withColumn("rank", F.col("at") + F.col("shift")).where(F.col("rank") <= top)


def collocations(docs: DataFrame, least: int = LEAST, subsumed: int = SUBSUMED, top: int = TOP, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first `top` phrases of 2 to 3 words.

    A null language is `und`, a null or empty text has no words, and rows that repeat count as often as they occur. Texts of any
    length are counted in parts; a word is as long as it is. Ties are broken by a and the phrase. Other columns are ignored, whatever their names; an empty table gives an empty one.
    """
    d = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    single = merged(d, None, least)
    words = single.where("prefix IS NOT NULL AND next IS NULL").select("lang", F.col("prefix").alias("word"), F.col("n").alias("f"))
    n = single.where("prefix IS NULL").select("lang", "n")
    pairs = single.where("next IS NOT NULL").select("lang", F.col("prefix").alias("first"), F.col("next").alias("second"), F.col("n").alias("a"))
    of = lambda column, f: words.withColumnsRenamed({"word": column, "f": f})
    pairs = cut(pairs.join(of("first", "f_first"), ["lang", "first"]).join(of("second", "f_second"), ["lang", "second"]), "pairs")

    longer = merged(d, pair_bits(pairs), least).withColumnRenamed("prefix", "front")
    middle = F.substring_index("front", " ", -1)
    longer = longer.select("lang", F.substring_index("front", " ", 1).alias("first"), middle.alias("second"), F.col("next").alias("third"), F.col("n").alias("a"))
    front = pairs.select("lang", "first", "second", F.col("f_first").alias("l1"), F.col("a").alias("l2"))
    back = pairs.select("lang", F.col("first").alias("second"), F.col("second").alias("third"), F.col("a").alias("r1"), F.col("f_second").alias("r2"))
    longer = cut(longer.join(front, ["lang", "first", "second"]).join(back, ["lang", "second", "third"]), "longer")

    # The largest extensions of a pair, on either side.
    largest = longer.select("lang", "first", "second", "a").union(longer.select("lang", "second", "third", "a")).groupBy("lang", "first", "second").agg(F.max("a").alias("most"))
    left = pairs.join(largest, ["lang", "first", "second"], "left").where(F.col("most").isNull() | (100 * F.col("most") < subsumed * F.col("a")))
    two = left.select("lang", F.concat_ws(" ", "first", "second").alias("phrase"), "a", F.col("f_first").alias("l"), F.col("f_second").alias("r")).withColumn("score", score("a", "l", "r"))
    scored = longer.withColumn("s1", score("a", "l1", "r1")).withColumn("s2", score("a", "l2", "r2"))
    early = F.col("s1") <= F.col("s2")
    choose = lambda x, y: F.when(early, F.col(x)).otherwise(F.col(y))
    three = scored.select("lang", F.concat_ws(" ", "first", "second", "third").alias("phrase"), "a", choose("l1", "l2").alias("l"), choose("r1", "r2").alias("r"), choose("s1", "s2").alias("score"))
    best = ranked(two.union(three), top)
    return best.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
