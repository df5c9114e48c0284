import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from matchlake.llm import phrases, registry

LOWER = {c: c + 32 for c in range(65, 91)}


def brute_force(docs, least=10, subsumed=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, count in f.items():
        candidates = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        dropped = {q for p, a in candidates.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= subsumed * count[q]}
        kept = []
        for p, a in candidates.items():
            if p not in dropped:
                s, k = min((1_000_000 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-s, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, rank, p.decode(), -a, le, r, n[lang], -s) for rank, (s, a, p, le, r) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def found(spark, docs, **options):
    df = spark.createDataFrame([(text, lang, "x", 1) for lang, text in docs], "text string, lang string, phrase string, n int").repartition(5)
    return sorted(map(tuple, phrases.collocations(df, **options).collect()))


def made(seed, n):
    rng = random.Random(seed)
    words = ["a", "A", "b", "the", "The", "of", "É", "é", "日本", "x y", "z\x00", " ", "rare"]
    ends = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "!?"]
    return [(rng.choice(["en", "en", "de", None, ""]), "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 60)))) for _ in range(n)]


def test_against_brute_force(spark):
    docs = [*made(1, 500), ("en", None), (None, ""), ("fr", " \t\n. "), ("en", "Of the Of the")]
    want = brute_force(docs)
    assert len(want) > 200 and found(spark, docs) == want


def test_parts_and_stripes_of_few_words(spark, monkeypatch):
    """Texts cut into parts, and stripes sent within them, lose no phrase; the tasks take the sizes with the functions."""
    docs = made(2, 60) + [("en", "one two three " * 500), ("en", "x" * 3000 + " one two")]
    want = brute_force(docs, least=3)
    table = spark.createDataFrame([("und" if lang is None else lang, text) for lang, text in docs], "lang string, text string").coalesce(1).toArrow().combine_chunks()
    for held, size in ((40, 64), (7, 16)):
        monkeypatch.setattr(phrases, "HELD", held)
        monkeypatch.setattr(phrases, "CUT", size)
        streams, total = {}, Counter()
        batches = []
        for lang, text in zip(table["lang"].to_pylist(), table["text"].to_pylist()):
            stream = streams.setdefault(lang, phrases.Stream(lang, None))
            batches += stream.add([(text or "").encode()])
        for s in streams.values():
            batches += s.stripes()
        for b in batches:
            for lang, prefix, nexts, counts in zip(*(b.column(k).to_pylist() for k in (0, 1, 3, 4))):
                for x, n in zip(nexts, counts):
                    total[lang, prefix, x] += n
        pairs = {(lang, f"{a} {b}"): n for (lang, a, b), n in total.items() if a is not None and b is not None}
        for lang, _, phrase, a, *_ in want:
            if phrase.count(" ") == 1:
                assert pairs[lang, phrase] == a
    assert found(spark, docs, least=3) == want


def test_subsumption_ties_and_top(spark):
    docs = [("en", "new york city. " * 10 + "new york. " * 11 + "york city. " * 9), ("en", "a b. c d. " * 12), ("de", "a b. " * 9)]
    rows = found(spark, docs)
    assert rows == brute_force(docs)
    kept = [r[2] for r in rows]
    assert "new york" in kept and "york city" not in kept and "new york city" in kept  # 10 of 21, and 10 of 19
    assert [r[2] for r in found(spark, docs, top=1)] == ["a b"]  # as high and as often as 'c d', earlier by bytes
    assert found(spark, [("en", None)]) == [] and found(spark, []) == []


def test_large_products(spark):
    """Products of counts beyond 64 bits are exact."""
    big = [(7_000_000_011, 7_000_000_019, 7_000_000_023), (10**12, 10**12 + 1, 10**12 + 3), (999, 10**14, 10**14)]
    df = spark.createDataFrame(big, "a long, l long, r long").select(phrases.score("a", "l", "r"))
    assert [r[0] for r in df.collect()] == [1_000_000 * a * a // (le * r) for a, le, r in big]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    folder = f"/root/testdata/{sf}"
    got = registry.op13_collocations(spark, folder)
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = c.sql(registry.OP13_SQL)
    assert got.columns == want.columns
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(want.fetchall())
    if sf == "sf0.001":
        docs = spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text").collect()
        assert rows == brute_force(map(tuple, docs))
