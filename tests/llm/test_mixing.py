import hashlib
import math
from collections import defaultdict

import pytest
from test_quality import brute as quality_brute

from matchlake.llm import mixing


def brute_targets(sizes):
    """Targets by raising a level until the shares add up, from source to size."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        out = {s: w[s] * left / sum(w[f] for f in free) for s in free}
        over = {s for s in free if out[s] > 3 * sizes[s]}
        if not over:
            return {s: out.get(s, 3 * sizes[s]) for s in order}
        capped |= over


def weight(text):
    """Fresh words over one more than the failed rules of policy v1, by brute force."""
    n, chars, symbols, lines, dup, repeat = quality_brute(text)
    failed = [n < 20, 100 * repeat > 30 * n, 10 * symbols > 3 * n, lines >= 4 and 10 * dup > 6 * lines, n > 0 and chars < 2 * n, n > 0 and chars > 20 * n]
    return (max(0.05, 1 - repeat / n) if n else 0.05) / (1 + sum(failed))


def brute(rows):
    """(id, size, target, taken) of (id, source, text) rows with distinct ids."""
    texts = {i: t or "" for i, _, t in rows}
    docs = [(i, s, len((t or "").split())) for i, s, t in rows]
    sizes = defaultdict(int)
    for _, s, n in docs:
        sizes[s] += n
    targets, out = brute_targets(dict(sizes)), []
    for s in sizes:
        mine = []
        for i, t, n in docs:
            if t == s:
                digest = hashlib.md5(texts[i].encode()).hexdigest()
                u = (int(hashlib.md5(f"{i}:{digest}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
                mine.append((-math.log(u) / weight(texts[i]), i, n))
        epochs = min(3, math.floor(targets[s] / sizes[s] + 1e-9)) if sizes[s] else 0
        rest = round(max(0.0, targets[s] - epochs * sizes[s]))
        for _, i, n in sorted(mine):
            more = max(0, min(n, rest))
            rest -= n
            out.append((i, n, round(targets[s], 6), epochs * n + more))
    return sorted(out)


ROWS = [(i, f"s{i % 7}" if i % 11 else None, " ".join(f"w{k % (3 + i % 60)}" for k in range((i * 37) % 91))) for i in range(300)] + [(300, "tiny", "a"), (301, "none", ""), (302, "none", None), (303, "é", "x y"), (304, "Z", "one two three")]


def test_equals_brute_force(spark):
    df = spark.createDataFrame([(*r, 1, "x") for r in ROWS], "doc_id long, source string, text string, size int, part string").repartition(4)
    got = mixing.mix(df).collect()
    assert sorted((r["doc_id"], r["size"], round(r["target"], 6), r["taken"]) for r in got) == brute(ROWS)
    per = defaultdict(lambda: [0, 0.0])
    for r in got:
        assert r["taken"] <= 3 * r["size"] and r["n_copies"] <= 3 + 0
        per[r["source"]][0] += r["taken"]
        per[r["source"]][1] = r["target"]
    assert all(abs(t - g) <= 0.5 for t, g in per.values())
    assert sum(g for _, g in per.values()) == pytest.approx(sum(len((t or "").split()) for _, _, t in ROWS))


def test_reruns_agree_however_rows_are_dealt(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, source string, text string")
    a, b = (sorted(map(tuple, mixing.mix(df.repartition(n)).collect()), key=str) for n in (1, 7))
    assert a == b


def test_rows_that_repeat_are_taken_one_after_the_other(spark):
    """A third of a source in copies of one row without an id: no key range holds them all, and the totals hold."""
    rows = [(None, "a", "same words here")] * 500 + [(i, "a", f"word{i} and {i} more") for i in range(1000)] + [(9000, "b", "b " * 50)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)).collect()
    copies = sorted((r["taken"] for r in got if r["doc_id"] is None), reverse=True)
    assert len(got) == len(rows) and len(copies) == 500 and copies[0] - copies[-1] <= 3
    assert abs(sum(r["taken"] for r in got if r["source"] == "a") - next(r["target"] for r in got if r["source"] == "a")) <= 0.5


def test_odd_tables(spark):
    schema = "doc_id long, source string, text string"
    assert mixing.mix(spark.createDataFrame([], schema)).collect() == []
    assert [r["taken"] for r in mixing.mix(spark.createDataFrame([(1, None, None)], schema)).collect()] == [0]
    same = mixing.mix(spark.createDataFrame([(1, "a", "x y")] * 4 + [(None, "b", "z")], schema)).collect()
    assert len(same) == 5 and sum(r["taken"] for r in same) == 9  # b takes 1/3 of 9 words but stops at 3


def test_edges():
    import bisect

    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    edges = [0.1 * k for k in range(1, 40)]
    got = SparkSession.getActiveSession().range(100).select((F.col("id") * 0.05).alias("k")).select("k", mixing.range_of(F.col("k"), edges).alias("n")).collect()
    assert all(r["n"] == bisect.bisect_left(edges, r["k"]) for r in got)
