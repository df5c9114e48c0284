import random

import numpy as np

from matchlake.llm import neardup


def brute(rows):
    """component of each row index by all pairs."""
    sets = []
    for _, t in rows:
        w = [x for x in (t or "").encode().lower().split()]
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                up[root(i)] = root(j)
    comp = {}
    for i, (d, _) in enumerate(rows):
        comp[root(i)] = min(comp.get(root(i), d), d)
    return {(d, len(sets[i]), comp[root(i)]) for i, (d, _) in enumerate(rows)}


def corpus():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    rows = [(0, None), (1, ""), (2, " \n"), (3, "One two"), (4, "one  TWO"), (5, "one two three"), (6, "é É"), (7, "É é")]
    base = [word() for _ in range(120)]
    for _ in range(60):  # one large group of near copies, chained
        w = list(base)
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = word()
        rows.append((len(rows), " ".join(w)))
    rows += [(len(rows) + i, rows[20][1].upper()) for i in range(30)]  # copies
    for _ in range(60):
        rows.append((len(rows), " ".join(word() for _ in range(r.randint(1, 200)))))
    passage = " ".join(word() for _ in range(60))
    rows += [(len(rows) + i, passage + " " + " ".join(word() for _ in range(60))) for i in range(20)]
    return rows


def test_equals_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, cls int")
    got = neardup.near_duplicates(docs).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == brute(rows) and len(got) == len(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_blocks_of_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 4)
    monkeypatch.setattr(neardup, "BLOCK", 8)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r)[:3] for r in neardup.near_duplicates(docs).collect()} == brute(rows)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert {tuple(r)[:3] for r in neardup.near_duplicates(docs).collect()} == brute(rows)


def test_empty_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")] * 3 + [(None, "a b c d e f"), (None, None)], "doc_id long, text string")
    assert neardup.near_duplicates(docs.limit(0)).collect() == []
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in neardup.near_duplicates(docs).collect()) == [(0, 0), (0, 1), (1, 1), (1, 1), (1, 1)]


def test_signatures_estimate_similarity():
    x = np.random.default_rng(1).integers(0, 2**63, 3000).astype(np.uint64)
    a, b = neardup.signature(x[:2000], 2000), neardup.signature(x[500:2500], 2000)
    assert abs((a == b).mean() - 1500 / 2500) < 0.05


def test_digests_have_128_bits():
    some = [neardup.digest_of(np.array(x, np.uint64)) for x in ([1], [2], [1, 2], [1])]
    d1, d2 = neardup.halves([*some, None])
    assert all(len(d) == 16 for d in some) and len(set(some)) == len(set(d1[:4].to_pylist())) == len(set(d2[:4].to_pylist())) == 3
    assert d1[4].as_py() is None and d2[4].as_py() is None and (d1[0], d2[0]) == (d1[3], d2[3])
    assert [len(x) for x in neardup.halves([])] == [0, 0]
