import random

import pytest

from matchlake.llm import repeats


def brute(rows):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            first[b[i : i + 50]] = min(first.get(b[i : i + 50], d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        spans, i = [], 0
        while (a := gone.find(1, i)) >= 0:
            i = gone.find(0, a) if gone.find(0, a) >= 0 else len(b)
            spans.append((a, i))
        out.append((d, len(b), tuple(spans), bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return sorted(out)


def result(df):
    return sorted((r["doc_id"], r["n_bytes"], tuple(map(tuple, r["spans"])), bytes(r["kept"])) for r in repeats.remove_repeats(df).collect())


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abé ") for _ in range(6))
    text = lambda n: "".join(word() for _ in range(n))
    shared = [text(r.randint(5, 30)) for _ in range(6)]
    rows = [(i, "".join(r.choice([text(r.randint(0, 12)), (s := r.choice(shared))[r.randint(0, 20) :], s[: r.randint(0, 90)]]) for _ in range(r.randint(0, 6)))) for i in range(80)]
    rows += [(100 + i, rows[i % 7][1]) for i in range(20)] + [(200 + i, "x" * n) for i, n in enumerate((49, 50, 51, 120, 50))]
    rows += [(300, None), (301, ""), (302, "ab" * 100), (303, "b" + "ab" * 70), (304, rows[3][1] * 3), (305, "\0" * 60), (306, "\0" * 61)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(*row, 1, 2) for row in rows], "doc_id long, text string, h int, at int").repartition(5)
    assert result(df) == brute(rows)


def test_given_documents_in_small_chunks(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert result(df) == brute([(r["doc_id"], r["text"]) for r in df.collect()])


def test_chunks_change_nothing(monkeypatch):
    import numpy as np

    data = np.frombuffer(random.Random(4).randbytes(5000), np.uint8) % 4
    offsets = np.array([0, 10, 70, 70, 3000, 4970, 5000])
    whole = set(zip(*[c.tolist() for c in repeats.anchors(data, offsets)]))
    monkeypatch.setattr(repeats, "CHUNK", 128)
    assert set(zip(*[c.tolist() for c in repeats.anchors(data, offsets)])) == whole


def test_shared_ids_and_empty_table(spark):
    t = "some text that is certainly long enough to be a match of fifty bytes"
    df = spark.createDataFrame([(1, t), (1, t), (1, "x" + t), (2, t), (None, "short")], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_bytes"], len(r["kept"])) for r in repeats.remove_repeats(df).collect())
    assert got == [(0, 5, 5), (1, 68, 68), (1, 68, 68), (1, 69, 69), (2, 68, 0)]
    assert repeats.remove_repeats(df.limit(0)).collect() == []
