import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from matchlake.llm import repeats
from test_repeats import brute, corpus, result


@pytest.mark.parametrize("hot", [0, 3])
def test_hot_anchors_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    r = random.Random(hot)
    rows = corpus(4)
    ruler = "=" * 5 + "ruler-of-text" + "=" * 5
    rows += [(1000 + i, "".join(r.choice("abc") for _ in range(40)) + ruler + "".join(r.choice("ab") for _ in range(r.randint(5, 40)))) for i in range(60)]
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows)


def test_previous_factors_equal_all_pairs():
    r = np.random.default_rng(9)
    for n in (0, 1, 2, 7, 60):
        doc, shared = r.integers(0, max(1, n // 3) + 1, n), r.integers(0, 4, n)
        shared[:1] = 0
        prefix = lambda i, j: min(shared[i + 1 : j + 1])  # noqa: B023, E731
        want = [max([prefix(min(i, j), max(i, j)) for j in range(n) if doc[j] < doc[i]], default=0) for i in range(n)]
        assert repeats.previous_factors(doc, shared).tolist() == want


def test_an_anchor_of_many_contexts_in_bounded_memory():
    """200,000 contexts of one anchor, split by the bytes beside it, stay under 1 GB in a worker of their own."""
    import subprocess
    import sys

    code = """
import resource, sys
import numpy as np, pyarrow as pa
from matchlake.llm import repeats
r = np.random.default_rng(1)
n = 200_000
def batches():
    for i in range(0, n, 10_000):
        raw = r.integers(97, 101, (10_000, 80), dtype=np.uint8)
        raw[:, 30:50] = 120
        c = lambda v, t=np.int64: pa.array(np.asarray(v, t))
        m = np.arange(i, i + 10_000)
        yield pa.RecordBatch.from_arrays([c(np.zeros(10_000)), c(m), c(m), c(m), c(np.full(10_000, 30), np.int32), c(np.full(10_000, 50), np.int32), c(np.zeros(10_000), np.int32), c(np.full(10_000, 30), np.int32), pa.array([x.tobytes() for x in raw], pa.binary())], ["h", "doc", "key", "pos", "before", "after", "first", "last", "bytes"])
for _ in repeats._factors(batches()):
    pass
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss)
"""
    peak = int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout)
    assert peak < 1_000_000


def test_a_hot_anchor_is_not_carried():
    """The rows of one h over many batches leave with their batch."""
    n, size = 40, 50
    column = lambda v: pa.array(np.asarray(v, np.int64))
    at = np.arange(n * size)
    asked = []

    def batches():
        for i in range(0, n * size, size):
            part = at[i : i + size]
            asked.append(i)
            yield pa.RecordBatch.from_arrays([column(np.zeros(size)), column(part), column(part % 7), column(part), column(part)], ["h", "context", "doc", "key", "pos"])

    out = 0
    for b in repeats._meet(batches()):
        out += len(b)
        assert out >= (len(asked) - 1) * size
    assert out == n * size


def test_rows_that_share_an_id_and_a_checksum(spark):
    """Two texts of one id whose 23-bit checksums agree: each loses only what an earlier document holds."""
    r = random.Random(7)
    passage = "".join(r.choice("abcdefgh") for _ in range(60))
    seen, pair = {}, None
    while pair is None:
        t = "".join(r.choice("ijklmnop") for _ in range(30)) + ("" if len(seen) % 2 else passage) + "".join(r.choice("ijklmnop") for _ in range(90 if len(seen) % 2 else 30))
        other = seen.setdefault(zlib.crc32(t.encode()) & 0x7FFFFF, t)
        pair = (other, t) if (passage in other) != (passage in t) else None
    rows = [(1, passage), (5, pair[0]), (5, pair[1])]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_very_many_copies_of_one_row(spark):
    """Copies of a row that shares shorter strings and one passage with others: they meet once, and all are cut alike."""
    import hashlib

    from pyspark.sql import functions as F

    r = random.Random(8)
    text = "".join(r.choice("abcdefgh ") for _ in range(1000))
    near = "".join(text[i : i + 60] + "#%d#" % i for i in range(0, 960, 60))
    rows = [(1, near), (2, text), (3, text[:45] + "?" + text[300:360]), (7, "other text " * 3)]
    n = 30_000
    docs = spark.createDataFrame(rows, "doc_id long, text string").union(spark.range(n).select(F.lit(2).cast("long"), F.lit(text))).repartition(6)
    got = repeats.remove_repeats(docs).groupBy("doc_id", "n_bytes", "spans", F.sha2("kept", 256).alias("kept")).count().collect()
    assert {r["doc_id"]: r["count"] for r in got} == {1: 1, 2: n + 1, 3: 1, 7: 1}
    few = {r["doc_id"]: r for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for row in got:
        alone = few[row["doc_id"]]
        assert row["spans"] == alone["spans"] and row["kept"] == hashlib.sha256(alone["kept"]).hexdigest()
    assert any(row["spans"] for row in got if row["doc_id"] == 2)


def test_copies_are_dropped_over_batches():
    c = lambda v, t=np.int64: np.asarray(v, t)
    new, last = repeats._unlike_last([c([1, 1, 2]), c([5, 5, 5])], None)
    assert new.tolist() == [True, False, True]
    new, last = repeats._unlike_last([c([2, 2, 3]), c([5, 6, 6])], last)
    assert new.tolist() == [False, True, True]
    new, last = repeats._unlike_last([c([]), c([])], last)
    assert new.tolist() == [] and last == [3, 6]
    assert repeats._unlike_last([c([3]), c([6])], last)[0].tolist() == [False]
