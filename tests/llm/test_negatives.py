import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlake.llm import negatives, registry

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, score int"


def brute_force(rows, every=10, n_positives=5, n_negatives=10, low=30, high=90):
    """rows: (id, vector, label), with ids of their own."""
    usable = []
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v):
            usable.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v], label))
    out = []
    for i, v, label in usable:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in usable if j != i and len(w) == len(v))
        for p, j, _ in [s for s in scored if s[2] == label][:n_positives]:
            fit = [(s, k) for s, k, other in scored if other != label and low * -p <= 100 * -s <= high * -p][:n_negatives]
            out += [(i, j, r, k, -p, -s) for r, (s, k) in enumerate(fit, 1)]
    return sorted(out)


def found(spark, rows, every=10, **options):
    df = spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, negatives.mine(df, F.col("vec_id") % every == 0, **options).collect()))


def made(seed, n, dims=8, spread=0.5):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((4, dims))
    at = rng.integers(0, 4, n)
    v = centres[at] + spread * rng.standard_normal((n, dims))
    return [(i, [float(x) for x in v[i]], int(rng.integers(0, 3) if rng.random() < 0.5 else at[i])) for i in range(n)]


def test_strides_end_early_and_lose_nothing(spark, monkeypatch):
    """Small blocks, so that lists have many strides; walks are certified before their ends."""
    for name, value in (("BLOCK", 16), ("MEMBERS", 4), ("FIRST", 1), ("GROWTH", 2), ("RANGE", 200)):
        monkeypatch.setattr(negatives, name, value)
    met = []
    once = negatives._in_small_batches

    def counted(pairs, of, schema):
        met.append(pairs.select(F.sum(F.size("node") * F.size("m_node"))).first()[0])
        return once(pairs, of, schema)

    monkeypatch.setattr(negatives, "_in_small_batches", counted)
    rows = made(1, 400, spread=0.15)
    assert found(spark, rows) == brute_force(rows)
    assert sum(met) < 2 * 40 * 400  # pairs of an anchor and a row in both walks


def test_odd_rows(spark):
    rows = made(2, 60)
    rows += [(100, None, 1), (101, [], 1), (102, [float("nan")] * 8, 1), (103, [1.0, None] * 4, 1), (104, [float("inf")] * 8, 1), (110, [0.0] * 8, 1), (120, [1.0, 0.5], 1), (121, [0.5, 1.0], 1), (122, [0.6, 0.1], 2), (130, [3.0], 0)]
    rows += [(None, [1.0] * 8, 1), (140, [1.0] * 8, None), (141, [3e38] * 8, 1), (-20, [1.0] * 8, 1), (-30, [-1.0] * 8, 2)]
    unusable = {141}
    want = brute_force([r for r in rows if r[0] not in unusable])
    assert found(spark, rows + rows[:25]) == want  # rows that repeat count once
    assert any(r[0] == 120 for r in want) and any(r[0] == 110 for r in want)
    assert found(spark, []) == [] and found(spark, [(1, [1.0], 1)]) == []


def test_ties_and_copies(spark, monkeypatch):
    """A third of all rows are one vector: scores tie and go by id."""
    monkeypatch.setattr(negatives, "BLOCK", 32)
    rows = [(i, [0.5, 0.25, 0.0] if i % 3 else [0.3, 0.1 * (i % 5), 0.2], i % 4) for i in range(300)]
    assert found(spark, rows) == brute_force(rows)


def test_other_numbers(spark):
    rows = made(3, 120)
    assert found(spark, rows, every=4, n_positives=2, n_negatives=3, low=50, high=100) == brute_force(rows, 4, 2, 3, 50, 100)


def test_large_components_are_exact():
    rng = np.random.default_rng(0)
    a, b = rng.integers(-(2**28), 2**28, (2, 5, 4))
    want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
    assert negatives.products(a.astype("<i4"), b.astype("<i4")).tolist() == want


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    got = registry.op11_hard_negatives(spark, f"/root/testdata/{sf}")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/{sf}/embeddings.parquet'")
    want = c.sql(registry.OP11_SQL)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
