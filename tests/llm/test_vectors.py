import numpy as np
import pytest

from matchlake.llm import vectors


def brute(rows):
    good = [(i, np.array(v, float) / max(map(abs, v))) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    up = {k: k for k in range(len(good))}
    links = [0] * len(good)

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(good)):
        for b in range(a):
            x, y = good[a][1], good[b][1]
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95:
                links[a] += 1
                links[b] += 1
                up[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(good):
        least[root(k)] = min(least.get(root(k), i), i)
    out = {i: (0, i, True) for i, _ in rows}
    for k, (i, _) in enumerate(good):
        out[i] = (links[k], least[root(k)], least[root(k)] == i)
    return out


@pytest.mark.parametrize(("window", "crowd"), [(2048, 64), (16, 4), (16, 1000)])
def test_equals_all_pairs(spark, monkeypatch, window, crowd):
    """Also with windows far shorter than a cluster of 80: crowds are compared whole."""
    monkeypatch.setattr(vectors, "WINDOW", window)
    monkeypatch.setattr(vectors, "BLOCK", 4 * window)
    monkeypatch.setattr(vectors, "CHUNK", 8 if window < 100 else 512)
    monkeypatch.setattr(vectors, "CROWD", crowd)
    monkeypatch.setattr(vectors, "MEMBERS", 32)
    monkeypatch.setattr(vectors, "RANGE", 500)
    monkeypatch.setattr(vectors, "MISS", 1e-9)
    r = np.random.default_rng(2)
    base = r.standard_normal((120, 16))
    close = 80 if crowd < 1000 else 10
    x = [*base, *(base[0] + 0.12 * r.standard_normal((close, 16))), *(base[1:40] + 0.25 * r.standard_normal((39, 16))), *([base[5]] * 6), *(3 * base[6:8])]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [None] + [1.0] * 15), (904, [float("nan")] * 16), (905, [float("inf")] * 16), (906, [1.0]), (907, [1e-300] * 16), (908, [1e300] * 16)]
    df = spark.createDataFrame([(*row, 1) for row in rows], "vec_id long, embedding array<double>, node int")
    got = vectors.near_vectors(df).collect()
    assert {r["vec_id"]: tuple(r)[1:] for r in got} == brute(rows) and len(got) == len(rows)


def test_recall_of_sorted_passes(spark, monkeypatch):
    """Planted pairs near the threshold among 20,000 vectors, with windows of 64 in place of 2048: 0.9 is asked for, 0.99 measured."""
    monkeypatch.setattr(vectors, "WINDOW", 64)
    monkeypatch.setattr(vectors, "BLOCK", 1024)
    r = np.random.default_rng(5)
    base = r.standard_normal((20_000, 24)).astype(np.float32)
    noise = r.standard_normal((500, 24))
    unit = base[:500] / np.linalg.norm(base[:500], axis=1, keepdims=True)
    noise -= (noise * unit).sum(1, keepdims=True) * unit
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    cos = r.uniform(0.951, 0.97, (500, 1))
    base[500:1000] = (cos * unit + np.sqrt(1 - cos * cos) * noise).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in vectors.near_vectors(df).collect()}
    assert sum(got[500 + i]["component_id"] == i and got[i]["n_links"] >= 1 for i in range(500)) >= 0.99 * 500


def test_ids_that_repeat_or_are_null(spark):
    """Rows of one id are vectors of their own; a component without ids has a null component_id."""
    rows = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (2, [0.0, 2.0]), (None, [1.0, 0.01]), (None, [-1.0, 0.0]), (None, [-1.0, 0.01])]
    got = sorted(vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect(), key=str)
    assert [tuple(r) for r in got] == sorted([(5, 1, 5, True), (5, 1, 2, False), (2, 1, 2, True), (None, 1, 5, False), (None, 1, None, True), (None, 1, None, True)], key=lambda t: str(vectors_row(t)))


def vectors_row(t):
    from pyspark.sql import Row

    return Row(vec_id=t[0], n_links=t[1], component_id=t[2], kept=t[3])


def test_empty(spark):
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
