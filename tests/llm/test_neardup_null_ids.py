from matchlake.llm import neardup


def test_null_ids_link_and_bridge(spark):
    w = [f"w{i}" for i in range(60)]
    near = lambda n: " ".join(w[n:] + [f"x{i}" for i in range(n)])
    v = " ".join(f"v{i}" for i in range(40))
    # near(0) and near(10) are not similar, only bridged by near(5), whose id is null.
    docs = spark.createDataFrame([(1, near(0)), (None, near(5)), (2, near(10)), (None, v), (None, v), (None, v + " end"), (None, None), (None, "")], "doc_id long, text string")
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == 8
    assert sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in got if r["n_shingles"] > 50) == [(0, 1, False), (1, 1, True), (2, 1, False)]
    lone = [r for r in got if 0 < r["n_shingles"] < 50]
    assert len(lone) == 3 and {r["component_id"] for r in lone} == {None} and sum(r["kept"] for r in lone) == 1
    assert all(r["kept"] for r in got if not r["n_shingles"])
