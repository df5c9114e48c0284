import zlib
from collections import defaultdict

from matchlake.llm import sharding


def test_groups_stay_together_and_sizes_are_near_equal(spark):
    rows = [(i, f"text {i} " * (i % 40)) for i in range(3000)] + [(3000 + i, "a copy") for i in range(400)] + [(4000, None), (4001, ""), (None, "no id")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, shard int, size int").repartition(5)
    got = sharding.assign(df).collect()
    assert len(got) == len(rows)
    texts, shards, group = dict(rows), defaultdict(list), defaultdict(set)
    for r in got:
        t = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(t) + 8 and r["text_crc32"] == zlib.crc32(t)
        shards[r["shard"]].append(r)
        group[t].add(r["shard"])
    assert all(len(s) == 1 for s in group.values())
    assert all(sorted(r["slot"] for r in s) == list(range(len(s))) for s in shards.values())
    loads = [sum(r["size"] for r in s) for s in shards.values()]
    assert len(loads) == 24 and max(loads) - min(loads) <= 0.02 * sum(loads) / 24


def test_one_large_group_fills_a_shard_alone(spark):
    rows = [(i, "the same text") for i in range(500)] + [(1000 + i, f"another text {i}") for i in range(500)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    home = {r["shard"] for r in got if r["doc_id"] < 500}
    assert len(home) == 1 and all(r["shard"] not in home for r in got if r["doc_id"] >= 1000)


def test_cells_number_without_gaps(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELL", 7)
    got = sharding.assign(spark.createDataFrame([(i, "one text") for i in range(100)] + [(7, "one text")], "doc_id long, text string"), 3).collect()
    assert sorted(r["slot"] for r in got) == list(range(101)) and len({r["shard"] for r in got}) == 1


def test_equals_longest_first_over_all_groups(spark):
    """Groups above 1/64 of an even share go as plain longest-first scheduling sends them, when all are."""
    rows = [(i, chr(97 + i) * (50 + 7 * (i % 13))) for i in range(26)] + [(100 + i, "a" * 50) for i in range(5)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    sizes, digest = defaultdict(int), {}
    for r in got:
        sizes[r["digest"]] += r["size"]
        digest[r["doc_id"]] = r["digest"]
    loads, home = [0] * 4, {}
    for d in sorted(sizes, key=lambda d: (-sizes[d], d)):
        s = loads.index(min(loads))
        home[d], loads[s] = s, loads[s] + sizes[d]
    assert all(r["shard"] == home[r["digest"]] for r in got)


def test_rows_without_ids_and_more_shards_than_groups(spark):
    got = sharding.assign(spark.createDataFrame([(None, "x")] * 300 + [(None, "y")] * 2, "doc_id long, text string"), 24).collect()
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert len(got) == 302 and len(by) == 2 and all(sorted(s) == list(range(len(s))) for s in by.values())


def test_schedule_is_longest_first():
    assert sharding.schedule([(5, "a"), (4, "b"), (3, "c"), (3, "d"), (3, "e")], 2) == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}


def test_empty(spark):
    assert sharding.assign(spark.createDataFrame([], "doc_id long, text string")).collect() == []
