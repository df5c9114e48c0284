from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from matchlake.llm import packing, registry

NAME = "word_bpe_49k.json"


def check(rows, docs, length):
    t = Tokenizer.from_file(public_tokenizers.path(NAME))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
        assert len(r["ids"]) == 4 * r["length"] > 0
    assert set(by_doc) == set(docs)
    for i, pieces in by_doc.items():
        pieces.sort(key=lambda r: r["start"])
        ids = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in pieces]).tolist()
        assert ids == t.encode(docs[i] or "", add_special_tokens=False).ids + [1]
        assert [r["start"] for r in pieces] == np.cumsum([0] + [r["length"] for r in pieces])[:-1].tolist()
        assert {r["doc_tokens"] for r in pieces} == {len(ids)}
    padding = 0
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        ends = np.cumsum([0] + [r["length"] for r in pieces])
        assert [r["offset"] for r in pieces] == ends[:-1].tolist() and ends[-1] <= length
        padding += 0 if ends[-1] & (ends[-1] - 1) == 0 else length - ends[-1]
    assert padding == 0


def test_pack_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack(docs, registry.vocabulary(NAME)).collect()
    check(rows, {r["doc_id"]: r["text"] for r in docs.collect()}, packing.LENGTH)


def test_pack_odd_documents(spark):
    texts = {0: None, 1: "", 2: "word " * 5000, 3: "a b", 4: "a b"}
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in texts.items()], "doc_id long, text string, key int, ids string")
    check(packing.pack(docs, registry.vocabulary(NAME), length=64).collect(), texts, 64)
    assert packing.pack(docs.limit(0), registry.vocabulary(NAME)).collect() == []


def test_hilbert_visits_each_cell_once_and_neighbours_next():
    grid = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    order = np.argsort(packing.hilbert(grid, 3))
    assert sorted(packing.hilbert(grid, 3)) == list(range(512))
    assert (np.abs(np.diff(grid[order], axis=0)).sum(1) == 1).all()
