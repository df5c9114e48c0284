import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from matchlake.llm import pieces, registry

NAME = "piece_bpe_32k.model"
ODD = ["", " ", "  ", "a  b", " a b ", "\n", "\n\n a\n", "a \n b", "a\x00b", "a\x00 \n  b\x00\n", "▁", "a▁b", "▁▁a", "<s> </s> <unk> <0x0A>", "a\r\n\tb", "日本語のテキスト 日", "é é 😀😀 x", "ﬁ K"]


@pytest.fixture(scope="module")
def both():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(NAME)), pieces.Model(registry.model_file(NAME))


def same(both, text):
    library, model = both
    ids = np.frombuffer(model.encode(text), "<i4").tolist()
    assert ids == library.encode(text)
    assert model.decode(ids) == library.decode(ids)


def test_odd_texts(both):
    for t in ODD:
        same(both, t)


def test_runs_of_spaces(both):
    """All tokens of spaces have one score, so the leftmost merges go first."""
    for n in range(1, 120):
        for t in (" " * n, " " * n + "the", "a" + " " * n + "日", " " * n + "\n" + " " * n):
            same(both, t)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("abethoinsr ▁\n\t\x00é日😀<0x>A."), max_size=60))
def test_random_texts(both, text):
    same(both, text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 31_999), max_size=12))
def test_ids_that_no_text_gives(both, ids):
    library, model = both
    assert model.decode(ids) == library.decode(ids)


def test_long_words_and_texts(both):
    for t in ("a" * 20_000, "日本" * 5_000, "the quick " * 20_000, "é😀" * 3_000, " " * 2_000):
        same(both, t)


def test_words_are_forgotten(both, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT", 8)
    monkeypatch.setattr(pieces, "PAIRS", 8)
    library, model = both
    model.clear()
    for n in range(200):
        same(both, f"word{n} other{n}")
    assert len(model) <= 8 and len(model.may_follow) <= 8
    model.clear()
    same(both, "x" * 100)
    assert not model  # long words are not kept


def test_other_models_are_refused():
    with pytest.raises(Exception):
        pieces.Model(b"no model")


def test_table(spark, both):
    texts = [*ODD, None, "one text", "one text"]
    docs = spark.createDataFrame([(n, t, "x", 0) for n, t in enumerate(texts)] + [(None, "no id", "y", 1)], "doc_id long, text string, ids string, decoded int")
    rows = pieces.round_trip(docs, registry.model_file(NAME)).collect()
    library = both[0]
    want = {n: t or "" for n, t in enumerate(texts)} | {None: "no id"}
    assert len(rows) == len(want)
    for r in rows:
        assert r["ids"] == library.encode(want[r["doc_id"]])
        assert r["decoded"] == library.decode(r["ids"])
    assert pieces.round_trip(docs.limit(0), registry.model_file(NAME)).collect() == []


def test_query(spark, both):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in registry.op12_pieces(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = both[0].encode(d["text"] or "")
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(both[0].decode(ids).encode()).hexdigest()
