import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from matchlake.llm import registry, tokens

ODD = ["", " ", "a  b", " a b ", "a\n b", "a \nb", "x <|endoftext|> y", "<|endoftext|>a <|startoftext|>b", "it 's don't", "é è ́a", "a  b  c", "Σας ΟΔΟΣ x", "1 22 333", "\x1c a\x85 b", "日本 語"]
NAMES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


def library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


@pytest.fixture(scope="module", params=NAMES)
def both(request):
    json = registry.vocabulary(request.param)
    return library(request.param), tokens.Pieces(json, tokens.as_bytes("<u2"), most=500)


def same(both, texts):
    t, pieces = both
    got = [np.frombuffer(b, "<u2").tolist() for b in tokens.encode_ids(pa.array(texts, pa.string()), pieces)]
    assert got == [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_odd_texts(both):
    same(both, ODD + [None, "long " * 30_000])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'1. \n\t éÉß́ςΣ日<|endoftext>😀"), max_size=30), max_size=8))
def test_random_texts(both, texts):
    same(both, texts)


def test_given_documents(both, spark):
    same(both, [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()])


def test_counts_and_cache(spark, tmp_path):
    texts = ["one two", "one two", None, "", "three <|endoftext|>", "é"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(0, "one two", "y"), (0, "other text", "z"), (None, "no id", "z")], "doc_id long, text string, n_tokens string")
    t, json, cache = library(NAMES[0]), registry.vocabulary(NAMES[0]), str(tmp_path / "cache")
    rows = tokens.counts(docs, json, cache).collect()
    assert len(rows) == 9
    want = {len((x or "").encode()): len(t.encode(x or "").ids) for x in [*texts, "other text", "no id"]}
    assert {(r["n_bytes"], r["n_tokens"]) for r in rows} == set(want.items())
    kept = spark.read.parquet(cache).count()
    assert kept == 6  # distinct texts
    assert tokens.counts(docs, json, cache).count() == 9 and spark.read.parquet(cache).count() == kept
    assert tokens.counts(docs.limit(0), json).collect() == []


def test_each_distinct_text_is_encoded_once(spark, tmp_path):
    """Rows that repeat an id and text, and rows without ids, bring their text once."""
    docs = spark.createDataFrame([(None, "one text")] * 5 + [(1, "another text")] * 3 + [(2, "another text")], "doc_id long, text string").repartition(4)
    cache = str(tmp_path / "cache")
    assert tokens.counts(docs, registry.vocabulary(NAMES[0]), cache).count() == 9
    assert spark.read.parquet(cache).count() == 2
    tokens.counts(docs.limit(1), registry.vocabulary(NAMES[1]), cache).count()
    assert spark.read.parquet(cache).select("version").distinct().count() == 2


def test_rare_words(both, spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    words = sorted({w for t in texts for w in t.split(" ")})
    letters = "".join(map(chr, range(0xA1, 0x250)))
    same(both, words + [letters, *letters, *(a + "n" + a for a in letters)])


def test_long_pieces_leave_with_their_texts(both):
    """Texts without spaces are one piece each; they don't fill the memory of a task."""
    _, pieces = both
    rng = np.random.default_rng(4)
    for _ in range(30):
        same(both, ["".join(map(chr, rng.integers(0x4E00, 0x9000, 700))) for _ in range(20)] + ["a" * 65, "b c"])
    list(tokens.encode_ids(pa.array(["short one"]), pieces))
    assert max(map(len, pieces)) <= tokens.LONG
