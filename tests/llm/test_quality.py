import re

from pyspark.sql import functions as F

from matchlake.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", " \n\t", "one", "a b c d e f g h", "a b c d e f g h " * 3, "x " * 40, "l1 a\nl1 a\n\n \nl2\nl1 a", "# $ % & | < > * " * 5, "é😀 ß " * 10, ("w%d " * 1) * 3, " ".join(map(str, range(9000))) + " " + " ".join(map(str, range(50)))]


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i : i + 8]), []).append(i)
    repeated = {i + k for p in at.values() if len(p) > 1 for i in p for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(repeated)


def test_measures_equal_brute_force(spark):
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], 1, 2)], "doc_id long, text string, n_words int, failures int")
    got = quality.measure(docs).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        assert tuple(r)[1:] == brute(TEXTS[r["doc_id"]]), r["doc_id"]
    assert quality.ledger(docs.limit(0)).collect() == []


def test_extra_measures(spark):
    docs = spark.createDataFrame([(1, "- a1\n* b22\n\u2022 c\nthe end...\nof \u2026 \n"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: [r[c] for c in quality.EXTRA] for r in quality.measure(docs, extra=quality.EXTRA).collect()}
    assert got == {1: [3, 3, 2, 2], 2: [0, 0, 0, 0]}


def test_policies_and_ablations(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    book = quality.ledger(docs)
    rows = book.collect()
    for rule, fails in quality.RULES.items():
        assert {r["doc_id"] for r in rows if r["failures"] & quality.bit(rule)} == {r["doc_id"] for r in book.where(fails).collect()}
    policy = quality.POLICIES["v1"]
    kept = {r["doc_id"] for r in book.where(quality.passes(policy)).collect()}
    for r in quality.ablations(book, policy).collect():
        rest = [p for p in policy if p != r["rule"]]
        assert r["n_kept"] == len(kept)
        assert r["n_kept_without"] == book.where(quality.passes(rest)).count()
        assert r["n_failed"] == book.where(F.expr(quality.RULES[r["rule"]])).count()


def test_repeated_words_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(tuple(r)[1:] == brute(texts[r["doc_id"]]) for r in quality.measure(docs).collect())
