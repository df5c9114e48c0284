import re
from collections import Counter

import corpus_pipeline
from test_neardup import brute as near_brute
from test_packing import check as packing_check
from test_quality import brute as quality_brute
from test_secrets import brute as secrets_brute

from matchlake.llm import packing

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails(text):
    """Whether a text fails policy v1, by brute force."""
    n, chars, symbols, lines, dup, repeat = quality_brute(text)
    return n < 20 or 100 * repeat > 30 * n or 10 * symbols > 3 * n or (lines >= 4 and 10 * dup > 6 * lines) or chars < 2 * n or chars > 20 * n


def test_stages_one_by_one(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.dtypes
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [r.asDict() for r in docs.collect()]
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
        after = [r.asDict() for r in docs.collect()]
        if name != "packing":
            assert docs.dtypes == columns
        ids = Counter(r["doc_id"] for r in after)
        if name == "quality":
            assert set(ids) == {r["doc_id"] for r in before if not fails(r["text"])}
        if name == "near_duplicates":
            assert set(ids) == {c for _, _, c in near_brute([(r["doc_id"], r["text"]) for r in before])}
        if name == "secrets":
            assert len(after) == len(before) and not any(secrets_brute(r["text"]) for r in after)
        if name == "mixing":
            whole = {r["doc_id"]: r["text"] for r in before}
            assert all(whole[r["doc_id"]].startswith(r["text"]) and r["n_chars"] == len(r["text"]) for r in after)
            assert max(ids.values()) <= 3
            words = lambda rows: sum(len(WORD.findall(r["text"])) for r in rows)
            assert abs(words(after) - words(before)) <= 20  # a rounding for each source
        if name == "packing" and max(Counter(r["doc_id"] for r in before).values()) == 1:
            packing_check(after, {r["doc_id"]: r["text"] for r in before}, packing.LENGTH)


def test_run_keeps_every_token(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and all(len(r["ids"]) == 4 * r["length"] for r in rows)


def test_clashing_columns_null_ids_and_repeated_rows(spark):
    """Stages keep columns named like those of operators, one row of exact copies, and need no n_chars."""
    schema = "doc_id long, text string, source string, row string, taken int, words int, n long, copy int, key string, kept boolean"
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(k, text(k), "s" if k % 2 else None, f"r{k}", k, 1, 2, 3, "k", True) for k in range(12)]
    rows += [rows[3]] * 3 + [(None, *rows[4][1:]), (None, text(99), "s", "r", 1, 1, 1, 1, "k", None), (None, text(99), "s", "r", 1, 1, 1, 1, "k", None)]
    for make in (rows, []):
        docs = spark.createDataFrame(make, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.dtypes == spark.createDataFrame([], schema).dtypes
            got = [r.asDict() for r in docs.collect()]
            if make and name == "quality":
                assert len(got) == len(rows)
            if make and name == "near_duplicates":
                assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == [(False, k) for k in range(12)] + [(True, 0)]
            assert {r["row"] for r in got} <= {r[3] for r in rows}
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= (1 if make else 0)
