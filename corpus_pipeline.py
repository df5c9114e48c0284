"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as
the docs of the next. All but the last keep the columns of documents and any others that docs has, whatever their names; n_chars
is brought up to date where docs has it. Null texts, ids and sources are allowed, rows may repeat, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm import mixing, neardup, packing, quality, registry, secrets
from matchlake.llm.scratch import cut, with_workers


def whole(docs: DataFrame) -> Column:
    """All columns as one, so that no name in docs meets one of an operator."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def numbered(docs: DataFrame) -> DataFrame:
    """n, row: each row of docs with a number of its own, written so that the numbers stay."""
    return cut(docs.select(F.monotonically_increasing_id().alias("n"), whole(docs)), "numbered")


def with_text(docs: DataFrame, text: Column) -> Column:
    """The column row with another text."""
    row = F.col("row").withField("text", text)
    return row.withField("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else row


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules of policy v1 accept; whole rows travel through the ledger, so none is joined."""
    book = quality.ledger(docs.select(whole(docs), "text"), "row", rules=mixing.RULES)
    return book.where(quality.passes(quality.POLICIES["v1"])).select("row.*")


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the smallest id's, a row with an id before one without. Texts without words stay."""
    with_workers(spark)
    rows = numbered(docs)
    key = F.struct(F.col("row.doc_id").isNull().alias("no_id"), F.col("row.doc_id").alias("doc_id"), "n").alias("key")
    kept = neardup.near_duplicates(rows.select(key, F.col("row.text").alias("text")), "key").where("kept").select("key.n")
    return rows.join(kept, "n", "left_semi").select("row.*")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by its kind in brackets."""
    with_workers(spark)
    return secrets.redact(docs).select(whole(docs)).select(with_text(docs, F.col("row.text")).alias("row")).select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes; the copy at the end of a source's budget is cut after its last word there."""
    rows = numbered(docs)
    content = F.concat_ws(":", F.coalesce(F.col("row.doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("row.text", F.lit("")).cast("binary")))
    plan = mixing.mix(rows.select("n", F.col("row.source").alias("source"), F.col("row.text").alias("text"), content.alias("content")), id_col="n", draw=F.col("content"))
    d = rows.join(plan.where("n_copies > 0").select("n", "size", "taken", "n_copies"), "n").withColumn("copy", F.explode(F.sequence(F.lit(1), "n_copies")))
    upto = F.col("taken") - (F.col("copy") - 1) * F.col("size")
    pieces = F.split("row.text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")  # each ends with a word
    text = F.when(upto < F.col("size"), F.array_join(F.slice(pieces, F.lit(1), upto.cast("int")), "")).otherwise(F.col("row.text"))
    return d.select(with_text(docs, text).alias("row")).select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences with their token ids."""
    with_workers(spark)
    return packing.pack(docs, registry.vocabulary("word_bpe_49k.json"))


STAGES = [("quality", good), ("near_duplicates", unlike), ("secrets", without_secrets), ("mixing", mixed), ("packing", packed)]

#: Sampling by hashed keys, MinHash and packing are not for SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_workers(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
