"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document with quality weight w gets the exponential key -ln(u) / w, u being a hash of its id and
text in (0, 1). Sorted by key within its source, documents are taken until their running sum of words
meets the source's budget; complete epochs of the source come first. The weight comes from the
quality ledger: the share of words that do not repeat, over one more than the rules failed.

Running sums are split by key range: a first aggregate gives each (source, range) its words, a
second pass adds the sums of the ranges before, so no source's documents meet in one task. Rows with one id and text
are one item with a number of copies, so they don't meet either. The table of sources itself goes through windows of one task:
sources may be millions, but not as many as documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm import quality
from matchlake.llm.scratch import cut

WEIGHTS = (5, 2, 1)
#: A target stops at this many times its source's size.
MOST = 3
#: Documents for each key range, about; ranges per source are between 64 and 4096.
PER_RANGE = 20_000


#: The rules whose failures lower a document's weight.
RULES = {name: quality.RULES[name] for name in quality.POLICIES["v1"]}
LEAST_WEIGHT = 0.05


def quality_weight(n_words: Column, n_repeat_words: Column, failures: Column) -> Column:
    """The default weight, from 0 to 1: of two documents of a source the better one is likelier to be taken in a fraction of an epoch."""
    fresh = F.when(n_words > 0, F.greatest(F.lit(LEAST_WEIGHT), F.lit(1.0) - n_repeat_words / F.greatest(n_words, F.lit(1)))).otherwise(F.lit(LEAST_WEIGHT))
    return fresh / (F.lit(1.0) + F.bit_count(failures))


def unit(name: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of a text's MD5."""
    return (F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: float = MOST) -> DataFrame:
    """source, is_null, source_size, target: the shares of all words, by weight, capped at `most` times a source's size.

    The excess is shared again by weight until no target is above its cap. Sorted by cap over
    weight the capped sources come first, so the level follows from running sums; one row per
    source goes through the one-task windows here.
    """
    by_name = Window.orderBy("is_null", "source")
    n = F.row_number().over(by_name) - 1
    s = sources.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (n % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("w"), "is_null", "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    s = s.withColumn("left_words", F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    s = s.withColumn("left_w", F.sum("w").over(after)).withColumn("r", F.row_number().over(order))
    # The first source whose level is no more than its own cap, and all after it, share by weight.
    s = s.withColumn("free", F.col("w") * F.col("left_words") / F.col("left_w") <= F.col("cap"))
    s = s.withColumn("first", F.min(F.when(F.col("free"), F.struct("r", "left_words", "left_w"))).over(everything))
    shared = F.col("w") * F.col("first")["left_words"] / F.col("first")["left_w"]
    return s.select("source", "is_null", "source_size", F.when(F.col("r") >= F.col("first")["r"], shared).otherwise(F.col("cap")).alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weight: Column | None = None,
    weights: Sequence[int] = WEIGHTS,
    most: float = MOST,
    draw: Column | None = None,
) -> DataFrame:
    """id, source, size, source_size, target, taken, n_copies: one row per input row.

    taken is the number of words that the mix takes of a document, repeats counted: all of it for
    each complete epoch, and once more if its running sum fits what is left of the budget; the one
    document across that limit is cut there. n_copies is the number of copies, the cut one
    included. weight is a column of docs; the default is `quality_weight`. draw is a column of docs, the text
    that gives each document its random number; the default is made of id and text. Null texts
    have size 0 and null sources form one source, last in order. Rows that repeat an id are
    separate documents; those that repeat its text too are taken one after the other. Other columns are ignored. An empty table gives an empty one.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    if draw is None:
        draw = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(text.cast("binary")))
    row = [F.col(id_col).alias("id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), F.col(source_col).isNull().alias("is_null"), unit(draw).alias("u"), (F.lit(None) if weight is None else weight).cast("double").alias("weight")]
    d = quality.ledger(docs.select(F.struct(*row).alias("row"), text.alias("text")), "row", rules=RULES)
    own = F.coalesce("row.weight", quality_weight(F.col("n_words"), F.col("n_repeat_words"), F.col("failures")))
    d = d.select("row.id", "row.source", "row.is_null", F.col("n_words").alias("size"), (-F.log("row.u") / F.greatest(own, F.lit(1e-9))).alias("key"))
    d = cut(d.groupBy("id", "source", "is_null", "size", "key").agg(F.count("*").alias("copies")), "mix-sizes")
    sources = d.groupBy("source", "is_null").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    planned = cut(targets(sources, weights, most), "mix-targets")

    n_rows = d.count()
    n_ranges = min(4096, max(64, -(-n_rows // PER_RANGE)))
    edges = d.agg(F.percentile_approx("key", [i / n_ranges for i in range(1, n_ranges)], 20 * n_ranges)).first()[0] or []
    d = d.withColumn("part", range_of(F.col("key"), edges))

    by_part = ["source", "is_null", "part"]
    parts = d.groupBy(*by_part).agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    before = Window.partitionBy("source", "is_null").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*by_part, F.coalesce(F.sum("words").over(before), F.lit(0)).alias("words_before"))
    parts = parts.join(planned, ["source", "is_null"])
    inside = Window.partitionBy(*by_part).orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("upto_here", F.sum(F.col("size") * F.col("copies")).over(inside)).join(parts, by_part)
    d = d.withColumn("after", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))  # the copies behind this one
    d = d.withColumn("upto", F.col("words_before") + F.col("upto_here") - F.col("after") * F.col("size"))
    epochs = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.floor(F.col("target") / F.col("source_size") + 1e-9))).otherwise(0.0).cast("long")
    d = d.withColumn("epochs", epochs)
    rest = F.round(F.greatest(F.col("target") - F.col("epochs") * F.col("source_size"), F.lit(0.0))).cast("long")
    d = d.withColumn("more", F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - (F.col("upto") - F.col("size")))))
    taken = F.col("epochs") * F.col("size") + F.col("more")
    copies = F.when(F.col("size") > 0, F.col("epochs") + F.when(F.col("more") > 0, 1).otherwise(0)).otherwise(F.lit(0)).cast("int")
    source = F.when(~F.col("is_null"), F.col("source"))
    return d.select(F.col("id").alias(id_col), source.alias(source_col), "size", "source_size", "target", taken.alias("taken"), copies.alias("n_copies"))


def range_of(key: Column, edges: Sequence[float]) -> Column:
    """How many of the sorted edges are below key, found by two levels of about sqrt(n) comparisons."""
    width = int(len(edges) ** 0.5) + 1
    doubles = lambda xs: F.array(*[F.lit(float(e)) for e in xs]).cast("array<double>")
    blocks = F.array(*[doubles(edges[i : i + width]) for i in range(0, len(edges), width)]) if edges else F.array(doubles([]))
    block = F.array_size(F.filter(doubles(edges[width - 1 :: width]), lambda e: e < key))
    return block * width + F.array_size(F.filter(F.coalesce(F.get(blocks, block), doubles([])), lambda e: e < key))
