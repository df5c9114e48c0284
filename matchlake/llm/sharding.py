"""Sharding by longest-processing-time scheduling of groups that must stay together.

Groups (equal texts) are sorted by size and go to the least-loaded shard through a heap. So that
the heap sees a bounded number of items whatever the size of the corpus, groups below 1/64 of an even
share of a shard are first bundled by a hash of their digest: at most 64 * n_shards groups are
larger, and there are BUNDLES * n_shards bundles. Rows that repeat an id and its text are one item with a number of
copies until they get their slots, so however many they are, they don't meet in a task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.scratch import cut

BUNDLES = 256
#: Rows that are numbered in one task, about.
CELL = 50_000


def schedule(items: Iterable[tuple[int, str]], n_shards: int) -> dict[str, int]:
    """The shard of each (size, name): largest first, each to the least-loaded shard; ties by name and lowest shard."""
    heap = [(0, s) for s in range(n_shards)]
    placed = {}
    for size, name in sorted(items, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        placed[name] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def assign(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8) -> DataFrame:
    """id, size, text_crc32, digest, shard, slot: one row per input row.

    size is the UTF-8 length of the text plus `overhead`; a null text has length 0 and is in the
    group of empty texts. slot numbers a shard's rows from 0 without gaps, a bundle at a time. Shards without
    rows don't appear. Other columns are ignored. A group larger than an even share fills a shard alone. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + overhead).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text.cast("binary"), 256).alias("digest"))
    d = cut(d.groupBy("id", "size", "text_crc32", "digest").agg(F.count("*").alias("copies")), "shard-sizes")
    all_bytes = F.sum(F.col("size") * F.col("copies"))
    total = d.agg(all_bytes).first()[0] or 0
    groups = d.groupBy("digest").agg(all_bytes.alias("size"))
    large = groups.where(F.col("size") * (64 * n_shards) > total)  # so fewer than 64 * n_shards rows
    bundle_of = F.concat(F.lit("b"), F.pmod(F.conv(F.substring("digest", 1, 12), 16, 10).cast("long"), F.lit(BUNDLES * n_shards)).cast("string"))
    small = groups.where(F.col("size") * (64 * n_shards) <= total).groupBy(bundle_of.alias("name")).agg(F.sum("size").alias("size"))
    big = [(r["size"], r["digest"]) for r in large.collect()]
    placed = schedule(big + [(r["size"], r["name"]) for r in small.collect()], n_shards)
    alone = spark.createDataFrame([(name,) for _, name in big], "big string")
    shards = spark.createDataFrame(list(placed.items()), "name string, shard int")
    d = d.join(F.broadcast(alone), F.col("digest") == F.col("big"), "left")
    d = d.withColumn("name", F.coalesce("big", bundle_of)).drop("big").join(F.broadcast(shards), "name")
    # Slots: rows are numbered within cells, which split a bundle by a hash of id and text, and cells are laid end to end.
    sizes = d.groupBy("name").agg(F.count("*").alias("n_name"))
    d = d.join(F.broadcast(sizes), "name")  # as many rows as `shards`
    d = d.withColumn("cell", F.pmod(F.xxhash64("id", "digest"), F.ceil(F.col("n_name") / CELL)).cast("long")).drop("n_name")
    cells = d.groupBy("shard", "name", "cell").agg(F.sum("copies").alias("n"))
    before = Window.partitionBy("shard").orderBy("name", "cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("name", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_slot"))
    inside = Window.partitionBy("name", "cell").orderBy("digest", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("upto", F.sum("copies").over(inside)).join(cells, ["name", "cell"])
    d = d.withColumn("back", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return d.select(F.col("id").alias(id_col), "size", "text_crc32", "digest", "shard", (F.col("first_slot") + F.col("upto") - F.col("back")).cast("long").alias("slot"))
