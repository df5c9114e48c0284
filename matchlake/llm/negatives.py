"""Hard negatives from lists of candidates that the anchors of a cluster share.

Anchors are clustered by direction. For each cluster every row of the table gets an upper bound on the cosine with any
member, by the angles between row, centroid and the outermost member, times its length; the rows are sorted by it
once. All members walk this list from the top. A member's walk ends, certified, when the bound of the next row times its
own length is below the last score that it holds of all it wants: no row further down can enter. Walks go in strides of
blocks that grow by GROWTH; only the members that are not certified, and the rows of the stride, meet again.

Lists hold numbers of rows and bounds. The vectors come in where a walk reaches them, packed by blocks of BLOCK rows and
of MEMBERS anchors, and each pair of blocks is one product of matrices. Scores are exact integers.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchlake.llm.scratch import cut

#: Clusters of anchors (of each length of vectors) and anchors that their centroids are fitted on, at most.
CLUSTERS, SAMPLE = 8, 4096
#: Rows and anchors of a block; blocks of the first stride, and how much longer the next is.
BLOCK, MEMBERS, FIRST, GROWTH = 2048, 1024, 2, 4
#: Tasks that the blocks of one cluster are dealt to.
SLOTS = 64
#: Rows of a range of the lists, about.
RANGE = 1_000_000
#: Components times SCALE are rounded down.
SCALE = 256.0
LOWEST, HIGHEST = -(2**63), 2**63 - 1


def scaled(v: pa.Scalar) -> np.ndarray | None:
    """The integer vector; None if it is null, empty, has null or non-finite components, or is so long that scores could pass 64 bits."""
    if not v.is_valid or not len(v.values) or v.values.null_count:
        return None
    x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
    if not np.isfinite(x).all() or np.abs(x).max() >= 2**31 / SCALE:
        return None
    q = np.floor(SCALE * x)
    return q.astype("<i4") if (q * q).sum() < 2.0**62 else None


def stacked(data: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(data), "<i4").reshape(len(data), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows."""
    most = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * a.shape[1]
    if most < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def centroids(x: np.ndarray, k: int = CLUSTERS, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """Directions of k clusters of rows, by cosine."""
    length = np.sqrt((x * x).sum(axis=1))
    x = x[length > 0] / length[length > 0, None]
    if not len(x):
        return np.zeros((0, x.shape[1]))
    c = x[np.random.default_rng(seed).choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        at = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        c = np.where(size > 0, sums / np.where(size > 0, size, 1), c)
    return c


def angles(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row with each centroid (0 for a row of length 0), and the rows' lengths."""
    x = x.astype(np.float64)
    length = np.sqrt((x * x).sum(axis=1))
    return np.where(length[:, None] > 0, np.arccos(np.clip(x @ c.T / np.where(length > 0, length, 1)[:, None], -1, 1)), 0), length


def best(score: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Of each row the allowed entries that may be among the k highest; those equal to the last one too."""
    if score.shape[1] > k:
        kept = np.where(allowed, score, LOWEST)
        allowed = allowed & (score >= np.partition(kept, -k, axis=1)[:, -k, None])
    return allowed


def walk(rows: DataFrame, lists: DataFrame, members: DataFrame, wanted: DataFrame, k: int, same_label: bool) -> DataFrame:
    """node, slot, score, id, tie, row: for each wanted (node, slot, low, high) the k first rows that the member `node` meets
    with a score within [low, high] and the same, or another, label. Rows of equal score go by id, then tie."""
    spark = rows.sparkSession
    order = Window.partitionBy("node", "slot").orderBy(F.desc("score"), "id", "tie")
    found_schema = "node bigint, slot int, score bigint, id bigint, tie bigint, row bigint"
    held = cut(spark.createDataFrame([], found_schema), "held")
    low_block, stride = 0, FIRST
    active = cut(members.join(wanted.where("low <= high"), "node"), "active")

    def pack_rows(t: pa.Table) -> pa.Table:
        lists = {c: pa.array([t[c].to_pylist()]) for c in ("node", "label", "id", "tie")}
        return pa.table({"dim": t["dim"][:1], "cluster": t["cluster"][:1], "block": t["block"][:1], **lists, "data": pa.array([b"".join(t["data"].to_pylist())], pa.binary())})

    def pack_members(t: pa.Table) -> pa.Table:
        t = t.sort_by([("node", "ascending"), ("slot", "ascending")])
        node, first = np.unique(t["node"].to_numpy(), return_index=True)
        data = t["data"].take(pa.array(first)).to_pylist()
        columns = {c: pa.array([t[c].to_pylist()]) for c in ("slot", "low", "high")}
        return pa.table({"dim": t["dim"][:1], "cluster": t["cluster"][:1], "part": t["part"][:1], "m_node": pa.array([node.tolist()]), "m_label": pa.array([t["label"].take(pa.array(first)).to_pylist()]),
                         "m_first": pa.array([first.tolist()]), **columns, "m_data": pa.array([b"".join(data)], pa.binary())})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                x = {c: batch.column(n)[r] for n, c in enumerate(batch.schema.names)}
                get = lambda c: np.asarray(x[c].values, np.int64)
                m_node, node, label, i, tie = get("m_node"), get("node"), get("label"), get("id"), get("tie")
                m_label, first, slots, low, high = get("m_label"), get("m_first"), get("slot"), get("low"), get("high")
                a = np.frombuffer(x["m_data"].as_py(), "<i4").reshape(len(m_node), -1)
                b = np.frombuffer(x["data"].as_py(), "<i4").reshape(len(node), -1)
                score = products(a, b)
                right = (m_label[:, None] == label) == same_label
                right &= m_node[:, None] != node
                many = np.diff(np.append(first, len(slots)))
                for s in range(many.max(initial=0)):
                    having = np.flatnonzero(many > s)
                    at = first[having] + s
                    mine = score[having]
                    y, z = np.nonzero(best(mine, right[having] & (mine >= low[at, None]) & (mine <= high[at, None]), k))
                    if not len(y):
                        continue
                    sorted_ = np.lexsort((tie[z], i[z], -mine[y, z], y))
                    y, z = y[sorted_], z[sorted_]
                    start = np.flatnonzero(np.diff(y, prepend=-1))
                    rank = np.arange(len(y)) - np.repeat(start, np.diff(np.append(start, len(y))))
                    y, z = y[rank < k], z[rank < k]
                    columns = [m_node[having][y], slots[at][y].astype(np.int32), mine[y, z], i[z], tie[z], node[z]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "slot", "score", "id", "tie", "row"])

    while True:
        clusters = active.groupBy("dim", "cluster").agg(F.countDistinct("node").alias("members"))
        here = clusters.collect()  # CLUSTERS rows for each length of vectors
        if not here:
            return held
        sizes = F.broadcast(spark.createDataFrame([(r["dim"], r["cluster"], -(-r["members"] // MEMBERS)) for r in here], "dim int, cluster int, parts int"))
        high_block = low_block + stride
        blocks = lists.where((F.col("block") >= low_block) & (F.col("block") < high_block)).join(sizes, ["dim", "cluster"]).join(rows.select("node", "label", "id", "tie", "data"), "node")
        blocks = blocks.groupBy("dim", "cluster", "block").applyInArrow(pack_rows, "dim int, cluster int, block bigint, node array<bigint>, label array<bigint>, id array<bigint>, tie array<bigint>, data binary")
        packs = active.join(sizes, ["dim", "cluster"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        packs = packs.select("dim", "cluster", "part", "node", "label", "data", "slot", "low", "high").groupBy("dim", "cluster", "part").applyInArrow(
            pack_members, "dim int, cluster int, part int, m_node array<bigint>, m_label array<bigint>, m_first array<bigint>, slot array<bigint>, low array<bigint>, high array<bigint>, m_data binary"
        )
        n_slots = min(SLOTS, stride)
        packs = packs.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(n_slots - 1)))).drop("part")
        pairs = cut(blocks, "blocks").withColumn("deal", (F.col("block") % n_slots).cast("int")).join(cut(packs, "packs"), ["dim", "cluster", "deal"])
        found = _in_small_batches(pairs.drop("deal", "block"), meet, found_schema)
        held = cut(held.union(found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank"), "held")
        # What lies below the next block's bound times a member's length cannot enter any more.
        ahead = lists.where(F.col("block") == high_block).groupBy("dim", "cluster").agg(F.max("bound").alias("bound"))
        full = held.groupBy("node", "slot").agg(F.count("*").alias("n"), F.min("score").alias("last")).where(F.col("n") >= k)
        active = active.join(ahead, ["dim", "cluster"]).join(full, ["node", "slot"], "left").withColumn("low", F.greatest("low", F.coalesce("last", F.col("low"))))
        reach = F.col("bound") * F.col("length")
        active = cut(active.where(reach + F.abs(reach) * 1e-9 + 1e-3 >= F.col("low")).drop("bound", "n", "last"), "active")
        low_block, stride = high_block, stride * GROWTH


def _in_small_batches(pairs: DataFrame, of: Callable, schema: str) -> DataFrame:
    """Rows of packed blocks, a few in each Arrow batch; written while that holds."""
    conf, key = pairs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key, None)
    conf.set(key, "8")
    try:
        return cut(pairs.mapInArrow(of, schema), "met")
    finally:
        conf.set(key, before) if before is not None else conf.unset(key)


def lists_of(rows: DataFrame, members: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """dim, cluster, node, bound, block: for each cluster of members all rows of their length, by bound."""
    spark = rows.sparkSession
    widest = {(r["dim"], r["cluster"]): r["angle"] for r in members.groupBy("dim", "cluster").agg(F.max("angle").alias("angle")).collect()}
    shared = spark.sparkContext.broadcast((centres, widest))

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, widest = shared.value
        for b in batches:
            dims = b.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                clusters = [c for d, c in widest if d == dim]
                at = np.flatnonzero(dims == dim)
                for part in np.array_split(at, -(-len(at) // 4096)) if clusters else []:
                    x = stacked(b.column(2).take(pa.array(part)).to_pylist())
                    angle, length = angles(x, centres.get(dim, np.zeros((0, dim))))
                    for c in clusters:
                        apart = angle[:, c] if c < angle.shape[1] else np.zeros(len(x))
                        bound = length * np.cos(np.maximum(0, apart - widest[dim, c] - 1e-7))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), dim, np.int32)), pa.array(np.full(len(x), c, np.int32)), b.column(0).take(pa.array(part)), pa.array(bound)], ["dim", "cluster", "node", "bound"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(b), part, np.int32)), pa.array(np.arange(done, done + len(b)))], [*b.schema.names, "part", "at"])
            done += len(b)

    each = cut(rows.select("node", "dim", "data").mapInArrow(bounds, "dim int, cluster int, node bigint, bound double"), "bounds")
    by = ["dim", "cluster", F.desc("bound"), "node"]
    ordered = each.repartitionByRange(max(1, -(-each.count() // RANGE)), *by).sortWithinPartitions(*by)
    ordered = cut(ordered.mapInArrow(number, "dim int, cluster int, node bigint, bound double, part int, at bigint"), "lists")
    shift, start, before = [], {}, 0
    counts = ordered.groupBy("part", "dim", "cluster").count().collect()  # a row for each range and cluster
    in_part = 0
    for n, r in enumerate(sorted(counts)):
        if n and r["part"] != last:
            in_part = 0
        last = r["part"]
        start.setdefault((r["dim"], r["cluster"]), before)
        shift.append((r["part"], r["dim"], r["cluster"], before - in_part - start[r["dim"], r["cluster"]]))
        before += r["count"]
        in_part += r["count"]
    shift = F.broadcast(spark.createDataFrame(shift, "part int, dim int, cluster int, shift bigint"))
    return ordered.join(shift, ["part", "dim", "cluster"]).select("dim", "cluster", "node", "bound", F.floor((F.col("at") + F.col("shift")) / BLOCK).alias("block"))


def mine(
    vectors: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor (rows where `is_anchor`, a
    condition on the ids) and each of its first n_positives rows of the same label the first n_negatives rows of other labels
    whose score is `low` to `high` hundredths of the positive's.

    A score is the inner product of components floor(256 x). Higher scores go first, then smaller ids; rows that share an id but not their
    content are rows of their own, in the order of a hash of it. Rows that repeat id, label and vector count once. Rows with a null id, label or
    vector, an empty vector, or null or non-finite components take no part; neither do vectors whose scores could pass 64 bits.
    Vectors of different lengths don't meet. Anchors without positives, and positives without
    negatives, give no rows. Other columns are ignored, whatever their names; an empty table gives an empty one.
    """
    spark = vectors.sparkSession
    d = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    d = d.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"), F.col(vector_col).alias("v"))

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = [scaled(v) for v in b.column(3)]
            at = pa.array([n for n, x in enumerate(q) if x is not None], pa.int64())
            data = pa.array([x.tobytes() for x in q if x is not None], pa.binary())
            dims = pa.array([len(x) for x in q if x is not None], pa.int32())
            lengths = pa.array([math.sqrt((x.astype(np.float64) ** 2).sum()) for x in q if x is not None], pa.float64())
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(at) for k in range(3)), dims, data, lengths], ["id", "label", "anchor", "dim", "data", "length"])

    rows = d.mapInArrow(prepare, "id bigint, label bigint, anchor boolean, dim int, data binary, length double").withColumn("tie", F.xxhash64("label", "data")).dropDuplicates(["id", "tie", "label", "data"])
    rows = cut(rows.withColumn("node", F.monotonically_increasing_id()), "rows")
    anchors = rows.where("anchor")
    sample = anchors.orderBy(F.xxhash64("id"), "tie").limit(SAMPLE).select("dim", "data").collect()
    centres = {dim: centroids(stacked([r["data"] for r in sample if r["dim"] == dim]).astype(np.float64)) for dim in {r["dim"] for r in sample}}
    shared = spark.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cluster, angle = np.zeros(len(b), np.int32), np.full(len(b), math.pi)
            dims = b.column(2).to_numpy()
            for dim in np.unique(dims).tolist():
                at, c = np.flatnonzero(dims == dim), shared.value.get(dim)
                if c is not None and len(c):
                    a, _ = angles(stacked(b.column(3).take(pa.array(at)).to_pylist()), c)
                    cluster[at], angle[at] = a.argmin(axis=1), a.min(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cluster), pa.array(angle)], [*b.schema.names, "cluster", "angle"])

    members = anchors.select("node", "label", "dim", "data", "length", "id").mapInArrow(assign, "node bigint, label bigint, dim int, data binary, length double, id bigint, cluster int, angle double")
    members = cut(members, "members")
    lists = cut(lists_of(rows, members, centres), "places")
    names = members.select("node", F.col("id").alias("anchor_id"))
    members = members.select("node", "label", "dim", "data", "length", "cluster")
    every = members.select("node", F.lit(0).alias("slot"), F.lit(LOWEST + 1).alias("low"), F.lit(HIGHEST).alias("high"))
    positives = walk(rows, lists, members, every, n_positives, same_label=True)
    slot = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "id", "tie")).cast("int")
    positives = positives.select("node", slot.alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    # low p <= 100 n <= high p, for whole n
    p = F.col("positive_score").cast("decimal(25,0)")
    bands = positives.select("node", "slot", F.ceil(p * low / 100).cast("long").alias("low"), F.floor(p * high / 100).cast("long").alias("high"))
    negatives = walk(rows, lists, members, bands, n_negatives, same_label=False)
    rank = F.row_number().over(Window.partitionBy("node", "slot").orderBy(F.desc("score"), "id", "tie"))
    out = negatives.select("node", "slot", rank.alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return out.join(positives, ["node", "slot"]).join(names, "node").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
