"""Embedding near-duplicates by sorted projection passes.

In each pass every vector gets the concatenation of many random hashes (signs of random projections), and the
vectors are sorted by it: the more leading hashes two vectors share, the nearer they lie. Each vector is
compared in double precision with the WINDOW that follow it, and the links of all passes are united.

The order holds only (pass, hashes, node). A vector's place in it is then joined to the vector itself, and places are dealt to
blocks; a block also gets the WINDOW places after it, so no window ends at the edge of a task.

A vector with more than CROWD links in one window lies in a crowd that windows may not see whole. The components of
such vectors are compared whole, in pairs of bounded blocks, so their links are counted exactly and no run has a cap.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.components import components
from matchlake.llm.scratch import cut

COSINE = 0.95
#: Places that each vector is compared with, per pass.
WINDOW = 2048
#: Places in a block, and rows of a block that are compared at once.
BLOCK, CHUNK = 8192, 512
#: Hashes that are concatenated.
HASHES = 62
#: Chance that a pair just at the threshold is in no pass within a window.
MISS = 1e-3
#: A vector with more links in a window than this has its component compared whole, in blocks of MEMBERS.
CROWD, MEMBERS = 64, 2048
#: Places in a range of the order, about.
RANGE = 1_000_000


def plan(n: int, cosine: float) -> int:
    """Passes for n vectors: so many leading hashes leave about WINDOW vectors, and a pair shares them in one pass or more."""
    leading = max(0, math.ceil(math.log2(max(1, n) / WINDOW)))
    together = (1 - math.acos(cosine) / math.pi) ** leading
    return 1 if together == 1 else math.ceil(math.log(MISS) / math.log(1 - together))


def sort_keys(x: np.ndarray, passes: int, seed: int = 3) -> np.ndarray:
    """The concatenated hashes of each vector (row) in each pass, as a number: the first hash is its highest bit."""
    weights = 1 << np.arange(HASHES - 1, -1, -1, dtype=np.int64)
    out = np.empty((len(x), passes), np.int64)
    for p in range(passes):
        planes = np.random.default_rng([seed, p, x.shape[1]]).standard_normal((x.shape[1], HASHES))
        out[:, p] = (x @ planes > 0) @ weights
    return out


def usable(batch: pa.Array) -> list[np.ndarray | None]:
    """Each vector; None if it is null, empty, zero or has null or non-finite components."""
    out = []
    for v in batch:
        x = None
        if v.is_valid and len(v.values) and not v.values.null_count:
            x = v.values.to_numpy(zero_copy_only=False)
            x = x if x.dtype in (np.float32, np.float64) else x.astype(np.float64)
            if not np.isfinite(x).all() or not x.any():
                x = None
        out.append(x)
    return out


def normed(x: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def roots(linked: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each node of a symmetric Boolean matrix."""
    label = np.arange(len(linked))
    while True:
        now = np.minimum(label, np.where(linked, label, len(linked)).min(axis=1))
        now = now[now]
        if (now == label).all():
            return label
        label = now


def _stack(data: pa.ChunkedArray, kind: str) -> np.ndarray:
    return normed(np.frombuffer(b"".join(data.to_pylist()), kind).reshape(len(data), -1))


def _found(a: np.ndarray, b: np.ndarray, kind: int) -> pa.Table:
    return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64()), "kind": pa.array(np.full(len(a), kind), pa.int32())})


#: Kinds of found rows: a link; two nodes of one component; a crowded node.
LINK, TOGETHER, CROWDED = 0, 1, 2


def near_vectors(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, n_links (other vectors linked directly), component_id, kept: one row per input row.

    Equal vectors are one node that counts as often as it occurs. Vectors that are null, empty, zero or
    have null or non-finite components link with nothing; so do vectors of different lengths. Rows
    that repeat an id are vectors of their own, which only their own links join. Null ids count as no
    id: component_id is null where all ids of a component are, and each of its rows is kept. Other columns are ignored. An empty
    table gives an empty one.
    """
    d = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    kind = "<f4" if d.schema["v"].dataType.simpleString() == "array<float>" else "<f8"

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = [None if x is None else (x + 0.0).astype(kind).tobytes() for x in usable(b.column(1))]  # + 0.0: no negative zeros
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(data, pa.binary())], ["id", "data"])

    id_kind = d.schema["id"].dataType.simpleString()
    rows = cut(d.mapInArrow(prepare, f"id {id_kind}, data binary").withColumn("digest", F.unhex(F.sha2("data", 256))), "vectors")
    nodes = rows.where("data IS NOT NULL").groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("times"), F.first("data").alias("data"))
    nodes = cut(nodes.withColumn("size", F.octet_length("data")).withColumn("node", F.monotonically_increasing_id()), "nodes")
    n = nodes.count()
    passes = plan(n, cosine)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code, sizes = np.zeros((len(b), passes), np.int64), b.column(1).to_numpy()
            for s in np.unique(sizes):
                at = np.flatnonzero(sizes == s)
                code[at] = sort_keys(_stack(b.column(2).take(pa.array(at)), kind), passes)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(b) + 1, dtype=np.int32) * passes), pa.array(code.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], ["node", "size", "keys"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        for b in batches:
            at = np.arange(done, done + len(b))
            done += len(b)
            yield pa.RecordBatch.from_arrays([*b.columns[:2], b.column(3), pa.array(np.full(len(b), part, np.int32)), pa.array(at)], ["pass", "size", "node", "part", "at"])

    coded = cut(nodes.select("node", "size", "data").mapInArrow(keys, "node bigint, size int, keys array<bigint>"), "keys")
    order = ["pass", "size", "key", "node"]
    each = coded.select("size", "node", F.posexplode("keys").alias("pass", "key")).select(*order)
    each = each.repartitionByRange(max(1, -(-n * passes // RANGE)), *order).sortWithinPartitions(*order)
    placed = cut(each.mapInArrow(number, "pass int, size int, node bigint, part int, at bigint"), "order")
    first, before = [], 0
    for r in sorted(placed.groupBy("part").count().collect()):  # a row for each range
        first.append((r["part"], before))
        before += r["count"]
    first = F.broadcast(d.sparkSession.createDataFrame(first, "part int, first bigint"))
    placed = placed.join(first, "part").select("pass", "size", "node", (F.col("first") + F.col("at")).alias("at"))
    # The first WINDOW places of a block are also behind the block before.
    block = F.floor(F.col("at") / BLOCK)
    blocks = F.when((F.col("at") % BLOCK < WINDOW) & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))
    placed = placed.join(nodes.select("node", "data"), "node").select("pass", "size", "node", "at", "data", F.explode(blocks).alias("block"))

    def compare(t: pa.Table) -> pa.Table:
        t = t.sort_by("at")
        node, at, own = t["node"].to_numpy(), t["at"].to_numpy(), t["block"][0].as_py()
        group = t["pass"].to_numpy().astype(np.int64) << 32 | t["size"].to_numpy()
        out = [_found(np.empty(0, np.int64), np.empty(0, np.int64), LINK)]
        for g in np.unique(group):
            low, high = np.searchsorted(group, [g, g + 1])
            x = _stack(t["data"].slice(low, high - low), kind)
            for i in range(0, len(x), CHUNK):
                mine = slice(low + i, min(low + i + CHUNK, high))
                if at[mine][0] // BLOCK != own:
                    break  # the next block compares these with each other
                size = mine.stop - mine.start
                linked = x[i : i + size] @ x[i : i + size + WINDOW].T >= cosine
                ahead = np.arange(linked.shape[1])[None, :] - np.arange(size)[:, None]
                linked &= (ahead > 0) & (ahead <= WINDOW) & (at[mine] // BLOCK == own)[:, None]
                crowded = linked.sum(axis=1) > CROWD
                y, z = np.nonzero(linked & ~crowded[:, None])
                here = node[mine.start : mine.start + linked.shape[1]]
                out.append(_found(here[y], here[z], LINK))
                if crowded.any():
                    full = np.zeros((linked.shape[1],) * 2, bool)
                    full[:size] = linked & crowded[:, None]
                    root = roots(full | full.T)
                    out += [_found(here, here[root], TOGETHER), _found(here[:size][crowded], here[:size][crowded], CROWDED)]
        return pa.concat_tables(out)

    found = cut(placed.groupBy("block").applyInArrow(compare, "a bigint, b bigint, kind int").distinct(), "found")
    at = components(found.where(F.col("kind") != CROWDED).select("a", "b")).select(F.col("id").alias("node"), "component")
    named = nodes.select("node", "digest", "rep", "times").join(at, "node", "left").withColumn("component", F.coalesce("component", "node"))
    crowds = found.where(F.col("kind") == CROWDED).select(F.col("a").alias("node")).join(at, "node").select("component").distinct()
    named = cut(named.join(crowds.withColumn("crowd", F.lit(True)), "component", "left"), "components-of-nodes")

    links = found.where(F.col("kind") == LINK)
    ends = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
    added = ends.join(named.select(F.col("node").alias("other"), "times", "crowd"), "other").where("crowd IS NULL").groupBy("node").agg(F.sum("times").alias("added"))
    members = named.where("crowd").select("component", "node", "times").join(nodes.select("node", "size", "data"), "node")
    sizes = cut(named.where("crowd").groupBy("component").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("blocks")), "crowds")
    members = members.join(sizes, "component").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    members = members.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    members = members.select("component", "node", "times", "data", "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))

    def count(t: pa.Table) -> pa.Table:
        node, times, mine = (t[c].to_numpy() for c in ("node", "times", "mine"))
        i, j = t["i"][0].as_py(), t["j"][0].as_py()
        x = _stack(t["data"], kind)  # a component's vectors have one length
        total = np.zeros(len(node), np.int64)
        for s in range(0, len(x), CHUNK):
            linked = x[s : s + CHUNK] @ x.T >= cosine
            linked[np.arange(len(linked)), s + np.arange(len(linked))] = False
            if i != j:
                linked &= mine[s : s + CHUNK, None] != mine[None, :]
            total[s : s + CHUNK] = linked @ times
        return pa.table({"node": pa.array(node, pa.int64()), "added": pa.array(total, pa.int64())})

    crowded = members.groupBy("component", "i", "j").applyInArrow(count, "node bigint, added bigint").groupBy("node").agg(F.sum("added").alias("added"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    final = named.join(least, "component").join(cut(added.union(crowded), "links-of-nodes"), "node", "left")
    final = final.select("digest", "component_id", (F.coalesce("added", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.lit(True).alias("linked"))
    component = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("id"))
    return rows.select("id", "digest").join(final, "digest", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept")
    )
