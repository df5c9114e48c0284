"""Near-duplicate documents by circulant MinHash.

Words are lower-cased (A-Z) runs of non-space; a document's set is its distinct five-word
shingles. Two fixed permutations of 32-bit numbers, one shifted circularly by k, give coordinate k
of the signature. Equal bands of coordinates make two documents candidates, and every link is
confirmed on the full sets.

Documents with equal sets are one class, told apart by 128 bits of a digest and numbered; only classes are banded. Within a bucket the classes are
first compared with the most central one; then only pairs that are still in different components
are compared, in large buckets block by block, so a group of near copies costs few comparisons and
rows for each of its members, and no link between components is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm.components import components
from matchlake.llm.scratch import cut
from matchlake.llm.secrets import part_bytes

SHINGLE = 5
#: A pair with similarity 0.75 shares a band with probability 1 - (1 - 0.75 ** ROWS) ** BANDS = 0.9997.
BANDS, ROWS = 30, 5
PERCENT = 75
#: Larger buckets are compared in blocks of BLOCK classes.
SMALL, BLOCK = 64, 256
_CHUNK = 1024


def shingles(text: bytes) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles; the whole sequence if it has fewer words; empty without words."""
    words = text.lower().split()  # on bytes: A-Z, and exactly the six ASCII spaces
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(SHINGLE, len(h))
    mixed = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[i : len(h) - n + 1 + i]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return np.unique(mixed ^ (mixed >> np.uint64(31)))


def signature(hashes: np.ndarray, n: int = BANDS * ROWS) -> np.ndarray:
    """Coordinate k is the least of pi((sigma(x) + k) mod 2**32) over the set; sigma and pi are mixing permutations."""
    sigma = (hashes >> np.uint64(32)).astype(np.uint32) * np.uint32(0x9E3779B1)
    shifts = np.arange(n, dtype=np.uint32)
    least = np.full(n, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(sigma), _CHUNK):
        x = sigma[i : i + _CHUNK, None] + shifts
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(13)
        x *= np.uint32(0xC2B2AE35)
        x ^= x >> np.uint32(16)
        np.minimum(least, x.min(axis=0), out=least)
    return least


def bands(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each band of each row of signatures."""
    rows = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for i in range(ROWS):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9) + rows[:, :, i]
    return (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)


def digest_of(hashes: np.ndarray) -> bytes:
    """16 bytes for a set: equal sets have equal ones."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def halves(digests: list[bytes | None]) -> tuple[pa.Array, pa.Array]:
    """Two columns of 64 bits for a list of digests; null for None."""
    n = np.frombuffer(b"".join(d or bytes(16) for d in digests), np.int64).reshape(-1, 2)
    none = np.array([d is None for d in digests], bool)
    return pa.array(n[:, 0], mask=none), pa.array(n[:, 1], mask=none)


def whole_texts(texts: pa.Array) -> Iterator[bytes]:
    data, offsets = part_bytes(texts.fill_null(""))
    buffer = data.tobytes()
    return (buffer[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))


def sketches(docs: DataFrame) -> DataFrame:
    """id, k, n (size of the set), d1, d2 (its digest), bands for (id, text, k); without words n is 0 and the digest null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, digests, signs = [], [], []
            for text in whole_texts(b.column(1)):
                s = shingles(text)
                n.append(len(s))
                digests.append(digest_of(s) if len(s) else None)
                signs.append(signature(s))
            hashes = bands(np.array(signs, np.uint32).reshape(-1, BANDS * ROWS)).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(b) + 1, dtype=np.int32) * BANDS), pa.array(hashes.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64()), *halves(digests), lists], ["id", "k", "n", "d1", "d2", "bands"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, k bigint, n bigint, d1 bigint, d2 bigint, bands array<bigint>")


def sets(docs: DataFrame) -> DataFrame:
    """d1, d2, hashes for (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingles(t) for t in whole_texts(b.column(0))]
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            flat = np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([*halves(list(map(digest_of, found))), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["d1", "d2", "hashes"])

    return docs.mapInArrow(run, "d1 bigint, d2 bigint, hashes array<bigint>")


def similar(n_a: Column, n_b: Column, both: Column) -> Column:
    return both * 100 >= (n_a + n_b - both) * PERCENT


def confirm(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar."""
    side = lambda s: full.select(F.col("cls").alias(s), F.col("hashes").alias(f"h{s}"))
    checked = pairs.join(side("a"), "a").join(side("b"), "b")
    return checked.where(similar(F.size("ha"), F.size("hb"), F.size(F.array_intersect("ha", "hb")))).select("a", "b").distinct()


def near_in_size(n: str, m: str) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT


def compare_blocks(t: pa.Table) -> pa.Table:
    """The links within two blocks of a large bucket, as a spanning set.

    A pair is compared in the first band that it shares, if it is in different components so far.
    """
    cls, component, n, mine = (t[c].to_numpy() for c in ("cls", "component", "n", "mine"))
    codes = np.array(t["bands"].to_pylist(), np.int64).reshape(len(t), BANDS)
    band = int(np.flatnonzero(codes[0] == t["h"][0].as_py())[0])
    open_ = component[:, None] != component[None, :]
    open_ &= np.minimum(n[:, None], n[None, :]) * 100 >= np.maximum(n[:, None], n[None, :]) * PERCENT
    if t["i"][0].as_py() != t["j"][0].as_py():
        open_ &= mine[:, None] != mine[None, :]
    for q in range(band):
        open_ &= codes[:, q, None] != codes[None, :, q]
    sets_ = [frozenset(s) for s in t["hashes"].to_pylist()]
    up = {c: c for c in component.tolist()}

    def root(c: int) -> int:
        while up[c] != c:
            up[c] = c = up[up[c]]
        return c

    found = []
    for x, y in zip(*(k.tolist() for k in np.nonzero(np.triu(open_, 1))), strict=True):
        a, b = root(component[x].item()), root(component[y].item())
        if a != b:
            both = len(sets_[x] & sets_[y])
            if 100 * both >= PERCENT * (len(sets_[x]) + len(sets_[y]) - both):
                up[a] = b
                found.append((cls[x], cls[y]))
    return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})


def links(buckets: DataFrame, full: DataFrame) -> DataFrame:
    """Confirmed links (a, b) among classes that share a bucket, enough of them to connect all that are linked.

    buckets: h, cls, n, m (classes in the bucket, two at least); full: cls, hashes, bands.
    """
    # 1. Each bucket's pivot, the member whose buckets are largest together, meets the others.
    central = buckets.groupBy("cls").agg(F.sum("m").alias("met"))
    ranked = buckets.join(central, "cls")
    pivot = F.max(F.struct("met", F.col("cls").alias("p"), F.col("n").alias("pn"))).alias("p")
    # Tables of one row per bucket are written first here and below: joined to large buckets they are skewed joins that Spark can split.
    pivots = cut(ranked.groupBy("h").agg(pivot), "pivots")
    pairs = ranked.join(pivots, "h").where(F.col("cls") != F.col("p.p")).where(near_in_size("n", "p.pn"))
    pairs = cut(pairs.select(F.least("cls", "p.p").alias("a"), F.greatest("cls", "p.p").alias("b")).distinct(), "pairs")
    found = cut(confirm(pairs, full), "confirmed")
    # 2. Buckets of three or more that still hold several components go on; a smaller one has been compared.
    at = components(found).select(F.col("id").alias("cls"), F.col("component").alias("to"))
    state = buckets.where("m > 2").join(at, "cls", "left").withColumn("component", F.coalesce("to", "cls")).drop("to")
    open_ = cut(state.groupBy("h").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("h"), "open")
    state = cut(state.join(open_, "h", "left_semi"), "open-buckets")
    # 3. In small ones pairs in different components are listed, SMALL for each member at most.
    small = state.where(F.col("m") <= SMALL)
    other = small.select("h", F.col("cls").alias("b"), F.col("n").alias("pn"), F.col("component").alias("pc"))
    rest = small.withColumnRenamed("cls", "a").join(other, "h").where("a < b AND component <> pc").where(near_in_size("n", "pn"))
    rest = rest.select("a", "b").distinct().join(pairs, ["a", "b"], "left_anti")
    # 4. Large ones are cut into blocks, and each two blocks are compared in one task.
    large = state.where(F.col("m") > SMALL).withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
    large = large.withColumn("mine", F.pmod(F.xxhash64("cls", "h"), F.col("blocks")).cast("int")).join(full, "cls")
    large = large.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    large = large.select("h", "cls", "n", "component", "bands", "hashes", "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    blocks = large.groupBy("h", "i", "j").applyInArrow(compare_blocks, "a bigint, b bigint")
    return found.union(confirm(rest, full)).union(blocks)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id (smallest id reachable by links, itself included), kept: one row per input row.

    A null text, or one without words, has an empty set, is linked with nothing and is its own
    component. Rows that repeat an id share what the first of them in a component gives. A component
    whose ids are all null has a null component_id, and one of its rows is kept. Other columns are
    ignored. An empty table gives an empty one.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("k", F.xxhash64("id", "text"))  # k is never null
    all_ = cut(sketches(d).withColumn("row", F.monotonically_increasing_id()), "sketches")
    classes = all_.where("n > 0").groupBy("d1", "d2").agg(F.min("id").alias("rep"), F.min("k").alias("k"), F.min("row").alias("row"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = cut(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    rows = classes.select(F.explode("bands").alias("h"), "cls", "n")
    shared = cut(rows.groupBy("h").agg(F.count("*").alias("m")).where("m > 1"), "shared")
    buckets = cut(rows.join(shared, "h"), "buckets")
    met = buckets.select("cls").distinct()
    wanted = met.join(classes.select("cls", "k"), "cls").select("k").distinct()
    full = sets(d.join(wanted, "k", "left_semi").select("text")).dropDuplicates(["d1", "d2"]).join(classes.join(met, "cls", "left_semi").select("d1", "d2", "cls", "bands"), ["d1", "d2"])
    full = cut(full.select("cls", "hashes", "bands"), "shingle-sets")
    at = components(links(buckets, full)).select(F.col("id").alias("cls"), "component")
    placed = classes.select("d1", "d2", "cls", "rep", "row").join(at, "cls", "left").select("d1", "d2", "rep", "row", F.coalesce("component", "cls").alias("component"))
    least = placed.groupBy("component").agg(F.min("rep").alias("component_id"), F.min("row").alias("first"))
    named = placed.join(least, "component").select("d1", "d2", "component_id", "first")
    component = F.coalesce("component_id", "id")
    kept = F.when(component.isNull() & F.col("first").isNotNull(), F.col("row") == F.col("first")).otherwise(component.eqNullSafe(F.col("id")))
    return all_.join(named, ["d1", "d2"], "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"))
