"""Packing documents into sequences along a space-filling curve.

A document's token ids are hashed into a vector, which a fixed random matrix projects to a few
dimensions; both steps are one table of weights per id. Documents are range-sorted by the Hilbert
key of their point, so neighbours on the curve are neighbours in a sequence, and each range
is laid end to end and cut at the sequence length. What a range has left over is cut at powers of
two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.scratch import cut
from matchlake.llm.tokens import Pieces, as_bytes, encode_ids, id_type

LENGTH = 2048
DIMENSIONS, BITS = 3, 10
HASHED = 4096
#: Tokens in one range, about.
RANGE_TOKENS = 4_000_000
#: An output batch has at most this many ids, or as many pieces as one document has sequences at the least.
BATCH_IDS = 4_000_000


def weights(n_ids: int, dimensions: int = DIMENSIONS, seed: int = 7) -> np.ndarray:
    """For each id, what it adds to a document's point: its hashed bucket's row of a random matrix, with its hashed sign."""
    random = np.random.default_rng(seed)
    ids = np.arange(n_ids, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (ids ^ (ids >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    sign = 1 - 2 * (mixed >> np.uint64(63)).astype(np.float32)
    return (random.standard_normal((HASHED, dimensions), np.float32)[(mixed >> np.uint64(40)) % np.uint64(HASHED)] * sign[:, None]).astype(np.float32)


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The Hilbert key of each row of integer coordinates below 2**bits (Skilling's transposed form)."""
    x = points.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(set_, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b) & 1
    return key


def tokenize(docs: DataFrame, tokenizer_json: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, key (Hilbert), n_tokens, ids (bytes of little-endian 16- or 32-bit ids, end_id last)."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    kind = id_type(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(shared.value, as_bytes(kind))
        table = weights(pieces.tokenizer.get_vocab_size() + 1)
        end = np.array([end_id], kind).tobytes()
        for b in batches:
            ids = [i + end for i in encode_ids(b.column(1), pieces)]
            each = [np.frombuffer(i, kind) for i in ids]
            points = np.array([np.take(table, e, 0).sum(0) / len(e) for e in each]).reshape(-1, DIMENSIONS)
            cells = ((1 << BITS) / (1 + np.exp(-8 * points.astype(np.float64)))).astype(np.int64)
            key = hilbert(np.clip(cells, 0, (1 << BITS) - 1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(key), pa.array([len(e) for e in each], pa.int64()), pa.array(ids, pa.binary())], ["id", "key", "n_tokens", "ids"])

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, f"id {d.schema['id'].dataType.simpleString()}, key bigint, n_tokens bigint, ids binary")


def pack(docs: DataFrame, tokenizer_json: str, end_id: int = 1, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset: one row per piece.

    Every row of docs is packed, repeated ones too; a null or empty text is end_id alone. Each id is
    in one piece, and a sequence's pieces lie without gaps from offset 0. Sequences are full but
    for the last few of each range, whose lengths are powers of two. An empty table gives no pieces.
    """
    kind = id_type(tokenizer_json)
    tokens = cut(tokenize(docs, tokenizer_json, end_id, id_col, text_col), "token-ids")
    total = tokens.agg(F.sum("n_tokens")).first()[0] or 0
    order = ["key", "id", "n_tokens"]
    ranged = tokens.repartitionByRange(max(1, -(-total // RANGE_TOKENS)), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        made = 0  # sequences so far
        open_: list[tuple] = []  # (id, start, ids, n_tokens) of the sequence that is being filled
        filled = 0
        names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        id_kind = None
        rows: list[tuple] = []

        def lay(pieces: list[tuple]) -> None:
            nonlocal made
            offset = 0
            for i, start, ids, n in pieces:
                rows.append((i, start, len(ids), ids.astype("<u4").tobytes(), n, first + made, offset))
                offset += len(ids)
            made += 1

        def out() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
            kinds = [id_kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)
            rows.clear()
            return batch

        for b in batches:
            id_kind = b.column(0).type
            for i, n, data in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3), strict=True):
                ids, start = np.frombuffer(data.as_buffer(), kind), 0
                while start < n:
                    take = min(length - filled, n - start)
                    open_.append((i, start, ids[start : start + take], n))
                    start, filled = start + take, filled + take
                    if filled == length:
                        lay(open_)
                        open_, filled = [], 0
                    if len(rows) * length > BATCH_IDS:
                        yield out()
            open_ = [(i, s, x.copy(), n) for i, s, x, n in open_]  # not to hold on to the batch
        while open_:  # the rest, cut at powers of two
            size, now, got = 1 << (filled.bit_length() - 1), [], 0
            while got < size:
                i, s, x, n = open_.pop(0)
                use = min(size - got, len(x))
                now.append((i, s, x[:use], n))
                got += use
                if use < len(x):
                    open_.insert(0, (i, s + use, x[use:], n))
            lay(now)
            filled -= size
        if id_kind is not None:
            yield out()

    kind_of_id = tokens.schema["id"].dataType.simpleString()
    packed = ranged.mapInArrow(run, f"id {kind_of_id}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")
    return packed.withColumnRenamed("id", id_col)
