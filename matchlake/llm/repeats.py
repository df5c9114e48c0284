"""Passages that repeat across documents, by longest-previous-factor arrays over suffixes in byte order.

A byte goes if a string of LENGTH bytes that covers it also starts in a document with a smaller id. Sorting all
suffixes of a corpus in one place is out of reach, so they are thinned first, without losing a match: in every
window of LENGTH bytes the K bytes with the least hash are an anchor, so equal strings of LENGTH
bytes have an anchor at the same place, and every match shows in the context of an
anchor (SIDE bytes before it, LENGTH from its start on).

1. Anchors meet by hash. One whole context that also occurs in an earlier document is covered; anchors
   that one document alone holds, or one context, need nothing more.
2. For the rest, the first of each context, the suffixes that start in a context are sorted by their bytes, and each
   gets the longest prefix that it shares with the previous and the next suffix of a smaller document in that order. The longer of the two is its
   longest previous factor; from LENGTH on it covers the suffix's first LENGTH bytes.
   The contexts of one anchor meet in one task. An anchor with more than HOT is split by the bytes beside it: of LENGTH bytes
   around an anchor at least SIDE / 2 lie before it or as many behind it, so contexts that share those meet in place
   of all of the anchor's. What is still hot goes on as strings of LENGTH bytes, whose smallest document is an aggregate.
3. Covered ranges go back to their documents, which are cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.scratch import cut, discard
from matchlake.llm.secrets import part_bytes

LENGTH, K = 50, 20
SIDE = LENGTH - K
WINDOW = LENGTH - K + 1
CHUNK = 1 << 20
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: An anchor with more open contexts is hot, and split, so no task holds them together.
HOT = 10_000
HALF = SIDE // 2
#: Documents that a task remembers, to see which rows repeat one.
SEEN = 1_000_000


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    return x ^ (x >> np.uint64(29))


def gram_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of the `length` elements from each position on, along the last axis, by doubling."""
    h, n = mix(data.astype(np.uint64) * _A + _C), 1
    out, done = None, 0
    while True:
        if length & n:
            if out is None:
                out = h
            else:
                m = h.shape[-1] - done
                out = mix(out[..., :m] * _A ^ h[..., done : done + m])
            done += n
        if 2 * n > length:
            return out[..., : data.shape[-1] - length + 1]
        h, n = mix(h[..., : h.shape[-1] - n] * _C ^ h[..., n:]), 2 * n


def sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """best (minimum or maximum) of each `width` neighbours."""
    n = 1
    while 2 * n <= width:
        x, n = best(x[:-n], x[n:]), 2 * n
    return best(x[: len(x) - width + n], x[width - n :]) if n < width else x


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the documents laid end to end in data: each anchor's row, position there, hash and hash of its context."""
    found = []
    for a in range(0, len(data), CHUNK):
        low, high = max(0, a - 2 * LENGTH), min(len(data), a + CHUNK + 3 * LENGTH)
        if high - low < LENGTH:
            continue
        h = gram_hashes(data[low:high], K)
        starts = h[a - low : a - low + CHUNK + WINDOW - 1]
        if len(starts) < WINDOW:
            continue
        least = sliding(starts, WINDOW, np.minimum)
        none = np.zeros(WINDOW - 1, np.uint64)
        at = a + np.flatnonzero(sliding(np.concatenate([none, least, none]), WINDOW, np.maximum) == starts)
        row = np.searchsorted(offsets, at, "right") - 1
        ok = (at + K <= offsets[row + 1]) & (offsets[row + 1] - offsets[row] >= LENGTH)
        at, row = at[ok], row[ok]
        first, last = offsets[row] - low, offsets[row + 1] - K - low
        x = at - low
        context = (np.minimum(x - first, SIDE) * 64 + np.minimum(last - x, SIDE)).astype(np.uint64)
        for shift in (-SIDE, -SIDE + K, SIDE - K, SIDE):
            context = mix(context * _A ^ h[np.clip(x + shift, first, last)])
        found.append((row, at - offsets[row], h[x], context))
    if not found:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    row, at, h, context = (np.concatenate(c) for c in zip(*found, strict=True))
    once = np.unique(offsets[row] + at, return_index=True)[1]  # chunks overlap
    return row[once], at[once], h[once], context[once]


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text, key) -> anchors. Those whose context an earlier document of the batch holds are settled here: pos is negative, h at random."""
    for b in batches:
        data, offsets = part_bytes(b.column(1))
        row, at, h, context = anchors(data, offsets)
        h &= ~np.uint64(0xFFFF)  # 48 bits tell anchors apart well enough (contexts are compared), and take less room
        doc = b.column(0).to_numpy()[row]
        key, pos = b.column(2).to_numpy()[row], at
        order = np.lexsort((doc, context, h))
        h, context, doc, key, pos = h[order], context[order], doc[order], key[order], pos[order]
        new = _changes(h, context)
        least = doc[np.flatnonzero(new)][np.cumsum(new) - 1] if len(h) else doc
        settled = doc > least
        h = np.where(settled, mix(key.view(np.uint64) ^ pos.astype(np.uint64) * _A), h)
        yield _batch(h=h.view(np.int64), context=context.view(np.int64), doc=doc, key=key, pos=np.where(settled, -pos - 1, pos))


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before in any column."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _unlike_last(cols: list[np.ndarray], last: list | None) -> tuple[np.ndarray, list | None]:
    """Where a row of a sorted stream differs from the one before it, which may be the last of the batch before; and the last row."""
    new = _changes(*cols)
    if len(new) and last is not None:
        new[0] = any(c[0] != v for c, v in zip(cols, last, strict=True))
    return new, [c[-1] for c in cols] if len(new) else last


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors sorted by h, context, doc, key, pos -> those with a covered context, and (open) the rows of each context's first document where h has several.

    Of the last h only the rows of its first context are carried while that is its only one, and then one row of its last context.
    """
    carried: list[np.ndarray] | None = None
    emitted = False  # the carried h has several contexts, and the carried row is out
    last = None
    for b in batches:
        cols = [c.to_numpy() for c in b.columns]
        new, last = _unlike_last(cols, last)  # copies of a row count once, however many batches they fill
        done = cols[4] < 0
        settled = [c[done & new] for c in cols]
        cols = [c[~done & new] for c in cols]
        n_carried = 0
        if carried is not None:
            n_carried = len(carried[0])
            cols = [np.concatenate(p) for p in zip(carried, cols, strict=True)]
        h, context, doc, key, pos = cols
        if len(h):
            new_h, new_c = _changes(h), _changes(h, context)
            least = doc[np.flatnonzero(new_c)][np.cumsum(new_c) - 1]
            covered = doc > least
            group = np.cumsum(new_h) - 1
            several = np.bincount(group, new_c) > 1
            several[0] |= emitted
            is_open = several[group] & ~covered
            is_open[:n_carried] &= not emitted
            yield _found(h[is_open], doc[is_open], key[is_open], pos[is_open], True)
            yield _found(np.zeros(covered.sum(), np.int64), doc[covered], key[covered], pos[covered], False)
            emitted = bool(several[-1])  # this h may go on in the next batch
            stay = np.flatnonzero(new_c)[-1:] if emitted else np.flatnonzero((group == group[-1]) & ~covered)
            carried = [c[stay] for c in cols]
        yield _found(np.zeros(len(settled[0]), np.int64), settled[2], settled[3], -settled[4] - 1, False)


def _found(h: np.ndarray, doc: np.ndarray, key: np.ndarray, pos: np.ndarray, is_open: bool) -> pa.RecordBatch:
    return _batch(h=h, doc=doc, key=key, pos=pos, open=np.full(len(h), is_open))


def _contexts(batches: Iterator[pa.RecordBatch], split: bool = False) -> Iterator[pa.RecordBatch]:
    """(doc, text, key, at: list of (pos, h)) -> the bytes of each context, padded, with how many are real on either side.

    Of the rows of a task that repeat a doc and key one goes on. first and last are the starts within the context that are to be compared. With `split` a context
    comes twice: under its anchor and the HALF bytes before it, for the starts that take in these, and the same with those behind it.
    """
    seen: set[tuple[int, int]] = set()
    for b in batches:
        if len(seen) > SEEN:  # repeated rows of a task follow each other, but for broadcast joins
            seen.clear()
        names = list(zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True))
        fresh = [not (name in seen or seen.add(name)) for name in names]
        b = b if all(fresh) else b.filter(pa.array(fresh, pa.bool_()))
        data, offsets = part_bytes(b.column(1))
        doc, key, lists = b.column(0).to_numpy(), b.column(2).to_numpy(), b.column(3)
        row = np.repeat(np.arange(len(b)), lists.value_lengths().to_numpy())
        pos, h = (lists.flatten().field(i).to_numpy() for i in (0, 1))
        at = pos + offsets[row]
        before, after = np.minimum(at - offsets[row], SIDE), np.minimum(offsets[row + 1] - at, LENGTH)
        for i in range(0, max(1, len(at)), 10_000):
            part = slice(i, i + 10_000)
            place = at[part, None] + np.arange(-SIDE, LENGTH)
            inside = (place >= (at - before)[part, None]) & (place < (at + after)[part, None])
            bytes_ = np.where(inside, data[np.clip(place, 0, max(0, len(data) - 1))], 0).astype(np.uint8) if len(data) else np.empty((0, SIDE + LENGTH), np.uint8)
            fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(SIDE + LENGTH), len(bytes_), [None, pa.py_buffer(bytes_.tobytes())]).cast(pa.binary())
            rest = dict(doc=doc[row[part]], key=key[row[part]], pos=pos[part], before=before[part].astype(np.int32), after=after[part].astype(np.int32))
            kinds = [(h[part], 0, SIDE)]
            if split:
                beside = lambda start: gram_hashes(bytes_[:, start : start + HALF], HALF)[:, 0]  # noqa: B023, E731
                mixed = lambda start, n: mix(h[part].view(np.uint64) * _A ^ beside(start) + np.uint64(n)).view(np.int64)  # noqa: B023, E731
                kinds = [(mixed(SIDE - HALF, 1), 0, SIDE - HALF), (mixed(SIDE + K, 2), SIDE - HALF + 1, SIDE)]
            for hash_, first, last in kinds:
                n = len(bytes_)
                yield _batch(h=hash_, **rest, first=np.full(n, first, np.int32), last=np.full(n, last, np.int32), bytes=fixed)


CONTEXT = "h bigint, doc bigint, key bigint, pos bigint, before int, after int, first int, last int, bytes binary"


def _raw(t: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The contexts as rows of bytes, and which starts in each are to be compared: those with LENGTH real bytes."""
    raw = np.frombuffer(b"".join(t["bytes"].to_pylist()), np.uint8).reshape(len(t), SIDE + LENGTH)
    before, after, first, last = (t[c].to_numpy()[:, None] for c in ("before", "after", "first", "last"))
    start = np.arange(WINDOW)
    return raw, (start >= SIDE - before) & (start + LENGTH <= SIDE + after) & (start >= first) & (start <= last)


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts -> a row for each string of LENGTH bytes that is to be compared, placed from the anchor."""
    for b in batches:
        if len(b):
            raw, real = _raw(b)
            for start in np.flatnonzero(real.any(axis=0)):
                who = np.flatnonzero(real[:, start])
                strings = np.ascontiguousarray(raw[who, start : start + LENGTH])
                fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(LENGTH), len(who), [None, pa.py_buffer(strings.tobytes())]).cast(pa.binary())
                yield _batch(suffix=fixed, **{c: b[c].to_numpy()[who] for c in ("doc", "key", "pos")}, start=np.full(len(who), start - SIDE, np.int32))


def _nearest_smaller(doc: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """For each position the prefix that it shares with the nearest position before it of a smaller document; 0 without one.

    shared[i] is the prefix that i - 1 and i share. Each position points to one before which nothing smaller lies in between,
    and jumps on to where that one points until it meets a smaller document; prefixes only shrink on the way.
    """
    to, prefix = np.arange(-1, len(doc) - 1), shared.copy()
    prefix[:1] = 0
    open_ = np.flatnonzero((to >= 0) & (doc[to] >= doc))
    while len(open_):
        via = to[open_]
        prefix[open_] = np.minimum(prefix[open_], prefix[via])
        to[open_] = to[via]
        prefix[open_[to[open_] < 0]] = 0
        open_ = open_[(to[open_] >= 0) & (prefix[open_] > 0) & (doc[to[open_]] >= doc[open_])]
    return prefix


def previous_factors(doc: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """The longest previous factor of suffixes in byte order: the longer of the prefixes shared with the previous and the next suffix of a smaller document."""
    back = np.concatenate([[0], shared[:0:-1]]).astype(shared.dtype)
    return np.maximum(_nearest_smaller(doc, shared), _nearest_smaller(doc[::-1], back)[::-1])


def covered_starts(raw: np.ndarray, real: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which (context, start) have a longest previous factor of LENGTH bytes or more.

    Suffixes from the last start on are sorted first. Those from the start before are then in order by a stable sort of
    the one byte that they have in front.
    """
    words = np.zeros((len(raw), 56), np.uint8)
    words[:, :LENGTH] = raw[:, SIDE:]
    order = np.lexsort(words.view(">u8").astype(np.uint64).T[::-1])
    out = np.zeros_like(real)
    for start in range(SIDE, -1, -1):
        if start < SIDE:
            order = order[np.argsort(raw[order, start], kind="stable")]
        at = order[real[order, start]]
        if len(at) < 2:
            continue
        string = raw[at, start : start + LENGTH]
        unlike = string[1:] != string[:-1]
        shared = np.concatenate([[0], np.where(unlike.any(axis=1), unlike.argmax(axis=1), LENGTH)])
        # Only neighbours with a prefix of LENGTH go on: between others no factor is that long.
        near = shared >= LENGTH
        near[:-1] |= near[1:]
        at, shared = at[near], np.where(shared >= LENGTH, shared, 0)[near]
        out[at[previous_factors(doc[at], shared) >= LENGTH], start] = True
    return out


def _factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by h, doc, key, pos, first -> the covered range of each, from its anchor. Up to HOT contexts of the last h are held, with one batch; copies of a context are dropped before."""

    def test(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts)
        doc = t["doc"].to_numpy()
        has = covered_starts(*_raw(t), doc)
        hit = np.flatnonzero(has.any(axis=1))
        low, high = has[hit].argmax(axis=1) - SIDE, SIDE - has[hit, ::-1].argmax(axis=1) - SIDE + LENGTH
        return _batch(doc=doc[hit], key=t["key"].to_numpy()[hit], pos=t["pos"].to_numpy()[hit], low=low.astype(np.int32), high=high.astype(np.int32))

    held: list[pa.RecordBatch] = []
    before = None
    for b in batches:
        new, before = _unlike_last([b[c].to_numpy() for c in ("h", "doc", "key", "pos", "first")], before)
        b = b if new.all() else b.filter(pa.array(new))
        if not len(b):
            continue
        h = b["h"].to_numpy()
        last = int(np.searchsorted(h, h[-1], "left"))
        if held and (last or held[-1]["h"][-1].as_py() != h[-1]):
            yield test([*held, b.slice(0, last)])
            held = []
        elif last:
            yield test([b.slice(0, last)])
        held.append(b.slice(last))
    if held:
        yield test(held)


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, at: list of (pos, low, high)) -> id, n_bytes, spans, kept."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for b in batches:
        data, offsets = part_bytes(b.column(1))
        lists = b.column(2)
        lengths = lists.value_lengths().fill_null(0).to_numpy()
        upto = np.concatenate([[0], np.cumsum(lengths)])
        pos, low, high = (lists.flatten().field(i).to_numpy() for i in range(3))
        spans, kept = [], []
        for i, n in enumerate(np.diff(offsets).tolist()):
            mine = slice(upto[i], upto[i + 1])
            p = pos[mine]
            text = data[offsets[i] : offsets[i + 1]]
            change = np.zeros(n + 1, np.int32)
            np.add.at(change, np.maximum(p + low[mine], 0), 1)
            np.add.at(change, np.minimum(p + high[mine], n), -1)
            out = np.cumsum(change[:-1]) > 0
            edges = np.flatnonzero(np.diff(np.concatenate([[0], out.astype(np.int8), [0]])))
            spans.append([{"start": a, "end": z} for a, z in edges.reshape(-1, 2).tolist()])
            kept.append(text[~out].tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(offsets), pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())], ["id", "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, spans (start, end in UTF-8 bytes of what is removed), kept (the bytes that stay): one row per input row.

    The id is a whole number (other types are a TypeError); a null one counts as the smallest. Null texts are empty. Rows that share an id
    are never earlier than each other, so both stay; rows that repeat an id and text count once until the last step, however many they are. Other columns are ignored; an empty table gives an empty one.
    """
    if docs.schema[id_col].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{id_col} must hold whole numbers: documents are compared by it")
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("doc")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    row = [text.alias("text"), F.xxhash64(text).alias("key")]  # key tells rows apart that share an id; those with one text too have the same ranges
    d = docs.select(doc, *row)
    met = d.mapInArrow(_scan, "h bigint, context bigint, doc bigint, key bigint, pos bigint").repartition("h").sortWithinPartitions("h", "context", "doc", "key", "pos")
    met = cut(met.mapInArrow(_meet, "h bigint, doc bigint, key bigint, pos bigint, open boolean"), "anchors")

    def contexts(anchors: DataFrame, split: bool = False) -> DataFrame:
        wanted = anchors.groupBy("doc", "key").agg(F.collect_list(F.struct("pos", "h")).alias("at"))
        return d.join(wanted, ["doc", "key"]).select("doc", "text", "key", "at").mapInArrow(lambda batches: _contexts(batches, split), CONTEXT)

    ranges = "doc bigint, key bigint, pos bigint, low int, high int"
    many = lambda x: x.groupBy("h").count().where(F.col("count") > HOT).select("h")
    compared = lambda x: x.repartition("h").sortWithinPartitions("h", "doc", "key", "pos", "first").mapInArrow(_factors, ranges)
    opened = met.where("open")
    hot = cut(many(opened), "hot-anchors")
    factors = cut(compared(contexts(opened.join(hot, "h", "left_anti"))), "factors")
    if not hot.isEmpty():
        halves = cut(contexts(opened.join(hot, "h", "left_semi"), split=True), "split-contexts")
        hotter = cut(many(halves), "hot-contexts")
        factors = factors.union(cut(compared(halves.join(hotter, "h", "left_anti")), "split-factors"))
        if not hotter.isEmpty():
            suffixes = cut(halves.join(hotter, "h", "left_semi").mapInArrow(_suffixes, "suffix binary, doc bigint, key bigint, pos bigint, start int"), "suffixes")
            least = cut(suffixes.groupBy("suffix").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most"), "least")
            again = suffixes.join(least, "suffix").where("doc > least")
            again = again.groupBy("doc", "key", "pos").agg(F.min("start").alias("low"), (F.max("start") + LENGTH).cast("int").alias("high"))
            factors = factors.union(cut(again, "hot-factors"))
            discard(suffixes, least)
        discard(halves)

    whole = met.where("NOT open").select("doc", "key", "pos", F.lit(-SIDE).alias("low"), F.lit(LENGTH).alias("high"))
    covered = whole.union(factors).groupBy("doc", "key").agg(F.collect_list(F.struct("pos", "low", "high")).alias("at"))
    rows = docs.select(F.col(id_col).alias("id"), doc, *row)
    rows = rows.join(covered, ["doc", "key"], "left").select("id", "text", F.coalesce("at", F.array().cast("array<struct<pos: bigint, low: int, high: int>>")).alias("at"))
    out = rows.mapInArrow(_cut_out, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary")
    return out.withColumnRenamed("id", id_col)
