"""Secret scans over a trigram inverted index.

Each rule's regular expression gives a Boolean query over byte trigrams that every match must
contain. The corpus is indexed in segments (slices of an Arrow batch, so a segment's index lives
and dies in one task): the trigrams that the rules ask for are looked up at every position, their
postings (rows of the segment) are intersected and united as the query says, and only these
candidates are verified with the regular expression. A rule without a mandatory trigram scans
every row. A-Z are folded to lower case in the index and in the query alike, so the query holds for either case.
"""

from __future__ import annotations

import re
import re._constants as sre_constants
import re._parser as sre_parser
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEGMENT_BYTES = 8 << 20
#: Alternatives that a run of exact characters may have before it is cut.
MOST_STRINGS = 128


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of pattern count if the given group has at least `least` characters."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    flags: int = re.ASCII


#: The first three are the base kinds, in their order.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}"),  # runs are maximal, so a shorter run never hides a longer one
    # Up to its end line; without one, as far as lines of base64 go.
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:[^-]*+(?:-(?!----)[^-]*+)*+-----END [A-Z ]{0,40}PRIVATE KEY-----|(?:(?:\s|\\[nr])*+[A-Za-z0-9+/=]{20,}+)*+)"),
    # From the start of a run of its characters, so a run is read once.
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    Rule("code_host", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35}"),
)
BASE = ("assign", "access", "hex")

SPAN = "array<struct<kind: string, start: bigint, end: bigint>>"


def fold(character: str) -> str:
    """A-Z as lower case, as in the index; other characters as they are."""
    return character.lower() if "A" <= character <= "Z" else character


def trigrams(text: bytes) -> frozenset[bytes]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def trigram_query(pattern: str, flags: int = 0) -> list[list[frozenset[bytes]]]:
    """A conjunction of disjunctions: some set of each inner list is wholly in any text that matches; empty if nothing is mandatory."""
    query: list[list[frozenset[bytes]]] = []
    # Without regard to case, characters beyond ASCII have other cases, and k, s and i are cases of such characters.
    any_case = bool(flags & re.IGNORECASE or re.search(r"\(\?[aLmsux]*i", pattern)) and not flags & re.ASCII
    other_cases = lambda c: any_case and (c > 127 or chr(c) in "kKsSiI")

    def strings(op, arg) -> set[str] | None:
        """All strings, folded, that an element can match, or None if they are too many to list."""
        if op is sre_constants.LITERAL:
            return None if other_cases(arg) else {fold(chr(arg))}
        if op is sre_constants.IN:
            found: set[str] = set()
            for kind, x in arg:
                if kind is sre_constants.LITERAL:
                    x = (x, x)
                elif kind is not sre_constants.RANGE or x[1] - x[0] >= 8:
                    return None
                if any(map(other_cases, range(x[0], x[1] + 1))):
                    return None
                found |= {fold(chr(c)) for c in range(x[0], x[1] + 1)}
            return found if len(found) <= 8 else None
        if op is sre_constants.SUBPATTERN:
            return sequence(arg[-1])
        if op is sre_constants.BRANCH:
            parts = [sequence(p) for p in arg[1]]
            return None if None in parts else set().union(*parts)
        if op in (sre_constants.MAX_REPEAT, sre_constants.MIN_REPEAT) and arg[1] <= 4:
            one = sequence(arg[2])
            if one is None:
                return None
            total, power = (set() if arg[0] else {""}), {""}
            for n in range(1, arg[1] + 1):
                power = {a + b for a in power for b in one}
                if len(power) > MOST_STRINGS:
                    return None
                if n >= arg[0]:
                    total |= power
            return total
        if op is sre_constants.AT:
            return {""}
        return None

    def sequence(items) -> set[str] | None:
        run = {""}
        for op, arg in items:
            if (s := strings(op, arg)) is None or len(run) * len(s) > MOST_STRINGS:
                return None
            run = {a + b for a in run for b in s}
        return run

    def require(run: set[str]) -> None:
        sets = [trigrams(s.encode()) for s in run]
        if all(sets):  # what contains another alternative adds nothing
            query.append(list(dict.fromkeys(s for s in sets if not any(t < s for t in sets))))

    def walk(items) -> None:
        run = {""}
        for op, arg in items:
            s = strings(op, arg)
            if s is not None and len(run) * len(s) <= MOST_STRINGS:
                run = {a + b for a in run for b in s}
                continue
            require(run)
            run = s if s is not None else {""}
            if s is None and op is sre_constants.SUBPATTERN:
                walk(arg[-1])
            elif s is None and op in (sre_constants.MAX_REPEAT, sre_constants.MIN_REPEAT) and arg[0] >= 1:
                walk(arg[2])
        require(run)

    walk(sre_parser.parse(pattern, flags))
    return query


class Scanner:
    """The rules, compiled, and the table that finds their trigrams; one for each task."""

    def __init__(self, rules: Sequence[Rule] = RULES):
        self.rules = [(r, re.compile(r.pattern, r.flags), trigram_query(r.pattern, r.flags)) for r in rules]
        wanted = sorted({t for _, _, q in self.rules for any_of in q for s in any_of for t in s})
        self.number = {t: n for n, t in enumerate(wanted, 1)}
        self.table = np.zeros(1 << 24, np.uint16)
        for t, n in self.number.items():
            self.table[t[0] << 16 | t[1] << 8 | t[2]] = n
        self.fold = np.arange(256, dtype=np.uint32)
        self.fold[65:91] += 32

    def postings(self, data: np.ndarray, offsets: np.ndarray) -> dict[int, np.ndarray]:
        """The rows that hold each wanted trigram."""
        if len(data) < 3:
            return {}
        b = self.fold[data]
        found = self.table[b[:-2] << 16 | b[1:-1] << 8 | b[2:]]
        at = np.flatnonzero(found)
        row = np.searchsorted(offsets, at, "right") - 1
        inside = at + 3 <= offsets[row + 1]
        pairs = np.unique(found[at[inside]].astype(np.int64) << 32 | row[inside])
        which, row = pairs >> 32, pairs & 0xFFFFFFFF
        cuts = np.flatnonzero(np.diff(which)) + 1
        return {int(w[0]): r for w, r in zip(np.split(which, cuts), np.split(row, cuts), strict=True) if len(w)}

    def candidates(self, query: list[list[frozenset[bytes]]], postings: dict[int, np.ndarray], n_rows: int) -> np.ndarray:
        none = np.empty(0, np.int64)
        rows = np.arange(n_rows)
        for any_of in query:
            united = none
            for need in any_of:
                hit = None
                for t in need:
                    p = postings.get(self.number[t], none)
                    hit = p if hit is None else np.intersect1d(hit, p, assume_unique=True)
                united = np.union1d(united, hit)
            rows = np.intersect1d(rows, united, assume_unique=True)
        return rows

    def scan(self, texts: pa.Array) -> list[list[tuple[str, int, int]]]:
        """The spans of each text, by start and then by the order of the rules; nulls have none."""
        spans: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
        done = 0
        for part in segments(texts):
            data, offsets = part_bytes(part)
            postings = self.postings(data, offsets)
            for n, (rule, pattern, query) in enumerate(self.rules):
                for i in self.candidates(query, postings, len(part)):
                    if (text := part[int(i)].as_py()) is None:
                        continue
                    for m in pattern.finditer(text):
                        if m.end(rule.group) - m.start(rule.group) >= rule.least:
                            spans[done + i].append((m.start(), n, m.end()))
            done += len(part)
        return [[(self.rules[n][0].kind, a, b) for a, n, b in sorted(s)] for s in spans]


def part_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the offsets of its rows in them."""
    wide = texts.cast(pa.large_string())
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = np.frombuffer(wide.buffers()[2], np.uint8) if wide.buffers()[2] else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def segments(texts: pa.Array, size: int = SEGMENT_BYTES) -> Iterator[pa.Array]:
    """Slices of about `size` bytes; one text is never cut."""
    if not len(texts):
        return
    _, offsets = part_bytes(texts)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield texts.slice(at, end - at)
        at = end


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """id and spans (kind, start, end in code points, end exclusive), one row per input row; by start, then in the order of the rules.

    Texts of any length are scanned whole, in time and memory that grow with their length; spans of different kinds may overlap.

    A null or empty text has no spans; other columns are ignored. Repeated rows give repeated results.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            found = scanner.scan(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in x] for x in found], kind)], ["id", "spans"])

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, f"id {d.schema['id'].dataType.simpleString()}, spans {SPAN}").withColumnRenamed("id", id_col)


def redact(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """docs with every span, overlapping ones together, replaced by its first kind in brackets; all columns stay."""
    names = docs.columns
    at = names.index(text_col)

    def clean(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
        if not spans:
            return text
        out, upto = [], 0
        for kind, start, end in spans:
            if start >= upto:
                out += [text[upto:start], f"[{kind}]"]
            upto = max(upto, end)
        return "".join([*out, text[upto:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            texts = batch.column(at)
            found = scanner.scan(texts)
            if any(found):
                done = pa.array([clean(t, s) for t, s in zip(texts.to_pylist(), found, strict=True)], texts.type)
                batch = pa.RecordBatch.from_arrays([done if i == at else batch.column(i) for i in range(len(names))], names)
            yield batch

    return docs.mapInArrow(run, docs.schema)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
