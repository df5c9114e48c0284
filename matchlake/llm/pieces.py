"""SentencePiece BPE ids and texts by a table of the last token of each prefix.

A prefix of a word has one token that its encoding can end with: of the tokens that end there (found by an
Aho-Corasick automaton) the one that the encoding of what stands before it may be followed by. Two tokens may follow
each other if the merges of their joined text give just these two, which the merges within both tell. The table is filled from left to right, and the ids are
read off backwards from the word's end, so a word costs its length times the tokens that end at a place.

No token has a space after another character, so words (a run of spaces and what follows it) are encoded on their own,
and characters that no token has are their UTF-8 bytes and part what stands beside them. Each worker keeps the ids of the short words it has seen.
"""

from __future__ import annotations

import codecs
import hashlib
import math
import re
from array import array
from collections.abc import Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.secrets import segments

SPACE = "▁"
#: Words that a worker keeps: their number and their longest length in characters.
KEPT, KEPT_CHARS = 1_000_000, 48
#: Pairs of tokens whose test a worker keeps.
PAIRS = 4_000_000
#: Probes that a model has to answer so; others normalise texts in ways that are not built here.
PROBES = (("a", "▁a"), (" a  b ", "▁▁a▁▁b▁"), ("ﬁ́\n", "▁ﬁ́\n"))

codecs.register_error("one_byte_each", lambda e: ("�", e.start + 1))


class Model(dict):
    """Ids of words under one model, as bytes of 32-bit numbers; a dictionary of the words met before."""

    def __init__(self, proto: bytes):
        import ahocorasick
        import sentencepiece

        super().__init__()
        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        if any(sp.normalize(a) != b for a, b in PROBES):
            raise ValueError("only models that add a space in front and otherwise keep texts as they are")
        every = range(sp.get_piece_size())
        self.surface = [sp.id_to_piece(i).replace(SPACE, " ").encode() for i in every]
        for i in every:
            if sp.is_byte(i):
                self.surface[i] = bytes([int(sp.id_to_piece(i)[3:5], 16)])
            elif sp.is_control(i):
                self.surface[i] = b""
            elif sp.is_unknown(i):
                self.surface[i] = " ⁇ ".encode()
        self.byte = {self.surface[i][0]: i for i in every if sp.is_byte(i)}
        if len(self.byte) < 256:
            raise ValueError("only models that fall back on bytes")
        self.special = {i for i in every if sp.is_control(i) or sp.is_unknown(i)}
        pieces = [(i, sp.id_to_piece(i)) for i in every if i not in self.special and not sp.is_byte(i)]
        if any(SPACE in p.lstrip(SPACE) for _, p in pieces):
            raise ValueError("only models whose tokens have spaces in front alone")
        self.piece = dict(pieces)
        self.score = {p: sp.get_score(i) for i, p in pieces}
        self.ends = ahocorasick.Automaton()
        self.within = {}
        for i, p in pieces:
            self.within[i] = self.steps(p)
            if self.within[i][-1][1] == p:  # others are in no encoding
                self.ends.add_word(p, (i, len(p)))
        self.ends.make_automaton()
        self.length = {i: len(p) for i, p in pieces}
        self.characters = {p for _, p in pieces if len(p) == 1}
        self.may_follow: dict[int, bool] = {}

    def steps(self, text: str) -> list[tuple[float, str, str]]:
        """The merges of a text, of the neighbours that form a token the best first and of equals the leftmost: before each
        of them, and after the last (score -inf), its score and the first and the last part."""
        parts, score, out = list(text), self.score, []
        while True:
            best, at = -math.inf, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and s > best:
                    best, at = s, k
            out.append((best, parts[0], parts[-1]))
            if at < 0:
                return out
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, a: int, b: int) -> bool:
        """Whether the merges of both tokens' joined text give the two: no merge across the border comes before those within."""
        pair = a << 32 | b
        known = self.may_follow.get(pair)
        if known is not None:
            return known
        if len(self.may_follow) >= PAIRS:
            self.may_follow.clear()
        left, right, i, j, known = self.within[a], self.within[b], 0, 0, True
        while known:
            mine, its = left[i][0], right[j][0]
            across = self.score.get(left[i][2] + right[j][1])
            if across is not None and across > mine and across >= its:
                known = False
            elif mine == its == -math.inf:
                break
            elif mine >= its:
                i += 1
            else:
                j += 1
        self.may_follow[pair] = known
        return known

    def known(self, part: str) -> list[int]:
        """The ids of a part of a word whose characters are all tokens."""
        last, may = [-1] * len(part), self.may_follow.get  # last: of the prefix that ends with the character
        for at, (token, length) in self.ends.iter(part):
            if last[at] < 0:
                if at < length:
                    last[at] = token
                else:
                    before = last[at - length]
                    fits = may(before << 32 | token)
                    if fits or (fits is None and self.follows(before, token)):
                        last[at] = token
        ids, at = [], len(part) - 1
        while at >= 0:
            ids.append(last[at])
            at -= self.length[last[at]]
        return ids[::-1]

    def word(self, word: str) -> list[int]:
        """The ids of one word, spaces as SPACE."""
        if self.characters.issuperset(word):
            return self.known(word)
        ids = []
        for is_known, part in groupby(word, self.characters.__contains__):
            ids += self.known("".join(part)) if is_known else [self.byte[b] for b in "".join(part).encode()]
        return ids

    def __missing__(self, word: str) -> bytes:
        ids = self.word(word.replace(" ", SPACE))
        out = array("i", ids).tobytes()
        if len(word) <= KEPT_CHARS:
            if len(self) >= KEPT:  # the first seen are the common ones
                first = dict(islice(self.items(), KEPT // 2))
                self.clear()
                self.update(first)
            self[word] = out
        return out

    #: Places in front of which texts are cut: a run of spaces after anything else, and both sides of a line feed.
    CUT = re.compile(r"(?<=[^ ])(?= )|(?<=\n)(?=[^ ])|(?=\n)(?<!^)")

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        text = " " + text.replace(SPACE, " ")
        if "\x00" in text:
            return self.CUT.split(text)
        if "  " in text:
            text = re.sub(r"(?<=[^ ]) ", "\x00 ", text)
        else:
            text = text[:1] + text[1:].replace(" ", "\x00 ")
        return text.replace("\n", "\x00\n\x00").replace("\x00\x00", "\x00").split("\x00")

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.words(text)))

    def decode(self, ids: list[int]) -> str:
        """The text of ids: the space that encoding adds in front goes, and each byte that is no UTF-8 is U+FFFD."""
        text = b"".join(map(self.surface.__getitem__, ids))
        first = next((i for i in ids if i not in self.special or self.surface[i]), None)
        if first is not None and first not in self.special and text[:1] == b" " and self.piece.get(first, "")[:1] == SPACE:
            text = text[1:]
        return text.decode("utf-8", "one_byte_each")


_MODELS: dict[bytes, Model] = {}


def model(proto: bytes) -> Model:
    """The worker's model, with what it has learnt from the tasks before."""
    key = hashlib.sha256(proto).digest()
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Model(proto)
    return _MODELS[key]


def round_trip(docs: DataFrame, proto: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (array<int>, without begin and end), decoded (the text of these ids): one row per input row.

    The ids are those of the sentencepiece library for the model in `proto`. A null or empty text has no ids and decodes to ''. A text of
    any length is one row and is encoded word by word; words without spaces cost their length. Repeated rows, and null ids, give
    rows of their own; other columns are ignored, whatever their names; an empty table gives an empty one. There are no ties: each prefix has one last token.
    """
    shared = docs.sparkSession.sparkContext.broadcast(proto)
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(shared.value)
        for b in batches:
            at = 0
            for part in segments(b.column(1), 4 << 20):
                ids = [m.encode(t or "") for t in part.to_pylist()]
                offsets = np.zeros(len(ids) + 1, np.int64)
                np.cumsum([len(x) // 4 for x in ids], out=offsets[1:])
                flat = np.frombuffer(b"".join(ids), "<i4")
                text = pa.array([m.decode(np.frombuffer(x, "<i4").tolist()) for x in ids], pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(part)), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat)), text], ["id", "ids", "decoded"])
                at += len(part)

    out = d.mapInArrow(run, f"id {d.schema['id'].dataType.simpleString()}, ids array<int>, decoded string")
    return out.select(F.col("id").alias(id_col), "ids", "decoded")
