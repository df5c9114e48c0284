"""Token ids and counts of whole texts, and the digest cache of counts.

A text is cut at single spaces between two plain visible characters. Both public vocabularies in use
split there anyway (a space starts a piece or is dropped), so the ids of the pieces, laid end to end, are
those of the text; pieces repeat far more than texts, and each task keeps those it has seen.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Callable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.scratch import cut, shared_dir
from matchlake.llm.secrets import segments

#: Visible characters that are certainly neither white space nor marks that join what precedes them.
PLAIN = "!-~À-˿Ͱ-ͳͶ-ͷΆ-ϿЀ-ҁҊ-ԯ"
ODD = re.compile(f" (?:(?![{PLAIN}])|(?<![{PLAIN}] ))")
#: Characters of a piece that is kept.
LONG = 64
SAFE = re.compile(f" (?<=[{PLAIN}] )(?=[{PLAIN}])")


class WordEnds:
    """Ids of Latin words under a lower-casing vocabulary whose tokens mark the ends of words.

    The vocabulary as merge ranks: byte 0xFF, which UTF-8 never has, stands for the end of a word.
    Such words are most of what is new in a text and several times cheaper this way; the tests hold the
    ids against the library's. `ids` is None for any piece with other characters, which the library encodes.
    """

    #: ASCII and Latin letters that lower-casing and composition leave in this range, and line feeds.
    LATIN = re.compile(r"[\n!-~\u00a1-\u012f\u0131-\u017f]*\Z")
    WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u017f]+|[0-9\u00b2\u00b3\u00b9\u00bc-\u00be]|[^\sa-z0-9\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u017f\u00b2\u00b3\u00b9\u00bc-\u00be]+")
    END = "</w>"

    def __init__(self, model: dict):
        import tiktoken

        # Bytes that print stand for themselves in the vocabulary, the others for characters from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {}
        for token, i in model["vocab"].items():
            if all(c in byte for c in token):
                ends = token.endswith(self.END) and token != self.END
                ranks[bytes(byte[c] for c in (token[: -len(self.END)] if ends else token)) + b"\xff" * ends] = i
        self.piece = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    @classmethod
    def of(cls, tokenizer: dict) -> WordEnds | None:
        steps = [n["type"] for n in (tokenizer.get("normalizer") or {}).get("normalizers", [])]
        return cls(tokenizer["model"]) if tokenizer["model"].get("end_of_word_suffix") == cls.END and steps == ["NFC", "Replace", "Lowercase"] else None

    def ids(self, piece: str) -> list[int] | None:
        if not self.LATIN.match(piece) or "<|" in piece:
            return None
        piece = piece.lower()
        if piece.isalpha():  # one word
            return self.piece(piece.encode() + b"\xff")
        out: list[int] = []
        for w in self.WORD.findall(piece):
            out += self.piece(w.encode() + b"\xff")
        return out


class Pieces(dict):
    """What `of` makes of the ids of each piece, kept across texts: up to about `most` pieces of up to LONG characters; longer ones leave with their texts.

    A piece after a text's first stands for itself with the space before it. A first piece has a key
    that no other has: it starts with a space, and the others never do.
    """

    def __init__(self, tokenizer_json: str, of: Callable[[list[int]], object], most: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.of, self.most, self.long = of, most, []
        self.words = WordEnds.of(json.loads(tokenizer_json))

    def __missing__(self, piece: str) -> object:
        ids = self.words.ids(piece[1:] if piece[:1] == " " else piece) if self.words else None
        if ids is None:
            self.add([piece])
            return self[piece]
        value = self.of(ids)
        if len(piece) <= LONG:
            self[piece] = value
        return value

    def add(self, pieces: list[str]) -> None:
        encoded = self.tokenizer.encode_batch_fast([p[1:] if p[:1] == " " else " " + p for p in pieces], add_special_tokens=False)
        self.update(zip(pieces, [self.of(e.ids) for e in encoded], strict=True))
        self.long += [p for p in pieces if len(p) > LONG]

    def values_of(self, texts: list[str]) -> Iterator[Iterator[object]]:
        """The values of each text's pieces, in order. They have to be read before the next call."""
        for p in self.long:
            self.pop(p, None)
        self.long.clear()
        if len(self) > self.most:  # the first seen are the common ones
            first = dict(islice(self.items(), self.most // 2))
            self.clear()
            self.update(first)
        cut_up = [t.split(" ") if not ODD.search(t) else SAFE.split(t) for t in texts]
        for p in cut_up:
            p[0] = " " + p[0]
        if not self.words:  # the library is quicker with all new pieces at once
            self.add(list(set(chain.from_iterable(cut_up)).difference(self)))
        get = self.__getitem__
        return (map(get, p) for p in cut_up)


def encode_ids(texts: pa.Array, pieces: Pieces) -> Iterator[bytes]:
    """The ids of each text as bytes of what `pieces` keeps; nulls are empty texts."""
    for part in segments(texts, 4 << 20):
        yield from map(b"".join, pieces.values_of([t or "" for t in part.to_pylist()]))


def count_ids(texts: pa.Array, pieces: Pieces) -> Iterator[int]:
    for part in segments(texts, 4 << 20):
        yield from map(sum, pieces.values_of([t or "" for t in part.to_pylist()]))


def counts(docs: DataFrame, tokenizer_json: str, cache: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens: one row per input row.

    `cache` is a folder of counts by the digests of tokenizer and text, partitioned by tokenizer; texts that it lacks are
    encoded once each, however many rows repeat them, their ids included, and appended to it. None makes a new one in
    the shared folder. A null text counts as empty. Repeated and null ids are separate rows; other columns are ignored; an empty table gives an empty one.
    """
    import hashlib
    import uuid

    spark = docs.sparkSession
    cache = cache or f"{shared_dir(spark)}/token-counts-{uuid.uuid4().hex}"
    version = hashlib.sha256(tokenizer_json.encode()).hexdigest()
    shared = spark.sparkContext.broadcast(tokenizer_json)
    schema = "version string, digest binary, n_tokens bigint"
    spark.createDataFrame([], schema).write.mode("append").partitionBy("version").parquet(cache)
    known = lambda: spark.read.schema(schema).parquet(cache).where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest")
    # Of the rows of a text those whose id has the least hash bring it; they have the same text, so any one of them does.
    thin = cut(docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col)).alias("h"), digest, F.octet_length(text).cast("long").alias("n_bytes")), "digests")
    misses = thin.groupBy("digest").agg(F.min("h").alias("h")).join(known(), "digest", "left_anti")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(shared.value, len)
        for b in batches:
            n = pa.array(list(count_ids(b.column(1), pieces)), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([version] * len(b), pa.string()), b.column(0), n], ["version", "digest", "n_tokens"])

    texts = docs.select(F.xxhash64(F.col(id_col)).alias("h"), digest, text.alias("text"))
    found = texts.dropDuplicates(["h", "digest"]).join(misses, ["h", "digest"]).select("digest", "text")
    found.mapInArrow(encode, schema).write.mode("append").partitionBy("version").parquet(cache)
    # The counts as a table of their own: a text that very many rows repeat is then a skewed join that Spark can split.
    return thin.join(cut(known(), "token-counts"), "digest").select(F.col("id").alias(id_col), "n_bytes", "n_tokens")


def id_type(tokenizer_json: str) -> str:
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_str(tokenizer_json).get_vocab_size() <= 1 << 16 else "<u4"


def as_bytes(kind: str) -> Callable[[list[int]], bytes]:
    letter = {"<u2": "H", "<u4": "I"}[kind]
    if sys.byteorder == "big":
        return lambda ids: np.array(ids, kind).tobytes()
    return lambda ids: array(letter, ids).tobytes()  # several times as fast for a few ids
