"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Ids travel as packed little-endian unsigned 32-bit integers in a binary column:
one value per document whatever its length, ready to be hashed or written.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import release, trim

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Texts above this many characters are cut. The library's pattern engine gives up on runs of about a million.
LONG = 1 << 16
#: Bytes of packed ids that leave a worker at once, about.
PART = 1 << 22
#: No match of the pattern crosses these places: white space after anything else, and the end of a run of
#: letters or of digits. A cut there changes neither side, as the one lookahead of the pattern looks past white space only.
CUT = regex.compile(r"(?<=\P{White_Space})(?=\p{White_Space})|(?<=\p{L})(?=\P{L})|(?<=\p{N})(?=\P{N})")


class Codec:
    """One vocabulary: ranks of byte strings and the pattern that splits text before merging."""

    def __init__(self, ranks: str, pattern: str):
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
        self.library = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        # The library's white space is the Unicode property; ``regex`` has a slightly different class.
        self.pattern = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))

    def stretches(self, text: str) -> Iterator[str]:
        """The text cut at safe places into stretches of about ``LONG`` characters, longer where none is in reach."""
        start = 0
        while len(text) - start > LONG:
            place = CUT.search(text, start + LONG // 2)
            end = place.start() if place else len(text)
            yield text[start:end]
            start = end
        yield text[start:]

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= LONG:
            return self.library.encode_to_numpy(text)
        parts = []
        for stretch in self.stretches(text):
            if len(stretch) <= LONG:
                parts.append(self.library.encode_to_numpy(stretch))
            else:  # one giant run: match by match, as the library would
                for match in self.pattern.finditer(stretch):
                    parts.append(np.array(self.library._encode_single_piece(match.group()), dtype=np.uint32))
        return np.concatenate(parts) if parts else np.empty(0, np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        return self.library.decode_bytes(ids.tolist())


@functools.lru_cache(maxsize=4)
def codec(ranks: str, pattern: str) -> Codec:
    return Codec(ranks, pattern)


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``docs`` with a binary column ``ids``: the packed token ids of the whole text.

    A null text counts as an empty one, which has no ids. Rows are kept as they
    are, repeated ones too; a column already named like ``ids`` is replaced.
    Strings of special tokens are ordinary text.
    """

    @F.pandas_udf("binary")
    def encoded(texts: pd.Series) -> pd.Series:
        own = codec(ranks, pattern)
        return pd.Series([own.encode(t or "").astype("<u4").tobytes() for t in texts], dtype=object)

    return docs.withColumn(ids, encoded(F.col(text)))


def decode(docs: DataFrame, ids: str = "ids", raw: str = "decoded", ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``docs`` with a binary column ``raw``: the bytes that the packed ids stand for; null ids give none.

    Bytes and not text, as ids cut at any place may end inside a character.
    """

    @F.pandas_udf("binary")
    def decoded(packed: pd.Series) -> pd.Series:
        own = codec(ranks, pattern)
        return pd.Series([own.decode(np.frombuffer(p or b"", dtype="<u4")) for p in packed], dtype=object)

    return docs.withColumn(raw, decoded(F.col(ids)))


def digest(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """Per document: doc_id, number of ids, SHA-256 of the packed ids and of the decoded bytes.

    A null text counts as empty and has no ids. Null ids and rows that repeat have rows of their own; no rows
    give no rows; other columns are not read.
    """
    coded = decode(encode(docs.select("doc_id", "text"), ranks=ranks).select("doc_id", "ids"), ranks=ranks)
    return coded.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def checked(docs: DataFrame, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Per row: doc_id, source, number of ids, packed ids, and whether they decode to the text's bytes.

    A null text counts as empty. Rows that repeat are encoded each; no rows give no rows; other columns are not
    read. Ids are decoded where they were made and leave in parts of about ``PART`` bytes, so that a task has one
    worker, which holds one batch of texts and one part.
    """

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        own = codec(ranks, pattern)
        for batch in batches:
            start, size, ids, same = 0, 0, [], []
            for at, text in enumerate(batch.column("text"), 1):
                whole = text.as_py() or ""
                found = own.encode(whole).astype("<u4")
                same.append(own.decode(found) == whole.encode())
                ids.append(found.tobytes())
                size += len(ids[-1])
                if size >= PART or at == len(batch):
                    kept = [batch.column(c).slice(start, at - start) for c in ("doc_id", "source")]
                    counts = pa.array([len(i) // 4 for i in ids], pa.int64())
                    yield pa.RecordBatch.from_arrays([*kept, counts, pa.array(ids, pa.binary()), pa.array(same)], names)
                    start, size, ids, same = at, 0, [], []
            trim()

    rows = docs.select("doc_id", "source", "text")
    schema = T.StructType(
        [
            *rows.drop("text").schema.fields,
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("round_trip", T.BooleanType()),
        ]
    )
    names = schema.names
    return rows.mapInArrow(coded, schema)
