"""Byte-level BPE: whole texts to token ids and back, with a local rank file.

Texts are encoded by the tiktoken library as ordinary text. Long texts are cut first,
at places where no match of the split pattern can span: before a blank that follows a
letter or digit. Ids of the pieces in a row are the ids of the whole text. Decoding
joins the bytes of the ids.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickstream.llm.frames import as_bytes, extended, session_of

RANKS = "byte_bpe_50k.tiktoken"
# Texts above this many characters are cut into pieces of about this many.
PIECE_CHARS = 1 << 15
_BOUNDARY = re.compile(r"(?<=[^\W_])(?=[ \n])")


@functools.lru_cache(maxsize=4)
def load(path: str, pattern: str) -> tuple[tiktoken.Encoding, list[bytes]]:
    """The encoding of a rank file and the bytes of each id."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    names = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        names[rank] = token
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), names


def split_text(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """Pieces of at least ``limit`` characters that end at safe boundaries."""
    start = 0
    while len(text) - start > limit:
        cut = _BOUNDARY.search(text, start + limit)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(text: str, encoding: tiktoken.Encoding, limit: int = PIECE_CHARS) -> list[int]:
    ids: list[int] = []
    for piece in split_text(text, limit):
        ids += encoding.encode_ordinary(piece)
    return ids


def encode(docs: DataFrame, text: str = "text", path: str | None = None,
           pattern: str = public_tokenizers.PATTERN, ids: str = "token_ids",
           decoded: str | None = None) -> DataFrame:
    """The frame with the texts' token ids as an array column (replaced where it exists).

    With ``decoded`` the ids are decoded at once, into a binary column of that name; a
    ``decode`` behind ``encode`` does the same with a second Python worker per task. Null and empty texts have no ids. The rank file must lie at ``path`` on all
    machines. Bytes that are not UTF-8 are read as replacement characters.
    """
    path = path or public_tokenizers.path(RANKS)
    session_of(docs)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, names = load(path, pattern)
        for batch in source:
            raw = batch.column(batch.num_columns - 1)
            # The ids of a batch may outgrow its texts, so few rows are held at a time.
            for at, count in _row_groups(raw):
                part = batch.slice(at, count)
                rows = [encode_text(value.as_py().decode("utf-8", "replace"), encoding)
                        for value in part.column(batch.num_columns - 1)]
                lengths = np.cumsum([0] + [len(r) for r in rows])
                flat = np.fromiter((i for r in rows for i in r), np.int32, int(lengths[-1]))
                column = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat))
                back = [pa.array([decode_ids(r, names) for r in rows], pa.binary())] if decoded else []
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], column, *back], [*part.schema.names[:-1], *added])

    added = {ids: "array<int>"} | ({decoded: "binary"} if decoded else {})
    kept = docs.drop(*added)
    body = docs.select(*kept.columns, as_bytes(text).alias("__bytes"))
    schema = extended(kept, added)
    return body.mapInArrow(run, schema)


def decode_ids(ids: list[int], names: list[bytes]) -> bytes:
    return b"".join(map(names.__getitem__, ids))


def _row_groups(raw: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    start = held = 0
    for row, value in enumerate(raw):
        held += len(value.as_buffer())
        if held >= limit:
            yield start, row + 1 - start
            start, held = row + 1, 0
    if start < len(raw):
        yield start, len(raw) - start


def decode(tokens: DataFrame, ids: str = "token_ids", path: str | None = None,
           pattern: str = public_tokenizers.PATTERN, decoded: str = "decoded") -> DataFrame:
    """The frame with the raw bytes of the ids as a binary column (replaced where it exists).

    A null array decodes to no bytes. An id outside the rank file is an error.
    """
    path = path or public_tokenizers.path(RANKS)
    session_of(tokens)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, names = load(path, pattern)
        for batch in source:
            rows = batch.column(batch.num_columns - 1)
            out = [decode_ids(row.as_py() or [], names) for row in rows]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(out, pa.binary())],
                [*batch.schema.names[:-1], decoded])

    kept = tokens.drop(decoded)
    schema = extended(kept, {decoded: "binary"})
    return kept.withColumn("__ids", F.col(ids)).mapInArrow(run, schema)


def token_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded bytes, from a real round trip."""
    tokens = encode(docs.select("doc_id", "text"), decoded="decoded")
    return tokens.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def encode_stage(docs: DataFrame) -> DataFrame:
    """Pipeline stage: the documents with their ids, and whether decoding gives the text back."""
    tokens = encode(docs, decoded="decoded")
    return tokens.withColumn("n_tokens", F.size("token_ids").cast("long")).withColumn(
        "round_trip", F.col("decoded") == as_bytes("text")).drop("decoded")
