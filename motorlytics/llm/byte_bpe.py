"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Long texts are cut into pieces before they are encoded. A cut goes between a character that is no white space and a white
space: no match of the splitting pattern crosses such a place, and a match that starts after it doesn't look back, so
the ids of the pieces in a row are the ids of the whole text. A text without such a place stays whole.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlytics.llm.common import batch, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_CHARS = 1 << 16

# Python counts U+001C to U+001F as white space and the pattern's engine doesn't, so they are no place to cut.
_BOUNDARY = re.compile(r"[^\s\x1c-\x1f](?=[ \t\n\r])")


@functools.lru_cache(maxsize=4)
def encoding(ranks_path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> tiktoken.Encoding:
    """The encoding of a rank file; a worker reads each file once."""
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, cut at safe boundaries only."""
    start = 0
    while len(text) - start > size:
        cut = _BOUNDARY.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str = RANKS,
           pattern: str = public_tokenizers.PATTERN, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int), one row per input row.

    Null or empty text: no ids. Repeated rows and null ids of documents stay as they are; other columns are not read;
    an empty table gives an empty result. Special tokens do not exist: their strings are ordinary text.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks_path, pattern)
        for rows in batches:
            ids = []
            for text in rows.column(1).to_pylist():
                parts = [enc.encode_ordinary(p) for p in pieces(text or "", piece_chars)]
                ids.append(parts[0] if len(parts) == 1 else [i for part in parts for i in part])
            yield batch(schema, [rows.column(0), ids])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, ids_col: str = "ids", ranks_path: str = RANKS,
           pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` (the raw bytes, which need not be valid UTF-8); null ids give no bytes."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks_path, pattern)
        for rows in batches:
            decoded = [enc.decode_bytes(ids or []) for ids in rows.column(1).to_pylist()]
            yield batch(schema, [rows.column(0), rows.column(1), decoded])

    source = tokens.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return source.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decode(encode(table(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
