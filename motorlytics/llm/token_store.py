"""Token ids as binary files with random access, by directly addressable codes.

An id is split into chunks of 8 bits. Level 0 holds the lowest chunk of every id and a bitmap that says which ids go on;
level 1 holds the next chunk of those, with a bitmap of its own, and so on. A chunk's place on the next level is the number of
set bits before it; a directory keeps that number for every 512 bits, so any token is read by a few lookups and no block is
decoded.

File: the magic, a little-endian uint32 with the length of a JSON header, the header, then the parts it names (offset and
length from the end of the header): document ids (int64), places of their first tokens (int64, one more than documents), and
per level chunks (uint8), bits (uint8, lowest bit first) and ranks (uint32).
"""

from __future__ import annotations

import json
import os
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from motorlytics.llm.common import as_bytes, batch, filesystem, many_partitions, slices, table
from motorlytics.session import scratch_path, written

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
FILE_TOKENS = 4_000_000
KNOWN_WORDS = 800_000
CHUNK, RANK_BITS, MAGIC = 8, 512, b"DACIDS1\n"
_TAIL = b".,!?;:*#$%&|<>()[]{}+=/\\\"-_~^@`"


# --- the code ---


def packed(ids: np.ndarray) -> list[dict[str, np.ndarray]]:
    """The levels of an array of ids."""
    levels, rest = [], ids.astype(np.uint32)
    while len(rest) or not levels:
        more = rest >> np.uint32(CHUNK)
        goes_on = more > 0
        bits = np.packbits(goes_on, bitorder="little")
        per_block = np.add.reduceat(goes_on.astype(np.uint32), np.arange(0, len(rest), RANK_BITS)) if len(rest) else np.zeros(0, np.uint32)
        ranks = np.concatenate([[0], np.cumsum(per_block)]).astype("<u4")
        levels.append({"chunks": rest.astype(np.uint8), "bits": bits, "ranks": ranks})
        rest = more[goes_on]
    return levels


def rank(level: dict[str, np.ndarray], place: int) -> int:
    """Set bits before a place: the directory, then the bits of one block."""
    block = place // RANK_BITS
    part = level["bits"][block * RANK_BITS // 8 : -(-place // 8)]
    bits = np.unpackbits(part, bitorder="little")[: place - block * RANK_BITS]
    return int(level["ranks"][block]) + int(bits.sum())


def token(levels: list[dict[str, np.ndarray]], place: int) -> int:
    """The id at a place."""
    value = 0
    for depth, level in enumerate(levels):
        value |= int(level["chunks"][place]) << (CHUNK * depth)
        if not level["bits"][place // 8] >> (place % 8) & 1:
            break
        place = rank(level, place)
    return value


def tokens(levels: list[dict[str, np.ndarray]], start: int, end: int, depth: int = 0) -> np.ndarray:
    """The ids at start <= place < end."""
    level = levels[depth]
    values = level["chunks"][start:end].astype(np.uint32)
    if end <= start:
        return values
    low = start // 8
    goes_on = np.unpackbits(level["bits"][low : -(-end // 8)], bitorder="little")[start - 8 * low : end - 8 * low].astype(bool)
    n = int(goes_on.sum())
    if n:
        first = rank(level, start)
        values[goes_on] |= tokens(levels, first, first + n, depth + 1) << np.uint32(CHUNK)
    return values


def file_bytes(doc_ids: list, counts: list[int], ids: np.ndarray) -> bytes:
    parts = {"doc_ids": np.array([0 if d is None else d for d in doc_ids], "<i8"),
             "no_id": np.array([d is None for d in doc_ids], np.uint8),
             "starts": np.concatenate([[0], np.cumsum(counts)]).astype("<i8")}
    levels = packed(ids)
    for depth, level in enumerate(levels):
        parts |= {f"{name}{depth}": array for name, array in level.items()}
    places, at = {}, 0
    for name, array in parts.items():
        places[name] = [at, array.nbytes, array.dtype.str]
        at += array.nbytes
    header = json.dumps({"tokens": len(ids), "levels": len(levels), "chunk": CHUNK, "parts": places}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *(a.tobytes() for a in parts.values())])


class TokenFile:
    """A written file; ``read_at(length, offset)`` fetches bytes, so single parts can be read from any store."""

    def __init__(self, read_at):
        head = read_at(len(MAGIC) + 4, 0)
        if head[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        size = struct.unpack("<I", head[len(MAGIC) :])[0]
        self.header = json.loads(read_at(size, len(head)))
        base = len(head) + size

        def part(name: str) -> np.ndarray:
            at, length, kind = self.header["parts"][name]
            return np.frombuffer(read_at(length, base + at), kind)

        self.starts = part("starts")
        self.doc_ids = [None if gone else int(d) for d, gone in zip(part("doc_ids"), part("no_id"))]
        self.levels = [{n: part(f"{n}{d}") for n in ("chunks", "bits", "ranks")} for d in range(self.header["levels"])]

    def __len__(self) -> int:
        return self.header["tokens"]

    def __getitem__(self, place: int) -> int:
        return token(self.levels, place)

    def document(self, number: int) -> np.ndarray:
        return tokens(self.levels, int(self.starts[number]), int(self.starts[number + 1]))


# --- encoding ---


class Encoder(dict):
    """Ids of texts, word by word: white space ends a word, and no piece of this vocabulary crosses it.

    Maps a word to its row in a table of ids. Words that are new are gathered and given to the library together. A word
    that ends in punctuation after a letter or digit is looked up in two parts, since a split lies there. At ``limit`` words
    the table starts anew, so its memory is bounded.
    """

    def __init__(self, path: str, limit: int = KNOWN_WORDS):
        self.library = Tokenizer.from_file(path)
        # strings the library takes for one id wherever they stand; a word with one is never cut or folded
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.mark = os.path.commonprefix(self.special)
        self.limit = limit
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.parts: dict[bytes, int] = {b"": 0}
        self.fresh: list[bytes] = [b""]
        self[b""] = 0  # the end of a text
        self.core, self.tail = np.zeros(0, np.int64), np.zeros(0, np.int64)  # the parts of each word
        self.start, self.size = np.zeros(1, np.int64), np.zeros(1, np.int64)  # the ids of each part
        self.flat = np.zeros(0, np.uint32)

    def __missing__(self, word: bytes) -> int:
        self[word] = row = len(self)
        self.fresh.append(word)
        return row

    def settle(self) -> None:
        """Ids for the words that are new since the last call."""
        parts, new, core, tail = self.parts, [], [], []
        for word in self.fresh:
            first = word.rstrip(_TAIL)
            last = word[len(first) :]
            whole = self.mark in word and any(s in word for s in self.special)
            if whole or last and not first[-1:].isalnum():
                first, last = word, b""
            # folding must not make a special string of what is none
            folded = first.lower() if first.isascii() and not whole and b"<|" not in first else first
            for part, row in ((folded, core), (last, tail)):
                at = parts.get(part)
                if at is None:
                    at = parts[part] = len(parts)
                    new.append(part)
                row.append(at)
        self.core, self.tail = np.append(self.core, core), np.append(self.tail, tail)
        self.fresh = []
        starts, sizes, ids, known = [self.start], [self.size], [self.flat], len(self.flat)
        for low in range(0, len(new), 2000):  # many parts in one text cost far less than a call for each
            some = [p.decode() for p in new[low : low + 2000]]
            made = self.library.encode(" ".join(some), add_special_tokens=False)
            owner = np.searchsorted(np.cumsum([len(p) + 1 for p in some]), [a for a, _ in made.offsets], "right")
            size = np.bincount(owner, minlength=len(some))
            starts.append(known + np.cumsum(size) - size)
            sizes.append(size)
            ids.append(np.array(made.ids, np.uint32))
            known += len(made.ids)
        self.start, self.size, self.flat = np.concatenate(starts), np.concatenate(sizes), np.concatenate(ids)

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, each text ended by ``end_id``, and the number of ids of each text."""
        if len(self) > self.limit:
            self.reset()
        words, counts = [], []
        for text in texts:
            found = text.split()
            words += found
            words.append(b"")
            counts.append(len(found) + 1)
        rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.fresh:
            self.settle()
        parts = np.empty((len(rows), 2), np.int64)
        parts[:, 0], parts[:, 1] = self.core[rows], self.tail[rows]
        ends = rows == 0
        sizes = self.size[parts]
        sizes[ends, 0] = 1
        place = self.start[parts].ravel()
        flat = sizes.ravel()
        first = np.cumsum(flat) - flat
        index = np.repeat(place - first, flat) + np.arange(int(flat.sum()))
        last = first[::2][ends]
        index[last] = 0
        ids = self.flat[index] if len(self.flat) else np.zeros(len(index), np.uint32)
        ids[last] = end_id
        return ids, np.add.reduceat(sizes.sum(1), np.cumsum(counts) - counts)


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, end_id: int) -> Encoder:
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = Encoder(path)
    return _encoders[path, end_id]


# --- Spark ---


def write_tokens(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end_id: int = END_ID,
                 file_tokens: int = FILE_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes texts, adds ``end_id`` to each, writes token files in ascending id order, and returns their list:
    ``path``, ``shard``, ``number``, ``n_docs``, ``n_tokens`` and ``base`` (tokens in all files before).

    A null text is empty; null ids come first; rows that repeat an id are ordered by their text. An empty table gives no file.
    A task names its files anew, and only files of tasks that ended well are listed, so retries do no harm.
    """
    schema = pa.schema([("path", pa.string()), ("shard", pa.int32()), ("number", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, name, number = TaskContext.get().partitionId(), uuid.uuid4().hex, 0
        enc, store, root = encoder(vocabulary, end_id), *filesystem(folder)
        doc_ids, counts, ids, size = [], [], [], 0

        def flushed() -> pa.RecordBatch:
            path = f"{root}/tokens-{shard:06d}-{number:04d}-{name}.dac"
            with store.open_output_stream(path) as out:
                out.write(file_bytes(doc_ids, counts, np.concatenate(ids)))
            return batch(schema, [[path], [shard], [number], [len(doc_ids)], [size]])

        for rows in batches:
            texts, names = as_bytes(rows.column(1)), rows.column(0).to_pylist()
            for a, b in slices(texts):
                made, n = enc.encode(texts[a:b], end_id)
                doc_ids += names[a:b]
                counts += n.tolist()
                ids.append(made)
                size += len(made)
                if size >= file_tokens:
                    yield flushed()
                    doc_ids, counts, ids, size, number = [], [], [], 0, number + 1
        if doc_ids:
            yield flushed()

    store, root = filesystem(folder)
    store.create_dir(root, recursive=True)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    ordered = source.repartitionByRange(many_partitions(docs.sparkSession), *order).sortWithinPartitions(*order, "text")
    files = written(ordered.mapInArrow(run, "path string, shard int, number int, n_docs long, n_tokens long"), "token-files")
    before = Window.orderBy("shard", "number").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))


def read_tokens(files: DataFrame, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (tokens of all documents before), ``n_tokens`` and ``ids`` of every document in the files."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(folder)
        for rows in batches:
            for path, base in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                with store.open_input_file(path) as source:
                    held = TokenFile(source.read_at)
                for low in range(0, len(held.doc_ids), 128):
                    some = range(low, min(low + 128, len(held.doc_ids)))
                    first, last = int(held.starts[some.start]), int(held.starts[some.stop])
                    raw = tokens(held.levels, first, last).astype("<u4").tobytes()
                    cut = (held.starts[some.start : some.stop + 1] - first).tolist()
                    yield batch(schema, [
                        held.doc_ids[some.start : some.stop], held.starts[some.start : some.stop] + base,
                        np.diff(cut), [raw[4 * a : 4 * b] for a, b in zip(cut, cut[1:])]])

    spread = files.select("path", "base").repartition(many_partitions(files.sparkSession), "path")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "tokens")
    rows = read_tokens(write_tokens(docs, folder), folder)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
