"""Removal of long byte strings that occur more than once, by suffix arrays over shards.

A string of ``length`` bytes and each of its copies choose the same anchor in themselves: the leftmost smallest of the hashes
of their 32-byte substrings. Strings of a text that share an anchor are neighbours and make up one snippet, and every string
is in exactly one. Anchors whose hash is unique can't lie in a repeated string and are dropped. The snippets of the
others meet by hash, equal ones count once, and those with the same anchor but different surroundings go to a shard. A
shard is sorted by induced sorting; where the common prefix of neighbours reaches ``length``, both strings are repeated.

An anchor with very many different snippets (a passage in documents that differ around it) is no shard: its strings are
compared as 128-bit hashes, which Spark counts before it shuffles them.

Passages that documents share are often shorter than ``length`` bytes. So the same way finds, beside what is removed, the
stretches of ``words`` words that another document has too: their words are hashed, they choose an anchor among the hashes
of their 8-word substrings, and those that share one are compared as 64-bit hashes. They are reported, not removed.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlytics.llm.common import as_bytes, batch, prepare, slices, table
from motorlytics.llm.decontaminate import word_hashes
from motorlytics.llm.suffix_array import common_prefixes, suffix_array
from motorlytics.session import written

LENGTH = 400
GRAM = 32
WORDS = 51
WORD_GRAM = 8
SHARD_BYTES = 1 << 20
HOT_SNIPPETS = 2_000
ZONES = 8
SCAN_BYTES = 1 << 20

_BYTE = np.random.default_rng(20240).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_LOW = np.uint64((1 << 32) - 1)
# Words end at these bytes; NUL counts as 0xFF, which UTF-8 doesn't have.
_SPACES = bytes(32 if b == 32 or 9 <= b <= 13 else b or 255 for b in range(256))
_KEY = "doc_id long, text_hash long, words boolean, anchor long, digest long, first long, n int"


def mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return hashes ^ (hashes >> np.uint64(29))


def doubled(hashes: np.ndarray, gram: int) -> np.ndarray:
    """A hash for each stretch of ``gram`` (a power of two) hashes."""
    width = 1
    while width < gram:
        hashes = hashes[:-width] * np.uint64(pow(_STEP, width, 1 << 64)) + hashes[width:]
        width *= 2
    return mixed(hashes)


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash for each 32-byte substring, by doubling."""
    return doubled(_BYTE[raw], GRAM)


def stretch_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each stretch of ``width`` words: its first and its last part, which overlap, of a power of two."""
    part = 1 << (width.bit_length() - 1)
    parts = doubled(hashes, part)
    n = max(0, len(hashes) - width + 1)
    return mixed(parts[:n] * np.uint64(_STEP) + parts[width - part :][:n])


def smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each window of ``width`` keys."""
    done = 1
    while 2 * done <= width:
        keys = np.minimum(keys[:-done], keys[done:])
        done *= 2
    return np.minimum(keys[: len(keys) - (width - done)], keys[width - done :]) if width > done else keys


def anchors(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Snippets of the texts: number of the text, first string's place in it, number of strings, hash of the anchor.

    The choice looks at a string's own bytes only: 32 bits of hash, and of equal ones the leftmost.
    """
    raw = np.frombuffer(b"".join(texts), np.uint8)
    return chosen(gram_hashes(raw), np.array([len(t) for t in texts], np.int64), length, GRAM)


def chosen(hashes: np.ndarray, sizes: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same, given the hashes of substrings of ``gram`` bytes (or words) and the texts' sizes."""
    if sizes.sum() < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    least = smallest((hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64), length - gram + 1)
    place = (least & _LOW).astype(np.int64)
    ends = np.cumsum(sizes)
    fits = np.maximum(sizes - length + 1, 0)
    owner = np.repeat(np.arange(len(sizes)), fits)
    window = np.arange(int(fits.sum())) - np.repeat(np.cumsum(fits) - fits, fits) + (ends - sizes)[owner]
    place = place[window]
    new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])]) if len(place) else np.zeros(0, np.int64)
    n = np.diff(np.append(new, len(place)))
    return owner[new], window[new] - (ends - sizes)[owner[new]], n, hashes[place[new]]


def snippets(docs: DataFrame, length: int, words: int) -> DataFrame:
    """Where the snippets of bytes and of words are, with hashes of anchor and content; not the content itself."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("words", pa.bool_()), ("anchor", pa.int64()),
                        ("digest", pa.int64()), ("first", pa.int64()), ("n", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = as_bytes(rows.column(2))
            for a, b in slices(texts, SCAN_BYTES):
                hashed, counts = word_hashes(texts[a:b], _SPACES)
                begin, size = np.cumsum(counts) - counts, hashed.itemsize
                for by_word, (owner, first, n, hashes), views in (
                        (False, anchors(texts[a:b], length), [memoryview(t) for t in texts[a:b]]),
                        (True, chosen(doubled(hashed, WORD_GRAM), counts, words, WORD_GRAM),
                         [memoryview(hashed[s : s + c]).cast("B") for s, c in zip(begin, counts)])):
                    unit, more = (size, words - 1) if by_word else (1, length - 1)
                    digest = [xxhash.xxh3_64_intdigest(views[o][unit * f : unit * (f + k + more)])
                              for o, f, k in zip(owner.tolist(), first.tolist(), n.tolist())]
                    at = pa.array(owner + a)
                    yield batch(schema, [rows.column(0).take(at), rows.column(1).take(at), [by_word] * len(at), hashes.view(np.int64),
                                         np.array(digest, np.uint64).view(np.int64), first, n.astype(np.int32)])

    return docs.mapInArrow(run, _KEY)


def likely(keys: list[int], texts: list[bytes], length: int) -> list[tuple[int, int]]:
    """For each snippet the range of its strings outside of which none is repeated, by what surrounds the anchors.

    Strings with the anchor in about the same place (one of ``ZONES``) share all but a few of their bytes, from which
    those bytes follow. If no other snippet has the same ones there, none of these strings has a copy. So this only rules out.
    """
    raw = np.frombuffer(b"\xff".join(texts) + bytes(GRAM), np.uint8)
    hashes = gram_hashes(raw).view(np.int64)
    width = -(-(length - GRAM + 1) // ZONES)
    zones, times, begin = [], Counter(), 0
    for key, text in zip(keys, texts):
        n = len(text) - length + 1
        shared = hashes[begin + n - 1 : begin + length - GRAM + 1] == key  # in the bytes that all strings have
        anchor = n - 1 + int(shared.argmax())
        zones.append([(z, anchor, (key, z, text[anchor - z * width : anchor - (z + 1) * width + 1 + length]))
                      for z in range((anchor - n + 1) // width, anchor // width + 1)])
        times.update(bytes_there for _, _, bytes_there in zones[-1])
        begin += len(text) + 1
    ranges = []
    for text, mine in zip(texts, zones):
        again = [(anchor - (z + 1) * width + 1, anchor - z * width + 1) for z, anchor, there in mine if times[there] > 1]
        n = len(text) - length + 1
        ranges.append((max(0, again[-1][0]), min(n, again[0][1])) if again else (0, 0))
    return ranges


def repeated_in_shard(keys: list[int], texts: list[bytes], copies: list[int], length: int) -> list[np.ndarray]:
    """For each snippet, a bool per string: whether it occurs elsewhere. Texts are UTF-8, so 0xFF divides them."""
    ranges = likely(keys, texts, length)
    parts = [t[a : b + length - 1] + b"\xff" if a < b else b"" for t, (a, b) in zip(texts, ranges)]
    raw = np.frombuffer(b"".join(parts), np.uint8)
    shared, before = common_prefixes(raw, suffix_array(raw))
    again = shared >= length
    again[before[again]] = True
    marks = [np.full(len(t) - length + 1, c > 1) for t, c in zip(texts, copies)]
    for mark, (a, b), p in zip(marks, ranges, np.cumsum([0, *map(len, parts)]).tolist()):
        mark[a:b] |= again[p : p + b - a]
    return marks


def shared_in_shard(snippets: list[bytes], low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
    """For each snippet of words, given as hashes of its stretches, a bool per stretch: whether two documents have it.
    ``low``, ``high``: the smallest and the largest document that has the snippet."""
    sizes = [len(s) // 8 for s in snippets]
    keys = np.frombuffer(b"".join(snippets), np.int64)
    owner = np.repeat(np.arange(len(snippets)), sizes)
    order = keys.argsort()
    new = np.flatnonzero(np.r_[True, np.diff(keys[order]) != 0])
    shared = np.minimum.reduceat(low[owner[order]], new) < np.maximum.reduceat(high[owner[order]], new)
    marks = np.empty(len(keys), bool)
    marks[order] = np.repeat(shared, np.diff(np.append(new, len(keys))))
    return np.split(marks, np.cumsum(sizes)[:-1])


RUNS = "anchor long, digest long, runs array<struct<a:int,b:int>>"
_RUNS = pa.schema([("anchor", pa.int64()), ("digest", pa.int64()),
                   ("runs", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))])


def runs(marks: list[np.ndarray]) -> pa.ListArray:
    """For each snippet its runs of marked strings: first one, and the one after the last."""
    ends = np.cumsum([len(m) + 1 for m in marks])
    begins = np.append(0, ends[:-1])
    flags = np.zeros(int(ends[-1]), np.int8)
    for mark, begin in zip(marks, begins.tolist()):
        flags[begin : begin + len(mark)] = mark
    edge = np.diff(flags, prepend=np.int8(0))
    first, after = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    upto = np.searchsorted(first, ends)
    begin = np.repeat(begins, np.diff(upto, prepend=0))
    each = pa.StructArray.from_arrays([pa.array((first - begin).astype(np.int32)), pa.array((after - begin).astype(np.int32))], names=["a", "b"])
    return pa.ListArray.from_arrays(pa.array(np.append(0, upto).astype(np.int32)), each)


def sharded(found: DataFrame, marks: Callable[[pa.Table], list[np.ndarray]], shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Repeated strings among snippets that share an anchor. ``found``: anchor, digest, snippet and what ``marks`` reads."""

    def shard(rows: pa.Table) -> pa.RecordBatch:
        return batch(_RUNS, [rows.column("anchor").combine_chunks(), rows.column("digest").combine_chunks(), runs(marks(rows))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for part in batches:
            held = pa.concat_tables([held, pa.Table.from_batches([part])]) if held else pa.Table.from_batches([part])
            while held.num_rows:
                keys = held.column("anchor").to_numpy()
                size = np.cumsum(pa.compute.binary_length(held.column("snippet")).to_numpy())
                full = int(np.searchsorted(size, shard_bytes)) + 1
                if full >= held.num_rows:
                    break
                later = np.flatnonzero(keys[full:] != keys[full - 1])  # a shard ends where an anchor ends
                if not len(later):
                    break
                cut = full + int(later[0])
                yield shard(held.slice(0, cut))
                held = held.slice(cut)
        if held and held.num_rows:
            yield shard(held)

    return found.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, RUNS)


def by_hash(found: DataFrame, strings: Callable[[bytes], list[bytes]], repeated: Column) -> DataFrame:
    """The same for anchors with very many snippets: one hash per string, counted over all."""
    kinds = [("anchor", pa.int64()), ("digest", pa.int64()), ("copies", pa.int64()), ("low", pa.int64()), ("high", pa.int64())]
    names = [name for name, _ in kinds]
    schema = pa.schema([*kinds, ("at", pa.int32()), ("string", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for i, text in enumerate(as_bytes(rows.column("snippet"))):
                each = strings(text)
                one = pa.array([i] * len(each))
                yield batch(schema, [*(rows.column(c).take(one) for c in names), np.arange(len(each), dtype=np.int32), each])

    each = found.select(*names, "snippet").mapInArrow(run, f"{', '.join(f'{c} long' for c in names)}, at int, string binary")
    each = written(each, "suffix-strings")
    often = each.groupBy("anchor", "string").agg(
        F.sum("copies").alias("copies"), F.min("low").alias("low"), F.max("high").alias("high")).where(repeated).select("anchor", "string")
    one = F.struct(F.col("at").alias("a"), (F.col("at") + 1).alias("b"))
    return each.join(often, ["anchor", "string"], "left_semi").groupBy("anchor", "digest").agg(F.collect_list(one).alias("runs"))


def repeated_strings(docs: DataFrame, length: int = LENGTH, hot: int = HOT_SNIPPETS, id_col: str = "doc_id", text_col: str = "text",
                     words: int = WORDS) -> DataFrame:
    """``doc_id``, ``text_hash``, ``spans`` (start, end in bytes; may overlap) of repeated strings and ``passages`` (in words, from
    0; may overlap) of stretches of ``words`` words that a document of another id has; texts without either are absent."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    every = written(snippets(texts, length, words), "suffix-anchors")
    document = F.coalesce("doc_id", F.lit(-1 << 63))
    # repeated: bytes at another place, words in another document
    ends, repeated = (F.min(document).alias("low"), F.max(document).alias("high")), F.expr("if(words, low < high, copies > 1)")
    # the counts are a table of their own: then the join reads plain shuffles, of which a hot anchor's part can be split
    often = written(every.groupBy("anchor").agg(F.count("*").alias("times")).where("times > 1").select("anchor"), "suffix-often")
    # hashing the few, of which a key has one, saves sorting all
    every = written(every.join(often.hint("shuffle_hash"), "anchor", "left_semi"), "suffix-repeated")
    kinds = every.groupBy("anchor", "words", "digest").agg(
        F.count("*").alias("copies"), *ends, F.min(F.struct("doc_id", "text_hash", "first", "n")).alias("at"))
    sizes = kinds.groupBy("anchor", "words").agg(
        F.sum("copies").alias("copies"), F.min("low").alias("low"), F.max("high").alias("high"), F.count("*").alias("variants"))
    kinds = written(kinds.join(sizes.where(repeated).select("anchor", "words", "variants"), ["anchor", "words"]), "suffix-kinds")
    same = kinds.where("variants = 1").where(repeated).select(
        "anchor", "digest", F.array(F.struct(F.lit(0).alias("a"), F.col("at.n").alias("b"))).alias("runs"), "words")
    held = ("anchor", "digest", "words", "copies", "low", "high", "variants")
    fetched = kinds.where("variants > 1").groupBy(F.col("at.doc_id").alias("d"), F.col("at.text_hash").alias("h")).agg(
        F.collect_list(F.struct(*held, F.col("at.first").alias("first"), F.col("at.n").alias("n"))).alias("wanted"))
    # of rows that repeat id and text, each would give the same snippets
    source = texts.join(fetched, texts["doc_id"].eqNullSafe(fetched["d"]) & (texts["text_hash"] == fetched["h"]))
    schema = pa.schema([*((c, pa.bool_() if c == "words" else pa.int64()) for c in held), ("snippet", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = as_bytes(rows.column(0))
            for a, b in slices(texts, SCAN_BYTES):
                part = rows.column(1).slice(a, b - a)
                wanted = dict(zip((*held, "first", "n"), part.flatten().flatten()))
                by_word, first, n = (wanted[c].to_numpy(zero_copy_only=False) for c in ("words", "first", "n"))
                owner = np.repeat(np.arange(a, b), part.value_lengths().to_numpy())
                asked = np.unique(owner[by_word])
                hashed, counts = word_hashes([texts[i] for i in asked.tolist()], _SPACES)
                keys = stretch_hashes(hashed, words)
                begin = np.zeros(len(texts), np.int64)
                begin[asked] = np.cumsum(counts) - counts
                start = first + np.where(by_word, begin[owner], 0)
                yield batch(schema, [*(wanted[c] for c in held), [
                    keys[s : s + k].tobytes() if w else texts[o][s : s + k + length - 1]
                    for w, o, s, k in zip(by_word.tolist(), owner.tolist(), start.tolist(), n.tolist())]])

    found = source.select("text", "wanted").mapInArrow(cut, f"{', '.join(f'{c} boolean' if c == 'words' else f'{c} long' for c in held)}, snippet binary")
    found = written(found, "suffix-snippets").dropDuplicates(["anchor", "words", "digest"])

    def of_bytes(rows: pa.Table) -> list[np.ndarray]:
        return repeated_in_shard(rows.column("anchor").to_pylist(), as_bytes(rows.column("snippet")), rows.column("copies").to_pylist(), length)

    def of_words(rows: pa.Table) -> list[np.ndarray]:
        return shared_in_shard(as_bytes(rows.column("snippet")), rows.column("low").to_numpy(), rows.column("high").to_numpy())

    def strings(text: bytes) -> list[bytes]:
        view = memoryview(text)
        return [xxhash.xxh3_128_digest(view[p : p + length]) for p in range(len(text) - length + 1)]

    def stretches(keys: bytes) -> list[bytes]:
        return [keys[p : p + 8] for p in range(0, len(keys), 8)]

    marked = same
    for by_word, marks, each, twice in ((False, of_bytes, strings, "copies > 1"), (True, of_words, stretches, "low < high")):
        mine = found.where(F.col("words") == by_word)
        few = sharded(mine.where(F.col("variants") <= hot), marks)
        many = by_hash(mine.where(F.col("variants") > hot), each, F.expr(twice))
        marked = marked.unionByName(few.unionByName(many).withColumn("words", F.lit(by_word)))
    marked = written(marked.where(F.size("runs") > 0), "suffix-marked")
    last = F.when(F.col("words"), words - 1).otherwise(length - 1)
    span = F.transform("runs", lambda r: F.struct((F.col("first") + r["a"]).alias("start"), (F.col("first") + r["b"] + last).alias("end")))
    return every.join(marked, ["anchor", "words", "digest"]).select("doc_id", "text_hash", "words", span.alias("spans")).groupBy(
        "doc_id", "text_hash").agg(F.flatten(F.collect_set(F.when(~F.col("words"), F.col("spans")))).alias("spans"),
                                   F.flatten(F.collect_set(F.when(F.col("words"), F.col("spans")))).alias("passages"))


def joined_up(spans: list[dict[str, int]] | None) -> list[list[int]]:
    """Spans in order, with those that overlap or touch made one."""
    joint: list[list[int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
        if joint and start <= joint[-1][1]:
            joint[-1][1] = max(joint[-1][1], end)
        else:
            joint.append([start, end])
    return joint


def without_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT_SNIPPETS, id_col: str = "doc_id", text_col: str = "text",
                    words: int = WORDS) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``spans`` (maximal removed runs, in bytes), ``kept`` (the other bytes) and ``passages`` (maximal
    runs of words in stretches of ``words`` words that a document of another id has too), one row per input row.

    A string that starts at two places of the input, in one text or two, is removed at both, overlaps included. Null texts are
    empty; rows that repeat a text remove each other; ids may be null or repeat. An empty table gives no rows. Words are divided by
    spaces and tab to carriage return and numbered from 0; a passage stays where it holds no repeated string. Rows without an id are one document.
    """
    found = repeated_strings(docs, length, hot, id_col, text_col, words)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = found.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "spans", "passages")
    joined = texts.join(found, texts["doc_id"].eqNullSafe(found["d"]) & (texts["text_hash"] == found["h"]), "left")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", kind), ("kept", pa.binary()), ("passages", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts, out, kept = as_bytes(rows.column(1)), [], []
            for text, spans in zip(texts, rows.column(2).to_pylist()):
                joint = joined_up(spans)
                edges = [0, *(x for pair in joint for x in pair), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                out.append([{"start": a, "end": b} for a, b in joint])
            passages = [[{"start": a, "end": b} for a, b in joined_up(p)] for p in rows.column(3).to_pylist()]
            yield batch(schema, [rows.column(0), [len(t) for t in texts], out, kept, passages])

    spans = "array<struct<start:long,end:long>>"
    return joined.select("doc_id", "text", "spans", "passages").mapInArrow(
        run, f"doc_id long, n_bytes long, spans {spans}, kept binary, passages {spans}")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``n_bytes`` is the size before the removal; ``text`` and ``n_chars`` are what is left. A character of which bytes are
    removed shows as U+FFFD there. ``n_passage_words`` counts words of the whole text in passages of over 50 words that another
    document has too, removed or not."""
    rows = without_repeats(table(spark, sf_dir, "documents"))
    size = F.aggregate("passages", F.lit(0).cast("long"), lambda total, p: total + p["end"] - p["start"])
    return rows.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"), size.alias("n_passage_words")).withColumn(
            "n_chars", F.char_length("text").cast("long"))
