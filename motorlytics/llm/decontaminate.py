"""Benchmark decontamination by spaced-seed hashing.

Each mask picks some of the words in a short window and ignores the others, so a seed survives a substitution at an ignored
place, and masks of different shape survive different ones. Test and training texts are hashed with the same masks. A
bitmap of fixed size lets training texts drop windows that no test item has; what stays is joined on the exact hash. Each
hit gives a diagonal (place in the document less place in the item). An overlap starts and ends in equal words, and at most
a fifth of its words differ. Whether there is one shows in the words around the hit (see ``reach``): documents and items that
share a hash bring these to a group, hot hashes to several, and are compared there in blocks. No pair leaves a group: per
hit its best item and the number of places it is linked to do, so a phrase that all items share costs a document no more
rows than any other. The overlap is measured for the best item of a document, along the whole diagonal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlytics.llm.common import as_bytes, batch, free_name, prepare, slices, table
from motorlytics.session import written

# 1: the word counts, 0: it doesn't. Wherever at most a fifth of 13 or more words differ, one of MASKS meets none of these (any
# such stretch has a part of 13 to 25 words of which at most a fifth differ). SHORT_MASKS do the same for items of 4 to 12 words.
MASKS = ("1101111", "11010001011", "1101100011", "1011111")
SHORT_MASKS = ("1111", "11011", "11101", "10111")
# An overlap counts from this many words on, or if it covers a shorter item; at most a fifth of its words differ.
LEAST_WORDS = 13
MISMATCH_COST = 4
BITMAP_BITS = 24
# A group has about as many hits of documents, and a hash brings it at most about as many places of items; blocks bound its memory.
HITS_PER_GROUP, PLACES_PER_GROUP = 20_000, 2_000
PAIRS_PER_BLOCK = 1 << 15
# Beyond the ends of a document and of an item; no two of these are equal.
DOC_PAD, ITEM_PAD = 0, 1

_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; a worker keeps the longest list it needed."""
    if len(_powers.get(base, ())) < n:
        made = np.ones(1, np.uint64)
        while len(made) < n:
            made = np.concatenate([made, made * np.uint64(pow(base, len(made), 1 << 64))])
        _powers[base] = made
    return _powers[base]


def stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes], fold: bytes = _FOLD) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of the texts (A-Z lower-cased; letters, digits and non-ASCII), and the words per text.

    Words are polynomials of their bytes, read off prefix sums, so the work is a few passes over the bytes. Another ``fold``
    says what each byte counts as: 32 divides words, and no byte may become 0.
    """
    raw = np.frombuffer((b" ".join(texts) + b" ").translate(fold), np.uint8)
    inside = raw != 32
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.cumsum(raw * powers(_BASE, len(raw))[: len(raw)], dtype=np.uint64)
    before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    hashed = stirred((sums[ends - 1] - before) * powers(_INVERSE, len(raw))[starts])
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(starts, text_ends)
    return hashed, np.diff(upto, prepend=0)


def seeds(words: np.ndarray, counts: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the mask at every word whose window stays within its text, and the numbers of these words."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.full(n, int(mask, 2), np.uint64)
    for i, bit in enumerate(mask):
        if bit == "1":
            total += words[i : i + n] * np.uint64((_BASE * (2 * i + 1)) & 0xFFFFFFFFFFFFFFFF)
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(text[:n] == text[len(mask) - 1 :])
    return stirred(total[at]), at


def places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of the bitmap that a seed sets."""
    return (hashes >> np.uint64(64 - BITMAP_BITS)).astype(np.int64), (hashes & np.uint64((1 << BITMAP_BITS) - 1)).astype(np.int64)


def item_tables(benchmark: DataFrame, item_col: str, text_col: str, masks: tuple[str, ...], short: tuple[str, ...],
                least_words: int) -> tuple[DataFrame, DataFrame]:
    """``item_id, words`` and ``hash, item_id, place, b0, b1`` of the test items."""
    schema = pa.schema([("item_id", pa.int64()), ("words", pa.list_(pa.int64()))])
    seed_schema = pa.schema([("hash", pa.int64()), ("item_id", pa.int64()), ("place", pa.int64()), ("b0", pa.int64()), ("b1", pa.int64())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = as_bytes(rows.column(1))
            for a, b in slices(texts):
                words, counts = word_hashes(texts[a:b])
                each = np.split(words.view(np.int64), np.cumsum(counts)[:-1])
                yield batch(schema, [rows.column(0).slice(a, b - a), each])

    def seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for item, words in zip(rows.column(0).to_pylist(), rows.column(1)):
                words = np.array(words.as_py(), np.int64).view(np.uint64)
                for mask in masks if len(words) >= least_words else short:
                    hashes, at = seeds(words, np.array([len(words)]), mask)
                    yield batch(seed_schema, [hashes.view(np.int64), [item] * len(at), at, *places(hashes)])

    source = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    items = written(source.mapInArrow(hashed, "item_id long, words array<long>").distinct(), "benchmark-items")
    made = items.mapInArrow(seeded, "hash long, item_id long, place long, b0 long, b1 long")
    return items, written(made.distinct(), "benchmark-seeds")


def bitmap(seed_rows: DataFrame) -> np.ndarray:
    """Which bits some seed sets: 2**BITMAP_BITS bits, or-ed by Spark, whatever the number of test items."""
    bits = seed_rows.select(F.explode(F.array("b0", "b1")).alias("bit")).groupBy(F.shiftright("bit", 5).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 32 AS int))")).alias("bits"))
    out = np.zeros(1 << (BITMAP_BITS - 5), np.uint32)
    for word, value in bits.toLocalIterator():
        out[word] = value
    return out


def overlap(doc: np.ndarray, item: np.ndarray, diagonal: int) -> tuple[int, int, int]:
    """(matches, first, end) of the best run on a diagonal, in places of the item; a mismatch costs MISMATCH_COST matches."""
    low, high = max(0, -diagonal), min(len(item), len(doc) - diagonal)
    if high <= low:
        return 0, 0, 0
    same = doc[low + diagonal : high + diagonal] == item[low:high]
    score = np.concatenate([[0], np.cumsum(np.where(same, 1, -MISMATCH_COST))])
    lowest = np.minimum.accumulate(score)
    end = int(np.argmax(score - lowest))
    first = int(np.flatnonzero(score[: end + 1] == lowest[end])[-1])
    return int(same[first:end].sum()), low + first, low + end


def tolerant(doc: np.ndarray, item: np.ndarray, diagonal: int) -> tuple[int, int, int]:
    """(matches, first, end) of the longest stretch of a diagonal from match to match with at most one mismatch to MISMATCH_COST matches."""
    low, high = max(0, -diagonal), min(len(item), len(doc) - diagonal)
    if high <= low or not (same := doc[low + diagonal : high + diagonal] == item[low:high]).any():
        return 0, 0, 0
    score = np.concatenate([[0], np.cumsum(np.where(same, 1, -MISMATCH_COST))])
    starts, ends = np.flatnonzero(same), np.flatnonzero(same) + 1
    highest = np.maximum.accumulate(score[ends][::-1])[::-1]  # from each end on; it falls
    last = ends[np.searchsorted(-highest, -score[starts], "right") - 1]
    k = int(np.argmax(last - starts))
    first, end = int(starts[k]), int(last[k])
    return int(same[first:end].sum()), low + first, low + end


def measured(doc: np.ndarray, item: np.ndarray, diagonal: int, least_words: int) -> tuple[int, int, int]:
    """(matches, first, end) of the overlap on a diagonal that has one; an item of fewer than ``least_words`` words is its own."""
    if len(item) < least_words:
        return int((doc[diagonal : diagonal + len(item)] == item).sum()), 0, len(item)
    best = overlap(doc, item, diagonal)
    return best if best[2] - best[1] >= least_words else tolerant(doc, item, diagonal)


def reach(least_words: int) -> int:
    """How far around a hit an overlap shows.

    A stretch from match to match of at least twice ``5/4 * least_words`` words can be halved; one half has no larger share of
    mismatches, and what is left of it after its mismatches at the cut is long enough. So the shortest overlaps are below that.
    """
    return 2 * -(-5 * least_words // 4) - 2


def around(words: Column, place: Column, n: int, pad: int) -> Column:
    """The words up to ``n`` places before and after a place; ``pad`` stands before the first word, nothing after the last."""
    before = F.array_repeat(F.lit(pad).cast("long"), F.greatest(n - place, F.lit(0)).cast("int"))
    start = F.greatest(place - n, F.lit(0)).cast("int")
    return F.concat(before, F.slice(words, start + 1, (place + n + 1 - start).cast("int")))


def windows(column: pa.ChunkedArray, width: int, pad: int) -> np.ndarray:
    lengths = pc.list_value_length(column).to_numpy()
    out = np.full((len(column), width), pad, np.int64)
    out[np.arange(width) < lengths[:, None]] = pc.list_flatten(column).to_numpy()
    return out


def overlapping(same: np.ndarray, least_words: int) -> np.ndarray:
    """Which rows have a stretch of ``least_words`` or more from match to match with at most a fifth of mismatches."""
    out = np.zeros(len(same), bool)
    some = np.flatnonzero(same.sum(1) * (MISMATCH_COST + 1) >= least_words * MISMATCH_COST)
    same = same[some]
    score = np.cumsum(np.where(same, np.int16(1), np.int16(-MISMATCH_COST)), axis=1, dtype=np.int16)
    ends = np.where(same, score, np.int16(-(1 << 14)))
    highest = np.maximum.accumulate(ends[:, ::-1], axis=1)[:, ::-1]
    starts = same.shape[1] - least_words + 1  # the score before a match is one less than with it
    out[some] = (same[:, :starts] & (highest[:, least_words - 1 :] >= score[:, :starts] - 1)).any(1)
    return out


def linked(least_words: int):
    """Compares the hits of documents and the places of items of a group: per hit that overlaps, its best item and the number of places."""
    n = reach(least_words)
    names = ("doc_id", "text_hash", "hash", "place", "alike", "item_id", "diagonal", "item_places")
    schema = pa.schema([(name, pa.int64()) for name in names])

    def compare(docs: pa.Table, items: pa.Table) -> pa.Table:
        docs, items = docs.sort_by("hash"), items.sort_by([("hash", "ascending"), ("item_id", "ascending")])
        if not len(docs) or not len(items):
            return schema.empty_table()
        left, right = windows(docs["near"], 2 * n + 1, DOC_PAD), windows(items["near"], 2 * n + 1, ITEM_PAD)
        place, size, weight = (items[c].to_numpy() for c in ("place", "size", "places"))
        hashes, keys = docs["hash"].to_numpy(), items["hash"].to_numpy()
        low, high = np.searchsorted(keys, hashes), np.searchsorted(keys, hashes, "right")
        upto = np.cumsum(high - low)
        out, a = [], 0
        while a < len(left):
            done = upto[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(upto, done + PAIRS_PER_BLOCK, "right")))
            d = np.repeat(np.arange(a, b), (high - low)[a:b])
            i = np.arange(len(d)) - (upto[d] - (high - low)[d] - done) + low[d]
            same = left[d] == right[i]
            good = (size[i] >= least_words) & overlapping(same, least_words)
            for k in np.flatnonzero(size[i] < least_words):  # the whole item, inside the document
                span = slice(n - place[i[k]], n - place[i[k]] + size[i[k]])
                inside = not (left[d[k], span] == DOC_PAD).any()
                good[k] = inside and (size[i[k]] - same[k, span].sum()) * (MISMATCH_COST + 1) <= size[i[k]]
            d, i, alike = d[good], i[good], same[good].sum(1)
            first = np.flatnonzero(np.diff(d, prepend=-1))
            if len(first):
                ranked = np.lexsort((i, -alike, d))[first]  # the smallest item of those most alike
                out.append((d[first], i[ranked], alike[ranked], np.add.reduceat(weight[i], first)))
            a = b
        if not out:
            return schema.empty_table()
        d, i, alike, places = (np.concatenate(x) for x in zip(*out))
        chosen, items = docs.take(d), items.take(i)
        return pa.table([chosen["doc_id"], chosen["text_hash"], chosen["hash"], chosen["place"], pa.array(alike), items["item_id"],
                         pc.subtract(chosen["place"], items["place"]), pa.array(places)], schema=schema)

    return compare, ", ".join(f"{name} long" for name in names)


def leaks(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, short: tuple[str, ...] = SHORT_MASKS,
          least_words: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", hits_per_group: int = HITS_PER_GROUP, places_per_group: int = PLACES_PER_GROUP) -> DataFrame:
    """One row per document that overlaps with a test item: ``doc_id``, ``text_hash``, ``item_id`` (of the item most alike around
    a hit, the smallest of several), ``item_words``, ``overlap_words``, ``matches``, ``first_word``, ``last_word`` (in the
    document, from 0), ``item_first`` and ``item_places``, the most places in test items that one hit overlaps with.

    Rows that repeat id and text are reported once. Null texts have no words; null ids are ids like any other. Items of
    fewer words than the shortest mask have no seed and are never reported. Empty tables give no rows.
    """
    prepare(docs.sparkSession)
    spark = docs.sparkSession
    items, seed_rows = item_tables(benchmark, item_col, item_text_col, masks, short, least_words)
    shared = spark.sparkContext.broadcast(bitmap(seed_rows))
    some_short = not items.where(F.size("words").between(min(map(len, short)), least_words - 1)).isEmpty()
    used = masks + (short if some_short else ())
    kind = pa.struct([("hash", pa.int64()), ("place", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("words", pa.list_(pa.int64())), ("seeds", pa.list_(kind))])

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = shared.value
        is_set = lambda bit: (there[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1 == 1
        for rows in batches:
            texts = as_bytes(rows.column(2))
            for a, b in slices(texts):
                words, counts = word_hashes(texts[a:b])
                ends = np.cumsum(counts)
                found = []
                for mask in used:
                    hashes, at = seeds(words, counts, mask)
                    first, second = places(hashes)
                    some = np.flatnonzero(is_set(first))
                    some = some[is_set(second[some])]
                    found.append((hashes[some].view(np.int64), at[some]))
                hashes, at = (np.concatenate(x) for x in zip(*found))
                owner = np.searchsorted(ends, at, "right")
                for doc in np.unique(owner):
                    mine, start = owner == doc, int(ends[doc] - counts[doc])
                    pairs = [{"hash": h, "place": p} for h, p in zip(hashes[mine].tolist(), (at[mine] - start).tolist())]
                    yield batch(schema, [rows.column(0).slice(a + doc, 1), rows.column(1).slice(a + doc, 1),
                                         [words[start : ends[doc]].view(np.int64)], [pairs]])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = source.mapInArrow(hits, "doc_id long, text_hash long, words array<long>, seeds array<struct<hash:long,place:long>>")
    found = written(found.dropDuplicates(["doc_id", "text_hash"]), "benchmark-hits")
    # Per hash that both have: how many parts its hits and its places of items are dealt to. One row per hash of an item at most.
    shares = lambda n: F.ceil(F.col("count") / n).cast("int")
    sizes = written(
        found.select(F.explode("seeds.hash").alias("hash")).groupBy("hash").count().select("hash", F.col("count").alias("hits"), shares(hits_per_group).alias("doc_parts"))
        .join(seed_rows.groupBy("hash").count().select("hash", shares(places_per_group).alias("item_parts")), "hash"), "benchmark-hashes")
    groups = max(1, -(-(sizes.agg(F.sum("hits")).first()[0] or 0) // hits_per_group))
    keys = ["part", "doc_part", "item_part"]
    part, n = F.pmod("hash", F.lit(groups)).alias("part"), reach(least_words)
    dealt = lambda by, parts: F.pmod(F.xxhash64(*by), F.col(parts)).cast("int")
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    doc_side = (
        found.select("doc_id", "text_hash", "words", F.explode("seeds").alias("s")).select("doc_id", "text_hash", "s.hash", "s.place", "words")
        .join(sizes, "hash").select("doc_id", "text_hash", "hash", "place", around(F.col("words"), F.col("place"), n, DOC_PAD).alias("near"), part,
                                    dealt(["doc_id", "text_hash", "place"], "doc_parts").alias("doc_part"), each("item_parts").alias("item_part"))
    )
    size = F.size("words")
    item_side = (
        seed_rows.join(sizes, "hash").join(items.withColumnRenamed("item_id", "i"), F.col("item_id").eqNullSafe(F.col("i")))
        .select("hash", "item_id", "place", "doc_parts", "item_parts", around(F.col("words"), F.col("place"), n, ITEM_PAD).alias("near"),
                F.when(size < least_words, size).otherwise(least_words).cast("long").alias("size"))
        .groupBy("hash", "near", "size", "doc_parts", "item_parts").agg(F.min(F.struct("item_id", "place")).alias("it"), F.count(F.lit(1)).alias("places"))
        .select("hash", "near", "size", "places", "it.item_id", "it.place", part, each("doc_parts").alias("doc_part"),
                dealt(["near"], "item_parts").alias("item_part"))
    )
    by_hit = doc_side.groupBy(*keys).cogroup(item_side.groupBy(*keys)).applyInArrow(*linked(least_words))
    best = (
        by_hit.groupBy("doc_id", "text_hash", "hash", "place").agg(
            F.max(F.struct("alike", -F.col("item_id"), "item_id", "diagonal")).alias("to"), F.sum("item_places").alias("item_places"))
        .groupBy("doc_id", "text_hash").agg(F.max("to").alias("to"), F.max("item_places").alias("item_places"))
        .select("doc_id", "text_hash", "to.item_id", "to.diagonal", "item_places")
    )
    texts = found.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), F.col("words").alias("doc_words"))
    checked = best.join(items.withColumnRenamed("item_id", "i"), F.col("item_id").eqNullSafe(F.col("i"))).join(
        texts, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")))
    names = ("doc_id", "text_hash", "item_id", "item_words", "overlap_words", "matches", "first_word", "last_word", "item_first", "item_places")
    out_schema = pa.schema([(n, pa.int64()) for n in names])

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = []
            for doc, h, item, diagonal, places, words, text in zip(*(c.to_pylist() for c in rows.columns)):
                words, text = np.array(words, np.int64), np.array(text, np.int64)
                matches, first, end = measured(text, words, diagonal, least_words)
                out.append((doc, h, item, len(words), end - first, matches, first + diagonal, end - 1 + diagonal, first, places))
            yield batch(out_schema, list(zip(*out)) if out else [[]] * len(names))

    return checked.select("doc_id", "text_hash", "item_id", "diagonal", "item_places", "words", "doc_words").mapInArrow(
        verified, ", ".join(f"{n} long" for n in names))


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **search) -> DataFrame:
    """The rows of ``docs`` that overlap with no test item; columns stay."""
    ids, hashes, own = (free_name(docs, n) for n in ("leak_id", "leak_hash", "own_hash"))
    found = leaks(docs, benchmark, id_col=id_col, text_col=text_col, **search).select(
        F.col("doc_id").alias(ids), F.col("text_hash").alias(hashes))
    marked = docs.withColumn(own, F.xxhash64(text_col))
    return marked.join(found, marked[id_col].eqNullSafe(found[ids]) & (marked[own] == found[hashes]), "left_anti").select(*docs.columns)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")
