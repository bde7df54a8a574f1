"""Periodic runs: stretches of words that repeat with some period at least four times over.

A document is tiled once per octave of periods (B <= period < 2 B): boundaries stand every B words, a tile has several of them
and the words around. A tile is solved alone. At a boundary, the Z-function of what follows tells for each period how far
words equal those a period later, the Z-function of what comes before, read backwards, how far this reaches to the
left; both look as far as the next boundaries only. The fragments of a document and period then meet and are stitched to runs.

A long enough run has two neighbouring blocks of B words, from boundary to boundary, that come again a period later. Hashes of
blocks rule out most boundaries, and tiles without any are not made.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from motorlytics.llm.common import CRC32_SQL, as_bytes, batch, many_partitions, prepare, table
from motorlytics.session import written

REPEATS, LEAST_WORDS = 4, 6
TILE = 1024
PART_WORDS = 1 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)


def z_function(words: list[int]) -> list[int]:
    """For each place, how many words from there on equal those at the start."""
    n = len(words)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and words[k] == words[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def boundaries(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Per octave, B and the boundaries at which two neighbouring blocks may come again within it."""
    n, size = len(codes), 1
    hashes = (codes.astype(np.uint64) + np.uint64(1)) * _STEP
    hashes ^= hashes >> np.uint64(29)
    while REPEATS * size <= n and n >= LEAST_WORDS:
        blocks = (n - size) // size  # those with a whole block B words later
        later = np.zeros(blocks * size, np.uint64)
        found = hashes[size : size + blocks * size]
        later[: len(found)] = found
        again = later.reshape(blocks, size) == hashes[: blocks * size : size, None]
        both = (again[:-1] & again[1:]).any(axis=1)
        marked = np.flatnonzero(np.r_[both, False] | np.r_[False, both])
        if len(marked):
            yield size, marked * size
        hashes = hashes[:-size] * _STEP + hashes[size:]
        hashes ^= hashes >> np.uint64(31)
        size *= 2


def tiles(codes: np.ndarray, tile: int = TILE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """B, number of the first word, boundaries as places in the tile, words."""
    for size, marked in boundaries(codes):
        step = max(tile, 4 * size)
        for group in np.split(marked, np.flatnonzero(np.diff(marked // step)) + 1):
            first = max(int(group[0]) - size, 0)
            yield size, first, group - first, codes[first : int(group[-1]) + 4 * size]


def solved(size: int, bounds: list[int], words: list[int]) -> Iterator[tuple[int, int, int]]:
    """Fragments of a tile: period, and from where to where words equal those a period later. A period counts only if the
    words of one period aren't repetitions themselves; then the whole run has a smaller one."""
    joint: dict[int, list[int]] = {}
    for c in bounds:
        right = words[c : c + 4 * size]
        z = z_function(right)
        found = [p for p in range(size, min(2 * size, len(right))) if z[p] >= size]
        if not found:
            continue
        reach = np.maximum.accumulate(np.arange(1, len(right)) + np.array(z[1:])) if len(right) > 1 else np.zeros(0, int)
        smallest = np.searchsorted(reach, found) + 1
        found = [p for p, q in zip(found, smallest.tolist()) if q >= p or p % q]
        lefts: list[int] | None = None
        low = max(c - size, 0)
        for p in found:
            end, last = c + min(z[p], 2 * size), joint.get(p)
            if last and last[1] >= c:
                last[1] = max(last[1], end)
                continue
            if lefts is None:
                upper = min(c + 2 * size, len(words))
                lefts = z_function(words[low:c][::-1] + [-1] + words[low:upper][::-1])
            start = c - lefts[c - low + 1 + upper - c - p]
            if last and last[1] >= start:
                last[1] = end
                continue
            if last:
                yield p, last[0], last[1]
            joint[p] = [start, end]
    for p, (start, end) in joint.items():
        yield p, start, end


_TILED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("sha256", pa.string()), ("words", pa.string()),
                    ("size", pa.int32()), ("first", pa.int64()), ("bounds", pa.list_(pa.int32())), ("codes", pa.list_(pa.int32()))])
TILED = "row long, doc_id long, n_words long, sha256 string, words string, size int, first long, bounds array<int>, codes array<int>"


def tiled(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """A row per document (``size`` 0; its words joined by spaces, if it has a tile, and their digest) and one per tile."""

    def rows_of(row: int, doc_id: int | None, text: bytes) -> Iterator[tuple]:
        words = text.split()  # at the six blanks of ASCII
        codes, any_tile = np.array(list(map({}.setdefault, words, itertools.count())), np.int32), False
        for size, first, bounds, part in tiles(codes, tile):
            any_tile = True
            yield row, None, None, None, None, size, first, bounds, part
        joined = b" ".join(words)
        yield row, doc_id, len(words), hashlib.sha256(joined).hexdigest(), joined.decode() if any_tile else None, 0, 0, None, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            held: list[tuple] = []
            weight = 0
            for row, doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), as_bytes(rows.column(2))):
                for made in rows_of(row, doc_id, text):
                    held.append(made)
                    weight += len(made[-1]) if made[-1] is not None else len(made[4] or ()) // 4
                    if weight > PART_WORDS:
                        yield batch(_TILED, list(zip(*held)))
                        held, weight = [], 0
            if held:
                yield batch(_TILED, list(zip(*held)))

    return docs.mapInArrow(run, TILED)


_FRAGMENTS = pa.schema([("row", pa.int64()), ("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def fragments(found: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = [(row, p, first + start, first + end)
                   for row, size, first, bounds, codes in zip(*(c.to_pylist() for c in rows.columns))
                   for p, start, end in solved(size, bounds, codes)]
            if out:
                yield batch(_FRAGMENTS, list(zip(*out)))

    return found.select("row", "size", "first", "bounds", "codes").mapInArrow(run, "row long, period long, start long, end long")


def stitched(parts: DataFrame) -> DataFrame:
    """Runs: fragments of a document and period that touch become one; those long enough stay."""
    order = Window.partitionBy("row", "period").orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("new", F.coalesce((F.col("start") > reached).cast("int"), F.lit(1)))
    parts = parts.withColumn("number", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = parts.groupBy("row", "period", "number").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    runs = runs.select("row", "start", (F.col("end") + F.col("period") - F.col("start")).alias("length"), "period")
    return runs.where(F.col("length") >= F.greatest(F.lit(LEAST_WORDS), REPEATS * F.col("period")))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """``doc_id``, ``n_words``, ``sha256`` (of the words joined by single spaces), ``runs`` (``start``, ``period``, ``length``, in order;
    null if there are none) and ``words`` (joined; null for most documents without runs), one row per input row.

    A run has a smallest period q, at least 6 and 4 q words, and can't be made longer. Runs may overlap. A null text has no words.
    Ids may be null or repeat; each row is a document. An empty table gives no rows. Other columns are not looked at.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    every = written(tiled(texts, tile), "runs-tiles")
    # tiles of a long document spread over tasks, whose number is given since tiles are small for the work they make
    found = every.where("size > 0").repartition(many_partitions(docs.sparkSession), "row", "size", "first")
    runs = stitched(fragments(found)).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    return every.where("size = 0").select("row", "doc_id", "n_words", "sha256", "words").join(runs, "row", "left").drop("row")


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """Words that are in no run (start, period, length) or among the first ``period`` words of each run they are in."""
    edges = np.zeros(len(words) + 1, np.int64)
    for start, period, length in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [w for w, covered in zip(words, np.cumsum(edges).tolist()) if not covered]


_DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
                      ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])


def digests(rows: DataFrame) -> DataFrame:
    """Per document the number of runs, the one with the largest exponent, and digests of all runs and of the text without repetitions."""

    def summary(sha256: str, text: str | None, found: list[dict] | None) -> tuple:
        if not found:
            return 0, None, None, None, None, hashlib.sha256(b"").hexdigest(), sha256
        runs = [(r["start"], r["period"], r["length"]) for r in found]
        start, period, length = max(runs, key=lambda r: (Fraction(r[2], r[1]), -r[0], -r[1]))
        listed = "".join(f"{s},{n},{p}\n" for s, p, n in runs)
        rest = " ".join(collapsed(text.split(" "), runs))
        return (len(runs), start, length, period, 1000 * length // period,
                hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(rest.encode()).hexdigest())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            out = [summary(*r) for r in zip(*(part.column(c).to_pylist() for c in ("sha256", "words", "runs")))]
            yield batch(_DIGESTS, [part.column("doc_id"), *zip(*out)])

    return rows.select("doc_id", "sha256", "words", "runs").mapInArrow(
        run, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")


def with_planted_tails(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; where 10 divides h = crc32 of the id, words from a = g % n on (g = h // 10) repeat those from a on
    with period 1 + (n - a) // (3 + g % 8). Rows without an id keep their text."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[ \t\n\x0B\f\r]+"), lambda w: w != "")
    chosen = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    chosen = chosen.withColumn("n", F.size("words").cast("long"))
    chosen = chosen.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    chosen = chosen.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    copied = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("words", place(i).cast("int")))
    return chosen.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), F.array_join(copied, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(periodic_runs(with_planted_tails(table(spark, sf_dir, "documents"))))


SQL = rf"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS l, {CRC32_SQL} AS h FROM documents),
sized AS (SELECT doc_id, l, h, len(l) AS n, h // 10 AS g FROM split),
tailed AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM sized),
texts AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN l
    ELSE list_transform(range(n), lambda i: l[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS l
  FROM tailed),
words AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(l) AS word FROM texts),
again AS (
  SELECT x.doc_id, y.i - x.i AS p, x.i FROM words x JOIN words y
  ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM again),
found AS (
  SELECT doc_id, p, min(i) AS start, count(*) + p AS length FROM islands GROUP BY doc_id, p, island
  HAVING count(*) + p >= greatest(6, 4 * p)),
runs AS (SELECT doc_id, start, length, min(p) AS period FROM found GROUP BY doc_id, start, length),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listing
  FROM runs GROUP BY doc_id),
-- length / period of different runs of a text differ by more than a double's error
best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
rest AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM words ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(listing, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN rest USING (doc_id)
"""
