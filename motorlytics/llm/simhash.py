"""SimHash near-duplicates through Gray-order hierarchical indexes.

A text's fingerprint holds the majority of each bit over the hashes of its word shingles. Equal fingerprints are joined
first. Two fingerprints of at most d differing bits are found through keys: the bits are cut into blocks, and where there are
more blocks than d, two such fingerprints agree on a whole block (pigeonhole), so that nothing is missed. A key that
too many fingerprints share is cut again, by blocks of the remaining bits, until its bucket is small. With d blocks or fewer
a further cut would lose pairs, so such a key is dealt over parts instead, and each two parts make a bucket.

Within a bucket, fingerprints are sorted by their rank in Gray order, so that neighbours share long bit patterns. Groups of
neighbours become leaf nodes, groups of nodes upper nodes, and a node holds the bits on which all below it agree.
A search goes down from the bucket's root, adds up the differences on the shared bits, drops a node once they exceed d, and
accepts a whole node when even its open bits cannot exceed d.

What leaves a task is a forest (each fingerprint with one other of its class), so links cost as many rows as there are
fingerprints, not pairs. Classes that meet in several buckets are merged by rounds of star contraction over written tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlytics.llm.common import as_bytes, batch, free_name, prepare, slices, table
from motorlytics.session import written

FAN = 16
BUCKET_LIMIT = 20_000
CHUNK_ROWS = 40_000
FRONTIER = 1 << 20

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes, shingle: int, seed: int = 42) -> list[int]:
    """XXH64 of every run of ``shingle`` words, A-Z lower-cased and joined by spaces; of all words if they are fewer."""
    words = text.translate(_LOWER).split()
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = list(accumulate(len(w) + 1 for w in words))
    last = ends[shingle - 1 :] or ends[-1:]
    return [digest(joined[a : b - 1], seed) for a, b in zip([0, *ends], last)]


def mixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """Further 64 bits of a hash; word 0 is the hash itself."""
    if not word:
        return hashes
    x = hashes + np.uint64(word * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def majorities(hashes: np.ndarray, counts: np.ndarray, words: int = 1) -> np.ndarray:
    """One row of ``words`` 64-bit words per text: a bit is 1 if set in over half of the text's hashes.

    Eight bits are counted at once, one in each byte of a 64-bit lane, over runs of at most 255 hashes.
    """
    out = np.zeros((len(counts), words), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    n = counts[full]
    runs = -(-n // 255)
    first = np.cumsum(n) - n
    run_first = np.cumsum(runs) - runs
    within = np.arange(runs.sum()) - np.repeat(run_first, runs)
    starts = np.repeat(first, runs) + 255 * within
    for word in range(words):
        x = mixed(hashes, word)
        packed = np.zeros((len(full), 8), np.uint8)
        for bit in range(8):
            lanes = np.add.reduceat((x >> np.uint64(bit)) & _LANES, starts)
            ones = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), run_first, axis=0)
            packed |= (2 * ones > n[:, None]).astype(np.uint8) << bit
        out[full, word] = packed.view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, words: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash`` and ``fp`` (8 * ``words`` bytes, big-endian), one row per input row.

    Null and empty texts, and those without words, have the fingerprint zero. Null ids and repeated rows stay.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = as_bytes(rows.column(2))
            for a, b in slices(texts):
                each = [shingle_hashes(t, shingle) for t in texts[a:b]]
                counts = np.array([len(x) for x in each], np.int64)
                flat = np.fromiter((h for x in each for h in x), np.uint64, int(counts.sum()))
                made = majorities(flat, counts, words).astype(">u8")
                yield batch(schema, [rows.column(0).slice(a, b - a), rows.column(1).slice(a, b - a), [x.tobytes() for x in made]])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return source.mapInArrow(run, "doc_id long, text_hash long, fp binary")


# --- keys ---


def blocks(bits: list[int], n: int) -> list[list[int]]:
    cuts = [len(bits) * i // n for i in range(n + 1)]
    return [bits[a:b] for a, b in zip(cuts, cuts[1:])]


def refined(path: str, width: int, n_blocks: int) -> list[tuple[str, list[int]]]:
    """The keys below a path: further blocks, each with its path. A path names the blocks that were taken so far.

    Blocks always divide the bits that the path leaves open, so pigeonhole holds at each step.
    """
    open_bits = list(range(width))
    for step in path.split(".") if path else ():
        taken = set(blocks(open_bits, n_blocks)[int(step)])
        open_bits = [b for b in open_bits if b not in taken]
    return [(f"{path}.{i}" if path else str(i), bits) for i, bits in enumerate(blocks(open_bits, n_blocks)) if bits]


def with_keys(nodes: DataFrame, width: int, n_blocks: int) -> DataFrame:
    """``path``, ``key``, ``fp``: each fingerprint once per block below its path. ``key`` continues the key it has."""
    schema = pa.schema([("path", pa.string()), ("key", pa.int64()), ("fp", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            bits = np.unpackbits(np.frombuffer(b"".join(rows.column(2).to_pylist()), np.uint8).reshape(-1, width // 8), axis=1)
            paths, keys = np.array(rows.column(0).to_pylist(), object), rows.column(1).to_numpy(zero_copy_only=False)
            for path in dict.fromkeys(paths):
                at = np.flatnonzero(paths == path)
                for below, places in refined(path, width, n_blocks):
                    packed = np.packbits(bits[at][:, places], axis=1)
                    key = [xxhash.xxh64_intdigest(k.to_bytes(8, "big", signed=True) + p.tobytes()) for k, p in zip(keys[at].tolist(), packed)]
                    yield batch(schema, [[below] * len(at), np.array(key, np.uint64).view(np.int64), rows.column(2).take(pa.array(at))])

    return nodes.select("path", "key", "fp").mapInArrow(run, "path string, key long, fp binary")


# --- the index of a task ---


def gray_order(fps: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """The order of rows by bucket and then by rank in Gray order (each rank bit is the parity of the bits up to it)."""
    ranks, carry = [], np.zeros(len(fps), bool)
    for word in fps.T:
        x = word.copy()
        for shift in (1, 2, 4, 8, 16, 32):
            x ^= x >> np.uint64(shift)
        x = np.where(carry, ~x, x)
        carry = (x & np.uint64(1)).astype(bool)
        ranks.append(x)
    return np.lexsort([*ranks[::-1], buckets])


def levels(fps: np.ndarray, buckets: np.ndarray) -> list[dict]:
    """From the rows up to one node per bucket: shared bits, their values, first child and number of children."""
    made, all_and, all_or, owner = [], fps, fps, buckets
    first_row, end_row = np.arange(len(fps)), np.arange(1, len(fps) + 1)
    while True:
        new = np.r_[True, owner[1:] != owner[:-1]]
        begin = np.flatnonzero(new)
        within = np.arange(len(owner)) - np.repeat(begin, np.diff(np.r_[begin, len(owner)]))
        starts = np.flatnonzero(within % FAN == 0)
        sizes = np.diff(np.r_[starts, len(owner)])
        all_and, all_or = np.bitwise_and.reduceat(all_and, starts), np.bitwise_or.reduceat(all_or, starts)
        first_row, end_row = first_row[starts], end_row[starts + sizes - 1]
        owner = owner[starts]
        mask = ~(all_and ^ all_or)
        made.append({"value": all_and, "mask": mask, "open": np.bitwise_count(~mask).sum(1).astype(np.int64), "child": starts,
                     "n": sizes, "first": first_row, "end": end_row, "owner": owner})
        if len(np.unique(owner)) == len(owner):
            return made


def expanded(query: np.ndarray, child: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    total = np.repeat(np.arange(len(n)), n)
    return query[total], child[total] + np.arange(len(total)) - np.repeat(np.cumsum(n) - n, n)


def merged(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the classes of each pair; a class is named by its smallest row."""
    while True:
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            return labels
        a, b, low, high = a[apart], b[apart], np.minimum(la, lb)[apart], np.maximum(la, lb)[apart]
        np.minimum.at(labels, high, low)
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels = further


def classes(fps: np.ndarray, buckets: np.ndarray, most: int) -> np.ndarray:
    """For rows in Gray order: the smallest row of each row's class, over links of ``most`` bits within a bucket."""
    tree = levels(fps, buckets)
    labels = np.arange(len(fps))
    top = tree[-1]
    root = np.repeat(np.arange(len(top["n"])), top["end"] - top["first"])
    sizes = (top["end"] - top["first"])[root]
    step = max(1, FRONTIER // int(min(sizes.max(), FRONTIER)))
    cuts = [0]
    while cuts[-1] < len(fps):  # queries in blocks whose frontier stays bounded however many nodes they meet
        load = np.cumsum(sizes[cuts[-1] :])
        cuts.append(cuts[-1] + max(step, int(np.searchsorted(load, FRONTIER, "right"))))
    for low, high in zip(cuts, cuts[1:]):
        query = np.arange(low, min(high, len(fps)))
        node = root[query]
        for depth in range(len(tree) - 1, -1, -1):
            level = tree[depth]
            diff = np.bitwise_count((fps[query] ^ level["value"][node]) & level["mask"][node]).sum(1).astype(np.int64)
            near = (diff <= most) & (level["end"][node] > query + 1)
            whole = near & (diff + level["open"][node] <= most)
            if whole.any():
                labels = merged(labels, query[whole], level["first"][node[whole]])
                for k in np.unique(node[whole]):
                    inside = np.arange(level["first"][k], level["end"][k])
                    labels = merged(labels, inside[:-1], inside[1:])
            near &= ~whole
            query, node = expanded(query[near], level["child"][node[near]], level["n"][node[near]])
        near = (node > query) & (np.bitwise_count(fps[query] ^ fps[node]).sum(1) <= most)
        labels = merged(labels, query[near], node[near])
    return labels


def node_ids(fps: list[bytes]) -> np.ndarray:
    if fps and len(fps[0]) == 8:
        return np.frombuffer(b"".join(fps), ">u8").astype(np.uint64).view(np.int64)
    return np.array([xxhash.xxh64_intdigest(x) for x in fps], np.uint64).view(np.int64)


def forest(keyed: DataFrame, most: int) -> DataFrame:
    """``a``, ``b``: ids of linked fingerprints, as many rows as fingerprints at most. Needs whole buckets in a partition."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def linked(rows: pa.Table) -> pa.RecordBatch:
        raw = rows.column("fp").to_pylist()
        fps = np.frombuffer(b"".join(raw), ">u8").reshape(len(raw), -1).astype(np.uint64)
        buckets = rows.column("key").to_numpy()
        new = np.r_[True, buckets[1:] != buckets[:-1]]
        buckets = np.cumsum(new)
        lone = new & np.r_[new[1:], True]
        keep = np.flatnonzero(~lone)
        if not len(keep):
            return batch(schema, [[], []])
        keep = keep[gray_order(fps[keep], buckets[keep])]
        labels = classes(fps[keep], buckets[keep], most)
        ids = node_ids([raw[i] for i in keep])
        other = labels != np.arange(len(labels))
        return batch(schema, [ids[other], ids[labels[other]]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for part in batches:
            held.append(part)
            rows += part.num_rows
            if rows < CHUNK_ROWS:
                continue
            whole = pa.Table.from_batches(held)
            paths, keys = whole.column("path"), whole.column("key")
            same = (np.asarray(keys) == keys[-1].as_py()) & (np.asarray(paths) == paths[-1].as_py())
            cut = len(same) if same.all() else int(np.flatnonzero(~same)[-1]) + 1
            if same.all():
                continue  # one bucket so far; it ends within BUCKET_LIMIT rows
            yield linked(whole.slice(0, cut))
            held, rows = whole.slice(cut).to_batches(), len(same) - cut
        if rows:
            yield linked(pa.Table.from_batches(held))

    return keyed.mapInArrow(run, "a long, b long")


def paired_parts(keyed: DataFrame, large: DataFrame, limit: int) -> DataFrame:
    """``keyed`` of the large keys (``path``, ``key``, ``count``) in buckets of about ``limit`` rows that hold any two of a key's rows.

    Rows are dealt by hash over parts of half that size, and each two parts make a bucket.
    """
    parts = F.ceil(F.col("count") * 2 / limit).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    with_part = keyed.join(large.select("path", "key", parts.alias("parts")), ["path", "key"]).withColumn("mine", mine)
    both = with_part.withColumn("other", F.explode(F.expr("filter(sequence(0, parts - 1), x -> x <> mine)")))
    bucket = F.concat_ws("-", "path", F.least("mine", "other"), F.greatest("mine", "other"))
    return both.select(bucket.alias("path"), "key", "fp")


def keyed_within(nodes: DataFrame, width: int, most: int, n_blocks: int, limit: int) -> list[DataFrame]:
    """Fingerprints under keys, in tables whose buckets hold about ``limit`` rows at most unless all their bits are used up.

    No pair that shares a key is lost: a key is cut by further blocks only where pigeonhole finds all its links again.
    """
    tables, rest = [], nodes.select(F.lit("").alias("path"), F.lit(0).cast("long").alias("key"), "fp")
    for _ in range(width):
        keyed = written(with_keys(rest, width, n_blocks), "simhash-keys")
        large = keyed.groupBy("path", "key").count().where(F.col("count") > limit)
        if large.isEmpty():
            return [*tables, keyed]
        large = written(large, "simhash-large")
        tables.append(keyed.join(large, ["path", "key"], "left_anti"))
        if n_blocks <= most:
            return [*tables, paired_parts(keyed, large, limit)]
        rest = keyed.join(large, ["path", "key"], "left_semi")
    return [*tables, rest]


def components(edges: DataFrame) -> DataFrame:
    """``id``, ``component``: the smallest id reachable, for every id in an edge. Alternating star contraction.

    Each round is a written table, so that lost executors cost one round; a star's centre is joined, never collected.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.explode(F.array(F.col("a"), F.col("b"))).alias("a"), F.col("low").alias("b"))
        edges = written(small.where("a <> b").distinct(), "links")
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:
            return edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id")
        before = after


def near_duplicates(docs: DataFrame, shingle: int = 3, words: int = 1, most: int = 2, n_blocks: int | None = None,
                    limit: int = BUCKET_LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash``, ``fp``, ``node`` (a number for the class) and ``component_id``, one row per input row.

    ``component_id`` is the smallest id of a document that is reachable over links of ``most`` bits, itself included; null
    ids count only if no other is there. With more than ``most`` blocks no link is missed (the default has one more);
    with fewer, a link is found if some block agrees wholly. Null, empty and repeated texts are linked like any
    other; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    width, n_blocks = 64 * words, n_blocks or most + 1
    prints = written(fingerprints(docs, shingle, words, id_col, text_col), "fingerprints")
    one = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = [forest(t.repartition("path", "key").sortWithinPartitions("path", "key"), most)
             for t in keyed_within(one, width, most, n_blocks, limit)]
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    node = F.conv(F.hex("fp"), 16, -10).cast("long") if words == 1 else None
    if node is None:
        schema = pa.schema([("fp", pa.binary()), ("least", pa.int64()), ("id", pa.int64())])

        def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in batches:
                yield batch(schema, [rows.column(0), rows.column(1), node_ids(rows.column(0).to_pylist())])

        one = one.mapInArrow(number, "fp binary, least long, id long")
    else:
        one = one.withColumn("id", node)
    one = one.join(components(edges), "id", "left").withColumn("node", F.coalesce("component", "id")).select("fp", "node", "least")
    named = one.groupBy("node").agg(F.min("least").alias("component_id"))
    named = written(one.join(named, "node").select("fp", "node", "component_id"), "simhash-classes")
    return prints.join(named, "fp").select(
        "doc_id", "text_hash", "fp", "node", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **search) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class the one with the smallest id (null only if all are).

    Rows that repeat that id within the class count as one. Columns stay.
    """
    ids, hashes, own = (free_name(docs, n) for n in ("kept_id", "kept_hash", "own_hash"))
    rows = near_duplicates(docs, id_col=id_col, text_col=text_col, **search)
    kept = rows.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("node").agg(
        F.min_by(F.struct("doc_id", "text_hash"), F.col("text_hash")).alias("k")).select(
        F.col("k.doc_id").alias(ids), F.col("k.text_hash").alias(hashes))
    marked = docs.withColumn(own, F.xxhash64(text_col))
    joined = marked.join(kept, marked[id_col].eqNullSafe(kept[ids]) & (marked[own] == kept[hashes]), "left_semi")
    return joined.dropDuplicates([id_col, own]).select(*docs.columns)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, words=1, most=2)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
