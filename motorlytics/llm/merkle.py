"""Merkle manifest of a dataset: every row's digest, the roots over them, and for each row the siblings that lead to the root.

Trees have runs of ``WIDTH`` nodes. A task appends the leaves of one aligned block in order; subtrees that are still open
hold, for each leaf below, the part of its witness that is known, and each run that closes extends them. The root of a block is
appended to a further tree just as leaves are, until a group has one node; the groups' roots go to a last tree. Witnesses grow
downwards along the blocks, so no step joins more than a block of rows to one key, whatever the size of a group.

A witness is bytes: for each run on the way up one byte (place in the run * ``WIDTH`` + number of siblings) and the siblings'
digests from left to right, 32 bytes each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from motorlytics.llm.common import CRC32_SQL, batch, prepare, table
from motorlytics.session import written

WIDTH = 3
LEVELS = 6  # a block has WIDTH ** LEVELS = 729 nodes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(digests: Sequence[bytes]) -> bytes:
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


class Tree:
    """Nodes appended in order, with the witness of each as far as its open subtree knows it."""

    def __init__(self) -> None:
        self.witnesses: list[bytearray] = []
        self.open: list[list[tuple[bytes, range]]] = [[]]

    def append(self, digest: bytes) -> None:
        n = len(self.witnesses)
        self.witnesses.append(bytearray())
        self.open[0].append((digest, range(n, n + 1)))
        level = 0
        while len(self.open[level]) == WIDTH:
            self.close(level)
            level += 1

    def close(self, level: int) -> None:
        """The open run of a level becomes a node above; the leaves below it learn their siblings there."""
        run, self.open[level] = self.open[level], []
        digests = [digest for digest, _ in run]
        for place, (_, leaves) in enumerate(run):
            step = bytes([place * WIDTH + len(run) - 1]) + b"".join(digests[:place] + digests[place + 1 :])
            for leaf in leaves:
                self.witnesses[leaf] += step
        if level + 1 == len(self.open):
            self.open.append([])
        self.open[level + 1].append((digest_of(digests), range(run[0][1].start, run[-1][1].stop)))

    def finish(self, levels: int | None = None) -> bytes:
        """Close what is open, up to a level that later appends expect or else to the only node; its digest."""
        level = 0
        while True:
            above = any(self.open[level + 1 :])
            if not above and len(self.open[level]) == 1 and (levels is None or level == levels):
                return self.open[level][0][0]
            if self.open[level]:
                self.close(level)
            level += 1


def steps(witness: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """Place and siblings of each run, from the leaf up."""
    at = 0
    while at < len(witness):
        place, n = divmod(witness[at], WIDTH)
        yield place, [witness[at + 1 + 32 * k : at + 33 + 32 * k] for k in range(n)]
        at += 1 + 32 * n


def folded(leaf: bytes, witness: bytes) -> bytes:
    """The root that a leaf and its witness give."""
    for place, siblings in steps(witness):
        leaf = digest_of([*siblings[:place], leaf, *siblings[place:]])
    return leaf


def leaf_of(values: Sequence[Column]) -> Column:
    """Digest of a row: each value as its length in bytes, a colon and its text; ``-`` for null."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(part, values)), 256))


def ranked(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes`` with ``rank`` (by ``order`` within ``grp``, from 0) and ``total`` (nodes of the group).

    Rows are dealt by ranges of all keys and a last one that tells equal rows apart, so neither a large group nor rows that repeat
    land in one task. What is summed up over a group are its counts per task.
    """
    nodes = nodes.withColumn("row_number", F.monotonically_increasing_id())
    keys = ["grp", *order, "row_number"]
    placed = nodes.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("row_number")
    placed = written(placed.withColumn("place", F.monotonically_increasing_id()), "merkle-placed")
    placed = placed.withColumn("part", F.shiftright("place", 33))
    parts = placed.groupBy("grp", "part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    group = Window.partitionBy("grp")
    parts = parts.select(F.col("grp").alias("g"), F.col("part").alias("p"), F.sum("n").over(group).alias("total"),
                         (F.sum("n").over(group.orderBy("part")) - F.col("n") - F.col("first")).alias("shift"))
    return placed.join(parts, placed["grp"].eqNullSafe(parts["g"]) & (placed["part"] == parts["p"])).withColumn(
        "rank", F.col("place") + F.col("shift")).drop("g", "p", "shift", "place", "part")


def appended(nodes: DataFrame, levels: int) -> DataFrame:
    """``nodes`` (``grp``, ``rank``, ``total``, ``digest``, others) with ``block``, ``witness`` in the block and ``top``, its root."""
    size = WIDTH**levels
    nodes = nodes.withColumn("block", F.floor(F.col("rank") / size))
    names = nodes.columns

    def grow(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("rank").combine_chunks()
        tree = Tree()
        for digest in rows.column("digest").to_pylist():
            tree.append(digest)
        top = tree.finish(None if rows.column("total")[0].as_py() <= size else levels)
        rows = rows.select(names).append_column("witness", pa.array(map(bytes, tree.witnesses), pa.binary()))
        return rows.append_column("top", pa.array([top] * rows.num_rows, pa.binary()))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema.fields)
    return nodes.groupBy("grp", "block").applyInArrow(grow, f"{kinds}, witness binary, top binary")


def grown(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """One table per storey of blocks, leaves first; a group whose nodes fit in a block goes no further."""
    size, tables = WIDTH**levels, []
    while True:
        storey = written(appended(nodes, levels), "merkle-storey")
        tables.append(storey)
        if (storey.agg(F.max("total")).first()[0] or 0) <= size:
            return tables
        nodes = storey.where((F.col("rank") % size == 0) & (F.col("total") > size)).select(
            "grp", F.col("block").alias("rank"), F.ceil(F.col("total") / size).alias("total"), F.col("top").alias("digest"))


def roots(tables: list[DataFrame], levels: int) -> DataFrame:
    """``grp`` and ``digest`` of each group's root."""
    ends = [t.where((F.col("total") <= WIDTH**levels) & (F.col("rank") == 0)).select("grp", F.col("top").alias("digest")) for t in tables]
    return ends[0] if len(ends) == 1 else ends[0].unionByName(roots(tables[1:], levels))


def extended(tables: list[DataFrame], above: DataFrame, levels: int) -> DataFrame:
    """The leaves' table with whole witnesses. ``above``: per ``grp``, ``witness`` from its root on and columns to hand down."""
    handed = [c for c in above.columns if c not in ("grp", "witness")]
    ends = above.select(F.col("grp").alias("g"), F.lit(0).cast("long").alias("r"), F.col("witness").alias("further"), *handed)
    parents = ends
    for n, storey in reversed(list(enumerate(tables))):
        storey = storey.join(parents, storey["grp"].eqNullSafe(parents["g"]) & (storey["block"] == parents["r"]))
        storey = storey.withColumn("witness", F.concat("witness", "further")).drop("g", "r", "further")
        if n:
            passed = storey.select(F.col("grp").alias("g"), F.col("rank").alias("r"), F.col("witness").alias("further"), *handed)
            passed = written(passed, "merkle-witnesses")
            # groups that end below have their root in the last tree
            known = passed.select(F.col("g").alias("k")).where("r = 0")
            parents = passed.unionByName(ends.join(known, ends["g"].eqNullSafe(known["k"]), "left_anti"))
    return storey


def manifest(docs: DataFrame, group_col: str = "source", order_col: str = "doc_id", fields: Sequence[str] = FIELDS,
             levels: int = LEVELS, carry: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id`` (the order column), ``grp`` (the group's value), ``leaf``, ``subroot``, ``root``, ``witness`` as bytes, and columns of
    ``carry``; one row per input row.

    Groups are ordered by value, null first; so are rows in a group, and rows with equal ids by digest. Rows that repeat have
    equal leaves at neighbouring places and witnesses of their own. Null is a value of any field and told from the
    empty text. An empty table gives no rows. Fields not named don't count, whatever their names.
    """
    prepare(docs.sparkSession)
    carry = carry or {}
    nodes = docs.select(F.col(group_col).alias("grp"), F.col(order_col).alias("doc_id"), leaf_of([F.col(f) for f in fields]).alias("digest"),
                        *(c.alias(name) for name, c in carry.items()))
    tables = grown(ranked(nodes, ["doc_id", "digest"]), levels)
    tops = roots(tables, levels).select(F.lit(0).alias("grp"), F.col("grp").alias("value"), "digest")
    last = grown(ranked(tops, ["value"]), levels)
    top = roots(last, levels).select("grp", F.col("digest").alias("root"), F.lit(b"").alias("witness"))
    above = extended(last, top, levels).select(F.col("value").alias("grp"), F.col("digest").alias("subroot"), "root", "witness")
    rows = extended(tables, above, levels)
    return rows.select("doc_id", "grp", F.col("digest").alias("leaf"), "subroot", "root", "witness", *carry)


_CHECKED = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                      ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())])


def checked(rows: DataFrame) -> DataFrame:
    """Fold each ``claimed`` leaf along the witness of its row and compare with the root; digests as hex."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            out: list[list] = [[], [], []]
            for claimed, witness, root in zip(*(part.column(c).to_pylist() for c in ("claimed", "witness", "root"))):
                again = folded(claimed, witness)
                for column, value in zip(out, (digest_of([s for _, run in steps(witness) for s in run]).hex(), again.hex(), again == root)):
                    column.append(value)
            digests = ([d.hex() for d in part.column(c).to_pylist()] for c in ("leaf", "subroot", "root"))
            yield batch(_CHECKED, [part.column("doc_id"), *digests, *out])

    columns = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "leaf", "subroot", "root", "witness", "claimed")
    return columns.mapInArrow(run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row without an id is not tampered with."""
    docs = table(spark, sf_dir, "documents")
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    without = leaf_of([F.replace(F.col(f), F.lit("\n"), F.lit("")) if f == "text" else F.col(f) for f in FIELDS])
    rows = manifest(docs, carry={"tampered": F.when(odd & F.contains("text", F.lit("\n")), without)})
    return checked(rows.withColumn("claimed", F.coalesce("tampered", "leaf")))


def _sql_leaf(text: str) -> str:
    parts = [f"coalesce(octet_length(encode(CAST({f} AS VARCHAR))) || ':' || CAST({f} AS VARCHAR), '-')" for f in (*FIELDS[:-1], text)]
    return f"sha256({' || '.join(parts)})"


SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx, {_sql_leaf("text")} AS leaf,
         CASE WHEN {CRC32_SQL} % 2 = 0 THEN {_sql_leaf("replace(text, chr(10), '')")} ELSE {_sql_leaf("text")} END AS claimed
  FROM documents),
sub AS (
  SELECT source, 0 AS level, idx, leaf AS digest, count(*) OVER (PARTITION BY source) AS n FROM leaves
  UNION ALL
  SELECT source, level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), max((n + 2) // 3)
  FROM sub WHERE n > 1 GROUP BY source, level, idx // 3),
subroots AS (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM sub WHERE n = 1),
top AS (
  SELECT 0 AS level, place AS idx, subroot AS digest, n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), max((n + 2) // 3) FROM top WHERE n > 1 GROUP BY level, idx // 3),
siblings AS (
  SELECT doc_id, level, sub.idx AS k, leaves.idx // CAST(power(3, level) AS BIGINT) AS own, digest
  FROM leaves JOIN sub ON leaves.source IS NOT DISTINCT FROM sub.source AND n > 1
    AND sub.idx // 3 = leaves.idx // CAST(power(3, level + 1) AS BIGINT)
  UNION ALL
  SELECT doc_id, 1000 + level, top.idx, place // CAST(power(3, level) AS BIGINT), digest
  FROM leaves JOIN subroots ON leaves.source IS NOT DISTINCT FROM subroots.source
  JOIN top ON top.n > 1 AND top.idx // 3 = place // CAST(power(3, level + 1) AS BIGINT)),
steps AS (
  SELECT doc_id, level, coalesce(string_agg(digest, '' ORDER BY k) FILTER (k < own), '') AS a,
         coalesce(string_agg(digest, '' ORDER BY k) FILTER (k > own), '') AS b
  FROM siblings GROUP BY doc_id, level),
paths AS (
  SELECT doc_id, string_agg(a || b, '' ORDER BY level) AS proof, list({{'a': a, 'b': b}} ORDER BY level) AS path FROM steps GROUP BY doc_id),
folded AS (
  SELECT doc_id, leaf, subroot, (SELECT digest FROM top WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
         list_reduce(list_prepend({{'a': claimed, 'b': ''}}, coalesce(path, [])),
                     lambda x, s: {{'a': sha256(s.a || x.a || s.b), 'b': ''}}).a AS folded_root
  FROM leaves JOIN subroots ON leaves.source IS NOT DISTINCT FROM subroots.source LEFT JOIN paths USING (doc_id))
SELECT *, folded_root = root AS verified FROM folded
"""
