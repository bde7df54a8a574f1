"""WARC archives with a two-level capture index.

Records are gzip members of their own, so any record is a range of its file. The lower level of the index has a line per
capture, sorted by the URL with its host reversed, in compressed blocks; the upper level, a sparse directory, has the first
key and the range of each block. A lookup searches the bounds of the index files, then the directory of one file, then the
lines of one block by bisection, and reads one range of an archive per capture.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlytics.llm.common import batch, filesystem, many_partitions, table
from motorlytics.session import scratch_path, written

LEAST_SHARED_BYTES = 1000
BLOCK_LINES = 1000
GZIP_LEVEL = 4
DATE = "2024-01-01T00:00:00Z"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SAFE = "".join(map(chr, range(33, 127)))


def url_key(url: str | None) -> str:
    """The URL with its host reversed, by which captures of a domain stand together; no scheme, no fragment, no www."""
    try:
        parts = urllib.parse.urlsplit((url or "").strip())
        host = (parts.hostname or "").removeprefix("www.")
        port = f":{parts.port}" if parts.port else ""
    except ValueError:  # not a URL: its own key
        return urllib.parse.quote(url or "", safe=_SAFE)
    query = f"?{parts.query}" if parts.query else ""
    return urllib.parse.quote(f"{','.join(reversed(host.split('.')))}{port}){parts.path or '/'}{query}", safe=_SAFE)


def urn(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: bytes, size: int, refers_to: int | None, target: str | None) -> bytes:
    """A response or, with ``target`` set, a revisit record as a gzip member. The HTTP header tells the payload's full size."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = target is not None
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {urn(page_id)}", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {urllib.parse.quote(url or '', safe=_SAFE)}",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}"]
    if revisit:
        head += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: {urn(refers_to)}",
                 f"WARC-Refers-To-Target-URI: {urllib.parse.quote(target, safe=_SAFE)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(whole) + packer.flush()


def parsed(member: bytes) -> dict:
    """What a record says of its page."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    sizes = dict(line.lower().split(": ", 1) for line in http.decode().split("\r\n")[1:])
    number = lambda x: int(x[len("<urn:page:") : -1]) if x and x.startswith("<urn:page:") else None
    kind = fields["WARC-Type"]
    # a response is measured by what was read; a revisit holds no payload, and says what its original's is
    size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    if kind == "revisit":
        size, digest = int(sizes["content-length"]), base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex()
    return {"page_id": number(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "record_type": kind,
            "payload_bytes": size, "payload_digest": digest,
            "refers_to": number(fields.get("WARC-Refers-To")), "payload": payload if kind == "response" else None}


# --- writing ---


def with_originals(pages: DataFrame, least_bytes: int = LEAST_SHARED_BYTES) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``digest``, ``size``, ``refers_to`` and ``target`` (both null for responses).

    Of equal payloads of at least ``least_bytes``, the page with the largest id is the response (all rows with that id, if it
    repeats; rows without id if none has one), and the others refer to it.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumns({"digest": F.unhex(F.sha1("payload")), "size": F.octet_length("payload").cast("long")})
    shared = rows.where(F.col("size") >= least_bytes).groupBy("digest", "size").agg(
        F.max("page_id").alias("original"), F.max_by("url", "page_id").alias("original_url"), F.count("*").alias("n")).where("n > 1")
    shared = written(shared, "warc-shared")  # then the join reads plain shuffles, of which a hot payload's part can be split
    later = (F.col("original").isNotNull()) & ~F.col("page_id").eqNullSafe(F.col("original"))
    return rows.join(shared, ["digest", "size"], "left").select(
        "page_id", "url", F.when(later, F.lit(b"")).otherwise(F.col("payload")).alias("payload"), "digest", "size",
        F.when(later, F.col("original")).alias("refers_to"), F.when(later, F.coalesce("original_url", F.lit(""))).alias("target"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """A WARC file per task, and its captures: ``key``, ``url``, ``path``, ``offset``, ``length``.

    Files of a task that is run again get another name; only those of tasks that ended well are listed.
    """
    schema = pa.schema([("key", pa.string()), ("url", pa.string()), ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        out, at = None, 0
        path = f"{root}/pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        for rows in batches:
            out = out or store.open_output_stream(path, compression=None)
            lines = []
            for values in zip(*(c.to_pylist() for c in rows.columns)):
                member = record(*values)
                out.write(member)
                lines.append((url_key(values[1]), values[1], path, at, len(member)))
                at += len(member)
            if lines:
                yield batch(schema, list(zip(*lines)))
        if out:
            out.close()

    store, root = filesystem(folder)
    store.create_dir(root, recursive=True)
    rows = with_originals(pages).select("page_id", "url", "payload", "digest", "size", "refers_to", "target")
    return written(rows.mapInArrow(run, "key string, url string, path string, offset long, length long"), "warc-captures")


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Index files and their directory: ``shard``, ``block``, ``first_key``, ``last_key``, ``path``, ``offset``, ``length``."""
    names = ("shard", "block", "first_key", "last_key", "path", "offset", "length")
    schema = pa.schema(list(zip(names, (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        shard = TaskContext.get().partitionId()
        path = f"{root}/index-{shard:06d}-{uuid.uuid4().hex}.cdxz"
        lines: list[tuple[str, str]] = []
        out, at, block = None, 0, 0

        def flushed(some: list[tuple[str, str]]) -> pa.RecordBatch:
            nonlocal at, block
            packed = zlib.compress("\n".join(x for _, x in some).encode())
            out.write(packed)
            row = [[shard], [block], [some[0][0]], [some[-1][0]], [path], [at], [len(packed)]]
            at, block = at + len(packed), block + 1
            return batch(schema, row)

        for rows in batches:
            out = out or store.open_output_stream(path, compression=None)
            lines += [(k, f"{k} {json.dumps(rest)}") for k, *rest in zip(*(c.to_pylist() for c in rows.columns))]
            while len(lines) >= block_lines:
                yield flushed(lines[:block_lines])
                lines = lines[block_lines:]
        if lines:
            yield flushed(lines)
        if out:
            out.close()

    order = ["key", "path", "offset"]
    ordered = captures.repartitionByRange(many_partitions(captures.sparkSession), *order).sortWithinPartitions(*order)
    kinds = "shard int, block int, first_key string, last_key string, path string, offset long, length long"
    return written(ordered.select("key", "path", "offset", "length").mapInArrow(run, kinds), "warc-directory")


# --- reading ---


def lookup(directory: DataFrame, folder: str, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """``key``, ``path``, ``offset``, ``length`` of every capture of the given URLs; each URL counts once.

    The bounds of the index files are known to all tasks: as many pairs of keys as ``write_index`` had tasks. A file's
    directory and the keys that fall in its bounds meet in a task, which opens only blocks that can hold them.
    """
    bounds = sorted(tuple(r) for r in directory.groupBy("shard").agg(F.min("first_key"), F.max("last_key")).select(
        "min(first_key)", "max(last_key)", "shard").collect())
    lows = [b[0] for b in bounds]
    schema = pa.schema([("key", pa.string()), ("shard", pa.int32())])

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            keys, shards = [], []
            for key in {url_key(u) for u in rows.column(0).to_pylist()}:
                at = bisect.bisect_right(lows, key)
                while at and bounds[at - 1][1] >= key:  # a key with very many captures goes over several files
                    keys.append(key)
                    shards.append(bounds[at - 1][2])
                    at -= 1
            yield batch(schema, [keys, shards])

    def searched(blocks: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        store, _ = filesystem(folder)
        found, opened, at = [], None, -1
        blocks = blocks.sort_values("block")
        lasts, ranges = blocks["last_key"].tolist(), list(zip(blocks["first_key"], blocks["path"], blocks["offset"], blocks["length"]))
        lines: list[str] = []
        if len(keys) and len(ranges):
            opened = store.open_input_file(ranges[0][1])
        for key in sorted(keys["key"]) if opened else ():
            block = bisect.bisect_left(lasts, key)
            while block < len(ranges) and ranges[block][0] <= key:
                if block != at:
                    lines, at = zlib.decompress(opened.read_at(int(ranges[block][3]), int(ranges[block][2]))).decode().split("\n"), block
                line = bisect.bisect_left(lines, f"{key} ")
                while line < len(lines) and lines[line].startswith(f"{key} "):
                    found.append((key, *json.loads(lines[line][len(key) + 1 :])))
                    line += 1
                block += 1
        return pd.DataFrame(found, columns=["key", "path", "offset", "length"])

    asked = urls.select(url_col).mapInArrow(routed, "key string, shard int").distinct()
    return directory.groupBy("shard").cogroup(asked.groupBy("shard")).applyInPandas(searched, "key string, path string, offset long, length long")


RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def fetch(captures: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """The records of captures, one range read each; responses with their ``payload`` if asked for."""
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
    names = [x.split()[0] for x in RECORD.split(", ")] + ["payload"] * payload
    schema = pa.schema(list(zip(names, kinds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(folder)
        path, opened = None, None
        for rows in batches:
            out = []
            for where, offset, length in zip(*(c.to_pylist() for c in rows.columns)):
                if where != path:
                    path, opened = where, store.open_input_file(where)
                out.append(parsed(opened.read_at(length, offset)))
            yield batch(schema, [[r[n] for r in out] for n in names])

    spread = captures.select("path", "offset", "length").repartition(many_partitions(captures.sparkSession), "path", F.shiftright("offset", 22))
    return spread.sortWithinPartitions("path", "offset").mapInArrow(run, RECORD + ", payload binary" * payload)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, found by its URL. Null ids, urls and texts keep their rows; an empty table gives none."""
    pages, folder = table(spark, sf_dir, "pages"), scratch_path(spark, "warc")
    captures = write_archives(pages, folder)
    found = lookup(write_index(captures, folder), folder, pages)
    return fetch(found, folder, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS original FROM p)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= {LEAST_SHARED_BYTES} AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= {LEAST_SHARED_BYTES} AND page_id <> original THEN original END AS refers_to FROM g
"""
