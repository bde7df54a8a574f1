"""Removal of lines that many documents share: hash the lines, count documents per hash, drop by position, put together again.

Text crosses the network once, when a document meets the places of its dropped lines; everything before works on hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlytics.llm.common import table
from motorlytics.session import written

LEAST_CHARS = 20
LEAST_DOCS = 3
HOT_SHARE = 1000
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def key_of(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def hashed_lines(texts: DataFrame, least_chars: int) -> DataFrame:
    """``doc_id``, ``text_hash``, ``place`` and a 128-bit hash (``h``, ``k``) of each line whose key is long enough."""
    lines = texts.select("doc_id", "text_hash", F.posexplode(lines_of(F.col("text"))).alias("place", "line"))
    keys = lines.select("doc_id", "text_hash", "place", key_of(F.col("line")).alias("key")).where(F.char_length("key") >= least_chars)
    return keys.select("doc_id", "text_hash", "place", F.xxhash64("key").alias("h"), F.xxhash64(F.lit(1), "key").alias("k"))


def common_lines(lines: DataFrame, least_docs: int) -> DataFrame:
    """Hashes that enough documents hold, with the document that keeps its lines and the number of lines."""
    per_doc = lines.groupBy("h", "k", "doc_id").agg(F.count("*").alias("n"))  # a hot line is spread over its documents here
    counted = per_doc.groupBy("h", "k").agg(F.count("*").alias("holders"), F.max("doc_id").alias("keeper"), F.sum("n").alias("times"))
    return counted.where(F.col("holders") >= least_docs).drop("holders")


def dropped_places(lines: DataFrame, common: DataFrame, hot_share: int) -> DataFrame:
    """The lines to drop. Hashes with over 1 / ``hot_share`` of all common lines, of which there are fewer than ``hot_share``,
    are broadcast; the lines of the others meet their hash by a shuffle."""
    total = common.agg(F.sum("times")).first()[0] or 0
    is_hot = F.col("times") * hot_share > total
    hot = F.broadcast(common.where(is_hot).drop("times"))
    rare = lines.join(hot, ["h", "k"], "left_anti").join(common.where(~is_hot).drop("times"), ["h", "k"])
    found = lines.join(hot, ["h", "k"]).unionByName(rare)
    return found.where(~F.col("doc_id").eqNullSafe(F.col("keeper"))).select("doc_id", "text_hash", "place")


def without_common_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, id_col: str = "doc_id",
                         text_col: str = "text", hot_share: int = HOT_SHARE) -> DataFrame:
    """``doc_id``, ``n_lines`` (before dropping), ``n_dropped`` and ``kept`` (the text left), one row per input row.

    A line's key is the line without blanks at both ends and with A-Z in lower case. Lines whose key has ``least_chars`` code
    points and is in ``least_docs`` documents go, except in the document with the largest id that has the key, which keeps all of
    them. Rows with the same id are one document; null is an id, smaller than all others. A null or empty text is one empty
    line. Rows that repeat give rows that repeat; an empty table gives no rows. Other columns of ``docs`` are not looked at.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.withColumn("text_hash", F.xxhash64("text"))  # tells rows that share an id apart
    lines = written(hashed_lines(texts, least_chars), "line-hashes")
    common = written(common_lines(lines, least_docs), "line-common")
    gone = dropped_places(lines, common, hot_share).groupBy("doc_id", "text_hash").agg(F.collect_set("place").alias("gone"))
    gone = gone.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t"), "gone")
    joined = texts.join(gone, texts["doc_id"].eqNullSafe(gone["d"]) & (texts["text_hash"] == gone["t"]), "left")
    parts = joined.select("doc_id", "text", lines_of(F.col("text")).alias("parts"), "gone")
    stay = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), "gone")  # keeps the order of the first array
    kept = F.array_join(F.transform(stay, lambda i: F.get("parts", i)), "\n")
    return parts.select(
        "doc_id", F.size("parts").cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("kept"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = without_common_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(l))) AS place, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keys AS (
  SELECT doc_id, place, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
  FROM lines),
common AS (
  SELECT key, max(doc_id) AS keeper FROM keys WHERE length(key) >= {LEAST_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {LEAST_DOCS}),
marked AS (
  SELECT doc_id, place, line, coalesce(doc_id <> keeper, false) AS gone FROM keys LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
