"""From raw documents to token ids: quality rules, near-duplicates, decontamination, secrets, encoding.

Each stage takes what its predecessor kept. All but the last return the columns of documents, and further columns of the input
stay whatever their names. An empty table passes every stage as an empty one, and texts of any length are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlytics.llm import byte_bpe, decontaminate, quality_rules, secret_scan, simhash
from motorlytics.llm.common import prepare, table
from motorlytics.session import scratch_path

def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go, so null and empty texts do; repeated rows and null ids are judged by their text alone."""
    return quality_rules.good_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays: three-word shingles, 64 bits, at most two differ.

    Null and empty texts are equal, a null id stays only where its group has no other, and rows that repeat an id in a group are one.
    """
    prepare(spark)
    return simhash.one_of_each(docs, shingle=3, words=1, most=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go; null and empty texts overlap with none, and repeated rows go or stay together."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text, and ``n_chars`` follows; no document goes, repeated rows stay, and a null text stays null."""
    clean = secret_scan.without_secrets(docs)
    changed = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return clean.withColumns(changed).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` per row; the ids decode to the text's bytes. Null and empty texts have no ids."""
    prepare(spark)
    rows = byte_bpe.encode(docs)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]

# SQL has neither the fingerprints nor the tokenizer; tests compare with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared scratch folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
