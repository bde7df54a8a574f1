"""Registered text queries against their SQL, and the pipeline against a plain version."""

from __future__ import annotations

import re

import pytest
import tiktoken  # noqa: F401
import xxhash
from compare import difference, duck
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from conftest import SMALL
from motorlytics.llm import byte_bpe, decontaminate, quality_rules, registry
from motorlytics.llm.common import table


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_matches_sql(spark, name):
    assert difference(contract.queries()[name](spark, SMALL), duck(SMALL), registry.SQL[name]) is None


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_empty_tables(spark, name, tmp_path):
    for t in ("documents", "pages", "benchmark"):
        spark.read.parquet(f"{SMALL}/{t}.parquet").where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    result = registry.QUERIES[name](spark, str(tmp_path))
    assert result.count() == 0 and result.columns == registry.QUERIES[name](spark, SMALL).columns


def fingerprint(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_pipeline(spark):
    docs = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    kept = sorted(r.doc_id for r in quality_rules.judged(table(spark, SMALL, "documents")).where("kept").collect())
    prints = {i: fingerprint(docs[i]) for i in kept}
    least = {i: i for i in kept}
    for _ in kept:  # the smallest id reachable over links of two bits
        after = {i: min(least[j] for j in kept if (prints[i] ^ prints[j]).bit_count() <= 2) for i in kept}
        if after == least:
            break
        least = after
    fold = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", t.lower())
    items = [fold(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    leaked = {i for i in kept for item in items if f" {' '.join(item)} " in f" {' '.join(fold(docs[i]))} "}
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    firsts = {i for i in kept if least[i] == i}
    found = {r.doc_id for r in decontaminate.leaks(table(spark, SMALL, "documents"), table(spark, SMALL, "benchmark")).collect()}
    assert len(firsts) < len(kept) and leaked <= found and set(out) == firsts - found
    enc = byte_bpe.encoding()
    for i, r in out.items():
        text = enc.decode_bytes(r.ids).decode()
        assert r.n_tokens == len(r.ids) and (text == docs[i] or "[SECRET]" in text)


def test_stages_keep_the_columns_of_documents(spark):
    docs = table(spark, SMALL, "documents").withColumnRenamed("source", "origin")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_on_nulls_empty_texts_and_repeated_rows(spark):
    """A column named like the secret scan's own, null ids and texts, and a row that comes twice."""
    body = " ".join(f"the w{k} of" for k in range(40))
    rows = [(1, body, "x"), (1, body, "x"), (2, None, "y"), (3, "", "z"), (None, body, "n"), (4, f"{body} password = abcdefgh12345678", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, secrets string").withColumn("n_chars", F.length("text").cast("long"))
    stage = {name: lambda d, f=f: f(spark, d, SMALL) for name, f in corpus_pipeline.STAGES}
    ids = lambda d: sorted((r.doc_id for r in d.collect()), key=lambda i: (i is None, i))
    assert ids(stage["quality"](docs)) == [1, 1, 4, None]
    assert ids(stage["near_dedup"](docs)) in ([1, 2], [1, 2, 4])  # 2 and 3 are equal, and so are 1 and the row without id
    assert ids(stage["decontamination"](docs)) == [1, 1, 2, 3, 4, None]
    clean = {r.secrets: r for r in stage["secrets"](docs).collect()}
    assert clean["y"].text is None and clean["z"].text == "" and clean["n"].text == body
    assert "abcdefgh12345678" not in clean["s"].text and clean["s"].n_chars == len(clean["s"].text)
    tokens = [(r.doc_id, r.n_tokens) for r in stage["tokens"](docs).collect()]
    assert len(tokens) == 6 and {i for i, n in tokens if n == 0} == {2, 3}
