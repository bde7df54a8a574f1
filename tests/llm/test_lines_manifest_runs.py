"""Line removal, Merkle manifest and periodic runs against plain versions: nulls, empty and long texts, ties, repeats, clashing names."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from motorlytics.llm import line_dedup, merkle, periodic_runs
from motorlytics.session import written


def same(df, columns, expected):
    assert collections.Counter(tuple(r) for r in df.select(*columns).collect()) == collections.Counter(expected)


# 11


def plain_lines(rows, least_chars=20, least_docs=3):
    fold = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    holders = collections.defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[fold(line)].add(i)
    keeper = {k: max(h, key=lambda i: (i is not None, i or 0)) for k, h in holders.items() if len(k) >= least_chars and len(h) >= least_docs}
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if keeper.get(fold(x), i) == i]
        yield i, len(lines), len(lines) - len(kept), "\n".join(kept)


def line_texts():
    rng = random.Random(3)
    stock = [f"  Standard notice number {k} of the site\t" for k in range(6)] + ["short", "", "ÄÖ" * 10, "x" * 19, "y" * 20]
    texts = ["\n".join(rng.choice([*stock, f"own line of text {d} {rng.random()}"]) for _ in range(rng.randint(1, 12))) for d in range(60)]
    rows = list(enumerate(texts)) + [(100 + k, "EVERY page says this, always\r\n" + "y" * 20 + "\n") for k in range(50)]
    rows += [(7, texts[8]), (7, texts[7]), (None, "every PAGE says this, always"), (None, None), (200, ""), (201, None), (202, "\n\n")]
    return rows + [(300, "every page says this, always\n" * 20_000 + "end"), (301, "every page says this, always ")]


@pytest.mark.parametrize("hot_share", [1, 4, 1000])
def test_line_dedup(spark, hot_share):
    rows = line_texts()
    docs = spark.createDataFrame([(i, t, "c", 1, 2) for i, t in rows], "doc_id long, text string, text_hash string, place int, gone int")
    found = line_dedup.without_common_lines(docs, hot_share=hot_share)
    same(found, ["doc_id", "n_lines", "n_dropped", "kept"], plain_lines(rows))


def test_line_dedup_other_columns_and_limits(spark):
    rows = [(f"k{i}", t) for i, t in line_texts() if i is not None]
    docs = spark.createDataFrame(rows, "name string, body string")
    found = line_dedup.without_common_lines(docs, 5, 2, id_col="name", text_col="body")
    same(found, ["doc_id", "n_lines", "n_dropped", "kept"], plain_by_name(rows))
    assert line_dedup.without_common_lines(docs.where("false"), id_col="name", text_col="body").count() == 0


def plain_by_name(rows):
    order = {name: n for n, name in enumerate(sorted({i for i, _ in rows}))}
    back = {n: name for name, n in order.items()}
    return [(back[i], n, d, k) for i, n, d, k in plain_lines([(order[i], t) for i, t in rows], 5, 2)]


def test_line_dedup_counts_before_it_shuffles_and_joins_no_text_by_line(spark):
    rows = [(i, "a line that is in every document of all\n" + str(i)) for i in range(2000)]
    lines = written(line_dedup.hashed_lines(
        spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_hash", F.xxhash64("text")), 20), "t")
    assert lines.columns == ["doc_id", "text_hash", "place", "h", "k"]
    plan = line_dedup.common_lines(lines, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 4 and plan.count("Exchange hashpartitioning") == 2


# 12


def plain_hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    """Root, and per leaf its (place, siblings) from the bottom up."""
    paths, below, nodes = [[] for _ in leaves], [[k] for k in range(len(leaves))], list(leaves)
    while len(nodes) > 1:
        runs = [range(k, min(k + 3, len(nodes))) for k in range(0, len(nodes), 3)]
        for run in runs:
            for k in run:
                for leaf in below[k]:
                    paths[leaf].append((k - run[0], [nodes[o] for o in run if o != k]))
        below, nodes = [sum((below[k] for k in run), []) for run in runs], [plain_hash(*(nodes[k] for k in run)) for run in runs]
    return nodes[0], paths


def plain_manifest(rows, fields):
    """rows: dicts; yields id, leaf, subroot, root, path."""
    value = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r["source"]].append((r["doc_id"], plain_hash(*(value(r[f]) for f in fields))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[name] = plain_tree([leaf for _, leaf in groups[name]])
    root, upper = plain_tree([trees[name][0] for name in names])
    for name, up in zip(names, upper):
        for (i, leaf), path in zip(groups[name], trees[name][1]):
            yield i, leaf, trees[name][0], root, [*path, *up]


def manifest_rows():
    rng, rows = random.Random(1), []
    for source, n in [(None, 5), ("", 1), ("a", 81), ("b", 82), ("ü", 3), ("\U0001f600", 10), ("￿", 28), ("z", 200)]:
        rows += [dict(doc_id=len(rows) + rng.randint(0, 1) * 1000, source=source, lang=rng.choice([None, "de"]), n_chars=rng.choice([None, 3]),
                      text=rng.choice([None, "", "a\nb", "é" * k, "1:x"])) for k in range(n)]
    rows += [dict(rows[40]), dict(rows[40]), dict(rows[41], text="other"), dict(rows[7], doc_id=None), dict(rows[7], doc_id=None)]
    return rows


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest(spark, levels):
    rows = manifest_rows()
    docs = spark.createDataFrame([(*r.values(), "w", 1) for r in rows],
                                 "doc_id long, source string, lang string, n_chars int, text string, witness string, rank int")
    got = [(r.doc_id, r.leaf.hex(), r.subroot.hex(), r.root.hex(), [(p, [s.hex() for s in n]) for p, n in merkle.steps(r.witness)])
           for r in merkle.manifest(docs, levels=levels).collect()]
    key = lambda r: str(r)
    assert sorted(got, key=key) == sorted(plain_manifest(rows, merkle.FIELDS), key=key)


def test_manifest_shows_every_change(spark):
    rows = manifest_rows()[:60]
    docs = spark.createDataFrame([tuple(r.values()) for r in rows], "doc_id long, source string, lang string, n_chars int, text string")
    found = merkle.manifest(docs, carry={"length": F.length("text")}).collect()
    for r in found:
        assert merkle.folded(r.leaf, r.witness) == r.root
        assert merkle.folded(bytes(32), r.witness) != r.root
    checked = merkle.checked(merkle.manifest(docs).withColumn("claimed", F.when(F.col("doc_id") % 2 == 0, F.col("leaf")).otherwise(F.lit(bytes(32)))))
    assert all(r.verified == (r.doc_id % 2 == 0) for r in checked.collect())


def test_manifest_of_one_row_and_none(spark):
    docs = spark.createDataFrame([(1, "s", None, 1, "t")], "doc_id long, source string, lang string, n_chars int, text string")
    row = merkle.manifest(docs).first()
    assert row.leaf == row.subroot == row.root and row.witness == b""
    assert merkle.manifest(docs.where("false")).count() == 0


def test_tree_knows_a_witness_as_soon_as_its_run_closes():
    tree, leaves = merkle.Tree(), [bytes([k]) * 32 for k in range(5)]
    for leaf in leaves[:2]:
        tree.append(leaf)
    assert list(tree.witnesses) == [b"", b""]
    tree.append(leaves[2])
    assert [list(merkle.steps(bytes(w))) for w in tree.witnesses] == [[(k, leaves[:k] + leaves[k + 1 : 3])] for k in range(3)]
    for leaf in leaves[3:]:
        tree.append(leaf)
    assert tree.witnesses[3] == b"" and len(tree.open[0]) == 2
    root = tree.finish()
    assert all(merkle.folded(leaf, bytes(w)) == root for leaf, w in zip(leaves, tree.witnesses))


def test_a_block_of_fewer_nodes_reaches_the_level_that_later_appends_expect():
    leaves = [bytes([k]) * 32 for k in range(10)]
    whole = merkle.Tree()
    for leaf in leaves:
        whole.append(leaf)
    first, second, above = merkle.Tree(), merkle.Tree(), merkle.Tree()
    for leaf in leaves[:9]:
        first.append(leaf)
    second.append(leaves[9])
    above.append(first.finish(2))
    above.append(second.finish(2))
    assert whole.finish() == above.finish()


# 13


def plain_runs(words):
    """(start, period, length) of all runs, by the definition."""
    found = {}
    for p in range(1, len(words) // 4 + 1):
        start = 0
        for i in range(len(words) - p + 1):
            if i == len(words) - p or words[i] != words[i + p]:
                if i - start + p >= max(6, 4 * p):
                    found.setdefault((start, i - start + p), p)
                start = i + 1
    return sorted((s, p, n) for (s, n), p in found.items())


def plain_collapsed(words, runs):
    return [w for i, w in enumerate(words) if not any(s + p <= i < s + n for s, p, n in runs)]


def run_texts():
    rng, rows = random.Random(8), []
    for k in range(150):
        letters = "ab" if k % 3 else "abcdefgh"
        words = []
        while len(words) < rng.choice([0, 5, 40, 200]):
            piece = [rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 30]))]
            words += piece * rng.choice([1, 1, 2, 3, 4, 5, 9])
            words += words[-rng.randint(1, 9) :] if rng.random() < 0.3 else []
        rows.append((k, rng.choice([" ", "\n", " \t "]).join(words)))
    long = [f"w{k}" for k in range(700)]
    rows += [(200, " ".join(long * 5 + long[:123])), (201, "a " * 6000), (202, " ".join([*"ab" * 3000, "x", *"abc" * 2000])), (203, None), (204, ""),
             (205, " \n "), (None, "a b a b a b a b"), (200, "b b b b b b"), (None, "b b b b b"), (206, "x y " * 3)]
    return rows


@pytest.mark.parametrize("tile", [1, 16, 1024])
def test_periodic_runs(spark, tile):
    rows = run_texts()
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, row string, period int")
    expected = []
    for i, text in rows:
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        if len(words) < 5000:
            runs = plain_runs(words)
        else:
            runs = [(0, 1, 6000)] if i == 201 else [(0, 2, 6000), (6001, 3, 6000)]
        expected.append((i, len(words), hashlib.sha256(" ".join(words).encode()).hexdigest(), tuple(runs) or None))
    got = [(r.doc_id, r.n_words, r.sha256, r.runs and tuple(tuple(x) for x in r.runs)) for r in periodic_runs.periodic_runs(docs, tile=tile).collect()]
    assert collections.Counter(got) == collections.Counter(expected)
    assert any(r[3] and len(r[3]) > 3 for r in expected)


def test_digests(spark):
    rows = [(i, t) for i, t in run_texts() if i != 201 and i != 202]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = []
    for i, text in rows:
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        runs = plain_runs(words)
        best = max(runs, key=lambda r: (r[2] / r[1], -r[0], -r[1]), default=None)
        four = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
        expected.append((i, len(runs), *four, plain_hash(*(f"{s},{n},{p}\n" for s, p, n in runs)), plain_hash(" ".join(plain_collapsed(words, runs)))))
    found = periodic_runs.digests(periodic_runs.periodic_runs(docs))
    same(found, ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"], expected)


def test_runs_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert periodic_runs.digests(periodic_runs.periodic_runs(docs)).count() == 0


def test_z_function():
    rng = random.Random(4)
    for _ in range(300):
        words = [rng.randint(0, 1) for _ in range(rng.randint(0, 30))]
        expected = [0] + [next((k for k in range(len(words) - i) if words[k] != words[i + k]), len(words) - i) for i in range(1, len(words))]
        assert periodic_runs.z_function(words) == expected[: len(words)]


def test_text_of_one_repeated_word_gives_one_period_only():
    codes = np.zeros(200_000, np.int32)
    total = 0
    for size, first, bounds, part in periodic_runs.tiles(codes):
        found = list(periodic_runs.solved(size, bounds.tolist(), part.tolist()))
        assert {p for p, _, _ in found} <= {1}
        total += len(found)
    assert total <= 200_000 / 1024 + 1
