"""Boosted trees as a relation: fitted to counts of binned features, stored as a table of nodes, scored by joins down the nodes.

Fitting needs each vehicle once. Every feature is cut at up to 31 of its quantiles, and Spark counts vehicles per cell (a bin of
each feature) and label. That table has at most 32 ** 3 * 3 * 2 rows (three numeric features, three class numbers, two labels) however many
vehicles there are, so boosting over it fits in one task and still sees every vehicle with its weight. Gains and values
are those of second-order boosting with a logistic loss.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from motorlytics.operators.evaluation import class_balance
from motorlytics.plans.kpis import as_of_column
from motorlytics.plans.risk import CLASS_NUMBER, DEPTH, FEATURES, LEARNING_RATE, TREES, model_input, train_and_test
from motorlytics.schemas import PREDICTION_COLUMNS, PREDICTION_SCHEMA
from motorlytics.session import scratch_path, written
from motorlytics.sources.tables import is_empty, rebuild

# --- fixed values: the usual regularisation of such trees ---
LAMBDA, LEAST_HESSIAN, LEAST_GAIN = 1.0, 1.0, 1e-6
# --- end of fixed values ---

BINS = 32
ACCURACY = 100_000  # quantiles are exact up to as many vehicles; further on their rank is off by at most one in as many
GAIN_DECIMALS = 9  # gains that agree to here are ties: the first feature and the lowest cut win

# Node 0 is the root. Inner nodes have a feature, and children where it is at most the threshold, or above; leaves have a value,
# in log-odds. ``weight`` is what the training rows at a node weigh: their hessian, or for a Spark ML model their weight.
NODES = "tree int, node int, feature string, threshold double, left int, right int, value double, gain double, weight double"


def feature_values(rows: DataFrame) -> DataFrame:
    """The features as doubles, gaps filled, the class as its number."""
    filled = model_input(rows)
    return filled.withColumns({f: (F.expr(CLASS_NUMBER) if f == "vehicle_class" else F.col(f)).cast("double") for f in FEATURES})


def cut_points(values: DataFrame, bins: int = BINS) -> dict[str, list[float]]:
    """At most ``bins`` - 1 cuts per feature: its quantiles, each once."""
    ranks = [k / bins for k in range(1, bins)]
    found = values.agg(*[F.percentile_approx(f, ranks, ACCURACY).alias(f) for f in FEATURES]).first()
    return {f: sorted(set(found[f] or [])) for f in FEATURES}


def bin_of(feature: str, cuts: Sequence[float]) -> Column:
    """How many cuts lie below the value."""
    return sum((F.when(F.col(feature) > c, 1).otherwise(0) for c in cuts), F.lit(0))


def counted_cells(values: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    bins = [bin_of(f, cuts[f]).alias(f"bin_{n}") for n, f in enumerate(FEATURES)]
    return values.groupBy(*bins, F.col("is_at_risk").alias("label")).agg(F.count("*").alias("vehicles"))


def grown_trees(bins: np.ndarray, label: np.ndarray, weight: np.ndarray, n_cuts: list[int], trees: int, depth: int) -> Iterator[tuple]:
    """(tree, node, feature number or -1, cut number, value, gain, hessian) of boosting over cells."""
    margin = np.zeros(len(label))
    for tree in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        g, h = weight * (p - label), weight * p * (1.0 - p)
        node = np.zeros(len(label), int)
        for level in range(depth + 1):
            first, n = 2**level - 1, 2**level
            here = np.flatnonzero(node >= first)
            at = node[here] - first
            total_g, total_h = np.bincount(at, g[here], n), np.bincount(at, h[here], n)
            best = np.full(n, -np.inf)
            chosen = np.full((n, 2), -1)
            for f, cuts in enumerate(n_cuts if level < depth else []):
                where = at * (cuts + 1) + bins[here, f]
                left_g, left_h = (np.bincount(where, x[here], n * (cuts + 1)).reshape(n, -1).cumsum(axis=1)[:, :cuts] for x in (g, h))
                right_g, right_h = total_g[:, None] - left_g, total_h[:, None] - left_h
                gain = 0.5 * (left_g**2 / (left_h + LAMBDA) + right_g**2 / (right_h + LAMBDA) - (total_g**2 / (total_h + LAMBDA))[:, None])
                gain = np.where((left_h >= LEAST_HESSIAN) & (right_h >= LEAST_HESSIAN), gain, -np.inf).round(GAIN_DECIMALS)
                if cuts:
                    top = gain.argmax(axis=1)
                    better = gain[np.arange(n), top] > best
                    best[better] = gain[better, top[better]]
                    chosen[better] = np.column_stack([np.full(n, f), top])[better]
            chosen[best <= LEAST_GAIN] = -1
            value = -LEARNING_RATE * total_g / (total_h + LAMBDA)
            for k in np.unique(at).tolist():
                f, cut = chosen[k].tolist()
                yield tree, first + k, f, cut, value[k], best[k] if f >= 0 else 0.0, total_h[k]
            splits = chosen[at, 0] >= 0
            margin[here[~splits]] += value[at[~splits]]
            below, k = here[splits], at[splits]
            node[here[~splits]] = -1
            node[below] = 2 * node[below] + 1 + (bins[below, chosen[k, 0]] > chosen[k, 1])


def fit_trees(train: DataFrame, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> DataFrame:
    """The nodes of trees fitted to all of ``train``. At-risk vehicles weigh healthy / at-risk. Rows without a label don't count;
    without rows there are no nodes."""
    train = train.where(F.col("is_at_risk").isNotNull())
    values = feature_values(train)
    cuts = cut_points(values, bins)
    weight = class_balance(train).first()["scale_pos_weight"]
    names, n_cuts = [f"bin_{n}" for n in range(len(FEATURES))], [len(cuts[f]) for f in FEATURES]

    def boost(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = pd.concat(list(batches) or [pd.DataFrame(columns=[*names, "label", "vehicles"])]).sort_values([*names, "label"])
        if cells.empty:
            return
        label = cells["label"].to_numpy(float)
        weights = cells["vehicles"].to_numpy(float) * np.where(label == 1, weight, 1.0)
        rows = [(t, n, FEATURES[f] if f >= 0 else None, cuts[FEATURES[f]][cut] if f >= 0 else None, *((2 * n + 1, 2 * n + 2) if f >= 0 else (None, None)),
                 v, g, h) for t, n, f, cut, v, g, h in grown_trees(cells[names].to_numpy(int), label, weights, n_cuts, trees, depth)]
        out = pd.DataFrame(rows, columns=[part.split()[0] for part in NODES.split(", ")])
        yield out.astype({"left": "Int32", "right": "Int32"})

    return counted_cells(values, cuts).coalesce(1).mapInPandas(boost, NODES)


def nodes_of(model: PipelineModel) -> DataFrame:
    """The same relation for a fitted Spark ML model (``risk.fit_risk_model``), read from its stored form."""
    booster, session = model.stages[-1], SparkSession.active()
    path = scratch_path(session, "risk-model")
    booster.write().save(path)
    weights = session.createDataFrame(list(enumerate(booster.treeWeights)), "tree int, tree_weight double")
    data = session.read.parquet(f"{path}/data").selectExpr("treeID AS tree", "nodeData.*").join(F.broadcast(weights), "tree")
    inner, weight = F.col("leftChild") >= 0, F.get("impurityStats", F.lit(0))  # gains are stored per row
    # the booster's probability is that of twice its margin
    value = 2.0 * F.col("tree_weight") * F.col("prediction")
    return data.select(
        F.col("tree").cast("int"), F.col("id").alias("node"),
        F.when(inner, F.element_at(F.array(*map(F.lit, FEATURES)), F.col("split.featureIndex") + 1)).alias("feature"),
        F.when(inner, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        value.alias("value"), F.when(inner, F.col("gain") * weight).otherwise(0.0).alias("gain"), weight.alias("weight"))


def scored_by_nodes(nodes: DataFrame, features: DataFrame, key: str = "vehicle_id", trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """``features`` with ``risk_probability`` and ``risk_label``: each vehicle goes down every tree, one join per level.

    Nodes are broadcast: a forest has at most ``trees`` * (2 ** (``depth`` + 1) - 1) of them, about 6,300, however many vehicles it
    was fitted to. Trees are numbered from 0, and a missing one adds nothing; without any the probability is 0.5. ``key`` names
    one row of ``features``.
    """
    table = F.broadcast(nodes.select("tree", "node", "feature", "threshold", "left", "right", "value"))
    values = feature_values(features).select(F.col(key).alias("_key"), F.create_map(
        *[part for f in FEATURES for part in (F.lit(f), F.col(f))]).alias("_values"))
    at = values.select("_key", "_values", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).alias("node"))
    for _ in range(depth):
        there = at.join(table, ["tree", "node"])
        goes_left = F.col("_values")[F.col("feature")] <= F.col("threshold")
        child = F.when(F.col("feature").isNull(), F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        at = there.select("_key", "_values", "tree", child.alias("node"))
    margin = at.join(table, ["tree", "node"]).groupBy("_key").agg(F.sum("value").alias("_margin"))
    probability = 1.0 / (1.0 + F.exp(-F.coalesce("_margin", F.lit(0.0))))
    joined = features.join(margin, features[key].eqNullSafe(margin["_key"]), "left")
    return joined.select(features["*"], probability.alias("risk_probability")).withColumn(
        "risk_label", (F.col("risk_probability") > 0.5).cast("int"))


def importance_from_nodes(nodes: DataFrame) -> DataFrame:
    """Per feature its number of splits and its share of all gain, a row for each feature."""
    every = nodes.sparkSession.createDataFrame([(f,) for f in FEATURES], "feature string")
    gains = nodes.where("feature IS NOT NULL").groupBy("feature").agg(F.count("*").alias("splits"), F.sum("gain").alias("_gain"))
    total = F.sum("_gain").over(Window.partitionBy(F.lit(0)))  # over one row per feature
    share = F.coalesce(F.try_divide(F.col("_gain"), total), F.lit(0.0))
    return every.join(gains, "feature", "left").select("feature", F.coalesce("splits", F.lit(0)).cast("long").alias("splits"), share.alias("importance"))


def fleet_predictions(nodes: DataFrame, features: DataFrame, predicted_at: dt.datetime | None = None) -> DataFrame:
    """The predictions contract for the whole fleet, stamped with the time of the run (or a given one) in whole seconds."""
    time = F.date_trunc("SECOND", as_of_column(predicted_at))
    return scored_by_nodes(nodes, features).withColumn("predicted_at", time).select(*PREDICTION_COLUMNS)


def refresh_predictions(features: DataFrame, path: str, predicted_at: dt.datetime | None = None, nodes: DataFrame | None = None
                        ) -> DataFrame | None:
    """Fit on a stored feature table (unless nodes are given), score the fleet, and replace the predictions at ``path``.

    Without any vehicle nothing is fitted or replaced, and the result is None.
    """
    if is_empty(features):
        return None
    if nodes is None:
        nodes = written(fit_trees(train_and_test(features)[0]), "risk-nodes")
    rebuild(fleet_predictions(nodes, features, predicted_at), path)
    return features.sparkSession.read.schema(PREDICTION_SCHEMA).parquet(path)
