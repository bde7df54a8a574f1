"""Splits and classifier quality measures that stay distributed."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values: share of the test side and the seed of the split ---
TEST_SHARE, SPLIT_SEED = 0.2, 42
# --- end of fixed values ---

_SCORE_BUCKETS = 1024


def encode_category(df: DataFrame, column: str, output: str) -> DataFrame:
    """Number the distinct values of ``column`` from 0 in alphabetical order.

    The values are the classes of a fleet configuration; the join broadcasts them only when small.
    """
    codes = df.select(column).distinct().withColumn(
        output, F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy(column)) - 1
    )
    return df.join(codes, df[column].eqNullSafe(codes[column]), "left").select(df["*"], codes[output])


def encode_known(df: DataFrame, column: str, output: str, values: tuple[str, ...]) -> DataFrame:
    """Number the given values from 0 in alphabetical order; any other value, or none, has the next number.

    One expression: nothing is counted, sorted or joined, however many other values the messages bring.
    """
    code = F.lit(len(values))
    for number, value in enumerate(sorted(values)):
        code = F.when(F.col(column) == value, number).otherwise(code)
    return df.withColumn(output, code)


def stratified_split(df: DataFrame, label: str = "is_at_risk", key: str = "vehicle_id",
                     test_share: float = TEST_SHARE, seed: int = SPLIT_SEED) -> DataFrame:
    """Add ``is_test``: per label, exactly the first ``ceil(share * n)`` rows by a seeded hash of the key.

    The exact rank comes from two levels: rows before a hash prefix (65,536 prefixes, so a small table)
    plus the rank inside the prefix. No label, however frequent, is ordered in one task. Rows without a label are
    a stratum of their own, and a missing key counts as an empty one, so every row stays.
    """
    hashed = df.withColumn("_hash", F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(F.col(key).cast("string"), F.lit("")))))
    hashed = hashed.withColumn("_prefix", F.substring("_hash", 1, 4))
    sizes = hashed.groupBy(label, "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    by_prefix = Window.partitionBy(label).orderBy("_prefix")
    before = sizes.select(
        F.col(label).alias("_label"), F.col("_prefix").alias("_from"),
        F.coalesce(F.sum("_n").over(by_prefix.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(label)).alias("_label_rows"),
    )
    inside = Window.partitionBy(label, "_prefix").orderBy("_hash", key)
    ranked = hashed.withColumn("_rank", F.row_number().over(inside)).join(
        before, F.col(label).eqNullSafe(F.col("_label")) & (F.col("_prefix") == F.col("_from")))
    is_test = F.col("_before") + F.col("_rank") <= F.ceil(F.col("_label_rows") * F.lit(float(test_share)))
    return ranked.select(*df.columns, is_test.alias("is_test"))


def class_balance(df: DataFrame, label: str = "is_at_risk") -> DataFrame:
    """Counts of both labels and the weight that balances them (1 without positives)."""
    counts = df.agg(
        F.count(F.when(F.col(label) == 0, 1)).alias("negatives"),
        F.count(F.when(F.col(label) == 1, 1)).alias("positives"),
    )
    weight = F.when(F.col("positives") > 0, F.try_divide("negatives", "positives")).otherwise(1.0)
    return counts.withColumn("scale_pos_weight", weight)


def classification_report(scored: DataFrame, label: str = "is_at_risk", prediction: str = "risk_label") -> DataFrame:
    """Precision, recall, F1 and support per label, with accuracy, macro and weighted means.

    Everything follows from the label x prediction counts, so the rows are aggregated once.
    """
    pairs = scored.groupBy(F.col(label).alias("_y"), F.col(prediction).alias("_p")).agg(
        F.count(F.lit(1)).alias("_n"))
    totals = pairs.agg(*[
        F.coalesce(F.sum(F.when(test, F.col("_n"))), F.lit(0)).cast("double").alias(name)
        for value in (0, 1)
        for name, test in (
            (f"_hit{value}", (F.col("_y") == value) & (F.col("_p") == value)),
            (f"_said{value}", F.col("_p") == value),
            (f"_is{value}", F.col("_y") == value),
        )
    ])

    def share(part, whole):
        return F.when(whole > 0, part / whole).otherwise(0.0)

    size = F.col("_is0") + F.col("_is1")
    measures = {}
    for value in (0, 1):
        precision = share(F.col(f"_hit{value}"), F.col(f"_said{value}"))
        recall = share(F.col(f"_hit{value}"), F.col(f"_is{value}"))
        f1 = share(2 * F.col(f"_hit{value}"), F.col(f"_said{value}") + F.col(f"_is{value}"))
        measures[value] = (precision, recall, f1)
    accuracy = share(F.col("_hit0") + F.col("_hit1"), size)

    def row(name, precision, recall, f1, support):
        return F.struct(F.lit(name).alias("label"), precision.alias("precision"), recall.alias("recall"),
                        f1.alias("f1"), support.cast("long").alias("support"))

    rows = [row(str(v), *measures[v], F.col(f"_is{v}")) for v in (0, 1)]
    nothing = F.lit(None).cast("double")
    rows.append(row("accuracy", nothing, nothing, accuracy, size))
    rows.append(row("macro avg", *[(a + b) / 2 for a, b in zip(measures[0], measures[1])], size))
    rows.append(row("weighted avg", *[
        share(a * F.col("_is0") + b * F.col("_is1"), size) for a, b in zip(measures[0], measures[1])
    ], size))
    return totals.select(F.inline(F.array(*rows)))


def auc_roc(scored: DataFrame, label: str = "is_at_risk", score: str = "risk_probability") -> DataFrame:
    """Area under the ROC curve; equal scores count half. Rows without a score or label are left out and counted
    as ``skipped``; without rows of both labels the area is NULL.

    Rows first collapse to distinct scores. Those are cut at quantiles into buckets of similar size, so
    the running count of negatives is a bucket offset plus a running count inside each bucket.
    """
    value, known = F.col(score).cast("double"), F.col(label).isin(0, 1)
    counted = scored.groupBy(F.when(~F.isnan(value), value).alias("_score")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("_pos"),
        F.count(F.when(F.col(label) == 0, 1)).alias("_neg"),
        F.count(F.when(~F.coalesce(known, F.lit(False)), 1)).alias("_skipped"),
    )
    distinct, unscored = counted.where("_score IS NOT NULL"), counted.where("_score IS NULL")
    cuts = distinct.approxQuantile("_score", [i / _SCORE_BUCKETS for i in range(1, _SCORE_BUCKETS)],
                                   0.25 / _SCORE_BUCKETS)
    splits = [float("-inf"), *(sorted(set(cuts)) or [0.0]), float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol="_score", outputCol="_bucket").transform(distinct)
    in_bucket = Window.partitionBy("_bucket").orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = bucketed.withColumn("_lower", F.coalesce(F.sum("_neg").over(in_bucket), F.lit(0)))
    # Per bucket: pairs won against lower negatives of the same bucket, and both counts.
    per_bucket = ranked.groupBy("_bucket").agg(
        F.sum(F.col("_pos") * (F.col("_lower") + F.col("_neg") / 2)).alias("_won"),
        F.sum("_pos").alias("_pos"),
        F.sum("_neg").alias("_neg"),
        F.sum("_skipped").alias("_skipped"),
    ).unionByName(unscored.select(
        F.lit(-1.0).alias("_bucket"), F.lit(0.0).alias("_won"), F.lit(0).cast("long").alias("_pos"),
        F.lit(0).cast("long").alias("_neg"), (F.col("_pos") + F.col("_neg") + F.col("_skipped")).alias("_skipped")))
    # At most _SCORE_BUCKETS + 1 rows from here on.
    across = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    summed = per_bucket.withColumn("_below", F.coalesce(F.sum("_neg").over(across), F.lit(0))).agg(
        F.sum(F.col("_won") + F.col("_pos") * F.col("_below")).alias("_won"),
        F.sum("_pos").alias("positives"),
        F.sum("_neg").alias("negatives"),
        F.sum("_skipped").alias("skipped"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return summed.select(
        F.try_divide(F.col("_won"), pairs).alias("auc_roc"), "positives", "negatives", "skipped",
    )


