"""Confusion counts and the scores derived from them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelsight.functions.columns import ratio


def confusion(
    scored: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Rows per true and predicted class, rows without a label left out."""
    return (
        scored.filter(F.col(label).isNotNull())
        .groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def accuracy(counts: DataFrame, model: str) -> DataFrame:
    right = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0)))
    return counts.agg(ratio(right, F.sum("n")).alias("accuracy")).select(
        F.lit(model).alias("model"), "accuracy"
    )


def scores(counts: DataFrame, model: str, positive: str) -> DataFrame:
    """Accuracy, precision, recall and F1 with a chosen positive class."""
    is_true, is_said = F.col("label") == positive, F.col("prediction") == positive
    n = F.col("n")

    def total(condition) -> object:
        return F.sum(F.when(condition, n).otherwise(F.lit(0)))

    hits = total(is_true & is_said)
    parts = counts.agg(
        ratio(total(F.col("label") == F.col("prediction")), F.sum(n)).alias("accuracy"),
        ratio(hits, total(is_said)).alias("precision"),
        ratio(hits, total(is_true)).alias("recall"),
    )
    p, r = F.col("precision"), F.col("recall")
    return parts.select(
        F.lit(model).alias("model"),
        "accuracy",
        "precision",
        "recall",
        ratio(F.lit(2.0) * p * r, p + r).alias("f1"),
    )


def compare(scored: Mapping[str, DataFrame], positive: str | None = None) -> DataFrame:
    """One row per model: accuracy, and the other scores if a positive class is given."""
    parts = []
    for name, rows in scored.items():
        counts = confusion(rows)
        parts.append(scores(counts, name, positive) if positive else accuracy(counts, name))
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table
