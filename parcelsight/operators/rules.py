"""Association rules among the categorical attributes of reviews."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelsight.functions.columns import at_least
from parcelsight.sources.scratch import staged

SEPARATOR = "\u0001"


def review_labels(reviews: DataFrame) -> DataFrame:
    """Two-level labels of accuracy, availability, discount and rating.

    Thresholds and labels are fixed values; a missing score gets the low label.
    """
    return reviews.select(
        at_least("order_accuracy", 4, "HighAccuracy", "LowAccuracy").alias("accuracy_cat"),
        at_least("product_availability", 4, "GoodAvailability", "LowAvailability").alias(
            "availability_cat"
        ),
        F.when(F.col("discount_applied") == 1, F.lit("Discount"))
        .otherwise(F.lit("NoDiscount"))
        .alias("discount_cat"),
        at_least("rating", 4, "HighRating", "LowRating").alias("rating_cat"),
    )


def _item(column: str) -> Column:
    return F.when(
        F.col(column).isNotNull(), F.concat(F.lit(f"{column}="), F.col(column).cast("string"))
    )


def transactions(labels: DataFrame) -> DataFrame:
    """Item sets: one ``column=value`` item per non-null label of a row."""
    return labels.select(F.array_compact(F.array(*map(_item, labels.columns))).alias("items"))


def pattern_counts(labels: DataFrame) -> DataFrame:
    """Distinct label rows with their number: counted map-side, so a frequent row costs
    one record per map task."""
    return labels.groupBy(*labels.columns).agg(F.count(F.lit(1)).alias("freq"))


def _subset_itemsets(patterns: DataFrame, least: int) -> DataFrame:
    """Every non-empty item set held by ``least`` rows or more, with its frequency.

    Attributes are taken up one by one. A pattern is copied once without the attribute's item
    and once with it, and copies whose items so far are infrequent go at once: no frequent set
    holds an infrequent one. Patterns that have become equal are merged.
    """
    columns = [c for c in patterns.columns if c != "freq"]
    chosen = patterns.withColumn("_items", F.array().cast("array<string>"))
    for at, column in enumerate(columns):
        rest = columns[at + 1 :]
        item = _item(column)
        options = F.when(
            item.isNotNull(), F.array("_items", F.array_append("_items", item))
        ).otherwise(F.array("_items"))
        copied = chosen.select(*rest, F.explode(options).alias("_items"), "freq")
        merged = copied.groupBy(*rest, "_items").agg(F.sum("freq").alias("freq"))
        frequent = (
            merged.groupBy("_items")
            .agg(F.sum("freq").alias("_held"))
            .where((F.col("_held") >= least) | (F.size("_items") == 0))
        )
        # Staged, so that the plan does not double with every attribute.
        chosen = staged(merged.join(frequent.select("_items"), "_items", "left_semi"), "patterns")
    return (
        chosen.filter(F.size("_items") > 0)
        .groupBy(F.array_sort("_items").alias("items"))
        .agg(F.sum("freq").alias("freq"))
    )


def frequent_itemsets(
    labels: DataFrame, min_support: float = 0.05, method: str = "subsets"
) -> DataFrame:
    """Item sets held by at least a share of the rows: (items sorted, freq, total).

    "subsets" grows them from counted patterns, "fpgrowth" from the rows; the sets are the same.
    """
    if method == "subsets":
        patterns = staged(pattern_counts(labels), "patterns")
        # The total is summed over the counted patterns: no second pass over the rows.
        total = patterns.agg(F.sum("freq")).first()[0] or 0
        sets = _subset_itemsets(patterns, math.ceil(min_support * total - 1e-9))
    elif method == "fpgrowth":
        total = labels.count()
        model = FPGrowth(itemsCol="items", minSupport=min_support).fit(transactions(labels))
        sets = model.freqItemsets.select(F.array_sort("items").alias("items"), "freq")
    else:
        raise ValueError(f"no such method: {method}")
    counted = sets.withColumn("total", F.lit(total).cast("bigint"))
    return counted.filter(F.col("freq") >= F.ceil(F.lit(min_support) * F.col("total") - 1e-9))


def association_rules(itemsets: DataFrame, min_confidence: float = 0.6) -> DataFrame:
    """Rules with one item on the right and at least one on the left.

    Every item of a set is tried as the consequent, and the frequencies of both sides are
    looked up by key: equi-joins on the item sets, no pairing of sets with sets. The sets
    are used three times and staged once.
    """
    itemsets = staged(itemsets, "itemsets")
    key = F.array_join("items", SEPARATOR)
    known = itemsets.select(key.alias("_key"), F.col("freq").alias("_freq"))
    split = itemsets.filter(F.size("items") > 1).select(
        "items", "freq", "total", F.explode("items").alias("consequent")
    )
    rules = split.withColumn(
        "antecedent", F.filter("items", lambda i: i != F.col("consequent"))
    ).withColumn("_left", F.array_join("antecedent", SEPARATOR))
    left = known.select(F.col("_key").alias("_left"), F.col("_freq").alias("_left_freq"))
    right = known.select(F.col("_key").alias("consequent"), F.col("_freq").alias("_right_freq"))
    rules = rules.join(left, "_left").join(right, "consequent")
    total = F.col("total").cast("double")
    support = F.col("freq") / total
    confidence = F.col("freq").cast("double") / F.col("_left_freq")
    return rules.select(
        F.concat(
            F.lit("{"), F.array_join("antecedent", ","), F.lit("} => {"),
            F.col("consequent"), F.lit("}"),
        ).alias("rules"),
        support.alias("support"),
        confidence.alias("confidence"),
        (F.col("_left_freq") / total).alias("coverage"),
        (confidence / (F.col("_right_freq") / total)).alias("lift"),
        F.col("freq").alias("count"),
    ).filter(F.col("confidence") >= min_confidence)


def mine_rules(
    labels: DataFrame,
    min_support: float = 0.05,
    min_confidence: float = 0.6,
    method: str = "subsets",
) -> DataFrame:
    """Rule table of a frame of label columns."""
    return association_rules(frequent_itemsets(labels, min_support, method), min_confidence)


def strongest_rules(rules: DataFrame, k: int = 20) -> DataFrame:
    """First k rules by lift; ties by confidence, support and text."""
    return rules.orderBy(F.desc("lift"), F.desc("confidence"), F.desc("support"), "rules").limit(k)
